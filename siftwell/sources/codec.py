"""Image codecs: PNG and baseline JPEG in NumPy; all else through Pillow where it is installed."""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np

from siftwell.sources import jpeg

_MAGIC = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _unfilter(raw: np.ndarray, kinds: np.ndarray, unit: int) -> np.ndarray:
    """Undo PNG row filters."""
    out = np.zeros_like(raw)
    above = np.zeros(raw.shape[1], np.int64)
    for y, kind in enumerate(kinds):
        line = raw[y].astype(np.int64)
        if kind == 1:
            line = line.reshape(-1, unit).cumsum(axis=0).reshape(-1)
        elif kind == 2:
            line = line + above
        elif kind in (3, 4):
            for x in range(len(line)):
                left = line[x - unit] if x >= unit else 0
                if kind == 3:
                    line[x] = (line[x] + (left + above[x]) // 2) & 255
                else:
                    corner = above[x - unit] if x >= unit else 0
                    guess = left + above[x] - corner
                    line[x] = (line[x] + min((left, above[x], corner), key=lambda v: abs(guess - v))) & 255
        above = line & 255
        out[y] = above
    return out


def decode_png(data: bytes) -> np.ndarray:
    """An 8-bit PNG without interlacing as height x width x 3."""
    if data[:8] != _MAGIC:
        raise ValueError("not a PNG image")
    at, body, palette, head = 8, b"", None, None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += chunk
        at += size + 12
    width, height, depth, colour, _, _, interlace = head
    if depth != 8 or interlace:
        raise ValueError("only 8-bit PNG images without interlacing are read")
    unit = _CHANNELS[colour]
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, width * unit + 1)
    pixels = _unfilter(lines[:, 1:], lines[:, 0], unit).reshape(height, width, unit)
    if colour == 3:
        return palette[pixels[..., 0]]
    return np.repeat(pixels[..., :1], 3, axis=2) if unit < 3 else np.ascontiguousarray(pixels[..., :3])


def encode_png(rgb: np.ndarray) -> bytes:
    """Height x width x 3 as PNG."""
    h, w, _ = rgb.shape
    lines = np.concatenate([np.zeros((h, 1), np.uint8), rgb.reshape(h, w * 3)], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return _MAGIC + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    """Any known image as height x width x 3."""
    if data[:8] == _MAGIC:
        try:
            return decode_png(data)
        except (ValueError, KeyError):
            pass
    try:
        from PIL import Image
    except ImportError:
        if data[:2] == b"\xff\xd8":
            return jpeg.decode(data)
        raise ValueError("images other than 8-bit PNG and baseline JPEG need Pillow") from None
    return np.asarray(Image.open(io.BytesIO(data)).convert("RGB"))


def encode(rgb: np.ndarray, image_format: str = "png", quality: int = 95) -> bytes:
    """An image as PNG or JPEG."""
    if image_format.lower() == "png":
        return encode_png(rgb)
    try:
        from PIL import Image
    except ImportError:
        return jpeg.encode(rgb, quality)
    out = io.BytesIO()
    Image.fromarray(rgb).save(out, format="JPEG", quality=quality)
    return out.getvalue()
