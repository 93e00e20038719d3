"""Baseline JPEG in NumPy: what Pillow does where it is installed, for machines without it.

Written images are three-channel and unsampled, with Huffman codes made for the image. Read are baseline images of
one or three components, any whole sampling factors, and restart intervals; progressive and arithmetic ones are not.
"""

from __future__ import annotations

import heapq
import struct
from collections import Counter

import numpy as np

# fixed values: quantisation of brightness and of colour at quality 50, row by row
BRIGHT = [
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
]
COLOUR = [17, 18, 24, 47, 18, 21, 26, 66, 24, 26, 56, 99, 47, 66, 99, 99]
#: Places of an 8 x 8 block along its diagonals, every other one turned.
ZIGZAG = np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, (p // 8 if (p // 8 + p % 8) % 2 else p % 8))))
_K = np.arange(8)
#: Rows are the cosines of the orthonormal transform.
_DCT = np.sqrt(np.where(_K == 0, 1, 2) / 8)[:, None] * np.cos((2 * _K[None, :] + 1) * _K[:, None] * np.pi / 16)


def tables(quality: int) -> list[np.ndarray]:
    """Quantisation of brightness and colour for a quality of 1 to 100."""
    scale = 5000 // max(1, quality) if quality < 50 else 200 - 2 * min(quality, 100)
    colour = np.full((8, 8), 99)
    colour[:4, :4] = np.array(COLOUR).reshape(4, 4)
    return [np.clip((t * scale + 50) // 100, 1, 255) for t in (np.array(BRIGHT).reshape(8, 8), colour)]


def _code_lengths(counts: dict[int, int]) -> dict[int, int]:
    """Huffman code lengths of at most 16 bits; no code is all ones, as the format asks."""
    heap = [(n, k, (s,)) for k, (s, n) in enumerate(sorted(counts.items()))] + [(0, -1, (-1,))]
    heapq.heapify(heap)
    depth: Counter = Counter()
    serial = len(heap)
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        for s in (*x, *y):
            depth[s] += 1
        heapq.heappush(heap, (a + b, serial, (*x, *y)))
        serial += 1
    sizes = Counter(max(1, d) for d in depth.values())
    for d in range(max(sizes), 16, -1):  # too deep: two leaves move up, a higher leaf becomes a fork
        while sizes[d]:
            up = next(j for j in range(d - 2, 0, -1) if sizes[j])
            sizes[d] -= 2
            sizes[d - 1] += 1
            sizes[up + 1] += 2
            sizes[up] -= 1
    sizes[max(d for d in sizes if sizes[d])] -= 1  # the reserved code
    lengths = [d for d in range(1, 17) for _ in range(sizes[d])]
    order = sorted(counts, key=lambda s: (-counts[s], s))
    return dict(zip(order, lengths, strict=True))


def _codes(lengths: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """Symbol to (code, length) for (symbol, length) in order of length."""
    out, code, last = {}, 0, 0
    for s, n in lengths:
        code <<= n - last
        out[s], code, last = (code, n), code + 1, n
    return out


def _size(values: np.ndarray) -> np.ndarray:
    """Bits of the magnitudes."""
    return np.ceil(np.log2(np.abs(values).astype(np.float64) + 1)).astype(np.int64)


def _symbols(blocks: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(block, table kind, symbol, value) of zigzag blocks of one component, in order; kind 0 is DC, 1 AC."""
    gaps = np.diff(blocks[:, 0], prepend=0)
    out = [(i, -1, 0, int(s), int(v)) for i, (s, v) in enumerate(zip(_size(gaps), gaps, strict=True))]
    row, place = np.nonzero(blocks[:, 1:])
    value = blocks[row, place + 1]
    before = np.where(np.diff(row, prepend=-1) == 0, np.concatenate([[0], place[:-1]]) if len(place) else place, -1)
    run = place - before - 1
    for i, p, r, s, v in zip(row.tolist(), place.tolist(), run.tolist(), _size(value).tolist(), value.tolist(), strict=True):
        out += [(i, p - r + 16 * k, 1, 0xF0, 0) for k in range(r // 16)]
        out.append((i, p, 1, r % 16 * 16 + s, v))
    last = np.full(len(blocks), -1)
    np.maximum.at(last, row, place)
    out += [(int(i), 99, 1, 0, 0) for i in np.flatnonzero(last < 62)]
    out.sort(key=lambda x: (x[0], x[1]))
    return [(i, kind, s, v) for i, _, kind, s, v in out]


def encode(rgb: np.ndarray, quality: int = 95) -> bytes:
    """Height x width x 3 as a baseline JPEG."""
    h, w, _ = rgb.shape
    r, g, b = np.moveaxis(rgb.astype(np.float64), -1, 0)
    y = 0.299 * r + 0.587 * g + 0.114 * b
    planes = [y, (b - y) / 1.772 + 128, (r - y) / 1.402 + 128]
    quant = tables(quality)
    told, counts = [], [Counter(), Counter(), Counter(), Counter()]
    for c, plane in enumerate(planes):
        full = np.pad(plane, ((0, -h % 8), (0, -w % 8)), mode="edge") - 128
        cells = full.reshape(full.shape[0] // 8, 8, -1, 8).swapaxes(1, 2).reshape(-1, 8, 8)
        waves = np.rint(_DCT @ cells @ _DCT.T / quant[min(c, 1)]).astype(np.int64)
        told.append(_symbols(waves.reshape(-1, 64)[:, ZIGZAG]))
        for _, kind, s, _ in told[-1]:
            counts[2 * min(c, 1) + kind][s] += 1
    lengths = [sorted(_code_lengths(n).items(), key=lambda x: x[1]) for n in counts]
    codes = [_codes(n) for n in lengths]
    by_block: list[list[str]] = [[] for _ in range(told[0][-1][0] + 1)]
    for c, rows in enumerate(told):
        for i, kind, s, v in rows:
            code, n = codes[2 * min(c, 1) + kind][s]
            bits = s if kind == 0 else s & 15
            extra = f"{v if v > 0 else v + (1 << bits) - 1:0{bits}b}" if bits else ""
            by_block[i].append(f"{code:0{n}b}{extra}")
    line = "".join("".join(x) for x in by_block)
    line += "1" * (-len(line) % 8)
    body = int(line, 2).to_bytes(len(line) // 8, "big").replace(b"\xff", b"\xff\x00")
    part = lambda mark, data: struct.pack(">BBH", 0xFF, mark, len(data) + 2) + data
    out = b"\xff\xd8" + part(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")
    for k, q in enumerate(quant):
        out += part(0xDB, bytes([k]) + bytes(q.reshape(-1)[ZIGZAG].astype(np.uint8)))
    out += part(0xC0, struct.pack(">BHHB", 8, h, w, 3) + bytes([1, 0x11, 0, 2, 0x11, 1, 3, 0x11, 1]))
    for k, n in enumerate(lengths):
        sizes = Counter(d for _, d in n)
        out += part(0xC4, bytes([k // 2 | k % 2 << 4]) + bytes(sizes[d] for d in range(1, 17)) + bytes(s for s, _ in n))
    return out + part(0xDA, bytes([3, 1, 0, 2, 0x11, 3, 0x11, 0, 63, 0])) + body + b"\xff\xd9"


class _Bits:
    """Bits of a stretch between restart marks."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.held, self.n = data.replace(b"\xff\x00", b"\xff"), 0, 0, 0

    def take(self, n: int) -> int:
        while self.n < n:
            more = self.data[self.at : self.at + 6] or b"\0\0"
            self.at += 6
            self.held = self.held << 8 * len(more) | int.from_bytes(more, "big")
            self.n += 8 * len(more)
        self.n -= n
        out = self.held >> self.n
        self.held &= (1 << self.n) - 1
        return out

    def symbol(self, codes: dict) -> int:
        code = n = 0
        while n < 16:
            code, n = code << 1 | self.take(1), n + 1
            found = codes.get((code, n))
            if found is not None:
                return found
        raise ValueError("a code that no table holds")

    def value(self, bits: int) -> int:
        if not bits:
            return 0
        v = self.take(bits)
        return v if v >> bits - 1 else v - (1 << bits) + 1


def decode(data: bytes) -> np.ndarray:
    """A baseline JPEG as height x width x 3."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG image")
    at, quant, codes, frame, interval = 2, {}, {}, None, 0
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("a JPEG image that ends early")
        mark, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        part = data[at + 4 : at + 2 + size]
        at += 2 + size
        if mark == 0xDB:
            while part:
                wide = part[0] >> 4
                quant[part[0] & 15] = np.frombuffer(part[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int64)
                part = part[65 + 64 * wide :]
        elif mark == 0xC4:
            while part:
                n = sum(part[1:17])
                lengths = [d for d in range(1, 17) for _ in range(part[d])]
                codes[part[0]] = {code: s for s, code in _codes(list(zip(range(n), lengths, strict=True))).items()}
                codes[part[0]] = {code: part[17 + s] for code, s in codes[part[0]].items()}
                part = part[17 + n :]
        elif mark in (0xC0, 0xC1):
            depth, h, w, n = struct.unpack(">BHHB", part[:6])
            frame = [(part[6 + 3 * k], part[7 + 3 * k] >> 4, part[7 + 3 * k] & 15, part[8 + 3 * k]) for k in range(n)]
            if depth != 8 or n not in (1, 3):
                raise ValueError("only 8-bit images of one or three components are read")
        elif 0xC2 <= mark <= 0xCF:
            raise ValueError("only baseline JPEG images are read without Pillow")
        elif mark == 0xDD:
            interval = struct.unpack(">H", part)[0]
        elif mark == 0xDA:
            break
    if frame is None or part[0] != len(frame):
        raise ValueError("a scan that does not hold the whole image")
    which = {part[1 + 2 * k]: part[2 + 2 * k] for k in range(part[0])}
    if len(frame) == 1:
        frame = [(frame[0][0], 1, 1, frame[0][3])]
    wide, high = max(f[1] for f in frame), max(f[2] for f in frame)
    across, down = -(-w // (8 * wide)), -(-h // (8 * high))
    waves = [np.zeros((down * v, across * u, 64), np.int64) for _, u, v, _ in frame]
    stretches, begin = [], at
    while at < len(data) - 1:
        if data[at] == 0xFF and data[at + 1] not in (0, 0xFF):
            stretches.append(data[begin:at])
            if not 0xD0 <= data[at + 1] <= 0xD7:
                break
            begin = at + 2
            at += 1
        at += 1
    else:
        stretches.append(data[begin:])
    units = iter(range(across * down))
    for stretch in stretches:
        bits, last = _Bits(stretch), [0] * len(frame)
        for unit, _ in zip(units, range(interval or across * down), strict=False):
            for k, (name, u, v, _) in enumerate(frame):
                dc, ac = codes[which[name] >> 4], codes[0x10 | which[name] & 15]
                for j in range(u * v):
                    block = waves[k][unit // across * v + j // u, unit % across * u + j % u]
                    last[k] += bits.value(bits.symbol(dc))
                    block[0], place = last[k], 1
                    while place < 64:
                        s = bits.symbol(ac)
                        if not s:
                            break
                        place += s >> 4
                        if s & 15:
                            block[place] = bits.value(s & 15)
                        place += 1
            if interval and (unit + 1) % interval == 0:
                break
    planes = []
    for found, (_, u, v, q) in zip(waves, frame, strict=True):
        cells = np.zeros(found.shape, np.float64)
        cells[..., ZIGZAG] = found * quant[q]
        pixels = _DCT.T @ cells.reshape(*found.shape[:2], 8, 8) @ _DCT + 128
        plane = pixels.swapaxes(1, 2).reshape(found.shape[0] * 8, -1)
        planes.append(plane.repeat(high // v, axis=0).repeat(wide // u, axis=1)[:h, :w])
    if len(planes) == 1:
        planes = [planes[0], np.full((h, w), 128.0), np.full((h, w), 128.0)]
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    rgb = np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], axis=-1)
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)
