"""Letter classes and letter trigrams of batches of texts.

Characters fall into 64 classes: 0 for anything but letters, 1 to 26 for a to z, and 37 hashed classes for
all other letters. Case is folded; runs of non-letters count as one; a row is framed by non-letters.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from siftwell.llm import bytetext as bt

CLASSES = 64
TRIGRAMS = CLASSES**3


def letter_class(c: str) -> int:
    """The class of one character."""
    if not c.isalpha():
        return 0
    low = c.lower()[0]
    return ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % 37


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            table[cp] = letter_class(c)
    return table


def _code_points(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows and the n + 1 bounds of the rows."""
    raw = body.tobytes()
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        rows = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        return np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32), bounds
    heads = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
    return np.frombuffer(text.encode("utf-32-le"), np.uint32), heads[offsets]


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, trigram) of every letter trigram; at least one of its characters is a letter."""
    points, bounds = _code_points(*bt.utf8(column))
    n = len(bounds) - 1
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes + 2)
    classes = np.zeros(len(owner), np.uint8)
    first = np.cumsum(sizes + 2) - sizes - 1
    at = np.arange(len(points)) - np.repeat(bounds[:-1], sizes) + np.repeat(first, sizes)
    classes[at] = class_table()[points]
    keep = np.ones(len(classes), bool)
    keep[1:] = (classes[1:] != 0) | (classes[:-1] != 0) | (owner[1:] != owner[:-1])
    classes, owner = classes[keep].astype(np.int64), owner[keep]
    tri = classes[:-2] * CLASSES**2 + classes[1:-1] * CLASSES + classes[2:]
    whole = (owner[:-2] == owner[2:]) & (tri != 0)
    return owner[:-2][whole], tri[whole]


def counted(owner: np.ndarray, tri: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, trigram) with their counts."""
    keys, counts = np.unique(owner * TRIGRAMS + tri, return_counts=True)
    return keys // TRIGRAMS, keys % TRIGRAMS, counts
