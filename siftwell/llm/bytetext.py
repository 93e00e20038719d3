"""Vectorised work on batches of texts: words, word hashes and shingle sets from UTF-8 bytes.

All functions take an Arrow string column; nulls are empty texts. ``bounded`` cuts batches to at most
``MOST_ROWS`` rows, and ``shingle_sets`` refuses more, since a row's number shares 64 bits with a hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Fixed mixing constants of the public splitmix64 generator.
GOLDEN, MIX_A, MIX_B = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
SHINGLE = 5
#: Bytes of text worked on at once: the arrays beside them are many times as large.
BATCH_BYTES = 4 << 20
#: Bits of a shingle hash that stay beside eight bits for the row of a batch.
HASH_BITS = 56
MOST_ROWS = 1 << (64 - HASH_BITS)
_SPAN = 4096


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * MIX_A
    x = (x ^ (x >> U64(27))) * MIX_B
    return x ^ (x >> U64(31))


_PLACES = mix64(np.arange(1, _SPAN + 1, dtype=U64) * GOLDEN) | U64(1)
_TURNS = np.arange(1, 65, dtype=U64) * GOLDEN
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def separators(*codes: int) -> np.ndarray:
    """A table of 256 flags that is True for bytes inside words."""
    inside = np.ones(256, dtype=bool)
    inside[list(codes)] = False
    return inside


#: Words are parted by the space and the control characters 9 to 13.
PLAIN_WORDS = separators(32, 9, 10, 11, 12, 13)
#: Words of letters, digits and all non-ASCII characters.
ALNUM_WORDS = separators(*range(0, 48), *range(58, 97), *range(123, 128))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def bounded(batches, column: str = "text", limit: int = BATCH_BYTES):
    """Arrow batches of at most ``MOST_ROWS`` rows whose texts hold at most ``limit`` bytes, or one text alone."""
    for batch in batches:
        _, ends = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1, first + 1)
            last = min(last, first + MOST_ROWS)
            yield batch.slice(first, last - first)
            first = last
    pa.default_memory_pool().release_unused()  # the worker stays for later tasks


def words(body: np.ndarray, offsets: np.ndarray, inside: np.ndarray = PLAIN_WORDS):
    """Words of lower-cased rows: (lowered bytes, starts, ends, row of each word)."""
    low = _LOWER[body]
    within = inside[low]
    n = len(low)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], before[1:] = False, within[:-1]
        after[-1], after[:-1] = False, within[1:]
    starts = np.flatnonzero(within & (~before | edge[:n]))
    ends = np.flatnonzero(within & (~after | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return low, starts, ends, rows


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word from its bytes and their places."""
    if not len(starts):
        return np.zeros(0, U64)
    lengths = ends - starts
    total = int(lengths.sum())
    place = np.arange(total, dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    place -= np.repeat(first, lengths)
    at = place + np.repeat(starts, lengths)
    weights = _PLACES[place & (_SPAN - 1)]
    if int(lengths.max()) > _SPAN:
        far = place >= _SPAN  # a word's hash must not depend on the words around it
        weights[far] = mix64(weights[far] + (place[far] // _SPAN).astype(U64) * GOLDEN)
    sums = np.add.reduceat((low[at].astype(U64) + U64(1)) * weights, first)
    return mix64(sums + lengths.astype(U64) * GOLDEN)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every row: (row << 56 | hash) in order, and the n + 1 bounds of the rows.

    A row with fewer words than ``size`` but at least one has its whole word sequence as one shingle.
    """
    body, offsets = utf8(column)
    n = len(offsets) - 1
    if n > MOST_ROWS:
        raise ValueError(f"{n} rows at once; at most {MOST_ROWS}")
    low, starts, ends, rows = words(body, offsets)
    hashes = word_hashes(low, starts, ends)
    counts = np.bincount(rows, minlength=n) if len(rows) else np.zeros(n, np.int64)
    full = np.zeros(0, np.int64)
    if len(hashes) >= size:
        full = np.flatnonzero(rows[: len(rows) - size + 1] == rows[size - 1 :])
    values = np.zeros(len(full), U64)
    for k in range(size):
        values += mix64(hashes[full + k] + _TURNS[k])
    owner = rows[full]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.searchsorted(rows, short)
        extra = np.zeros(len(short), U64)
        for k in range(size - 1):
            have = counts[short] > k
            extra[have] += mix64(hashes[first[have] + k] + _TURNS[k])
        extra = mix64(extra + counts[short].astype(U64))
        values, owner = np.concatenate([values, extra]), np.concatenate([owner, short])
    keys = (owner.astype(U64) << U64(HASH_BITS)) | (mix64(values) >> U64(64 - HASH_BITS))
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    bounds = np.searchsorted(keys, np.arange(n, dtype=U64) << U64(HASH_BITS)) if n else np.zeros(0, np.int64)
    return keys, np.concatenate([bounds, [len(keys)]]).astype(np.int64)


HASH_MASK = U64((1 << HASH_BITS) - 1)


def pairs_within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All index pairs i < j inside consecutive groups of the given sizes: (i, j, group)."""
    sizes = np.asarray(sizes, np.int64)
    total = int(sizes.sum())
    group = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    later = ends - np.arange(total) - 1
    i = np.repeat(np.arange(total), later)
    j = np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later) + i + 1
    return i, j, group[i]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges (i, j): the least node of each node's component."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        # roots too, then shorten the chains
        np.minimum.at(label, before[i], low)
        np.minimum.at(label, before[j], low)
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label = shorter
        keep = label[i] != label[j]
        i, j = i[keep], j[keep]
    return label
