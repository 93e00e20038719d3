"""SentencePiece encoding and decoding by a streaming Viterbi search.

Pieces come from a ready vocabulary file. A piece's probability follows its rank (Zipf's law over the order
in which the file lists its pieces); bytes stand in for characters that no piece covers. One search walks a
text from left to right along a tree of the pieces and keeps back pointers for a window only: as soon as the
paths of all live positions (at most the longest piece ahead) meet in one boundary, the ids before it are final
and passed on, and the window begins there.

Two characters that stand side by side in no piece always part, so there all paths meet (before every space,
around line feeds and most punctuation). The search takes those boundaries without looking back, one stretch
at a time; what it found for short stretches is remembered in a bounded memory. What grows with a text is the
text itself and its ids, not the search. Where paths never meet (one letter over and over may be parted at odd
or at even places) the window grows, as exactness asks.

The file's own library would merge pairs instead; both give pieces of the same vocabulary that decode to the
same text, and decoding here is exact for every text: spaces stand for themselves and a literal U+2581 becomes
bytes.

Edge cases: null and empty texts have no ids and decode to the empty text; identical rows stay rows; very long
texts and stretches are searched in windows; an empty table gives no rows; other columns are not read by
``digests``.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.support import arrow_batches

VOCABULARY = os.environ.get("SIFTWELL_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
#: Characters between looks for a common boundary; stretches remembered in each of two generations, and their
#: longest (longer ones are searched each time, in the same way).
COMMIT_EVERY, REMEMBERED, LONGEST_REMEMBERED = 64, 200_000, 48
BYTE_COST = -20.0
NEVER = -1e300
_STRETCH = re.compile(r" *[^ \n]+|\n| +")


class Pieces:
    """A vocabulary: texts of the pieces, log probabilities, and the ids of single bytes."""

    def __init__(self, listed: list[tuple[str, float]]) -> None:
        self.table: list[bytes] = [b""] * len(listed)
        self.bytes: list[int] = [0] * 256
        self.ids: dict[str, tuple[int, float]] = {}
        ranked = [(i, p, -s) for i, (p, s) in enumerate(listed)]
        total = log(sum(1 / (k + 1) for k in range(len(listed))))
        for i, p, rank in ranked:
            if m := re.fullmatch(r"<0x([0-9A-F]{2})>", p):
                self.bytes[int(m[1], 16)] = i
                self.table[i] = bytes([int(m[1], 16)])
            elif p not in ("<unk>", "<s>", "</s>"):
                text = p.replace("▁", " ")
                # runs of spaces carry no rank: the longest run wins
                self.ids[text] = (i, -log((1 if not text.strip(" ") and len(text) > 1 else min(max(rank, 0), len(listed))) + 2) - total)
                self.table[i] = text.encode()
        self.longest = max(map(len, self.ids))
        self.parts = not any(" " in t.lstrip(" ") or "\n" in t for t in self.ids)
        self.joined = {t[k : k + 2] for t in self.ids for k in range(len(t) - 1)}
        # a tree of the pieces by character: (branches, id or -1, score)
        self.root: tuple = ({}, -1, 0.0)
        for t, (i, score) in sorted(self.ids.items()):
            node = self.root
            for c in t[:-1]:
                node = node[0].setdefault(c, ({}, -1, 0.0))
            node[0][t[-1]] = ({}, i, score)
        self.young: dict[str, array] = {}
        self.old: dict[str, array] = {}
        #: The widest window so far.
        self.widest = 0

    def search(self, text: str):
        """Yield the ids of the best path over ``text``, a run at a time as they become final."""
        n, longest, root, known = len(text), self.longest, self.root, self.ids
        room = min(n, COMMIT_EVERY + longest)
        # for positions from `base` on; everything before is final
        base, score, come, piece = 0, [0.0] + [NEVER] * room, [0] * (room + 1), [0] * (room + 1)
        look = COMMIT_EVERY
        for start in range(n):
            at = start - base
            if at == look:
                live = [k for k in range(at, min(at + longest, n - base) + 1) if score[k] > NEVER]
                meet = _meeting(come, live)
                if meet:
                    yield self._path(text, base, come, piece, meet)
                    base += meet
                    score, piece = score[meet:] + [NEVER] * meet, piece[meet:] + [0] * meet
                    come = [c - meet for c in come[meet:]] + [0] * meet
                    at, look = start - base, COMMIT_EVERY
                    while look <= at:
                        look += COMMIT_EVERY
                else:
                    look *= 2  # looking back costs as much as the window is wide
                grow = look + longest + 1 - len(score)
                if grow > 0:
                    score, come, piece = score + [NEVER] * grow, come + [0] * grow, piece + [0] * grow
                self.widest = max(self.widest, len(score))
            s, node, end = score[at], root, at
            for c in text[start : start + longest]:
                node = node[0].get(c)
                if node is None:
                    break
                end += 1
                if node[1] >= 0 and s + node[2] > score[end]:
                    score[end], come[end], piece[end] = s + node[2], at, node[1]
            if text[start] not in known:
                raw = s + BYTE_COST * len(text[start].encode("utf-8", "surrogatepass"))
                if raw > score[at + 1]:
                    score[at + 1], come[at + 1], piece[at + 1] = raw, at, -1
        if n > base:
            yield self._path(text, base, come, piece, n - base)

    def _path(self, text: str, base: int, come: list, piece: list, at: int) -> array:
        """Ids along the back pointers from ``at`` to the window's beginning."""
        out = []
        while at:
            if piece[at] < 0:
                raw = text[base + come[at] : base + at].encode("utf-8", "surrogatepass")
                out += [self.bytes[x] for x in reversed(raw)]
            else:
                out.append(piece[at])
            at = come[at]
        out.reverse()
        return array("i", out)

    def _found(self, stretch: str) -> array:
        """All ids of a stretch."""
        if len(stretch) <= COMMIT_EVERY:
            return next(self.search(stretch))
        out = array("i")
        for run in self.search(stretch):
            out.extend(run)
        return out

    def _keep(self, stretch: str, got: array) -> array:
        """Remember a stretch; what has not been asked for since two fillings is forgotten."""
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[stretch] = got
        return got

    def _stretch(self, stretch: str) -> array:
        """Ids of a stretch that is not among the young."""
        got = self.old.get(stretch)
        if got is not None:
            return self._keep(stretch, got)
        # nearly all letters join somewhere: words of letters are searched whole
        word = stretch.isalpha() or stretch[1:].isalpha()
        cuts = [] if word else [k for k in range(1, len(stretch)) if stretch[k - 1 : k + 1] not in self.joined]
        if not cuts:
            found = self._found(stretch)
            return self._keep(stretch, found) if len(stretch) <= LONGEST_REMEMBERED else found
        out = array("i")
        for a, b in zip([0, *cuts], [*cuts, len(stretch)], strict=True):
            part = stretch[a:b]
            out.extend(self.young.get(part) or self._stretch(part))
        return self._keep(stretch, out) if len(stretch) <= LONGEST_REMEMBERED else out

    def encode(self, text: str) -> array:
        """Ids of ``text``; the text is read as if it began with a space."""
        out = array("i")
        if not text:
            return out
        text = " " + text
        if not self.parts:
            return self._found(text)
        for m in _STRETCH.finditer(text):
            stretch = m[0]
            out.extend(self.young.get(stretch) or self._stretch(stretch))
        return out

    def decode(self, ids) -> str:
        """The text of ``ids``."""
        return b"".join(map(self.table.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


def _meeting(come: list, live: list) -> int:
    """The last boundary that the paths of all ``live`` positions, in order, go through."""
    paths = set(live)
    while len(paths) > 1:
        last = max(paths)
        paths.discard(last)
        paths.add(come[last])
    return paths.pop()


def load(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) of a vocabulary file, in order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


_open: dict = {}


def _shared(listed, key: str) -> Pieces:
    """One vocabulary a Python worker, so that its memory serves all tasks; ``key`` tells vocabularies apart."""
    if key not in _open:
        _open.clear()
        _open[key] = Pieces(listed)
    return _open[key]


def _encoder(listed):
    key = hashlib.sha256(repr(listed).encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches):
        pieces = _shared(listed, key)
        for batch in batches:
            ids, ends, chars, whole, marks, again = array("i"), [0], [], [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                got = pieces.encode(text)
                back = pieces.decode(got)
                ids.extend(got)
                ends.append(len(ids))
                chars.append(len(text))
                whole.append(back == text)
                marks.append(hashlib.sha256(got.tobytes()).hexdigest())
                again.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(pa.int32(), len(ids), [None, pa.py_buffer(ids.tobytes())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, pa.array(chars, pa.int64()), pa.array(marks, pa.string()), pa.array(again, pa.string()), pa.array(whole, pa.bool_())],
                ["doc_id", "ids", "n_chars", "ids_sha256", "decoded_sha256", "round_trip"],
            )
            del ids, lists, batch
        pieces.old = {}  # the worker stays for later tasks
        pa.default_memory_pool().release_unused()

    return run


def encode(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, n_chars, ids_sha256, decoded_sha256, round_trip) for every row of ``docs``."""
    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encoder(load(path)),
        "doc_id long, ids array<int>, n_chars long, ids_sha256 string, decoded_sha256 string, round_trip boolean",
    )


def digests(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Counts and hashes of what encoding and decoding give."""
    return encode(docs, path).select(
        "doc_id", "n_chars", F.size("ids").cast("long").alias("n_ids"), "ids_sha256", "decoded_sha256", "round_trip"
    )
