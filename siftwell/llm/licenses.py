"""License scans: exact phrase places, and an exact set-similarity join with notice templates.

Base: every place where a phrase's words stand one after another. Templates: public notices, from a line to
several paragraphs, as sets of word pairs, that is neighbouring words in their order, so scattered words do not
make a notice. A text's words are cut, across lines, into blocks of two and a half times a template's length
that overlap by half. A block meets a template if it holds at least ``CONTAINMENT`` of its pairs. Templates of
one family (``apache``, ``cc`` and so on) exclude each other: of overlapping blocks that meet some of them, only
those with the highest containment give their labels, so a share-alike notice is no plain attribution notice.

The join is exact. A first pass counts the templates' pairs over all documents; templates list their pairs
from the rarest on. A block can only meet a template of s pairs, of which it must hold c, if it holds one of
the s - c + 1 rarest (prefix filter), has c distinct known pairs itself (length filter), and, where its first
match is the template's i-th pair, s - i >= c (positional filter). What passes is counted in full.

Edge cases: a null or empty text has no words, no places and empty labels; repeated rows stay rows; without
documents every pair counts as equally rare; texts of any length are scanned whole; other columns are not read.
"""

from __future__ import annotations

import re
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm import bytetext as bt
from siftwell.llm.support import arrow_batches

# fixed values: phrases and the labels they give
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# fixed values: common public notices and the labels they give; the part of a label before its first sign is its family
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
    with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
    Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
    on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
    the specific language governing permissions and limitations under the License.""": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
    License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
    later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
    even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
    License for more details.""": "gpl-3.0",
    """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
    License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any
    later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
    even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
    License for more details.""": "gpl-2.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4.0",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4.0",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-grant",
    """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation
    the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
    to permit persons to whom the Software is furnished to do so, subject to the following conditions:
    The above copyright notice and this permission notice shall be included in all copies or substantial portions of
    the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
    NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""": "mit-grant",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
    of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
    notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution.""": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
    distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""": "mpl",
}
#: Least share of a template's word pairs that a block holds, in fifths: whole numbers do not round.
CONTAINMENT = 4, 5
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    """Lower-cased words of letters, digits and all non-ASCII characters."""
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def family(label: str) -> str:
    """The part of a label that templates which exclude each other share."""
    return label.split("-")[0]


def stride(template: str) -> int:
    """Half of a template's block length, in words."""
    return ceil(len(words_of(template)) * 5 / 4)


def _hash(word: str) -> np.uint64:
    raw = np.frombuffer(word.encode(), np.uint8)
    return bt.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """A hash of every word and the word after it; the last has none and gets 0."""
    out = np.zeros(len(hashes), np.uint64)
    out[:-1] = bt.mix64(bt.mix64(hashes[:-1] + bt.GOLDEN) + hashes[1:])
    return out


class Templates:
    """Phrases and templates by hash; word pairs are ordered by how many documents hold them."""

    def __init__(self, counts: dict[int, int] | None = None) -> None:
        told = {t: words_of(t) for t in TEMPLATES}
        pairs = {p for w in told.values() for p in zip(w, w[1:], strict=False)}
        hashes = {p: _pairs(np.array([_hash(p[0]), _hash(p[1])]))[0] for p in pairs}
        counts = counts or {}
        # the global order: rare pairs first, ties by spelling
        order = sorted(pairs, key=lambda p: (counts.get(int(hashes[p]), 0), p))
        by_hash = np.array([hashes[p] for p in order], np.uint64)
        self.sorter = np.argsort(by_hash)
        self.hashes = by_hash[self.sorter]
        self.labels = list(TEMPLATES.values())
        self.strides = [stride(t) for t in TEMPLATES]
        self.holds = np.zeros((len(self.labels), len(order)), bool)
        place = {p: k for k, p in enumerate(order)}
        for k, w in enumerate(told.values()):
            self.holds[k, [place[p] for p in zip(w, w[1:], strict=False)]] = True
        self.sizes = self.holds.sum(axis=1)
        few, of = CONTAINMENT
        self.need = -(-few * self.sizes // of)
        # rank of a pair within each template, and the template's prefix
        self.rank = np.where(self.holds, self.holds.cumsum(axis=1) - 1, 10**6)
        self.prefix = self.rank < (self.sizes - self.need + 1)[:, None]
        self.phrases = [([_hash(w) for w in p.split()], p.encode(), label) for p, label in PHRASES.items()]

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Place in the global order of each word pair, or -1."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.sorter[at], -1)


def _words(batch: pa.RecordBatch, known: Templates):
    """Words of a batch, their hashes, and the code of the pair that each begins, if it lies in one text."""
    low, starts, ends, rows = bt.words(*bt.utf8(batch.column("text")), bt.ALNUM_WORDS)
    hashes = bt.word_hashes(low, starts, ends)
    code = known.codes(_pairs(hashes)) if len(hashes) else np.zeros(0, np.int64)
    if len(code):
        code[-1] = -1
        code[:-1][rows[:-1] != rows[1:]] = -1
    return low, starts, ends, rows, hashes, code


def _counts(batches):
    """How many documents hold each word pair of the templates."""
    known = Templates()
    seen = np.zeros(len(known.hashes), np.int64)
    for batch in bt.bounded(batches):
        _, _, _, rows, _, code = _words(batch, known)
        use = code >= 0
        distinct = np.unique(rows[use] * len(known.hashes) + code[use])
        seen += np.bincount(distinct % len(known.hashes), minlength=len(known.hashes))
    hashes = np.empty(len(seen), np.uint64)
    hashes[known.sorter] = known.hashes
    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(seen)], ["pair", "n"])


def pair_frequencies(docs: DataFrame) -> dict[int, int]:
    """Document frequency of every word pair of the templates; as many numbers as there are such pairs."""
    rows = docs.select("text").mapInArrow(_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return {int(np.int64(r["pair"]).view(np.uint64)): r["n"] for r in rows}


def _meet(known: Templates, code: np.ndarray, nth: np.ndarray, rows: np.ndarray) -> list[tuple]:
    """(row, template, first word, word after the last, pairs held) of every block that meets a template."""
    out = []
    use = np.flatnonzero(code >= 0)
    for k, half in enumerate(known.strides):
        own = use[known.holds[k, code[use]]]
        # a pair lies in the block that starts at or before its half, and in the one before
        block = nth[own] // half
        owner, block = np.concatenate([own, own[block > 0]]), np.concatenate([block, block[block > 0] - 1])
        key = rows[owner] * np.int64(1 << 40) + block
        held = known.prefix[k, code[owner]]
        if not held.any():
            continue
        hot, at = np.unique(key[held]), None
        at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
        inside = hot[at] == key
        at, rank = at[inside], known.rank[k, code[owner[inside]]]
        first = np.full(len(hot), 10**6)
        np.minimum.at(first, at, rank)
        distinct = np.unique(at * np.int64(known.sizes[k]) + rank)
        held = np.bincount(distinct // known.sizes[k], minlength=len(hot))
        for b in np.flatnonzero((known.sizes[k] - first >= known.need[k]) & (held >= known.need[k])):
            row, w = int(hot[b] >> 40), int(hot[b] & ((1 << 40) - 1))
            out.append((row, k, w * half, (w + 2) * half, int(held[b])))
    return out


def _told(known: Templates, met: list[tuple], n: int) -> tuple[list[set], np.ndarray]:
    """Labels and best containment of every row; overlapping blocks of a family give those of the highest."""
    labels: list[set] = [set() for _ in range(n)]
    best = np.zeros(n)
    by: dict[tuple, list] = {}
    for row, k, start, end, held in met:
        by.setdefault((row, family(known.labels[k])), []).append((start, end, held / known.sizes[k], known.labels[k]))
        best[row] = max(best[row], held / known.sizes[k])
    for (row, _), blocks in by.items():
        blocks.sort()
        widest = max(end - start for start, end, *_ in blocks)
        begins = [b[0] for b in blocks]
        for start, end, share, label in blocks:
            a, b = np.searchsorted(begins, [start - widest, end])
            if all(s <= share for x, y, s, _ in blocks[a:b] if y > start and x < end):
                labels[row].add(label)
    return labels, best


def _scanner(counts: dict[int, int]):
    def run(batches):
        known = Templates(counts)
        for batch in bt.bounded(batches):
            n = batch.num_rows
            low, starts, ends, rows, hashes, code = _words(batch, known)
            heads = np.searchsorted(rows, np.arange(n))
            base: list[set] = [set() for _ in range(n)]
            places, first, last = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
            for parts, spelled, label in known.phrases:
                last_start = len(hashes) - len(parts) + 1
                if last_start <= 0:
                    continue
                hit = rows[:last_start] == rows[len(parts) - 1 :]
                for k, h in enumerate(parts):
                    hit &= hashes[k : k + last_start] == h
                for w in np.flatnonzero(hit):
                    if b" ".join(low[starts[w + k] : ends[w + k]].tobytes() for k in range(len(parts))) != spelled:
                        continue
                    r, nth = rows[w], w - heads[rows[w]]
                    base[r].add(label)
                    places[r] += 1
                    first[r] = nth if first[r] < 0 else min(first[r], nth)
                    last[r] = max(last[r], nth)
            met = _meet(known, code, np.arange(len(rows)) - heads[rows], rows) if len(rows) else []
            labels, best = _told(known, met, n)
            score = np.where(places > 0, 1.0, best)
            none = places == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.bincount(rows, minlength=n).astype(np.int64)),
                    pa.array(places),
                    pa.array(first.astype(np.int64), mask=none),
                    pa.array(last.astype(np.int64), mask=none),
                    pa.array([",".join(sorted(b)) for b in base], pa.string()),
                    pa.array([",".join(sorted(b | m)) for b, m in zip(base, labels, strict=True)], pa.string()),
                    pa.array(score),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


def scan(docs: DataFrame) -> DataFrame:
    """Words, phrase places, labels and score of every row of ``docs``."""
    arrow_batches(docs.sparkSession)
    counts = pair_frequencies(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scanner(counts),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )


def _listed(words: list[str]) -> str:
    return "[" + ",".join(f"'{w}'" for w in words) + "]"


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
u AS (SELECT row_id, unnest(range(0, len(w))) AS nth, unnest(w) AS a FROM d),
p AS (SELECT row_id, nth, a, lead(a) OVER run AS b, lead(a, 2) OVER run AS c, lead(a, 3) OVER run AS e FROM u WINDOW run AS (PARTITION BY row_id ORDER BY nth)),
phrase(words, label) AS (VALUES {", ".join(f"({_listed(k.split())}, '{v}')" for k, v in PHRASES.items())}),
base AS (SELECT row_id, nth, label FROM p JOIN phrase ON a = words[1] AND b = words[2] AND (len(words) < 3 OR c = words[3]) AND (len(words) < 4 OR e = words[4])),
template(id, words, label, family, half) AS (VALUES {", ".join(f"({k}, {_listed(words_of(t))}, '{v}', '{family(v)}', {stride(t)})" for k, (t, v) in enumerate(TEMPLATES.items()))}),
pair AS (SELECT DISTINCT id, unnest(words[:-2]) AS a, unnest(words[2:]) AS b FROM template),
size AS (SELECT id, count(*) AS size FROM pair GROUP BY id),
hit AS (SELECT row_id, id, nth // half AS block, p.a, p.b FROM p JOIN pair ON p.a = pair.a AND p.b = pair.b JOIN template USING (id)),
twice AS (SELECT row_id, id, block, a, b FROM hit UNION SELECT row_id, id, block - 1, a, b FROM hit WHERE block > 0),
met AS (SELECT row_id, id, block, count(*) AS held FROM twice GROUP BY ALL),
block AS (
  SELECT row_id, label, family, block * half AS first, (block + 2) * half AS after, held / size AS share
  FROM met JOIN size USING (id) JOIN template USING (id) WHERE {CONTAINMENT[1]} * held >= {CONTAINMENT[0]} * size),
told AS (SELECT row_id, label FROM block x WHERE NOT EXISTS (
  SELECT 1 FROM block y WHERE y.row_id = x.row_id AND y.family = x.family AND y.after > x.first AND y.first < x.after AND y.share > x.share)),
b AS (SELECT row_id, count(*) AS n, min(nth) AS lo, max(nth) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM base GROUP BY row_id),
l AS (SELECT row_id, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM (SELECT row_id, label FROM base UNION SELECT row_id, label FROM told) GROUP BY row_id),
s AS (SELECT row_id, max(share) AS share FROM block GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word,
       coalesce(b.l, '') AS base_labels, coalesce(l.l, '') AS labels, CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(s.share, 0)::DOUBLE END AS score
FROM d LEFT JOIN b USING (row_id) LEFT JOIN l USING (row_id) LEFT JOIN s USING (row_id)
"""
