"""Toxicity scores of restored text by a noisy-channel decoder.

Restoring: a token that mixes letters with look-alike digits or signs, stretches a letter, or spaces its
letters out becomes a lattice: each character may stand for its look-alikes or for nothing, a letter that
is repeated for one or two, and a joiner or gap between letters for nothing or the end of a word. Other
signs part a token before it is decoded. Viterbi picks the path that is likeliest under a letter trigram model and the
channel's costs; tokens of any length are decoded in full. The letter model counts all texts of the table; labels have no part in it.

Scoring: a text's features are its words and the words' first four and five bytes, together with those of
its restored tokens. Features are weighed by logistic regression over the ``FEATURES`` that tell the labels
apart best. The fit takes a bounded sample: at most ``FIT_ROWS`` labelled documents outside the held-out third,
the first in a seeded order; a doc_id that repeats among them teaches once, by the first of its texts. Labels, language, source and id are never inputs.

Edge cases: null and empty texts have no features and get the base score; rows without a label are scored
but not learned from; a document with several labels counts as toxic if one of them says so; without
training rows every score is 0; repeated rows stay rows; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm import bytetext as bt
from siftwell.llm import letters
from siftwell.llm.support import arrow_batches, order_key, settle

FIT_ROWS = 40_000
FEATURES = 512
#: Least log-likelihood gain of a feature, chosen by the log loss of one half of the training rows under a fit to
#: the other half; held-out rows had no part in it.
LEAST_GAIN = 6.0
THRESHOLD = 0.7
HELD_OUT = (3, 1)
SEED = 1789
#: Rows of a feature table that a task holds before it passes them on.
OPEN_FEATURES = 2_000_000
#: Longer tokens are decoded anew each time, and letters that all paths share are set aside from this many on.
LONGEST_KEPT = 64
# fixed values: what a sign may stand for
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t",
}
SIGN_COST, DROP_COST, KEEP_COST, DOUBLE_COST, BREAK_COST = -1.0, -6.0, -12.0, -1.0, -1.0
JOINERS = "-._*~"
#: What stands between letters that are spaced out.
GAP = " "
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKALIKES]] = True
_JOINER = np.zeros(256, bool)
_JOINER[[ord(c) for c in JOINERS]] = True


# ---- letter model -------------------------------------------------------------------------------


def _count(batches):
    total = np.zeros(letters.TRIGRAMS, np.int64)
    for batch in bt.bounded(batches):
        _, tri = letters.trigrams(batch.column("text"))
        total += np.bincount(tri, minlength=letters.TRIGRAMS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["tri", "n"])


def letter_model(docs: DataFrame) -> np.ndarray:
    """Log probability of each letter class after two others; counted over all texts, smoothed.

    The number of classes bounds what reaches the driver.
    """
    arrow_batches(docs.sparkSession)
    rows = docs.select("text").mapInArrow(_count, "tri long, n long").groupBy("tri").agg(F.sum("n").alias("n")).collect()
    counts = np.full(letters.TRIGRAMS, 0.1)
    for r in rows:
        counts[r["tri"]] += r["n"]
    counts = counts.reshape(-1, letters.CLASSES)
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32).reshape(-1)


# ---- restoring ----------------------------------------------------------------------------------


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character or run of a token, the strings it may stand for and their costs."""
    return list(_ways(token))


def _ways(token: str):
    k = 0
    while k < len(token):
        end = k + 1
        while end < len(token) and token[end] == token[k]:
            end += 1
        c, run = token[k], end - k
        if c in LOOKALIKES:
            ways = [(s, SIGN_COST) for s in LOOKALIKES[c]] + [("", DROP_COST)]
            ways += [(s + s, SIGN_COST + DOUBLE_COST) for s in LOOKALIKES[c]] if run > 1 else []
        elif c.isalpha():
            ways = [(c, 0.0)] if run == 1 else [(c, DOUBLE_COST), (c + c, 0.0)] if run == 2 else [(c, 0.0), (c + c, DOUBLE_COST)]
        else:
            ways = [("", 0.0), (" ", BREAK_COST)] if c in JOINERS or c == GAP else [("", DROP_COST), (c, KEEP_COST)]
        yield ways
        k = end


def restore(token: str, model: np.ndarray) -> str:
    """The likeliest plain word behind a token."""
    k = letters.CLASSES
    states = {(0, 0): (0.0, "")}
    done = []
    for ways in _ways(token):
        after: dict = {}
        for (a, b), (score, text) in states.items():
            for added, cost in ways:
                s, x, y = score + cost, a, b
                for c in added:
                    z = _class_of(c)
                    s += float(model[(x * k + y) * k + z])
                    x, y = y, z
                if (x, y) not in after or after[x, y][0] < s:
                    after[x, y] = (s, text + added)
        states = after
        if len(next(iter(states.values()))[1]) > LONGEST_KEPT:
            shared = commonprefix([t for _, t in states.values()])
            done.append(shared)
            states = {at: (s, t[len(shared) :]) for at, (s, t) in states.items()}
    done.append(max(((s + float(model[(a * k + b) * k]), t) for (a, b), (s, t) in states.items()))[1])
    return "".join(done)


_class_of = lru_cache(maxsize=4096)(letters.letter_class)


def _suspects(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> list[tuple[int, str]]:
    """(row, token) of all tokens of white-space words that may hide a word."""
    if not len(starts):
        return []
    count = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    inside = lambda total: total[ends] - total[starts]
    n_letters, n_signs, n_joiners = (inside(count(f[low])) for f in (_LETTER, _SIGN, _JOINER))
    same = np.zeros(len(low), bool)
    same[1:] = (low[1:] == low[:-1]) & _LETTER[low[1:]] & (low[1:] < 128)
    stretched = inside(count(same)) > 0
    mixed = (n_signs > 0) & (n_letters > 0)
    dotted = (n_joiners >= 2) & (n_letters >= 3)
    out = []
    for w in np.flatnonzero(mixed | stretched | dotted):
        out.append((int(rows[w]), low[starts[w] : ends[w]].tobytes().decode("utf-8", "replace")))
    # letters spaced out: runs of words of one letter or sign, one blank apart
    single = (ends - starts == 1) & (n_letters + n_signs == 1)
    follows = np.zeros(len(starts), bool)
    follows[1:] = single[1:] & single[:-1] & (rows[1:] == rows[:-1]) & (starts[1:] == ends[:-1] + 1)
    heads = np.flatnonzero(single & ~follows)
    tails = np.flatnonzero(single & ~np.append(follows[1:], False)) + 1
    for a, b in zip(heads, tails, strict=True):
        if b - a >= 3:
            out.append((int(rows[a]), GAP.join(low[starts[a:b]].tobytes().decode())))
    return out


_EDGES = ".,;:?()[]{}\"'`<>=/\\#%&*^_-~"


def _parts(token: str) -> list[str]:
    """What stands between the signs of a token that are neither letters, look-alikes nor joiners."""
    known = "".join(c if c.isalpha() or c in LOOKALIKES or c in JOINERS or c == GAP else "\n" for c in token)
    return [part for part in known.split("\n") if part]


def _plain(token: str) -> str | None:
    """A part of a token without the punctuation around it, or None if nothing is hidden in it."""
    edges = _EDGES + GAP
    token = token.strip(edges)
    while len(token) > 1 and token[-1] in "!$|+@" and token[-2] == token[-1]:
        token = token.rstrip(token[-1]).rstrip(edges)
    token = token.rstrip("!?|+").strip(edges)
    return token if len(token) >= 3 and any(c.isalpha() for c in token) else None


class Restorer:
    """Restores tokens with a bounded memory of those seen."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model.tolist()
        self.seen = lru_cache(maxsize=200_000)(self._one)

    def _one(self, token: str) -> str | None:
        plain = [p for p in map(_plain, _parts(token)) if p is not None]
        return " ".join(restore(p, self.model) for p in plain) or None

    def restored(self, low, starts, ends, rows) -> tuple[np.ndarray, list[str]]:
        found = [(r, w) for r, t in _suspects(low, starts, ends, rows) if (w := self.seen(t) if len(t) <= LONGEST_KEPT else self._one(t))]
        return np.array([r for r, _ in found], np.int64), [w for _, w in found]


# ---- features -----------------------------------------------------------------------------------


def _word_features(low, starts, ends, rows) -> tuple[np.ndarray, np.ndarray]:
    whole = bt.word_hashes(low, starts, ends)
    out, owner = [whole], [rows]
    for size in (4, 5):
        longer = ends - starts >= size
        out.append(bt.word_hashes(low, starts[longer], starts[longer] + size) + bt.U64(size))
        owner.append(rows[longer])
    return np.concatenate(owner), np.concatenate(out)


def features(column: pa.Array, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all words and restored tokens of a batch, repeats included."""
    body, offsets = bt.utf8(column)
    owner, hashes = _word_features(*bt.words(body, offsets, bt.ALNUM_WORDS))
    rows, words = restorer.restored(*bt.words(body, offsets))
    if len(words):
        extra, ends = bt.utf8(pa.array(words, pa.string()))
        o, h = _word_features(*bt.words(extra, ends, bt.ALNUM_WORDS))
        owner, hashes = np.concatenate([owner, rows[o]]), np.concatenate([hashes, h])
    return owner, hashes


def _distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    keep = np.ones(len(owner), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[keep], hashes[keep]


def _tally(model):
    def run(batches):
        restorer = Restorer(model)
        held, size = [], 0

        def flush():
            hashes = np.concatenate([h for h, _ in held])
            toxic = np.concatenate([t for _, t in held])
            names, index = np.unique(hashes, return_inverse=True)
            bad = np.bincount(index, weights=toxic, minlength=len(names)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(bad), pa.array(np.bincount(index, minlength=len(names)) - bad)], ["feature", "bad", "fine"]
            )

        for batch in bt.bounded(batches):
            owner, hashes = _distinct(*features(batch.column("text"), restorer))
            held.append((hashes, batch.column("toxic").to_numpy(zero_copy_only=False)[owner]))
            size += len(hashes)
            if size > OPEN_FEATURES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def _select(model, chosen: np.ndarray):
    def run(batches):
        restorer = Restorer(model)
        for batch in bt.bounded(batches):
            n = batch.num_rows
            owner, at = _hits(*features(batch.column("text"), restorer), chosen)
            ends = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32)))], ["toxic", "found"]
            )

    return run


def _hits(owner: np.ndarray, hashes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, place in ``chosen``), by row; ``chosen`` is sorted."""
    if not len(chosen) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(chosen, hashes), len(chosen) - 1)
    hit = chosen[at] == hashes
    keys = np.unique(owner[hit] * len(chosen) + at[hit])
    return keys // len(chosen), keys % len(chosen)


# ---- fitting and scoring ------------------------------------------------------------------------


def held_out():
    """Whether crc32 of the id as text has the held-out remainder."""
    n, r = HELD_OUT
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == r, F.lit(False))


def _logistic(rows: list, features_: int) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton steps with a quadratic penalty, over rows of present features.

    Toxic rows count again with half of their features: no word may lean on another.
    Rows of the same features are one weighted row.
    """
    rng = np.random.default_rng(SEED)
    weight: dict = {}
    for r in sorted(rows, key=lambda r: (r["toxic"], list(r["found"]))):  # rows arrive in any order
        found, y = np.asarray(r["found"], np.int64), r["toxic"]
        kept = [found] if y < 0.5 else [found, found[rng.random(len(found)) < 0.5]]
        for k, part in enumerate(kept):
            if k == 0 or len(part):
                key = (y, part.tobytes())
                weight[key] = weight.get(key, 0) + 1
    keys = sorted(weight)
    x = np.zeros((len(keys), features_ + 1), np.float32)
    for i, (_, part) in enumerate(keys):
        x[i, np.frombuffer(part, np.int64)] = 1
    x[:, -1] = 1
    y, n = np.array([k[0] for k in keys]), np.array([weight[k] for k in keys], float)
    w = np.zeros(features_ + 1)
    penalty = np.full(features_ + 1, 0.01)
    penalty[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step, curve = x.T @ (n * (y - p)) - penalty * w, np.diag(penalty + 1e-9)
        for at in range(0, len(keys), 4096):
            part = x[at : at + 4096]
            curve = curve + (part * (n * p * (1 - p))[at : at + 4096, None]).T @ part
        move = np.linalg.solve(curve, step)
        w += np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) learned from at most ``fit_rows`` labelled rows."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(~held_out()).orderBy(order_key(SEED, "doc_id"), "doc_id").limit(fit_rows)
    marked = marked.select(F.col("doc_id").cast("long").alias("marked_id"), F.col("toxic").cast("int").alias("toxic"))
    # at most fit_rows rows of two numbers: small enough to broadcast by construction
    sample = docs.select("doc_id", "text").join(F.broadcast(marked), F.col("doc_id") == F.col("marked_id"))
    # a doc_id that repeats teaches once, by the first of its texts: the bound holds for rows, too
    sample = sample.groupBy("marked_id").agg(F.min("text").alias("text"), F.max("toxic").cast("double").alias("toxic"))
    sample = settle(sample.select("text", "toxic"))
    totals = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0.0)).alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, fine = float(totals["bad"]), float(totals["n"] - totals["bad"])
    if not bad or not fine:
        return np.zeros(0, np.uint64), np.zeros(0), -40.0 if not bad else 40.0
    table = sample.mapInArrow(_tally(model), "feature long, bad long, fine long").groupBy("feature")
    table = table.agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine")).where(F.col("bad") >= 3)
    term = lambda seen, of, other: seen * F.log((seen + 0.5) / of / ((seen + other + 1.0) / (bad + fine)))
    gain = term(F.col("bad"), bad, F.col("fine")) + term(F.col("fine"), fine, F.col("bad"))
    table = table.where((F.col("bad") / bad > F.col("fine") / fine) & (gain >= LEAST_GAIN))
    best = table.orderBy(gain.desc(), "feature").limit(FEATURES).select("feature").collect()
    chosen = np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))
    rows = sample.mapInArrow(_select(model, chosen), "toxic double, found array<int>").collect()
    weights, bias = _logistic(rows, len(chosen))
    return chosen, weights, bias


def _scorer(model, chosen, weights, bias):
    def run(batches):
        restorer = Restorer(model)
        for batch in bt.bounded(batches):
            owner, at = _hits(*features(batch.column("text"), restorer), chosen)
            total = bias + np.bincount(owner, weights=weights[at], minlength=batch.num_rows) if len(at) else np.full(batch.num_rows, bias)
            score = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "score"])

    return run


def scored(rows: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows``, which have ``text`` and no column score, with ``score``; learned from docs and labels."""
    model = letter_model(docs)
    learned = fit(docs, labels, model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_scorer(model, *learned), f"{schema}, score double")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    own = docs.select("doc_id", "text")
    return scored(own, own, labels).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not predicted toxic, with the columns of ``docs``."""
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], F.col("text"))
    kept = scored(rows, docs.select("doc_id", "text"), labels).where(F.col("score") < THRESHOLD)
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
