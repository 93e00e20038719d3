"""Language identification by hyperdimensional profiles.

Every letter class has a random vector of ``DIM`` signs. A trigram binds its letters: the elementwise
product of the first rotated twice, the second rotated once and the third. A text bundles, that is sums,
the vectors of all its trigrams; a language's prototype bundles all its training texts. A text gets the
language whose prototype has the largest cosine with its own vector.

Bundling is linear, so training only counts trigrams per language inside each task and bundles the counts;
all sums are whole numbers and the result does not depend on the partitioning.

Edge cases: a null text and a text without letters get ``und`` and score 0; rows with a null language are
predicted but not learned from; a null doc_id is neither held out nor learned from; without any training
row everything is ``und``; ties (cosines within 1e-6) go to the first language by name; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm import bytetext as bt
from siftwell.llm import letters
from siftwell.llm.support import arrow_batches

DIM = 1024
SEED = 4711
UNKNOWN = "und"
HELD_OUT = (4, 2)
#: Cosines that differ by less than single precision tells are ties.
TIE = 1e-6
#: Languages that the table may teach: their prototypes are held by the driver and by every worker.
MOST_LANGUAGES = 4096
#: Languages a task counts at once before it passes its counts on.
OPEN_LANGUAGES = 64


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    signs = np.random.default_rng(SEED).integers(0, 2, (letters.CLASSES, DIM)).astype(np.int8) * 2 - 1
    return np.roll(signs, 2, axis=1), np.roll(signs, 1, axis=1), signs


def trigram_vectors(tri: np.ndarray) -> np.ndarray:
    """(len(tri), DIM) float32 signs."""
    a, b, c = _letters()
    k = letters.CLASSES
    return (a[tri // (k * k)] * b[tri // k % k] * c[tri % k]).astype(np.float32)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text has the held-out remainder."""
    n, r = HELD_OUT
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % n == r, F.lit(False))


def _bundle(counts: dict) -> pa.RecordBatch:
    names, places, values = [], [], []
    for name, count in counts.items():
        used = np.flatnonzero(count)
        total = np.zeros(DIM)
        for at in range(0, len(used), 8192):
            part = used[at : at + 8192]
            # doubles: whole numbers stay exact
            total += count[part].astype(np.float64) @ trigram_vectors(part).astype(np.float64)
        names += [name] * DIM
        places.append(np.arange(DIM, dtype=np.int32))
        values.append(total)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(np.concatenate(places)), pa.array(np.concatenate(values))], ["lang", "place", "value"]
    )


def _learn(batches):
    counts: dict = {}
    for batch in bt.bounded(batches):
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        owner, tri = letters.trigrams(batch.column("text"))
        for name in sorted(set(langs)):
            rows = np.flatnonzero(langs == name)
            use = np.isin(owner, rows)
            got = np.bincount(tri[use], minlength=letters.TRIGRAMS)
            counts[name] = counts[name] + got if name in counts else got
        if len(counts) > OPEN_LANGUAGES:
            yield _bundle(counts)
            counts = {}
    if counts:
        yield _bundle(counts)


def prototypes(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages by name and their unit prototypes; DIM numbers a language reach the driver.

    A table with more than ``MOST_LANGUAGES`` values of lang is refused: such a column does not hold languages.
    """
    arrow_batches(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("lang", "text")
    if rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} values")
    sums = rows.mapInArrow(_learn, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    got = sums.collect()
    names = sorted({r["lang"] for r in got})
    index = {name: k for k, name in enumerate(names)}
    vectors = np.zeros((len(names), DIM))
    for r in got:
        vectors[index[r["lang"]], r["place"]] = r["value"]
    norms = np.linalg.norm(vectors, axis=1)
    keep = norms > 0
    return [n for n, k in zip(names, keep, strict=True) if k], (vectors[keep] / norms[keep, None]).astype(np.float32)


def cosines(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """(rows, languages) cosines; rows without letters are 0."""
    n = len(column)
    row, tri, count = letters.counted(*letters.trigrams(column))
    out = np.zeros((n, len(vectors)))
    if not len(tri):
        return out
    used, code = np.unique(tri, return_inverse=True)
    bundle = np.zeros((n, DIM), np.float32)
    for at in range(0, len(used), 8192):
        part = (code >= at) & (code < at + 8192)
        dense = np.zeros((n, min(8192, len(used) - at)), np.float32)
        dense[row[part], code[part] - at] = count[part]
        bundle += dense @ trigram_vectors(used[at : at + 8192])
    norms = np.linalg.norm(bundle, axis=1, keepdims=True)
    return np.divide(bundle @ vectors.T, norms, out=out, where=norms > 0)


def _predictor(names: list[str], vectors: np.ndarray):
    choice = np.array([*names, UNKNOWN], dtype=object)

    def run(batches):
        for batch in bt.bounded(batches):
            n = batch.num_rows
            best, score = np.full(n, len(names)), np.zeros(n)
            if names and n:
                found = cosines(batch.column("text"), vectors)
                told = np.abs(found).sum(axis=1) > 0
                best[told] = (found[told] >= found[told].max(axis=1, keepdims=True) - TIE).argmax(axis=1)
                score[told] = np.clip(found[told].max(axis=1), 0, 1)
            rest = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(choice[best], pa.string()), pa.array(score)], [*batch.schema.names, "lang_pred", "score"]
            )

    return run


def predict(rows: DataFrame, names: list[str], vectors: np.ndarray) -> DataFrame:
    """``rows``, which have ``text`` and no column lang_pred or score, with both."""
    arrow_batches(rows.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_predictor(names, vectors), f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``."""
    model = prototypes(docs)
    return predict(docs.select("doc_id", "text"), *model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


#: A text whose best cosine lies below this resembles no learned language: three deviations of unrelated bundles.
LEAST_COSINE = 3 / DIM**0.5


def keep_known(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` in a learned language, with the columns of ``docs``; ``und`` and unlike texts go."""
    model = prototypes(docs)
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], F.col("text"))
    kept = predict(rows, *model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_COSINE))
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
