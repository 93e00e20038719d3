"""The pipeline as a whole: no model runs twice on a row, stages equal plain versions, odd tables pass through."""

import zlib

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline
from siftwell.llm import langid, letters, mixing, toxicity
from siftwell.session import read_table


def _counting(real, seen):
    def make(*args):
        run = real(*args)

        def counted(batches):
            def told():
                for batch in batches:
                    seen.add(batch.num_rows)
                    yield batch

            yield from run(told())

        return counted

    return make


def test_every_model_scores_a_row_once(spark, monkeypatch):
    seen = {m: spark.sparkContext.accumulator(0) for m in (langid, toxicity)}
    monkeypatch.setattr(langid, "_predictor", _counting(langid._predictor, seen[langid]))
    monkeypatch.setattr(toxicity, "_scorer", _counting(toxicity._scorer, seen[toxicity]))
    out = corpus_pipeline.run(spark, DATA)
    docs = read_table(spark, DATA, "documents")
    assert out.where(~F.col("round_trip")).count() == 0 and out.count() > 0
    assert seen[langid].value == docs.count()
    assert seen[toxicity].value == langid.keep_known(docs).count()


def _bundle(text, signs):
    a, b, c = signs
    seq = [0]
    for ch in (text or "") + " ":
        z = letters.letter_class(ch)
        seq += [z] if z or seq[-1] else []
    seq = np.array(seq)
    out = np.zeros(langid.DIM)
    for at in range(0, max(len(seq) - 2, 0), 4096):
        p, q, r = (seq[at + k : min(at + k + 4096, len(seq) - 2 + k)] for k in range(3))
        out += (a[p].astype(int) * b[q] * c[r]).sum(axis=0)
    return out


def test_language_stage_equals_plain_bundles(spark):
    docs = read_table(spark, DATA, "documents")
    rows = docs.select("doc_id", "text", "lang").collect()
    signs = langid._letters()
    bundles = [_bundle(r["text"], signs) for r in rows]
    learned = {}
    for r, v in zip(rows, bundles, strict=True):
        if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            learned[r["lang"]] = learned.get(r["lang"], 0) + v
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    best = [max(float(unit(v) @ unit(p)) for p in learned.values()) if v.any() else 0.0 for v in bundles]
    assert min(abs(x - langid.LEAST_COSINE) for x in best) > 1e-5
    want = sorted(r["doc_id"] for r, x in zip(rows, best, strict=True) if x >= langid.LEAST_COSINE)
    assert sorted(r["doc_id"] for r in corpus_pipeline.known_languages(spark, docs, DATA).collect()) == want


def test_toxicity_stage_equals_the_scores(spark):
    docs, labels = read_table(spark, DATA, "documents"), read_table(spark, DATA, "labels")
    want = sorted(r["doc_id"] for r in toxicity.score(docs, labels).where("score < 0.7").collect())
    assert sorted(r["doc_id"] for r in corpus_pipeline.clean_texts(spark, docs, DATA).collect()) == want


def test_mixture_stage_repeats_what_the_operator_takes(spark):
    docs = read_table(spark, DATA, "documents")
    taken = {r["doc_id"]: r["repeats"] for r in mixing.mixed_sizes(docs).collect() if r["repeats"]}
    got = corpus_pipeline.mixed_sources(spark, docs, DATA).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == taken


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=[name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_clashing_columns(spark, stage):
    name, run = stage
    docs = read_table(spark, DATA, "documents")
    clash = ["score", "lang_pred", "held_out", "kept_id", "component_id", "key", "row", "copy", "cut", "whole", "c0", "size", "a.b"]
    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", "en", None, 0)], docs.schema)
    wide = docs.unionByName(odd).withColumns({c: F.lit(k) for k, c in enumerate(clash)}).withColumn("told", F.create_map(F.lit("k"), F.lit(1)))
    out = run(spark, wide, DATA)
    assert out.columns == wide.columns and out.count() > 0
    assert {tuple(r) for r in out.select(*[F.col(f"`{c}`") for c in clash]).distinct().collect()} == {tuple(range(len(clash)))}
    none = run(spark, wide.limit(0), DATA)
    assert none.columns == wide.columns and none.count() == 0
