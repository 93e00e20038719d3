"""Text operators on what lies across the pieces that they cut texts into."""

import random
import re

import numpy as np
import pyarrow as pa
from conftest import DATA
from pyspark.sql import functions as F

from siftwell.llm import catalog, langid, letters, licenses, toxicity
from siftwell.session import read_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in texts], DOCS)


BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"


def test_wrapped_notice_is_labelled(spark, tmp_path):
    texts = [(1, BSD), (2, "filler\n" * 77 + BSD), (3, "Licensed under\nthe Apache\nLicense,\nVersion 2.0"), (4, BSD[:40]), (5, None)]
    _docs(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["labels"] for r in catalog.QUERIES["op4_licenses"](spark, str(tmp_path)).collect()}
    assert got == {1: "bsd", 2: "bsd", 3: "apache,apache-2.0", 4: "", 5: ""}


def _met(text):
    """Labels of blocks of word pairs over all words; overlapping blocks of a family give the best ones."""
    words, met = re.findall("[a-z0-9]+", text.lower()), []
    for t, label in licenses.TEMPLATES.items():
        own, half = licenses.words_of(t), licenses.stride(t)
        pairs = {tuple(own[k : k + 2]) for k in range(len(own) - 1)}
        for at in range(0, max(len(words), 1), half):
            held = pairs & {tuple(words[k : k + 2]) for k in range(at, min(at + 2 * half, len(words) - 1))}
            if len(held) / len(pairs) >= 0.8:
                met.append((at, at + 2 * half, len(held) / len(pairs), label))
    same = lambda x, y: x.split("-")[0] == y.split("-")[0]
    return {v for a, b, share, v in met if not any(d > a and c < b and s > share and same(v, o) for c, d, s, o in met)}


def test_wrapped_texts_equal_brute_force(spark):
    rng = random.Random(16)
    parts = [w for t in licenses.TEMPLATES for w in licenses.words_of(t)] + ["\n", "\n", "filler"]
    notice = lambda: licenses.words_of(rng.choice(list(licenses.TEMPLATES)))
    texts = []
    for k in range(120):
        words = rng.choices(parts, k=rng.randint(0, 40)) + notice() + rng.choices(parts, k=rng.randint(0, 90))
        words.insert(rng.randrange(len(words)), "\n")
        texts.append((k, " ".join(words)))
    rows = licenses.scan(_docs(spark, texts)).withColumn("own", F.array_except(F.split("labels", ","), F.split("base_labels", ","))).collect()
    assert {r["doc_id"]: set(r["own"]) - {""} for r in rows} == {i: _met(t) for i, t in texts}


FINE = ["good", "house", "river", "stone", "loss", "ideal", "food", "total", "you", "such", "a"]


def _toxic_scores(spark, hidden):
    """Predictions of clean texts that hold each of ``hidden``, learned from plain words."""
    rng = random.Random(8)
    fine = lambda: " ".join(rng.choices(FINE[:7], k=12) + ["such a house", "you total"])
    rows = [(i, fine() + (" loser idiot " if i % 4 == 0 else " ") + fine()) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    rows += [(1000 + k, f"{fine()} {h} {fine()}") for k, h in enumerate(hidden)]
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(_docs(spark, rows), labels).collect()}
    return [got[1000 + k] for k in range(len(hidden))]


def test_long_and_doubled_words_are_found(spark):
    hidden = ["i" * 90 + "diot " + "l" * 90 + "oser", "iiddiioott lloosseerr", "l0s3r1d10t" * 8 + " l" + "o" * 300 + "ser", "good house"]
    assert _toxic_scores(spark, hidden) == [1, 1, 1, 0]


def test_long_tokens_are_restored_exactly():
    model = np.log(np.random.default_rng(3).dirichlet(np.ones(letters.CLASSES), letters.CLASSES**2)).astype(np.float32).reshape(-1)

    def whole(token):
        k, states = letters.CLASSES, {(0, 0): (0.0, "")}
        for ways in toxicity.lattice(token):
            after = {}
            for (a, b), (score, text) in states.items():
                for added, cost in ways:
                    s, x, y = score + cost, a, b
                    for c in added:
                        s, x, y = s + float(model[(x * k + y) * k + letters.letter_class(c)]), y, letters.letter_class(c)
                    if (x, y) not in after or after[x, y][0] < s:
                        after[x, y] = (s, text + added)
            states = after
        return max((s + float(model[(a * k + b) * k]), t) for (a, b), (s, t) in states.items())[1]

    rng = random.Random(4)
    for n in (5, 70, 900):
        token = "".join(rng.choices("abcdeello10-.$!", k=n))
        assert toxicity.restore(token, model) == whole(token)


def test_words_within_restored_tokens_are_found(spark):
    hidden = ["such a l o s e r  y o u i d i o t", "total-1d10t total_l0s3r", "1d10t,l0s3r", "1d10t's l0s3r's", "y o u g o o d h o u s e"]
    assert _toxic_scores(spark, hidden) == [1, 1, 1, 1, 0]


def test_gaps_and_joiners_may_end_words():
    counts = np.full(letters.TRIGRAMS, 0.1)
    _, tri = letters.trigrams(pa.array(["such a loser you idiot total idiot you loser a total"]))
    np.add.at(counts, tri, 50)
    counts = counts.reshape(-1, letters.CLASSES)
    model = np.log(counts / counts.sum(axis=1, keepdims=True)).reshape(-1)
    restorer = toxicity.Restorer(model)
    want = {"a l o s e r": "a loser", "y o u i d i o t": "you idiot", "total-1d10t": "total idiot", "1d10t,l0s3r": "idiot loser", "1d10t's": "idiot", "l.o.s.e.r": "loser"}
    assert {t: restorer.seen(t) for t in want} == want


def test_unlearned_scripts_go_and_learned_texts_stay(spark):
    docs = read_table(spark, DATA.replace("sf0.001", "sf0.01"), "documents").where("text rlike '[A-Za-z]' AND lang IS NOT NULL")
    rng = random.Random(2)
    scripts = ["αβγδεζηθικλμνξοπ", "абвгдежзиклмнопр", "אבגדהוזחטיכלמנס", "あいうえおかきくけこさしすせそ"]
    foreign = [(-1 - k, "".join(rng.choices(scripts[k % 4] + "  ", k=300))) for k in range(200)]
    kept = langid.keep_known(docs.unionByName(_docs(spark, foreign).select(docs.columns)))
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sum(i < 0 for i in ids) <= 2
    assert sum(i >= 0 for i in ids) == docs.count()
