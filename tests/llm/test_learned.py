"""Near-duplicates, vectors, pieces, licenses, toxicity, languages and the pipeline against brute force."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline
from siftwell.llm import bytetext, capfilters, components, langid, letters, licenses, minhash, pieces, toxicity
from siftwell.session import read_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, texts, extra=True):
    rows = [(i, t, None, "s", None) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({"n": F.lit(1), "rep": F.lit("x"), "regs": F.lit(2), "key": F.lit(3), "score": F.lit(0.5), "lang_pred": F.lit("q")}) if extra else df


def _sets(texts):
    out = {}
    for i, t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def _components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def _near_texts(seed, groups=12, size=12):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([3, 6, 40, 120]))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append((len(out), rng.choice([" ", "\t", " \n "]).join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
    return [*out, (900, None), (901, ""), (902, " \n"), (903, "é"), (904, "É"), (905, "x" * 9000)]


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_equal_brute_force(spark, seed):
    texts = _near_texts(seed)
    sets = _sets(texts)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(_docs(spark, texts)).collect()}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and 100 * len(x & y) >= 85 * len(x | y)

    want = _components([i for i, _ in texts], linked)
    for i, _ in texts:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), want[i], want[i] == i)
    kept = minhash.deduplicate(_docs(spark, texts), 85)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in want if want[i] == i)


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    texts = _near_texts(7, groups=2, size=30)
    want = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(_docs(spark, texts)).collect()}
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "MEMBER_BLOCK", 5)
    assert want == {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(_docs(spark, texts)).collect()}


def test_near_duplicates_of_odd_tables(spark):
    assert minhash.near_duplicates(_docs(spark, [])).count() == 0 and minhash.deduplicate(_docs(spark, [])).count() == 0
    got = minhash.near_duplicates(_docs(spark, [(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "a b c")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [(-1, -1, False), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert minhash.deduplicate(_docs(spark, [(1, "a"), (1, "a"), (None, "a"), (2, None)])).count() == 3


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 2**56, k).astype(np.uint64) for k in (900, 60, 40))
    column = [np.unique(np.concatenate(x)) for x in ((common, a), (common, b), (common, a, b))]
    keys, bounds = np.concatenate(column), np.concatenate([[0], np.cumsum([len(c) for c in column])])
    regs = minhash.registers(keys, bounds)
    assert (np.maximum(regs[0], regs[1]) == regs[2]).all()
    n = np.diff(bounds).astype(float)
    found = minhash.estimate(regs[:1], regs[1:2], n[:1], n[1:2])[0]
    assert abs(found - 0.9) < 0.12 and minhash.plausible(regs[:1], regs[1:2], n[:1], n[1:2])[0]


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(40)] + [(200, 200 + k) for k in range(1, 30)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    ids = sorted({x for e in edges for x in e})
    known = set(edges) | {(b, a) for a, b in edges}
    want = _components(ids, lambda a, b: (a, b) in known)
    assert got == {i: want[i] for i in ids if any(i in e and e[0] != e[1] for e in edges)}
    assert components.components(df.limit(0)).count() == 0


def test_words_and_hashes():
    texts = ["A b\x0bC", None, "", "  x" * 3, "é É ß", "long" * 3000]
    low, starts, ends, rows = bytetext.words(*bytetext.utf8(pa.array(texts, pa.string())))
    got = [(int(r), low[a:b].tobytes().decode()) for a, b, r in zip(starts, ends, rows, strict=True)]
    assert got == [(0, "a"), (0, "b"), (0, "c"), (3, "x"), (3, "x"), (3, "x"), (4, "é"), (4, "É"), (4, "ß"), (5, "long" * 3000)]
    h = bytetext.word_hashes(low, starts, ends)
    assert h[3] == h[4] and len(set(h.tolist())) == 8


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"rep": F.lit(1), "dim": F.lit(2), "filter": F.lit("x")})


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 24))
    x = np.concatenate([c + 0.25 * rng.normal(size=(12, 24)) for c in x] + [np.repeat(x[:1], 30, axis=0) * 3]).astype(np.float32)
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [1.0] * 3, [2.0] * 3, [float("inf")] + [1.0] * 23]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(1000 + k, v) for k, v in enumerate(odd)]
    got = {r["vec_id"]: r for r in capfilters.near_vectors(_vectors(spark, rows)).collect()}
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    want = _components(range(len(x)), lambda a, b: near[a, b])
    missed = sum(got[i]["n_links"] != near[i].sum() for i in range(len(x)))
    assert missed <= 0.01 * len(x) and all(got[i]["n_links"] <= near[i].sum() for i in range(len(x)))
    assert sum(got[i]["component_id"] != want[i] for i in want) <= 0.01 * len(x)
    assert [got[1000 + k]["n_links"] for k in range(len(odd))] == [0, 0, 0, 0, 0, 1, 1, 0]
    assert got[1006]["component_id"] == 1005 and not got[1006]["kept"] and got[1000]["kept"]


def test_vector_blocks_count_every_link_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = (rng.normal(size=16) + 0.05 * rng.normal(size=(60, 16))).astype(np.float32)
    monkeypatch.setattr(capfilters, "BLOCK", 7)
    got = capfilters.near_vectors(_vectors(spark, [(i, [float(v) for v in r]) for i, r in enumerate(x)])).collect()
    assert {r["n_links"] for r in got} == {59} and {r["component_id"] for r in got} == {0}
    assert capfilters.near_vectors(_vectors(spark, [])).count() == 0


@pytest.mark.parametrize("least", [3, 16, 80])
def test_list_decoding_is_complete(least):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation, parts = capfilters.code(10, 5)
    pieces_ = np.array_split(np.arange(10), 4)
    y = x @ rotation
    for i in range(30):
        scores = sum(np.meshgrid(*[p @ y[i, c] for c, p in zip(pieces_, parts, strict=True)], indexing="ij")).reshape(-1)
        want = set(np.flatnonzero(scores >= min(capfilters.threshold(10, 5, least), np.sort(scores)[-least]) - 1e-12))
        rows, ids = capfilters.decode(x[i : i + 1], 5, least)
        assert set(ids.tolist()) == want and set(rows.tolist()) == {0}


@pytest.mark.parametrize(("dim", "k"), [(2, 8), (16, 4), (16, 18), (16, 40), (16, 64), (64, 18), (64, 40), (64, 64), (128, 4), (128, 40)])
def test_recall_follows_the_code(dim, k):
    """Fresh pairs at the link's cosine share a filter, whatever the dimension and the size of the code."""
    assert capfilters.shared_share(dim, k, capfilters.list_size(dim, k), capfilters.COSINE, 1000, 2) >= 0.99


def test_signs_keep_linked_pairs():
    for dim in (2, 16, 128):
        a, b = capfilters.pairs_at(capfilters.COSINE, dim, 4000, 3)
        differ = ((a @ capfilters.planes(dim) > 0) != (b @ capfilters.planes(dim) > 0)).sum(axis=1)
        assert differ.max() <= capfilters.MOST_BITS
    assert [capfilters.code_size(n) for n in (0, 1, 10**6, 10**9, 10**12)] == [4, 4, 14, 76, 423]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(pieces.load())


def _best(v, text):
    """Full Viterbi without windows."""
    best = [(0.0, [])]
    for end in range(1, len(text) + 1):
        raw = text[end - 1].encode()
        ways = [(best[end - 1][0] + pieces.BYTE_COST * len(raw), best[end - 1][1] + [v.bytes[b] for b in raw])]
        for start in range(max(0, end - v.longest), end):
            if hit := v.ids.get(text[start:end]):
                ways.append((best[start][0] + hit[1], best[start][1] + [hit[0]]))
        best.append(max(ways, key=lambda w: w[0]))
    return best[-1][0]


def test_streamed_search_is_optimal_and_exact(vocabulary):
    rng = random.Random(5)
    letters_ = "abcdeth on réß你\n\t ▁😀\u0000"
    cost = {i: s for i, s in vocabulary.ids.values()} | {b: pieces.BYTE_COST for b in vocabulary.bytes}
    for n in [0, 1, 2, 5, 30, 200, 700]:
        text = "".join(rng.choices(letters_, k=n))
        ids = vocabulary.encode(text)
        assert vocabulary.decode(ids) == text
        whole = [i for run in vocabulary.search(" " + text) for i in run] if text else []
        assert abs(sum(cost[i] for i in whole) - sum(cost[i] for i in ids)) < 1e-6
        assert not text or abs(sum(cost[i] for i in ids) - _best(vocabulary, " " + text)) < 1e-6


def test_pieces_table(spark):
    texts = [(1, None), (2, ""), (3, "▁ a  b"), (3, "▁ a  b"), (None, "x" * 50_000), (4, "Hello world")]
    got = pieces.encode(_docs(spark, texts)).collect()
    assert all(r["round_trip"] for r in got) and len(got) == 6
    assert [r["n_chars"] for r in got if r["doc_id"] == 1] == [0] and pieces.digests(_docs(spark, [])).count() == 0


def test_window_stays_small(vocabulary):
    vocabulary.widest = 0
    for text in ("ab" * 20_000, "internationalisation" * 2_000, "é😀" * 5_000):
        runs = list(vocabulary.search(" " + text))
        assert vocabulary.decode([i for run in runs for i in run]) == text
        assert len(runs) > len(text) // (4 * pieces.COMMIT_EVERY)
    assert vocabulary.widest <= 2 * (pieces.COMMIT_EVERY + vocabulary.longest)
    # paths at odd and at even places never meet: the window has to grow, and the time stays in proportion
    runs = list(vocabulary.search("x" * 300_000))
    assert vocabulary.decode([i for run in runs for i in run]) == "x" * 299_999


def test_vocabularies_are_told_apart():
    one = [("<unk>", 0.0), ("a", -1.0), ("b", -2.0), ("\u2581", -3.0), ("c", -9.0)] + [(f"<0x{k:02X}>", -9.0) for k in range(256)]
    other = [one[0], one[2], one[1], *one[3:]]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["ab"])], ["doc_id", "text"])
    ids = [next(pieces._encoder(v)([batch])).column("ids").to_pylist()[0] for v in (one, other, one)]
    assert ids == [[3, 1, 2], [3, 2, 1], [3, 1, 2]]


def test_ids_equal_full_search(vocabulary):
    """Ids, not just costs: an unwindowed search of tests/ breaks ties in the same way."""
    def full(text):
        best = [(0.0, 0, 0)] + [(-1e300, 0, 0)] * len(text)
        for start in range(len(text)):
            for end in range(start + 1, min(len(text), start + vocabulary.longest) + 1):
                hit = vocabulary.ids.get(text[start:end])
                if hit and best[start][0] + hit[1] > best[end][0]:
                    best[end] = (best[start][0] + hit[1], start, hit[0])
            raw = text[start].encode()
            if text[start] not in vocabulary.ids and best[start][0] + pieces.BYTE_COST * len(raw) > best[start + 1][0]:
                best[start + 1] = (best[start][0] + pieces.BYTE_COST * len(raw), start, -1)
        ids, at = [], len(text)
        while at:
            _, start, piece = best[at]
            ids = ([piece] if piece >= 0 else [vocabulary.bytes[b] for b in text[start:at].encode()]) + ids
            at = start
        return ids

    rng = random.Random(11)
    for n in (1, 40, 65, 300, 900):
        text = "".join(rng.choices("abcdeth on\n.,réß你😀", k=n)) + "".join(rng.choices("aeinst", k=n))
        assert list(vocabulary.encode(text)) == full(" " + text)


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def _notices(words):
    """(label, share) of blocks of word pairs, without those that a better one of the family overlaps."""
    met = []
    for template, label in licenses.TEMPLATES.items():
        t = licenses.words_of(template)
        pairs, half = set(zip(t, t[1:])), licenses.stride(template)  # noqa: B905
        for at in range(0, max(len(words), 1), half):
            # pairs that begin in the block
            block = set(zip(words[at : at + 2 * half], words[at + 1 : at + 2 * half + 1]))  # noqa: B905
            if 5 * len(block & pairs) >= 4 * len(pairs):
                met.append((label, at, at + 2 * half, len(block & pairs) / len(pairs)))
    rival = lambda x, y: x[0].split("-")[0] == y[0].split("-")[0] and y[2] > x[1] and y[1] < x[2] and y[3] > x[3]
    return {x[0] for x in met if not any(rival(x, y) for y in met)}, max((x[3] for x in met), default=0.0)


def _scan(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits = [(k, PHRASES[p]) for p in PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    base = {label for _, label in hits}
    labels, best = _notices(w)
    return len(w), len(hits), min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if hits else best


def test_licenses_equal_brute_force(spark):
    rng = random.Random(6)
    bits = ["the", "License", "MIT", "mit-license", "Apache", "GNU General Public License", "cc", "BY", "NC", "4.0", "\n", "licensed under", "é", "version 2", "filler", ",", "permission is hereby granted free of charge", "released", "work is"]
    texts = [(k, rng.choice([" ", "  ", "-"]).join(rng.choices(bits, k=rng.randint(0, 200)))) for k in range(150)]
    long = [t for t in licenses.TEMPLATES if len(t) > 200]
    for k in range(60):
        notice = rng.choice(long).split()
        for _ in range(rng.choice([0, 1, 3, 8])):
            notice[rng.randrange(len(notice))] = rng.choice(["x", "the", "license"])
        texts.append((200 + k, "\n".join(rng.choices(bits, k=rng.randint(0, 90)) + notice + rng.choices(bits, k=5))))
    texts += [(900, None), (901, ""), (902, "cc\nby"), (903, "x " * 500 + "Licensed under CC BY-NC 4.0."), (903, "mit license")]
    got = licenses.scan(_docs(spark, texts)).collect()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = sorted([(i, *_scan(t)) for i, t in texts], key=str)
    assert sorted([(r["doc_id"], *[r[c] for c in names]) for r in got], key=str) == want
    assert licenses.scan(_docs(spark, [])).count() == 0


def test_notices_exclude_each_other(spark):
    told = {
        "Licensed under CC BY 4.0": "cc-by,cc-by-4.0",
        "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa-4.0",
        "licensed under cc by-nc 4.0": "cc-by,cc-by-nc-4.0",
        "We licensed photos under 4 CC editors by 0 rules": "",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted": "bsd",
        "Licensed under CC BY 4.0. " + "word " * 40 + "Licensed under CC BY-SA 4.0": "cc-by,cc-by-4.0,cc-by-sa-4.0",
    }
    long = {t: v for t, v in licenses.TEMPLATES.items() if len(t) > 200}
    told |= {t.replace(" ", "\n"): v for t, v in long.items()}
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(_docs(spark, list(enumerate(told)))).collect()}
    for k, (text, want) in enumerate(told.items()):
        assert (want in got[k].split(",")) if k >= 6 else got[k] == want, (text, got[k])
        if want == "gpl-2.0":
            assert "gpl-3.0" not in got[k]


def test_letter_trigrams():
    row, tri = letters.trigrams(pa.array(["Ab  c", None, "...", "é"]))
    k = letters.CLASSES
    told = [(int(r), int(t) // k**2, int(t) // k % k, int(t) % k) for r, t in zip(row, tri, strict=True)]
    e = letters.letter_class("é")
    assert told == [(0, 0, 1, 2), (0, 1, 2, 0), (0, 2, 0, 3), (0, 0, 3, 0), (3, 0, e, 0)]


def test_cosines_equal_bundles():
    texts = ["the cat", "le chat", None]
    protos = np.random.default_rng(0).normal(size=(3, langid.DIM)).astype(np.float32)
    protos /= np.linalg.norm(protos, axis=1, keepdims=True)
    got = langid.cosines(pa.array(texts, pa.string()), protos)
    a, b, c = (x.astype(int) for x in langid._letters())
    for i, t in enumerate(texts[:2]):
        seq = [0, *[letters.letter_class(x) for x in t], 0]
        v = sum(a[seq[k]] * b[seq[k + 1]] * c[seq[k + 2]] for k in range(len(seq) - 2))
        assert np.allclose(got[i], protos @ v / np.linalg.norm(v), atol=1e-5)
    assert (got[2] == 0).all()


def test_languages_held_out(spark):
    docs = read_table(spark, DATA.replace("sf0.001", "sf0.01"), "documents")
    got = langid.identify(docs).join(docs.select(F.col("doc_id").alias("d"), "lang"), F.col("doc_id") == F.col("d")).where("held_out").collect()
    assert len(got) > 100 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1


def test_languages_of_odd_tables(spark):
    none = langid.identify(_docs(spark, [(1, None), (2, "..."), (3, "abc")])).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and langid.identify(_docs(spark, [])).count() == 0
    df = spark.createDataFrame([(i, t, g, "s", 1) for i, t, g in [(0, "the then", "en"), (1, "die der", "de"), (5, None, "en"), (None, "x", "en"), (7, "!", None)]], DOCS)
    assert {r["doc_id"]: r["lang_pred"] for r in langid.identify(df).collect() if r["doc_id"] in (5, 7)} == {5: "und", 7: "und"}


def test_language_ties_and_dirty_columns(spark, monkeypatch):
    rows = [(i, "the same words in two tables", g) for i, g in [(0, "b"), (1, "a"), (4, "c")]] + [(9, "the same words", None)]
    df = spark.createDataFrame([(i, t, g, "s", 1) for i, t, g in rows], DOCS)
    learned = [i for i, _, g in rows if g and zlib.crc32(str(i).encode()) % 4 != 2]
    assert len(learned) > 1
    first = min(g for i, _, g in rows if i in learned)
    assert {r["lang_pred"] for r in langid.identify(df).collect()} == {first}
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 1)
    with pytest.raises(ValueError, match="more than 1 values"):
        langid.identify(df)


def test_languages_equal_brute_force(spark):
    """Predictions and scores from bundles summed trigram by trigram in plain whole numbers."""
    rng = random.Random(13)
    words = {"x": ["alpha", "beta", "gamma"], "y": ["uno", "due", "tre"], "z": ["ein", "zwei", "drei"]}
    rows = [(i, rng.choice([None, "", "12"] + [" ".join(rng.choices(words[g], k=9))] * 7), rng.choice([g, g, None])) for i, g in enumerate(rng.choices("xyz", k=80))]
    rows += [(200, "alpha " * 3000 + "zwei", None)]
    a, b, c = (x.astype(int) for x in langid._letters())

    def bundle(text):
        seq = [0]
        for ch in (text or "") + " ":
            z = letters.letter_class(ch)
            seq += [z] if z or seq[-1] else []
        return sum((a[p] * b[q] * c[r] for p, q, r in zip(seq, seq[1:], seq[2:], strict=False)), np.zeros(langid.DIM, int))

    proto = {}
    for i, t, g in rows:
        if g and zlib.crc32(str(i).encode()) % 4 != 2:
            proto[g] = proto.get(g, 0) + bundle(t)
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame([(i, t, g, "s", 1) for i, t, g in rows], DOCS).repartition(3)).collect()}
    for i, t, _ in rows:
        v = bundle(t)
        if not any(letters.letter_class(ch) for ch in t or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0)
            continue
        cosine = {g: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for g, p in proto.items()}
        best = max(sorted(cosine), key=cosine.get)
        assert got[i]["lang_pred"] == best and abs(got[i]["score"] - min(max(cosine[best], 0), 1)) < 1e-4


def test_a_repeated_id_teaches_once(spark):
    rows = [(7, "loser " * 3)] * 500 + [(i, "idiot house" if i % 3 == 0 else "good house") for i in range(100, 200)]
    df = spark.createDataFrame([(i, t, None, "s", 1) for i, t in rows], DOCS)
    labels = spark.createDataFrame([(7, 1)] + [(i, int(i % 3 == 0)) for i in range(100, 200)], "doc_id long, toxic int")
    model = toxicity.letter_model(df)
    seen = []
    real = toxicity._logistic
    toxicity._logistic = lambda rows, n: seen.append(len(rows)) or real(rows, n)
    try:
        toxicity.fit(df, labels, model, fit_rows=60)
    finally:
        toxicity._logistic = real
    assert 0 < seen[0] <= 60


def test_scores_equal_plain_logistic(spark):
    """The fitted score against a slow logistic regression on the features that were chosen."""
    rng = random.Random(14)
    rows = [(i, " ".join(rng.choices(["good", "house", "river", "stone"], k=8) + (["loser"] if i % 5 == 0 else []) + (["moron"] if i % 7 == 0 else []))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "loser " * 20_000)]
    labels = [(i, int((i % 5 == 0 or i % 7 == 0) and rng.random() < 0.9)) for i in range(300)]
    df = spark.createDataFrame([(i, t, None, "s", 1) for i, t in rows], DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.letter_model(df)
    chosen, weights, bias = toxicity.fit(df, marks, model)
    restorer = toxicity.Restorer(model)
    found = {}
    for i, t in rows:
        owner, at = toxicity._hits(*toxicity.features(pa.array([t], pa.string()), restorer), chosen)
        found[i] = set(at.tolist())
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, marks).collect()}
    for i, _ in rows:
        assert abs(got[i] - 1 / (1 + np.exp(-min(max(bias + sum(weights[k] for k in found[i]), -40), 40)))) < 1e-9
    # the weights are where the penalised likelihood of the training rows, halved copies included, is flat
    learned = [{"toxic": float(v), "found": sorted(found[i])} for i, v in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    again, base = toxicity._logistic(learned, len(chosen))
    assert np.allclose(again, weights) and abs(base - bias) < 1e-9
    rng2 = np.random.default_rng(toxicity.SEED)
    x, y = [], []
    for r in sorted(learned, key=lambda r: (r["toxic"], r["found"])):
        for part in [r["found"]] if r["toxic"] < 0.5 else [r["found"], [k for k, u in zip(r["found"], rng2.random(len(r["found"])), strict=True) if u < 0.5]]:
            if part is r["found"] or part:
                x.append([float(k in part) for k in range(len(chosen))] + [1.0])
                y.append(r["toxic"])
    x, y = np.array(x), np.array(y)
    p = 1 / (1 + np.exp(-(x @ np.append(weights, bias))))
    slope = x.T @ (y - p) - np.append(0.01 * weights, 1e-6 * bias)
    assert np.abs(slope).max() < 1e-3


def test_toxicity_held_out(spark):
    sf = DATA.replace("sf0.001", "sf0.1")
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    marks = labels.select(F.col("doc_id").alias("d"), "toxic")
    got = toxicity.score(docs, labels).join(marks, F.col("doc_id") == F.col("d")).where("held_out").collect()
    bad = [r for r in got if r["toxic"]]
    assert len(bad) > 50 and sum(r["predicted"] for r in bad) >= 0.85 * len(bad)
    assert sum(r["predicted"] for r in got if not r["toxic"]) <= 0.01 * len(got)


def _letter_model(words):
    counts = np.full(letters.TRIGRAMS, 0.1)
    _, tri = letters.trigrams(pa.array(words))
    np.add.at(counts, tri, 50)
    counts = counts.reshape(-1, letters.CLASSES)
    return np.log(counts / counts.sum(axis=1, keepdims=True)).reshape(-1)


@pytest.mark.parametrize(("token", "plain"), [("l0s3r", "loser"), ("1d10t", "idiot"), ("looooser", "loser"), ("st.up.id", "stupid"), ("p@th3t1c", "pathetic"), ("loser", "loser")])
def test_restoring(token, plain):
    model = _letter_model(["loser", "idiot", "stupid", "pathetic", "good", "food"])
    assert toxicity.restore(token, model) == plain


def test_restoring_is_the_best_path():
    model = _letter_model(["loser", "slider", "lilies"])
    k = letters.CLASSES

    def worth(ways):
        text, cost = "".join(w for w, _ in ways), sum(c for _, c in ways)
        seq = [0, 0, *map(letters.letter_class, text), 0]
        return cost + sum(model[(seq[i] * k + seq[i + 1]) * k + seq[i + 2]] for i in range(len(seq) - 2))

    from itertools import product

    for token in ("1!13s", "sssl1d3r", "l!li35"):
        best = max(product(*toxicity.lattice(token)), key=worth)
        assert toxicity.restore(token, model) == "".join(w for w, _ in best)


def test_hidden_words_are_found(spark):
    rng = random.Random(8)
    fine = lambda: " ".join(rng.choices(["good", "house", "river", "stone", "loss", "ideal", "food"], k=12))
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, fine() + (" loser idiot " if toxic else " ") + fine()))
        marks.append((i, int(toxic)))
    hidden = ["l0ser 1diot", "looooser idiooot", "l o s e r  i d i o t", "l.o.s.e.r i-d-i-o-t", "LOSER!! idiot."]
    rows += [(1000 + k, f"{fine()} {h} {fine()}") for k, h in enumerate(hidden)] + [(2000, fine()), (2001, None), (2002, "")]
    docs = _docs(spark, rows)
    labels = spark.createDataFrame([*marks, (1, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert [got[1000 + k]["predicted"] for k in range(len(hidden))] == [1] * len(hidden)
    assert [got[i]["predicted"] for i in (2000, 2001, 2002)] == [0, 0, 0]
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 303
    assert {r["score"] for r in toxicity.score(docs, labels.limit(0)).collect()} < {0.0, 1e-10} or toxicity.score(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs = read_table(spark, DATA, "documents")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        assert after.count() > 0
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == names, name
        if name == "near_duplicates":
            sets = _sets([(r["doc_id"], r["text"]) for r in after.collect()])
            ids = [i for i in sets if sets[i]]
            assert not any(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a in ids for b in ids if a < b)
            lost = {r["doc_id"] for r in docs.collect()} - set(sets)
            every = _sets([(r["doc_id"], r["text"]) for r in docs.collect()])
            assert all(any(100 * len(every[a] & every[b]) >= 80 * len(every[a] | every[b]) for b in every if b != a) for a in lost)
        docs = after
    assert docs.where(~F.col("round_trip")).count() == 0


def test_pipeline_of_nothing(spark, tmp_path):
    docs = read_table(spark, DATA, "documents").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert docs.count() == 0
