"""Mixing, sharding, chat formatting and SimHash against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from siftwell.llm import catalog, chat, mixing, sharding, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    """Documents with a clashing extra column."""
    df = spark.createDataFrame([(i, t, None, s, None if t is None else len(t)) for i, t, s in rows], DOCS)
    return df.withColumns({"key": F.lit(1), "size": F.lit("x"), "slice": F.lit(2), "range": F.lit(3)})


def _random_docs(seed, n, sources=("a", "b", "c", None), hot="a"):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(30)]
    out = []
    for i in range(n):
        text = rng.choice([None, "", " \n", " ".join(rng.choices(words, k=rng.randint(1, 40)))] + [" ".join(rng.choices(words, k=20))] * 6)
        out.append((i, text, hot if rng.random() < 0.4 else rng.choice(sources)))
    return out


def _fill(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Water-filling by repeated clamping."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        target = {s: left * w[s] / sum(w[t] for t in free) for s in free} if free else {}
        over = [s for s in free if target[s] > cap * sizes[s] * (1 + 1e-12)]
        if not over:
            return fixed | target
        fixed |= {s: float(cap * sizes[s]) for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_mixture(spark, seed):
    rows = _random_docs(seed, 120)
    got = mixing.mixed_sizes(_docs(spark, rows)).collect()
    size = {i: len((t or "").split()) for i, t, _ in rows}
    by = defaultdict(int)
    for i, _, s in rows:
        by[s] += size[i]
    want = _fill(by)
    largest = max(size.values())
    taken = Counter()
    for r in got:
        assert r["size"] == size[r["doc_id"]] and abs(r["target"] - want[r["source"]]) < 1e-6 and r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= largest for s in by) and len(got) == len(rows)
    again = mixing.mixed_sizes(_docs(spark, rows).repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    mixed = mixing.mix(_docs(spark, rows))
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({r["doc_id"]: r["repeats"] for r in got if r["repeats"]})
    assert mixed.columns == _docs(spark, rows).columns


def test_mixture_of_nothing(spark):
    assert mixing.mixed_sizes(_docs(spark, [])).count() == 0 and mixing.mix(_docs(spark, [])).count() == 0
    got = mixing.mixed_sizes(_docs(spark, [(1, None, None), (1, "", None), (None, None, "s")])).collect()
    assert [r["taken"] for r in got] == [0, 0, 0]


@pytest.mark.parametrize("n", [0, 1, 5, 16, 17, 400])
def test_shards(spark, n):
    rows = _random_docs(n, n)
    got = sharding.shard(_docs(spark, rows).repartition(3)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in rows)
    counts = Counter(r["shard"] for r in got)
    sizes = [counts[s] for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(16))
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    text = {i: (t or "").encode() for i, t, _ in rows}
    assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in got)
    total = Counter(s for *_, s in rows)
    for s, m in total.items():
        parts = Counter(r["shard"] for r in got if r["source"] == s)
        assert all(abs(parts[k] - m / 16) <= 2 for k in range(16))


def test_shards_take_repeats_and_nulls(spark):
    got = sharding.shard(_docs(spark, [(1, "a", "x")] * 40 + [(None, None, None)] * 8)).collect()
    assert len(got) == 48 and len({(r["shard"], r["slot"]) for r in got}) == 48


def _told(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns = [(r, x) for _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return out


def test_conversations_are_read_back(spark):
    rng = random.Random(1)
    bits = ["<|turn|>", "<|end|>\n", "<|text|>", "</s>", "[INST]", "[/INST]", "<\\|", "<", "\\", "|", "[", "\n", "é😀", "", "a", "<\\\\|end|>"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<|text|>"]), rng.choice([None, "".join(rng.choices(bits, k=rng.randint(0, 9)))])) for c in range(30) for t in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"tree": F.lit(1), "node": F.lit(2)})
    got = chat.digests(chat.format_conversations(df))
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got.collect()} == _told(rows)


def test_long_and_repeated_conversations(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"x{t}") for t in range(150)] + [(2, 0, "user", "a")] * 3 + [(None, 0, "user", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r["n_turns"] for r in chat.digests(chat.format_conversations(df)).collect()}
    assert got == {1: 150, 2: 3, None: 1}
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_branches_are_ranked_by_score(spark):
    #      1        a: 1-2-4 scores (0+5+0)/3, 1-2-5 (0+5+9)/3, 1-3 (0+1)/2
    nodes = [("a", 1, None, 0.0), ("a", 2, 1, 5.0), ("a", 3, 1, 1.0), ("a", 4, 2, 0.0), ("a", 5, 2, 9.0), ("b", 1, 77, 1.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double")
    got = defaultdict(list)
    for r in sorted(chat.best_paths(df, 2).collect(), key=lambda r: r["nth"]):
        got[r["tree"], r["branch"]].append(r["node"])
    assert got == {("a", 1): [1, 2, 5], ("a", 2): [1, 2, 4], ("b", 1): [1]}


def test_paths_of_random_trees(spark):
    rng = random.Random(12)
    nodes, scores, parents = [], {}, {}
    for tree in ("a", "b", "null", None, "=", ""):
        ids = rng.sample(range(1000), 60)
        for k, node in enumerate(ids):
            parent = rng.choice(ids[max(0, k - 4) : k]) if k and rng.random() < 0.95 else rng.choice([None, 5000])
            if k and rng.random() < 0.5:
                parent = ids[k - 1]
            nodes.append((tree, node, parent, float(rng.randrange(20))))
    by = defaultdict(dict)
    for tree, node, parent, score in nodes:
        by[tree][node] = (parent, score)
    want = {}
    for tree, own in by.items():
        answered = {p for p, _ in own.values()}
        paths = []
        for leaf in own:
            if leaf not in answered:
                path = [leaf]
                while own[path[-1]][0] in own:
                    path.append(own[path[-1]][0])
                paths.append((-sum(own[n][1] for n in path) / len(path), leaf, path[::-1]))
        for k, (_, _, path) in enumerate(sorted(paths)[:3]):
            want[tree, k + 1] = path
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double")
    got = defaultdict(list)
    for r in sorted(chat.best_paths(df, 3).collect(), key=lambda r: r["nth"]):
        got[r["tree"], r["branch"]].append(r["node"])
    assert got == want
    # formatting follows the paths, and the mask finds the assistant's texts by code points and by bytes
    said = df.withColumns({"role": F.when(F.col("node") % 2 == 0, "assistant").otherwise("user"), "text": F.concat(F.lit("é[INST]"), "node"), "conv_id": F.lit(1)})
    for r in chat.format_paths(chat.path_parts(df, 3), said).collect():
        path = want[r["tree"], r["branch"]]
        assert r["formatted"] == "".join(f"<|turn|>{'user' if n % 2 else 'assistant'}<|text|>é[\\INST]{n}<|end|>\n" for n in path)
        texts = [f"é[\\INST]{n}" for n in path if n % 2 == 0]
        assert [r["formatted"][x["start"] : x["start"] + x["len"]] for x in r["loss"]] == texts
        assert [r["formatted"].encode()[x["byte"] : x["byte"] + x["bytes"]].decode() for x in r["loss"]] == texts


def test_very_long_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", "é<|end|>" * 500) for t in range(3000)] + [(2, 0, "assistant", "x" * 2_000_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.digests(chat.format_conversations(df)).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == _told(rows)


def test_cycles_are_refused(spark, monkeypatch):
    monkeypatch.setattr(chat, "MAX_DOUBLINGS", 4)
    df = spark.createDataFrame([("a", 1, 2, 0.0), ("a", 2, 1, 0.0)], "tree string, node long, parent long, score double")
    with pytest.raises(ValueError, match="cycle"):
        chat.best_paths(df)


def _hash_words(spark, words):
    words = sorted(set(words))
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect() if words else []
    return {r["w"]: r["h"] & (2**64 - 1) for r in rows}


def test_fingerprints_equal_votes(spark):
    rng = random.Random(3)
    rows = _random_docs(9, 40) + [(100 + k, " ".join(f"t{rng.randint(0, 400)}" for _ in range(n)), "a") for k, n in enumerate((126, 127, 128, 400, 1000))]
    got = {r["doc_id"]: r for r in simhash.fingerprint_documents(_docs(spark, rows)).collect()}
    texts = {i: t or "" for i, t, _ in rows}
    order = sorted(texts)
    follow = dict(zip(order, order[1:] + order[:1], strict=True))
    edited = {i: texts[i][: len(texts[i]) - len(texts[i]) // 4] + texts[follow[i]][: len(texts[i]) // 4] for i in order}
    h = _hash_words(spark, [w for t in [*texts.values(), *edited.values()] for w in t.lower().split()])

    def vote(t):
        words = [h[w] for w in t.lower().split()]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in words) > len(words))

    same = lambda a, b: 1 - (a ^ b).bit_count() / 64
    prints = {i: vote(texts[i]) for i in order}
    for i in order:
        r = got[i]
        assert int(r["fingerprint"], 16) == prints[i] and r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(edited[i].encode()).hexdigest()
        assert int(r["edited_fingerprint"], 16) == vote(edited[i])
        assert r["near_edited"] == same(prints[i], vote(edited[i])) and r["near_next"] == same(prints[i], prints[follow[i]])
        if i % 20 == 0:
            assert r["n_near"] == sum((prints[i] ^ p).bit_count() <= 3 for p in prints.values()) - 1


def test_all_fingerprints_within_the_radius(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = {x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for x in base for _ in range(12)}
    signed = lambda x: x - 2**64 if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = {(r["query_fp"], r["fp"]) for r in simhash.within_radius(df, df).collect()}
    assert got == {(signed(a), signed(b)) for a in fps for b in fps if (a ^ b).bit_count() <= 3}


def test_fingerprints_of_odd_tables(spark):
    assert simhash.fingerprint_documents(_docs(spark, [])).count() == 0
    got = simhash.fingerprint_documents(_docs(spark, [(1, "a b c d", "x")])).first()
    assert got["edited_sha256"] == hashlib.sha256(b"a b c a").hexdigest()
    assert simhash.fingerprint_documents(_docs(spark, [(1, "a", "x")] * 3 + [(None, None, None)] * 2)).count() == 5


def test_very_long_texts(spark):
    """Sharding, mixing and fingerprints take whole texts."""
    long = "wörd other " * 200_000
    rows = [(1, long, "a"), (2, "x", "a"), (3, None, "b"), (20, "one two " * 15_000 + "three", "b")]
    docs = _docs(spark, rows)
    got = {r["doc_id"]: r for r in sharding.shard(docs).collect()}
    assert (got[1]["size"], got[1]["text_crc32"]) == (len(long.encode()) + 1, zlib.crc32(long.encode()))
    taken = {r["doc_id"]: r for r in mixing.mixed_sizes(docs).collect()}
    assert taken[1]["size"] == 400_000 and taken[20]["size"] == 30_001 and all(r["taken"] <= 2 * r["size"] for r in taken.values())
    prints = {r["doc_id"]: r for r in simhash.fingerprint_documents(docs).collect()}
    h = _hash_words(spark, ["wörd", "other", "one", "two", "three"])
    vote = lambda words: sum(1 << b for b in range(64) if 2 * sum(n * (h[w] >> b & 1) for w, n in words.items()) > sum(words.values()))
    assert int(prints[1]["fingerprint"], 16) == vote({"wörd": 200_000, "other": 200_000})
    assert int(prints[20]["fingerprint"], 16) == vote({"one": 15_000, "two": 15_000, "three": 1})
    assert prints[1]["n_chars"] == len(long)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, duck, name):
    told = lambda table: sorted(str(sorted(row.items())) for row in table.to_pylist())
    got, want = catalog.QUERIES[name](spark, DATA).toArrow(), duck.sql(catalog.ORACLES[name]).to_arrow_table()
    assert told(got) == told(want)


@pytest.mark.parametrize("name", ["op2_chat", "op5_sharding", "op6_simhash", "op10_mixing"])
def test_no_python_on_the_main_path(spark, name):
    plan = catalog.QUERIES[name](spark, DATA)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
