"""SimHash document fingerprints. DataFrame operations only.

A text's terms are its lower-cased words; each occurrence votes with its 64-bit hash, so a term weighs as
often as it occurs, and a bit of the fingerprint is set where the votes for one outnumber those for zero.
The votes are counted in eight byte-wide lanes of eight longs over runs of 127 words, then summed, all in
one scalar expression: no shuffle and no grouping of words.

``within_radius`` finds all fingerprints within a Hamming radius: a fingerprint is cut into radius + 3
blocks; two of that radius agree on at least three blocks, so tables keyed by each triple of blocks hold
every pair, and every pair found is checked on the full distance. Equal fingerprints are collapsed first.

Edge cases: null texts count as empty; a text without words has the fingerprint of zeros; equal texts have
equal fingerprints; the last document is edited with the first; with one document it is edited with itself;
rows that share a doc_id follow each other by text; null doc_ids come first; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.ranges import range_of
from siftwell.llm.support import settle

RADIUS = 3
#: Words a run of byte lanes can count without carrying or reaching the sign bit.
RUN = 127
LANE = 0x0101010101010101
#: Every such doc_id asks for its neighbours.
QUERY_STRIDE = 20


def _lanes(hashes: Column) -> Column:
    """Eight longs for a run of at most 127 hashes; byte b of long k counts set bits 8b + k."""
    zero = F.struct(*[F.lit(0).cast("long").alias(f"v{k}") for k in range(8)])
    return F.aggregate(
        hashes,
        zero,
        lambda acc, h: F.struct(
            *[(acc[f"v{k}"] + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(LANE))).alias(f"v{k}") for k in range(8)]
        ),
    )


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable is not inlined as an expression is."""
    return F.transform(F.array(value), body)[0]


def _signs(runs: Column, n: Column) -> Column:
    """The fingerprint of ``n`` words from their runs of lanes, bit by bit."""

    def set_votes(bit: int) -> Column:
        lane = lambda acc, r: acc + F.shiftrightunsigned(r[f"v{bit % 8}"], 8 * (bit // 8)).bitwiseAND(F.lit(255).cast("long"))
        return F.aggregate(runs, F.lit(0).cast("long"), lane)

    total = F.lit(0).cast("long")
    for bit in range(64):
        value = F.lit(1 << bit if bit < 63 else -(1 << 63)).cast("long")
        total = total.bitwiseOR(F.when(2 * set_votes(bit) > n, value).otherwise(F.lit(0).cast("long")))
    return total


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as a long."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def vote(hashed: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(hashed) - 1) / RUN).cast("int"))
        runs = F.transform(starts, lambda i: _lanes(F.slice(hashed, i * F.lit(RUN) + 1, RUN)))
        return F.when(F.size(hashed) == 0, F.lit(0).cast("long")).otherwise(_bind(runs, lambda r: _signs(r, F.size(hashed))))

    return _bind(F.transform(words, lambda w: F.xxhash64(w)), vote)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / 64.0


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last quarter replaced by the first as many code points of ``following``."""
    n = F.length(text)
    return F.concat(text.substr(F.lit(1), n - _quarter(n)), following.substr(F.lit(1), _quarter(n)))


def _quarter(n: Column) -> Column:
    """Code points that an edit of a text of ``n`` replaces."""
    return F.floor(n / 4).cast("int")


def _ranges(docs: DataFrame) -> list[int]:
    """Lower bounds of contiguous doc_id ranges, a few for each shuffle partition; each holds rows."""
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull())
    bounds = ids.repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("low"))
    return sorted(r["low"] for r in bounds.collect())


def _range_of(bounds: list) -> Column:
    """The range of a doc_id; null ids come before all others."""
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(range_of(F.col("doc_id"), bounds[1:]))


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp and next_fp of every row.

    Documents are ordered within doc_id ranges. Behind the last row of a range stands a guest, the first row of the
    next one, of which only as much text comes along as an edit can use. Guests are one row a range.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("range", _range_of(_ranges(rows)))
    row = F.struct("doc_id", "text")
    ends = rows.groupBy("range").agg(F.min(row).alias("head"), F.max(row).alias("tail"))
    ends = settle(ends.select("range", F.col("head.text").alias("head"), F.length("tail.text").alias("n")))
    first, last = ends.agg(F.min("range"), F.max("range")).first()
    # ranges are numbered without gaps; the first follows the last
    before = F.when(F.col("range") == first, F.lit(last)).otherwise(F.col("range") - 1) if first is not None else F.lit(0)
    hosts = ends.select(F.col("range").alias("host"), "n")
    guests = ends.select(before.alias("before"), "head").join(hosts, F.col("before") == F.col("host")).select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.col("head").substr(F.lit(1), _quarter(F.col("n"))).alias("text"),
        F.col("before").alias("range"),
        fingerprint(F.col("head")).alias("fp"),
        F.lit(True).alias("guest"),
    )
    rows = rows.withColumn("fp", fingerprint(F.col("text"))).withColumn("guest", F.lit(False)).unionByName(guests)
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    both = rows.withColumns({"following": F.lead("text").over(order), "next_fp": F.lead("fp").over(order)}).where(~F.col("guest"))
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(edited(F.col("text"), F.col("following")), 256).alias("edited_sha256"),
        "fp",
        fingerprint(edited(F.col("text"), F.col("following"))).alias("edited_fp"),
        "next_fp",
    )


def fingerprint_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row a document; fingerprints as 16 hexadecimal digits; ``n_near`` for query rows, else null."""
    joined = own = settle(neighbour_fingerprints(docs))
    counts = near_counts(own.select("doc_id", "fp"), radius)
    counts = counts.withColumnRenamed("fp", "query_fp")
    # only query rows meet the counts: the others would share one null key
    asks = F.coalesce(F.pmod(F.col("doc_id"), F.lit(QUERY_STRIDE)) == 0, F.lit(False))
    asking = joined.where(asks).join(counts, F.col("fp") == F.col("query_fp"), "left").drop("query_fp")
    joined = asking.unionByName(joined.where(~asks).withColumn("n_near", F.lit(None).cast("long")))
    digits = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digits("fp").alias("fingerprint"),
        digits("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.col("n_near"),
    )


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of every block."""
    cuts = [64 * i // (radius + 3) for i in range(radius + 4)]
    return [(low, high - low) for low, high in zip(cuts, cuts[1:], strict=False)]


def _tables(fp: Column, radius: int) -> Column:
    """Keys of all permuted block tables: (table, block bits) hashed to one long each."""
    part = [F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) for low, bits in _blocks(radius)]
    chosen = combinations(range(len(part)), 3)
    return F.array(*[F.xxhash64(F.lit(t), *[part[i] for i in c]) for t, c in enumerate(chosen)])


def _first_table(a: Column, b: Column, radius: int) -> Column:
    """The first table that holds two fingerprints together: that of their first three equal blocks."""
    differ = a.bitwiseXOR(b)
    same = [F.shiftrightunsigned(differ, low).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) == 0 for low, bits in _blocks(radius)]
    out = F.lit(None).cast("int")
    for t, c in reversed(list(enumerate(combinations(range(len(same)), 3)))):
        out = F.when(same[c[0]] & same[c[1]] & same[c[2]], F.lit(t)).otherwise(out)
    return out


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (query_fp, fp, distance) of distinct fingerprints within the radius, itself included.

    ``fps`` may have more columns, which stay; its fingerprints are distinct. A pair is taken from the first table
    that holds it, so none has to be dropped afterwards.
    """
    q = queries.select(F.col("fp").alias("query_fp")).distinct()
    q = q.select("query_fp", F.posexplode(_tables(F.col("query_fp"), radius)).alias("query_table", "query_key"))
    t = fps.select("*", F.explode(_tables(F.col("fp"), radius)).alias("key"))
    distance = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp")))
    first = _first_table(F.col("query_fp"), F.col("fp"), radius) == F.col("query_table")
    pairs = q.join(t, (F.col("query_key") == F.col("key")) & (distance <= radius) & first)
    return pairs.select("query_fp", *fps.columns, distance.alias("distance"))


def near_counts(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, n_near): for the fingerprint of every query row, the other rows within the radius."""
    sizes = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    queries = rows.where(F.pmod(F.col("doc_id"), F.lit(QUERY_STRIDE)) == 0)
    pairs = within_radius(queries, sizes, radius)
    return pairs.groupBy(F.col("query_fp").alias("fp")).agg((F.sum("n") - 1).alias("n_near"))
