"""Chat formatting over reply trees. DataFrame operations only.

Messages form trees through (tree, node, parent). Runs of messages that each answer the one before, in order of
their nodes, are one stretch with prefix sums of scores and depths. Iterative self-joins then double the
reach of each stretch's ancestor pointer, so a tree whose paths change stretches d times takes log2(d) joins, and
a chain none: they give every stretch its root and the summed score above it. Leaves are ranked within their tree
by mean path score, the best ``branches`` stay, and a second doubling pass enumerates only the chosen paths. Each
path becomes one conversation.

Template: ``<|turn|>role<|text|>text<|end|>`` and a line feed for every turn. Control strings inside roles
and texts (the template's own and the common ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) get a backslash
after their first character, and strings that already look so get one more, so reading back is exact. The
loss mask lists the escaped assistant texts as (start, len) in code points and (byte, bytes) in UTF-8.

Edge cases: null texts and roles are empty; an unknown parent makes a node a root; all messages of a null tree id
are one tree; turns that tie are ordered by role and text; identical rows stay separate turns; texts of any length
are kept whole; an empty table gives no conversation; a cycle of replies is an error; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm.support import settle

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
CONTROL = r"(\||/?s>|/?INST\])"
MAX_DOUBLINGS = 40


def escape(c: Column) -> Column:
    """Text that holds no control string."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(c, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def _keyed(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``tree_key``, the tree's id as a key for joins: null is a tree, too, and equals no other."""
    if "tree_key" in nodes.columns:
        return nodes
    return nodes.withColumn("tree_key", F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("")))


def linear_trees(messages: DataFrame, texts: bool = True) -> DataFrame:
    """Messages (conv_id, turn, role, text) as trees of one branch: every turn answers the one before it.

    Without ``texts`` text is not read and empty; the trees and their nodes are the same.
    """
    text = F.col("text") if texts else F.lit(None).cast("string").alias("text")
    rows = _keyed(messages.select(F.col("conv_id").cast("string").alias("tree"), "conv_id", "turn", "role", text))
    order = Window.partitionBy("tree_key").orderBy("turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select("tree_key", "tree", "conv_id", "node", parent.alias("parent"), F.lit(1.0).alias("score"), "role", "text")


def path_parts(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree_key, tree, branch, first, last, above) of the ``branches`` best root-to-leaf paths of each tree.

    ``nodes`` has tree, node, parent and score; a node's id is its own within a tree. A path is a list of parts;
    a part holds the nodes from ``first`` to ``last``, and ``above`` nodes of the path come before them.
    """
    own = _keyed(nodes).select("tree_key", "tree", "node", "parent", F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
    order = Window.partitionBy("tree_key").orderBy("node")
    own = own.withColumn("goes_on", F.coalesce(F.col("parent") == F.lag("node").over(order), F.lit(False)))
    own = own.withColumn("first", F.max(F.when(~F.col("goes_on"), F.col("node"))).over(order))
    run = Window.partitionBy("tree_key", "first").orderBy("node")
    own = own.withColumns({"sum": F.sum("score").over(run), "depth": F.count(F.lit(1)).over(run)})
    stretches = settle(
        own.groupBy("tree_key", "first").agg(
            F.min("tree").alias("tree"),
            F.max(F.struct("node", "sum", "depth")).alias("end"),
            F.min(F.when(~F.col("goes_on"), F.col("parent"))).alias("parent"),
        )
    )
    # the node that a stretch answers, with what lies on the path up to it within its own stretch
    asked = stretches.where(F.col("parent").isNotNull()).select(F.col("tree_key").alias("k"), F.col("first").alias("child"), F.col("parent").alias("p"))
    columns = ["tree_key", F.col("child").alias("first"), F.col("up"), F.col("sum").alias("above_sum"), F.col("depth").alias("above"), F.col("node").alias("cut")]
    if asked.isEmpty():
        far = own.select(F.col("first").alias("child"), F.col("first").alias("up"), "tree_key", "sum", "depth", "node")
        answered = own.sparkSession.createDataFrame([], far.select(*columns).schema)
    else:
        met = own.withColumnRenamed("first", "up").join(asked, (F.col("tree_key") == F.col("k")) & (F.col("node") == F.col("p")))
        answered = settle(met.select(*columns))
    told = answered.select(F.col("tree_key").alias("k"), F.col("first").alias("f"), "up", "above_sum", "above", "cut")
    same = (F.col("tree_key") == F.col("k")) & (F.col("first") == F.col("f"))
    links = stretches.select("tree_key", "first").join(told, same, "left").select(
        "tree_key", "first", "up", F.coalesce("above_sum", F.lit(0.0)).alias("above_sum"), F.coalesce("above", F.lit(0)).cast("long").alias("above"), "cut"
    )
    # only stretches that have not reached their root go on; the others lend them their sums
    links = settle(links)
    open_ = F.col("up").isNotNull()
    jumps, finished = [links.where(open_)], links.where(~open_)
    while not jumps[-1].isEmpty():
        if len(jumps) > MAX_DOUBLINGS:
            raise ValueError("the replies of a tree form a cycle")
        names = ("tree_key", "first", "up", "above_sum", "above", "cut")
        b = jumps[-1].unionByName(finished).select(*[F.col(c).alias(f"b_{c}") for c in names])
        further = jumps[-1].join(b, (F.col("tree_key") == F.col("b_tree_key")) & (F.col("up") == F.col("b_first")))
        sums = [(F.col(c) + F.col(f"b_{c}")).alias(c) for c in ("above_sum", "above")]
        further = settle(further.select("tree_key", "first", F.col("b_up").alias("up"), *sums, F.col("b_cut").alias("cut")))
        jumps.append(further.where(open_))
        finished = finished.unionByName(further.where(~open_))
    tops = finished.select(F.col("tree_key").alias("k"), F.col("first").alias("f"), "above_sum", "above")
    parents = answered.select("tree_key", F.col("cut").alias("last")).distinct()
    leaves = stretches.select("tree_key", "tree", "first", F.col("end.node").alias("last"), "end.sum", "end.depth")
    leaves = leaves.join(parents, ["tree_key", "last"], "left_anti").join(tops, same)
    mean = (F.col("sum") + F.col("above_sum")) / (F.col("depth") + F.col("above"))
    rank = F.row_number().over(Window.partitionBy("tree_key").orderBy(mean.desc(), "last"))
    reached = leaves.select("tree_key", "tree", "first", "last", rank.alias("branch")).where(F.col("branch") <= branches)
    # after step k a path holds its last 2^k stretches; each jump table is used from the shortest on
    for step, jump in enumerate(jumps[:-1]):
        j = jump.select(F.col("tree_key").alias("k"), F.col("first").alias("f"), "up", "cut")
        back = reached.join(j, same).select("tree_key", "tree", F.col("up").alias("first"), F.col("cut").alias("last"), "branch")
        reached = reached.unionByName(back)
        if step % 3 == 2:
            reached = settle(reached)
    return reached.join(tops, same).select("tree_key", "tree", "branch", "first", "last", "above")


def best_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, branch, node, nth) of the ``branches`` best root-to-leaf paths of each tree; ``nth`` counts from the root."""
    parts = path_parts(nodes, branches).withColumnRenamed("tree_key", "k")
    own = _keyed(nodes).select("tree_key", "node")
    on = parts.join(own, (F.col("k") == F.col("tree_key")) & F.col("node").between(F.col("first"), F.col("last")))
    within = Window.partitionBy("tree_key", "branch", "first").orderBy("node")
    return on.select("tree", "branch", "node", (F.col("above") + F.row_number().over(within)).alias("nth"))


def format_paths(parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row a path: tree, conv_id, branch, formatted and loss, where its assistant texts stand.

    ``nodes`` has conv_id, role and text, too. The texts are dealt by tree once; the parts of a tree's paths come to
    them as one list. Places are prefix sums over a path's turns.
    """
    taken = parts.groupBy(F.col("tree_key").alias("k")).agg(F.collect_list(F.struct("branch", "first", "last", "above")).alias("parts"))
    turns = _keyed(nodes).join(taken, F.col("tree_key") == F.col("k"))
    # stretches are runs in the order of nodes, so a part's nodes lie between its ends
    mine = F.filter("parts", lambda p: F.col("node").between(p["first"], p["last"]))
    turns = turns.select("tree_key", "tree", "conv_id", "node", escape(F.col("role")).alias("r"), escape(F.col("text")).alias("t"), F.explode(mine).alias("part"))
    turns = turns.select("*", "part.branch", "part.above").withColumn("head", F.concat(F.lit(TURN), F.col("r"), F.lit(TEXT)))
    before = Window.partitionBy("tree_key", "branch").orderBy("above", "node").rowsBetween(Window.unboundedPreceding, -1)
    for name, size in (("start", F.length), ("byte", F.octet_length)):
        whole = (size("head") + size("t") + F.lit(len(END))).cast("long")
        turns = turns.withColumn(name, F.coalesce(F.sum(whole).over(before), F.lit(0)) + size("head"))
    span = F.struct("start", F.length("t").cast("long").alias("len"), "byte", F.octet_length("t").cast("long").alias("bytes"))
    turn = F.struct("above", "node", F.concat("head", "t", F.lit(END)).alias("piece"), F.when(F.col("r") == "assistant", span).alias("span"))
    paths = turns.groupBy("tree_key", "branch").agg(
        F.min("tree").alias("tree"), F.min("conv_id").alias("conv_id"), F.sort_array(F.collect_list(turn)).alias("turns")
    )
    return paths.select(
        "tree",
        "conv_id",
        "branch",
        F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda x: x["span"].isNotNull()), lambda x: x["span"]).alias("loss"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    parts = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p, i: i > 0)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(p, TEXT, 1)).alias("role"),
            unescape(
                F.substring(p, F.length(F.substring_index(p, TEXT, 1)) + F.lit(len(TEXT) + 1),
                            F.length(p) - F.length(F.substring_index(p, TEXT, 1)) - F.lit(len(TEXT) + len(END)))
            ).alias("text"),
        ),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the formatted conversations, as counts and hashes."""
    back = formatted.withColumn("back", parse(F.col("formatted")))
    told = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # bytes are reached without counting characters from the start each time
    part = lambda raw, s: unescape(F.decode(raw.substr((s["byte"] + 1).cast("int"), s["bytes"].cast("int")), "UTF-8"))
    masked = F.transform(
        F.array(F.encode("formatted", "UTF-8")), lambda raw: F.array_join(F.transform("loss", lambda s: part(raw, s)), "")
    )[0]
    return back.withColumn("masked", masked).select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: A conversation whose texts are control strings.
HOSTILE = "</s>[INST] ok [/INST]"


def with_hostile(messages: DataFrame) -> DataFrame:
    """``messages`` and conversation -7, in which a user and an assistant say control strings."""
    more = messages.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HOSTILE).alias("text"),
    )
    return messages.select("conv_id", "turn", "role", "text").unionByName(more)


def format_conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Formatted conversations of (conv_id, turn, role, text)."""
    parts = path_parts(linear_trees(messages, texts=False), branches)
    return format_paths(parts, linear_trees(messages))


SQL = r"""
WITH m AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i,
             coalesce(role, '') AS role, coalesce(text, '') AS text FROM m),
e AS (SELECT *, regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS er,
             regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS et FROM n)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|turn|>' || er || '<|text|>' || et || '<|end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
