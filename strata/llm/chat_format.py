"""Chat formatting of reply trees.

Messages are nodes of trees. Root-to-leaf paths come from iterative self-joins
that double the reach: ``up[k]`` has each node's ancestor 2**k steps above, and
the paths of all leaves are filled from the longest reach down, so a path of
depth d takes about log2(d) joins and as many rows as it has nodes. Paths of a
tree are ranked by score; each chosen path is one conversation:

    [INST]role[/INST]text</s>  for every turn

``[INST]``, ``[/INST]`` and ``</s>`` inside a role or text get a backslash after
their first character (one more where some are there already), which
``unescape`` takes away, so any text comes back unchanged. The loss mask is the
spans (first code point from 0, length) of the assistant texts.

A null role or text is empty, a null tree id is a tree of its own, a null turn
comes first. Rows with
the same tree and turn stand in the order of role and text; equal rows are
turns of their own. Of paths with equal scores the one with the smaller leaf
comes first. The registered query adds conversation -1; given rows with that id
are turns of the same conversation. Extra columns are not read. Only DataFrame functions are used;
what one task must hold is one conversation, which is one output row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, stored, table

OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
_CONTROL = r"(/?INST\]|/s>)"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, rf"([\[<])(\\*){_CONTROL}", r"$1$2\\$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, rf"([\[<])(\\*)\\{_CONTROL}", "$1$2$3")


def paths(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, above): every node on the way from each leaf to its
    root, ``above`` steps from the leaf. ``nodes`` has tree, node, parent (null
    for a root); (tree, node) is unique."""
    up = [stored(spark, nodes.select("tree", "node", "parent").where("parent is not null"), "chat-up")]
    while True:
        low, high = up[-1].alias("a"), up[-1].alias("b")
        twice = low.join(high, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.parent") == F.col("b.node"))).select(
            "a.tree", "a.node", "b.parent")
        twice = stored(spark, twice, "chat-up")
        if twice.isEmpty():
            discard(spark, twice)
            break
        up.append(twice)
    inner = nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    way = nodes.select("tree", "node").alias("n").join(
        inner.alias("i"), F.col("n.tree").eqNullSafe(F.col("i.tree")) & (F.col("n.node") == F.col("i.node")), "left_anti")
    way = way.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    for k in range(len(up) - 1, -1, -1):
        step = way.alias("w").join(up[k].alias("u"), F.col("w.tree").eqNullSafe(F.col("u.tree"))
                                   & (F.col("w.node") == F.col("u.node"))).select(
            "w.tree", "w.leaf", F.col("u.parent").alias("node"), (F.col("w.above") + 2 ** k).alias("above"))
        # every row is extended once by each reach, so no node comes twice
        longer = stored(spark, way.unionByName(step), "chat-way")
        if k < len(up) - 1:
            discard(spark, way)
        way = longer
    discard(spark, *up)
    return way


def rank_paths(way: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, leaf, score, rank): paths of each tree by the sum of their scores."""
    score = way.alias("w").join(nodes.alias("n"), F.col("w.tree").eqNullSafe(F.col("n.tree"))
                                & (F.col("w.node") == F.col("n.node"))).groupBy("w.tree", "w.leaf").agg(
        F.sum(F.coalesce("n.score", F.lit(0.0))).alias("score"))
    order = W.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    return score.withColumn("rank", F.row_number().over(order))


def best_paths(way: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, leaf, score) of the first path of each tree, without sorting its paths."""
    score = way.alias("w").join(nodes.alias("n"), F.col("w.tree").eqNullSafe(F.col("n.tree"))
                                & (F.col("w.node") == F.col("n.node"))).groupBy("w.tree", "w.leaf").agg(
        F.sum(F.coalesce("n.score", F.lit(0.0))).alias("score"))
    best = score.groupBy("tree").agg(F.max(F.struct("score", (-F.col("leaf")).alias("less"))).alias("b"))
    return best.select("tree", (-F.col("b.less")).alias("leaf"), F.col("b.score").alias("score"))


def format_paths(way: DataFrame, chosen: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, leaf, formatted, loss): one conversation for each chosen path."""
    rows = way.alias("w").join(chosen.alias("c"), F.col("w.tree").eqNullSafe(F.col("c.tree"))
                               & (F.col("w.leaf") == F.col("c.leaf")), "left_semi")
    rows = rows.join(nodes.alias("n"), F.col("w.tree").eqNullSafe(F.col("n.tree"))
                     & (F.col("w.node") == F.col("n.node"))).select(
        "w.tree", "w.leaf", (-F.col("w.above")).alias("place"), F.coalesce("n.role", F.lit("")).alias("role"),
        F.coalesce("n.text", F.lit("")).alias("text"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    rows = rows.withColumns({"head": head, "body": escape(F.col("text"))})
    size = F.length("head") + F.length("body") + len(CLOSE)
    before = W.partitionBy("tree", "leaf").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)))
    span = F.when(F.col("role") == "assistant", F.struct(
        (F.col("start") + F.length("head")).alias("first"), F.length("body").alias("length")))
    turn = F.struct("place", F.concat("head", "body", F.lit(CLOSE)).alias("turn"), span.alias("span"))
    grouped = rows.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return grouped.select("tree", "leaf", F.array_join("t.turn", "").alias("formatted"),
                          F.filter("t.span", lambda s: s.isNotNull()).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, r"\Q" + CLOSE + r"\E", -1)

    def turn(p: Column) -> Column:
        head = F.substring_index(p, MIDDLE, 1)
        return F.struct(unescape(F.substring(head, len(OPEN) + 1, 2 ** 31 - 1)).alias("role"),
                        unescape(F.substr(p, F.length(head) + len(MIDDLE) + 1)).alias("text"))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(
        formatted, (s["first"] + 1).cast("int"), s["length"].cast("int")))), "")


def op10_reply_tree_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.sql("SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(c1 AS BIGINT) AS turn, c2 AS role, "
                      "'</s>[INST] ok [/INST]' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(c1, c2)")
    rows = given.unionByName(added)
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    nodes = rows.select(F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("node"),
                        "role", "text")
    nodes = nodes.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))
    nodes = stored(spark, nodes, "chat-nodes")
    way = paths(spark, nodes)
    chats = format_paths(way, best_paths(way, nodes), nodes)
    back = chats.withColumns({"turns": read_turns(F.col("formatted")), "spoken": read_loss(F.col("formatted"), F.col("loss"))})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.length("spoken").cast("long").alias("loss_chars"),
        F.sha2(F.col("spoken").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(role, '([\[<])(\\*){_CONTROL}', '\1\2\\\3', 'g') AS r,
             regexp_replace(text, '([\[<])(\\*){_CONTROL}', '\1\2\\\3', 'g') AS t FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(r) + length(t) + {len(OPEN) + len(MIDDLE) + len(CLOSE)})::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
