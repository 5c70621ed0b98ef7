"""Chat formatting of reply trees.

Messages of a tree point to the message they answer. Self-joins that double
their reach give every message its distance and score sum from the root, so a
thread of n messages takes log2(n) joins. The leaves of a tree rank its branches
by mean score along the path; the same jump tables, from the longest to the
shortest, list the messages of the chosen branches, and each branch becomes one
conversation. Join keys are (tree, message) pairs, so one tree that holds a
third of all messages is spread over all tasks until its text is put together.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts ``\\`` becomes ``\\b`` and ``<|`` becomes ``<\\p``; line breaks in roles
become ``\\n``. No control string can then appear inside a text, and the reverse
replacements restore it.

Defined results: a null text, role or score is empty or 0; messages without a
tree share one; a message whose parent is null or missing starts a branch of its
own; messages on a cycle, or below one, belong to no branch; repeated message
ids need ``number_turns`` first. An empty table gives no conversations. Only the
named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.session import settle

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CELL = 1024


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\p"), F.lit("|"))
    return F.replace(plain, F.lit("\\b"), F.lit("\\"))


def number_turns(rows: DataFrame, tree: str, turn: str, role: str, text: str) -> DataFrame:
    """(tree, node, parent, role, text) of linear conversations: each row answers the one before it.

    Rows are ordered by turn (null first), role and text. A conversation is
    numbered in cells of turns; only one row a cell goes along all of it.
    """
    df = rows.select(
        F.coalesce(F.col(tree).cast("string"), F.lit("")).alias("tree"),
        F.coalesce(F.col(turn).cast("long"), F.lit(-(2**62))).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("cell", F.floor(F.col("turn") / CELL))
    counts = df.groupBy("tree", "cell").count()
    along = Window.partitionBy("tree").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("tree", "cell", F.coalesce(F.sum("count").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("tree", "cell").orderBy("turn", "role", "text")
    numbered = df.withColumn("place", F.row_number().over(inside)).join(before, ["tree", "cell"])
    node = F.col("before") + F.col("place") - 1
    return numbered.select("tree", node.alias("node"), F.when(node > 0, node - 1).alias("parent"), "role", "text")


def paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, node, above) of the best branches: ``above`` counts the steps from the leaf."""
    links = nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("total"))
    known = links.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    state = settle(
        links.join(known, ["tree", "parent"], "left").select(
            "tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"),
            F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"), "total",
        )
    )
    parents = state.where("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
    leaves = state.join(parents, ["tree", "node"], "left_anti").select("tree", "node")
    jumps, ended, most = [], [], max(1, state.count()).bit_length() + 1
    while True:
        jump = state.where("up IS NOT NULL")
        active = jump.select("tree").distinct()
        if jump.isEmpty():
            ended.append(state)
            break
        if len(jumps) > most:  # what still has an ancestor 2**most above it is on or below a cycle
            ended.append(state.where("up IS NULL"))
            break
        jumps.append(jump.select("tree", "node", "up"))
        ended.append(state.join(active, "tree", "left_anti"))
        state = state.join(active, "tree", "left_semi")
        other = state.select(
            "tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"), F.col("total").alias("total2")
        )
        state = settle(
            state.join(other, ["tree", "up"], "left").select(
                "tree", "node", F.col("up2").alias("up"),
                (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
                (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"),
            )
        )
    done = reduce(DataFrame.unionByName, ended)
    rank = F.row_number().over(
        Window.partitionBy("tree").orderBy((F.col("total") / (F.col("depth") + 1)).desc(), F.col("depth").desc(), "node")
    )
    chosen = done.join(leaves, ["tree", "node"], "left_semi").withColumn("rank", rank).where(F.col("rank") <= branches)
    found = chosen.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    for k in reversed(range(len(jumps))):
        further = found.join(jumps[k], ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("above") + 2**k).alias("above")
        )
        found = settle(found.unionByName(further))
    return found


def format_trees(nodes: DataFrame, branches: int = 1, learn: str = "assistant") -> DataFrame:
    """One row for each chosen branch: tree, leaf, formatted, loss_spans (turn, start, length in characters).

    ``nodes`` has tree (string), node, parent, role, text, score. The spans mark
    the escaped texts of the role to be learned.
    """
    steps = paths(nodes, branches).join(nodes.select("tree", "node", "role", "text"), ["tree", "node"])
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    steps = steps.select("tree", "leaf", "above", "role", head.alias("head"), body.alias("body")).withColumn(
        "turn", F.concat("head", "body", F.lit(CLOSE + "\n"))
    )
    earlier = Window.partitionBy("tree", "leaf").orderBy(F.col("above").desc()).rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("begin", F.coalesce(F.sum(F.length("turn")).over(earlier), F.lit(0)) + F.length("head"))
    number = F.count("*").over(earlier)
    steps = steps.withColumn("number", number)
    learned = F.when(F.col("role") == learn, F.struct(F.col("number").alias("turn"), F.col("begin").alias("start"), F.length("body").alias("length")))
    return steps.groupBy("tree", "leaf").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("number", "turn"))), lambda x: x["turn"]), "").alias("formatted"),
        F.sort_array(F.collect_list(learned)).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    pieces = F.filter(F.split(formatted, rf"\Q{CLOSE}\E\n", -1), lambda x: x != "")

    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.regexp_extract(p, rf"(?s)^\Q{OPEN}\E([^\n]*)\n", 1)).alias("role"),
            unescape(F.regexp_replace(p, rf"^\Q{OPEN}\E[^\n]*\n", "")).alias("text"),
        ),
    )
