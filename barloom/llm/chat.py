"""Chat formatting of reply trees, with DataFrame functions only.

Every message points at its parent.  Self-joins on the pointers double the
distance each round, so a tree of depth d takes log2(d) rounds: the first pass
adds up the score of every root-to-leaf branch, the second, for the chosen
leaves only, lists the messages of each path.  The best branches of each tree
are formatted as one conversation each.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for every turn.  Inside roles
and texts a backslash is doubled and a control string gets a backslash after
its first character, so texts cannot forge a turn and can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm._spark import cut

START, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of common chat formats, escaped inside texts.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

_TAILS = "|".join("".join("\\" + c if c in "|[]<>/" else c for c in x[1:]) for x in CONTROL)


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"([<\[])(?={_TAILS})", r"$1\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    parts = F.transform(F.split(text, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("\n")), F.lit("\\"), F.lit("")))
    return F.array_join(parts, "\\")


def _branches(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``(tree, node, depth, score)`` summed up to the root, and the pointers of each round.

    A message whose chain never ends (a cycle) has no root and is left out.
    """
    state = cut(nodes.select("tree", "node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score")))
    # Messages whose chain has reached its root are set aside; only the others go on.
    live, summed = state.where("up is not null"), state.where("up is null").drop("up")
    jumps, longest = [], state.count()
    reached = summed
    while (1 << len(jumps)) <= longest and not live.isEmpty():
        jumps.append(live.select("tree", "node", "up"))
        above = live.select("tree", "node", "up", "depth", "score").unionByName(reached.withColumn("up", F.lit(None).cast("string")))
        above = above.toDF("tree", "up", "up2", "d2", "s2")
        state = cut(
            live.join(above, ["tree", "up"]).select(
                "tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("score") + F.col("s2")).alias("score")
            )
        )
        live, fresh = state.where("up is not null"), state.where("up is null").drop("up")
        # A pointer of this round may end at any message that is done by now.
        reached = cut(reached.unionByName(fresh))
    return reached, jumps


def format_reply_trees(
    messages: DataFrame,
    tree_col: str = "tree_id",
    id_col: str = "message_id",
    parent_col: str = "parent_id",
    role_col: str = "role",
    text_col: str = "text",
    score_col: str | None = None,
    paths_per_tree: int | None = 1,
) -> DataFrame:
    """``tree_col, leaf, path_rank, path_score, formatted, loss_spans``: one row per chosen path.

    Branches are ranked by the sum of their messages' scores (null: 0), then
    by length, then by leaf id; None takes every branch.  ``loss_spans`` are the
    ``(start, end)`` code points of the assistants' texts in ``formatted``.
    Null roles and texts are empty; a null tree id is one tree; a parent that
    is null or absent makes a root; messages in or under a cycle have no path.
    Rows with one id in one tree are one message, the least by parent, role,
    text and score.  An empty table gives an empty result; other columns are ignored.
    """
    text = lambda c: F.col(c).cast("string")
    rows = messages.select(
        F.col(tree_col).alias("tree_value"), F.coalesce(F.concat(F.lit("="), text(tree_col)), F.lit("null")).alias("tree"),
        F.coalesce(F.concat(F.lit("="), text(id_col)), F.lit("null")).alias("node"), F.concat(F.lit("="), text(parent_col)).alias("parent"),
        text(role_col).alias("role"), text(text_col).alias("text"),
        F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)).alias("score") if score_col else F.lit(0.0).alias("score"),
    )
    rows = cut(
        rows.groupBy("tree", "node").agg(F.first("tree_value").alias("tree_value"), F.min(F.struct("parent", "role", "text", "score")).alias("m"))
        .select("tree", "tree_value", "node", "m.*")
    )
    ids = rows.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    nodes = rows.select("tree", "node", "parent", "score").join(ids, ["tree", "parent"], "left")
    nodes = cut(nodes.select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("parent"), "score"))
    summed, jumps = _branches(nodes)
    leaves = summed.join(nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct(), ["tree", "node"], "left_anti")
    by_score = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "node")
    ranked = leaves.withColumn("path_rank", F.row_number().over(by_score))
    chosen = cut(ranked if paths_per_tree is None else ranked.where(F.col("path_rank") <= paths_per_tree))

    path = chosen.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    for k, jump in enumerate(jumps):
        further = path.join(jump.withColumnRenamed("up", "to"), ["tree", "node"])
        path = cut(path.unionByName(further.select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"))))

    turns = path.join(rows, ["tree", "node"])
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turns = turns.select(
        "tree", "tree_value", "leaf", "up", F.coalesce("role", F.lit("")).alias("role"), F.length(head).alias("skip"),
        escape(F.col("text")).alias("body"), F.concat(head, escape(F.col("text")), F.lit(END)).alias("turn"),
    )
    so_far = Window.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(F.length("turn")).over(so_far), F.lit(0)) + F.col("skip"))
    span = F.struct("start", (F.col("start") + F.length("body")).alias("end"))
    # The window has sorted each path in one task, so nothing is shuffled again.
    whole = turns.groupBy("tree", "leaf").agg(
        F.first("tree_value").alias(tree_col),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "turn"))), lambda t: t["turn"]), "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", span))).alias("loss_spans"),
    )
    ranks = chosen.select("tree", F.col("node").alias("leaf"), "path_rank", F.col("score").alias("path_score"))
    return whole.join(ranks, ["tree", "leaf"]).select(
        tree_col, F.expr("substring(leaf, 2)").alias("leaf"), "path_rank", "path_score", "formatted", "loss_spans"
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of ``(role, text)``, unescaped."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")

    def turn(piece):
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined without anything between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def conversations_as_trees(conversations: DataFrame) -> DataFrame:
    """Linear conversations ``(conv_id, turn, role, text)`` as reply chains.

    Each row answers the one before it by turn (null first), then role and text;
    every row is a message of its own, repeated rows too.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = conversations.select("conv_id", "turn", "role", "text").withColumn("message_id", F.row_number().over(order))
    parent = F.when(F.col("message_id") > 1, F.col("message_id") - 1)
    return placed.select(F.col("conv_id").alias("tree_id"), "message_id", parent.alias("parent_id"), "role", "text")
