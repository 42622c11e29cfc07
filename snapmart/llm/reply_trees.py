"""Chat formatting of reply trees.

Messages form trees: each names the message it answers. The paths from roots to
leaves are the conversations a tree holds. They are found by self-joins that double
their reach: a message knows its ancestor 1, 2, 4, ... steps up, with the score of
what lies between, so a chain of n messages takes log2(n) joins and no path is written
out before one is chosen. Leaves are ranked by the score of their whole branch; the
chosen ones mark their ancestors by the same jumps, and the marked messages of a
branch are formatted as one conversation.

The template marks turns with control strings. Where a text holds one of its own
it is escaped, so the texts can be read back from the formatted conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapmart.llm.common import stage

#: Control strings of the template, and the escape sign; fixed values.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ESCAPE = "\\"


def escape(text: Column) -> Column:
    """A text without control strings: the escape sign is doubled, and put into each '<|'."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.replace(doubled, F.lit("<|"), F.lit(f"<{ESCAPE}|"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(f"{ESCAPE}n"))


def unescape(text: str) -> str:
    """What ``escape`` was given; also reads an escaped line break of a role."""
    out, at = [], 0
    while (cut := text.find(ESCAPE, at)) >= 0 and cut + 1 < len(text):
        after = text[cut + 1]
        out += (text[at:cut], "\n" if after == "n" else after)
        at = cut + 2
    out.append(text[at:])
    return "".join(out)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns = []
    for part in formatted.split(f"{CLOSE}\n")[:-1]:
        role, _, text = part.removeprefix(OPEN).partition("\n")
        turns.append((unescape(role), unescape(text)))
    return turns


def jumps(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (tree, node, up) of the ancestor 1, 2, 4, ... steps up, and (tree, node, score, steps) up to the root.

    A table holds the messages that have such an ancestor. ``score`` and ``steps``
    cover the messages from ``node`` to its root. Only messages that haven't
    arrived are joined and written again. Messages whose parents form a
    cycle, and those below them, never arrive; they are left out of the second table.
    """
    reach = stage(messages.select("tree", "node", F.col("parent").alias("up"), "score", F.lit(1).cast("long").alias("steps")), "jump")
    rounds = reach.count().bit_length() + 1  # a path has no more steps than there are messages
    levels, arrived = [], reach.where(F.col("up").isNull())
    for _ in range(rounds):
        moving = reach.where(F.col("up").isNotNull())
        if moving.isEmpty():
            break
        levels.append(moving.select("tree", "node", "up"))
        above = moving.unionByName(arrived).select(
            F.col("tree"), F.col("node").alias("up"), F.col("up").alias("next"),
            F.col("score").alias("more"), F.col("steps").alias("further"))
        reach = stage(moving.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("score") + F.col("more")).alias("score"),
            (F.col("steps") + F.col("further")).alias("steps")), "jump")
        arrived = arrived.unionByName(reach.where(F.col("up").isNull()))
    return levels, arrived.drop("up")


def rooted(messages: DataFrame) -> DataFrame:
    """``messages`` with a null parent where the parent isn't a message of the tree, or is the message itself."""
    known = messages.select(F.col("tree").alias("t"), F.col("node").alias("n")).distinct()
    found = messages.join(known, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("n")), "left")
    parent = F.when(F.col("n").isNotNull() & (F.col("parent") != F.col("node")), F.col("parent"))
    return found.withColumn("parent", parent).drop("t", "n")


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, position): the messages on the ``branches`` best branches of each tree.

    ``messages`` has tree, node, parent and score, and (tree, node) is unique;
    ``position`` counts from the root. A branch's score is the sum over its
    messages, null counting as 0; of equals the one with the smallest leaf comes
    first. Messages on a cycle of parents, or below one, are on no branch.
    """
    plain = stage(rooted(messages).select("tree", "node", "parent", F.coalesce(F.col("score"), F.lit(0.0)).cast("double").alias("score")), "messages")
    levels, arrived = jumps(plain)
    inner = plain.where(F.col("parent").isNotNull()).select("tree", F.col("parent").alias("node")).distinct()
    leaves = arrived.join(inner, ["tree", "node"], "left_anti")
    # the best leaf is a plain aggregate; only for more branches are leaves ranked in a window, which keeps the first ones
    if branches == 1:
        best = leaves.groupBy("tree").agg(F.min(F.struct((-F.col("score")).alias("s"), "node")).alias("b")).select(
            "tree", F.col("b.node").alias("leaf"), F.lit(1).alias("rank"))
    else:
        order = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
        best = leaves.select("tree", F.col("node").alias("leaf"), F.row_number().over(order).alias("rank")).where(F.col("rank") <= branches)
    marked = stage(best.select("tree", "leaf", "rank", F.col("leaf").alias("node")), "marked")
    # longest jumps first, so that few rows are marked before the last ones; an ancestor's distance is one sum of jumps
    for level in reversed(levels):  # messages that reach a cycle aren't on a marked path
        higher = marked.join(level, ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"))
        marked = marked.unionByName(stage(higher, "marked"))
    depth = arrived.select("tree", "node", F.col("steps").alias("position"))
    return marked.join(depth, ["tree", "node"])


def format_paths(
    messages: DataFrame, paths: DataFrame, trained_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """(tree, rank, n_turns, formatted, loss_spans) for each path.

    ``messages`` has tree, node, role and text; null roles and texts count as empty. ``loss_spans`` holds (start, stop) code points
    of what is learnt: the escaped texts of ``trained_roles``, without marks. A
    conversation is one row, so its turns meet in one task; that is the result's size.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = paths.join(messages.select("tree", "node", "role", "text"), ["tree", "node"]).select(
        "tree", "rank", "position", F.concat(F.lit(OPEN), _escape_role(role), F.lit("\n")).alias("head"),
        escape(text).alias("body"), role.isin(*trained_roles).alias("trained"))
    # a turn's place is a running sum over the rows, so work is linear in the turns; the grouping below uses the same exchange
    end = F.length("head") + F.length("body") + len(CLOSE) + 1
    before = Window.partitionBy("tree", "rank").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.withColumn("stop", F.sum(end).over(before) - (len(CLOSE) + 1))
    listed = placed.groupBy("tree", "rank").agg(F.sort_array(F.collect_list(F.struct(
        "position", F.concat("head", "body", F.lit(f"{CLOSE}\n")).alias("turn"), "trained",
        F.struct((F.col("stop") - F.length("body")).alias("start"), "stop").alias("span")))).alias("turns"))
    return listed.select(
        "tree", "rank", F.size("turns").cast("long").alias("n_turns"), F.array_join("turns.turn", "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: t["span"]).alias("loss_spans"))


def chains(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Plain conversations as trees without branches: each row answers the one before it.

    Columns tree, node, parent, role, text and a score of 0. Rows stand by turn
    (null first), then role and text, so ties and repeated rows have a fixed place
    and none is lost. The window holds one conversation's rows, as its one row of
    output will.
    """
    order = Window.partitionBy(conv_col).orderBy(turn_col, "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.select(
        F.col(conv_col).alias("tree"), node.alias("node"), "role", "text",
    ).select("*", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"))


def format_trees(
    messages: DataFrame, branches: int = 1, trained_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """The ``branches`` best branches of each tree as formatted conversations.

    ``messages`` has tree, node, parent, score, role and text. A message
    whose parent is missing is a root; a tree may have several, each with its own
    branches. Messages of a null tree or node are ignored.

    ``messages`` is read three times, its texts once: pass a table, or a frame that is staged.
    """
    sound = messages.where(F.col("tree").isNotNull() & F.col("node").isNotNull())
    return format_paths(sound, chosen_paths(sound, branches), trained_roles)
