"""Chat formatting: reply trees become conversations.

Built-in functions only. Messages point to the message they reply to. Jump tables (the
ancestor 1, 2, 4, ... steps above, by repeated self-joins) give every leaf the score of its
path; the best branches of each tree are chosen, and the same tables, read downwards, list
each chosen path's messages: every distance is one sum of powers of two. Joins grow with
the logarithm of the depth and rows with the paths that are written, not with pairs.

Template: `<turn:ROLE>` newline TEXT `</turn>` newline. In roles and texts a backslash is
written `\\b`, `<` is `\\l` and `>` is `\\g`, so no text holds a control string, and a backslash
always begins such a pair, which makes reading back exact. The loss mask covers the
escaped texts of the assistant.

Null texts and roles count as empty. Messages of a tree with equal order are ordered by role
and text, so repeated rows are repeated turns. A null tree is a tree of its own. A reply
to a message that is not there starts a path. Messages that reply to each other in a circle have no
root: the smallest one of the circle becomes it. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.session import stored

ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
OPEN, BETWEEN, CLOSE = "<turn:", ">\n", "</turn>\n"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def chains(rows: DataFrame, tree_col: str = "conv_id", order_col: str = "turn") -> DataFrame:
    """Messages of linear conversations: each replies to the one before."""
    rows = rows.select(
        F.col(tree_col).alias("tree"),
        F.col(order_col).alias("_turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree").orderBy(F.col("_turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    return rows.withColumn("parent", F.when(F.col("message") > 1, F.col("message") - 1)).withColumn("score", F.lit(0.0)).drop("_turn")


def paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """tree, leaf, place, message of every message on the chosen root-to-leaf paths.

    `messages` has tree, message (unique in its tree), parent and score. Branches are ranked by
    the mean score of their messages, ties by the smaller leaf; `branches` bounds how many a
    tree keeps, None keeps all.
    """
    nodes = messages.select("tree", "message", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    here = nodes.select(F.col("tree").alias("t2"), F.col("message").alias("m2"))
    tree, same = F.col("tree"), F.col("tree").eqNullSafe(F.col("t2"))
    nodes = nodes.join(here, same & (F.col("parent") == F.col("m2")), "left")
    nodes = nodes.select("tree", "message", F.col("m2").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("length"))
    jumps = [stored(nodes, "jumps")]
    deepest = jumps[0].count()
    while not jumps[-1].filter("up IS NOT NULL").isEmpty():
        if 2 ** (len(jumps) - 1) > deepest:  # no path is as long
            return paths(_opened(messages, jumps), branches)
        above = jumps[-1].toDF("t2", "m2", "up2", "total2", "length2")
        joined = jumps[-1].filter("up IS NOT NULL").join(above, same & (F.col("up") == F.col("m2")))
        further = joined.select("tree", "message", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"), (F.col("length") + F.col("length2")).alias("length"))
        jumps.append(stored(further.unionByName(jumps[-1].filter("up IS NULL")), "jumps"))
    parents = jumps[0].filter("up IS NOT NULL").select(F.col("tree").alias("t2"), F.col("up").alias("m2")).distinct()
    leaves = jumps[-1].join(parents, same & (F.col("message") == F.col("m2")), "left_anti")
    if branches is not None:
        best = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("length")), "message")
        leaves = leaves.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= branches)
    found = leaves.select(tree, F.col("message").alias("leaf"), "message", F.col("length").alias("place"))
    for k in reversed(range(len(jumps) - 1)):
        # every message goes on, and with it the one 2**k above
        steps = jumps[k].filter("up IS NOT NULL").select(F.col("tree").alias("t2"), F.col("message").alias("m2"), F.col("up"))
        stays = F.struct("message", "place")
        rises = F.struct(F.col("up").alias("message"), (F.col("place") - 2**k).alias("place"))
        both = F.explode(F.when(F.col("up").isNull(), F.array(stays)).otherwise(F.array(stays, rises)))
        found = found.join(steps, same & (F.col("message") == F.col("m2")), "left").select("tree", "leaf", both.alias("at"))
        found = found.select("tree", "leaf", "at.*")
    return found


def _opened(messages: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """`messages`, where the smallest one of every circle replies to none.

    So many steps up, every message without a root has arrived in a circle, and those that were in it
    fill it again.
    """
    same = F.col("tree").eqNullSafe(F.col("t2"))
    inside = jumps[-1].filter("up IS NOT NULL").select(F.col("tree").alias("t2"), F.col("up").alias("m2")).distinct()
    ring = jumps[0].join(inside, same & (F.col("message") == F.col("m2")), "left_semi")
    ring = stored(ring.select("tree", "message", "up", F.least("message", "up").alias("low")), "circles")
    for _ in jumps:  # the smallest of 2, 4, 8, ... messages
        above = ring.toDF("t2", "m2", "up2", "low2")
        ring = ring.join(above, same & (F.col("up") == F.col("m2")))
        ring = stored(ring.select("tree", "message", F.col("up2").alias("up"), F.least("low", "low2").alias("low")), "circles")
    roots = ring.filter("message = low").select(F.col("tree").alias("t2"), F.col("message").alias("m2"))
    found = messages.join(roots, same & (F.col("message") == F.col("m2")), "left")
    return found.withColumn("parent", F.when(F.col("m2").isNull(), F.col("parent"))).drop("t2", "m2")


def conversations(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """tree, leaf, and the conversation's `segments`: pieces of text with their loss mask.

    Concatenated, the pieces are the formatted conversation, `formatted`.
    """
    texts = messages.select(F.col("tree").alias("t2"), F.col("message").alias("m2"), "role", "text")
    listed = paths(messages, branches)
    listed = listed.join(texts, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("message") == F.col("m2")))
    turn = F.struct("place", escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"))
    grouped = listed.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("piece"), loss.alias("loss"))

    def segments(t: Column) -> Column:
        opening = piece(F.concat(F.lit(OPEN), t["role"], F.lit(BETWEEN)), F.lit(False))
        return F.array(opening, piece(t["text"], t["role"] == TRAINED_ROLE), piece(F.lit(CLOSE), F.lit(False)))

    grouped = grouped.select("tree", "leaf", F.flatten(F.transform("turns", segments)).alias("segments"))
    return grouped.withColumn("formatted", F.concat_ws("", "segments.piece"))


def turns(formatted: str) -> Column:
    """Role and text of each turn, read back from a formatted conversation."""
    whole = F.filter(F.split(F.col(formatted), CLOSE), lambda x: x != "")

    def parsed(turn: Column) -> Column:
        cut = F.instr(turn, BETWEEN)
        role = F.substring(turn, len(OPEN) + 1, cut - len(OPEN) - 1)
        text = F.substring(turn, cut + len(BETWEEN), F.length(turn))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(whole, parsed)


def trained_text(segments: str) -> Column:
    """All text under the loss mask."""
    return unescaped(F.concat_ws("", F.transform(F.filter(F.col(segments), lambda s: s["loss"]), lambda s: s["piece"])))
