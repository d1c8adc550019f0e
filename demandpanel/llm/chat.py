"""Conversations of reply trees, formatted for training, in DataFrame expressions alone.

A message may have several replies, so messages form trees. Every message gets pointers to its
ancestors at distances of 1, 2, 4, ... by self-joins, as many as the logarithm of the longest
path. They give the length and the score of the branch that ends in each leaf; branches are
ranked by score, and the paths of the chosen ones are enumerated by the same pointers from the
longest distance down, so that each ancestor is met once. Only ids are joined till then; the
texts follow in one join and one grouping by branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.sources.checkpoints import ensure_checkpoint_dir

START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"

_PART, _LINE, _BEFORE = "__chat_part", "__chat_line", "__chat_before"


def escape(text: Column) -> Column:
    """A text without control strings: one more backslash in each ``<|``, ``<\\|``, and so on."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role on one line and without ``<``."""
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("<", "\\l")):
        role = F.replace(role, F.lit(plain), F.lit(written))
    return role


def unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\")
    parts = F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    parts = F.transform(parts, lambda p: F.replace(p, F.lit("\\l"), F.lit("<")))
    return F.array_join(parts, "\\")


def chains(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Messages of a table of turns: each row replies to the row before it in its conversation.

    ``node, parent, conv_id, role, text, score``. Rows are ordered by turn, then role and text, nulls
    first; repeated rows and rows of one turn all stay. A null id is a conversation like any
    other. The rows of all conversations are put in one line by a range sort and numbered
    through per-partition counts, so no conversation meets in one task, however long.
    """
    ensure_checkpoint_dir(turns.sparkSession)
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        F.col(text).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    # The checkpoint fixes which rows a partition holds: counts and rows must agree.
    line = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_LINE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint()
    )
    # One row a partition: small enough for one task and for a broadcast at any input size.
    counts = line.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
    placed = line.join(F.broadcast(offsets), _PART).select(
        (F.col(_LINE) + F.col(_BEFORE)).alias("node"), "conv_id", "role", "text"
    )
    last = placed.select((F.col("node") + 1).alias("node"), F.col("conv_id").alias("__chat_conv"),
                         F.col("node").alias("__chat_last"))
    same = F.col("__chat_conv").eqNullSafe(F.col("conv_id"))
    return placed.join(last, "node", "left").select(
        "node", F.when(same, F.col("__chat_last")).alias("parent"), "conv_id", "role", "text",
        F.lit(0.0).alias("score"),
    )


def replies(
    messages: DataFrame, conv_id: str = "conv_id", message_id: str = "message_id",
    parent_id: str = "parent_id", role: str = "role", text: str = "text", score: str | None = None,
) -> DataFrame:
    """Messages of a table that names each message's parent.

    ``node`` and ``parent`` are structs of conversation and message. Of rows of one message the least
    by role, text and score holds; a null or NaN score counts as 0; a null parent is none.
    """
    at = lambda c: F.struct(F.col(conv_id).alias("conv"), F.col(c).alias("message"))
    value = F.col(score).cast("double") if score else F.lit(0.0)
    rows = messages.select(
        at(message_id).alias("node"),
        F.struct(
            F.col(role).alias("role"),
            F.col(text).alias("text"),
            F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0)).alias("score"),
            F.when(F.col(parent_id).isNotNull(), at(parent_id)).alias("parent"),
        ).alias("row"),
    )
    one = rows.groupBy("node").agg(F.min("row").alias("row"))
    return one.select("node", "row.parent", F.col("node.conv").alias("conv_id"), "row.role", "row.text", "row.score")


def _pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointers ``node, up`` over 1, 2, 4, ... replies, and ``node, depth, total`` of all nodes
    that a root is above; those in or below a circle of replies are left out."""
    there = nodes.select(F.col("node").alias("up"))
    own = nodes.select("node", F.col("parent").alias("up"), "score")
    known = own.where("up IS NOT NULL").join(there, "up", "left_semi").select("node", "up")
    state = (
        own.drop("up")
        .join(known, "node", "left")
        .select("node", "up", F.lit(1).cast("long").alias("steps"), F.col("score").alias("total"))
        .checkpoint()
    )
    n, jumps = state.count(), []
    while (1 << len(jumps)) <= n:
        open_ = state.where("up IS NOT NULL")
        if open_.isEmpty():
            break
        jumps.append(open_.select("node", "up"))
        above = state.select(
            F.col("node").alias("up"), F.col("up").alias("further"),
            F.col("steps").alias("more_steps"), F.col("total").alias("more"),
        )
        state = (
            open_.join(above, "up")
            .select(
                "node", F.col("further").alias("up"),
                (F.col("steps") + F.col("more_steps")).alias("steps"),
                (F.col("total") + F.col("more")).alias("total"),
            )
            .unionByName(state.where("up IS NULL"))
            .checkpoint()
        )
    done = state.where("up IS NULL").select("node", F.col("steps").alias("depth"), "total")
    return jumps, done


def branches(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """``leaf, conv_id, rank, depth, total, node, place``: the messages of every chosen branch.

    A branch leads from a root to a message without replies, its score is the sum of its
    messages' scores, and ``rank`` counts the branches of a conversation from the highest score down,
    ties by leaf; ``best`` keeps so many of each conversation, None all of them (``rank`` is then
    null). ``place`` counts from 1 at the root. A message whose parent is not in the table is a
    root; messages in or below a circle of replies are in no branch.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    jumps, done = _pointers(nodes)
    parents = nodes.where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = (
        nodes.select("node", "conv_id")
        .join(parents, "node", "left_anti")
        .join(done, "node")
        .select(F.col("node").alias("leaf"), "conv_id", "depth", "total")
    )
    if best is None:
        leaves = leaves.withColumn("rank", F.lit(None).cast("int"))
    else:
        by = Window.partitionBy("conv_id").orderBy(F.desc("total"), "leaf")
        leaves = leaves.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= best)
    walk = leaves.select("leaf", "conv_id", "rank", "depth", "total", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("away"))
    for k in range(len(jumps) - 1, -1, -1):
        here = F.struct("node", "away")
        there = F.struct(F.col("up").alias("node"), (F.col("away") + (1 << k)).alias("away"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, there))
        walk = (
            walk.join(jumps[k], "node", "left")
            .select("leaf", "conv_id", "rank", "depth", "total", F.explode(both).alias("__chat_at"))
            .select("leaf", "conv_id", "rank", "depth", "total", "__chat_at.*")
        )
    return walk.withColumn("place", F.col("depth") - F.col("away")).drop("away")


def format_branches(nodes: DataFrame, best: int | None = None, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``leaf, conv_id, rank, total, n_turns, segments, formatted``: a conversation per branch.

    ``formatted`` is the text of all turns, ``<|im_start|>role``, a new line, the text, ``<|im_end|>``
    and a new line each. Control strings in texts are escaped reversibly (``escape``), and so are
    new lines, backslashes and ``<`` in roles. ``segments`` are ``text, loss`` in order; their texts
    joined are ``formatted``, and those with ``loss`` are the loss mask: the text of each turn of
    ``loss_role``, without what stands around it. A null text or role is empty.

    One value holds one conversation, so the longest must fit in Spark's 2 GB.
    """
    said = nodes.select("node", "role", "text")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        "place",
        F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("head"),
        escape(text).alias("body"),
        (role == loss_role).alias("loss"),
    )
    walk = branches(nodes, best)
    rows = walk.join(said, "node").select("leaf", "conv_id", "rank", "total", turn.alias("turn"))
    turns = F.array_sort(F.collect_list("turn"))
    grouped = rows.groupBy("leaf").agg(
        F.first("conv_id").alias("conv_id"), F.first("rank").alias("rank"),
        F.first("total").alias("total"), turns.alias("__chat_turns"),
    )
    segment = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "__chat_turns",
            lambda t: F.array(
                segment(t["head"], F.lit(False)), segment(t["body"], t["loss"]), segment(F.lit(END), F.lit(False))
            ),
        )
    )
    out = grouped.select(
        "leaf", "conv_id", "rank", "total",
        F.size("__chat_turns").cast("long").alias("n_turns"), segments.alias("segments"),
    )
    return out.withColumn("formatted", F.array_join(F.col("segments")["text"], ""))


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` read back from a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    return F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(
                F.substr(
                    p,
                    F.char_length(F.substring_index(p, "\n", 1)) + 2,
                    F.char_length(p) - F.char_length(F.substring_index(p, "\n", 1)) - 1 - len(END),
                )
            ).alias("text"),
        ),
    )


def read_loss(segments: Column) -> Column:
    """The text under the loss mask, unescaped."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"])), "")
