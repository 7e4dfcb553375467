"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation several times, each snapshot longer than the last. A rolling hash
runs over the turns of each conversation: the hash of a prefix is the sum of one 120-bit hash per
turn, taken of its position, role and text. A conversation whose whole hash is the hash of a
shorter prefix of another is dropped by an anti-join; of equal conversations the smallest conv_id
stays. The maximal ones are rendered with turn markers.

All steps are DataFrame operations. No step gathers a conversation: turns are range-sorted by
(conv_id, turn, role, text), positions and hashes are sums within a sorted run plus the offsets of
the runs before it, and text is rendered in segments of at most SEGMENT turns.

Defined cases: turns are ordered by turn (null last), then role, then text; rows that repeat are
turns of their own; a null conv_id is one conversation; null role is written as ``unknown`` but
is not equal to that role; null text is empty but not equal to empty text; an empty table gives no
rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

#: The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SEGMENT = 64
_HASH = "decimal(38,0)"


def _half(digest: Column, start: int) -> Column:
    """15 hex digits of a digest as an integer."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")


def _mark(value: Column) -> Column:
    """A text that tells null from every string."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit("-"))


def prefix_hashes(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(turns, hashes): each turn with its position from 1, and (conv, pos, h1, h2) per prefix."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    t = turns.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    ).repartitionByRange(n, F.col("conv").asc_nulls_first(), *order)
    t = t.sortWithinPartitions(F.col("conv").asc_nulls_first(), *order).withColumn("at", F.monotonically_increasing_id())
    t = scratch.cut(t.withColumn("run", F.shiftright("at", 33)), "turns")

    # the place of a run's first turn: a few rows per conversation, one for nearly all
    runs = t.groupBy("conv", "run").agg(F.min("at").alias("first_at"), F.count("*").alias("run_n"))
    w = Window.partitionBy("conv").orderBy("run")
    runs = runs.withColumn("before", F.coalesce(F.sum("run_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    runs = runs.select(F.col("conv").alias("r_conv"), F.col("run").alias("r_run"), "first_at", "before")
    on = F.col("conv").eqNullSafe(F.col("r_conv")) & (F.col("run") == F.col("r_run"))
    pos = t.join(runs, on).select("conv", "run", "at", "role", "text", (F.col("at") - F.col("first_at") + F.col("before") + 1).alias("pos"))

    digest = F.md5(F.concat_ws("\x1f", F.col("pos").cast("string"), _mark(F.col("role")), _mark(F.col("text"))).cast("binary"))
    terms = pos.withColumn("d", digest).select("conv", "run", "pos", _half(F.col("d"), 1).alias("t1"), _half(F.col("d"), 16).alias("t2"))
    terms = scratch.cut(terms, "terms")
    sums = terms.groupBy("conv", "run").agg(F.sum("t1").alias("s1"), F.sum("t2").alias("s2"))
    sums = sums.select(
        F.col("conv").alias("r_conv"),
        F.col("run").alias("r_run"),
        *(F.coalesce(F.sum(s).over(w.rowsBetween(Window.unboundedPreceding, -1)).cast(_HASH), F.lit(0).cast(_HASH)).alias(b) for s, b in (("s1", "b1"), ("s2", "b2"))),
    )
    inside = Window.partitionBy("conv", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = terms.select("conv", "run", "pos", F.sum("t1").over(inside).cast(_HASH).alias("l1"), F.sum("t2").over(inside).cast(_HASH).alias("l2"))
    hashes = local.join(sums, on).select("conv", "pos", (F.col("l1") + F.col("b1")).cast(_HASH).alias("h1"), (F.col("l2") + F.col("b2")).cast(_HASH).alias("h2"))
    return pos, scratch.cut(hashes, "hashes")


def maximal(hashes: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of the conversations that no other one extends."""
    ends = hashes.groupBy("conv").agg(F.max(F.struct("pos", "h1", "h2")).alias("e")).select("conv", F.col("e.pos").alias("n"), F.col("e.h1").alias("h1"), F.col("e.h2").alias("h2"))
    # equal conversations meet in a map-side combined minimum: one row however many copies
    whole = ends.groupBy("n", "h1", "h2").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    inner = hashes.join(ends.select(F.col("conv").alias("e_conv"), F.col("n").alias("e_n")), F.col("conv").eqNullSafe(F.col("e_conv")))
    inner = inner.where("pos < e_n").select(F.col("pos").alias("p_n"), F.col("h1").alias("p_1"), F.col("h2").alias("p_2")).distinct()
    left = whole.join(inner, (F.col("n") == F.col("p_n")) & (F.col("h1") == F.col("p_1")) & (F.col("h2") == F.col("p_2")), "left_anti")
    return left.select(F.col("conv").alias("m_conv"), F.col("n").alias("n_turns"), "n_copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, n_copies, first_turn, last_turn, text: maximal conversations, rendered.

    A conversation of up to SEGMENT turns is one row (part 0); a longer one is the concatenation of
    its parts in order.
    """
    scratch = Scratch(turns.sparkSession, "chats")
    pos, hashes = prefix_hashes(turns, scratch)
    kept = scratch.cut(maximal(hashes), "maximal")
    rows = pos.join(kept, F.col("conv").eqNullSafe(F.col("m_conv")))
    turn = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE + "\n"))
    rows = rows.select("conv", "n_turns", "n_copies", "pos", F.floor((F.col("pos") - 1) / SEGMENT).cast("long").alias("part"), turn.alias("rendered"))
    g = rows.groupBy("conv", "part").agg(
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), F.min("pos").alias("first_turn"), F.max("pos").alias("last_turn"), F.sort_array(F.collect_list(F.struct("pos", "rendered"))).alias("t")
    )
    text = F.array_join(F.transform("t", lambda x: x["rendered"]), "")
    return g.select(F.col("conv").alias("conv_id"), "part", "n_turns", "n_copies", "first_turn", "last_turn", text.alias("text"))
