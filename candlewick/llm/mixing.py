"""Mixing sources to target weights along a time-varying curriculum.

Sources, by code point with null last, get the weights 5, 2, 1, repeating. Targets share all words
by weight, up to 3 times a source's own words, the excess going to the others by weight: each
target is ``min(level * weight, 3 * size)`` for the one level at which they add up.

Within a source, documents are laid end to end in the order of the md5 of their id, again and
again; a copy is taken if its middle lies before the target. So what is taken ends within half a
document of the target, and no document is taken more than 3 times.

Each weight moves over the curriculum: the demand rate of a source at time x in [0, 1] is
``1 + slope * (2x - 1)``, whose integral is ``x + slope * (x*x - x)``. A copy at fraction q of its
source's target gets the position x at which that integral is q. Documents are then range-sorted
by position.

Order within a source comes from sums over hash slices, so no task reads a whole source: the words
before a document are those of earlier slices plus those before it in its slice.

``mix_report`` writes the mix in training order, reads it back and says per document what it holds.

Defined cases: null text has size 0; documents of size 0 are never taken; a null source is a source of its own, the last; rows repeating a
doc_id are laid one after the other, by a digest of all their columns, and each is taken and counted by itself; an empty
table gives no rows; other columns are kept by ``mix`` and ignored by ``schedule``, but for that order, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Slopes of the demand rate, in turn as the weights: early, even and late sources.
SLOPES = (-0.5, 0.0, 0.5)
WORD = r"[^\x20\x09-\x0D]+"
#: Timestamps to the microsecond.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Documents that one hash slice of a source holds on average.
SLICE_ROWS = 4000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, slot, target from (source, source_size): one row per source, in one task."""
    everything = Window.partitionBy(F.lit(0))
    t = totals.withColumn("slot", (F.row_number().over(Window.orderBy(F.encode(F.col("source"), "UTF-8").asc_nulls_last())) - 1) % len(weights))
    t = t.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("slot") + 1).cast("double"))
    t = t.withColumn("cap", F.col("source_size").cast("double") * max_repeats).withColumn("full_at", F.col("cap") / F.col("weight"))
    filled = Window.orderBy("full_at", F.encode(F.col("source"), "UTF-8").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("total", F.sum("source_size").over(everything).cast("double")).withColumn("all_weight", F.sum("weight").over(everything))
    # the level if exactly the sources before this one are full
    rest = F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    t = t.withColumn("try", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / rest)
    # it is right for the first source that it does not fill; for later ones it only falls
    t = t.withColumn("level", F.max(F.when(F.col("try") <= F.col("full_at"), F.col("try"))).over(everything))
    target = F.least(F.coalesce("level", F.col("full_at")) * F.col("weight"), F.col("cap"))
    return t.select("source", "source_size", "slot", target.alias("target"))


def invert(q: Column, slope: Column) -> Column:
    """x in [0, 1] with x + slope * (x*x - x) = q."""
    b = F.lit(1.0) - slope
    root = F.sqrt(F.greatest(b * b + F.lit(4.0) * slope * q, F.lit(0.0)))
    return F.when(slope == 0.0, q).otherwise(F.lit(2.0) * q / F.greatest(b + root, F.lit(1e-12)))


def id_hash(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def row_key(docs: DataFrame) -> Column:
    """A digest of all columns: rows that share it are copies of one another."""
    rest = F.to_json(F.struct(*(docs[c] for c in docs.columns if c != "text")), JSON)
    text = F.coalesce(F.md5(docs["text"].cast("binary")), F.lit("-"))
    return F.unhex(F.md5(F.concat(text, F.md5(rest.cast("binary"))).cast("binary")))


def _placed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``schedule`` with their source, ``h`` (id_hash), ``key`` (row_key) and ``start``: the words before
    a row in its source, which tell rows of one source apart where they have words."""
    d = docs.select("doc_id", docs["source"].cast("string").alias("source"), word_count(docs["text"]).alias("size"), row_key(docs).alias("key"))
    d = d.withColumn("h", id_hash(F.col("doc_id")))
    d = scratch.cut(d.withColumn("cell", F.conv(F.substring("h", 1, 8), 16, 10).cast("long")), "sizes")
    per_source = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = targets(per_source.drop("n")).join(per_source.select(F.col("source").alias("n_source"), F.ceil(F.col("n") / SLICE_ROWS).alias("slices")), F.col("source").eqNullSafe(F.col("n_source")))
    plan = scratch.cut(plan.drop("n_source").withColumnsRenamed({"source": "p_source"}), "plan")
    d = d.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
    d = d.withColumn("slice", F.floor(F.col("cell") * F.col("slices") / F.lit(1 << 32)).cast("long"))
    slices = d.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    base = F.coalesce(F.sum("slice_size").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = slices.select(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"), base.alias("base"))
    within = Window.partitionBy("source", "slice").orderBy("h", "doc_id", "size", "key").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    d = d.join(slices, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
    d = d.withColumn("start", F.col("base") + F.col("before"))
    middle = [(F.col("start") + k * F.col("source_size")).cast("double") + F.col("size") / F.lit(2.0) for k in range(MAX_REPEATS)]
    taken = [F.when((F.col("size") > 0) & (m <= F.col("target")), 1).otherwise(0) for m in middle]
    slope = F.element_at(F.array(*map(F.lit, SLOPES)), F.col("slot") + 1)
    positions = F.array(*(F.when(x == 1, invert(m / F.greatest(F.col("target"), F.lit(1e-12)), slope)) for x, m in zip(taken, middle, strict=True)))
    d = d.withColumn("copies", sum(taken[1:], taken[0]).cast("long")).withColumn("positions", F.filter(positions, lambda x: x.isNotNull()))
    return d.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "positions", "source", "h", "key", "start")


def schedule(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken, copies, positions (one per copy)."""
    return _placed(docs, scratch or Scratch(docs.sparkSession, "mix")).drop("source", "h", "key", "start")


def _in_order(docs: DataFrame, placed: DataFrame, scratch: Scratch) -> DataFrame:
    """The mix, range-sorted by training position, with ``mix_at__`` (that position) and ``mix_start__`` (its row's start)."""
    spark = docs.sparkSession
    spots = F.transform("positions", lambda p: F.struct(p.alias("at"), F.col("start").alias("start")))
    plan = placed.where("copies > 0").groupBy(F.col("key").alias("mix_plan_key__")).agg(F.flatten(F.collect_list(spots)).alias("mix_spots__"))
    # what a source gives is the first of its rows by hash: texts after the last one stay where they are
    last = scratch.cut(placed.where("copies > 0").groupBy(F.col("source").alias("mix_source__")).agg(F.max("h").alias("mix_last__")), "last")
    within = docs["source"].cast("string").eqNullSafe(F.col("mix_source__")) & (id_hash(docs["doc_id"]) <= F.col("mix_last__"))
    # of rows that are copies of one another, one stands for all, at the positions of all
    keyed = docs.where(docs["text"].rlike(WORD)).join(last, within, "left_semi").withColumn("mix_key__", row_key(docs))
    keyed = keyed.withColumn("mix_nth__", F.row_number().over(Window.partitionBy("mix_key__").orderBy("mix_key__"))).where("mix_nth__ = 1")
    out = keyed.join(plan, F.col("mix_key__") == F.col("mix_plan_key__"))
    out = out.select(*(keyed[c] for c in docs.columns), "mix_key__", F.explode("mix_spots__").alias("mix_spot__"))
    out = out.withColumn("mix_at__", F.col("mix_spot__.at")).withColumn("mix_start__", F.col("mix_spot__.start")).drop("mix_spot__")
    order = ("mix_at__", "doc_id", "mix_key__")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("mix_key__")


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken, range-sorted by training position."""
    scratch = Scratch(docs.sparkSession, "mix")
    placed = scratch.cut(_placed(docs, scratch), "placed")
    return _in_order(docs, placed, scratch).drop("mix_at__", "mix_start__")


def mix_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, and of the mix, written in training
    order and read back: taken (the words of its copies there) and first_position (null if none)."""
    scratch = Scratch(docs.sparkSession, "mix")
    placed = scratch.cut(_placed(docs, scratch), "placed")
    mixed = scratch.cut(_in_order(docs, placed, scratch), "mix")
    held = mixed.groupBy(mixed["source"].cast("string").alias("h_source"), F.col("mix_start__").alias("h_start"))
    held = held.agg(F.sum(word_count(mixed["text"])).alias("words"), F.min("mix_at__").alias("first_position"))
    held = scratch.cut(held, "held")
    scratch.drop("mix")
    same = F.col("source").eqNullSafe(F.col("h_source")) & (F.col("start") == F.col("h_start")) & (F.col("size") > 0)
    return placed.join(held, same, "left").select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken"), "first_position")
