"""Indicators on request: name families and periods, get columns.

``indicators`` sorts each series once in one task, which is right for many series. A single series
of very many bars would be one task's work, so ``chunked_indicators`` cuts it into chunks of bars,
each led in by as many bars as its outputs reach back; a chunk is then an independent partition.
Recursive families reach back until their memory is below a double's precision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import frames as W
from ..operators.kernels import FAMILY_OF, reach
from ..operators.recursive import RECURSIVE, add_recursive
from ..operators.windowed import FAMILIES, add_windowed
from ..storage import ready_checkpoints

CHUNK_ROWS = 200_000


def indicators(bars: DataFrame, wanted: dict[str, list[int]]) -> DataFrame:
    """``bars`` with a column per wanted family or output and period.

    Recursive families and outputs run in one grouped Arrow pass, the others as window expressions.
    """
    recursive = {f: ps for f, ps in wanted.items() if f in RECURSIVE}
    windowed = {f: ps for f, ps in wanted.items() if f in FAMILIES}
    if unknown := set(wanted) - set(recursive) - set(windowed):
        known = sorted({*FAMILIES, *RECURSIVE})
        hint = {u: FAMILY_OF[u] for u in unknown if u in FAMILY_OF}
        raise ValueError(f"unknown families {sorted(unknown)}; known: {', '.join(known)}" + (f"; outputs belong to {hint}" if hint else ""))
    columns, out = list(bars.columns), bars
    if recursive:
        out = add_recursive(out, recursive)
    if windowed:
        before = set(out.columns)
        helpers = set(W.with_bars(out).columns) - before
        out = add_windowed(out, windowed)
        out = out.drop(*helpers)
    return out.select(*columns, *(c for c in out.columns if c not in columns))


def numbered(bars: DataFrame, partitions: int) -> DataFrame:
    """Adds rn and n without a task that sees a whole series: a range sort, and offsets of its runs."""
    ready_checkpoints(bars.sparkSession)
    order = [*W.KEYS, W.ORDER]
    df = bars.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    df = df.withColumn("_run", F.shiftright("_at", 33))
    runs = df.groupBy(*W.KEYS, "_run").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    w = Window.partitionBy(*W.KEYS)
    so_far = w.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"_before": F.coalesce(F.sum("_rows").over(so_far), F.lit(0)), "n": F.sum("_rows").over(w)}).drop("_rows")
    out = df.join(runs, [*W.KEYS, "_run"])
    return out.withColumn("rn", F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_at", "_run", "_first", "_before")


def overlapping(df: DataFrame, chunk_rows: int, reach: int) -> DataFrame:
    """Rows with their chunk; the ``reach`` rows before a chunk also stand, not its own, before it."""
    own = F.floor((F.col("rn") - 1) / chunk_rows).cast("long")
    last = F.least(F.floor((F.col("rn") - 1 + reach) / chunk_rows), F.floor((F.col("n") - 1) / chunk_rows)).cast("long")
    return df.withColumn("_chunk", F.explode(F.sequence(own, last))).withColumn("_own", F.col("_chunk") == own)


def with_obv(df: DataFrame, chunk_rows: int) -> DataFrame:
    """Numbered bars with their on-balance volume: sums within chunks on the sums of the chunks before."""
    keys = (*W.KEYS, "_chunk")
    with W.partitioned_by(*keys):
        d = overlapping(df, chunk_rows, 1)
        change = F.col("close") - F.lag("close").over(W.base())
        d = d.withColumn("_signed", F.coalesce(F.signum(change) * F.col("volume"), F.lit(0.0))).where("_own")
        sums = d.groupBy(*keys).agg(F.sum("_signed").alias("_sum"))
        before = Window.partitionBy(*W.KEYS).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_base"))
        d = d.withColumn("_inside", F.sum("_signed").over(W.so_far())).join(sums, list(keys))
        return d.withColumn("obv_line", F.col("_base") + F.col("_inside")).drop("_chunk", "_own", "_signed", "_inside", "_base")


def chunked_indicators(bars: DataFrame, wanted: dict[str, list[int]], chunk_rows: int = CHUNK_ROWS, partitions: int | None = None) -> DataFrame:
    """As ``indicators``, in chunks of bars. Chunks are at least three times the longest period of a
    recursive family, as some have no values in series shorter than that."""
    recursive = {f: ps for f, ps in wanted.items() if f in RECURSIVE}
    windowed = {f: ps for f, ps in wanted.items() if f in FAMILIES}
    if unknown := set(wanted) - set(recursive) - set(windowed):
        raise ValueError(f"unknown families {sorted(unknown)}")
    if chunk_rows < (least := 3 * max((p for ps in recursive.values() for p in ps), default=0) + 1):
        raise ValueError(f"chunks of {chunk_rows} rows; these periods need {least}")
    columns = list(bars.columns)
    df = numbered(bars, partitions or int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys, made = (*W.KEYS, "_chunk"), []
    if recursive:
        lead = max(reach(f, p) for f, ps in recursive.items() for p in ps)
        df = add_recursive(overlapping(df, chunk_rows, lead), recursive, keys).drop("_chunk", "_own")
        made += [f"{f}_{p}" for f, ps in recursive.items() for p in ps]
    if not windowed:
        return df.select(*columns, *made)
    if {"obv_line", "obv_sma"} & set(windowed):
        df = with_obv(df, chunk_rows)
    made += ["obv_line"] * ("obv_line" in windowed)
    with W.partitioned_by(*keys):
        base = W.with_bars(overlapping(df, chunk_rows, max(reach(f, p) for f, ps in windowed.items() for p in ps)))
        wide = add_windowed(base, windowed)
    made += [c for c in wide.columns if c not in base.columns and not c.startswith("_")]
    return wide.where("_own").select(*columns, *made)
