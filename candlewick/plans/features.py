"""The feature table in packed form.

One row per series, bar and period with ``values``, an array of that period's outputs in schema
order. 40 outputs x 196 periods would be 7,840 columns; packed, they are 196 rows that any grouped
aggregate can read, tasks split by (series, period), and nothing wide exists before export.

A feature's index is ``1 + (period - min) * outputs + place``; 0 is ``obv_line``, which has no period
and is packed under period 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructType

from ..functions.frames import KEYS, ORDER
from ..functions.scalars import price
from ..operators import kernels
from ..operators.recursive import series_of
from ..shipping import ship
from .indicators import numbered, overlapping, with_obv

MIN_PERIOD, MAX_PERIOD = 5, 200


@dataclass(frozen=True)
class FeatureSpace:
    """Which outputs over which periods; names and indices follow schema order (period-major)."""

    periods: tuple[int, ...] = tuple(range(MIN_PERIOD, MAX_PERIOD + 1))
    outputs: tuple[str, ...] = tuple(kernels.ORDER)
    obv: bool = True

    def names(self) -> list[str]:
        return (["obv_line"] if self.obv else []) + [f"{o}_{p}" for p in self.periods for o in self.outputs]

    def index(self) -> dict[str, int]:
        return {name: i for i, name in enumerate(self.names())}

    def locate(self, name: str) -> tuple[int, int]:
        """(period, place in ``values``) of a feature."""
        if name == "obv_line":
            return 0, 0
        family, _, period = name.rpartition("_")
        return int(period), self.outputs.index(family)

    def index_of(self, period: Column, place: Column) -> Column:
        """The index from period and place, as an expression."""
        at = F.array_position(F.array(*map(F.lit, self.periods)), period) - 1
        value = at * len(self.outputs) + place + int(self.obv)
        return F.when(period == 0, F.lit(0)).otherwise(value).cast("int")

    def name_at(self, index: Column) -> Column:
        """The name from the index, as an expression."""
        k, at = len(self.outputs), index - int(self.obv)
        family = F.element_at(F.array(*map(F.lit, self.outputs)), (F.pmod(at, F.lit(k)) + 1).cast("int"))
        period = F.element_at(F.array(*map(F.lit, self.periods)), (F.floor(at / k) + 1).cast("int"))
        return F.when(at < 0, F.lit("obv_line")).otherwise(F.concat_ws("_", family, period.cast("string")))

    def name_of(self, period: Column, place: Column) -> Column:
        families = F.array(*map(F.lit, self.outputs))
        return F.when(period == 0, F.lit("obv_line")).otherwise(F.concat_ws("_", F.element_at(families, place.cast("int") + 1), period.cast("string")))


#: Numbers in one Arrow list array, whose offsets have 32 bits.
LIST_NUMBERS = 1 << 30


def packed_features(bars: DataFrame, space: FeatureSpace, chunk_rows: int | None = None) -> DataFrame:
    """instrument, timeframe, timestamp, rn, close, period, values.

    A task has one period of one series, or with ``chunk_rows`` of one chunk of a series (led in by the
    bars that its outputs reach back to), so that no task grows with a series' length.
    """
    ship(bars.sparkSession)
    periods = (0,) * space.obv + tuple(space.periods)
    kinds = {f.name: f.dataType for f in bars.schema.fields}
    schema = StructType()
    for c in (*KEYS, ORDER):
        schema = schema.add(c, kinds[c])
    schema = schema.add("rn", LongType()).add("close", DoubleType()).add("period", IntegerType()).add("values", ArrayType(DoubleType(), True))
    outputs = space.outputs

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(ORDER, "ascending")])
        s, p, n = series_of(table), table.column("period")[0].as_py(), table.num_rows
        if chunk_rows:
            s.obv = table.column("obv_line").to_numpy()
        results = list((s.outputs(outputs, p) if p else s.obv_line()).values())
        first = table.column("_own").to_pylist().index(True) if chunk_rows else 0
        k = len(results)
        flat = np.column_stack([v[first:] for v, _ in results])
        unknown = ~np.column_stack([known[first:] for _, known in results])
        numbers = table.column("rn").to_numpy()[first:] if chunk_rows else np.arange(1, n + 1, dtype=np.int64)
        lists, step = [], max(1, LIST_NUMBERS // k)
        for at in range(0, n - first, step):
            v, u = flat[at : at + step], unknown[at : at + step]
            lists.append(pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, k, dtype=np.int32)), pa.array(v.ravel(), type=pa.float64(), mask=u.ravel())))
        kept = [table.column(c).slice(first) for c in (*KEYS, ORDER)]
        made = [pa.array(numbers), table.column("close").slice(first), pa.array(np.full(n - first, p, dtype=np.int32)), pa.chunked_array(lists)]
        return pa.Table.from_arrays([*kept, *made], names=[f.name for f in schema.fields])

    keys, more = KEYS, []
    if chunk_rows:
        if chunk_rows < (least := 3 * max(space.periods, default=0) + 1):
            raise ValueError(f"chunks of {chunk_rows} rows; these periods need {least}")
        lead = max((kernels.reach(o, p) for o in outputs for p in space.periods), default=1)
        bars = numbered(bars, int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        bars = overlapping(with_obv(bars, chunk_rows), chunk_rows, lead)
        keys, more = (*KEYS, "_chunk"), ["rn", "obv_line", "_chunk", "_own"]
    fanned = bars.select(*KEYS, ORDER, "open", "high", "low", "close", "volume", *more, F.explode(F.array(*map(F.lit, periods))).alias("period"))
    return fanned.groupBy(*keys, "period").applyInArrow(run, schema)


def cells(packed: DataFrame, space: FeatureSpace, named: bool = True) -> DataFrame:
    """One row per bar and feature: ..., period, place, idx, value, and with ``named`` the feature's name.
    Plans that group them go by idx and name what is left (``FeatureSpace.name_at``)."""
    e = packed.select(*KEYS, ORDER, "rn", "close", "period", F.posexplode("values").alias("place", "value"))
    e = e.withColumn("idx", space.index_of(F.col("period"), F.col("place")))
    return e.withColumn("feature", space.name_of(F.col("period"), F.col("place"))) if named else e


def complete_rows(packed: DataFrame, partitions: int | None = None) -> DataFrame:
    """Bars of which no feature is null (NaN is a value): keys, timestamp, rn, close, clean_rn.

    A task numbers a whole series; with ``partitions``, a range sort into as many does instead."""
    from pyspark.sql import Window

    whole = F.forall("values", lambda v: v.isNotNull())
    rows = packed.groupBy(*KEYS, ORDER, "rn").agg(F.min("close").alias("close"), F.bool_and(whole).alias("ok")).where("ok").drop("ok")
    if partitions:
        return numbered(rows.withColumnRenamed("rn", "_bar"), partitions).drop("n").withColumnsRenamed({"rn": "clean_rn", "_bar": "rn"})
    return rows.withColumn("clean_rn", F.row_number().over(Window.partitionBy(*KEYS).orderBy("rn")).cast("long"))


def null_row_filter(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of a wide table without a null in ``columns`` (all if none are given); NaN is kept."""
    ok = F.lit(True)
    for c in columns or df.columns:
        ok = ok & F.col(c).isNotNull()
    return df.where(ok)


def next_return(df: DataFrame, order: str = ORDER, numbers: bool = False) -> DataFrame:
    """Adds ``target``: the return to the next row of the series, of closes as the base table has them
    (five decimals); rows with a zero close or no next row get null. Apply it after filtering.

    With ``numbers``, ``order`` counts a series' rows by one, and a row meets the next by a join on it,
    so that no task sorts a whole series."""
    from pyspark.sql import Window

    close = price(F.col("close")).cast("double")
    if numbers:
        df = df.join(df.select(*KEYS, (F.col(order) - 1).alias(order), close.alias("_next")), [*KEYS, order], "left")
        following = F.col("_next")
    else:
        following = F.lead(close).over(Window.partitionBy(*KEYS).orderBy(order))
    return df.withColumn("target", F.when(close != 0, (following - close) / F.when(close != 0, close))).drop("_next")


def wide_features(packed: DataFrame, names: Sequence[str], space: FeatureSpace) -> DataFrame:
    """The named features as columns: one grouped aggregate, reading only their periods."""
    where = {n: space.locate(n) for n in names}
    rows = packed.where(F.col("period").isin(sorted({p for p, _ in where.values()})))
    picks = [F.max(F.when(F.col("period") == p, F.get("values", F.lit(i)))).alias(n) for n, (p, i) in where.items()]
    return rows.groupBy(*KEYS, ORDER, "rn").agg(F.min("close").alias("close"), *picks)
