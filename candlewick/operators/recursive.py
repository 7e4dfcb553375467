"""Recursive families as a grouped Arrow operator: one pass over each series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructType

from ..functions.frames import KEYS, ORDER
from ..shipping import ship
from . import kernels

#: Families that carry state from bar to bar, which no finite frame reproduces.
RECURSIVE = ("ema", "smma", "dema", "tema", "trix", "rsi", "sm_rsi", "atr", "adx", "pdi", "mdi", "fi")


def series_of(table: pa.Table) -> kernels.Series:
    return kernels.Series(*(table.column(c).to_numpy().astype(float) for c in ("open", "high", "low", "close", "volume")))


def nullable(result: kernels.Result) -> pa.Array:
    """Arrow doubles: unknown values are null, NaN stays NaN."""
    return pa.array(np.ascontiguousarray(result[0]), type=pa.float64(), mask=~result[1])


def add_recursive(bars: DataFrame, wanted: dict[str, list[int]], keys: Sequence[str] = KEYS) -> DataFrame:
    """``bars`` with a column per wanted output and period; every series (or what ``keys`` tell apart)
    is one group. Of groups with a column ``_own``, the rows where that is false only lead in."""
    ship(bars.sparkSession)
    names = [(f, p) for f, ps in wanted.items() for p in ps]
    schema = StructType(list(bars.schema.fields))
    for f, p in names:
        schema = schema.add(f"{f}_{p}", DoubleType(), True)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(ORDER, "ascending")])
        s = series_of(table)
        by_period: dict[int, tuple[str, ...]] = {}
        for f, p in names:
            by_period[p] = (*by_period.get(p, ()), f)
        done = {p: s.outputs(fs, p) for p, fs in by_period.items()}
        for f, p in names:
            table = table.append_column(f"{f}_{p}", nullable(done[p][f]))
        return table.filter(table.column("_own")) if "_own" in table.column_names else table

    return bars.groupBy(*keys).applyInArrow(run, schema)
