"""The library's registered queries over the driver tables, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.frames import with_bars
from .operators import correlation, ranking, screening
from .operators.recursive import add_recursive
from .operators.windowed import add_windowed
from .plans.features import FeatureSpace, cells, complete_rows, next_return, null_row_filter, packed_features, wide_features
from .plans.indicators import chunked_indicators
from .plans.selection import analyze, export_head
from .sources.candles import bars, base_table, candles_from_events, slice_candles

PERIODS = (5, 14)
#: The features that selection queries use: small enough to write out in SQL.
SPACE = FeatureSpace(periods=PERIODS, outputs=("sma", "mom", "roc", "env_middle", "donchian_upper", "std_dev"))
#: The features that the queries over every series use: all outputs.
WIDE_SPACE = FeatureSpace(periods=(5, 14, 50, 100))
BATCH_ROWS = 100
SERIES = "click"
EXPORT_COLUMNS = ("close", "instrument", "roc_14", "sma_5", "std_dev_14", "time_day_of_week", "timestamp")

WINDOWED = ("sma", "wma", "vwma", "hma", "env", "obv_line", "obv_sma", "mom", "roc", "cci", "wpr", "cmo", "mfi", "aroon", "donchian", "fcb", "std_dev", "variance", "median", "vi", "cmf")
RECURSIVE = {"ema": ("ema",), "smma": ("smma",), "dema": ("dema",), "tema": ("tema",), "trix": ("trix",), "rsi": ("rsi", "sm_rsi"), "atr": ("atr",), "adx": ("adx", "pdi", "mdi"), "force_index": ("fi",)}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles_from_events(events(spark, sf_dir))


def rounded(name: str) -> Column:
    return (F.round(name, 6) + F.lit(0.0)).alias(name)


def shown(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select("instrument", F.unix_timestamp(F.col("timestamp").cast("timestamp")).alias("ts"), *map(rounded, columns))


def windowed_query(family: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        have = bars(candles(spark, sf_dir))
        out = add_windowed(have, {family: list(PERIODS)})
        fixed = {*have.columns, *with_bars(have).columns}
        names = [c for c in out.columns if c not in fixed and (family != "obv_sma" or c != "obv_line")]
        return shown(out, names)

    return run


def recursive_query(outputs: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = add_recursive(bars(candles(spark, sf_dir)), {o: list(PERIODS) for o in outputs})
        return shown(out, [f"{o}_{p}" for o in outputs for p in PERIODS])

    return run


def candles_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base_table(candles(spark, sf_dir))
    return b.select(*(F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.unix_timestamp(F.col(c).cast("timestamp")).alias("ts") if c == "timestamp" else F.col(c) for c, t in b.dtypes))


def candle_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = slice_candles(candles(spark, sf_dir), SERIES, "h1", "2024-01-02 00:00:00", "2024-01-20 12:00:00")
    return shown(s, ["open", "close"])


def null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = add_windowed(bars(candles(spark, sf_dir)), {"sma": [5], "roc": [14]})
    return shown(null_row_filter(out, ["sma_5", "roc_14"]), ["sma_5", "roc_14"])


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = complete_rows(packed_features(bars(candles(spark, sf_dir)), SPACE))
    return shown(next_return(clean), ["close", "target"])


def all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every output at two periods, packed and unpacked again: count and sum per feature, of values to six decimals."""
    space = FeatureSpace(periods=PERIODS)
    c = cells(packed_features(bars(candles(spark, sf_dir)), space), space)
    return c.groupBy("instrument", "idx", "feature").agg(F.count("value").alias("present"), (F.round(F.sum(F.round("value", 6)), 2) + F.lit(0.0)).alias("total"))


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive and windowed families of every series in chunks of 150 bars."""
    out = chunked_indicators(bars(candles(spark, sf_dir)), {f: list(PERIODS) for f in ("tema", "adx", "obv_sma")}, chunk_rows=150)
    return shown(out, [f"{f}_{p}" for f in ("tema", "adx", "obv_sma") for p in PERIODS])


def chunked_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As all_features, from features packed in chunks of 150 bars."""
    space = FeatureSpace(periods=PERIODS)
    c = cells(packed_features(bars(candles(spark, sf_dir)), space, chunk_rows=150), space)
    return c.groupBy("instrument", "idx", "feature").agg(F.count("value").alias("present"), (F.round(F.sum(F.round("value", 6)), 2) + F.lit(0.0)).alias("total"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(wide_features(packed_features(bars(candles(spark, sf_dir)), SPACE), ["roc_14", "obv_line", "sma_5"], SPACE), ["roc_14", "obv_line", "sma_5"])


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_features(bars(candles(spark, sf_dir)), SPACE)


def p1_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = screening.feature_ranges(cells(_packed(spark, sf_dir), SPACE))
    return r.select("instrument", "idx", "feature", rounded("min"), rounded("max"), "present")


def p1_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screening.screen(cells(_packed(spark, sf_dir), SPACE)).select("instrument", "idx", "feature", "kept", "reason")


def _one_series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(clean cells, packed, names) of one series; the features are all of the space."""
    packed = packed_features(bars(candles(spark, sf_dir)).where(F.col("instrument") == SERIES), SPACE)
    clean = complete_rows(packed).select("instrument", "timeframe", "rn")
    return cells(packed, SPACE).join(clean, ["instrument", "timeframe", "rn"]), packed, SPACE.names()


def p2_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, names = _one_series(spark, sf_dir)
    k = len(names)
    wanted = spark.createDataFrame([(i, i) for i in range(k)], "idx int, rank int")
    r = correlation.pearson(*correlation.gram(correlation.row_vectors(rows, wanted), k))
    d = correlation.distances(r)
    pairs = [(names[i], names[j], float(r[i, j]), float(d[i, j])) for i in range(k) for j in range(i + 1, k)]
    return spark.createDataFrame(pairs, "a string, b string, corr double, dist double").select("a", "b", rounded("corr"), rounded("dist"))


def p2_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, names = _one_series(spark, sf_dir)
    wanted = spark.createDataFrame([(i, i) for i in range(len(names))], "idx int, rank int")
    r = correlation.pearson(*correlation.gram(correlation.row_vectors(rows, wanted), len(names)))
    _, label = correlation.representatives(names, r)
    return spark.createDataFrame([(n, c, c == i) for i, (n, c) in enumerate(zip(names, label, strict=True))], "feature string, cluster int, representative boolean")


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = _packed(spark, sf_dir)
    clean = next_return(complete_rows(packed), "clean_rn").select("instrument", "timeframe", "rn", "clean_rn", "target")
    return ranking.batch_correlations(cells(packed, SPACE).join(clean, ["instrument", "timeframe", "rn"]), BATCH_ROWS)


def p3_batch_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir).select("instrument", "batch_id", "feature", rounded("abs_r"))


def p4_stability_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ranking.stability(_batches(spark, sf_dir))
    return s.select("instrument", "feature", rounded("mean"), rounded("std_dev"), rounded("stability_score"))


def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_features(ranking.stability(_batches(spark, sf_dir)), 3).select("instrument", "feature", "rank")


def export_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = candles(spark, sf_dir).where(F.col("instrument") == SERIES)
    out = export_head(one, EXPORT_COLUMNS, SPACE)
    return out.select("instrument", F.unix_timestamp(F.col("timestamp").cast("timestamp")).alias("ts"), F.col("close").cast("double").alias("close"), "time_day_of_week", *map(rounded, ("roc_14", "sma_5", "std_dev_14")))


def selection_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole analysis of one series: selected features and the columns to export."""
    s = analyze(candles(spark, sf_dir).where(F.col("instrument") == SERIES), SPACE, batch_rows=BATCH_ROWS)
    return spark.createDataFrame([(c, c in set(s.selected)) for c in s.columns], "name string, selected boolean")


def _every_series(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    have = candles(spark, sf_dir)
    names = sorted(r.instrument for r in have.select("instrument").distinct().collect())
    return [(n, have.where(F.col("instrument") == n)) for n in names]


def _matrix(one: DataFrame) -> tuple[list[str], np.ndarray]:
    packed = packed_features(bars(one), WIDE_SPACE)
    clean = complete_rows(packed).select("instrument", "timeframe", "rn")
    names = WIDE_SPACE.names()
    wanted = one.sparkSession.createDataFrame([(i, i) for i in range(len(names))], "idx int, rank int")
    rows = cells(packed, WIDE_SPACE).join(clean, ["instrument", "timeframe", "rn"])
    return names, correlation.pearson(*correlation.gram(correlation.row_vectors(rows, wanted), len(names)))


def p2_corr_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = []
    for series, one in _every_series(spark, sf_dir):
        names, r = _matrix(one)
        d = correlation.distances(r)
        out += [(series, names[i], names[j], float(r[i, j]), float(d[i, j])) for i in range(len(names)) for j in range(i + 1, len(names))]
    return spark.createDataFrame(out, "instrument string, a string, b string, corr double, dist double").select("instrument", "a", "b", rounded("corr"), rounded("dist"))


def p2_clusters_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = []
    for series, one in _every_series(spark, sf_dir):
        names, r = _matrix(one)
        _, label = correlation.representatives(names, r)
        out += [(series, n, int(c), bool(c == i)) for i, (n, c) in enumerate(zip(names, label, strict=True))]
    return spark.createDataFrame(out, "instrument string, feature string, cluster int, representative boolean")


def export_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [export_head(one, EXPORT_COLUMNS, WIDE_SPACE) for _, one in _every_series(spark, sf_dir)]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select("instrument", F.unix_timestamp(F.col("timestamp").cast("timestamp")).alias("ts"), F.col("close").cast("double").alias("close"), "time_day_of_week", *map(rounded, ("roc_14", "sma_5", "std_dev_14")))


def analyze_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = []
    for series, one in _every_series(spark, sf_dir):
        s = analyze(one, WIDE_SPACE, batch_rows=BATCH_ROWS)
        heads = len(set(s.clusters.values()))
        out += [(series, c, c in set(s.selected), heads) for c in s.columns]
    return spark.createDataFrame(out, "instrument string, name string, selected boolean, clusters int")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = (
    {"candles_base": candles_base, "candle_slice": candle_slice}
    | {f: windowed_query(f) for f in WINDOWED}
    | {k: recursive_query(v) for k, v in RECURSIVE.items()}
    | {
        "all_features": all_features,
        "chunked_indicators": chunked,
        "chunked_features": chunked_features,
        "wide_features": wide,
        "null_row_filter": null_rows,
        "next_return": returns,
        "p1_min_max": p1_min_max,
        "p1_duplicates": p1_duplicates,
        "p2_corr": p2_corr,
        "p2_clusters": p2_clusters,
        "p3_batch_corr": p3_batch_corr,
        "p4_stability_rank": p4_stability_rank,
        "top_n": top_n,
        "export_head": export_query,
        "analyze": selection_query,
        "p2_corr_all": p2_corr_all,
        "p2_clusters_all": p2_clusters_all,
        "export_head_all": export_all,
        "analyze_all": analyze_all,
    }
)

# --- the same in SQL ---

_CANDLES = """
c0 AS (
  SELECT event_type AS instrument, 'h1' AS timeframe, date_trunc('hour', ts) AS timestamp, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
    arg_max(value, event_id) AS close, count(*) AS tick_count, min(0.01e0 * (user_id % 10)) AS min_spread, max(0.01e0 * (user_id % 10)) AS max_spread, avg(0.01e0 * (user_id % 10)) AS avg_spread,
    count(*) FILTER (WHERE user_id % 2 = 0) AS total_bid_volume, count(*) FILTER (WHERE user_id % 2 = 1) AS total_ask_volume,
    sum(value * (1 + user_id % 10)) / sum(1 + user_id % 10) AS vwap
  FROM events GROUP BY ALL),
s AS (
  SELECT *, epoch(timestamp)::BIGINT AS ts, (total_bid_volume + total_ask_volume)::DOUBLE AS volume, row_number() OVER w AS rn, count(*) OVER (PARTITION BY instrument) AS n,
    lag(high) OVER w AS ph, lag(low) OVER w AS pl, lag(close) OVER w AS pc FROM c0 WINDOW w AS (PARTITION BY instrument ORDER BY timestamp)),
b AS MATERIALIZED (
  SELECT *, (high + low + close) / 3e0 AS tp, (ph + pl + pc) / 3e0 AS ptp, close - pc AS ch,
    CASE WHEN pc IS NULL THEN 0e0 ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr,
    sum(CASE WHEN pc IS NULL THEN 0 ELSE sign(close - pc) * volume END) OVER (PARTITION BY instrument ORDER BY rn ROWS UNBOUNDED PRECEDING) AS obv FROM s)"""


def _w(p: int, first: int | None = None, last: str = "CURRENT ROW") -> str:
    return f"OVER (PARTITION BY instrument ORDER BY rn ROWS BETWEEN {p - 1 if first is None else first} PRECEDING AND {last})"


def _full(p: int, x: str) -> str:
    return f"CASE WHEN rn >= {p} THEN {x} END"


def _after(p: int, x: str) -> str:
    return f"CASE WHEN rn > {p} THEN {x} END"


def _ratio(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def _weighted(x: str, p: int, w: str) -> str:
    """A weighted mean from a list, independent of the two-sum form."""
    return f"(list_sum(list_transform(list({x}) {w}, lambda v, k: v * k)) / {p * (p + 1) / 2}e0)"


def _windowed_sql(family: str, p: int) -> dict[str, str]:
    w = _w(p)
    avg = lambda x: f"avg({x}) {w}"
    hi, lo = f"max(high) {w}", f"min(low) {w}"
    up, down = f"sum(greatest(ch, 0)) {w}", f"sum(greatest(-ch, 0)) {w}"
    fin, fout = f"sum(CASE WHEN tp > ptp THEN tp * volume ELSE 0 END) {w}", f"sum(CASE WHEN tp < ptp THEN tp * volume ELSE 0 END) {w}"
    place = lambda key: f"((arg_max(rn, struct_pack(v := {key}, r := rn)) {w}) - (rn - {p})) / {p}e0 * 100"
    money = "CASE WHEN high = low THEN 0 ELSE ((close - low) - (high - close)) / nullif(high - low, 0) END * volume"
    half, root = p // 2, max(1, round(p**0.5))
    return {
        "sma": {"sma": _full(p, avg("close"))},
        "wma": {"wma": _full(p, _weighted("close", p, w))},
        "vwma": {"vwma": _full(p, _ratio(f"sum(close * volume) {w}", f"sum(volume) {w}"))},
        "hma": {"hma": f"CASE WHEN rn >= {p - 1 + root} THEN {_weighted(f'raw_{p}', root, _w(root))} END"},
        "env": {f"env_{k}": _full(p, f"{avg('close')} * {m}e0") for k, m in (("upper", 1.025), ("lower", 0.975), ("middle", 1))},
        "obv_sma": {"obv_sma": _full(p, avg("obv"))},
        "mom": {"mom": f"close - lag(close, {p}) OVER (PARTITION BY instrument ORDER BY rn)"},
        "roc": {"roc": f"(close - lag(close, {p}) OVER (PARTITION BY instrument ORDER BY rn)) / nullif(lag(close, {p}) OVER (PARTITION BY instrument ORDER BY rn), 0) * 100"},
        "cci": {"cci": _full(p, f"CASE WHEN dev_{p} = 0 THEN 0 ELSE (tp - mean_{p}) / (0.015e0 * nullif(dev_{p}, 0)) END")},
        "wpr": {"wpr": _full(p, f"coalesce({_ratio(f'{hi} - close', f'({hi}) - ({lo})')}, 0) * -100")},
        "cmo": {"cmo": _after(p, f"{_ratio(f'({up}) - ({down})', f'({up}) + ({down})')} * 100")},
        "mfi": {"mfi": _after(p, f"CASE WHEN {fout} = 0 THEN 100 ELSE 100 - 100 / (1 + {_ratio(fin, fout)}) END")},
        "aroon": {"aroon_up": _full(p, place("high")), "aroon_down": _full(p, place("-low")), "aroon_osc": _full(p, f"{place('high')} - ({place('-low')})")},
        "donchian": {"donchian_upper": _full(p, hi), "donchian_lower": _full(p, lo), "donchian_middle": _full(p, f"(({hi}) + ({lo})) / 2")},
        "fcb": {"fcb_upper": _after(p, f"max(high) {_w(p, p, '1 PRECEDING')}"), "fcb_lower": _after(p, f"min(low) {_w(p, p, '1 PRECEDING')}")},
        "std_dev": {"std_dev": _full(p, f"stddev_pop(close) {w}")},
        "variance": {"variance": _full(p, f"var_pop(close) {w}")},
        "median": {"median": _full(p, f"median(close) {w}")},
        "vi": {k: _after(p, _ratio(f"sum(coalesce(abs({x}), 0)) {w}", f"sum(tr) {w}")) for k, x in (("vi_plus", "high - pl"), ("vi_minus", "low - ph"))},
        "cmf": {"cmf": _full(p, _ratio(f"sum({money}) {w}", f"sum(volume) {w}"))},
    }[family]


def _r(x: str, name: str) -> str:
    return f"round({x}, 6) + 0e0 AS {name}"


def _windowed_query_sql(family: str) -> str:
    if family == "obv_line":
        return f"WITH {_CANDLES} SELECT instrument, ts, {_r('obv', 'obv_line')} FROM b"
    extra, source = "", "b"
    if family == "hma":
        raws = ", ".join(f"CASE WHEN rn >= {p} THEN 2 * {_weighted('close', p // 2, _w(p // 2))} - {_weighted('close', p, _w(p))} END AS raw_{p}" for p in PERIODS)
        extra, source = f", h AS (SELECT *, {raws} FROM b)", "h"
    if family == "cci":
        lists = ", ".join(f"list(tp) {_w(p)} AS tps_{p}, avg(tp) {_w(p)} AS mean_{p}" for p in PERIODS)
        devs = ", ".join(f"list_sum(list_transform(tps_{p}, lambda v: abs(v - mean_{p}))) / {p}e0 AS dev_{p}" for p in PERIODS)
        extra, source = f", g AS (SELECT *, {lists} FROM b), h AS (SELECT *, {devs} FROM g)", "h"
    columns = ", ".join(_r(x, f"{k}_{p}") for p in PERIODS for k, x in _windowed_sql(family, p).items())
    return f"WITH {_CANDLES}{extra} SELECT instrument, ts, {columns} FROM {source}"


def _smooth(name: str, source: str, x: str, p: int, start: int, k: str) -> str:
    """y = y * (1 - k) + x * k, seeded with the mean of p rows from row ``start`` of ``source``."""
    return (
        f"{name} AS (SELECT instrument, {start + p - 1}::BIGINT AS rn, avg({x}) AS y FROM {source} WHERE rn BETWEEN {start} AND {start + p - 1} GROUP BY instrument HAVING count(*) = {p} "
        f"UNION ALL SELECT t.instrument, t.rn, e.y * (1 - {k}) + t.{x} * {k} FROM {name} e JOIN {source} t ON t.instrument = e.instrument AND t.rn = e.rn + 1)"
    )


def _wilder_sum(name: str, x: str, p: int) -> str:
    return (
        f"{name} AS (SELECT instrument, {p + 1}::BIGINT AS rn, sum({x}) AS y FROM v WHERE rn BETWEEN 2 AND {p + 1} GROUP BY instrument "
        f"UNION ALL SELECT t.instrument, t.rn, e.y - e.y / {p} + t.{x} FROM {name} e JOIN v t ON t.instrument = e.instrument AND t.rn = e.rn + 1)"
    )


def _recursive_sql(key: str) -> str:
    ctes, joins, columns = [], [], []
    if key == "atr":
        ctes.append("v AS MATERIALIZED (SELECT *, CASE WHEN pc IS NULL THEN high - low ELSE tr END AS tr0 FROM b)")
    elif key == "rsi":
        ctes.append("v AS MATERIALIZED (SELECT *, greatest(ch, 0) AS gain, greatest(-ch, 0) AS loss FROM b)")
    elif key == "force_index":
        ctes.append("v AS MATERIALIZED (SELECT *, coalesce(ch * volume, 0) AS force FROM b)")
    elif key == "adx":
        ctes.append(
            "v AS MATERIALIZED (SELECT *, CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph ELSE 0 END AS up, "
            "CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low ELSE 0 END AS down FROM b)"
        )
    for p in PERIODS:
        ema, wilder = f"(2e0 / {p + 1}e0)", f"(1e0 / {p}e0)"

        def last(cte: str, expr: str, name: str, p: int = p) -> None:
            joins.append(f"LEFT JOIN {cte} ON {cte}.instrument = b.instrument AND {cte}.rn = b.rn")
            columns.append(_r(expr, f"{name}_{p}"))

        if key in ("ema", "dema", "tema", "smma"):
            ctes.append(_smooth(f"a{p}", "b", "close", p, 1, wilder if key == "smma" else ema))
            if key in ("ema", "smma"):
                last(f"a{p}", f"a{p}.y", key)
            else:
                ctes.append(_smooth(f"d{p}", f"a{p}", "y", p, p, ema))
                if key == "tema":
                    ctes.append(_smooth(f"t{p}", f"d{p}", "y", p, 2 * p - 1, ema))
                ctes.append(
                    f"z{p} AS (SELECT d{p}.instrument, d{p}.rn, 2 * a{p}.y - d{p}.y AS y FROM d{p} JOIN a{p} USING (instrument, rn))"
                    if key == "dema"
                    else f"z{p} AS (SELECT t{p}.instrument, t{p}.rn, 3 * a{p}.y - 3 * d{p}.y + t{p}.y AS y FROM t{p} JOIN d{p} USING (instrument, rn) JOIN a{p} USING (instrument, rn))"
                )
                last(f"z{p}", f"z{p}.y", key)
        elif key == "trix":
            ctes.append(_smooth(f"a{p}", "b", "close", p, 1, ema))
            ctes.append(f"az{p} AS MATERIALIZED (SELECT b.instrument, b.rn, coalesce(a{p}.y, 0) AS y FROM b LEFT JOIN a{p} USING (instrument, rn))")
            ctes.append(_smooth(f"d{p}", f"az{p}", "y", p, 1, ema))
            ctes.append(f"dz{p} AS MATERIALIZED (SELECT b.instrument, b.rn, coalesce(d{p}.y, 0) AS y FROM b LEFT JOIN d{p} USING (instrument, rn))")
            ctes.append(_smooth(f"t{p}", f"dz{p}", "y", p, 1, ema))
            ctes.append(f"z{p} AS (SELECT instrument, rn, (y - lag(y) OVER q) / nullif(lag(y) OVER q, 0) * 100 AS y FROM t{p} WINDOW q AS (PARTITION BY instrument ORDER BY rn))")
            last(f"z{p}", f"CASE WHEN b.n >= {3 * p} THEN z{p}.y END", "trix")
        elif key == "rsi":
            ctes += [_smooth(f"g{p}", "v", "gain", p, 2, wilder), _smooth(f"l{p}", "v", "loss", p, 2, wilder)]
            ctes.append(f"z{p} AS (SELECT instrument, rn, CASE WHEN l.y = 0 THEN 100 ELSE 100 - 100 / (1 + g.y / nullif(l.y, 0)) END AS y FROM g{p} g JOIN l{p} l USING (instrument, rn))")
            last(f"z{p}", f"z{p}.y", "rsi")
            columns.append(_r(f"z{p}.y", f"sm_rsi_{p}"))
        elif key == "atr":
            ctes.append(_smooth(f"a{p}", "v", "tr0", p, 1, wilder))
            last(f"a{p}", f"CASE WHEN b.n > {p} THEN a{p}.y END", "atr")
        elif key == "force_index":
            ctes.append(_smooth(f"a{p}", "v", "force", p, 1, ema))
            last(f"a{p}", f"a{p}.y", "fi")
        elif key == "adx":
            ctes += [_wilder_sum(f"r{p}", "tr", p), _wilder_sum(f"u{p}", "up", p), _wilder_sum(f"d{p}", "down", p)]
            ctes.append(f"q{p} AS (SELECT instrument, rn, 100 * u.y / r.y AS pdi, 100 * d.y / r.y AS mdi FROM r{p} r JOIN u{p} u USING (instrument, rn) JOIN d{p} d USING (instrument, rn) WHERE rn > {p + 1})")
            ctes.append(f"x{p} AS MATERIALIZED (SELECT *, CASE WHEN pdi + mdi = 0 THEN 0 ELSE 100 * abs(pdi - mdi) / nullif(pdi + mdi, 0) END AS dx FROM q{p})")
            ctes.append(_smooth(f"a{p}", f"x{p}", "dx", p, p + 2, wilder))
            guard = lambda e, p=p: f"CASE WHEN b.n >= {2 * p} THEN {e} END"
            last(f"a{p}", guard(f"a{p}.y"), "adx")
            last(f"x{p}", guard(f"x{p}.pdi"), "pdi")
            columns.append(_r(guard(f"x{p}.mdi"), f"mdi_{p}"))
    return f"WITH RECURSIVE {_CANDLES}, {', '.join(ctes)} SELECT b.instrument, b.ts, {', '.join(columns)} FROM b {' '.join(joins)}"


def _features_sql() -> str:
    """f: one row per bar with the features of SPACE; k: one row per bar and feature; g: clean bars."""
    columns = ["obv AS obv_line"] + [f"{_windowed_sql('env' if o.startswith('env') else 'donchian' if o.startswith('donchian') else o, p)[o]} AS {o}_{p}" for p in PERIODS for o in SPACE.outputs]
    names = SPACE.names()
    cells_ = ", ".join(f"{{'idx': {i}, 'feature': '{n}', 'value': {n}::DOUBLE}}" for i, n in enumerate(names))
    clean = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"""{_CANDLES},
f AS MATERIALIZED (SELECT instrument, ts, rn, close, {_half_even('close')} AS shown, {', '.join(columns)} FROM b),
k AS (SELECT instrument, ts, rn, e.idx AS idx, e.feature AS feature, e.value AS value FROM (SELECT instrument, ts, rn, unnest([{cells_}]) AS e FROM f)),
g AS MATERIALIZED (SELECT *, row_number() OVER q AS clean_rn, CASE WHEN shown <> 0 THEN (lead(shown) OVER q - shown) / nullif(shown, 0) END AS target FROM f WHERE {clean} WINDOW q AS (PARTITION BY instrument ORDER BY rn))"""


def _half_even(x: str) -> str:
    """Five decimals, half to even, of the decimal value that a non-negative double shows."""
    y = f"({x}::DECIMAL(28,12) * 100000)"
    return f"((CASE WHEN {y} - floor({y}) > 0.5 OR ({y} - floor({y}) = 0.5 AND floor({y})::BIGINT % 2 = 1) THEN floor({y}) + 1 ELSE floor({y}) END)::BIGINT / 100000e0)"


def _selection_sql() -> dict[str, str]:
    names, head = SPACE.names(), f"WITH {_features_sql()}"
    ranges = "r AS (SELECT instrument, idx, feature, min(value) AS lo, max(value) AS hi, count(value) AS present, list(value ORDER BY rn) AS vs FROM k GROUP BY instrument, idx, feature)"
    reasons = "t AS (SELECT *, CASE WHEN present = 0 THEN 'All Null / Empty' WHEN abs(hi - lo) < 1e-9 THEN 'Zero Variance (Constant Value)' END AS why FROM r)"
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN stddev_samp({a}) * stddev_samp({b}) < 1e-9 THEN 0 ELSE corr({a}, {b}) END AS r FROM g WHERE instrument = '{SERIES}'" for i, a in enumerate(names) for b in names[i + 1 :]
    )
    cells_ = ", ".join(f"{{'idx': {i}, 'feature': '{n}', 'value': {n}::DOUBLE}}" for i, n in enumerate(names))
    batches = f"""{head},
x AS (SELECT instrument, (clean_rn - 1) // {BATCH_ROWS} AS batch_id, target AS y, unnest([{cells_}]) AS e FROM g WHERE target IS NOT NULL),
z AS (SELECT instrument, batch_id, e.idx AS idx, e.feature AS feature, count(*)::DOUBLE AS n, sum(e.value) AS sx, sum(y) AS sy, sum(e.value * e.value) AS sxx, sum(y * y) AS syy, sum(e.value * y) AS sxy FROM x GROUP BY ALL),
d AS (SELECT *, sqrt(greatest((n * sxx - sx * sx) * (n * syy - sy * sy), 0)) AS root FROM z),
h AS (SELECT instrument, batch_id, idx, feature, CASE WHEN n >= 2 AND root > 1e-9 THEN abs((n * sxy - sx * sy) / nullif(root, 0)) ELSE 0 END AS abs_r FROM d),
m AS (SELECT instrument, idx, feature, avg(abs_r) AS mean, stddev_pop(abs_r) AS dev FROM h GROUP BY ALL)"""
    decimals = ", ".join(f"{_half_even(c)} AS {c}" for c in ("open", "high", "low", "close", "min_spread", "max_spread", "avg_spread", "vwap"))
    return {
        "candles_base": f"WITH {_CANDLES} SELECT epoch(timestamp)::BIGINT AS ts, instrument, timeframe, {decimals}, tick_count, total_bid_volume, total_ask_volume, "
        "minute(timestamp)::SMALLINT AS time_minute_of_hour, hour(timestamp)::SMALLINT AS time_hour_of_day, isodow(timestamp)::SMALLINT AS time_day_of_week FROM c0",
        "candle_slice": f"WITH {_CANDLES} SELECT instrument, epoch(timestamp)::BIGINT AS ts, {_r('open', 'open')}, {_r('close', 'close')} FROM c0 WHERE instrument = '{SERIES}' AND timeframe = 'h1' AND timestamp >= TIMESTAMP '2024-01-02 00:00:00' AND timestamp <= TIMESTAMP '2024-01-20 12:00:00'",
        "null_row_filter": f"{head} SELECT instrument, ts, {_r('sma_5', 'sma_5')}, {_r('roc_14', 'roc_14')} FROM f WHERE sma_5 IS NOT NULL AND roc_14 IS NOT NULL",
        "next_return": f"{head} SELECT instrument, ts, {_r('close', 'close')}, {_r('target', 'target')} FROM g",
        "wide_features": f"{head} SELECT instrument, ts, {', '.join(_r(n, n) for n in ('roc_14', 'obv_line', 'sma_5'))} FROM f",
        "p1_min_max": f"{head}, {ranges} SELECT instrument, idx, feature, {_r('lo', 'min')}, {_r('hi', 'max')}, present FROM r",
        "p1_duplicates": f"""{head}, {ranges}, {reasons},
u AS (SELECT *, CASE WHEN why IS NULL THEN arg_min(feature, idx) OVER (PARTITION BY instrument, vs, why IS NULL) END AS first FROM t)
SELECT instrument, idx, feature, why IS NULL AND first = feature AS kept, CASE WHEN why IS NULL AND first <> feature THEN 'Duplicate of ' || first ELSE why END AS reason FROM u""",
        "p2_corr": f"{head}, p AS ({pairs}) SELECT a, b, {_r('greatest(-1, least(1, r))', 'corr')}, {_r('greatest(0, 1 - abs(greatest(-1, least(1, r))))', 'dist')} FROM p",
        "p3_batch_corr": f"{batches} SELECT instrument, batch_id, feature, {_r('abs_r', 'abs_r')} FROM h",
        "p4_stability_rank": f"{batches} SELECT instrument, feature, {_r('mean', 'mean')}, {_r('dev', 'std_dev')}, {_r('mean - dev', 'stability_score')} FROM m",
        "top_n": f"{batches}, o AS (SELECT *, row_number() OVER (PARTITION BY instrument ORDER BY round(mean - dev, 12) DESC, round(mean, 12) DESC, idx) AS rank FROM m) SELECT instrument, feature, rank::INTEGER AS rank FROM o WHERE rank <= 3",
        "export_head": f"{head} SELECT f.instrument, g.ts, {_half_even('g.close')} AS close, isodow(to_timestamp(g.ts) AT TIME ZONE 'UTC')::SMALLINT AS time_day_of_week, "
        f"{', '.join(_r(f'g.{n}', n) for n in ('roc_14', 'sma_5', 'std_dev_14'))} FROM g JOIN f USING (instrument, rn) WHERE g.instrument = '{SERIES}' ORDER BY g.rn LIMIT 500",
    }


def _every_output_sql() -> str:
    """Count and sum per feature and series, from the SQL of the families."""
    outputs = FeatureSpace(periods=PERIODS).names()
    parts = []
    for key in (*WINDOWED, *RECURSIVE):
        sql = _windowed_query_sql(key) if key in WINDOWED else _recursive_sql(key)
        mine = ["obv_line"] if key == "obv_line" else [n for n in outputs if f" + 0e0 AS {n}," in sql or f" + 0e0 AS {n} " in sql]
        cells_ = ", ".join(f"{{'idx': {outputs.index(n)}, 'feature': '{n}', 'v': {n}::DOUBLE}}" for n in mine)
        parts.append(f"SELECT instrument, e.idx AS idx, e.feature AS feature, count(e.v) AS present, round(sum(e.v), 2) + 0e0 AS total FROM (SELECT instrument, unnest([{cells_}]) AS e FROM ({sql})) GROUP BY ALL")
    return " UNION ALL ".join(parts)


def _chunked_sql() -> str:
    names = {k: [f"{k}_{p}" for p in PERIODS] for k in ("tema", "adx", "obv_sma")}
    t, a, o = _recursive_sql("tema"), _recursive_sql("adx"), _windowed_query_sql("obv_sma")
    columns = ", ".join(f"{k}.{n}" for k, ns in names.items() for n in ns)
    return f"SELECT instrument, ts, {columns} FROM ({t}) tema JOIN ({a}) adx USING (instrument, ts) JOIN ({o}) obv_sma USING (instrument, ts)"


ORACLES: dict[str, str] = {"all_features": _every_output_sql(), "chunked_features": _every_output_sql(), "chunked_indicators": _chunked_sql()} | {f: _windowed_query_sql(f) for f in WINDOWED} | {k: _recursive_sql(k) for k in RECURSIVE} | _selection_sql()


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, clean rows, batch correlations and the stability ranking of every series."""
    return p4_stability_rank(spark, sf_dir)

