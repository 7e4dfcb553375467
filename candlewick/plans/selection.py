"""The two runs: analyze (choose features) and export (write them)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import KEYS, ORDER
from ..operators import correlation, ranking, screening
from ..sources.candles import BASE_COLUMNS, base_table, bars
from ..sources.sinks import write_feature_list, write_parquet
from ..storage import ready_checkpoints
from .features import FeatureSpace, cells, complete_rows, next_return, packed_features, wide_features

EXPORT_LIMIT = 500


def candidate_columns(schema: Sequence[tuple[str, str]], protected: Sequence[str] = BASE_COLUMNS) -> list[str]:
    """Double columns that are neither protected nor targets, in schema order."""
    return [n for n, kind in schema if kind == "double" and n not in protected and not n.startswith("target_")]


def final_columns(schema: Sequence[str], selected: Sequence[str], protected: Sequence[str] = BASE_COLUMNS) -> list[str]:
    """Protected columns, targets and the selected features, each once, in name order."""
    return sorted({n for n in schema if n in protected or n.startswith("target_")} | set(selected))


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns that exist, in the order of ``names``."""
    have = set(df.columns)
    return df.select(*(n for n in names if n in have))


@dataclass
class Selection:
    selected: list[str]
    columns: list[str]
    quality: DataFrame | None = None
    ranking: DataFrame | None = None
    clusters: dict[str, str] = field(default_factory=dict)
    clean_rows: int = 0


def analyze(candles: DataFrame, space: FeatureSpace | None = None, batch_rows: int = ranking.BATCH_ROWS, threshold: float = correlation.THRESHOLD, top: int | None = None, chunk_rows: int | None = None) -> Selection:
    """Select features for one series of raw candles: screen, cluster, rank. Several series are an error.

    The packed table is checkpointed, as four steps read it. A series without clean rows selects nothing.
    With ``chunk_rows``, no task has more than that of the series (and what its outputs reach back to).
    """
    space = space or FeatureSpace()
    spark = candles.sparkSession
    ready_checkpoints(spark)
    packed = packed_features(bars(candles), space, chunk_rows).checkpoint()
    each = cells(packed, space, named=False)  # a cell has its feature's index; names come after grouping
    quality = screening.screen(each, space.name_at).checkpoint()
    series = [tuple(r) for r in quality.select(*KEYS).distinct().limit(2).collect()]
    if len(series) > 1:
        raise ValueError(f"features are selected for one series at a time; these are of {series}")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) if chunk_rows else None
    clean = complete_rows(packed, parts).checkpoint()
    n = clean.count()
    if not n:
        return Selection([], [], quality)
    kept = quality.where("kept").groupBy("idx", "feature").agg(((F.min("min") + F.max("max")) / 2).alias("middle")).orderBy("idx").collect()
    names = [r.feature for r in kept]
    where = spark.createDataFrame([(r.idx, k) for k, r in enumerate(kept)], "idx int, rank int")
    clean_cells = each.join(clean.select("instrument", "timeframe", "rn", "clean_rn"), ["instrument", "timeframe", "rn"])
    clusters: dict[str, str] = {}
    chosen = names
    if n > 1 and len(names) > 1:
        r = correlation.pearson(*correlation.gram(correlation.row_vectors(clean_cells, where), len(names), [r.middle or 0.0 for r in kept]))
        chosen, label = correlation.representatives(names, r, threshold)
        clusters = {f: names[i] for f, i in zip(names, label, strict=True)}
    index = space.index()
    left = spark.createDataFrame([(index[f],) for f in chosen], "idx int")
    with_target = next_return(clean, "clean_rn", numbers=bool(chunk_rows)).select("instrument", "timeframe", "rn", "target")
    rows = clean_cells.join(F.broadcast(left), "idx").join(with_target, ["instrument", "timeframe", "rn"])  # no longer than the schema
    ranked = ranking.stability(ranking.batch_correlations(rows, batch_rows)).withColumn("feature", space.name_at(F.col("idx"))).checkpoint()
    k = ranking.target_count(len(chosen)) if top is None else top
    selected = [r.feature for r in ranking.top_features(ranked, k).select("feature", "rank").orderBy("rank").collect()]
    return Selection(selected, final_columns([*BASE_COLUMNS, *space.names()], selected), quality, ranked, clusters, n)


def export_head(candles: DataFrame, columns: Sequence[str], space: FeatureSpace | None = None, limit: int = EXPORT_LIMIT, chunk_rows: int | None = None) -> DataFrame:
    """The first ``limit`` bars, in time order, of which every feature of the space is defined, with
    the base and feature columns named."""
    space = space or FeatureSpace()
    packed = packed_features(bars(candles), space, chunk_rows)
    features = [c for c in columns if c in set(space.names())]
    clean = complete_rows(packed).orderBy(ORDER, "instrument", "timeframe").limit(limit).select("instrument", "timeframe", ORDER)
    on = ["instrument", "timeframe", ORDER]
    out = clean.join(base_table(candles), on)
    if features:
        out = out.join(wide_features(packed, features, space).drop("rn", "close"), on)
    return project(out, columns).orderBy(ORDER)


def export(spark: SparkSession, candles: DataFrame, selection: Selection, folder: str, space: FeatureSpace | None = None, chunk_rows: int | None = None) -> None:
    """Write ``selected_features.txt`` and ``selected_head.parquet`` below ``folder``."""
    write_feature_list(spark, selection.columns, f"{folder}/selected_features.txt")
    write_parquet(export_head(candles, selection.columns, space, chunk_rows=chunk_rows), f"{folder}/selected_head.parquet")


def reports(selection: Selection) -> str:
    """The two ranking tables: 15 by mean, 20 by stability score."""
    from ..sources.sinks import report

    if selection.ranking is None:
        return ""
    return "\n\n".join((report(selection.ranking, "mean", 15), report(selection.ranking, "stability_score", 20)))
