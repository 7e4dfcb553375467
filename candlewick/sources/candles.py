"""Candle sources: Parquet, JDBC, or bars built from an events table; and the typed base table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import scalars as S
from ..functions.frames import ORDER

#: Wire name -> table name of the columns that a source may rename.
WIRE_NAMES = {"ts": "timestamp", "inst": "instrument", "tf": "timeframe", "min_spr": "min_spread", "max_spr": "max_spread", "avg_spr": "avg_spread"}
RAW_COLUMNS = ("timestamp", "instrument", "timeframe", "open", "high", "low", "close", "tick_count", "min_spread", "max_spread", "avg_spread", "total_bid_volume", "total_ask_volume", "vwap")
PRICE_COLUMNS = ("open", "high", "low", "close", "min_spread", "max_spread", "avg_spread", "vwap")
BASE_COLUMNS = (*RAW_COLUMNS, "time_minute_of_hour", "time_hour_of_day", "time_day_of_week")


def long_names(df: DataFrame) -> DataFrame:
    """Wire names to table names; an integer ``ts`` holds epoch seconds."""
    if dict(df.dtypes).get("ts") in ("int", "bigint"):
        df = df.withColumn("ts", S.epoch_to_timestamp(F.col("ts")))
    return df.withColumnsRenamed({k: v for k, v in WIRE_NAMES.items() if k in df.columns})


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    """The raw columns of Parquet candles; others are never read."""
    return long_names(spark.read.parquet(path)).select(*RAW_COLUMNS)


def read_candles_jdbc(spark: SparkSession, config: Config, table: str = "candles", partitions: int = 1, **options: str) -> DataFrame:
    """The configured series from a JDBC table, with table or wire names; ``options`` go to Spark's reader.

    The four comparisons are made on the stored columns, epoch seconds or timestamps, so the database
    applies them and sends the raw columns of these rows only. With ``partitions`` over 1, that many
    connections read parts of the time range. The database's driver must be on the class path.
    """
    reader = spark.read.format("jdbc").option("url", config.jdbc_url()).option("dbtable", table).option("user", config.user).option("password", config.password).options(**options)
    stored = reader.load()  # the schema only
    time = "ts" if "ts" in stored.columns else ORDER
    kind = dict(stored.dtypes)[time]
    epoch = kind in ("int", "bigint")
    bounds = [F.lit(x).cast("timestamp" if epoch else kind) for x in (config.start, config.end)]
    if epoch:
        bounds = [F.unix_timestamp(x).cast(kind) for x in bounds]
    first, last = spark.range(1).select(*(x.cast("string") for x in bounds)).first()
    if partitions > 1:  # parallel reads by time
        reader = reader.option("partitionColumn", time).option("lowerBound", first).option("upperBound", last).option("numPartitions", str(partitions))
        stored = reader.load()
    inst, tf = ("inst" if "inst" in stored.columns else "instrument"), ("tf" if "tf" in stored.columns else "timeframe")
    rows = stored.where((F.col(inst) == config.instrument) & (F.col(tf) == config.timeframe) & (F.col(time) >= F.lit(first).cast(kind)) & (F.col(time) <= F.lit(last).cast(kind)))
    return long_names(rows).select(*RAW_COLUMNS)


def slice_candles(candles: DataFrame, instrument: str, timeframe: str, start: str, end: str) -> DataFrame:
    """One series, both ends of the time range included; all four are plain comparisons that reach the scan."""
    kind = dict(candles.dtypes)["timestamp"]
    return candles.where(
        (F.col("instrument") == F.lit(instrument)) & (F.col("timeframe") == F.lit(timeframe)) & (F.col("timestamp") >= F.lit(start).cast(kind)) & (F.col("timestamp") <= F.lit(end).cast(kind))
    )


def configured_candles(candles: DataFrame, config: Config) -> DataFrame:
    return slice_candles(candles, config.instrument, config.timeframe, config.start, config.end)


def candles_from_events(events: DataFrame) -> DataFrame:
    """Hourly bars per event type: one grouped aggregate with map-side partials."""
    share = F.lit(0.01) * (F.col("user_id") % 10)
    weight = 1 + F.col("user_id") % 10
    return events.groupBy(F.col("event_type").alias("instrument"), F.lit("h1").alias("timeframe"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp")).agg(
        F.min_by("value", "event_id").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "event_id").alias("close"),
        F.count("*").alias("tick_count"),
        F.min(share).alias("min_spread"),
        F.max(share).alias("max_spread"),
        F.avg(share).alias("avg_spread"),
        F.count(F.when(F.col("user_id") % 2 == 0, 1)).alias("total_bid_volume"),
        F.count(F.when(F.col("user_id") % 2 == 1, 1)).alias("total_ask_volume"),
        (F.sum(F.col("value") * weight) / F.sum(weight)).alias("vwap"),
    )


def base_table(candles: DataFrame) -> DataFrame:
    """The 17 typed base columns: prices as decimal(18,5), calendar columns from the timestamp."""
    ts = F.col("timestamp")
    return candles.select(
        *(S.price(F.col(c).cast("double")).alias(c) if c in PRICE_COLUMNS else F.col(c) for c in RAW_COLUMNS),
        S.minute_of_hour(ts).alias("time_minute_of_hour"),
        S.hour_of_day(ts).alias("time_hour_of_day"),
        S.day_of_week(ts).alias("time_day_of_week"),
    )


def bars(candles: DataFrame) -> DataFrame:
    """What indicators read: keys, raw double prices and volume = bid + ask."""
    return candles.select(
        "instrument", "timeframe", "timestamp", *(F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")), S.total_volume(F.col("total_bid_volume"), F.col("total_ask_volume")).alias("volume")
    )
