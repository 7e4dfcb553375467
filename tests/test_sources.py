import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.config import Config, checked
from candlewick.functions import scalars as X
from candlewick.sources import candles as C
from candlewick.streaming.indicators import Recurrences, Tail, stream_indicators, stream_outputs
from tests.test_indicators import random_series

ENV = {"CLICKHOUSE_HOST": "h", "CLICKHOUSE_DB": "d", "QUERY_START_DATE": "2024-01-01 00:00:00", "QUERY_END_DATE": "2024-02-01"}


def test_config(tmp_path):
    c = Config.load(ENV)
    assert (c.port, c.user, c.password, c.instrument, c.timeframe) == (9000, "default", "", "EURUSD", "m1")
    (tmp_path / ".env").write_text("# x\nCLICKHOUSE_PORT=1\nexport QUERY_INSTRUMENT='ABC'\n\nCLICKHOUSE_HOST=other\n")
    c = Config.load(ENV, tmp_path / ".env")
    assert (c.host, c.port, c.instrument) == ("h", 1, "ABC") and c.jdbc_url() == "jdbc:clickhouse://h:1/d"
    with pytest.raises(KeyError):
        Config.load({"CLICKHOUSE_HOST": "h"})
    with pytest.raises(ValueError):
        Config.load(ENV | {"QUERY_INSTRUMENT": "a'; drop"})


def test_whitelist():
    assert checked("") == "" and checked("Ünicode-1_2 3:4") == "Ünicode-1_2 3:4"
    for bad in (".", "/", "+", "'", ";"):
        with pytest.raises(ValueError):
            checked(bad)


def test_scalars(spark):
    df = spark.createDataFrame([(1.1,), (0.000005,), (0.000015,), (float("nan"),), (float("inf"),), (None,), (-2.5,)], "v double")
    assert [r.p for r in df.select(X.price(F.col("v")).alias("p")).collect()] == [Decimal(x) for x in ("1.10000", "0.00000", "0.00002", "0", "0", "0", "-2.50000")]
    t = spark.sql("select timestamp'2024-01-01 13:45:10' as ts").select(X.day_of_week(F.col("ts")), X.hour_of_day(F.col("ts")), X.minute_of_hour(F.col("ts"))).first()
    assert tuple(t) == (1, 13, 45)
    assert df.select(X.finite(F.col("v")).alias("f")).where("f").count() == 4


def raw(spark, rows):
    full = [(t, i, "m1", 1.0, 2.0, 0.5, c, 3, 0.1, 0.2, 0.15, 4, 5, 1.25) for t, i, c in rows]
    return spark.createDataFrame(full, "ts long, inst string, tf string, open double, high double, low double, close double, tick_count long, min_spr double, max_spr double, avg_spr double, total_bid_volume long, total_ask_volume long, vwap double")


def test_scan_filter_and_base_table(spark, tmp_path):
    raw(spark, [(1704067200 + 60 * k, i, float(k)) for k in range(10) for i in ("EURUSD", "X")]).write.parquet(str(tmp_path / "c"))
    c = C.read_candles(spark, str(tmp_path / "c"))
    assert tuple(c.columns) == C.RAW_COLUMNS
    part = C.slice_candles(c, "EURUSD", "m1", "2024-01-01 00:02:00", "2024-01-01 00:05:00")
    assert sorted(r.close for r in part.collect()) == [2, 3, 4, 5]  # both ends
    base = C.base_table(part)
    assert tuple(base.columns) == C.BASE_COLUMNS and dict(base.dtypes)["close"] == "decimal(18,5)"
    b = C.bars(part).first()
    assert b.volume == 9.0
    plan = C.slice_candles(C.read_candles(spark, str(tmp_path / "c")), "EURUSD", "m1", "2024-01-01", "2024-01-02")._jdf.queryExecution().toString()
    assert "EqualTo(inst,EURUSD)" in plan and "EqualTo(tf,m1)" in plan
    config = Config("h", "d", "2024-01-01 00:08:00", "2024-01-01 00:30:00")
    assert C.configured_candles(c, config).count() == 2


@pytest.mark.parametrize("wire", [True, False])
def test_jdbc_scan(spark, tmp_path, wire):
    """From the database that Spark brings along: filters and columns go to it, both ends are included."""
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    names = ("inst", "tf", "ts") if wire else ("instrument", "timeframe", "timestamp")
    rows = raw(spark, [(1704067200 + 60 * k, i, float(k)) for k in range(10) for i in ("EURUSD", "X")]).withColumn("unread", F.lit(1))
    (rows if wire else C.long_names(rows)).write.format("jdbc").option("url", url).option("dbtable", "candles").option("user", "app").option("createTableColumnTypes", ", ".join(f"{c} varchar(16)" for c in names[:2])).save()
    config = Config("h", "d", "2024-01-01 00:02:00", "2024-01-01 00:05:00", user="app")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for partitions in (1, 3):
        got = C.read_candles_jdbc(spark, config, partitions=partitions, url=url)
        assert tuple(got.columns) == C.RAW_COLUMNS and sorted(r.close for r in got.collect()) == [2, 3, 4, 5]
        assert got.agg(F.min(F.unix_timestamp("timestamp"))).first()[0] == 1704067320
        plan = got._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters") :].split("]")[0]
        assert all(n in pushed for n in (f"EqualTo({names[0]},EURUSD)", f"EqualTo({names[1]},m1)", f"GreaterThanOrEqual({names[2]},", f"LessThanOrEqual({names[2]},"))
        assert "unread" not in plan and got.rdd.getNumPartitions() == partitions
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    from candlewick.operators.recursive import add_recursive
    from candlewick.queries import candles

    b = C.bars(candles(spark, sf_dir)).withColumn("timestamp", F.col("timestamp").cast("timestamp")).cache()
    cuts = [r[0] for r in b.selectExpr("percentile_approx(timestamp, array(0.3, 0.6))").collect()][0]
    edges = [dt.datetime(1970, 1, 1), *cuts, dt.datetime(2100, 1, 1)]
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        b.where((F.col("timestamp") > F.lit(lo)) & (F.col("timestamp") <= F.lit(hi))).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(b.schema).parquet(str(tmp_path / "in"))
        q = stream_indicators(stream, (5, 14)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(120)
    names = [f"{f}_{p}" for p in (5, 14) for f in ("ema", "smma", "rsi", "atr")]
    got = {(r.instrument, r.timestamp): r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = add_recursive(b, {f: [5, 14] for f in ("ema", "smma", "rsi", "atr")}).collect()
    assert len(got) == len(want)
    for w in want:
        for n in names:
            g = got[w.instrument, w.timestamp][n]
            assert (g is None) == (w[n] is None) and (g is None or g == pytest.approx(w[n], rel=1e-9)), n


def test_recurrences_keep_a_fixed_state():
    r = Recurrences((3,))
    sizes = set()
    for k in range(50):
        out = r.push(k + 1.0, k - 1.0, float(k), 2.0)
        sizes.add(len(r.state()[4]) + len(r.state()[5]))
    assert sizes == {10} and out[0] == 98.0 and out[1] == pytest.approx(48.0)


def test_tail_equals_whole_series():
    """Every output, in micro-batches of uneven size, long after the tail has lost the start."""
    from candlewick.operators import kernels as K

    whole, periods = random_series(900, 7), (3, 5)
    bars = [getattr(whole, c) for c in ("open", "high", "low", "close", "volume")]
    t = Tail({f: periods for f in K.ORDER})
    assert t.lead < 500
    parts, state, at = [], None, 0
    for size in (1, 2, 5, 40, 0, 300, 7, 545):
        t = Tail({f: periods for f in K.ORDER}, state)
        parts.append(t.push(*(x[at : at + size] for x in bars)))
        at, state = at + size, t.state()
        assert all(len(x) <= t.lead for x in state[5:])
    assert at == whole.n and np.allclose(np.concatenate([p[0] for p in parts]), whole.obv)
    ends = np.cumsum([len(p[0]) for p in parts])
    for end, (line, results) in zip(ends, parts, strict=True):  # as a series that ends with the batch
        so_far = K.Series(*(x[:end] for x in bars))
        for (f, p), (got, ok) in zip(t.names, results, strict=True):
            values, known = (x[end - len(line) :] for x in so_far.output(f, p))
            assert np.array_equal(ok, known), (f, p, end)
            assert np.allclose(got[ok], values[known], rtol=1e-9, atol=1e-9, equal_nan=True), (f, p, end)


def test_lasting_nan():
    """ADX of a series that starts flat is NaN for good, also once the tail has forgotten why."""
    flat = np.full(12, 5.0)
    s = random_series(400, 9)
    bars = [np.concatenate((flat, getattr(s, c))) for c in ("open", "high", "low", "close", "volume")]
    t, out = Tail({"adx": (3,)}), []
    for at in range(0, 412, 103):
        out.append(t.push(*(x[at : at + 103] for x in bars))[1][0])
    from candlewick.operators import kernels as K

    values, known = K.Series(*bars).output("adx", 3)
    assert np.array_equal(np.concatenate([o[1] for o in out]), known)
    assert np.array_equal(np.isnan(np.concatenate([o[0] for o in out]))[known], np.isnan(values[known]))


def test_stream_of_all_outputs(spark, tmp_path):
    """Two series in three micro-batches, with bars that come late or twice."""
    schema = "instrument string, timeframe string, timestamp timestamp, open double, high double, low double, close double, volume double"
    wanted = {"tema": (3,), "adx": (4,), "vi_plus": (3,), "median": (4,), "obv_sma": (3,), "cmo": (2,)}
    start, whole = dt.datetime(2024, 1, 1), {"A": random_series(90, 1), "B": random_series(61, 2)}
    rows = {k: [(k, "m1", start + dt.timedelta(minutes=i), *(float(getattr(s, c)[i]) for c in ("open", "high", "low", "close", "volume"))) for i in range(s.n)] for k, s in whole.items()}
    cuts = [rows["A"][:40] + rows["B"][:9], rows["A"][40:41] + rows["A"][10:12], rows["A"][41:] + rows["A"][88:] + rows["B"][9:]]
    for part in cuts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = stream_outputs(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), wanted).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        q.option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination(120)
    got = {(r.instrument, r.rn): r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 151 and got["A", 40].late == 0 and got["A", 41].late == 2 and got["A", 90].late == 4 and got["B", 61].late == 0
    for k, s in whole.items():
        for f, ps in wanted.items():
            values, known = s.output(f, ps[0])
            for i in range(s.n):
                g = got[k, i + 1][f"{f}_{ps[0]}"]
                assert (g is None) == (not known[i]) and (g is None or g == pytest.approx(values[i], rel=1e-9, abs=1e-9, nan_ok=True)), (k, f, i)
    with pytest.raises(ValueError, match="unknown"):
        stream_outputs(spark.createDataFrame([], schema), {"nope": (3,)})
