import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.operators import correlation as C
from candlewick.operators import ranking, screening
from candlewick.plans import features as P
from candlewick.plans import selection as S
from candlewick.queries import candles
from candlewick.sources.candles import bars


def long_cells(spark, columns):
    rows = [("A", "m1", rn, i, n, v) for i, (n, vs) in enumerate(columns.items()) for rn, v in enumerate(vs, 1)]
    return spark.createDataFrame(rows, "instrument string, timeframe string, rn long, idx int, feature string, value double")


def test_screen(spark):
    nan = float("nan")
    cols = {"a": [1.0, 2.0, None], "b": [1.0, 2.0, None], "c": [1.0, 2.0, 3.0], "flat": [5.0] * 3, "flat2": [5.0] * 3, "void": [None] * 3, "nan": [nan] * 3, "d": [2.0, 1.0, None], "zero": [0.0, 1.0, None], "minus": [-0.0, 1.0, None]}
    out = {r.feature: r.reason for r in screening.screen(long_cells(spark, cols)).collect()}
    assert out == {"a": None, "b": "Duplicate of a", "c": None, "flat": screening.CONSTANT, "flat2": screening.CONSTANT, "void": screening.EMPTY, "nan": None, "d": None, "zero": None, "minus": "Duplicate of zero"}


def test_equal_marks_do_not_make_duplicates(spark, monkeypatch):
    cols = {"a": [1.0, 2.0, 4.0], "b": [1.0, 3.0, 4.0], "c": [1.0, 2.0, 4.0]}
    with monkeypatch.context() as m:
        m.setattr(screening.F, "xxhash64", lambda *_: F.lit(7).cast("long"))  # every mark collides
        screened = screening.screen(long_cells(spark, cols))
    assert {r.feature: r.reason for r in screened.collect()} == {"a": None, "b": None, "c": "Duplicate of a"}


def test_names_from_indices(spark):
    for space in (P.FeatureSpace(periods=(5, 9, 200)), P.FeatureSpace(periods=(3,), outputs=("sma", "adx"), obv=False)):
        got = spark.range(len(space.names())).select(space.name_at(F.col("id").cast("int")).alias("n")).orderBy("id").collect()
        assert [r.n for r in got] == space.names()


def greedy_linkage(dist, cut):
    groups = [[i] for i in range(len(dist))]
    while len(groups) > 1:
        d, a, b = min((np.mean([dist[i, j] for i in x for j in y]), a, b) for (a, x), (b, y) in itertools.combinations(enumerate(groups), 2))
        if d > cut:
            break
        groups[a] += groups.pop(b)
    return [min(next(g for g in groups if i in g)) for i in range(len(dist))]


def test_average_linkage_against_greedy():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(2, 14))
        x = rng.random((n, n))
        d = (x + x.T) / 2
        for cut in (0.2, 0.4, 0.6):
            assert C.average_linkage(d, cut) == greedy_linkage(d, cut)


def test_gram_and_pearson(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 3)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 7)) + 1e6
    x[:, 3] = x[:, 0] * 2
    x[:, 4] = 5.0
    df = spark.createDataFrame([("A", "m1", i, row.tolist()) for i, row in enumerate(x)], "instrument string, timeframe string, rn long, x array<double>").repartition(5)
    r = C.pearson(*C.gram(df, 7))
    want = np.corrcoef(x[:, [0, 1, 2, 3, 5, 6]].T)
    keep = [0, 1, 2, 3, 5, 6]
    assert np.allclose(r[np.ix_(keep, keep)], want, atol=1e-6) and (np.delete(r[4], 4) == 0).all()
    names, label = C.representatives([f"f{i}" for i in range(7)], r)
    assert names == ["f0", "f1", "f2", "f4", "f5", "f6"] and label[3] == 0


def test_nan_features_stay_alone():
    r = C.pearson(10, np.array([1.0, np.nan]), np.array([[5.0, np.nan], [np.nan, np.nan]]))
    assert r[0, 1] == 0 and r[1, 0] == 0


def test_ranking(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=250), rng.normal(size=250)
    x[7], y[9] = np.nan, np.inf
    flat = np.ones(250)
    rows = [("A", "m1", i + 1, k, n, float(v[i]), float(y[i])) for k, (n, v) in enumerate((("x", x), ("flat", flat))) for i in range(250)]
    df = spark.createDataFrame(rows, "instrument string, timeframe string, clean_rn long, idx int, feature string, value double, target double")
    got = {(r.feature, r.batch_id): r.abs_r for r in ranking.batch_correlations(df, 100).collect()}
    for b in range(3):
        s = slice(100 * b, min(100 * b + 100, 250))
        ok = np.isfinite(x[s]) & np.isfinite(y[s])
        assert got["x", b] == pytest.approx(abs(np.corrcoef(x[s][ok], y[s][ok])[0, 1])) and got["flat", b] == 0
    history = [got["x", b] for b in range(3)]
    out = {r.feature: r for r in ranking.stability(ranking.batch_correlations(df, 100)).collect()}
    assert out["x"].stability_score == pytest.approx(np.mean(history) - np.std(history)) and (out["x"].rank, out["flat"].rank) == (1, 2)
    assert [ranking.target_count(k) for k in (1, 200, 201, 1000)] == [50, 50, 51, 250]


def test_ties_by_mean_then_index(spark):
    rows = [("A", "m1", b, i, n, v) for i, (n, vs) in enumerate((("p", (0.5, 0.5)), ("q", (0.7, 0.3)), ("r", (0.5, 0.5)), ("s", (0.8, 0.4)))) for b, v in enumerate(vs)]
    r = ranking.stability(spark.createDataFrame(rows, "instrument string, timeframe string, batch_id long, idx int, feature string, abs_r double"), penalty=0.5)
    assert [x.feature for x in r.orderBy("rank").collect()] == ["s", "p", "r", "q"]  # 0.5 three times, s with the greatest mean


def test_names_and_places():
    space = P.FeatureSpace()
    assert len(space.names()) == 7841 and space.names()[0] == "obv_line" and space.names()[1] == "sma_5" and space.names()[-1] == "obv_sma_200"
    assert space.locate("donchian_upper_17") == (17, space.outputs.index("donchian_upper"))


def test_indices_in_the_table(spark, sf_dir):
    space = P.FeatureSpace(periods=(5, 9), outputs=("sma", "rsi"))
    got = {(r.idx, r.feature) for r in P.cells(P.packed_features(bars(candles(spark, sf_dir)), space), space).select("idx", "feature").distinct().collect()}
    assert got == set(enumerate(space.names()))


def test_clean_rows_keep_nan(spark):
    rows = [("A", "m1", i, 10.0, 10.0, 10.0, 10.0, 1.0) for i in range(30)]
    b = spark.createDataFrame(rows, "instrument string, timeframe string, timestamp long, open double, high double, low double, close double, volume double")
    clean = P.complete_rows(P.packed_features(b, P.FeatureSpace(periods=(5,), outputs=("adx", "sma"))))
    assert [(r.rn, r.clean_rn) for r in clean.orderBy("rn").collect()] == [(i + 11, i + 1) for i in range(20)]
    df = spark.createDataFrame([(1.0, None), (float("nan"), 2.0)], "a double, b double")
    assert P.null_row_filter(df).count() == 1 and P.null_row_filter(df, ["a"]).count() == 2


def test_returns_of_rounded_closes(spark):
    """Five decimals, half to even, as the base table has them; what rounds to 0 has no return."""
    df = spark.createDataFrame([("A", "m", i, c) for i, c in enumerate([1.000005, 1.000015, 0.000004, 2.0])], "instrument string, timeframe string, timestamp long, close double")
    got = [r.target for r in P.next_return(df).orderBy("timestamp").collect()]
    assert got == [pytest.approx(0.00002), pytest.approx(-1.0), None, None]


def test_returns_by_number(spark):
    df = spark.createDataFrame([(s, "m1", i + 1, c) for s in "AB" for i, c in enumerate((2.0, 3.0, 0.0, 4.0))], "instrument string, timeframe string, clean_rn long, close double")
    one, other = (sorted(map(tuple, P.next_return(df, "clean_rn", numbers=k).select("instrument", "clean_rn", "target").collect())) for k in (False, True))
    assert one == other and [t for *_, t in one[:4]] == [0.5, -1.0, None, None]


def test_next_return(spark):
    df = spark.createDataFrame([("A", "m1", i, c) for i, c in enumerate((2.0, 3.0, 0.0, 4.0))], "instrument string, timeframe string, timestamp long, close double")
    assert [r.target for r in P.next_return(df).orderBy("timestamp").collect()] == [0.5, -1.0, None, None]


def test_column_lists():
    schema = [("close", "double"), ("sma_5", "double"), ("target_x", "double"), ("adx_10", "double"), ("n", "bigint")]
    assert S.candidate_columns(schema) == ["sma_5", "adx_10"]
    assert S.final_columns([n for n, _ in schema], ["adx_5", "adx_10", "adx_10"]) == ["adx_10", "adx_5", "close", "target_x"]


def test_analyze_and_export(spark, sf_dir, tmp_path):
    space = P.FeatureSpace(periods=(5, 8, 13))
    one = candles(spark, sf_dir).where("instrument = 'click'").cache()
    s = S.analyze(one, space, batch_rows=40)
    reasons = {r.feature: r.reason for r in s.quality.collect()}
    assert all(reasons[f"sm_rsi_{p}"] == f"Duplicate of rsi_{p}" and reasons[f"env_middle_{p}"] == f"Duplicate of sma_{p}" for p in space.periods)
    assert s.selected and set(s.selected) <= set(space.names()) and s.columns == sorted(set(s.columns)) and set(S.BASE_COLUMNS) <= set(s.columns)
    assert all(space.index()[rep] <= space.index()[f] for f, rep in s.clusters.items())
    S.export(spark, one, s, f"file://{tmp_path}", space)
    back = spark.read.parquet(f"file://{tmp_path}/selected_head.parquet")
    assert back.columns == s.columns and back.count() == min(500, s.clean_rows) and back.where(" or ".join(f"{c} is null" for c in back.columns)).count() == 0
    from candlewick.sources.sinks import read_feature_list

    assert sorted(read_feature_list(spark, f"file://{tmp_path}/selected_features.txt")) == s.columns
    assert "stability" not in S.reports(s) and len(S.reports(s).splitlines()) > 10
    few = S.analyze(one, space, batch_rows=40, top=4)
    assert few.selected == s.selected[:4]


def test_analyze_and_export_in_chunks(spark, sf_dir, tmp_path):
    """No task has the whole series, and the selection is the same, place by place."""
    space = P.FeatureSpace(periods=(5, 8))
    one = candles(spark, sf_dir).where("instrument = 'click'").cache()
    whole, cut = (S.analyze(one, space, batch_rows=40, top=12, chunk_rows=k) for k in (None, 60))
    assert cut.selected == whole.selected and cut.clusters == whole.clusters and cut.clean_rows == whole.clean_rows
    assert {(r.feature, r.kept, r.reason) for r in cut.quality.collect()} == {(r.feature, r.kept, r.reason) for r in whole.quality.collect()}
    S.export(spark, one, cut, f"file://{tmp_path}/cut", space, chunk_rows=60)
    S.export(spark, one, whole, f"file://{tmp_path}/whole", space)
    a, b = (spark.read.parquet(f"file://{tmp_path}/{k}/selected_head.parquet").orderBy("timestamp").collect() for k in ("cut", "whole"))
    assert len(a) == len(b) > 0
    for x, y in zip(a, b, strict=True):
        for c, v in y.asDict().items():
            assert x[c] == (pytest.approx(v, rel=1e-9, abs=1e-9, nan_ok=True) if isinstance(v, float) else v), c


def test_analyze_takes_one_series(spark, sf_dir):
    with pytest.raises(ValueError, match="one series"):
        S.analyze(candles(spark, sf_dir), P.FeatureSpace(periods=(5,), outputs=("sma", "mom")))


def test_no_clean_rows(spark, sf_dir, tmp_path):
    one = candles(spark, sf_dir).where("instrument = 'click'").limit(20)
    s = S.analyze(one, P.FeatureSpace(periods=(30,)))
    assert (s.selected, s.columns, s.clean_rows) == ([], [], 0) and S.reports(s) == ""
    S.export(spark, one, S.Selection([], ["close", "sma_30"]), f"file://{tmp_path}", P.FeatureSpace(periods=(30,)))
    assert spark.read.parquet(f"file://{tmp_path}/selected_head.parquet").count() == 0


def test_full_period_range_needs_600_bars(spark):
    n = 640
    rng = np.random.default_rng(0)
    close = 100 + np.cumsum(rng.normal(size=n))
    rows = [("A", "m1", i, *(float(close[i] + d) for d in (0, 1, -1, 0)), float(i % 7 + 1)) for i in range(n)]
    b = spark.createDataFrame(rows, "instrument string, timeframe string, timestamp long, open double, high double, low double, close double, volume double")
    space = P.FeatureSpace(periods=(5, 200))
    assert P.complete_rows(P.packed_features(b, space)).agg(F.min("rn"), F.count("*")).first() == (598, n - 597)
    assert math.isclose(P.wide_features(P.packed_features(b, space), ["sma_200"], space).where(f"rn = {n}").first().sma_200, close[-200:].mean())
