import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.operators import kernels as K
from candlewick.operators.recursive import add_recursive
from candlewick.operators.windowed import FAMILIES, add_windowed


def series(close, high=None, low=None, volume=None):
    c = np.array(close, dtype=float)
    return K.Series(c, c if high is None else np.array(high, float), c if low is None else np.array(low, float), c, np.full(len(c), 5.0) if volume is None else np.array(volume, float))


def values(result):
    return [v if k else None for v, k in zip(result[0].tolist(), result[1].tolist())]


def random_series(n=300, seed=0):
    rng = np.random.default_rng(seed)
    c = 100 + np.cumsum(rng.normal(size=n))
    c[5:9] = c[5]
    return K.Series(c, c + rng.random(n), c - rng.random(n), c, np.floor(rng.random(n) * 10))


LINEAR = {
    "sma": [None, None, 2, 3, 4, 5], "ema": [None, None, 2, 3, 4, 5], "wma": [None, None, 14 / 6, 20 / 6, 26 / 6, 32 / 6], "smma": [None, None, 2, 8 / 3, 31 / 9, 116 / 27],
    "rsi": [None] * 3 + [100] * 3, "mom": [None] * 3 + [3] * 3, "roc": [None] * 3 + [300, 150, 100], "cmo": [None] * 3 + [100] * 3, "median": [None, None, 2, 3, 4, 5], "variance": [None, None] + [2 / 3] * 4,
}


@pytest.mark.parametrize("name", LINEAR)
def test_linear_fixture(name):
    got = values(series([1, 2, 3, 4, 5, 6]).output(name, 3))
    assert [g is None for g in got] == [w is None for w in LINEAR[name]]
    assert [g for g in got if g is not None] == pytest.approx([w for w in LINEAR[name] if w is not None])


def test_flat_fixture():
    s, p = series([10.0] * 40), 5
    last = lambda n: values(s.output(n, p))[-1]
    assert [last(n) for n in ("rsi", "mfi", "cci", "wpr", "cmf")] == [100, 100, 0, 0, 0]
    assert [last(n) for n in ("cmo", "vi_plus", "vi_minus")] == [None] * 3
    assert all(math.isnan(last(n)) for n in ("pdi", "mdi", "adx"))
    assert [last(n) for n in ("aroon_up", "aroon_down", "aroon_osc", "atr", "fi", "std_dev", "variance")] == [100, 100, 0, 0, 0, 0, 0]


FIRST = {"sma": lambda p: p - 1, "ema": lambda p: p - 1, "wma": lambda p: p - 1, "dema": lambda p: 2 * (p - 1), "tema": lambda p: 3 * (p - 1), "rsi": lambda p: p, "mom": lambda p: p, "mfi": lambda p: p, "vi_plus": lambda p: p, "cmo": lambda p: p, "pdi": lambda p: p + 1, "adx": lambda p: 2 * p, "trix": lambda p: p, "hma": lambda p: p - 1 + max(1, round(p**0.5)) - 1, "fcb_upper": lambda p: p}


@pytest.mark.parametrize("name", FIRST)
@pytest.mark.parametrize("p", [2, 5, 14, 50])
def test_warm_up(name, p):
    known = random_series().output(name, p)[1]
    assert int(np.argmax(known)) == FIRST[name](p)
    assert known[FIRST[name](p) + 10 :].all()  # past the flat rows, where cmo has no value


def test_cmo_has_no_value_on_flat_rows():
    v = values(series([1, 2, 2, 2, 3]).output("cmo", 2))
    assert v == [None, None, 100.0, None, 100.0]


@pytest.mark.parametrize("n,name,p,some", [(14, "atr", 14, False), (15, "atr", 14, True), (27, "pdi", 14, False), (28, "pdi", 14, True), (28, "adx", 14, False), (29, "adx", 14, True), (599, "trix", 200, False), (600, "trix", 200, True), (597, "tema", 200, False), (598, "tema", 200, True)])
def test_length_guards(n, name, p, some):
    assert random_series(n).output(name, p)[1].any() == some


@pytest.mark.parametrize("n", [0, 1, 2, 3, 6])
def test_short_series(n):
    s = random_series(300)
    short = K.Series(*(getattr(s, a)[:n] for a in ("open", "high", "low", "close", "volume")))
    for name in K.ORDER:
        v, known = short.output(name, 5)
        assert len(v) == len(known) == n


@given(st.lists(st.floats(-1e3, 1e3), min_size=1, max_size=200), st.floats(0.0, 0.999))
@settings(max_examples=60, deadline=None)
def test_scan_is_the_recurrence(xs, a):
    y, want = 0.0, []
    for i, x in enumerate(xs):
        y = x if i == 0 else a * y + x
        want.append(y)
    assert K.scan(np.array(xs), a) == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_nan_stays():
    y = K.scan(np.array([1.0, np.nan, 1.0, 1.0] + [1.0] * 5000), 0.5)
    assert np.isnan(y[1:]).all() and y[0] == 1


@given(st.integers(0, 50), st.integers(2, 30))
@settings(max_examples=25, deadline=None)
def test_bounds_and_identities(seed, p):
    s = random_series(120, seed)
    get = lambda n: np.where((r := s.output(n, p))[1], r[0], np.nan)
    inside = lambda n, lo, hi: np.nanmin(get(n)) >= lo - 1e-9 and np.nanmax(get(n)) <= hi + 1e-9
    assert inside("rsi", 0, 100) and inside("wpr", -100, 0) and inside("aroon_up", 100 / p, 100) and inside("mfi", 0, 100)
    assert np.array_equal(get("env_middle"), get("sma"), equal_nan=True) and np.array_equal(get("sm_rsi"), get("rsi"), equal_nan=True)
    assert np.array_equal(get("aroon_osc"), get("aroon_up") - get("aroon_down"), equal_nan=True)
    assert np.array_equal(get("fcb_upper")[p:], get("donchian_upper")[p - 1 : -1])


@pytest.mark.parametrize("name", K.ORDER)
def test_prefix_stability(name):
    s, k, p = random_series(200), 120, 9
    part = K.Series(*(getattr(s, a)[:k] for a in ("open", "high", "low", "close", "volume")))
    whole, cut = s.output(name, p), part.output(name, p)
    assert np.array_equal(whole[1][:k], cut[1]) and np.allclose(whole[0][:k][cut[1]], cut[0][cut[1]])


def frame(spark, s, instrument="A", order=None):
    rows = [(instrument, "m1", i, float(s.open[i]), float(s.high[i]), float(s.low[i]), float(s.close[i]), float(s.volume[i])) for i in (order or range(s.n))]
    return spark.createDataFrame(rows, "instrument string, timeframe string, timestamp long, open double, high double, low double, close double, volume double")


def test_windows_equal_kernels(spark):
    s, p = random_series(150), 7
    out = add_windowed(frame(spark, s), {f: [p] for f in FAMILIES}).orderBy("timestamp").toPandas()
    names = [n for n in K.ORDER if f"{n}_{p}" in out.columns] + ["obv_line"]
    assert len(names) == 29
    for n in names:
        v, known = s.output(n, p)
        got = out["obv_line" if n == "obv_line" else f"{n}_{p}"].to_numpy(dtype=float)
        assert np.array_equal(~np.isnan(got), known), n
        assert np.allclose(got[known], v[known], rtol=1e-9, atol=1e-9), n


def test_sample_deviation(spark):
    from candlewick.functions.frames import with_bars
    from candlewick.operators.windowed import std_dev, variance

    df = with_bars(frame(spark, series([1, 2, 3, 4, 5, 6])))
    out = df.select("rn", *(x[0][k].alias(k) for x in (variance(3, ddof=1), std_dev(3, ddof=1)) for k in x[0])).orderBy("rn").collect()
    assert [r.variance_3 for r in out] == [None, None, 1, 1, 1, 1] and [r.std_dev_3 for r in out[2:]] == [1] * 4


def test_partition_independence(spark):
    a, b = random_series(90, 1), random_series(80, 2)
    rng = np.random.default_rng(3)
    both = frame(spark, a, "A", rng.permutation(90).tolist()).unionByName(frame(spark, b, "B", rng.permutation(80).tolist()))
    outs = []
    for n in (1, 7):
        df = add_recursive(add_windowed(both.repartition(n), {"sma": [5]}), {"adx": [5], "tema": [5]})
        outs.append(sorted(map(repr, df.select("instrument", "timestamp", "sma_5", "adx_5", "tema_5").collect())))
    assert outs[0] == outs[1] and len(outs[0]) == 170


def test_nan_is_not_null(spark):
    out = add_recursive(frame(spark, series([10.0] * 20)), {"pdi": [3]}).orderBy("timestamp").selectExpr("pdi_3 is null as empty", "isnan(pdi_3) as nan").collect()
    assert [r.empty for r in out] == [True] * 4 + [False] * 16 and out[-1].nan
