import numpy as np
import pytest

from candlewick.operators.kernels import reach
from candlewick.operators.recursive import RECURSIVE
from candlewick.operators.windowed import FAMILIES
from candlewick.plans.features import FeatureSpace, packed_features
from candlewick.plans.indicators import chunked_indicators, indicators, numbered
from tests.test_indicators import frame, random_series


def test_indicators_on_request(spark):
    b = frame(spark, random_series(60))
    out = indicators(b, {"sma": [5, 9], "adx": [5], "aroon": [7], "rsi": [5]})
    assert out.columns == [*b.columns, "adx_5", "rsi_5", "sma_5", "sma_9", "aroon_up_7", "aroon_down_7", "aroon_osc_7"] and out.count() == 60
    with pytest.raises(ValueError, match="unknown"):
        indicators(b, {"vi_plus": [5]})


def two_series(spark):
    rng = np.random.default_rng(5)
    a, b = random_series(260, 1), random_series(97, 2)
    return frame(spark, a, "A", rng.permutation(260).tolist()).unionByName(frame(spark, b, "B", rng.permutation(97).tolist())).repartition(6)


def test_numbering_without_a_whole_series(spark):
    rows = numbered(two_series(spark), 5).select("instrument", "timestamp", "rn", "n").collect()
    assert len(rows) == 357 and all(r.rn == r.timestamp + 1 and r.n == {"A": 260, "B": 97}[r.instrument] for r in rows)


def same_rows(whole, cut):
    one, other = ({(r.instrument, r.timestamp, r.asDict().get("period")): r.asDict(True) for r in x.collect()} for x in (whole, cut))
    assert one.keys() == other.keys()
    for k, row in one.items():
        assert row.keys() == other[k].keys()
        for c, v in row.items():
            pairs = zip(v, other[k][c], strict=True) if isinstance(v, list) else [(v, other[k][c])]
            for x, y in pairs:
                assert x == y or x == pytest.approx(y, rel=1e-9, abs=1e-9, nan_ok=True), (k, c)


def test_chunks_equal_whole_series(spark):
    b = two_series(spark)
    wanted = {f: [4, 9] for f in (*FAMILIES, *RECURSIVE)}
    same_rows(indicators(b, wanted), chunked_indicators(b, wanted, chunk_rows=40, partitions=5))


def test_long_series_forget_their_start(spark):
    """Lead-ins that end before the series does: chunks that never saw its start."""
    b = frame(spark, random_series(1500, 3))
    wanted = {f: [3, 5] for f in RECURSIVE}
    assert max(reach(f, p) for f, ps in wanted.items() for p in ps) < 400
    same_rows(indicators(b, wanted), chunked_indicators(b, wanted, chunk_rows=100, partitions=4))


def test_packed_features_in_chunks(spark):
    b, space = two_series(spark), FeatureSpace(periods=(3, 6))
    same_rows(packed_features(b, space), packed_features(b, space, chunk_rows=50))


def test_chunks_are_partitions_of_their_own(spark):
    plan = chunked_indicators(two_series(spark), {"sma": [5]}, chunk_rows=40)._jdf.queryExecution().toString()
    assert "hashpartitioning(instrument" in plan and "_chunk" in plan
    with pytest.raises(ValueError, match="need 151"):
        chunked_indicators(two_series(spark), {"trix": [50]}, chunk_rows=40)
    with pytest.raises(ValueError, match="unknown"):
        chunked_indicators(two_series(spark), {"vi_plus": [5]})
