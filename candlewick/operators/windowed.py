"""Indicator families that a finite row frame defines, as Column expressions.

A family is a function of the period that returns stages: dicts of column name -> expression. A
stage may use the columns of the one before. All frames share one partitioning and order, so a
request for many indicators is one sort per series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frames as W
from ..functions.scalars import ratio

Stages = list[dict[str, Column]]
BAND = 0.025
CCI_SCALE = 0.015


def c(name: str) -> Column:
    return F.col(name)


def mean(value: str, p: int) -> Column:
    return F.avg(value).over(W.last(p))


def weighted(value: str, p: int, row: str = "rn") -> Column:
    """Mean with weights 1..p, newest heaviest, from two sums: the weight of a row is its number
    less that of the row before the frame."""
    w = W.last(p)
    return (F.sum(c(row) * c(value)).over(w) - (c(row) - p) * F.sum(value).over(w)) / F.lit(p * (p + 1) / 2)


def sma(p: int) -> Stages:
    return [{f"sma_{p}": W.full(p, mean("close", p))}]


def wma(p: int) -> Stages:
    return [{f"wma_{p}": W.full(p, weighted("close", p))}]


def vwma(p: int) -> Stages:
    w = W.last(p)
    return [{f"vwma_{p}": W.full(p, ratio(F.sum(c("close") * c("volume")).over(w), F.sum("volume").over(w)))}]


def hma(p: int) -> Stages:
    half, root = p // 2, max(1, round(p**0.5))
    part = weighted("close", half) if half else F.lit(0.0)
    raw = 2.0 * part - weighted("close", p) if half else F.lit(0.0)
    # rows before p - 1 have no difference; the frame of the second mean never reaches them
    return [{f"_hma_{p}": W.full(p, raw)}, {f"hma_{p}": W.full(p - 1 + root, weighted(f"_hma_{p}", root))}]


def env(p: int) -> Stages:
    m = W.full(p, mean("close", p))
    return [{f"env_upper_{p}": m * (1 + BAND), f"env_lower_{p}": m * (1 - BAND), f"env_middle_{p}": m}]


def obv_line(p: int = 0) -> Stages:
    signed = F.coalesce(F.signum("change") * c("volume"), F.lit(0.0))
    return [{"obv_line": F.sum(signed).over(W.so_far())}]


def obv_sma(p: int) -> Stages:
    return [*obv_line(), {f"obv_sma_{p}": W.full(p, mean("obv_line", p))}]


def mom(p: int) -> Stages:
    return [{f"mom_{p}": c("close") - F.lag("close", p).over(W.base())}]


def roc(p: int) -> Stages:
    old = F.lag("close", p).over(W.base())
    return [{f"roc_{p}": ratio(c("close") - old, old) * 100}]


def cci(p: int) -> Stages:
    ma = f"_cci_mean_{p}"
    spread = F.aggregate(F.collect_list("tp").over(W.last(p)), F.lit(0.0), lambda s, x: s + F.abs(x - c(ma))) / p
    dev = f"_cci_dev_{p}"
    value = F.when(c(dev) == 0, 0.0).otherwise((c("tp") - c(ma)) / (CCI_SCALE * F.when(c(dev) != 0, c(dev))))
    return [{ma: mean("tp", p)}, {dev: spread}, {f"cci_{p}": W.full(p, value)}]


def wpr(p: int) -> Stages:
    hi, lo = F.max("high").over(W.last(p)), F.min("low").over(W.last(p))
    return [{f"wpr_{p}": W.full(p, F.coalesce(ratio(hi - c("close"), hi - lo), F.lit(0.0)) * -100)}]


def cmo(p: int) -> Stages:
    up = F.sum(F.greatest("change", F.lit(0.0))).over(W.last(p))
    down = F.sum(F.greatest(-c("change"), F.lit(0.0))).over(W.last(p))
    return [{f"cmo_{p}": W.full_after(p, ratio(up - down, up + down) * 100)}]


def mfi(p: int) -> Stages:
    flow = c("tp") * c("volume")
    up = F.sum(F.when(c("tp") > c("prev_tp"), flow).otherwise(0.0)).over(W.last(p))
    down = F.sum(F.when(c("tp") < c("prev_tp"), flow).otherwise(0.0)).over(W.last(p))
    value = F.when(down == 0, 100.0).otherwise(100.0 - 100.0 / (1.0 + ratio(up, down)))
    return [{f"mfi_{p}": W.full_after(p, value)}]


def _aroon(p: int) -> tuple[Column, Column]:
    w = W.last(p)

    def place(key: Column) -> Column:  # of the latest extreme, 1 to p
        return (F.max_by("rn", F.struct(key, c("rn"))).over(w) - (c("rn") - p)) / F.lit(float(p)) * 100

    return W.full(p, place(c("high"))), W.full(p, place(-c("low")))


def aroon(p: int) -> Stages:
    up, down = _aroon(p)
    return [{f"aroon_up_{p}": up, f"aroon_down_{p}": down}, {f"aroon_osc_{p}": c(f"aroon_up_{p}") - c(f"aroon_down_{p}")}]


def donchian(p: int) -> Stages:
    hi, lo = W.full(p, F.max("high").over(W.last(p))), W.full(p, F.min("low").over(W.last(p)))
    return [{f"donchian_upper_{p}": hi, f"donchian_lower_{p}": lo, f"donchian_middle_{p}": (hi + lo) / 2.0}]


def fcb(p: int) -> Stages:
    return [{f"fcb_upper_{p}": W.full_after(p, F.max("high").over(W.before(p))), f"fcb_lower_{p}": W.full_after(p, F.min("low").over(W.before(p)))}]


def std_dev(p: int, ddof: int = 0) -> Stages:
    """Population; ddof=1 gives the sample form, 0 where there are fewer than two points."""
    f = F.stddev_pop if ddof == 0 else F.stddev_samp
    return [{f"std_dev_{p}": W.full(p, F.coalesce(f("close").over(W.last(p)), F.lit(0.0)))}]


def variance(p: int, ddof: int = 0) -> Stages:
    f = F.var_pop if ddof == 0 else F.var_samp
    return [{f"variance_{p}": W.full(p, F.coalesce(f("close").over(W.last(p)), F.lit(0.0)))}]


def median(p: int) -> Stages:
    return [{f"median_{p}": W.full(p, F.percentile("close", F.lit(0.5)).over(W.last(p)))}]


def vi(p: int) -> Stages:
    w = W.last(p)
    trs = F.sum("tr").over(w)
    plus = F.sum(F.coalesce(F.abs(c("high") - c("prev_low")), F.lit(0.0))).over(w)
    minus = F.sum(F.coalesce(F.abs(c("low") - c("prev_high")), F.lit(0.0))).over(w)
    return [{f"vi_plus_{p}": W.full_after(p, ratio(plus, trs)), f"vi_minus_{p}": W.full_after(p, ratio(minus, trs))}]


def cmf(p: int) -> Stages:
    span = c("high") - c("low")
    multiplier = F.coalesce(ratio((c("close") - c("low")) - (c("high") - c("close")), span), F.lit(0.0))
    w = W.last(p)
    return [{f"cmf_{p}": W.full(p, ratio(F.sum(multiplier * c("volume")).over(w), F.sum("volume").over(w)))}]


FAMILIES: dict[str, Callable[[int], Stages]] = {
    f.__name__: f for f in (sma, wma, vwma, hma, env, obv_line, obv_sma, mom, roc, cci, wpr, cmo, mfi, aroon, donchian, fcb, std_dev, variance, median, vi, cmf)
}


def add_windowed(candles: DataFrame, wanted: dict[str, list[int]]) -> DataFrame:
    """``candles`` (keys, prices, volume) with the columns of the wanted families and periods."""
    df = W.with_bars(candles) if "tr" not in candles.columns else candles
    stages: list[dict[str, Column]] = []
    for family, periods in wanted.items():
        for p in periods:
            for depth, columns in enumerate(FAMILIES[family](p)):
                if depth == len(stages):
                    stages.append({})
                stages[depth].update(columns)
    for columns in stages:
        df = df.withColumns({k: v for k, v in columns.items() if k not in df.columns})
    return df.drop(*(k for s in stages for k in s if k.startswith("_")))
