"""All indicator families on one series in numpy: what the grouped Arrow operators run.

A result is (values, known): ``known`` is False where an indicator is not defined (null), and a
known value may be NaN (0/0 in the directional family), which is not the same.

Recurrences y[t] = a * y[t-1] + u[t] are solved by doubling: after the k-th pass each y holds the
terms of the last 2**k steps, and passes stop once a**(2**k) is below the precision of a double.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

Result = tuple[np.ndarray, np.ndarray]
_NEGLIGIBLE = 1e-20
BAND = 0.025
CCI_SCALE = 0.015
#: Families by the name of their function, and the outputs of each, in schema order per period.
ORDER = (
    "sma ema wma vwma hma smma dema tema rsi cci mom roc wpr atr adx pdi mdi trix sm_rsi donchian_upper donchian_lower donchian_middle env_upper env_lower env_middle "
    "fi cmf mfi vi_plus vi_minus aroon_up aroon_down aroon_osc cmo std_dev variance median fcb_upper fcb_lower obv_sma"
).split()


def scan(u: np.ndarray, a: float) -> np.ndarray:
    """y[t] = a * y[t-1] + u[t], y[0] = u[0]. From the first NaN on, all is NaN."""
    y = np.array(u, dtype=float)
    bad = np.flatnonzero(np.isnan(y))
    step, factor = 1, a
    while step < len(y) and abs(factor) > _NEGLIGIBLE:
        y[step:] = y[step:] + factor * y[:-step]
        step, factor = 2 * step, factor * factor
    if len(bad):
        y[bad[0] :] = np.nan
    return y


def nothing(n: int) -> Result:
    return np.full(n, np.nan), np.zeros(n, dtype=bool)


def placed(n: int, start: int, values: np.ndarray) -> Result:
    """``values`` from row ``start`` on."""
    if start >= n or not len(values):
        return nothing(n)
    out, known = nothing(n)
    out[start : start + len(values)] = values
    known[start : start + len(values)] = True
    return out, known


def masked(result: Result, ok: np.ndarray) -> Result:
    return result[0], result[1] & ok


def rolling(x: np.ndarray, p: int) -> np.ndarray:
    return sliding_window_view(x, p)


def smooth(x: np.ndarray, p: int, k: float) -> np.ndarray:
    """Exponential mean of weight k seeded with the mean of the first p: from row p - 1 on."""
    if len(x) < p:
        return np.empty(0)
    u = k * x[p - 1 :]
    u[0] = x[:p].mean()
    return scan(u, 1.0 - k)


def ema_tail(x: np.ndarray, p: int) -> np.ndarray:
    return smooth(x, p, 2.0 / (p + 1))


def zero_filled(x: np.ndarray, p: int) -> np.ndarray:
    """The exponential mean with 0 where it is not defined."""
    out = np.zeros(len(x))
    tail = ema_tail(x, p)
    if len(tail):
        out[p - 1 :] = tail
    return out


def weights(x: np.ndarray, p: int) -> np.ndarray:
    return rolling(x, p) @ np.arange(1, p + 1, dtype=float) / (p * (p + 1) / 2) if len(x) >= p else np.empty(0)


@dataclass
class Series:
    """One ordered series, and what its families share."""

    open: np.ndarray
    high: np.ndarray
    low: np.ndarray
    close: np.ndarray
    volume: np.ndarray

    def __post_init__(self) -> None:
        """``obv`` may be set afterwards, to the line of a longer series that this is a part of."""
        self.n = n = len(self.close)
        h, l, c = self.high, self.low, self.close
        self.change = np.diff(c)
        self.tp = (h + l + c) / 3.0
        self.tr = np.zeros(n)
        self.up, self.down = np.zeros(n), np.zeros(n)
        if n > 1:
            self.tr[1:] = np.maximum.reduce([h[1:] - l[1:], np.abs(h[1:] - c[:-1]), np.abs(l[1:] - c[:-1])])
            up, down = np.diff(h), -np.diff(l)
            self.up[1:] = np.where((up > down) & (up > 0), up, 0.0)
            self.down[1:] = np.where((down > up) & (down > 0), down, 0.0)
        step = np.sign(self.change) * self.volume[1:]
        self.obv = np.concatenate(([0.0], np.cumsum(step)))[:n]
        flow = self.tp[1:] * self.volume[1:]
        self.flow_in, self.flow_out = np.zeros(n), np.zeros(n)
        moved = np.diff(self.tp)
        self.flow_in[1:], self.flow_out[1:] = np.where(moved > 0, flow, 0.0), np.where(moved < 0, flow, 0.0)
        span = h - l
        with np.errstate(all="ignore"):
            self.money = np.where(span == 0, 0.0, ((c - l) - (h - c)) / span) * self.volume

    # moving averages
    def sma(self, p: int) -> dict[str, Result]:
        return {"sma": self._mean(self.close, p)}

    def _mean(self, x: np.ndarray, p: int) -> Result:
        return placed(self.n, p - 1, rolling(x, p).mean(axis=1)) if self.n >= p else nothing(self.n)

    def ema(self, p: int) -> dict[str, Result]:
        return {"ema": placed(self.n, p - 1, ema_tail(self.close, p))}

    def wma(self, p: int) -> dict[str, Result]:
        return {"wma": placed(self.n, p - 1, weights(self.close, p))}

    def vwma(self, p: int) -> dict[str, Result]:
        if self.n < p:
            return {"vwma": nothing(self.n)}
        return {"vwma": self._ratio(p - 1, rolling(self.close * self.volume, p).sum(axis=1), rolling(self.volume, p).sum(axis=1))}

    def _ratio(self, start: int, a: np.ndarray, b: np.ndarray, scale: float = 1.0) -> Result:
        """a / b * scale from row ``start`` on, null where b is 0."""
        with np.errstate(all="ignore"):
            out = placed(self.n, start, a / b * scale)
        ok = np.ones(self.n, dtype=bool)
        ok[start : start + len(b)] = b != 0
        return masked(out, ok)

    def hma(self, p: int) -> dict[str, Result]:
        half, root = p // 2, max(1, round(p**0.5))
        if self.n < p:
            return {"hma": nothing(self.n)}
        long = weights(self.close, p)
        raw = 2.0 * weights(self.close, half)[p - half :] - long if half else np.zeros(len(long))
        return {"hma": placed(self.n, p - 1 + root - 1, weights(raw, root))}

    def smma(self, p: int) -> dict[str, Result]:
        return {"smma": placed(self.n, p - 1, smooth(self.close, p, 1.0 / p))}

    def dema(self, p: int) -> dict[str, Result]:
        one = ema_tail(self.close, p)
        two = ema_tail(one, p)
        return {"dema": placed(self.n, 2 * (p - 1), 2 * one[p - 1 :] - two) if len(two) else nothing(self.n)}

    def tema(self, p: int) -> dict[str, Result]:
        one = ema_tail(self.close, p)
        two = ema_tail(one, p)
        three = ema_tail(two, p)
        return {"tema": placed(self.n, 3 * (p - 1), 3 * one[2 * (p - 1) :] - 3 * two[p - 1 :] + three) if len(three) else nothing(self.n)}

    def trix(self, p: int) -> dict[str, Result]:
        if self.n < 3 * p:
            return {"trix": nothing(self.n)}
        third = ema_tail(zero_filled(zero_filled(self.close, p), p), p)
        return {"trix": self._ratio(p, np.diff(third), third[:-1], 100.0)}

    def env(self, p: int) -> dict[str, Result]:
        v, known = self._mean(self.close, p)
        return {"env_upper": (v * (1 + BAND), known), "env_lower": (v * (1 - BAND), known), "env_middle": (v, known)}

    def obv_sma(self, p: int) -> dict[str, Result]:
        return {"obv_sma": self._mean(self.obv, p)}

    # oscillators
    def rsi(self, p: int) -> dict[str, Result]:
        if self.n <= p:
            return {"rsi": nothing(self.n)}
        gain = smooth(np.maximum(self.change, 0.0), p, 1.0 / p)
        loss = smooth(np.maximum(-self.change, 0.0), p, 1.0 / p)
        with np.errstate(all="ignore"):
            return {"rsi": placed(self.n, p, np.where(loss == 0, 100.0, 100.0 - 100.0 / (1.0 + gain / loss)))}

    def sm_rsi(self, p: int) -> dict[str, Result]:
        return {"sm_rsi": self.rsi(p)["rsi"]}

    def cci(self, p: int) -> dict[str, Result]:
        if self.n < p:
            return {"cci": nothing(self.n)}
        w = rolling(self.tp, p)
        m = w.mean(axis=1)
        dev = np.abs(w - m[:, None]).mean(axis=1)
        with np.errstate(all="ignore"):
            return {"cci": placed(self.n, p - 1, np.where(dev == 0, 0.0, (self.tp[p - 1 :] - m) / (CCI_SCALE * dev)))}

    def mom(self, p: int) -> dict[str, Result]:
        return {"mom": placed(self.n, p, self.close[p:] - self.close[:-p])}

    def roc(self, p: int) -> dict[str, Result]:
        old = self.close[:-p]
        return {"roc": self._ratio(p, self.close[p:] - old, old, 100.0)}

    def wpr(self, p: int) -> dict[str, Result]:
        if self.n < p:
            return {"wpr": nothing(self.n)}
        hi, lo = rolling(self.high, p).max(axis=1), rolling(self.low, p).min(axis=1)
        with np.errstate(all="ignore"):
            return {"wpr": placed(self.n, p - 1, np.where(hi == lo, 0.0, (hi - self.close[p - 1 :]) / (hi - lo) * -100.0))}

    def cmo(self, p: int) -> dict[str, Result]:
        if self.n <= p:
            return {"cmo": nothing(self.n)}
        up, down = rolling(np.maximum(self.change, 0.0), p).sum(axis=1), rolling(np.maximum(-self.change, 0.0), p).sum(axis=1)
        return {"cmo": self._ratio(p, up - down, up + down, 100.0)}

    def mfi(self, p: int) -> dict[str, Result]:
        if self.n <= p:
            return {"mfi": nothing(self.n)}
        up, down = rolling(self.flow_in, p).sum(axis=1)[1:], rolling(self.flow_out, p).sum(axis=1)[1:]
        with np.errstate(all="ignore"):
            return {"mfi": placed(self.n, p, np.where(down == 0, 100.0, 100.0 - 100.0 / (1.0 + up / down)))}

    def aroon(self, p: int) -> dict[str, Result]:
        if self.n < p:
            return {k: nothing(self.n) for k in ("aroon_up", "aroon_down", "aroon_osc")}
        up = (p - np.argmax(rolling(self.high, p)[:, ::-1], axis=1)) / p * 100.0  # the latest of equal extremes
        down = (p - np.argmin(rolling(self.low, p)[:, ::-1], axis=1)) / p * 100.0
        return {"aroon_up": placed(self.n, p - 1, up), "aroon_down": placed(self.n, p - 1, down), "aroon_osc": placed(self.n, p - 1, up - down)}

    # trend, volatility, bands
    def atr(self, p: int) -> dict[str, Result]:
        if self.n <= p:
            return {"atr": nothing(self.n)}
        tr = self.tr.copy()
        tr[0] = self.high[0] - self.low[0]
        return {"atr": placed(self.n, p - 1, smooth(tr, p, 1.0 / p))}

    def adx(self, p: int) -> dict[str, Result]:
        if self.n < 2 * p:
            return {k: nothing(self.n) for k in ("adx", "pdi", "mdi")}

        def total(x: np.ndarray) -> np.ndarray:  # Wilder sums, from row p on
            u = x[p:].copy()
            u[0] = x[1 : p + 1].sum()
            return scan(u, 1.0 - 1.0 / p)[1:]

        tr, up, down = total(self.tr), total(self.up), total(self.down)
        with np.errstate(all="ignore"):
            pdi, mdi = 100.0 * up / tr, 100.0 * down / tr
            both = pdi + mdi
            dx = np.where(both == 0, 0.0, 100.0 * np.abs(pdi - mdi) / both)
        adx = nothing(self.n) if 2 * p >= self.n else placed(self.n, 2 * p, smooth(dx, p, 1.0 / p))
        return {"adx": adx, "pdi": placed(self.n, p + 1, pdi), "mdi": placed(self.n, p + 1, mdi)}

    def donchian(self, p: int) -> dict[str, Result]:
        if self.n < p:
            return {k: nothing(self.n) for k in ("donchian_upper", "donchian_lower", "donchian_middle")}
        hi, lo = rolling(self.high, p).max(axis=1), rolling(self.low, p).min(axis=1)
        return {"donchian_upper": placed(self.n, p - 1, hi), "donchian_lower": placed(self.n, p - 1, lo), "donchian_middle": placed(self.n, p - 1, (hi + lo) / 2.0)}

    def fcb(self, p: int) -> dict[str, Result]:
        if self.n <= p:
            return {k: nothing(self.n) for k in ("fcb_upper", "fcb_lower")}
        return {"fcb_upper": placed(self.n, p, rolling(self.high, p).max(axis=1)[:-1]), "fcb_lower": placed(self.n, p, rolling(self.low, p).min(axis=1)[:-1])}

    def std_dev(self, p: int) -> dict[str, Result]:
        return {"std_dev": placed(self.n, p - 1, rolling(self.close, p).std(axis=1)) if self.n >= p else nothing(self.n)}

    def variance(self, p: int) -> dict[str, Result]:
        return {"variance": placed(self.n, p - 1, rolling(self.close, p).var(axis=1)) if self.n >= p else nothing(self.n)}

    def median(self, p: int) -> dict[str, Result]:
        return {"median": placed(self.n, p - 1, np.median(rolling(self.close, p), axis=1)) if self.n >= p else nothing(self.n)}

    def vi(self, p: int) -> dict[str, Result]:
        if self.n <= p:
            return {k: nothing(self.n) for k in ("vi_plus", "vi_minus")}
        plus, minus = np.zeros(self.n), np.zeros(self.n)
        plus[1:], minus[1:] = np.abs(self.high[1:] - self.low[:-1]), np.abs(self.low[1:] - self.high[:-1])
        tr = rolling(self.tr, p).sum(axis=1)[1:]
        return {k: self._ratio(p, rolling(x, p).sum(axis=1)[1:], tr) for k, x in (("vi_plus", plus), ("vi_minus", minus))}

    # volume
    def obv_line(self, p: int = 0) -> dict[str, Result]:
        return {"obv_line": (self.obv, np.ones(self.n, dtype=bool))}

    def cmf(self, p: int) -> dict[str, Result]:
        if self.n < p:
            return {"cmf": nothing(self.n)}
        return {"cmf": self._ratio(p - 1, rolling(self.money, p).sum(axis=1), rolling(self.volume, p).sum(axis=1))}

    def fi(self, p: int) -> dict[str, Result]:
        raw = np.zeros(self.n)
        raw[1:] = self.change * self.volume[1:]
        return {"fi": placed(self.n, p - 1, ema_tail(raw, p))}

    def output(self, name: str, p: int) -> Result:
        """One output by its name: ``adx``, ``vi_plus``, ``env_middle``, ..."""
        return self.outputs((name,), p)[name]

    def outputs(self, names: tuple[str, ...], p: int) -> dict[str, Result]:
        """Several outputs of one period; families are computed once."""
        done: dict[str, Result] = {}
        for name in names:
            if name not in done:
                done |= getattr(self, FAMILY_OF[name])(p)
        return {k: done[k] for k in names}


#: Output -> the family that computes it.
FAMILY_OF = {k: k for k in ORDER} | {k: f for f in ("donchian", "env", "vi", "aroon", "fcb") for k in ORDER if k.startswith(f + "_")} | {"pdi": "adx", "mdi": "adx", "obv_line": "obv_line"}

#: Recurrences that stand on each other: exponential means of weight 2 / (p + 1), and Wilder's of 1 / p.
_EXPONENTIAL = {"ema": 1, "dema": 2, "tema": 3, "trix": 3, "fi": 1}
_WILDER = {"smma": 1, "rsi": 1, "sm_rsi": 1, "atr": 1, "pdi": 1, "mdi": 1, "adx": 2}


def reach(output: str, p: int) -> int:
    """Bars back from a bar beyond which nothing bears on its value in double precision: the frame of
    a windowed output (stacked ones take twice the period), or where a recurrence's memory is negligible."""
    levels = _EXPONENTIAL.get(output) or _WILDER.get(output)
    if levels is None:
        return 2 * p + 2
    left = 1.0 - (2.0 / (p + 1) if output in _EXPONENTIAL else 1.0 / p)
    memory = np.log(_NEGLIGIBLE) / np.log(left) if left > 0 else 0.0
    # a stack of means forgets like t ** (levels - 1) * left ** t, and starts levels * p bars late
    return int(np.ceil(memory * (1 + 0.25 * (levels - 1)))) + levels * p + 2
