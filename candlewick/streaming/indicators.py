"""Indicators over an unbounded stream, with a state per series that the stream's length does not change.

``stream_indicators`` keeps the running values of a few recurrences (some numbers per period).
``stream_outputs`` gives every output of the feature table: it keeps the tail of bars that the outputs
reach back to and runs the batch kernels over the tail and the new bars.

Bars of one micro-batch are taken in time order; a bar not later than the last one taken is dropped, as
its place is gone, and counted in ``late``: how many the series had dropped when the row was made (use a
watermark and a sorting buffer upstream where bars come late).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState

from ..functions.frames import KEYS
from ..operators import kernels
from ..shipping import ship

FAMILIES = ("ema", "smma", "rsi", "atr")
#: Per period: seed sums and values of close means (ema, smma), gain, loss and true range.
_SLOTS = 5
STATE = "n long, last timestamp, close double, obv double, sums array<double>, values array<double>, late long"
BAR = ("open", "high", "low", "close", "volume")
TAIL_STATE = "n long, last timestamp, obv double, late long, lasting array<string>, " + ", ".join(f"{c} array<double>" for c in BAR)
#: Outputs that are NaN for good after a NaN, as their last step is a recurrence.
LASTING_NAN = ("ema", "smma", "dema", "tema", "fi", "atr", "adx", "rsi", "sm_rsi")


class Recurrences:
    """The recurrences of one series, one bar at a time."""

    def __init__(self, periods: Sequence[int], state: tuple | None = None) -> None:
        self.periods = periods
        k = len(periods) * _SLOTS
        self.n, self.last, self.close, self.obv, sums, values, self.late = state or (0, None, 0.0, 0.0, [0.0] * k, [0.0] * k, 0)
        self.sums, self.values = list(sums), list(values)

    def state(self) -> tuple:
        return self.n, self.last, self.close, self.obv, self.sums, self.values, self.late

    def _mean(self, slot: int, x: float, seen: int, p: int, weight: float) -> float | None:
        """Seeded with the mean of the first p, then smoothed; None before that."""
        if seen < p:
            self.sums[slot] += x
            return None
        if seen == p:
            self.values[slot] = (self.sums[slot] + x) / p
        else:
            self.values[slot] += weight * (x - self.values[slot])
        return self.values[slot]

    def push(self, high: float, low: float, close: float, volume: float) -> list[float | None]:
        """obv_line, then ema, smma, rsi and atr of each period."""
        self.n += 1
        change = close - self.close if self.n > 1 else 0.0
        spread = max(high - low, abs(high - self.close), abs(low - self.close)) if self.n > 1 else high - low
        self.obv += volume * ((change > 0) - (change < 0))
        self.close = close
        out: list[float | None] = [self.obv]
        for i, p in enumerate(self.periods):
            at = i * _SLOTS
            ema = self._mean(at, close, self.n, p, 2.0 / (p + 1))
            smma = self._mean(at + 1, close, self.n, p, 1.0 / p)
            rsi = None
            if self.n > 1:
                gain, loss = (self._mean(at + 2 + j, max(s * change, 0.0), self.n - 1, p, 1.0 / p) for j, s in enumerate((1, -1)))
                if gain is not None:
                    rsi = 100.0 if loss == 0 else 100.0 - 100.0 / (1.0 + gain / loss)
            out += [ema, smma, rsi, self._mean(at + 4, spread, self.n, p, 1.0 / p)]
        return out


def stream_indicators(bars: DataFrame, periods: Sequence[int]) -> DataFrame:
    """instrument, timeframe, timestamp, rn, late, obv_line, ema_p, smma_p, rsi_p, atr_p of a stream of bars."""
    ship(bars.sparkSession)
    periods = tuple(periods)
    names = ["obv_line", *(f"{f}_{p}" for p in periods for f in FAMILIES)]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        r = Recurrences(periods, state.get if state.exists else None)
        rows = []
        for b in pd.concat(list(batches)).sort_values("timestamp").itertuples(index=False):
            if r.last is not None and b.timestamp <= pd.Timestamp(r.last):
                r.late += 1
                continue
            values = r.push(b.high, b.low, b.close, b.volume)
            r.last = b.timestamp.to_pydatetime()
            rows.append((*key, b.timestamp, r.n, r.late, *values))
        state.update(r.state())
        out = pd.DataFrame(rows, columns=[*KEYS, "timestamp", "rn", "late", *names])
        yield out.astype({c: "float64" for c in names} | {"rn": "int64", "late": "int64"})

    schema = "instrument string, timeframe string, timestamp timestamp, rn long, late long, " + ", ".join(f"{n} double" for n in names)
    return bars.groupBy(*KEYS).applyInPandasWithState(run, schema, STATE, "append", "NoTimeout")


class Tail:
    """The last bars of one series, as far back as its outputs reach, and what a longer past has left:
    the count, the on-balance volume at the tail's first bar, and the outputs that are NaN for good."""

    def __init__(self, wanted: dict[str, Sequence[int]], state: tuple | None = None) -> None:
        self.names = [(f, p) for f, ps in wanted.items() for p in ps]
        self.lead = max((kernels.reach(f, p) for f, p in self.names), default=1)
        self.n, self.last, self.obv, self.late, lasting, *bars = state or (0, None, 0.0, 0, [], *([] for _ in BAR))
        self.lasting, self.bars = set(lasting), [np.asarray(x, dtype=float) for x in bars]

    def state(self) -> tuple:
        return self.n, self.last, self.obv, self.late, sorted(self.lasting), *(x.tolist() for x in self.bars)

    def push(self, *new: np.ndarray) -> tuple[np.ndarray, list[kernels.Result]]:
        """The on-balance volume and each wanted output at the new bars, given in time order."""
        first, more = len(self.bars[0]), len(new[0])
        s = kernels.Series(*(np.concatenate(x) for x in zip(self.bars, new, strict=True)))
        s.obv = self.obv + s.obv
        by_period: dict[int, list[str]] = {}
        for f, p in self.names:
            by_period.setdefault(p, []).append(f)
        done = {p: s.outputs(tuple(fs), p) for p, fs in by_period.items()}
        results = []
        for f, p in self.names:
            v, known = (x[first:] for x in done[p][f])
            if f in LASTING_NAN:
                if f"{f}_{p}" in self.lasting:
                    v, known = np.full(more, np.nan), np.ones(more, dtype=bool)
                elif more and known[-1] and np.isnan(v[-1]):
                    self.lasting.add(f"{f}_{p}")
            results.append((v, known))
        cut = max(0, s.n - self.lead)
        line, self.obv = s.obv[first:], float(s.obv[cut]) if s.n else self.obv
        self.bars, self.n = [getattr(s, c)[cut:] for c in BAR], self.n + more
        return line, results


def stream_outputs(bars: DataFrame, wanted: dict[str, Sequence[int]]) -> DataFrame:
    """instrument, timeframe, timestamp, rn, late, obv_line and ``<output>_<period>`` of a stream of bars,
    for any outputs of ``kernels.ORDER``, equal to a double's precision to those of the series up to the
    end of the micro-batch. (ATR, ADX, PDI, MDI and TRIX have no value in series shorter than some
    periods, so their very first values are null if a micro-batch ends just there.)

    A series' state is as many bars as the outputs reach back (``kernels.reach``: about two periods for
    windowed ones, 12,000 bars or 0.5 MB for ADX at period 200), and a micro-batch computes over the state
    and its own bars at once, so long periods want micro-batches of many bars. PDI, MDI and TRIX forget a
    NaN price after their reach, where the whole series would not.
    """
    if unknown := set(wanted) - set(kernels.ORDER):
        raise ValueError(f"unknown outputs {sorted(unknown)}")
    ship(bars.sparkSession)
    wanted = {f: tuple(ps) for f, ps in wanted.items()}
    names = [f"{f}_{p}" for f, ps in wanted.items() for p in ps]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        t = Tail(wanted, state.get if state.exists else None)
        got = pd.concat(list(batches)).sort_values("timestamp", kind="stable")
        fresh = ~got["timestamp"].duplicated()
        if t.last is not None:
            fresh &= got["timestamp"] > pd.Timestamp(t.last)
        t.late += int((~fresh).sum())
        got, before = got[fresh], t.n
        line, results = t.push(*(got[c].to_numpy(dtype=float) for c in BAR))
        if len(got):
            t.last = got["timestamp"].iloc[-1].to_pydatetime()
        state.update(t.state())
        out = {"timestamp": got["timestamp"].to_numpy(), "rn": before + 1 + np.arange(len(got)), "late": np.full(len(got), t.late), "obv_line": line}
        # nullable doubles tell a NaN from no value
        out |= {n: pd.arrays.FloatingArray(np.ascontiguousarray(v), ~known) for n, (v, known) in zip(names, results, strict=True)}
        yield pd.DataFrame({k: [x] * len(got) for k, x in zip(KEYS, key, strict=True)} | out)

    schema = "instrument string, timeframe string, timestamp timestamp, rn long, late long, obv_line double" + "".join(f", {n} double" for n in names)
    return bars.groupBy(*KEYS).applyInPandasWithState(run, schema, TAIL_STATE, "append", "NoTimeout")
