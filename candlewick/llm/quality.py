"""Quality rules with adaptive thresholds.

Per text, base measures are counted over the whole text. The rates built from them (symbols and
repeats as the lower two-sigma bound of the count, so that a few in a short text say nothing) go
into quantile sketches per (lang, source), of the texts that pass the base rule: log-linear
histograms on integers (relative error 1/64), which merge by adding counts, in any order, to the
same sketch.

A group's normal range runs from its median to the quantile at LEVELS of its sketch; beyond FAR
times that range from the median a text is rejected. No value of a threshold is fixed: where a group
has no spread, anything beyond its median is out. Quantiles of small groups lean on the merged
sketch of their language, and that one's on the sketch of everything, either counting as much as
PRIOR_ROWS texts. Filtering is a join with the thresholds.

Defined cases: null text counts as empty and fails the base rule (n_words < 10); null lang or
source is a group of its own; repeated rows count as often as they occur; an empty table gives no
rows; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, bound_batches, text_bytes

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
#: Sketch: values under EXACT have a bucket each, larger ones keep their leading bits.
BITS = 7
EXACT = 1 << BITS
#: Metric: the percentile at which its normal range ends. Debris of markup comes in whole texts, so
#: up to a quarter of a group may be out by symbols; of the others the range is what nearly all have.
LEVELS = {"word_len_milli": 90, "symbol_milli": 75, "dup_line_milli": 98, "repeat_milli": 98}
#: Metrics that also have a lower fence, at the mirrored percentile.
TWO_SIDED = ("word_len_milli",)
#: Fences lie so many normal ranges from the median: 5.1 standard deviations of a normal spread at
#: the 90th percentile, about where outer fences by quartiles lie (4.7).
FAR = 4
#: Texts that a merged sketch counts as beside a group's own.
PRIOR_ROWS = 200

MEASURE_FIELDS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur at least twice in the text."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    key = np.fromiter([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64, count=n)
    if len(seen) == n:
        return 0
    one, width = key, 1
    while width < window:  # ranks of windows of 2, 4 and 5 words: exact, never hashed
        grow = width if 2 * width <= window else 1
        tail = one[width:] if grow == width else key[width:]
        pair = one[: len(tail)] * np.int64(int(tail.max()) + 1) + tail
        one = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        width += grow
    twice = np.bincount(one)[one] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def measure_text(raw: bytes) -> tuple[int, int, int, int, int, int]:
    """The measures of one text, in the order of MEASURE_FIELDS."""
    words = raw.split()  # bytes split at \x20 and \x09-\x0D only
    if not words:
        return 0, 0, 0, 0, 0, 0
    text = raw.decode("utf-8", "replace")
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), repeat_words(words)


_measures = "struct<" + ",".join(f"{x}:bigint" for x in MEASURE_FIELDS) + ">"


def _measure(texts: pa.Array) -> pa.Array:
    rows = np.array([measure_text(x.as_py()) for x in texts], dtype=np.int64).reshape(-1, len(MEASURE_FIELDS))
    return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(MEASURE_FIELDS))], list(MEASURE_FIELDS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratios() -> dict[str, Column]:
    """Integer rates in thousandths, so that every engine buckets them alike."""
    words = F.greatest(F.col("n_words"), F.lit(1))

    def bound(count: str) -> Column:
        """A thousand times the count less two standard deviations of it."""
        n = F.col(count)
        return F.floor(F.greatest(n - F.lit(2.0) * F.sqrt(n), F.lit(0.0)) * F.lit(1000.0)).cast("long")

    def milli(thousands: Column, of: Column) -> Column:
        return F.floor(thousands / of).cast("long")

    return {
        "word_len_milli": milli(F.col("word_chars") * 1000, words),
        "symbol_milli": milli(bound("n_symbols"), F.greatest(F.col("word_chars"), F.lit(1))),
        "dup_line_milli": milli(bound("n_dup_lines"), F.greatest(F.col("n_lines"), F.lit(1))),
        "repeat_milli": milli(bound("n_repeat_words"), words),
    }


def bucket(value: Column) -> Column:
    """Lower edge of the sketch bucket of a non-negative integer."""
    drop = F.length(F.bin(value)) - BITS
    return F.when(value < EXACT, value).otherwise(F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop))


def sketch(measured: DataFrame, keys: list[str]) -> DataFrame:
    """Mergeable sketches: count per key, metric and bucket. Partial counts combine before the shuffle."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), bucket(v).alias("bucket")) for k, v in ratios().items())))
    return measured.select(*keys, each.alias("e")).groupBy(*keys, F.col("e.metric").alias("metric"), F.col("e.bucket").alias("bucket")).agg(F.count("*").alias("n"))


def _level(cells: DataFrame, keys: list[str]) -> DataFrame:
    """rows, mid, hi and lo of each merged sketch of ``keys``: the median and both ends of the normal range."""
    merged = cells.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    # a sketch has at most about a thousand buckets, so one key's array is small whatever its rows
    packed = merged.groupBy(*keys, "metric").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("cells"), F.sum("n").alias("rows"))
    level = F.lit(0)
    for metric, percent in LEVELS.items():
        level = F.when(F.col("metric") == metric, percent).otherwise(level)

    def quantile(percent: Column) -> Column:
        """The least bucket at which the running count reaches ``percent`` of the rows."""
        need = F.ceil(F.col("rows") * percent / F.lit(100))
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
        return F.aggregate(
            "cells",
            start,
            lambda acc, c: F.struct((acc["seen"] + c["n"]).alias("seen"), F.when(acc["at"].isNull() & ((acc["seen"] + c["n"]) >= need), c["bucket"]).otherwise(acc["at"]).alias("at")),
            lambda acc: acc["at"],
        )

    return packed.select(*keys, "metric", "rows", quantile(F.lit(50)).alias("mid"), quantile(level).alias("hi"), quantile(100 - level).alias("lo"))


def _leaning(rows: Column, own: Column, prior: Column, prior_rows: int) -> Column:
    """A quantile of ``rows`` texts drawn to that of the merged sketch."""
    n = rows.cast("double")
    return (n * own + F.lit(float(prior_rows)) * prior) / (n + F.lit(float(prior_rows)))


def thresholds(cells: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """(lang, source, one column per fence) for each group of the sketches."""
    parts = ("mid", "hi", "lo")
    whole = _level(cells, []).select(F.col("metric").alias("w_metric"), *(F.col(c).cast("double").alias(f"w_{c}") for c in parts))
    lang = _level(cells, ["lang"]).join(whole, F.col("metric") == F.col("w_metric"))
    lang = lang.select(F.col("lang").alias("l_lang"), F.col("metric").alias("l_metric"), *(_leaning(F.col("rows"), F.col(c), F.col(f"w_{c}"), prior_rows).alias(f"l_{c}") for c in parts))
    j = _level(cells, ["lang", "source"]).join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("metric") == F.col("l_metric")))
    j = j.select("lang", "source", "metric", *(_leaning(F.col("rows"), F.col(c), F.col(f"l_{c}"), prior_rows).alias(c) for c in parts))
    fences = []
    for metric in LEVELS:
        of = F.col("metric") == metric
        fences.append(F.max(F.when(of, F.col("mid") + F.lit(float(FAR)) * (F.col("hi") - F.col("mid")))).alias(f"{metric}_hi"))
        if metric in TWO_SIDED:
            fences.append(F.max(F.when(of, F.col("mid") - F.lit(float(FAR)) * (F.col("mid") - F.col("lo")))).alias(f"{metric}_lo"))
    return j.groupBy("lang", "source").agg(*fences)


def verdicts() -> dict[str, Column]:
    """Whether the bucket of a text lies inside each rule's fences, which are drawn from buckets."""
    out = {}
    for metric, value in ratios().items():
        at = bucket(value)
        out[metric] = at <= F.col(f"{metric}_hi")
        if metric in TWO_SIDED:
            out[metric] = out[metric] & (at >= F.col(f"{metric}_lo"))
    return out


def quality_rules(docs: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """doc_id, n_words, the base measures, base_failed, kept, failed_rules (of texts that pass the base rule)."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "quality")
    m = docs.select("doc_id", "lang", "source", F.arrow_udf(_measure, _measures)(text_bytes()).alias("m")).select("doc_id", "lang", "source", "m.*")
    m = scratch.cut(m, "measures")
    cells = scratch.cut(sketch(m.where(~base_failed()), ["lang", "source"]), "sketches")
    limits = thresholds(cells, prior_rows).select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), "*").drop("lang", "source")
    # a group all of whose texts fail the base rule has no sketch, and needs none
    j = m.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left").withColumn("failed", base_failed())
    out = F.array_compact(F.array(*(F.when(~F.col("failed") & ~ok, F.lit(metric)) for metric, ok in verdicts().items())))
    j = j.select("doc_id", *(c for c in MEASURE_FIELDS if c != "n_lines"), F.col("failed").alias("base_failed"), out.alias("failed_rules"))
    return j.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
