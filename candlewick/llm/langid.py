"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are byte 3- and 4-grams of the lower-cased text with anything but letters as one
separator; a separator may stand only at either end, as a word's edge. Their hashes index an
embedding table; a text is the mean of its embeddings, and a linear layer with a softmax follows.
Training is stochastic gradient descent in numpy on a bounded sample (about SAMPLE_PER_LANG whole
texts per language, plus a short piece of each); their subwords are counted where the texts are, so
that at most BUCKETS counts of each come to the driver. Prediction reads whole texts.
As mean and layer are linear, the table is stored as one row of logits per hash.

A temperature fitted on held-back sample texts calibrates the probabilities. The rejection level is
the REJECT_QUANTILE of the confidence of right answers there, at most REJECT_MAX: a text under it,
or without letters, is rejected.

Defined cases: null text or one without a letter is ``und`` with score 0; null lang is never
learned from; with no labelled rows everything is ``und``, with one language everything is that;
repeated rows count each; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, fold

#: Rows of the table; their numbers fit two bytes.
BUCKETS = 1 << 16
DIM = 16
GRAMS = (3, 4)
SAMPLE_PER_LANG = 1200
PIECE = 60
EPOCHS = 5
RATE = 0.6
REJECT_QUANTILE = 0.001
REJECT_MAX = 0.5
HELD_FOLDS, HELD_OUT = 3, 1
#: Bytes that one pass over a batch handles.
CHUNK = 1 << 18

_SPACE = 32
_CLEAN = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else _SPACE for c in range(256)], dtype=np.uint8)


def gram_hashes(clean: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, bucket) of each n-gram without a separator inside."""
    m = len(clean) - n + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
    ok = np.ones(m, dtype=bool)
    for i in range(n):
        part = clean[i : i + m]
        h = (h ^ part) * np.uint32(0x01000193)
        if 0 < i < n - 1:
            ok &= part != _SPACE
    at = np.flatnonzero(ok)
    h = h[at]
    h ^= h >> np.uint32(15)
    return at, (h & np.uint32(BUCKETS - 1)).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    logits: np.ndarray  # BUCKETS x langs, float32
    bias: np.ndarray
    temperature: float
    reject_below: float

    def sums(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text the sum of its n-grams' logits and their number. Texts begin and end with a separator."""
        docs = len(offsets) - 1
        total, count = np.zeros((docs, len(self.langs))), np.zeros(docs)
        most = max(GRAMS) - 1
        for a in range(int(offsets[0]), int(offsets[-1]), CHUNK):
            b = min(a + CHUNK, int(offsets[-1]))
            clean = _CLEAN[data[a : min(b + most, int(offsets[-1]))]]
            first, last = np.searchsorted(offsets, a, "right") - 1, np.searchsorted(offsets, b, "left")
            ends = np.clip(offsets[first : last + 1], a, b) - a
            owner = np.repeat(np.arange(last - first), np.diff(ends))
            for n in GRAMS:
                at, h = gram_hashes(clean, n)
                if (k := np.searchsorted(at, b - a)) < len(at):
                    at, h = at[:k], h[:k]
                who, rows = owner[at], self.logits[h]
                count[first:last] += np.bincount(who, minlength=last - first)
                for j in range(len(self.langs)):
                    total[first:last, j] += np.bincount(who, weights=rows[:, j], minlength=last - first)
        return total, count

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, calibrated probability) of each text."""
        total, count = self.sums(data, offsets)
        z = (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def _bag(text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
    clean = _CLEAN[np.frombuffer(b" " + text + b" ", dtype=np.uint8)]
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(clean), CHUNK):
        for n in GRAMS:
            counts += np.bincount(gram_hashes(clean[at : at + CHUNK + n - 1], n)[1], minlength=BUCKETS)
    u = np.flatnonzero(counts)
    return (u, (counts[u] / counts[u].sum()).astype(np.float32)) if len(u) else None


def bags(text: bytes) -> list[tuple[np.ndarray, np.ndarray]]:
    """The subword shares of a lower-cased text, and of a piece of it that its bytes choose."""
    out = [_bag(text)]
    if len(text) > 2 * PIECE:
        at = zlib.crc32(text) % (len(text) - PIECE)
        out.append(_bag(text[at : at + PIECE]))
    return [b for b in out if b is not None]


def fit(samples: list[list[tuple[np.ndarray, np.ndarray]]], labels: list[str], seed: int = 7) -> Model:
    """Train on the bags of texts and their languages."""
    langs = sorted(set(labels))
    k = len(langs)
    if k < 2:
        return Model(langs, np.zeros((BUCKETS, k), np.float32), np.zeros(k), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    index = {x: i for i, x in enumerate(langs)}
    train, held = [], []
    for i, (sample, lang) in enumerate(zip(samples, labels, strict=True)):
        (held if i % 5 == 0 else train).extend((u, c, index[lang]) for u, c in sample)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, k), np.float32), np.zeros(k, np.float32)
    steps, done = EPOCHS * len(train), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(train)):
            u, c, y = train[i]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = c @ emb[u]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= 0.01 * rate * p
            emb[u] -= (rate * 20) * np.outer(c, back)
    logits = emb @ out
    z = np.array([c @ logits[u] + bias for u, c, _ in held or train])
    y = np.array([y for *_, y in held or train])

    def probs(t: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return e / e.sum(axis=1, keepdims=True)

    temperature = min(np.geomspace(0.02, 4, 60), key=lambda t: -np.log(np.maximum(probs(t)[np.arange(len(y)), y], 1e-9)).mean())
    p = probs(temperature)
    right = p.argmax(axis=1) == y
    level = float(np.quantile(p.max(axis=1)[right], REJECT_QUANTILE)) if right.any() else 0.0
    return Model(langs, logits.astype(np.float32), bias.astype(np.float64), float(temperature), min(level, REJECT_MAX))


def train(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on a bounded sample of rows outside the held-out fold, by the hash of doc_id."""
    rows = docs.where(F.col("lang").isNotNull() & (fold("doc_id", HELD_FOLDS) != HELD_OUT))
    counts = rows.groupBy("lang").count().collect()  # one row per language
    space = 1 << 30
    share = F.lit(0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], int(space * min(1.0, sample_per_lang / r["count"]))).otherwise(share)
    # by id and text: rows without an id are drawn like others
    picked = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(space)) < share)
    text = F.lower(F.coalesce("text", F.lit(""))).cast("binary")

    def read(texts: pa.Array) -> pa.Array:
        made = [bags(b" " + x.as_py() + b" ") for x in texts]
        return pa.array([[{"u": u.astype("<u2").tobytes(), "c": c.astype("<f4").tobytes()} for u, c in m] for m in made], pa.list_(pa.struct([("u", pa.binary()), ("c", pa.binary())])))

    # equal rows are drawn together; one of them is learned from
    got = picked.groupBy("lang", "doc_id", F.xxhash64("text").alias("h")).agg(F.min(text).alias("t"))
    got = got.select("lang", "doc_id", "h", F.arrow_udf(read, "array<struct<u:binary,c:binary>>")("t").alias("bags"))
    got = sorted(((r.lang, -1 if r.doc_id is None else r.doc_id, r.h, r.bags) for r in got.toLocalIterator()), key=lambda r: r[:3])
    samples = [[(np.frombuffer(bytes(b.u), "<u2"), np.frombuffer(bytes(b.c), "<f4")) for b in r[3]] for r in got]
    order = np.random.default_rng(1).permutation(len(got))
    return fit([samples[i] for i in order], [got[i][0] for i in order])


def predictor(docs: DataFrame, model: Model):
    """Text column -> struct(lang, score, rejected)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        m = shared.value
        if not m.langs:
            n = len(texts)
            return pa.StructArray.from_arrays([pa.array(["und"] * n), pa.array([0.0] * n), pa.array([True] * n)], ["lang", "score", "rejected"])
        wide = texts.cast(pa.large_binary())
        _, offsets, data = wide.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
        best, score = m.predict(raw, at)
        return pa.StructArray.from_arrays([pa.array(m.langs).take(pa.array(best)), pa.array(score), pa.array(score < m.reject_below)], ["lang", "score", "rejected"])

    udf = F.arrow_udf(run, "struct<lang:string,score:double,rejected:boolean>")

    def apply(text: Column) -> Column:
        return udf(F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")).cast("binary"))

    return apply


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    bound_batches(docs.sparkSession)
    model = model or train(docs)
    apply = predictor(docs, model)
    d = docs.select("doc_id", (fold("doc_id", HELD_FOLDS) == HELD_OUT).alias("held_out"), has_letter(F.col("text")).alias("any"), apply(F.col("text")).alias("p"))
    return d.select(
        "doc_id",
        "held_out",
        F.when(F.col("any"), F.col("p.lang")).otherwise("und").alias("lang_pred"),
        F.when(F.col("any"), F.col("p.score")).otherwise(0.0).alias("score"),
        (~F.col("any") | F.col("p.rejected")).alias("rejected"),
    )


def accept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is told, all columns as they were."""
    bound_batches(docs.sparkSession)
    apply = predictor(docs, train(docs))
    out = docs.withColumn("langid_rejected__", ~has_letter(F.col("text")) | apply(F.col("text"))["rejected"])
    return out.where(~F.col("langid_rejected__")).select(*docs.columns)
