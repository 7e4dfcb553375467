"""Benchmark decontamination: BM25 search of test items by every training passage.

Test items are indexed: postings of BM25 impacts, each divided by the item's score for its own
text, so that a score is the share of an item that a passage holds. Every window of every document
is a query for all items at RETRIEVE or more, by block-max WAND: cursors stand at their next item,
term maxima find the next item that could reach the threshold (the pivot), maxima of the posting
blocks around it confirm or skip it, and only then is it scored. A window whose distinct terms
cannot reach the threshold together is passed over; nothing that could match is.

A retrieved item is verified by order: the longest common subsequence of words of the passage with
the item's question (all sentences but the last) and with its answer (the last sentence; the whole
item if there is one sentence only) must cover QUESTION and ANSWER of them.

Windows are twice as long as the longest item of a length class (a power of two) and start half a
window apart, so a copy of an item lies within one. Items
are searched in blocks of bounded size, each broadcast alone; document frequencies cover all items.

Defined cases: words are runs of letters and digits, lower-cased; null or wordless items are never
matched and null or wordless texts never match; items or documents that repeat are reported each;
an empty benchmark or document table gives no matches; columns other than doc_id, item_id and text
are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, text_bytes

K1, B = 1.2, 0.75
RETRIEVE = 0.5
QUESTION, ANSWER = 0.75, 0.6
MIN_LENGTH_CLASS = 32
POSTING_BLOCK = 4
#: Most of an item's own score that its terms counted as frequent make up.
FREQUENT_SHARE = 0.2
#: Strides of one document whose bounds are summed at once.
SLAB = 256
#: Bounds of a block of items.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 8 << 20

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_SLACK = 1e-9


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def split_item(text: str) -> tuple[list[str], list[str]]:
    """(question words, answer words) of an item."""
    parts = [w for s in _SENTENCE.split(text) if (w := words_of(s))]
    if len(parts) < 2:
        whole = words_of(text)
        return whole, whole
    return [w for p in parts[:-1] for w in p], parts[-1]


def common_share(part: list[str], passage: list[str]) -> float:
    """Share of ``part`` in its longest common subsequence with ``passage``, by bit-parallel rows."""
    if not part:
        return 1.0
    places: dict[str, int] = defaultdict(int)
    for i, w in enumerate(part):
        places[w] |= 1 << i
    full = (1 << len(part)) - 1
    row = full
    for w in passage:
        if hit := places.get(w):
            u = row & hit
            row = ((row + u) | (row - u)) & full
    return (len(part) - row.bit_count()) / len(part)


class _Cursor:
    """A place in the postings of one query term."""

    __slots__ = ("items", "impacts", "bound", "lasts", "maxima", "at", "item")

    def __init__(self, posting: tuple) -> None:
        self.items, self.impacts, self.bound, self.lasts, self.maxima = posting
        self.at, self.item = 0, self.items[0]

    def seek(self, item: int) -> bool:
        """Move to the first posting of ``item`` or later; False at the end."""
        self.at = bisect_left(self.items, item, self.at)
        if self.at == len(self.items):
            return False
        self.item = self.items[self.at]
        return True

    def block(self, item: int) -> int:
        return bisect_left(self.lasts, item)


class Index:
    """Items of one length class with their postings."""

    def __init__(self, items: list[tuple[int | None, str]], document_frequency: Counter, n: int, mean_length: float, reach: int) -> None:
        self.ids = [i for i, _ in items]
        self.parts = [split_item(t) for _, t in items]
        self.window, self.stride = 2 * reach, reach
        found: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for k, (_, text) in enumerate(items):
            words = words_of(text)
            norm = K1 * (1 - B + B * len(words) / mean_length)
            impacts = {w: math.log(1 + (n - document_frequency[w] + 0.5) / (document_frequency[w] + 0.5)) * f * (K1 + 1) / (f + norm) for w, f in Counter(words).items()}
            whole = sum(impacts.values())
            for w, x in impacts.items():
                found[w].append((k, x / whole))
        self.postings = {}
        for w, posting in found.items():
            ids, impacts = [k for k, _ in posting], [x for _, x in posting]
            starts = [c for c in range(len(ids)) if not c or ids[c] // POSTING_BLOCK != ids[c - 1] // POSTING_BLOCK]
            spans = list(zip(starts, [*starts[1:], len(ids)], strict=True))
            self.postings[w] = (ids, impacts, max(impacts), [ids[b - 1] for _, b in spans], [max(impacts[a:b]) for a, b in spans])
        self._bounds(found, len(items))

    def _bounds(self, found: dict[str, list[tuple[int, float]]], n: int) -> None:
        """Block maxima as arrays, and what the frequent terms give a block's items at most."""
        self.blocks = -(-n // POSTING_BLOCK)
        common, cap = np.zeros(n), np.zeros(n)
        self.frequent: set[str] = set()
        for w in sorted(found, key=lambda w: (-len(found[w]), w)):
            for k, x in found[w]:
                cap[k] += x
            if cap.max() > FREQUENT_SHARE:
                break
            common = cap.copy()
            self.frequent.add(w)
        self.cap = np.array([common[b * POSTING_BLOCK : (b + 1) * POSTING_BLOCK].max() for b in range(self.blocks)])
        self.rows = {w: i for i, w in enumerate(w for w in found if w not in self.frequent)}
        maxima = [(w, [(lasts[i] // POSTING_BLOCK, m) for i, m in enumerate(tops)]) for w in self.rows for lasts, tops in [self.postings[w][3:5]]]
        self.counts = np.array([len(m) for _, m in maxima], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)[:-1])).astype(np.int64) if len(maxima) else self.counts
        self.block_of = np.array([b for _, m in maxima for b, _ in m], dtype=np.int64)
        self.block_max = np.array([x for _, m in maxima for _, x in m], dtype=np.float64)

    def open_windows(self, rows: np.ndarray) -> list[int]:
        """Starts of the windows in which some block of items could reach the threshold.
        ``rows``: this index's row of each word, -1 for others."""
        strides = -(-len(rows) // self.stride)
        at = np.flatnonzero(rows >= 0)
        once = np.unique(at // self.stride * len(self.rows) + rows[at])  # a term counts once a stride
        at, row = once // max(len(self.rows), 1), once % max(len(self.rows), 1)
        out: list[int] = []
        for a in range(0, max(1, strides - 1), SLAB):  # windows a .. a + SLAB - 1, each of two strides
            lo, hi = np.searchsorted(at, (a, a + SLAB + 1))
            n = self.counts[row[lo:hi]]
            entry = np.repeat(self.first[row[lo:hi]] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            key = np.repeat((at[lo:hi] - a) * self.blocks, n) + self.block_of[entry]
            sums = np.bincount(key, weights=self.block_max[entry], minlength=(SLAB + 1) * self.blocks).reshape(-1, self.blocks)
            most = (sums[:-1] + sums[1:] + self.cap).max(axis=1)
            k = min(SLAB, max(1, strides - 1) - a)
            out += ((np.flatnonzero(most[:k] >= RETRIEVE - 1e-6) + a) * self.stride).tolist()
        return out

    def search(self, terms: set[str], threshold: float = RETRIEVE) -> list[tuple[int, float]]:
        """(item, score) of all items at ``threshold`` or more, by block-max WAND."""
        cursors = [_Cursor(p) for t in terms if (p := self.postings.get(t)) is not None]
        need, out = threshold - _SLACK, []
        while cursors:
            cursors.sort(key=lambda c: c.item)
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += c.bound
                if total >= need:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot].item
            while pivot + 1 < len(cursors) and cursors[pivot + 1].item == item:
                pivot += 1
            blocks = [(c, c.block(item)) for c in cursors[: pivot + 1]]
            near = sum(c.maxima[b] for c, b in blocks if b < len(c.maxima))
            if near < need:  # none of these blocks can reach it: go past the first to end
                past = min([c.lasts[b] + 1 for c, b in blocks if b < len(c.lasts)] + [x.item for x in cursors[pivot + 1 : pivot + 2]])
                past = max(past, item + 1)
                gone = [c for c in cursors[: pivot + 1] if c.item < past and not c.seek(past)]
            elif cursors[0].item == item:
                score = sum(c.impacts[c.at] for c in cursors[: pivot + 1])
                if score >= need:
                    out.append((item, score))
                gone = [c for c in cursors[: pivot + 1] if not c.seek(item + 1)]
            else:
                gone = [c for c in cursors[: pivot + 1] if c.item < item and not c.seek(item)]
            if gone:
                cursors = [c for c in cursors if c not in gone]
        return out

    def matches(self, words: list[str], rows: np.ndarray) -> dict[int, tuple[float, float, float]]:
        """item -> (score, question share, answer share), verified, best window each."""
        out: dict[int, tuple[float, float, float]] = {}
        for a in self.open_windows(rows):
            passage = words[a : a + self.window]
            terms = {w for w in passage if w in self.postings}
            for item, score in self.search(terms):
                if item in out and out[item][0] >= score:
                    continue
                question, answer = self.parts[item]
                q, r = common_share(question, passage), common_share(answer, passage)
                if q >= QUESTION and r >= ANSWER:
                    out[item] = (score, q, r)
        return out


class Block:
    """Indexes of one block of items that share a numbering of their terms."""

    def __init__(self, indexes: list[Index]) -> None:
        self.indexes = indexes
        self.numbers = {w: i for i, w in enumerate(dict.fromkeys(w for x in indexes for w in x.postings))}
        self.rows = []
        for x in indexes:
            rows = np.full(len(self.numbers) + 1, -1, dtype=np.int64)
            for w, row in x.rows.items():
                rows[self.numbers[w]] = row
            self.rows.append(rows)


def build_indexes(benchmark: DataFrame) -> Iterator[Block]:
    """Blocks of items as indexes, one per length class. The driver holds one block at a time, and
    the benchmark's vocabulary with its document frequencies."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    frequency, n, length = Counter(), 0, 0
    for r in items.toLocalIterator():
        if words := words_of(r.text):
            frequency.update(set(words))
            n, length = n + 1, length + len(words)
    if not n:
        return

    def packed(block: list[tuple[int | None, str, int]]) -> Block:
        classes = defaultdict(list)
        for item_id, text, size in block:
            classes[max(MIN_LENGTH_CLASS, 1 << (size - 1).bit_length())].append((item_id, text))
        return Block([Index(rows, frequency, n, length / n, reach) for reach, rows in sorted(classes.items())])

    block, chars = [], 0
    for r in items.toLocalIterator():
        if words := words_of(r.text):
            block.append((r.item_id, r.text, len(words)))
            chars += len(r.text)
            if len(block) >= BLOCK_ITEMS or chars >= BLOCK_CHARS:
                yield packed(block)
                block, chars = [], 0
    if block:
        yield packed(block)


def search_all(block: Block, words: list[str]) -> list[tuple[int | None, float, float, float]]:
    """(item_id, score, question share, answer share) of each verified match of a whole text."""
    if not words:
        return []
    numbers = np.fromiter(map(block.numbers.get, words, repeat(-1)), dtype=np.int64, count=len(words))
    if (numbers < 0).all():
        return []
    out = []
    for index, rows in zip(block.indexes, block.rows, strict=True):
        # the last entry serves words that no item has
        out += [(index.ids[k], *v) for k, v in sorted(index.matches(words, rows[numbers]).items())]
    return out


HITS = "array<struct<item_id:bigint,score:double,question:double,answer:double>>"


def matcher(docs: DataFrame, block: Block):
    """Text column -> array of verified matches with one block of items."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for x in texts:
            words = words_of(x.as_py().decode("utf-8", "replace"))
            found = search_all(shared.value, words)
            out.append([{"item_id": i, "score": s, "question": q, "answer": a} for i, s, q, a in found])
        return pa.array(out, pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())])))

    udf = F.arrow_udf(run, HITS)
    return lambda column: udf(text_bytes(column))


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every verified match."""
    spark = docs.sparkSession
    bound_batches(spark)
    out = None
    for block in build_indexes(benchmark):
        hits = docs.select("doc_id", F.explode(matcher(docs, block)("text")).alias("h"))
        hits = hits.select("doc_id", "h.item_id", F.round("h.score", 6).alias("score"), F.round("h.question", 6).alias("question_overlap"), F.round("h.answer", 6).alias("answer_overlap"))
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        empty: list[Column] = [F.lit(None).cast(t).alias(c) for c, t in (("item_id", "bigint"), ("score", "double"), ("question_overlap", "double"), ("answer_overlap", "double"))]
        return docs.select("doc_id", *empty).where(F.lit(False))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that match no test item, all columns as they were."""
    bound_batches(docs.sparkSession)
    out = docs
    for block in build_indexes(benchmark):
        out = out.withColumn("decontam_hits__", matcher(docs, block)("text")).where(F.size("decontam_hits__") == 0).select(*docs.columns)
    return out
