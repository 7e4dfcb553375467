"""Correlation of features and clusters of correlated ones."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.frames import KEYS
from ..shipping import ship

MIN_PRODUCT = 1e-9
THRESHOLD = 0.95
#: Features along one side of a block of the Gram matrix.
BLOCK = 256


def row_vectors(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per bar the values of the ``wanted`` features (idx, from 0 in rank order) as one array; the
    array is as long as the feature list, whatever the number of bars."""
    ranked = cells.join(F.broadcast(wanted), "idx")  # no longer than the schema
    return ranked.groupBy(*KEYS, "rn").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"]).alias("x"))


def gram(vectors: DataFrame, k: int, centre: Sequence[float] | None = None) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, products) of the k-long arrays in column ``x``, in double and about ``centre`` (some
    value within each feature's range; without it, any row, which costs a run of the input), so that
    large levels do not cancel: products are centred on the overall mean at the end.

    Each task adds up its partial matrix (8 k**2 bytes, and as much while a batch is multiplied) and
    sends it in blocks; blocks are added where they meet. The k x k result comes to the driver, where
    ``pearson`` and the linkage take about five such matrices: 2.5 GB at 7,841 features.
    """
    ship(vectors.sparkSession)
    cuts = [(a, min(a + BLOCK, k)) for a in range(0, k, BLOCK)]
    schema = "i int, j int, n bigint, s binary, q binary"
    if centre is None:
        centre = vectors.select("x").first()[0] if k else []
    centre = np.array(centre, dtype=float)
    centre = np.where(np.isfinite(centre), centre, 0.0)

    def rows(parts) -> pa.RecordBatch:
        cols = list(zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())], names=["i", "j", "n", "s", "q"])

    def partial(batches):
        n, s, q = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k) - centre
            n, s = n + len(x), s + x.sum(axis=0)
            with np.errstate(all="ignore"):
                q += x.T @ x
        if n:
            for i, (a, b) in enumerate(cuts):
                for j, (c, d) in enumerate(cuts[i:], i):
                    yield rows([(i, j, n, s[a:b].tobytes() if i == j else b"", q[a:b, c:d].tobytes())])

    def merge(table: pa.Table) -> pa.Table:
        add = lambda name: sum(np.frombuffer(x.as_py()) for x in table.column(name)).tobytes() if table.column(name)[0].as_py() else b""
        return pa.Table.from_batches([rows([(table.column("i")[0].as_py(), table.column("j")[0].as_py(), sum(table.column("n").to_pylist()), add("s"), add("q"))])])

    sums, products, n = np.zeros(k), np.zeros((k, k)), 0
    for r in vectors.select("x").mapInArrow(partial, schema).groupBy("i", "j").applyInArrow(merge, schema).toLocalIterator():
        (a, b), (c, d) = cuts[r.i], cuts[r.j]
        n = r.n
        products[a:b, c:d] = np.frombuffer(bytes(r.q)).reshape(b - a, d - c)
        products[c:d, a:b] = products[a:b, c:d].T
        if r.i == r.j:
            sums[a:b] = np.frombuffer(bytes(r.s))
    return n, sums, products


def pearson(n: int, sums: np.ndarray, products: np.ndarray, least: float = MIN_PRODUCT) -> np.ndarray:
    """Correlations from sums; 0 where the product of the deviations is under ``least`` or NaN is about."""
    if n < 2:
        return np.eye(len(sums))
    with np.errstate(all="ignore"):
        cov = (products - np.outer(sums, sums) / n) / (n - 1)
        dev = np.sqrt(np.maximum(np.nan_to_num(np.diag(cov), nan=0.0), 0.0))
        scale = np.outer(dev, dev)
        r = np.where(scale < least, 0.0, np.clip(cov / scale, -1.0, 1.0))
    return np.nan_to_num(r, nan=0.0)


def distances(r: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, 1.0 - np.abs(r))


def average_linkage(dist: np.ndarray, cut: float) -> list[int]:
    """Cluster label of each item: average-linkage merges up to height ``cut``, by chains of nearest
    neighbours on one working copy of the matrix. Average linkage never inverts, so chains reach the
    merges of the greedy order; labels are the least member."""
    n = len(dist)
    d = np.array(dist, dtype=float)
    np.fill_diagonal(d, np.inf)
    size, alive = np.ones(n), np.ones(n, dtype=bool)
    label = np.arange(n)
    chain: list[int] = []
    for _ in range(n - 1):
        if not chain:
            left = np.flatnonzero(alive)
            if len(left) < 2:
                break
            chain = [int(left[0])]
        while True:
            top = chain[-1]
            near = int(np.argmin(d[top]))
            if len(chain) > 1 and d[top, chain[-2]] <= d[top, near]:
                near = chain[-2]
            if len(chain) > 1 and near == chain[-2]:
                break
            chain.append(near)
        a, b = sorted((chain.pop(), chain.pop()))
        if d[a, b] <= cut:
            label[label == label[b]] = label[a]
        row = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
        d[a], d[:, a] = row, row
        d[a, a] = np.inf
        d[b], d[:, b] = np.inf, np.inf
        size[a] += size[b]
        alive[b] = False
    least = {}
    for i, x in enumerate(label.tolist()):
        least.setdefault(x, i)
    return [least[x] for x in label.tolist()]


def representatives(names: Sequence[str], r: np.ndarray, threshold: float = THRESHOLD) -> tuple[list[str], list[int]]:
    """(the first feature of each cluster in schema order, each feature's cluster by its first member)."""
    if len(names) < 2:
        return list(names), [0] * len(names)
    label = average_linkage(distances(r), 1.0 - threshold)
    return [n for i, n in enumerate(names) if label[i] == i], label
