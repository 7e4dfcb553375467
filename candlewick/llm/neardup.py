"""Near-duplicate groups by a chosen-path set similarity join.

A document is the set of its distinct word shingles. Documents with equal sets form a class, which
its least doc_id stands for. TOKENS minwise tokens summarise each class. In each of TREES independent
trees, a class walks down from the root: a node picks a token position by its own hash, and the
class's token there leads to the child (a second position with probability BRANCH, so that a pair at
the threshold keeps about one common path a level). Nodes of at most NODE_LIMIT classes are compared
exhaustively; larger ones branch on, and what is still large at DEPTH is compared with pivots of the
node, which is linear in its size: one at random and the medoid, the member that agrees best with the
node's commonest tokens (as the text does that the others were copied from).

Comparing first estimates similarity from the tokens and passes on pairs over ESTIMATE (five
standard deviations under the threshold), then confirms them on the full shingle sets of the two
texts. Each class's best pair is confirmed first; of the others only those that still join
different components, so a group of thousands is linked by about as many confirmations. Members
of large nodes that are then apart from their medoid are pivots in turn, STRAYS per node and tree.
Pivots only shorten what follows: classes of large nodes that are not one component by then are
joined in full by prefix filtering. With shingles in one order for all (rare first, by a sketch of
their counts), sets at the threshold share one of the first n - ceil(0.8 n) + 1, so every pair
across components that may reach it is compared, whether or not one of the two was a pivot.

A pair at similarity 0.8 shares a path of k levels with probability 0.8 ** k per tree; the trees
miss one with probability (1 - 0.8 ** k) ** TREES: 7e-12 at level 1, 2e-4 at level 4.

Defined cases: ASCII letters are lower-cased, words are runs of other than ASCII white space; null
text and text without words have the empty set and link with nothing; fewer words than a shingle
make one shingle; a null doc_id belongs to no component; rows that share a doc_id share a
component; an empty table gives no rows; columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components, merge_components
from .shared import Scratch, bound_batches, release_caches, text_bytes

WIDTH = 4
THRESHOLD_PERCENT = 80
TOKENS = 64
TREES = 16
DEPTH = 4
NODE_LIMIT = 12
BRANCH = 0.25
ESTIMATE = 0.55
#: Bytes of a text that are hashed at once.
PIECE = 1 << 20
#: Members of a large node that are asked for its commonest tokens.
POLL = 128
#: Members apart from the rest that a large node compares with all others.
STRAYS = 1
#: Tasks that the members of one large node are dealt to where they meet their node's row.
SALTS = 16
#: Counters of the sketch that orders shingles by how common they are; it steers cost, not results.
COUNTERS = 1 << 20

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RNG.integers(0, 1 << 63, 64, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MIN_A = _RNG.integers(0, 1 << 63, TOKENS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MIN_B = _RNG.integers(0, 1 << 63, TOKENS, dtype=np.int64).astype(np.uint64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a byte array, taken PIECE bytes at a time (up to a word's end)."""
    if len(data) <= PIECE:
        return _piece_hashes(data)
    out, at = [], 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and not (stop := _IS_SPACE[data[end : end + PIECE]]).any():
            end += len(stop)
        if end < len(data):
            end += int(stop.argmax())
        out.append(_piece_hashes(data[at:end]))
        at = end
    return np.concatenate(out)


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    space = _IS_SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(starts):
        return np.empty(0, np.uint64)
    data, space, starts = data[starts[0] :], space[starts[0] :], starts - starts[0]
    place = np.arange(len(data), dtype=np.int64) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    place[space] = 0
    power = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE))
    value = _BYTE[_LOWER[data]] * power[place]
    value[space] = 0
    return _mix(np.add.reduceat(value, starts))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct sorted hashes of the shingles of one text's word hashes."""
    n = len(words)
    if not n:
        return words
    k = min(n, width)
    total = np.full(n - k + 1, k, dtype=np.uint64)
    for j in range(k):
        total += words[j : n - k + 1 + j] * _PLACE[j]
    return np.unique(_mix(total))


def minwise(shingles: np.ndarray) -> bytes:
    """TOKENS minwise tokens of a non-empty set, 32 bits each."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[None, at : at + 4096] * _MIN_A[:, None] + _MIN_B[:, None]).min(axis=1))
    return (_mix(least) >> np.uint64(32)).astype("<u4").tobytes()


def _profile(width: int):
    def run(texts: pa.Array) -> pa.Array:
        release_caches()
        n, prints, tokens = [], [], []
        for x in texts:
            raw = x.as_buffer()
            shingles = shingle_hashes(word_hashes(np.frombuffer(raw, dtype=np.uint8)), width) if raw.size else np.empty(0, np.uint64)
            n.append(len(shingles))
            prints.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
            tokens.append(minwise(shingles) if len(shingles) else None)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(tokens, pa.binary())], ["n", "print", "tokens"])

    return F.arrow_udf(run, "struct<n:bigint,print:binary,tokens:binary>")


@lru_cache(maxsize=8)
def exact_set(raw: bytes, width: int) -> frozenset:
    """The full shingle set of a text, as word sequences."""
    words = raw.lower().split()  # bytes: lower-cases A-Z, splits at ASCII white space
    k = min(len(words), width)
    return frozenset(zip(*(words[i:] for i in range(k)), strict=False)) if k else frozenset()


def linked(a: bytes, b: bytes, width: int = WIDTH) -> bool:
    """100 * intersection >= THRESHOLD_PERCENT * union, on the full sets."""
    x, y = exact_set(a, width), exact_set(b, width)
    if not x or not y or 100 * min(len(x), len(y)) < THRESHOLD_PERCENT * max(len(x), len(y)):
        return False
    both = len(x & y)
    return 100 * both >= THRESHOLD_PERCENT * (len(x) + len(y) - both)


def _token(position: Column) -> Column:
    return F.substring(F.col("tokens"), (position * 4 + 1).cast("int"), F.lit(4))


def _position(key: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(TOKENS))


def _agreement(x: pa.Array, y: pa.Array) -> pa.Array:
    """Share of equal tokens, row by row."""
    s, t = (np.frombuffer(b"".join(z.to_pylist()), dtype="<u4").reshape(-1, TOKENS) for z in (x, y))
    return pa.array((s == t).mean(axis=1), pa.float64())


def _consensus(col: pa.Array) -> pa.Array:
    """The commonest token at each position of each list of token rows."""
    out = []
    for rows in col:
        t = np.sort(np.frombuffer(b"".join(x.as_py() for x in rows.values), dtype="<u4").reshape(-1, TOKENS), axis=0)
        best = t[0].copy()
        most, run = np.zeros(TOKENS, dtype=int), np.zeros(TOKENS, dtype=int)
        for i in range(len(t)):
            run = np.where(t[i] == t[i - 1], run + 1, 1) if i else np.ones(TOKENS, dtype=int)
            best = np.where(run > most, t[i], best)
            most = np.maximum(run, most)
        out.append(best.astype("<u4").tobytes())
    return pa.array(out, pa.binary())


def _join_node(members: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
    """``members`` (key, rep, ...) with the row of their node: there are few of those, of which each
    salt gets a copy, so that a node of very many members is not one task's work."""
    copies = nodes.withColumn("n_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    dealt = members.withColumn("m_salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)))
    return dealt.join(copies, (F.col("key") == F.col(node)) & (F.col("m_salt") == F.col("n_salt"))).drop("m_salt", "n_salt")


def _with_medoid(large: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(m_key, medoid) of each large node. The commonest tokens come from about POLL members, which
    only steers the choice; every member is held against them, in one map-side combined maximum."""
    told = scratch.cut(large.join(classes.withColumnRenamed("rep", "t_rep"), F.col("rep") == F.col("t_rep")).select("key", "rep", "size", "tokens"), "told")
    polled = told.where(F.pmod(F.xxhash64("rep", "key", F.lit("poll")), F.ceil(F.col("size") / POLL)) == 0)
    polls = polled.groupBy("key").agg(F.collect_list("tokens").alias("ts")).select(F.col("key").alias("p_key"), F.arrow_udf(_consensus, "binary")("ts").alias("common"))
    held = _join_node(told, polls, "p_key")
    held = held.select("key", "rep", F.arrow_udf(_agreement, "double")("tokens", "common").alias("like"))
    held = scratch.cut(held, "held")  # apart from the grouping, so that the join can be split
    return held.groupBy(F.col("key").alias("m_key")).agg(F.max_by("rep", F.struct("like", -F.col("rep"))).alias("medoid"))


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) with their estimated similarity, those over ESTIMATE."""
    of_a = classes.select(F.col("rep").alias("ra"), F.col("tokens").alias("ta"))
    of_b = classes.select(F.col("rep").alias("rb"), F.col("tokens").alias("tb"))
    both = pairs.join(of_a, F.col("a") == F.col("ra")).join(of_b, F.col("b") == F.col("rb"))
    return both.select("a", "b", F.arrow_udf(_agreement, "double")("ta", "tb").alias("est")).where(F.col("est") >= ESTIMATE)


def candidate_pairs(classes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """(pairs, large): pairs (a, b, est) of class representatives that a common node compared, over
    ESTIMATE; and the memberships (key, rep, medoid, ...) of nodes still large at DEPTH, if any."""
    root = F.xxhash64(F.lit("tree"), F.col("tree"))
    rows = classes.select("rep", "tokens", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.select("rep", F.xxhash64(root, _token(_position(root, 0))).alias("key"))
    small, large = [], None
    for level in range(1, DEPTH + 1):
        if level > 1:
            rows = scratch.cut(rows, f"paths-{level}")
        order = F.xxhash64("rep", "key")
        nodes = rows.groupBy(F.col("key").alias("node")).agg(F.count("*").alias("size"), F.min_by("rep", order).alias("low")).where("size > 1")
        # written before it is grouped, so that a key of very many rows can be split in the join
        inside = scratch.cut(rows.join(nodes.hint("merge"), F.col("key") == F.col("node")).drop("node"), f"inside-{level}")
        # at most NODE_LIMIT members each; the same members from several trees are compared once
        small.append(inside.where(F.col("size") <= NODE_LIMIT).groupBy("key").agg(F.array_sort(F.collect_set("rep")).alias("members")).select("members").where(F.size("members") > 1))
        many = inside.where(F.col("size") > NODE_LIMIT)
        if many.isEmpty():
            break
        if level == DEPTH:
            large = scratch.cut(_join_node(many, _with_medoid(many, classes, scratch), "m_key").drop("m_key"), "large")
            break
        walk = many.select("key", F.col("rep").alias("w_rep")).join(classes, F.col("w_rep") == F.col("rep"))
        second = F.pmod(F.xxhash64("key", F.lit("second")), F.lit(1 << 20)) < int(BRANCH * (1 << 20))
        children = [F.xxhash64("key", F.lit(k), _token(_position(F.col("key"), k))) for k in (1, 2)]
        ways = F.when(second, F.array(*children)).otherwise(F.array(children[0]))
        rows = walk.select("rep", F.explode(ways).alias("key"))

    groups = small[0]
    for more in small[1:]:
        groups = groups.unionByName(more)
    groups = groups.distinct().select(F.monotonically_increasing_id().alias("group"), "members")
    groups = scratch.cut(groups, "groups")
    told = groups.select("group", F.explode("members").alias("m")).join(classes, F.col("m") == F.col("rep"))
    packed = told.groupBy("group").agg(F.collect_list(F.struct("rep", "tokens")).alias("g"))

    def compare(col: pa.Array) -> pa.Array:
        out = []
        for g in col.to_pylist():
            ids = np.array([x["rep"] for x in g], dtype=np.int64)
            t = np.frombuffer(b"".join(x["tokens"] for x in g), dtype="<u4").reshape(len(g), TOKENS)
            est = (t[:, None, :] == t[None, :, :]).mean(axis=2)
            out.append([{"a": int(min(ids[i], ids[j])), "b": int(max(ids[i], ids[j])), "est": float(est[i, j])} for i, j in zip(*np.nonzero(np.triu(est >= ESTIMATE, 1)), strict=True) if ids[i] != ids[j]])
        return pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("est", pa.float64())])))

    pairs = packed.select(F.explode(F.arrow_udf(compare, "array<struct<a:bigint,b:bigint,est:double>>")("g")).alias("p")).select("p.*")
    if large is not None:
        star = large.select("rep", F.explode(F.array("low", "medoid")).alias("lead")).where("rep <> lead")
        pairs = pairs.unionByName(_estimated(star.select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct(), classes))
    return scratch.cut(pairs.groupBy("a", "b").agg(F.max("est").alias("est")), "pairs"), large


def _confirm(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([linked(p.as_py(), q.as_py(), width) for p, q in zip(x, y, strict=True)], pa.bool_())

    of_a = texts.select(F.col("t_id").alias("ia"), F.col("t").alias("xa"))
    of_b = texts.select(F.col("t_id").alias("ib"), F.col("t").alias("xb"))
    both = pairs.select("a", "b").join(of_a, F.col("a") == F.col("ia")).join(of_b, F.col("b") == F.col("ib"))
    return both.where(F.arrow_udf(run, "boolean")("xa", "xb")).select("a", "b")


def _place_strays(labels: DataFrame, large: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    """Members of large nodes that are still apart from their medoid become pivots themselves: up
    to STRAYS of each node, others in each tree, are compared with all members apart from them."""
    of_rep = labels.select(F.col("vertex").alias("vr"), F.col("component").alias("cr"))
    of_medoid = labels.select(F.col("vertex").alias("vm"), F.col("component").alias("cm"))
    placed = large.select("key", "rep", "medoid").join(of_rep, F.col("rep") == F.col("vr"), "left").join(of_medoid, F.col("medoid") == F.col("vm"), "left")
    placed = scratch.cut(placed.select("key", "rep", F.coalesce("cr", "rep").alias("own"), F.coalesce("cm", "medoid").alias("main")), "placed")
    strays = placed.where("own <> main").withColumn("turn", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("rep", "key")))).where(F.col("turn") <= STRAYS)
    strays = scratch.cut(strays.select(F.col("key").alias("s_key"), F.col("rep").alias("stray"), F.col("own").alias("s_own")), "strays")
    if strays.isEmpty():
        return labels
    star = _join_node(placed, strays, "s_key").where("own <> s_own").select(F.least("rep", "stray").alias("a"), F.greatest("rep", "stray").alias("b"))
    near = _estimated(scratch.cut(star.distinct(), "stray-pairs"), classes)
    return merge_components(labels, scratch.cut(_confirm(near, texts, width), "links-3"), scratch, "third")


def _shingles(raw: pa.Scalar, width: int) -> np.ndarray:
    return shingle_hashes(word_hashes(np.frombuffer(raw.as_buffer(), dtype=np.uint8)), width)


def _counted(rows: DataFrame, width: int) -> np.ndarray:
    """The sketch: how many texts of ``rows`` have a shingle of each counter, COUNTERS at most."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique(_shingles(x, width) % np.uint64(COUNTERS)).astype(np.int32) for x in texts], pa.list_(pa.int32()))

    found = rows.select(F.explode(F.arrow_udf(run, "array<int>")("t")).alias("c")).groupBy("c").agg(F.count("*").alias("n")).where("n > 1").toArrow()
    counts = np.ones(COUNTERS, dtype=np.int64)
    counts[found["c"].to_numpy()] = found["n"].to_numpy()
    return counts


def _prefixes(rows: DataFrame, width: int) -> DataFrame:
    """(rep, own, n, place, h): the shingles of each text's prefix, in the common order."""
    counts = rows.sparkSession.sparkContext.broadcast(_counted(rows, width))

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for x in texts:
            s = _shingles(x, width)
            s = s[np.lexsort((s, counts.value[(s % np.uint64(COUNTERS)).astype(np.int64)]))]
            out.append({"n": len(s), "hs": s[: len(s) + THRESHOLD_PERCENT * len(s) // -100 + 1].view(np.int64)})
        return pa.array(out, pa.struct([("n", pa.int64()), ("hs", pa.list_(pa.int64()))]))

    p = rows.select("rep", "own", F.arrow_udf(run, "struct<n:bigint,hs:array<bigint>>")("t").alias("p"))
    return p.select("rep", "own", F.col("p.n").alias("n"), F.posexplode("p.hs").alias("place", "h"))


def _link_rest(labels: DataFrame, large: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    """The exact end: all classes of large nodes that are not one component yet, joined by their
    prefixes. Of a shingle's holders, those outside its commonest component meet all others."""
    of_rep = labels.select(F.col("vertex").alias("vr"), F.col("component").alias("cr"))
    held = scratch.cut(large.select("key", "rep").join(of_rep, F.col("rep") == F.col("vr"), "left").select("key", "rep", F.coalesce("cr", "rep").alias("own")), "rest")
    # unlike the medoid's component alone, this also sees members linked only to each other
    open_keys = held.groupBy(F.col("key").alias("o_key")).agg(F.min("own").alias("x"), F.max("own").alias("y")).where("x <> y").select("o_key")
    rows = _join_node(held, open_keys, "o_key").select("rep", "own").distinct()
    rows = scratch.cut(rows.join(texts, F.col("rep") == F.col("t_id")).select("rep", "own", "t").dropDuplicates(["rep"]), "rest-texts")
    if rows.isEmpty():
        return labels
    prefixes = scratch.cut(_prefixes(rows, width), "prefixes")
    by = prefixes.groupBy("h", "own").agg(F.count("*").alias("k")).groupBy(F.col("h").alias("m_h")).agg(F.max_by("own", F.struct("k", "own")).alias("main"), F.count("*").alias("owns")).where("owns > 1").select("m_h", "main")
    shared = scratch.cut(prefixes.join(by, F.col("h") == F.col("m_h")).drop("m_h"), "shared")
    x = shared.where("own <> main").select(F.col("h").alias("x_h"), F.col("rep").alias("x"), F.col("own").alias("x_own"), F.col("n").alias("x_n"), F.col("place").alias("x_place"))
    both = x.join(shared, (F.col("x_h") == F.col("h")) & (F.col("x_own") != F.col("own")) & ((F.col("own") == F.col("main")) | (F.col("x_own") < F.col("own"))))
    # the overlap that the threshold asks for, and the most that is left after this shingle
    both = both.where((100 + THRESHOLD_PERCENT) * F.least(F.col("n") - F.col("place"), F.col("x_n") - F.col("x_place")) >= THRESHOLD_PERCENT * (F.col("n") + F.col("x_n")))
    pairs = scratch.cut(both.select(F.least("x", "rep").alias("a"), F.greatest("x", "rep").alias("b")).distinct(), "rest-pairs")
    near = scratch.cut(_estimated(pairs, classes), "rest-near")
    scratch.drop("rest-texts", "prefixes", "shared")
    return merge_components(labels, scratch.cut(_confirm(near, texts, width), "links-4"), scratch, "fourth")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "neardup")
    p = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _profile(width)(text_bytes()).alias("p"))
    p = scratch.cut(p.select("doc_id", F.col("p.n").alias("n"), F.col("p.print").alias("print"), F.col("p.tokens").alias("tokens")), "profiles")
    # equal sets: a map-side combined minimum, one row per task for the largest group of copies
    classes = p.where("n > 0 AND doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens"), F.count("*").alias("copies"))
    classes = scratch.cut(classes, "classes")
    pairs, large = candidate_pairs(classes.select("rep", "tokens"), scratch)

    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    if large is not None:
        ids = ids.unionByName(large.select(F.col("rep").alias("id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("t_id"), text_bytes().alias("t")).join(ids.distinct().hint("merge"), F.col("t_id") == F.col("id"), "left_semi")
    texts = scratch.cut(texts, "texts")
    directed = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "est"))
    best = directed.groupBy("a").agg(F.max_by("b", F.struct("est", "b")).alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    labels = connected_components(scratch.cut(_confirm(best, texts, width), "links-1"), scratch, "first")
    of_a = labels.select(F.col("vertex").alias("va"), F.col("component").alias("ca"))
    of_b = labels.select(F.col("vertex").alias("vb"), F.col("component").alias("cb"))
    apart = pairs.join(best, ["a", "b"], "left_anti").join(of_a, F.col("a") == F.col("va"), "left").join(of_b, F.col("b") == F.col("vb"), "left")
    apart = apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    labels = merge_components(labels, scratch.cut(_confirm(apart, texts, width), "links-2"), scratch, "second")
    if large is not None:
        labels = _place_strays(labels, large, classes, texts, scratch, width)
        labels = _link_rest(labels, large, classes, texts, scratch, width)
    scratch.drop("texts")

    whole = classes.join(labels, F.col("rep") == F.col("vertex"), "left").select(F.col("print").alias("c_print"), F.coalesce("component", "rep").alias("c_id"))
    # copies find their class: plain keys, which adaptive execution splits where a class is large
    out = p.join(whole.hint("merge"), F.col("print") == F.col("c_print"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5) -> DataFrame:
    """One row of ``docs`` per group of near-duplicates (that of the least doc_id), all columns as they were."""
    kept = near_duplicates(docs, width).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("neardup_id__")).distinct()
    named = docs.withColumn("neardup_key__", F.col("doc_id").cast("long"))
    out = named.join(kept.hint("merge"), F.col("neardup_key__") == F.col("neardup_id__"), "left_semi")
    # rows that repeat a doc_id: the partitioning of the join serves again
    out = out.dropDuplicates(["neardup_key__"]).select(*docs.columns)
    return out.unionByName(docs.where(F.col("doc_id").isNull()))
