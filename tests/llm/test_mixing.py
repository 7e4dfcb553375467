import hashlib

import pytest

from candlewick.llm import mixing as M


def brute_targets(sizes):
    """Shares by weight; the excess over 3 times the size is reshared until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    left = float(sum(sizes.values()))
    while left > 1e-9:
        open_ = [s for s in names if s not in full]
        if not open_:
            break
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in open_:
            target[s] += share * weight[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                full.add(s)
    return target


def rows_of(sizes, docs_each=7):
    rows, doc = [], 0
    for source, size in sizes.items():
        for k in range(docs_each):
            n = size // docs_each + (size % docs_each if k == 0 else 0)
            rows.append((doc, " ".join(["w"] * n), "en", source))
            doc += 1
    return rows


@pytest.mark.parametrize("sizes", [{"a": 700, "b": 300, "c": 50}, {"a": 10, "b": 10, "c": 1000, "d": 40, None: 60}, {"x": 0, "y": 90}, {None: 30}, {"é": 80, "z": 80, "Z": 500}])
def test_targets_and_taken(make_docs, sizes):
    rows = rows_of(sizes)
    out = {r.doc_id: r for r in M.schedule(make_docs(rows)).collect()}
    assert len(out) == len(rows)
    want = brute_targets(sizes)
    for source, size in sizes.items():
        mine = [out[d] for d, _, _, s in rows if s == source]
        assert all(r.source_size == size and r.target == pytest.approx(want[source], abs=1e-6) for r in mine)
        assert all(r.taken <= 3 * r.size and r.taken == r.size * r.copies == r.size * len(r.positions) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[source]) <= max(r.size for r in mine)
        assert all(0 <= p <= 1 for r in mine for p in r.positions)
        # against laying the documents out one by one
        at, order = 0, sorted(mine, key=lambda r: (hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id))
        for r in order:
            assert r.copies == sum(r.size > 0 and at + k * size + r.size / 2 <= r.target for k in range(3))
            at += r.size


def test_slices_do_not_change_the_result(make_docs, monkeypatch):
    docs = make_docs(rows_of({"a": 900, "b": 200}, 40))
    one = sorted(tuple(r) for r in M.schedule(docs).collect())
    monkeypatch.setattr(M, "SLICE_ROWS", 3)
    assert sorted(tuple(r) for r in M.schedule(docs).collect()) == one


def test_inverse_of_demand(spark):
    from pyspark.sql import functions as F

    for slope in (-0.5, 0.0, 0.5):
        for r in spark.range(0, 11).select((F.col("id") / 10.0).alias("q")).select("q", M.invert(F.col("q"), F.lit(slope)).alias("x")).collect():
            assert r.x + slope * (r.x * r.x - r.x) == pytest.approx(r.q, abs=1e-12)


def test_mixed_rows(make_docs, odd_docs):
    docs = make_docs(odd_docs)
    plan = M.schedule(docs).collect()
    assert len(plan) == len(odd_docs) and all(r.taken == 0 for r in plan if r.size == 0)
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies if r.doc_id != 6 else max(p.copies for p in plan if p.doc_id == 6) for r in plan)
    assert M.mix(make_docs([])).count() == 0 and M.schedule(make_docs([])).count() == 0


def test_order_follows_position(make_docs):
    docs = make_docs(rows_of({"a": 900, "b": 600, "c": 300}, 30))
    at = {r.doc_id: min(r.positions) for r in M.schedule(docs).collect() if r.positions}
    seen, order = set(), [r.doc_id for r in M.mix(docs).collect()]
    first = [x for x in order if not (x in seen or seen.add(x))]
    assert [at[x] for x in first] == sorted(at[x] for x in first)


def test_rows_sharing_an_id_are_mixed_by_themselves(make_docs):
    from collections import Counter

    rows = [(1, "rare " * 20, "en", "c"), (1, "common " * 400, "en", "a"), (2, "more " * 600, "en", "a"), (1, "rare " * 20, "en", "c"), (None, "none " * 30, "en", "b"), (None, "null " * 50, "en", "a")]
    docs = make_docs(rows)
    plan = Counter()
    for r in M.schedule(docs).collect():
        plan[r.doc_id, r.size] += r.copies
    mixed = Counter((r.doc_id, len(r.text.split())) for r in M.mix(docs).collect())
    assert len({n for (i, _), n in plan.items() if i == 1}) > 1
    assert mixed == Counter({k: n for k, n in plan.items() if n})


def test_report_comes_from_the_mix_in_order(make_docs, odd_docs, monkeypatch):
    docs = make_docs(odd_docs + rows_of({"d": 900, "e": 300}, 30) + [(3, "one more row of three", "en", "d")])
    first = lambda r: min(r.positions) if r.positions else None
    order = lambda rows: sorted(rows, key=repr)
    want = order((r.doc_id, r.size, r.source_size, r.target, r.taken, first(r)) for r in M.schedule(docs).collect())
    written = {}
    cut = M.Scratch.cut

    def spy(self, df, name):
        written[name] = back = cut(self, df, name)
        if name == "mix":
            written["files"] = [[r.mix_at__ for r in self.spark.read.parquet(f).collect()] for f in sorted(back.inputFiles())]
        return back

    monkeypatch.setattr(M.Scratch, "cut", spy)
    assert order(tuple(r) for r in M.mix_report(docs).collect()) == want
    # the files, one after the other, are in training order and hold every copy
    at = [x for file in written["files"] for x in file]
    assert at == sorted(at) and len(at) == sum(r.copies for r in M.schedule(docs).collect())
    assert M.mix_report(make_docs([])).count() == 0


def test_query_counts_what_the_mix_holds(spark, sf_dir, monkeypatch):
    from candlewick.llm.queries import op5_mixing

    whole = op5_mixing(spark, sf_dir).collect()
    in_order = M._in_order
    monkeypatch.setattr(M, "_in_order", lambda *given: in_order(*given).where("mix_at__ < 0.5"))
    half = {r.doc_id: r for r in op5_mixing(spark, sf_dir).collect()}
    late = [r for r in whole if r.first_position is not None and r.first_position > 0.5]
    assert late and all(half[r.doc_id].taken == 0 and half[r.doc_id].first_position is None for r in late)
    assert all(half[r.doc_id].first_position == r.first_position for r in whole if r.first_position is not None and r.first_position < 0.5)


def test_positions_are_not_rounded(make_docs):
    slope = {"a": -0.5, "b": 0.0, "c": 0.5}
    rows = rows_of({"a": 700, "b": 300, "c": 50}, 6)
    source = {i: s for i, _, _, s in rows}
    for r in M.schedule(make_docs(rows)).collect():
        for x in r.positions:
            # twice the words before a copy's middle is a whole number
            y = 2 * r.target * (x + slope[source[r.doc_id]] * (x * x - x))
            assert y == pytest.approx(round(y), abs=1e-9)
