import random
from collections import Counter

from candlewick.llm import decontam as D

ITEM = "The ferry leaves the old harbour at seven in the evening. How many passengers wait on the northern pier? Forty two passengers wait there."
FILL = "plain filler words about gardens rivers stones and quiet mornings without any question at all "


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, bench):
    return {(r.doc_id, r.item_id) for r in D.find_contamination(docs, bench).collect()}


def test_planted_copies(spark, make_docs, odd_docs):
    words = ITEM.split()
    edited = " ".join(words[:6] + ["dark"] + words[7:15] + words[16:])
    rows = [*odd_docs, (20, FILL * 9 + ITEM + FILL * 9, "en", "a"), (21, ITEM.upper(), "en", "a"), (22, FILL * 30 + edited, "en", "a"), (23, FILL * 20, "en", "a"), (24, " ".join(sorted(words)) + FILL, "en", "a"), (25, ITEM.split(". ")[0], "en", "a")]
    bench = items(spark, [(1, ITEM), (2, None), (3, "..."), (None, "Another item that nobody copied anywhere here. Really nobody."), (4, ITEM)])
    assert found(make_docs(rows), bench) == {(d, i) for d in (20, 21, 22) for i in (1, 4)}
    kept = D.decontaminate(make_docs(rows), bench)
    assert kept.columns == make_docs(rows).columns and kept.count() == len(rows) - 3


def test_empty_tables(spark, make_docs):
    assert found(make_docs([]), items(spark, [(1, ITEM)])) == set()
    assert found(make_docs([(1, ITEM, None, None)]), items(spark, [])) == set()
    assert D.decontaminate(make_docs([(1, ITEM, None, None)]), items(spark, [])).count() == 1


def _index(rnd, n):
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rnd.choices(vocabulary, weights=[1 / (i + 1) for i in range(300)], k=rnd.randint(5, 30))) for _ in range(n)]
    frequency = Counter(w for t in texts for w in set(D.words_of(t)))
    return D.Index(list(enumerate(texts)), frequency, n, sum(len(t.split()) for t in texts) / n, 32), vocabulary


def brute(index, terms, threshold):
    total = Counter()
    for t in terms:
        for k, x in zip(*index.postings.get(t, ((), ()))[:2], strict=True):
            total[k] += x
    return {k for k, s in total.items() if s >= threshold - 1e-9}


def test_wand_finds_all_above_threshold():
    rnd = random.Random(2)
    index, vocabulary = _index(rnd, 150)
    for _ in range(400):
        terms = set(rnd.sample(vocabulary, rnd.randint(1, 60)))
        for threshold in (0.1, 0.3, 0.5, 0.8):
            assert {k for k, _ in index.search(terms, threshold)} == brute(index, terms, threshold)


def test_no_window_that_matches_is_passed_over():
    rnd = random.Random(3)
    index, vocabulary = _index(rnd, 60)
    block = D.Block([index])
    for _ in range(40):
        words = rnd.choices(vocabulary, weights=[1 / (i + 1) for i in range(300)], k=rnd.randint(1, 400))
        numbers = [block.numbers.get(w, -1) for w in words]
        import numpy as np

        got = set(index.open_windows(block.rows[0][np.array(numbers)]))
        for a in range(0, max(1, len(words) - index.window + index.stride), index.stride):
            if brute(index, set(words[a : a + index.window]), D.RETRIEVE):
                assert a in got


def test_common_share_against_dynamic_programming():
    rnd = random.Random(4)
    for _ in range(200):
        a, b = [rnd.choices("abcd", k=rnd.randint(0, 12)) for _ in range(2)]
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(row[j], last[j + 1])
        assert D.common_share(a, b) == (row[-1] / len(a) if a else 1.0)


def test_verbatim_leaks_of_the_tables(spark, sf_dir):
    docs, bench = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    flat = {r.item_id: " ".join(r.text.split()) for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in flat.items() if t in " ".join(r.text.split())}
    assert want <= found(docs, bench)
    assert len({d for d, _ in found(docs, bench)} - {d for d, _ in want}) == 0


def test_blocks_of_items(spark, make_docs, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 2)
    other = "Seven painters shared one studio above the bakery. Who paid the rent? The youngest of them paid it."
    bench = items(spark, [(i, t) for i, t in enumerate([ITEM, other, ITEM, other, "A last item of its own with some words. Yes indeed."])])
    assert found(make_docs([(1, FILL + ITEM, "en", "a"), (2, other + FILL, "en", "b")]), bench) == {(1, 0), (1, 2), (2, 1), (2, 3)}
