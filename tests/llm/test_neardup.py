import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from candlewick.llm import neardup as N
from candlewick.llm.components import connected_components, merge_components
from candlewick.llm.shared import Scratch


def brute(texts, width):
    """{id: (set size, component)} from all pairs that share a shingle."""
    sets = {i: N.exact_set((t or "").encode(), width) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for g in sets[i] for j in index[g])
        for g in sets[i]:
            index[g].append(i)
        for j, k in shared.items():
            if 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def got(docs, width=N.WIDTH):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(docs, width).collect()}


def corpus(seed, n, groups):
    rnd = random.Random(seed)
    words = [f"v{i}" for i in range(4000)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 150))) for _ in range(n)]
    for size, edits in groups:
        base = rnd.choices(words, k=120)
        for _ in range(size):
            copy = base[:]
            for _ in range(rnd.randint(0, edits)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            texts.append(" ".join(copy))
    rnd.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("width", [4, 5])
def test_against_brute_force(make_docs, width):
    texts = corpus(1, 150, [(2, 1), (3, 2), (6, 3), (40, 2), (60, 4)])
    assert got(make_docs([(i, t, "en", "a") for i, t in texts.items()]), width) == brute(texts, width)


@pytest.mark.parametrize("seed", [11, 12])
def test_large_groups_of_borderline_copies(make_docs, seed):
    texts = corpus(seed, 40, [(2, 1), (60, 4), (250, 4)])
    assert got(make_docs([(i, t, "en", "a") for i, t in texts.items()])) == brute(texts, 4)


def test_copies_linked_to_the_original_only(make_docs):
    rnd = random.Random(9)
    words = [f"v{i}" for i in range(4000)]
    base = rnd.choices(words, k=200)
    texts = {0: " ".join(base)}
    for i in range(1, 80):  # five apart words changed: 0.8 and more to the original, far less to each other
        copy = base[:]
        for at in rnd.sample(range(0, 200, 6), 5):
            copy[at] = f"own{i}x{at}"
        texts[i] = " ".join(copy)
    assert got(make_docs([(i, t, "en", "a") for i, t in texts.items()])) == brute(texts, 4)


def test_pairs_on_one_template(make_docs):
    # 0.76 to all others, 0.83 to the one pair member: nodes stay large, and few paths tell a pair from the rest
    template, texts = [f"t{i}" for i in range(400)], {}
    for n in range(150):
        for i in (2 * n, 2 * n + 1):
            texts[i] = " ".join([*template, *(f"pair{n}x{k}" for k in range(20)), *(f"own{i}x{k}" for k in range(43))])
    want = brute(texts, 4)
    assert len({c for _, c in want.values()}) == 150
    assert got(make_docs([(i, t, "en", "a") for i, t in texts.items()])) == want


def test_merge_components(spark):
    scratch = Scratch(spark, "cc")
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "vertex long, component long")
    out = merge_components(labels, spark.createDataFrame([(2, 6), (10, 11), (9, 8)], "a long, b long"), scratch, "m")
    assert {r.vertex: r.component for r in out.collect()} == {1: 1, 2: 1, 5: 1, 6: 1, 8: 8, 9: 8, 10: 10, 11: 10}
    assert merge_components(labels, spark.createDataFrame([(1, 2)], "a long, b long"), scratch, "n").count() == 6


def test_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(docs) == brute({r.doc_id: r.text for r in docs.collect()}, 4)


def test_odd_rows(make_docs, odd_docs):
    rows = [*odd_docs, (8, "Two words", "en", "a"), (9, "two WORDS", "en", "a"), (10, "two words more", "en", "a"), (11, "ÀB two words", "en", "a"), (12, "àb two words", "en", "a")]
    out = N.near_duplicates(make_docs(rows)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[i].n_shingles for i in (1, 2, 3, 8)] == [0, 0, 0, 1]
    assert by[6].component_id == 5 and not by[6].kept and by[9].component_id == 8 and by[10].component_id == 10 and by[12].component_id == 12
    assert by[None].component_id is None and by[None].kept
    assert all(r.component_id == r.doc_id for r in out if r.doc_id in (1, 2, 3, 4))
    kept = N.keep_one(make_docs([*rows, (4, odd_docs[3][1], "en", "b")]))
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 7, 8, 10, 11, 12]
    assert N.near_duplicates(make_docs([])).count() == 0 and N.keep_one(make_docs([])).count() == 0


def test_word_hashes_match_words():
    rnd = random.Random(3)
    for _ in range(200):
        raw = "".join(rnd.choice("aAbZé \t\n") for _ in range(rnd.randint(1, 60))).encode()
        hashes = N.word_hashes(np.frombuffer(raw, dtype=np.uint8))
        words = raw.lower().split()
        assert len(words) == len(hashes)
        assert len(set(words)) == len(set(hashes.tolist())) and all((words[i] == words[j]) == (hashes[i] == hashes[j]) for i in range(len(words)) for j in range(i))


def test_pieces_do_not_change_the_hashes(monkeypatch):
    rnd = random.Random(8)
    texts = [("".join(rnd.choice("aAb é\n") for _ in range(rnd.randint(1, 300)))).encode() for _ in range(100)] + [b"x" * 500 + b" y", b"  " + b"z" * 40]
    whole = [N.word_hashes(np.frombuffer(t, dtype=np.uint8)).tolist() for t in texts]
    monkeypatch.setattr(N, "PIECE", 16)
    assert [N.word_hashes(np.frombuffer(t, dtype=np.uint8)).tolist() for t in texts] == whole


def test_threshold_is_exact():
    a = [f"w{i}" for i in range(13)]  # 10 shingles of 4
    assert N.linked(" ".join(a[:12]).encode(), " ".join(a).encode())  # 9 of 10
    assert N.linked(" ".join(a[:11]).encode(), " ".join(a).encode())  # 8 of 10
    assert not N.linked(" ".join(a[:10]).encode(), " ".join(a).encode())  # 7 of 10
    assert not N.linked(b"", b"")


def test_components(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(150)] + [(7000, 7000)]
    parent = {x: x for e in links for x in e if e[0] != e[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    out = connected_components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "cc"), "t")
    assert {r.vertex: r.component for r in out.collect()} == {x: root(x) for x in parent}
