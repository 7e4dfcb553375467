import zlib

import numpy as np
from pyspark.sql import functions as F

from candlewick.llm import langid as L


def test_grams_stay_in_words():
    clean = L._CLEAN[np.frombuffer(b" ab cd ", dtype=np.uint8)]
    at, _ = L.gram_hashes(clean, 3)
    assert at.tolist() == [0, 1, 3, 4]  # " ab", "ab ", " cd", "cd "
    assert len(L.gram_hashes(clean[:2], 3)[0]) == 0


def test_chunks_do_not_change_the_sums(monkeypatch):
    rng = np.random.default_rng(0)
    texts = [b" " + bytes(rng.choice(list(b"abc  de"), int(n))) + b" " for n in (0, 5, 300, 1, 4000, 77)]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    m = L.Model(["a", "b"], rng.normal(size=(L.BUCKETS, 2)).astype(np.float32), np.zeros(2), 1.0, 0.0)
    whole = m.sums(data, offsets)
    monkeypatch.setattr(L, "CHUNK", 64)
    parts = m.sums(data, offsets)
    assert np.allclose(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def test_held_out_accuracy_and_acceptance(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert r.right > 0.98 and 0 <= r.low and r.high <= 1
    kept = L.accept(docs)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()


def test_odd_rows(spark, make_docs, odd_docs):
    rows = [*odd_docs, (8, "12 34 !!", "en", "a")]
    out = L.identify(make_docs(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id in (1, 2, 3, 8):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in {"en", "de", "fr"} and 0 <= r.score <= 1
    assert {r.doc_id for r in L.accept(make_docs(rows)).collect()}.isdisjoint({1, 2, 3, 8})


def test_nothing_and_one_language_to_learn(make_docs):
    out = L.identify(make_docs([(1, "some words", None, "a")])).collect()
    assert (out[0].lang_pred, out[0].score) == ("und", 0.0)
    # ids outside the held-out fold
    rows = [(i, "only this language here", "en", "a") for i in range(9)]
    assert {r.lang_pred for r in L.identify(make_docs(rows)).collect()} == {"en"}
    assert L.identify(make_docs([])).count() == 0 and L.accept(make_docs([])).count() == 0


def plain_bag(text):
    """Shares of the 3- and 4-grams by definition, through the one hash of a single gram."""
    clean = bytes(L._CLEAN[np.frombuffer(b" " + text + b" ", dtype=np.uint8)])
    counts = {}
    for n in L.GRAMS:
        for i in range(len(clean) - n + 1):
            gram = clean[i : i + n]
            if b" " not in gram[1:-1]:
                b = int(L.gram_hashes(np.frombuffer(gram, dtype=np.uint8), n)[1][0])
                counts[b] = counts.get(b, 0) + 1
    return {b: c / sum(counts.values()) for b, c in counts.items()}


def test_bags_and_predictions_against_the_definition(monkeypatch):
    rng = np.random.default_rng(3)
    m = L.Model(["a", "b", "c"], rng.normal(size=(L.BUCKETS, 3)).astype(np.float32), rng.normal(size=3), 0.7, 0.0)
    texts = [bytes(rng.choice(list(b"abcdefg  "), int(n))) for n in (4, 30, 200, 900)]
    data = [b" " + t + b" " for t in texts]
    best, score = m.predict(np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum([0] + [len(d) for d in data]))
    monkeypatch.setattr(L, "CHUNK", 50)
    for t, k, s in zip(texts, best, score, strict=True):
        want = plain_bag(t)
        u, c = L._bag(t)
        assert dict(zip(u.tolist(), c.tolist())) == {b: np.float32(x) for b, x in want.items()}
        z = (sum(x * m.logits[b].astype(float) for b, x in plain_bag(t).items()) + m.bias) / 0.7
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert k == p.argmax() and abs(s - p.max()) < 1e-6


def test_rows_without_ids_and_copies_are_drawn_like_others(make_docs, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "fit", lambda samples, labels: seen.append((len(samples), len(labels))))
    L.train(make_docs([(None, f"words of text {i} {i * i}", "en", "a") for i in range(400)]), 40)
    open_id = next(i for i in range(1, 9) if zlib.crc32(str(i).encode()) % 3 != 1)
    L.train(make_docs([(open_id, "the very same text", "en", "a")] * 400), 400)
    assert 15 < seen[0][0] < 80 and seen[1] == (1, 1)
