import random
import zlib

import numpy as np

from candlewick.llm.shared import Scratch
from candlewick.llm.token_store import END_ID, Encoder, read_ids, read_index, read_store, token_store, tokenizer_path, write_store


def plain(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_pieces_encode_as_whole_texts():
    rnd = random.Random(5)
    alphabet = list("aAzZéÉİıßǅ.,;:!?'sdt09 \t\n \x1ċ̌Jj-_<|>中🙂«»×÷³·. , .") + ["<|endoftext|>", "'ll", "<|startoftext|>", "the ", "Words, "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(6000)] + ["x" * 5000, ""]
    enc = Encoder(tokenizer_path())
    for _ in range(2):  # the second time from the memo
        got = [np.frombuffer(x, dtype=enc.dtype).tolist() for x in enc.encode([t.encode() for t in texts])]
        assert got == plain(texts)


def test_store_round_trip(spark, make_docs, odd_docs):
    docs = make_docs(odd_docs)
    out = sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in token_store(docs).collect())
    start = 0
    rows = sorted(odd_docs, key=lambda r: (r[0] is not None, r[0] or 0))
    for (_, got_id, got_start, n, crc), (doc_id, text, *_), ids in zip(out, rows, plain([r[1] or "" for r in rows]), strict=True):
        ids = np.array([*ids, END_ID], dtype="<u4")
        assert (got_id, got_start, n, crc) == (doc_id or 0, start, len(ids), zlib.crc32(ids.tobytes()))
        start += n


def test_short_access_and_index(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = Scratch(spark, "t").path("store")
    write_store(docs, path)
    some = docs.orderBy("doc_id").limit(3).collect()
    for r, ids in zip(some, plain([r.text for r in some]), strict=True):
        assert read_ids(spark, path, r.doc_id)[0].tolist() == [*ids, END_ID]
    assert read_index(spark, path).count() == docs.count() == read_store(spark, path).count()
    assert read_ids(spark, path, -5) == []


def test_empty(make_docs):
    assert token_store(make_docs([])).collect() == []


def test_other_vocabularies_are_encoded_whole():
    import glob
    import os

    from tokenizers import Tokenizer

    texts = ["The quick Brown fox, it said: 12 dogs.", "  two  spaces\tand é. ", "", "中文 ok"]
    others = [f for f in glob.glob(os.path.join(os.path.dirname(tokenizer_path()), "*.json")) if f != tokenizer_path()]
    for path in others:
        try:
            t = Tokenizer.from_file(path)
        except Exception:  # another kind of file
            continue
        enc = Encoder(path)
        assert [np.frombuffer(x, dtype=enc.dtype).tolist() for x in enc.encode([x.encode() for x in texts])] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)], path
    assert Encoder(tokenizer_path()).by_pieces


def test_shards_by_halving(spark):
    from pyspark.sql import functions as F

    from candlewick.llm.token_store import _below

    for bounds in ([], [5], [1, 4, 9, 9000], list(range(0, 300, 7))):
        for r in spark.range(0, 320).select(F.col("id").alias("doc_id")).select("doc_id", _below(bounds, 0).alias("s")).collect():
            assert r.s == sum(b < r.doc_id for b in bounds)
