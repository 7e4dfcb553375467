"""Token ids in a compressed binary format with per-document access.

A store is a folder of two Parquet tables that Spark writes, so lost executors and retried tasks
leave no partial files:

``dictionary``  one row: ``dict_hash`` (SHA-256), ``dictionary`` (zstandard), ``width`` (bytes per id).
``blocks``      rows of about BLOCK_BYTES: ``shard``, ``block``, ``dict_hash``, the arrays ``doc_ids``,
                ``offsets``, ``sizes``, ``n_tokens`` and ``starts`` (the offset index), and ``data``:
                the frames, one zstandard frame per document, end to end.

The index columns are read without the data. Shards hold consecutive ranges of doc_id in ascending
order (null first), so a document is found by its block's range, its offset and the frame there.
The dictionary is trained on the whole ids of a bounded, documented sample (of the DICT_SAMPLE
documents with the smallest hash of their id, those of up to DICT_TEXT bytes; it serves short ones);
it changes sizes, never contents. Ids are little-endian unsigned,
2 bytes if the vocabulary allows it, else 4.

Defined cases: null or empty text is the end id alone; rows repeating a doc_id are stored each, in
an unspecified order among themselves; an empty table gives an empty store; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, bound_batches, register_cache, text_bytes

TOKENIZER_FILE = "word_bpe_49k.json"
END_ID = 1
DICT_SAMPLE = 512
#: The longest text that the dictionary is trained on, in bytes, and the dictionary's size.
DICT_TEXT = 64 << 10
DICT_BYTES = 64 << 10
LEVEL = 3
BLOCK_BYTES = 1 << 20
#: White-space-separated pieces that are remembered per Python worker, and the longest of them.
MEMO_PIECES = 1_000_000
MEMO_PIECE_BYTES = 48
#: Bytes of characters up to U+00FF, and a closing mark between a letter and white space.
_NARROW = bytes(range(0xC4))
_CLOSING = re.compile(rb"(?:(?<=[a-z])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([.,;:!?])(?=[\x09-\x0d\x20]|\Z)")

#: Letters (here all of 80-FF too), white space, closing marks and the rest.
_KINDS = bytes(97 if chr(c).isalpha() and c < 128 or c >= 0x80 else 32 if c == 32 or 9 <= c <= 13 else 46 if chr(c) in ".,;:!?" else 120 for c in range(256))

#: Texts that tell whether a vocabulary reads across white space, keeps case or splits marks otherwise.
PROBE = [
    t.encode()
    for t in ("The quick Brown fox, it said: jumps! (over) 12 dogs; 3.14 and well-known e.g. x_y.\nNew line.\tTab  two  spaces ", " Ünïcode Wörter, ÀÉ ß × ÷ ¿qué? «non».", "中文 字符, 🙂 ok. don't I'LL", "a", "", " ")
]

BLOCK_SCHEMA = "shard int, block int, dict_hash string, first_id bigint, last_id bigint, doc_ids array<bigint>, offsets array<bigint>, sizes array<int>, n_tokens array<bigint>, starts array<bigint>, data binary"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Texts to little-endian ids. This vocabulary's normalizer and splitter never join or read
    across white space, so pieces between ASCII white space encode alone to the same ids; pieces
    are remembered as the bytes of their ids. In texts without characters beyond U+00FF, where no
    mark can combine with a letter, ASCII is lower-cased and a closing mark after a letter split off
    first, as the normalizer and the splitter would. Letters-only pieces, each of which ends with
    one word-end id, are encoded many at a time. Whether a vocabulary is of this kind is tried on
    PROBE when it is read; with others, texts are encoded as a whole."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.dtype = np.dtype("<u2" if self.width == 2 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.memo: dict[bytes, bytes] = {}
        self.by_pieces = self._by_pieces(PROBE) == self._each([p.decode() for p in PROBE])
        self.memo.clear()

    def _each(self, pieces: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in got]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of letters-only pieces: each has at least one word end, so if there are as many as
        pieces, each has exactly one, its last id."""
        out: list[bytes] = []
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            stops = (np.flatnonzero(self.ends[ids]) + 1) * self.width
            if len(stops) != len(part):
                out += self._each(part)
                continue
            raw, stops = ids.tobytes(), stops.tolist()
            out += [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        return out

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces that are not remembered."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        alone = [s.isalpha() for s in texts]
        out = dict(zip([p for p, a in zip(pieces, alone, strict=True) if a], self._words([s for s, a in zip(texts, alone, strict=True) if a]), strict=True))
        out.update(zip([p for p, a in zip(pieces, alone, strict=True) if not a], self._each([s for s, a in zip(texts, alone, strict=True) if not a]), strict=True))
        return out

    @staticmethod
    def _pieces(text: bytes) -> list[bytes]:
        if text.translate(None, _NARROW):
            return text.split()
        kinds = text.translate(_KINDS)
        if b".." not in kinds and b"x." not in kinds and b"\xc2" not in text and b"\xc3\x97" not in text and b"\xc3\xb7" not in text:
            # every mark follows a letter or white space: plain replacement splits right
            return text.lower().replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" .\n").split()
        return _CLOSING.sub(rb" \1", text.lower()).split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each whole text, without an end id."""
        if not self.by_pieces:
            return self._each([t.decode("utf-8", "replace") for t in texts])
        return self._by_pieces(texts)

    def _by_pieces(self, texts: list[bytes]) -> list[bytes]:
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        memo = self.memo
        split = [self._pieces(t) for t in texts]
        found = [list(map(memo.get, pieces)) for pieces in split]
        gaps = [[i for i, x in enumerate(got) if x is None] for got in found]
        unknown = {pieces[i] for pieces, gap in zip(split, gaps, strict=True) for i in gap}
        learned = self._learn(list(unknown))
        memo.update((p, x) for p, x in learned.items() if len(p) <= MEMO_PIECE_BYTES)
        for pieces, got, gap in zip(split, found, gaps, strict=True):
            for i in gap:
                got[i] = learned[pieces[i]]
        return [b"".join(got) for got in found]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    register_cache("tokens", encoder.cache_clear)
    return Encoder(path)


def train_dictionary(docs: DataFrame, path: str, sample: int = DICT_SAMPLE) -> bytes:
    """A zstandard dictionary from the ids of ``sample`` documents; empty if they are too few."""
    # ids first: a top-k of whole texts would meet in one task, as many of them as tasks read
    few = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = [r.doc_id for r in few.collect()]
    if not chosen:
        return b""
    rows = docs.where(F.col("doc_id").isin(chosen)).select("doc_id", text_bytes().alias("b")).where(F.octet_length("b") <= DICT_TEXT)
    rows = rows.groupBy("doc_id").agg(F.min("b").alias("b"))  # of rows that share an id the same one in each run
    ids = encoder(path).encode([b for _, b in sorted((r.doc_id, bytes(r.b)) for r in rows.toLocalIterator())])
    ids = [x for x in ids if len(x) >= 8]
    if len(ids) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, ids)) // 8 + 256), ids).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return b""


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)


def _decompressor(raw: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)


class _Block:
    """Frames gathered for one row of ``blocks``."""

    def __init__(self) -> None:
        self.ids, self.offsets, self.sizes, self.counts, self.starts, self.frames, self.bytes = [], [], [], [], [], [], 0

    def add(self, doc_id: int | None, frame: bytes, n: int, start: int) -> None:
        for into, x in ((self.ids, doc_id), (self.offsets, self.bytes), (self.sizes, len(frame)), (self.counts, n), (self.starts, start), (self.frames, frame)):
            into.append(x)
        self.bytes += len(frame)

    def row(self, shard: int, block: int, dict_hash: str, schema: pa.Schema) -> pa.RecordBatch:
        values = [shard, block, dict_hash, self.ids[0], self.ids[-1], self.ids, self.offsets, self.sizes, self.counts, self.starts, b"".join(self.frames)]
        return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode doc_id and text of ``docs`` into a store at ``path``."""
    spark = docs.sparkSession
    bound_batches(spark)
    vocabulary = tokenizer or tokenizer_path()
    raw = train_dictionary(docs, vocabulary)
    dict_hash = hashlib.sha256(raw).hexdigest()
    width = encoder(vocabulary).width
    spark.createDataFrame([(dict_hash, raw, width)], "dict_hash string, dictionary binary, width int").write.mode("overwrite").parquet(f"{path}/dictionary")
    list_of = lambda t: pa.list_(t)
    types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), list_of(pa.int64()), list_of(pa.int64()), list_of(pa.int32()), list_of(pa.int64()), list_of(pa.int64()), pa.binary()]
    schema = pa.schema([pa.field(f.split()[0], t) for f, t in zip(BLOCK_SCHEMA.split(", "), types, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer, shard = encoder(vocabulary), _compressor(raw), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        block, number, start = _Block(), 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist()), strict=True):
                    n = len(ids) // enc.width + 1
                    block.add(doc_id, packer.compress(ids + end), n, start)
                    start += n
                    if block.bytes >= BLOCK_BYTES:
                        yield block.row(shard, number, dict_hash, schema)
                        block, number = _Block(), number + 1
        if block.ids:
            yield block.row(shard, number, dict_hash, schema)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    # bounds of the shards from the ids alone; a range partitioner would read the texts for its sample
    cuts = ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    shard = _below(sorted(set(cuts or [])), 0)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("b")).withColumn("s", F.when(F.col("doc_id").isNull(), 0).otherwise(shard))
    ordered = ordered.repartitionById(n, "s").drop("s").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, BLOCK_SCHEMA).write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks")


def _below(bounds: list[int], at: int) -> Column:
    """``at`` and how many of the sorted bounds are under doc_id, by halving."""
    if not bounds:
        return F.lit(at)
    half = len(bounds) // 2
    return F.when(F.col("doc_id") > bounds[half], _below(bounds[half + 1 :], at + half + 1)).otherwise(_below(bounds[:half], at))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index: one row per document with its shard, block, offset, size and first token."""
    b = spark.read.parquet(f"{path}/blocks")
    e = F.explode(F.arrays_zip("doc_ids", "offsets", "sizes", "n_tokens", "starts")).alias("e")
    return b.select("shard", "block", "dict_hash", e).select("shard", "block", "dict_hash", F.col("e.doc_ids").alias("doc_id"), F.col("e.offsets").alias("offset"), F.col("e.sizes").alias("size"), F.col("e.n_tokens").alias("n_tokens"), F.col("e.starts").alias("start_in_shard"))


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(raw := bytes(row.dictionary)).hexdigest() != row.dict_hash:
        raise ValueError("the dictionary does not match its hash")
    return row.dict_hash, raw, row.width


def _shard_starts(spark: SparkSession, path: str) -> dict[int, int]:
    """Tokens before each shard: one small row per shard, bounded by the number of write tasks."""
    totals = spark.read.parquet(f"{path}/blocks").select("shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    out, at = {}, 0
    for row in sorted(totals.collect()):
        out[row.shard], at = at, at + row.n
    return out


def read_ids(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (several arrays if the id was stored more than once)."""
    dict_hash, raw, width = _dictionary(spark, path)
    unpack, dtype = _decompressor(raw), np.dtype(f"<u{width}")
    hit = spark.read.parquet(f"{path}/blocks").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id) & (F.col("dict_hash") == dict_hash))
    e = F.explode(F.arrays_zip("doc_ids", "offsets", "sizes")).alias("e")
    frames = hit.select("data", e).where(F.col("e.doc_ids") == doc_id).select(F.substring("data", F.col("e.offsets").cast("int") + 1, F.col("e.sizes")).alias("f"))
    return [np.frombuffer(unpack.decompress(bytes(r.f)), dtype=dtype) for r in frames.toLocalIterator()]


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of ids as 32-bit integers)."""
    dict_hash, raw, width = _dictionary(spark, path)
    base = _shard_starts(spark, path)
    dtype = np.dtype(f"<u{width}")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _decompressor(raw)
        for batch in batches:
            for r in batch.to_pylist():
                if r["dict_hash"] != dict_hash:
                    raise ValueError("a block was written with another dictionary")
                data, rows = memoryview(r["data"]), []
                for doc_id, at, size, n, start in zip(r["doc_ids"], r["offsets"], r["sizes"], r["n_tokens"], r["starts"], strict=True):
                    ids = np.frombuffer(unpack.decompress(data[at : at + size]), dtype=dtype)
                    if len(ids) != n:
                        raise ValueError(f"document {doc_id}: {len(ids)} ids stored, {n} indexed")
                    rows.append((doc_id, base[r["shard"]] + start, n, zlib.crc32(ids.astype("<u4").tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*rows, strict=True)], names=names)

    blocks = spark.read.parquet(f"{path}/blocks").select("shard", "dict_hash", "doc_ids", "offsets", "sizes", "n_tokens", "starts", "data")
    return blocks.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_store(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write a store of ``docs`` in the shared folder and read it back."""
    path = Scratch(docs.sparkSession, "tokens").path("store")
    write_store(docs, path, tokenizer)
    return read_store(docs.sparkSession, path)
