"""Helpers that every operator of this subpackage uses: scratch tables, byte-bounded Arrow
batches and tolerant column access.

Lineage is cut with Parquet tables in the shared folder named by ``spark.checkpoint.dir``
(a local one only where that setting is unset and the master is local), so a lost executor costs a
re-read. What operators leave there is removed when the driver ends.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from ..storage import shared_root

#: Rows and bytes of one Arrow batch between the JVM and Python.
BATCH_ROWS = 2048
BATCH_BYTES = 16 << 20

def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables of one operator run below the shared folder."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.base = f"{shared_root(spark)}/candlewick/{label}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._at_exit)

    def _at_exit(self) -> None:
        with suppress(Exception):  # the session may have ended before
            self.drop_all()

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a reader of it: everything above is forgotten."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Remove tables that later steps no longer read."""
        for name in names:
            _delete(self.spark, self.path(name))

    def drop_all(self) -> None:
        _delete(self.spark, self.base)


def bound_batches(spark: SparkSession) -> None:
    """Ready Python workers: this package's code, and Arrow batches bounded by rows and bytes, so
    that very long texts cannot fill a worker."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_caches: dict[str, Callable[[], None]] = {}


def register_cache(name: str, clear: Callable[[], None]) -> None:
    """Name a large cache of this Python worker; Spark uses a worker for one operator after another."""
    _caches[name] = clear


def release_caches() -> None:
    """Free what other operators have left in this worker."""
    while _caches:
        _caches.popitem()[1]()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def fold(name: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
