"""Where intermediate tables and checkpoints go: a folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

_own_dir: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where it is unset, a local master gets a temporary
    one, removed at exit; a cluster has no folder that all can read, so that is an error there."""
    global _own_dir
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all hosts of {master} share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="candlewick-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return f"file://{_own_dir}"


def ready_checkpoints(spark: SparkSession) -> None:
    """Set a checkpoint folder if the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/checkpoints")
