"""Session-derived settings: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    On a cluster this is the shared folder the cluster names; without one this raises. Only a local
    session (tests) that has none gets a folder of this machine, registered so that later
    ``checkpoint()`` calls work too.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # core config: cannot be set at runtime; register it with the context
        path = tempfile.mkdtemp(prefix="tonetide-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir() or path
    return path.rstrip("/")


_SCRATCH: list[str] = []  # written by this process and not cleaned yet


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one write."""
    _SCRATCH.append(f"{shared_dir(spark)}/tonetide/{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def clean_scratch(spark: SparkSession) -> int:
    """Delete what this process wrote under ``scratch_path``; call it when the results are read.

    Checkpoints are Spark's own: ``spark.cleaner.referenceTracking.cleanCheckpoints`` removes them.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = hadoop(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``df.checkpoint()`` usable: point it at the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
