"""The shared folder for written intermediates, and how tables are put there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is missing *and* the
    master is local, as in unit tests; on a cluster a missing setting is an error.
    """
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="tradepanel-")
    return _local_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/tradepanel/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Used where several branches read one expensive result: the lineage is cut, a
    lost executor costs no recomputation, later scans read only the columns they
    need, and the planner sees true sizes when it picks its joins.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
