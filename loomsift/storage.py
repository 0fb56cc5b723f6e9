"""The folder that driver and executors share, and tables written into it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, named by spark.checkpoint.dir.

    Where the setting is absent, as in tests on one machine, a temporary folder is made once.
    """
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="loomsift-")
        spark.sparkContext.setCheckpointDir(_own_dir)
    return _own_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/loomsift-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here, lost executors lose nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
