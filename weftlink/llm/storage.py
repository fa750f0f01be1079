"""Shared storage, lineage cuts and checked broadcasts for the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of at most this many bytes in total may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir.

    Only in a local session without that setting (tests on one machine) a folder of our
    own is made and kept in the session; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.conf.get("spark.weftlink.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="weftlink-")
        spark.conf.set("spark.weftlink.shared.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A path in the shared folder that nobody else uses."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame, kind: str = "cut", by: list[str] | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it again: lineage ends there."""
    path = fresh_path(df.sparkSession, kind)
    writer = df.write
    if by:
        writer = writer.partitionBy(*by)
    writer.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._weftlink_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete a table made by cut() that nothing reads any more."""
    path = getattr(df, "_weftlink_path", None)
    if path:
        drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark df for broadcast if its counted rows stay under BROADCAST_BYTES, else leave the join to shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def free_names(df: DataFrame, n: int) -> list[str]:
    """n column names that df does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    free = (f"__{i}" for i in range(n + len(taken)) if f"__{i}" not in taken)
    return [next(free) for _ in range(n)]
