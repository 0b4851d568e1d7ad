"""Intermediate tables in the folder that the cluster shares, so that a job's plan stays short and survives lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"
#: Lets a query's shuffle files go when it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder. Without one a cluster's session is refused; on one machine a temporary folder is set."""
    base = spark.conf.get(SHARED, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SHARED} has to name a folder that all executors reach")
        base = tempfile.mkdtemp(prefix="eventloom-")
        spark.conf.set(SHARED, base)
    if "://" not in base and not base.startswith("file:"):
        base = f"file://{base}"
    return f"{base.rstrip('/')}/eventloom/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; the shuffle files that went into it are removed."""
    spark = df.sparkSession
    path, before = shared_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstaged(*tables: DataFrame) -> None:
    """Removes tables of ``staged`` that nothing will read again."""
    for df in tables:
        spark, where = df.sparkSession, df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._staged_at)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
