"""Helpers that several corpus operators share: reading tables, staging and batch sizes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a missing document id where ids are ordered or joined; nulls sort first.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share (``spark.checkpoint.dir``).

    Without one a cluster's session is refused; on one machine, as in tests, a temporary folder is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors reach")
        base = tempfile.mkdtemp(prefix="eventloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and not base.startswith("file:"):
        base = f"file://{base}"
    return f"{base.rstrip('/')}/eventloom/{name}-{uuid.uuid4().hex}"


#: Tables staged while ``settled`` builds a result, innermost last.
_building: list[list[DataFrame]] = []

#: Lets a query's shuffle files go when it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps survive lost executors.

    Once the table stands, nothing reads the shuffle files that went into it; they are removed then.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
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
    if _building:
        _building[-1].append(out)
    return out


def settled(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """``build()`` staged; all tables that were staged on the way to it are removed once it stands, or once that failed."""
    made: list[DataFrame] = []
    _building.append(made)
    try:
        out = staged(build(), name)
    except BaseException:
        _building.pop()
        unstaged(*made)
        raise
    _building.pop()
    unstaged(*[t for t in made if t is not out])
    if _building:
        _building[-1].append(out)
    return out


def by_position(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named ``c0``, ``c1`` and so on, and those names by the old ones: no name of a step's own can clash with them."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))]), {c: f"c{k}" for k, c in enumerate(docs.columns)}


def unstaged(*tables: DataFrame) -> None:
    """Removes tables that ``staged`` wrote and nothing will read again."""
    for df in tables:
        if at := getattr(df, "_staged_at", None):
            remove_path(df.sparkSession, at)


def remove_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Let Arrow batches hold few rows, for whole texts differ widely in length."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def utf8(column: str) -> Column:
    """The text's UTF-8 bytes, empty where it is null."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def id_key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))
