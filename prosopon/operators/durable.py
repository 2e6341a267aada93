"""Cutting lineage through tables in the folder that the driver and the executors share."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "prosopon.shared.dir"
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Only a local session (tests) that names none gets a temporary folder of our own: there the
    driver and the executors are one process."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(_SETTING, None)
    if not path and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not path:
        path = f"file://{tempfile.mkdtemp(prefix='prosopon-')}"
        spark.conf.set(_SETTING, path)
    return path


def write_table(df: DataFrame, what: str, *partition_by: str, tidy: bool = False) -> DataFrame:
    """Writes the rows to the shared folder and reads them from there, so that a lost executor costs no recomputation.

    tidy: the write's shuffle files go as soon as it has ended, not when the cleaner (see release) comes to them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    before = spark.conf.get(_TIDY, None)
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    finally:
        if tidy:
            spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def drop_table(df: DataFrame) -> None:
    """Deletes a table of write_table() that no later plan reads."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(df._written_to)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of plans that have ended: it acts only when the plans' objects are collected on
    both sides, and a run of many stages would otherwise hold all their shuffles on disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
