"""Intermediate results of a flow: tables in the cluster's shared folder, which outlive executors and are deleted together."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_temporary: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``; only a local session without that setting gets a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = _temporary.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="colloquy-"))
    return f"{where.rstrip('/')}/colloquy-flows/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table of columns with statistics: what follows plans from there and reads what it needs of it."""
    path = scratch(df.sparkSession, "settled")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Deletes what this application's flows and queries have put into the shared folder, when their results have been used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
