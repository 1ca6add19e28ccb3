"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or what ``setCheckpointDir`` named.  A local session without either gets a folder of its own; a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="hostsift-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base


def delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def _quietly(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # noqa: BLE001  the session may have ended before the interpreter
        pass


def kept(spark: SparkSession, name: str) -> Callable[[DataFrame, str], DataFrame]:
    """A function that writes a table to the shared folder and reads it again; tables go when the interpreter ends."""
    base = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_quietly, spark, base)

    def keep(df: DataFrame, what: str) -> DataFrame:
        path = f"{base}/{what}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep
