"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DIR = "spark.checkpoint.dir"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session may go without: it then uses the warehouse."""
    if found := spark.conf.get(_DIR, None):
        return found
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError(f"{_DIR} has to name a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by ``new_folder`` that no later step reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def _shuffles_end_with_the_job(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    Cuts the lineage with a copy that survives lost executors, gives later joins the table's true size, and frees
    the shuffle files of the job that made it.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with _shuffles_end_with_the_job(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
