"""Where a job keeps the tables it writes between steps."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


@contextlib.contextmanager
def work_folder(spark: SparkSession, beside: str) -> Iterator[str]:
    """A new folder for one run, deleted when the run ends, also when it stops.

    It lies in the cluster's shared folder (``spark.checkpoint.dir``), or in the folder
    ``beside``, which all executors reach as the results go there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or beside
    folder = f"{root.rstrip('/')}/_work-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once and read it back: later steps neither recompute it nor lose it
    with an executor, and their filters and column lists reach the files."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
