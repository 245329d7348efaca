"""Tables written once to the shared folder, so that a lost executor costs no more than a reread."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of this machine only where all of Spark is this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="tallybook-llm-")
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


_opened: list[Staging] = []


@contextlib.contextmanager
def released() -> Iterator[None]:
    """At its end all tables are deleted that were staged inside, so read no result of theirs after it."""
    before = len(_opened)
    try:
        yield
    finally:
        while len(_opened) > before:
            _opened.pop().clear()


class Staging:
    """Intermediate tables of one run of an operator, under a folder of its own.

    ``clear()`` deletes them once the result is consumed; the end of the program does it otherwise.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.root = f"{(folder or shared_folder(spark)).rstrip('/')}/llm-{uuid.uuid4().hex}"
        atexit.register(self._at_exit)
        _opened.append(self)

    def table(self, frame: DataFrame, name: str) -> DataFrame:
        """Write ``frame`` and return the written table, whose plan has no memory of how it was made.

        Shuffle files that only served this write go when the driver collects its garbage, so it does.
        """
        path = f"{self.root}/{name}"
        frame.write.mode("overwrite").parquet(path)
        self.spark._jvm.System.gc()
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete one table that no later step reads."""
        self._delete(f"{self.root}/{name}")

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def clear(self) -> None:
        """Delete all tables."""
        atexit.unregister(self._at_exit)
        self._delete(self.root)

    def _at_exit(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # the session has ended before; its folder goes with the cluster's
            return
