"""Reference maps in files: appended to without two writers ever storing one key."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallybook.filesystem import FileSystem
from tallybook.operators.uploads import Upload
from tallybook.sources.readers import Location, conform
from tallybook.sources.schemas import MAP_TABLES

_NO_ROWS_YET = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


class FileStore:
    """The files of one map, and a hidden folder that says which appends there were.

    An append is a numbered folder. A writer reads the store as append n left it, writes what it may add to
    a folder of its own, and renames that to n + 1: only one writer can, the others read again. Then the
    files move up into the store, whose readers need to know nothing of this. If the writer is killed
    before they did, the next one moves them before it reads.
    """

    def __init__(self, spark: SparkSession, target: Location, upload: Upload) -> None:
        self.spark, self.target, self.upload = spark, target, upload
        self.root = target.path.rstrip("/")
        self.appends = f"{self.root}/_appends"
        self.files = FileSystem(spark, self.root)

    def version(self) -> int:
        """The number of the last append, all of whose files lie in the store by then."""
        numbers = [name for name in self.files.names(self.appends) if name.isdigit()]
        for number in numbers:
            self._move_up(f"{self.appends}/{number}")
        return max(map(int, numbers), default=0)

    def _move_up(self, folder: str) -> None:
        for name in self.files.names(folder):
            if not name.startswith(("_", ".")):
                self.files.move(f"{folder}/{name}", f"{self.root}/{name}")

    def rows(self) -> DataFrame:
        """The rows stored so far; none before the first append."""
        reader = self.spark.read.format(self.target.format).options(**self.target.options)
        try:
            rows = reader.load(self.root)
        except AnalysisException as error:
            if error.getCondition() not in _NO_ROWS_YET:
                raise
            return self.spark.createDataFrame([], self.upload.schema)
        return conform(rows, MAP_TABLES[self.upload.table])

    def append(self, rows: DataFrame, version: int) -> bool:
        """Add rows that were checked against the store as append ``version`` left it.

        False, and nothing is added, if there was another append since.
        """
        own = f"{self.appends}/_new-{uuid.uuid4().hex}"
        rows.write.format(self.target.format).options(**self.target.options).save(own)
        self.files.write_text(f"{own}/_from_version", str(version))
        claimed = f"{self.appends}/{version + 1:08d}"
        if not self.files.claim(own, claimed):
            self.files.delete(own)
            return False
        self._move_up(claimed)
        return True


class ConnectedStore:
    """A map in a database, over jdbc. Its own key constraint is what refuses a key twice."""

    def __init__(self, spark: SparkSession, target: Location, upload: Upload) -> None:
        self.spark, self.target, self.upload = spark, target, upload

    def version(self) -> int:
        return 0

    def rows(self) -> DataFrame:
        reader = self.spark.read.format(self.target.format).options(**self.target.options)
        return conform(reader.load(), MAP_TABLES[self.upload.table])

    def append(self, rows: DataFrame, version: int) -> bool:
        rows.write.format(self.target.format).options(**self.target.options).mode("append").save()
        return True


def store(spark: SparkSession, target: Location, upload: Upload) -> FileStore | ConnectedStore:
    return (FileStore if target.path else ConnectedStore)(spark, target, upload)
