"""Results of a booking run, published together or not at all."""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from tallybook.filesystem import FileSystem

MONTH = "booking_period="
_NEW, _READY, _PLAN = "_new-", "_ready", "plan.json"


class Publication:
    """Tables of one run, written to a hidden folder beside those they will replace.

    ``commit`` says what replaces what in a plan, and one rename makes plan and tables ready. Only then
    are months and folders moved to their places, and a run that is killed meanwhile leaves the plan:
    ``recover``, which every run calls first, goes through the rest of it. So until the rename nothing
    of a run is seen, and after it all of it will be. Runs into one place follow each other.
    """

    def __init__(self, spark: SparkSession, out: str) -> None:
        self.out = out.rstrip("/")
        self.files = FileSystem(spark, out)
        self.folder = f"{self.out}/{_NEW}{uuid.uuid4().hex}"
        self.plan: list[dict] = []

    def path(self, table: str) -> str:
        """Where this run writes the table."""
        return f"{self.folder}/{table}"

    def replace_months(self, table: str, months: list[str] | None) -> None:
        """The written months take the place of the same months; others stay. Of ``months`` those that
        were not written are dropped; None stands for all there are."""
        new = [n for n in self.files.names(self.path(table)) if n.startswith(MONTH)]
        if months is None:
            there = [n for n in self.files.names(f"{self.out}/{table}") if n.startswith(MONTH)]
        else:
            there = [f"{MONTH}{month}" for month in months]
        self.plan.append({"table": table, "drop": sorted(set(there) - set(new)), "put": new})

    def replace_table(self, table: str) -> None:
        """The written table takes the place of the whole earlier one."""
        self.plan.append({"table": table, "drop": [], "put": None})

    def commit(self) -> None:
        self.files.write_text(f"{self.folder}/{_PLAN}", json.dumps(self.plan))
        if not self.files.claim(self.folder, f"{self.out}/{_READY}"):
            raise RuntimeError(f"another run is publishing to {self.out}")
        _put_in_place(self.files, self.out)


def _put_in_place(files: FileSystem, out: str) -> None:
    """Go through the plan that is ready. What was moved before is no longer there to be moved."""
    ready = f"{out}/{_READY}"
    for step in json.loads(files.read_text(f"{ready}/{_PLAN}")):
        source, target = f"{ready}/{step['table']}", f"{out}/{step['table']}"
        if step["put"] is None:
            if files.exists(source):
                files.delete(target)
                files.move(source, target)
            continue
        files.make(target)
        for name in step["drop"]:
            files.delete(f"{target}/{name}")
        for name in step["put"]:
            if files.exists(f"{source}/{name}"):
                files.delete(f"{target}/{name}")
                files.move(f"{source}/{name}", f"{target}/{name}")
    files.delete(ready)


def recover(spark: SparkSession, out: str) -> None:
    """Finish the publication of a run that was killed in it, and delete what earlier ones left."""
    files, out = FileSystem(spark, out), out.rstrip("/")
    names = files.names(out)
    if _READY in names:
        if files.exists(f"{out}/{_READY}/{_PLAN}"):
            _put_in_place(files, out)
        else:  # killed while the emptied folder was deleted
            files.delete(f"{out}/{_READY}")
    for name in names:
        if name.startswith(_NEW):
            files.delete(f"{out}/{name}")


@contextlib.contextmanager
def publication(spark: SparkSession, out: str) -> Iterator[Publication]:
    """A publication whose folder is deleted if the run stops before it commits."""
    recover(spark, out)
    new = Publication(spark, out)
    try:
        yield new
    finally:
        new.files.delete(new.folder)
