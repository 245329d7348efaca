"""Uploading reference data: all rows must be valid, or nothing is stored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallybook.functions.rules import invalid_rows
from tallybook.operators.uploads import UPLOADS, Upload, check_upload, plan_append
from tallybook.sinks.files import write_csv
from tallybook.sources.readers import Location, read_upload
from tallybook.storage import stage, work_folder
from tallybook.store import store


@dataclass(frozen=True)
class UploadResult:
    """``stored`` rows were appended, ``refused`` ones are in the error log."""

    accepted: bool
    stored: int
    refused: int
    log: str


def run_upload(
    spark: SparkSession,
    kind: str,
    path: str,
    target: Location,
    log: str,
    multi_line: bool = True,
) -> UploadResult:
    """Check the CSV at ``path`` and append its rows to the map at ``target``.

    ``kind`` is ``benef_code_map``, ``retail_supplier`` or ``ledger_map``. If any row is
    invalid, all invalid rows go to ``log`` and nothing is stored. Rows whose key is stored
    already, or came earlier in the file, are refused one by one and logged; so are those that another
    upload stores at the same time. ``multi_line=False`` reads files faster whose values hold no line breaks.
    """
    with work_folder(spark, log.rstrip("/").rpartition("/")[0]) as work:
        return _upload(spark, UPLOADS[kind], path, target, log, multi_line, work)


def _upload(
    spark: SparkSession,
    upload: Upload,
    path: str,
    target: Location,
    log: str,
    multi_line: bool,
    work: str,
) -> UploadResult:
    rows = read_upload(spark, path, upload.columns, multi_line)
    checked = stage(check_upload(rows, upload), f"{work}/rows")
    shown = ["error", *upload.columns]
    wrong = invalid_rows(checked)
    refused = wrong.count()
    write_csv(wrong, log, shown)
    if refused:
        return UploadResult(False, 0, refused, log)

    # What was planned is written first: after the append its own rows would be stored ones.
    kept = store(spark, target, upload)
    while True:
        version = kept.version()
        plan = plan_append(checked.drop("error"), kept.rows(), upload)
        planned = stage(plan, f"{work}/planned")
        counted = planned.groupBy(F.col("error").isNull().alias("ok")).count().collect()
        numbers = {row["ok"]: row["count"] for row in counted}
        accepted = planned.where(F.col("error").isNull()).select(*upload.columns)
        if not numbers.get(True) or kept.append(accepted, version):
            break
    write_csv(invalid_rows(planned), log, shown)
    return UploadResult(True, numbers.get(True, 0), numbers.get(False, 0), log)
