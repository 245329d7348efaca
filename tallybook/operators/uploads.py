"""Uploaded reference data: checks, and what may be appended to the stored map."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.functions.rules import Field, with_error
from tallybook.operators.row_checks import BENEFICIARY_UPLOAD, LEDGER_MAP_UPLOAD, RETAIL_UPLOAD
from tallybook.sources.readers import BROKEN
from tallybook.sources.schemas import MAP_KEYS, MAP_TABLES

KEY_PRESENT = "key is already stored"
KEY_REPEATED = "key occurs earlier in the upload"
OUT_OF_RANGE = "number is out of range"
WRONG_FIELDS = "row has a wrong number of fields"


@dataclass(frozen=True)
class Upload:
    """One kind of upload: the map it feeds and the rules of its rows."""

    table: str
    rules: tuple[Field, ...]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(MAP_TABLES[self.table])

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def keys(self) -> list[str]:
        return list(MAP_KEYS[self.table])


UPLOADS = {
    "benef_code_map": Upload("beneficiary_code_map", BENEFICIARY_UPLOAD),
    "retail_supplier": Upload("retail_short_code", RETAIL_UPLOAD),
    "ledger_map": Upload("ledger_map", LEDGER_MAP_UPLOAD),
}


def check_upload(rows: DataFrame, upload: Upload) -> DataFrame:
    """Adds ``error``. A row with a wrong number of fields has no values to check."""
    checked = with_error(rows, upload.rules)
    if BROKEN not in rows.columns:
        return checked
    wrong = F.when(F.col(BROKEN).isNotNull(), F.concat(F.lit(f"{WRONG_FIELDS}: "), F.col(BROKEN)))
    return checked.withColumn("error", F.coalesce(wrong, "error")).drop(BROKEN)


def plan_append(rows: DataFrame, stored: DataFrame, upload: Upload) -> DataFrame:
    """Valid upload rows in the stored types, with ``error`` where the store must refuse.

    Of rows with the same key the first by ``row_no`` that fits the stored types is taken,
    if the key is not stored yet. Both looked-up sides have unique keys.
    """
    keys = upload.keys
    typed, overflow = [], F.lit(False)
    for field in upload.schema:
        text = F.when(F.col(field.name) != "", F.col(field.name))
        value = text.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        overflow = overflow | (text.isNotNull() & value.isNull())
    rows = rows.select(*typed, overflow.alias("overflow"), "row_no")
    first = rows.where(~F.col("overflow")).groupBy(*keys).agg(F.min("row_no").alias("first_row"))
    known = stored.select(*keys).distinct().withColumn("is_stored", F.lit(True))
    error = (
        F.when(F.col("is_stored"), KEY_PRESENT)
        .when(F.col("overflow"), OUT_OF_RANGE)
        .when(F.col("row_no") > F.col("first_row"), KEY_REPEATED)
    )
    return (
        rows.join(first, keys, "left")
        .join(known, keys, "left")
        .select(*upload.columns, error.alias("error"), "row_no")
    )
