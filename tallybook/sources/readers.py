"""Source tables from any format Spark reads, and upload files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallybook.sources.records import read_blocks, read_lines, read_records
from tallybook.sources.schemas import ALL_TABLES


@dataclass(frozen=True)
class Location:
    """Where a table lies: a path for file formats, or only options (jdbc)."""

    path: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The named columns with the named types; other columns are not read."""
    wanted = StructType.fromDDL(schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def read_table(spark: SparkSession, name: str, location: Location) -> DataFrame:
    """One source table. Text formats get the schema up front, so nothing is inferred.

    Over jdbc, give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in
    the options; without them one task reads the whole table.
    """
    schema = ALL_TABLES[name]
    reader = spark.read.format(location.format).options(**location.options)
    if location.format == "json":
        reader = reader.schema(schema)
    if location.format == "csv":
        # A row of more or fewer fields than the header fails the read, as nothing is guessed.
        reader = reader.option("header", True).option("mode", "FAILFAST")
        reader = reader.option("columnPruning", False)
    return conform(reader.load(location.path) if location.path else reader.load(), schema)


def read_tables(spark: SparkSession, where: Mapping[str, Location]) -> dict[str, DataFrame]:
    return {name: read_table(spark, name, location) for name, location in where.items()}


def read_folder(
    spark: SparkSession, folder: str, names: Iterable[str], fmt: str = "parquet", **options: str
) -> dict[str, DataFrame]:
    """Tables that lie side by side in one folder, each under its own name."""
    return read_tables(
        spark, {n: Location(f"{folder.rstrip('/')}/{n}", fmt, options) for n in names}
    )


# The column of an upload that holds a row with a wrong number of fields.
BROKEN = "broken"


class UploadError(ValueError):
    """An upload file that cannot be read at all."""


def _heading(spark: SparkSession, path: str) -> list[str]:
    options = {"header": True, "multiLine": True, "escape": '"', "columnPruning": False}
    return spark.read.options(**options).csv(path).columns


def _whole_records(
    spark: SparkSession, path: str, schema: StructType, options: Mapping[str, str]
) -> DataFrame:
    """Rows whose values may hold line breaks, read in as many tasks as the files have pieces."""
    lines = read_lines(spark, path)
    blocks = read_blocks(lines)
    if blocks.unclosed:
        raise UploadError(f"{blocks.unclosed[0]}: a quote is opened and not closed")
    records = read_records(lines, blocks)
    place = F.struct("file", "block", "row")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    parsed = F.from_csv("text", ddl, options | {"multiLine": "true"})
    return records.select(parsed.alias("fields"), place.alias("row_no"))


def read_upload(
    spark: SparkSession, path: str, columns: Iterable[str], multi_line: bool = True
) -> DataFrame:
    """An upload CSV: columns by header name, all text, plus ``row_no`` in file order.

    A column the header lacks is NULL, further columns are ignored. ``broken`` is the text of a
    row that has more or fewer fields than the header. Large files are read in pieces. Values may hold
    line breaks inside quotes; a file that ends inside quotes is an error. ``multi_line=False`` saves
    looking for them, where it is known that there are none.
    """
    columns = list(columns)
    heading = _heading(spark, path)
    if not set(columns) & set(heading):
        raise UploadError(f"{path}: no column of {', '.join(columns)} in the header")
    broken = BROKEN
    while broken in heading:
        broken += "_"
    schema = StructType([StructField(c, StringType()) for c in [*heading, broken]])
    options = {"escape": '"', "columnNameOfCorruptRecord": broken, "columnPruning": "false"}
    if multi_line:
        rows = _whole_records(spark, path, schema, options)
        fields, place = "fields.", F.col("row_no")
    else:
        reader = spark.read.options(**options, header=True)
        rows = reader.schema(schema).csv(path)
        fields, place = "", F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    text = [
        F.col(f"{fields}`{c}`").alias(c) if c in heading else F.lit(None).cast("string").alias(c)
        for c in columns
    ]
    return rows.select(*text, place.alias("row_no"), F.col(f"{fields}`{broken}`").alias(BROKEN))
