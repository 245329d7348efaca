"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

toxicity drops the documents that its classifier rejects; near_duplicates keeps one document of each
class; personal_data masks what it finds; mixing puts the documents in the order of the mixture, file by
file; packing gives the pieces of all of them with their sequences, which follow the mixture. All but the
last return the columns of documents. What the operators do with nulls, empty and very long texts, ties,
repeated rows and empty tables holds for their stages: no row is lost but those that a stage rejects, and
columns of other names, also clashing ones, come through to packing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import dartminhash, mixing, packing, personal_data, toxicity
from tallybook.llm.queries import importable, table
from tallybook.llm.staging import Staging, released


#: Weights of the sources; None: the root of their row counts.
WEIGHTS: dict[str, float] | None = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a toxicity score below 0.5."""
    importable(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), Staging(spark))
    scored = toxicity.scored(docs, model)
    return scored.where(F.col(scored.columns[-1]) < 0.5).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the least id; of wholly repeated rows, one."""
    importable(spark)
    found = dartminhash.classes(docs, Staging(spark)).where("first_of_class")
    kept = found.select(F.col("doc_id").alias("id"), F.col("content").alias("kept"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = docs.select(row, F.col("doc_id").alias("own"), dartminhash.content(F.col("text")).alias("content"))
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("content") == F.col("kept"))
    return marked.join(kept, same, "left_semi").dropDuplicates(["own", "content"]).select("row.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the new text."""
    importable(spark)
    found = personal_data.scanned(docs, personal_data.fit(docs, Staging(spark)))
    base, added = found.columns[-2:]
    spans = F.concat(base, added)
    text = F.when(F.size(spans) > 0, personal_data.masked(F.col("text"), spans)).otherwise(F.col("text"))
    changed = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return changed.select(docs.columns)


def in_mixture(docs: DataFrame, mark: Column) -> tuple[DataFrame, Column]:
    """``docs`` with their place in the mixture, and their position in it, which depends on the rows alone and
    not on their files. ``mark`` stands for a document's text."""
    mixture = mixing.mixed(docs, WEIGHTS, order=F.struct("doc_id", mark.alias("mark")))
    return mixture, F.col(f"{mixing.place_column(docs, mixture)}.position")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture: later files hold later positions."""
    importable(spark)
    mixture, position = in_mixture(docs, F.xxhash64("text"))
    return mixture.orderBy(position).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences, in the order of the mixture.

    Files that are read again keep no order, so the positions are computed again, to the same numbers, from
    ids, sources and hashes of the texts.
    """

    def positions(narrow: DataFrame) -> DataFrame:
        mixture, position = in_mixture(narrow, F.col("mark"))
        return mixture.select("row", position.alias("position"))

    importable(spark)
    return packing.pack(docs, Staging(spark), positions=positions, positions_read=["source"])


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has no classifier, random field or tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage staged goes when its result is written."""
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with released():
            docs = staging.table(stage(spark, docs, sf_dir), name)
    return docs
