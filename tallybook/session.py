"""Spark settings that suit the booking jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Shuffle partitions are sized from measured bytes; a hot key is split at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast only if Spark's own size estimate, or its measured shuffle size,
    # stays under this; beyond it the join shuffles.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # If every measured partition of a side is small, hash it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Plans are built from many small expressions; do not record a call site for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Partitions that keep about 128 MiB each, and Spark's default of 200 at least. Adaptive
    execution merges those that turn out small, but cannot add more."""
    return max(200, -(-shuffled_bytes // PARTITION_BYTES))


def build_session(
    name: str = "tallybook",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **settings,
) -> SparkSession:
    """A session with the settings above; ``settings`` override them (dots as ``__``).

    ``shuffled_bytes`` is the expected size of the largest shuffle, about the columns of one
    period's transactions that the extract keeps. Without it Spark's default of 200 partitions
    holds, which suits shuffles of up to about 25 GB.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    merged = SETTINGS | {k.replace("__", "."): str(v) for k, v in settings.items()}
    if shuffled_bytes is not None:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffled_bytes))
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
