"""Toxicity scores from non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.staging import Staging
from tallybook.llm.wordhash import LOWER, Words, chunks, range_hash

#: Hashed features, and the bytes at a word's start and end that make features of their own.
FEATURES = 1 << 18
AFFIXES = (4, 6)
#: Bounds of the training sample: documents with a toxic label, and documents whose label isn't looked at.
POSITIVE_ROWS = 3000
UNLABELLED_ROWS = 9000
#: Features that the classifier weighs: those whose rates in the two samples differ most, by a
#: log-likelihood gain of at least LEAST_GAIN.
CHOSEN = 3000
LEAST_GAIN = 4.0
EPOCHS, RATE, DECAY, BATCH = 30, 0.05, 1e-3, 512
HELD_OUT = 5


def fold(doc_id: Column) -> Column:
    """0 for the documents held out from all learning."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % HELD_OUT


def features(words: Words, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) of the wanted features, all by default.

    Features are whole words in lower case and their first and last bytes. The value grows with the root
    of a feature's share of the document's words, up to 1 at a share of 0.04, so a few telling words
    count in long texts too.
    """
    data = LOWER[words.data]
    document, start, end = words.document(), words.start, words.end
    kinds = [range_hash(data, start, end)]
    for size in AFFIXES:
        long = end - start > size
        kinds += [
            np.where(long, range_hash(data, start, np.minimum(start + size, end)) ^ np.uint64(size), kinds[0]),
            np.where(long, range_hash(data, np.maximum(end - size, start), end) ^ np.uint64(size + 100), kinds[0]),
        ]
    pairs = []
    for kind in kinds:
        slot = (kind % np.uint64(FEATURES)).astype(np.int64)
        keep = slice(None) if wanted is None else wanted[slot]
        pairs.append(document[keep] * FEATURES + slot[keep])
    pair, count = np.unique(np.concatenate(pairs), return_counts=True)
    owner = pair // FEATURES
    return owner, pair % FEATURES, np.minimum(1, 5 * np.sqrt(count / np.maximum(words.counts[owner], 1)))


@dataclass(frozen=True)
class Model:
    """A linear classifier; a document is toxic from a score of 0.5."""

    weights: np.ndarray
    bias: float

    def scores(self, words: Words) -> np.ndarray:
        document, feature, value = features(words, self.weights != 0)
        margin = np.bincount(document, self.weights[feature] * value, minlength=words.documents) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def learn(owner: np.ndarray, feature: np.ndarray, value: np.ndarray, positive: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk: prior * loss(positives as toxic) + max(0, loss(unlabelled as
    clean) - prior * loss(positives as clean)), with the logistic loss, by Adam over minibatches.

    ``owner`` ascends; document k of the sample is a positive example where ``positive[k]``. Where the
    part under the maximum falls below 0, the step goes against its gradient. Last, the bias is moved to
    the threshold of the largest recall ** 2 / share predicted toxic, which needs no negative labels.
    """
    rows = np.searchsorted(owner, np.arange(len(positive) + 1))
    toxic, unlabelled = np.flatnonzero(positive), np.flatnonzero(~positive)
    weights, bias = np.zeros(FEATURES), 0.0
    first, second = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    random, step = np.random.default_rng(0), 0
    for _ in range(EPOCHS):
        parts = max(1, len(unlabelled) // BATCH)
        for p, u in zip(
            np.array_split(random.permutation(toxic), min(parts, len(toxic))) * -(-parts // len(toxic)),
            np.array_split(random.permutation(unlabelled), parts),
            strict=False,
        ):
            some = np.concatenate([p, u])
            size = rows[some + 1] - rows[some]
            at = np.repeat(rows[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
            local = np.repeat(np.arange(len(some)), size)
            margin = np.bincount(local, weights[feature[at]] * value[at], minlength=len(some)) + bias
            chance, as_clean = 1 / (1 + np.exp(-margin)), np.logaddexp(0, margin)
            is_toxic = np.arange(len(some)) < len(p)
            if as_clean[~is_toxic].mean() >= prior * as_clean[is_toxic].mean():
                slope = np.where(is_toxic, -prior / len(p), chance / len(u))
            else:
                slope = np.where(is_toxic, prior * chance / len(p), -chance / len(u))
            gradient = np.bincount(feature[at], slope[local] * value[at], minlength=FEATURES) + DECAY * weights
            gradient = np.append(gradient, slope.sum())
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            weights, bias = weights - move[:-1], bias - move[-1]
    margin = np.bincount(owner, weights[feature] * value, minlength=len(positive)) + bias
    order = np.argsort(-margin)
    recall = np.cumsum(positive[order]) / len(toxic)
    share = np.cumsum(~positive[order]) / len(unlabelled)
    worth = np.where(share > 0, recall**2 / np.maximum(share, 0.5 / len(unlabelled)), 0)
    at = int(np.argmax(worth[:-1])) if len(worth) > 1 else 0
    threshold = (margin[order[at]] + margin[order[min(at + 1, len(order) - 1)]]) / 2
    return Model(weights, float(bias - threshold))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        positive = batch.column(1).to_numpy(zero_copy_only=False)
        for rows, words in chunks(batch.column(0)):
            owner, feature, _ = features(words)
            mine = positive[rows][owner]
            found = np.bincount(feature[mine], minlength=FEATURES), np.bincount(feature[~mine], minlength=FEATURES)
            some = np.flatnonzero(found[0] + found[1])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, found[0][some], found[1][some])], ["feature", "a", "b"])


def _chosen(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, words in chunks(batch.column(0)):
            owner, feature, value = features(words, wanted)
            at = np.searchsorted(owner, np.arange(words.documents + 1))
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x)) for x in (feature, value)]
            yield pa.RecordBatch.from_arrays([batch.column(1)[rows], *lists], ["positive", "feature", "value"])


def fit(
    documents: DataFrame,
    labels: DataFrame,
    staging: Staging,
    positive_rows: int = POSITIVE_ROWS,
    unlabelled_rows: int = UNLABELLED_ROWS,
) -> Model:
    """Learn from documents with a toxic label and others as they come, all outside the held-out fold.

    The samples are the first so many rows by a hash of the id; their texts are read whole. A document is
    a positive example if any of its labels is 1. The class prior is the share of toxic ones among
    labelled documents. Without any positive example every score is 0, without unlabelled ones 1.
    """
    learning = fold(F.col("doc_id")) != 0
    marks = labels.where(learning).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic is not null")
    prior = marks.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    by_hash = F.xxhash64(F.col("doc_id"), F.lit(7))
    toxic = marks.where("toxic = 1").orderBy(by_hash, "doc_id").limit(positive_rows).select("doc_id", F.lit(True).alias("positive"))
    others = (
        documents.where(learning & F.col("doc_id").isNotNull())
        .select("doc_id")
        .distinct()
        .orderBy(by_hash, "doc_id")
        .limit(unlabelled_rows)
        .withColumn("positive", F.lit(False))
    )
    chosen = F.broadcast(toxic.unionAll(others))  # at most positive_rows + unlabelled_rows ids
    sample = staging.table(documents.select("doc_id", "text").join(chosen, "doc_id").select("text", "positive"), "sample")
    size = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if not size.get(True) or not size.get(False):
        return Model(np.zeros(FEATURES), -30.0 if not size.get(True) else 30.0)
    rate = [(F.sum(x) + 0.1) / F.lit(size[y] + 1.0) for x, y in (("a", True), ("b", False))]
    gain = F.col("n") * F.log(F.col("p") / F.col("q")) + (size[True] - F.col("n")) * F.log((1.0001 - F.col("p")) / (1.0001 - F.col("q")))
    best = (
        sample.mapInArrow(_counts, "feature long, a long, b long")
        .groupBy("feature")
        .agg(F.sum("a").alias("n"), rate[0].alias("p"), rate[1].alias("q"))
        .withColumn("gain", gain)
        .where(F.col("gain") >= LEAST_GAIN)
        .orderBy(F.desc("gain"), "feature")
        .limit(CHOSEN)
    )
    wanted = np.zeros(FEATURES, bool)
    wanted[[r["feature"] for r in best.select("feature").collect()]] = True
    rows = sample.mapInArrow(
        lambda batches: _chosen(batches, wanted), "positive boolean, feature array<long>, value array<double>"
    ).collect()
    sizes = [len(r["feature"]) for r in rows]
    return learn(
        np.repeat(np.arange(len(rows)), sizes),
        np.array([x for r in rows for x in r["feature"]], np.int64),
        np.array([x for r in rows for x in r["value"]], float),
        np.array([r["positive"] for r in rows]),
        prior,
    )


def scored(documents: DataFrame, model: Model, name: str = "toxicity", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``documents`` and a score from 0 to 1 in column ``name``.

    ``name`` gets underscores until it is new. Null and empty texts get the score of a text without any
    feature; repeated rows are scored alike; an empty table stays empty.
    """
    while name.lower() in (c.lower() for c in documents.columns):
        name += "_"
    at = documents.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.scores(words) for _, words in chunks(batch.column(at))]
            score = pa.array(np.concatenate(found) if found else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, name])

    return documents.mapInArrow(add, T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())]))
