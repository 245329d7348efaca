"""Near-duplicate classes from DartMinHash signatures of weighted word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.blocks import Rule, links
from tallybook.llm.components import components
from tallybook.llm.staging import Staging
from tallybook.llm.wordhash import Words, chunks, mix, range_hash

SHINGLE = 5
SIMILARITY = 0.8
#: Two texts of similarity 0.8 share a band with probability 0.9999.
BANDS, ROWS = 32, 6
COORDINATES = BANDS * ROWS
#: Darts expected below a document's first rank limit: enough to fill all coordinates in most documents.
DARTS = COORDINATES * (log(COORDINATES) + 2)
#: The rank axis is cut at FIRST_CELL, 2 * FIRST_CELL, 4 * FIRST_CELL, ...
FIRST_CELL = 2.0**-7
_DOCUMENTS_AT_ONCE = 256
_FREE = ~np.uint64(0)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@cache
def _poisson(mean: float) -> np.ndarray:
    """Cumulated probabilities of 0, 1, 2, ... darts in a cell of that area."""
    terms, k = [-mean], 0
    while k < mean or terms[-1] > -50:
        k += 1
        terms.append(terms[-1] + log(mean) - log(k))
    return np.cumsum([exp(x) for x in terms])


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each run of five words; a shorter text is one shingle of all its words."""
    hashes, counts = words.hashes(), words.counts
    start = words.runs(SHINGLE)
    end = start + SHINGLE
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    start, end = np.append(start, words.first[:-1][short]), np.append(end, words.first[1:][short])
    return np.searchsorted(words.first, start, side="right") - 1, range_hash(hashes, start, end)


def units(document: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted elements as unit regions: the n-th occurrence of a shingle in a document is the region
    from weight n - 1 to n of its axis. Sorted by document."""
    order = np.lexsort((element, document))
    document, element = document[order], element[order]
    at = np.arange(len(element))
    new = np.append(True, (document[1:] != document[:-1]) | (element[1:] != element[:-1]))[: len(element)]
    return document, mix(element + (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64) * _GOLDEN)


def signatures(document: np.ndarray, unit: np.ndarray, documents: int) -> np.ndarray:
    """For each document and coordinate the earliest dart, as rank (upper 32 bits) and dart.

    Hashed darts fall on each unit region at a density of one for each unit of rank. A document of total
    weight w looks at ranks below DARTS / w; those still without a dart on some coordinate look twice as
    far, and so on. The darts of a region don't depend on the document, so two documents agree on a
    coordinate with the probability of their weighted Jaccard similarity.
    """
    earliest = np.full(documents * COORDINATES, _FREE)
    weight = np.bincount(document, minlength=documents)
    reach, pending = np.zeros(documents), weight > 0
    limit = DARTS / np.maximum(weight, 1)
    while pending.any():
        farthest, low, cell = limit[pending].max(), 0.0, 0
        mine = pending[document]
        owner, region = document[mine], unit[mine]
        while low < farthest:
            high = FIRST_CELL * 2.0**cell
            here = (limit[owner] > low) & (reach[owner] < high)
            who, seed = owner[here], mix(region[here] ^ mix(np.array([cell], np.uint64)))
            count = np.searchsorted(_poisson(high - low), (seed >> np.uint64(11)).astype(float) * 2.0**-53, side="right")
            some = np.flatnonzero(count)
            count = count[some]
            number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            thrown = np.repeat(some, count)
            dart = mix(seed[thrown] + (number + 1).astype(np.uint64) * _GOLDEN)
            rank = low + (high - low) * ((dart >> np.uint64(40)).astype(float) * 2.0**-24)
            who = who[thrown]
            near = rank < limit[who]
            dart, rank, who = dart[near], rank[near].astype(np.float32), who[near]
            slot = who * COORDINATES + ((dart & np.uint64(0xFFFFFFFF)) % np.uint64(COORDINATES)).astype(np.int64)
            packed = (rank.view(np.uint32).astype(np.uint64) << np.uint64(32)) | (mix(dart) >> np.uint64(32))
            np.minimum.at(earliest, slot, packed)
            low, cell = high, cell + 1
        reach = np.where(pending, limit, reach)
        pending = pending & (earliest.reshape(documents, COORDINATES) == _FREE).any(axis=1)
        limit = np.where(pending, 2 * limit, limit)
    return earliest.reshape(documents, COORDINATES)


def buckets(signature: np.ndarray) -> np.ndarray:
    """One hash for each band of coordinates."""
    parts, out = signature.reshape(-1, BANDS, ROWS), np.zeros((len(signature), BANDS), np.uint64)
    for row in range(ROWS):
        out = mix(out * _GOLDEN + parts[:, :, row])
    return mix(out + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, words in chunks(batch.column(2)):
            document, unit = units(*shingles(words))
            bounds = np.searchsorted(document, np.arange(words.documents + 1))
            for low in range(0, words.documents, _DOCUMENTS_AT_ONCE):
                high = min(low + _DOCUMENTS_AT_ONCE, words.documents)
                part = slice(bounds[low], bounds[high])
                hashes = buckets(signatures(document[part] - low, unit[part], high - low))
                some = np.diff(bounds[low : high + 1]) > 0
                ends = np.append(0, np.cumsum(some * BANDS)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[some].ravel().view(np.int64)))
                own = slice(rows.start + low, rows.start + high)
                weight = pa.array(np.diff(bounds[low : high + 1]))
                columns = [batch.column(0)[own], batch.column(1)[own], weight, lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "content", "weight", "bands"])


def content(text: Column) -> Column:
    """128 bits that stand for a text; null is a text of its own."""
    return F.unhex(F.md5(F.encode(F.coalesce(F.concat(F.lit("+"), text), F.lit("")), "UTF-8")))


def weighted(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The weighted shingles of each document as a set of unit regions; two texts share the weight they share."""
    document, unit = units(*shingles(words))
    order = np.lexsort((unit, document))
    return document[order], unit[order]


def classes(documents: DataFrame, staging: Staging) -> DataFrame:
    """One row per document: doc_id, content, class_id (least doc_id of its class), first_of_class.

    Texts whose weighted Jaccard similarity of five-word shingles (weight: how often) is 0.8 or more are
    linked, and a class is what links hold together. Texts that share a bucket meet in blocks, where their
    similarity is computed exactly. Equal texts are one node from the start. Texts of fewer than five words have one shingle; texts without a word are like equal texts only, and null is
    like null. ``first_of_class`` marks one content of each class, that of the least id (nulls last, then
    least content). Rows that are wholly repeated are marked alike. Very long texts are taken
    whole. An empty table gives no rows. Other columns are not read.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = staging.table(
        rows.select("doc_id", content(F.col("text")).alias("content"), F.coalesce("text", F.lit("")).alias("text"))
        .mapInArrow(_sign, "doc_id long, content binary, weight long, bands array<long>")
        .withColumn("row", F.monotonically_increasing_id()),
        "signed",
    )
    same = staging.table(signed.groupBy("content").agg(F.min("row").alias("node")), "same")
    nodes = signed.join(same.select(F.col("node").alias("row")), "row", "left_semi").select(
        F.col("row").alias("node"), "doc_id", "content", F.col("weight").alias("n"), F.col("bands").alias("keys")
    )
    texts = rows.select("doc_id", content(F.col("text")).alias("content"), "text")
    found = links(staging.table(nodes, "nodes"), texts, Rule(weighted, round(100 * SIMILARITY)), staging)
    roots = components(found, staging, "component")
    placed = (
        signed.select("doc_id", "content")
        .join(same, "content")
        .join(roots, "node", "left")
        .select("doc_id", "content", F.coalesce("root", "node").alias("class"))
    )
    placed = staging.table(placed, "classes")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    first = placed.groupBy("class").agg(F.min(rank).alias("first"))
    mine = (F.col("content") == F.col("first.content")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    return placed.join(first, "class").select("doc_id", "content", F.col("first.doc_id").alias("class_id"), mine.alias("first_of_class"))
