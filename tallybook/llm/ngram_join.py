"""Jaccard join of documents on word n-grams by blocked sparse matrix products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.blocks import Rule, content_key, links
from tallybook.llm.components import components
from tallybook.llm.staging import Staging
from tallybook.llm.wordhash import Words, chunks, mix, range_hash

SHINGLE = 3
#: Two sets link when PARTS * shared >= LINKED * either, as whole numbers: a similarity of 0.9.
LINKED, PARTS = 90, 100
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_KEY_A, _KEY_B, _PART, _ELEMENT, _PREFIX = (np.uint64(0x100000001B3 * k + 1) for k in range(5))


def _bands() -> tuple[np.ndarray, np.ndarray]:
    """First size of each size band, and into how many parts its sets are divided.

    A set links only with sets up to PARTS / LINKED of its size, so with those of its own band and of its
    neighbours. Linked sets of n <= m elements differ in (n + m) * (PARTS - LINKED) / (PARTS + LINKED) elements
    at most; with one part more than that, one part at least is the same in both.
    """
    first, parts = [1], []
    while first[-1] < 1 << 40:
        first.append(first[-1] * PARTS // LINKED + 1)
        largest = first[-1] - 1
        parts.append((largest + largest * PARTS // LINKED) * (PARTS - LINKED) // (PARTS + LINKED) + 1)
    return np.array(first[:-1]), np.array(parts)


BAND_FIRST, BAND_PARTS = _bands()


def sets_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, element) of the distinct shingles of each document, sorted; a shorter text is one shingle."""
    hashes, counts = words.hashes(lower=True), words.counts
    start = words.runs(SHINGLE)
    end = start + SHINGLE
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    start, end = np.append(start, words.first[:-1][short]), np.append(end, words.first[1:][short])
    document, element = np.searchsorted(words.first, start, side="right") - 1, range_hash(hashes, start, end)
    order = np.lexsort((element, document))
    document, element = document[order], element[order]
    new = np.append(True, (document[1:] != document[:-1]) | (element[1:] != element[:-1]))[: len(element)]
    return document[new], element[new]


def _sums(owner: np.ndarray, values: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(length, np.uint64)
    np.add.at(out, owner, values)
    return out


def part_keys(document: np.ndarray, element: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, key): two documents that link have a key in common.

    Each set is divided by a hash of its elements into the parts of its band, and of the band before for its
    smaller partners; a part's key stands for all elements in it. Where a part is empty, the part that two
    sets have in common might be that one; such sets also get the keys of their least elements by hash, one
    more than a linked set may lack, of which both then have one.
    """
    owners, keys = [], []
    band = np.searchsorted(BAND_FIRST, np.maximum(sizes, 1), side="right") - 1
    value = mix(element ^ _ELEMENT)
    for back in (0, 1):
        mine = band - back
        parts = np.where((sizes > 0) & (mine >= 0), BAND_PARTS[np.maximum(mine, 0)], 0)
        parts = np.where(parts > 1, parts, 0)  # with one part only equal sets link, and these are one already
        first = np.append(0, np.cumsum(parts))
        some = parts[document] > 0
        who = document[some]
        seed = mix((mine[who].astype(np.uint64) + np.uint64(1)) * _PART)
        at = first[who] + (mix(element[some] ^ seed) % parts[who].astype(np.uint64)).astype(np.int64)
        total = _sums(at, value[some], first[-1])
        filled = np.zeros(first[-1], bool)
        filled[at] = True
        holder = np.repeat(np.arange(len(sizes)), parts)
        number = np.arange(first[-1]) - first[holder]
        owners.append(holder[filled])
        keys.append(mix(total[filled] + mix((mine[holder] << 32 | number)[filled].astype(np.uint64) * _GOLDEN)))
        gap = np.zeros(len(sizes), bool)
        gap[holder[~filled]] = True
        order = np.lexsort((value, document))
        who = document[order]
        rank = np.arange(len(order)) - np.searchsorted(who, who)
        least = gap[who] & (rank <= sizes[who] * (PARTS - LINKED) // PARTS)
        who, token = who[least], value[order][least]
        owners.append(who)
        keys.append(mix((token ^ _PREFIX) + mix((mine[who].astype(np.uint64) + np.uint64(1)) * _PREFIX)))
    return np.concatenate(owners), np.concatenate(keys)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, content, n, set_key, parts) of each document."""
    for batch in batches:
        for rows, words in chunks(batch.column(2)):
            document, element = sets_of(words)
            sizes = np.bincount(document, minlength=words.documents)
            owner, keys = part_keys(document, element, sizes)
            order = np.argsort(owner, kind="stable")
            ends = np.append(0, np.cumsum(np.bincount(owner, minlength=words.documents))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[order].view(np.int64)))
            both = np.stack([_sums(document, mix(element ^ k), words.documents) for k in (_KEY_A, _KEY_B)], axis=1)
            key = pa.array([x.tobytes() for x in both], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[rows], batch.column(1)[rows], pa.array(sizes), key, lists], ["doc_id", "content", "n", "set_key", "parts"]
            )


class Joiner:
    """Links between different sets, found block by block.

    All sets that have a key in common with one leader are a group, so two sets that link have a group in
    common. Groups go to bins, as many as keep a bin below a block. A group larger than a block is dealt
    at random into blocks, and each two of its blocks meet in a task. A group of more than ``FEW_BLOCKS``
    blocks is first only multiplied block by block, twice over with other blocks, which ties most of it
    together at a cost in proportion to its sets; what may still be linked then has one side outside the
    group's largest component, so blocks of these meet all blocks. Only links with the first set of each
    component leave a task.
    """

    def __init__(self, groups: DataFrame, documents: DataFrame, staging: Staging):
        """groups: group, node, n, doc_id, content; documents: doc_id, content, text."""
        self.staging = staging
        weight = F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_ELEMENTS)
        sizes = groups.groupBy("group").agg(F.ceil(weight).cast("long").alias("blocks"), weight.alias("weight"))
        self.sizes = staging.table(sizes, "sizes")
        placed = groups.join(self.sizes, "group").select("group", "node", "doc_id", "content", "blocks")
        # No broadcast: neither side has a bound.
        same = (documents["content"] == placed["content"]) & documents["doc_id"].eqNullSafe(placed["doc_id"])
        self.texts = documents.hint("merge").join(placed, same).select("group", "node", "blocks", "text")

    def product(self, dealt: DataFrame, name: str) -> DataFrame:
        """Links in each group of (bin, block)."""
        links = dealt.select("bin", "block", "group", "node", "text").groupBy("bin", "block").applyInArrow(_multiply, "a long, b long")
        return self.staging.table(links, name)

    def block(self, seed: int) -> Column:
        """A random block of each set of a group."""
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.col("blocks"))

    def links(self) -> DataFrame:
        summed = self.sizes.agg(F.sum(F.when(F.col("blocks") == 1, F.col("weight"))), F.max("blocks")).first()
        bins = 1 + int(4 * (summed[0] or 0))
        mine = self.block(1)
        beside = F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda other: F.least(mine, other) * F.col("blocks") + F.greatest(mine, other)
        )
        alone = F.array(F.lit(-1).cast("long"))
        dealt = self.texts.where(F.col("blocks") <= FEW_BLOCKS).select(
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("group"), F.lit(bins))).otherwise(F.col("group")).alias("bin"),
            F.explode(F.when(F.col("blocks") == 1, alone).otherwise(beside)).alias("block"),
            "group",
            "node",
            "text",
        )
        links = self.product(dealt, "links")
        if (summed[1] or 0) <= FEW_BLOCKS:
            return links
        return links.unionAll(self.large())

    def large(self) -> DataFrame:
        """The links of groups of many blocks."""
        texts = self.texts.where(F.col("blocks") > FEW_BLOCKS)
        seeded = [texts.select(F.col("group").alias("bin"), self.block(s).alias("block"), "group", "node", "text") for s in (1, 2)]
        tied = self.product(seeded[0], "links_first").unionAll(self.product(seeded[1], "links_second"))
        roots = components(tied, self.staging, "tied")
        rooted = texts.withColumn("block", self.block(1)).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        counted = rooted.groupBy("group", "root").agg(F.count(F.lit(1)).alias("sets"))
        largest = counted.groupBy("group").agg(F.max(F.struct("sets", "root")).alias("most")).select("group", F.col("most.root").alias("most"))
        rooted = self.staging.table(rooted.join(largest, "group").withColumn("open", F.col("root") != F.col("most")), "rooted")
        asking = self.staging.table(rooted.where("open").select("group", F.col("block").alias("asking")).distinct(), "asking")
        asked = rooted.join(asking, "group").where("not open or block > asking")
        own = rooted.where("open").withColumnRenamed("block", "asking")
        beside = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
        met = F.concat_ws("/", "group", "asking").alias("bin")
        dealt = asked.select(met, "block", "group", "node", "text").unionAll(own.select(met, beside, "group", "node", "text"))
        return tied.unionAll(self.product(dealt, "links_open"))


def joined(documents: DataFrame, staging: Staging) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A document is the set of its distinct runs of ``SHINGLE`` words, in which A-Z are lower-cased; one of fewer
    words is a single run of them all. Documents link when their sets have a Jaccard similarity of 0.9 or
    more, and component_id is the least doc_id that links reach from a document, itself included.

    Equal sets are one node from the start, so copies cost one set. No pair of documents is ever a row.
    Null and empty texts, and texts without words, link with nothing. Null ids come last: a component that
    has no other has a null component_id. Rows with one id but other texts are documents of their own, and
    repeated rows each get the same result. Very long texts are one set each. An empty table gives no rows.
    Other columns are not read.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), content_key().alias("content"), text)
    made = "doc_id long, content binary, n long, set_key binary, parts array<long>"
    signed = staging.table(rows.mapInArrow(_signed, made).withColumn("row", F.monotonically_increasing_id()), "signed")
    same = signed.where("n > 0").groupBy("set_key").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    same = staging.table(same, "same")
    firsts = signed.join(same.select(F.col("node").alias("row")), "row", "left_semi")
    firsts = staging.table(firsts.select(F.col("row").alias("node"), "doc_id", "content", "n", F.col("parts").alias("keys")), "firsts")
    found = links(firsts, rows, Rule(sets_of, LINKED, PARTS), staging)
    roots = components(found, staging, "component")
    placed = staging.table(same.join(roots, "node", "left").select("set_key", "least", F.coalesce("root", "node").alias("root")), "placed")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("set_key", "component_id")
    return signed.select("doc_id", "n", "set_key").join(named, "set_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
