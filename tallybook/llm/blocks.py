"""Links between similar sets that share a key, found by matrix products of bounded blocks.

Sets may be millions and a group of like ones most of them, so no pair of sets is ever a row: groups are cut
into blocks, a task multiplies the incidence matrix of one or two blocks by its transpose, and only a
spanning forest of the links it finds leaves the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.components import components
from tallybook.llm.staging import Staging
from tallybook.llm.wordhash import Words, chunks

#: Sets and elements that one task multiplies at a time; larger groups are cut into blocks.
BLOCK_SETS = 1024
BLOCK_ELEMENTS = 1 << 21
#: Up to so many blocks of a group all meet each other at once.
FEW_BLOCKS = 8
#: Columns multiplied at once, and the share of a block's sets from which a column is multiplied densely.
_COLUMNS_AT_ONCE = 4096
_DENSE = 1 / 32


@dataclass(frozen=True)
class Rule:
    """Which sets texts are, as sorted (document, element) arrays without doubles, and which of them link.

    Two sets link when ``parts`` * shared >= ``linked`` * either, as whole numbers.
    """

    sets: Callable[[Words], tuple[np.ndarray, np.ndarray]]
    linked: int
    parts: int = 100


def overlaps(row: np.ndarray, element: np.ndarray, rows: int) -> np.ndarray:
    """How many elements each two sets share, above the diagonal: the incidence matrix times its transpose.

    Columns that hold one set only add nothing. Columns of many sets are multiplied densely, some thousand at
    a time; of the others each entry is paired with those below it in its column.
    """
    _, column, count = np.unique(element, return_inverse=True, return_counts=True)
    shared = np.zeros((rows, rows), np.int64)
    dense = np.flatnonzero((count > 1) & (count >= rows * _DENSE))
    number = np.full(len(count), -1)
    number[dense] = np.arange(len(dense))
    place = number[column]
    for low in range(0, len(dense), _COLUMNS_AT_ONCE):
        here = (place >= low) & (place < low + _COLUMNS_AT_ONCE)
        block = np.zeros((rows, min(_COLUMNS_AT_ONCE, len(dense) - low)), np.float32)
        block[row[here], place[here] - low] = 1
        shared += (block @ block.T).astype(np.int64)
    sparse = (place < 0) & (count[column] > 1)
    row, column = row[sparse], column[sparse]
    order = np.lexsort((row, column))
    row, column = row[order], column[order]
    step = 1
    while len(row) > step:
        same = np.flatnonzero(column[step:] == column[:-step])
        if not len(same):
            break
        np.add.at(shared, (row[same], row[same + step]), 1)
        step += 1
    return np.triu(shared, 1)


def linked(row: np.ndarray, element: np.ndarray, sizes: np.ndarray, rule: Rule) -> np.ndarray:
    """The symmetric matrix of links: pairs that share at least what their sizes ask for."""
    shared = overlaps(row, element, len(sizes))
    bound = rule.linked * (sizes[:, None] + sizes[None, :])
    links = (rule.parts + rule.linked) * shared >= bound
    return links | links.T


def stars(links: np.ndarray) -> Iterator[tuple[int, int]]:
    """(member, first member) of each component of more than one set."""
    free = np.ones(len(links), bool)
    for first in range(len(links)):
        if not free[first]:
            continue
        free[first] = False
        edge = np.array([first])
        while len(edge):
            edge = np.flatnonzero(links[edge].any(axis=0) & free)
            free[edge] = False
            for member in edge.tolist():
                yield member, first


def _multiply(table: pa.Table, rule: Rule) -> pa.Table:
    """The components of each group among the sets of a block, as links with their least sets."""
    found = []
    table = table.combine_chunks()
    if table.num_rows:
        parts = [(rows.start, *rule.sets(words)) for rows, words in chunks(table.column("text"))]
        row = np.concatenate([d + at for at, d, _ in parts])
        element = np.concatenate([e for _, _, e in parts])
        node, group = (table.column(c).to_numpy() for c in ("node", "group"))
        order = np.lexsort((node, group))
        new = np.append(True, (np.diff(node[order]) != 0) | (np.diff(group[order]) != 0))
        order = order[new]  # rows that are repeated as a whole are one set
        bounds = np.searchsorted(row, np.arange(len(node) + 1))
        for members in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            if len(members) < 2:
                continue
            sizes = bounds[members + 1] - bounds[members]
            elements = np.concatenate([element[bounds[m] : bounds[m + 1]] for m in members])
            links = linked(np.repeat(np.arange(len(members)), sizes), elements, sizes, rule)
            found += [(node[members[a]], node[members[b]]) for a, b in stars(links)]
    columns = list(zip(*found, strict=True)) or [[], []]
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def content_key(text: str = "text") -> Column:
    """128 bits that stand for a text; null is like an empty one."""
    return F.unhex(F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")))


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

    def __init__(self, groups: DataFrame, documents: DataFrame, rule: Rule, staging: Staging):
        """groups: group, node, n, doc_id, content; documents: doc_id, content, text."""
        self.staging, self.rule = staging, rule
        weight = F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_ELEMENTS)
        sizes = groups.groupBy("group").agg(F.ceil(weight).cast("long").alias("blocks"), weight.alias("weight"))
        self.sizes = staging.table(sizes, "sizes")
        placed = groups.join(self.sizes, "group").select("group", "node", "doc_id", "content", "blocks")
        # No broadcast: neither side has a bound.
        same = (documents["content"] == placed["content"]) & documents["doc_id"].eqNullSafe(placed["doc_id"])
        self.texts = documents.hint("merge").join(placed, same).select("group", "node", "blocks", "text")

    def product(self, dealt: DataFrame, name: str) -> DataFrame:
        """Links in each group of (bin, block)."""
        rule, grouped = self.rule, dealt.select("bin", "block", "group", "node", "text").groupBy("bin", "block")
        links = grouped.applyInArrow(lambda table: _multiply(table, rule), "a long, b long")
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


def links(nodes: DataFrame, documents: DataFrame, rule: Rule, staging: Staging) -> DataFrame:
    """(a, b): links that hold together all nodes that link, of those with a key in common.

    ``nodes``: node, n (elements), doc_id, content, keys; ``documents``: doc_id, content, text. Each key is led
    by its least node, and all nodes of the keys that one node leads are a group.
    """
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("node").alias("group"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    leaders = staging.table(leaders.select("key", "group"), "leaders")
    groups = keyed.join(leaders, "key").select("group", "node").distinct().join(nodes.drop("keys"), "node")
    return Joiner(staging.table(groups, "groups"), documents, rule, staging).links()
