"""Best-fit-decreasing packing of indivisible groups into shards of one capacity."""

from __future__ import annotations

from dataclasses import dataclass
from random import Random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.ranks import ranked
from tallybook.llm.staging import Staging

#: Group sizes up to 2 ** SIZE_BITS bytes stay exact in the packing plan; larger ones are rounded up to
#: so many significant bits. That bounds the size table on the driver: 4,096 classes for each doubling
#: of the largest group, so under 160,000 for groups of up to 2 ** 50 bytes, whatever the row count.
SIZE_BITS = 13


@dataclass
class _Node:
    key: tuple[int, int]
    weight: float
    left: _Node | None = None
    right: _Node | None = None


def _split(node: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
    """The keys below ``key``, and the others."""
    if node is None:
        return None, None
    if node.key < key:
        node.right, high = _split(node.right, key)
        return node, high
    low, node.left = _split(node.left, key)
    return low, node


def _merge(low: _Node | None, high: _Node | None) -> _Node | None:
    """Two trees, of which one has all smaller keys; the lighter root stays above."""
    if low is None or high is None:
        return low or high
    if low.weight < high.weight:
        low.right = _merge(low.right, high)
        return low
    high.left = _merge(low, high.left)
    return high


class RoomTree:
    """Remaining capacities with their bins in a binary tree, which random weights keep balanced."""

    def __init__(self):
        self.root, self.random = None, Random(0)

    def add(self, room: int, number: int) -> None:
        low, high = _split(self.root, (room, number))
        self.root = _merge(_merge(low, _Node((room, number), self.random.random())), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least room for ``size``, of equal ones that of the least number."""
        low, high = _split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        first = high
        while first.left:
            first = first.left
        _, rest = _split(high, (first.key[0], first.key[1] + 1))
        self.root = _merge(low, rest)
        return first.key


class Bins:
    """Open bins in a balanced tree by remaining capacity; equal ones by number."""

    def __init__(self, capacity: int, bins: int):
        self.capacity, self.most, self.used, self.rest = capacity, bins, 0, RoomTree()

    def place(self, size: int, count: int) -> list[tuple[int, int]] | None:
        """Put ``count`` items of ``size`` one by one into the tightest bin each: (bin, items) in order.

        A bin that just took an item is the tightest for the next of the same size while it fits, so a
        run of equal items costs one step for each bin that it reaches. None: they don't fit.
        """
        placed = []
        while count:
            tightest = self.rest.take_tightest(size)
            if tightest:
                room, number = tightest
            elif self.used < self.most and size <= self.capacity:
                room, number = self.capacity, self.used
                self.used += 1
            else:
                return None
            taken = min(count, room // size) if size else count
            self.rest.add(room - taken * size, number)
            placed.append((number, taken))
            count -= taken
        return placed


def pack_classes(classes: list[tuple[int, int]], capacity: int, bins: int) -> list[tuple[int, int, int, int]] | None:
    """Place classes (size, count) in descending size: (size, first, end, bin) ranges, or None if too full."""
    open_bins, ranges = Bins(capacity, bins), []
    for size, count in classes:
        placed = open_bins.place(size, count)
        if placed is None:
            return None
        first = 0
        for number, taken in placed:
            ranges.append((size, first, first + taken, number))
            first += taken
    return ranges


def least_capacity(classes: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int, int]]:
    """Ranges of the least capacity, found by bisection, at which best fit fills no more than ``bins`` bins."""
    total = sum(size * count for size, count in classes)
    low = max(-(-total // bins), classes[0][0] if classes else 0)
    high, best = low, pack_classes(classes, low, bins)
    step = 1
    while best is None:
        low, high = high + 1, high + step
        best, step = pack_classes(classes, high, bins), step * 2
    while low < high:
        middle = (low + high) // 2
        found = pack_classes(classes, middle, bins)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return best


def rounded_up(size: F.Column, bits: int = SIZE_BITS) -> F.Column:
    """``size`` with so many significant bits, never less than it is."""
    unit = F.expr("1L") * F.pow(F.lit(2), F.greatest(F.lit(0), F.length(F.bin(size)) - bits)).cast("long")
    return (F.ceil(size / unit) * unit).cast("long")


def shard(documents: DataFrame, bins: int, staging: Staging, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, group, shard, slot.

    Groups are equal texts and are never divided. Their sizes, largest first, go into the bin with the
    least room that still takes them; the capacity is the least one that needs no more than ``bins``
    bins, so their sizes come out near equal. The driver sees only the table of group sizes, bounded by
    ``SIZE_BITS``; groups find their bin by their rank among groups of that size. A size is planned
    with less than 1 in 4,096 (2 ** (SIZE_BITS - 1)) more than it is, so a shard never holds more than its
    planned capacity, and the planned sizes are larger than the true ones by less than that part.

    A null text has size 1 and the checksum of the empty text, but is a group apart from empty texts.
    Rows with equal ids are kept, all of them. An empty table gives none. Other columns are not read.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staging.table(
        documents.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.concat(F.col(text_col).isNull().cast("int").cast("string"), F.md5(F.encode(text, "UTF-8"))).alias("group"),
        ),
        "rows",
    )
    groups = staging.table(
        rows.groupBy("group").agg(F.sum("size").alias("bytes")).withColumn("class", rounded_up(F.col("bytes"))), "groups"
    )
    classes = [(r["class"], r["count"]) for r in groups.groupBy("class").count().orderBy(F.desc("class")).collect()]
    ranges = spark.createDataFrame(least_capacity(classes, bins), "class long, first long, end long, shard int")
    placed = (
        ranked(groups, ["class"], "group", "place")
        .join(ranges, "class")
        .where((F.col("place") >= F.col("first")) & (F.col("place") < F.col("end")))
        .select("group", "shard")
    )
    found = staging.table(rows.join(placed, "group"), "placed")
    return ranked(found, ["shard"], F.struct("doc_id", "group"), "slot")
