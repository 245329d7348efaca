"""Interleaving sources to target weights by earliest-deadline-first scheduling of Pfair windows."""

from __future__ import annotations

import heapq
from collections import defaultdict, deque
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.ranks import ranked, spread

#: Slots that a task schedules at least, or SLOTS_A_SOURCE for each source if that is more.
PERIOD = 1024
SLOTS_A_SOURCE = 8
#: Weights are whole numbers of 1 / FINE: over 2^30 slots that moves a source by a thousandth of a block.
FINE = 2**40
BLOCK_ROWS = 16
_ROWS_AT_ONCE = 10_000
TEMPER = 0.5


def tempered(sizes: dict[str, int], power: float = TEMPER) -> dict[str, float]:
    """Weights in proportion to a power of the sizes: under 1 it lifts small sources."""
    total = sum(n**power for n in sizes.values())
    return {source: n**power / total for source, n in sizes.items()}


def slots(sources: int, period: int = PERIOD) -> int:
    """Slots of a period with so many sources."""
    return max(period, SLOTS_A_SOURCE * sources)


def shares(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Blocks of each source in a period: whole numbers that sum to it, by the largest remainder.

    A source has one at least, which one of the largest gives; with ``FINE`` blocks that moves no weight by more
    than its share of 2 ** -40.
    """
    if min(weights.values()) <= 0:
        raise ValueError("weights are over 0")
    period = slots(len(weights), period)
    total = sum(map(Fraction, weights.values()))
    exact = {s: period * Fraction(w) / total for s, w in sorted(weights.items())}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (parts[s] - exact[s], s))
    rest = period - sum(parts.values())
    for s in by_rest[: max(rest, 0)]:
        parts[s] += 1
    for _ in range(-rest):
        parts[max(parts, key=lambda s: (parts[s], s))] -= 1
    return parts


def stretch(parts: dict[str, int]) -> int:
    """Slots that are scheduled apart from the others: as many as the longest window, or more."""
    return max(2 * slots(len(parts)), sum(parts.values()) // min(parts.values()) + 2)


def _window(share: int, whole: int, block: int) -> tuple[int, int]:
    return block * whole // share, -(-(block + 1) * whole // share)


def begun(parts: dict[str, int], slot: int) -> dict[str, int]:
    """Blocks of each source that run before ``slot``: its quota rounded down or up, summing to ``slot``.

    A source between two blocks has part of one due. Which of these blocks run before ``slot`` decides
    whether all windows on both sides can be met: taken in the order of their windows' starts, and as well
    in that of their ends, the chosen ones must never be fewer than the whole blocks due so far. So both
    orders are cut into stretches of one whole block due, and a flow finds one block for each stretch of
    either; a solution exists, as the due parts themselves are one in fractions.
    """
    whole = sum(parts.values())
    out = {s: n * slot // whole for s, n in parts.items()}
    due = {s: n * slot % whole for s, n in parts.items() if n * slot % whole}
    ahead: dict[tuple, dict] = defaultdict(dict)  # keys in their order, the same in every process
    for side in (0, 1):
        at = 0
        for s in sorted(due, key=lambda s: (Fraction(out[s] + side, parts[s]), s)):
            for stretch in range(at // whole, (at + due[s] - 1) // whole + 1):
                if side:
                    ahead["out", s][side, stretch] = True
                    ahead[side, stretch]["end",] = True
                else:
                    ahead["start",][side, stretch] = True
                    ahead[side, stretch]["in", s] = True
            at += due[s]
    for s in due:
        ahead["in", s]["out", s] = True
    for _ in range(sum(due.values()) // whole):
        came, queue = {("start",): None}, deque([("start",)])
        while ("end",) not in came:
            node = queue.popleft()
            for then in ahead[node]:
                if then not in came:
                    came[then] = node
                    queue.append(then)
        node = ("end",)
        while came[node] is not None:
            del ahead[came[node]][node]
            ahead[node][came[node]] = True
            node = came[node]
    for s in due:
        out[s] += ("out", s) not in ahead["in", s]
    return out


def schedule(parts: dict[str, int], start: int = 0, length: int | None = None) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) of each block of ``length`` slots from ``start``; default: one period.

    Block i of a source with n of ``period`` slots may run from floor(i * period / n) and must have run by
    ceil((i + 1) * period / n). Each slot takes the released block of the earliest deadline. As the shares
    fill the period, every deadline holds, and a source is never a whole block ahead of or behind its weight.
    Stretches that follow each other can be scheduled apart, as ``begun`` says which blocks are whose, if
    no window is longer than a stretch (``stretch``).
    """
    period = sum(parts.values())
    end = start + (period if length is None else length)
    first, last = begun(parts, start), begun(parts, end)
    waiting = [(_window(parts[s], period, first[s])[0], s, first[s]) for s in parts if first[s] < last[s]]
    heapq.heapify(waiting)
    ready: list[tuple] = []
    for slot in range(start, end):
        while waiting and waiting[0][0] <= slot:
            release, source, block = heapq.heappop(waiting)
            deadline = _window(parts[source], period, block)[1]
            heapq.heappush(ready, (min(deadline, end), source, block, release, deadline))
        _, source, block, release, deadline = heapq.heappop(ready)
        yield source, block, release, deadline, slot
        if block + 1 < last[source]:
            heapq.heappush(waiting, (_window(parts[source], period, block + 1)[0], source, block + 1))


def _scheduled(batches: Iterator[pa.RecordBatch], parts: dict[str, int], length: int, blocks: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """The schedule of each stretch, as far as the sources have blocks."""
    kinds = (pa.string(), *[pa.int64()] * 4)
    for batch in batches:
        for number in batch.column(0).to_pylist():
            plan = (p for p in schedule(parts, number * length, length) if p[1] < blocks[p[0]])
            while some := list(islice(plan, _ROWS_AT_ONCE)):
                columns = zip(*some, strict=True)
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["source", "block", "release", "deadline", "slot"])


def source_key(source: Column) -> Column:
    """A text that stands for a source; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("+"), source.cast("string")), F.lit(""))


def mixed(
    documents: DataFrame,
    weights: dict[str, float] | None = None,
    source_col: str = "source",
    order: Column | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """All rows and columns of ``documents`` and a struct column of their place in the mixture.

    The struct has block, release, deadline, slot and position, the order of the mixture, in which a block's
    rows stand together. Windows follow from the given weights over the whole stream, and tasks schedule stretches
    of it apart, each as long as the longest window: so a source is never a whole block off its weight, however
    long the stream and small the weight. Rows of a source are taken in the order of a hash, so blocks are
    mixed; ``order`` is unique but for rows that are wholly equal (default: doc_id), which take their places in
    any order. ``weights`` maps sources to weights over 0; default: the root of their row counts. A source that
    isn't in it gets the least of them. When a source runs out, its slots stay empty and the others keep their
    pace: no row is dropped or repeated. Null is a source of its own. The struct is called ``mixture``, with
    underscores until that is new; columns of any other name are kept as they are. Texts aren't looked at. An empty
    table stays empty. ``documents`` is read more than once.
    """
    name = "mixture"
    while name in (c.lower() for c in documents.columns):
        name += "_"
    spark = documents.sparkSession
    hashed = F.col("doc_id") if order is None else order
    kept = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    keyed = documents.select(kept, source_key(F.col(source_col)).alias("source"), F.struct(F.xxhash64(hashed), hashed).alias("order"))
    sizes = {r["source"]: r["count"] for r in keyed.groupBy("source").count().collect()}
    if weights is not None:
        given = {f"+{s}" if s is not None else "": w for s, w in weights.items()}
        target = {s: given.get(s, min(given.values())) for s in sizes}
    else:
        target = tempered(sizes)
    parts = shares(target or {"": 1.0}, FINE)
    blocks, length = {s: -(-n // block_rows) for s, n in sizes.items()}, stretch(parts)
    last = max((_window(parts[s], FINE, n - 1)[1] for s, n in blocks.items()), default=0)
    fields = "source string, block long, release long, deadline long, slot long"
    stretches = -(-last // length)
    numbers = spark.range(0, stretches, 1, max(1, min(stretches, 4 * spread(documents))))
    table = numbers.mapInArrow(lambda batches: _scheduled(batches, parts, length, blocks), fields)
    numbered = ranked(keyed, ["source"], "order", "rank").withColumn("block", F.floor(F.col("rank") / block_rows))
    place = F.struct("block", "release", "deadline", "slot", (F.col("slot") * block_rows + F.col("rank") % block_rows).alias("position"))
    return numbered.join(table, ["source", "block"]).select("row.*", place.alias(name))


def place_column(documents: DataFrame, mixture: DataFrame) -> str:
    """The name of the column that ``mixed`` added."""
    (name,) = [f.name for f in mixture.schema if isinstance(f.dataType, T.StructType) and f.name not in documents.columns]
    return name
