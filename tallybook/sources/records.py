"""CSV records of large files, read in pieces although values may hold line breaks.

A record may begin in one piece of a file and end in another, and whether a line break ends a record
depends on all quotes before it. So each line is reduced to what it does to a reader: where it leaves one
that comes to it outside quotes, and where one that comes inside. A first pass puts these effects together in
each piece, for both ways to come to it, and returns one row for each piece; they are chained over the pieces of
a file. A second pass knows how a reader comes to its piece and joins the lines of each record as they are read,
so no text is shuffled but that of the few records that cross the border of two pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE, DELIMITER = '"', ","

# Where a reader stands in a line: at the start of a value, in a plain value, in quotes, behind a quote in them.
_START, _PLAIN, _QUOTED, _BEHIND = range(4)


def _left_by(text: Column, coming: int) -> Column:
    """Does a reader that comes to the line outside (0) or inside (1) quotes leave it inside them?

    A quote opens a value only at its start, and closes it unless another follows: two are one of the value's
    own. Quotes within a plain value are part of it.
    """

    def quote(state: Column) -> Column:
        return (
            F.when(state == _START, _QUOTED)
            .when(state == _QUOTED, _BEHIND)
            .when(state == _BEHIND, _QUOTED)
            .otherwise(_PLAIN)
        )

    def piece(state: Column, between: Column) -> Column:
        plain = F.when(F.endswith(between, F.lit(DELIMITER)), _START).otherwise(_PLAIN)
        return F.when((between == "") | (state == _QUOTED), state).otherwise(plain)

    pieces = F.split(text, QUOTE, -1)
    first = F.lit(_QUOTED if coming else _START)
    # Each piece but the first has a quote before it.
    end = F.aggregate(
        F.slice(pieces, 2, F.size(pieces)),
        piece(first, F.element_at(pieces, 1)),
        lambda state, between: piece(quote(state), between),
    )
    inside = (end == _QUOTED).cast("int")
    return F.when(F.contains(text, F.lit(QUOTE)), inside).otherwise(F.lit(coming))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, row and text of all lines; row numbers grow along the lines of a block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("text"),
    )


def _effect() -> Column:
    """What a line does: 1 if it leaves one inside who comes outside, 2 if one who comes inside, 4 if it is blank."""
    text = F.col("text")
    blank = text.isin("", "\r").cast("int")
    return (_left_by(text, 0) + 2 * _left_by(text, 1) + 4 * blank).cast("byte").alias("effect")


def _after(effects: np.ndarray, came: int) -> np.ndarray:
    """Is a reader who ``came`` so inside quotes behind each line?

    An effect either forgets where the reader came from, or keeps it, or turns it round. So what counts is the
    last one that forgets, and how many turned it round since.
    """
    out, in_ = effects & 1, effects >> 1 & 1
    turns = np.cumsum(out & (in_ ^ 1))
    last = np.maximum.accumulate(np.where(out == in_, np.arange(len(out)), -1))
    known = last >= 0
    return np.where(known, out[last] + turns - turns[last], came + turns) & 1


def _runs(same: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of equal values."""
    cuts = np.append(np.flatnonzero(same[1:] != same[:-1]) + 1, len(same))
    return zip(np.append(0, cuts[:-1]).tolist(), cuts.tolist(), strict=True)


_ENDS = "file string, block long, " + ", ".join(
    f"left_{c} int, first_{c} long, last_{c} long, head_{c} long" for c in (0, 1)
)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block. For a reader who comes outside (0) and inside (1): where it is left, the first
    and the last line that begins a record, and the first of them that isn't blank."""
    place, seen = None, []

    def summary() -> pa.RecordBatch:
        values = [v for way in seen for v in way]
        columns = [pa.array([v], pa.string() if i == 0 else pa.int64()) for i, v in enumerate([*place, *values])]
        for i in (2, 6):
            columns[i] = columns[i].cast(pa.int32())
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _ENDS.split(", ")])

    for batch in batches:
        if not len(batch):
            continue
        files = batch.column("file").dictionary_encode()
        names, file = files.dictionary, files.indices.to_numpy()
        block, row, effect = (batch.column(c).to_numpy() for c in ("block", "row", "effect"))
        for file_from, file_to in _runs(file):
            for low, high in _runs(block[file_from:file_to]):
                low, high = low + file_from, high + file_from
                here = (names[int(file[low])].as_py(), int(block[low]))
                if here != place:
                    if place is not None:
                        yield summary()
                    place, seen = here, [[0, None, None, None], [1, None, None, None]]
                for way in seen:
                    after = _after(effect[low:high], way[0])
                    begins = np.flatnonzero(np.append(way[0], after[:-1]) == 0) + low
                    filled = begins[effect[begins] < 4]
                    way[0] = int(after[-1])
                    if len(begins):
                        way[1] = int(row[begins[0]]) if way[1] is None else way[1]
                        way[2] = int(row[begins[-1]])
                    if len(filled) and way[3] is None:
                        way[3] = int(row[filled[0]])
    if place is not None:
        yield summary()


@dataclass
class Block:
    """How a reader comes to a piece of a file, and which of its lines belong to records that cross its border."""

    file: str
    block: int
    came: int
    heading: int | None = None
    head_until: int | None = None
    head_of: tuple[int, int] | None = None
    tail_from: int | None = None


@dataclass
class Blocks:
    """All pieces, in their order, and the files that end inside quotes: their last record would swallow all
    that follows the quote."""

    blocks: list[Block]
    unclosed: list[str]


_NO_ROW = (1 << 63) - 1


def read_blocks(lines: DataFrame) -> Blocks:
    """The first pass; one row for each piece comes to the driver, as many as the driver dealt out."""
    effects = lines.select("file", "block", "row", _effect())
    ends = sorted(effects.mapInArrow(_ends, _ENDS).collect())
    blocks, unclosed = [], []
    came, begun, headed = 0, None, False
    for i, end in enumerate(ends):
        if i == 0 or ends[i - 1]["file"] != end["file"]:
            came, begun, headed = 0, None, False
        left, first, last, head = (end[f"{name}_{came}"] for name in ("left", "first", "last", "head"))
        block = Block(end["file"], end["block"], came)
        if head is not None and not headed:
            block.heading, headed = head, True
        if came:
            block.head_until, block.head_of = _NO_ROW if first is None else first, begun
        if last is not None:
            begun = (end["block"], last)
            if left:
                block.tail_from = last
        blocks.append(block)
        came = left
        if left and (i + 1 == len(ends) or ends[i + 1]["file"] != end["file"]):
            unclosed.append(end["file"])
    return Blocks(blocks, unclosed)


def _file_key() -> Column:
    return F.xxhash64("file")


_PLACED = "file string, block long, row long, text string"


def _joined(places: dict[tuple[int, int], Block]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Joins the lines of each record that lies in one block; leaves out headings.

    The lines of a batch lie one behind the other, line breaks included. So a record is a stretch of these
    bytes, and only one that goes on in the next batch is copied.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, block, state, open_row, open_text = None, None, 0, 0, []
        out: list[tuple[str, int, np.ndarray, pa.Array]] = []

        def close() -> None:
            if open_text:
                whole = pa.array([b"".join(open_text)], pa.binary()).view(pa.string())
                out.append((block.file, block.block, np.array([open_row]), whole))
                open_text.clear()

        def batch_out() -> pa.RecordBatch:
            files = [pa.repeat(pa.scalar(file), len(rows)) for file, _, rows, _ in out]
            numbers = [pa.array(np.full(len(rows), start)) for _, start, rows, _ in out]
            rows, texts = [pa.array(rows) for _, _, rows, _ in out], [text for _, _, _, text in out]
            columns = [pa.concat_arrays(x) for x in (files, numbers, rows, texts)]
            keep = np.ones(len(columns[2]), bool)
            for heading in {places[k].heading for k in touched} - {None}:
                keep &= columns[2].to_numpy() != heading
            return pa.RecordBatch.from_arrays(columns, ["file", "block", "row", "text"]).filter(pa.array(keep))

        touched: set[tuple[int, int]] = set()
        for batch in batches:
            if not len(batch):
                continue
            key, start, row, effect = (batch.column(c).to_numpy() for c in ("key", "block", "row", "effect"))
            text = batch.column("text").cast(pa.string())
            _, offsets, data = text.buffers()
            offsets = np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1]
            touched = {here} - {None}
            for key_from, key_to in _runs(key):
                for low, high in _runs(start[key_from:key_to]):
                    low, high = low + key_from, high + key_from
                    place = (int(key[low]), int(start[low]))
                    if place != here:
                        if not state:
                            close()
                        open_text.clear()
                        here, block = place, places[place]
                        state = block.came
                        touched.add(place)
                    after = _after(effect[low:high], state)
                    begins = np.flatnonzero(np.append(state, after[:-1]) == 0) + low
                    until = begins[0] if len(begins) else high
                    if open_text:
                        open_text.append(data[int(offsets[low]) : int(offsets[until])].to_pybytes())
                    if len(begins):
                        close()
                        bounds = pa.py_buffer(np.ascontiguousarray(offsets[begins]))
                        records = pa.StringArray.from_buffers(len(begins) - 1, bounds, data)
                        out.append((block.file, block.block, row[begins[:-1]], records))
                        open_row = int(row[begins[-1]])
                        open_text.append(data[int(offsets[begins[-1]]) : int(offsets[high])].to_pybytes())
                    state = int(after[-1])
            if out:
                yield batch_out()
                out.clear()
        if not state:
            close()
        if out:
            touched = {here}
            yield batch_out()

    return join


def _crossing(lines: DataFrame, blocks: Blocks) -> DataFrame | None:
    """The records that lie in several blocks, None if there are none; headings are left out."""
    headings = {(b.file, b.block, b.heading) for b in blocks.blocks if b.heading is not None}
    rows = []
    for b in blocks.blocks:
        head = b.head_of if b.head_of and (b.file, *b.head_of) not in headings else None
        tail = b.tail_from if (b.file, b.block, b.tail_from) not in headings else None
        if head or tail is not None:
            rows.append((b.file, b.block, b.head_until if head else -1, *(head or (None, None)), _NO_ROW if tail is None else tail))
    if not rows:
        return None
    names = ("file", "block", "head_until", "head_block", "head_row", "tail_from")
    kinds = (pa.string(), *[pa.int64()] * 5)
    table = pa.table([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    wanted = lines.join(lines.sparkSession.createDataFrame(table), ["file", "block"])
    head, tail = F.struct(F.col("head_block").alias("block"), F.col("head_row").alias("row")), F.struct("block", F.col("tail_from").alias("row"))
    wanted = wanted.withColumn("start", F.when(F.col("row") < F.col("head_until"), head).when(F.col("row") >= F.col("tail_from"), tail))
    pieces = F.array_sort(F.collect_list(F.struct("block", "row", "text")))
    gathered = wanted.where("start IS NOT NULL").groupBy("file", "start").agg(
        F.array_join(F.transform(pieces, lambda x: x["text"]), "\n").alias("text")
    )
    return gathered.select("file", "start.*", "text")


def read_records(lines: DataFrame, blocks: Blocks) -> DataFrame:
    """file, block, row (those of its first line) and text of all records that are not empty, without the heading.

    A line break inside quotes is part of the record; a carriage return before one that ends it is not.
    """
    files = pa.table([pa.array(sorted({b.file for b in blocks.blocks}), pa.string())], ["file"])
    keys = dict(lines.sparkSession.createDataFrame(files).select("file", _file_key()).collect())
    if len(set(keys.values())) < len(keys):
        raise ValueError("two of the files have one hash; rename one")
    places = {(keys[b.file], b.block): b for b in blocks.blocks}
    line = F.concat("text", F.lit("\n")).alias("text")
    sent = lines.select(_file_key().alias("key"), "block", "row", _effect(), line)
    records = sent.mapInArrow(_joined(places), _PLACED).withColumn("text", F.expr("left(text, length(text) - 1)"))
    crossing = _crossing(lines, blocks)
    if crossing is not None:
        records = records.unionByName(crossing)
    return records.withColumn("text", F.regexp_replace("text", r"\r\z", "")).where("text <> ''")
