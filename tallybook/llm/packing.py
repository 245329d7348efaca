"""Best-two-fit packing of tokenized documents into sequences of one length."""

from __future__ import annotations

import functools
import os
import string
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.ranks import ranked, spread
from tallybook.llm.staging import Staging

SEQUENCE = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Different pieces of text whose ids a Python worker keeps; beyond that it forgets all and goes on, with
#: the same results.
KNOWN_PIECES = 600_000
_BATCH_PIECES = 512
_MARK = "\0"
_SYMBOLS = string.punctuation.replace("'", "")
_RESERVED = "<|"
#: Multiples of it, without their whole part, lie evenly between 0 and 1 however many there are.
_SPREAD = (5**0.5 - 1) / 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of a text as little-endian 32-bit bytes, word by word.

    The tokenizer drops white space and never joins over it, so the ids of a text are those of its
    pieces between blanks, tabs and line ends, and each different piece is encoded once. Unseen pieces
    are encoded many at a time, with a mark between them whose id nothing else has. What the tokenizer
    does before its merges is left out where it can be seen to do nothing: printable Latin-1 text needs
    only lower case, letters with ASCII symbols behind them need only the cut between the two, and
    ASCII needs no byte alphabet. Texts with the start of a special token are encoded in one go.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        blank = pre_tokenizers.WhitespaceSplit()
        self.whole = Tokenizer.from_file(path)
        # One model, the largest part by far, for all four.
        self.latin, self.words, self.ascii = (Tokenizer(self.whole.model) for _ in range(3))
        self.latin.pre_tokenizer = self.whole.pre_tokenizer
        for tokenizer in (self.latin, self.words, self.ascii):
            tokenizer.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence([blank, byte_level])
        self.ascii.pre_tokenizer = blank
        ((byte_mark, _),) = byte_level.pre_tokenize_str(_MARK)
        self.marks = {id(t): _MARK for t in (self.whole, self.latin, self.words)} | {id(self.ascii): byte_mark}
        (self.mark,) = self.whole.encode(_MARK, add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}

    def at_once(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, tokenizer, pieces: dict[str, str]) -> None:
        """pieces: each piece and the form in which ``tokenizer`` gets it."""
        keys, between = list(pieces), f" {self.marks[id(tokenizer)]} "
        for at in range(0, len(keys), _BATCH_PIECES):
            some = keys[at : at + _BATCH_PIECES]
            found = tokenizer.encode_batch_fast([between.join(map(pieces.__getitem__, some))], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            marks = 4 * np.flatnonzero(ids == self.mark)
            raw, ends, starts = ids.tobytes(), [*marks.tolist(), 4 * len(ids)], [0, *(marks + 4).tolist()]
            self.known.update(zip(some, map(raw.__getitem__, map(slice, starts, ends)), strict=True))

    def learn(self, pieces: set[str]) -> None:
        ascii, words, latin, other = {}, {}, {}, {}
        for piece in pieces:
            if piece.isprintable() and (piece.isascii() or max(piece) < "\u0100"):
                low = piece.lower()
                letters = low.rstrip(_SYMBOLS)
                if not letters.isalpha():
                    latin[piece] = low
                elif low.isascii():
                    ascii[piece] = low if len(letters) == len(low) else f"{letters} {low[len(letters):]}"
                else:
                    words[piece] = low if len(letters) == len(low) else f"{letters} {low[len(letters):]}"
            elif _MARK in piece:
                self.known[piece] = self.at_once(piece)
            else:
                other[piece] = piece
        for tokenizer, some in ((self.ascii, ascii), (self.words, words), (self.latin, latin), (self.whole, other)):
            self._learn(tokenizer, some)

    def encode(self, text: str) -> bytes:
        if _RESERVED in text:
            return self.at_once(text)
        pieces = text.replace("\n", " ").replace("\t", " ").split(" ")
        missing = set(pieces).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > KNOWN_PIECES:
                self.known.clear()
                missing = set(pieces)
            self.learn(missing)
        return b"".join(map(self.known.__getitem__, pieces))


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each Python worker, which runs many tasks."""
    return Encoder(path)


def pieces_of(batches: Iterator[pa.RecordBatch], path: str, sequence: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, piece, start, length, ids_crc32) of each piece of each document, and its position if it has one."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    known, end = encoder(path), np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        out, rows = [], []
        for row, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
            ids = known.encode(text.as_py() or "") + end
            for piece, at in enumerate(range(0, len(ids), 4 * sequence)):
                part = ids[at : at + 4 * sequence]
                out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                rows.append(row)
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            + [c.take(pa.array(rows, pa.int64())) for c in batch.columns[2:]],
            ["doc_id", "piece", "start", "length", "ids_crc32", *batch.schema.names[2:]],
        )


def _two(left: np.ndarray, most: int, more_than: int) -> tuple[int, int] | None:
    """The two unpacked lengths of the largest sum over ``more_than`` and up to ``most``."""
    lengths = np.flatnonzero(left)
    lengths = lengths[lengths < most]
    if not len(lengths):
        return None
    at = np.searchsorted(lengths, most - lengths, side="right") - 1
    twice = (at >= 0) & (lengths[at] == lengths) & (left[lengths] < 2)
    at = np.where(twice, at - 1, at)  # the only one of its length can't be taken twice
    sums = np.where(at >= 0, lengths + lengths[at], 0)
    best = int(np.argmax(sums))
    return (int(lengths[best]), int(lengths[at[best]])) if sums[best] > more_than else None


def plan(counts: dict[int, int], sequence: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many bins like this), by best-two-fit over the table of lengths.

    A bin takes the longest piece left, then again and again the longest that fits. Then its smallest
    piece gives way to two unpacked ones, if they fill its place and the gap more tightly, until no two
    do. All bins that can be filled alike are made at once, which uses up at least one length: so there
    are about as many steps as lengths, however many pieces.
    """
    left = np.zeros(sequence + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    bins = []
    while True:
        lengths = np.flatnonzero(left)
        if not len(lengths):
            return bins
        chosen, room, top, trial = [], sequence, sequence, left.copy()
        while True:
            fits = np.flatnonzero(trial[: min(room, top) + 1])
            if not len(fits):
                break
            top = int(fits[-1])
            taken = min(int(trial[top]), room // top)
            chosen += [top] * taken
            trial[top] -= taken
            room -= taken * top
            top -= 1
        while room and len(chosen) > 1:
            least = chosen[-1]
            pair = _two(trial, room + least, least)
            if pair is None:
                break
            trial[least] += 1
            trial[pair[0]] -= 1
            trial[pair[1]] -= 1
            chosen = sorted([*chosen[:-1], *pair], reverse=True)
            room += least - sum(pair)
        used = left - trial
        some = used > 0
        times = int((left[some] // used[some]).min())
        left = left - used * times
        bins.append((chosen, times))


def places(bins: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (length, first, end, sequence, offset): the piece of rank first + i goes to sequence + i."""
    rows, ranks, sequence = [], {}, 0
    for lengths, times in bins:
        offset = 0
        for length in lengths:
            first = ranks.get(length, 0)
            rows.append((length, first, first + times, sequence, offset))
            ranks[length], offset = first + times, offset + length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def put(batches: Iterator[pa.RecordBatch], where: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Add sequence_id and offset; the table ``where`` has some ten rows for each of the lengths at most."""
    key = (where[:, 0] << 48) + where[:, 1]
    for batch in batches:
        length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
        at = np.searchsorted(key, (length << 48) + rank, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(5)] + [pa.array(where[at, 3] + rank - where[at, 1]), pa.array(where[at, 4])],
            [*batch.schema.names[:5], "sequence_id", "offset"],
        )


def _expanded(batches: Iterator[pa.RecordBatch], uses: np.ndarray, shifts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The places of some numbers: (length, offset, bin, at) of the use that the number falls into."""
    for batch in batches:
        number = batch.column(0).to_numpy()
        use = np.searchsorted(uses[:, 4], number, side="right") - 1
        turn = number - uses[use, 4]
        columns = [uses[use, 0], uses[use, 1], uses[use, 2] + turn, (turn + shifts[use]) / uses[use, 3]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["length", "offset", "bin", "at"])


def in_order(pieces: DataFrame, bins: list[tuple[list[int], int]], staging: Staging) -> DataFrame:
    """Add sequence_id and offset to pieces with a position, so that sequences follow the positions.

    The bins are those of ``plan``. Alike bins are spread evenly over the stream, and each length's pieces go
    to its places in the order of their positions, so a sequence holds pieces that stand at about the same
    part of the stream. Sequences are numbered by the mean position of their ids.
    """
    rows, shifts, first, number = [], [], 0, 0
    for kind, (lengths, times) in enumerate(bins):
        offset = 0
        for length in lengths:
            rows.append((length, offset, first, times, number))
            shifts.append((kind + 1) * _SPREAD % 1)
            offset, number = offset + length, number + times
        first += times
    uses, shifts = np.array(rows, np.int64).reshape(-1, 5), np.array(shifts)
    numbers = pieces.sparkSession.range(0, number, 1, spread(pieces))
    places = numbers.mapInArrow(lambda batches: _expanded(batches, uses, shifts), "length long, offset long, bin long, at double")
    places = ranked(staging.table(places, "places"), ["length"], F.struct("at", "bin", "offset"), "rank", F.col("at")).drop("at")
    end = (pieces.agg(F.max("position")).first()[0] or 0) + 1
    order = F.struct("position", "doc_id", "piece", "ids_crc32")
    put = ranked(pieces, ["length"], order, "rank", F.col("position") / end).join(places, ["length", "rank"])
    put = staging.table(put.drop("rank"), "put")
    mean = (F.sum(F.col("position") * F.col("length")) / F.sum("length")).alias("mean")
    means = staging.table(put.groupBy("bin").agg(mean), "means")
    numbers = ranked(means, [], F.struct("mean", "bin"), "sequence_id", F.col("mean") / end)
    return put.join(numbers.select("bin", "sequence_id"), "bin")


def pack(
    documents: DataFrame,
    staging: Staging,
    sequence: int = SEQUENCE,
    path: str | None = None,
    positions: Callable[[DataFrame], DataFrame] | None = None,
    positions_read: Sequence[str] = (),
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and an end id; only longer ones are cut, into pieces of ``sequence`` ids. The
    driver plans with the count of each length, at most ``sequence`` numbers, and sends the plan back;
    pieces find their place by their rank among pieces of their length, so the packing is one over all
    pieces and no task or driver holds them together.

    ``positions`` gives an order that the sequences then follow, with the same bins; without it they follow
    the plan and a hash. It gets one narrow row for each document, of ``row``, ``doc_id``, ``mark`` (a hash of
    the text) and the columns ``positions_read``, and adds ``position``, a whole number from 0. Texts are
    read once, by the tokenizer, and shuffled nowhere.

    Null and empty texts are one end id. Repeated rows are packed each. Very long texts are tokenized whole.
    No documents give no pieces. Other columns are not read.
    """
    path = path or tokenizer_path()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    rows, made = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), schema
    if positions:
        read = [F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("mark"), *positions_read]
        rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *read)
        made = ", ".join([schema, "row long, mark long", *(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in positions_read)])
    pieces = staging.table(rows.mapInArrow(lambda batches: pieces_of(batches, path, sequence), made), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    bins = plan(counts, sequence)
    if positions:
        narrow = pieces.where("piece = 0").select("row", "doc_id", "mark", *positions_read)
        placed = staging.table(positions(narrow).select("row", "position"), "positions")
        placed = staging.table(pieces.drop("mark", *positions_read).join(placed, "row").drop("row"), "placed")
        placed = in_order(placed, bins, staging)
        return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    where = places(bins)
    return (
        ranked(pieces, ["length"], F.struct("doc_id", "piece", "ids_crc32"), "rank")
        .select(*pieces.columns, "rank")
        .mapInArrow(lambda batches: put(batches, where), f"{schema}, sequence_id long, offset long")
    )
