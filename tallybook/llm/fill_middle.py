"""Fill-in-the-middle rearrangement of texts; the cuts come out of a compressed set of unit boundaries."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of 100 texts, how many are rearranged, and how many of those have their suffix first.
REARRANGED, SUFFIX_FIRST = 50, 80
#: Numbers of one container differ in their lower 16 bits only.
_LOW_BITS = 16
_SPAN = 1 << _LOW_BITS
_SPACE = np.zeros(_SPAN, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class ArrayContainer:
    """Sorted 16-bit numbers, for few members."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit for each possible number, for many members; ``before`` counts the members ahead of each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_SPAN, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words).astype(np.int64)))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.flatnonzero(np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little"))
        return 64 * word + int(bits[k - self.before[word]])


class RunContainer:
    """First numbers of runs of neighbours; ``before`` counts the members ahead of each run."""

    def __init__(self, low: np.ndarray):
        new = np.flatnonzero(np.append(True, low[1:] != low[:-1] + 1))
        self.first, self.before = low[new], np.append(new, len(low))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run] + k - self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The container that takes the fewest bytes: two for a member, four for a run, 8 KiB for a bitmap."""
    runs = 1 + int(np.count_nonzero(low[1:] != low[:-1] + 1))
    sizes = {RunContainer: 4 * runs, ArrayContainer: 2 * len(low), BitmapContainer: _SPAN // 8}
    return min(sizes, key=sizes.__getitem__)(low)


class Boundaries:
    """A set of ascending whole numbers in containers by their upper bits, with cumulated cardinalities."""

    def __init__(self, parts: Iterator[np.ndarray]):
        """``parts``: the members, ascending, in arrays whose upper bits are all equal and grow."""
        self.keys, self.containers, sizes = [], [], [0]
        for members in parts:
            if len(members):
                key = int(members[0]) >> _LOW_BITS
                self.keys.append(key)
                self.containers.append(container(members - (key << _LOW_BITS)))
                sizes.append(sizes[-1] + len(members))
        self.before = np.array(sizes)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The member with ``k`` smaller ones: the container is searched for, the rest is its own select."""
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return (self.keys[at] << _LOW_BITS) + self.containers[at].select(k - int(self.before[at]))


def word_ends(text: str) -> Iterator[np.ndarray]:
    """Where units end, in code points: behind each word, and at the end of blanks that no word follows."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    for low in range(0, len(points) + 1 if text else 0, _SPAN):
        # An end of number i lies behind character i - 1, so this container looks one character back.
        here = points[max(low - 1, 0) : low + _SPAN]
        space = _SPACE[np.minimum(here, _SPAN - 1)]
        last = low + _SPAN > len(points)
        follows = np.append(space[1:], True) if last else space[1:]
        ends = ~space[: len(follows)] & follows
        if last:
            ends[-1] = True
        yield np.flatnonzero(ends) + max(low - 1, 0) + 1


def character_ends(text: str) -> Iterator[np.ndarray]:
    """Every code point is a unit."""
    for low in range(0, len(text) + 1, _SPAN):
        yield np.arange(max(low, 1), min(low + _SPAN, len(text) + 1))


UNITS = {"words": word_ends, "characters": character_ends}


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits that depend on seed and id alone; a null id is an empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def rearrange(text: str, doc_id: int | None, unit: str, seed: int, share: int, suffix_first: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = Boundaries(UNITS[unit](text))
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= share:
        return n, "plain", None, None, text
    first, second = (ends.select(k - 1) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < suffix_first:
        form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return n, form, len(prefix), len(middle), "".join(parts)


_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
_NAMES = ("n", "form", "prefix_chars", "middle_chars", "output")
_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _rearranged(batches: Iterator[pa.RecordBatch], **how) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        rows = [rearrange(text.as_py() or "", doc_id, **how) for doc_id, text in zip(ids, texts, strict=True)]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        arrays = [pa.array(c, kind) for c, kind in zip(columns, _KINDS, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *_NAMES])


def fill_middle(
    documents: DataFrame, unit: str = "words", seed: int = SEED, share: int = REARRANGED, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars, output (the new text).

    ``unit`` is ``words`` (a word with the blanks before it; blanks at the end are a unit of their own) or
    ``characters``. ``share`` of 100 texts are cut at two of their unit boundaries and written with marks as
    prefix, suffix, middle (psm) or, ``suffix_first`` of 100 of them, as suffix, prefix, middle (spm); cuts and
    form depend on ``seed`` and doc_id alone, so repeated rows get the same result. A cut is found by a select
    on the set of boundaries, so no list of units is made.

    Empty and null texts, and texts that hold one of the marks, stay plain, with null lengths. A null id draws
    like an empty one. Very long texts are taken whole, one at a time. An empty table gives no rows. Other
    columns are not read.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(partial(_rearranged, unit=unit, seed=seed, share=share, suffix_first=suffix_first), _SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_middle`` was given, from what it made of it.

    The first mark opens the output, and as the text holds none, the other two are found exactly.
    """
    body = F.substr(output, F.lit(len(PREFIX) + 1))

    def part(first: str, i: int) -> Column:
        return F.get(F.split(body, f"{re.escape(first)}|{re.escape(MIDDLE)}", 3), F.lit(i))

    psm = F.concat(part(SUFFIX, 0), part(SUFFIX, 2), part(SUFFIX, 1))
    spm = F.concat(part(PREFIX, 1), part(PREFIX, 2), part(PREFIX, 0))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
