"""Removal of passages that occur earlier in the corpus, located by Aho-Corasick automata of phrases."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.staging import Staging
from tallybook.llm.wordhash import Words, chunks, mix, range_hash

WINDOW = 20
#: Words of a phrase: each window holds WINDOW - PHRASE + 1, and the one of least hash stands for it.
PHRASE = 8
#: Text whose documents and automaton one task holds at a time.
SHARD_BYTES = 8 << 20
_OTHER_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_NONE, _BYTE = ~np.uint64(0), np.uint64(255)


class Windows:
    """The windows of a chunk, each with the place of the phrase that stands for it.

    Equal windows have equal phrases at equal places, whatever is around them, so a window that recurs
    has a phrase that recurs.
    """

    def __init__(self, words: Words):
        self.words, self.hashes = words, words.hashes()
        self.start = words.runs(WINDOW)
        phrases = words.runs(PHRASE)
        self.key = np.zeros(len(self.hashes), np.uint64)
        for k in range(PHRASE):
            self.key[phrases] |= (self.hashes[phrases + k] & _BYTE) << np.uint64(8 * k)
        order = np.full(len(self.hashes), _NONE)
        order[phrases] = mix(self.key[phrases])
        least, self.at = order[self.start], self.start.copy()
        for offset in range(1, WINDOW - PHRASE + 1):
            other = order[self.start + offset]
            less = other < least
            least = np.where(less, other, least)
            self.at = np.where(less, self.start + offset, self.at)

    def phrases(self) -> np.ndarray:
        """The places of all phrases that stand for some window, ascending."""
        return np.unique(self.at)

    def letters(self) -> str:
        return _letters((self.hashes & _BYTE).astype(np.uint8)).decode("ascii")


def _letters(words: np.ndarray) -> bytes:
    """Two characters for the byte of each word, from alphabets of 16 that don't overlap.

    The automaton looks its branches up one by one, so few letters make it fast, and the two alphabets
    keep matches at the words' bounds.
    """
    out = np.empty(2 * words.size, np.uint8)
    out[0::2] = 48 + (words.ravel() & 15)
    out[1::2] = 96 + (words.ravel() >> 4)
    return out.tobytes()


def phrase_letters(keys: np.ndarray) -> list[str]:
    """What the automaton looks for: the key of a phrase holds the bytes of its words."""
    text = _letters(keys.astype("<u8").view(np.uint8)).decode("ascii")
    return [text[i : i + 2 * PHRASE] for i in range(0, len(text), 2 * PHRASE)]


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, words in chunks(batch.column(1)):
            windows = Windows(words)
            at = windows.phrases()
            shard = batch.column(0)[rows].to_numpy()[np.searchsorted(words.first, at, side="right") - 1]
            yield pa.RecordBatch.from_arrays([pa.array(shard), _signed(windows.key[at])], ["shard", "phrase"])


def _locate(key: tuple, recurring: pa.Table, documents: pa.Table) -> pa.Table:
    """Compile the recurring phrases of a shard and stream its documents through the automaton.

    One row for each place where it finds a phrase that stands for windows: document, first window, the phrase,
    and a hash of each of its windows, which start at consecutive words.
    """
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for letters in phrase_letters(np.unique(recurring.column("phrase").to_numpy().view(np.uint64))):
        automaton.add_word(letters)
    ids, marks = (documents.column(c).to_numpy() for c in ("doc", "mark"))
    parts: list[list[np.ndarray]] = []
    if len(automaton):
        automaton.make_automaton()
        for rows, words in chunks(documents.column("text")):
            windows = Windows(words)
            letters = windows.letters()
            hit = np.zeros(len(windows.hashes), bool)
            for k in range(words.documents):
                low, high = int(words.first[k]), int(words.first[k + 1])
                if high - low >= WINDOW:
                    ends = [end for end, _ in automaton.iter(letters, 2 * low, 2 * high)]
                    hit[(np.array(ends, np.int64) + 1) // 2 - PHRASE] = True
            found = hit[windows.at]
            start, at = windows.start[found], windows.at[found]
            if not len(start):
                continue
            new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            owner = np.searchsorted(words.first, start[new], side="right") - 1
            parts.append(
                [
                    ids[rows][owner],
                    marks[rows][owner],
                    (start[new] - words.first[owner]).astype(np.int32),
                    windows.key[at[new]].view(np.int64),
                    np.diff(np.append(new, len(start))),
                    range_hash(windows.hashes, start, start + WINDOW, _OTHER_BASE).view(np.int64),
                ]
            )
    kinds = (np.int64, np.int32, np.int32, np.int64, np.int64, np.int64)
    doc, mark, first, phrase, size, hashes = (
        np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, kind) for i, kind in enumerate(kinds)
    )
    bounds = np.append(0, np.cumsum(size)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes))
    return pa.table([pa.array(doc), pa.array(mark), pa.array(first), pa.array(phrase), lists], ["doc", "mark", "first", "phrase", "windows"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, text, first, size, kept = (batch.column(i) for i in range(5))
        out = []
        for k in range(len(doc)):
            words = (text[k].as_py() or "").encode().split()
            removed = np.zeros(len(words) + 1, np.int64)
            if first[k].is_valid:
                low, count = (np.asarray(x[k].values).astype(np.int64) for x in (first, size))
                windows = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
                if kept[k].is_valid:
                    windows = np.setdiff1d(windows, np.asarray(kept[k].values))
                np.add.at(removed, windows, 1)
                np.add.at(removed, windows + WINDOW, -1)
            stay = np.cumsum(removed)[:-1] == 0
            out.append((len(words), int(len(words) - stay.sum()), b" ".join(compress(words, stay.tolist())).decode()))
        columns = list(zip(*out, strict=True)) or [[]] * 3
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)]
        yield pa.RecordBatch.from_arrays([doc, *arrays], ["doc_id", "n_words", "n_removed", "kept_text"])


def without_repeats(documents: DataFrame, staging: Staging) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (the words that stay, joined by blanks).

    Every word covered by a window of ``WINDOW`` words that also starts earlier (smaller doc_id, or
    earlier in the same document) is removed; windows are those of the input. Steps:

    1. Phrases that stand for windows are counted over all documents; those found twice recur.
    2. Documents are dealt into shards of bounded text. Each shard gets the recurring phrases that occur in
       it, compiles them to an automaton and streams its documents through it. Only what the automaton
       finds goes on, and every window that recurs holds a hit.
    3. Hits with equal windows are folded to their first place, then single windows are. What isn't a
       first place is removed; phrase and window hash together are 128 bits.

    Null texts have no words. Null ids come before all others. Rows with one id but other texts are
    documents of their own, in the order of a hash of the text; rows equal in both are one document, and
    each gets its result. Very long texts are taken whole. An empty table gives no rows. Columns other than doc_id and text are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    least = -(2**63)
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + size // SHARD_BYTES
    rows = documents.select("doc_id", text.alias("text")).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("doc"), F.hash("text").alias("mark"), "text", "doc_id"
    )
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc", "mark"), F.lit(shards)))
    phrases = staging.table(dealt.select("shard", "text").mapInArrow(_phrases, "shard long, phrase long"), "phrases")
    # Written, so that both sides of the join are read from files or shuffles and a hot phrase can be split.
    twice = staging.table(phrases.groupBy("phrase").count().where("count > 1").select("phrase"), "twice")
    recurring = staging.table(phrases.join(twice, "phrase", "left_semi").select("shard", "phrase"), "recurring")
    staging.drop("phrases")
    staging.drop("twice")
    places = staging.table(
        recurring.groupBy("shard")
        .cogroup(dealt.select("shard", "doc", "mark", "text").groupBy("shard"))
        .applyInArrow(_locate, "doc long, mark int, first int, phrase long, windows array<long>"),
        "places",
    )
    staging.drop("recurring")
    place = F.struct("doc", "mark", "first")
    firsts = staging.table(places.groupBy("phrase", "windows").agg(F.min(place).alias("place")), "firsts")
    single = firsts.select("phrase", "place", F.posexplode("windows").alias("k", "window")).select(
        "phrase", "window", F.struct("place.doc", "place.mark", (F.col("place.first") + F.col("k")).alias("start")).alias("place")
    )
    kept = staging.table(single.groupBy("phrase", "window").agg(F.min("place").alias("place")).select("place.*"), "kept")
    staging.drop("firsts")
    hits = places.groupBy("doc", "mark").agg(
        F.collect_list(F.struct("first", F.size("windows").alias("size"))).alias("hits")
    )
    stays = kept.groupBy("doc", "mark").agg(F.collect_list("start").alias("kept"))
    return (
        rows.join(hits, ["doc", "mark"], "left")
        .join(stays, ["doc", "mark"], "left")
        .select("doc_id", "text", "hits.first", "hits.size", "kept")
        .mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_text string")
    )
