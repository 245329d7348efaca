"""How far the sources of each language differ in their terms, on run-length encoded count columns."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.ranks import spread
from tallybook.llm.staging import Staging

LEAST_DOCUMENTS = 10
#: A probability is a whole number of 1 / SCALE.
SCALE = 1_000_000_000
TOP_TERMS = 10
#: Terms of one block, a power of two: what one task holds of the columns of a language.
BLOCK = 1 << 14
#: Groups whose pairs one task looks at; a language of more sources is cut into tiles of them.
TILE = 512
#: Terms whose counts a Python worker holds before it hands them on.
_ENTRIES = 500_000
_DOCUMENTS_AT_ONCE = 500
_FOLD = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of letters, where every character beyond ASCII is one; only A-Z are lower-cased."""
    return text.encode().translate(_FOLD).split()


def _counted(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, count, docs), added up as far as one worker's memory allows."""
    counts: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def held() -> Iterator[pa.RecordBatch]:
        for group, found in counts.items():
            n = len(found)
            names = [pa.array([x]).take(pa.array(np.zeros(n, np.int32))) for x in group]
            words = pa.array(found.keys(), pa.binary()).cast(pa.string())
            numbers = [pa.array(found.values(), pa.int64()), pa.array(map(docs[group].__getitem__, found), pa.int64())]
            yield pa.RecordBatch.from_arrays([*names, words, *numbers], ["lang", "source", "term", "count", "docs"])
        counts.clear()
        docs.clear()

    for batch in batches:
        for low in range(0, batch.num_rows, _DOCUMENTS_AT_ONCE):
            part = batch.slice(low, _DOCUMENTS_AT_ONCE)
            for lang, source, text in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                found = terms(text)
                if found:
                    counts[lang, source].update(found)
                    docs[lang, source].update(set(found))
            if sum(map(len, counts.values())) > entries:
                yield from held()
    yield from held()


def probabilities(counts: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * vocabulary)), exact for any count."""
    return np.array([1 + SCALE * (c + 2) // (total + 2 * vocabulary) for c in counts.tolist()], np.int64)


class Runs:
    """One column of a block as runs of equal counts: where each starts, its count and its probability."""

    def __init__(self, column: np.ndarray, total: int, vocabulary: int):
        self.start = np.flatnonzero(np.append(True, column[1:] != column[:-1]))[: len(column)]
        self.count = column[self.start]
        self.p = probabilities(self.count, total, vocabulary)

    def at(self, cuts: np.ndarray) -> np.ndarray:
        """The run at each of some places."""
        return np.searchsorted(self.start, cuts, side="right") - 1


def meet(one: Runs, two: Runs, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(runs of one, runs of two, f, lengths) of the runs in which both columns stay the same."""
    cuts = np.union1d(one.start, two.start)
    mine, theirs = one.at(cuts), two.at(cuts)
    p, q = one.p[mine], two.p[theirs]
    return mine, theirs, (p - q) * (p - q) // (p + q), np.diff(np.append(cuts, rows))


def _most(group: Runs, whole: Runs, words: pa.Array, most: int) -> tuple[list[str], list[int]]:
    """The terms that are more frequent in a group than in its language, by f and then by their bytes."""
    mine, theirs, f, lengths = meet(group, whole, len(words))
    above = (group.count[mine] > 0) & (group.p[mine] > whole.p[theirs])
    value = np.repeat(np.where(above, f, -1), lengths)
    found = np.flatnonzero(value >= 0)
    if len(found) > most:
        least = np.partition(value[found], len(found) - most)[len(found) - most]
        found = found[value[found] >= least]
    names = words.take(pa.array(found)).to_pylist()
    best = sorted(zip((-value[found]).tolist(), (n.encode() for n in names), strict=True))[:most]
    return [n.decode() for _, n in best], [-v for v, _ in best]


def _compare(key: tuple, groups: pa.Table, block: pa.Table, most: int, tile_size: int) -> pa.Table:
    """Parts of the values of all pairs of one tile of groups with later groups, over the terms of a block."""
    lang, tile = key[0].as_py(), key[2].as_py()
    groups = groups.sort_by("index")
    names, totals = groups.column("source").to_pylist(), groups.column("total").to_pylist()
    vocabulary, whole_total = groups.column("vocabulary")[0].as_py(), groups.column("lang_total")[0].as_py()
    block = block.sort_by("at").combine_chunks()
    rows = block.num_rows
    tiled = range(tile * tile_size, min((tile + 1) * tile_size, len(names)))
    out: list[tuple] = []
    if rows:
        entries = block.column("entries").combine_chunks()
        flat = entries.flatten()
        row = np.repeat(np.arange(rows), entries.value_lengths().to_numpy())
        index, count = (flat.field(i).to_numpy() for i in (0, 1))
        order = np.argsort(index, kind="stable")
        bounds = np.searchsorted(index[order], np.arange(len(names) + 1))
        columns = []
        for g, total in enumerate(totals):
            mine, dense = order[bounds[g] : bounds[g + 1]], np.zeros(rows, np.int64)
            dense[row[mine]] = count[mine]
            columns.append(Runs(dense, total, vocabulary))
        dense = np.zeros(rows, np.int64)
        np.add.at(dense, row, count)
        whole, words = Runs(dense, whole_total, vocabulary), block.column("term").combine_chunks()
        for a in tiled:
            for b in range(a + 1, len(names)):
                _, _, f, lengths = meet(columns[a], columns[b], rows)
                out.append((names[a], "pair", names[b], int((f * lengths).sum())))
            out += [(names[a], "term", word, value) for word, value in zip(*_most(columns[a], whole, words, most), strict=True)]
    else:  # a language without a kept term
        out = [(names[a], "pair", names[b], 0) for a in tiled for b in range(a + 1, len(names))]
    columns = list(zip(*out, strict=True)) or [[]] * 4
    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(),) * 3 + (pa.int64(),), strict=True)]
    return pa.table([pa.array([lang] * len(out), pa.string()), *arrays], ["lang", "source", "part", "item", "value"])


def _or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def audit(documents: DataFrame, staging: Staging, least: int = LEAST_DOCUMENTS, most: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language.

    A language keeps the terms of at least ``least`` of its documents. Part ``pair`` has each other source of
    the language with the divergence of both over all kept terms; part ``term`` the ``most`` terms by which a
    source stands out most against its language. All numbers are whole and exact.

    1. Tasks add up the counts of (lang, source, term); they are added up once more over all tasks.
    2. The vocabulary of a language is ordered by the counts of its sources, smallest source first, so equal
       counts stand together, and is cut into blocks of ``BLOCK`` terms.
    3. A task takes a block, encodes the count column of each source as runs, and intersects the runs of each
       pair: in each the value of a term is the same, so it is computed once and multiplied by the length.
       Parts of the blocks are added up.

    So a hot source or language is split into many blocks, and a term's row has no more entries than its
    language has sources. Null text, lang and source are empty texts. Repeated rows count each. Ties go to
    the smaller item in UTF-8. Sources without terms take part with counts of zero. An empty table gives
    no rows. Other columns are not read.
    """
    texts = documents.select(*map(_or_empty, ("lang", "source", "text")))
    entries, tile_size = _ENTRIES, TILE
    made = texts.mapInArrow(lambda batches: _counted(batches, entries), "lang string, source string, term string, count long, docs long")
    added = made.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    counts = staging.table(added, "counts")
    kept = staging.table(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang", "term"), "kept")
    used = staging.table(counts.join(kept, ["lang", "term"], "left_semi").select("lang", "source", "term", "count"), "used")
    totals = used.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    zero, inside = F.lit(0).cast("long"), Window.partitionBy("lang")
    groups = (
        texts.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(vocabulary, "lang", "left")
        .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("vocabulary", zero).alias("vocabulary"))
        .withColumn("index", F.row_number().over(inside.orderBy("total", "source")) - 1)
        .withColumn("lang_total", F.sum("total").over(inside))
        .withColumn("groups", F.count(F.lit(1)).over(inside))
    )
    groups = staging.table(groups, "groups")
    entry = F.struct("index", "count")
    vectors = used.join(groups.select("lang", "source", "index"), ["lang", "source"]).groupBy("lang", "term")
    vectors = staging.table(vectors.agg(F.array_sort(F.collect_list(entry)).alias("entries")), "vectors")
    order = ("lang", "entries", "term")
    sorted_terms = vectors.repartitionByRange(spread(documents), *order).sortWithinPartitions(*order)
    blocks = staging.table(sorted_terms.select(*order, F.monotonically_increasing_id().alias("at")), "blocks")
    blocks = blocks.withColumn("block", F.col("at").bitwiseAND(F.lit(-BLOCK)))
    last_tile = F.floor((F.col("groups") - 1) / tile_size).cast("int")
    tiles = groups.where("index = 0").select("lang", F.explode(F.sequence(F.lit(0), last_tile)).alias("tile"))
    places = tiles.join(blocks.select("lang", "block").distinct(), "lang", "left").withColumn("block", F.coalesce("block", F.lit(-1).cast("long")))
    places = staging.table(places.select("lang", "block", "tile"), "places")
    key = ["lang", "block", "tile"]
    heads, bodies = groups.join(places, "lang"), blocks.join(places, ["lang", "block"])
    found = (
        heads.select(*key, "index", "source", "total", "vocabulary", "lang_total")
        .groupBy(*key)
        .cogroup(bodies.select(*[F.col(c).alias(c) for c in key], "at", "term", "entries").groupBy(*key))
        .applyInArrow(lambda key, head, block: _compare(key, head, block, most, tile_size), "lang string, source string, part string, item string, value long")
    )
    found = staging.table(found, "found")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    sides = [F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("source", "item"), ("item", "source"))]
    both = pairs.select("lang", "part", "value", F.inline(F.array(*sides))).select(*found.columns)
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    place = F.row_number().over(by_value).alias("rank")
    return both.select("*", place).unionByName(found.where("part = 'term'").select("*", place).where(F.col("rank") <= most))
