"""Personal data in texts: fixed patterns, and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.staging import Staging
from tallybook.llm.wordhash import Words, chunks, range_hash

KINDS = ("email", "ip", "card", "phone")
#: Labels: outside, then for each kind its first word and its further words.
LABELS = 1 + 2 * len(KINDS)
FEATURES = 1 << 14
#: A sequence is a line, cut after so many words.
SEQUENCE = 64
#: Bound of the labelled table: sequences with personal data, and as many with digits or @ but none.
LABELLED_ROWS = 1500
EPOCHS, RATE, DECAY = 40, 0.1, 1e-4
_TRIM = b"\"'()[]{}<>.,;:!?|&$#%*"

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]*@[A-Za-z0-9._%+@-]*")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")
_NO_DIGIT = re.compile("[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted; spans of a kind don't overlap."""
    found = []
    if "@" in text:
        for run in _ADDRESS.finditer(text):  # a match lies in one run of its characters around an @
            low = run.start()
            found += [(low + m.start(), 0, low + m.end()) for m in _EMAIL.finditer(run[0])]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := _NO_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


#: Letters are a or A, digits 9, white space a blank, other ASCII itself, bytes of other characters a.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("0") : ord("9") + 1] = ord("9")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[128:] = ord("a")
_TELLING = np.zeros(256, bool)
_TELLING[[*range(ord("0"), ord("9") + 1), ord("@")]] = True


def _checks(word: bytes) -> int:
    """What a word with digits or @ passes: its digits, and the tests of an address, an IP or a card number."""
    text = word.strip(_TRIM).decode("latin-1")
    digits = _NO_DIGIT.sub("", text)
    parts = text.split(".")
    ip = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    return min(len(digits), 24) * 8 + 4 * bool(_EMAIL.fullmatch(text)) + 2 * ip + (14 <= len(digits) <= 19 and luhn(digits))


@dataclass
class Sequences:
    """The words of a chunk as padded rows: ``word`` is the number of each, -1 behind the end."""

    word: np.ndarray
    features: np.ndarray


def sequences(words: Words, telling_only: bool = False) -> Sequences:
    """Features of each word: its shape with runs folded, the shapes beside it, and what it passes."""
    n = len(words.start)
    if not n:
        return Sequences(np.zeros((0, 1), np.int64), np.zeros((0, 4), np.int64))
    shape = _SHAPE[words.data]
    first = np.append(True, shape[1:] != shape[:-1])
    first[words.start] = True
    place = np.append(0, np.cumsum(first))
    folded = range_hash(shape[first], place[words.start], place[words.end])
    telling = np.append(0, np.cumsum(_TELLING[words.data]))
    special = np.flatnonzero(telling[words.end] > telling[words.start])
    passed = np.full(n, 255, np.int64)
    passed[special] = [_checks(words.data[a:b].tobytes()) for a, b in zip(words.start[special], words.end[special], strict=True)]
    lines = np.append(0, np.cumsum(words.data == 10))[words.start]
    new = np.append(True, (lines[1:] != lines[:-1]) | (words.document()[1:] != words.document()[:-1]))
    at = np.arange(n)
    in_line = at - np.maximum.accumulate(np.where(new, at, 0))
    new = in_line % SEQUENCE == 0
    row, column = np.cumsum(new) - 1, in_line % SEQUENCE
    bucket = lambda x, salt: ((x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(FEATURES - 1)).astype(np.int64) + 1
    before, after = bucket(folded, 2), bucket(folded, 3)
    before = np.where(new, 0, np.append(0, before[:-1]))
    after = np.where(np.append(new[1:], True), 0, np.append(after[1:], 0))
    features = np.stack([bucket(folded, 1), before, after, passed], axis=1)
    if telling_only:
        wanted = np.unique(row[special])
        keep = np.isin(row, wanted)
        row, column, at = np.searchsorted(wanted, row[keep]), column[keep], at[keep]
    word = np.full((int(row.max()) + 1 if len(row) else 0, SEQUENCE), -1)
    word[row, column] = at
    return Sequences(word[:, : int(column.max()) + 1 if len(column) else 1], features)


@dataclass(frozen=True)
class Model:
    """Weights of (feature slot, feature, label), of label pairs, and of the first label."""

    emission: np.ndarray
    transition: np.ndarray
    first: np.ndarray

    def potentials(self, features: np.ndarray) -> np.ndarray:
        total = self.emission[0][features[:, 0]]
        for slot in range(1, features.shape[1]):
            total = total + self.emission[slot][features[:, slot]]
        return total

    def decode(self, words: Words) -> np.ndarray:
        """The label of each word, by Viterbi over all sequences at once."""
        rows = sequences(words)
        potential = np.append(self.potentials(rows.features), np.zeros((1, LABELS)), axis=0)
        labels = np.zeros(len(words.start) + 1, np.int64)
        order = np.argsort(-(rows.word >= 0).sum(axis=1), kind="stable")
        word = rows.word[order]
        lengths = (word >= 0).sum(axis=1)
        best = self.first + potential[word[:, 0]] if len(word) else np.zeros((0, LABELS))
        back = []
        for step in range(1, word.shape[1]):
            live = int(np.searchsorted(-lengths, -step))
            scores = best[:live, :, None] + self.transition
            choice = scores.argmax(axis=1)
            back.append(choice)
            best[:live] = np.take_along_axis(scores, choice[:, None, :], axis=1)[:, 0] + potential[word[:live, step]]
        label = best.argmax(axis=1)
        for step in range(word.shape[1] - 1, -1, -1):
            live = int(np.searchsorted(-lengths, -step))
            labels[word[:live, step]] = label[:live]
            if step:
                choice = back[step - 1]
                label[: len(choice)] = choice[np.arange(len(choice)), label[: len(choice)]]
        return labels[:-1]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def learn(word: np.ndarray, features: np.ndarray, labels: np.ndarray) -> Model:
    """Maximise the likelihood of the labelled sequences, by forward-backward and Adam over all of them."""
    weights = [np.zeros((features.shape[1], FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    live = word >= 0
    rows, steps = word.shape
    seen = [np.unique(features[:, slot], return_inverse=True) for slot in range(features.shape[1])]
    for turn in range(1, EPOCHS + 1):
        model = Model(*weights)
        potential = model.potentials(features)[np.where(live, word, 0)]
        forward, backward = np.zeros((rows, steps, LABELS)), np.zeros((rows, steps, LABELS))
        forward[:, 0] = model.first + potential[:, 0]
        for t in range(1, steps):
            new = _lse(forward[:, t - 1, :, None] + model.transition, 1) + potential[:, t]
            forward[:, t] = np.where(live[:, t, None], new, forward[:, t - 1])
        total = _lse(forward[:, -1], 1)
        for t in range(steps - 2, -1, -1):
            new = _lse(model.transition + (potential[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(live[:, t + 1, None], new, backward[:, t + 1])
        chance = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        pair_gradient = np.zeros((LABELS, LABELS))
        for t in range(1, steps):
            pair = forward[:, t - 1, :, None] + model.transition + (potential[:, t] + backward[:, t])[:, None, :]
            pair_gradient += (np.exp(pair - total[:, None, None]) * live[:, t, None, None]).sum(axis=0)
            both = live[:, t]
            np.add.at(pair_gradient, (labels[word[both, t - 1]], labels[word[both, t]]), -1)
        per_word = np.zeros((len(features), LABELS))
        per_word[word[live]] = chance[live]
        per_word[np.arange(len(features)), labels] -= 1
        emission_gradient = np.zeros_like(weights[0])
        for slot, (values, inverse) in enumerate(seen):
            sums = np.zeros((len(values), LABELS))
            np.add.at(sums, inverse, per_word)
            emission_gradient[slot][values] = sums
        first_gradient = chance[:, 0].sum(axis=0) - np.bincount(labels[word[:, 0]], minlength=LABELS)
        for k, gradient in enumerate((emission_gradient, pair_gradient, first_gradient)):
            gradient = gradient / rows + DECAY * weights[k]
            one, two = moments[k]
            one += 0.1 * (gradient - one)
            two += 0.001 * (gradient**2 - two)
            weights[k] = weights[k] - RATE * (one / (1 - 0.9**turn)) / (np.sqrt(two / (1 - 0.999**turn)) + 1e-8)
    return Model(*weights)


def word_labels(text: bytes, words: Words) -> np.ndarray:
    """Labels of one text's words from its base spans: each word that holds part of a span."""
    labels = np.zeros(len(words.start), np.int64)
    for start, kind, end in base_spans(text.decode()):
        low, high = (len(text.decode()[:x].encode()) for x in (start, end))
        a, b = np.searchsorted(words.end, low, side="right"), np.searchsorted(words.start, high)
        if (labels[a:b] == 0).all():
            labels[a] = 1 + 2 * kind
            labels[a + 1 : b] = 2 + 2 * kind
    return labels


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sequences with digits or @ of each text: words, labels, whether any label is set."""
    for batch in batches:
        for _, words in chunks(batch.column(0), 1):
            rows = sequences(words, telling_only=True)
            if not len(rows.word):
                continue
            labels = word_labels(words.text(0), words)
            texts, marks = [], []
            for row in rows.word:
                row = row[row >= 0]
                texts.append(b" ".join(words.data[words.start[i] : words.end[i]].tobytes() for i in row).decode())
                marks.append(labels[row].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts), pa.array(marks, pa.list_(pa.int32())), pa.array([any(m) for m in marks])], ["line", "labels", "some"]
            )


def labelled_table(documents: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """A small table of sequences (line, labels), half with personal data, by a hash of the line.

    Labels come from the base patterns on whole texts.
    """
    found = documents.where(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(_label, "line string, labels array<int>, some boolean")
    order = F.xxhash64("line")
    halves = [found.where(F.col("some") == some).dropDuplicates(["line"]).orderBy(order, "line").limit(rows) for some in (True, False)]
    return halves[0].unionAll(halves[1])


def fit(documents: DataFrame, staging: Staging, rows: int = LABELLED_ROWS) -> Model | None:
    """The field learned from the labelled table, which is small enough for the driver; None without one."""
    table = staging.table(labelled_table(documents, rows), "labelled").collect()
    if not any(r["some"] for r in table):
        return None
    lines = pa.array([r["line"] for r in table])
    padded, features, labels, base = [], [], [], 0
    for part, words in chunks(lines):
        found = sequences(words)
        padded.append(np.where(found.word >= 0, found.word + base, -1))
        features.append(found.features)
        labels += [x for r in table[part] for x in r["labels"]]
        base += len(found.features)
    width = max(p.shape[1] for p in padded)
    word = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1])), constant_values=-1) for p in padded])
    return learn(word, np.concatenate(features), np.array(labels))


def _decoded(words: Words, labels: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points of the spans that the labels of document k give."""
    low, high = int(words.first[k]), int(words.first[k + 1])
    mine = labels[low:high]
    out, at = [], 0
    offset, data = int(words.offsets[k]), words.data
    marked = np.flatnonzero(mine)
    while at < len(marked):
        i = int(marked[at])
        kind, j = (int(mine[i]) - 1) // 2, i + 1
        while j < len(mine) and mine[j] == 2 + 2 * kind:
            j += 1
        at = int(np.searchsorted(marked, j))
        start, end = int(words.start[low + i]), int(words.end[low + j - 1])
        inner = data[start:end].tobytes()
        start += len(inner) - len(inner.lstrip(_TRIM))
        end -= len(inner) - len(inner.rstrip(_TRIM))
        if start < end:
            before = int(((data[offset:start] & 0xC0) != 0x80).sum())
            out.append((before, kind, before + int(((data[start:end] & 0xC0) != 0x80).sum())))
    return out


def _plausible(kind: int, text: str) -> bool:
    """Added spans must hold what no such datum lacks."""
    digits = len(_DIGITS.findall(text))
    return "@" in text if kind == 0 else digits >= (4, 4, 13, 7)[kind]


def spans_of(text: str, decoded: list[tuple[int, int, int]]) -> tuple[list, list]:
    """Base spans, and those that the field adds: they overlap no base span."""
    base = base_spans(text)
    added, reach = [], 0
    for span in decoded:
        free = all(span[2] <= s or span[0] >= e for s, _, e in base)
        if free and span[0] >= reach and _plausible(span[1], text[span[0] : span[2]]):
            added.append(span)
            reach = span[2]
    return base, added


_SPAN = T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "kind", "end")])
_ARROW = pa.list_(pa.struct([(c, pa.int32()) for c in ("start", "kind", "end")]))


def scanned(documents: DataFrame, model: Model | None, names: tuple[str, str] = ("base_spans", "added_spans")) -> DataFrame:
    """All rows and columns of ``documents``, and two arrays of (start, kind, end) in code points.

    Names get underscores until they are new. Null texts are empty; repeated rows get equal results.
    """
    taken, fresh = {c.lower() for c in documents.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        fresh.append(name)
        taken.add(name.lower())
    at = documents.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added = [], []
            for _, words in chunks(batch.column(at)):
                labels = model.decode(words) if model else np.zeros(len(words.start), np.int64)
                any_label = np.append(0, np.cumsum(labels > 0))
                marked = any_label[words.first[1:]] > any_label[words.first[:-1]]
                for k in range(words.documents):
                    found = spans_of(words.text(k).decode(), _decoded(words, labels, k) if marked[k] else [])
                    for spans, out in zip(found, (base, added), strict=True):
                        out.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans])
            lists = [pa.array(x, _ARROW) for x in (base, added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, *fresh])

    fields = [*documents.schema.fields, *(T.StructField(n, T.ArrayType(_SPAN)) for n in fresh)]
    return documents.mapInArrow(add, T.StructType(fields))


def written(spans: Column) -> Column:
    """kind:start:end of each span, by start and then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(F.array_sort(spans), one))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    state = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(a["done"].alias("done"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(
            F.struct(
                F.concat(a["done"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"])).alias("done"),
                s["end"].alias("at"),
            )
        ),
    )
    rest = F.substring(text, state["at"] + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(state["done"], rest))
