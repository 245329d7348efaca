import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallybook.llm import personal_data as pd_
from tallybook.llm.wordhash import chunks


def brute(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits[::-1]))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_against_the_plain_patterns():
    random.seed(14)
    pieces = ["a.b", "@", "x-y.com", "mail@", "@@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4539 1488 0343 6467", "4539148803436467",
              "+1 (555) 010-9999", "+", "12", " ", "-", ".", "é", "0001.2.3.4", "99999999999999", "\n", "+49 30 1234567"]
    for _ in range(3000):
        text = "".join(random.choices(pieces, k=random.randint(0, 14)))
        assert pd_.base_spans(text) == brute(text), repr(text)


def people(n):
    random.seed(15)
    rows = []
    for i in range(n):
        words = ["".join(random.choices("abcdeé", k=random.randint(1, 8))) for _ in range(random.randint(5, 150))]
        extra = [f"joe.{i}@mail{i % 9}.example.com", f"10.{i % 256}.7.{(i * 7) % 256}", f"+1 ({200 + i % 700}) 555-{1000 + i}", str(random.randint(1, 99))]
        for x in random.sample(extra, random.randint(0, 3)):
            words.insert(random.randrange(len(words)), x)
        rows.append((i, random.choice([" ", "\n"]).join(words)))
    return rows


def test_the_field_learns_the_labels_it_is_shown(documents, staging):
    rows = people(400)
    model = pd_.fit(documents(rows[:300]), staging)
    right = total = 0
    for _, text in rows[300:]:
        ((_, words),) = chunks(pa.array([text]))
        labels, want = model.decode(words), pd_.word_labels(text.encode(), words)
        right += ((labels == want) & (want > 0)).sum()
        total += ((want > 0) | (labels > 0)).sum()
    assert right / total > 0.95


def test_viterbi_finds_the_best_path():
    random = np.random.default_rng(4)
    model = pd_.Model(random.normal(size=(4, pd_.FEATURES, pd_.LABELS)), random.normal(size=(pd_.LABELS, pd_.LABELS)), random.normal(size=pd_.LABELS))
    ((_, words),) = chunks(pa.array(["a 1 b\nc", "", "d@e f 22 g h"]))
    potential, labels = model.potentials(pd_.sequences(words).features), model.decode(words)
    for low, high in ((0, 3), (3, 4), (4, 9)):
        paths = np.stack(np.meshgrid(*[np.arange(pd_.LABELS)] * (high - low), indexing="ij"), -1).reshape(-1, high - low)
        score = model.first[paths[:, 0]] + sum(potential[low + k, paths[:, k]] for k in range(high - low))
        score = score + sum(model.transition[paths[:, k - 1], paths[:, k]] for k in range(1, high - low))
        assert (paths[score.argmax()] == labels[low:high]).all()


def test_spans_counts_and_masks(documents, staging):
    rows = people(200) + [(1000, "é x@y.org 1.2.3.4"), (1001, None), (1002, "")]
    table = documents(rows)
    found = pd_.scanned(table, pd_.fit(table, staging))
    assert found.columns == [*table.columns, "base_spans", "added_spans"]
    spans = F.concat("base_spans", "added_spans")
    for r in found.withColumn("masked", pd_.masked(F.col("text"), spans)).withColumn("w", pd_.written("base_spans")).collect():
        base = brute(r.text or "")
        assert r.w == ",".join(f"{pd_.KINDS[k]}:{a}:{e}" for a, k, e in base)
        for s in r.added_spans:
            assert all(s.end <= a or s.start >= e for a, _, e in base)
        if r.doc_id == 1000:
            assert r.masked == "é [email] [ip]"
        if r.doc_id == 1001:
            assert r.masked is None


def test_odd_rows_and_tables(documents, staging, odd):
    model = pd_.fit(documents(people(60)), staging)
    table = documents(odd).withColumnRenamed("place", "base_spans")
    found = pd_.scanned(table, model)
    assert found.columns == [*table.columns, "base_spans_", "added_spans"]
    assert len(found.collect()) == len(odd)
    assert pd_.fit(documents([]), staging) is None
    assert pd_.scanned(documents([]), None).collect() == []
