import random

import ahocorasick
import numpy as np
import pyarrow as pa

from tallybook.llm import repeats
from tallybook.llm.repeats import WINDOW, Windows, phrase_letters, without_repeats
from tallybook.llm.wordhash import words_of


def brute(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        words = (text or "").encode().split()
        removed = set()
        for i in range(len(words) - WINDOW + 1):
            content = tuple(words[i : i + WINDOW])
            if content in seen:
                removed.update(range(i, i + WINDOW))
            seen.add(content)
        kept = [w for i, w in enumerate(words) if i not in removed]
        out[doc_id] = (len(words), len(removed), b" ".join(kept).decode())
    return out


def test_against_brute_force(documents, staging):
    random.seed(4)
    words = [f"w{i}" for i in range(30)]
    passages = [" ".join(random.choices(words, k=n)) for n in (19, 20, 21, 45, 70)]
    rows = []
    for i in range(80):
        parts = [" ".join(random.choices(words, k=random.randint(0, 40))) for _ in range(3)]
        parts.insert(random.randint(0, 3), random.choice([*passages, "same " * 50, ""]))
        rows.append((i, random.choice([" ", "\n", "\t\x0b"]).join(parts)))
    rows += [(100, rows[3][1]), (101, None), (102, "")]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in without_repeats(documents(rows), staging).collect()}
    assert found == brute(rows)


def shard(text):
    """The tables that one shard's task gets, for documents of the same text."""
    data = np.frombuffer(text.encode(), np.uint8)
    windows = Windows(words_of(data, np.array([0, len(data)])))
    recurring = pa.table({"phrase": pa.array(windows.key[windows.phrases()].view(np.int64))})
    documents = pa.table({"doc": [1, 2], "mark": pa.array([7, 7], pa.int32()), "text": [text, text]})
    return windows, recurring, documents


def test_places_come_from_the_automaton(monkeypatch):
    windows, recurring, documents = shard(" ".join(str(i) for i in range(200)))
    found = repeats._locate((), recurring, documents)
    assert sum(found.column("windows").combine_chunks().value_lengths().to_pylist()) == 2 * len(windows.start)
    assert repeats._locate((), recurring.slice(0, 0), documents).num_rows == 0

    real = ahocorasick.Automaton

    class Blind:
        def __init__(self, *args):
            self.automaton = real(*args)

        def __getattr__(self, name):
            return getattr(self.__dict__["automaton"], name)

        def __len__(self):
            return len(self.automaton)

        def iter(self, *args):
            return iter(())

    monkeypatch.setattr(repeats.ahocorasick, "Automaton", Blind)
    assert repeats._locate((), recurring, documents).num_rows == 0


def test_letters_of_a_key_are_those_of_its_words():
    windows, _, _ = shard(" ".join(f"w{i}" for i in range(40)))
    text, at = windows.letters(), windows.phrases()
    assert phrase_letters(windows.key[at]) == [text[2 * i : 2 * (i + repeats.PHRASE)] for i in at.tolist()]


def test_odd_rows(documents, staging, odd):
    found = without_repeats(documents(odd), staging).collect()
    assert len(found) == len(odd)
    assert {(r.n_words, r.n_removed) for r in found} == {(0, 0), (1, 0), (60_000, 0), (len(odd[7][1].encode().split()), 0)}


def test_rows_that_are_wholly_equal_get_one_result(documents, staging):
    text = " ".join(str(i) for i in range(50))
    found = without_repeats(documents([(1, text), (1, text), (2, text)]), staging).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (1, 0), (2, 50)]


def test_empty_table(documents, staging):
    assert without_repeats(documents([]), staging).collect() == []
