import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import fill_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, share=50, suffix_first=80):
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= share:
        return len(units), "plain", None, None, text
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if h4 % 100 < suffix_first:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("share", [50, 100])
def test_same_as_brute_force(spark, documents, odd, share):
    random.seed(5)
    rows = [(i, "".join(random.choices("ab \n\t\x0bé🙂<PSM>", k=random.randint(0, 60)))) for i in range(10, 400)]
    rows += [*odd, (401, "a <P> b"), (402, "half <S a mark> <M"), (403, " lead and trail \n"), (404, "<S" * 9 + "P>")]
    table = documents(rows)
    made = fim.fill_middle(table, share=share)
    back = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back), key=str)
    assert got == sorted(((i, *brute(i, t or "", share)) for i, t in rows), key=str)
    texts = sorted((t or "" for _, t in rows))
    assert sorted(r.back for r in back) == texts
    assert {r.form for r in back} == {"plain", "psm", "spm"}


@pytest.mark.parametrize(
    "members, kind",
    [
        (np.arange(0, 60_000, 7), "BitmapContainer"),
        (np.arange(0, 60_000, 70), "ArrayContainer"),
        (np.arange(100, 50_000), "RunContainer"),
        (np.array([65_535]), "ArrayContainer"),
    ],
)
def test_select_in_each_container(members, kind):
    assert type(fim.container(members)).__name__ == kind
    found = fim.Boundaries(iter([members, members + (3 << 16)]))
    assert [found.select(k) for k in range(0, len(found), 13)] == [*members, *(members + (3 << 16))][::13]
    assert found.select(len(found) - 1) == members[-1] + (3 << 16)


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", "é 🙂", "ab " * 40_000, "x" * 131_072, " " * 65_536 + "b", "a " * 32_768 + "b"])
def test_boundaries_over_container_limits(text):
    ends = np.cumsum([len(u) for u in UNIT.findall(text)]).tolist()
    found = fim.Boundaries(fim.word_ends(text))
    assert [found.select(k) for k in range(len(found))] == ends
    found = fim.Boundaries(fim.character_ends(text))
    assert len(found) == len(text) and [found.select(k) for k in range(0, len(text), 997)] == list(range(1, len(text) + 1))[::997]


def test_characters_and_empty_table(spark, documents):
    rows = fim.fill_middle(documents([(i, "日本 語") for i in range(40)]), unit="characters", share=100).collect()
    assert {r.n for r in rows} == {4} and len({r.prefix_chars for r in rows}) > 2
    assert fim.fill_middle(documents([(1, "a")]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.fill_middle(documents([(1, "a")]), unit="bytes")
