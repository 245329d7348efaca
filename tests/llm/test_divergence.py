import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallybook.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, most=10):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = [t.translate(FOLD) for t in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = set()
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        p = {}
        for s, c in [*groups.items(), (None, sum(groups.values(), Counter()))]:
            total = sum(c[t] for t in kept) + 2 * len(kept)
            p[s] = {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        def f(a, b, t, p=p):
            return (p[a][t] - p[b][t]) ** 2 // (p[a][t] + p[b][t])

        for s in groups:
            pairs = [(o, sum(f(s, o, t) for t in kept)) for o in groups if o != s]
            words = [(t, f(s, None, t)) for t in kept if groups[s][t] and p[s][t] > p[None][t]]
            for part, found, limit in (("pair", pairs, None), ("term", words, most)):
                ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ordered)}
    return out


def table(spark, rows):
    full = [(i, t, lang, s, 1, 2, 3, "x") for i, (lang, s, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, value int, rank int, block int, index string")


@pytest.fixture(scope="module")
def corpus():
    random.seed(3)
    words = ["".join(random.choices("abcdeé", k=random.randint(1, 4))) for _ in range(250)] + ["日本", "Straße", "İ"]
    rows = []
    for k in range(500):
        source = "hot" if k % 3 == 0 else f"s{k % 7}"
        pool = words[k % 5 * 30 :]
        rows.append(("en" if k % 4 else "fr", source, " ".join(w.upper() if random.random() < 0.3 else w for w in random.choices(pool, k=random.randint(0, 60)))))
    rows += [("en", "empty", None), ("en", None, "1 2 3 ---"), (None, "s1", "one"), (None, None, ""), ("xx", "a", "rare"), ("xx", "b", "")]
    rows += [("same", s, "alpha beta") for s in "abc" for _ in range(20)] + [("en", "long", "lange " * 30_000)]
    return rows


@pytest.mark.parametrize("block, tile", [(1 << 14, 512), (16, 3)])
def test_same_as_brute_force(spark, staging, corpus, monkeypatch, block, tile):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    got = [tuple(r) for r in divergence.audit(table(spark, corpus), staging).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(corpus)


def test_runs_and_their_meeting():
    one = divergence.Runs(np.array([0, 0, 0, 5, 5, 0]), 10, 6)
    two = divergence.Runs(np.array([1, 1, 4, 4, 4, 4]), 18, 6)
    assert one.start.tolist() == [0, 3, 5] and one.count.tolist() == [0, 5, 0]
    mine, theirs, f, lengths = divergence.meet(one, two, 6)
    assert (mine.tolist(), theirs.tolist(), lengths.tolist()) == ([0, 0, 1, 2], [0, 1, 1, 1], [2, 1, 2, 1])
    p, q = 1 + 10**9 * 7 // 22, 1 + 10**9 * 6 // 30
    assert f[2] == (p - q) ** 2 // (p + q)


def test_counts_beyond_64_bits():
    assert divergence.probabilities(np.array([10**12]), 10**12, 5).tolist() == [1 + 10**9 * (10**12 + 2) // (10**12 + 10)]


def test_workers_hand_on_full_counters(spark, staging, corpus, monkeypatch):
    monkeypatch.setattr(divergence, "_ENTRIES", 1)
    got = {tuple(r) for r in divergence.audit(table(spark, corpus), staging, least=3, most=4).collect()}
    assert got == brute(corpus, 3, 4)


def test_empty_table(spark, staging):
    assert divergence.audit(table(spark, [("en", "a", "x")]).limit(0), staging).count() == 0
