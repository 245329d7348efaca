import random

import numpy as np
import pytest

from tallybook.llm import blocks
from tallybook.llm import ngram_join as join
from tallybook.llm.wordhash import words_of


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 90 * len(a | sets[j]):
                root[top(i)] = top(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc_id))
    return sorted(out, key=str)


def near(text, edits):
    words = text.split()
    for _ in range(edits):
        words[random.randrange(len(words))] = random.choice("xyz") * 3
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    """Drifting families around the threshold, tiny texts, copies, and a passage that many share."""
    random.seed(11)
    vocabulary = ["".join(random.choices("aeiounrstl", k=random.randint(2, 7))) for _ in range(500)]
    passage = " ".join(random.choices(vocabulary, k=40))
    rows = []
    for family in range(12):
        length = [3, 9, 11, 12, 13, 22, 40, 60, 90, 150, 300, 700][family]
        text = " ".join(random.choices(vocabulary, k=length))
        for _ in range(14):
            text = near(text, random.choice([0, 1, 1, 1 + length // 60]))
            rows.append((len(rows) + 5, text.upper() if random.random() < 0.2 else text))
    rows += [(1000 + i, f"{' '.join(random.choices(vocabulary, k=20))} {passage}") for i in range(40)]
    rows += [(2000 + i, " ".join(random.choices(vocabulary[:3], k=k))) for i in range(10) for k in (1, 2, 3)]
    random.shuffle(rows)
    return rows


def found(spark_table, staging):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join.joined(spark_table, staging).collect()), key=str)


def test_same_as_brute_force(documents, staging, corpus, odd):
    rows = corpus + odd
    assert found(documents(rows), staging) == brute(rows)


@pytest.mark.parametrize("few", [1, 8])
@pytest.mark.parametrize("edits, copies", [(1, 60), (3, 60)])
def test_a_group_of_many_blocks(documents, staging, monkeypatch, edits, copies, few):
    """Near copies without their first text: some link, some don't, and blocks of eight see few at once."""
    random.seed(edits)
    monkeypatch.setattr(blocks, "BLOCK_SETS", 8)
    monkeypatch.setattr(blocks, "FEW_BLOCKS", few)
    text = " ".join(random.choices("abcdefghijklmnopqrstuvw", k=90))
    rows = [(i, near(text, random.randint(0, edits) + 1)) for i in range(copies)]
    want = brute(rows)
    assert len({c for _, _, c in want}) > 1 or edits == 1
    assert found(documents(rows), staging) == want


def test_no_link_without_a_common_key():
    """Over random pairs of all sizes: what links has a key in common."""
    random.seed(8)
    checked = 0
    for n in [*range(9, 60), 75, 120, 333, 1000, 5000]:
        for _ in range(8 if n < 100 else 3):
            a = list(range(10**6 * n, 10**6 * n + n))
            lost = random.sample(a, random.randint(0, n // 9))
            b = sorted(set(a) - set(lost)) + [-x - 1 for x in range(random.randint(0, max(0, n // 9 - len(lost))))]
            o = len(set(a) & set(b))
            if 100 * o < 90 * (len(a) + len(b) - o):
                continue
            rng = np.array([*a, *b], np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            document = np.repeat([0, 1], [len(a), len(b)])
            owner, key = join.part_keys(document, rng, np.array([len(a), len(b)]))
            if sorted(a) != sorted(b) and max(len(a), len(b)) > 9:
                checked += 1
                assert set(key[owner == 0].tolist()) & set(key[owner == 1].tolist()), n
    assert checked > 100


def test_an_empty_part_in_common_is_made_up_for():
    """Two sets of 10 and 9 elements in two parts, where the part that is the same in both is empty."""
    tried = 0
    for seed in range(4000):
        element = np.random.default_rng(seed).integers(0, 2**63, 10).astype(np.uint64)
        document, both = np.repeat([0, 1], [10, 9]), np.append(element, element[:9])
        owner, key = join.part_keys(document, both, np.array([10, 9]))
        assert set(key[owner == 0].tolist()) & set(key[owner == 1].tolist())
        tried += len(key) > 4  # the parts that are filled, and two and one least elements
    assert tried


def test_product_counts_shared_elements():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, 60)) if k % 2 else np.unique(rng.integers(0, 40_000, 60)) for k in range(90)]
    row = np.repeat(np.arange(90), [len(s) for s in sets])
    got = blocks.overlaps(row, np.concatenate(sets).astype(np.uint64), 90)
    for i in range(90):
        for j in range(90):
            assert got[i, j] == (len(np.intersect1d(sets[i], sets[j])) if i < j else 0)


def test_sets_fold_ascii_only():
    texts = [t.encode() for t in ("A b C", "a B c", "Ä b c", "ä b c")]
    offsets = np.cumsum([0, *map(len, texts)])
    document, element = join.sets_of(words_of(np.frombuffer(b"".join(texts), np.uint8), offsets))
    assert document.tolist() == [0, 1, 2, 3] and element[0] == element[1] and len(np.unique(element)) == 3


def test_empty_table(documents, staging):
    assert join.joined(documents([(1, "a")]).limit(0), staging).count() == 0
