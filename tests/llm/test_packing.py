import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallybook.llm.packing import Encoder, pack, plan, tokenizer_path


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(plain, text):
    return [*plain.encode(text or "", add_special_tokens=False).ids, 1]


def test_encoder_equals_the_tokenizer(plain):
    random.seed(6)
    alphabet = [*"abcXYZéßñÀ019.,!'#-_ \n\t", "日", "🙂", " ", "́", "'s", "'LL", "<|", "<|endoftext|>", "\0", "\x1c", "\x0b", "İ", "Σ"]
    encoder = Encoder(tokenizer_path())
    for _ in range(400):
        text = "".join(random.choices(alphabet, k=random.randint(0, 60)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(plain, text)[:-1], repr(text)


def test_plan_places_every_piece():
    random.seed(7)
    for _ in range(20):
        counts = Counter(random.randint(1, 64) for _ in range(random.randint(1, 500)))
        bins = plan(counts, 64)
        assert all(sum(lengths) <= 64 for lengths, _ in bins)
        used = Counter()
        for lengths, times in bins:
            for length in lengths:
                used[length] += times
        assert used == counts
        total = sum(n * c for n, c in counts.items())
        assert sum(times for _, times in bins) <= 1.1 * total / 64 + 2


def test_two_small_ones_fill_the_place_of_one():
    assert plan({10: 1, 4: 1, 3: 2}, 16) == [([10, 3, 3], 1), ([4], 1)]


def one_by_one(counts, room):
    """Best-two-fit of single documents, one bin after the other."""
    left, bins = sorted(Counter(counts).elements()), []
    while left:
        chosen, rest = [], room
        while fits := [x for x in left if x <= rest]:
            chosen.append(max(fits))
            left.remove(chosen[-1])
            rest -= chosen[-1]
        while rest and len(chosen) > 1:
            least = min(chosen)
            pairs = [(a + b, -a, -b) for i, a in enumerate(left) for b in left[i + 1 :] if least < a + b <= rest + least]
            if not pairs:
                break
            total, a, b = max(pairs)
            chosen.remove(least)
            chosen += [-a, -b]
            left = sorted([*left, least])
            left.remove(-a)
            left.remove(-b)
            rest += least - total
        bins.append(sorted(chosen, reverse=True))
    return bins


def test_plan_against_single_documents():
    """Bins made many at a time are those made one by one: as many, and each of them filled alike."""
    random.seed(8)
    for _ in range(60):
        counts = Counter(random.choice([random.randint(1, 40), random.randint(1, 8)]) for _ in range(random.randint(1, 45)))
        want, got = one_by_one(counts, 40), [lengths for lengths, times in plan(counts, 40) for _ in range(times)]
        assert len(got) == len(want)
        assert sorted(map(sum, got)) == sorted(map(sum, want))


def check(plain, rows, found, sequence):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in rows:
        ids = ids_of(plain, text)
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)[: -(-len(ids) // sequence)]
        assert [p.start for p in pieces] == list(range(0, len(ids), sequence))
        for p in pieces:
            part = ids[p.start : p.start + sequence]
            assert (p.length, p.ids_crc32) == (len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence


def test_round_trip(documents, staging, plain):
    random.seed(8)
    rows = [(i, " ".join(random.choices(["alpha", "béta", "Gamma,", "x9"], k=random.randint(0, 90)))) for i in range(120)]
    found = pack(documents(rows), staging, sequence=64).collect()
    check(plain, rows, found, 64)
    total = sum(len(ids_of(plain, t)) for _, t in rows)
    assert len({r.sequence_id for r in found}) <= total / 64 * 1.02 + 1


def test_odd_rows(documents, staging, plain, odd):
    rows = [r for r in odd if r[0] is not None]
    found = pack(documents(rows), staging).collect()
    assert sum(r.doc_id == 4 for r in found) == 2
    check(plain, [r for r in rows if r[0] != 4], [r for r in found if r.doc_id != 4] + [r for r in found if r.doc_id == 4], 4096)


def test_empty_table(documents, staging):
    assert pack(documents([]), staging).collect() == []
