import random
from fractions import Fraction

import pytest

from tallybook.llm.mixing import FINE, mixed, schedule, shares, slots, stretch


def test_every_deadline_holds_and_no_source_strays_by_a_block():
    random.seed(16)
    for _ in range(30):
        weights = {f"s{i}": random.choice([0.01, 0.3, 1, 7]) * random.random() + 1e-6 for i in range(random.randint(1, 12))}
        parts = shares(weights, random.choice([16, 128, 1024]))
        period, done = sum(parts.values()), dict.fromkeys(parts, 0)
        plan = list(schedule(parts))
        assert [p[4] for p in plan] == list(range(period)) and min(parts.values()) >= 1
        for source, block, release, deadline, slot in plan:
            assert release <= slot < deadline and block == done[source]
            done[source] += 1
            for s, n in parts.items():
                assert abs(done[s] - Fraction(n * (slot + 1), period)) < 1
        assert done == parts


def test_no_source_strays_by_a_block_from_its_given_weight_over_many_periods():
    random.seed(17)
    heavy = {"s0": 19 / 2} | {f"s{i}": 1 for i in range(1, 20)}
    cases = [heavy, {f"s{i}": 40.0 if i == 0 else 1 for i in range(140)}]
    for _ in range(12):
        cases.append({f"s{i}": random.choice([0.004, 0.1, 1, 7]) * (0.2 + random.random()) for i in range(random.randint(1, 30))})
    for weights in cases:
        total, parts = sum(weights.values()), shares(weights, FINE)
        assert all(abs(parts[s] / FINE - w / total) < 1e-9 for s, w in weights.items())
        done, slot, length = dict.fromkeys(parts, 0), 0, stretch(parts)
        for number in range(max(3, 30_000 // length)):
            for source, block, release, deadline, at in schedule(parts, number * length, length):
                assert release <= at < deadline and block == done[source] and at == slot
                done[source] += 1
                slot += 1
                assert all(abs(done[s] - weights[s] / total * slot) < 1 + 1e-6 for s in (source, random.choice([*parts])))


def test_a_small_source_moves_no_other_over_a_million_slots():
    weights = {"a": 0.6, "b": 0.3999, "c": 0.0001}
    parts = shares(weights, FINE)
    length, done, slot = stretch(parts), dict.fromkeys(weights, 0), 0
    assert 10_000 <= length < 20_000
    while slot < 10**6:
        for source, *_ in schedule(parts, slot, length):
            done[source] += 1
            slot += 1
            assert all(abs(done[s] - w * slot) < 1 + 1e-6 for s, w in weights.items())


def test_weights_are_over_zero():
    with pytest.raises(ValueError):
        shares({"a": 1, "b": 0})


def test_a_long_stream_keeps_the_given_weights(documents):
    weights = {"a": 0.5003, "b": 0.25, "c": 0.2497}
    rows = [(i, "t", "aabc"[i % 4]) for i in range(60_000)]
    found = mixed(documents(rows), weights, block_rows=1).collect()
    check(rows, found, 1)
    done = dict.fromkeys(weights, 0)
    for slot, r in enumerate(sorted(found, key=lambda r: r.mixture.slot)[:59_000]):
        assert r.mixture.slot == slot
        done[r.source] += 1
        assert all(abs(done[s] - w * (slot + 1)) < 1 for s, w in weights.items())


def check(rows, found, block_rows):
    assert len(found) == len(rows)
    places = sorted((r.mixture.position, r.source) for r in found)
    assert len({p for p, _ in places}) == len(places)
    by_slot = {}
    for r in found:
        assert r.mixture.release <= r.mixture.slot < r.mixture.deadline
        assert by_slot.setdefault(r.mixture.slot, r.source) == r.source
        assert r.mixture.position // block_rows == r.mixture.slot


def test_rows_follow_the_schedule_for_many_periods(documents):
    rows = [(i, "t", "abc"[i % 3 if i % 2 else 0]) for i in range(6000)]
    found = mixed(documents(rows), {"a": 4, "b": 2, "c": 1}, block_rows=2).collect()
    check(rows, found, 2)
    first = sorted(found, key=lambda r: r.mixture.position)[:1400]
    share = {s: sum(r.source == s for r in first) / 1400 for s in "abc"}
    assert abs(share["a"] - 4 / 7) < 0.01 and abs(share["b"] - 2 / 7) < 0.01


def test_odd_rows(documents):
    rows = [(1, None, None), (1, None, None), (None, "", ""), (2, "x", None), (3, "y" * 100_000, "new"), (4, "", "a")]
    table = documents(rows).withColumnsRenamed({"place": "mixture", "bytes": "block", "n_chars": "rank", "lang": "order"})
    found = mixed(table, {"a": 1.0, "b": 5.0})
    assert found.columns == [*table.columns, "mixture_"]
    assert len(found.collect()) == len(rows)
    check(rows, mixed(documents(rows)).collect(), 16)


def test_empty_table(documents):
    assert mixed(documents([])).collect() == []
