import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tallybook.llm.sharding import Bins, RoomTree, least_capacity, pack_classes, rounded_up, shard


def test_best_fit_matches_one_item_at_a_time():
    random.seed(1)
    for _ in range(50):
        capacity, bins = random.randint(20, 60), random.randint(2, 6)
        sizes = sorted((random.randint(1, 20) for _ in range(random.randint(1, 25))), reverse=True)
        rest, used, fits = [], 0, True
        for size in sizes:
            room = [(r, i) for i, r in enumerate(rest) if r >= size]
            if room:
                rest[min(room)[1]] -= size
            elif used < bins:
                rest.append(capacity - size)
                used += 1
            else:
                fits = False
                break
        ranges = pack_classes(sorted(Counter(sizes).items(), reverse=True), capacity, bins)
        assert (ranges is not None) == fits
        if fits:
            load = Counter()
            for size, first, end, number in ranges:
                load[number] += size * (end - first)
            assert sorted(load.values()) == sorted(capacity - r for r in rest)


def test_tree_takes_the_tightest_room():
    random.seed(2)
    tree, rooms = RoomTree(), []
    for number in range(3000):
        if random.random() < 0.6 or not rooms:
            rooms.append((random.randint(0, 500), number))
            tree.add(*rooms[-1])
        else:
            size = random.randint(0, 520)
            want = min((r for r in rooms if r[0] >= size), default=None)
            assert tree.take_tightest(size) == want
            if want:
                rooms.remove(want)


def test_sizes_are_rounded_by_less_than_the_stated_part(spark):
    rows = spark.range(1, 200_000).select((F.col("id") * F.col("id") % 10**10 + 1).alias("size"))
    worst = rows.select("size", rounded_up(F.col("size")).alias("up")).agg(F.min(F.expr("up - size")), F.max(F.expr("(up - size) / size"))).first()
    assert worst[0] >= 0 and worst[1] < 1 / 4096


def test_no_room():
    assert Bins(5, 2).place(6, 1) is None
    assert least_capacity([(7, 1)], 3) == [(7, 0, 1, 0)]


def check(rows, found):
    assert len(found) == len(rows)
    shards, groups = defaultdict(list), defaultdict(set)
    for r in found:
        shards[r.shard].append(r.slot)
    for slots in shards.values():
        assert sorted(slots) == list(range(len(slots)))
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        text = texts[r.doc_id]
        assert r.size == len((text or "").encode()) + 1
        assert r.text_crc32 == zlib.crc32((text or "").encode())
        groups[text].add(r.shard)
    assert all(len(x) == 1 for x in groups.values())
    load = Counter()
    for r in found:
        load[r.shard] += r.size
    return load


def test_equal_texts_stay_together_and_sizes_are_near(documents, staging):
    random.seed(2)
    rows = [(i, random.choice(["", None, "copy " * 40, "é" * random.randint(1, 300)])) for i in range(600)]
    load = check(rows, shard(documents(rows), 4, staging).collect())
    largest = max(Counter(r[1] for r in rows)["copy " * 40] * 201, sum(load.values()) / 4)
    assert max(load.values()) <= largest * 1.01 + 1


def test_odd_rows(documents, staging, odd):
    check([r for r in odd if r[0] is not None] + [(None, "one")], shard(documents(odd), 3, staging).collect())


def test_empty_table(documents, staging):
    assert shard(documents([]), 4, staging).collect() == []
