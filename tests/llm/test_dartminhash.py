import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallybook.llm import blocks
from tallybook.llm.components import components
from tallybook.llm.dartminhash import buckets, classes, content, shingles, signatures, units, weighted
from tallybook.llm.wordhash import chunks


def weights(text):
    words = (text or "").encode().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute(rows):
    least = {}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, _ in rows:
        least[i] = i
    bags = {i: weights(t) for i, t in rows}
    for (a, s), (b, t) in combinations(rows, 2):
        shared = sum((bags[a] & bags[b]).values())
        if s == t or shared and shared >= 0.8 * sum((bags[a] | bags[b]).values()):
            low, high = sorted((find(a), find(b)))
            least[high] = low
    return {i: find(i) for i, _ in rows}


def changed(words, share):
    return " ".join(random.choice("xyz") + str(random.random()) if random.random() < share else w for w in words)


def test_agreement_follows_the_weighted_similarity():
    random.seed(11)
    words = [f"w{i}" for i in range(300)] + ["again"] * 60
    texts = [" ".join(words)] + [changed(words, s) for s in (0.01, 0.02, 0.05)]
    ((_, found),) = chunks(pa.array(texts))
    document, unit = units(*shingles(found))
    signature = signatures(document, unit, 4)
    for k in (1, 2, 3):
        a, b = weights(texts[0]), weights(texts[k])
        similarity = sum((a & b).values()) / sum((a | b).values())
        assert abs((signature[0] == signature[k]).mean() - similarity) < 0.15
    assert len(np.unique(buckets(signature))) > 32


def test_classes_against_brute_force(documents, staging):
    random.seed(12)
    rows, number = [], 0
    for size in (1, 2, 3, 8, 30):
        for _ in range(4):
            words = [f"{random.choice('abc')}{random.randint(0, 10_000)}" for _ in range(random.randint(60, 300))]
            for copy in range(size):
                rows.append((number, changed(words, random.choice([0, 0.002, 0.004, 0.03, 0.08])) if copy else " ".join(words)))
                number += 1
    rows += [(900 + i, "tiny text") for i in range(3)] + [(910, "tiny texts"), (911, ""), (912, None), (913, None), (914, " "), (915, "")]
    random.shuffle(rows)
    found = {r.doc_id: r.class_id for r in classes(documents(rows), staging).collect()}
    want = brute(rows)
    assert found == want
    firsts = [r.doc_id for r in classes(documents(rows), staging).collect() if r.first_of_class]
    assert sorted(firsts) == sorted(set(want.values()))


def test_a_member_that_the_leader_misses_still_links(documents, staging):
    random.seed(13)
    words = [f"w{i}" for i in range(200)]
    chain = [list(words)]
    for step in range(6):
        chain.append([f"c{step}" if i in (step * 30, step * 30 + 12) else w for i, w in enumerate(chain[-1])])
    rows = [(i, " ".join(w)) for i, w in enumerate(chain)]
    assert {r.class_id for r in classes(documents(rows), staging).collect()} == set(brute(rows).values()) == {0}


def test_members_linked_with_unlike_leaders_are_still_compared(spark, staging):
    def text(word, places):
        return " ".join(f"c{i}" if i in places else f"{word}{i}" for i in range(400))

    # a chain one - a - b - two, whose ends lead before its middle
    one, two, other, a, b = (r.id for r in spark.range(1, 6).orderBy(F.xxhash64("id"), "id").collect())
    steps = {node: set(range(10, 10 + 120 * k, 20)) for k, node in enumerate((one, a, b, two))}
    rows = [(0, text("x", ())), (other, text("y", ()))] + [(node, text("w", places)) for node, places in steps.items()]
    assert len(set(brute(rows).values())) == 3
    frame = spark.createDataFrame([(i, i, t, 396, [7, 8]) for i, t in rows], "node long, doc_id long, text string, n long, keys array<long>").withColumn("content", content(F.col("text")))
    links = blocks.links(frame.drop("text"), frame.select("doc_id", "content", "text"), blocks.Rule(weighted, 80), staging)
    assert {r.node for r in components(links, staging, "found").collect()} == {one, two, a, b} - {min(one, two, a, b)}


def test_drifting_families_in_shared_buckets(documents, staging):
    random.seed(22)
    rows = []
    for family in range(4):
        members = [[f"f{family}w{i}" for i in range(160)]]
        while len(members) < 60:
            words = list(random.choice(members))
            for _ in range(random.randint(1, 3)):
                words[random.randrange(160)] = f"n{random.random()}"
            members.append(words)
        rows += [(family * 60 + k, " ".join(words)) for k, words in enumerate(members)]
    assert {r.doc_id: r.class_id for r in classes(documents(rows), staging).collect()} == brute(rows)


def test_repeated_rows_are_one_set(documents, staging):
    random.seed(23)
    words = [f"w{i}" for i in range(100)]
    rows = [(i, text) for i, text in enumerate((" ".join(words), " ".join([*words[:-1], "other"]))) for _ in range(40)]
    found = classes(documents(rows), staging).collect()
    assert len(found) == 80 and {r.class_id for r in found} == {0}


def test_odd_rows(documents, staging, odd):
    found = classes(documents(odd), staging).collect()
    assert len(found) == len(odd)
    assert {r.doc_id: r.class_id for r in found} == {1: 1, 2: 2, 3: 3, 4: 4, None: 4, 5: 5, 6: 6, 7: 7}


def test_empty_table(documents, staging):
    assert classes(documents([]), staging).collect() == []


def test_components_of_a_long_chain_and_a_star(spark, staging):
    links = [(i, i + 1) for i in range(10, 90)] + [(200, 200 + i) for i in range(1, 40)] + [(300, 299), (299, 300), (5, 5)]
    found = components(spark.createDataFrame(links, "a long, b long"), staging, "c").collect()
    want = {i: 10 for i in range(11, 91)} | {200 + i: 200 for i in range(1, 40)} | {300: 299}
    assert {r.node: r.root for r in found} == want
