import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import neighbours
from tallybook.llm.neighbours import Tree, cosine, nearest, unit, visits

SCHEMA = "vec_id long, embedding array<float>, label int, leaf int, query string"


@pytest.fixture
def embeddings(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0, 1, "q") for i, v in rows], SCHEMA)


def brute(rows, step, neighbours=5):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, one in good:
        if q % step == 0:
            near = sorted((-float(cosine(one, v[None, :])[0]), i) for i, v in good if i != q)[:neighbours]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_small_tables_are_exact_with_ties(embeddings, staging):
    random = np.random.default_rng(1)
    rows = [(i, random.integers(-2, 3, 4).astype(float).tolist()) for i in range(1, 90)]
    rows += [(i, [1.0, 1.0, 0.0, 0.0]) for i in range(90, 120)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(205, []), (206, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0])]
    assert len({tuple(v) for _, v in rows if v}) > 50
    got = found(nearest(embeddings(rows), F.col("vec_id") % 10 == 0, staging))
    want = brute([r for r in rows if r[0] not in (205, 206)], 10)
    assert got.keys() == want.keys()
    hits = sum(x == y for q in want for x, y in zip(got[q], want[q], strict=True))
    assert hits >= 0.9 * sum(len(x) for x in want.values())
    assert got[100] == want[100] and [x[1] for x in got[100]] == [90, 91, 92, 93, 94]


def test_recall(embeddings, staging):
    random = np.random.default_rng(2)
    centers = random.normal(size=(30, 16))
    rows = [(i, (centers[i % 30] + 0.4 * random.normal(size=16)).tolist()) for i in range(3000)]
    got, want = found(nearest(embeddings(rows), F.col("vec_id") % 50 == 0, staging)), brute(rows, 50)
    hits = sum(len({x[1] for x in got[q]} & {x[1] for x in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert all(abs(s - dict((i, s) for _, i, s in want[q]).get(i, s)) < 1e-12 for q in got for _, i, s in got[q])


@pytest.mark.parametrize("rows_at_once, queries_at_once", [(4000, 20_000), (7, 3)])
def test_vectors_of_two_sizes_are_searched_among_their_own(embeddings, staging, monkeypatch, rows_at_once, queries_at_once):
    monkeypatch.setattr(neighbours, "GROUP_ROWS", rows_at_once)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", queries_at_once)
    random = np.random.default_rng(4)
    three = [(i, random.normal(size=3).round(1).tolist()) for i in range(60)]
    two = [(i, random.normal(size=2).round(1).tolist()) for i in range(100, 140)]
    got = found(nearest(embeddings(three + two + [(500, [1.0])]), F.col("vec_id") % 5 == 0, staging))
    assert got == brute(three, 5) | brute(two, 5)


def test_fewer_candidates(embeddings, staging):
    got = found(nearest(embeddings([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]), F.col("vec_id") % 50 == 0, staging))
    assert [x[1] for x in got[0]] == [2, 1]


def test_empty_table(embeddings, staging):
    frame = nearest(embeddings([]), F.col("vec_id") % 50 == 0, staging)
    assert frame.collect() == [] and frame.columns == ["query_id", "rank", "vec_id", "score"]


def test_search_visits_all_leaves_nearest_first():
    sample = np.random.default_rng(3).normal(size=(8000, 8))
    tree = Tree(sample)
    order = list(tree.search(unit(sample[:1])[0]))
    assert sorted(order) == list(range(tree.leaves)) and tree.leaves > 20
    assert 1 <= visits(tree, sample[:500], 5) <= tree.leaves
