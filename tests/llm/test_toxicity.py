import random
import zlib

import numpy as np
import pytest

from tallybook.llm import toxicity


@pytest.fixture
def corpus():
    random.seed(5)
    words = ["".join(random.choices("aeionrst", k=random.randint(2, 8))) for _ in range(800)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 8 == 0
        body = random.choices(words, k=random.randint(20, 120))
        for _ in range(toxic * random.randint(1, 6)):
            body.insert(random.randrange(len(body)), random.choice(["idiot", "moron", "trash", "scum"]))
        rows.append((i, " ".join(body)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, documents, staging, corpus):
    rows, labels = corpus
    model = toxicity.fit(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), staging)
    found = {r.doc_id: r.toxicity for r in toxicity.scored(documents(rows), model).collect()}
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = [(found[i] >= 0.5) == bool(labels[i][2]) for i in held]
    assert len(held) > 100 and np.mean(right) > 0.95


def test_held_out_labels_do_not_matter(spark, documents, staging, corpus):
    rows, labels = corpus
    flipped = [(i, q, t if zlib.crc32(str(i).encode()) % 5 else 1 - t) for i, q, t in labels]
    models = [
        toxicity.fit(documents(rows[:300]), spark.createDataFrame(x[:300], "doc_id long, quality int, toxic int"), staging)
        for x in (labels, flipped)
    ]
    assert (models[0].weights == models[1].weights).all() and models[0].bias == models[1].bias


def test_odd_rows_keep_all_columns(spark, documents, staging, odd):
    model = toxicity.Model(np.ones(toxicity.FEATURES), 0.0)
    table = documents(odd).withColumnRenamed("place", "toxicity")
    found = toxicity.scored(table, model)
    assert found.columns == [*table.columns, "toxicity_"]
    scores = [r.toxicity_ for r in found.collect()]
    assert len(scores) == len(odd) and all(0 <= s <= 1 for s in scores)


def test_without_labels_or_documents(spark, documents, staging):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(documents([(1, "a b")]), none, staging)
    assert toxicity.scored(documents([(1, "a b")]), model).first().toxicity < 0.5
    assert toxicity.scored(documents([]), toxicity.fit(documents([]), none, staging)).collect() == []
    nulls = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    toxicity.fit(documents([(1, "a"), (None, "b")]), nulls, staging)
