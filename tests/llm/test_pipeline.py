import random
from pathlib import Path

import corpus_pipeline
import pytest
from checks.compare import connect, differences
from pyspark.sql import functions as F

from tallybook.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with toxic documents, exact and near copies, personal data and odd rows."""
    random.seed(19)
    words = ["".join(random.choices("aeionrstl", k=random.randint(2, 9))) for _ in range(900)]
    rows, labels = [], []
    for i in range(500):
        body = random.choices(words, k=random.randint(80, 150))
        if i % 9 == 0:
            for _ in range(4):
                body.insert(random.randrange(len(body)), random.choice(["idiot", "moron", "trash"]))
        if i % 11 == 1:
            body[10] = f"joe{i}@mail.example.com"
        rows.append((i, " ".join(body)))
        labels.append((i, 1, int(i % 9 == 0)))
    for i in range(20):
        text = rows[i * 9 + 2][1].split()
        text[5] = "changed"
        rows += [(600 + i, rows[i * 9 + 2][1]), (700 + i, " ".join(text))]
    rows += [(900, None), (901, ""), (902, "tiny"), (902, "tiny"), (None, "no id here"), (903, " ".join(words) + " " + " ".join(words[::-1]) * 8)]
    path = str(tmp_path_factory.mktemp("corpus"))
    documents = [(i, t, "en", f"s{k % 4}" if k % 50 else None, len(t or "")) for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    kept = {}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == DOCUMENT
        kept[name] = docs.collect()
    toxic = {i for i in range(500) if i % 9 == 0}
    after = {r.doc_id for r in kept["toxicity"]}
    assert len(after & toxic) <= 3 and len(kept["toxicity"]) >= 546 - len(toxic) - 3
    after = [r.doc_id for r in kept["near_duplicates"]]
    assert len(after) == len(set(after)) and not {i for i in after if i is not None and 600 <= i < 800}
    assert len(after) == len({r.doc_id for r in kept["toxicity"] if r.doc_id is None or not 600 <= r.doc_id < 800})
    masked = {r.doc_id: r for r in kept["personal_data"]}
    assert masked.keys() == set(after)
    assert not any("@" in (r.text or "") for r in masked.values())
    assert any("[email]" in (r.text or "") for r in masked.values())
    assert all(r.n_chars == len(r.text or "") for r in masked.values())
    assert sorted(kept["mixing"], key=str) == sorted(kept["personal_data"], key=str)
    assert {r.doc_id for r in kept["packing"]} == set(after)
    assert corpus_pipeline.run(spark, folder).count() == len(kept["packing"])


def test_stages_of_an_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0


def test_stages_keep_columns_of_clashing_names(spark, folder, tmp_path):
    extra = "content row id kept own rank block order mark base_spans score mixture position label fold".split()
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60 or doc_id >= 880 or doc_id is null")
    docs = docs.select("*", *[F.lit(k).alias(name) for k, name in enumerate(extra)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == [*DOCUMENT, *extra]
        assert docs.select(*extra).distinct().collect() == [tuple(range(len(extra)))]
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {900, 901, 902, 903, None} <= ids
    assert {r.doc_id for r in corpus_pipeline.pack_sequences(spark, docs, folder).collect()} == ids


def test_a_run_leaves_only_its_results(spark, folder):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.iterdir())
    corpus_pipeline.run(spark, folder).count()
    (new,) = set(shared.iterdir()) - before
    assert {p.name for p in new.iterdir()} == {name for name, _ in corpus_pipeline.STAGES}


def test_sequences_follow_the_weights(spark, tmp_path, monkeypatch):
    random.seed(20)
    rows = [(i, " ".join(["alpha"] * random.choice([250, 430, 610, 900])), "abc"[i % 3]) for i in range(1800)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    docs, source = spark.read.parquet(f"{tmp_path}/documents.parquet"), {i: s for i, _, s in rows}
    packed = {}
    for heavy in "ab":
        weights = {"a": 1, "b": 1, "c": 1, heavy: 4}
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", weights)
        packed[heavy] = corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).collect()
        assert {r.doc_id for r in packed[heavy]} == set(source)
        last = max(r.sequence_id for r in packed[heavy])
        assert {r.sequence_id for r in packed[heavy]} == set(range(last + 1))
        early = [r for r in packed[heavy] if r.sequence_id < last / 3]
        total = sum(r.length for r in early)
        for s, w in weights.items():
            assert abs(sum(r.length for r in early if source[r.doc_id] == s) / total - w / 6) < 0.06
    assert len({r.sequence_id for r in packed["a"]}) == len({r.sequence_id for r in packed["b"]})
    assert sorted(packed["a"]) != sorted(packed["b"])


def test_run_changes_with_the_weights(spark, folder, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
    found = []
    for weights in ({"s0": 9, "s1": 1, None: 1}, {"s0": 1, "s1": 9, None: 1}):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", weights)
        found.append({(r.doc_id, r.piece, r.ids_crc32): (r.sequence_id, r.offset) for r in corpus_pipeline.run(spark, folder).collect()})
    assert found[0].keys() == found[1].keys() and found[0] != found[1]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op6_neighbours", "op11_divergence"}))
def test_queries_return_every_document(spark, name):
    ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    got = QUERIES[name](spark, SF).groupBy("doc_id").agg(F.count("*").alias("n"))
    assert got.count() == ids.count() == got.join(ids, "doc_id").count()
