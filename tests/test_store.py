"""Uploads that meet each other, or were killed on the way."""

from __future__ import annotations

import threading

import pytest

from tallybook.filesystem import FileSystem
from tallybook.plans.upload import run_upload
from tallybook.sources.readers import Location

HEAD = "short_code,beneficiary_code\n"


def upload(spark, tmp_path, name, body, target):
    path = tmp_path / f"{name}.csv"
    path.write_text(HEAD + body)
    return run_upload(spark, "benef_code_map", str(path), target, str(tmp_path / f"log_{name}"))


def stored(spark, target):
    rows = spark.read.format(target.format).load(target.path).select("short_code", "beneficiary_code")
    return sorted(tuple(r) for r in rows.collect())


def logged(spark, result):
    return [tuple(r)[:2] for r in spark.read.option("header", True).csv(result.log).collect()]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
@pytest.mark.parametrize("earlier", [True, False])
def test_two_uploads_of_one_key_at_once_store_it_once(spark, tmp_path, monkeypatch, fmt, earlier):
    target = Location(str(tmp_path / "map"), fmt)
    if earlier:
        upload(spark, tmp_path, "first", "IR00000,3000000000\n", target)
    both, claim, met = threading.Barrier(2), FileSystem.claim, []

    def together(self, folder, place):
        if len(met) < 2:  # both have planned with the same store before either stores
            met.append(place)
            both.wait(60)
        return claim(self, folder, place)

    monkeypatch.setattr(FileSystem, "claim", together)
    results = {}

    def run(name, body):
        results[name] = upload(spark, tmp_path, name, body, target)

    threads = [
        threading.Thread(target=run, args=(name, f"IR00001,{code}\nIR0000{k},{code}\n"))
        for k, (name, code) in enumerate([("a", 3000000001), ("b", 3000000002)], 2)
    ]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert met[0] == met[1]
    assert sorted(r.stored for r in results.values()) == [1, 2]
    (loser,) = (r for r in results.values() if r.stored == 1)
    assert logged(spark, loser) == [("key is already stored", "IR00001")]
    keys = [k for k, _ in stored(spark, target)]
    assert keys == ["IR00000"] * earlier + ["IR00001", "IR00002", "IR00003"]


def test_an_upload_killed_before_its_files_were_moved_counts(spark, tmp_path, monkeypatch):
    target = Location(str(tmp_path / "map"))
    upload(spark, tmp_path, "a", "IR00001,3000000001\n", target)

    class Killed(BaseException):
        pass

    def killed(self, source, to):
        raise Killed

    monkeypatch.setattr(FileSystem, "move", killed)
    with pytest.raises(Killed):
        upload(spark, tmp_path, "b", "IR00002,3000000002\n", target)
    monkeypatch.undo()
    assert [k for k, _ in stored(spark, target)] == ["IR00001"]
    result = upload(spark, tmp_path, "c", "IR00002,3000000009\nIR00003,3000000003\n", target)
    assert logged(spark, result) == [("key is already stored", "IR00002")]
    assert stored(spark, target) == [("IR00001", 3000000001), ("IR00002", 3000000002), ("IR00003", 3000000003)]


def test_a_store_written_by_others_is_added_to(spark, tmp_path):
    target = Location(str(tmp_path / "map"))
    rows = spark.createDataFrame([("IR00007", 3000000007)], "short_code string, beneficiary_code bigint")
    rows.write.parquet(target.path)
    result = upload(spark, tmp_path, "a", "IR00007,3000000001\nIR00008,3000000008\n", target)
    assert (result.stored, result.refused) == (1, 1)
    assert stored(spark, target) == [("IR00007", 3000000007), ("IR00008", 3000000008)]


def test_an_upload_that_stores_nothing_is_no_append(spark, tmp_path):
    target = Location(str(tmp_path / "map"))
    upload(spark, tmp_path, "a", "IR00001,3000000001\n", target)
    before = sorted(p.name for p in (tmp_path / "map").iterdir())
    result = upload(spark, tmp_path, "b", "IR00001,3000000001\n", target)
    assert (result.accepted, result.stored, result.refused) == (True, 0, 1)
    assert sorted(p.name for p in (tmp_path / "map").iterdir()) == before
