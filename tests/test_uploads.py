"""Upload files: reading, the all-or-nothing gate, appends and refusals."""

from __future__ import annotations

import pytest

from tallybook.plans.upload import run_upload
from tallybook.sources.readers import Location, UploadError, read_table, read_upload

HEAD = "short_code,beneficiary_code\n"


def write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def logged(spark, log):
    return [tuple(r) for r in spark.read.option("header", True).csv(log).collect()]


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(
        tmp_path / "a.csv", 'error,beneficiary_code,note,short_code\nold,3000000001,"a,b",IR00001\n'
    )
    rows = read_upload(spark, path, ["short_code", "beneficiary_code"])
    assert rows.columns == ["short_code", "beneficiary_code", "row_no", "broken"]
    assert [tuple(r)[:2] for r in rows.collect()] == [("IR00001", "3000000001")]


def test_a_missing_column_is_empty(spark, tmp_path):
    path = write(tmp_path / "a.csv", "short_code\nIR00001\n")
    rows = read_upload(spark, path, ["short_code", "beneficiary_code"])
    assert [tuple(r)[:2] for r in rows.collect()] == [("IR00001", None)]


def test_a_file_without_known_columns_is_an_error(spark, tmp_path):
    with pytest.raises(UploadError):
        read_upload(spark, write(tmp_path / "a.csv", "a,b\n1,2\n"), ["short_code"])


def test_one_bad_row_keeps_everything_out(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEAD + "IR00001,3000000001\nIR00002,x\n")
    target = Location(str(tmp_path / "map"))
    result = run_upload(spark, "benef_code_map", path, target, str(tmp_path / "log"))
    assert (result.accepted, result.stored, result.refused) == (False, 0, 1)
    assert logged(spark, result.log) == [
        ("BeneficiaryCode: must be an integer number.", "IR00002", "x")
    ]
    assert not (tmp_path / "map").exists()


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("row", ["IR00001,3000000001,EXTRA", "IR00001"])
def test_a_row_with_a_wrong_number_of_fields_keeps_everything_out(spark, tmp_path, row, multi_line):
    path = write(tmp_path / "a.csv", f"{HEAD}IR00002,3000000002\n{row}\n")
    target = Location(str(tmp_path / "map"))
    result = run_upload(spark, "benef_code_map", path, target, str(tmp_path / "log"), multi_line)
    assert (result.accepted, result.stored, result.refused) == (False, 0, 1)
    assert logged(spark, result.log)[0][0] == f"row has a wrong number of fields: {row}"
    assert not (tmp_path / "map").exists()


def test_a_blank_that_makes_a_row_invalid_is_logged(spark, tmp_path):
    path = write(tmp_path / "a.csv", "short_code\n IR12ABC\n")
    result = run_upload(
        spark, "retail_supplier", path, Location(str(tmp_path / "map")), str(tmp_path / "log")
    )
    assert logged(spark, result.log) == [("ShortCode: must be in a valid format.", " IR12ABC")]


def test_ragged_source_tables_fail(spark, tmp_path):
    write(tmp_path / "t.csv", "short_code\nIR00001,x\n")
    rows = read_table(spark, "retail_short_code", Location(str(tmp_path / "t.csv"), "csv"))
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        rows.collect()


def test_line_break_inside_quotes_is_part_of_the_value(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'short_code\n"IR12ABC\n"\nIR12ABC\n')
    result = run_upload(
        spark, "retail_supplier", path, Location(str(tmp_path / "map")), str(tmp_path / "log")
    )
    assert (result.accepted, result.refused) == (False, 1)


def test_rows_are_appended_once(spark, tmp_path):
    target = Location(str(tmp_path / "map"))
    first = write(tmp_path / "a.csv", HEAD + "IR00001,3000000001\nIR00002,3000000002\n")
    result = run_upload(spark, "benef_code_map", first, target, str(tmp_path / "log1"))
    assert (result.accepted, result.stored, result.refused) == (True, 2, 0)
    assert logged(spark, result.log) == []

    second = write(
        tmp_path / "b.csv",
        HEAD + "IR00003,3000000003\nIR00002,3000000009\nIR00003,3000000004\n"
        "IR00004,30000000040000000000\n",
    )
    result = run_upload(spark, "benef_code_map", second, target, str(tmp_path / "log2"))
    assert (result.accepted, result.stored, result.refused) == (True, 1, 3)
    assert {r[:2] for r in logged(spark, result.log)} == {
        ("key is already stored", "IR00002"),
        ("key occurs earlier in the upload", "IR00003"),
        ("number is out of range", "IR00004"),
    }
    stored = spark.read.parquet(target.path)
    assert dict(stored.dtypes) == {"short_code": "string", "beneficiary_code": "bigint"}
    assert {tuple(r) for r in stored.collect()} == {
        ("IR00001", 3000000001),
        ("IR00002", 3000000002),
        ("IR00003", 3000000003),
    }


def test_the_first_row_of_a_file_read_in_pieces_wins(spark, tmp_path):
    lines = [f"IR{n % 100:02d}{n // 100:03d},3{n:09d}\n" for n in range(3000)]
    body = "".join(lines) + "".join(f"IR00000,3{n:09d}\n" for n in range(5000, 9000))
    path = write(tmp_path / "a.csv", HEAD + body)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = read_upload(spark, path, ["short_code", "beneficiary_code"], multi_line=False)
        assert rows.rdd.getNumPartitions() > 4
        ordered = [r["beneficiary_code"] for r in rows.orderBy("row_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert ordered == [line.split(",")[1] for line in body.splitlines()]


def test_ledger_map_upload(spark, tmp_path):
    head = (
        "transaction_type,item_status,payment_method,shipment_provider_name,ledger,subledger\n"
    )
    path = write(
        tmp_path / "a.csv",
        head + "Item Price,closed,SEP,NA,13004,\nItem Price,closed,PEC,NA,33001,33002\n",
    )
    target = Location(str(tmp_path / "map"), "orc")
    result = run_upload(spark, "ledger_map", path, target, str(tmp_path / "log"))
    assert (result.accepted, result.stored) == (True, 2)
    stored = spark.read.orc(target.path).select("ledger", "subledger").collect()
    assert {tuple(r) for r in stored} == {(13004, None), (33001, 33002)}
