"""Reading CSV files in pieces although values hold line breaks."""

from __future__ import annotations

import csv
import io
import random

import pytest

from tallybook.sources.readers import UploadError, read_upload
from tallybook.sources.records import _crossing, read_blocks, read_lines, read_records
from tests.test_scale import settings

COLUMNS = ["a", "b", "c"]


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def records(spark, path, **how):
    rows = read_upload(spark, path, COLUMNS, **how).orderBy("row_no").collect()
    return [tuple(r)[:3] for r in rows]


def random_file(seed, rows, end="\n"):
    random.seed(seed)
    values = ["", "x", "a,b", 'say "hi"', "two\nlines", '"', "\n\n\n", ',"\n",', "ends\n", "long " * 300, "é\n日本"]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL if seed % 2 else csv.QUOTE_MINIMAL)
    body = [[random.choice(values) for _ in COLUMNS[:-1]] + [str(i)] for i in range(rows)]
    writer.writerows([COLUMNS, *body])
    return out.getvalue(), [tuple(v or None for v in row) for row in body]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_read_in_pieces_as_the_csv_module_reads_it(spark, tmp_path, seed):
    text, want = random_file(seed, 700)
    path = write(tmp_path / "a.csv", text)
    with settings(spark, spark__sql__files__maxPartitionBytes="7k", spark__sql__files__openCostInBytes="0"):
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 8
        got = records(spark, path)
    assert [tuple(v or None for v in row) for row in got] == want


def test_same_as_reading_the_file_in_one_task(spark, tmp_path):
    text, _ = random_file(6, 300)
    path = write(tmp_path / "a.csv", text)
    whole = spark.read.options(header=True, multiLine=True, escape='"').csv(path).collect()
    with settings(spark, spark__sql__files__maxPartitionBytes="5k", spark__sql__files__openCostInBytes="0"):
        assert records(spark, path) == [tuple(r) for r in whole]


def test_a_record_that_spans_whole_pieces(spark, tmp_path):
    middle = "\n".join(f"line {i}, with a comma" for i in range(2000))
    path = write(tmp_path / "a.csv", f'a,b,c\n1,"{middle}",2\n3,4,5\n')
    with settings(spark, spark__sql__files__maxPartitionBytes="4k", spark__sql__files__openCostInBytes="0"):
        assert records(spark, path) == [("1", middle, "2"), ("3", "4", "5")]


def test_quotes_inside_plain_values_open_nothing(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b,c\n5" pipe,x"y"z,1\n"q""",2,3\n4,5,6\n')
    assert records(spark, path) == [('5" pipe', 'x"y"z', "1"), ('q"', "2", "3"), ("4", "5", "6")]


def test_carriage_returns_and_empty_lines(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b,c\r\n1,"x\r\ny",2\r\n\r\n3,4,5\r\n')
    got = records(spark, path)
    assert [(r[0], r[1].replace("\r", ""), r[2]) for r in got] == [("1", "x\ny", "2"), ("3", "4", "5")]


def test_several_files_have_a_heading_each(spark, tmp_path):
    write(tmp_path / "1.csv", 'a,b,c\n1,"\n",1\n')
    write(tmp_path / "2.csv", "a,b,c\n2,2,2\n")
    assert records(spark, str(tmp_path)) == [("1", "\n", "1"), ("2", "2", "2")]


def test_a_file_that_ends_inside_quotes_is_refused(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b,c\n1,"2,3\n4,5,6\n')
    with pytest.raises(UploadError, match="not closed"):
        read_upload(spark, path, COLUMNS)


def test_only_a_heading(spark, tmp_path):
    assert records(spark, write(tmp_path / "a.csv", "a,b,c\n")) == []


def test_no_text_is_shuffled_but_that_of_records_across_pieces(spark, tmp_path):
    text, want = random_file(2, 700)
    path = write(tmp_path / "a.csv", text)
    whole = read_upload(spark, path, COLUMNS)
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    with settings(spark, spark__sql__files__maxPartitionBytes="7k", spark__sql__files__openCostInBytes="0"):
        lines = read_lines(spark, path)
        blocks = read_blocks(lines)
        crossing = _crossing(lines, blocks).count()
    assert 8 < len(blocks.blocks) and crossing < len(blocks.blocks) < len(want)


def test_a_heading_across_pieces_and_behind_empty_lines(spark, tmp_path):
    wide = "h\n" * 3000
    path = write(tmp_path / "a.csv", f'\n\r\n"a","b","c","{wide}"\n1,"x\ny",2,3\n\n4,5,6,7\n')
    lines = 'key,"' + wide + '"\n1,2\n'
    other = write(tmp_path / "b.csv", lines)
    with settings(spark, spark__sql__files__maxPartitionBytes="1k", spark__sql__files__openCostInBytes="0"):
        got = [[r["text"] for r in _records(spark, p)] for p in (path, other)]
    assert got == [['1,"x\ny",2,3', "4,5,6,7"], ["1,2"]]


def _records(spark, path):
    lines = read_lines(spark, path)
    return read_records(lines, read_blocks(lines)).orderBy("block", "row").collect()


def test_records_across_batches_and_files_in_one_task(spark, tmp_path):
    for name in "xyz":
        write(tmp_path / f"{name}.csv", "a,b,c\n" + "".join(f'{name},"{i}\n\nend",3\n' for i in range(20)))
    want = [(name, f"{i}\n\nend", "3") for name in "xyz" for i in range(20)]
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="7"):
        assert records(spark, str(tmp_path)) == want
