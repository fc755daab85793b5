"""Delimited logs: decoding, the data source, tailing and restarts."""

import datetime
import decimal
import os

import pyarrow as pa
import pytest

from millrace.operators import projection
from millrace.sources import delimited, logtail
from millrace.streaming import runner

SCORES = "stu_no int, sub_no int, score int"
TYPED = "i int, s smallint, b bigint, d decimal(4,2), v string, t timestamp_ntz, dt date"
TYPED_LINES = "1,2,3,12.345,x,2024-01-01 10:00:00,19723\n,,,,,,\n-1,-2,-3,123.4,y z,2024-01-01 10:00:00.5,0\n7,7,7,-0.005,w,1969-12-31 23:59:59,-1\n"
TYPED_ROWS = [
    (1, 2, 3, decimal.Decimal("12.35"), "x", datetime.datetime(2024, 1, 1, 10), datetime.date(2024, 1, 1)),
    (None,) * 7,
    (-1, -2, -3, None, "y z", datetime.datetime(2024, 1, 1, 10, 0, 0, 500000), datetime.date(1970, 1, 1)),
    (7, 7, 7, decimal.Decimal("-0.01"), "w", datetime.datetime(1969, 12, 31, 23, 59, 59), datetime.date(1969, 12, 31)),
]


def write(path, text, mode="w"):
    with open(path, mode, newline="") as handle:
        handle.write(text)
    return path


@pytest.fixture
def scan(spark):
    """Both readers of a bounded log, which must agree."""

    def run(path, schema, **options):
        column_based = delimited.scan_log(spark, path, schema, options.get("separator", ","), on_malformed=options.get("on_malformed", "drop"))
        return [column_based, logtail.read_log(spark, path, schema, **options)]

    return run


def test_rows_of_a_log_without_final_newline(spark, scan, folder, rows):
    path = write(f"{folder}/scores.csv", "1,1,1\n1,2,3\n2,2,2\n3,1,3")
    assert rows(logtail.read_log(spark, path, SCORES, range_bytes="5")) == [(1, 1, 1), (1, 2, 3), (2, 2, 2), (3, 1, 3)]
    for df in scan(path, SCORES):
        assert rows(df) == [(1, 1, 1), (1, 2, 3), (2, 2, 2), (3, 1, 3)]
        assert rows(projection.keep(df, "stu_no = 1", "sub_no <> 1")) == [(1, 2, 3)]
        assert rows(projection.keep(df, "stu_no <> 1", "sub_no <> 1")) == [(2, 2, 2)]
    assert rows(delimited.scan_log(spark, path, SCORES, parallelism=2)) == [(1, 1, 1), (1, 2, 3), (2, 2, 2), (3, 1, 3)]


def test_every_type(scan, folder):
    path = write(f"{folder}/typed.csv", TYPED_LINES)
    for df in scan(path, TYPED):
        assert [tuple(r) for r in df.collect()] == TYPED_ROWS


def test_malformed_lines(scan, folder, rows):
    path = write(f"{folder}/bad.csv", "1,1,1\n1,2\n1,,3\n1,2,\n\n5,5,5\n")
    for df in scan(path, SCORES):
        assert sorted(rows(df), key=str) == sorted([(1, 1, 1), (1, None, 3), (1, 2, None), (5, 5, 5)], key=str)
    for df in scan(path, SCORES, on_malformed="fail"):
        with pytest.raises(Exception, match="wrong number of fields"):
            df.collect()
    bad_number = write(f"{folder}/number.csv", "x,2,3\n")
    for df in scan(bad_number, SCORES):
        with pytest.raises(Exception):
            df.collect()


def test_separator_is_literal_and_line_ends(scan, folder, rows):
    path = write(f"{folder}/bars.csv", "1|1|1\r\n1|2|3\r\n")
    for df in scan(path, SCORES, separator="|"):
        assert rows(df) == [(1, 1, 1), (1, 2, 3)]


def test_unsupported_type(spark, folder):
    path = write(f"{folder}/x.csv", "1\n")
    with pytest.raises(ValueError, match="unsupported data type"):
        delimited.scan_log(spark, path, "a double")
    with pytest.raises(Exception, match="unsupported data type"):
        logtail.read_log(spark, path, "a double").collect()


def test_equality_reaches_the_source(spark, folder, rows):
    path = write(f"{folder}/scores.csv", "1,1,1\n1,2,3\n2,2,2\n,1,3\n")
    df = logtail.read_log(spark, path, SCORES).where("stu_no = 1 AND sub_no <> 1 AND score = 3")
    plan = projection.explain_text(df, "simple")
    assert rows(df) == [(1, 2, 3)]
    # what the source took is gone from the plan, what it refused is still there
    filter_line = next(line for line in plan.splitlines() if "Filter" in line)
    assert "sub_no" in filter_line and "= 1)" not in filter_line.replace("(sub_no", "").replace("= 1))", "")
    assert rows(logtail.read_log(spark, path, SCORES).where("stu_no = 1 AND stu_no = 2")) == []
    assert rows(logtail.read_log(spark, path, SCORES).where("stu_no <> 1")) == [(2, 2, 2)]
    text = write(f"{folder}/text.csv", "a,1\nb,2\n,3\n")
    assert rows(logtail.read_log(spark, text, "k string, n bigint").where("k = 'b'")) == [("b", 2)]
    assert rows(logtail.read_log(spark, text, "k string, n bigint").where("n = 3")) == [(None, 3)]


@pytest.mark.parametrize("size", [1, 3, 7, 64])
def test_byte_ranges_give_every_line_once(folder, monkeypatch, size):
    lines = ["", "a", "bb" * 20, "c", "", "dddd", "e" * 100, "f"]
    for end in ("", "\n"):
        path = write(f"{folder}/lines-{size}-{len(end)}", "\n".join(lines) + end)
        monkeypatch.setattr(logtail, "BLOCK_BYTES", 4)
        monkeypatch.setattr(logtail, "PROBE_BYTES", 5)
        total = os.path.getsize(path)
        found = [v.as_py() for part in logtail._ranges(path, 0, total, size) for batch in logtail._lines(path, part) for v in batch]
        assert found == lines
        complete = logtail._after_last_newline(pa.fs.LocalFileSystem(), path, 0, total)
        assert complete == (total if end else total - 1)


def tail(spark, path, out, checkpoint):
    df = logtail.read_log(spark, path, SCORES, mode="stream")
    runner.finish(runner.start_append(df, out, checkpoint))
    return sorted(tuple(r) for r in spark.read.schema(SCORES).parquet(out).collect())


def test_tail_holds_back_half_lines_and_resumes(spark, folder):
    path, out, checkpoint = f"{folder}/log.csv", f"{folder}/out", f"{folder}/checkpoint"
    write(path, "1,1,1\n1,2,3\n2,2,2\n3,1,3")
    assert len(tail(spark, path, out, checkpoint)) == 3
    write(path, "\n4,1,", "a")
    assert tail(spark, path, out, checkpoint)[-1] == (3, 1, 3)
    write(path, "4\nbad\n5,1,5\n", "a")
    assert tail(spark, path, out, checkpoint) == [(1, 1, 1), (1, 2, 3), (2, 2, 2), (3, 1, 3), (4, 1, 4), (5, 1, 5)]
    # nothing new, nothing read again
    assert len(tail(spark, path, out, checkpoint)) == 6


def test_tail_of_a_folder_sees_new_and_growing_files(spark, folder):
    logs, out, checkpoint = f"{folder}/logs", f"{folder}/out", f"{folder}/checkpoint"
    os.mkdir(logs)
    write(f"{logs}/a.csv", "1,1,1\n")
    assert tail(spark, logs, out, checkpoint) == [(1, 1, 1)]
    write(f"{logs}/b.csv", "2,2,2\n")
    write(f"{logs}/a.csv", "1,1,2\n", "a")
    assert tail(spark, logs, out, checkpoint) == [(1, 1, 1), (1, 1, 2), (2, 2, 2)]


def test_shortened_log_fails(spark, folder):
    path, out, checkpoint = f"{folder}/log.csv", f"{folder}/out", f"{folder}/checkpoint"
    write(path, "1,1,1\n1,2,3\n")
    tail(spark, path, out, checkpoint)
    write(path, "9,9,9\n")
    with pytest.raises(Exception, match="may only grow"):
        tail(spark, path, out, checkpoint)


def tail_on(spark, path, folder, **options):
    df = logtail.read_log(spark, path, SCORES, mode="stream", **options)
    runner.finish(runner.start_append(df, f"{folder}/out", f"{folder}/checkpoint"))
    return sorted(tuple(r) for r in spark.read.schema(SCORES).parquet(f"{folder}/out").collect())


def test_replaced_log_fails_or_is_read_anew(spark, folder):
    path = write(f"{folder}/log.csv", "1,1,1\n2,2,2\n")
    tail_on(spark, path, folder)
    write(path, "7,7,7\n8,8,8\n9,9,9\n")
    with pytest.raises(Exception, match="other content"):
        tail_on(spark, path, folder)
    expected = [(1, 1, 1), (2, 2, 2), (7, 7, 7), (8, 8, 8), (9, 9, 9)]
    assert tail_on(spark, path, folder, on_rotation="restart") == expected


def test_renamed_log_is_read_on(spark, folder):
    logs = f"{folder}/logs"
    os.mkdir(logs)
    write(f"{logs}/a.csv", "1,1,1\n2,2,")
    assert tail_on(spark, logs, folder) == [(1, 1, 1)]
    os.rename(f"{logs}/a.csv", f"{logs}/a.csv.1")
    write(f"{logs}/a.csv.1", "2\n", "a")
    write(f"{logs}/a.csv", "3,3,3\n")
    assert tail_on(spark, logs, folder) == [(1, 1, 1), (2, 2, 2), (3, 3, 3)]


def test_vanished_log(spark, folder):
    logs = f"{folder}/logs"
    os.mkdir(logs)
    write(f"{logs}/whole.csv", "1,1,1\n")
    write(f"{logs}/half.csv", "2,2,2\n3,3")
    assert len(tail_on(spark, logs, folder)) == 2
    os.rename(f"{logs}/whole.csv", f"{folder}/elsewhere.csv")
    write(f"{logs}/new.csv", "4,4,4\n")
    assert len(tail_on(spark, logs, folder)) == 3
    os.rename(f"{logs}/half.csv", f"{folder}/elsewhere-2.csv")
    write(f"{logs}/new.csv", "5,5,5\n", "a")
    with pytest.raises(Exception, match="not complete"):
        tail_on(spark, logs, folder)
    assert len(tail_on(spark, logs, folder, on_rotation="restart")) == 4


def test_logs_in_folders_and_empty_logs(spark, folder, rows):
    logs = f"{folder}/logs"
    os.makedirs(f"{logs}/dt=1/_temporary")
    assert rows(logtail.read_log(spark, logs, SCORES)) == []
    write(f"{logs}/empty.csv", "")
    assert rows(logtail.read_log(spark, logs, SCORES)) == []
    write(f"{logs}/b.csv", "1,1,1\n")
    write(f"{logs}/dt=1/a.csv", "2,2,2\n3,3,3\n")
    write(f"{logs}/dt=1/_temporary/c.csv", "9,9,9\n")
    write(f"{logs}/.hidden", "9,9,9\n")
    assert rows(logtail.read_log(spark, logs, SCORES)) == [(1, 1, 1), (2, 2, 2), (3, 3, 3)]
    assert tail_on(spark, logs, folder) == [(1, 1, 1), (2, 2, 2), (3, 3, 3)]


def test_rolling_folder(spark, folder):
    logs, out = f"{folder}/logs", f"{folder}/out"
    os.mkdir(logs)
    write(f"{logs}/a.csv", "1,1,1\n2,2,2")
    for expected in (2, 3):
        runner.finish(runner.start_append(delimited.tail_folder(spark, logs, SCORES), out, f"{folder}/checkpoint"))
        assert spark.read.schema(SCORES).parquet(out).count() == expected
        write(f"{logs}/b.csv", "3,3,3\n")


def test_replaced_log_that_begins_alike(spark, folder):
    """A banner of more than the known beginning, then other lines: nothing of the new log may be lost."""
    path, banner = f"{folder}/a.log", "0,0,12345\n" * 120
    write(path, banner + "".join(f"{n},{n},1\n" for n in range(1, 4)))
    assert len(tail_on(spark, path, folder)) == 123
    write(path, banner + "".join(f"{n},{n},2\n" for n in range(900, 904)))
    with pytest.raises(Exception, match="other content"):
        tail_on(spark, path, folder)
    expected = tail_on(spark, path, folder, on_rotation="restart")
    assert [r for r in expected if r[0] >= 900] == [(n, n, 2) for n in range(900, 904)] and len(expected) == 123 + 124


def test_grown_log_is_read_on_behind_a_long_beginning(spark, folder):
    path, banner = f"{folder}/a.log", "0,0,12345\n" * 400
    write(path, banner)
    assert len(tail_on(spark, path, folder)) == 400
    write(path, banner + "7,7,7\n")
    assert len(tail_on(spark, path, folder)) == 401


def test_line_longer_than_many_blocks(folder, monkeypatch):
    monkeypatch.setattr(logtail, "BLOCK_BYTES", 7)
    write(f"{folder}/a.log", "1," + "x" * 500 + "\n2,y\n3," + "z" * 90)
    size = os.path.getsize(f"{folder}/a.log")
    for width in (50, 1000):
        parts = logtail._ranges(f"{folder}/a.log", 0, size, width)
        lines = [x.as_py() for p in parts for block in logtail._lines(f"{folder}/a.log", p) for x in block]
        assert lines == ["1," + "x" * 500, "2,y", "3," + "z" * 90]
