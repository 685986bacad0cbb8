"""Quoted text in raw files: kept to the byte, split wherever a split may fall."""

import csv
import io
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.sources import quoted, raw

PIECES = ["a", "é", ",", '"', "\n", "\r\n", "\r", " ", "word", '","', '\n"', "x\n\ny", '""']


def table(seed, rows=60, columns=3):
    rng = random.Random(seed)

    def value():
        return "".join(rng.choice(PIECES) for _ in range(rng.randrange(6)))

    return [[str(i), *[value() for _ in range(columns - 1)]] for i in range(rows)]


def text_of(rows, end, bom=False, quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=quoting)
    writer.writerows(rows)
    return ("\ufeff" if bom else "") + out.getvalue()


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "307b", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def read(spark, paths, names, **more):
    rows = raw.read_files(spark, paths, names, **more).select(*[F.col(f"`{n}`") for n in names])
    return sorted(tuple(v or "" for v in r) for r in rows.collect())


@pytest.mark.parametrize("seed", range(4))
def test_splits_may_fall_anywhere(spark, tmp_path, small_splits, seed):
    end = ["\n", "\r\n"][seed % 2]
    rows = [["id", "one", "two"], *table(seed, 150)]
    path = tmp_path / "year_month=2030-01" / "t_20300101_0900.csv"
    path.parent.mkdir()
    path.write_bytes(text_of(rows, end, bom=seed > 1).encode())
    assert read(spark, [str(path)], ("id", "one", "two"), multiline=True) == sorted(map(tuple, rows[1:]))
    found = raw.read_files(spark, [str(path)], ("id", "one", "two"))
    row = found.first()
    assert row["___Raw_year_month"] == "2030-01" and row["___Raw_filename"].endswith("t_20300101_0900.csv")
    lines = spark.read.option("lineSep", "\n").text(str(path))
    assert lines.rdd.getNumPartitions() > 8


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_text_of_whole_files_is_kept_to_the_byte(spark, tmp_path, end):
    rows = [["id", "first\nline", "two"], *table(20), ["x", "CR LF \r\n inside", "ends with\r\n"]]
    path = tmp_path / "a.csv"
    path.write_bytes(text_of(rows, end).encode())
    names = raw.header(spark, str(path))
    assert names == ("id", "first\nline", "two")
    assert read(spark, [str(path)], names) == sorted(map(tuple, rows[1:]))


def test_a_value_over_many_splits_and_a_file_without_quotes_at_its_end(spark, tmp_path, small_splits):
    long = "line of a long value, with commas\r\n" * 60 + '"'
    rows = [["id", "text"], ["1", "x"], ["2", long], ["3", "y\nz"], *[[str(i), "plain"] for i in range(4, 60)], ["60", long], ["61", "\n"]]
    path = tmp_path / "long.csv"
    path.write_bytes(text_of(rows, "\n").encode())
    assert read(spark, [str(path)], ("id", "text")) == sorted(map(tuple, rows[1:]))


def test_stray_quotes_open_nothing(spark, tmp_path, small_splits):
    path = tmp_path / "stray.csv"
    path.write_text('id,text\n1,5" pipe\n2,"two\nlines"\n3,a"b"c\n' + "4,plain\n" * 30 + '5,"x ""quoted"" y\n"\n')
    found = read(spark, [str(path)], ("id", "text"), multiline=True)
    assert found == sorted([("1", '5" pipe'), ("2", "two\nlines"), ("3", 'a"b"c'), *[("4", "plain")] * 30, ("5", 'x "quoted" y\n')])


def test_the_same_as_another_reader(spark, tmp_path, small_splits):
    rows = [["id", "one", "two"], *table(77, 200)]
    path = tmp_path / "d.csv"
    path.write_bytes(text_of(rows, "\r\n", quoting=csv.QUOTE_ALL).encode())
    con = duckdb.connect()
    sql = f"SELECT id, one, two FROM read_csv('{path}', all_varchar=true, header=true, delim=',', quote='\"', escape='\"', strict_mode=false, nullstr='\x01')"
    want = sorted(tuple(v or "" for v in r) for r in con.execute(sql).fetchall())
    assert read(spark, [str(path)], ("id", "one", "two"), multiline=True) == want


def test_a_row_with_too_many_values_fails_a_strict_read(spark, tmp_path, small_splits):
    path = tmp_path / "year_month=2030-01" / "bad_20300101_0900.csv"
    path.parent.mkdir()
    path.write_text('id,text\n' + '1,"a\nb"\n' * 30 + '2,"c\nd",more\n')
    with pytest.raises(Exception, match="MALFORMED"):
        raw.read_files(spark, [str(path)], ("id", "text"), True).collect()
    assert ("2", "c\nd") in read(spark, [str(path)], ("id", "text"), multiline=True, strict=False)


def test_heads_read_no_body(spark, tmp_path, monkeypatch):
    asked = []
    original = raw.head_of
    monkeypatch.setattr(raw, "head_of", lambda s, path, size: asked.append(size) or original(s, path, size))
    monkeypatch.setattr(raw, "HEAD_BYTES", 32)
    body = "1,2\n" * 50_000
    (tmp_path / "short.csv").write_text("a,b\n" + body)
    (tmp_path / "wide.csv").write_text(",".join(f"c{i}" for i in range(30)) + "\n" + body)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b")
    (tmp_path / "parts.csv").mkdir()
    (tmp_path / "parts.csv" / "part-0.csv").write_text("")
    (tmp_path / "parts.csv" / "part-1.csv").write_bytes(b"\xef\xbb\xbfx,y\r\n1,2\r\n")
    (tmp_path / "parts.csv" / "_SUCCESS").write_text("")
    paths = {n: str(tmp_path / f"{n}.csv") for n in ("short", "wide", "empty", "header", "parts")}
    found = raw.heads(spark, list(paths.values()))
    assert found[paths["short"]].names == ("a", "b") and found[paths["short"]].line_end == "\n"
    assert len(found[paths["wide"]].names) == 30
    assert found[paths["empty"]].names == () and found[paths["header"]].names == ("a", "b")
    assert found[paths["parts"]].names == ("x", "y") and found[paths["parts"]].line_end == "\r\n"
    assert max(asked) <= 256


@pytest.mark.parametrize("line, outside, inside", [("", False, True), ('a,"b', True, False), ('"', True, False), ('"a"', False, False), ('a","b', True, True), ('x"', False, False), ('""', False, True), ('"""', True, False), ('a""b', False, True)])
def test_states_of_a_line(line, outside, inside):
    assert quoted.ends_inside(line, False) is outside and quoted.ends_inside(line, True) is inside


def test_records_inside_a_split_are_not_written(spark, tmp_path, small_splits, monkeypatch):
    """Only what an end of a split cuts is kept; the rest is read again in the same splits, whatever the session says then."""
    rows = [["id", "text"], *[[str(i), f'say "{i}"\r\n, twice'] for i in range(400)]]
    path = tmp_path / "t.csv"
    path.write_bytes(text_of(rows, "\n").encode())
    kept = str(tmp_path / "kept")
    monkeypatch.setattr(quoted, "work_folder", lambda s, purpose: kept)
    found = raw.read_split(spark, [str(path)], ("id", "text"))
    pieces = spark.read.parquet(f"{kept}/pieces").where(F.col("kind") != quoted.END)
    assert pieces.where(F.col("kind") == quoted.WHOLE).isEmpty()
    assert found.sparkSession is spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    assert sorted(tuple(r) for r in found.select("id", "text").collect()) == sorted(map(tuple, rows[1:]))


def test_a_split_that_was_not_read_before_fails():
    batch = quoted.pa.RecordBatch.from_pydict({"path": ["p"], "block": [307], "state": quoted.pa.array([None], quoted.pa.int32()), "value": ["a,b"]})
    with pytest.raises(ValueError, match="307"):
        list(quoted._whole(iter([batch])))
