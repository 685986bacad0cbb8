"""Text rendering, snapshot equality, raw reading, joins, flattening, state, stream."""

import csv
import math
import re
import struct

import duckdb
import pytest
import register as reg
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline import catalog
from ledgerline.functions.digest import double_text
from ledgerline.operators import checks
from ledgerline.operators.changes import full_replay
from ledgerline.operators.equality import fingerprint, row_differences, same_bytes, same_rows
from ledgerline.operators.flatten import Structure, flatten, parse_json
from ledgerline.operators.joins import hook_join, hot_values
from ledgerline.plans import quality_queries  # noqa: F401
from ledgerline.plans.registry import QUERIES
from ledgerline.sources import log, raw, state, std
from ledgerline.streaming.continuous import continuous_load


# Text of doubles


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(), min_size=200, max_size=200))
def test_double_text_reads_back(spark, values):
    values = values + [0.0, -0.0, 1e7, 1e16, 1e-3, 1e-4, 1e-5, 9999999.999, 123456789.125, math.inf, -math.inf, math.nan]
    got = [r["t"] for r in spark.createDataFrame([(v,) for v in values], "v double").select(double_text(F.col("v")).alias("t")).collect()]
    expected = [r[0] for r in duckdb.connect().execute("SELECT unnest($1::DOUBLE[])::VARCHAR", [values]).fetchall()]
    for value, text, shortest in zip(values, got, expected, strict=True):
        if math.isnan(value):
            assert text == "nan"
            continue
        assert struct.pack("d", float(text)) == struct.pack("d", value)
        # the JVM may print more digits than needed, never another format
        if len(text) == len(shortest):
            assert text == shortest


def test_double_text_format(spark):
    values = [0.5, 1.0, 1e7, 12345678.9, 1e15, 1e16, 1.5e20, 1e100, 1e-3, 1e-4, 1.25e-7, 1e-5, -3.0, 0.00012]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(double_text(F.col("v")).alias("t"))
    expected = [r[0] for r in duckdb.connect().execute("SELECT unnest($1::DOUBLE[])::VARCHAR", [values]).fetchall()]
    assert [r["t"] for r in df.collect()] == expected


# Snapshot equality


def test_same_rows(spark):
    schema = "a string, b string, stamp string"
    old = spark.createDataFrame([("1", "x", "m"), ("2", None, "m"), ("2", None, "m")], schema)
    assert same_rows(old, spark.createDataFrame([("2", "", "n"), ("1", "x", "n"), ("2", None, "o")], schema), ["stamp"])
    assert not same_rows(old, spark.createDataFrame([("1", "x", "m"), ("2", None, "m")], schema), ["stamp"])
    assert not same_rows(old, spark.createDataFrame([("1", "y", "m"), ("2", None, "m"), ("2", None, "m")], schema), ["stamp"])
    assert not same_rows(old, old.select("b", "a", "stamp"), ["stamp"])
    assert not same_rows(old, old.withColumn("c", F.lit("1")), ["stamp"])
    assert fingerprint(old, ["stamp"]) == fingerprint(old.orderBy(F.desc("a")), ["stamp"])
    with pytest.raises(ValueError):
        row_differences(old, old.select("b", "a", "stamp"))


def test_row_differences_see_the_text(spark, tmp_path):
    rows = [(0, "one", "en", "s", 3), (1, "two", "en", "s", 3), (2, "same", "en", "s", 4), (3, "same", "en", "s", 4)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["snapshot_row_differences"](spark, str(tmp_path)).collect()
    assert sorted((r.text, r.surplus) for r in found) == [("one", 1), ("two", -1)]


def test_same_bytes(spark, tmp_path):
    contents = {"a": b"x,y\n1,2\n3,4\n", "same": b"x,y\n1,2\n3,4\n", "order": b"x,y\n3,4\n1,2\n", "value": b"x,y\n1,2\n3,5\n",
                "long": b"x,y\n1,2\n3,4\n\n", "crlf": b"x,y\r1,2\n3,4\n"}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    same = {n for n in contents if same_bytes(spark, str(tmp_path / "a"), str(tmp_path / n))}
    assert same == {"a", "same"}


# Raw reading


def test_quoted_line_breaks_are_found(spark, tmp_path):
    spec, root = catalog.FIELD_OPERATOR_HST, str(tmp_path)
    at = spec.names.index("cmpLongName")
    one, three = ([[*x[:at], f"Firm {i}", *x[at + 1:]] for i, x in enumerate(reg.lines(spec, m))] for m in (1, 3))
    two = [[*x[:at], f'Firm\r\n{i} "A"', *x[at + 1:]] for i, x in enumerate(reg.lines(spec, 2))]
    files = [reg.put(root, spec, m, reg.header(spec), x) for m, x in zip(reg.MONTHS, (one, two, three))]
    assert raw.with_quoted_line_breaks(spark, [files[0], files[2]]) == []
    assert raw.with_quoted_line_breaks(spark, files) == [files[1]]
    assert raw.headers(spark, files) == dict.fromkeys(files, spec.names)
    rows = raw.read_files(spark, files, spec.names)
    found = sorted(r["cmpLongName"].replace("\r", "") for r in rows.collect())
    assert found == sorted(x[at].replace("\r", "") for x in one + two + three)


def test_columns_are_united_by_name(spark, tmp_path):
    spec, root = catalog.COMPANY_RESERVES, str(tmp_path)
    reg.export(root, spec, 1)
    turned = [x[::-1] + [""] for x in reg.lines(spec, 2)]
    reg.put(root, spec, 2, reg.header(spec)[::-1] + ["extra"], turned)
    rows = raw.scan(spark, f"{root}/raw", spec)
    want = sorted(tuple(v or None for v in x) for m in (1, 2) for x in reg.lines(spec, m))
    assert sorted(tuple(r) for r in rows.select(*spec.names).collect()) == want
    assert rows.where("extra is not null").isEmpty()
    assert rows.columns[-3:] == ["___Raw_filename", "___Raw_year_month", "___Raw_file_timestamp"]


def test_snapshot_as_a_folder_of_parts(spark, tmp_path):
    spec, root = catalog.COMPANY_RESERVES, str(tmp_path)
    whole = reg.raw_file(root, spec, 1)
    for i, line in enumerate(reg.lines(spec, 1)):
        part = tmp_path / whole.removeprefix(root + "/") / f"part-{i}.csv"
        part.parent.mkdir(parents=True, exist_ok=True)
        with part.open("w", encoding="utf-8", newline="") as out:
            csv.writer(out).writerows([reg.header(spec), line])
    files = raw.snapshot_files(spark, f"{root}/raw", spec).collect()
    assert [f["file"].endswith(whole) for f in files] == [True]
    assert std.standardize_all(spark, spec, f"{root}/raw", f"{root}/std") == 1
    assert std.scan(spark, f"{root}/std", spec).count() == len(reg.lines(spec, 1))


def test_latest_period(spark):
    schema = "y string, m string"
    rows = spark.createDataFrame([("2025", "12"), ("2026", "7"), ("2026", "3"), (None, ""), ("x", "9"), ("2027", None)], schema)
    assert raw.latest_period(rows, "y", "m").first()["latest_period"] == "2026-07"
    assert raw.latest_period(rows.limit(0), "y", "m").first()["latest_period"] is None


def test_std_path_needs_month_and_stamp(spark):
    good = "x/year_month=2026-09/t_20260929_1000.csv"
    df = spark.createDataFrame([(good,)], "p string")
    assert df.select(std.std_path("r", "s", "doc_wells", F.col("p")).alias("q")).first()["q"] == (
        "r/s/doc_wells/year_month=2026-09/s_doc_wells_20260929_1000.parquet"
    )
    with pytest.raises(Exception, match="Not a Raw file path"):
        spark.createDataFrame([("s/t/no_partition.csv",)], "p string").select(std.std_path("r", "s", "t", F.col("p"))).collect()


# Checks


def test_violations_are_kept_whole(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("flag"))
    wrong = checks.domain_violations(rows, ["flag"], ["Y", "N"])
    found = checks.listed(wrong, "value", str(tmp_path))
    assert found.total == 5000 and found.path.startswith(f"{tmp_path}/_violations/")
    assert {r[0] for r in spark.read.parquet(found.path).collect()} == {str(i) for i in range(5000)}
    assert found.text.startswith("0, 1, 10, ") and "5000 in all" in found.text
    assert checks.listed(wrong.where("false"), "value") is None


@pytest.mark.parametrize("value, wrong", [("abc", 0), ("abc\n", 1), ("\nabc", 1), ("ab", 1), (None, 1)])
def test_a_pattern_matches_the_whole_value(spark, value, wrong):
    rows = spark.createDataFrame([(value,)], "code string")
    assert checks.pattern_violations(rows, "code", "[a-z]{3}").count() == wrong


def test_schema_drift_text():
    assert checks.schema_drift(["a", "b"], ["b", "a"]) is None
    assert checks.schema_drift(["b", "a", "Z"], ["z", "b"]) == "missing: Z, a; unexpected: z"


# Hook join


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hook_join_with_hot_and_missing_hooks(spark, how):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 50).alias("h")
    )
    right = spark.range(40).select(F.col("id").alias("h2"), F.concat(F.lit("n"), "id").alias("name")).unionByName(
        spark.createDataFrame([(None, "none"), (7, "again")], "h2 bigint, name string")
    )
    hot = hot_values(left, "h")
    assert [tuple(r) for r in hot.collect()] == [(7, 2)]
    for values in (None, hot):
        got = hook_join(left, right, "h", how, right_hook="h2", hot=values)
        assert got.columns == ["id", "h", "h2", "name"]
        plain = left.join(right, left["h"] == right["h2"], how)
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    with pytest.raises(ValueError):
        hook_join(left, right, "h", "full", right_hook="h2")


# Nested records


def test_flatten(spark):
    text = (
        '{"country": "NO", "year": 2026, "fields": [{"field": "A", "oil": 1.5, "wells": [{"well": 1}, {"well": 2}]},'
        ' {"field": "B", "oil": null, "wells": []}], "notes": null}'
    )
    schema = (
        "country string, year int, notes array<struct<n: int>>, "
        "fields array<struct<field: string, oil: double, wells: array<struct<well: int>>>>"
    )
    rows = parse_json(spark.createDataFrame([(text,)], "doc string"), "doc", schema)
    top = Structure("doc", ("country", "year"), (), {
        "fields": Structure("doc_fields", ("field",), ("oil",), {"wells": Structure("doc_wells", ("well",))}),
        "notes": Structure("doc_notes", ("n",)),
    })
    tables = flatten(rows, top)
    assert [tuple(r) for r in tables["doc"].collect()] == [("NO", 2026)]
    assert sorted(tuple(r) for r in tables["doc_fields"].collect()) == [("NO\x1f2026", "A", 1.5), ("NO\x1f2026", "B", None)]
    assert sorted(tuple(r) for r in tables["doc_wells"].collect()) == [("NO\x1f2026\x1fA", 1), ("NO\x1f2026\x1fA", 2)]
    assert tables["doc_notes"].isEmpty()
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse_json(spark.createDataFrame([("{",)], "doc string"), "doc", schema).collect()


# Load state


def test_load_state(spark, tmp_path):
    root = str(tmp_path)
    blank = state.of(spark, root, "lab", "one")
    assert blank == state.LoadState("lab", "one") and blank.finished
    first = state.LoadState("lab", "one", "full", "2031-04", raw_file="f1")
    for now in (first.at("raw"), first.at("std"), state.LoadState("lab", "two").at("ok")):
        state.record(spark, root, now)
    assert state.of(spark, root, "lab", "one") == first.at("std") and not first.at("std").finished
    latest = state.latest_state(state.read(spark, root))
    assert sorted((r["dataset"], r["status"]) for r in latest.collect()) == [("one", "std"), ("two", "ok")]
    with pytest.raises(ValueError, match="no load can be at"):
        state.record(spark, root, first.at("gone"))


# Stream


def test_stream_equals_batch_and_survives_a_rerun(spark, tmp_path):
    spec, root = catalog.COMPANY_RESERVES, str(tmp_path)
    names = [n for n in spec.log_schema.names if n not in spec.volatile]

    def run(checkpoint):
        continuous_load(spark, spec, f"{root}/std", f"{root}/lake", checkpoint).awaitTermination()
        return log.read(spark, f"{root}/lake", spec)

    reg.export(root, spec, 1)
    reg.export(root, spec, 2)
    std.standardize_all(spark, spec, f"{root}/raw", f"{root}/std")
    sizes = {m: sum(len(reg.added(spec, k)) for k in range(1, m + 1)) for m in reg.MONTHS}
    assert run(f"{root}/checkpoint").count() == sizes[2]
    reg.export(root, spec, 3)
    std.standardize_all(spark, spec, f"{root}/raw", f"{root}/std")
    got = run(f"{root}/checkpoint")
    assert got.count() == sizes[3]
    log.rebuild(spark, f"{root}/full", f"{root}/std", spec)
    full = log.read(spark, f"{root}/full", spec)
    assert got.select(*names).exceptAll(full.select(*names)).isEmpty()
    assert run(f"{root}/checkpoint").count() == sizes[3]
    # a lost checkpoint announces everything again and changes nothing
    assert run(f"{root}/checkpoint-2").count() == sizes[3]


def test_reloading_a_replaced_snapshot_rewrites_its_partition(spark, tmp_path):
    spec, root = catalog.COMPANY_RESERVES, str(tmp_path)
    first, second = reg.export(root, spec, 1), reg.export(root, spec, 2)
    for path, stamp in ((first, reg.STAMPS[1]), (second, reg.STAMPS[2])):
        std.standardize(spark, spec, f"{root}/std", path)
        log.load(spark, f"{root}/lake", f"{root}/std", spec, [stamp])
    assert log.read(spark, f"{root}/lake", spec).count() == len(reg.added(spec, 1)) + len(reg.added(spec, 2))
    same = reg.put(root, spec, 2, reg.header(spec), reg.lines(spec, 1))
    std.standardize(spark, spec, f"{root}/std", same)
    log.load(spark, f"{root}/lake", f"{root}/std", spec, [reg.STAMPS[2]])
    assert log.read(spark, f"{root}/lake", spec).count() == len(reg.added(spec, 1))


def test_rebuild_switches_versions(spark, tmp_path):
    spec, root = catalog.COMPANY_RESERVES, str(tmp_path)
    std.standardize(spark, spec, f"{root}/std", reg.export(root, spec, 1))
    for _ in range(3):
        log.rebuild(spark, f"{root}/lake", f"{root}/std", spec)
    assert log.versions(spark, f"{root}/lake", spec) == [2, 3]
    # a rebuild that broke off is not read, and the next one takes it away
    (tmp_path / log.version_folder("lake", spec, 4) / "snapshot=20310417_0645").mkdir(parents=True)
    assert log.current_version(spark, f"{root}/lake", spec) == 3
    assert log.read(spark, f"{root}/lake", spec).count() == len(reg.added(spec, 1))
    log.rebuild(spark, f"{root}/lake", f"{root}/std", spec)
    assert log.versions(spark, f"{root}/lake", spec) == [3, 5]


# Catalog tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_need_no_shuffle(spark, tmp_path):
    from ledgerline.sources import tables

    spec, root = catalog.FIELD_OPERATOR_HST, str(tmp_path)
    for month in (1, 2, 3):
        reg.export(root, spec, month)
    std.standardize_all(spark, spec, f"{root}/raw", f"{root}/std")
    log.rebuild(spark, f"{root}/lake", f"{root}/std", spec)
    full = log.read(spark, f"{root}/lake", spec)

    tables.create_schema(spark, "ledger")
    for _ in range(2):  # creating again changes nothing
        tables.create_std(spark, "ledger.std_hst", spec, 4, f"{root}/tables/std")
        tables.create_log(spark, "ledger.log_hst", spec, 4, f"{root}/tables/log")
    tables.write_clustered(std.scan(spark, f"{root}/std", spec), "ledger.std_hst", spec.keys, 4)
    broadcast, spark_conf = "spark.sql.autoBroadcastJoinThreshold", spark.conf
    before = spark_conf.get(broadcast)
    spark_conf.set(broadcast, "-1")  # no table counts as small
    try:
        replayed = tables.replay_table(spark, "ledger.std_hst", f"{root}/std", spec)
        assert "Exchange hashpartitioning" not in plan(replayed) and "SortMergeJoin" not in plan(replayed)
        from_files = full_replay(spec, std.scan(spark, f"{root}/std", spec), std.snapshots(spark, f"{root}/std", spec), std.BY)
        keyed = ", ".join(f"{k}#\\d+L?" for k in spec.keys)
        assert re.findall(r"Exchange hashpartitioning\(", plan(from_files)) == ["Exchange hashpartitioning("]
        assert re.search(rf"Exchange hashpartitioning\({keyed}, ", plan(from_files))
        assert replayed.exceptAll(full).isEmpty() and full.exceptAll(replayed).isEmpty()
        for month in reg.MONTHS:
            step = tables.step_table(spark, "ledger.std_hst", "ledger.log_hst", f"{root}/std", spec, reg.STAMPS[month])
            assert "Exchange hashpartitioning" not in plan(step)
            assert step.count() == len(reg.added(spec, month))
            tables.write_log(step, "ledger.log_hst", spec, 4)
        assert tables.step_table(spark, "ledger.std_hst", "ledger.log_hst", f"{root}/std", spec, reg.STAMPS[1]).isEmpty()
        assert tables.step_table(spark, "ledger.std_hst", "ledger.log_hst", f"{root}/std", spec, "20990101_1000").isEmpty()
        # deletions repeat the last log row here and the last observation there: volatile columns differ
        got = spark.table("ledger.log_hst").drop("snapshot", *spec.volatile)
        assert got.exceptAll(full.select(*got.columns)).isEmpty() and got.count() == full.count()
    finally:
        spark_conf.set(broadcast, before)
        spark.sql("DROP SCHEMA ledger CASCADE")
