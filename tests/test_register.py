"""The six register datasets end to end, from seeded CSV exports to hooks."""

import json
from datetime import datetime, timezone

import pytest
import register as reg
from pyspark.sql import functions as F

from ledgerline import catalog
from ledgerline.functions.hooks import DEVELOPMENT, PRODUCTION
from ledgerline.operators import versions
from ledgerline.operators.checks import CheckError
from ledgerline.operators.flatten import Structure, flatten
from ledgerline.plans.loads import Ledger
from ledgerline.sources import log, metadata, raw, state, std
from ledgerline.spec import DatasetSpec, columns

NAMED = {"argvalues": reg.SPECS, "ids": [s.table for s in reg.SPECS]}


def instant(month):
    return datetime.strptime(reg.STAMPS[month], "%Y%m%d_%H%M")


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    """Every dataset, loaded in full mode."""
    ledger = Ledger(spark, str(tmp_path_factory.mktemp("full")))
    for spec in reg.SPECS:
        for month in reg.MONTHS:
            reg.export(ledger.root, spec, month)
        ledger.arrived(spec, "full", reg.raw_file(ledger.root, spec, 3))
        ledger.full_load(spec)
    return ledger


@pytest.fixture(scope="module")
def registry(spark):
    return metadata.build(metadata.catalog_tables(spark))


def hooks(registry, spec):
    return metadata.hooks_of(registry["hooks"], registry["datasets"], spec.code)


def numbers(spec, rows, *more):
    """Key numbers of rows, and further columns."""
    def text(value):
        return value.strftime("%d.%m.%Y") if hasattr(value, "strftime") else str(value)

    known = {tuple(reg.key_values(spec, n)[k] for k in spec.keys): n for n in range(reg.KEYS)}
    found = rows.select(*spec.keys, *more).collect()
    out = [(known[tuple(text(v) for v in r[: len(spec.keys)])], *r[len(spec.keys) :]) for r in found]
    assert len(out) == len(set(out))
    return set(out)


@pytest.mark.parametrize("spec", **NAMED)
def test_full_load(full, spec):
    rows = full.log(spec)
    for month in reg.MONTHS:
        own = rows.where(F.col("___Lake_load_timestamp") == F.lit(instant(month)))
        assert numbers(spec, own, "___Lake_isdeleted") == reg.added(spec, month)
    assert {n for n, in numbers(spec, full.latest(spec))} == reg.current(spec)
    assert full.status_of(spec).status == "lake"


@pytest.mark.parametrize("spec", **NAMED)
def test_incremental_equals_full(spark, full, tmp_path, spec):
    ledger, total = Ledger(spark, str(tmp_path)), 0
    for month in reg.MONTHS:
        assert ledger.incremental_load(spec, reg.export(ledger.root, spec, month))
        total += len(reg.added(spec, month))
        assert ledger.log(spec).count() == total
    names = [c for c in spec.log_schema.names if c != "___Lake_sourcefile" and c not in spec.volatile]
    ours, theirs = ledger.log(spec).select(*names), full.log(spec).select(*names)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    # The newest snapshot again, or an older one, adds nothing.
    log.load(spark, ledger.lake_root, ledger.std_root, spec, [reg.STAMPS[3]])
    assert log.load(spark, ledger.lake_root, ledger.std_root, spec, [reg.STAMPS[1]]) == []
    assert ledger.log(spec).count() == total


def test_raw_and_std_tell_where_rows_are_from(spark, full):
    spec = catalog.FIELD_OPERATOR_HST
    rows = raw.scan(spark, full.raw_root, spec)
    assert rows.count() == sum(len(reg.records(spec, m)) for m in reg.MONTHS)
    row = rows.where(F.col("___Raw_year_month") == reg.year_month(2)).first()
    assert row["___Raw_filename"].endswith(reg.raw_file(full.root, spec, 2)) and row["___Raw_file_timestamp"] == instant(2)
    view = std.view(spark, full.std_root, spec)
    assert view.columns[: len(spec.keys)] == list(spec.keys) and dict(view.dtypes)["fldOperatorFrom"] == "date"
    first = view.where(F.col("___Std_year_month") == reg.year_month(1)).first()
    assert first["___Std_filename"].endswith(
        f"/{spec.source}/{spec.table}/year_month={reg.year_month(1)}/{spec.code}_{reg.STAMPS[1]}.parquet"
    )


def test_text_survives(spark, full):
    spec = catalog.FIELD_DESCRIPTION
    want = {tuple(v for v in row.values() if "line" in v) for row in reg.records(spec, 3).values()}
    found = full.latest(spec).select(*[n for n in spec.names if dict(full.latest(spec).dtypes)[n] == "string"]).collect()
    assert any("\r\n" in v for row in want for v in row)
    assert {tuple(v for v in r if v and "line" in v) for r in found} == want


@pytest.mark.parametrize("spec", [catalog.FIELD, catalog.COMPANY], ids=["field", "company"])
def test_frame_versions(full, registry, spec):
    frame = full.frame(spec, hooks(registry, spec))
    assert versions.open_versions(spec, frame).isEmpty()
    fast, slow = full.latest(spec, hooks(registry, spec)), versions.latest_of_frame(frame)
    assert fast.columns == slow.columns
    assert fast.exceptAll(slow).isEmpty() and slow.exceptAll(fast).isEmpty()
    for month in reg.MONTHS:
        known = {n for n, in numbers(spec, full.as_of(spec, instant(month)))}
        assert known == reg.current(spec, month)
        assert known == {n for n, in numbers(spec, versions.as_of_frame(full.frame(spec), instant(month)))}
    ends = frame.groupBy(*spec.keys).agg(F.count("*").alias("n"), F.count("___Effective_To").alias("closed"))
    assert ends.where("closed <> n - 1").isEmpty()


@pytest.mark.parametrize("spec", **NAMED)
def test_hooks_of_the_registry(full, registry, spec):
    own = hooks(registry, spec)
    rows = full.latest(spec, own, PRODUCTION)
    assert rows.columns[: len(own)] == [h.column for h in own]
    for hook in own:
        digits = 16 if hook.encoding == "bigint" else 8
        want = F.concat(F.lit(bytes(hook.key_set_binary).hex().upper()), F.lpad(F.hex(F.expr(hook.expression_prod).cast("bigint")), digits, "0"))
        assert rows.where(~F.hex(F.col(hook.column)).eqNullSafe(want)).isEmpty()
    dev = full.latest(spec, own, DEVELOPMENT)
    want = F.concat(F.lit(own[0].key_set + "|"), F.expr(own[0].expression_dev).cast("string"))
    assert dev.where(~F.col(own[0].column).eqNullSafe(want)).isEmpty()


def test_views_do_not_depend_on_the_zone(spark, full, registry):
    spec = catalog.FIELD
    full.create_views(spec, hooks(registry, spec))
    count = len(reg.current(spec))
    assert spark.table(f"latest_{spec.code}").count() == count
    assert spark.table(f"frame_{spec.code}_dev").count() == full.log(spec).count()
    assert spark.table(f"raw_{spec.code}").count() == sum(len(reg.records(spec, m)) for m in reg.MONTHS)
    seconds = full.log(spec).select(F.unix_timestamp(F.min("___Lake_load_timestamp"))).first()[0]
    assert seconds == int(instant(1).replace(tzinfo=timezone.utc).timestamp())
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert spark.table(f"latest_{spec.code}").count() == count
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# What a bad export does


def std_fails(spark, tmp_path, spec, header, lines):
    path = reg.put(str(tmp_path), spec, 4, header, lines)
    with pytest.raises(Exception) as caught:
        std.standardize(spark, spec, f"{tmp_path}/std", path)
    assert std.scan(spark, f"{tmp_path}/std", spec).isEmpty()
    return caught.value


def spoilt(spec, name, value, month=1):
    """The lines of a month with *value* in one column of the last row."""
    lines = reg.lines(spec, month)
    lines[-1][spec.names.index(name)] = value
    return lines


def test_schema_drift(spark, tmp_path):
    spec = catalog.COMPANY_RESERVES
    header = ["Surplus" if n == "cmpShare" else n.swapcase() if n == "fldName" else n for n in spec.names]
    error = std_fails(spark, tmp_path, spec, header, reg.lines(spec, 1))
    assert "missing: cmpShare, fldName; unexpected: FLDnAME, Surplus" in str(error)


@pytest.mark.parametrize("flag", ["y", ""])
def test_bad_flag(spark, tmp_path, flag):
    spec = catalog.COMPANY
    error = std_fails(spark, tmp_path, spec, reg.header(spec), spoilt(spec, spec.flags[3], flag))
    assert isinstance(error, CheckError) and f"{spec.flags[3]}={flag or 'NULL'}" in str(error)
    assert error.total == 1 and spark.read.parquet(error.path).count() == 1


def test_empty_and_repeated_keys(spark, tmp_path):
    spec = catalog.FIELD_OPERATOR_HST
    error = std_fails(spark, tmp_path / "a", spec, reg.header(spec), spoilt(spec, "fldOperatorFrom", ""))
    assert isinstance(error, CheckError) and "Empty fldOperatorFrom in" in str(error)
    error = std_fails(spark, tmp_path / "b", spec, reg.header(spec), reg.lines(spec, 1) * 2)
    assert "Duplicate key in" in str(error) and error.total == len(reg.records(spec, 1))


@pytest.mark.parametrize(
    "spec, name, value, message",
    [
        (catalog.COMPANY_RESERVES, "cmpShare", "many", "CAST_INVALID_INPUT"),
        (catalog.FIELD, "wlbCompletionDate", "2030-12-24", "CANNOT_PARSE"),
    ],
)
def test_bad_values(spark, tmp_path, spec, name, value, message):
    assert message in str(std_fails(spark, tmp_path, spec, reg.header(spec), spoilt(spec, name, value)))


@pytest.mark.parametrize("cut", [-1, 1])
def test_row_of_the_wrong_length(spark, tmp_path, cut):
    spec = catalog.FIELD_PRODUCTION_MONTHLY
    lines = reg.lines(spec, 1)
    lines[0] = lines[0][:-1] if cut < 0 else [*lines[0], "9"]
    assert "MALFORMED" in str(std_fails(spark, tmp_path, spec, reg.header(spec), lines))


def test_bad_file_stops_after_the_older_ones(spark, tmp_path):
    spec, root = catalog.COMPANY_RESERVES, str(tmp_path)
    reg.export(root, spec, 1)
    reg.put(root, spec, 2, reg.header(spec), spoilt(spec, "cmpShare", "many", 2))
    reg.export(root, spec, 3)
    convert = lambda **more: std.standardize_all(spark, spec, f"{root}/raw", f"{root}/std", **more)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        convert()
    assert [r["snapshot"] for r in std.snapshots(spark, f"{root}/std", spec).collect()] == [reg.STAMPS[1]]
    reg.export(root, spec, 2)
    assert [convert(), convert(), convert(rebuild=True)] == [2, 0, 3]


def test_drifted_file_stops_after_the_older_ones(spark, tmp_path):
    spec, root = catalog.COMPANY, str(tmp_path)
    reg.export(root, spec, 1)
    reg.put(root, spec, 2, [*reg.header(spec), "extra"], [[*line, "x"] for line in reg.lines(spec, 2)])
    with pytest.raises(CheckError, match="unexpected: extra"):
        std.standardize_all(spark, spec, f"{root}/raw", f"{root}/std")
    assert std.snapshots(spark, f"{root}/std", spec).count() == 1


def test_negative_id_fails_the_production_frame(spark, tmp_path, registry):
    spec = catalog.FIELD
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.incremental_load(spec, reg.put(ledger.root, spec, 1, reg.header(spec), spoilt(spec, "fldNpdidField", "-5")))
    assert ledger.latest(spec, hooks(registry, spec), DEVELOPMENT).count() == len(reg.records(spec, 1))
    with pytest.raises(Exception, match="does not fit integer"):
        ledger.latest(spec, hooks(registry, spec), PRODUCTION).collect()


# Loads that break off, and loads that have nothing to say


@pytest.mark.parametrize("status, loads", [("raw", True), ("std", True), ("lake", False), ("ok", False)])
def test_a_load_goes_on_where_it_broke_off(spark, tmp_path, status, loads):
    spec = catalog.COMPANY_RESERVES
    ledger = Ledger(spark, str(tmp_path))
    path = reg.export(ledger.root, spec, 1)
    if status == "std":
        std.standardize(spark, spec, ledger.std_root, path)
    state.record(spark, ledger.root, state.LoadState(spec.source, spec.table, "incremental", raw_file=path).at(status))
    assert ledger.incremental_load(spec) is False
    assert ledger.log(spec).count() == (len(reg.added(spec, 1)) if loads else 0)
    assert ledger.status_of(spec).finished


def test_unchanged_export_is_not_loaded(spark, tmp_path):
    spec = catalog.FIELD
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.incremental_load(spec, reg.export(ledger.root, spec, 1))
    moved = [[("09.09.2031" if n in spec.volatile else v) for n, v in zip(spec.names, line)] for line in reversed(reg.lines(spec, 1))]
    assert not ledger.incremental_load(spec, reg.put(ledger.root, spec, 2, reg.header(spec), moved))
    assert ledger.incremental_load(spec, reg.export(ledger.root, spec, 2))


def test_one_failing_dataset_does_not_stop_the_others(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    good, bad = catalog.COMPANY, catalog.COMPANY_RESERVES
    arrived = {
        bad.code: reg.put(ledger.root, bad, 1, [*reg.header(bad), "more"], [[*x, ""] for x in reg.lines(bad, 1)]),
        good.code: reg.export(ledger.root, good, 1),
    }
    failed = ledger.load_all([bad, good], "incremental", arrived)
    assert len(failed) == 1 and failed[0].startswith(bad.code)
    assert ledger.log(good).count() == len(reg.added(good, 1))
    with pytest.raises(ValueError):
        ledger.load_all([good], "sometimes")


# A dataset that feeds two tables

WELLS = DatasetSpec("lab", "wells", columns("well string\ndepth bigint"), ("well",))
CORES = DatasetSpec("lab", "cores", columns("parent string\ncore bigint\nlength double"), ("parent", "core"))
TREE = Structure("wells", ("well",), ("depth",), {"cores": Structure("cores", ("core",), ("length",))})
RECORD = "well string, depth bigint, cores array<struct<core: bigint, length: double>>"


def split(spark, raw_file):
    return flatten(spark.read.schema(RECORD).json(raw_file), TREE)


@pytest.mark.parametrize("mode", ["full", "incremental"])
def test_nested_dataset_loads_all_its_tables(spark, tmp_path, mode):
    ledger = Ledger(spark, str(tmp_path), {WELLS.code: ((WELLS, CORES), split)})
    months = {
        1: [{"well": "w1", "depth": 10, "cores": [{"core": 1, "length": 0.5}, {"core": 2, "length": 1.5}]}, {"well": "w2", "depth": 5, "cores": []}],
        2: [{"well": "w1", "depth": 10, "cores": [{"core": 1, "length": 0.7}]}, {"well": "w2", "depth": 6, "cores": [{"core": 1, "length": 2.0}]}],
    }
    for month, records in months.items():
        path = tmp_path / f"raw/lab/wells/year_month={reg.year_month(month)}/wells_{reg.STAMPS[month]}.json"
        path.parent.mkdir(parents=True)
        path.write_text("\n".join(map(json.dumps, records)))
        if mode == "incremental":
            assert ledger.incremental_load(WELLS, str(path))
    if mode == "full":
        ledger.arrived(WELLS, "full", str(path))
        assert ledger.full_load(WELLS) == 2 and ledger._standardize_nested(WELLS, False) == 0
    rows = lambda spec, *names: sorted(tuple(r) for r in ledger.log(spec).select(*names, "___Lake_isdeleted").collect())
    assert rows(WELLS, "well", "depth") == [("w1", 10, False), ("w2", 5, False), ("w2", 6, False)]
    assert rows(CORES, "parent", "core", "length") == [
        ("w1", 1, 0.5, False), ("w1", 1, 0.7, False), ("w1", 2, 1.5, False), ("w1", 2, 1.5, True), ("w2", 1, 2.0, False)
    ]
    assert ledger.status_of(WELLS).status == "lake"
