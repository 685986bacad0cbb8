"""A nested raw file is parsed once, whatever reads its tables afterwards."""

import json

import pytest
from test_register import CORES, TREE, WELLS, split

from ledgerline.operators import checks
from ledgerline.operators.flatten import flatten
from ledgerline.plans.layer_queries import split_events
from ledgerline.plans.loads import Ledger
from ledgerline.sources import log, std
from ledgerline.spec import DatasetSpec, columns


def test_split_tables_do_not_read_the_raw_file_again(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text(json.dumps({"event_id": 1, "event_type": "x", "k": 2, "marks": [{"mark": "a", "weight": 1, "notes": [{"note": 1}, {"note": 2}]}]}))
    tables = split_events(spark, str(path))
    path.write_text("no record any more")
    assert {name: rows.count() for name, rows in tables.items()} == {"events": 1, "events_marks": 1, "events_marks_notes": 2}


def test_a_new_file_is_split_once(spark, tmp_path):
    asked = []
    ledger = Ledger(spark, str(tmp_path), {WELLS.code: ((WELLS, CORES), lambda s, path: asked.append(path) or split(s, path))})
    paths = []
    for month, depth in ((1, 10), (2, 11), (3, 11)):
        path = tmp_path / f"raw/lab/wells/year_month=2030-0{month}/wells_20300{month}01_0900.json"
        path.parent.mkdir(parents=True)
        path.write_text(json.dumps({"well": "w1", "depth": depth, "cores": [{"core": 1, "length": 0.5}]}))
        paths.append(str(path))
    assert [ledger.incremental_load(WELLS, path) for path in paths] == [True, True, False]
    assert sorted(asked) == [paths[0], paths[0], paths[1], paths[1], paths[2]]  # each once as the new and once as the latest file
    assert sorted((r["well"], r["depth"]) for r in log.read(spark, ledger.lake_root, WELLS).collect()) == [("w1", 10), ("w1", 11)]


def test_a_key_twice_is_named_and_not_published(spark, tmp_path):
    schema = "well string, depth bigint, cores array<struct<core: bigint, length: double>>"
    records = [("w1", 1, [(1, 0.5), (1, 0.5), (2, 0.1)]), ("w2", 2, [(1, 0.5)])]
    tables = flatten(spark.createDataFrame(records, schema), TREE)
    file = "raw/lab/cores/year_month=2030-01/cores_20300101_0900.json"
    std.publish(WELLS, tables["wells"], str(tmp_path), file)
    with pytest.raises(checks.CheckError, match="w1/1"):
        std.publish(CORES, tables["cores"], str(tmp_path), file)
    assert std.scan(spark, str(tmp_path), WELLS).count() == 2 and std.scan(spark, str(tmp_path), CORES).count() == 0


def test_keys_of_one_hash_are_not_taken_for_equal(spark, tmp_path):
    """NULLs leave a hash as it is, so these two keys share theirs."""
    rows = spark.createDataFrame([(None, "a"), ("a", None)], "parent string, mark string")
    spec = DatasetSpec("star", "t", columns("parent string\nmark string"), ("parent", "mark"))
    checks.check_unique(spec, rows, "f", str(tmp_path))
