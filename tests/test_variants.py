"""Flattening of records whose structure is found in the data."""

import pytest

from ledgerline.operators.flatten import Structure, flatten, parse_json
from ledgerline.operators.variants import flatten_undeclared, found_shape, structure_drift, unread


def texts(spark, *records):
    return spark.createDataFrame(list(enumerate(records)), "id int, record string")


def tables(rows, own_keys=None):
    found = flatten_undeclared(rows, ("id",), "record", found_shape(rows, "record", "t"), own_keys)
    return {name: sorted((tuple(r) for r in df.collect()), key=repr) for name, df in found.items()}


def test_objects_arrays_and_mixed_fields(spark):
    rows = texts(
        spark,
        '{"a": 1, "in": {"x y": "u", "OBJECT<": true}, "m": 1, "list": [{"p": 1}, null, {"p": 2.5, "q": [3, 4]}]}',
        ' {"a": null, "m": {"z": 1}, "none": null, "list": []}',
        '{"m": null}',
        None,
        "[1]",
        "{broken",
    )
    found = flatten_undeclared(rows, ("id",), "record", found_shape(rows, "record", "t"))
    assert found["t"].columns == ["id", "a", "in.OBJECT<", "in.x y", "m", "none"]
    got = tables(rows)
    empty = (None,) * 5
    assert got["t"] == [(0, 1, True, "u", "1", None), (1, None, None, None, '{"z":1}', None), (2, *empty), (3, *empty), (4, *empty), (5, *empty)]
    assert [(r[0], r[1], None if r[2] is None else float(r[2])) for r in got["t_list"]] == [("0", 0, 1.0), ("0", 1, None), ("0", 2, 2.5)]
    assert got["t_list_q"] == [("0\x1f2", 0, 3), ("0\x1f2", 1, 4)]
    assert unread(rows, "record") == 2


def test_arrays_of_arrays(spark):
    got = tables(texts(spark, '{"m": [[1, 2], [], [3]]}'))
    assert got["t_m"] == [("0", 0), ("0", 1), ("0", 2)]
    assert got["t_m_value"] == [("0\x1f0", 0, 1), ("0\x1f0", 1, 2), ("0\x1f2", 0, 3)]


def test_named_keys_give_what_a_declared_structure_gives(spark):
    rows = texts(spark, '{"wells": [{"well": "A", "depth": 5, "cores": [{"core": 1}, {"core": 2}]}, {"well": "B", "depth": null, "cores": null}]}')
    top = Structure("t", ("id",), (), {"wells": Structure("t_wells", ("well",), ("depth",), {"cores": Structure("t_wells_cores", ("core",))})})
    schema = "wells array<struct<well: string, depth: bigint, cores: array<struct<core: bigint>>>>"
    want = flatten(parse_json(rows, "record", schema, ("id",)), top)
    got = tables(rows, {"t_wells": ("well",), "t_wells_cores": ("core",)})
    assert got == {name: sorted((tuple(r) for r in df.collect()), key=repr) for name, df in want.items()}
    with pytest.raises(ValueError, match="no scalar fields"):
        tables(rows, {"t_wells": ("cores",)})


def test_nothing_and_names_that_clash(spark):
    assert tables(texts(spark, None)) == {"t": [(0,)]}
    nothing = texts(spark, None).limit(0)
    assert tables(nothing) == {"t": []}
    with pytest.raises(ValueError, match="differ in case only"):
        tables(texts(spark, '{"a": 1, "A": 2}'))


def test_tables_read_their_own_fields_only(spark):
    rows = texts(spark, '{"long": "text", "list": [{"p": 1, "q": "more"}]}')
    found = flatten_undeclared(rows, ("id",), "record", found_shape(rows, "record", "t"))
    plan = found["t_list"].select("parent", "p")._jdf.queryExecution().optimizedPlan().toString()
    assert "long" not in plan


def test_drift_of_groups(spark):
    rows = spark.createDataFrame(
        [("a", '{"x": 1, "l": [1]}'), ("a", '{"y": 1}'), ("b", '{"x": 2}'), ("c", None)], "g string, record string"
    )
    got = dict(structure_drift(rows, "g", "record", "t", {"t": ("x", "y")}).collect())
    assert got == {"a": "unexpected: t_l.value", "b": "missing: t.y", "c": "missing: t.x, t.y"}
