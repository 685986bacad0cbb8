"""Flattening of nested records whose structure is not declared.

One aggregate over all records finds their common structure. Each table of it is then read with a
schema of its own that holds no field but those it needs.

* Fields of an inner object are columns of the row that holds it, named ``outer.inner``.
* An array is a table of its own, named after its parent and field: ``parent``, its key, and the
  fields of its objects, or ``value`` if it holds none. The key is ``position`` (from 0) unless
  fields are named for it.
* A field that holds values of several kinds is JSON text; one that is always null is null text.

Records that are null or no JSON object have a row in the top table, all of whose fields are null;
``unread`` counts them. Names that differ in case only are refused, since columns cannot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.checks import column_drift
from ledgerline.operators.flatten import PARENT, key_text

POSITION, VALUE = "position", "value"


@dataclass(frozen=True)
class Shape:
    """A table that was found: where it lies below its parent's records, its columns, its children."""

    name: str
    path: tuple[str, ...]
    element: T.DataType
    columns: dict[tuple[str, ...], T.DataType] = field(default_factory=dict)
    children: tuple[Shape, ...] = ()

    def tables(self) -> Iterator[Shape]:
        yield self
        for child in self.children:
            yield from child.tables()


def _record(column: str) -> Column:
    """The JSON object in a text column, or null."""
    return F.when(F.col(column).rlike(r"^\s*\{"), F.try_parse_json(F.col(column)))


def shape_of(name: str, found: str) -> Shape:
    """The tables of a structure as ``schema_of_variant_agg`` words it."""
    record = T.DataType.fromDDL(_as_struct(found))
    return _shape(name, (), record if isinstance(record, T.StructType) else T.StructType([]))  # void without a record


def _as_struct(found: str) -> str:
    """The same type with objects as structs; quoted names are left alone."""
    parts = found.split("`")
    parts[::2] = [p.replace("OBJECT<", "STRUCT<") for p in parts[::2]]
    return "`".join(parts)


def _shape(name: str, path: tuple[str, ...], element: T.DataType) -> Shape:
    columns, arrays = {}, {}

    def walk(kind: T.DataType, at: tuple[str, ...]) -> None:
        if isinstance(kind, T.StructType):
            seen = {}
            for f in kind.fields:
                if seen.setdefault(f.name.lower(), f.name) != f.name:
                    raise ValueError(f"{name}: {seen[f.name.lower()]} and {f.name} differ in case only")
                walk(f.dataType, (*at, f.name))
        elif isinstance(kind, T.ArrayType):
            arrays[at] = kind.elementType
        else:
            columns[at] = kind

    walk(element, ())
    children = tuple(_shape("_".join((name, *(at or (VALUE,)))), at, kind) for at, kind in arrays.items())
    return Shape(name, path, element, columns, children)


def found_shape(rows: DataFrame, column: str, name: str) -> Shape:
    """The common structure of all records in the JSON text *column*: one aggregate, combined map-side."""
    found = rows.agg(F.schema_of_variant_agg(_record(column))).first()[0]
    return shape_of(name, found)


def unread(rows: DataFrame, column: str) -> int:
    """Rows whose text is no JSON object."""
    return rows.where(F.col(column).isNotNull() & _record(column).isNull()).count()


def _only(kind: T.DataType, wanted: set[tuple[str, ...]]) -> T.DataType:
    """*kind* without the fields that are on no *wanted* path."""
    if not isinstance(kind, T.StructType):
        return T.ArrayType(T.VariantType()) if isinstance(kind, T.ArrayType) else kind
    kept = []
    for f in kind.fields:
        below = {p[1:] for p in wanted if p and p[0] == f.name}
        if below:
            kept.append(T.StructField(f.name, _only(f.dataType, below)))
    return T.StructType(kept)


def _read(record: Column, kind: T.DataType, wanted: set[tuple[str, ...]]) -> Column:
    pruned = _only(kind, wanted)
    if isinstance(pruned, (T.VariantType, T.NullType)):
        return record
    return F.variant_get(record, "$", _ddl(pruned))  # raises where a record does not fit the shape


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return "variant" if isinstance(kind, T.NullType) else kind.simpleString()


def _at(read: Column, path: tuple[str, ...], kind: T.DataType) -> Column:
    for name in path:
        read = read.getField(name)
    if isinstance(kind, T.NullType):
        return F.lit(None).cast("string")
    if isinstance(kind, T.VariantType):
        return F.when(~F.is_variant_null(read), F.to_json(read))
    return read


def flatten_undeclared(
    rows: DataFrame, keys: tuple[str, ...], column: str, top: Shape, own_keys: dict[str, tuple[str, ...]] | None = None
) -> dict[str, DataFrame]:
    """One table per structure of *top*, as ``flatten`` gives for a declared one.

    *keys* are the columns of *rows* that tell its rows apart. *own_keys* names, by table, the
    fields whose values are the key within the parent, instead of the position. Nothing is
    gathered or joined: each table is a chain of generators over its own row.
    """
    record = rows.select(*[F.col(k) for k in keys], _record(column).alias("_record"))
    out: dict[str, DataFrame] = {}
    _table(record, top, list(keys), own_keys or {}, out)
    return out


def _table(rows: DataFrame, shape: Shape, key: list[str], own_keys: dict[str, tuple[str, ...]], out: dict[str, DataFrame]) -> None:
    names = {path: ".".join(path) or VALUE for path in shape.columns}
    own = rows.withColumn("_read", _read(F.col("_record"), shape.element, set(shape.columns)))
    out[shape.name] = own.select(
        *[F.col(f"`{k}`") for k in key],
        *[_at(F.col("_read"), path, kind).alias(names[path]) for path, kind in shape.columns.items()],
    )
    for child in shape.children:
        fields = own_keys.get(child.name, ())
        wanted = {child.path}
        elements = rows.select(
            key_text([F.col(f"`{k}`") for k in key]).alias(PARENT),
            F.posexplode(_at(_read(F.col("_record"), shape.element, wanted), child.path, T.ArrayType(T.VariantType()))).alias(POSITION, "_record"),
        )
        if not fields:
            _table(elements, child, [PARENT, POSITION], own_keys, out)
            continue
        kinds = {path: kind for path, kind in child.columns.items() if path in {(f,) for f in fields}}
        if len(kinds) < len(fields):
            raise ValueError(f"{child.name} has no scalar fields {', '.join(fields)}")
        read = elements.withColumn("_read", _read(F.col("_record"), child.element, set(kinds)))
        keyed = read.select(PARENT, *[_at(F.col("_read"), path, kinds[path]).alias(path[0]) for path in kinds], "_record")
        rest = Shape(child.name, child.path, child.element, {p: k for p, k in child.columns.items() if p not in kinds}, child.children)
        _table(keyed, rest, [PARENT, *fields], own_keys, out)


def structure_drift(rows: DataFrame, group: str, column: str, name: str, declared: dict[str, tuple[str, ...]]) -> DataFrame:
    """(group, drift): the tables and fields of each group's records against the *declared* ones.

    Entries read ``table.field``. A group costs one row of partial aggregates per task; the driver
    sees each different structure once.
    """
    found = rows.groupBy(group).agg(F.schema_of_variant_agg(_record(column)).alias("_found"))
    spark = rows.sparkSession
    words = [r[0] for r in found.select("_found").distinct().collect()]
    entries = [
        (w, f"{t.name}.{'.'.join(path) or VALUE}") for w in words for t in shape_of(name, w).tables() for path in t.columns
    ]
    fields = spark.createDataFrame(entries, "_found string, entry string")
    actual = found.join(fields, "_found").select(group, "entry")
    wanted = F.array(*[F.lit(f"{t}.{c}") for t, columns in declared.items() for c in columns])
    expected = found.select(group, F.explode(wanted).alias("entry"))
    return column_drift(expected, actual, group, "entry")
