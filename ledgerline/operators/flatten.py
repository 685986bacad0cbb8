"""Flattening of nested records into one keyed table per structure."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.digest import UNIT_SEPARATOR
from ledgerline.session import work_folder

PARENT = "parent"


@dataclass(frozen=True)
class Structure:
    """A record structure: its own key fields, its scalar fields, and the
    arrays of child records it holds (field name -> structure)."""

    name: str
    keys: tuple[str, ...]
    fields: tuple[str, ...] = ()
    children: dict[str, Structure] = field(default_factory=dict)


def parse_json(rows: DataFrame, column: str, schema: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Records of a JSON text column under *schema*, next to the *carry* columns."""
    return rows.select(*carry, F.from_json(F.col(column), schema, {"mode": "FAILFAST"}).alias("record")).select(
        *carry, "record.*"
    )


def kept_records(rows: DataFrame) -> DataFrame:
    """*rows* from a table below the work folder, so that their text is parsed once for all tables, checks and writes."""
    folder = work_folder(rows.sparkSession, "records")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def key_text(names: list[Column]) -> Column:
    return F.concat_ws(UNIT_SEPARATOR, *[n.cast("string") for n in names])


def flatten(rows: DataFrame, top: Structure) -> dict[str, DataFrame]:
    """One table per structure.

    The top level keeps its keys and fields. Every other table starts with
    ``parent``: the parent row's key values as text, joined by the unit
    separator; its key is ``parent`` plus its own keys. Each table is a chain of
    generators over its own row; nothing is gathered or joined.
    """
    out = {top.name: rows.select(*top.keys, *top.fields)}
    _children(rows, top, [F.col(k) for k in top.keys], out)
    return out


def _children(rows: DataFrame, parent: Structure, key: list[Column], out: dict[str, DataFrame]) -> None:
    for field_name, child in parent.children.items():
        exploded = rows.select(key_text(key).alias(PARENT), F.explode(F.col(field_name)).alias("element"))
        nested = exploded.select(
            PARENT, *[F.col(f"element.`{n}`").alias(n) for n in (*child.keys, *child.fields, *child.children)]
        )
        out[child.name] = nested.select(PARENT, *child.keys, *child.fields)
        _children(nested, child, [F.col(PARENT), *[F.col(k) for k in child.keys]], out)
