"""Declarative description of a keyed snapshot dataset.

One spec drives every operator: the typed projection, the checks, the row
digest, the change log, the versions and the hook columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import types as T

# Metadata columns of each layer.
RAW_FILENAME = "___Raw_filename"
RAW_YEAR_MONTH = "___Raw_year_month"
RAW_TIMESTAMP = "___Raw_file_timestamp"
STD_MD5 = "___Std_md5"
STD_FILENAME = "___Std_filename"
STD_YEAR_MONTH = "___Std_year_month"
STD_TIMESTAMP = "___Std_file_timestamp"
LOG_MD5 = "___Lake_md5"
LOG_TIMESTAMP = "___Lake_load_timestamp"
LOG_DATASOURCE = "___Lake_datasource"
LOG_SOURCEFILE = "___Lake_sourcefile"
LOG_DELETED = "___Lake_isdeleted"
EFFECTIVE_FROM = "___Effective_From"
EFFECTIVE_TO = "___Effective_To"
IS_DELETED = "___Is_Deleted"

LOG_COLUMNS = (LOG_MD5, LOG_TIMESTAMP, LOG_DATASOURCE, LOG_SOURCEFILE, LOG_DELETED)

# How raw text becomes a typed value.
CAST, DATE, FLAG, BLANK = "cast", "date", "flag", "blank"


class SpecError(ValueError):
    """The spec contradicts itself."""


@dataclass(frozen=True)
class Column:
    """A typed column; ``parse`` says how its raw text is read.

    cast   ANSI cast, a bad value fails the snapshot
    date   strict day.month.year text
    flag   Y or N, becomes boolean
    blank  text whose blank-only values become NULL
    """

    name: str
    type: str = "string"
    parse: str = CAST

    @property
    def data_type(self) -> T.DataType:
        return T.DataType.fromDDL(self.type)


@dataclass(frozen=True)
class DatasetSpec:
    """A dataset: source and table name, typed columns, key and volatile columns.

    ``keys`` come first in ``columns``. ``volatile`` columns move with every
    export and stay out of the digest. ``key_labels`` name the columns that
    describe an offending row in the empty-key message. ``multiline`` is None
    when the reader has to find out whether quoted text spans lines.
    """

    source: str
    table: str
    columns: tuple[Column, ...]
    keys: tuple[str, ...]
    volatile: tuple[str, ...] = ()
    key_labels: tuple[str, ...] = ()
    multiline: bool | None = None
    names: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        names = tuple(c.name for c in self.columns)
        object.__setattr__(self, "names", names)
        if len({n.lower() for n in names}) != len(names):
            raise SpecError(f"{self.code}: column names must differ in more than case")
        if not self.keys:
            raise SpecError(f"{self.code}: no key columns")
        if names[: len(self.keys)] != tuple(self.keys):
            raise SpecError(f"{self.code}: the key columns must come first")
        for name in (*self.volatile, *self.key_labels):
            if name not in names:
                raise SpecError(f"{self.code}: unknown column {name}")
        if set(self.volatile) & set(self.keys):
            raise SpecError(f"{self.code}: a key column cannot be volatile")
        for column in self.columns:
            if column.parse not in (CAST, DATE, FLAG, BLANK):
                raise SpecError(f"{self.code}: unknown parse rule {column.parse}")

    @property
    def code(self) -> str:
        return f"{self.source}_{self.table}"

    @property
    def digest_columns(self) -> tuple[str, ...]:
        return tuple(n for n in self.names if n not in self.keys and n not in self.volatile)

    @property
    def payload(self) -> tuple[str, ...]:
        """Every column that is not part of the key."""
        return self.names[len(self.keys):]

    @property
    def flags(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.parse == FLAG)

    @cached_property
    def schema(self) -> T.StructType:
        """Typed columns as stored in Std."""
        return T.StructType([T.StructField(c.name, c.data_type) for c in self.columns])

    @cached_property
    def log_schema(self) -> T.StructType:
        """Columns of the change log."""
        return T.StructType(
            self.schema.fields
            + [
                T.StructField(LOG_MD5, T.StringType()),
                T.StructField(LOG_TIMESTAMP, T.TimestampType()),
                T.StructField(LOG_DATASOURCE, T.StringType()),
                T.StructField(LOG_SOURCEFILE, T.StringType()),
                T.StructField(LOG_DELETED, T.BooleanType()),
            ]
        )


def columns(text: str) -> tuple[Column, ...]:
    """Columns from lines of ``name type [parse]``."""
    return tuple(Column(*line.split()) for line in text.strip().splitlines())
