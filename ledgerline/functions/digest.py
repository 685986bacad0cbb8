"""Row digest: one MD5 over the columns that carry meaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT_SEPARATOR = "\x1f"


def _plain(text: Column) -> Column:
    """Positional spelling of a number written with an exponent.

    38 digits hold every magnitude this branch sees (1e-4 to 1e16) with the 17
    significant digits of a double.
    """
    fixed = F.format_string("%s", text.cast("decimal(38,20)").cast("string"))
    return F.regexp_replace(F.regexp_replace(fixed, "0+$", ""), r"\.$", ".0")


def _exponent(text: Column) -> Column:
    """``1.5E-7`` to ``1.5e-07``, ``1.0E20`` to ``1e+20``."""
    mantissa = F.regexp_replace(F.regexp_extract(text, "^([^E]+)E", 1), r"\.0$", "")
    sign = F.when(F.contains(text, F.lit("E-")), F.lit("-")).otherwise(F.lit("+"))
    digits = F.regexp_extract(text, "E-?([0-9]+)$", 1)
    digits = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    return F.concat(mantissa, F.lit("e"), sign, digits)


def double_text(value: Column) -> Column:
    """Text of a double that does not depend on the engine.

    Spark switches to an exponent at 1e7 and below 1e-3; this spelling is
    positional from 1e-4 up to 1e16 and uses a two-digit exponent outside.
    Before Java 19 the JVM prints a few doubles with one digit more than
    needed; their text differs from an engine that prints the shortest form.
    """
    text = value.cast("string")
    size = F.abs(value)
    return (
        F.when((value == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e-4) & (size < 1e16), _plain(text))
        .when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .otherwise(_exponent(text))
    )


def canonical_text(name: str, data_type: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, T.DoubleType):
        return double_text(value)
    return value.cast("string")


def row_digest(schema: T.StructType, names: Iterable[str]) -> Column:
    """MD5 over the text of *names* in order; NULL counts as empty text."""
    parts = [F.coalesce(canonical_text(n, schema[n].dataType), F.lit("")) for n in names]
    return F.md5(F.concat_ws(UNIT_SEPARATOR, *parts))
