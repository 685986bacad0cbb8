"""Hook columns: typed business keys through which datasets meet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER, BIGINT, VARCHAR = "integer", "bigint", "varchar"
ENCODINGS = (INTEGER, BIGINT, VARCHAR)

DEVELOPMENT, PRODUCTION = "development", "production"

_WIDTH = {INTEGER: 8, BIGINT: 16}
_LARGEST = {INTEGER: 2**32 - 1, BIGINT: 2**63 - 1}


@dataclass(frozen=True)
class Hook:
    """One row of the hook registry that belongs to a dataset."""

    id: int
    column: str
    key_set: str
    key_set_binary: bytes
    expression_dev: str
    expression_prod: str
    encoding: str


def key_set(source: Column, domain: Column, concept: Column) -> Column:
    """Readable key set ``source.domain.concept``."""
    return F.concat(source, F.lit("."), domain, F.lit("."), concept)


def byte(value: Column) -> Column:
    """One byte; a value that does not fit fails the query."""
    number = value.cast("bigint")
    message = F.concat(F.lit("does not fit one byte: "), number.cast("string"))
    fits = F.when(number.between(0, 255) | number.isNull(), number).otherwise(F.raise_error(message).cast("bigint"))
    return F.unhex(F.lpad(F.hex(fits), 2, "0"))


def key_set_binary(source: Column, domain: Column, concept: Column) -> Column:
    """Compact key set: one byte per id."""
    return F.concat(byte(source), byte(domain), byte(concept))


def hook_column(concept_name: Column, role: Column) -> Column:
    """``HK_`` and the concept name in capitals, then ``__role`` if any."""
    name = F.upper(F.regexp_replace(concept_name, "[^A-Za-z0-9]", "_"))
    return F.concat(F.lit("HK_"), name, F.coalesce(F.concat(F.lit("__"), role), F.lit("")))


def development_hook(key_set_text: Column, value: Column) -> Column:
    """``key_set|value``; NULL stays NULL."""
    return F.concat(key_set_text, F.lit("|"), value.cast("string"))


def encoded(value: Column, encoding: str) -> Column:
    """Unsigned big-endian bytes of an integer, or the UTF-8 bytes of text.

    A value out of range fails the query: it would build a wrong hook.
    """
    if encoding == VARCHAR:
        return F.encode(value.cast("string"), "UTF-8")
    if encoding not in _WIDTH:
        raise ValueError(f"Unknown hook encoding '{encoding}'")
    number = value.cast("bigint")
    whole = number == value  # a fraction would share its hook with another key
    guarded = F.when((whole & number.between(0, _LARGEST[encoding])) | value.isNull(), number).otherwise(
        F.raise_error(F.concat(F.lit(f"hook value does not fit {encoding}: "), value.cast("string"))).cast("bigint")
    )
    return F.unhex(F.lpad(F.hex(guarded), _WIDTH[encoding], "0"))


def production_hook(key_set_bytes: Column, value: Column, encoding: str) -> Column:
    return F.concat(key_set_bytes, encoded(value, encoding))


def hook_columns(hooks: list[Hook], mode: str) -> list[Column]:
    """Hook columns of a dataset in id order."""
    if mode not in (DEVELOPMENT, PRODUCTION):
        raise ValueError(f"Unknown hook mode '{mode}'")
    out = []
    for hook in sorted(hooks, key=lambda h: h.id):
        if mode == DEVELOPMENT:
            value = development_hook(F.lit(hook.key_set), F.expr(hook.expression_dev))
        else:
            prefix = F.lit(bytearray(hook.key_set_binary))
            value = production_hook(prefix, F.expr(hook.expression_prod), hook.encoding)
        out.append(value.alias(hook.column))
    return out
