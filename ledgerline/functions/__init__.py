from ledgerline.functions.digest import canonical_text, row_digest
from ledgerline.functions.parse import (
    blank_to_null,
    file_month,
    file_stamp,
    parse_date,
    parse_flag,
    stamp_time,
    typed,
)

__all__ = [
    "blank_to_null",
    "canonical_text",
    "file_month",
    "file_stamp",
    "parse_date",
    "parse_flag",
    "row_digest",
    "stamp_time",
    "typed",
]
