"""Register exports that a seed invents, with the changes that each month brings.

Every dataset has ten keys. The seed says which of them a month holds, which change their value and
which change a volatile column only; what a load adds to the log follows from that by a plain
comparison of one month with the months before (``added``).
"""

from __future__ import annotations

import csv
import io
import random
from pathlib import Path

from ledgerline import catalog
from ledgerline.spec import BLANK, FLAG

MONTHS = (1, 2, 3)
STAMPS = {month: f"2031{month + 3:02d}17_0645" for month in (*MONTHS, 4)}
KEYS = 10


def year_month(month):
    return f"2031-{month + 3:02d}"


def raw_file(root, spec, month):
    return f"{root}/raw/{spec.source}/{spec.table}/year_month={year_month(month)}/{spec.table}_{STAMPS[month]}.csv"


def put(root, spec, month, header, lines, bom=True):
    """UTF-8 with BOM, CRLF and a trailing blank line."""
    path = Path(raw_file(root, spec, month))
    path.parent.mkdir(parents=True, exist_ok=True)
    text = io.StringIO()
    writer = csv.writer(text, lineterminator="\r\n")
    writer.writerow(header)
    writer.writerows(lines)
    path.write_bytes((("﻿" if bom else "") + text.getvalue() + "\r\n").encode())
    return str(path)


def header(spec):
    return list(spec.names)


def _text(column, dice, key):
    """A raw value that the column's type can parse."""
    kind = column.type
    if column.parse == FLAG:
        return dice.choice("YN")
    if kind == "date":
        return f"{dice.randint(1, 28):02d}.{dice.randint(1, 12):02d}.{dice.randint(1950, 2030)}"
    if kind == "double" or kind.startswith("decimal"):
        return f"{dice.randint(0, 9999) / 100:.2f}"
    if kind in ("int", "bigint"):
        return str(dice.randint(1, 90_000))
    if column.parse == BLANK:
        return dice.choice([" ", "", f"code {dice.randint(1, 99)}"])
    return dice.choice(["plain", 'with "quotes"', "with, comma", "øæå"]) + f" {dice.randint(1, 9999)}"


def _key(column, number):
    """A raw key value; different numbers give different values."""
    kind = column.type
    if kind == "date":
        return f"{number % 27 + 1:02d}.05.{1990 + number}"
    if kind in ("int", "bigint", "double"):
        return str(7000 + 13 * number)
    return f"KEY-{number:03d}"


def records(spec, month):
    """{number: raw values} of one month's export."""
    out = {}
    for number in range(KEYS):
        dice = random.Random(f"{spec.code}/{number}")
        base = {c.name: _text(c, dice, number) for c in spec.columns} | {
            c.name: _key(c, number) for c in spec.columns if c.name in spec.keys
        }
        if spec.multiline:
            for c in spec.columns:
                if c.type == "string" and c.name not in (*spec.keys, *spec.volatile):
                    base[c.name] += '\r\nnext, "line"'
        free = [c for c in spec.columns if c.name not in (*spec.keys, *spec.volatile) and c.parse != FLAG and c.type not in ("date",)]
        present = True
        for m in range(1, month + 1):
            fate = random.Random(f"{spec.code}/{number}/{m}").random()
            present = fate > 0.2 or (m == 1 and number < 4)
            if m > 1 and 0.2 < fate < 0.45:  # a real change; values of another month's dice
                changed = free[number % len(free)]
                base[changed.name] = {"double": f"{m}.5", "int": f"{m}{number}", "bigint": f"{m}{number}"}.get(changed.type, f"{m}{number}")
            for c in spec.columns:  # volatile columns change every month
                if c.name in spec.volatile and c.name not in spec.keys:
                    base[c.name] = f"{m:02d}.{m:02d}.2031" if c.type == "date" else f"{m}"
        if present:
            out[number] = dict(base)
    return out


def lines(spec, month):
    return [[row[name] for name in spec.names] for row in records(spec, month).values()]


def export(root, spec, month):
    return put(root, spec, month, header(spec), lines(spec, month), bom=month != 2)


def told(spec, row):
    """What of a record counts: neither volatile nor told apart by blanks."""
    return tuple(row[n].strip() if n not in spec.keys else row[n] for n in spec.names if n not in spec.volatile)


def added(spec, month):
    """(key number, deleted) of what one month adds to the log."""
    now, before = records(spec, month), records(spec, month - 1) if month > 1 else {}
    changed = {(k, False) for k in now if k not in before or told(spec, now[k]) != told(spec, before[k])}
    return changed | {(k, True) for k in before if k not in now}


def current(spec, month=3):
    """Key numbers that are live after a month."""
    return set(records(spec, month))


def key_values(spec, number):
    return {c.name: _key(c, number) for c in spec.columns if c.name in spec.keys}


SPECS = list(catalog.DATASETS.values())
