"""Compare a registered query with its SQL counterpart on the same tables."""

import decimal
import sys
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(con, sql, df):
    """None if equal, otherwise what differs."""
    result = con.execute(sql)
    expected_names = [d[0] for d in result.description]
    if sorted(expected_names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(expected_names)}"
    expected = _rows(expected_names, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(expected) != len(actual):
        return f"{len(actual)} rows instead of {len(expected)}"
    for a, e in zip(actual, expected, strict=True):
        if a != e:
            return f"{a} instead of {e}"
    return None


def main():
    """``python tests/oracle.py <sf_dir> [name ...]``"""
    import time

    import __spark_entry__ as entry
    from ledgerline.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    spark, con, oracle, bad = local_session(), connect(sf_dir), entry.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            problem = compare(con, oracle[name], df) if name in oracle else f"(no SQL) {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:30s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
