"""Whole loads through files: quoted exports, nested datasets, resumed loads, stored metadata."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.hooks import PRODUCTION, hook_columns
from ledgerline.operators import versions
from ledgerline.operators.changes import by_key
from ledgerline.operators.checks import CheckError, ranked
from ledgerline.operators.flatten import Structure, flatten, kept_records
from ledgerline.plans.history_queries import (
    latest_sql,
    log_sql,
    series_sql,
    stable_log_sql,
    time_sql,
    _stable_log,
)
from ledgerline.plans.loads import FULL, INCREMENTAL, Ledger
from ledgerline.plans.quality_queries import META_SQL, REGISTRY_SQL, derived_metadata
from ledgerline.plans.registry import query
from ledgerline.plans.series import CUSTOMER, ORDERS, Series, replay, snapshot_dates, snapshot_rows, table
from ledgerline.session import work_folder
from ledgerline.sources import metadata, raw, state, std
from ledgerline.spec import RAW_TIMESTAMP, RAW_YEAR_MONTH, Column, DatasetSpec, columns

# Raw exports ---------------------------------------------------------------

TEXTS = DatasetSpec("star", "texts", (Column("doc_id"), Column("source"), Column("text")), ("doc_id",))


#: Text of the exports: as it is, with quotes and line feeds (which the writer of the export turns into its
#: line end, CR LF), with quotes and CR LF.
_SAID = "CASE month WHEN 1 THEN nullif(text, '') WHEN 2 THEN replace('say \"' || text || chr(10) || '\", twice', chr(10), chr(13) || chr(10)) ELSE 'say \"' || text || chr(13) || chr(10) || '\", twice' || chr(13) END"


@query(
    "raw_quoted",
    f"""WITH files AS (
        SELECT unnest([1, 2, 3, 4]) AS month)
    SELECT doc_id::VARCHAR AS doc_id, source,
           CASE month WHEN 4 THEN nullif(translate(text, chr(10) || chr(13), '  '), '') ELSE {_SAID} END AS text,
           CASE WHEN month = 4 THEN lang END AS lang,
           '2026-0' || month AS "___Raw_year_month", make_timestamp(2026, month, 1, 10, 0, 0.0) AS "___Raw_file_timestamp"
    FROM documents, files""",
)
def raw_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through four exports, read back in one scan.

    The first begins with a byte order mark; the second ends its lines with CR LF, also inside the quoted
    texts; the third ends its lines with line feeds and has CR LF in every text, and a CR
    before the closing quote; the last has other columns in another order and one line per row.
    """
    root = work_folder(spark, "raw-quoted")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text", "lang")
    said = F.concat(F.lit('say "'), F.col("text"), F.lit('\n", twice'))
    with_cr = F.concat(F.lit('say "'), F.col("text"), F.lit('\r\n", twice\r'))
    exports = {
        1: (docs.select(F.col("doc_id").alias("\ufeffdoc_id"), "source", "text"), "\n"),
        2: (docs.select("doc_id", "source", said.alias("text")), "\r\n"),
        3: (docs.select("doc_id", "source", with_cr.alias("text")), "\n"),
        4: (docs.select(F.translate("text", "\n\r", "  ").alias("text"), "doc_id", "lang", "source"), "\n"),
    }
    for (seq, month, stamp), (rows, end) in zip(snapshot_dates(len(exports)), exports.values(), strict=True):
        path = f"{raw.folder(f'{root}/raw', TEXTS)}/year_month={month}/texts_{stamp}.csv"
        _write_texts(rows, path, end)
    return raw.scan(spark, f"{root}/raw", TEXTS).select(*TEXTS.names, "lang", RAW_YEAR_MONTH, RAW_TIMESTAMP)


def _write_texts(rows: DataFrame, path: str, end: str) -> None:
    rows.write.options(
        header=True, quote='"', escape='"', lineSep=end, emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


@query(
    "raw_split_quoted",
    f"""WITH files AS (SELECT unnest([2, 3]) AS month)
    SELECT doc_id::VARCHAR AS doc_id, source, {_SAID} AS text, month FROM documents, files""",
)
def raw_split_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports with line breaks in every text, one with each line end, read in splits that begin anywhere."""
    root = work_folder(spark, "raw-split")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    said = F.concat(F.lit('say "'), F.col("text"), F.lit('\n", twice'))
    with_cr = F.concat(F.lit('say "'), F.col("text"), F.lit('\r\n", twice\r'))
    united = None
    for month, text, end in ((2, said, "\r\n"), (3, with_cr, "\n")):
        path = f"{root}/year_month=2026-0{month}/texts_20260{month}01_1000.csv"
        _write_texts(docs.select("doc_id", "source", text.alias("text")), path, end)
        rows = raw.read_split(spark, [path], TEXTS.names).select(*TEXTS.names, F.lit(month).alias("month"))
        united = rows if united is None else united.unionByName(rows)
    return united


# A dataset that feeds three tables -----------------------------------------

EVENTS = DatasetSpec("star", "events", columns("event_id bigint\nevent_type string\nk bigint"), ("event_id",))
MARKS = DatasetSpec("star", "events_marks", columns("parent string\nmark string\nweight bigint"), ("parent", "mark"))
NOTES = DatasetSpec("star", "events_marks_notes", columns("parent string\nnote bigint"), ("parent", "note"))

_NOTES = Structure("events_marks_notes", ("note",))
_MARKS = Structure("events_marks", ("mark",), ("weight",), {"notes": _NOTES})
EVENT_TREE = Structure("events", ("event_id",), ("event_type", "k"), {"marks": _MARKS})
EVENT_RECORD = (
    "event_id bigint, event_type string, k bigint, "
    "marks array<struct<mark: string, weight: bigint, notes: array<struct<note: bigint>>>>"
)


def split_events(spark: SparkSession, raw_file: str) -> dict[str, DataFrame]:
    return flatten(kept_records(spark.read.schema(EVENT_RECORD).json(raw_file, mode="FAILFAST")), EVENT_TREE)


def _event_export(spark: SparkSession, sf_dir: str, seq: int) -> DataFrame:
    """Nested records of one snapshot, by the rule of the series."""
    number = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint") + F.floor((number % 13 + seq) / F.lit(5.0))

    def mark(name: str, weight) -> Column:
        notes = F.transform(F.filter(F.array(F.lit(1), F.lit(2)), lambda i: i <= weight), lambda i: F.struct(i.alias("note")))
        return F.struct(F.lit(name).alias("mark"), weight.alias("weight"), notes.alias("notes"))

    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    events = by_key(("event_id",), events, events.count())  # a file of one row group would be one task
    events = events.where((number * 7 + seq * 3) % 11 != 0)
    # the text is read once a row: written into the marks, its expression would run for every element
    events = events.select("event_id", "event_type", k.alias("k")).select("*", (F.col("k") % 3).alias("a"), (F.col("k") % 2).alias("b"))
    return events.select("event_id", "event_type", "k", F.array(mark("a", F.col("a")), mark("b", F.col("b"))).alias("marks"))


def _replay_sql(name: str) -> str:
    """Change rows of one table: its key as text, its digest, load and deletion."""
    return f"""SELECT '{name}' AS table_name, key, md5 AS digest, load_no, deleted FROM (
        SELECT key, md5, seq AS load_no, false AS deleted FROM {name}_seen
        WHERE before IS NULL OR before < seq - 1 OR md5_before <> md5
        UNION ALL
        SELECT key, md5, seq + 1, true FROM {name}_seen WHERE seq < 4 AND (after IS NULL OR after > seq + 1))"""


def _seen_sql(name: str, rows: str, key: str, digest: str) -> str:
    return f"""{name}_seen AS (
        SELECT *, lag(seq) OVER w AS before, lead(seq) OVER w AS after, lag(md5) OVER w AS md5_before
        FROM (SELECT {key} AS key, md5({digest}) AS md5, seq FROM {rows}) WINDOW w AS (PARTITION BY key ORDER BY seq))"""


_TABLES_SQL = {
    "star_events": ("records", "event_id::VARCHAR", "event_type || chr(31) || k"),
    "star_events_marks": ("marks", "event_id || chr(31) || mark", "weight::VARCHAR"),
    "star_events_marks_notes": ("notes", "event_id || chr(31) || mark || chr(31) || note", "''"),
}

NESTED_SQL = f"""WITH records AS (
        SELECT event_id, event_type, seq, (props->>'$.k')::BIGINT + floor((event_id % 13 + seq) / 5.0)::BIGINT AS k
        FROM (SELECT *, unnest([1, 2, 3, 4]) AS seq FROM events) WHERE (event_id * 7 + seq * 3) % 11 <> 0),
    marks AS (
        SELECT event_id, seq, mark, CASE mark WHEN 'a' THEN k % 3 ELSE k % 2 END AS weight
        FROM (SELECT *, unnest(['a', 'b']) AS mark FROM records)),
    notes AS (SELECT event_id, seq, mark, unnest(range(1, weight + 1)) AS note FROM marks),
    {", ".join(_seen_sql(name, *parts) for name, parts in _TABLES_SQL.items())}
    SELECT table_name, key, digest, {time_sql("load_no")} AS loaded_at, deleted
    FROM ({" UNION ALL ".join(_replay_sql(name) for name in _TABLES_SQL)})"""


@query("nested_to_logs", NESTED_SQL)
def nested_to_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested exports to three Std tables to three logs under one load state.

    Three exports come in one full load, the fourth incrementally. Which tables there are, and their order,
    is read from the metadata of the datasets.
    """
    specs = (EVENTS, MARKS, NOTES)
    known = [("3", NOTES.code, MARKS.code, "parent, note"), ("2", MARKS.code, EVENTS.code, "parent, mark"), ("1", EVENTS.code, None, "event_id")]
    datasets = spark.createDataFrame(known, "id string, code string, parent_code string, keys string")
    root = work_folder(spark, "nested-to-logs")
    ledger = Ledger.of_metadata(spark, root, datasets, {s.code: s for s in specs}, {EVENTS.code: split_events})
    paths = []
    for seq, month, stamp in snapshot_dates(4):
        paths.append(f"{raw.folder(ledger.raw_root, EVENTS)}/year_month={month}/events_{stamp}.json")
        _event_export(spark, sf_dir, seq).write.json(paths[-1])
        if seq == 3:
            ledger.arrived(EVENTS, FULL, paths[-1])
            ledger.full_load(EVENTS)
    ledger.incremental_load(EVENTS, paths[-1])
    united = None
    for spec in specs:
        rows = ledger.log(spec).select(
            F.lit(spec.code).alias("table_name"),
            F.concat_ws("\x1f", *[F.col(k).cast("string") for k in spec.keys]).alias("key"),
            F.col("___Lake_md5").alias("digest"),
            F.col("___Lake_load_timestamp").alias("loaded_at"),
            F.col("___Lake_isdeleted").alias("deleted"),
        )
        united = rows if united is None else united.unionByName(rows)
    return united


# Loads of single exports ---------------------------------------------------


def _export(spark: SparkSession, sf_dir: str, ledger: Ledger, series: Series, seq: int, empty: bool = False) -> str:
    """One snapshot of a series as a CSV export, or its header alone; its path."""
    _, month, stamp = snapshot_dates(seq)[-1]
    path = f"{raw.folder(ledger.raw_root, series.spec)}/year_month={month}/{series.spec.table}_{stamp}.csv"
    rows = snapshot_rows(spark, sf_dir, series, seq).where(F.col("seq") == seq)
    rows.select(*series.spec.names).where(F.lit(not empty)).write.option("header", True).csv(path)
    return path


@query(
    "empty_exports",
    f"""WITH {series_sql(CUSTOMER)},
    counts AS (SELECT seq, count(*) AS n FROM obs WHERE seq < 4 GROUP BY seq)
    SELECT '2026-0' || seq AS year_month, strftime({time_sql("seq")}, '%Y%m%d_%H%M') AS stamp,
           CASE WHEN seq = 2 THEN 0 ELSE n END AS rows, 2 AS first_load, 0 AS second_load, 1 AS third_load FROM counts""",
)
def empty_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal after three loads: of an export and one that has a header only, of nothing new, and of one more."""
    spec = CUSTOMER.spec
    ledger = Ledger(spark, work_folder(spark, "empty-exports"))

    def convert() -> int:
        return std.standardize_all(spark, spec, ledger.raw_root, ledger.std_root)

    for seq in (1, 2):
        _export(spark, sf_dir, ledger, CUSTOMER, seq, empty=seq == 2)
    loads = [convert(), convert()]
    _export(spark, sf_dir, ledger, CUSTOMER, 3)
    loads.append(convert())
    counted = [F.lit(n).alias(name) for n, name in zip(loads, ("first_load", "second_load", "third_load"))]
    return std.journal(spark, ledger.std_root, spec).select("year_month", "stamp", "rows", *counted)


FLAGGED = DatasetSpec(
    "star", "flagged", (Column("c_custkey", "bigint"), Column("c_name"), Column("active", "boolean", "flag")), ("c_custkey",)
)


@query(
    "fail_fast",
    """WITH t AS (
        SELECT CASE WHEN c_custkey % 10 = 3 THEN c_custkey - 1 ELSE c_custkey END AS id, c_name, c_custkey % 7 AS k, substr(c_mktsegment, 1, 1) AS s FROM customer)
    SELECT 'flags' AS check_name, 'active=' || s AS message FROM t WHERE k = 0 GROUP BY s
    UNION ALL SELECT 'keys', c_name FROM t WHERE id % 10 = 4
    UNION ALL SELECT 'unique', id::VARCHAR FROM t GROUP BY id HAVING count(*) > 1""",
)
def fail_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three exports of which each breaks one rule: the load fails, nothing is published, every violation is in the error's table."""
    root = work_folder(spark, "fail-fast")
    number = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        F.when(number % 10 == 3, number - 1).otherwise(number).alias("c_custkey"), "c_name",
        F.substring("c_mktsegment", 1, 1).alias("segment"), (number % 7).alias("k"),
    )
    exports = {
        "flags": rows.select("c_custkey", "c_name", F.when(F.col("k") == 0, F.col("segment")).otherwise("Y").alias("active")),
        "keys": rows.select(F.when(F.col("c_custkey") % 10 != 4, F.col("c_custkey")).alias("c_custkey"), "c_name", F.lit("N").alias("active")),
        "unique": rows.select("c_custkey", "c_name", F.lit("N").alias("active")),
    }
    spec = replace(FLAGGED, key_labels=("c_name",))
    united = None
    for (name, export), (_, month, stamp) in zip(exports.items(), snapshot_dates(len(exports)), strict=True):
        path = f"{raw.folder(f'{root}/raw', spec)}/year_month={month}/{spec.table}_{stamp}.csv"
        export.write.option("header", True).csv(path)
        try:
            std.standardize(spark, spec, f"{root}/std", path)
        except CheckError as e:
            found = spark.read.parquet(e.path).select(F.lit(name).alias("check_name"), "message")
            united = found if united is None else united.unionByName(found)
    if not std.scan(spark, f"{root}/std", spec).isEmpty():
        raise AssertionError("a broken export was published")
    return united


@query(
    "newest_per_group",
    """SELECT o_custkey, o_orderkey, o_orderdate::DATE AS ordered FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""",
)
def newest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order of each customer: first row of a group in an order, one row per group and task in the shuffle."""
    orders = table(spark, sf_dir, "orders")
    found = ranked(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return found.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"))


@query("as_of_in_another_zone", latest_sql(ORDERS, upto=f"{time_sql('load_no')} <= TIMESTAMP '2026-02-01 10:00:00'"))
def as_of_in_another_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at an instant, asked in a session of another time zone: instants do not depend on it."""
    path, zone = work_folder(spark, "zone"), spark.conf.get("spark.sql.session.timeZone")
    log = replay(spark, sf_dir, ORDERS)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        at = datetime(2026, 2, 1, 10, tzinfo=timezone.utc)
        versions.as_of(ORDERS.spec, log, at).write.parquet(path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark.read.parquet(path)


@query("resumed_loads", stable_log_sql(CUSTOMER, 3))
def resumed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads: one breaks off before Std, one after it, one runs through.

    Each next load first finishes what is recorded as unfinished.
    """
    spec = CUSTOMER.spec
    ledger = Ledger(spark, work_folder(spark, "resumed-loads"))
    ledger.arrived(spec, INCREMENTAL, _export(spark, sf_dir, ledger, CUSTOMER, 1))
    ledger.incremental_load(spec)
    second = _export(spark, sf_dir, ledger, CUSTOMER, 2)
    std.standardize(spark, spec, ledger.std_root, second)
    half = state.LoadState(spec.source, spec.table, INCREMENTAL, raw_file=second).at(state.STD)
    state.record(spark, ledger.root, half)
    ledger.incremental_load(spec, _export(spark, sf_dir, ledger, CUSTOMER, 3))
    return _stable_log(ledger.log(spec), CUSTOMER)


@query(
    "one_snapshot",
    f"""WITH {series_sql(ORDERS)} SELECT {", ".join(ORDERS.spec.names)}, md5 AS "___Std_md5",
        '2026-02' AS "___Std_year_month", {time_sql("2")} AS "___Std_file_timestamp" FROM obs WHERE seq = 2""",
)
def one_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of two exports converted and seen through the Std view; the other stays raw."""
    ledger = Ledger(spark, work_folder(spark, "one-snapshot"))
    paths = [_export(spark, sf_dir, ledger, ORDERS, seq) for seq in (1, 2)]
    std.standardize(spark, ORDERS.spec, ledger.std_root, paths[1])
    return std.view(spark, ledger.std_root, ORDERS.spec).drop("___Std_filename")


@query(
    "views_after_loads",
    f"""WITH {log_sql(CUSTOMER, 2)}
    SELECT c_custkey, balance, {time_sql("load_no")} AS "___Effective_From", deleted AS "___Is_Deleted" FROM log""",
)
def views_after_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame view after two loads: the second load has replaced it."""
    spec = CUSTOMER.spec
    ledger = Ledger(spark, work_folder(spark, "views"), views={spec.code: ()})
    for seq in (1, 2):
        ledger.incremental_load(spec, _export(spark, sf_dir, ledger, CUSTOMER, seq))
    return spark.table(f"frame_{spec.code}").select("c_custkey", "balance", "___Effective_From", "___Is_Deleted")


# Stored metadata -----------------------------------------------------------

VALID_META_SQL = META_SQL.replace("(c_custkey % 200)", "(c_custkey % 199 + 1)").replace(
    "(s_suppkey % 200)::INTEGER, 's_name', 's_suppkey', 'bigint', NULL",
    "(s_suppkey % 199 + 1)::INTEGER, 's_name', 's_suppkey', 'bigint', 'S' || s_suppkey",
)


@query("metadata_copy", REGISTRY_SQL.replace(META_SQL, VALID_META_SQL))
def metadata_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text metadata checked by every rule, stored, and the registry read back."""
    tables = derived_metadata(spark, sf_dir)
    number = F.col("id").cast("int")
    key = F.floor(number / 2)
    tables["hooks"] = tables["hooks"].withColumns({
        "dataset_id": (key % 199 + 1).cast("string"),
        "hook_role": F.concat(F.when(number % 2 == 0, "C").otherwise("S"), key.cast("string")),
    })
    root = work_folder(spark, "metadata")
    metadata.store(tables, root)
    registry = spark.read.parquet(f"{root}/metadata/hooks")
    return registry.withColumn("key_set_binary", F.hex("key_set_binary"))


@query(
    "frame_with_registered_hooks",
    f"""WITH {log_sql(CUSTOMER)}
    SELECT c_custkey, {time_sql("load_no")} AS "___Effective_From",
           'HK_' || replace(r_name, ' ', '_') || '__Home' AS hook_column,
           printf('%02X%02X%02X', 7, r_regionkey + 20, r_regionkey + 40)
               || CASE WHEN r_regionkey % 2 = 0 THEN printf('%016X', c_custkey) ELSE hex(encode(c_name)) END AS hook
    FROM log JOIN region ON true""",
)
def frame_with_registered_hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of customers with the hooks that the registry holds for them: one per region."""
    region = table(spark, sf_dir, "region")
    number = F.col("r_regionkey")

    def text(shift: int) -> Column:
        return (number + shift).cast("string")

    none = F.lit(None).cast("string")
    even = number % 2 == 0
    expression = F.when(even, "c_custkey").otherwise("c_name")
    tables = metadata.catalog_tables(spark) | {
        "sources": metadata.from_text(spark, "sources", "id,code\n7,star\n"),
        "datasets": metadata.from_text(spark, "datasets", f"id,code,name,source_id,keys\n3,{CUSTOMER.spec.code},Customers,7,c_custkey\n"),
        "business_domains": region.select(
            text(20).alias("id"), F.lower(F.substring("r_name", 1, 3)).alias("code"), F.col("r_name").alias("name"),
            none.alias("description"),
        ),
        "business_concepts": region.select(
            text(40).alias("id"), F.lower("r_name").alias("code"), F.col("r_name").alias("name"), none.alias("description"),
            text(20).alias("business_domain_id"),
        ),
        "hooks": region.select(
            text(1).alias("id"), text(40).alias("business_concept_id"), F.lit("3").alias("dataset_id"),
            expression.alias("hook_expression_dev"), expression.alias("hook_expression_prod"),
            F.when(even, "bigint").otherwise("varchar").alias("hook_encoding"), F.lit("Home").alias("hook_role"),
        ),
    }
    built = metadata.build(tables)
    hooks = metadata.hooks_of(built["hooks"], built["datasets"], CUSTOMER.spec.code)
    frame = versions.frame(CUSTOMER.spec, replay(spark, sf_dir, CUSTOMER), hook_columns(hooks, PRODUCTION))
    pairs = [F.struct(F.lit(h.column).alias("hook_column"), F.hex(h.column).alias("hook")) for h in hooks]
    return frame.select("c_custkey", "___Effective_From", F.inline(F.array(*pairs)))
