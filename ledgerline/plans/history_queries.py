"""Change capture, versions and hooks over the derived snapshot series."""

from __future__ import annotations

from datetime import datetime
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.digest import double_text, row_digest
from ledgerline.functions.hooks import (
    BIGINT,
    DEVELOPMENT,
    INTEGER,
    PRODUCTION,
    VARCHAR,
    Hook,
    development_hook,
    hook_columns,
    production_hook,
)
from ledgerline.operators import versions
from ledgerline.operators.changes import (
    ROWS_A_TASK,
    capture_changes,
    current_state,
    empty_log,
    incremental_changes,
)
from ledgerline.operators.joins import hook_join, hot_values
from ledgerline.plans.registry import query
from ledgerline.plans.series import (
    BY,
    CUSTOMER,
    DOCUMENTS,
    LINEITEM,
    ORDERS,
    Series,
    replay,
    snapshot_dates,
    snapshot_list,
    snapshot_rows,
    table,
)
from ledgerline.operators.narrow import narrow_replay
from ledgerline.sources import frames
from ledgerline.sources import log as log_layer
from ledgerline.sources import std as std_layer
from ledgerline.sources import tables
from ledgerline.session import work_folder
from ledgerline.streaming.continuous import continuous_load

SNAPSHOTS = 4

# SQL counterparts ----------------------------------------------------------


def series_sql(series: Series, count: int = SNAPSHOTS) -> str:
    """Relation ``obs``: rows of every snapshot with digest and seq."""
    base = series.base
    if series.aggregates:
        keys = ", ".join(series.spec.keys)
        base = f"(SELECT {keys}, {', '.join(series.aggregates)} FROM {series.base} GROUP BY {keys})"
    digest = ", ".join(f"coalesce({c}::VARCHAR, '')" for c in series.spec.digest_columns)
    return f"""obs AS (
        SELECT *, md5(concat_ws(chr(31), {digest})) AS md5
        FROM (
            SELECT {', '.join(series.select)},
                   ({series.moving}::DECIMAL(18,2)
                    + floor((({series.number}) % 13 + seq) / 5.0)::DECIMAL(18,2))::DECIMAL(18,2) AS balance,
                   seq AS sync_no, seq
            FROM (SELECT *, unnest([{', '.join(str(i) for i in range(1, count + 1))}])::INTEGER AS seq
                  FROM {base})
            WHERE (({series.number}) * 7 + seq * 3) % 11 <> 0
        )
    )"""


def time_sql(seq: str) -> str:
    return f"make_timestamp(2026, {seq}, 1, 10, 0, 0.0)"


def file_sql(series: Series, seq: str) -> str:
    month = f"lpad(({seq})::VARCHAR, 2, '0')"
    spec = series.spec
    return (
        f"'std/{spec.source}/{spec.table}/year_month=2026-' || {month} || '/{spec.code}_2026' || {month}"
        " || '01_1000.parquet'"
    )


def log_sql(series: Series, count: int = SNAPSHOTS) -> str:
    """Relations ``obs``, ``seen`` and ``log`` (a full replay, ``load_no`` = snapshot)."""
    keys, names = ", ".join(series.spec.keys), ", ".join(series.spec.names)
    return f"""{series_sql(series, count)},
    seen AS (
        SELECT *, lag(seq) OVER k AS seq_before, lead(seq) OVER k AS seq_after, lag(md5) OVER k AS md5_before
        FROM obs WINDOW k AS (PARTITION BY {keys} ORDER BY seq)
    ),
    log AS (
        SELECT {names}, md5, seq AS load_no, false AS deleted FROM seen
        WHERE seq_before IS NULL OR seq_before < seq - 1 OR md5_before <> md5
        UNION ALL
        SELECT {names}, md5, seq + 1 AS load_no, true AS deleted FROM seen
        WHERE seq < {count} AND (seq_after IS NULL OR seq_after > seq + 1)
    )"""


def log_columns_sql(series: Series, names: tuple[str, ...] | None = None) -> str:
    columns = ", ".join(names or series.spec.names)
    return (
        f'{columns}, md5 AS "___Lake_md5", {time_sql("load_no")} AS "___Lake_load_timestamp", '
        f"'{series.spec.code}' AS \"___Lake_datasource\", {file_sql(series, 'load_no')} AS \"___Lake_sourcefile\", "
        'deleted AS "___Lake_isdeleted"'
    )


def state_sql(series: Series, log: str = "log") -> str:
    return (
        f"SELECT * FROM {log} QUALIFY row_number() OVER "
        f"(PARTITION BY {', '.join(series.spec.keys)} ORDER BY load_no DESC) = 1"
    )


LINEAGE_SQL = (
    'md5 AS "___Lake_md5", \'{code}\' AS "___Lake_datasource", {file} AS "___Lake_sourcefile"'
)


def lineage_sql(series: Series) -> str:
    return LINEAGE_SQL.format(code=series.spec.code, file=file_sql(series, "load_no"))


def frame_sql(series: Series, hooks: str = "") -> str:
    return (
        f"SELECT {hooks}{', '.join(series.spec.names)}, {lineage_sql(series)}, "
        f'{time_sql("load_no")} AS "___Effective_From", '
        f'lead({time_sql("load_no")}) OVER (PARTITION BY {", ".join(series.spec.keys)} ORDER BY load_no) AS "___Effective_To", '
        'deleted AS "___Is_Deleted" FROM log'
    )


# Digest --------------------------------------------------------------------


@query(
    "row_digest",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       md5(concat_ws(chr(31), coalesce(l_quantity::VARCHAR, ''), coalesce(l_extendedprice::VARCHAR, ''),
           coalesce(l_discount::VARCHAR, ''), coalesce(l_tax::VARCHAR, ''), coalesce(l_returnflag, ''),
           coalesce(l_linestatus, ''), coalesce(l_shipdate::DATE::VARCHAR, ''))) AS digest
       FROM lineitem""",
)
def row_digest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    names = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", row_digest(rows.schema, names).alias("digest")
    )


@query(
    "double_text",
    """SELECT event_id, value::VARCHAR AS plain, (value * 1e6)::VARCHAR AS large,
       (value / 1e5)::VARCHAR AS small, (value / 1024)::VARCHAR AS fraction FROM events""",
)
def double_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        double_text(value).alias("plain"),
        double_text(value * F.lit(1e6)).alias("large"),
        double_text(value / F.lit(1e5)).alias("small"),
        double_text(value / F.lit(1024.0)).alias("fraction"),
    )


# Change log ----------------------------------------------------------------


@query("full_replay", f"WITH {log_sql(ORDERS)} SELECT {log_columns_sql(ORDERS)} FROM log")
def full_replay_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, sf_dir, ORDERS)


@query("full_replay_composite_key", f"WITH {log_sql(LINEITEM)} SELECT {log_columns_sql(LINEITEM)} FROM log")
def full_replay_composite_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, sf_dir, LINEITEM)


@query(
    "change_counts",
    f"""WITH {log_sql(LINEITEM)}
    SELECT {time_sql('load_no')} AS loaded_at, deleted, count(*) AS changes, count(DISTINCT l_orderkey) AS orders
    FROM log GROUP BY ALL""",
)
def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        replay(spark, sf_dir, LINEITEM)
        .groupBy(F.col("___Lake_load_timestamp").alias("loaded_at"), F.col("___Lake_isdeleted").alias("deleted"))
        .agg(F.count("*").alias("changes"), F.countDistinct("l_orderkey").alias("orders"))
    )


def step_sql(series: Series) -> str:
    """Changes of the last snapshot against the state after the ones before."""
    keys, names = ", ".join(series.spec.keys), series.spec.names
    first = series.spec.keys[0]
    state_names = ", ".join(f"c.{n}" for n in names)
    incoming_names = ", ".join(f"i.{n}" for n in names)
    before = SNAPSHOTS - 1
    return f"""WITH {log_sql(series, before)},
    state AS ({state_sql(series)}),
    incoming AS (
        WITH {series_sql(series, SNAPSHOTS)} SELECT * FROM obs WHERE seq = {SNAPSHOTS}
    ),
    step AS (
        SELECT {incoming_names}, i.md5, {SNAPSHOTS} AS load_no, false AS deleted
        FROM incoming i LEFT JOIN state c USING ({keys})
        WHERE c.md5 IS NULL OR c.deleted OR c.md5 <> i.md5
        UNION ALL
        SELECT {state_names}, c.md5, {SNAPSHOTS} AS load_no, true AS deleted
        FROM state c ANTI JOIN incoming i USING ({keys})
        WHERE NOT c.deleted
    )
    SELECT {log_columns_sql(series)} FROM step WHERE {first} IS NOT NULL"""


@query("incremental_step", step_sql(ORDERS))
def incremental_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot_rows(spark, sf_dir, ORDERS, SNAPSHOTS).where(f"seq = {SNAPSHOTS}")
    log = replay(spark, sf_dir, ORDERS, SNAPSHOTS - 1)
    arrived = snapshot_list(spark, ORDERS, SNAPSHOTS).where(f"seq = {SNAPSHOTS}")
    return incremental_changes(ORDERS.spec, rows, log, arrived, BY)


STABLE = tuple(n for n in CUSTOMER.spec.names if n not in CUSTOMER.spec.volatile)


@query("replay_equals_fold", f"WITH {log_sql(CUSTOMER)} SELECT {log_columns_sql(CUSTOMER, STABLE)} FROM log")
def replay_equals_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log built one snapshot at a time; the counterpart replays them all."""
    rows = snapshot_rows(spark, sf_dir, CUSTOMER, SNAPSHOTS)
    listed = snapshot_list(spark, CUSTOMER, SNAPSHOTS)
    folder = work_folder(spark, "fold")
    log = empty_log(spark, CUSTOMER.spec)
    for seq in range(1, SNAPSHOTS + 1):
        step = capture_changes(
            CUSTOMER.spec, rows.where(F.col("seq") == seq), log=log, snapshots=listed.where(F.col("seq") == seq), by=BY
        )
        step.write.parquet(f"{folder}/step-{seq}")  # each step reads the log once, as a table
        log = spark.read.schema(log.schema).parquet(f"{folder}/step-*")
    return log.drop(*CUSTOMER.spec.volatile)


@query(
    "seeded_replay",
    f"""WITH {log_sql(CUSTOMER)},
    -- a deletion repeats the last row that entered the log, volatile column included
    repeated AS (
        SELECT * REPLACE (
            CASE WHEN deleted THEN last_value(CASE WHEN NOT deleted THEN sync_no END IGNORE NULLS) OVER (
                PARTITION BY c_custkey ORDER BY load_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
            ) ELSE sync_no END AS sync_no)
        FROM log
    )
    SELECT {log_columns_sql(CUSTOMER)} FROM repeated WHERE load_no > 2""",
)
def seeded_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two new snapshots at once on top of a log of two."""
    late = F.col("seq") > 2
    return capture_changes(
        CUSTOMER.spec,
        snapshot_rows(spark, sf_dir, CUSTOMER, SNAPSHOTS).where(late),
        log=replay(spark, sf_dir, CUSTOMER, 2),
        snapshots=snapshot_list(spark, CUSTOMER, SNAPSHOTS).where(late),
        by=BY,
    )


@query(
    "current_state",
    f"WITH {log_sql(ORDERS)}, state AS ({state_sql(ORDERS)}) SELECT {log_columns_sql(ORDERS)} FROM state",
)
def current_state_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_state(ORDERS.spec, replay(spark, sf_dir, ORDERS))


@query("deletions", f"WITH {log_sql(LINEITEM)} SELECT {log_columns_sql(LINEITEM)} FROM log WHERE deleted")
def deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(spark, sf_dir, LINEITEM).where("___Lake_isdeleted")


# Versions ------------------------------------------------------------------


@query("frame_scd2", f"WITH {log_sql(LINEITEM)} {frame_sql(LINEITEM)}")
def frame_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.frame(LINEITEM.spec, replay(spark, sf_dir, LINEITEM))


def latest_sql(series: Series, hooks: str = "", upto: str = "true") -> str:
    return (
        f"WITH {log_sql(series)}, state AS ({state_sql(series, f'(SELECT * FROM log WHERE {upto})')}) "
        f"SELECT {hooks}{', '.join(series.spec.names)}, {lineage_sql(series)} FROM state WHERE NOT deleted"
    )


@query("latest", latest_sql(LINEITEM))
def latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.latest(LINEITEM.spec, replay(spark, sf_dir, LINEITEM))


@query("latest_of_frame", latest_sql(CUSTOMER))
def latest_of_frame_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.latest_of_frame(versions.frame(CUSTOMER.spec, replay(spark, sf_dir, CUSTOMER)))


AT = datetime(2026, 2, 15)


@query("as_of", latest_sql(ORDERS, upto=f"{time_sql('load_no')} <= TIMESTAMP '2026-02-15 00:00:00'"))
def as_of_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.as_of(ORDERS.spec, replay(spark, sf_dir, ORDERS), AT)


@query(
    "one_open_version",
    f"""WITH {log_sql(ORDERS)}, versions AS (
        SELECT o_orderkey, count(*) AS versions,
               sum(CASE WHEN "___Effective_To" IS NULL THEN 1 ELSE 0 END)::BIGINT AS open_versions
        FROM ({frame_sql(ORDERS)}) GROUP BY 1)
    SELECT open_versions, versions, count(*) AS keys FROM versions GROUP BY 1, 2""",
)
def one_open_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys have how many versions, and how many of them are open."""
    frame = versions.frame(ORDERS.spec, replay(spark, sf_dir, ORDERS))
    per_key = frame.groupBy(*ORDERS.spec.keys).agg(
        F.count("*").alias("versions"), F.sum(F.col("___Effective_To").isNull().cast("long")).alias("open_versions")
    )
    return per_key.groupBy("open_versions", "versions").agg(F.count("*").alias("keys"))


# Hooks ---------------------------------------------------------------------

KEY_SET, KEY_SET_BINARY = "star.sal.cust", bytes.fromhex("140102")


def hex_column(name: str) -> Column:
    return F.hex(name).alias(name)


@query("hook_dev", f"SELECT o_orderkey, '{KEY_SET}|' || o_custkey::VARCHAR AS hook FROM orders")
def hook_dev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", development_hook(F.lit(KEY_SET), F.col("o_custkey")).alias("hook")
    )


def _production(spark: SparkSession, sf_dir: str, name: str, key: list[str], value: str, encoding: str) -> DataFrame:
    hook = production_hook(F.lit(bytearray(KEY_SET_BINARY)), F.expr(value), encoding)
    return table(spark, sf_dir, name).select(*key, F.hex(hook).alias("hook"))


@query("hook_prod_int", "SELECT o_orderkey, '140102' || printf('%08X', o_custkey) AS hook FROM orders")
def hook_prod_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _production(spark, sf_dir, "orders", ["o_orderkey"], "o_custkey", INTEGER)


@query(
    "hook_prod_bigint",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       '140102' || printf('%016X', l_orderkey * 1000000007 + l_linenumber) AS hook FROM lineitem""",
)
def hook_prod_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return _production(spark, sf_dir, "lineitem", key, "l_orderkey * 1000000007L + l_linenumber", BIGINT)


@query("hook_prod_varchar", "SELECT conv_id, turn, '140102' || hex(encode(text)) AS hook FROM conversations")
def hook_prod_varchar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _production(spark, sf_dir, "conversations", ["conv_id", "turn"], "text", VARCHAR)


ORDER_HOOKS = [
    Hook(1, "HK_ORDER", "star.sal.ord", bytes.fromhex("140101"), "o_orderkey", "o_orderkey", BIGINT),
    Hook(2, "HK_CUSTOMER__Buyer", KEY_SET, KEY_SET_BINARY, "o_custkey", "o_custkey", INTEGER),
]
CUSTOMER_HOOKS = [Hook(3, "HK_CUSTOMER", KEY_SET, KEY_SET_BINARY, "c_custkey", "c_custkey", INTEGER)]


@query(
    "frame_with_hooks",
    f"""WITH {log_sql(ORDERS)} {frame_sql(ORDERS, "'140101' || printf('%016X', o_orderkey) AS HK_ORDER, "
        "'140102' || printf('%08X', o_custkey) AS HK_CUSTOMER__Buyer, ")}""",
)
def frame_with_hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = versions.frame(ORDERS.spec, replay(spark, sf_dir, ORDERS), hook_columns(ORDER_HOOKS, PRODUCTION))
    return frame.withColumns({h.column: F.hex(h.column) for h in ORDER_HOOKS})


@query(
    "hook_join",
    f"""WITH o AS ({latest_sql(ORDERS)}), c AS ({latest_sql(CUSTOMER)})
    SELECT o.o_orderkey, '140102' || printf('%08X', o.o_custkey) AS "HK_CUSTOMER__Buyer",
           o.balance AS order_balance, c.c_name, c.c_mktsegment
    FROM o LEFT JOIN c ON o.o_custkey = c.c_custkey""",
)
def hook_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current orders with the current customer that placed them, if any."""
    orders = versions.latest(ORDERS.spec, replay(spark, sf_dir, ORDERS), hook_columns(ORDER_HOOKS, PRODUCTION))
    customers = versions.latest(
        CUSTOMER.spec, replay(spark, sf_dir, CUSTOMER), hook_columns(CUSTOMER_HOOKS, PRODUCTION)
    )
    joined = hook_join(
        orders.select("o_orderkey", "HK_CUSTOMER__Buyer", F.col("balance").alias("order_balance")),
        customers.select("HK_CUSTOMER", "c_name", "c_mktsegment"),
        "HK_CUSTOMER__Buyer",
        right_hook="HK_CUSTOMER",
    )
    return joined.select("o_orderkey", hex_column("HK_CUSTOMER__Buyer"), "order_balance", "c_name", "c_mktsegment")


@query(
    "hook_join_skewed",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, s.s_name
    FROM (SELECT *, CASE WHEN l_returnflag = 'A' THEN 7 WHEN l_linestatus = 'F' THEN NULL ELSE l_suppkey END AS who
          FROM lineitem) l
    LEFT JOIN supplier s ON l.who = s.s_suppkey""",
)
def hook_join_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows share one hook and a third have none."""
    who = F.expr("CASE WHEN l_returnflag = 'A' THEN 7 WHEN l_linestatus = 'F' THEN NULL ELSE l_suppkey END")
    prefix = F.lit(bytearray(bytes.fromhex("140103")))
    left = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        production_hook(prefix, who, INTEGER).alias("HK_SUPPLIER__Seller"),
    )
    right = table(spark, sf_dir, "supplier").select(
        production_hook(prefix, F.col("s_suppkey"), INTEGER).alias("HK_SUPPLIER"), "s_name"
    )
    hot = hot_values(left, "HK_SUPPLIER__Seller")
    joined = hook_join(left, right, "HK_SUPPLIER__Seller", right_hook="HK_SUPPLIER", hot=hot)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "s_name")


# Layers and stream ---------------------------------------------------------


def _partitioned(spark: SparkSession, sf_dir: str, series: Series, by_keys: bool = False) -> DataFrame:
    month = F.lpad(F.col("seq").cast("string"), 2, "0")
    return snapshot_rows(spark, sf_dir, series, SNAPSHOTS, by_keys).select(
        *series.spec.names,
        F.concat(F.lit("2026-"), month).alias("year_month"),
        F.concat(F.lit("2026"), month, F.lit("01_1000")).alias("snapshot"),
    )


def _write_std(spark: SparkSession, sf_dir: str, series: Series, root: str) -> None:
    """Std snapshots from the tasks that aggregate the table: its rows are shuffled, those of its snapshots are not."""
    rows = _partitioned(spark, sf_dir, series, by_keys=True).sortWithinPartitions(*std_layer.BY, *series.spec.keys)
    std_layer.write(series.spec, rows, root, gather=False)


def _stable_log(log: DataFrame, series: Series) -> DataFrame:
    return log.drop("___Lake_sourcefile", *series.spec.volatile)


def stable_log_sql(series: Series, count: int = SNAPSHOTS) -> str:
    names = ", ".join(n for n in series.spec.names if n not in series.spec.volatile)
    return (
        f'WITH {log_sql(series, count)} SELECT {names}, md5 AS "___Lake_md5", '
        f'{time_sql("load_no")} AS "___Lake_load_timestamp", \'{series.spec.code}\' AS "___Lake_datasource", '
        'deleted AS "___Lake_isdeleted" FROM log'
    )


@query("raw_to_log", stable_log_sql(ORDERS))
def raw_to_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV exports to Std to change log, through files."""
    root = work_folder(spark, "raw-to-log")
    spec = ORDERS.spec
    rows = _partitioned(spark, sf_dir, ORDERS)
    for seq in range(1, SNAPSHOTS + 1):
        stamp = f"2026{seq:02d}01_1000"
        one = rows.where(F.col("sync_no") == seq).select(*spec.names)
        one.write.option("header", True).csv(
            f"{root}/raw/{spec.source}/{spec.table}/year_month=2026-{seq:02d}/{spec.table}_{stamp}.csv"
        )
    std_layer.standardize_all(spark, spec, f"{root}/raw", f"{root}/std")
    log_layer.rebuild(spark, f"{root}/lake", f"{root}/std", spec)
    return _stable_log(log_layer.read(spark, f"{root}/lake", spec), ORDERS)


@query("continuous_load", stable_log_sql(CUSTOMER))
def continuous_load_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Std snapshots picked up by the stream in two runs."""
    root = work_folder(spark, "continuous-load")
    rows = _partitioned(spark, sf_dir, CUSTOMER)
    for part in (F.col("sync_no") <= 2, F.col("sync_no") > 2):
        std_layer.write(CUSTOMER.spec, rows.where(part), f"{root}/std")
        continuous_load(
            spark, CUSTOMER.spec, f"{root}/std", f"{root}/lake", f"{root}/checkpoint"
        ).awaitTermination()
    return _stable_log(log_layer.read(spark, f"{root}/lake", CUSTOMER.spec), CUSTOMER)


@query("kept_state_loads", stable_log_sql(LINEITEM))
def kept_state_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load after load, each on top of the kept state and at most one load after it; the last one twice."""
    root = work_folder(spark, "kept-state")
    spec = LINEITEM.spec
    _write_std(spark, sf_dir, LINEITEM, f"{root}/std")
    for seq in (*range(1, SNAPSHOTS + 1), SNAPSHOTS):
        log_layer.load(spark, f"{root}/lake", f"{root}/std", spec, [f"2026{seq:02d}01_1000"], tail_loads=1)
    return _stable_log(log_layer.read(spark, f"{root}/lake", spec), LINEITEM)


def stable_frame_sql(series: Series) -> str:
    names = ", ".join(n for n in series.spec.names if n not in series.spec.volatile)
    keys = ", ".join(series.spec.keys)
    return (
        f'WITH {log_sql(series)} SELECT {names}, md5 AS "___Lake_md5", \'{series.spec.code}\' AS "___Lake_datasource", '
        f'{time_sql("load_no")} AS "___Effective_From", lead({time_sql("load_no")}) OVER (PARTITION BY {keys} ORDER BY load_no) '
        'AS "___Effective_To", deleted AS "___Is_Deleted" FROM log'
    )


@query("maintained_frame", stable_frame_sql(LINEITEM))
def maintained_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame kept beside the log: built after two loads, then brought up to date by each, the last one twice."""
    root, spec = work_folder(spark, "maintained-frame"), LINEITEM.spec
    _write_std(spark, sf_dir, LINEITEM, f"{root}/std")
    for seq in range(1, SNAPSHOTS + 1):
        log_layer.load(spark, f"{root}/lake", f"{root}/std", spec, [f"2026{seq:02d}01_1000"])
        if seq > 1:
            frames.refresh(spark, f"{root}/lake", f"{root}/frames", spec, buckets=4)
    frames.refresh(spark, f"{root}/lake", f"{root}/frames", spec, buckets=4)
    return _stable_log(frames.read(spark, f"{root}/lake", f"{root}/frames", spec), LINEITEM)


def _wide_std(spark: SparkSession, sf_dir: str) -> str:
    """Std snapshots of whole documents."""
    root = work_folder(spark, "wide-std")
    rows = snapshot_rows(spark, sf_dir, DOCUMENTS, SNAPSHOTS)
    for seq, month, stamp in snapshot_dates(SNAPSHOTS):
        std_layer.write_snapshot(DOCUMENTS.spec, rows.where(F.col("seq") == seq), f"{root}/std", month, stamp)
    return f"{root}/std"


@query("narrow_replay", stable_log_sql(DOCUMENTS))
def narrow_replay_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full replay of whole documents; only keys, digests and addresses cross the shuffle."""
    root = _wide_std(spark, sf_dir)
    files, listed = std_layer.scan(spark, root, DOCUMENTS.spec), std_layer.snapshots(spark, root, DOCUMENTS.spec)
    return _stable_log(narrow_replay(DOCUMENTS.spec, files, listed, std_layer.BY), DOCUMENTS)


def _buckets(spark: SparkSession, sf_dir: str, series: Series) -> int:
    """As many buckets as the cluster shuffles into, and so many that a task can sort the history of one."""
    rows = table(spark, sf_dir, series.base).count() * SNAPSHOTS  # footers only
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(rows / ROWS_A_TASK))


def _clustered_std(spark: SparkSession, sf_dir: str, series: Series) -> tuple[str, str, int]:
    """A Std table bucketed on the key, the name prefix of its snapshots, and its buckets."""
    root, buckets = work_folder(spark, "clustered"), _buckets(spark, sf_dir, series)
    name = "ledgerline_" + root.rsplit("-", 1)[-1]
    tables.create_std(spark, name, series.spec, buckets, f"{root}/std")
    tables.write_clustered(_partitioned(spark, sf_dir, series), name, series.spec.keys, buckets)
    return name, "std", buckets


@query("clustered_replay", f"WITH {log_sql(ORDERS)} SELECT {log_columns_sql(ORDERS)} FROM log")
def clustered_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full replay of a bucketed Std table: no shuffle of the history."""
    name, root, _ = _clustered_std(spark, sf_dir, ORDERS)
    return tables.replay_table(spark, name, root, ORDERS.spec)


@query("clustered_step", step_sql(ORDERS))
def clustered_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last snapshot against a bucketed log of the ones before."""
    name, root, buckets = _clustered_std(spark, sf_dir, ORDERS)
    log, last = f"{name}_log", f"2026{SNAPSHOTS:02d}01_1000"
    tables.create_log(spark, log, ORDERS.spec, buckets, f"{work_folder(spark, 'clustered-log')}/log")
    tables.write_log(replay(spark, sf_dir, ORDERS, SNAPSHOTS - 1), log, ORDERS.spec, buckets)
    return tables.step_table(spark, name, log, root, ORDERS.spec, last)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current customers with their development hook, from a replay of four snapshots."""
    log = replay(spark, sf_dir, CUSTOMER)
    frame = versions.frame(CUSTOMER.spec, log, hook_columns(CUSTOMER_HOOKS, DEVELOPMENT))
    return versions.latest_of_frame(frame)
