"""Parsing, checks, metadata, load state and flattening over whole tables."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.parse import blank_to_null, snapshot_path, typed
from ledgerline.operators import checks
from ledgerline.operators.equality import row_differences
from ledgerline.operators.flatten import Structure, flatten, parse_json
from ledgerline.operators.variants import flatten_undeclared, found_shape, structure_drift
from ledgerline.plans.registry import query
from ledgerline.plans.series import ORDERS, snapshot_rows, table
from ledgerline.plans.history_queries import series_sql
from ledgerline.sources import metadata, raw, state, std
from ledgerline.spec import BLANK, DATE, FLAG, RAW_FILENAME, Column

# Parsing -------------------------------------------------------------------


@query(
    "typed_projection",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag,
       l_shipdate::DATE AS l_shipdate, l_linestatus = 'O' AS is_open FROM lineitem""",
)
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text rows through the declared types, dates and flags."""
    text = table(spark, sf_dir, "lineitem").select(
        *[F.col(c).cast("string").alias(c) for c in (
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
        )],
        F.date_format("l_shipdate", "dd.MM.yyyy").alias("l_shipdate"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("is_open"),
    )
    columns = (
        Column("l_orderkey", "bigint"), Column("l_linenumber", "int"), Column("l_partkey", "bigint"),
        Column("l_suppkey", "bigint"), Column("l_quantity", "double"), Column("l_extendedprice", "double"),
        Column("l_returnflag"), Column("l_shipdate", "date", DATE), Column("is_open", "boolean", FLAG),
    )
    return text.select(*[typed(c) for c in columns])


@query(
    "date_parse",
    """SELECT o_orderkey, strptime(strftime(o_orderdate, '%-d.%-m.%Y'), '%d.%m.%Y')::DATE AS ordered
       FROM orders""",
)
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "d.M.yyyy").alias("ordered"))
    return text.select("o_orderkey", typed(Column("ordered", "date", DATE)))


@query(
    "blank_to_null",
    """SELECT p_partkey, nullif(trim(CASE WHEN p_size % 3 = 0 THEN '  ' ELSE ' ' || p_name END), '') AS name
       FROM part""",
)
def blank_to_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.when(F.col("p_size") % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", padded.alias("name")).select(
        "p_partkey", typed(Column("name", "string", BLANK))
    )


@query(
    "enumerated_default",
    """SELECT encoding, encoding IN ('integer', 'bigint', 'varchar') AS known, count(*) AS rows FROM (
        SELECT coalesce(lower(nullif(trim(CASE o_orderstatus WHEN 'O' THEN ' Integer ' WHEN 'F' THEN ' '
               ELSE o_orderpriority END), '')), 'bigint') AS encoding FROM orders)
       GROUP BY ALL""",
)
def enumerated_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(F.col("o_orderstatus") == "O", " Integer ")
        .when(F.col("o_orderstatus") == "F", " ")
        .otherwise(F.col("o_orderpriority"))
    )
    encoding = F.coalesce(F.lower(blank_to_null(text)), F.lit("bigint"))
    return (
        table(spark, sf_dir, "orders")
        .select(encoding.alias("encoding"))
        .groupBy("encoding", F.col("encoding").isin("integer", "bigint", "varchar").alias("known"))
        .agg(F.count("*").alias("rows"))
    )


@query(
    "latest_period",
    """SELECT source, CASE WHEN newest IS NOT NULL
            THEN printf('%04d-%02d', newest.y, newest.m) END AS latest_period
       FROM (
        SELECT o_orderpriority AS source,
               max(CASE WHEN y IS NOT NULL AND m IS NOT NULL THEN {'y': y, 'm': m} END) AS newest
        FROM (SELECT o_orderpriority,
                     TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE strftime(o_orderdate, '%Y') END AS INTEGER) AS y,
                     TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%m') END AS INTEGER) AS m
              FROM orders)
        GROUP BY 1)""",
)
def latest_period_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy")).alias("year"),
        F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.date_format("o_orderdate", "MM")).alias("month"),
    )
    return raw.latest_period(rows, "year", "month", by=("source",))


# Checks --------------------------------------------------------------------


@query(
    "schema_drift",
    """WITH actual AS (SELECT DISTINCT user_id || '/' || ts::DATE AS file, event_type AS name FROM events),
    expected AS (SELECT DISTINCT file, unnest(['click', 'view', 'Error', 'signup']) AS name FROM actual),
    sides AS (
        SELECT file, 'missing: ' || string_agg(name, ', ' ORDER BY name) AS side
        FROM (FROM expected EXCEPT FROM actual) GROUP BY file
        UNION ALL
        SELECT file, 'unexpected: ' || string_agg(name, ', ' ORDER BY name)
        FROM (FROM actual EXCEPT FROM expected) GROUP BY file)
    SELECT file, string_agg(side, '; ' ORDER BY side) AS drift FROM sides GROUP BY file""",
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's day of events as a file whose columns are the event types seen."""
    file = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.col("ts").cast("date").cast("string"))
    actual = table(spark, sf_dir, "events").select(file.alias("file"), F.col("event_type").alias("name"))
    names = F.array(*[F.lit(n) for n in ("click", "view", "Error", "signup")])
    expected = actual.select("file").distinct().select("file", F.explode(names).alias("name"))
    return checks.column_drift(expected, actual, "file", "name")


@query(
    "domain_check",
    """SELECT v."column" AS "column", v.value AS value, count(*) AS rows FROM (
        SELECT unnest([
            CASE WHEN coalesce(o_orderstatus, '') NOT IN ('O', '1-URGENT')
                 THEN {'column': 'o_orderstatus', 'value': o_orderstatus} END,
            CASE WHEN coalesce(o_orderpriority, '') NOT IN ('O', '1-URGENT')
                 THEN {'column': 'o_orderpriority', 'value': o_orderpriority} END,
            CASE WHEN coalesce(note, '') NOT IN ('O', '1-URGENT') THEN {'column': 'note', 'value': note} END
        ]) AS v
        FROM (SELECT *, nullif(o_orderstatus, 'P') AS note FROM orders))
       WHERE v IS NOT NULL GROUP BY ALL""",
)
def domain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("note", F.nullif("o_orderstatus", F.lit("P")))
    return checks.domain_violations(rows, ["o_orderstatus", "o_orderpriority", "note"], ["O", "1-URGENT"])


@query(
    "null_key_check",
    """SELECT 'priority' AS "column", o_orderstatus || '/' || o_custkey AS label, count(*) AS rows
       FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NULL GROUP BY ALL""",
)
def null_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return checks.null_keys(rows, ["o_orderkey", "priority"], ["o_orderstatus", "o_custkey"])


@query(
    "uniqueness_check",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def uniqueness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "referential_check",
    """SELECT doc_id, count(*) AS rows FROM documents
       WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id) GROUP BY ALL""",
)
def referential_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.missing_parents(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id"
    )


@query(
    "pattern_check",
    "SELECT p_partkey, p_brand FROM part WHERE NOT regexp_full_match(p_brand, 'Brand#[1-9][0-9]')",
)
def pattern_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.pattern_violations(table(spark, sf_dir, "part"), "p_brand", "Brand#[1-9][0-9]").select(
        "p_partkey", "p_brand"
    )


@query("range_check", "SELECT p_partkey, p_size FROM part WHERE p_size NOT BETWEEN 5 AND 40")
def range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.range_violations(table(spark, sf_dir, "part"), "p_size", 5, 40).select("p_partkey", "p_size")


@query(
    "encoding_consistency",
    """SELECT l_partkey, min(l_returnflag) AS lowest, max(l_returnflag) AS highest, count(*) AS rows
       FROM lineitem GROUP BY 1 HAVING min(l_returnflag) <> max(l_returnflag)""",
)
def encoding_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.mixed_values(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_returnflag")


# Snapshots and files -------------------------------------------------------

FILE_SQL = """SELECT DISTINCT 'raw/star/events/year_month=' || strftime(ts, '%Y-%m') || '/events_u' || user_id || '_'
    || strftime(ts, '%Y%m%d_%H%M') || '.csv' AS file,
    strftime(ts, '%Y-%m') AS year_month, strftime(ts, '%Y%m%d_%H%M') AS stamp,
    date_trunc('minute', ts) AS time, user_id, event_id % 4 AS shard FROM events"""


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files the events could have come from: one per user and minute."""
    ts = F.col("ts")
    path = F.concat(
        F.lit("raw/star/events/year_month="), F.date_format(ts, "yyyy-MM"), F.lit("/events_u"),
        F.col("user_id").cast("string"), F.lit("_"), F.date_format(ts, "yyyyMMdd_HHmm"), F.lit(".csv"),
    )
    return table(spark, sf_dir, "events").select(path.alias("file"), "user_id", (F.col("event_id") % 4).alias("shard"))


def described_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("file")
    stamp = raw.file_stamp(path)
    return event_files(spark, sf_dir).select(
        "file", raw.file_month(path).alias("year_month"), stamp.alias("stamp"), raw.stamp_time(stamp).alias("time"),
        "user_id", "shard",
    )


@query(
    "raw_provenance",
    f"SELECT DISTINCT file, year_month, stamp, time AS taken_at FROM ({FILE_SQL})",
)
def raw_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month, stamp and instant parsed from paths (single files and folders of parts)."""
    parts = event_files(spark, sf_dir).select(F.concat("file", F.lit("/part-00000.csv")).alias("path"))
    path = snapshot_path(F.col("path"))
    rows = parts.select(path.alias(RAW_FILENAME)).select(
        F.col(RAW_FILENAME).alias("file"),
        raw.file_month(F.col(RAW_FILENAME)).alias("year_month"),
        raw.file_stamp(F.col(RAW_FILENAME)).alias("stamp"),
    )
    return rows.distinct().withColumn("taken_at", raw.stamp_time(F.col("stamp")))


@query(
    "snapshot_list",
    f"""SELECT file, min(time) AS min_time FROM ({FILE_SQL}) GROUP BY file ORDER BY min(time), file""",
)
def snapshot_list_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.list_snapshots(described_files(spark, sf_dir))


@query(
    "std_paths",
    f"""SELECT DISTINCT file, 'std/star/events/year_month=' || year_month || '/star_events_' || stamp || '.parquet'
        AS std_file FROM ({FILE_SQL})""",
)
def std_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = event_files(spark, sf_dir).select("file").distinct()
    return files.select("file", std.std_path("std", "star", "events", F.col("file")).alias("std_file"))


@query(
    "pending_snapshots",
    f"""WITH files AS (SELECT DISTINCT file, year_month, stamp, time FROM ({FILE_SQL})),
    existing AS (SELECT DISTINCT CASE WHEN shard < 2 THEN 'events' ELSE 'events_props' END AS "table",
                 year_month, stamp FROM ({FILE_SQL}) WHERE shard < 3)
    SELECT file, time FROM files f WHERE EXISTS (
        SELECT 1 FROM (VALUES ('events'), ('events_props')) t(name)
        WHERE NOT EXISTS (SELECT 1 FROM existing e
            WHERE e."table" = t.name AND e.year_month = f.year_month AND e.stamp = f.stamp))""",
)
def pending_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files that lack a Std snapshot of one of two tables."""
    described = described_files(spark, sf_dir)
    existing = (
        described.where("shard < 3")
        .select(F.when(F.col("shard") < 2, "events").otherwise("events_props").alias("table"), "year_month", "stamp")
        .distinct()
    )
    files = described.select("file", "year_month", "stamp", "time").distinct()
    return std.pending(files, ["events", "events_props"], existing)


EQUALITY_SQL = f"""WITH {series_sql(ORDERS)},
    l AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, balance FROM obs WHERE seq = 1),
    r AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, balance FROM obs WHERE seq = 2)"""


@query(
    "snapshot_equality",
    f"""{EQUALITY_SQL},
    d AS (SELECT 1 AS side, count(*) AS n FROM (FROM l EXCEPT ALL FROM r)
          UNION ALL SELECT -1, count(*) FROM (FROM r EXCEPT ALL FROM l))
    SELECT sum(n) = 0 AS same, sum(CASE WHEN side = 1 THEN n ELSE 0 END)::BIGINT AS only_left,
           sum(CASE WHEN side = -1 THEN n ELSE 0 END)::BIGINT AS only_right FROM d""",
)
def snapshot_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports compared in any row order, without the volatile column."""
    rows = snapshot_rows(spark, sf_dir, ORDERS, 2)
    left, right = (rows.where(F.col("seq") == s).drop("seq") for s in (1, 2))
    surplus = F.col("surplus")
    return row_differences(left, right, ORDERS.spec.volatile).agg(
        (F.count("*") == 0).alias("same"),
        F.coalesce(F.sum(F.when(surplus > 0, surplus)), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.when(surplus < 0, -surplus)), F.lit(0)).alias("only_right"),
    )


@query(
    "snapshot_differences",
    """SELECT text_md5, lang, source, n_chars, surplus FROM (
        SELECT md5(text) AS text_md5, lang, source, n_chars, sum(CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END)::BIGINT AS surplus
        FROM documents GROUP BY ALL) WHERE surplus <> 0""",
)
def snapshot_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that two halves of the documents do not share, with how often; the whole text by its digest."""
    rows = table(spark, sf_dir, "documents").withColumn("text_md5", F.md5("text"))
    even, odd = (rows.where(F.col("doc_id") % 2 == i).drop("doc_id", "text") for i in (0, 1))
    return row_differences(even, odd)


@query(
    "snapshot_row_differences",
    """SELECT text, lang, source, n_chars, surplus FROM (
        SELECT text, lang, source, n_chars, sum(CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END)::BIGINT AS surplus
        FROM documents GROUP BY ALL) WHERE surplus <> 0""",
)
def snapshot_row_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows, text included, that two halves of the documents do not share, with how often."""
    rows = table(spark, sf_dir, "documents")
    even, odd = (rows.where(F.col("doc_id") % 2 == i).drop("doc_id") for i in (0, 1))
    return row_differences(even, odd)


# Metadata derived from the dimension tables --------------------------------

# regions are domains, nations concepts, part sizes sources, parts datasets and
# suppliers and customers give the hooks
META_SQL = """sources AS (SELECT DISTINCT p_size::INTEGER AS id, 'src' || p_size AS code FROM part),
    datasets AS (SELECT p_partkey::INTEGER AS id, 'src' || p_size || '_' || p_partkey AS code,
                 p_size::INTEGER AS source_id FROM part),
    domains AS (SELECT r_regionkey AS id, lower(substr(r_name, 1, 3)) AS code FROM region),
    concepts AS (SELECT n_nationkey AS id, lower(n_name) AS code, n_name AS name, n_regionkey AS domain_id FROM nation),
    hooks AS (
        SELECT (c_custkey * 2)::INTEGER AS id, c_nationkey AS concept_id, (c_custkey % 200)::INTEGER AS dataset_id,
               'c_name' AS dev, 'c_custkey' AS prod, 'bigint' AS encoding,
               'C' || c_custkey AS role FROM customer
        UNION ALL
        SELECT (s_suppkey * 2 + 1)::INTEGER, s_nationkey, (s_suppkey % 200)::INTEGER, 's_name', 's_suppkey', 'bigint', NULL
        FROM supplier)"""


def derived_metadata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Text metadata tables, as if read from files."""
    part, nation, region = (table(spark, sf_dir, n) for n in ("part", "nation", "region"))
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")

    def text(name: str) -> SparkColumn:
        return F.col(name).cast("string")

    none = F.lit(None).cast("string")
    hooks = customer.select(
        (F.col("c_custkey") * 2).cast("string").alias("id"), text("c_nationkey").alias("business_concept_id"),
        (F.col("c_custkey") % 200).cast("string").alias("dataset_id"), F.lit("c_name").alias("hook_expression_dev"),
        F.lit("c_custkey").alias("hook_expression_prod"), F.lit("").alias("hook_encoding"),
        F.concat(F.lit("C"), text("c_custkey")).alias("hook_role"),
    ).unionByName(
        supplier.select(
            (F.col("s_suppkey") * 2 + 1).cast("string").alias("id"), text("s_nationkey").alias("business_concept_id"),
            (F.col("s_suppkey") % 200).cast("string").alias("dataset_id"), F.lit("s_name").alias("hook_expression_dev"),
            F.lit("s_suppkey").alias("hook_expression_prod"), F.lit(" BIGINT ").alias("hook_encoding"), none.alias("hook_role"),
        )
    )
    source_code = F.concat(F.lit("src"), text("p_size"))
    return {
        "sources": part.select(
            text("p_size").alias("id"), source_code.alias("code"), none.alias("name"), none.alias("scope"), none.alias("url")
        ).distinct(),
        "datasets": part.select(
            text("p_partkey").alias("id"), F.concat(source_code, F.lit("_"), text("p_partkey")).alias("code"),
            F.col("p_name").alias("name"), text("p_size").alias("source_id"),
            *[none.alias(c) for c in metadata.COLUMNS["datasets"][4:]],
        ),
        "business_domains": region.select(
            text("r_regionkey").alias("id"), F.lower(F.substring("r_name", 1, 3)).alias("code"),
            F.col("r_name").alias("name"), none.alias("description"),
        ),
        "business_concepts": nation.select(
            text("n_nationkey").alias("id"), F.lower("n_name").alias("code"), F.col("n_name").alias("name"),
            none.alias("description"), text("n_regionkey").alias("business_domain_id"),
        ),
        "hooks": hooks,
    }


REGISTRY_SQL = f"""WITH {META_SQL}
    SELECT h.id, h.concept_id AS business_concept_id, h.dataset_id, h.dev AS hook_expression_dev,
           h.prod AS hook_expression_prod, h.encoding AS hook_encoding, h.role AS hook_role,
           s.code || '.' || d.code || '.' || c.code AS key_set,
           printf('%02X', s.id) || printf('%02X', d.id) || printf('%02X', c.id) AS key_set_binary,
           'HK_' || upper(regexp_replace(c.name, '[^A-Za-z0-9]', '_', 'g')) || coalesce('__' || h.role, '') AS hook_column
    FROM hooks h LEFT JOIN datasets ds ON ds.id = h.dataset_id LEFT JOIN sources s ON s.id = ds.source_id
    LEFT JOIN concepts c ON c.id = h.concept_id LEFT JOIN domains d ON d.id = c.domain_id"""


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived_metadata(spark, sf_dir)
    return metadata.hook_registry(
        metadata.hook_rows(tables["hooks"]),
        metadata.datasets(tables["datasets"]),
        metadata.sources(tables["sources"]),
        metadata.business_concepts(tables["business_concepts"]),
        metadata.business_domains(tables["business_domains"]),
    )


@query("hook_registry", REGISTRY_SQL)
def hook_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registry(spark, sf_dir).withColumn("key_set_binary", F.hex("key_set_binary"))


@query(
    "key_sets",
    f"SELECT key_set, key_set_binary, count(*) AS hooks FROM ({REGISTRY_SQL}) GROUP BY ALL",
)
def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _registry(spark, sf_dir)
        .groupBy("key_set", F.hex("key_set_binary").alias("key_set_binary"))
        .agg(F.count("*").alias("hooks"))
    )


@query(
    "hook_rule_check",
    f"""WITH {META_SQL}, h AS (
        SELECT o_orderkey::INTEGER AS id, (o_custkey % 27)::INTEGER AS concept_id,
               (o_custkey + 900)::INTEGER AS dataset_id,
               CASE WHEN o_orderkey % 10 <> 3 THEN 'o_orderkey' END AS dev,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'float' WHEN '2-HIGH' THEN 'varchar' ELSE 'integer' END AS encoding,
               CASE WHEN o_orderstatus = 'F' THEN 'licensee' ELSE 'Buyer' END AS role
        FROM orders),
    r AS (
        SELECT h.*, ds.id AS d_id, c.id AS c_id, s.code || '.' || d.code || '.' || c.code AS key_set,
               count(*) OVER (PARTITION BY h.dataset_id, h.concept_id, h.role) AS role_count
        FROM h LEFT JOIN datasets ds ON ds.id = h.dataset_id LEFT JOIN sources s ON s.id = ds.source_id
        LEFT JOIN concepts c ON c.id = h.concept_id LEFT JOIN domains d ON d.id = c.domain_id),
    m AS (
        SELECT id, key_set, min(encoding) OVER k <> max(encoding) OVER k AS mixed
        FROM r WHERE key_set IS NOT NULL WINDOW k AS (PARTITION BY key_set))
    SELECT id, 'hooks.csv id ' || id || ': empty hook_expression_dev' AS message FROM h WHERE dev IS NULL
    UNION ALL
    SELECT id, 'hooks.csv id ' || id || ': unknown hook_encoding ' || encoding || ' (integer, bigint or varchar)'
    FROM h WHERE encoding = 'float'
    UNION ALL
    SELECT id, 'hooks.csv id ' || id || ': hook_role ' || role
        || ' must be an uppercase letter followed by letters or digits' FROM h WHERE role = 'licensee'
    UNION ALL
    SELECT id, 'hooks.csv id ' || id || ': dataset ' || dataset_id || ' has more than one hook for business concept '
        || concept_id || ' with role ' || role || ' (give each a different hook_role)' FROM r WHERE role_count > 1
    UNION ALL
    SELECT id, 'hooks.csv id ' || id || ': unknown dataset_id ' || dataset_id FROM r WHERE d_id IS NULL
    UNION ALL
    SELECT id, 'hooks.csv id ' || id || ': unknown business_concept_id ' || concept_id FROM r WHERE c_id IS NULL
    UNION ALL
    SELECT id, 'hooks.csv id ' || id || ': key set ' || key_set || ' has hooks with different hook_encoding'
    FROM m WHERE mixed""",
)
def hook_rule_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders taken for hooks: every rule they break, one row each."""
    tables = derived_metadata(spark, sf_dir)
    text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        (F.col("o_custkey") % 27).cast("string").alias("business_concept_id"),
        (F.col("o_custkey") + 900).cast("string").alias("dataset_id"),
        F.when(F.col("o_orderkey") % 10 == 3, " ").otherwise("o_orderkey").alias("hook_expression_dev"),
        F.lit("o_custkey").alias("hook_expression_prod"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "float")
        .when(F.col("o_orderpriority") == "2-HIGH", "Varchar")
        .otherwise("integer")
        .alias("hook_encoding"),
        F.when(F.col("o_orderstatus") == "F", "licensee").otherwise("Buyer").alias("hook_role"),
    )
    return metadata.hook_problems(
        metadata.hook_rows(text),
        metadata.datasets(tables["datasets"]),
        metadata.sources(tables["sources"]),
        metadata.business_concepts(tables["business_concepts"]),
        metadata.business_domains(tables["business_domains"]),
    )


@query(
    "domain_rule_check",
    """SELECT p_partkey::INTEGER AS id, 'business_domains.csv id ' || p_partkey::INTEGER
           || ': must fit in one byte (0-255) for key_set_binary' AS message
       FROM part WHERE p_partkey NOT BETWEEN 0 AND 255
       UNION ALL
       SELECT p_partkey::INTEGER, 'business_domains.csv id ' || p_partkey || ': code ' || lower(substr(p_name, 1, 3))
           || ' must be exactly 3 lowercase letters or digits'
       FROM part WHERE NOT regexp_full_match(lower(substr(p_name, 1, 3)), '[a-z0-9]{3}')
       UNION ALL
       SELECT NULL, 'business_domains.csv: duplicate code ' || lower(substr(p_name, 1, 3))
       FROM part GROUP BY lower(substr(p_name, 1, 3)) HAVING count(*) > 1
       UNION ALL
       SELECT p_partkey::INTEGER, 'business_domains.csv id ' || p_partkey || ': empty name'
       FROM part WHERE p_size % 7 = 0""",
)
def domain_rule_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts taken for business domains: every rule they break."""
    text = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.lower(F.substring("p_name", 1, 3)).alias("code"),
        F.when(F.col("p_size") % 7 == 0, " ").otherwise(F.col("p_name")).alias("name"), F.lit("").alias("description"),
    )
    return metadata.domain_problems(metadata.business_domains(text))


@query(
    "concept_rule_check",
    """SELECT c_custkey::INTEGER AS id, 'business_concepts.csv id ' || c_custkey
           || ': unknown business_domain_id ' || (c_nationkey % 8) AS message
       FROM customer WHERE c_nationkey % 8 NOT IN (SELECT r_regionkey FROM region)
       UNION ALL
       SELECT NULL, 'business_concepts.csv: duplicate code ' || c_mktsegment
       FROM customer GROUP BY c_mktsegment HAVING count(*) > 1""",
)
def concept_rule_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers taken for business concepts: every rule they break."""
    text = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("code"),
        F.col("c_name").alias("name"), F.lit("").alias("description"),
        (F.col("c_nationkey") % 8).cast("string").alias("business_domain_id"),
    )
    domains = metadata.business_domains(derived_metadata(spark, sf_dir)["business_domains"])
    return metadata.concept_problems(metadata.business_concepts(text), domains)


@query(
    "domain_rules_all",
    """WITH t AS (
        SELECT CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN p_partkey - 1 ELSE p_partkey END::INTEGER AS id,
               CASE WHEN p_size % 9 = 0 THEN NULL ELSE trim(lower(substr(p_name, 1, 4))) END AS code,
               CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_name END AS name FROM part),
    m AS (SELECT *, 'business_domains.csv id ' || coalesce(id::VARCHAR, '(empty)') AS prefix FROM t)
    SELECT DISTINCT NULL::INTEGER AS id, 'business_domains.csv: empty id' AS message FROM t WHERE id IS NULL
    UNION ALL SELECT id, 'business_domains.csv: duplicate id ' || id FROM t WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
    UNION ALL SELECT DISTINCT id, prefix || ': must fit in one byte (0-255) for key_set_binary' FROM m WHERE id > 255 OR id < 0
    UNION ALL SELECT DISTINCT id, prefix || ': code ' || coalesce(code, '(empty)') || ' must be exactly 3 lowercase letters or digits'
        FROM m WHERE code IS NULL OR NOT regexp_full_match(code, '[a-z0-9]{3}')
    UNION ALL SELECT NULL, 'business_domains.csv: duplicate code ' || code FROM t WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1
    UNION ALL SELECT DISTINCT id, prefix || ': empty name' FROM m WHERE name IS NULL""",
)
def domain_rules_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts taken for business domains, so that every rule is broken by some."""
    key, size = F.col("p_partkey"), F.col("p_size")
    text = table(spark, sf_dir, "part").select(
        F.when(key % 97 != 0, F.when(key % 5 == 0, key - 1).otherwise(key)).cast("string").alias("id"),
        F.when(size % 9 != 0, F.lower(F.substring("p_name", 1, 4))).alias("code"),
        F.when(size % 7 != 0, F.col("p_name")).otherwise("").alias("name"), F.lit("").alias("description"),
    )
    return metadata.domain_problems(metadata.business_domains(text))


@query(
    "concept_rules_all",
    """WITH t AS (
        SELECT CASE WHEN c_custkey % 89 = 0 THEN NULL WHEN c_custkey % 6 = 0 THEN c_custkey - 1 ELSE c_custkey END::INTEGER AS id,
               CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment || c_custkey // 2 END AS code,
               CASE WHEN c_nationkey % 8 = 7 THEN NULL ELSE c_nationkey % 8 END AS parent FROM customer),
    m AS (SELECT *, 'business_concepts.csv id ' || coalesce(id::VARCHAR, '(empty)') AS prefix FROM t)
    SELECT DISTINCT NULL::INTEGER AS id, 'business_concepts.csv: empty id' AS message FROM t WHERE id IS NULL
    UNION ALL SELECT id, 'business_concepts.csv: duplicate id ' || id FROM t WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
    UNION ALL SELECT DISTINCT id, prefix || ': empty code' FROM m WHERE code IS NULL
    UNION ALL SELECT NULL, 'business_concepts.csv: duplicate code ' || code FROM t WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1
    UNION ALL SELECT DISTINCT id, prefix || ': empty business_domain_id' FROM m WHERE parent IS NULL
    UNION ALL SELECT DISTINCT id, prefix || ': unknown business_domain_id ' || parent FROM m
        WHERE parent NOT IN (SELECT r_regionkey FROM region)""",
)
def concept_rules_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers taken for business concepts, so that every rule is broken by some."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    text = table(spark, sf_dir, "customer").select(
        F.when(key % 89 != 0, F.when(key % 6 == 0, key - 1).otherwise(key)).cast("string").alias("id"),
        F.when(nation != 3, F.concat("c_mktsegment", F.floor(key / 2).cast("string"))).otherwise(" ").alias("code"),
        F.col("c_name").alias("name"), F.lit("").alias("description"),
        F.when(nation % 8 != 7, nation % 8).cast("string").alias("business_domain_id"),
    )
    domains = metadata.business_domains(derived_metadata(spark, sf_dir)["business_domains"])
    return metadata.concept_problems(metadata.business_concepts(text), domains)


@query(
    "hook_rules_all",
    f"""WITH {META_SQL},
    parts AS (SELECT id, code, CASE WHEN id % 9 = 4 THEN 9000 + id ELSE source_id END AS source_id FROM datasets),
    origins AS (SELECT CASE WHEN id % 10 = 7 THEN 300 + id ELSE id END AS id, code, id AS was FROM sources),
    linked AS (SELECT p.id, p.code, CASE WHEN p.source_id < 9000 AND p.source_id % 10 = 7 THEN 300 + p.source_id ELSE p.source_id END AS source_id FROM parts p),
    h AS (
        SELECT CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey - 1 ELSE s_suppkey END::INTEGER AS id, (s_nationkey % 27)::INTEGER AS concept_id,
               (s_suppkey % 60 + 1)::INTEGER AS dataset_id, CASE WHEN s_suppkey % 7 = 2 THEN NULL ELSE 's_suppkey' END AS prod
        FROM supplier),
    r AS (
        SELECT h.*, ds.id AS d_id, ds.code AS d_code, s.id AS s_id, c.id AS c_id, d.id AS b_id,
               'hooks.csv id ' || h.id AS prefix, count(*) OVER (PARTITION BY h.id) AS same_id,
               count(*) OVER (PARTITION BY h.dataset_id, h.concept_id) AS same_role
        FROM h LEFT JOIN linked ds ON ds.id = h.dataset_id LEFT JOIN origins s ON s.id = ds.source_id
        LEFT JOIN concepts c ON c.id = h.concept_id LEFT JOIN domains d ON d.id = c.domain_id)
    SELECT DISTINCT id, prefix || ': empty hook_expression_prod' AS message FROM r WHERE prod IS NULL
    UNION ALL SELECT DISTINCT id, 'hooks.csv: duplicate id ' || id FROM r WHERE same_id > 1
    UNION ALL SELECT DISTINCT id, prefix || ': dataset ' || d_code || ' has an unknown source_id' FROM r WHERE d_id IS NOT NULL AND s_id IS NULL
    UNION ALL SELECT DISTINCT id, prefix || ': source id ' || s_id || ', business domain id ' || coalesce(b_id::VARCHAR, '(empty)')
        || ' and business concept id ' || coalesce(c_id::VARCHAR, '(empty)') || ' must fit in one byte (0-255) for key_set_binary' FROM r WHERE s_id > 255
    UNION ALL SELECT DISTINCT id, prefix || ': unknown dataset_id ' || dataset_id FROM r WHERE d_id IS NULL
    UNION ALL SELECT DISTINCT id, prefix || ': unknown business_concept_id ' || concept_id FROM r WHERE c_id IS NULL
    UNION ALL SELECT DISTINCT id, prefix || ': dataset ' || dataset_id || ' has more than one hook for business concept ' || concept_id
        || ' with role (none) (give each a different hook_role)' FROM r WHERE same_role > 1""",
)
def hook_rules_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers taken for hooks, with the rules that ``hook_rule_check`` does not break: repeated ids, empty
    production expressions, datasets of an unknown source, and a source id beyond a byte."""
    tables = derived_metadata(spark, sf_dir)
    key, source = F.col("s_suppkey"), F.col("source_id").cast("int")
    moved = lambda c: F.when(c % 10 == 7, c + 300).otherwise(c)
    parts = tables["datasets"].withColumn(
        "source_id", F.when(F.col("id").cast("int") % 9 == 4, F.col("id").cast("int") + 9000).otherwise(moved(source)).cast("string")
    )
    origins = tables["sources"].withColumn("id", moved(F.col("id").cast("int")).cast("string"))
    text = table(spark, sf_dir, "supplier").select(
        F.when(key % 4 == 0, key - 1).otherwise(key).cast("string").alias("id"),
        (F.col("s_nationkey") % 27).cast("string").alias("business_concept_id"),
        (key % 60 + 1).cast("string").alias("dataset_id"),
        F.lit("s_name").alias("hook_expression_dev"),
        F.when(key % 7 != 2, F.lit("s_suppkey")).alias("hook_expression_prod"),
        F.lit("").alias("hook_encoding"), F.lit(None).cast("string").alias("hook_role"),
    )
    return metadata.hook_problems(
        metadata.hook_rows(text), metadata.datasets(parts), metadata.sources(origins),
        metadata.business_concepts(tables["business_concepts"]), metadata.business_domains(tables["business_domains"]),
    )


@query(
    "dataset_tables",
    """WITH RECURSIVE rows AS (
        SELECT 'r' || r_regionkey AS code, NULL AS parent_code, '' AS keys FROM region
        UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN 'k' ELSE ' ' END FROM nation
        UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, 'parent, k' FROM supplier
        UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'parent, k' FROM customer),
    tree AS (
        SELECT code AS root, code, keys, 0 AS level FROM rows
        UNION ALL
        SELECT t.root, r.code, r.keys, t.level + 1 FROM tree t JOIN rows r ON r.parent_code = t.code)
    SELECT root, code, level FROM tree WHERE trim(keys) <> ''""",
)
def dataset_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations, suppliers and customers as a tree of datasets."""
    def rows(name: str, code: SparkColumn, parent: SparkColumn, keys: SparkColumn) -> DataFrame:
        return table(spark, sf_dir, name).select(
            code.alias("code"), parent.cast("string").alias("parent_code"), keys.alias("keys")
        )

    def tag(letter: str, name: str) -> SparkColumn:
        return F.concat(F.lit(letter), F.col(name).cast("string"))

    even = F.when(F.col("n_nationkey") % 2 == 0, "k").otherwise(" ")
    tree = (
        rows("region", tag("r", "r_regionkey"), F.lit(None), F.lit(""))
        .unionByName(rows("nation", tag("n", "n_nationkey"), tag("r", "n_regionkey"), even))
        .unionByName(rows("supplier", tag("s", "s_suppkey"), tag("n", "s_nationkey"), F.lit("parent, k")))
        .unionByName(rows("customer", tag("c", "c_custkey"), tag("n", "c_nationkey"), F.lit("parent, k")))
    )
    return metadata.dataset_tables(tree)


# Load state ----------------------------------------------------------------


@query(
    "load_state_latest",
    """SELECT source, dataset, load_mode, last_period_fetched, status, raw_file, updated_at FROM (
        SELECT event_type AS source, 'u' || user_id % 10 AS dataset,
               CASE WHEN event_id % 2 = 0 THEN 'full' ELSE 'incremental' END AS load_mode,
               strftime(ts, '%Y-%m') AS last_period_fetched, props AS status, event_id::VARCHAR AS raw_file,
               ts AS updated_at, event_id FROM events)
       QUALIFY row_number() OVER (PARTITION BY source, dataset ORDER BY updated_at DESC, event_id DESC) = 1""",
)
def load_state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as load-state rows: the newest per (source, dataset)."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        F.concat(F.lit("u"), (F.col("user_id") % 10).cast("string")).alias("dataset"),
        F.when(F.col("event_id") % 2 == 0, "full").otherwise("incremental").alias("load_mode"),
        F.date_format("ts", "yyyy-MM").alias("last_period_fetched"),
        F.col("props").alias("status"),
        F.col("event_id").cast("string").alias("raw_file"),
        F.col("ts").alias("updated_at"),
        "event_id",
    )
    return state.latest_state(rows, "event_id").drop("event_id")


# Nested records ------------------------------------------------------------

DOCUMENT = Structure(
    name="events",
    keys=("event_id",),
    fields=("event_type", "k"),
    children={
        "marks": Structure(
            name="events_marks",
            keys=("mark",),
            fields=("weight",),
            children={"notes": Structure(name="events_marks_notes", keys=("note",))},
        )
    },
)

RECORD_SCHEMA = (
    "k bigint, marks array<struct<mark: string, weight: bigint, notes: array<struct<note: bigint>>>>"
)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with two marks in their JSON, each with as many notes as its weight says."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")

    def mark(name: str, weight: SparkColumn) -> SparkColumn:
        notes = F.transform(
            F.filter(F.array(F.lit(1), F.lit(2)), lambda i: i <= weight), lambda i: F.struct(i.alias("note"))
        )
        return F.struct(F.lit(name).alias("mark"), weight.alias("weight"), notes.alias("notes"))

    record = F.to_json(F.struct(k.alias("k"), F.array(mark("a", k % 3), mark("b", k % 2)).alias("marks")))
    return parse_json(
        events.select("event_id", "event_type", record.alias("json")), "json", RECORD_SCHEMA, ("event_id", "event_type")
    )


@query(
    "flatten_nested",
    """SELECT event_id, event_type, (props->>'$.k')::BIGINT AS k FROM events""",
)
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-level table of the event records."""
    return flatten(event_records(spark, sf_dir), DOCUMENT)["events"]


MARKS_SQL = """marks AS (
        SELECT event_id::VARCHAR AS parent, mark, CASE mark WHEN 'a' THEN k % 3 ELSE k % 2 END AS weight
        FROM (SELECT event_id, (props->>'$.k')::BIGINT AS k, unnest(['a', 'b']) AS mark FROM events))"""


@query("flatten_nested_child", f"WITH {MARKS_SQL} SELECT parent, mark, weight FROM marks")
def flatten_nested_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(event_records(spark, sf_dir), DOCUMENT)["events_marks"]


@query(
    "flatten_nested_grandchild",
    f"""WITH {MARKS_SQL}
    SELECT parent || chr(31) || mark AS parent, note FROM (
        SELECT parent, mark, unnest(range(1, weight + 1)) AS note FROM marks)""",
)
def flatten_nested_grandchild(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(event_records(spark, sf_dir), DOCUMENT)["events_marks_notes"]


# Nested records without a declared structure ---------------------------------

NUMBER = "(props->>'$.k')::BIGINT"


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON texts whose fields depend on their type.

    All have a number and a user; purchases have two items with tags, errors a code that is a
    number or a text, sign-ups a field that is always null.
    """
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    tags = F.transform(F.sequence(F.lit(0), (F.col("k") % 3).cast("int")), lambda i: F.concat(F.lit("t"), i.cast("string")))
    item = F.struct(F.concat(F.lit("s"), F.col("k").cast("string")).alias("sku"), (F.col("k") % 7).alias("n"), tags.alias("tags"))
    bare = F.struct(F.lit("bare").alias("sku"), F.col("k").alias("n"), F.lit(None).cast("array<string>").alias("tags"))
    code = F.when(F.col("k") % 2 == 0, F.col("k").cast("string")).otherwise(F.format_string('"c%d"', "k"))
    parts = [
        F.format_string('"k":%d,"user":{"id":%d,"even":%s}', "k", "user_id", (F.col("user_id") % 2 == 0).cast("string")),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit('"items":'), F.to_json(F.array(item, bare)))),
        F.when(F.col("event_type") == "error", F.concat(F.lit('"code":'), code)),
        F.when(F.col("event_type") == "signup", F.lit('"code":null')),
    ]
    return events.select("event_id", "event_type", F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("record"))


def undeclared(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    texts = event_texts(spark, sf_dir)
    return flatten_undeclared(texts, ("event_id",), "record", found_shape(texts, "record", "events"))


@query(
    "flatten_undeclared",
    f"""SELECT event_id, {NUMBER} AS k, user_id AS "user.id", user_id % 2 = 0 AS "user.even",
        CASE WHEN event_type = 'error' THEN CASE WHEN {NUMBER} % 2 = 0 THEN {NUMBER}::VARCHAR ELSE '"c' || {NUMBER} || '"' END END AS code
    FROM events""",
)
def flatten_top_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top table of records whose structure is found in the data."""
    return undeclared(spark, sf_dir)["events"]


ITEMS_SQL = f"""items AS (
        SELECT event_id::VARCHAR AS parent, position::INTEGER AS position, {NUMBER} AS k FROM (
            SELECT event_id, props, unnest([0, 1]) AS position FROM events WHERE event_type = 'purchase'))"""


@query(
    "flatten_undeclared_child",
    f"""WITH {ITEMS_SQL}
    SELECT parent, position, CASE position WHEN 0 THEN 's' || k ELSE 'bare' END AS sku, CASE position WHEN 0 THEN k % 7 ELSE k END AS n FROM items""",
)
def flatten_child_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of an array, by position."""
    return undeclared(spark, sf_dir)["events_items"]


@query(
    "flatten_undeclared_values",
    f"""WITH {ITEMS_SQL}
    SELECT parent || chr(31) || '0' AS parent, i::INTEGER AS position, 't' || i AS value
    FROM (SELECT parent, unnest(range(0, k % 3 + 1)) AS i FROM items WHERE position = 0)""",
)
def flatten_values_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain values of an array within an array."""
    return undeclared(spark, sf_dir)["events_items_tags"]


@query(
    "structure_drift",
    """SELECT DISTINCT event_type, CASE event_type
        WHEN 'purchase' THEN 'missing: events.code; unexpected: events_items_tags.value'
        WHEN 'error' THEN 'missing: events_items.n, events_items.sku'
        WHEN 'signup' THEN 'missing: events_items.n, events_items.sku'
        ELSE 'missing: events.code, events_items.n, events_items.sku' END AS drift
    FROM events""",
)
def drift_of_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each type of event lacks of the declared structures, and has besides."""
    declared = {"events": ("k", "code", "user.id", "user.even"), "events_items": ("sku", "n")}
    return structure_drift(event_texts(spark, sf_dir), "event_type", "record", "events", declared)
