"""Static metadata: sources, datasets, business domains and concepts, hooks.

Every table is built from text columns and its rules. The rules are relational
(counts, anti joins, predicates); each broken rule is one row (id, message).
"""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import catalog
from ledgerline.functions.hooks import ENCODINGS, Hook, hook_column, key_set, key_set_binary
from ledgerline.functions.parse import blank_to_null
from ledgerline.operators.snapshots import local_relation
from ledgerline.operators.checks import listed, missing_parents, mixed_values, whole
from ledgerline.session import work_folder

# Columns of the metadata files and the patterns of their codes.
COLUMNS = {
    "sources": ("id", "code", "name", "scope", "url"),
    "datasets": (
        "id", "code", "name", "source_id", "copyright", "type", "format", "parent_code", "granularity",
        "periodicity", "keys", "url",
    ),
    "business_domains": ("id", "code", "name", "description"),
    "business_concepts": ("id", "code", "name", "description", "business_domain_id"),
    "hooks": (
        "id", "business_concept_id", "dataset_id", "hook_expression_dev", "hook_expression_prod",
        "hook_encoding", "hook_role",
    ),
}
DOMAIN_CODE = "[a-z0-9]{3}"
HOOK_ROLE = "[A-Z][A-Za-z0-9]*"


class MetadataError(ValueError):
    """A metadata file breaks a rule; the previous table stays. *path* holds every broken rule."""

    def __init__(self, message: str, path: str | None = None, total: int | None = None):
        super().__init__(message)
        self.path, self.total = path, total


def from_text(spark: SparkSession, name: str, text: str) -> DataFrame:
    """Text columns of one metadata file given as CSV text (a handful of rows)."""
    rows = [
        tuple(row.get(c) or None for c in COLUMNS[name]) for row in csv.DictReader(io.StringIO(text))
    ]
    return local_relation(spark, rows, T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS[name]]))


def scan(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Text columns of a metadata CSV file."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True).select(*COLUMNS[name])


def catalog_tables(spark: SparkSession, overrides: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    texts = {**catalog.STATIC, **(overrides or {})}
    return {name: from_text(spark, name, texts[name]) for name in COLUMNS}


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("(empty)")) for p in parts])


def sources(text: DataFrame) -> DataFrame:
    return text.select(F.col("id").cast("int").alias("id"), "code", "name", "scope", "url")


def datasets(text: DataFrame) -> DataFrame:
    return text.select(
        F.col("id").cast("int").alias("id"),
        "code",
        "name",
        F.col("source_id").cast("int").alias("source_id"),
        *COLUMNS["datasets"][4:],
    )


def business_domains(text: DataFrame) -> DataFrame:
    return text.select(
        F.col("id").cast("int").alias("id"),
        F.trim("code").alias("code"),
        blank_to_null(F.col("name")).alias("name"),
        "description",
    )


@dataclass(frozen=True)
class Rule:
    """A rule on single rows (*broken*), or on groups of rows (*group*, the key as text; rows without one are in none)."""

    message: Column
    broken: Column | None = None
    group: tuple[str, Column] | None = None
    #: Whether a group breaks the rule by having more than one row; otherwise the caller names the bad groups.
    alone: bool = True
    #: Whether the message is about a row; otherwise it has no id.
    of_row: bool = True


def broken_rules(rows: DataFrame, rules: list[Rule], bad_groups: DataFrame | None = None) -> DataFrame:
    """Distinct (id, message) of every broken rule, in two passes over *rows*.

    The first counts the groups, partial counts first, so a group of any size is one row after the shuffle;
    *bad_groups* (kind, key) are bad for other reasons. The second names what each row breaks itself
    and the groups it is in, and keeps the groups that are bad.
    """
    none = F.lit(None).cast("string")
    members = [F.struct(F.lit(r.group[0]).alias("kind"), r.group[1].alias("key")) for r in rules if r.group and r.alone]
    counted = rows.select(F.inline(F.array(*members))).where("key is not null").groupBy("kind", "key").count()
    bad = counted.where("count > 1").select("kind", "key")
    if bad_groups is not None:
        bad = bad.unionByName(bad_groups)

    def entry(rule: Rule) -> Column:
        kind, key = rule.group or (None, none)
        ident = F.col("id") if rule.of_row else F.lit(None).cast(rows.schema["id"].dataType)
        one = F.struct(ident.alias("id"), F.lit(kind).cast("string").alias("kind"), key.alias("key"), rule.message.alias("message"))
        return F.when(rule.broken if rule.group is None else key.isNotNull(), one)

    named = rows.select(F.explode(F.array(*[entry(r) for r in rules])).alias("one")).where("one is not null").select("one.*")
    kept = named.join(bad.distinct().withColumn("bad", F.lit(True)), ["kind", "key"], "left").where("kind is null or bad")
    return kept.select("id", "message").distinct()


def domain_problems(domains: DataFrame) -> DataFrame:
    """Distinct (id, message) of every rule a business domain breaks."""
    file, ident, code = "business_domains.csv", F.col("id"), F.col("code")
    # The messages of the rules.
    return broken_rules(domains, [
        Rule(F.lit(f"{file}: empty id"), ident.isNull()),
        Rule(_text(f"{file}: duplicate id ", ident), group=("id", ident.cast("string"))),
        Rule(_text(f"{file} id ", ident, ": must fit in one byte (0-255) for key_set_binary"), ~ident.between(0, 255)),
        Rule(_text(f"{file} id ", ident, ": code ", F.coalesce(code, F.lit("(empty)")),
                   " must be exactly 3 lowercase letters or digits"), code.isNull() | ~code.rlike(whole(DOMAIN_CODE))),
        Rule(_text(f"{file}: duplicate code ", code), group=("code", code), of_row=False),
        Rule(_text(f"{file} id ", ident, ": empty name"), F.col("name").isNull()),
    ])


def business_concepts(text: DataFrame) -> DataFrame:
    return text.select(
        F.col("id").cast("int").alias("id"),
        blank_to_null(F.col("code")).alias("code"),
        "name",
        "description",
        F.col("business_domain_id").cast("int").alias("business_domain_id"),
    )


def concept_problems(concepts: DataFrame, domains: DataFrame) -> DataFrame:
    """Distinct (id, message) of every rule a business concept breaks."""
    file, ident, code, parent = "business_concepts.csv", F.col("id"), F.col("code"), F.col("business_domain_id")
    orphans = missing_parents(concepts, "business_domain_id", domains, "id")
    unknown = orphans.select(F.lit("parent").alias("kind"), parent.cast("string").alias("key"))
    # The messages of the rules.
    return broken_rules(concepts, [
        Rule(F.lit(f"{file}: empty id"), ident.isNull()),
        Rule(_text(f"{file}: duplicate id ", ident), group=("id", ident.cast("string"))),
        Rule(_text(f"{file} id ", ident, ": empty code"), code.isNull()),
        Rule(_text(f"{file}: duplicate code ", code), group=("code", code), of_row=False),
        Rule(_text(f"{file} id ", ident, ": empty business_domain_id"), parent.isNull()),
        Rule(_text(f"{file} id ", ident, ": unknown business_domain_id ", parent), group=("parent", parent.cast("string")), alone=False),
    ], unknown)


def hook_rows(text: DataFrame) -> DataFrame:
    """Typed hook rows, before the derived columns."""
    return text.select(
        F.col("id").cast("int").alias("id"),
        F.col("business_concept_id").cast("int").alias("business_concept_id"),
        F.col("dataset_id").cast("int").alias("dataset_id"),
        blank_to_null(F.col("hook_expression_dev")).alias("hook_expression_dev"),
        blank_to_null(F.col("hook_expression_prod")).alias("hook_expression_prod"),
        F.coalesce(F.lower(blank_to_null(F.col("hook_encoding"))), F.lit("bigint")).alias("hook_encoding"),
        blank_to_null(F.col("hook_role")).alias("hook_role"),
    )


def _resolved(
    hooks: DataFrame, datasets_: DataFrame, sources_: DataFrame, concepts: DataFrame, domains: DataFrame
) -> DataFrame:
    """Hooks with the rows they refer to; missing references stay NULL.

    The four parents are joined as plain tables: Spark broadcasts those whose
    size it knows to be small.
    """
    d = datasets_.select(F.col("id").alias("dataset_id"), F.col("id").alias("d_id"), F.col("code").alias("d_code"), "source_id")
    s = sources_.select(F.col("id").alias("source_id"), F.col("id").alias("s_id"), F.col("code").alias("s_code"))
    c = concepts.select(
        F.col("id").alias("business_concept_id"), F.col("id").alias("bc_id"), F.col("code").alias("bc_code"),
        F.col("name").alias("bc_name"), "business_domain_id",
    )
    b = domains.select(F.col("id").alias("business_domain_id"), F.col("id").alias("bd_id"), F.col("code").alias("bd_code"))
    return (
        hooks.join(d, "dataset_id", "left")
        .join(s, "source_id", "left")
        .join(c, "business_concept_id", "left")
        .join(b, "business_domain_id", "left")
        .withColumn("key_set", key_set(F.col("s_code"), F.col("bd_code"), F.col("bc_code")))
    )


def keyed_messages(found: DataFrame, own: list[tuple[Column, Column]], groups: Column) -> DataFrame:
    """(id, kind, key, message) of the rules of *own* that rows break, and of the *groups* they are in.

    No key is null: null keys would all meet in one task of a join. A group without a key is none, and
    a broken rule has its message for key.
    """
    alone = [
        F.when(condition, F.struct(F.lit("own").alias("kind"), F.xxhash64(message).cast("string").alias("key"), message.alias("message")))
        for condition, message in own
    ]
    return found.select("id", F.explode(F.concat(F.array(*alone), groups)).alias("one")).where("one.key is not null").select("id", "one.*")


def hook_problems(
    hooks: DataFrame, datasets_: DataFrame, sources_: DataFrame, concepts: DataFrame, domains: DataFrame
) -> DataFrame:
    """Distinct (id, message) of every rule a hook breaks.

    Rules on groups of hooks (one id, one role, one key set) name the group as text. Two passes find
    the bad groups, partial counts first, so a group of any size is one row after the shuffle. A third
    names the rules each hook breaks itself and the groups it is in, and keeps the groups that are bad.
    """
    file, ident = "hooks.csv", F.col("id")
    prefix = _text(f"{file} id ", ident)
    s_id, bd_id, bc_id = F.col("s_id"), F.col("bd_id"), F.col("bc_id")
    too_large = F.lit(False)
    for one in (s_id, bd_id, bc_id):
        too_large = too_large | ~F.coalesce(one.between(0, 255), F.lit(True))
    # The messages of the rules.
    own = [
        (F.col("hook_expression_dev").isNull(), _text(prefix, ": empty hook_expression_dev")),
        (F.col("hook_expression_prod").isNull(), _text(prefix, ": empty hook_expression_prod")),
        (~F.col("hook_encoding").isin(*ENCODINGS),
         _text(prefix, ": unknown hook_encoding ", F.col("hook_encoding"), " (integer, bigint or varchar)")),
        (F.col("hook_role").isNotNull() & ~F.col("hook_role").rlike(whole(HOOK_ROLE)),
         _text(prefix, ": hook_role ", F.col("hook_role"), " must be an uppercase letter followed by letters or digits")),
        (F.col("d_id").isNull(), _text(prefix, ": unknown dataset_id ", F.col("dataset_id"))),
        (F.col("d_id").isNotNull() & s_id.isNull(), _text(prefix, ": dataset ", F.col("d_code"), " has an unknown source_id")),
        (bc_id.isNull(), _text(prefix, ": unknown business_concept_id ", F.col("business_concept_id"))),
        (too_large, _text(prefix, ": source id ", s_id, ", business domain id ", bd_id, " and business concept id ", bc_id,
                          " must fit in one byte (0-255) for key_set_binary")),
    ]
    role = F.struct("dataset_id", "business_concept_id", F.coalesce("hook_role", F.lit("")).alias("role"))
    shared = {
        "id": (F.to_json(F.struct("id")), _text(f"{file}: duplicate id ", ident)),
        "role": (F.to_json(role), _text(
            prefix, ": dataset ", F.col("dataset_id"), " has more than one hook for business concept ",
            F.col("business_concept_id"), " with role ", F.coalesce("hook_role", F.lit("(none)")),
            " (give each a different hook_role)")),
        "key_set": (F.col("key_set"), _text(prefix, ": key set ", F.col("key_set"), " has hooks with different hook_encoding")),
    }
    groups = F.array(*[
        F.struct(F.lit(kind).alias("kind"), key.alias("key"), message.alias("message")) for kind, (key, message) in shared.items()
    ])
    # a reference that occurs twice among its parents gives a hook several rows; groups count hooks
    found = _resolved(hooks, datasets_, sources_, concepts, domains)
    members = hooks.select("id", F.array(*[
        F.struct(F.lit(kind).alias("kind"), shared[kind][0].alias("key")) for kind in ("id", "role")
    ]).alias("groups"))
    counted = members.select(F.inline("groups")).groupBy("kind", "key").count().where("count > 1").select("kind", "key")
    mixed = mixed_values(found.where("key_set is not null"), ["key_set"], "hook_encoding")
    bad = counted.unionByName(mixed.select(F.lit("key_set").alias("kind"), F.col("key_set").alias("key")))
    named = keyed_messages(found, own, groups)
    kept = named.join(bad.withColumn("bad", F.lit(True)), ["kind", "key"], "left").where("kind = 'own' or bad")
    return kept.select("id", "message").distinct()


def hook_registry(
    hooks: DataFrame, datasets_: DataFrame, sources_: DataFrame, concepts: DataFrame, domains: DataFrame
) -> DataFrame:
    """Hooks with their derived key sets and column name, in id order."""
    found = _resolved(hooks, datasets_, sources_, concepts, domains)
    return found.select(
        "id", "business_concept_id", "dataset_id", "hook_expression_dev", "hook_expression_prod",
        "hook_encoding", "hook_role", "key_set",
        key_set_binary(F.col("s_id"), F.col("bd_id"), F.col("bc_id")).alias("key_set_binary"),
        hook_column(F.col("bc_name"), F.col("hook_role")).alias("hook_column"),
    ).orderBy("id")


def _assert_none(problems: DataFrame) -> None:
    found = listed(problems, "message")
    if found:
        raise MetadataError(found.text, found.path, found.total)


def build(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Validated metadata tables from text columns; raises before returning any."""
    s, d = sources(tables["sources"]), datasets(tables["datasets"])
    domains = business_domains(tables["business_domains"])
    _assert_none(domain_problems(domains))
    concepts = business_concepts(tables["business_concepts"])
    _assert_none(concept_problems(concepts, domains))
    hooks = hook_rows(tables["hooks"])
    _assert_none(hook_problems(hooks, d, s, concepts, domains))
    return {
        "sources": s,
        "datasets": d,
        "business_domains": domains.orderBy("id"),
        "business_concepts": concepts.orderBy("id"),
        "hooks": hook_registry(hooks, d, s, concepts, domains),
    }


def store(tables: Mapping[str, DataFrame], root: str) -> None:
    """Copy the text tables as received, then rebuild the typed ones.

    All rules run before the first typed table is written, so a broken file
    leaves the previous tables in place.
    """
    for name, text in tables.items():
        text.write.mode("overwrite").option("header", True).csv(f"{root}/raw/metadata/{name}")
    for name, table in build(tables).items():
        table.write.mode("overwrite").parquet(f"{root}/metadata/{name}")


def hooks_of(registry: DataFrame, datasets_: DataFrame, code: str) -> list[Hook]:
    """The hooks of one dataset in id order (a handful of registry rows)."""
    wanted = datasets_.where(F.col("code") == code).select(F.col("id").alias("dataset_id"))
    rows = registry.join(wanted, "dataset_id", "left_semi").orderBy("id").collect()
    return [
        Hook(r["id"], r["hook_column"], r["key_set"], bytes(r["key_set_binary"]), r["hook_expression_dev"],
             r["hook_expression_prod"], r["hook_encoding"])
        for r in rows
    ]


def dataset_tables(datasets_: DataFrame, root: str | None = None) -> DataFrame:
    """(root, code, level) of every dataset, or of *root* alone, and the tables it feeds.

    A row feeds its own table if it has keys; children follow ``parent_code``, parents first, to any
    depth. Meeting a code again on the way down from a root is a cycle and fails the query.
    """
    spark = datasets_.sparkSession
    rows = datasets_.select("code", "parent_code", F.trim(F.coalesce("keys", F.lit(""))).alias("keys"))
    start = rows if root is None else rows.where(F.col("code") == root)
    path = work_folder(spark, "dataset-tables")
    limits = ("spark.sql.cteRecursionLevelLimit", "spark.sql.cteRecursionRowLimit")
    before = {name: spark.conf.get(name, None) for name in limits}
    for name in limits:  # for this query only: the data end the recursion
        spark.conf.set(name, "-1")
    try:
        found = spark.sql(
            """
            WITH RECURSIVE tree(root, code, keys, level, above, again) AS (
                SELECT code, code, keys, 0, array(code), false FROM {start}
                UNION ALL
                SELECT t.root, r.code, r.keys, t.level + 1, array_append(t.above, r.code), array_contains(t.above, r.code)
                FROM tree t JOIN {rows} r ON r.parent_code = t.code WHERE NOT t.again
            )
            SELECT * FROM tree
            """,
            start=start,
            rows=rows,
        )
        message = F.concat(F.lit("datasets: parent_code leads from "), "code", F.lit(" back to itself"))
        checked = F.when(F.col("again"), F.raise_error(message).cast("string")).otherwise(F.col("keys"))
        found = found.where(checked != "").select("root", "code", "level")
        found.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.schema(found.schema).parquet(path)


def tables_of(datasets_: DataFrame, code: str) -> list[str]:
    """Codes of the tables fed by one dataset, parents first."""
    if datasets_.where(F.col("code") == code).isEmpty():
        raise KeyError(f"no dataset has the code '{code}'")
    fed = dataset_tables(datasets_, code).select("code", "level")
    rows = fed.join(datasets_.select("code", "id"), "code").orderBy("level", "id").collect()
    if not rows:
        raise ValueError(f"dataset '{code}' feeds no table: none of its rows has keys")
    return [r["code"] for r in rows]
