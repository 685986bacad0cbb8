"""Static metadata: derived key sets, rules and their messages."""

import re

import pytest

from ledgerline import catalog
from ledgerline.functions.hooks import Hook, byte, encoded, hook_columns
from ledgerline.sources import metadata
from pyspark.sql import functions as F

DOMAINS = "id,code,name,description\n"
CONCEPTS = "id,code,name,description,business_domain_id\n"
HOOKS = "id,business_concept_id,dataset_id,hook_expression_dev,hook_expression_prod,hook_encoding,hook_role\n"
FIELD, COMPANY = ("no_sodir.sup.field", "080101"), ("no_sodir.sup.cmp", "080102")


def build(spark, **texts):
    return metadata.build(metadata.catalog_tables(spark, texts))


def test_catalog_registry(spark):
    tables = build(spark)
    got = [
        (r["id"], r["dataset_id"], r["key_set"], bytes(r["key_set_binary"]).hex(), r["hook_column"])
        for r in tables["hooks"].collect()
    ]
    assert got == [
        (1, 1, *FIELD, "HK_FIELD"),
        (2, 2, *FIELD, "HK_FIELD"),
        (3, 2, *COMPANY, "HK_COMPANY__Operator"),
        (4, 3, *COMPANY, "HK_COMPANY"),
        (5, 4, *COMPANY, "HK_COMPANY"),
        (6, 4, *FIELD, "HK_FIELD"),
        (7, 5, *FIELD, "HK_FIELD"),
        (8, 6, *FIELD, "HK_FIELD"),
        (9, 6, *COMPANY, "HK_COMPANY__Operator"),
    ]
    assert tables["sources"].count() == 15 and tables["datasets"].count() == 6
    for code, spec in catalog.DATASETS.items():
        assert metadata.tables_of(tables["datasets"], code) == [code]
        keys = tables["datasets"].where(F.col("code") == code).first()["keys"]
        assert tuple(k.strip() for k in keys.split(",")) == spec.keys


def test_default_encoding_and_roles(spark):
    rows = "40,2,3,x,y,,Seller\n41,2,3,x,y, ,Buyer\n42,2,3,x,y,BigInt,\n"
    found = build(spark, hooks=HOOKS + rows)["hooks"].collect()
    assert {r["hook_encoding"] for r in found} == {"bigint"}
    assert [r["hook_column"] for r in found] == ["HK_COMPANY__Seller", "HK_COMPANY__Buyer", "HK_COMPANY"]


def test_hook_column_replaces_other_characters(spark):
    concepts = catalog.BUSINESS_CONCEPTS_CSV + "60,rig,Rig-no. (new),d,1\n"
    hooks = build(spark, business_concepts=concepts, hooks=HOOKS + "40,60,3,x,y,varchar,Second3\n")["hooks"]
    assert hooks.first()["hook_column"] == "HK_RIG_NO___NEW___Second3"


def listed_by(name, *cases):
    return [(name, rows, message) for rows, message in cases]


# Every rule, each with several offenders among good rows.
INVALID = [
    *listed_by(
        "business_domains",
        ("30,geo,Rocks,d\n31,env,Air,d\n30,law,Law,d\n31,tax,Tax,d\n", ["duplicate id 30", "duplicate id 31"]),
        ("30,geo,Rocks,d\n31,geo,Air,d\n32,law,Law,d\n33,law,Tax,d\n", ["duplicate code geo", "duplicate code law"]),
        ("30,g,Rocks,d\n31,rocks,Air,d\n32,Geo,Law,d\n33,a b,Tax,d\n34,,No,d\n", [f"id {i}: code {c} must be exactly 3" for i, c in ((30, "g"), (31, "rocks"), (32, "Geo"), (33, "a b"), (34, r"\(empty\)"))]),
        ("30,geo, ,d\n31,env,,d\n", ["id 30: empty name", "id 31: empty name"]),
        ("300,geo,Rocks,d\n-1,env,Air,d\n", ["id 300: must fit in one byte", "id -1: must fit in one byte"]),
        (",geo,Rocks,d\n", ["empty id"]),
    ),
    *listed_by(
        "business_concepts",
        ("50,rig,Rig,d,1\n51,pipe,Pipe,d,1\n50,ship,Ship,d,1\n51,dock,Dock,d,1\n", ["duplicate id 50", "duplicate id 51"]),
        ("50,rig,Rig,d,1\n51,rig,Pipe,d,1\n", ["duplicate code rig"]),
        ("50, ,Rig,d,1\n51,,Pipe,d,1\n", ["id 50: empty code", "id 51: empty code"]),
        ("50,rig,Rig,d,\n51,pipe,Pipe,d,200\n52,ship,Ship,d,201\n", ["id 50: empty business_domain_id", "id 51: unknown business_domain_id 200", "id 52: unknown business_domain_id 201"]),
        (",rig,Rig,d,1\n", ["empty id"]),
    ),
    *listed_by(
        "hooks",
        ("40,1,2,x,y,integer,\n40,2,3,x,y,integer,\n", ["duplicate id 40"]),
        ("40,1,77,x,y,integer,\n41,1,,x,y,integer,\n", ["id 40: unknown dataset_id 77", r"id 41: unknown dataset_id \(empty\)"]),
        ("40,88,2,x,y,integer,\n41,,2,x,y,integer,\n", ["id 40: unknown business_concept_id 88", r"id 41: unknown business_concept_id \(empty\)"]),
        ("40,1,2, ,y,integer,\n41,2,2,x,,integer,\n", ["id 40: empty hook_expression_dev", "id 41: empty hook_expression_prod"]),
        ("40,1,2,x,y,hex,\n41,2,2,x,y,Text,\n", ["id 40: unknown hook_encoding hex", "id 41: unknown hook_encoding text"]),
        ("40,1,2,x,y,integer,\n41,1,3,x,y,bigint,\n42,1,4,x,y,varchar,\n", [f"id {i}: key set .* different hook_encoding" for i in (40, 41, 42)]),
        ("40,2,3,x,y,integer,\n41,2,3,x,y,integer,\n42,2,3,x,y,integer,Buyer\n43,2,3,x,y,integer,Buyer\n", [r"id 40: .* with role \(none\)", "id 43: .* with role Buyer"]),
        ("40,2,3,x,y,integer,buyer\n41,2,4,x,y,integer,Old buyer\n", ["hook_role buyer must be", "hook_role Old buyer must be"]),
    ),
]


@pytest.mark.parametrize("name, text, message", INVALID)
def test_invalid_metadata(spark, name, text, message):
    heads = {"business_domains": DOMAINS, "business_concepts": CONCEPTS, "hooks": HOOKS}
    tables = metadata.catalog_tables(spark, {name: heads[name] + text})
    domains = metadata.business_domains(tables["business_domains"])
    concepts = metadata.business_concepts(tables["business_concepts"])
    problems = {
        "business_domains": lambda: metadata.domain_problems(domains),
        "business_concepts": lambda: metadata.concept_problems(concepts, domains),
        "hooks": lambda: metadata.hook_problems(
            metadata.hook_rows(tables["hooks"]), metadata.datasets(tables["datasets"]),
            metadata.sources(tables["sources"]), concepts, domains,
        ),
    }[name]()
    with pytest.raises(metadata.MetadataError) as caught:
        metadata._assert_none(problems)
    for part in message:
        assert re.search(part, str(caught.value)), part
    assert spark.read.parquet(caught.value.path).count() == caught.value.total


def test_ids_above_one_byte(spark):
    concepts = catalog.BUSINESS_CONCEPTS_CSV + "700,rig,Rig,d,1\n"
    with pytest.raises(metadata.MetadataError, match="id 40: .*concept id 700 must fit in one byte"):
        build(spark, business_concepts=concepts, hooks=HOOKS + "40,700,2,x,y,integer,\n")
    with pytest.raises(Exception, match="does not fit one byte: 700"):
        spark.range(1).select(byte(F.lit(700))).collect()


def test_store_keeps_the_previous_tables_on_failure(spark, tmp_path):
    root = str(tmp_path)
    metadata.store(metadata.catalog_tables(spark), root)
    assert spark.read.parquet(f"{root}/metadata/hooks").count() == 9
    again = metadata.scan(spark, f"{root}/raw/metadata/business_domains", "business_domains")
    assert again.first()["description"].startswith("Indicators of hydrocarbon supply: production, reserves")
    with pytest.raises(metadata.MetadataError):
        metadata.store(metadata.catalog_tables(spark, {"hooks": HOOKS + "40,1,77,x,y,integer,\n"}), root)
    assert spark.read.parquet(f"{root}/metadata/hooks").count() == 9


TREE = "id int, code string, parent_code string, keys string"


def test_tables_of_nested_datasets(spark):
    rows = [(9, "lab", None, " "), (4, "lab_core", "lab_well", "parent, core"), (7, "lab_well", "lab", "well"),
            (3, "lab_log", "lab_well", "parent, log"), (1, "alone", None, "k"), (2, "bare", None, None)]
    datasets = spark.createDataFrame(rows, TREE)
    assert metadata.tables_of(datasets, "lab") == ["lab_well", "lab_log", "lab_core"]
    assert metadata.tables_of(datasets, "lab_well") == ["lab_well", "lab_log", "lab_core"]
    assert metadata.tables_of(datasets, "alone") == ["alone"]
    with pytest.raises(KeyError):
        metadata.tables_of(datasets, "unheard")
    with pytest.raises(ValueError):
        metadata.tables_of(datasets, "bare")


def test_long_chains_are_no_cycles_but_cycles_are(spark):
    chain = [(i, f"c{i}", f"c{i - 1}" if i else None, "k") for i in range(80)]
    assert metadata.tables_of(spark.createDataFrame(chain, TREE), "c0") == [f"c{i}" for i in range(80)]
    ring = spark.createDataFrame([(1, "p", "r", "k"), (2, "q", "p", "k"), (3, "r", "q", "k")], TREE)
    with pytest.raises(Exception, match="back to itself"):
        metadata.dataset_tables(ring).collect()


def one(spark, value, ddl, encoding):
    df = spark.createDataFrame([(value,)], f"v {ddl}")
    got = df.select(encoded(F.col("v"), encoding).alias("b")).first()["b"]
    return None if got is None else bytes(got).hex()


def test_encodings(spark):
    assert one(spark, 43506, "bigint", "integer") == "0000a9f2"
    assert one(spark, 2**32 - 1, "bigint", "integer") == "ffffffff"
    assert one(spark, 0, "int", "integer") == "00000000"
    assert one(spark, 2**63 - 1, "bigint", "bigint") == "7fffffffffffffff"
    assert one(spark, "Vår", "string", "varchar") == "56c3a572"
    assert one(spark, None, "bigint", "integer") is None
    assert one(spark, 3.0, "double", "integer") == "00000003"
    with pytest.raises(Exception, match="does not fit integer: 1.7"):
        one(spark, 1.7, "double", "integer")
    for value, encoding in ((-1, "integer"), (2**32, "integer"), (-1, "bigint")):
        with pytest.raises(Exception, match=f"does not fit {encoding}"):
            one(spark, value, "bigint", encoding)


def test_hooks_come_in_id_order(spark):
    hooks = [Hook(7, "HK_B", "s.d.b", b"\1\1\2", "v", "v", "integer"), Hook(2, "HK_A", "s.d.a", b"\1\1\1", "v", "v", "bigint")]
    df = spark.createDataFrame([(5,)], "v bigint")
    dev = df.select(*hook_columns(hooks, "development"))
    assert dev.columns == ["HK_A", "HK_B"] and tuple(dev.first()) == ("s.d.a|5", "s.d.b|5")
    prod = df.select(*hook_columns(hooks, "production")).first()
    assert bytes(prod["HK_A"]).hex() == "0101010000000000000005" and bytes(prod["HK_B"]).hex() == "01010200000005"
    with pytest.raises(ValueError):
        hook_columns(hooks, "test")


def test_broken_rules_do_not_meet_in_one_task(spark):
    found = spark.range(50).selectExpr("id", "if(id % 5 = 0, string(id), null) as set_")
    groups = F.array(F.struct(F.lit("set").alias("kind"), F.col("set_").alias("key"), F.lit("m").alias("message")))
    rows = metadata.keyed_messages(found, [(F.col("id") > 9, F.concat(F.lit("bad "), F.col("id")))], groups).collect()
    assert len({r.key for r in rows if r.kind == "own"}) == 40 and sorted(r.id for r in rows if r.kind == "set") == list(range(0, 50, 5))
    assert all(r.key is not None for r in rows)
