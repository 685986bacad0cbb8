"""Change capture against a step-by-step model, on random snapshot sequences."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import versions
from ledgerline.operators.changes import (
    FROM_LOG,
    capture_changes,
    current_state,
    empty_log,
    full_replay,
    incremental_changes,
    with_digest,
)
from ledgerline.operators.snapshots import SEQ, local_relation, number_snapshots
from ledgerline.spec import Column, DatasetSpec, SpecError

SPEC = DatasetSpec(
    source="t",
    table="item",
    keys=("a", "b"),
    volatile=("seen",),
    columns=(Column("a", "int"), Column("b"), Column("x", "double"), Column("note"), Column("seen", "int")),
)
START = datetime(2026, 1, 1, 10)


def snapshot_name(i):
    return f"item_{i:03d}"


def random_snapshots(seed, count):
    """A list of {key: (x, note, seen)}; some snapshots are empty."""
    rng = random.Random(seed)
    keys = [(a, b) for a in range(4) for b in ("p", "q")]
    out = []
    for i in range(count):
        if rng.random() < 0.15:
            out.append({})
            continue
        out.append({
            k: (rng.choice([None, 1.0, 2.5]), rng.choice([None, "", "n"]), i)
            for k in keys if rng.random() < 0.6
        })
    return out


def digest_of(row):
    x, note, _ = row
    return ("" if x is None else repr(x), note or "")


def fold(snapshots):
    """The incremental rule, one snapshot after the other, in plain Python."""
    state, log = {}, []
    for i, rows in enumerate(snapshots):
        if not rows:
            continue
        for key, row in rows.items():
            held = state.get(key)
            if held is None or held[1] or digest_of(held[0]) != digest_of(row):
                state[key] = (row, False)
                log.append((*key, *row, i, False))
        for key, (row, deleted) in list(state.items()):
            if not deleted and key not in rows:
                state[key] = (row, True)
                log.append((*key, *row, i, True))
    return log


def frame_of(spark, snapshots):
    rows = [
        (*key, *row, snapshot_name(i), START + timedelta(days=i))
        for i, one in enumerate(snapshots) for key, row in one.items()
    ]
    schema = "a int, b string, x double, note string, seen int, ___Std_filename string, ___Std_file_timestamp timestamp"
    return with_digest(SPEC, spark.createDataFrame(rows, schema))


def as_rows(log):
    got = log.select("a", "b", "x", "note", "seen", "___Lake_sourcefile", "___Lake_isdeleted").collect()
    return sorted((repr((r[0], r[1], r[2], r[3], r[4], int(r[5].split("_")[1]), r[6])) for r in got))


@pytest.mark.parametrize("seed", range(3))
def test_fold_replay_and_seeded_replay_agree(spark, seed):
    snapshots = random_snapshots(seed, 7)
    expected = fold(snapshots)
    observations = frame_of(spark, snapshots).cache()

    # one replay that repeats log values equals the fold, volatile columns included
    whole = capture_changes(SPEC, observations, deletions_repeat=FROM_LOG)
    assert as_rows(whole) == sorted(repr(tuple(r)) for r in expected)

    # the plain full replay differs at most in what the digest does not see: the
    # volatile column, and NULL against empty text, of deletions
    replayed = full_replay(SPEC, observations)

    def seen_by_digest(log):
        return sorted(map(str, log.drop("seen").fillna("", ["note"]).collect()))

    assert seen_by_digest(replayed) == seen_by_digest(whole)
    live = "not ___Lake_isdeleted"
    assert as_rows(replayed.where(live)) == as_rows(whole.where(live))

    # a replay seeded with the log of the first snapshots adds exactly the rest
    cut = F.lit(START + timedelta(days=3))
    head = capture_changes(SPEC, observations.where(F.col("___Std_file_timestamp") < cut), deletions_repeat=FROM_LOG)
    tail = capture_changes(SPEC, observations.where(F.col("___Std_file_timestamp") >= cut), log=head)
    assert as_rows(head.unionByName(tail)) == as_rows(whole)

    # loading the newest snapshot again adds nothing
    newest = observations.where(F.col("___Std_filename") == snapshot_name(max(i for i, s in enumerate(snapshots) if s)))
    assert incremental_changes(SPEC, newest, whole).isEmpty()
    oldest = observations.where(F.col("___Std_filename") == snapshot_name(min(i for i, s in enumerate(snapshots) if s)))
    assert incremental_changes(SPEC, oldest, whole).isEmpty()

    # versions
    frame = versions.frame(SPEC, whole)
    assert versions.open_versions(SPEC, frame).isEmpty()
    last = max((i for i, s in enumerate(snapshots) if s))
    assert {(r["a"], r["b"]) for r in versions.latest(SPEC, whole).collect()} == set(snapshots[last])
    state = current_state(SPEC, whole)
    assert state.count() == whole.select("a", "b").distinct().count()
    for i, one in enumerate(snapshots):
        if one:
            at = versions.as_of(SPEC, whole, START + timedelta(days=i))
            assert {(r["a"], r["b"]) for r in at.collect()} == set(one)
    observations.unpersist()


def test_empty_snapshot_deletes_nothing(spark):
    log = full_replay(SPEC, frame_of(spark, [{(1, "p"): (1.0, "n", 0)}]))
    assert incremental_changes(SPEC, frame_of(spark, [{}]), log).isEmpty()
    assert full_replay(SPEC, frame_of(spark, [{}])).isEmpty()


def test_null_and_empty_text_are_the_same(spark):
    snapshots = [{(1, "p"): (None, None, 0)}, {(1, "p"): (None, "", 1)}]
    assert full_replay(SPEC, frame_of(spark, snapshots)).count() == 1


def test_duplicate_key_in_a_snapshot_fails(spark):
    twice = frame_of(spark, [{(1, "p"): (1.0, "n", 0)}])
    with pytest.raises(Exception, match="duplicate key"):
        full_replay(SPEC, twice.union(twice)).collect()
    with pytest.raises(Exception, match="duplicate key"):
        incremental_changes(SPEC, twice.union(twice), empty_log(spark, SPEC)).collect()


def test_increment_reads_one_row_per_key_of_the_log(spark):
    snapshots = random_snapshots(11, 6)
    observations = frame_of(spark, snapshots)
    log = full_replay(SPEC, observations)
    step = incremental_changes(SPEC, observations, log)
    assert "WindowGroupLimit" in step._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


def test_numbering_does_not_depend_on_the_list_length(spark):
    schema = "___Std_filename string, ___Std_file_timestamp timestamp"
    rows = [(f"f{i % 3}", START + timedelta(days=i % 4)) for i in range(8)]
    numbered = number_snapshots(spark.createDataFrame(rows, schema).distinct()).orderBy(SEQ).collect()
    assert [(r[1], r[0]) for r in numbered] == sorted({(t, f) for f, t in rows})


def test_local_relation_keeps_instants(spark):
    from datetime import timezone
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("t", T.TimestampType())])
    df = local_relation(spark, [(datetime(2026, 1, 1, 10, tzinfo=timezone.utc),)], schema)
    assert df.select(F.unix_timestamp("t").alias("s")).first()["s"] == 1767261600
    assert local_relation(spark, [], schema).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_replay_plans_one_shuffle_and_one_window(spark):
    listed = spark.createDataFrame(
        [(snapshot_name(i), START + timedelta(days=i)) for i in range(3)],
        "___Std_filename string, ___Std_file_timestamp timestamp",
    )
    text = plan(full_replay(SPEC, frame_of(spark, random_snapshots(1, 3)), listed))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("+- Window [") == 1


def test_a_long_list_of_snapshots_is_written(spark, monkeypatch):
    from ledgerline.operators import snapshots as listing

    observations = frame_of(spark, random_snapshots(5, 6))
    whole = as_rows(full_replay(SPEC, observations))
    monkeypatch.setattr(listing, "LISTED", 2)
    assert as_rows(full_replay(SPEC, observations)) == whole


def test_latest_limits_before_the_shuffle(spark):
    text = plan(versions.latest(SPEC, empty_log(spark, SPEC).unionByName(full_replay(SPEC, frame_of(spark, [{(1, "p"): (1.0, "n", 0)}])))))
    assert "WindowGroupLimit" in text


def test_spec_rules():
    good = dict(source="s", table="t", keys=("k",), columns=(Column("k", "int"), Column("v")))
    assert DatasetSpec(**good).digest_columns == ("v",)
    for bad in (
        {"keys": ()},
        {"keys": ("v",)},
        {"volatile": ("w",)},
        {"volatile": ("k",)},
        {"columns": (Column("k", "int"), Column("V"), Column("v"))},
        {"columns": (Column("k", "int", "guess"), Column("v"))},
    ):
        with pytest.raises(SpecError):
            DatasetSpec(**{**good, **bad})
