"""What loads and frames leave on disk: shuffles of finished writes, rows shuffled twice, digests that follow from the row."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_changes import SPEC, random_snapshots
from test_frames import check
from test_kept_state import stamp, std_snapshots
from test_task_width import exchanges

from ledgerline.operators import changes, versions
from ledgerline.sources import frames, log, std


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.splitlines() if "/shuffle_" in f}


def loaded(spark, root, snapshots, **options):
    std_snapshots(spark, f"{root}/std", snapshots)
    for i in range(len(snapshots)):
        log.load(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(i)], **options)


@pytest.mark.parametrize("layer", ["std", "log", "frame"])
def test_a_write_leaves_no_shuffle_behind(spark, tmp_path, layer):
    root = str(tmp_path)
    loaded(spark, root, random_snapshots(41, 3))
    rows = log.read(spark, f"{root}/lake", SPEC)
    before = shuffle_files(spark)
    if layer == "std":
        std.write(SPEC, rows.select(*SPEC.names, F.lit("2031-01").alias("year_month"), F.lit("20310101_0000").alias("snapshot")), f"{root}/other")
    elif layer == "log":
        log._write(rows, f"{root}/other", "static")
    else:
        frames.build(spark, SPEC, log.version_folder(f"{root}/lake", SPEC, 1), f"{root}/other", [stamp(i) for i in range(3)], 2)
    assert all(".zstd." in p.name for p in Path(root, "other").rglob("*.parquet"))
    until = time.time() + 20  # Spark removes them beside the job
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_the_state_is_shuffled_once_beside_the_snapshots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(changes, "ROWS_A_TASK", 3)
    root, snapshots = str(tmp_path), random_snapshots(42, 4)
    loaded(spark, root, snapshots[:3])
    std_snapshots(spark, f"{root}/std", snapshots)
    step, taken = log.changes_of(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(3)])
    held = log.read(spark, f"{root}/lake", SPEC).count()
    wide = max(-(-(len(snapshots[3]) + held) // 3), spark.sparkContext.defaultParallelism)
    assert taken == [stamp(3)] and held > 3
    assert exchanges(step) == [wide, wide]  # one for each side, none for both together


def test_a_kept_state_gives_back_the_digests_of_the_log(spark, tmp_path):
    root = str(tmp_path)
    loaded(spark, root, random_snapshots(43, 4), tail_loads=0)
    path = log.version_folder(f"{root}/lake", SPEC, 1)
    stamps = log.partition_values(spark, path, log.PARTITION)
    assert "___Lake_md5" not in spark.read.parquet(f"{path}/_state/upto={stamps[-1]}").columns
    state = log.state_rows(spark, path, SPEC, stamps)
    want = changes.current_state(SPEC, log.read(spark, f"{root}/lake", SPEC)).where("not ___Lake_isdeleted")
    assert state.columns == want.columns and not want.isEmpty()
    assert state.exceptAll(want).isEmpty() and want.exceptAll(state).isEmpty()


@pytest.mark.parametrize("rows_a_task, buckets", [(1, 2), (2, 3), (250_000, 64)])
def test_a_frame_is_shuffled_once_and_its_buckets_stay_whole(spark, tmp_path, monkeypatch, rows_a_task, buckets):
    monkeypatch.setattr(frames, "ROWS_A_TASK", rows_a_task)
    root = str(tmp_path)
    loaded(spark, root, random_snapshots(44, 4))
    for _ in range(2):
        frames.refresh(spark, f"{root}/lake", f"{root}/frames", SPEC, buckets=buckets)
        check(spark, root)
    rows = log.read(spark, f"{root}/lake", SPEC)
    count = rows.count()
    dealt = versions.frame(SPEC, frames._slots(rows, SPEC, buckets, count), slot="__slot")
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and f"{SPEC.keys[0]}#" not in plan.split("Exchange ", 1)[1].split(")", 1)[0]
    parts = frames._slots(rows, SPEC, buckets, count).select(F.spark_partition_id().alias("task"), frames._bucket(SPEC, buckets).alias("bucket")).distinct().collect()
    if count / rows_a_task <= buckets:
        assert len(parts) == len({p["bucket"] for p in parts})  # a bucket lies in one task
    else:
        assert len(parts) == len({p["task"] for p in parts})  # a task has rows of one bucket


def test_a_null_in_a_key_matches_no_change(spark, tmp_path):
    """Loads reject it; rows that have one all the same stay open, as they did under a join by key."""
    path, at = str(tmp_path), F.to_timestamp(F.lit("2031-01-01 00:00:00"))
    row = lambda a, day: spark.range(1).select(
        F.lit(a).cast("int").alias("a"), F.lit("p").alias("b"),
        *[F.lit(None).cast(SPEC.schema[n].dataType).alias(n) for n in SPEC.payload],
        F.lit("00ff").alias("___Lake_md5"), (at + F.expr(f"interval {day} days")).alias("___Lake_load_timestamp"),
        F.lit("s").alias("___Lake_datasource"), F.lit(f"f{day}").alias("___Lake_sourcefile"), F.lit(False).alias("___Lake_isdeleted"),
    )
    for day, load in enumerate(["20310101_0000", "20310102_0000"]):
        rows = row(None, day).unionByName(row(1, day))
        rows.select(*[F.col(f.name).cast(f.dataType) for f in SPEC.log_schema]).write.parquet(f"{path}/log/snapshot={load}")
        frames.apply_load(spark, SPEC, f"{path}/log", f"{path}/frame", load, 2)
    found = frames._rows(spark, SPEC, f"{path}/frame", [f"{path}/frame/state=open/load=20310102_0000", f"{path}/frame/state=closed"])
    assert sorted((str(r["a"]), r["___Lake_md5"], r["___Effective_To"] is None) for r in found.collect()) == [
        ("1", "00ff", False), ("1", "00ff", True), ("None", "00ff", True), ("None", "00ff", True),
    ]
