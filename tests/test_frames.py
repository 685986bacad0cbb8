"""The maintained frame against the frame computed from the whole log, after every load."""

import pytest
from test_changes import SPEC, random_snapshots
from test_kept_state import stamp, std_snapshots

from ledgerline.operators import versions
from ledgerline.sources import frames, log


def check(spark, root):
    kept = frames.read(spark, f"{root}/lake", f"{root}/frames", SPEC)
    whole = versions.frame(SPEC, log.read(spark, f"{root}/lake", SPEC))
    assert kept.columns == whole.columns
    assert kept.exceptAll(whole).isEmpty() and whole.exceptAll(kept).isEmpty()
    now = frames.read(spark, f"{root}/lake", f"{root}/frames", SPEC, current=True)
    assert now.count() == whole.where("___Effective_To is null").count()


@pytest.mark.parametrize("seed, first", [(31, 1), (32, 3)])
def test_equals_the_frame_of_the_log_after_every_load(spark, tmp_path, seed, first):
    root, snapshots = str(tmp_path), random_snapshots(seed, 7)
    std_snapshots(spark, f"{root}/std", snapshots)
    assert frames.refresh(spark, f"{root}/lake", f"{root}/frames", SPEC) == []
    for i in range(len(snapshots)):
        log.load(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(i)])
        if i >= first:
            frames.refresh(spark, f"{root}/lake", f"{root}/frames", SPEC, buckets=3)
            check(spark, root)


def test_a_load_reads_and_writes_only_its_buckets(spark, tmp_path):
    root = str(tmp_path)
    base = {(a, "p"): (1.0, "n", 0) for a in range(40)}
    one = {**base, (7, "p"): (2.5, "n", 1)}
    std_snapshots(spark, f"{root}/std", [base, one, {**one, (7, "p"): (1.0, "x", 2)}])
    for i in range(3):
        log.load(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(i)])
        frames.refresh(spark, f"{root}/lake", f"{root}/frames", SPEC, buckets=8)
        check(spark, root)
    path = frames.folder(f"{root}/frames", SPEC, 1)
    assert [len(frames.partition_values(spark, f"{path}/state=open/load={stamp(i)}", "bucket")) for i in range(3)] == [8, 1, 1]


def test_a_load_again_and_a_rebuilt_log(spark, tmp_path):
    root = str(tmp_path)
    snapshots = [{(1, "p"): (1.0, "n", 0)}, {(1, "p"): (2.5, "n", 1), (2, "q"): (1.0, "n", 1)}, {(2, "q"): (None, "n", 2)}]
    std_snapshots(spark, f"{root}/std", snapshots)
    for i in range(3):
        log.load(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(i)])
    assert frames.refresh(spark, f"{root}/lake", f"{root}/frames", SPEC, buckets=2) == [stamp(i) for i in range(3)]
    assert frames.refresh(spark, f"{root}/lake", f"{root}/frames", SPEC, buckets=2) == []
    check(spark, root)
    std_snapshots(spark, f"{root}/std", [*snapshots[:2], snapshots[1]])  # the last snapshot changes nothing any more
    log.load(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(2)])
    frames.refresh(spark, f"{root}/lake", f"{root}/frames", SPEC, buckets=2)
    check(spark, root)
    log.rebuild(spark, f"{root}/lake", f"{root}/std", SPEC)
    frames.refresh(spark, f"{root}/lake", f"{root}/frames", SPEC, buckets=2)
    check(spark, root)
