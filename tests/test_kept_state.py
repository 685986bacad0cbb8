"""Loads on top of a kept state, and replays that leave the payload behind, against plain replays."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_changes import SPEC, START, fold, frame_of, random_snapshots

from ledgerline.operators.changes import empty_log, full_replay, step_changes
from ledgerline.operators.narrow import narrow_changes, narrow_replay
from ledgerline.sources import log, std


def stamp(i):
    return (START + timedelta(days=i)).strftime("%Y%m%d_%H%M")


def std_snapshots(spark, root, snapshots):
    when = F.col("___Std_file_timestamp")
    rows = frame_of(spark, snapshots).select(*SPEC.names, F.date_format(when, "yyyy-MM").alias("year_month"), F.date_format(when, "yyyyMMdd_HHmm").alias("snapshot"))
    std.write(SPEC, rows, root)


def rows_of(found):
    got = found.select("a", "b", "x", "note", "seen", "___Lake_load_timestamp", "___Lake_isdeleted").collect()
    return sorted(repr((*r[:5], (r[5] - START).days, r[6])) for r in got)


def test_loads_read_the_kept_state_and_the_tail(spark, tmp_path):
    root, snapshots = str(tmp_path), random_snapshots(21, 9)
    std_snapshots(spark, f"{root}/std", snapshots)
    path = log.version_folder(f"{root}/lake", SPEC, 1)
    for i, one in enumerate(snapshots):
        loads = log.partition_values(spark, path, log.PARTITION)
        if len(loads) > 4:
            read = log.state_rows(spark, path, SPEC, loads).inputFiles()
            old = [s for s in loads if any(f"snapshot={s}/" in f for f in read)]
            assert any("/_state/" in f for f in read) and len(old) <= 3
        assert log.load(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(i)], tail_loads=2) == ([stamp(i)] if one else [])
        assert rows_of(log.read(spark, f"{root}/lake", SPEC)) == sorted(map(repr, fold(snapshots[: i + 1])))
    assert 1 <= len(log.kept_states(spark, path)) <= 2


def test_a_load_again_drops_the_state_that_holds_it(spark, tmp_path):
    root = str(tmp_path)
    snapshots = [{(1, "p"): (1.0, "n", 0), (2, "p"): (1.0, "n", 0)}, {(1, "p"): (2.5, "n", 1)}, {(1, "p"): (2.5, "x", 2), (3, "q"): (None, None, 2)}]
    std_snapshots(spark, f"{root}/std", snapshots)
    path = log.version_folder(f"{root}/lake", SPEC, 1)
    for i in range(3):
        log.load(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(i)], tail_loads=0)
    assert log.kept_states(spark, path) == [stamp(1), stamp(2)]
    # the last snapshot comes again with other rows; the state after it must not be used
    changed = [*snapshots[:2], {(1, "p"): (2.5, "n", 2)}]
    std_snapshots(spark, f"{root}/std", changed)
    log.load(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(2)], tail_loads=0)
    # nothing changes any more with the third snapshot, so its partition and its state go
    assert rows_of(log.read(spark, f"{root}/lake", SPEC)) == sorted(map(repr, fold(changed)))
    assert log.partition_values(spark, path, log.PARTITION) == [stamp(0), stamp(1)]
    assert log.kept_states(spark, path) == [stamp(1)]


@pytest.mark.parametrize("seed, bits", [(1, None), (2, 1 << 15)])
def test_narrow_replay_equals_the_replay(spark, tmp_path, monkeypatch, seed, bits):
    from ledgerline.operators import narrow

    if bits:
        monkeypatch.setattr(narrow, "SIEVE_BITS", bits)
    root = str(tmp_path)
    std_snapshots(spark, root, random_snapshots(seed, 8))
    files, listed = std.scan(spark, root, SPEC), std.snapshots(spark, root, SPEC)
    whole = full_replay(SPEC, files, listed, std.BY)
    found = narrow_replay(SPEC, files, listed, std.BY)
    assert found.columns == whole.columns
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
    text = narrow_changes(SPEC, files, listed, std.BY)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    below = text[text.index(shuffled[0]) :].splitlines()[1]
    assert len(shuffled) == 1 and "note#" not in below.split("[", 1)[1].split("AS")[0]


def test_a_full_sieve_only_costs_time(spark, tmp_path, monkeypatch):
    from ledgerline.operators import narrow

    monkeypatch.setattr(narrow, "_is_set", lambda bitmap, place: F.lit(True))
    root = str(tmp_path)
    std_snapshots(spark, root, random_snapshots(5, 6))
    files, listed = std.scan(spark, root, SPEC), std.snapshots(spark, root, SPEC)
    whole = full_replay(SPEC, files, listed, std.BY)
    assert narrow_replay(SPEC, files, listed, std.BY).exceptAll(whole).isEmpty()


def test_a_download_is_compared_by_its_kept_fingerprint(spark, tmp_path, monkeypatch):
    import register as reg

    from ledgerline import catalog
    from ledgerline.plans.loads import Ledger
    from ledgerline.sources import prints

    spec, ledger = catalog.FIELD, Ledger(spark, str(tmp_path))
    first = reg.export(ledger.root, spec, 1)
    ledger.arrived(spec, "full", first)
    taken = []
    original = prints.fingerprint
    monkeypatch.setattr(prints, "fingerprint", lambda *a: taken.append(1) or original(*a))
    moved = [[("09.09.2031" if n in spec.volatile else v) for n, v in zip(spec.names, line)] for line in reversed(reg.lines(spec, 1))]
    same = reg.put(ledger.root, spec, 2, reg.header(spec), moved)
    assert not ledger.is_new_content(spec, same) and len(taken) == 2
    assert ledger.is_new_content(spec, reg.export(ledger.root, spec, 3)) and len(taken) == 3
    turned = reg.put(ledger.root, spec, 4, reg.header(spec)[::-1], [line[::-1] for line in reg.lines(spec, 1)])
    assert ledger.is_new_content(spec, turned)
    # equal fingerprints alone prove nothing: the rows decide
    monkeypatch.setattr(prints, "of", lambda *a: ())
    assert ledger.is_new_content(spec, reg.raw_file(ledger.root, spec, 3)) and not ledger.is_new_content(spec, same)


def test_a_repeated_key_fails_a_step(spark):
    twice = frame_of(spark, [{(1, "p"): (1.0, "n", 0)}]).select(*SPEC.names)
    with pytest.raises(Exception, match="duplicate key"):
        step_changes(SPEC, twice.union(twice), empty_log(spark, SPEC), F.lit("f"), F.lit(START)).collect()
