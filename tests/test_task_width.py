"""The number of tasks that sort a history follows its rows."""

import re
from collections import Counter

import pytest
from test_changes import SPEC, fold, random_snapshots
from test_kept_state import rows_of, stamp, std_snapshots

from ledgerline.operators import changes, versions
from ledgerline.plans.series import LINEITEM, ORDERS, replay, table
from ledgerline.sources import log

SF = "/root/testdata/sf0.001"


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*, (\d+)\)", plan)]


@pytest.mark.parametrize("series", [ORDERS, LINEITEM])
def test_a_replay_has_a_bounded_number_of_rows_a_task(spark, monkeypatch, series):
    def results():
        log = replay(spark, SF, series)
        return log, versions.frame(series.spec, log), versions.latest(series.spec, log)

    want = [Counter(df.collect()) for df in results()]
    monkeypatch.setattr(changes, "ROWS_A_TASK", 500)
    rows = 4 * table(spark, SF, series.base).count()
    for df, rows_wanted in zip(results(), want, strict=True):
        # one shuffle, of the table and not of its snapshots, which windows and aggregates share
        assert exchanges(df) == [-(-rows // 500)]
        assert Counter(df.collect()) == rows_wanted


def test_loads_of_many_rows_are_the_same(spark, monkeypatch, tmp_path):
    """Loads, the state kept beside them and a rebuild, with counted rows above what one task takes."""
    monkeypatch.setattr(changes, "ROWS_A_TASK", 3)
    root, snapshots = str(tmp_path), random_snapshots(5, 3)
    std_snapshots(spark, f"{root}/std", snapshots)
    for i in range(3):
        log.load(spark, f"{root}/lake", f"{root}/std", SPEC, [stamp(i)], tail_loads=0)
    loaded = log.read(spark, f"{root}/lake", SPEC)
    assert rows_of(loaded) == sorted(map(repr, fold(snapshots)))
    assert exchanges(changes.current_state(SPEC, loaded, 30)) == [10]
