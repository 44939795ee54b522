"""Plan-shape regressions for the properties that matter at scale."""

import datetime as dt

from tidemark.operators.merge import merge_upsert
from tidemark.operators.scd2 import scd2_apply
from tidemark.sources.tables import VersionedTable, stage

T = "k STRING, v INT, _bronze_sync_timestamp TIMESTAMP_NTZ, _silver_load_timestamp TIMESTAMP_NTZ"


def _plan(df, capsys) -> str:
    df.explain()
    return capsys.readouterr().out


def _frames(spark):
    now = dt.datetime(2024, 1, 1)
    target = stage(spark.createDataFrame([(f"k{i}", i, now, now) for i in range(200)], T), "t")
    updates = stage(spark.createDataFrame([("k1", -1, now, now), ("new", 5, now, now)], T), "u")
    return target, updates


def test_small_staged_batch_never_shuffles_the_target(spark, capsys):
    target, updates = _frames(spark)
    plan = _plan(merge_upsert(target, updates, ["k"], strategy="lookup"), capsys)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert merge_upsert(target, updates, ["k"]).count() == 201


def test_shuffle_merge_is_one_full_outer_join(spark, capsys):
    target, updates = _frames(spark)
    plan = _plan(merge_upsert(target, updates, ["k"], strategy="shuffle"), capsys)
    assert plan.count("FullOuter") == 1


def test_history_run_reads_only_the_current_slice(spark, tmp_path, capsys):
    s = "k STRING, v INT, _synced TIMESTAMP_NTZ"
    t = VersionedTable(spark, str(tmp_path / "h"))
    c1 = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1))], s)
    t.commit_history(scd2_apply(None, c1, ["k"], "2024-01-01", include_closed=False))
    c2 = spark.createDataFrame([("a", 2, dt.datetime(2024, 1, 2))], s)
    t.commit_history(scd2_apply(t.read(), c2, ["k"], "2024-01-03", include_closed=False))
    plan = _plan(scd2_apply(t.read(), c2, ["k"], "2024-01-04", include_closed=False), capsys)
    assert "PartitionFilters: [isnotnull(is_current" in plan
