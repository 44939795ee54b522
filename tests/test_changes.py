from conftest import rows, ts

from tidemark.sources.changes import api_delta, apply_changes, snapshot_diff

FEED = "k STRING, v INT, _synced TIMESTAMP_NTZ, op STRING"


import pytest


@pytest.mark.parametrize("strategy", ["shuffle", "lookup"])
def test_apply_changes_latest_wins_and_delete_keeps_payload(spark, strategy):
    bronze = spark.createDataFrame([("a", 1, ts("2024-01-01"), False), ("b", 1, ts("2024-01-01"), False),
                                    ("c", 1, ts("2024-01-01"), False)],
                                   "k STRING, v INT, _synced TIMESTAMP_NTZ, _deleted BOOLEAN")
    feed = spark.createDataFrame([
        ("a", 2, ts("2024-01-02"), "U"), ("a", 3, ts("2024-01-03"), "U"),   # latest change wins
        ("b", 0, ts("2024-01-02"), "D"),                                     # delete keeps payload v=1
        ("d", 5, ts("2024-01-02"), "I"), ("e", 7, ts("2024-01-02"), "D"),    # insert; delete of unknown key
    ], FEED)
    out = {r["k"]: r for r in rows(apply_changes(bronze, feed, ["k"], strategy=strategy), "k")}
    assert (out["a"]["v"], out["a"]["_deleted"]) == (3, False)
    assert (out["b"]["v"], out["b"]["_deleted"], out["b"]["_synced"]) == (1, True, ts("2024-01-02"))
    assert (out["c"]["v"], out["c"]["_deleted"]) == (1, False)
    assert (out["d"]["v"], out["d"]["_deleted"]) == (5, False)
    assert (out["e"]["v"], out["e"]["_deleted"]) == (7, True)


def test_snapshot_diff_null_safe(spark):
    prev = spark.createDataFrame([("a", 1, None), ("b", 1, "x"), ("c", 1, None)], "k STRING, v INT, w STRING")
    curr = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("d", 2, "y")], "k STRING, v INT, w STRING")
    out = {r["k"]: r["op"] for r in rows(snapshot_diff(prev, curr, ["k"]), "k")}
    assert out == {"b": "U", "c": "D", "d": "I"}  # a: NULL == NULL, unchanged


def test_snapshot_diff_feeds_apply_changes(spark):
    prev = spark.createDataFrame([("a", 1), ("b", 1)], "k STRING, v INT")
    curr = spark.createDataFrame([("a", 2), ("c", 3)], "k STRING, v INT")
    from pyspark.sql import functions as F
    diff = snapshot_diff(prev, curr, ["k"]).withColumn("_synced", F.lit("2024-01-02").cast("timestamp_ntz"))
    bronze = prev.withColumn("_synced", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("_deleted", F.lit(False))
    out = {r["k"]: (r["v"], r["_deleted"]) for r in rows(apply_changes(bronze, diff, ["k"]))}
    assert out == {"a": (2, False), "b": (1, True), "c": (3, False)}


def test_api_delta_only_past_cursor(spark):
    landed = spark.createDataFrame([("a", 1, ts("2024-01-01")), ("b", 1, ts("2024-01-03"))],
                                   "k STRING, v INT, _synced TIMESTAMP_NTZ")
    out = rows(api_delta(landed, ts("2024-01-02")))
    assert [(r["k"], r["op"]) for r in out] == [("b", "U")]
