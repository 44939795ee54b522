import itertools

import pytest
from conftest import rows, ts

from tidemark.functions.cleanse import active
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.scd2 import spliced_history
from tidemark.plans.models import ROW_ORDER, refine
from tidemark.sources.tables import VersionedTable
from tidemark.specs import Col, SnapshotSpec, TableSpec
from tidemark.streaming.ingest import file_stream, stream_scd1, stream_scd2

SCHEMA = "k STRING, v INT, _synced TIMESTAMP_NTZ, _deleted BOOLEAN"
SPEC = TableSpec("s", "b", ("k",), (Col("k"), Col("v")))
HIST = SnapshotSpec("h", "b", ("k",), ("k", "v"))


def _land(spark, landing, batches):
    for i, data in enumerate(batches):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(landing)


BATCHES = [
    [("a", 1, ts("2024-01-01"), False), ("b", 1, ts("2024-01-01"), False)],
    [("a", 2, ts("2024-01-03"), False), ("b", 2, ts("2024-01-02"), True)],
    [("a", 0, ts("2024-01-02"), False), ("c", 1, ts("2024-01-04"), False)],   # a arrives out of order
]


def test_stream_scd1_equals_batch(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _land(spark, landing, BATCHES)
    table = VersionedTable(spark, str(tmp_path / "silver"))
    stream = file_stream(spark, landing, SCHEMA, max_files_per_trigger=1)
    stream_scd1(stream, SPEC, table, str(tmp_path / "ckpt"), "2024-01-05")
    got = {r["k"]: r["v"] for r in rows(table.read())}
    assert ROW_ORDER in table.read().columns
    everything = spark.read.parquet(landing)
    want = {r["k"]: r["v"] for r in rows(latest_per_key(active(everything), ["k"]))}
    assert got == want == {"a": 2, "b": 1, "c": 1}
    v = table.current_version()
    # a restart with the same checkpoint finds nothing new: no new version
    stream_scd1(file_stream(spark, landing, SCHEMA, 1), SPEC, table, str(tmp_path / "ckpt"), "2024-01-05")
    assert table.current_version() == v


def _events(out):
    return [(r["k"], r["v"], str(r["valid_from"])[:10], str(r["valid_to"])[:10], r["is_current"], r["is_deleted"])
            for r in rows(out, "k", "valid_from", "v")]


def _history(spark, path, batches, per_trigger):
    _land(spark, f"{path}/landing", batches)
    table = VersionedTable(spark, f"{path}/hist")
    stream_scd2(file_stream(spark, f"{path}/landing", SCHEMA, per_trigger), HIST, table, f"{path}/ckpt", rows_per_range=2)
    return table


def test_stream_scd2_tombstones_from_deletes(spark, tmp_path):
    out = spliced_history(_history(spark, str(tmp_path), BATCHES[:2], 1).read())
    assert _events(out) == [("a", 1, "2024-01-01", "2024-01-03", False, False), ("a", 2, "2024-01-03", "9999-12-31", True, False),
                            ("b", 1, "2024-01-01", "2024-01-02", False, False), ("b", 1, "2024-01-02", "9999-12-31", True, True)]


TANGLED = [  # per file: late rows, a delete before its older live row, ties, a repeated row, NULL keys and sync times
    [("a", 1, ts("2024-01-01"), False), ("d", 9, ts("2024-01-05"), True), (None, 1, ts("2024-01-01"), False)],
    [("a", 3, ts("2024-01-03"), True), ("d", 1, ts("2024-01-02"), False), ("e", 1, ts("2024-01-01"), True)],
    [("a", 2, ts("2024-01-02"), False), ("a", 4, ts("2024-01-04"), True), ("f", 1, None, False), ("g", 5, ts("2024-01-01"), None)],
    [("a", 5, ts("2024-01-06"), False), ("g", 6, ts("2024-01-01"), False), ("g", 6, ts("2024-01-01"), False),
     (None, 2, ts("2024-01-01"), True), ("d", 2, ts("2024-01-07"), False)],
]
WANT = [
    (None, 1, "2024-01-01", "9999-12-31", True, False),
    ("a", 1, "2024-01-01", "2024-01-02", False, False), ("a", 2, "2024-01-02", "2024-01-03", False, False),
    ("a", 2, "2024-01-03", "2024-01-06", False, True), ("a", 5, "2024-01-06", "9999-12-31", True, False),
    ("d", 1, "2024-01-02", "2024-01-05", False, False), ("d", 1, "2024-01-05", "2024-01-07", False, True),
    ("d", 2, "2024-01-07", "9999-12-31", True, False), ("g", 6, "2024-01-01", "9999-12-31", True, False),
]


@pytest.mark.parametrize("order,per_trigger", [((0, 1, 2, 3), 1), ((3, 2, 1, 0), 1), ((2, 0, 3, 1), 2), ((1, 3, 0, 2), 10)])
def test_stream_scd2_does_not_depend_on_grouping_or_order(spark, tmp_path, order, per_trigger):
    table = _history(spark, str(tmp_path), [TANGLED[i] for i in order], per_trigger)
    assert _events(spliced_history(table.read())) == WANT
    kept = table.read().filter("_void").count()
    assert kept == 2  # the delete of the unknown key and the second delete wait for late rows


def test_stream_scd2_late_row_wakes_a_kept_delete(spark, tmp_path):
    _history(spark, str(tmp_path), TANGLED, 4)
    _land(spark, str(tmp_path / "landing"), [[("e", 7, ts("2023-12-31"), False)]])
    table = VersionedTable(spark, str(tmp_path / "hist"))
    stream_scd2(file_stream(spark, str(tmp_path / "landing"), SCHEMA, 1), HIST, table, str(tmp_path / "ckpt"))
    got = [e for e in _events(spliced_history(table.read())) if e[0] == "e"]
    assert got == [("e", 7, "2023-12-31", "2024-01-01", False, False), ("e", 7, "2024-01-01", "9999-12-31", True, True)]


TIES = [[("a", 1, ts("2024-01-01"), False), ("n", 1, ts("2024-01-05"), False), ("t", None, ts("2024-01-01"), False)],
        [("a", 2, ts("2024-01-01"), False), ("n", 2, None, False), ("t", 3, ts("2024-01-01"), None)],
        [("a", 0, ts("2024-01-01"), None), ("n", 3, ts("2024-01-06"), False), ("n", 1, None, False)]]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_stream_scd1_orders_ties_and_null_sync_like_the_batch(spark, tmp_path, order):
    landing = str(tmp_path / "landing")
    _land(spark, landing, [TIES[i] for i in order])
    table = VersionedTable(spark, str(tmp_path / "silver"))
    stream_scd1(file_stream(spark, landing, SCHEMA, 1), SPEC, table, str(tmp_path / "ckpt"), "2024-01-05", rows_per_range=1)
    cols = ["k", "v", "_bronze_sync_timestamp", "_is_deleted"]
    want = rows(refine(SPEC, spark.read.parquet(landing), "2024-01-05", "r").select(*cols), "k")
    assert rows(table.read().select(*cols), "k") == want
    assert {r["k"]: r["v"] for r in want} == {"a": 2, "n": 2, "t": 3}
