from collections import Counter

import pytest

from pyspark.sql import functions as F

from tidemark.plans.models import refine, run_model, upsert
from tidemark.sources import tables
from tidemark.sources.ranges import KeyRanges, rewrite_ranges
from tidemark.sources.tables import ConcurrentCommit, VersionedTable, staged
from tidemark.specs import Col, TableSpec


def test_commit_read_and_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None and t.current_version() is None
    assert t.commit(spark.range(3), run_id="r1") == 1
    assert t.commit(spark.range(5), run_id="r2") == 2
    assert t.read().count() == 5 and t.read(1).count() == 3
    assert t.commit_info(2)["run_id"] == "r2"


def test_uncommitted_write_is_invisible(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.commit(spark.range(3))
    # a crash after the data write but before the commit file leaves v1 current
    spark.range(7).write.parquet(str(tmp_path / "t" / "data" / "tm_version=000002"))
    assert t.current_version() == 1 and t.read().count() == 3
    assert t.commit(spark.range(4)) == 2 and t.read().count() == 4  # the next run overwrites the debris


def test_racing_writer_fails(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.commit(spark.range(1))
    other = VersionedTable(spark, str(tmp_path / "t"))
    other.commit(spark.range(2))
    monkeypatch.setattr(t, "current_version", lambda: 1)  # t read version 1 before the other writer won
    with pytest.raises(ConcurrentCommit):
        t.commit(spark.range(3))


def test_batch_replay_is_noop_and_vacuum(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.commit(spark.range(1), batch_id=0) == 1
    assert t.commit(spark.range(2), batch_id=1) == 2
    assert t.commit(spark.range(9), batch_id=1) == 2  # replayed micro-batch
    assert t.read().count() == 2
    assert t.vacuum(keep=1) == [1]
    assert [p.name.rsplit("-", 1)[0] for p in (tmp_path / "t" / "data").iterdir()] == ["tm_version=000002"]


def test_observed_metrics_travel_with_the_commit(spark, tmp_path):
    import datetime as dt

    from pyspark.sql import functions as F
    t = VersionedTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3, 4, 5, 6)), (2, dt.datetime(2024, 1, 1))],
                               "id INT, _bronze_sync_timestamp TIMESTAMP_NTZ")
    t.commit(df, observe={"rows": F.count(F.lit(1)), "high_water_mark": F.max("_bronze_sync_timestamp")})
    assert t.metrics() == {"rows": 2, "high_water_mark": dt.datetime(2024, 1, 2, 3, 4, 5, 6)}


def test_history_commits_append_closed_rows(spark, tmp_path):
    import datetime as dt

    from tidemark.operators.scd2 import scd2_apply
    t = VersionedTable(spark, str(tmp_path / "h"))
    s = "k STRING, v INT, _synced TIMESTAMP_NTZ"
    c1 = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1)), ("b", 1, dt.datetime(2024, 1, 1))], s)
    t.commit_history(scd2_apply(None, c1, ["k"], "2024-01-01", include_closed=False))
    c2 = spark.createDataFrame([("a", 2, dt.datetime(2024, 1, 2))], s)
    t.commit_history(scd2_apply(t.read(), c2, ["k"], "2024-01-03", include_closed=False))
    c3 = spark.createDataFrame([("a", 3, dt.datetime(2024, 1, 4))], s)
    t.commit_history(scd2_apply(t.read(), c3, ["k"], "2024-01-05", include_closed=False))
    parts = t.parts()
    # closed rows of runs 2 and 3 stay in their own folders; only run 3's current slice is new
    assert [[p.rsplit("/", 2)[-2].rsplit("-", 1)[0], p.rsplit("/", 1)[-1]] for p in parts] == [
        ["tm_version=000002", "is_current=false"], ["tm_version=000003", "is_current=false"], ["tm_version=000003", "is_current=true"]]
    out = {(r.k, r.v, r.is_current, r.is_deleted) for r in t.read().collect()}
    assert out == {("a", 1, False, False), ("a", 2, False, False), ("a", 3, True, False),
                   ("b", 1, False, False), ("b", 1, True, True)}
    assert t.vacuum(keep=1) == [1, 2]  # v1 is no longer referenced; v2's closed rows are


def test_history_folders_with_an_added_column_read_together(spark, tmp_path):
    import datetime as dt

    from tidemark.operators.scd2 import scd2_apply
    t = VersionedTable(spark, str(tmp_path / "h"))
    c1 = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1))], "k STRING, v INT, _synced TIMESTAMP_NTZ")
    t.commit_history(scd2_apply(None, c1, ["k"], "2024-01-01", include_closed=False))
    c2 = spark.createDataFrame([("a", 2, dt.datetime(2024, 1, 2), "x")],
                               "k STRING, v INT, _synced TIMESTAMP_NTZ, w STRING")
    t.commit_history(scd2_apply(t.read(), c2, ["k"], "2024-01-03", include_closed=False))
    out = sorted((r.v, r.w) for r in t.read().collect())
    assert out == [(1, None), (2, "x")]


def test_losing_writer_leaves_the_winners_data_alone(spark, tmp_path, monkeypatch):
    a, b = VersionedTable(spark, str(tmp_path / "t")), VersionedTable(spark, str(tmp_path / "t"))
    a.commit(spark.range(3))
    monkeypatch.setattr(b, "current_version", lambda: 1)  # both writers saw version 1
    a.commit(spark.range(10, 15))
    with pytest.raises(ConcurrentCommit):
        b.commit(spark.range(100, 200))
    assert sorted(r.id for r in a.read().collect()) == [10, 11, 12, 13, 14]


def test_crash_before_publishing_keeps_the_old_version(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.commit(spark.range(3))
    (tmp_path / "t" / "_commits" / ".000002-abc.tmp").write_text("")
    assert t.current_version() == 1 and t.read().count() == 3
    assert t.commit(spark.range(5)) == 2 and t.read().count() == 5


def test_empty_first_history_reads_back(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "h"))
    rows = spark.createDataFrame([], "k string, v int, is_current boolean")
    t.commit_history(rows)
    assert t.read().count() == 0 and t.read().columns == ["k", "v", "is_current"]


def test_pii_tags_survive_commit_and_read(spark, tmp_path):
    from tidemark.functions.governance import masked_view, pii_columns, tag_pii

    t = VersionedTable(spark, str(tmp_path / "p"))
    df = spark.createDataFrame([("a", "Jo")], "id string, name string")
    t.commit(tag_pii(df, {"name": "FIRST_NAME"}))
    assert pii_columns(t.read()) == {"name": "FIRST_NAME"}
    assert masked_view(t.read(), ["ANALYST_ROLE"], required={"name": "FIRST_NAME"}).first().name == "***MASKED***"
    with pytest.raises(ValueError):
        masked_view(df, ["ANALYST_ROLE"], required={"name": "FIRST_NAME"})


# ---- key ranges -------------------------------------------------------------------------------------------

RANGED = TableSpec("out", "b", ("k", "n"), (Col("k"), Col("n"), Col("v")))
RANGED_SCHEMA = "k STRING, n INT, v INT, _synced TIMESTAMP_NTZ, _deleted BOOLEAN"


def _bronze(spark, keys, v, day):
    import datetime as dt
    return spark.createDataFrame([(k, 1, v, dt.datetime(2024, 1, day), False) for k in keys], RANGED_SCHEMA)


def _files(table):
    import hashlib
    import os
    return {f"{p}/{f}": hashlib.sha256(open(f"{p}/{f}", "rb").read()).hexdigest()
            for p in table.parts() for f in os.listdir(p) if f.startswith("part-")}


def _state(table):
    return {(r.k, r.n): r.v for r in table.read().collect()}


def test_run_rewrites_only_the_ranges_of_changed_keys(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    keys = [f"k{i:04d}" for i in range(400)]
    first = _bronze(spark, keys, 0, 1)
    run_model(RANGED, first, t, "2024-01-01", "r1", rows_per_range=50)
    ranges = KeyRanges.load(t.commit_info(t.current_version())["ranges"])
    assert len(ranges.ids) == 8 and t.read().count() == 400
    before, mark = _files(t), t.metrics()["high_water_mark"]
    changed = keys[395:] + ["k9998", "k9999"]
    run_model(RANGED, first.unionByName(_bronze(spark, changed, 1, 2)), t, "2024-01-09", "r2", rows_per_range=50)
    after = _files(t)
    kept = before.keys() & after.keys()
    assert len({f.rsplit("/", 2)[1] for f in kept}) == 7 and all(before[f] == after[f] for f in kept)
    assert _state(t) == {**{(k, 1): 0 for k in keys}, **{(k, 1): 1 for k in changed}}
    assert t.metrics()["high_water_mark"] > mark and t.metrics()["rows_written"] < 60
    # a late change of an old key moves neither the mark nor the other ranges
    mark = t.metrics()["high_water_mark"]
    with staged(refine(RANGED, _bronze(spark, ["k0000", "k0001"], 7, 1), "2024-01-10", "r3")) as late:
        upsert(RANGED, t, late, "r3", rows_per_range=50)
    assert t.metrics()["high_water_mark"] == mark and _state(t)["k0001", 1] == 7 and len(_state(t)) == 402


def test_range_that_outgrows_its_size_is_split(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    sizes = []
    for day in range(1, 7):  # keys grow with time, as business numbers do
        keys = [f"k{i:05d}" for i in range(day * 100, day * 100 + 100)]
        run_model(RANGED, _bronze(spark, keys, day, day), t, f"2024-01-{day:02d}", f"r{day}", rows_per_range=40)
        sizes.append(len(KeyRanges.load(t.commit_info(t.current_version())["ranges"]).ids))
    assert t.read().count() == 600 and sizes == sorted(sizes) and sizes[-1] >= 8
    assert _state(t) == {(f"k{i:05d}", 1): i // 100 for i in range(100, 700)}


def test_rows_without_a_leading_key_are_appended(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    for n in (1, 2, 3):
        batch = _bronze(spark, [None, "a", f"b{n}"], n, n)
        run_model(RANGED, batch, t, f"2024-01-0{n}", f"r{n}")
    got = sorted((r.k or "", r.v) for r in t.read().collect())
    assert got == [("", 1), ("", 2), ("", 3), ("a", 3), ("b1", 1), ("b2", 2), ("b3", 3)]


def test_new_column_reads_null_in_untouched_ranges(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    keys = [f"k{i:04d}" for i in range(100)]
    run_model(RANGED, _bronze(spark, keys, 0, 1), t, "2024-01-01", "r1", rows_per_range=20)
    wider = TableSpec("out", "b", ("k", "n"), (Col("k"), Col("n"), Col("v"), Col("w")))
    with staged(refine(wider, _bronze(spark, keys[-3:], 1, 2).withColumn("w", F.lit("x")), "2024-01-02", "r2")) as updates:
        upsert(wider, t, updates, "r2")
    assert {r.k for r in t.read().filter("w = 'x'").collect()} == set(keys[-3:]) and t.read().count() == 100


@pytest.mark.parametrize("kind", ["INT", "BIGINT", "DATE", "TIMESTAMP_NTZ", "DECIMAL(9,2)", "STRING", "DOUBLE"])
def test_ranges_of_every_key_type(spark, tmp_path, kind):
    spec = TableSpec("out", "b", ("k",), (Col("k"), Col("v")))
    cast = {"DATE": "date_add(DATE '2024-01-01', CAST(id AS INT))", "TIMESTAMP_NTZ": "CAST(date_add(DATE '2024-01-01', CAST(id AS INT)) AS TIMESTAMP_NTZ)"}
    bronze = spark.range(60).selectExpr(f"CAST({cast.get(kind, 'id - 20')} AS {kind}) AS k", "CAST(id AS INT) AS v",
                                        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _synced", "FALSE AS _deleted")
    t = VersionedTable(spark, str(tmp_path / "t"))
    run_model(spec, bronze, t, "2024-01-01", "r1", rows_per_range=10)
    ranges = KeyRanges.load(t.commit_info(t.current_version())["ranges"])
    assert len(ranges.ids) == (1 if kind == "DOUBLE" else 6)
    run_model(spec, bronze.withColumn("v", F.col("v") + 100), t, "2024-01-02", "r2", rows_per_range=10)
    assert sorted(r.v for r in t.read().collect()) == list(range(100, 160))


def test_writer_based_on_an_older_version_fails(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"))
    run_model(RANGED, _bronze(spark, ["a"], 0, 1), t, "2024-01-01", "r1")
    other = VersionedTable(spark, str(tmp_path / "t"))
    with staged(refine(RANGED, _bronze(spark, ["b"], 1, 2), "2024-01-02", "r2")) as updates:
        def late(stored, changes):
            run_model(RANGED, _bronze(spark, ["c"], 2, 3), other, "2024-01-03", "r3")  # publishes in between
            return stored.unionByName(changes)
        with pytest.raises(ConcurrentCommit):
            rewrite_ranges(t, updates, "k", late, "r2")
    assert _state(t) == {("a", 1): 0, ("c", 1): 2}


def test_added_rows_leave_stored_files_alone_and_first_layout_is_written_once(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))

    def add(values):
        with staged(spark.createDataFrame(values, "k INT, v INT")) as batch:
            return rewrite_ranges(t, batch, "k", None, rows_per_range=50, gather=True)

    assert add([(i, 0) for i in range(400)]) == 1  # laid out in ranges before it is written, not written and then split
    assert len(KeyRanges.load(t.commit_info(1)["ranges"]).ids) == 8
    before, want = _files(t), [(i, 0) for i in range(400)]
    add([(5, 1), (399, 1), (None, 1)])
    after = _files(t)
    assert before.items() <= after.items()
    want += [(5, 1), (399, 1), (None, 1)]
    for n in range(2, 20):  # folders of a range are put together before they are many
        add([(5, n)])
        want.append((5, n))
    key = lambda kv: (kv[0] is None, kv)
    assert sorted(((r.k, r.v) for r in t.read().collect()), key=key) == sorted(want, key=key)
    assert max(Counter(p.rsplit("/", 1)[1] for p in t.parts()).values()) <= 16


SPILLS = """
import glob, json, sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from tidemark.session import build_session
from tidemark.sources import tables
from tidemark.sources.ranges import KeyRanges
w = {where!r}
spark = build_session("local[1]", 4, "spills", {{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + w + "/log",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.sql.warehouse.dir": w + "/warehouse",
    "spark.checkpoint.dir": w + "/ck", "spark.shuffle.spill.numElementsForceSpillThreshold": "500"}})
rows = spark.range(0, 20000, 1, 1).select("id", F.lit("x").alias("v"))
with tables.bucketed(rows, ["id"], 7) as kept:
    assert spark.conf.get(tables.OPEN_FILES) == "0" and kept.count() == 20000
ranges = KeyRanges.of(rows, "id").split([5000, 9000])
t = tables.VersionedTable(spark, w + "/t")
t.commit(rows.withColumn(tables.RANGE, ranges.column()), partition_by=[tables.RANGE], extra={{"ranges": ranges.dump()}})
assert sorted(r.id for r in t.read().collect()) == list(range(20000)) and len(t.parts()) == 3
spark.stop()
tasks = [json.loads(x) for x in open(glob.glob(w + "/log/*")[0]) if '"SparkListenerTaskEnd"' in x]
print("spilled", sum(x["Task Metrics"]["Memory Bytes Spilled"] for x in tasks))
"""


def test_rows_are_written_to_buckets_and_ranges_without_a_sort_that_spills(tmp_path):
    import os
    import subprocess
    import sys
    (tmp_path / "log").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_CONF"))}
    out = subprocess.run([sys.executable, "-c", SPILLS.format(root=root, where=str(tmp_path))], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=200)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split()[-2:] == ["spilled", "0"]


def test_open_files_are_shared_by_writes_side_by_side(spark):
    from tidemark.sources.tables import OPEN_FILES, files_open
    before = spark.conf.get(OPEN_FILES, "0")
    with files_open(spark, 5):
        with files_open(spark, 9):
            assert spark.conf.get(OPEN_FILES) == "10"
            with files_open(spark, 10**6):
                assert spark.conf.get(OPEN_FILES) == "10"  # no room for a million: those rows are sorted
        assert spark.conf.get(OPEN_FILES) == "6"
    assert spark.conf.get(OPEN_FILES) == before


def test_files_of_buckets_do_not_grow_with_the_input_tasks(spark):
    rows = spark.range(0, 4000, 1, 60).select("id", F.lit("x").alias("v"))
    few = 2 * spark.sparkContext.defaultParallelism
    for gather in (False, True):
        with tables.bucketed(rows, ["id"], 5, gather=gather) as kept:
            assert len(kept.inputFiles()) <= few * 5  # not 60 tasks x 5 buckets
            assert sorted(r.id for r in kept.collect()) == list(range(4000))
            plan = kept.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan
    with tables.bucketed(rows.filter("id < 3000"), ["id"], 5, beside=rows.filter("id >= 3000")) as kept:
        assert len(kept.inputFiles()) <= 2 * few * 5 and sorted(r.id for r in kept.collect()) == list(range(4000))


def test_columns_whose_values_differ_are_written_without_a_dictionary(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    rows = spark.range(0, 3000, 1, 2).select(F.concat(F.lit("k-"), "id").alias("k"), (F.col("id") % 7).alias("n"), F.lit(None).cast("string").alias("e"))
    plain, row_bytes = tables.head_facts(rows)
    assert plain == ("k",) and 32 <= row_bytes <= 64
    assert tables.head_facts(rows.limit(0))[0] == ()
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.commit(rows, plain=plain)
    for f in glob.glob(str(tmp_path / "t/data/*/*.parquet")):
        used = {c["path_in_schema"]: c["encodings"] for c in pq.read_metadata(f).to_dict()["row_groups"][0]["columns"]}
        assert not any("DICTIONARY" in e for e in used["k"]) and any("DICTIONARY" in e for e in used["n"])
    assert t.read().exceptAll(rows).count() == 0 and t.read().count() == 3000


def test_rows_that_a_task_cannot_hold_are_not_sorted(spark):
    room = tables.file_room(spark)
    assert tables.fits_sort(spark, room // 100, 100) and not tables.fits_sort(spark, room // 90, 100)
    found = spark.range(0, 100, 1, 3).select(tables.row_index().alias("i")).agg(F.max("i")).first()[0]
    assert found + 1 == 34  # the largest of three tasks
