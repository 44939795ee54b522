"""Bronze ingest by capture method: cursors, digests, order of files, growing schemas."""

import datetime as dt
import json

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import cli
from tidemark.plans import airline
from tidemark.sources import ingest
from tidemark.sources.bronze import conform, merged_schema, widened
from tidemark.sources.tables import VersionedTable
from tidemark.specs import MODELS, SNAPSHOTS, SOURCES
from tidemark.streaming.ingest import file_stream

FEED = "k STRING, v INT, _synced TIMESTAMP_NTZ, op STRING"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "bronze"))


def state(table):
    return {r["k"]: (r["v"], r["_deleted"], str(r["_synced"])[:10]) for r in rows(table.read())}


def test_every_source_has_its_business_key():
    assert set(ingest.SOURCE_KEYS) == set(SOURCES)
    assert {s.method for s in SOURCES.values()} == {"change_feed", "api_delta", "file_drop", "snapshot_diff"}
    for source, keys in ingest.SOURCE_KEYS.items():
        assert set(keys) <= {f.split()[0] for f in SOURCES[source].schema_ddl.split(", ")}


def test_change_feed_reads_past_the_cursor_kept_with_the_data(spark, table):
    feed = [("a", 1, ts("2024-01-01"), "I"), ("b", 1, ts("2024-01-02"), "I")]
    ingest.ingest_change_feed(spark.createDataFrame(feed, FEED), ["k"], table, "r1")
    assert table.metrics()["cursor"] == dt.datetime(2024, 1, 2)
    feed += [("a", 9, ts("2024-01-01"), "U"), ("b", 0, ts("2024-01-03"), "D"), ("c", 5, ts("2024-01-04"), "I"), ("c", 6, ts("2024-01-05"), "U")]
    v = ingest.ingest_change_feed(spark.createDataFrame(feed, FEED), ["k"], table, "r2")
    assert state(table) == {"a": (1, False, "2024-01-01"), "b": (1, True, "2024-01-03"), "c": (6, False, "2024-01-05")}
    # nothing past the cursor: no new version
    assert ingest.ingest_change_feed(spark.createDataFrame(feed, FEED), ["k"], table, "r3") == v == table.current_version()


def test_change_feed_without_rows_makes_no_table(spark, table):
    assert ingest.ingest_change_feed(spark.createDataFrame([], FEED), ["k"], table) is None and table.read() is None


def test_api_delta_loads_history_first_then_past_the_cursor(spark, table):
    landed = "k STRING, v INT, _synced TIMESTAMP_NTZ"
    ingest.ingest_api_delta(spark.createDataFrame([("a", 1, ts("2024-01-01")), ("a", 2, ts("2024-01-02"))], landed), ["k"], table)
    ingest.ingest_api_delta(spark.createDataFrame([("a", 7, ts("2024-01-02")), ("b", 3, ts("2024-01-03"))], landed), ["k"], table)
    assert state(table) == {"a": (2, False, "2024-01-02"), "b": (3, False, "2024-01-03")}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_file_drop_gives_the_newest_row_whatever_file_comes_first(spark, tmp_path, table, order):
    schema = "k STRING, v INT, _synced TIMESTAMP_NTZ, _deleted BOOLEAN"
    files = [[("a", 1, ts("2024-01-01"), None), ("b", 1, None, None)], [("a", 3, ts("2024-01-03"), None), ("a", 2, ts("2024-01-03"), None)],
             [("a", 9, ts("2024-01-02"), None), ("b", 4, ts("2024-01-01"), None)]]
    landing = str(tmp_path / "landing")
    for i in order:
        spark.createDataFrame(files[i], schema).coalesce(1).write.mode("append").parquet(landing)
        ingest.ingest_file_drop(file_stream(spark, landing, schema, 1), ["k"], table, str(tmp_path / "ckpt"))
    assert state(table) == {"a": (3, False, "2024-01-03"), "b": (4, False, "2024-01-01")}
    v = table.current_version()
    assert ingest.ingest_file_drop(file_stream(spark, landing, schema, 1), ["k"], table, str(tmp_path / "ckpt")) == v


# ---- snapshot diff in two phases ----------------------------------------------------------------------------

def copy_of(spark, values):
    return spark.createDataFrame(sorted(values.items()), "k STRING, v INT")


def test_equal_ranges_of_a_copy_are_not_read(spark, table):
    values = {f"k{i:03d}": i for i in range(200)}
    ingest.ingest_snapshot(copy_of(spark, values), ["k"], table, "2024-01-01", rows_per_range=25)
    ingest.ingest_snapshot(copy_of(spark, values), ["k"], table, "2024-01-02", rows_per_range=25)  # digests by the new ranges
    del values["k150"]
    values.update(k151=-1, k1515=7)
    copy = copy_of(spark, values)
    ranges, differing, _ = ingest.changed_ranges(table, copy, ["k", "v"])
    assert len(ranges.ids) >= 8 and len(differing) == 1
    diff, _ = ingest.diff_against(table, copy, ["k"])
    read = {f.rsplit("/", 2)[1] for f in diff.inputFiles() if "/bronze/" in f}
    assert read == {f"tm_range={differing[0]}"}
    assert {r.k: r.op for r in diff.collect()} == {"k150": "D", "k151": "U", "k1515": "I"}
    kept = set(table.parts_without(differing))
    ingest.ingest_snapshot(copy, ["k"], table, "2024-01-03", rows_per_range=25)
    assert kept <= set(table.parts())
    got = state(table)
    assert got["k150"] == (150, True, "2024-01-03") and got["k151"] == (-1, False, "2024-01-03") and got["k000"][2] == "2024-01-01"
    v = table.current_version()
    assert ingest.ingest_snapshot(copy, ["k"], table, "2024-01-04") == v  # an equal copy writes nothing
    values["k150"] = 5  # a deleted key comes back
    ingest.ingest_snapshot(copy_of(spark, values), ["k"], table, "2024-01-05")
    assert state(table)["k150"] == (5, False, "2024-01-05") and len(state(table)) == 201


def test_copies_with_null_keys_and_columns(spark, table):
    first = spark.createDataFrame([("a", None), ("b", 1)], "k STRING, v INT")
    ingest.ingest_snapshot(first, ["k"], table, "2024-01-01")
    ingest.ingest_snapshot(spark.createDataFrame([("a", None), ("b", None)], "k STRING, v INT"), ["k"], table, "2024-01-02")
    assert state(table) == {"a": (None, False, "2024-01-01"), "b": (None, False, "2024-01-02")}


# ---- growing schemas ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("a,b,want", [("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("float", "double", "double"),
                                      ("int", "float", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
                                      ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("string", "string", "string"),
                                      ("string", "int", None), ("bigint", "double", None), ("decimal(38,0)", "decimal(38,10)", None)])
def test_types_widen_and_never_lose(a, b, want):
    a, b = (T._parse_datatype_string(x) for x in (a, b))
    if want is None:
        with pytest.raises(TypeError):
            widened(a, b)
    else:
        assert widened(a, b).simpleString() == widened(b, a).simpleString() == want


def test_schema_merge_keeps_adds_and_widens():
    stored, arriving = (T._parse_datatype_string(x) for x in ("k STRING, v INT, gone DATE", "K STRING, v BIGINT, fresh DOUBLE"))
    assert merged_schema(stored, arriving).simpleString() == "struct<k:string,v:bigint,gone:date,fresh:double>"


def test_columns_widen_across_stored_ranges_and_narrow_batches(spark, table):
    kind = "k STRING, v {}, _synced TIMESTAMP_NTZ, op STRING"
    first = [(f"k{i:03d}", i, ts("2024-01-01"), "I") for i in range(100)]
    ingest.ingest_change_feed(spark.createDataFrame(first, kind.format("INT")), ["k"], table, rows_per_range=20)
    big = [("k099", 2**40, ts("2024-01-02"), "U")]
    ingest.ingest_change_feed(spark.createDataFrame(big, kind.format("BIGINT")), ["k"], table, rows_per_range=20)
    small = spark.createDataFrame([("k000", 5, ts("2024-01-03"), "U")], kind.format("SMALLINT")).withColumn("w", F.lit("new"))
    ingest.ingest_change_feed(small, ["k"], table, rows_per_range=20)
    out = table.read()
    assert dict(out.dtypes)["v"] == "bigint" and out.count() == 100
    got = {r.k: (r.v, r.w) for r in out.collect()}
    assert got["k099"] == (2**40, None) and got["k000"] == (5, "new") and got["k050"] == (50, None)
    v = table.current_version()
    with pytest.raises(TypeError):
        ingest.ingest_change_feed(spark.createDataFrame([("k001", "text", ts("2024-01-04"), "U")], kind.format("STRING")), ["k"], table)
    assert table.current_version() == v  # refused before anything is written


def test_conform_refuses_to_narrow(spark):
    with pytest.raises(TypeError):
        conform(spark.createDataFrame([("a", "x")], "k STRING, v STRING"), T._parse_datatype_string("k STRING, v INT"))


# ---- the command line ---------------------------------------------------------------------------------------

def test_cli_ingest_feeds_run_and_snapshot(spark, tmp_path, capsys):
    sf = "/root/testdata/sf0.001"
    landing, bronze, silver = (str(tmp_path / x) for x in ("landing", "bronze", "silver"))
    for source in ("fuel_invoice", "air_waybill", "ticket_coupon", "work_order"):  # feed, files, API, copy
        df = airline.bronze(spark, sf, source)
        if SOURCES[source].method == "change_feed":
            df = df.withColumn("op", F.when(F.col("_deleted"), "D").otherwise("U"))
        if SOURCES[source].method == "snapshot_diff":
            df = df.dropDuplicates(list(ingest.SOURCE_KEYS[source]))
        df.write.parquet(f"{landing}/{source}")
    spark.range(3).write.parquet(f"{landing}/brand_new")
    now = "2001-11-05T00:00:00"
    assert cli.main(["ingest", "--landing", landing, "--bronze", bronze, "--now", now, "--schema-policy", "ALLOW_COLUMNS"]) == 0
    assert set(json.loads(capsys.readouterr().out)) == {"fuel_invoice", "air_waybill", "ticket_coupon", "work_order"}
    assert cli.main(["ingest", "--landing", landing, "--bronze", bronze, "--now", now]) == 0
    assert json.loads(capsys.readouterr().out)["brand_new"] == 1
    for source in ("fuel_invoice", "air_waybill", "ticket_coupon", "work_order"):
        table = VersionedTable(spark, f"{bronze}/{source}")
        keys = list(ingest.SOURCE_KEYS[source])
        assert table.current_version() == 1  # the second ingest found nothing new
        assert table.read().count() == airline.bronze(spark, sf, source).select(*keys).distinct().count()
    assert cli.main(["run", "--bronze", bronze, "--silver", silver, "--now", now, "--select", "fuel_invoice", "air_waybill", "work_order"]) == 0
    out = VersionedTable(spark, f"{silver}/fuel_invoice").read()
    live = VersionedTable(spark, f"{bronze}/fuel_invoice").read().filter("NOT _deleted").count()
    assert out.count() == live > 0
    assert MODELS and SNAPSHOTS


def test_histories_of_the_airline_tables_hold_closed_and_deleted_rows(spark):
    from tidemark.plans.queries import QUERIES
    for name in SNAPSHOTS:
        got = {(r.is_current, r.is_deleted) for r in QUERIES[f"q_history_{name}"](spark, "/root/testdata/sf0.001").select("is_current", "is_deleted").distinct().collect()}
        assert got >= {(True, False), (False, False)}, name
        # no cost rate of these tables is deleted between the two runs
        assert (True, True) in got or name == "aircraft_cost_rate_history", name


def test_second_passenger_run_updates_and_inserts(spark):
    from tidemark.plans.queries import MODEL_T1, QUERIES, RUN_2
    out = QUERIES["q_model_passenger_name_record"](spark, "/root/testdata/sf0.001")
    second = out.filter(F.col("_run_id") == RUN_2)
    first_load = F.lit(MODEL_T1).cast("timestamp_ntz")
    assert second.filter(F.col("_silver_load_timestamp") == first_load).count() > 0  # updated
    assert second.filter(F.col("_silver_load_timestamp") > first_load).count() > 0   # inserted


def test_snapshot_source_lets_the_newest_row_decide(spark):
    from tidemark.plans.models import snapshot_source
    from tidemark.specs import SnapshotSpec
    spec = SnapshotSpec("h", "b", ("k",), ("k", "v"))
    data = [("a", 1, ts("2024-01-01"), False), ("a", 2, ts("2024-01-02"), True), ("b", 1, ts("2024-01-02"), None),
            ("b", 2, ts("2024-01-01"), True), ("c", 1, ts("2024-01-01"), False), ("c", 2, None, True)]
    df = spark.createDataFrame(data, "k STRING, v INT, _synced TIMESTAMP_NTZ, _deleted BOOLEAN")
    assert [(r["k"], r["v"]) for r in rows(snapshot_source(spec, df))] == [("b", 1)]
