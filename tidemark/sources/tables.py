"""Versioned Parquet tables: the sink for merged (SCD1) and history (SCD2) outputs.

Built-in Parquet tables support neither MERGE nor DELETE, so a run writes the
whole new state to a folder of its own attempt and then publishes it: a small
commit file, written whole under another name, is renamed into place, and the
rename refuses to replace. The commit names the folders and keeps the schema
(with its PII tags), so an empty version reads back and no footer is merged.
Readers only ever see committed versions, a run never reads what it writes, and
a crash before the rename leaves the old version current. A second committer
racing for the same version number fails and touches nothing of the winner's.
Paths go through the Hadoop FileSystem API so the same code works on local
disk, HDFS or cloud storage.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Folder keys of a version's data ("<key>=000042") and of a key range in it; a read drops the derived columns.
VERSION_KEY = "tm_version"
RANGE = "tm_range"
CODEC = "zstd"  # tables and staged rows are written several times over: about a quarter less than Spark's default


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
FILE_BYTES = 1 << 20  # heap of an open Parquet file, however few rows it holds
WAVES, MANY_FILES = 2, 64  # tasks a core of a write into folders or buckets; one where a task opens more files
HEAD_ROWS = 5_000     # rows that tell which columns need no dictionary, and how long a row is
SORT_BYTES = 48       # of a row in a sort, beside the row
PLAIN = (T.StringType, T.DecimalType, T.LongType, T.IntegerType, T.DoubleType, T.TimestampType, T.TimestampNTZType)


class ConcurrentCommit(RuntimeError):
    pass


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- layout ------------------------------------------------------------------
    def _attempt(self, n: int) -> str:
        """A data folder of this attempt alone."""
        return f"{self.path}/data/{VERSION_KEY}={n:06d}-{uuid.uuid4().hex[:12]}"

    def _commit_file(self, n: int) -> str:
        return f"{self.path}/_commits/{n:06d}.json"

    # --- reading ---------------------------------------------------------------------
    def versions(self) -> list[int]:
        d = self._Path(f"{self.path}/_commits")
        if not self._fs.exists(d):
            return []
        out = []
        for st in self._fs.listStatus(d):
            name = st.getPath().getName()
            if name.endswith(".json") and name[:-5].isdigit():
                out.append(int(name[:-5]))
        return sorted(out)

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def commit_info(self, n: int) -> dict:
        stream = self._fs.open(self._Path(self._commit_file(n)))
        try:
            reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(stream))
            return json.loads(reader.readLine())
        finally:
            stream.close()

    def parts(self, version: int | None = None) -> list[str]:
        """Data folders making up a version, as recorded at commit; an empty history has none."""
        n = self.current_version() if version is None else version
        if n is None:
            return []
        return self.commit_info(n)["parts"]

    def parts_without(self, ranges: list[int], version: int | None = None) -> list[str]:
        """A version's folders outside some key ranges."""
        gone = {f"{RANGE}={r}" for r in ranges}
        return [p for p in self.parts(version) if p.rsplit("/", 1)[1] not in gone]

    def read(self, version: int | None = None, ranges: list[int] | None = None) -> DataFrame | None:
        """A version's rows; of some key ranges only, their folders alone are listed."""
        n = self.current_version() if version is None else version
        if n is None:
            return None
        info = self.commit_info(n)
        schema, parts = T.StructType.fromJson(info["schema"]), info["parts"]
        if ranges is not None:
            wanted = {f"{RANGE}={r}" for r in ranges}
            parts = [p for p in parts if p.rsplit("/", 1)[1] in wanted]
        if not parts:
            return self.spark.createDataFrame([], schema)
        # one scan with the committed schema: a column added by a later run (K7) is NULL in older files
        return (self.spark.read.option("basePath", f"{self.path}/data").schema(schema).parquet(*parts)
                .select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields]))

    # --- writing -----------------------------------------------------------------------
    def metrics(self, version: int | None = None) -> dict:
        """Metrics observed while the version was written (e.g. row count, high-water mark)."""
        n = self.current_version() if version is None else version
        if n is None:
            return {}
        out = {}
        for k, v in self.commit_info(n).get("metrics", {}).items():
            out[k] = dt.datetime.fromisoformat(v[3:]) if isinstance(v, str) and v.startswith("ts:") else v
        return out

    def commit(self, df: DataFrame, run_id: str = "", batch_id: int | None = None,
               partition_by: list[str] | None = None, observe: dict[str, Column] | None = None,
               keep: list[str] | None = None, extra: dict | None = None, largest: tuple[str, ...] = (),
               again: bool = False, base: int | None = None,
               gate: Callable[[dict], None] | None = None, plain: Sequence[str] = ()) -> int:
        """Write ``df`` to a fresh folder and publish it, with the folders in ``keep``, as the next version.

        A batch id already committed is a no-op (unless ``again``: a new layout of the same batch). ``observe`` maps
        names to aggregate expressions computed by the write job itself (``DataFrame.observe``: no second pass) and
        stored with the commit; those in ``largest`` never fall below the version before. Columns that only kept
        folders hold stay in the schema. ``base`` is the version that ``df`` was made from (0: none): if another writer
        has published since, the commit fails. ``gate`` gets the observed values between write and publish; if it
        raises, what was written is removed and the version before stays current. ``plain``: see ``encoding``.
        """
        cur = self.current_version() if base is None else base
        before = self.commit_info(cur) if cur else {}
        done = before.get("batch_id")
        if batch_id is not None and done is not None and batch_id <= done and not again:
            return cur
        n = (cur or 0) + 1
        obs = None
        if observe:
            obs = Observation(f"commit-{n}-{uuid.uuid4().hex[:12]}")  # unique across concurrent runs
            df = df.observe(obs, *[e.alias(k) for k, e in observe.items()])
        folder = self._attempt(n)
        if partition_by:
            folders = len((extra or {}).get("ranges", {}).get("ids", ())) + 1  # and the range of rows without a key
            with files_open(self.spark, folders):
                df.write.options(**encoding(plain), **row_group(self.spark, folders)).partitionBy(*partition_by).parquet(folder)
            parts = sorted(f"{folder}/{d}" for d in self._folders(folder))
        else:
            df.write.options(**encoding(plain)).parquet(folder)
            parts = [folder]
        fields = [f for f in df.schema.fields if f.name != RANGE]
        if keep:
            older = T.StructType.fromJson(before["schema"])
            fields += [f for f in older.fields if f.name not in df.schema.names]
        info = {"version": n, "run_id": run_id, "batch_id": batch_id, "parts": [*(keep or []), *parts],
                "schema": T.StructType(fields).jsonValue(), **(extra or {})}
        if obs is not None:
            found = {k: (f"ts:{v.isoformat()}" if isinstance(v, dt.datetime) else v) for k, v in obs.get.items()}
            for k in largest:  # text of instants sorts like the instants
                found[k] = max((x for x in (found[k], before.get("metrics", {}).get(k)) if x is not None), default=None)
            info["metrics"] = found
            if gate is not None:
                try:
                    gate(obs.get)
                except Exception:
                    self._fs.delete(self._Path(folder), True)
                    raise
        return self._publish(n, info)

    def _folders(self, folder: str) -> list[str]:
        return [st.getPath().getName() for st in self._fs.listStatus(self._Path(folder)) if st.isDirectory() and "=" in st.getPath().getName()]

    def restate(self, extra: dict) -> int:
        """Publish the current version's folders again with further facts about them."""
        cur = self.current_version()
        return self._publish(cur + 1, {**self.commit_info(cur), **extra, "version": cur + 1})

    def commit_history(self, rows: DataFrame, run_id: str = "", batch_id: int | None = None, plain: Sequence[str] = ()) -> int:
        """Append-only history commit: write only this run's rows, partitioned by ``is_current``.

        The new version = every closed-row folder of the previous version (never rewritten)
        + this run's closed rows + this run's current slice. A run therefore writes
        O(current slice + changes), not O(whole history).
        """
        closed = [p for p in self.parts() if p.endswith("is_current=false")]
        return self.commit(rows, run_id, batch_id, partition_by=["is_current"], keep=closed, plain=plain)

    def _publish(self, n: int, info: dict) -> int:
        target = self._Path(self._commit_file(n))
        draft = self._Path(f"{self.path}/_commits/.{n:06d}-{uuid.uuid4().hex[:12]}.tmp")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(info).encode("utf-8")))
        finally:
            out.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        no_options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        files = hadoop.FileContext.getFileContext(target.makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory()).toUri(),
                                                  self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(draft.makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory()),
                         target.makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory()), no_options)
        except Exception as e:
            self._fs.delete(draft, False)
            if not self._fs.exists(target):
                raise
            # another writer published version n first; its folders are not ours
            raise ConcurrentCommit(f"{self.path}: version {n} was committed concurrently") from e
        return n

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete data folders that the newest ``keep`` versions do not name, and the commits of older versions."""
        old, new = (self.versions()[:-keep], self.versions()[-keep:]) if keep else (self.versions(), [])
        live = {p for n in new for p in self.parts(n)}
        gone = []
        for n in old:
            dead = [p for p in map(self._Path, set(self.parts(n)) - live) if self._fs.exists(p)]
            for p in dead:
                self._fs.delete(p, True)
            if dead:
                gone.append(n)
            if new:
                self._fs.delete(self._Path(self._commit_file(n)), False)
        return gone


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` once as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage like ``checkpoint()`` but in one job (a reliable checkpoint of an
    unpersisted plan computes it twice), and the staged files give the optimizer
    exact sizes. The folder is shared storage on a cluster, so a lost executor
    loses nothing.
    """
    return _stage(df, name)[0]


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``stage`` for a consumer that ends inside the block: the folder goes with it."""
    out, path = _stage(df, name)
    try:
        yield out
    finally:
        remove_path(df.sparkSession, path)


def _stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    from tidemark.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.options(**encoding()).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


_open_lock = threading.Lock()
_open_users: dict[str, list[int]] = {}  # by session: files asked for by the writes that run
_open_before: dict[str, str] = {}


@contextmanager
def files_open(spark: SparkSession, files: int) -> Iterator[None]:
    """Writes inside hold the files of all folders or buckets open instead of sorting a task's rows by file.

    That sort spills every row of a task that does not fit its memory, and how many rows a task reads is up to the input's
    row groups. Where a task's memory has no room for so many files its rows are sorted as before. The setting is the
    session's: outputs that are built side by side share it, the last one puts it back.
    """
    me = spark._jsparkSession.sessionUUID()
    asked = files + 1 if fits_open(spark, files) else 0

    def put() -> None:
        spark.conf.set(OPEN_FILES, max([int(_open_before[me]), *_open_users[me]]))

    with _open_lock:
        if not _open_users.get(me):
            _open_before[me], _open_users[me] = spark.conf.get(OPEN_FILES, "0"), []
        _open_users[me].append(asked)
        put()
    try:
        yield
    finally:
        with _open_lock:
            _open_users[me].remove(asked)
            put()


def file_room(spark: SparkSession) -> int:
    """Bytes that a task's open files may hold: a quarter of its share of the heap, 256 MB at most for the row groups."""
    sc = spark.sparkContext
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        heap, tasks = spark._jvm.java.lang.Runtime.getRuntime().maxMemory(), sc.defaultParallelism
    else:
        heap = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(sc.getConf().get("spark.executor.memory", "1g"))
        others = max(1, sc._jsc.sc().getExecutorMemoryStatus().size() - 1)  # without the driver
        tasks = int(sc.getConf().get("spark.executor.cores", "0")) or -(-sc.defaultParallelism // others)
    return max(2 * FILE_BYTES, heap // max(1, tasks) // 4)


def fits_open(spark: SparkSession, files: int) -> bool:
    return (files + 1) * FILE_BYTES <= file_room(spark)


def row_group(spark: SparkSession, files: int) -> dict[str, int]:
    """Row groups small enough for a task's open files."""
    if not fits_open(spark, files):
        return {}
    room = min(file_room(spark), 256 << 20)
    return {"parquet.block.size": max(FILE_BYTES // 2, min(128 << 20, room // files))}


def few_tasks(df: DataFrame, files: int) -> DataFrame:
    """``df`` in one or two tasks a core, for a write to as many folders or buckets as ``files``.

    Each task opens a file of every one that it meets. Tasks and buckets both grow with the rows, so without this the
    files would grow with their square and hold ever fewer rows. The open files stream, however much a task reads; where
    they have no room, rows are sorted by file and tasks stay small. Tasks are put together side by side, as many to each:
    give the parts of a union one by one.
    """
    spark = df.sparkSession
    waves = WAVES if files <= MANY_FILES else 1
    return df.coalesce(waves * spark.sparkContext.defaultParallelism) if fits_open(spark, files) else df


def encoding(plain: Sequence[str] = ()) -> dict[str, str]:
    """Write options. ``plain`` columns get no dictionary: of values that mostly differ it is built, outgrown and dropped."""
    return {"compression": CODEC, "parquet.compression.codec.zstd.level": "1",
            **{f"parquet.enable.dictionary#{c}": "false" for c in plain}}


def head_facts(df: DataFrame) -> tuple[tuple[str, ...], int]:
    """From the first rows: the columns whose values mostly differ, and the bytes of a row in memory. They decide how
    rows are written, never which."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, PLAIN) and f.name.isidentifier()]
    head = df.select(*names).limit(HEAD_ROWS).collect()
    plain = tuple(c for i, c in enumerate(names) if len({r[i] for r in head}) > 0.9 * len(head))
    text = sum(len(v.encode()) + 7 for r in head for v in r if isinstance(v, str)) // max(1, len(head))
    return plain, 8 + 8 * len(df.columns) + text


def row_index() -> Column:
    """A row's number within its task: its largest value tells of the rows of the largest task."""
    return F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)


def fits_sort(spark: SparkSession, rows: int, row_bytes: int) -> bool:
    """Whether a task sorts so many rows in its memory for execution, of which three eighths of its share of the heap are sure."""
    forced = int(spark.conf.get("spark.shuffle.spill.numElementsForceSpillThreshold", str((1 << 31) - 1)))
    return rows < forced and rows * (row_bytes + SORT_BYTES) <= file_room(spark) * 3 // 2


@contextmanager
def bucketed(df: DataFrame, keys: list[str], buckets: int, name: str = "buckets", plain: Sequence[str] = (),
             gather: bool = False, beside: DataFrame | None = None) -> Iterator[DataFrame]:
    """``staged`` with rows of equal ``keys`` in one bucket: windows on the keys, and joins of two such copies on them,
    need no shuffle. The columns of a Parquet file take a third of the room of shuffled rows.

    ``gather``: the rows of a task fit its memory (``fits_sort``) and are put in order of their buckets first. Going from
    one open file to another with every row costs more than that sort: each has buffers and dictionaries of its own. Rows
    ``beside`` are written by tasks of their own.
    """
    from tidemark.session import scratch_path

    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}".replace("-", "_")
    path = scratch_path(spark, name)
    if gather and fits_open(spark, buckets):
        df = df.sortWithinPartitions(F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(buckets)))
    df = few_tasks(df, buckets)
    if beside is not None:
        df = df.unionByName(few_tasks(beside, buckets))
    try:
        with files_open(spark, buckets):
            (df.write.format("parquet").options(path=path, **encoding(plain), **row_group(spark, buckets))
             .bucketBy(buckets, *keys).saveAsTable(table))
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
