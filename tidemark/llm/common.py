"""Shared helpers of the training-data operators: Arrow maps, staged tables, word rules."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.session import scratch_path

# The word classes of the contracts, as byte tables over UTF-8.
# "plain words" are runs of bytes outside \x20 and \x09-\x0D (what bytes.split() does);
# "item words" are runs of [0-9a-z] and every byte above \x7F, after lower-casing A-Z.
ITEM_WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words `[^\\x20\\x09-\\x0D]+` as UTF-8 bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def item_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` as UTF-8 bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(ITEM_WORD_TABLE).split() if text else []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, rid: str, name: str) -> DataFrame:
    """Staged copy of ``df`` with a unique long ``rid`` per row, fixed for every later read."""
    return stage(df.withColumn(rid, F.monotonically_increasing_id()), name)


def map_columns(df: DataFrame, columns: list[str], schema: StructType | str,
                rows: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` over some columns: ``rows`` maps an iterator of column lists to column lists.

    One call per partition, so per-worker tables (automata, tokenizer memos) are built once.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    out_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ins = ({n: b.column(i).to_pylist() for i, n in enumerate(columns)} for b in batches)
        for cols in rows(ins):
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[f.name], type=f.type) for f in out_schema], schema=out_schema)

    return df.select(*columns).mapInArrow(run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """A value that lives as long as the Python worker, over all its tasks (tokenizers, their memos)."""
    held = sys.__dict__.setdefault("_tidemark_worker_cache", {})
    if name not in held:
        held[name] = make()
    return held[name]
