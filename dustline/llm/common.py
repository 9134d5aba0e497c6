"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline.session import fresh_path

#: Text handled at once inside a Python task; only a single longer document exceeds it.
CHUNK_BYTES = 2 << 20
#: Rows of ids that may be broadcast (16 MB of longs); more are joined through a shuffle.
BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id as text modulo ``mod``; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string")) % mod


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` below the shared checkpoint folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_ids(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Semi or anti join whose id side is broadcast only when a count proves it small."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, key, how)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the incoming batches of at most ``CHUNK_BYTES`` of text each (one row at least)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
            sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        else:
            sizes = np.zeros(batch.num_rows, dtype=np.int64)
        ends, at, total = np.cumsum(sizes), 0, 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, total + CHUNK_BYTES, side="right")))
            yield batch.slice(at, stop - at)
            at, total = stop, int(ends[stop - 1])
        del batch, col
    pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    col = batch.column(batch.schema.get_field_index(text))
    if pa.types.is_null(col.type):
        return [b""] * batch.num_rows
    return [t or b"" for t in col.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wrapping unsigned arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments of ``values`` (rows), empty segments giving zero."""
    out = np.zeros((len(counts),) + values.shape[1:], dtype=np.float64)
    full = np.flatnonzero(counts)
    if len(full):
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))[full]
        out[full] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out
