"""Small shared helpers of the training-data operators."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kalulu.session import ensure_checkpoint_dir

#: stands for a null document id where ids are ordered: before every other id
NULL_ID = -(2 ** 63)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder that ``spark.checkpoint.dir`` names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Total size of the texts in bytes: one scan, one number."""
    row = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("n")).first()
    return int(row.n or 0)


def parts_for(total: int, each: int) -> int:
    """Number of parts of about ``each`` units; grows in proportion to the data."""
    return max(1, math.ceil(total / each))


def id_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def flat_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string/binary column back to back, and the row offsets.

    Null rows count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # combine_chunks of zero chunks
        column = pa.array([], pa.large_binary())
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def is_space(data: np.ndarray) -> np.ndarray:
    """The bytes that part words: 0x20 and 0x09-0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


#: tables of at most so many narrow rows may be broadcast
BROADCAST_ROWS = 100_000


def checked_side(df: DataFrame) -> DataFrame:
    """A side of a join, computed once and marked for broadcast only if it is counted and small.

    A larger table joins by shuffle; the result is the same.
    """
    df = checkpoint(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
