"""Small helpers shared by the operators: tables, landed intermediates, keys."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoline.session import scratch_path
from cargoline.storage import delete

NO_ID = -(2**63)  # stands for a null doc_id in internal keys


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def land(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once under the shared scratch root and read it back.

    Cuts the lineage at files every executor can read, so a lost executor
    costs only its running tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def landed(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like ``land``, but the files are deleted at the end: what is made of them inside must be written there."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def id_key(id_col: str) -> Column:
    """The document id with null mapped to a fixed value, for plain equi-joins."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def text_key(text_col: str) -> Column:
    """31 bits of the text's CRC-32; tells apart rows that share an id."""
    return F.shiftright(F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")), 1)


def blocks_of(column, size: int) -> Iterator[tuple[int, int]]:
    """``(first, number)`` of consecutive texts that hold about ``size`` bytes together, or one longer text."""
    lengths = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, lo = np.cumsum(lengths), 0
    while lo < len(lengths):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - lengths[lo] + size, "right")))
        yield lo, hi - lo
        lo = hi


def texts(column) -> Iterator[bytes]:
    """The UTF-8 bytes of an Arrow string column, one value at a time; null as b''."""
    for value in column:
        buffer = value.as_py()
        yield b"" if buffer is None else buffer.encode("utf-8", "surrogatepass")
