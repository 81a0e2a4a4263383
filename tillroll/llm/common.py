"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def cut(df: DataFrame, name: str, gather: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: later passes re-read the files, also after the loss of the
    executors that wrote them.  ``gather``: at most one file a core, for what comes
    out of a shuffle (its partitions are read one after the other, not moved).
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.coalesce(spark.sparkContext.defaultParallelism) if gather else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; null for null."""
    return F.crc32(col.cast("string").cast("binary")) % n


def fraction_of(key: Column, wanted: int, total: int) -> Column:
    """Keyed-hash row choice: about ``wanted`` of ``total`` rows, the same ones in every run."""
    if total <= wanted:
        return F.lit(True)
    return F.pmod(key, F.lit(1 << 30)) < F.lit(int((1 << 30) * wanted / total))


def crc32_ids(ids) -> int:
    """Unsigned CRC-32 of token ids laid out as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
