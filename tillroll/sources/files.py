"""File sources and sinks.

Artefacts go to a *new* directory under a shared base folder - by default the
session's ``spark.checkpoint.dir`` (a cluster-wide location) - and are never
written over their own input.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, materialize

RAW_SCHEMA = T.StructType([
    T.StructField("line_id", T.StringType()),
    T.StructField("invoice", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("customer_id", T.StringType()),
])


def artefact_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one artefact under the shared checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/artefacts/{name}-{uuid.uuid4().hex[:12]}"


def read_csv(spark: SparkSession, paths: Sequence[str], schema: T.StructType = RAW_SCHEMA,
             encoding: str = "ISO-8859-1", source_col: str | None = "_source") -> DataFrame:
    """S01 + S02: multi-file CSV scan with header, charset and an explicit
    schema (no inference); malformed rows are kept in ``_corrupt_record``."""
    sch = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    df = (spark.read.schema(sch).option("header", True).option("encoding", encoding)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").csv(list(paths)))
    if source_col:
        # the name of the file's folder; a regular expression searched from every place of the path, for each row
        folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)
        df = df.withColumn(source_col, folder)
    return df


#: Blocks of a numbered scan (a path and a few numbers each) that are broadcast; more of them are joined by a shuffle.
BROADCAST_BLOCKS = 100_000


def read_numbered_csv(spark: SparkSession, paths: Sequence[str], schema: T.StructType = RAW_SCHEMA,
                      encoding: str = "ISO-8859-1", line_col: str = "line_number") -> DataFrame:
    """S01 with the position of each row: ``line_col`` counts the rows of a folder (``_source``) from 1, through its
    files in the order of their names (part-99999 before part-100000) and through each file from its start.

    Two passes: the scan is written once with its file, block and running id; rows are then counted for each block, the
    counts summed over the blocks before, and the place inside the block added.  Which task read which block has no
    influence.  Header lines are not rows; a row is a line (no line breaks inside fields).
    """
    scan = read_csv(spark, paths, schema, encoding)
    kept = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                       F.monotonically_increasing_id().alias("_seq"))
    path = artefact_dir(spark, "numbered")
    kept.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    kept = read_artefact(spark, path)
    blocks = kept.groupBy("_source", "_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    before = lambda n, w: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = blocks.groupBy("_source", "_file").agg(F.sum("_n").alias("_rows"))
    whole = whole.select("_file", before("_rows", Window.partitionBy("_source").orderBy(F.length("_file"), "_file")).alias("_above"))
    offsets = materialize(blocks.withColumn("_ahead", before("_n", Window.partitionBy("_file").orderBy("_start"))).join(whole, "_file")
                          .select("_file", "_start", (F.col("_above") + F.col("_ahead") - F.col("_first") + 1).alias("_shift")))
    few = F.broadcast(offsets) if offsets.count() <= BROADCAST_BLOCKS else offsets
    return kept.join(few, ["_file", "_start"]).withColumn(line_col, F.col("_seq") + F.col("_shift")).drop("_file", "_start", "_seq", "_shift")


def write_csv(df: DataFrame, path: str, encoding: str = "ISO-8859-1") -> str:
    df.write.mode("errorifexists").option("header", True).option("encoding", encoding).csv(path)
    return path


def write_artefact(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a result table to a new directory (fails if it exists)."""
    w = df.write.mode("errorifexists")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_artefact(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", True).csv(path)
    return r.format(fmt).load(path)


def write_json_record(df: DataFrame, path: str) -> str:
    """One JSON object per row (``to_json(struct(*))``) as text."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1).write.mode("errorifexists").text(path)
    return path


def read_json_record(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)
