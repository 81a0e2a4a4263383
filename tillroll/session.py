"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames.  ``local_session`` exists for tests, the bench and the
command line; on a cluster the caller passes the session it already has.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "tillroll") -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant
    folder and is used as is.  Only a local master without one gets a scratch
    folder, so ``DataFrame.checkpoint()`` works; a cluster without one raises, as
    its machines share no local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def materialize(df):
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in
    the shared checkpoint folder (re-read by every later pass; survives the
    loss of the executors that computed it)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


PARALLELISM = 8  # Spark jobs that the driver submits at a time


def in_parallel(spark: SparkSession, fn: Callable, jobs: Iterable, parallelism: int = PARALLELISM) -> list:
    """``[fn(job) for job in jobs]``, several Spark jobs at a time; the first error is raised.

    Each job gets a copy of the local properties of its own.  Shared by the threads, the query id that one sets
    would be taken away by another that ends (``Cannot parse null string``)."""
    checkpoint_dir(spark)  # set before any thread needs it
    runs = [inheritable_thread_target(spark)(partial(fn, j)) for j in jobs]
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(runs)))) as pool:
        return list(pool.map(lambda run: run(), runs))
