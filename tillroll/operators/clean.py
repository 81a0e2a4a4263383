"""Cleaning and profiling.

Each step is a DataFrame -> DataFrame function; ``clean_lines`` chains them
into the documented order.  Profiles (nulls, describe, histogram, skewness)
are single aggregates; anything population-level (fences, min/max) is a
one-row aggregate broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import AMOUNT_TYPE, PRICE_TYPE
from ..functions.quantiles import quantiles
from ..session import materialize


# --- C01-C06 ---------------------------------------------------------------

def drop_null_keys(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """C01."""
    return df.na.drop(subset=[key])


def dedupe(df: DataFrame, exclude: Sequence[str] = ("_source",), copies: str | None = None) -> DataFrame:
    """Exact whole-row dedupe over the business columns; with ``copies``, these and the number of equal rows."""
    biz = [c for c in df.columns if c not in exclude]
    if copies:
        return df.groupBy(*biz).agg(F.count(F.lit(1)).alias(copies))
    return df.dropDuplicates(biz)


def normalise_key(c: str | Column) -> Column:
    """Text key, trailing '.0' of a float-typed extract removed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def parse_ts(c: str | Column, formats: Sequence[str]) -> Column:
    """First format that parses; unparsable -> NULL.  Formats are
    required: a guessed day/month order silently swaps months."""
    if not formats:
        raise ValueError("at least one timestamp format is required")
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def positive_only(df: DataFrame, qty: str = "quantity", price: str = "price") -> DataFrame:
    """C05."""
    return df.where((F.col(qty) > 0) & (F.col(price) > 0))


def with_amount(df: DataFrame, qty: str = "quantity", price: str = "price",
                out: str = "amount") -> DataFrame:
    """amount = quantity x price in DECIMAL (cents)."""
    return df.withColumn(out, F.round(F.col(qty).cast("decimal(12,0)") * F.col(price).cast(PRICE_TYPE), 2)
                         .cast(AMOUNT_TYPE))


# --- C07 -------------------------------------------------------------------

def iqr_fences(df: DataFrame, col: str, factor: float = 1.5) -> DataFrame:
    """One row: q1, q3, iqr, lower, upper (linear-interpolated quartiles)."""
    q = quantiles(df, col, [0.25, 0.75], names=["q1", "q3"])
    return q.select("q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                    (F.col("q1") - factor * (F.col("q3") - F.col("q1"))).alias("lower"),
                    (F.col("q3") + factor * (F.col("q3") - F.col("q1"))).alias("upper"))


def iqr_filter(df: DataFrame, col: str, factor: float = 1.5, checkpoint: bool = False) -> DataFrame:
    """Keep lower <= x <= upper (both inclusive); with ``checkpoint`` the fence is computed once."""
    f = iqr_fences(df, col, factor).select("lower", "upper")
    if checkpoint:
        f = materialize(f)
    x = F.col(col).cast("double")
    return df.crossJoin(F.broadcast(f)).where(x.between(F.col("lower"), F.col("upper"))).drop("lower", "upper")


# --- pipeline + C08 --------------------------------------------------------

def clean_lines(raw: DataFrame, formats: Sequence[str], key: str = "customer_id",
                ts_text: str = "invoice_date", iqr_col: str | None = "amount",
                factor: float = 1.5, checkpoint: bool = True) -> DataFrame:
    """C01 -> C02 -> C03/C04 -> C05 -> C06 -> C07, in the documented order.

    The IQR fence needs several passes over its input (sketch, bracket,
    filter) and the cleaned table feeds many later steps, so with
    ``checkpoint`` its input is materialised once in the shared checkpoint folder
    instead of recomputing the scan, joins and dedupe shuffle per pass, and so is
    the fence; the cleaned table is a filter over the two and not written again.
    """
    df = dedupe(drop_null_keys(raw, key))
    df = (df.withColumn(key, normalise_key(key))
            .withColumn("invoice_ts", parse_ts(ts_text, formats))
            .where(F.col("invoice_ts").isNotNull()))
    df = with_amount(positive_only(df))
    if not iqr_col:
        return df
    if checkpoint:
        df = materialize(df)
    return iqr_filter(df, iqr_col, factor, checkpoint)


def cleaning_funnel(raw: DataFrame, formats: Sequence[str], key: str = "customer_id",
                    ts_text: str = "invoice_date", factor: float = 1.5, exclude: Sequence[str] = ("_source",),
                    checkpoint: bool = True) -> DataFrame:
    """Rows remaining and removed after each stage, in stage order.

    One group-by over the business columns (the dedupe shuffle) keeps a copy
    count per distinct row, so raw, null-key and dedupe counts come from the
    same table; key, date and positivity are flags beside the amount, and only these are
    kept; only the IQR fence needs further passes, over the amounts of the positive rows.
    The raw input is read once.
    """
    biz = [c for c in raw.columns if c not in exclude]
    g = with_amount(raw.groupBy(*biz).agg(F.count(F.lit(1)).alias("_copies"))).select(
        "_copies", "amount", F.col(key).isNotNull().alias("_key"), parse_ts(ts_text, formats).isNotNull().alias("_dated"),
        ((F.col("quantity") > 0) & (F.col("price") > 0)).alias("_positive"))
    if checkpoint:
        g = materialize(g)
    nn = F.col("_key")
    ok_date = nn & F.col("_dated")
    ok_pos = ok_date & F.col("_positive")
    counts = g.agg(F.sum("_copies").alias("raw"), F.coalesce(F.sum(F.when(nn, F.col("_copies"))), F.lit(0))
                   .alias("null_keys"),
                   F.count_if(nn).alias("dedupe"), F.count_if(ok_date).alias("dates"),
                   F.count_if(ok_pos).alias("positive"))
    n_iqr = iqr_filter(g.where(ok_pos).select("amount"), "amount", factor).agg(F.count(F.lit(1)).alias("iqr"))
    one = counts.crossJoin(n_iqr)
    stages = ["raw", "null_keys", "dedupe", "dates", "positive", "iqr"]
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("rows_after"),
                              (F.col(stages[i - 1]) - F.col(s) if i else F.lit(0).cast("bigint")).alias("removed"))
                     for i, s in enumerate(stages)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


# --- C09-C12 profiles ------------------------------------------------------

def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column (long form) plus a '__total__' row."""
    a = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns],
                   F.struct(F.lit("__total__").alias("column"),
                            sum((F.col(c) for c in df.columns), F.lit(0).cast("bigint")).alias("nulls")))
    return a.select(F.explode(rows).alias("r")).select("r.*")


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C10 (numeric): count, mean, sample sd, min, quartiles, max per column."""
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        a = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                   F.min(x).alias("min"), F.max(x).alias("max"))
        q = quantiles(df, c, [0.25, 0.5, 0.75], names=["p25", "p50", "p75"])
        parts.append(a.crossJoin(F.broadcast(q)).select(F.lit(c).alias("column"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C10 (strings): count, unique, top (most frequent; ties -> smallest), freq."""
    parts = []
    for c in cols:
        freq = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_f"))
        top = freq.agg(F.count(F.lit(1)).alias("unique"), F.sum("_f").alias("count"),
                       F.max("_f").alias("freq"))
        best = freq.join(top.select("freq"), F.col("_f") == F.col("freq")).agg(F.min(c).alias("top"))
        parts.append(top.crossJoin(best).select(F.lit(c).alias("column"), "count", "unique", "top", "freq"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def histogram(df: DataFrame, col: str, bins: int = 30, by: str | None = None,
              log1p: bool = False) -> DataFrame:
    """C11: equal-width bins over [min, max] of the whole column, last bin
    right-inclusive; every bin present (empty bins count 0), optionally per group."""
    x = F.log1p(F.col(col).cast("double")) if log1p else F.col(col).cast("double")
    d = df.select(*([F.col(by).alias("grp")] if by else [F.lit("all").alias("grp")]), x.alias("_x")) \
          .where(F.col("_x").isNotNull())
    rng = d.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))),
                F.lit(bins - 1))).cast("int")
    counts = d.crossJoin(F.broadcast(rng)).groupBy("grp", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    groups = d.select("grp").distinct()
    dense = groups.crossJoin(F.broadcast(rng.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
                                                     "_lo", "_hi")))
    return (dense.join(counts, ["grp", "bin"], "left")
            .select("grp", "bin", (F.col("_lo") + F.col("bin") * width).alias("left_edge"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("right_edge"),
                    F.coalesce("count", F.lit(0)).alias("count")))


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population skewness g1 = m3 / m2^1.5 per column (one aggregate)."""
    a = df.agg(*[F.skewness(F.col(c).cast("double")).alias(c) for c in cols])
    return a.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("skewness"))
                                        for c in cols])).alias("r")).select("r.*")
