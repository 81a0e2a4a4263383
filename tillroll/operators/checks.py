"""Before/after dataset validation (V01-V08) and artefact checks.

Each check is a one-row DataFrame; ``check_report`` unions named checks into
PASS/FAIL rows plus an overall verdict, ``copy_counts`` and ``verdicts`` do so
from one comparison of the lines and one of the keys.  Row-level comparisons join on an
explicit line id carried from ingestion, never on partition order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def row_counts(before: DataFrame, after: DataFrame, expected: int | None = None) -> DataFrame:
    """Rows before/after, equal, equal to ``expected``."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"))
    j = b.crossJoin(a).withColumn("same_rows", F.col("rows_before") == F.col("rows_after"))
    if expected is not None:
        j = j.withColumn("rows_as_expected", F.col("rows_after") == F.lit(expected))
    return j


def total_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Total NULL cells over ``cols`` (default all)."""
    cols = list(cols or df.columns)
    return df.agg(sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0).cast("bigint")).alias("nulls"))


def key_set_equality(before: DataFrame, after: DataFrame, key: str = "customer_id",
                     norm=None) -> DataFrame:
    """Distinct key sets equal?  Keys only before / only after."""
    f = norm or (lambda c: c)
    b = before.select(f(F.col(key)).alias("k")).where("k IS NOT NULL").distinct().withColumn("_b", F.lit(True))
    a = after.select(f(F.col(key)).alias("k")).where("k IS NOT NULL").distinct().withColumn("_a", F.lit(True))
    j = b.join(a, "k", "full_outer")
    return j.agg(F.count_if(F.col("_a").isNull()).alias("only_before"),
                 F.count_if(F.col("_b").isNull()).alias("only_after"),
                 F.count_if(F.col("_a") & F.col("_b")).alias("common")) \
        .withColumn("identical", (F.col("only_before") == 0) & (F.col("only_after") == 0))


def compare_columns(before: DataFrame, after: DataFrame, line_id: str,
                    pairs: Sequence[tuple[str, str]], as_string: Sequence[str] = ()) -> DataFrame:
    """Full-outer join on the line id; per compared column the
    number of lines whose values differ (NULL-safe), plus unmatched lines."""
    b = before.select(F.col(line_id).alias("_id"), *[F.col(x).alias(f"b_{x}") for x, _ in pairs])
    a = after.select(F.col(line_id).alias("_id"), *[F.col(y).alias(f"a_{y}") for _, y in pairs],
                     F.lit(True).alias("_in_a"))
    b = b.withColumn("_in_b", F.lit(True))
    j = b.join(a, "_id", "full_outer")

    def val(c: str, s: bool) -> Column:
        return F.col(c).cast("string") if s else F.col(c)
    aggs = [F.count_if(F.col("_in_a").isNull() | F.col("_in_b").isNull()).alias("unmatched_lines")]
    for x, y in pairs:
        s = x in as_string
        aggs.append(F.count_if(~val(f"b_{x}", s).eqNullSafe(val(f"a_{y}", s))).alias(f"diff_{y}"))
    return j.agg(*aggs)


def skew_drift(before: DataFrame, after: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Population skewness before / after per column and |drift| in %."""
    b = before.agg(*[F.skewness(F.col(x).cast("double")).alias(f"b{i}") for i, (x, _) in enumerate(pairs)])
    a = after.agg(*[F.skewness(F.col(y).cast("double")).alias(f"a{i}") for i, (_, y) in enumerate(pairs)])
    j = b.crossJoin(a)
    rows = F.array(*[F.struct(F.lit(y).alias("column"), F.col(f"b{i}").alias("skew_before"),
                              F.col(f"a{i}").alias("skew_after"),
                              F.when(F.col(f"b{i}") != 0, F.abs(F.col(f"a{i}") - F.col(f"b{i}"))
                                     / F.abs(F.col(f"b{i}")) * 100).alias("drift_pct"))
                     for i, (_, y) in enumerate(pairs)])
    return j.select(F.explode(rows).alias("r")).select("r.*")


def amount_consistency(df: DataFrame, qty: str = "quantity", price: str = "price",
                       amount: str = "amount", atol: float = 0.01, rtol: float = 1e-5) -> DataFrame:
    """Lines where |amount - round(qty x price, 2)| > atol + rtol * |amount|."""
    recomputed = F.round(F.col(qty).cast("decimal(12,0)") * F.col(price).cast("decimal(12,2)"), 2).cast("double")
    a = F.col(amount).cast("double")
    bad = F.abs(a - recomputed) > (F.lit(atol) + F.lit(rtol) * F.abs(a))
    return df.agg(F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("inconsistent"))


def check_report(checks: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """``(name, one-row DataFrame, boolean SQL expression)`` -> rows
    (check, passed, status) plus an 'ALL' row that is the AND of all."""
    parts = [df.select(F.lit(name).alias("check"), F.expr(cond).alias("passed")) for name, df, cond in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    overall = out.agg(F.lit("ALL").alias("check"), F.bool_and("passed").alias("passed"))
    out = out.unionByName(overall)
    return out.withColumn("status", F.when(F.col("passed"), F.lit("PASS")).otherwise(F.lit("FAIL")))


def copy_counts(before: DataFrame, after: DataFrame, not_null: Sequence[str], unchanged: Sequence[str],
                attr: str, key: str = "customer_id", line_id: str = "line_id") -> DataFrame:
    """V01-V04 and V06 of an adapted copy in one row: both sides are computed once, as slim tables, their lines
    are joined once, and the keys of both are grouped once (two shuffles).  ``multi_<attr>`` counts keys with more than one
    ``attr`` after; lines without a key belong to no key."""
    after = after.withColumn("_nulls", sum((F.col(c).isNull().cast("bigint") for c in not_null), F.lit(0).cast("bigint")))
    before = materialize(before.select(line_id, key, *unchanged))
    after = materialize(after.select(line_id, key, *unchanged, "_nulls", *({attr} - {key, *unchanged})))
    b = before.select(F.col(line_id).alias("_id"), F.struct(key, *unchanged).alias("b"))
    a = after.select(F.col(line_id).alias("_id"), F.struct(key, *unchanged, "_nulls").alias("a"))
    lines = b.join(a, "_id", "full_outer").agg(
        F.count("b").alias("rows_before"), F.count("a").alias("rows_after"),
        F.coalesce(F.sum("a._nulls"), F.lit(0)).alias("nulls"),
        F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("unmatched_lines"),
        *[F.count_if(~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))).alias(f"diff_{c}") for c in (key, *unchanged)])
    side = before.select(F.col(key).alias("k"), F.lit(True).alias("_b"), F.lit(False).alias("_a"),
                         F.lit(None).cast(after.schema[attr].dataType).alias("v")) \
        .unionByName(after.select(F.col(key).alias("k"), F.lit(False).alias("_b"), F.lit(True).alias("_a"),
                                  F.col(attr).alias("v")))
    keys = (side.where("k IS NOT NULL").groupBy("k")
            .agg(F.bool_or("_b").alias("_b"), F.bool_or("_a").alias("_a"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .agg(F.count_if(~F.col("_a")).alias("only_before"), F.count_if(~F.col("_b")).alias("only_after"),
                 F.count_if(F.col("lo") < F.col("hi")).alias(f"multi_{attr}")))
    return lines.crossJoin(keys)


def verdicts(counts: DataFrame, checks: Sequence[tuple[str, str]]) -> DataFrame:
    """V08 from one row: ``(name, boolean SQL expression)`` -> rows (check, passed, status) and 'ALL'."""
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.expr(c).alias("passed")) for n, c in checks])
    both = F.concat(rows, F.array(F.struct(F.lit("ALL").alias("check"),
                                           F.forall(rows, lambda r: r["passed"]).alias("passed"))))
    return (counts.select(F.explode(both).alias("r")).select("r.*")
            .withColumn("status", F.when(F.col("passed"), F.lit("PASS")).otherwise(F.lit("FAIL"))))
