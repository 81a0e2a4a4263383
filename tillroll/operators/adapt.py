"""Key-level enrichment and rule-based rewriting.

Assignments that must be stable per key are pure functions of a hash of the
key, evaluated row-locally: every line of a customer gets the same category
without building, shuffling or joining a key -> category map.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash
from ..functions.money import AMOUNT_TYPE, charm_price, convert_currency, line_amount
from ..functions.rules import RuleSet, apply_ruleset

# ---------------------------------------------------------------------------
# Region weights (16 categories, sum 1), the flat exchange
# rate, and the display-name pools of the source project.
# ---------------------------------------------------------------------------
STATE_WEIGHTS = [
    ("Selangor", "0.34"), ("Kuala Lumpur", "0.20"), ("Johor", "0.11"), ("Penang", "0.09"),
    ("Perak", "0.05"), ("Sabah", "0.04"), ("Sarawak", "0.04"), ("Negeri Sembilan", "0.03"),
    ("Melaka", "0.03"), ("Kedah", "0.02"), ("Pahang", "0.02"), ("Kelantan", "0.01"),
    ("Terengganu", "0.01"), ("Perlis", "0.005"), ("Putrajaya", "0.003"), ("Labuan", "0.002"),
]
GBP_TO_MYR = 5.50
FIRST_NAMES = ["Ahmad", "Siti", "Wei Ling", "Kumar", "Nurul", "Chong",
               "Farah", "Ravi", "Aisyah", "Tan", "Priya", "Hafiz"]
LAST_NAMES = ["bin Ismail", "binti Rahman", "Lee", "a/l Muthu",
              "Wong", "binti Hassan", "Kaur", "Lim", "Osman", "Teh"]
GEO_SEED = 42


def cumulative_bounds(weights: list[tuple[str, str]]) -> list[tuple[str, Decimal]]:
    """Upper cumulative bound per category, in exact decimal; weights must sum to 1."""
    total = sum(Decimal(w) for _, w in weights)
    if total != Decimal(1):
        raise ValueError(f"weights sum to {total}, not 1")
    out, acc = [], Decimal(0)
    for name, w in weights:
        acc += Decimal(w)
        out.append((name, acc))
    return out


def weighted_choice(u: Column, weights: list[tuple[str, str]] = STATE_WEIGHTS) -> Column:
    """Category whose cumulative-weight interval contains u in [0, 1)."""
    bounds = cumulative_bounds(weights)
    expr = None
    for name, ub in bounds[:-1]:
        cond = u < F.lit(float(ub))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(bounds[-1][0]))


def assign_by_key(df: DataFrame, key: str = "customer_id", row_id: str = "line_id",
                  out: str = "state", weights=STATE_WEIGHTS, seed: int = GEO_SEED) -> DataFrame:
    """D01 + D02: one weighted draw per key, the same on every row of the key;
    rows without a key get their own draw from the row id."""
    u_key = unit_hash(F.col(key), seed=f"geo{seed}")
    u_row = unit_hash(F.col(row_id), seed=f"georow{seed}")
    u = F.when(F.col(key).isNotNull(), u_key).otherwise(u_row)
    return df.withColumn(out, weighted_choice(u, weights))


def override_constant(df: DataFrame, col: str = "country", value: str = "Malaysia") -> DataFrame:
    """D03."""
    return df.withColumn(col, F.lit(value))


def category_share(df: DataFrame, col: str) -> DataFrame:
    """Count and percentage per category (normalised value counts)."""
    g = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    tot = g.agg(F.sum("count").alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select(col, "count", (F.col("count") * 100.0 / F.col("_t")).alias("pct"))


def inconsistent_keys(df: DataFrame, key: str, attr: str) -> DataFrame:
    """Keys mapped to more than one distinct attribute value."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.countDistinct(attr).alias("n_values")).where(F.col("n_values") > 1))


def convert_prices(df: DataFrame, rate: float = GBP_TO_MYR, price: str = "price",
                   qty: str = "quantity", amount: str = "amount") -> DataFrame:
    """Price in the new currency (2 dp), original kept as ``price_orig``,
    amount recomputed."""
    return (df.withColumn("price_orig", F.col(price))
              .withColumn(price, convert_currency(F.col(price), rate))
              .withColumn(amount, line_amount(F.col(qty), F.col(price))))


def rewrite_text(df: DataFrame, ruleset: RuleSet, col: str = "description",
                 keep: str | None = "description_original") -> DataFrame:
    """Ordered rule fold; original kept when ``keep`` is given."""
    if keep:
        df = df.withColumn(keep, F.col(col))
    return df.withColumn(col, apply_ruleset(F.col(col), ruleset))


def rewrite_report(before: Column, after: Column, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one-row summary: rows, changed, pct; distinct before -> after mapping)."""
    x = df.select(before.alias("before"), after.alias("after"))
    changed = ~x["before"].eqNullSafe(x["after"])
    summary = x.agg(F.count(F.lit(1)).alias("rows"), F.count_if(changed).alias("changed")) \
               .withColumn("changed_pct", F.col("changed") * 100.0 / F.col("rows"))
    mapping = x.where(changed).groupBy("before", "after").agg(F.count(F.lit(1)).alias("rows"))
    return summary, mapping


def charm_prices(df: DataFrame, price: str = "price", qty: str = "quantity",
                 amount: str = "amount") -> DataFrame:
    """Snapped price, raw kept as ``price_raw``, amount recomputed."""
    return (df.withColumn("price_raw", F.col(price))
              .withColumn(price, charm_price(F.col(price)))
              .withColumn(amount, line_amount(F.col(qty), F.col(price)).cast(AMOUNT_TYPE)))


def price_endings(df: DataFrame, price: str = "price", top: int = 6) -> DataFrame:
    """Most frequent price endings (price mod 1), top ``top`` (ties by ending)."""
    return (df.where(F.col(price).isNotNull())
            .groupBy((F.col(price) % 1).cast("decimal(3,2)").alias("ending"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "ending").limit(top))


def display_name(key: Column, seed: int = GEO_SEED) -> Column:
    """Deterministic '<first> <last>' per key from the two fixed pools."""
    first = F.array(*[F.lit(n) for n in FIRST_NAMES])
    last = F.array(*[F.lit(n) for n in LAST_NAMES])
    hf = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(f"first{seed}"))), 1, 8), 16, 10)
    hl = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(f"last{seed}"))), 1, 8), 16, 10)
    i = (hf.cast("bigint") % len(FIRST_NAMES)) + 1
    j = (hl.cast("bigint") % len(LAST_NAMES)) + 1
    return F.when(key.isNull(), F.lit(None)).otherwise(
        F.concat(F.element_at(first, i.cast("int")), F.lit(" "), F.element_at(last, j.cast("int"))))
