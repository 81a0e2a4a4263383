"""Money as exact numbers.

Line amounts are summed over billions of rows; doubles would make totals
depend on partition order.  Prices and amounts are DECIMAL, derived through
integer cents so every engine agrees to the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(12,2)"
AMOUNT_TYPE = "decimal(18,2)"


def to_cents(c: Column) -> Column:
    """A double holding a 2-dp value -> exact integer cents."""
    return F.round(c * 100).cast("bigint")


def cents_to_decimal(c: Column, dtype: str = AMOUNT_TYPE) -> Column:
    return (c.cast("decimal(20,0)") / F.lit(100)).cast(dtype)


def unit_price_cents(total_cents: Column, qty: Column) -> Column:
    """round-half-up(total / qty) in cents, integer arithmetic only (qty > 0)."""
    q = qty.cast("bigint")
    return F.floor((total_cents * 2 + q) / (q * 2)).cast("bigint")


def line_amount(qty: Column, price: Column) -> Column:
    """Quantity x price as DECIMAL(18,2), rounded half-up to cents."""
    return F.round(qty.cast("decimal(12,0)") * price.cast(PRICE_TYPE), 2).cast(AMOUNT_TYPE)


def convert_currency(price: Column, rate: float) -> Column:
    """Flat-rate conversion, 2 dp half-up, in DECIMAL."""
    return F.round(price.cast(PRICE_TYPE) * F.lit(rate).cast("decimal(10,4)"), 2).cast(PRICE_TYPE)


def charm_price(price: Column) -> Column:
    """Snap to the nearest of base+.00/.50/.90 or base+1.00.

    Equal distances go to the lower candidate (fraction .25 -> .00,
    .70 -> .50, .95 -> .90).  NULL and non-positive prices pass unchanged.
    """
    p = price.cast(PRICE_TYPE)
    base = F.floor(p).cast(PRICE_TYPE)
    frac = p - base
    snapped = (F.when(frac <= F.lit(0.25), base)
               .when(frac <= F.lit(0.70), base + F.lit(0.5))
               .when(frac <= F.lit(0.95), base + F.lit(0.9))
               .otherwise(base + F.lit(1)))
    return F.when(p.isNull() | (p <= 0), p).otherwise(snapped.cast(PRICE_TYPE))


def rm(value: Column, decimals: int = 0) -> Column:
    """'RM 1,234' style label (format_number rounds half-up)."""
    return F.concat(F.lit("RM "), F.format_number(value.cast("double"), decimals))


def rm_compact(value: Column) -> Column:
    """RM x.xM / x.xK / x.xxK / x, one decimal kept in the thousands."""
    v = value.cast("double")
    a = F.abs(v)
    return (F.when(a >= 1_000_000, F.concat(F.lit("RM "), F.format_number(v / 1_000_000, 1), F.lit("M")))
            .when(a >= 10_000, F.concat(F.lit("RM "), F.format_number(v / 1_000, 1), F.lit("K")))
            .when(a >= 1_000, F.concat(F.lit("RM "), F.format_number(v / 1_000, 2), F.lit("K")))
            .otherwise(F.concat(F.lit("RM "), F.format_number(v, 0))))
