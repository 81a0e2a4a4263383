"""Column mapping from the star-schema tables onto retail transaction lines.

A retail line (one product on one invoice) maps onto the tables as:

    invoice     = o_orderkey            customer_id = o_custkey
    stock_code  = l_partkey             invoice_ts  = o_orderdate
    description = upper(p_name)         quantity    = l_quantity (whole units)
    price       = l_extendedprice / l_quantity, half-up to cents (DECIMAL)
    amount      = quantity x price (DECIMAL)
    state       = n_name of the customer's nation

Joins are added only for the columns a caller asks for, so a query that needs
no description never touches ``part``.  ``invoices`` is the invoice-level
roll-up built the cheap way: lineitem is reduced per order *before* it is
joined and shuffled, which cuts the largest shuffle by the lines-per-order
factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import TWO_POW_32
from ..functions.money import AMOUNT_TYPE, PRICE_TYPE, cents_to_decimal, to_cents, unit_price_cents
from .tables import Tables

LINE_COLUMNS = ["invoice", "stock_code", "quantity", "invoice_ts", "price", "amount", "customer_id"]


def _line_key_parts() -> list[Column]:
    return [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
            F.col("l_quantity").cast("int"), to_cents(F.col("l_extendedprice")),
            to_cents(F.col("l_discount")), to_cents(F.col("l_tax")), F.col("l_returnflag"),
            F.col("l_linestatus"), F.col("l_shipdate").cast("date")]  # its text is yyyy-MM-dd


def line_id() -> Column:
    """Stable row identity without a global sort: (order, line number, digest of the row).

    (l_orderkey, l_linenumber) alone repeats; the digest separates the copies.
    """
    digest = F.substring(F.md5(F.concat_ws("|", *[c.cast("string") for c in _line_key_parts()])), 1, 12)
    return F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), digest)


def _priced(li: DataFrame) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    pc = unit_price_cents(to_cents(F.col("l_extendedprice")), q)
    return li.withColumn("_q", q).withColumn("_price_cents", pc)


def customer_states(t: Tables) -> DataFrame:
    """customer_id -> state.  ``nation`` is a fixed 25-row dimension: broadcast."""
    return (t.customer.select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
            .join(F.broadcast(t.nation.select("n_nationkey", F.col("n_name").alias("state"))),
                  F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("customer_id", "state"))


def lines(t: Tables, description: bool = False, state: bool = False,
          with_line_id: bool = False) -> DataFrame:
    li = _priced(t.lineitem)
    if with_line_id:
        li = li.withColumn("line_id", line_id())
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    df = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    cols = [F.col("o_orderkey").alias("invoice"), F.col("l_partkey").alias("stock_code"),
            F.col("_q").alias("quantity"), F.col("o_orderdate").alias("invoice_ts"),
            cents_to_decimal(F.col("_price_cents"), PRICE_TYPE).alias("price"),
            cents_to_decimal(F.col("_price_cents") * F.col("_q"), AMOUNT_TYPE).alias("amount"),
            F.col("o_custkey").alias("customer_id")]
    if with_line_id:
        cols.insert(0, F.col("line_id"))
    if description:
        df = df.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left")
        cols.append(F.upper("p_name").alias("description"))
    out = df.select(*cols)
    if state:
        out = out.join(customer_states(t), "customer_id", "left")
    return out


def invoices(t: Tables) -> DataFrame:
    """Invoice roll-up (P10 shape): customer_id, invoice, inv_ts, inv_value, inv_items, n_lines.

    lineitem is aggregated per order first (map-side partial aggregation,
    then one shuffle of one row per order), so the join with ``orders`` is
    order-to-order on co-partitioned inputs.
    """
    li = _priced(t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice"))
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(F.col("_price_cents") * F.col("_q")).alias("_cents"),
        F.sum("_q").alias("inv_items"),
        F.count(F.lit(1)).alias("n_lines"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return (per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("invoice"),
                    F.col("o_orderdate").alias("inv_ts"),
                    cents_to_decimal(F.col("_cents"), AMOUNT_TYPE).alias("inv_value"),
                    F.col("inv_items").cast("bigint").alias("inv_items"), "n_lines"))


def event_lines(t: Tables) -> DataFrame:
    """``events`` as retail lines: right-skewed values and microsecond timestamps."""
    e = t.events
    return e.select(F.col("event_id").alias("invoice"), F.lit(None).cast("bigint").alias("stock_code"),
                    F.lit(1).alias("quantity"), F.col("ts").alias("invoice_ts"),
                    F.col("value").cast(PRICE_TYPE).alias("price"),
                    F.col("value").cast(AMOUNT_TYPE).alias("amount"),
                    F.col("user_id").alias("customer_id"), F.col("event_type"))


# ---------------------------------------------------------------------------
# Raw extracts: the same lines as two overlapping text extracts, with the
# defects the cleaning stage exists for.  Defects are keyed by hash of the
# line, so every row of the table is kept and the same rows are hit in any
# engine.
# ---------------------------------------------------------------------------
DIRTY_NULL_KEY = 0.03      # share of lines with a missing customer key
DIRTY_ZERO_PRICE = 0.02    # share of lines with price 0
DIRTY_BAD_DATE = 0.02      # share of lines whose date text does not parse
DIRTY_OVERLAP = 0.04       # share of lines present in both extracts
EXTRACT_SPLIT = "1998-01-01"

ISO_FORMAT = "yyyy-MM-dd HH:mm:ss"
DMY_FORMAT = "d/M/yyyy H:mm"


def raw_extracts(t: Tables) -> DataFrame:
    """Union of two text extracts (S02 input): all business columns are strings
    or raw numbers as a CSV reader with an explicit schema would give them."""
    li = _priced(t.lineitem).withColumn("line_id", line_id())
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    df = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    # four independent uniforms from the four 8-hex slices of one md5 per line
    digest = F.md5(F.col("line_id"))
    slot = {"date": 0, "price": 1, "key": 2, "overlap": 3}
    u = lambda tag: (F.conv(F.substring(digest, 1 + 8 * slot[tag], 8), 16, 10).cast("double")
                     / F.lit(TWO_POW_32))
    ts_text = (F.when(u("date") < DIRTY_BAD_DATE, F.lit("not a date"))
               .when(F.col("l_linenumber") % 2 == 0, F.date_format("o_orderdate", ISO_FORMAT))
               .otherwise(F.date_format("o_orderdate", DMY_FORMAT)))
    base = df.select(
        "line_id",
        F.col("o_orderkey").cast("string").alias("invoice"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.when(F.col("l_returnflag") == "R", -F.col("_q")).otherwise(F.col("_q")).alias("quantity"),
        ts_text.alias("invoice_date"),
        F.when(u("price") < DIRTY_ZERO_PRICE, F.lit(0.0))
         .otherwise(F.col("_price_cents") / F.lit(100.0)).alias("price"),
        F.when(u("key") < DIRTY_NULL_KEY, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("customer_id"),
        F.col("o_orderdate").alias("_ts"),
        (u("overlap") < DIRTY_OVERLAP).alias("_overlap"),
    )
    # one pass: a line goes to the extract of its period, overlap lines to both
    own = F.when(F.col("_ts") < F.lit(EXTRACT_SPLIT).cast("timestamp_ntz"), F.lit("extract_a")) \
           .otherwise(F.lit("extract_b"))
    sources = F.when(F.col("_overlap"), F.array(F.lit("extract_a"), F.lit("extract_b"))).otherwise(F.array(own))
    keep = ["line_id", "invoice", "stock_code", "quantity", "invoice_date", "price", "customer_id"]
    return base.select(*keep, F.explode(sources).alias("_source"))
