"""DuckDB building blocks for oracle SQL (never executed by Spark).

They restate the column mapping of ``sources.retail`` in plain SQL: integer
cents, half-up unit price, invoice roll-up, customer state.
"""

LINES = """
lp AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_returnflag, CAST(l.l_quantity AS BIGINT) AS q,
         (2 * CAST(round(l.l_extendedprice * 100) AS BIGINT) + CAST(l.l_quantity AS BIGINT))
           // (2 * CAST(l.l_quantity AS BIGINT)) AS pc
  FROM lineitem l),
lines AS (
  SELECT o.o_orderkey AS invoice, lp.l_partkey AS stock_code, lp.q AS quantity,
         o.o_orderdate AS invoice_ts, lp.pc AS price_cents, lp.pc * lp.q AS amount_cents,
         o.o_custkey AS customer_id, lp.l_linenumber, lp.l_returnflag
  FROM lp JOIN orders o ON lp.l_orderkey = o.o_orderkey)"""

INVOICES = LINES + """,
inv AS (
  SELECT customer_id, invoice, min(invoice_ts) AS inv_ts, sum(amount_cents) AS inv_cents,
         CAST(sum(amount_cents) AS DOUBLE) / 100 AS inv_value, CAST(sum(quantity) AS BIGINT) AS inv_items,
         count(*) AS n_lines
  FROM lines GROUP BY customer_id, invoice)"""

STATES = """
states AS (
  SELECT c.c_custkey AS customer_id, n.n_name AS state
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

RFM_TAIL = STATES + """,
snap AS (SELECT max(inv_ts) + INTERVAL 1 DAY AS snapshot_ts FROM inv),
rfm AS (
  SELECT i.customer_id, date_sub('day', max(i.inv_ts), any_value(s.snapshot_ts)) AS recency,
         count(*) AS frequency, CAST(sum(i.inv_cents) AS DOUBLE) / 100 AS monetary
  FROM inv i CROSS JOIN snap s GROUP BY i.customer_id),
rfm_s AS (SELECT r.*, st.state FROM rfm r LEFT JOIN states st USING (customer_id))"""
RFM = INVOICES + "," + RFM_TAIL


def r6(expr: str) -> str:
    return f"floor(({expr}) * 1000000.0 + 0.5) / 1000000.0"


def r1(expr: str) -> str:
    return f"floor(({expr}) * 10.0 + 0.5) / 10.0"


def unit_hash(key_sql: str, seed: str) -> str:
    return (f"(('0x' || substr(md5(concat_ws('|', {key_sql}, '{seed}')), 1, 8))::BIGINT"
            f" / 4294967296.0)")
