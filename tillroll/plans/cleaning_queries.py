"""S02-S03, C01-C12 and V01-V08 over the raw extracts and event lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import unit_hash
from ..functions.numeric import r6
from ..operators import adapt as D
from ..operators import checks as V
from ..operators import clean as C
from ..session import materialize
from ..sources import retail
from . import sqltext as S
from .registry import query

FORMATS = [retail.ISO_FORMAT, retail.DMY_FORMAT]

_LINE_ID = ("concat_ws(':', l.l_orderkey, l.l_linenumber, substr(md5(concat_ws('|', l.l_orderkey, l.l_linenumber, "
            "l.l_partkey, l.l_suppkey, CAST(l.l_quantity AS INTEGER), CAST(round(l.l_extendedprice * 100) AS BIGINT), "
            "CAST(round(l.l_discount * 100) AS BIGINT), CAST(round(l.l_tax * 100) AS BIGINT), l.l_returnflag, "
            "l.l_linestatus, strftime(l.l_shipdate, '%Y-%m-%d'))), 1, 12))")

RAW = f"""
raw0 AS (
  SELECT {_LINE_ID} AS line_id, l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_returnflag,
         CAST(l.l_quantity AS BIGINT) AS q,
         (2 * CAST(round(l.l_extendedprice * 100) AS BIGINT) + CAST(l.l_quantity AS BIGINT))
            // (2 * CAST(l.l_quantity AS BIGINT)) AS pc,
         o.o_custkey, o.o_orderdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
raw1 AS (
  SELECT line_id, CAST(l_orderkey AS VARCHAR) AS invoice, CAST(l_partkey AS VARCHAR) AS stock_code,
         CASE WHEN l_returnflag = 'R' THEN -q ELSE q END AS quantity,
         CASE WHEN ((('0x' || substr(md5(line_id), 1, 8))::BIGINT) / 4294967296.0) < 0.02 THEN 'not a date'
              WHEN l_linenumber % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(o_orderdate, '%-d/%-m/%Y %-H:%M') END AS invoice_date,
         CASE WHEN ((('0x' || substr(md5(line_id), 9, 8))::BIGINT) / 4294967296.0) < 0.02 THEN 0.0 ELSE CAST(pc AS DOUBLE) / 100 END AS price,
         CASE WHEN ((('0x' || substr(md5(line_id), 17, 8))::BIGINT) / 4294967296.0) < 0.03 THEN NULL
              ELSE CAST(o_custkey AS VARCHAR) || '.0' END AS customer_id,
         o_orderdate AS _ts, ((('0x' || substr(md5(line_id), 25, 8))::BIGINT) / 4294967296.0) < 0.04 AS _overlap
  FROM raw0),
raw AS (
  SELECT line_id, invoice, stock_code, quantity, invoice_date, price, customer_id, 'extract_a' AS _source
  FROM raw1 WHERE _overlap OR _ts < TIMESTAMP '1998-01-01'
  UNION ALL
  SELECT line_id, invoice, stock_code, quantity, invoice_date, price, customer_id, 'extract_b' AS _source
  FROM raw1 WHERE _overlap OR _ts >= TIMESTAMP '1998-01-01'),
nn AS (SELECT * FROM raw WHERE customer_id IS NOT NULL),
dd AS (SELECT DISTINCT line_id, invoice, stock_code, quantity, invoice_date, price, customer_id FROM nn),
parsed AS (
  SELECT dd.*, regexp_replace(customer_id, '\\.0$', '') AS key,
         coalesce(try_strptime(invoice_date, '%Y-%m-%d %H:%M:%S'), try_strptime(invoice_date, '%d/%m/%Y %H:%M'))
           AS invoice_ts
  FROM dd),
pos AS (
  SELECT line_id, invoice, stock_code, quantity, invoice_ts, price, key AS customer_id,
         CAST(quantity AS BIGINT) * CAST(round(price * 100) AS BIGINT) AS amount_cents
  FROM parsed WHERE invoice_ts IS NOT NULL AND quantity > 0 AND price > 0),
fence AS (
  SELECT quantile_cont(CAST(amount_cents AS DOUBLE) / 100, 0.25) AS q1,
         quantile_cont(CAST(amount_cents AS DOUBLE) / 100, 0.75) AS q3 FROM pos),
clean AS (
  SELECT p.* FROM pos p CROSS JOIN fence f
  WHERE CAST(amount_cents AS DOUBLE) / 100 BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))"""

EVENTS = """
ev AS (SELECT event_id, user_id, ts, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM events)"""


def raw(t):
    return retail.raw_extracts(t)


def clean(t):
    return C.clean_lines(raw(t), FORMATS)


@query("s02_extract_union", f"WITH {RAW} SELECT _source, count(*) AS rows FROM raw GROUP BY _source")
def s02_extract_union(t):
    """Bag union of the two extracts, rows per source."""
    return raw(t).groupBy("_source").agg(F.count(F.lit(1)).alias("rows"))


@query("s03_lenient_timestamps", f"""
WITH {RAW}
SELECT count(*) FILTER (WHERE try_strptime(invoice_date, '%Y-%m-%d %H:%M:%S') IS NOT NULL) AS iso,
       count(*) FILTER (WHERE try_strptime(invoice_date, '%Y-%m-%d %H:%M:%S') IS NULL
                          AND try_strptime(invoice_date, '%d/%m/%Y %H:%M') IS NOT NULL) AS dmy,
       count(*) FILTER (WHERE invoice_ts IS NULL) AS failed,
       strftime(min(invoice_ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(invoice_ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM (SELECT invoice_date, coalesce(try_strptime(invoice_date, '%Y-%m-%d %H:%M:%S'),
                                    try_strptime(invoice_date, '%d/%m/%Y %H:%M')) AS invoice_ts FROM raw)""")
def s03_lenient_timestamps(t):
    """Per-format parse outcome of the date text (bad text -> NULL)."""
    r = raw(t)
    iso = C.parse_ts("invoice_date", [retail.ISO_FORMAT])
    dmy = C.parse_ts("invoice_date", [retail.DMY_FORMAT])
    ts = C.parse_ts("invoice_date", FORMATS)
    return r.agg(F.count_if(iso.isNotNull()).alias("iso"), F.count_if(iso.isNull() & dmy.isNotNull()).alias("dmy"),
                 F.count_if(ts.isNull()).alias("failed"),
                 F.date_format(F.min(ts), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
                 F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss").alias("last_ts"))


@query("c01_drop_null_keys", f"""
WITH {RAW}
SELECT count(*) FILTER (WHERE customer_id IS NULL) AS removed, count(customer_id) AS rows_after FROM raw""")
def c01_drop_null_keys(t):
    r = raw(t)
    kept = C.drop_null_keys(r).agg(F.count(F.lit(1)).alias("rows_after"))
    rem = r.agg(F.count_if(F.col("customer_id").isNull()).alias("removed"))
    return rem.crossJoin(kept)


@query("c02_dedupe", f"""
WITH {RAW}
SELECT (SELECT count(*) FROM nn) - count(*) AS removed, count(*) AS rows_after FROM dd""")
def c02_dedupe(t):
    d = C.dedupe(C.drop_null_keys(raw(t)), copies="_copies")  # the extracts are made and read once
    return d.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("removed"), F.count(F.lit(1)).alias("rows_after"))


@query("c03_key_normalisation", f"""
WITH {RAW} SELECT DISTINCT customer_id AS raw_key, regexp_replace(customer_id, '\\.0$', '') AS customer_id FROM nn""")
def c03_key_normalisation(t):
    return (C.drop_null_keys(raw(t)).select(F.col("customer_id").alias("raw_key"),
                                            C.normalise_key("customer_id").alias("customer_id")).distinct())


@query("c04_parse_dates", f"""
WITH {RAW}
SELECT count(*) FILTER (WHERE invoice_ts IS NULL) AS removed, count(invoice_ts) AS rows_after FROM parsed""")
def c04_parse_dates(t):
    d = C.dedupe(C.drop_null_keys(raw(t))).withColumn("ts", C.parse_ts("invoice_date", FORMATS))
    return d.agg(F.count_if(F.col("ts").isNull()).alias("removed"), F.count("ts").alias("rows_after"))


@query("c05_positive_filter", f"""
WITH {RAW}
SELECT count(*) FILTER (WHERE quantity <= 0) AS non_positive_quantity,
       count(*) FILTER (WHERE price <= 0) AS non_positive_price,
       count(*) FILTER (WHERE quantity > 0 AND price > 0) AS rows_after
FROM parsed WHERE invoice_ts IS NOT NULL""")
def c05_positive_filter(t):
    d = (C.dedupe(C.drop_null_keys(raw(t))).withColumn("ts", C.parse_ts("invoice_date", FORMATS))
         .where(F.col("ts").isNotNull()))
    kept = C.positive_only(d).agg(F.count(F.lit(1)).alias("rows_after"))
    return d.agg(F.count_if(F.col("quantity") <= 0).alias("non_positive_quantity"),
                 F.count_if(F.col("price") <= 0).alias("non_positive_price")).crossJoin(kept)


@query("c06_line_amount", f"""
WITH {RAW}
SELECT line_id, customer_id, quantity, CAST(amount_cents AS DOUBLE) / 100 AS amount FROM pos""")
def c06_line_amount(t):
    d = (C.dedupe(C.drop_null_keys(raw(t))).withColumn("customer_id", C.normalise_key("customer_id"))
         .withColumn("ts", C.parse_ts("invoice_date", FORMATS)).where(F.col("ts").isNotNull()))
    return C.with_amount(C.positive_only(d)).select("line_id", "customer_id", "quantity",
                                                    F.col("amount").cast("double").alias("amount"))


@query("c07_iqr_fence", f"""
WITH {EVENTS},
f AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM ev)
SELECT {S.r6('q1')} AS q1, {S.r6('q3')} AS q3, {S.r6('q1 - 1.5 * (q3 - q1)')} AS lower,
       {S.r6('q3 + 1.5 * (q3 - q1)')} AS upper,
       count(*) FILTER (WHERE amount BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS kept,
       count(*) FILTER (WHERE NOT (amount BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS removed
FROM ev CROSS JOIN f GROUP BY q1, q3""")
def c07_iqr_fence(t):
    """IQR fence (1.5, inclusive) on the right-skewed event values."""
    ev = retail.event_lines(t)
    f = C.iqr_fences(ev, "amount")
    kept = C.iqr_filter(ev, "amount").agg(F.count(F.lit(1)).alias("kept"))
    n = ev.agg(F.count(F.lit(1)).alias("_n"))
    return f.crossJoin(kept).crossJoin(n).select(
        r6("q1").alias("q1"), r6("q3").alias("q3"), r6("lower").alias("lower"), r6("upper").alias("upper"),
        "kept", (F.col("_n") - F.col("kept")).alias("removed"))


@query("c08_cleaning_funnel", f"""
WITH {RAW},
stages AS (
  SELECT 0 AS step, 'raw' AS stage, (SELECT count(*) FROM raw) AS rows_after UNION ALL
  SELECT 1, 'null_keys', (SELECT count(*) FROM nn) UNION ALL
  SELECT 2, 'dedupe', (SELECT count(*) FROM dd) UNION ALL
  SELECT 3, 'dates', (SELECT count(*) FROM parsed WHERE invoice_ts IS NOT NULL) UNION ALL
  SELECT 4, 'positive', (SELECT count(*) FROM pos) UNION ALL
  SELECT 5, 'iqr', (SELECT count(*) FROM clean))
SELECT step, stage, rows_after, coalesce(lag(rows_after) OVER (ORDER BY step) - rows_after, 0) AS removed
FROM stages""")
def c08_cleaning_funnel(t):
    """Rows left / removed per cleaning stage, in the documented order."""
    return C.cleaning_funnel(raw(t), FORMATS)


@query("c09_null_counts", f"""
WITH {RAW}
SELECT * FROM (
  SELECT 'line_id' AS "column", count(*) FILTER (WHERE line_id IS NULL) AS nulls FROM raw UNION ALL
  SELECT 'invoice', count(*) FILTER (WHERE invoice IS NULL) FROM raw UNION ALL
  SELECT 'stock_code', count(*) FILTER (WHERE stock_code IS NULL) FROM raw UNION ALL
  SELECT 'quantity', count(*) FILTER (WHERE quantity IS NULL) FROM raw UNION ALL
  SELECT 'invoice_date', count(*) FILTER (WHERE invoice_date IS NULL) FROM raw UNION ALL
  SELECT 'price', count(*) FILTER (WHERE price IS NULL) FROM raw UNION ALL
  SELECT 'customer_id', count(*) FILTER (WHERE customer_id IS NULL) FROM raw UNION ALL
  SELECT '_source', count(*) FILTER (WHERE _source IS NULL) FROM raw UNION ALL
  SELECT '__total__', count(*) FILTER (WHERE customer_id IS NULL) FROM raw)""")
def c09_null_counts(t):
    return C.null_counts(raw(t))


@query("c10_describe_numeric", f"""
WITH {EVENTS}
SELECT 'amount' AS "column", count(amount) AS count, {S.r6('avg(amount)')} AS mean,
       {S.r6('stddev_samp(amount)')} AS std, {S.r6('min(amount)')} AS min, {S.r6('max(amount)')} AS max,
       {S.r6('quantile_cont(amount, 0.25)')} AS p25, {S.r6('quantile_cont(amount, 0.5)')} AS p50,
       {S.r6('quantile_cont(amount, 0.75)')} AS p75
FROM ev""")
def c10_describe_numeric(t):
    d = C.describe_numeric(retail.event_lines(t), ["amount"])
    return d.select("column", "count", *[r6(c).alias(c) for c in ["mean", "std", "min", "max", "p25", "p50", "p75"]])


@query("c10_describe_text", """
WITH f AS (SELECT event_type AS v, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1)
SELECT 'event_type' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS unique,
       min(v) FILTER (WHERE n = (SELECT max(n) FROM f)) AS top, max(n) AS freq FROM f""")
def c10_describe_text(t):
    return C.describe_text(t.events, ["event_type"])


@query("c11_histogram", f"""
WITH {EVENTS},
r AS (SELECT min(amount) AS lo, max(amount) AS hi FROM ev),
c AS (SELECT CAST(least(floor((amount - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin, count(*) AS n
      FROM ev CROSS JOIN r GROUP BY 1)
SELECT 'all' AS grp, b.bin, {S.r6('lo + b.bin * ((hi - lo) / 30)')} AS left_edge,
       {S.r6('lo + (b.bin + 1) * ((hi - lo) / 30)')} AS right_edge, coalesce(c.n, 0) AS count
FROM (SELECT unnest(range(0, 30)) AS bin) b CROSS JOIN r LEFT JOIN c ON b.bin = c.bin""")
def c11_histogram(t):
    """30 equal-width bins of event value."""
    h = C.histogram(retail.event_lines(t), "amount", bins=30)
    return h.select("grp", "bin", r6("left_edge").alias("left_edge"), r6("right_edge").alias("right_edge"), "count")


@query("c11_histogram_by_group", f"""
WITH {EVENTS},
x AS (SELECT event_type AS grp, ln(1 + amount) AS v FROM ev),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
c AS (SELECT grp, CAST(least(floor((v - lo) * 25 / (hi - lo)), 24) AS INTEGER) AS bin, count(*) AS n
      FROM x CROSS JOIN r GROUP BY 1, 2)
SELECT g.grp, b.bin, {S.r6('lo + b.bin * ((hi - lo) / 25)')} AS left_edge,
       {S.r6('lo + (b.bin + 1) * ((hi - lo) / 25)')} AS right_edge, coalesce(c.n, 0) AS count
FROM (SELECT DISTINCT grp FROM x) g CROSS JOIN (SELECT unnest(range(0, 25)) AS bin) b CROSS JOIN r
LEFT JOIN c ON c.grp = g.grp AND c.bin = b.bin""")
def c11_histogram_by_group(t):
    """25 bins of log1p(value) per event type, shared edges."""
    h = C.histogram(retail.event_lines(t), "amount", bins=25, by="event_type", log1p=True)
    return h.select("grp", "bin", r6("left_edge").alias("left_edge"), r6("right_edge").alias("right_edge"), "count")


@query("c12_skewness", f"""
WITH {EVENTS},
m AS (SELECT avg(amount) AS mu FROM ev)
SELECT 'amount' AS "column",
       {S.r6('avg(power(amount - mu, 3)) / power(avg(power(amount - mu, 2)), 1.5)')} AS skewness
FROM ev CROSS JOIN m""")
def c12_skewness(t):
    """Population skewness g1 of event value."""
    s = C.skewness(retail.event_lines(t), ["amount"])
    return s.select("column", r6("skewness").alias("skewness"))


# --- V01-V08: cleaned lines vs their adapted copy ---------------------------

def adapted(t):
    c = clean(t)
    a = D.assign_by_key(c)
    a = D.convert_prices(a)
    a = D.charm_prices(a)
    return c, a


ADAPTED = RAW + f""",
adapted AS (
  SELECT c.*, CASE {' '.join(f"WHEN {S.unit_hash('customer_id', 'geo42')} < {float(ub)} THEN '{name}'"
                             for name, ub in D.cumulative_bounds(D.STATE_WEIGHTS)[:-1])}
              ELSE 'Labuan' END AS state,
         (CAST(round(price * 100) AS BIGINT) * 55 + 5) // 10 AS fx_cents
  FROM clean c),
charm AS (
  SELECT *, fx_cents // 100 AS base, fx_cents % 100 AS frac FROM adapted),
final AS (
  SELECT *, CASE WHEN frac <= 25 THEN base * 100 WHEN frac <= 70 THEN base * 100 + 50
                 WHEN frac <= 95 THEN base * 100 + 90 ELSE base * 100 + 100 END AS new_price_cents
  FROM charm)"""


@query("v01_row_counts", f"""
WITH {ADAPTED}
SELECT (SELECT count(*) FROM clean) AS rows_before, count(*) AS rows_after,
       (SELECT count(*) FROM clean) = count(*) AS same_rows FROM final""")
def v01_row_counts(t):
    c, a = adapted(t)
    return V.row_counts(c, a)


@query("v02_total_nulls", f"""
WITH {ADAPTED}
SELECT count(*) FILTER (WHERE state IS NULL) + count(*) FILTER (WHERE customer_id IS NULL)
     + count(*) FILTER (WHERE invoice_ts IS NULL) + count(*) FILTER (WHERE quantity IS NULL)
     + count(*) FILTER (WHERE new_price_cents IS NULL) + count(*) FILTER (WHERE quantity * new_price_cents IS NULL) AS nulls
FROM final""")
def v02_total_nulls(t):
    _, a = adapted(t)
    return V.total_nulls(a, ["state", "customer_id", "invoice_ts", "quantity", "price", "amount"])


@query("v03_key_set_equality", f"""
WITH {ADAPTED},
b AS (SELECT DISTINCT customer_id AS k FROM clean), a AS (SELECT DISTINCT customer_id AS k FROM final)
SELECT count(*) FILTER (WHERE a.k IS NULL) AS only_before, count(*) FILTER (WHERE b.k IS NULL) AS only_after,
       count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS common,
       count(*) FILTER (WHERE a.k IS NULL OR b.k IS NULL) = 0 AS identical
FROM b FULL OUTER JOIN a ON a.k = b.k""")
def v03_key_set_equality(t):
    c, a = adapted(t)
    return V.key_set_equality(c, a)


@query("v04_row_sequence", f"""
WITH {ADAPTED}
SELECT count(*) FILTER (WHERE b.line_id IS NULL OR a.line_id IS NULL) AS unmatched_lines,
       count(*) FILTER (WHERE b.customer_id IS DISTINCT FROM a.customer_id) AS diff_customer_id
FROM clean b FULL OUTER JOIN final a ON a.line_id = b.line_id""")
def v04_row_sequence(t):
    """Same key on the same line (joined by line id)."""
    c, a = adapted(t)
    return V.compare_columns(c, a, "line_id", [("customer_id", "customer_id")])


@query("v05_skew_drift", f"""
WITH {ADAPTED},
x AS (SELECT CAST(b.quantity AS DOUBLE) AS bq, CAST(a.quantity AS DOUBLE) AS aq,
             b.price AS bp, CAST(a.new_price_cents AS DOUBLE) / 100 AS ap,
             CAST(b.amount_cents AS DOUBLE) / 100 AS bm, CAST(a.quantity * a.new_price_cents AS DOUBLE) / 100 AS am
      FROM clean b JOIN final a USING (line_id)),
m AS (SELECT avg(bq) mbq, avg(aq) maq, avg(bp) mbp, avg(ap) map, avg(bm) mbm, avg(am) mam FROM x),
s AS (SELECT avg(power(bq - mbq, 3)) / power(avg(power(bq - mbq, 2)), 1.5) AS sbq,
             avg(power(aq - maq, 3)) / power(avg(power(aq - maq, 2)), 1.5) AS saq,
             avg(power(bp - mbp, 3)) / power(avg(power(bp - mbp, 2)), 1.5) AS sbp,
             avg(power(ap - map, 3)) / power(avg(power(ap - map, 2)), 1.5) AS sap,
             avg(power(bm - mbm, 3)) / power(avg(power(bm - mbm, 2)), 1.5) AS sbm,
             avg(power(am - mam, 3)) / power(avg(power(am - mam, 2)), 1.5) AS sam FROM x CROSS JOIN m)
SELECT 'quantity' AS "column", {S.r6('sbq')} AS skew_before, {S.r6('saq')} AS skew_after,
       {S.r6('abs(saq - sbq) / abs(sbq) * 100')} AS drift_pct FROM s UNION ALL
SELECT 'price', {S.r6('sbp')}, {S.r6('sap')}, {S.r6('abs(sap - sbp) / abs(sbp) * 100')} FROM s UNION ALL
SELECT 'amount', {S.r6('sbm')}, {S.r6('sam')}, {S.r6('abs(sam - sbm) / abs(sbm) * 100')} FROM s""")
def v05_skew_drift(t):
    c, a = adapted(t)
    d = V.skew_drift(c, a, [("quantity", "quantity"), ("price", "price"), ("amount", "amount")])
    return d.select("column", *[r6(x).alias(x) for x in ["skew_before", "skew_after", "drift_pct"]])


@query("v06_column_unchanged", f"""
WITH {ADAPTED}
SELECT count(*) FILTER (WHERE b.line_id IS NULL OR a.line_id IS NULL) AS unmatched_lines,
       count(*) FILTER (WHERE b.quantity IS DISTINCT FROM a.quantity) AS diff_quantity,
       count(*) FILTER (WHERE strftime(b.invoice_ts, '%Y-%m-%d %H:%M:%S')
                        IS DISTINCT FROM strftime(a.invoice_ts, '%Y-%m-%d %H:%M:%S')) AS diff_invoice_ts
FROM clean b FULL OUTER JOIN final a ON a.line_id = b.line_id""")
def v06_column_unchanged(t):
    c, a = adapted(t)
    return V.compare_columns(c, a, "line_id", [("quantity", "quantity"), ("invoice_ts", "invoice_ts")],
                             as_string=["invoice_ts"])


@query("v07_amount_consistency", f"""
WITH {ADAPTED}
SELECT count(*) AS lines,
       count(*) FILTER (WHERE abs(CAST(quantity * new_price_cents AS DOUBLE) / 100
                                  - CAST(quantity * new_price_cents AS DOUBLE) / 100) > 0.01) AS inconsistent
FROM final""")
def v07_amount_consistency(t):
    _, a = adapted(t)
    return V.amount_consistency(a)


def damage(a):
    """The adapted copy with planted defects, each on about 0.2 % of the lines by hash: lost lines,
    changed keys, no state, a second state, and a quantity that no longer fits the amount."""
    def hit(tag):
        return unit_hash("line_id", seed=tag) < 0.002
    return (a.where(~hit("lost"))
            .withColumn("customer_id", F.when(hit("key"), F.concat(F.lit("X"), "customer_id"))
                        .otherwise(F.col("customer_id")))
            .withColumn("state", F.when(hit("gap"), F.lit(None)).when(hit("geo"), F.lit("Elsewhere"))
                        .otherwise(F.col("state")))
            .withColumn("quantity", F.when(hit("qty"), F.col("quantity") + 1).otherwise(F.col("quantity"))))


def _hit(tag):
    return f"{S.unit_hash('line_id', tag)} < 0.002"


DAMAGED = ADAPTED + f""",
dmg AS (
  SELECT line_id, invoice_ts, new_price_cents, quantity * new_price_cents AS amount_cents,
         CASE WHEN {_hit('key')} THEN 'X' || customer_id ELSE customer_id END AS customer_id,
         CASE WHEN {_hit('gap')} THEN NULL WHEN {_hit('geo')} THEN 'Elsewhere' ELSE state END AS state,
         CASE WHEN {_hit('qty')} THEN quantity + 1 ELSE quantity END AS quantity
  FROM final WHERE NOT ({_hit('lost')}))"""


def _counts_sql(after):
    """V01-V04 and V06 between ``clean`` and the table ``after``, check by check."""
    return f"""
counts AS (
  SELECT (SELECT count(*) FROM clean) AS rows_before, (SELECT count(*) FROM {after}) AS rows_after,
         (SELECT CAST(coalesce(sum(CAST(state IS NULL AS INT) + CAST(customer_id IS NULL AS INT)
                          + CAST(invoice_ts IS NULL AS INT) + CAST(quantity IS NULL AS INT)), 0) AS BIGINT)
          FROM {after}) AS nulls,
         (SELECT count(*) FROM clean b FULL OUTER JOIN {after} a USING (line_id)
          WHERE b.quantity IS NULL OR a.quantity IS NULL) AS unmatched_lines,
         (SELECT count(*) FROM clean b FULL OUTER JOIN {after} a USING (line_id)
          WHERE b.customer_id IS DISTINCT FROM a.customer_id) AS diff_customer_id,
         (SELECT count(*) FROM clean b FULL OUTER JOIN {after} a USING (line_id)
          WHERE b.quantity IS DISTINCT FROM a.quantity) AS diff_quantity,
         (SELECT count(*) FROM (SELECT customer_id FROM clean EXCEPT SELECT customer_id FROM {after})) AS only_before,
         (SELECT count(*) FROM (SELECT customer_id FROM {after} EXCEPT SELECT customer_id FROM clean)) AS only_after,
         (SELECT count(*) FROM (SELECT customer_id FROM {after} GROUP BY 1 HAVING count(DISTINCT state) > 1))
           AS multi_state)"""


CHECKS = [("rows", "rows_before = rows_after"), ("nulls", "nulls = 0"), ("keys", "only_before = 0 AND only_after = 0"),
          ("one_state_per_key", "multi_state = 0"), ("row_sequence", "unmatched_lines = 0 AND diff_customer_id = 0"),
          ("quantity_unchanged", "unmatched_lines = 0 AND diff_quantity = 0")]
_CHECKS_SQL = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", {c} AS passed FROM counts" for n, c in CHECKS)
_REPORT_SQL = f""", checks AS ({_CHECKS_SQL}),
rep AS (SELECT * FROM checks UNION ALL SELECT 'ALL', bool_and(passed) FROM checks)
SELECT "check", passed, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status FROM rep"""


def _copy_counts(before, after):
    return V.copy_counts(before, after, ["state", "customer_id", "invoice_ts", "quantity"], ["quantity"], "state")


@query("v08_check_report", f"WITH {ADAPTED}, {_counts_sql('final')} {_REPORT_SQL}")
def v08_check_report(t):
    """Six named PASS/FAIL checks of the adapted copy and the overall verdict."""
    return V.verdicts(_copy_counts(*adapted(t)), CHECKS)


@query("v08_check_report_damaged", f"WITH {DAMAGED}, {_counts_sql('dmg')} {_REPORT_SQL}")
def v08_check_report_damaged(t):
    """The same checks of a copy with planted defects."""
    c, a = adapted(t)
    return V.verdicts(_copy_counts(c, damage(a)), CHECKS)


@query("v08_damaged_counts", f"WITH {DAMAGED}, {_counts_sql('dmg')} SELECT * FROM counts")
def v08_damaged_counts(t):
    """What the checks of the copy with planted defects count."""
    c, a = adapted(t)
    return _copy_counts(c, damage(a))


@query("v07_amount_consistency_damaged", f"""
WITH {DAMAGED}
SELECT count(*) AS lines,
       count(*) FILTER (WHERE abs(amount_cents - quantity * new_price_cents) / 100.0
                              > 0.01 + 0.00001 * amount_cents / 100.0) AS inconsistent
FROM dmg""")
def v07_amount_consistency_damaged(t):
    """Lines of the copy with planted defects whose amount is not quantity x price."""
    return V.amount_consistency(damage(adapted(t)[1]))


@query("v03_v04_damaged", f"""
WITH {DAMAGED},
b AS (SELECT DISTINCT customer_id AS k FROM clean), a AS (SELECT DISTINCT customer_id AS k FROM dmg),
ks AS (SELECT count(*) FILTER (WHERE a.k IS NULL) AS only_before, count(*) FILTER (WHERE b.k IS NULL) AS only_after,
              count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS common
       FROM b FULL OUTER JOIN a ON a.k = b.k),
ln AS (SELECT count(*) FILTER (WHERE b.line_id IS NULL OR a.line_id IS NULL) AS unmatched_lines,
              count(*) FILTER (WHERE b.customer_id IS DISTINCT FROM a.customer_id) AS diff_customer_id
       FROM clean b FULL OUTER JOIN dmg a ON a.line_id = b.line_id)
SELECT *, only_before = 0 AND only_after = 0 AS identical FROM ks CROSS JOIN ln""")
def v03_v04_damaged(t):
    """Key sets and line-by-line keys of the copy with planted defects."""
    c, a = adapted(t)
    d = materialize(damage(a).select("line_id", "customer_id"))  # read by both checks
    return V.key_set_equality(c, d).crossJoin(V.compare_columns(c, d, "line_id", [("customer_id", "customer_id")]))


@query("d05_key_consistency_damaged", f"""
WITH {DAMAGED}
SELECT customer_id, count(DISTINCT state) AS n_values FROM dmg WHERE customer_id IS NOT NULL
GROUP BY customer_id HAVING count(DISTINCT state) > 1""")
def d05_key_consistency_damaged(t):
    """Customers with more than one state in the copy with planted defects."""
    return D.inconsistent_keys(damage(adapted(t)[1]), "customer_id", "state")
