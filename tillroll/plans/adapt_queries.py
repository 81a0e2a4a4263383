"""D01-D12 over the cleaned lines, part names and document texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..functions.rules import CLIMATE_RULESET, PLACE_RULESET, RuleSet, RuleStage, apply_ruleset
from ..operators import adapt as D
from ..sources import retail
from . import sqltext as S
from .cleaning_queries import ADAPTED, RAW, clean, raw
from .registry import query

# Parameters (not fixed values): a rule set fitted to the part-name vocabulary,
# with an ordered overlap (HOT PLATE before HOT) and a guarded stage.
VOCAB_RULESET = RuleSet([
    RuleStage([(r"\bHOT PLATE\b", "INDUCTION PLATE"), (r"\bHOT\b", "WARM"), (r"\bCOLD\b", "CHILLED")]),
    RuleStage([(r"(?i)\bsmall\b", "MINI"), (r"(?i)\blarge\b", "JUMBO")], guard="WIDGET"),
])
VOCAB_SQL = ("CASE WHEN contains(upper(s1), 'WIDGET') THEN regexp_replace(regexp_replace(s1, '(?i)\\bsmall\\b', "
             "'MINI', 'g'), '(?i)\\blarge\\b', 'JUMBO', 'g') ELSE s1 END")
VOCAB_S1 = ("regexp_replace(regexp_replace(regexp_replace(upper(p_name), '\\bHOT PLATE\\b', 'INDUCTION PLATE', 'g'), "
            "'\\bHOT\\b', 'WARM', 'g'), '\\bCOLD\\b', 'CHILLED', 'g')")


def _state_case(key_sql: str, seed: str) -> str:
    whens = " ".join(f"WHEN {S.unit_hash(key_sql, seed)} < {float(ub)} THEN '{name}'"
                     for name, ub in D.cumulative_bounds(D.STATE_WEIGHTS)[:-1])
    return f"CASE {whens} ELSE 'Labuan' END"


def _fold_sql(text: str, rules) -> str:
    out = text
    for pat, repl in rules:
        out = f"regexp_replace({out}, '{pat}', '{repl}', 'g')"
    return out


def _climate_sql(text: str) -> str:
    from ..functions.rules import CHARACTER_RULES, CLIMATE_RULES, EASTER_RULES
    s1 = _fold_sql(text, CHARACTER_RULES)
    s2 = f"CASE WHEN contains(upper(s1), 'EASTER') THEN {_fold_sql('s1', EASTER_RULES)} ELSE s1 END"
    return s1, s2, CLIMATE_RULES


@query("d01_key_assignment", f"""
WITH {RAW}
SELECT DISTINCT customer_id, {_state_case('customer_id', 'geo42')} AS state FROM clean""")
def d01_key_assignment(t):
    """Weighted state draw once per customer (hash of the key)."""
    return D.assign_by_key(clean(t)).select("customer_id", "state").distinct()


@query("d02_null_key_assignment", f"""
WITH {RAW}
SELECT line_id, {_state_case('line_id', 'georow42')} AS state FROM raw WHERE customer_id IS NULL""")
def d02_null_key_assignment(t):
    """Lines without a customer key get an independent per-line draw."""
    r = raw(t).where(F.col("customer_id").isNull())
    return D.assign_by_key(r).select("line_id", "state")


@query("d03_constant_override", f"""
WITH {RAW} SELECT 'Malaysia' AS country, count(*) AS rows FROM clean""")
def d03_constant_override(t):
    return D.override_constant(clean(t)).groupBy("country").agg(F.count(F.lit(1)).alias("rows"))


@query("d04_category_share", f"""
WITH {ADAPTED}
SELECT state, count(*) AS count, {S.r6('count(*) * 100.0 / (SELECT count(*) FROM final)')} AS pct
FROM final GROUP BY state""")
def d04_category_share(t):
    """Share of lines per assigned state (%)."""
    s = D.category_share(D.assign_by_key(clean(t)), "state")
    return s.select("state", "count", r6("pct").alias("pct"))


@query("d05_key_consistency", f"""
WITH {ADAPTED},
ks AS (SELECT customer_id FROM final GROUP BY 1 HAVING count(DISTINCT state) > 1),
pd AS (SELECT l_partkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1
       HAVING count(DISTINCT upper(p.p_name)) > 1)
SELECT (SELECT count(DISTINCT customer_id) FROM final) AS customers,
       (SELECT count(*) FROM ks) AS customers_multi_state,
       (SELECT count(*) FROM pd) AS codes_multi_description""")
def d05_key_consistency(t):
    """Keys mapped to >1 value: customer -> state, stock code -> description."""
    a = D.assign_by_key(clean(t))
    lines = retail.lines(t, description=True)
    return (a.agg(F.countDistinct("customer_id").alias("customers"))
            .crossJoin(D.inconsistent_keys(a, "customer_id", "state").agg(
                F.count(F.lit(1)).alias("customers_multi_state")))
            .crossJoin(D.inconsistent_keys(lines, "stock_code", "description").agg(
                F.count(F.lit(1)).alias("codes_multi_description"))))


@query("d06_currency_conversion", f"""
WITH {ADAPTED}
SELECT line_id, price AS price_orig, CAST(fx_cents AS DOUBLE) / 100 AS price,
       CAST(quantity * fx_cents AS DOUBLE) / 100 AS amount FROM adapted""")
def d06_currency_conversion(t):
    """Flat-rate conversion, 2 dp half-up, amount recomputed."""
    a = D.convert_prices(clean(t))
    return a.select("line_id", F.col("price_orig").cast("double").alias("price_orig"),
                    F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"))


@query("d06_shape_invariance", f"""
WITH {ADAPTED},
x AS (SELECT price AS bp, CAST(fx_cents AS DOUBLE) / 100 AS ap FROM adapted),
m AS (SELECT avg(bp) AS mb, avg(ap) AS ma FROM x)
SELECT {S.r6('avg(power(bp - mb, 3)) / power(avg(power(bp - mb, 2)), 1.5)')} AS skew_before,
       {S.r6('avg(power(ap - ma, 3)) / power(avg(power(ap - ma, 2)), 1.5)')} AS skew_after
FROM x CROSS JOIN m""")
def d06_shape_invariance(t):
    """Skewness of price before / after conversion (shape preserved)."""
    a = D.convert_prices(clean(t))
    s = a.agg(F.skewness(F.col("price_orig").cast("double")).alias("b"),
              F.skewness(F.col("price").cast("double")).alias("a"))
    return s.select(r6("b").alias("skew_before"), r6("a").alias("skew_after"))


@query("d07_rewrite_descriptions", f"""
WITH x AS (SELECT p_partkey AS stock_code, upper(p_name) AS description_original, {VOCAB_S1} AS s1 FROM part)
SELECT stock_code, description_original, {VOCAB_SQL} AS description FROM x""")
def d07_rewrite_descriptions(t):
    """Ordered regex rewrite of product descriptions (vocabulary rule set)."""
    p = t.part.select(F.col("p_partkey").alias("stock_code"), F.upper("p_name").alias("description"))
    return D.rewrite_text(p, VOCAB_RULESET).select("stock_code", "description_original", "description")


@query("d07_rewrite_documents", f"""
SELECT doc_id, md5({_fold_sql('text', PLACE_RULESET.stages[0].rules)}) AS text_md5,
       {_fold_sql('text', PLACE_RULESET.stages[0].rules)} <> text AS changed
FROM documents""")
def d07_rewrite_documents(t):
    """Place-name rule set over whole document texts."""
    d = t.documents.select("doc_id", "text")
    out = apply_ruleset(F.col("text"), PLACE_RULESET)
    return d.select("doc_id", F.md5(out).alias("text_md5"), (out != F.col("text")).alias("changed"))


def _climate_doc_sql() -> str:
    s1, s2, climate = _climate_sql("text")
    return f"""
WITH a AS (SELECT doc_id, text, {s1} AS s1 FROM documents),
b AS (SELECT doc_id, text, {s2} AS s2 FROM a)
SELECT doc_id, md5({_fold_sql('s2', climate)}) AS text_md5, {_fold_sql('s2', climate)} <> text AS changed FROM b"""


@query("d08_guarded_rewrite_documents", _climate_doc_sql())
def d08_guarded_rewrite_documents(t):
    """Case-insensitive pre-rules, trigger-guarded stage, ordered rules, whole texts."""
    d = t.documents.select("doc_id", "text")
    out = apply_ruleset(F.col("text"), CLIMATE_RULESET)
    return d.select("doc_id", F.md5(out).alias("text_md5"), (out != F.col("text")).alias("changed"))


# One phrase for each rule of the two sets, some in lower case where a rule ignores case; the last leaves a text as it is.
RULE_PHRASES = [
    "I LOVE LONDON", "LONDON BUS", "LONDON BRIDGE", "LONDON", "PARIS FASHION", "FRENCH STYLE", "NEW ENGLAND", "ENGLISH ROSE",
    "UNION JACK", "UNION FLAG", "JUBILEE", "CHARLIE + LOLA", "Charlie and Lola", "LARRY THE LAMB", "EASTER HEN", "EASTER BUNNIES",
    "easter bunny", "EASTER RABBIT", "EASTER CHICKS", "EASTER CHICK", "EASTER EGGS", "EASTER EGG", "WOOLLY HOTTIE", "HOTTIE",
    "HOT WATER BOTTLE", "MINI HAND WARMER", "HAND WARMER", "POCKET WARMER", "EGG WARMER", "EGG COSY", "SCARF KNITTING KIT", "SCARF",
    "BUNNY AND EGG CUP"]
_PLANTED = f"""
p AS (SELECT p_partkey AS stock_code, upper(p_name) || ' ' || [{", ".join(f"'{x}'" for x in RULE_PHRASES)}][p_partkey % {len(RULE_PHRASES)} + 1]
             AS description_original FROM part)"""


def planted_descriptions(t):
    """Product descriptions that end in a phrase of the rules, by the product's number."""
    phrase = F.element_at(F.array(*map(F.lit, RULE_PHRASES)), (F.col("p_partkey") % len(RULE_PHRASES) + 1).cast("int"))
    return t.part.select(F.col("p_partkey").alias("stock_code"), F.concat(F.upper("p_name"), F.lit(" "), phrase).alias("description"))


@query("d07_rewrite_planted", f"""
WITH {_PLANTED}
SELECT stock_code, description_original, {_fold_sql('description_original', PLACE_RULESET.stages[0].rules)} AS description FROM p""")
def d07_rewrite_planted(t):
    """Place-name rules over descriptions that hold a phrase of every rule."""
    return D.rewrite_text(planted_descriptions(t), PLACE_RULESET).select("stock_code", "description_original", "description")


def _planted_climate_sql() -> str:
    s1, s2, climate = _climate_sql("description_original")
    return f"""
WITH {_PLANTED},
a AS (SELECT *, {s1} AS s1 FROM p),
b AS (SELECT *, {s2} AS s2 FROM a)
SELECT stock_code, description_original, {_fold_sql('s2', climate)} AS description FROM b"""


@query("d08_guarded_rewrite_planted", _planted_climate_sql())
def d08_guarded_rewrite_planted(t):
    """Pre-rules, guarded stage and ordered rules over descriptions that hold a phrase of every rule."""
    return D.rewrite_text(planted_descriptions(t), CLIMATE_RULESET).select("stock_code", "description_original", "description")


_VOCAB_LINES = f"""
WITH x AS (SELECT upper(p.p_name) AS before, {VOCAB_S1} AS s1
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
y AS (SELECT before, {VOCAB_SQL} AS after FROM x)"""


def _vocab_report(t):
    lines = retail.lines(t, description=True)
    return D.rewrite_report(F.col("description"), apply_ruleset(F.col("description"), VOCAB_RULESET), lines)


@query("d09_rewrite_summary", _VOCAB_LINES + f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE before <> after) AS changed,
       {S.r6("count(*) FILTER (WHERE before <> after) * 100.0 / count(*)")} AS changed_pct FROM y""")
def d09_rewrite_summary(t):
    """Lines changed by the rewrite and their share."""
    s, _ = _vocab_report(t)
    return s.select("rows", "changed", r6("changed_pct").alias("changed_pct"))


@query("d09_rewrite_mapping", _VOCAB_LINES + """
SELECT before, after, count(*) AS rows FROM y WHERE before <> after GROUP BY before, after""")
def d09_rewrite_mapping(t):
    """Distinct before -> after pairs with line counts."""
    return _vocab_report(t)[1]


@query("d10_charm_pricing", f"""
WITH {ADAPTED}
SELECT line_id, CAST(fx_cents AS DOUBLE) / 100 AS price_raw, CAST(new_price_cents AS DOUBLE) / 100 AS price,
       CAST(quantity * new_price_cents AS DOUBLE) / 100 AS amount FROM final""")
def d10_charm_pricing(t):
    """Snap converted prices to .00/.50/.90/+1.00, amount recomputed."""
    a = D.charm_prices(D.convert_prices(clean(t)))
    return a.select("line_id", F.col("price_raw").cast("double").alias("price_raw"),
                    F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"))


@query("d11_price_endings", f"""
WITH {ADAPTED}
SELECT CAST(new_price_cents % 100 AS DOUBLE) / 100 AS ending, count(*) AS count
FROM final GROUP BY 1 ORDER BY count DESC, ending LIMIT 6""")
def d11_price_endings(t):
    """Top-6 price endings after charm pricing."""
    a = D.charm_prices(D.convert_prices(clean(t)))
    return D.price_endings(a).select(F.col("ending").cast("double").alias("ending"), "count")


@query("d12_display_name", f"""
WITH {RAW}
SELECT DISTINCT customer_id,
  ({'[' + ', '.join(repr(n) for n in D.FIRST_NAMES) + ']'})[
     CAST(('0x' || substr(md5(concat_ws('|', customer_id, 'first42')), 1, 8))::BIGINT % 12 AS INTEGER) + 1]
  || ' ' ||
  ({'[' + ', '.join(repr(n) for n in D.LAST_NAMES) + ']'})[
     CAST(('0x' || substr(md5(concat_ws('|', customer_id, 'last42')), 1, 8))::BIGINT % 10 AS INTEGER) + 1]
  AS display_name
FROM clean""")
def d12_display_name(t):
    """Deterministic synthetic display name per customer."""
    c = clean(t)
    return c.select("customer_id", D.display_name(F.col("customer_id")).alias("display_name")).distinct()
