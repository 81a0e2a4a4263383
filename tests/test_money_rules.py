from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.functions.money import charm_price, unit_price_cents
from tillroll.functions.rules import CLIMATE_RULESET, PLACE_RULESET, RuleSet, RuleStage, apply_ruleset


def test_charm_price_ties_and_passthrough(spark):
    rows = [("0.25",), ("0.70",), ("0.95",), ("1.00",), ("12.26",), ("12.71",), (None,), ("0",), ("-1",)]
    df = spark.createDataFrame(rows, "p string").select(F.col("p").cast("decimal(12,2)").alias("p"))
    got = [r[0] for r in df.select(charm_price(F.col("p"))).collect()]
    want = [Decimal("0.00"), Decimal("0.50"), Decimal("0.90"), Decimal("1.00"), Decimal("12.50"),
            Decimal("12.90"), None, Decimal("0.00"), Decimal("-1.00")]
    assert got == want


def test_unit_price_half_up_in_integers(spark):
    df = spark.createDataFrame([(1005, 2), (1003, 2), (999, 3), (1, 2)], "c long, q int")
    got = [r[0] for r in df.select(unit_price_cents(F.col("c"), F.col("q"))).collect()]
    assert got == [503, 502, 333, 1]  # 502.5 -> 503, 501.5 -> 502, 333, 0.5 -> 1


def test_rules_are_ordered_guarded_and_null_safe(spark):
    rs = RuleSet([RuleStage([(r"\bHOT PLATE\b", "INDUCTION PLATE"), (r"\bHOT\b", "WARM")]),
                  RuleStage([(r"(?i)\bsmall\b", "MINI")], guard="WIDGET")])
    df = spark.createDataFrame([("HOT PLATE",), ("HOT ROD",), ("small widget",), ("small rod",), (None,)], "t string")
    got = [r[0] for r in df.select(apply_ruleset(F.col("t"), rs)).collect()]
    assert got == ["INDUCTION PLATE", "WARM ROD", "MINI widget", "small rod", None]


def test_reference_rule_sets(spark):
    df = spark.createDataFrame([("I LOVE LONDON MUG",), ("LONDON BUS TOY",), ("UNION FLAG CUSHION",),
                                ("EASTER BUNNY EGG",), ("Charlie and Lola cup",), ("HOT WATER BOTTLE",),
                                ("egg cup",)], "t string")
    out = [r[0] for r in df.select(apply_ruleset(apply_ruleset(F.col("t"), PLACE_RULESET), CLIMATE_RULESET))
           .collect()]
    assert out == ["I LOVE MALAYSIA MUG", "KL MONORAIL TOY", "HIBISCUS PRINT CUSHION", "RAYA KETUPAT COOKIE",
                   "KIDS DESIGN cup", "INSULATED TUMBLER", "egg cup"]


def test_every_rule_changes_a_planted_phrase(spark):
    from tillroll.functions.rules import fold_rules
    from tillroll.plans.adapt_queries import RULE_PHRASES
    df = spark.createDataFrame([(x,) for x in RULE_PHRASES], "text string")
    for ruleset in (PLACE_RULESET, CLIMATE_RULESET):
        text, fired = F.col("text"), []
        for stage in ruleset.stages:
            on = F.upper(text).contains(stage.guard) if stage.guard else F.lit(True)
            steps = [fold_rules(text, stage.rules[:i]) for i in range(len(stage.rules) + 1)]
            fired += [F.count_if(on & (a != b)) for a, b in zip(steps, steps[1:])]
            text = F.when(on, steps[-1]).otherwise(text)
        assert min(df.agg(*[n.alias(f"r{i}") for i, n in enumerate(fired)]).first()) > 0
    last = df.where(F.col("text") == RULE_PHRASES[-1])
    assert [tuple(r) for r in last.select(apply_ruleset(F.col("text"), PLACE_RULESET), apply_ruleset(F.col("text"), CLIMATE_RULESET)).collect()] \
        == [(RULE_PHRASES[-1],) * 2]
