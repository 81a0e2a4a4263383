"""The held-out part of each stratum is exact and the same in every run."""
import math

from tillroll.operators.features import stratified_split


def test_exact_share_of_each_stratum(spark):
    df = spark.createDataFrame([(i, float(i % 37)) for i in range(203)], "customer_id long, future_spend double")
    rows = stratified_split(df).collect()
    median = sorted(r["future_spend"] for r in rows)[101]
    for high in (False, True):
        part = [r for r in rows if (r["future_spend"] > median) == high]
        assert sum(r["split"] == "test" for r in part) == math.ceil(len(part) / 5)
    again = {r["customer_id"]: r["split"] for r in stratified_split(df.repartition(5)).collect()}
    assert again == {r["customer_id"]: r["split"] for r in rows}


def test_split_of_no_rows(spark):
    assert stratified_split(spark.createDataFrame([], "customer_id long, future_spend double")).count() == 0
