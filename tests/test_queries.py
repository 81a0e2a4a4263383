"""The driver contract, and a few registered queries against their DuckDB oracle at sf0.001."""
import math

import duckdb
import pytest

from conftest import SMALL

FAST = ["r02_rfm", "c08_cleaning_funnel", "d04_category_share", "p16_rich_features", "p21_roc_auc",
        "q04_segment_totals", "k04_silhouette_sq", "v08_check_report"]


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and v.is_integer():
        return int(v)
    return v if isinstance(v, (int, float, str, bool)) else str(v)


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert set(df.columns) == {"customer_id", "recency", "frequency", "monetary", "state"}
    assert df.count() > 0


def test_every_oracle_has_a_query():
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())


def test_every_oracle_parses():
    import __spark_entry__ as e
    from tillroll.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    for name, sql in e.oracle_sql().items():
        try:
            con.execute(f"EXPLAIN {sql}")
        except duckdb.Error as error:
            pytest.fail(f"{name}: {error}")


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as e
    from tillroll.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    sp = e.queries()[name](spark, SMALL).toPandas()
    od = con.execute(e.oracle_sql()[name]).fetchdf()
    cols = sorted(sp.columns)
    assert cols == sorted(od.columns)
    a = sorted(tuple(norm(x) for x in r) for r in sp[cols].itertuples(index=False))
    b = sorted(tuple(norm(x) for x in r) for r in od[cols].itertuples(index=False))
    assert a == b
