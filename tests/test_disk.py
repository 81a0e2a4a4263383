"""What a query writes beside its result: each table once, and no checkpoint of what a filter or a scan gives back."""
from datetime import datetime

from tillroll.operators import clean as C
from tillroll.plans import serving_queries
from tillroll.plans.registry import QUERIES, load_all


def counted(monkeypatch, module):
    """The rows and columns of every table that ``module`` checkpoints."""
    seen, whole = [], module.materialize

    def one(df):
        out = whole(df)
        seen.append((out.count(), out.columns))
        return out
    monkeypatch.setattr(module, "materialize", one)
    return seen


def test_cleaned_lines_are_written_once(spark, monkeypatch):
    seen = counted(monkeypatch, C)
    rows = [(str(i % 7), f"c{i}", "2001-02-03 04:05:06", 1 + i % 3, 2.0 if i else 5000.0) for i in range(60)]
    raw = spark.createDataFrame(rows, "customer_id string, line_id string, invoice_date string, quantity int, price double")
    out = C.clean_lines(raw, ["yyyy-MM-dd HH:mm:ss"])
    want = C.clean_lines(raw, ["yyyy-MM-dd HH:mm:ss"], checkpoint=False)
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect())) and out.count() == 59
    assert out.first()["invoice_ts"] == datetime(2001, 2, 3, 4, 5, 6)
    assert [n for n, _ in seen] == [60, 1]


def test_numbered_lines_are_not_checkpointed_again(spark, monkeypatch):
    load_all()
    seen = counted(monkeypatch, serving_queries)
    found = {r["copy"]: r.asDict() for r in QUERIES["v04_row_position"](spark, "/root/testdata/sf0.001").collect()}
    assert found["adapted"]["same_sequence"] and not found["swapped"]["same_sequence"]
    assert found["swapped"]["diff_line_id"] == 2 and found["adapted"]["unmatched_lines"] == 0
    assert all(n <= 1 for n, _ in seen)
