import pytest

from tillroll.operators import serve as Q
from tillroll.sources import files


def test_unmapped_segment_label_fails(spark):
    df = spark.createDataFrame([(1, "Champions (recent, frequent, high spend)"), (2, "Big Spenders (recent, high value, infrequent)")],
                               "customer_id int, segment_label string")
    with pytest.raises(Exception, match="unmapped segment label"):
        Q.short_names(df).collect()


def test_contact_list_filters_and_order(spark):
    p = spark.createDataFrame([(1, 1, 0.9, 1, 10.0, "train", True), (2, 0, 0.4, 0, 0.0, "held-out test", True),
                               (3, 1, 0.7, 0, 5.0, "held-out test", False)],
                              "customer_id int, predicted int, probability double, actual int, "
                              "actual_future_spend double, data_split string, correct boolean")
    c = spark.createDataFrame([(1, "Champions", "A"), (2, "Champions", "B"), (3, "Lost / Dormant", "A")],
                              "customer_id int, segment string, state string")
    lst = Q.contact_list(p, c, 0.5)
    assert [r.customer_id for r in lst.collect()] == [1, 3]
    assert Q.contact_list(p, c, 0.5, held_out_only=True).count() == 1
    m = Q.contact_metrics(lst).first()
    assert m.customers == 2 and m.train_rows == 1 and m.accuracy == 0.5


def test_artefact_and_json_round_trip(spark):
    df = spark.createDataFrame([(1, 2.5, "x")], "a long, b double, c string")
    p = files.write_artefact(df, files.artefact_dir(spark, "t"))
    assert files.read_artefact(spark, p).collect() == df.collect()
    j = files.write_json_record(df, files.artefact_dir(spark, "j"))
    r = files.read_json_record(spark, j).first()
    assert (r.a, r.b, r.c) == (1, 2.5, "x")
    with pytest.raises(Exception):
        files.write_artefact(df, p)      # never overwrites an existing artefact


def test_line_numbers_through_blocks_and_files(spark):
    rows = [(f"{i:04d}", f"{i}", "é" * (i % 9), None if i % 5 == 0 else i, None, i / 4, None) for i in range(900)]
    df = spark.createDataFrame(rows, files.RAW_SCHEMA)
    base = files.artefact_dir(spark, "numbers")
    paths = [files.write_csv(df.coalesce(1).sortWithinPartitions("line_id"), f"{base}/one"),
             files.write_csv(df.repartitionByRange(5, "line_id").sortWithinPartitions("line_id"), f"{base}/five"),
             files.write_csv(df.where("false"), f"{base}/none")]
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")   # about 20 blocks in the one file
    try:
        back = files.read_numbered_csv(spark, paths)
        blocks = files.read_csv(spark, paths[:1]).select("_metadata.file_block_start").distinct().count()
        got = back.select("_source", "line_id", "line_number", "quantity").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert blocks > 5
    for source in ("one", "five"):
        mine = sorted((r.line_number, r.line_id, r.quantity) for r in got if r._source == source)
        assert mine == [(i + 1, f"{i:04d}", None if i % 5 == 0 else i) for i in range(900)]
    assert {r._source for r in got} == {"one", "five"}


def test_folder_name_without_a_search(spark):
    """``_source`` is cut from the path by its slashes, not searched for by a regular expression for each row."""
    base = files.artefact_dir(spark, "folders")
    df = spark.createDataFrame([("1", "1", "a", 1, None, 1.0, None)], files.RAW_SCHEMA)
    back = files.read_csv(spark, [files.write_csv(df, f"{base}/ext ra.ct=a"), files.write_csv(df, f"{base}/b")])
    assert "regexp_extract" not in back._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r._source for r in back.collect()) == ["b", "ext%20ra.ct=a"]
