"""JOI-1/2, FLT-3/4/6/7/11, SRT-2, PRJ-3: directory and record queries."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlane.operators import directory as D


def _tables(spark):
    feats = spark.createDataFrame([(i, 20 + i) for i in [1, 2, 10, 12, 19, 100, 123, 200]],
                                  "id long, age int")
    labels = spark.createDataFrame([(1, "Oui"), (12, "Non"), (123, "Oui"), (999, "Oui")],
                                   "id long, a_quitte_l_entreprise string")
    return feats, labels


def test_directory_prefix_label_and_order(spark):
    f, l = _tables(spark)
    rows = D.directory(f, l, q=" 1 ").collect()
    assert [r.id for r in rows] == [1, 10, 12, 19, 100, 123]
    assert rows[3].libelle == "Employé #19" and rows[2].a_quitte_l_entreprise == "Non"
    assert rows[1].a_quitte_l_entreprise is None


def test_blank_search_is_no_filter(spark):
    f, l = _tables(spark)
    assert D.directory(f, l, q=" ").count() == 8 and D.directory(f, l).count() == 8
    assert D.directory(f, l, limit=3).count() == 3


def test_live_wildcards(spark):
    f, l = _tables(spark)
    assert [r.id for r in D.directory(f, l, q="1_").collect()] == [10, 12, 19, 100, 123]


def test_flag_positives_record_missing(spark):
    f, l = _tables(spark)
    d = D.directory(f, l)
    assert [r.id for r in D.positives(d, "a_quitte_l_entreprise").collect()] == [1, 123]
    flags = {r.id: r.already_left for r in D.with_positive_flag(d, "a_quitte_l_entreprise").collect()}
    assert flags[1] is True and flags[2] is False and flags[12] is False
    rec = D.record(f, l, 123).collect()
    assert len(rec) == 1 and rec[0].age == 143 and rec[0].a_quitte_l_entreprise == "Oui"
    assert D.record(f, l, 5).count() == 0
    req = spark.createDataFrame([(2,), (5,), (5,), (123,)], "id long")
    assert sorted(r.id for r in D.records(f, l, req).collect()) == [2, 123]
    assert [r.id for r in D.missing_keys(req, f).collect()] == [5]


def test_prefix_filter_reaches_scan(spark, tmp_dir):
    f, l = _tables(spark)
    f.write.parquet(f"{tmp_dir}/f")
    plan = D.directory(spark.read.parquet(f"{tmp_dir}/f"), l, q="12")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(id,12)" in plan


@settings(max_examples=40, deadline=None)
@given(ids=st.lists(st.integers(min_value=-10**6, max_value=10**12), min_size=1, max_size=30),
       q=st.from_regex(r"[0-9]{1,4}", fullmatch=True))
def test_prefix_ranges_equal_text_prefix(spark, ids, q):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    cond = D.prefix_ranges(F.col("id"), q)
    got = sorted(r.id for r in df.where(cond).collect())
    want = sorted(i for i in ids if str(i).startswith(q))
    assert got == want


def test_bucketed_tables_join_without_exchange(spark):
    from churnlane.sources.sinks import write_bucketed
    feats = spark.range(0, 2000).select(F.col("id"), (F.col("id") % 90).alias("age"))
    labels = spark.range(0, 2000, 3).select(F.col("id"), F.lit("Oui").alias("a_quitte_l_entreprise"))
    f = write_bucketed(feats, "features_b", "id", 8)
    lab = write_bucketed(labels, "labels_b", "id", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = f.join(lab, "id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert joined.where(F.col("a_quitte_l_entreprise") == "Oui").count() == 667
        d = D.directory(f, lab, q="12")
        assert [r.id for r in d.collect()][:3] == [12, 120, 121]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
