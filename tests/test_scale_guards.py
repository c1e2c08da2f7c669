"""Scale guards: hot keys stay correct, plans keep their shape.

A hot key holds a third of all rows here, as the design assumes it may on a
cluster.  The plan checks run every registered query at the smallest scale
and reject shapes that do not survive 100x growth.
"""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from churnlane.operators import directory as D
from churnlane.operators import governance as G
from churnlane.operators import results as RS
from churnlane.operators import scoring as SC

SF_SMALL = "/root/testdata/sf0.001"
N = 3000


@pytest.fixture(scope="module")
def hot_results(spark):
    # owner 1 holds a third of the rows; the rest spread over 1000 owners
    df = spark.range(N).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000 + 2).alias("id_user"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.lit(None)).cast("long").alias("employe_id"))
    return df.repartition(6)


def test_topk_hot_owner(spark, hot_results):
    top = RS.topk_per_owner(hot_results, k=5)
    hot = top.where(F.col("id_user") == 1).orderBy("position").collect()
    assert [r.id for r in hot] == [2997, 2994, 2991, 2988, 2985]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_counts_and_erase_hot_owner(spark, hot_results):
    counts = {r.id_user: r.nb for r in RS.counts_per_owner(hot_results).collect()}
    assert counts[1] == N // 3 and sum(counts.values()) == N
    users = spark.range(1, 1010).withColumnRenamed("id", "id")
    _, kept, _ = G.erase(users, hot_results, spark.createDataFrame([(1,)], "id long"))
    assert kept.count() == N - N // 3


def test_register_hot_name(spark):
    inc = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("usr"), F.col("id").cast("string")))
        .alias("username"), F.col("id").alias("t")).repartition(6)
    acc, rej = G.register_unique(inc, spark.createDataFrame([], "username string"), order_cols=["t"])
    assert acc.where(F.col("username") == "hot").collect()[0].t == 0
    assert rej.count() == N // 3 - 1 and acc.count() == N - (N // 3 - 1)


def test_detail_hot_link(spark, hot_results):
    feats = spark.createDataFrame([(7, 30)], "id long, age int")
    det = RS.detail(hot_results.withColumn("details", F.lit(None).cast("string")), feats)
    by_source = {r.source_features: r["count"] for r in det.groupBy("source_features").count().collect()}
    assert by_source == {"employes_features": N // 3, "details_json": N - N // 3}


def test_records_hot_request(spark):
    feats = spark.range(100).withColumn("age", F.col("id") + 20)
    labels = spark.createDataFrame([(5, "Oui")], "id long, a_quitte_l_entreprise string")
    req = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 50)
                                .alias("id"))
    out = D.records(feats, labels, req)
    assert out.count() == 50


def test_exact_quantiles_hot_value(spark):
    df = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(5.0))
                               .otherwise(F.col("id").cast("double")).alias("x"))
    import numpy as np
    vals = [r.x for r in df.collect()]
    assert SC.exact_quantiles(df, "x", [0.1, 0.5, 0.9]) == pytest.approx(
        list(np.quantile(vals, [0.1, 0.5, 0.9])))


BAD_OPERATORS = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                 "ArrowEvalPython"]


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in BAD_OPERATORS:
        assert op not in plan, f"{name} plan contains {op}"


def test_salted_detail_equals_plain(spark, hot_results):
    feats = spark.createDataFrame([(7, 30), (8, 31)], "id long, age int")
    res = hot_results.withColumn("details", F.lit(None).cast("string"))
    plain = sorted((tuple(r) for r in RS.detail(res, feats).collect()), key=repr)
    salted_df = RS.detail(res, feats, salts=8, hot_min_rows=100)
    assert sorted((tuple(r) for r in salted_df.collect()), key=repr) == plain
    plan = salted_df._jdf.queryExecution().executedPlan().toString()
    assert "_cl_salt" in plan


def test_salted_join_inner_and_left(spark):
    from churnlane.operators.joins import salted_join
    big = spark.range(3000).select(F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 50)
                                   .alias("k"), F.col("id"))
    small = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "k2 long, v string")
    for how in ("inner", "left"):
        want = sorted((tuple(r) for r in big.join(small, big.k == small.k2, how).collect()), key=repr)
        got = sorted((tuple(r) for r in salted_join(big, small, "k", "k2", how, salts=4,
                                                    min_rows=500).collect()), key=repr)
        assert got == want


def test_salted_join_with_map_column(spark):
    from churnlane.operators.joins import salted_join
    big = spark.range(400).select((F.col("id") % 2).alias("k"),
                                  F.create_map(F.lit("a"), F.col("id")).alias("m"))
    small = spark.createDataFrame([(0, "x"), (1, "y")], "k2 long, v string")
    out = salted_join(big, small, "k", "k2", "left", salts=4, min_rows=100)
    assert out.count() == 400 and out.where(F.col("v").isNull()).count() == 0


def test_salted_erase_and_register_equal_plain(spark, hot_results):
    users = spark.range(1, 1010)
    req = spark.createDataFrame([(1,), (5,)], "id long")
    _, plain, _ = G.erase(users, hot_results, req)
    _, salted, _ = G.erase(users, hot_results, req, salts=8, hot_min_rows=100)
    assert sorted(r.id for r in salted.collect()) == sorted(r.id for r in plain.collect())
    inc = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 400)
                                                                        .cast("string")))
        .alias("username"), F.col("id").alias("t"))
    stored = spark.createDataFrame([("u7",)], "username string")
    a1, r1 = G.register_unique(inc, stored, order_cols=["t"])
    a2, r2 = G.register_unique(inc, stored, order_cols=["t"], salts=8, hot_min_rows=100)
    assert sorted(tuple(r) for r in a1.collect()) == sorted(tuple(r) for r in a2.collect())
    assert sorted(tuple(r) for r in r1.collect()) == sorted(tuple(r) for r in r2.collect())


def test_aqe_splits_hot_link_in_detail_join(spark):
    """With a sort-merge join, AQE splits the hot employee's partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        res = spark.range(90000).select(
            F.col("id"), (F.col("id") % 1000).alias("id_user"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).cast("long")
            .alias("employe_id"), F.lit(None).cast("string").alias("details"))
        feats = spark.range(5000).select(F.col("id"), (F.col("id") % 60).alias("age"))
        det = RS.detail(res, feats)
        assert len(det.collect()) == 90000
        plan = det._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
