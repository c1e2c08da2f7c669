"""Merged statistics against the whole, and sparse one-hot encoding."""

import math
import random

import pytest
from pyspark.sql import functions as F

from churnlane.operators import scoring as SC
from churnlane.operators import sparse as SP
from churnlane.operators import statistics as ST


def _numbers(spark, n=6000):
    rng = random.Random(5)
    rows = [(i % 7, rng.gauss(1e6, 3.0), rng.expovariate(0.1) if i % 11 else None, None) for i in range(n)]
    rows += [(9, float("nan"), 5.0, None)]
    return spark.createDataFrame(rows, "b int, x double, y double, z double")


def test_merged_batches_are_the_whole(spark):
    df = _numbers(spark)
    per_batch = ST.batch_statistics(df, ["x", "y", "z"], batch="b")
    assert per_batch.count() == 8 * 3
    merged = ST.merge_statistics(per_batch).cache()
    whole = {r.column: r for r in ST.batch_statistics(df, ["x", "y", "z"]).collect()}
    for r in merged.collect():
        w = whole[r.column]
        assert (r.n, r.missing, r.low, r.high) == (w.n, w.missing, w.low, w.high)
        if r.n:
            assert math.isclose(r["mean"], w["mean"], rel_tol=1e-12) and math.isclose(r.m2, w.m2, rel_tol=1e-6)
        else:
            assert r["mean"] is None
    want = SC.fit_standard(df.where(~F.isnan("x")), ["x"]) | SC.fit_standard(df, ["y"])
    for (a, b), (c, d) in zip(ST.standard_of(merged, ["x", "y"]).values(), want.values()):
        assert math.isclose(a, c, rel_tol=1e-9) and math.isclose(b, d, rel_tol=0.01)
    assert ST.minmax_of(merged, ["y"]) == SC.fit_minmax(df, ["y"])
    assert ST.fills_of(merged, ["y", "z"])["z"] is None
    assert math.isclose(ST.fills_of(merged, ["y"])["y"], SC.fit_impute_mean(df, ["y"])["y"], rel_tol=1e-9)
    # merging in two steps is the same
    two = ST.merge_statistics(ST.merge_statistics(per_batch.where("b < 3")).unionByName(
        ST.merge_statistics(per_batch.where("b >= 3"))))
    for r, s in zip(two.orderBy("column").collect(), merged.orderBy("column").collect()):
        assert r.n == s.n and (not r.n or math.isclose(r.m2, s.m2, rel_tol=1e-6))
    merged.unpersist()


def test_quantiles_are_within_the_rank_error(spark):
    df = _numbers(spark)
    values = sorted(r.y for r in df.where("y is not null").select("y").collect())
    merged = ST.merge_statistics(ST.batch_statistics(df, ["y", "z"], batch="b"))
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = {r.column: r.quantiles for r in ST.quantiles(merged, probs).collect()}
    assert got["z"] is None
    for q, x in zip(probs, got["y"]):
        rank = sum(v <= x for v in values) / len(values)
        assert abs(rank - q) < 0.01
    center, scale = ST.robust_of(merged, ["y"])["y"]
    exact_center, exact_scale = SC.fit_robust(df, ["y"])["y"]
    assert abs(center - exact_center) < 0.5 and abs(scale - exact_scale) < 0.8
    assert abs(ST.fills_of(merged, ["y"], median=True)["y"] - exact_center) < 0.5


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 1}, {"salts": 3}])
def test_sparse_one_hot(spark, options):
    rows = [(i, None if i % 13 == 0 else "hot" if i % 3 == 0 else f"v{i % 50:02d}") for i in range(600)]
    df = spark.createDataFrame(rows, "k long, v string")
    vocabulary = SP.vocabulary_index(df, "v")
    order = sorted({v for _, v in rows if v is not None})
    assert {(r.value, r["index"]) for r in vocabulary.collect()} == {(v, i) for i, v in enumerate(order)}
    got = {r.k: r["index"] for r in SP.one_hot_rows(df, "k", "v", vocabulary, **options).collect()}
    assert got == {k: order.index(v) for k, v in rows if v is not None}
    assert SP.one_hot_rows(df, "k", "v", vocabulary.where("index > 3"), **options).where("index <= 3").count() == 0


def test_sparse_vectors_over_two_columns(spark):
    df = spark.createDataFrame([(1, "b", 5), (2, "a", None), (3, None, 7), (4, "zzz", 5)], "k long, c string, d int")
    known = df.where("k < 4")
    vocabularies = {c: SP.vocabulary_index(known, c) for c in ("c", "d")}
    got = {r.k: (r.features.size, r.features.indices, r.features["values"]) for r in
           SP.one_hot_vectors(df, ["c", "d"], vocabularies).collect()}
    assert got == {1: (4, [1, 2], [1.0, 1.0]), 2: (4, [0], [1.0]), 3: (4, [3], [1.0]), 4: (4, [2], [1.0])}
    assert SP.vocabulary_index(df.where("false"), "c").count() == 0


def test_vocabulary_of_many_values(spark):
    n = 1_000_000
    df = spark.range(n).select("id", (F.col("id") * 7919 % n).alias("v"))
    vocabulary = SP.vocabulary_index(df, "v")
    assert vocabulary.where("value = index").count() == n
    rows = SP.one_hot_rows(df, "id", "v", vocabulary, max_broadcast=1000)
    assert rows.where(F.col("id") * 7919 % n == F.col("index")).count() == n
