"""ML-1..3, SCA-5/6/9, DEL-1..8: scoring, threshold, label, preparation stats."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlane.operators import scoring as SC


def test_threshold_inclusive_and_nan_safe(spark):
    df = spark.createDataFrame([(0.37,), (0.3699,), (float("nan"),), (0.9,)], "p double")
    rows = df.select(SC.binarise(F.col("p"), F.lit(0.37)).alias("y")).collect()
    assert [r.y for r in rows] == [1, 0, 0, 1]


def test_label_text(spark):
    df = spark.createDataFrame([(1,), (0,)], "y int")
    assert [r.l for r in df.select(SC.label_text(F.col("y")).alias("l")).collect()] == ["Quitte", "Reste"]


def test_score_matches_formula(spark):
    m = SC.LogisticModel("m", ["a", "b"], intercept=0.5, weights={"a": 2.0, "b": -1.0},
                         scaler={"a": (1.0, 2.0)})
    df = spark.createDataFrame([(3.0, 1.0), (-1.0, 4.0)], "a double, b double")
    rows = SC.score(df, m, threshold=0.5).collect()
    for r in rows:
        z = 0.5 + 2.0 * ((r.a - 1.0) / 2.0) - 1.0 * r.b
        p = 1 / (1 + math.exp(-z))
        assert r.probabilite_de_quitter == pytest.approx(p)
        assert r.prediction == (1 if p >= 0.5 else 0)
        assert r.seuil_applique == 0.5 and r.modele_utilise == "m"


def test_per_row_threshold(spark):
    m = SC.LogisticModel("m", ["a"], intercept=0.0, weights={"a": 0.0})   # p = 0.5
    df = spark.createDataFrame([(0.0, 0.5), (0.0, 0.6)], "a double, seuil double")
    rows = SC.score(df, m, threshold=F.col("seuil")).collect()
    assert [r.prediction for r in rows] == [1, 0]


def test_onehot_terms_and_layout(spark):
    m = SC.LogisticModel("m", ["c"], intercept=0.0, onehot={"c": {"x": 1.0, "y": -1.0}})
    assert m.layout == "aligned"
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "c string")
    ps = [r.probabilite_de_quitter for r in SC.score(df, m).collect()]
    assert ps == pytest.approx([1 / (1 + math.exp(-1)), 1 / (1 + math.exp(1)), 0.5])


def test_model_from_table(spark):
    coef = spark.createDataFrame([
        ("m", "__intercept__", None, -1.0, None, None),
        ("m", "age", None, 0.5, 40.0, 10.0),
        ("m", "statut_marital", "single", 0.25, None, None),
        ("m", "__threshold__", None, 0.4, None, None),
        ("other", "age", None, 9.0, None, None),
    ], "model string, feature string, category string, weight double, center double, scale double")
    m = SC.model_from_table(coef, "m")
    assert m.intercept == -1.0 and m.threshold == 0.4
    assert m.weights == {"age": 0.5} and m.scaler == {"age": (40.0, 10.0)}
    assert m.onehot == {"statut_marital": {"single": 0.25}}


def test_score_with_pandas_model(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    out = SC.score_with(df, lambda pdf: np.column_stack([1 - pdf["a"] / 10, pdf["a"] / 10]), ["a"])
    assert [r.probabilite_de_quitter for r in out.collect()] == pytest.approx([0.1, 0.2])
    out = SC.score_with(df, lambda pdf: (pdf["a"] / 4).to_numpy(), ["a"])
    assert [r.probabilite_de_quitter for r in out.collect()] == pytest.approx([0.25, 0.5])


def test_standard_scaler_uses_population_deviation(spark):
    xs = [1.0, 2.0, 4.0, 8.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    (mean, sd), = SC.fit_standard(df, ["x"]).values()
    assert mean == pytest.approx(np.mean(xs)) and sd == pytest.approx(np.std(xs))


def test_minmax(spark):
    df = spark.createDataFrame([(2.0,), (6.0,), (4.0,)], "x double")
    out = SC.apply_scaler(df, SC.fit_minmax(df, ["x"]))
    assert sorted(r.x for r in out.collect()) == [0.0, 0.5, 1.0]


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0, 1.0, 2.0, 10.0, 7.0], [1.0, 1.0, 1.0, 2.0, 9.0, 9.0, 4.0],
    list(np.random.default_rng(7).normal(size=301).round(3)),
])
def test_exact_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)
    got = SC.exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.75, 1.0])
    want = np.quantile(values, [0.0, 0.25, 0.5, 0.75, 1.0])
    assert got == pytest.approx(list(want))


def test_robust_approx_close_to_exact(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "x double")
    exact = SC.fit_robust(df, ["x"], exact=True)["x"]
    approx = SC.fit_robust(df, ["x"], exact=False)["x"]
    assert exact == (500.0, 500.0)
    assert approx[0] == pytest.approx(500.0, abs=2) and approx[1] == pytest.approx(500.0, abs=4)


def test_impute_and_one_hot(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "a")], "x double, c string")
    out = SC.apply_impute(df, SC.fit_impute_mean(df, ["x"]))
    assert [r.x for r in out.collect()] == [1.0, 2.0, 3.0]
    vocab = SC.vocabulary(df, "c")
    oh = SC.one_hot(df, "c", vocab).collect()
    assert vocab == ["a", "b"] and [(r.c_a, r.c_b) for r in oh] == [(1.0, 0.0), (0.0, 1.0), (1.0, 0.0)]


def test_fit_logistic_separates_classes(spark):
    rows = [(float(x), 1 if x > 50 else 0) for x in range(100)]
    df = spark.createDataFrame(rows, "x double, y int")
    m = SC.fit_logistic(df, ["x"], "y", name="fitted", reg_param=0.01)
    scored = SC.score(df, m).collect()
    acc = sum(r.prediction == r.y for r in scored) / len(scored)
    assert acc > 0.9 and m.scaler["x"][0] == pytest.approx(49.5)


def test_vocabulary_size_is_checked(spark):
    df = spark.range(6).selectExpr("CAST(id AS STRING) AS c")
    assert SC.vocabulary(df, "c", max_size=6) == list("012345")
    with pytest.raises(ValueError):
        SC.vocabulary(df, "c", max_size=5)
