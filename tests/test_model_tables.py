"""Models as data: equality with the per-model form, plan length, layout trial."""

import json

import pytest
from pyspark.sql import functions as F

from churnlane.operators import model_tables as MT
from churnlane.operators.predict import predict_with_models
from churnlane.operators.scoring import models_from_table

COEF = "model string, feature string, category string, weight double, center double, scale double"


def _bundle(columns, onehot=(), unknown=None, scaler=False, predict=True):
    model = {"type": "Pipeline", "predict": predict, "steps": [{"type": "ColumnTransformer", "transformers": [
        {"name": "o", "columns": list(onehot), "steps": ["OneHotEncoder"]}]}]}
    if unknown:
        model["handle_unknown"] = unknown
    out = {"model": model, "colonnes": columns}
    if scaler:
        out["scaler"] = {"type": "StandardScaler", "transform": True}
    return json.dumps(out)


def _tables(spark, n):
    registry, rows = [], []
    for i in range(n):
        name = f"m{i}"
        text = i % 2 == 1
        registry.append((name, _bundle(["k", "statut_marital"] if text else ["k", "frequence_deplacement"],
                                       ["statut_marital"] if text else ["nothing"])))
        rows += [(name, "__intercept__", None, -0.1 * (i % 7), None, None),
                 (name, "k", None, 0.01 * (i % 11), 50.0, 29.0)]
        rows += ([(name, "statut_marital", "single", 0.5 + i, None, None), (name, "statut_marital", "Married", -0.25, None, None)]
                 if text else [(name, "frequence_deplacement", None, 0.3, None, None)])
    return spark.createDataFrame(registry, "name string, metadata string"), spark.createDataFrame(rows, COEF)


def _requests(spark, n, models):
    out = []
    for i in range(n):
        f = {"k": [i % 100, str(i % 100), "1,5", None, True, "x"][i % 6],
             "statut_marital": ["single", "Married", "", "widower", 1, None][i % 6 if i % 5 else 0],
             "frequence_deplacement": ["Frequent", "2", " rare ", "never"][i % 4]}
        text = [json.dumps(f), None, "[1]", '{"k": "inf"}'][0 if i % 9 else 1 + i % 3]
        out.append((i, f"m{i % (models + 3)}" if i % 23 else None, text, [0.5, None, 0.2][i % 3] if i % 2 else 0.37))
    return spark.createDataFrame(out, "request_id long, modele string, features string, seuil double")


COLS = ["request_id", "modele_utilise", "probabilite_de_quitter", "prediction", "libelle_prediction", "seuil_applique",
        "colonnes_utilisees", "prenom", "nom", "details"]


def _same(spark, models, **options):
    registry, coef = _tables(spark, models)
    reqs = _requests(spark, 700, models)
    ok, no = MT.predict_with_registry(reqs, registry, coef, proba_digits=9, **options)
    want_ok, want_no = predict_with_models(reqs, models_from_table(coef), proba_digits=9)
    scored = _plain(ok)
    assert {tuple(r) for r in scored} == {tuple(r) for r in _plain(want_ok)}
    got = {r.request_id: r._reason for r in no.collect()}
    assert got == {r.request_id: r._reason for r in want_no.collect()}
    assert len(scored) + len(got) == 700


def _plain(df):
    return df.select(*COLS).withColumn("colonnes_utilisees", F.array_join("colonnes_utilisees", ",")).collect()


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 2}, {"salts": 4}])
def test_equals_the_form_with_a_branch_per_model(spark, options):
    _same(spark, 12, **options)


def test_a_thousand_models_in_a_plan_of_fixed_length(spark):
    lengths = []
    for n in (3, 1000):
        registry, coef = _tables(spark, n)
        reqs = _requests(spark, 2000, n)
        ok, _ = MT.predict_with_registry(reqs, registry, coef, proba_digits=9)
        lengths.append(len(ok._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert lengths[0] == lengths[1]
    got = {r.request_id: r.probabilite_de_quitter for r in ok.collect()}
    weights = {}
    for r in coef.collect():
        weights.setdefault(r.model, {})[(r.feature, r.category)] = r.weight
    checked = 0
    for r in reqs.collect():
        if r.request_id in got and json.loads(r.features).get("k") == r.request_id % 100 and "k" in r.features:
            f, w, i = json.loads(r.features), weights[r.modele], int(r.modele[1:])
            z = w[("__intercept__", None)] + w[("k", None)] * (f["k"] - 50) / 29
            z += (w.get(("statut_marital", f["statut_marital"]), 0) if i % 2 else
                  0.3 * {"Frequent": 2, "2": 2, " rare ": 1}[f["frequence_deplacement"]])
            assert abs(got[r.request_id] - 1 / (1 + 2.718281828459045 ** -z)) < 1e-6
            checked += 1
    assert checked > 100


def test_layout_trial_per_row(spark):
    bundles = {
        "plain": _bundle(["k"]),
        "strict": _bundle(["k", "statut_marital"], ["statut_marital"], "error"),
        "lax": _bundle(["k", "statut_marital"], ["statut_marital"], "ignore"),
        # its text column is not among the one-hot roles: aligned gives it a code, mixed its text
        "other_role": _bundle(["k", "statut_marital"], ["heure_supplementaires"], "error"),
        "codes": _bundle(["k", "statut_marital"]),
        "scaled": _bundle(["k", "statut_marital"], ["statut_marital"], "error", scaler=True),
        "bare": _bundle(["k", "age"]),
        "dead": _bundle(["k"], predict=False),
    }
    rows = [(m, "k", None, 1.0, None, None) for m in bundles]
    rows += [(m, "statut_marital", "single", 2.0, None, None) for m in ("strict", "lax", "other_role", "scaled")]
    rows += [("codes", "statut_marital", None, 3.0, None, None)]
    registry = spark.createDataFrame(list(bundles.items()), "name string, metadata string")
    cases = [("plain", "single"), ("strict", "single"), ("strict", "married"), ("lax", "married"), ("other_role", "single"),
             ("other_role", "married"), ("codes", "married"), ("codes", "1"), ("scaled", "single"), ("bare", "single"),
             ("dead", "single"), ("strict", "alien"), ("codes", "")]
    reqs = spark.createDataFrame([(i, m, json.dumps({"k": 0.5, "statut_marital": s})) for i, (m, s) in enumerate(cases)],
                                 "request_id long, modele string, features string")
    ok, no = MT.predict_with_registry(reqs, registry, spark.createDataFrame(rows, COEF))
    got = {cases[r.request_id]: (r.format_entree, round(r.probabilite_de_quitter, 6)) for r in ok.collect()}

    def p(z):
        return round(1 / (1 + 2.718281828459045 ** -z), 6)

    assert got == {("plain", "single"): ("dataframe_aligne", p(0.5)), ("strict", "single"): ("dataframe_aligne", p(2.5)),
                   ("lax", "married"): ("dataframe_aligne", p(0.5)), ("other_role", "single"): ("dataframe_mixte", p(2.5)),
                   ("codes", "married"): ("dataframe_float64", p(3.5)), ("codes", "1"): ("dataframe_aligne", p(3.5)),
                   ("codes", ""): ("dataframe_float64", p(0.5))}
    why = {cases[r.request_id]: r._reason for r in no.collect()}
    assert why.pop(("strict", "alien")).startswith("unknown value for 'statut_marital': alien")
    assert why == {
        ("strict", "married"): "no layout fits. dataframe_aligne: unknown category 'married' of 'statut_marital' | "
                               "dataframe_mixte: unknown category 'married' of 'statut_marital' | "
                               "dataframe_float64: unknown category 1.0 of 'statut_marital'",
        ("other_role", "married"): "no layout fits. dataframe_aligne: unknown category 1.0 of 'statut_marital' | "
                                   "dataframe_mixte: unknown category 'married' of 'statut_marital' | "
                                   "dataframe_float64: unknown category 1.0 of 'statut_marital'",
        ("scaled", "single"): "no layout fits. dataframe_aligne: 'single' of 'statut_marital' is not a number | "
                              "dataframe_mixte: 'single' of 'statut_marital' is not a number | "
                              "dataframe_float64: unknown category 0.0 of 'statut_marital'",
        ("bare", "single"): "model_without_coefficients", ("dead", "single"): "unknown_model"}


def test_empty_tables(spark):
    registry, coef = _tables(spark, 2)
    reqs = _requests(spark, 20, 2)
    ok, no = MT.predict_with_registry(reqs.where("false"), registry, coef)
    assert ok.count() == no.count() == 0
    ok, no = MT.predict_with_registry(reqs, registry.where("false"), coef)
    assert ok.count() == 0 and no.count() == 20


def test_requests_are_joined_before_their_values_are_worked_out(spark):
    """The exchange of a large registry carries requests as they came, not what is made of them."""
    registry, coef = _tables(spark, 2)
    ok, no = MT.predict_with_registry(_requests(spark, 20, 2), registry, coef, max_broadcast=0)
    for df in (ok, no):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftOuter" in plan and "parseJson" in plan.split("LeftOuter")[0]
        assert "parseJson" not in plan.split("LeftOuter")[1]
