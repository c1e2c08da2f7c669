"""SNK-1, JOI-3, FLT-1/2/5, SRT-1, LIM-2, AGG-2, PRJ-7: stored results."""

import json

from pyspark.sql import functions as F

from churnlane import schemas as S
from churnlane.operators import results as RS
from churnlane.operators.predict import as_results_rows, predict_requests
from churnlane.operators.scoring import LogisticModel

RESULT_COLS = ("id long, id_user long, prenom string, nom string, modele_utilise string, "
               "probabilite_de_quitter double, prediction int, libelle_prediction string, "
               "seuil_applique double, employe_id long, details string")


def _results(spark):
    rows = [
        (3, 1, "Alice", "Test", "top1", 0.8, 1, "Quitte", 0.37, None, None),
        (1, 1, "Jo", "Manuel", "top1", 0.4, 1, "Quitte", 0.37, None, '{"age": 41}'),
        (2, 1, "Jo", "Manuel", "top1", 0.4, 1, "Quitte", 0.37, None, None),
        (4, 1, "Jo", "Manuel", "top1", 0.4, 1, "Quitte", 0.37, 8, None),
        (5, 1, "Jo", "Manuel", "top1", 0.4, 1, "Quitte", 0.37, 9, None),
        (6, 2, "Bob", "Autre", "top1", 0.1, 0, "Reste", 0.37, None, ""),
    ]
    return spark.createDataFrame(rows, RESULT_COLS)


def _features(spark):
    return spark.createDataFrame([(8, 29, 3000.0)], "id long, age int, revenu_mensuel double")


def test_detail_sources(spark):
    det = {r.id: r for r in RS.detail(_results(spark), _features(spark)).collect()}
    assert det[1].source_features == S.FEATURES_FROM_JSON and json.loads(det[1].features) == {"age": 41}
    assert det[2].features == "{}" and det[6].features == "{}"
    assert det[4].source_features == S.FEATURES_FROM_TABLE
    assert json.loads(det[4].features) == {"age": 29, "revenu_mensuel": 3000.0}   # no id
    assert det[5].source_features == S.FEATURES_FROM_TABLE and det[5].features == "{}"
    assert "details" not in RS.detail(_results(spark), _features(spark)).columns


def test_detail_owner_scoping(spark):
    det = RS.detail(_results(spark), _features(spark), owner=2)
    assert [r.id for r in det.collect()] == [6]
    assert RS.detail(_results(spark), _features(spark), owner=3).count() == 0


def test_history_owner_order_and_filters(spark):
    res = _results(spark)
    assert RS.history(res, None).count() == 0
    ids = [r.id for r in RS.history(res, 1).collect()]
    assert ids == [5, 4, 3, 2, 1]
    assert [r.id for r in RS.history(res, 1, prenom=" alice ").collect()] == [3]
    assert [r.id for r in RS.history(res, 1, prenom="j_", nom="MAN%").collect()] == [5, 4, 2, 1]
    assert [r.id for r in RS.history(res, 1, prenom="").collect()] == ids
    assert "details" not in RS.history(res, 1).columns
    assert [r.id for r in RS.history(res, 1, limit=2).collect()] == [5, 4]
    assert RS.history(res, 1, prenom=" ").count() == 0            # " " -> ILIKE ''
    assert RS.history(res, 1, prenom="j_").count() == 4           # live wildcard
    assert RS.history(res, 1, prenom="j_", literal=True).count() == 0


def test_topk_and_counts(spark):
    res = _results(spark)
    top = RS.topk_per_owner(res, k=2).collect()
    assert sorted((r.id_user, r.id, r.position) for r in top) == [(1, 4, 2), (1, 5, 1), (2, 6, 1)]
    counts = {r.id_user: r.nb for r in RS.counts_per_owner(res).collect()}
    assert counts == {1: 5, 2: 1}


def test_display(spark):
    r = RS.display(_results(spark)).where(F.col("id") == 3).first()
    assert (r.nom_complet, r.risque, r.complement, r.probabilite_4) == ("Alice Test", "80.00%", "20.00%", 0.8)


def test_details_written_only_without_link(spark):
    df = spark.createDataFrame([('{"age": 41, "x": null}', None), ('{"age": 1}', 4), ('{"a": 2}', 0)],
                               "f string, e long")
    rows = df.select(RS.details_json(F.col("f"), F.col("e")).alias("d")).collect()
    assert json.loads(rows[0].d) == {"age": 41, "x": None}
    assert rows[1].d is None
    assert json.loads(rows[2].d) == {"a": 2}          # a link of 0 counts as no link on save


def test_append_assigns_dense_continuing_ids(spark, tmp_dir):
    path = f"{tmp_dir}/results"
    m = LogisticModel("top1", ["age"], intercept=0.0, weights={"age": 0.1})
    reqs = spark.createDataFrame(
        [(i, "top1", json.dumps({"age": i}), "" if i % 2 else "Ana", None, None if i % 3 else i, 7)
         for i in range(1, 21)],
        "request_id long, modele string, features string, prenom string, nom string, "
        "employe_id long, id_user long").repartition(3)
    scored, rejected = predict_requests(reqs, m)
    assert rejected.count() == 0
    RS.append_results(spark, path, as_results_rows(scored))
    RS.append_results(spark, path, as_results_rows(scored.limit(5)))
    back = RS.read_results(spark, path)
    ids = sorted(r.id for r in back.collect())
    assert ids == list(range(1, 26))
    names = {(r.prenom, r.nom) for r in back.collect()}
    assert names <= {("John", "Doe"), ("Ana", "Doe")}
    linked = back.where(F.col("employe_id").isNotNull())
    assert linked.where(F.col("details").isNotNull()).count() == 0
    assert back.where(F.col("employe_id").isNull() & F.col("details").isNull()).count() == 0


def test_predict_rejects_unknown_category(spark):
    m = LogisticModel("top1", ["age", "statut_marital"], intercept=0.0, weights={"age": 0.1})
    reqs = spark.createDataFrame([(1, json.dumps({"age": 3, "statut_marital": "mystere"})),
                                  (2, json.dumps({"age": 3, "statut_marital": "single"}))],
                                 "request_id long, features string")
    scored, rejected = predict_requests(reqs, m)
    assert [r.request_id for r in scored.collect()] == [2]
    assert [r.request_id for r in rejected.collect()] == [1]


def test_predict_with_models_per_request(spark):
    from churnlane.operators.predict import predict_with_models
    m1 = LogisticModel("a", ["age"], intercept=0.0, weights={"age": 1.0})
    m2 = LogisticModel("b", ["statut_marital"], intercept=0.0, onehot={"statut_marital": {"Single": 2.0}})
    reqs = spark.createDataFrame(
        [(1, "a", json.dumps({"age": 0})), (2, "b", json.dumps({"statut_marital": "Single"})),
         (3, "zz", json.dumps({"age": 0})), (4, "b", json.dumps({"statut_marital": "mystere"})),
         (5, None, "{}")],
        "request_id long, modele string, features string")
    scored, rejected = predict_with_models(reqs, {"a": m1, "b": m2})
    got = {r.request_id: (r.modele_utilise, round(r.probabilite_de_quitter, 6)) for r in scored.collect()}
    assert got == {1: ("a", 0.5), 2: ("b", round(1 / (1 + 2.718281828459045 ** -2), 6))}
    assert {(r.request_id, r.format_entree, *r.colonnes_utilisees) for r in scored.collect()} == {
        (1, "dataframe_float64", "age"), (2, "dataframe_aligne", "statut_marital")}
    reasons = {r.request_id: r._reason for r in rejected.collect()}
    assert reasons[3] == "unknown_model" and reasons[5] == "missing_model"
    assert reasons[4].startswith("unknown value for 'statut_marital'")


def test_predict_requests_uses_model_onehot_columns(spark):
    import math
    m = LogisticModel("top1", ["statut_marital", "heure_supplementaires"], intercept=0.0,
                      weights={"heure_supplementaires": 1.0},
                      onehot={"statut_marital": {"Single": 2.0}})
    reqs = spark.createDataFrame([(1, json.dumps({"statut_marital": "Single",
                                                  "heure_supplementaires": "Oui"}))],
                                 "request_id long, features string")
    scored, rejected = predict_requests(reqs, m)
    r = scored.first()
    # one-hot column kept as text (matches 'Single'), the other category encoded (Oui -> 1)
    assert r.probabilite_de_quitter == 1 / (1 + math.exp(-3.0)) and rejected.count() == 0


def test_save_route_defaults(spark):
    base = "modele_utilise string, probabilite_de_quitter double, prediction int, " \
           "libelle_prediction string, seuil_applique double"
    absent = spark.createDataFrame([("top1", 0.4, 1, "Quitte", 0.37)], base)
    r = RS.saved_rows(absent).first()
    assert (r.prenom, r.nom, r.employe_id, r.details) == ("John", "Doe", None, "{}")
    explicit = spark.createDataFrame([("top1", 0.4, 1, "Quitte", 0.37, None, "", 4, '{"a": 1}')],
                                     base + ", prenom string, nom string, employe_id long, features string")
    r = RS.saved_rows(explicit).first()
    assert (r.prenom, r.nom, r.employe_id, r.details) == (None, "", 4, None)


def test_feature_names_with_dots_and_quotes(spark):
    from churnlane.operators.predict import predict_with_models
    odd = 'say "it\'s"'
    m = LogisticModel("m", ["a.b", "it's", odd], intercept=-1.0,
                      weights={"a.b": 1.0, "it's": 1.0, odd: 1.0})
    reqs = spark.createDataFrame([(1, "m", json.dumps({"a.b": 1, "it's": 1, odd: 1, "a": {"b": 5}}))],
                                 "request_id long, modele string, features string")
    import math
    for scored in (predict_requests(reqs, m)[0], predict_with_models(reqs, {"m": m})[0]):
        assert scored.first().probabilite_de_quitter == 1 / (1 + math.exp(-2.0))


def test_old_root_files_and_appends_are_read_together(spark, tmp_dir):
    from pyspark.sql.types import StructType

    from churnlane import schemas as S
    path = f"{tmp_dir}/old"
    row = tuple(1 if f.name == "id" else None for f in S.RESULTS_SCHEMA.fields)
    spark.createDataFrame([row], S.RESULTS_SCHEMA).write.parquet(path)
    rows = spark.createDataFrame([row[1:]], StructType(S.RESULTS_SCHEMA.fields[1:]))
    assert RS.append_results(spark, path, rows) == 1
    assert RS.append_batch(spark, path, rows, "s-0") == 1
    assert RS.append_batch(spark, path, rows, "s-0") == 1      # replayed
    assert sorted(r.id for r in RS.read_results(spark, path).collect()) == [1, 2, 3]
