"""ML-4..9, JOI-8/9: registry resolution, contract lookup, roles."""

import json

from churnlane import schemas as S
from churnlane.operators import registry as R
from churnlane.plans import standins as SI


def _reg(spark, rows):
    return spark.createDataFrame([(n, json.dumps(m) if not isinstance(m, str) else m) for n, m in rows],
                                 "name string, metadata string")


def test_bundle_resolution_priorities(spark):
    reg = _reg(spark, [
        ("a", {"model": {"type": "LR", "predict": True}, "scaler": {"type": "SS", "transform": True},
               "columns": 12, "colonnes": ["age", "revenu_mensuel"], "threshold": 0.4}),
        ("b", {"clf": {"type": "LR", "predict": True}}),
        ("c", {"type": "LR", "predict": True, "feature_names_in_": ["x", "y"]}),
        ("d", {"scaler": {"type": "SS", "transform": True}}),
        ("e", {"weird": {"type": "LR", "predict": True}, "seuil": True}),
        ("f", {"pipeline": {"type": "P", "predict": True,
                            "steps": [{"type": "S"}, {"type": "T", "feature_names_in_": ["z"]}]},
               "best_threshold": 0.6}),
        ("g", "not json"),
        ("h", {"estimator": {"predict": True}, "colonnes": "ab", "threshold": "0.9"}),
        ("i", {"estimator": {"predict": True}, "columns": [], "features": {"u": 1, "v": 2}}),
        ("j", {"estimator": {"predict": True}, "columns": ["a", 3]}),
    ])
    got = {r.name: r for r in R.resolve(reg).collect()}
    a = got["a"]
    assert a.loaded and a.model_key == "model" and a.has_scaler and a.scaler_type == "SS"
    assert a.columns == ["age", "revenu_mensuel"] and a.threshold == 0.4
    b = got["b"]
    assert b.loaded and b.columns == S.MODEL_COLUMNS and b.threshold == 0.37 and not b.columns_extracted
    assert got["c"].columns == ["x", "y"] and got["c"].model_key is None
    assert not got["d"].loaded
    assert got["e"].loaded and got["e"].model_key == "weird" and got["e"].threshold == 1.0
    assert got["f"].columns == ["z"] and got["f"].threshold == 0.6
    assert not got["g"].loaded
    assert got["h"].columns == ["a", "b"] and got["h"].threshold == 0.37   # list("ab"); text is no number
    assert got["i"].columns == ["u", "v"]                                   # empty list skipped, dict keys
    assert got["j"].columns == S.MODEL_COLUMNS and not got["j"].columns_extracted


def test_contract_lookup_tags(spark):
    reqs = spark.createDataFrame([("top1",), ("top2",), ("top3",), ("nope",)], "modele string")
    rows = {r.modele: r for r in R.contract_for(reqs, spark.createDataFrame(
        SI.REGISTRY_ROWS, "name string, metadata string")).collect()}
    assert rows["top1"].colonnes == ["age", "revenu_mensuel"] and rows["top1"].seuil_modele == 0.4
    assert rows["top1"].source == S.SOURCE_EXTRACTED
    assert rows["top2"].colonnes == S.MODEL_COLUMNS and rows["top2"].source == S.SOURCE_EXTRACTED
    assert rows["nope"].colonnes == S.MODEL_COLUMNS and rows["nope"].source == S.SOURCE_NOT_LOADED
    assert rows["top3"].source == S.SOURCE_NOT_LOADED and rows["nope"].seuil_modele == 0.37


def test_unknown_model_split(spark):
    reqs = spark.createDataFrame([(1, "top1"), (2, "ghost"), (3, "top3")], "id int, modele string")
    known, rejected = R.split_known_model(reqs, spark.createDataFrame(
        SI.REGISTRY_ROWS, "name string, metadata string"))
    assert [r.id for r in known.collect()] == [1]
    assert sorted((r.id, r.reason) for r in rejected.collect()) == [(2, "unknown_model"),
                                                                    (3, "unknown_model")]


def test_roles_from_registry(spark):
    reg = spark.createDataFrame(SI.REGISTRY_ROWS, "name string, metadata string")
    rep = {r.role: r.colonnes for r in R.roles_report(R.branches_from_registry(reg)).collect()}
    assert rep == {"onehot": ["heure_supplementaires"], "numeriques": ["revenu_mensuel", "age", "x", "y"],
                   "autres": ["genre"]}


def test_roles_column_values_as_lists(spark):
    meta = {"model": {"predict": True, "transformers": [
        {"name": "s", "steps": ["StandardScaler"], "columns": "ab"},
        {"name": "d", "steps": ["StandardScaler"], "columns": "drop"},
        {"name": "n", "steps": ["OneHotEncoder"], "columns": None},
        {"name": "o", "steps": ["OneHotEncoder"], "columns": {"k": 1}}]}}
    reg = _reg(spark, [("m", meta)])
    rep = {r.role: r.colonnes for r in R.roles_report(R.branches_from_registry(reg)).collect()}
    assert rep == {"numeriques": ["a", "b"], "onehot": ["k"]}


def test_roles_keep_first_seen_order(spark):
    rows = [("m", ["StandardScaler"], "b", 3), ("m", ["StandardScaler"], "a", 5),
            ("m", ["StandardScaler"], "b", 9), ("m", ["MyOneHotThing"], "c", 1)]
    df = spark.createDataFrame(rows, "name string, steps array<string>, column string, pos long")
    rep = {r.role: r.colonnes for r in R.roles_report(df).collect()}
    assert rep == {"numeriques": ["b", "a"], "onehot": ["c"]}


def test_describe(spark):
    reg = spark.createDataFrame(SI.REGISTRY_ROWS, "name string, metadata string")
    d = R.describe(reg, "top1").first()
    assert d.type_model == "Pipeline" and d.a_scaler and d.nb_colonnes == 2
    assert d.seuil_sauvegarde == 0.4
    assert d.roles == {"onehot": ["heure_supplementaires"], "numeriques": ["revenu_mensuel", "age", "x", "y"],
                       "autres": ["genre"]}
    assert [tuple(x) for x in d.detail] == [
        ("overtime", ["MyOneHotThing"], ["heure_supplementaires"], None),
        ("pay", ["SimpleImputer", "FunctionTransformer"], ["revenu_mensuel", "age", "age"], "log1p"),
        ("inner", ["ColumnTransformer"], ["genre"], None), ("grade", ["RobustScaler"], ["x", "y"], None)]
    assert R.describe(reg, "top2").first().roles == {}
    assert R.describe(reg, "nope").count() == 0
