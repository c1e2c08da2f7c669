"""FE-1..7: derivation, encoding and layouts against the golden cases."""

import json

import pytest
from pyspark.sql import functions as F

from churnlane import schemas as S
from churnlane.operators import features as FE


def _json_values(spark, rows, keys):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, j string")
    return FE.with_json_values(df, "j", keys)


ENCODE = [
    ("heure_supplementaires", None, 0.0),
    ("heure_supplementaires", 1, 1.0),
    ("statut_marital", "Marié", 1.0),
    ("statut_marital", "mystere", None),
    ("statut_marital", " DIVORCÉ(E) ", 2.0),
    ("frequence_deplacement", "fréquent", 2.0),
    ("frequence_deplacement", "Travel_Rarely", 1.0),
    ("heure_supplementaires", True, 1.0),
    ("statut_marital", True, None),
    ("frequence_deplacement", "1.0", None),
    ("frequence_deplacement", 7, 7.0),
    ("statut_marital", "  ", None),
    ("statut_marital", "", 0.0),
]


@pytest.mark.parametrize("column,value,want", ENCODE)
def test_encode_json_values(spark, column, value, want):
    df, vals = _json_values(spark, [{column: value}], [column])
    code, unknown = FE.encode(column, vals[column])
    r = df.select(code.alias("c"), unknown.alias("u")).first()
    if want is None:
        assert r.u is True
    else:
        assert r.u is False and r.c == pytest.approx(want)


def test_encode_typed_column(spark):
    df = spark.createDataFrame([("Oui",), ("non",), (None,), ("peut-être",)], "heure_supplementaires string")
    x = FE.from_column(df, "heure_supplementaires")
    code, unknown = FE.encode("heure_supplementaires", x)
    rows = df.select(code.alias("c"), unknown.alias("u")).collect()
    assert [(r.c, r.u) for r in rows] == [(1.0, False), (0.0, False), (0.0, False), (None, True)]


def test_unknown_reason_lists_sorted_values(spark):
    df, vals = _json_values(spark, [{"statut_marital": "mystere"}], ["statut_marital"])
    reason = df.select(FE.unknown_reason("statut_marital", vals["statut_marital"]).alias("r")).first().r
    expected = ", ".join(sorted(S.CATEGORY_CODES["statut_marital"]))
    assert "mystere" in reason and expected in reason


DERIVE_KEYS = ["nb_formations_suivies", "annee_experience_totale", "formations_par_an",
               "niveau_hierarchique_poste", "niveau_education", "poste_x_niveau"]


@pytest.mark.parametrize("row,fpa,pxn", [
    ({"nb_formations_suivies": 2, "annee_experience_totale": 0, "formations_par_an": ""}, 0.0, 0.0),
    ({"nb_formations_suivies": 3, "annee_experience_totale": 10,
      "niveau_hierarchique_poste": 2, "niveau_education": 3}, 0.3, 6.0),
    ({"formations_par_an": "abc", "nb_formations_suivies": 3, "annee_experience_totale": 10}, 0.0, 0.0),
    ({"formations_par_an": 0, "nb_formations_suivies": 3, "annee_experience_totale": 10}, 0.0, 0.0),
    ({"nb_formations_suivies": "2", "annee_experience_totale": "4,0"}, 0.5, 0.0),
])
def test_derive(spark, row, fpa, pxn):
    df, vals = _json_values(spark, [row], DERIVE_KEYS)
    out = FE.derive(vals)
    r = df.select(out["formations_par_an"].num.alias("f"), out["poste_x_niveau"].num.alias("p")).first()
    assert (r.f, r.p) == (pytest.approx(fpa), pytest.approx(pxn))


def test_derive_is_idempotent(spark):
    df, vals = _json_values(spark, [{"nb_formations_suivies": 3, "annee_experience_totale": 10}],
                            DERIVE_KEYS)
    once = FE.derive(vals)
    twice = FE.derive(once)
    r = df.select(once["formations_par_an"].num.alias("a"), twice["formations_par_an"].num.alias("b")).first()
    assert r.a == r.b == pytest.approx(0.3)


def _layout(spark, row, layout, onehot=None, cols=("age", "statut_marital")):
    df, vals = _json_values(spark, [row], list(cols))
    return FE.prepare(df, vals, list(cols), layout, onehot).first()


def test_numeric_layout_order_and_values(spark):
    r = _layout(spark, {"age": 30, "statut_marital": "Célibataire"}, FE.NUMERIC_LAYOUT)
    assert list(r.asDict())[:2] == ["age", "statut_marital"]
    assert (r.age, r.statut_marital, r._reason) == (30.0, 0.0, None)


def test_mixed_layout_null_category_is_empty_text(spark):
    r = _layout(spark, {"age": 30, "statut_marital": None}, FE.MIXED_LAYOUT)
    assert r.statut_marital == ""


def test_aligned_layout_onehot_text_other_encoded(spark):
    r = _layout(spark, {"age": "3,5", "statut_marital": "Single"}, FE.ALIGNED_LAYOUT, ["statut_marital"])
    assert (r.age, r.statut_marital) == (3.5, "Single")
    r = _layout(spark, {"age": 3, "statut_marital": "Marié"}, FE.ALIGNED_LAYOUT, ["age"])
    assert (r.age, r.statut_marital) == ("3", 1.0)
    r = _layout(spark, {"age": 3, "statut_marital": "Marié"}, FE.ALIGNED_LAYOUT, [])
    assert r.statut_marital == "Marié"


def test_unknown_category_rejects_whatever_layout(spark):
    r = _layout(spark, {"age": 30, "statut_marital": "mystere"}, FE.ALIGNED_LAYOUT, ["statut_marital"])
    assert r._reason is not None and r.statut_marital == "mystere"


def test_absent_columns_default(spark):
    r = _layout(spark, {}, FE.MIXED_LAYOUT)
    assert (r.age, r.statut_marital) == (0.0, "")


def test_full_contract_example(spark):
    """The representative request: numeric layout in contract order."""
    features = {"age": 35, "revenu_mensuel": 5000, "annees_dans_l_entreprise": 5,
                "distance_domicile_travail": 10, "annes_sous_responsable_actuel": 2,
                "satisfaction_employee_environnement": 4, "niveau_hierarchique_poste": 2,
                "satisfaction_min": 2, "nb_formations_suivies": 2, "annee_experience_totale": 10,
                "niveau_education": 3, "statut_marital": "Célibataire",
                "frequence_deplacement": "Occasionnel", "heure_supplementaires": "Non"}
    keys = list(dict.fromkeys(S.MODEL_COLUMNS + DERIVE_KEYS))
    df, vals = _json_values(spark, [features], keys)
    r = FE.prepare(df, vals, S.MODEL_COLUMNS, FE.NUMERIC_LAYOUT).first()
    got = [r[c] for c in S.MODEL_COLUMNS]
    assert got == pytest.approx([35, 5000, 5, 10, 2, 4, 2, 2, 6, 0.2, 0, 1, 0, 0, 0])


def test_split_counts_are_conserved(spark):
    rows = [{"statut_marital": v} for v in ["single", "mystere", None, "married", "??"]]
    df, vals = _json_values(spark, rows, ["statut_marital"])
    prepared = FE.prepare(df, vals, ["statut_marital"], FE.NUMERIC_LAYOUT)
    ok, rejected = FE.split_ok_rejected(prepared)
    assert ok.count() + rejected.count() == df.count() == 5
    assert rejected.count() == 2


def test_impute_defaults(spark):
    df = spark.createDataFrame([(None, 1.0), (40, None)], "age int, formations_par_an double")
    rows = FE.impute_defaults(df).collect()
    assert [(r.age, r.formations_par_an) for r in rows] == [(36, 1.0), (40, 0.3)]
    assert F is not None


def _python_encode(column, value):
    """The encoding rule stated in Python: (code, rejected)."""
    if value is None or value == "":
        return 0.0, False
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return float(value), False
    code = S.CATEGORY_CODES[column].get(str(value).strip().lower())
    return (None, True) if code is None else (float(code), False)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_WORDS = sorted({w for codes in S.CATEGORY_CODES.values() for w in codes} | {"mystere", "Oui "})
_VALUES = st.one_of(
    st.none(), st.just(""), st.booleans(), st.integers(-3, 9), st.floats(-2, 5, allow_nan=False),
    st.tuples(st.sampled_from(_WORDS), st.sampled_from(["", " ", "\t", "  "]),
              st.sampled_from(["lower", "upper", "title"])).map(
        lambda t: t[1] + getattr(t[0], t[2])() + t[1]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(S.CATEGORICAL_COLUMNS), _VALUES), min_size=15, max_size=15))
def test_encode_matches_python_rule(spark, cases):
    rows = [(i, json.dumps({col: val})) for i, (col, val) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, j string")
    df, vals = FE.with_json_values(df, "j", S.CATEGORICAL_COLUMNS)
    exprs = []
    for col in S.CATEGORICAL_COLUMNS:
        code, unknown = FE.encode(col, vals[col])
        exprs += [code.alias(f"{col}_c"), unknown.alias(f"{col}_u")]
    got = {r.i: r for r in df.select("i", *exprs).collect()}
    for i, (col, val) in enumerate(cases):
        code, rejected = _python_encode(col, val)
        r = got[i]
        assert r[f"{col}_u"] == rejected, (col, val)
        if not rejected:
            assert r[f"{col}_c"] == pytest.approx(code), (col, val)
