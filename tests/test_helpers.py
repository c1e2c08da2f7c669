"""Small helpers: JSON rows, descriptive packing, key drop, evolution, strict parse."""

import json
import math

from pyspark.sql import functions as F

from churnlane.functions import clean
from churnlane.operators import directory as D
from churnlane.operators import features as FE
from churnlane.operators import results as RS
from churnlane.operators import scoring as SC
from churnlane.sources import sinks as SK


def test_as_json_rows_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "Élise", None)], "id long, prenom string, nom string")
    row = json.loads(RS.as_json_rows(df).first().json)
    assert row == {"id": 1, "prenom": "Élise", "nom": None}


def test_pack_descriptive_and_without_key(spark):
    df = spark.createDataFrame([(1, "F", "Sales")], "id long, genre string, departement string")
    packed = df.select(FE.pack_descriptive(["genre", "departement"]).alias("d")).first().d
    assert json.loads(packed) == {"genre": "F", "departement": "Sales"}
    assert D.without_key(df).columns == ["genre", "departement"]


def test_union_evolving_fills_new_columns(spark):
    old = spark.createDataFrame([(1, "a")], "id long, name string")
    new = spark.createDataFrame([(2, "b", 9)], "id long, name string, extra int")
    rows = sorted(SK.union_evolving(old, new).collect(), key=lambda r: r.id)
    assert [(r.id, r.extra) for r in rows] == [(1, None), (2, 9)]


def test_strict_float_gives_null_for_bad_text(spark):
    df = spark.createDataFrame([(" 2.5 ",), ("abc",), ("nan",)], "v string")
    got = [r.x for r in df.select(clean.strict_float("v").alias("x")).collect()]
    assert got[0] == 2.5 and got[1] is None and math.isnan(got[2])


def test_apply_function_is_a_column_expression(spark):
    df = spark.createDataFrame([(9.0,)], "x double")
    out = SC.apply_function(df, "x", F.sqrt, out="root")
    assert out.first().root == 3.0 and "BatchEvalPython" not in \
        out._jdf.queryExecution().executedPlan().toString()
