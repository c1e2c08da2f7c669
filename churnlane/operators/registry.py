"""Model registry: metadata resolution, contract lookup, roles, describe.

ML-4 load, ML-5 resolve bundle fields by key priority (SCA-22), ML-6 contract
+ threshold + provenance tag (JOI-8), ML-7 describe, ML-8 column roles
(AGG-3 ordered distinct, AGG-4 group by role), ML-9 expected feature names,
JOI-9 / ML-10 unknown model -> rejected.

A registry is a DataFrame ``(name string, metadata string)`` where metadata
is the JSON description of a saved model bundle, for example::

    {"model": {"type": "LogisticRegression", "predict": true,
               "feature_names_in_": ["age", "revenu_mensuel"],
               "transformers": [{"name": "num", "steps": ["StandardScaler"],
                                 "columns": ["age"]}]},
     "scaler": {"type": "StandardScaler", "transform": true},
     "colonnes": ["age", "revenu_mensuel"], "threshold": 0.4}

or a direct estimator ``{"type": ..., "predict": true, ...}``.  Resolution
is a single select of column expressions over the registry rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane import schemas as S
from churnlane.operators.joins import join_bounded
from churnlane.session import cut_lineage

MAX_MODELS = 10_000


def _field(meta: Column, key: str) -> Column:
    return F.try_variant_get(meta, f"$.{key}", "variant")


def _is_true(v: Column, key: str) -> Column:
    return F.coalesce(F.try_variant_get(v, f"$.{key}", "boolean"), F.lit(False))


def _as_list(v: Column) -> tuple[Column, Column]:
    """``list(value)`` of a JSON value, as (array<string>, all items were strings).

    A list gives its items, a string its characters, an object its keys;
    anything else (number, boolean, null) is not iterable and gives null.
    """
    typ = F.schema_of_variant(v)
    arr = F.try_variant_get(v, "$", "array<variant>")
    items = (F.when(typ.startswith("ARRAY"), F.try_variant_get(v, "$", "array<string>"))
             .when(typ == "STRING", F.split(F.try_variant_get(v, "$", "string"), ""))
             .when(typ.startswith("OBJECT"), F.json_object_keys(F.to_json(v))))
    all_str = (F.when(typ.startswith("ARRAY"),
                      F.forall(arr, lambda e: F.schema_of_variant(e) == F.lit("STRING")))
               .otherwise(items.isNotNull()))
    return items, all_str


def _string_list(v: Column) -> Column:
    """The value's ``list()`` when non-empty and made of strings, else null."""
    items, all_str = _as_list(v)
    return F.when(items.isNotNull() & (F.size(items) > 0) & all_str, items)


def _number(v: Column) -> Column:
    """A JSON number or boolean as double (isinstance(x, (int, float)))."""
    typ = F.schema_of_variant(v)
    ok = typ.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$")
    return F.when(ok, F.try_variant_get(v, "$", "double"))


def _members(v: Column) -> Column:
    """An object's members by key, whatever characters the keys hold (null for other values)."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def resolve(registry: DataFrame, name_col: str = "name", meta_col: str = "metadata") -> DataFrame:
    """ML-4 / ML-5 / ML-9: one row per registry entry with resolved fields.

    Output: name, loaded (a predictor was found), model (variant), model_key,
    has_scaler, scaler_type, columns (array<string>, defaults applied),
    columns_extracted, threshold (default applied), threshold_saved.
    """
    meta = F.try_parse_json(F.col(meta_col))
    direct = _is_true(meta, "predict")
    named = F.coalesce(*[F.when(_is_true(_field(meta, k), "predict"), F.lit(k))
                         for k in S.MODEL_KEYS])
    # Introspection fallback: first key, in document order, holding a predictor.
    any_key = F.get(F.filter(F.json_object_keys(F.col(meta_col)), lambda k: F.coalesce(
        F.lower(F.to_json(F.try_variant_get(F.try_element_at(_members(meta), k), "$.predict", "variant"))) == "true",
        F.lit(False))), 0)
    model_key = F.when(direct, F.lit(None).cast("string")).otherwise(F.coalesce(named, any_key))
    df = registry.select(F.col(name_col).alias("name"), F.col(meta_col).alias("_text"),
                         meta.alias("_meta"), direct.alias("_direct"),
                         model_key.alias("model_key"))
    m = F.col("_meta")
    df = df.withColumn("model", F.when(F.col("_direct"), m).otherwise(
        F.try_element_at(_members(m), F.col("model_key"))))
    scaler_key = F.coalesce(*[
        F.when(_is_true(_field(m, k), "transform") & F.coalesce(
            F.col("model_key") != F.lit(k), F.lit(True)), F.lit(k))
        for k in S.SCALER_KEYS])
    scaler_key = F.when(F.col("_direct"), F.lit(None).cast("string")).otherwise(scaler_key)
    listed = F.coalesce(*[_string_list(_field(m, k)) for k in S.COLUMN_KEYS])
    listed = F.when(F.col("_direct"), F.lit(None).cast("array<string>")).otherwise(listed)
    cols = F.coalesce(listed, _model_feature_names(F.col("model")))
    threshold_saved = F.when(F.col("_direct"), F.lit(None).cast("double")).otherwise(
        F.coalesce(*[_number(_field(m, k)) for k in S.THRESHOLD_KEYS]))
    return df.select(
        "name",
        (F.col("_direct") | F.col("model_key").isNotNull()).alias("loaded"),
        "model", "model_key",
        scaler_key.isNotNull().alias("has_scaler"),
        F.try_variant_get(F.try_element_at(_members(m), scaler_key), "$.type", "string").alias("scaler_type"),
        F.coalesce(cols, _default_columns()).alias("columns"),
        cols.isNotNull().alias("columns_extracted"),
        F.coalesce(threshold_saved, F.lit(S.DEFAULT_THRESHOLD)).alias("threshold"),
        threshold_saved.alias("threshold_saved"),
    )


def _model_feature_names(model: Column) -> Column:
    """ML-9: the estimator's own names, else the first step that has them."""
    own = _string_list(F.try_variant_get(model, "$.feature_names_in_", "variant"))
    steps = F.try_variant_get(model, "$.steps", "array<variant>")
    step_names = F.transform(steps, lambda s: _string_list(
        F.try_variant_get(s, "$.feature_names_in_", "variant")))
    first_step = F.get(F.filter(step_names, lambda a: a.isNotNull()), 0)
    return F.coalesce(own, first_step)


def _default_columns() -> Column:
    return F.array(*[F.lit(c) for c in S.MODEL_COLUMNS])


def loaded_models(registry: DataFrame) -> DataFrame:
    """ML-4: entries that resolved to a predictor (unreadable ones skipped)."""
    return resolve(registry).where(F.col("loaded"))


def contract_for(requests: DataFrame, registry: DataFrame, model_col: str = "modele") -> DataFrame:
    """ML-6 / JOI-8: columns, threshold and provenance tag per request.

    Unknown model -> the 15 default columns, 0.37, 'defaut_modele_non_charge'.
    The registry (one row per model) is broadcast after a size check.
    """
    reg = loaded_models(registry).select(
        F.col("name").alias(model_col), F.col("columns").alias("_cols"),
        F.col("threshold").alias("_thr"), F.lit(True).alias("_known"))
    j = join_bounded(requests, reg, model_col, "left", max_rows=MAX_MODELS)
    known = F.coalesce(F.col("_known"), F.lit(False))
    cols = F.when(known & (F.size("_cols") > 0), F.col("_cols")).otherwise(_default_columns())
    tag = (F.when(~known, F.lit(S.SOURCE_NOT_LOADED))
           .when(F.size("_cols") > 0, F.lit(S.SOURCE_EXTRACTED))
           .otherwise(F.lit(S.SOURCE_EXTRACTION_FAILED)))
    thr = F.when(known, F.coalesce("_thr", F.lit(S.DEFAULT_THRESHOLD))).otherwise(
        F.lit(S.DEFAULT_THRESHOLD))
    return j.withColumns({"colonnes": cols, "source": tag, "seuil_modele": thr}).drop(
        "_cols", "_thr", "_known")


def split_known_model(requests: DataFrame, registry: DataFrame,
                      model_col: str = "modele") -> tuple[DataFrame, DataFrame]:
    """JOI-9 / ML-10: (requests with a loaded model, rejected with reason)."""
    names = loaded_models(registry).select(F.col("name").alias(model_col))
    known = join_bounded(requests, names, model_col, "left_semi", max_rows=MAX_MODELS)
    rejected = join_bounded(requests, names, model_col, "left_anti", max_rows=MAX_MODELS) \
        .withColumn("reason", F.lit("unknown_model"))
    return known, rejected


def describe(registry: DataFrame, model: str) -> DataFrame:
    """ML-7: inspection summary of one model (empty when not loaded).

    Includes ``roles``: role -> columns in first-seen order (ML-8; at most
    three roles), and ``detail``: each branch with its steps, columns and
    function text, in order of appearance.
    """
    loaded = loaded_models(registry).where(F.col("name") == model)
    roles = (roles_report(branches_from_registry(registry.where(F.col("name") == model)))
             .groupBy("name").agg(F.map_from_entries(F.collect_list(
                 F.struct("role", "colonnes"))).alias("roles")))
    detail = (branch_details(registry.where(F.col("name") == model)).groupBy("name").agg(
        F.array_sort(F.collect_list(F.struct("place", "branch", "steps", "columns", "function"))).alias("_d")))
    detail = detail.select("name", F.transform("_d", lambda d: F.struct(
        d["branch"].alias("branche"), d["steps"].alias("etapes"), d["columns"].alias("colonnes"),
        d["function"].alias("function_transformer"))).alias("detail"))
    return (loaded.join(roles, "name", "left").join(detail, "name", "left").select(
        "name", F.try_variant_get("model", "$.type", "string").alias("type_model"),
        F.col("has_scaler").alias("a_scaler"), "scaler_type",
        F.size("columns").alias("nb_colonnes"), F.col("columns").alias("colonnes"),
        F.col("threshold_saved").alias("seuil_sauvegarde"),
        F.coalesce("roles", F.create_map().cast("map<string,array<string>>")).alias("roles"), "detail"))


# ---------------------------------------------------------------- ML-8 roles

def branch_role(steps: Column) -> Column:
    """Role of a preprocessing branch from its step type names."""
    is_onehot = F.exists(steps, lambda s: s.contains(S.ONEHOT_MARKER))
    is_numeric = F.exists(steps, lambda s: s.isin(*S.NUMERIC_STEPS))
    return (F.when(is_onehot, F.lit("onehot")).when(is_numeric, F.lit("numeriques"))
            .otherwise(F.lit("autres")))


def roles_report(branches: DataFrame, model_col: str = "name", steps_col: str = "steps",
                 column_col: str = "column", pos_col: str = "pos") -> DataFrame:
    """ML-8 + AGG-3 + AGG-4 over an exploded branch table.

    ``branches``: one row per (model, branch step list, column, position).
    Per model and role: distinct columns in first-seen order.  The distinct
    step runs as a partial aggregate first, so a hot role never collects
    more than its distinct columns.
    """
    tagged = branches.select(model_col, branch_role(F.col(steps_col)).alias("role"),
                             F.col(column_col).alias("column"), F.col(pos_col).alias("pos"))
    firsts = tagged.groupBy(model_col, "role", "column").agg(F.min("pos").alias("first_pos"))
    ordered = firsts.groupBy(model_col, "role").agg(
        F.array_sort(F.collect_list(F.struct("first_pos", "column"))).alias("_s"))
    return ordered.select(model_col, "role",
                          F.transform("_s", lambda s: s["column"]).alias("colonnes"),
                          F.size("_s").alias("nb_colonnes"))


def _nodes(registry: DataFrame) -> DataFrame:
    """(name, path, node): every object inside a loaded model, parents before children.

    Children are the objects among an object's ``steps`` and the
    ``transformer`` of each entry of its ``transformers``; models nest as deep
    as they like.  Each level is kept (checkpoint of model metadata), so the
    next one does not parse the bundles again.
    """
    level = cut_lineage(resolve(registry).where(F.col("loaded")).select(
        "name", F.array().cast("array<int>").alias("path"), F.col("model").alias("node")))
    found = level
    while True:
        steps = F.transform(F.try_variant_get("node", "$.steps", "array<variant>"),
                            lambda v, i: F.struct(F.array(F.lit(0), i).alias("at"), v.alias("node")))
        inner = F.transform(F.try_variant_get("node", "$.transformers", "array<variant>"),
                            lambda v, i: F.struct(F.array(F.lit(1), i).alias("at"),
                                                  F.try_variant_get(v, "$.transformer", "variant").alias("node")))
        none = F.array().cast("array<struct<at:array<int>,node:variant>>")
        below = level.select("name", "path", F.explode(F.concat(
            F.coalesce(steps, none), F.coalesce(inner, none))).alias("c"))
        level = cut_lineage(below.select("name", F.concat("path", "c.at").alias("path"), F.col("c.node").alias("node"))
                            .where(F.schema_of_variant("node").startswith("OBJECT")))
        if level.isEmpty():
            return found
        found = found.unionByName(level)


def branch_details(registry: DataFrame) -> DataFrame:
    """One row per branch of every column transformer inside a model, nested ones too.

    Columns: name, place (order of appearance), branch, steps (type names),
    columns, function (text of a function transformer).  Branches whose
    columns are null, "remainder" or "drop", or not iterable, are skipped;
    other values are taken as ``list(value)``.
    """
    ex = _nodes(registry).select("name", "path", F.posexplode(
        F.try_variant_get("node", "$.transformers", "array<variant>")).alias("bpos", "b"))
    cols_v = F.try_variant_get("b", "$.columns", "variant")
    items, _ = _as_list(cols_v)
    as_text = F.try_variant_get(cols_v, "$", "string")
    skipped = as_text.isin("remainder", "drop") & (F.schema_of_variant(cols_v) == "STRING")
    # a branch lists its steps, or holds a transformer (a pipeline with steps, or a single one)
    held = F.try_variant_get("b", "$.transformer", "variant")
    steps = F.coalesce(F.try_variant_get("b", "$.steps", "array<variant>"),
                       F.try_variant_get(held, "$.steps", "array<variant>"),
                       F.when(held.isNotNull(), F.array(held)), F.array().cast("array<variant>"))

    def type_name(v: Column) -> Column:
        return F.coalesce(F.try_variant_get(v, "$.type", "string"), F.try_variant_get(v, "$", "string"))

    functions = F.transform(F.filter(steps, lambda v: type_name(v) == "FunctionTransformer"),
                            lambda v: F.try_variant_get(v, "$.func", "string"))
    return (ex.select("name", F.struct("path", "bpos").alias("place"),
                      F.try_variant_get("b", "$.name", "string").alias("branch"),
                      F.transform(steps, type_name).alias("steps"),
                      F.when(~F.coalesce(skipped, F.lit(False)), items).alias("columns"),
                      F.coalesce(F.try_variant_get("b", "$.func", "string"),
                                 F.try_element_at(functions, F.lit(-1))).alias("function"))
            .where(F.col("columns").isNotNull()))


def branches_from_registry(registry: DataFrame) -> DataFrame:
    """The branch table of :func:`roles_report`: one row per branch and column."""
    return (branch_details(registry)
            .select("name", "branch", "steps", "place", F.posexplode("columns").alias("cpos", "column"))
            .select("name", "branch", "steps", "column", F.struct("place", "cpos").alias("pos")))
