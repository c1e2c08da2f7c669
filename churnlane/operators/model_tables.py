"""Models as data: requests scored by joining them with tables of models.

JOI-9 / ML-2 / ML-4 for any number of models, and the layout trial of ML-1.

A registry bundle gives a model's contract, roles and options; a coefficient
table gives its weights.  Both become one row per model (:func:`model_table`)
that is joined to the requests by the model they name, so the plan has the
same length for one model and for a hundred thousand.

Trial of layouts.  Each request is laid out aligned, mixed and numeric, and the
first layout that its model can take is used:

* a feature with category weights takes text; a number there, or a text that is
  no category, is an unknown category: the layout fails when the bundle says
  ``"handle_unknown": "error"`` and counts nothing when it says ``"ignore"``;
* a feature with a plain weight takes numbers; a text there must parse as one;
* a model behind an external scaler takes numbers only.

A request that no layout fits is rejected with every layout's failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane import schemas as S
from churnlane.functions import clean
from churnlane.operators import features as FE
from churnlane.operators import registry as R
from churnlane.operators.joins import join_bounded, salted_join
from churnlane.operators.predict import DERIVATION_INPUTS, _finish, request_columns
from churnlane.operators.scoring import LABEL, PREDICTION, PROBA, THRESHOLD, binarise, label_text
from churnlane.session import cut_lineage

INTERCEPT, SAVED_THRESHOLD = "__intercept__", "__threshold__"
#: Models that may be broadcast (one row each); more are joined by a shuffle.
MAX_BROADCAST_MODELS = 10_000
LAYOUTS = (FE.ALIGNED_LAYOUT, FE.MIXED_LAYOUT, FE.NUMERIC_LAYOUT)

_ENTRY = "struct<kind:string,text:string,num:double,value:double,parsed:double>"


def model_table(registry: DataFrame, coefficients: DataFrame, unknown: str = "ignore") -> DataFrame:
    """One row per loaded model: name, columns, intercept, onehot, numbers_only, strict, terms, complete.

    ``registry``: (name, metadata) bundles, see :mod:`registry`.
    ``coefficients``: (model, feature, category, weight, center, scale) rows as
    for ``scoring.model_from_table``; a (model, feature, category) stands once.
    ``terms`` holds the contract's columns in order, each with its weight or its
    category weights; ``complete`` says that every column has one.  ``unknown``
    is what a bundle without ``handle_unknown`` does.  Everything is a join or
    an aggregate over model metadata; no row reaches the driver.
    """
    loaded = cut_lineage(R.loaded_models(registry).select(
        "name", "columns", F.col("has_scaler").alias("numbers_only"),
        (F.coalesce(F.try_variant_get("model", "$.handle_unknown", "string"), F.lit(unknown)) == "error").alias("strict")))
    roles = (R.roles_report(R.branches_from_registry(registry)).where(F.col("role") == "onehot")
             .select("name", F.col("colonnes").alias("onehot")))
    special = F.col("feature").isin(INTERCEPT, SAVED_THRESHOLD)
    plain = F.col("category").isNull()
    weights = (coefficients.where(~special).groupBy(F.col("model").alias("name"), "feature").agg(
        F.max(F.when(plain, F.col("weight").cast("double"))).alias("weight"),
        F.max(F.when(plain, F.col("center").cast("double"))).alias("center"),
        F.max(F.when(plain, F.col("scale").cast("double"))).alias("scale"),
        F.map_from_entries(F.collect_list(F.when(~plain, F.struct(
            "category", F.col("weight").cast("double"))))).alias("categories")))
    intercepts = (coefficients.where(F.col("feature") == INTERCEPT).groupBy(F.col("model").alias("name"))
                  .agg(F.max(F.col("weight").cast("double")).alias("intercept")))
    terms = (loaded.select("name", F.posexplode("columns").alias("place", "feature"))
             .join(weights, ["name", "feature"], "left").groupBy("name").agg(
        F.array_sort(F.collect_list(F.struct("place", "feature", "weight", "center", "scale", "categories")),
                     lambda a, b: a["place"] - b["place"]).alias("terms")))
    categorical = F.array(*map(F.lit, S.CATEGORICAL_COLUMNS))
    return (loaded.join(terms, "name").join(roles, "name", "left").join(intercepts, "name", "left").select(
        "name", "columns", F.coalesce("intercept", F.lit(0.0)).alias("intercept"),
        F.coalesce("onehot", categorical).alias("onehot"), "numbers_only", "strict", "terms",
        F.forall("terms", lambda t: t["weight"].isNotNull() | (F.coalesce(F.size(t["categories"]), F.lit(0)) > 0)).alias("complete")))


def _entries(parsed: Column) -> Column:
    """A JSON object's members as key -> (kind, text, number, lenient float, text as a number).

    Each step's values are made once per member for the next one, and a
    member's text, JSON text and number only where its kind asks for them.
    """
    members = F.try_variant_get(parsed, "$", "map<string,variant>")

    def typed(_, v):
        return F.struct(v.alias("v"), F.schema_of_variant(v).alias("typ"))

    def kinded(_, e):
        typ = e["typ"]
        kind = (F.when(e["v"].isNull() | typ.isin("VOID", "NULL"), F.lit(FE.NULL)).when(typ == "BOOLEAN", F.lit(FE.BOOL))
                .when(typ.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
                      | typ.startswith("DECIMAL"), F.lit(FE.NUMBER)).otherwise(F.lit(FE.STRING)))
        return F.struct(e["v"].alias("v"), kind.alias("kind"))

    def finished(_, e):
        v, kind = e["v"], e["kind"]
        text = F.try_variant_get(v, "$", "string")
        text = (F.when(kind == FE.BOOL, F.initcap(text))
                .when(kind == FE.STRING, F.coalesce(text, F.to_json(v))).when(kind == FE.NUMBER, text))
        num = F.when(kind.isin(FE.NUMBER, FE.BOOL), F.try_variant_get(v, "$", "double"))
        return F.struct(kind.alias("kind"), text.alias("text"), num.alias("num"))

    def valued(_, e):
        number = (F.when(e["kind"].isin(FE.NUMBER, FE.BOOL), e["num"])
                  .when((e["kind"] == FE.STRING) & (e["text"] != ""), clean.text_number(e["text"])))
        return F.struct(e["kind"].alias("kind"), e["text"].alias("text"), e["num"].alias("num"), number.alias("number"))

    def parsed_(_, e):
        # a text that is no number counts as 0 (the lenient float) and has no parsed number
        kind, number = e["kind"], e["number"]
        value = F.when(kind.isin(FE.NUMBER, FE.BOOL), number).otherwise(F.coalesce(number, F.lit(0.0)))
        finite = F.when(number == 0, F.lit(0.0)).when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
        return F.struct(kind.alias("kind"), e["text"].alias("text"), e["num"].alias("num"), value.alias("value"),
                        F.when(kind.isin(FE.NUMBER, FE.STRING), finite).alias("parsed"))

    whole = members
    for step in (typed, kinded, finished, valued, parsed_):
        whole = F.transform_values(whole, step)
    return F.coalesce(whole, F.create_map().cast(f"map<string,{_ENTRY}>"))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row: no filter is pushed below and repeats them."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def _contract_values(df: DataFrame) -> DataFrame:
    """Add what every contract needs from ``_cl_e``: derived numbers, category codes, unknown values.

    The members are looked up once, in steps of their own, so that the code
    generated for a step stays small enough for the JVM to compile.
    """
    def found(prefix: str, keys: list[str]) -> dict[str, Column]:
        return {f"{prefix}{i}": F.try_element_at(F.col("_cl_e"), F.lit(k)) for i, k in enumerate(keys)}

    keep = df.columns
    blank, out = F.lit(FE.NULL), _once(df, **found("_cl_n", DERIVATION_INPUTS))

    def number(e: Column) -> Column:
        empty = F.coalesce(e["kind"], blank).isin(FE.NULL) | ((e["kind"] == FE.STRING) & (e["text"] == ""))
        return F.when(~empty, e["value"])

    out = _once(out.select(*map(FE.qcol, keep), *(number(F.col(f"_cl_n{i}")).alias(f"_cl_n{i}")
                                                   for i in range(len(DERIVATION_INPUTS)))),
                **found("_cl_c", S.CATEGORICAL_COLUMNS))
    vals = FE.derive({k: FE.Value.number(F.col(f"_cl_n{i}")) for i, k in enumerate(DERIVATION_INPUTS)})
    derived = [x for k in ("formations_par_an", "poste_x_niveau") for x in (F.lit(k), vals[k].num)]
    out = _once(out, _cl_derived=F.create_map(*derived))
    codes, reasons = [], []
    for i, k in enumerate(S.CATEGORICAL_COLUMNS):
        e = F.col(f"_cl_c{i}")
        x = FE.Value(F.coalesce(e["kind"], blank), e["text"], e["num"])
        code, unknown = FE.encode(k, x)
        out = _once(out, **{f"_cl_code{i}": code})
        codes += [F.lit(k), F.col(f"_cl_code{i}")]
        # the code of a number and of a known text is there; a text without one is unknown
        unknown = ~FE.is_blank(x) & (x.kind != FE.NUMBER) & F.col(f"_cl_code{i}").isNull()
        reasons += [F.lit(k), F.when(unknown, FE.unknown_reason(k, x))]
    out = _once(out, _cl_codes=F.create_map(*codes), _cl_unknown=F.create_map(*reasons))
    return out.select(*map(FE.qcol, keep), "_cl_derived", "_cl_codes", "_cl_unknown")


def _taken(t: Column, as_text: Column, number: Column, text: Column, parsed: Column) -> Column:
    """(z, fail) of one feature in one layout; ``parsed`` is the text as a number, if it is one."""
    x = F.when(as_text, parsed).otherwise(number)
    scaled = F.when(t["center"].isNotNull() & t["scale"].isNotNull(), (x - t["center"]) / t["scale"]).otherwise(x)
    shown = F.when(as_text, F.concat(F.lit("'"), text, F.lit("'"))).otherwise(number.cast("string"))
    no_number = F.concat(shown, F.lit(" of '"), t["feature"], F.lit("' is not a number"))
    category = F.when(as_text & ~F.col("numbers_only"), F.try_element_at(t["categories"], text))
    wants_text = F.size(t["categories"]) > 0
    must_be_number = ~wants_text | F.col("numbers_only")
    z = F.when(wants_text, F.coalesce(category, F.lit(0.0))).otherwise(t["weight"] * scaled)
    fail = (F.when(must_be_number & as_text & parsed.isNull(), no_number)
            .when(wants_text & category.isNull() & F.col("strict"),
                  F.concat(F.lit("unknown category "), shown, F.lit(" of '"), t["feature"], F.lit("'"))))
    return F.struct(z.alias("z"), fail.alias("fail"))


def _looked_up(t: Column) -> Column:
    """A feature of the contract with what the request has for it."""
    name = t["feature"]
    return F.struct(t.alias("t"), F.try_element_at(F.col("_cl_e"), name).alias("e"),
                    F.try_element_at(F.col("_cl_derived"), name).alias("derived"),
                    F.try_element_at(F.col("_cl_codes"), name).alias("code"),
                    F.try_element_at(F.col("_cl_unknown"), name).alias("unknown"),
                    name.isin(*S.CATEGORICAL_COLUMNS).alias("categorical"),
                    F.array_contains(F.col("onehot"), name).alias("onehot"))


def _valued(x: Column) -> Column:
    """Its number, its text and its text as a number."""
    return F.struct(x["t"].alias("t"), F.coalesce(x["derived"], x["code"], x["e"]["value"], F.lit(0.0)).alias("number"),
                    F.coalesce(x["derived"].cast("string"), x["e"]["text"], F.lit("")).alias("text"),
                    F.coalesce(x["derived"], x["e"]["parsed"]).alias("parsed"),
                    *(x[c].alias(c) for c in ("unknown", "categorical", "onehot")))


def _term(x: Column) -> Column:
    """One feature of the contract in the three layouts, and why the row cannot be laid out at all."""
    name, number = x["t"]["feature"], x["number"]
    reason = F.coalesce(x["unknown"], F.when(
        ~x["categorical"] & ~x["onehot"] & (F.isnan(number) | (F.abs(number) == float("inf"))),
        F.concat(F.lit("value of '"), name, F.lit("' is not finite"))))
    as_text = {FE.ALIGNED_LAYOUT: x["onehot"], FE.MIXED_LAYOUT: x["categorical"], FE.NUMERIC_LAYOUT: F.lit(False)}
    return F.struct(*(_taken(x["t"], as_text[layout], number, x["text"], x["parsed"]).alias(layout) for layout in LAYOUTS),
                    reason.alias("reason"))


def predict_with_registry(requests: DataFrame, registry: DataFrame, coefficients: DataFrame,
                          model_col: str = "modele", features_col: str = "features", unknown: str = "ignore",
                          proba_digits: int | None = None, max_broadcast: int = MAX_BROADCAST_MODELS,
                          salts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored rows, rejected rows) of requests that name their model; all models are data.

    Scored rows have the columns of ``predict.predict_with_models``; here
    ``format_entree`` is the layout that the request's own values allowed.
    Rejected rows keep the request and its reason: what makes it unscorable
    (``features.request_problem``), ``unknown_model``, ``model_without_coefficients``,
    an unknown category or a value that is not finite, or the failures of all
    three layouts.  Every request is in exactly one of the two outputs.

    Up to ``max_broadcast`` models are broadcast and no request is shuffled;
    beyond, requests and models are joined by a shuffle, in which ``salts``
    spreads the models that many requests name.
    """
    models = cut_lineage(model_table(registry, coefficients, unknown).withColumnRenamed("name", "_cl_name"))
    keep = [*request_columns(requests), features_col]
    problem = FE.request_problem(requests, features_col, model_col, F.col("_cl_v"))
    # joined as they come: the values that are worked out of a request are many times its size
    rows = requests.select(*map(FE.qcol, keep)).withColumn("_cl_model", FE.qcol(model_col))
    if salts:
        joined = salted_join(rows, models, "_cl_model", "_cl_name", "left", salts=salts)
    else:
        joined = join_bounded(rows, models.withColumnRenamed("_cl_name", "_cl_model").withColumn("_cl_name", F.col("_cl_model")),
                              "_cl_model", "left", max_rows=max_broadcast)
    joined = _once(joined, _cl_v=F.try_parse_json(FE.qcol(features_col)))
    joined = _contract_values(_once(joined, _cl_e=_entries(F.col("_cl_v")), _cl_problem=problem).drop("_cl_v"))
    terms = _once(joined, _cl_t=F.transform(F.transform(F.transform("terms", _looked_up), _valued), _term))

    def total(layout: str) -> Column:
        return F.aggregate(F.transform("_cl_t", lambda t: t[layout]["z"]), F.col("intercept"), lambda a, z: a + z)

    def failure(layout: str) -> Column:
        return F.get(F.filter(F.transform("_cl_t", lambda t: t[layout]["fail"]), lambda x: x.isNotNull()), 0)

    bad = F.get(F.filter(F.transform("_cl_t", lambda t: t["reason"]), lambda x: x.isNotNull()), 0)
    tried = _once(terms, _cl_bad=bad, **{f"_cl_f_{layout}": failure(layout) for layout in LAYOUTS},
                  **{f"_cl_z_{layout}": total(layout) for layout in LAYOUTS})
    fits = None
    for layout in LAYOUTS:
        hit = F.col(f"_cl_f_{layout}").isNull()
        fits = F.when(hit, F.lit(layout)) if fits is None else fits.when(hit, F.lit(layout))
    failures = F.concat(F.lit("no layout fits. "), F.concat_ws(" | ", *(
        F.concat(F.lit(f"{S.LAYOUT_NAMES[layout]}: "), F.col(f"_cl_f_{layout}")) for layout in LAYOUTS)))
    reason = (F.when(F.col("_cl_problem").isNotNull(), F.col("_cl_problem"))
              .when(F.col("_cl_name").isNull(), F.lit("unknown_model"))
              .when(~F.col("complete"), F.lit("model_without_coefficients"))
              .when(F.col("_cl_bad").isNotNull(), F.col("_cl_bad"))
              .when(fits.isNull(), failures))
    judged = _once(tried, _cl_layout=fits, _cl_reason=reason)
    rejected = judged.where(F.col("_cl_reason").isNotNull()).select(*map(FE.qcol, keep), F.col("_cl_reason").alias(FE.REASON))
    z = F.coalesce(*(F.when(F.col("_cl_layout") == layout, F.col(f"_cl_z_{layout}")) for layout in LAYOUTS))
    seuil = F.coalesce(F.col("seuil"), F.lit(S.DEFAULT_THRESHOLD)) if "seuil" in requests.columns \
        else F.lit(S.DEFAULT_THRESHOLD)
    names = F.create_map(*(F.lit(x) for layout in LAYOUTS for x in (layout, S.LAYOUT_NAMES[layout])))
    scored = judged.where(F.col("_cl_reason").isNull()).withColumn("_cl_p", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    scored = scored.withColumn(THRESHOLD, seuil.cast("double"))
    pred = binarise(F.col("_cl_p"), F.col(THRESHOLD))
    scored = scored.select(
        *map(FE.qcol, keep), THRESHOLD, F.col("_cl_name").alias("modele_utilise"),
        (F.col("_cl_p") if proba_digits is None else F.round("_cl_p", proba_digits)).alias(PROBA),
        pred.alias(PREDICTION), label_text(pred).alias(LABEL), F.col("columns").alias("colonnes_utilisees"),
        F.try_element_at(names, F.col("_cl_layout")).alias("format_entree"))
    return _finish(scored, requests.columns, features_col), rejected
