"""Score requests end to end (ML-2 / ML-3, SCA-15 / SCA-16, SNK-1 rows).

read requests -> parse features (VARIANT) -> derive -> align to the model's
contract (one layout per model) -> ok | rejected -> score -> threshold ->
label -> default names -> results rows.  One lazy plan; the same function
serves batch and streaming inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane import schemas as S
from churnlane.functions import clean
from churnlane.operators import features as FE
from churnlane.operators.results import details_json
from churnlane.operators.scoring import (LABEL, PREDICTION, PROBA, THRESHOLD, LogisticModel,
                                         binarise, label_text, score)

DERIVATION_INPUTS = ["annee_experience_totale", "nb_formations_suivies",
                     "niveau_education", "formations_par_an", "poste_x_niveau",
                     "niveau_hierarchique_poste"]


PROBLEM = "_request_problem"


def request_columns(requests: DataFrame) -> list[str]:
    return [c for c in requests.columns if c != "features"]


def predict_requests(requests: DataFrame, model: LogisticModel, features_col: str = "features",
                     onehot: list[str] | None = None,
                     proba_digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Return (scored rows, rejected rows) for JSON-feature requests.

    Every request is scored by ``model``; use :func:`predict_with_models`
    when requests name their model.  ``onehot`` overrides the model's own
    one-hot columns (the aligned layout's text columns).
    Absent optional fields take their defaults only when absent (SCA-16):
    ``seuil`` 0.37 (the request's threshold is the one applied, T11).
    Requests without a JSON object of features, with an explicit null
    threshold or with a value that is not finite are rejected, not scored.
    Names default to John / Doe when null or empty (SCA-15, predict path).
    """
    derived = {"formations_par_an", "poste_x_niveau"} & set(model.columns)
    keys = list(dict.fromkeys(model.columns + (DERIVATION_INPUTS if derived else [])))
    problem = FE.request_problem(requests, features_col)
    parsed, vals = FE.with_json_values(requests.withColumn(PROBLEM, problem), features_col, keys)
    keep = request_columns(requests) + [features_col]
    onehot = onehot if onehot is not None else (list(model.onehot) or None)
    prepared = FE.prepare(parsed, vals, model.columns, model.layout, onehot, keep=[*keep, PROBLEM])
    prepared = prepared.withColumn(FE.REASON, F.coalesce(PROBLEM, FE.REASON)).drop(PROBLEM)
    ok, rejected = FE.split_ok_rejected(prepared)
    seuil = F.coalesce(F.col("seuil"), F.lit(S.DEFAULT_THRESHOLD)) if "seuil" in requests.columns \
        else F.lit(S.DEFAULT_THRESHOLD)
    scored = score(ok, model, threshold=seuil, proba_digits=proba_digits).withColumns(_inputs(model))
    return _finish(scored, requests.columns, features_col), rejected


def _inputs(model: LogisticModel) -> dict:
    """ML-2: the columns a prediction used and their layout."""
    return {"colonnes_utilisees": F.array(*[F.lit(c) for c in model.columns]),
            "format_entree": F.lit(S.LAYOUT_NAMES[model.layout])}


def _finish(scored: DataFrame, request_cols: list[str], features_col: str) -> DataFrame:
    """Predict-path names (null or '' -> John / Doe) and the details JSON."""
    scored = scored.withColumns({
        "prenom": clean.falsy_default(F.col("prenom"), S.DEFAULT_FIRST_NAME)
        if "prenom" in request_cols else F.lit(S.DEFAULT_FIRST_NAME),
        "nom": clean.falsy_default(F.col("nom"), S.DEFAULT_LAST_NAME)
        if "nom" in request_cols else F.lit(S.DEFAULT_LAST_NAME),
    })
    link = F.col("employe_id") if "employe_id" in request_cols else F.lit(None).cast("long")
    return scored.withColumn("details", details_json(F.col(features_col), link))


def as_results_rows(scored: DataFrame) -> DataFrame:
    """The stored result columns (without the id, assigned at append)."""
    cols = [f.name for f in S.RESULTS_SCHEMA.fields if f.name != "id"]
    return scored.select(*[
        (F.col(c) if c in scored.columns else F.lit(None)).cast(S.RESULTS_SCHEMA[c].dataType).alias(c)
        for c in cols])


def predict_with_models(requests: DataFrame, models: dict[str, LogisticModel],
                        model_col: str = "modele", features_col: str = "features",
                        proba_digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """ML-2 / ML-3 / JOI-9 with the model named per request, in one pass.

    ``models`` is the loaded registry (bounded: one entry per model).  Each
    model's contract layout is computed under its own column names and the
    probability is a CASE over the model name, so the input is read once
    whatever the number of models.  Requests that cannot be scored are rejected
    with a reason (:func:`features.request_problem`), those naming no loaded
    model with ``unknown_model``; an unknown category or a value that is not
    finite rejects the request for the model it names.
    """
    needs_derived = any({"formations_par_an", "poste_x_niveau"} & set(m.columns)
                        for m in models.values())
    keys = list(dict.fromkeys([c for m in models.values() for c in m.columns]
                              + (DERIVATION_INPUTS if needs_derived else [])))
    problem = FE.request_problem(requests, features_col, model_col)
    parsed, vals = FE.with_json_values(requests.withColumn(PROBLEM, problem), features_col, keys)
    name = F.col(model_col)
    per_model, reasons, probas = [], [], []
    for i, (mname, m) in enumerate(models.items()):
        cols, reason = FE.layout_columns(vals, m.columns, m.layout, list(m.onehot) or None)
        per_model += [c.alias(f"_cl_m{i}_{j}") for j, c in enumerate(cols)]
        reasons.append((mname, reason))
        probas.append((mname, i, m))
    reason = F.when(F.col(PROBLEM).isNotNull(), F.col(PROBLEM)).when(~name.isin(*models), F.lit("unknown_model"))
    for mname, r in reasons:
        reason = reason.when(name == F.lit(mname), r)
    keep = request_columns(requests) + [features_col]
    staged = parsed.select(*[FE.qcol(c) for c in keep], *per_model, reason.alias(FE.REASON))
    ok = staged.where(F.col(FE.REASON).isNull())
    rejected = staged.where(F.col(FE.REASON).isNotNull()).select(*keep, FE.REASON)
    p = None
    for mname, i, m in probas:
        pos = {c: j for j, c in enumerate(m.columns)}
        branch = m.probability(lambda c, i=i, pos=pos: F.col(f"_cl_m{i}_{pos[c]}"))
        p = F.when(name == F.lit(mname), branch) if p is None else p.when(name == F.lit(mname), branch)
    seuil = F.coalesce(F.col("seuil"), F.lit(S.DEFAULT_THRESHOLD)) if "seuil" in requests.columns \
        else F.lit(S.DEFAULT_THRESHOLD)
    scored = ok.withColumns({"_cl_p": p, THRESHOLD: seuil.cast("double")})
    pred = binarise(F.col("_cl_p"), F.col(THRESHOLD))
    scored = scored.withColumns({
        "modele_utilise": name,
        PROBA: F.col("_cl_p") if proba_digits is None else F.round("_cl_p", proba_digits),
        PREDICTION: pred,
        LABEL: label_text(pred),
    })
    for out in ("colonnes_utilisees", "format_entree"):
        used = None
        for mname, _, m in probas:
            value = _inputs(m)[out]
            used = F.when(name == F.lit(mname), value) if used is None else used.when(name == F.lit(mname), value)
        scored = scored.withColumn(out, used)
    helper = [c for c in scored.columns if c.startswith("_cl_")] + [FE.REASON]
    return _finish(scored.drop(*helper), requests.columns, features_col), rejected
