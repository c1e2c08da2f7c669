"""Registered queries over the driver's tables (see ``standins``).

Each function takes (spark, sf_dir) and returns a DataFrame whose column
names match the oracle SQL in ``oracle.py``.  Every query reads whole tables;
limits appear only where the limit is the feature (per-owner top-k).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.functions import clean
from churnlane.operators import directory as D
from churnlane.operators import features as FE
from churnlane.operators import governance as G
from churnlane.operators import model_tables as MT
from churnlane.operators import registry as R
from churnlane.operators import results as RS
from churnlane.operators import scoring as SC
from churnlane.operators import sparse as SP
from churnlane.operators import statistics as STAT
from churnlane.operators.predict import as_results_rows, predict_requests, predict_with_models
from churnlane.plans import standins as SI
from churnlane.session import read_table, scratch_path
from churnlane.sources import ingest as IN
from churnlane.sources import sinks as SK
from churnlane.streaming import dedup as DD
from churnlane.streaming import registration as RG
from churnlane.streaming import score_stream as ST


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# ------------------------------------------------------------ directory

def directory_prefix(spark, sf_dir):
    """JOI-1 FLT-4 SRT-2 PRJ-3 SCA-13 SCA-14 (flagship)."""
    return D.directory(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"),
                       key="doc_id", label_col="quality", q=" 1 ", label_prefix="Doc #")


def directory_all(spark, sf_dir):
    """JOI-1 without a search term (blank q = no filter)."""
    return D.directory(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"),
                       key="doc_id", label_col="quality", q="  ", label_prefix="Doc #")


def employee_record(spark, sf_dir):
    """JOI-2 PRJ-4 FLT-3 SRC-6, batch form: records of the requested ids."""
    return D.records(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"),
                     _t(spark, sf_dir, "events"), key="doc_id", label_col="quality",
                     requested_key="user_id")


def label_filter(spark, sf_dir):
    """FLT-6: directory entries whose label is positive (pushed into the plan)."""
    d = D.directory(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"),
                    key="doc_id", label_col="quality", label_prefix="Doc #")
    return D.positives(d, "quality", positive=1)


def label_flag(spark, sf_dir):
    """FLT-11: warning flag per directory entry (missing label -> false)."""
    d = D.directory(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"),
                    key="doc_id", label_col="quality", label_prefix="Doc #")
    return D.with_positive_flag(d, "quality", positive=1)


def missing_keys(spark, sf_dir):
    """FLT-7: requested keys (every document) with no label row."""
    return D.missing_keys(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"),
                          key="doc_id")


# ------------------------------------------------------------ history

def _results(spark, sf_dir):
    return SI.orders_as_results(_t(spark, sf_dir, "orders"))


def history_by_owner(spark, sf_dir):
    """FLT-1 FLT-5 SRT-1 PRJ-1 GOV-4: histories of the owners seen in events."""
    owners = _t(spark, sf_dir, "events").select(F.col("user_id").alias("id_user"))
    return RS.history_for_owners(
        _results(spark, sf_dir), owners,
        columns=["id", "id_user", "prenom", "nom", "modele_utilise", "probabilite_de_quitter",
                 "prediction", "libelle_prediction", "seuil_applique"]
    ).withColumn("probabilite_de_quitter", F.round("probabilite_de_quitter", 6))


def history_of_owner(spark, sf_dir):
    """FLT-1 FLT-2 SRT-1: one owner's whole history of results whose first name matches."""
    h = RS.history(_results(spark, sf_dir), 7, prenom=" F ")
    return h.select("id", "prenom", "nom", F.round("probabilite_de_quitter", 6).alias("probabilite_de_quitter"))


def history_no_owner(spark, sf_dir):
    """FLT-5: histories asked for by requests of which a part names no owner; those get no rows."""
    asked = _t(spark, sf_dir, "events").select(F.when(F.col("event_type") != "error", F.col("user_id") * 7).alias("id_user"))
    return RS.history_for_owners(_results(spark, sf_dir), asked, columns=["id", "id_user"])


def record_one(spark, sf_dir):
    """FLT-3 LIM-1 JOI-2: one record by its key."""
    return D.record(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"), 11, key="doc_id",
                    label_col="quality")


def results_json(spark, sf_dir):
    """SNK-5: rows as JSON text, nulls kept, parsed again."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.when(
        F.col("o_orderkey") % 4 > 0, F.col("o_totalprice")).alias("p"))
    text = RS.as_json_rows(o).where(F.size(F.json_object_keys("json")) == len(o.columns))
    return text.select(F.from_json("json", o.schema).alias("j")).select("j.*")


def strict_numbers(spark, sf_dir):
    """SCA-4 SCA-10: strict numbers and leading numbers of texts."""
    n = F.col("l_linenumber") % 4
    text = (F.when(n == 1, F.col("l_quantity").cast("string"))
            .when(n == 2, F.concat(F.lit("x"), F.col("l_quantity").cast("string")))
            .when(n == 3, F.concat(F.lit(" -"), F.col("l_quantity").cast("string"), F.lit("e2"))))
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("t"))
    return li.select("l_orderkey", "l_linenumber", clean.strict_float("t").alias("strict"),
                     clean.leading_number("t").alias("leading"))


def history_topk(spark, sf_dir):
    """LIM-2: the 20 newest results of every owner."""
    r = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"),
                                           F.col("o_custkey").alias("id_user"), "o_totalprice")
    return RS.topk_per_owner(r, k=20)


def history_counts(spark, sf_dir):
    """AGG-2: result count per owner."""
    r = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id_user"))
    return RS.counts_per_owner(r)


def history_display(spark, sf_dir):
    """PRJ-7 SCA-7 SCA-8: display rows with percent texts."""
    return RS.display(_results(spark, sf_dir))


def name_ilike(spark, sf_dir):
    """FLT-2 SCA-12: stripped case-insensitive patterns, ANDed."""
    c = _t(spark, sf_dir, "customer")
    return (RS.name_search(c, "c_name", "c_mktsegment", " customer#%1 ", " building ")
            .select("c_custkey", "c_name", "c_mktsegment")
            .orderBy(F.col("c_custkey").desc()))


def detail_two_source(spark, sf_dir):
    """JOI-3 PRJ-2 PRJ-5 SCA-20 SCA-21: features from table or stored JSON."""
    res = SI.events_as_results(_t(spark, sf_dir, "events"))
    det = RS.detail(res, _t(spark, sf_dir, "customer"), features_key="c_custkey")
    f = F.col("features")
    # json_tuple reads the three fields in one parse of the features text.
    fields = det.select("id", "employe_id", "source_features",
                        F.size(F.json_object_keys(f)).cast("long").alias("n_features"),
                        F.json_tuple(f, "k", "c_name", "c_acctbal"))
    return fields.select("id", "employe_id", "source_features",
                         F.col("c0").cast("long").alias("k"), F.col("c1").alias("c_name"),
                         F.col("c2").cast("double").alias("c_acctbal"), "n_features")


# ------------------------------------------------------------ cleaning / features

def _dirty_text(li: DataFrame) -> DataFrame:
    n = F.col("l_linenumber")
    raw = (F.when(n == 1, F.translate(F.col("l_quantity").cast("string"), ".", ","))
           .when(n == 2, F.concat(F.lit(" "), F.col("l_extendedprice").cast("string"), F.lit(" ")))
           .when(n == 3, F.lit("abc"))
           .when(n == 4, F.lit(""))
           .when(n == 5, F.lit(None).cast("string"))
           .when(n == 6, F.concat(F.lit("+"), F.col("l_partkey").cast("string"), F.lit("e-3")))
           .otherwise(F.concat(F.col("l_quantity").cast("string"), F.lit("d"))))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw"))


def lenient_float(spark, sf_dir):
    """SCA-1 SCA-18: lenient parse of dirty numeric text."""
    d = _dirty_text(_t(spark, sf_dir, "lineitem"))
    return d.select("l_orderkey", "l_linenumber", "raw", clean.to_float("raw").alias("val"))


def derived_ratio_product(spark, sf_dir):
    """FE-1 SCA-2 SCA-3: derive only where blank; supplied values kept."""
    li = _t(spark, sf_dir, "lineitem")
    fpa = (F.when(F.col("l_returnflag") == "R", F.col("l_discount").cast("string"))
           .when(F.col("l_returnflag") == "A", F.lit("abc")))
    base = li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_linenumber").alias("nb_formations_suivies"),
        (F.col("l_quantity") - 25).alias("annee_experience_totale"),
        F.col("l_linenumber").alias("niveau_hierarchique_poste"),
        (F.col("l_tax") * 100).alias("niveau_education"),
        fpa.alias("formations_par_an"),
        F.lit("").alias("poste_x_niveau"))
    vals = FE.derive(FE.values_from_columns(base, [
        "nb_formations_suivies", "annee_experience_totale", "niveau_hierarchique_poste",
        "niveau_education", "formations_par_an", "poste_x_niveau"]))
    return base.select("l_orderkey", "l_linenumber",
                       F.round(vals["formations_par_an"].num, 6).alias("formations_par_an"),
                       F.round(vals["poste_x_niveau"].num, 6).alias("poste_x_niveau"))


def _orders_features(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.col("o_totalprice").alias("montant"),
                    SI.travel_text(F.col("o_orderpriority")).alias("frequence_deplacement"),
                    SI.overtime_text(F.col("o_orderstatus")).alias("heure_supplementaires"))


def _encoded(spark, sf_dir) -> DataFrame:
    df = _orders_features(spark, sf_dir)
    x = FE.from_column(df, "frequence_deplacement")
    code, unknown = FE.encode("frequence_deplacement", x)
    return df.select("o_orderkey", F.col("frequence_deplacement").alias("valeur"),
                     code.alias("code"),
                     F.when(unknown, FE.unknown_reason("frequence_deplacement", x)).alias("reason"))


def encode_ok(spark, sf_dir):
    """FE-2 JOI-7 SCA-11: known categories and their codes."""
    return _encoded(spark, sf_dir).where(F.col("reason").isNull()).drop("reason")


def encode_rejected(spark, sf_dir):
    """FE-2 AGG-5: unknown categories with the sorted accepted values."""
    return _encoded(spark, sf_dir).where(F.col("reason").isNotNull()).drop("code")


def _layout(spark, sf_dir, layout, onehot=None):
    df = _orders_features(spark, sf_dir)
    vals = FE.values_from_columns(df, SI.ORDERS_CONTRACT)
    prepared = FE.prepare(df, vals, SI.ORDERS_CONTRACT, layout, onehot, keep=["o_orderkey"])
    ok, _ = FE.split_ok_rejected(prepared)
    return ok


def layout_numeric(spark, sf_dir):
    """FE-3 PRJ-6 SCA-4: all-float layout in contract order."""
    return _layout(spark, sf_dir, FE.NUMERIC_LAYOUT)


def layout_mixed(spark, sf_dir):
    """FE-4: categories as raw text, the rest lenient floats."""
    return _layout(spark, sf_dir, FE.MIXED_LAYOUT)


def layout_aligned(spark, sf_dir):
    """FE-5: one-hot columns as text, other categories encoded."""
    return _layout(spark, sf_dir, FE.ALIGNED_LAYOUT, onehot=["frequence_deplacement"])


def impute_defaults(spark, sf_dir):
    """FE-6: fixed per-column defaults for missing inputs."""
    j = _t(spark, sf_dir, "documents").select("doc_id").join(
        _t(spark, sf_dir, "labels"), "doc_id", "left")
    return FE.impute_defaults(j, {"quality": -1, "toxic": -1})


# ------------------------------------------------------------ scoring

def logistic_score(spark, sf_dir):
    """ML-1 ML-2 SCA-5 SCA-6 SCA-9 FLT-10: score, threshold, label."""
    li = _t(spark, sf_dir, "lineitem")
    m = SI.LINEITEM_MODEL
    vals = FE.values_from_columns(li, m.columns)
    prepared = FE.prepare(li, vals, m.columns, m.layout, keep=["l_orderkey", "l_linenumber"])
    ok, _ = FE.split_ok_rejected(prepared)
    scored = SC.score(ok, m, proba_digits=6)
    return scored.select("l_orderkey", "l_linenumber", "modele_utilise", SC.PROBA,
                         SC.PREDICTION, SC.LABEL, SC.THRESHOLD)


_REQUEST_OUT = ["prenom", "nom", "modele_utilise", SC.PROBA, SC.PREDICTION, SC.LABEL,
                SC.THRESHOLD, "employe_id", "id_user"]


def _score_events(events: DataFrame) -> DataFrame:
    scored, _ = predict_requests(SI.events_as_requests(events), SI.EVENTS_MODEL, proba_digits=6)
    return scored


def score_and_append(spark, sf_dir):
    """ML-3 SNK-1 SNK-5 FE-7 SCA-15 SCA-16 SCA-19: score, append, read back."""
    path = scratch_path(spark, "results")
    rows = as_results_rows(_score_events(_t(spark, sf_dir, "events")))
    RS.append_results(spark, path, rows)
    back = RS.read_results(spark, path)
    return back.select(*_REQUEST_OUT,
                       F.get_json_object("details", "$.k").cast("long").alias("details_k"))


def append_mixed(spark, sf_dir):
    """SNK-1 STR-1: half of the events appended by batch, half by stream, read back whole."""
    path, half = scratch_path(spark, "mixed"), scratch_path(spark, "mixed-source")
    ev = _t(spark, sf_dir, "events")
    ev.where(F.col("event_id") % 2 == 0).write.parquet(half)
    RS.append_results(spark, path, as_results_rows(_score_events(ev.where(F.col("event_id") % 2 == 1))))
    back = ST.stream_to_results(spark, half, ev.schema, lambda b: as_results_rows(_score_events(b)), path,
                                scratch_path(spark, "mixed-ckpt"), "mixed")
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"),
                    F.min("id").cast("int").alias("first_id"), F.max("id").alias("last_id"),
                    F.sum("id_user").alias("users"))


def erase_then_append(spark, sf_dir):
    """GOV-1 SNK-1: erased ids are never given again."""
    path, new = scratch_path(spark, "before"), scratch_path(spark, "after")
    ev = _t(spark, sf_dir, "events")
    rows = as_results_rows(_score_events(ev))
    RS.append_results(spark, path, rows)
    users = ev.select(F.col("user_id").alias("id")).distinct()
    G.erase_and_write(spark, users, RS.read_results(spark, path), users.where(F.col("id") % 2 == 0),
                      results_out=new, old_results_path=path)
    RS.append_results(spark, new, rows)
    last = ev.count()
    return RS.read_results(spark, new).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"),
        F.min(F.when(F.col("id") > last, F.col("id"))).alias("first_new_id"))


def _mixed_requests(spark, sf_dir):
    """All events as requests; half of them broken in different ways."""
    reqs = SI.events_as_requests(_t(spark, sf_dir, "events"))
    kind = F.col("request_id") % 10
    return reqs.withColumns({
        "features": F.when(kind == 0, F.lit(None).cast("string")).when(kind == 1, "not json").when(kind == 2, "[1,2]")
        .when(kind == 3, F.when(F.col("request_id") % 20 == 3, '{"k":"nan"}').otherwise('{"k":"1e400"}'))
        .when(kind == 5, '{"k":5,"k":6}').otherwise(F.col("features")),
        "modele": F.when(kind != 4, F.col("modele"))})


def requests_ok(spark, sf_dir):
    """ML-2 ML-10: the requests that can be scored; of a repeated key the last value counts."""
    ok, _ = predict_with_models(_mixed_requests(spark, sf_dir), SI.EVENTS_MODELS, proba_digits=6)
    return ok.select("request_id", SC.PROBA)


def requests_rejected(spark, sf_dir):
    """FLT-12 ML-10: the other requests, each with its reason."""
    _, rejected = predict_with_models(_mixed_requests(spark, sf_dir), SI.EVENTS_MODELS)
    return rejected.select("request_id", F.col("_reason").alias("reason"))


def _by_model(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    reqs = ev.select(F.col("event_id").alias("request_id"),
                     SI.events_model_choice(F.col("event_type")).alias("modele"),
                     F.col("props").alias("features"))
    return predict_with_models(reqs, SI.EVENTS_MODELS, proba_digits=6)


def score_by_model(spark, sf_dir):
    """ML-2 ML-3 JOI-9: each request scored by the model it names, one pass."""
    scored, _ = _by_model(spark, sf_dir)
    return scored.select("request_id", "modele_utilise", SC.PROBA, SC.PREDICTION, SC.LABEL,
                         SC.THRESHOLD)


def score_by_model_rejected(spark, sf_dir):
    """JOI-9 ML-10: requests naming a model that is not loaded."""
    _, rejected = _by_model(spark, sf_dir)
    return rejected.select("request_id", "modele", F.col("_reason").alias("reason"))


def _by_registry(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    return MT.predict_with_registry(SI.events_as_registry_requests(_t(spark, sf_dir, "events")), SI.part_registry(part),
                                    SI.part_coefficients(part), proba_digits=6)


def score_by_registry(spark, sf_dir):
    """JOI-9 ML-1 ML-2 ML-4: a model per part, joined as data; each request in the first layout that fits."""
    scored, _ = _by_registry(spark, sf_dir)
    return scored.select("request_id", "modele_utilise", SC.PROBA, SC.PREDICTION, SC.LABEL, "format_entree",
                         F.size("colonnes_utilisees").cast("long").alias("nb_colonnes"))


def score_by_registry_rejected(spark, sf_dir):
    """ML-1 ML-10 JOI-9: the other requests: unknown models and values, and every layout's failure."""
    _, rejected = _by_registry(spark, sf_dir)
    return rejected.select("request_id", "modele", F.col("_reason").alias("reason"))


def stream_score(spark, sf_dir):
    """STR-1: the same scoring as a file-source stream into a Parquet sink."""
    schema = _t(spark, sf_dir, "events").schema
    out = ST.score_stream(
        spark, sf_dir, schema,
        lambda s: _score_events(s).select("request_id", *_REQUEST_OUT,
                                          F.get_json_object("details", "$.k").cast("long")
                                          .alias("details_k")),
        scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt"),
        glob="events.parquet")
    return out


def stream_to_results(spark, sf_dir):
    """STR-1 SNK-1: streamed requests appended to the results table with ids."""
    schema = _t(spark, sf_dir, "events").schema
    back = ST.stream_to_results(
        spark, sf_dir, schema, lambda b: as_results_rows(_score_events(b)),
        scratch_path(spark, "stream-results"), scratch_path(spark, "stream-results-ckpt"),
        query_name="events", glob="events.parquet")
    return back.select(*_REQUEST_OUT,
                       F.get_json_object("details", "$.k").cast("long").alias("details_k"))


def stream_enrich(spark, sf_dir):
    """STR-2: stream-static left join of events to customers."""
    schema = _t(spark, sf_dir, "events").schema
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")

    def transform(s):
        return ST.enrich_stream(s, cust, "user_id", "c_custkey").select(
            "event_id", "user_id", "c_name", "c_acctbal")

    return ST.score_stream(spark, sf_dir, schema, transform,
                           scratch_path(spark, "enrich-out"), scratch_path(spark, "enrich-ckpt"),
                           glob="events.parquet")


# ------------------------------------------------------------ registry

def _registry(spark):
    return spark.createDataFrame(SI.REGISTRY_ROWS, "name string, metadata string")


def _orders_requests(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(
        "o_orderkey", SI.model_for_status(F.col("o_orderstatus")).alias("modele"))


def registry_lookup(spark, sf_dir):
    """JOI-8 ML-4 ML-5 ML-6 SCA-22: contract, threshold and tag per request."""
    c = R.contract_for(_orders_requests(spark, sf_dir), _registry(spark))
    return c.select("o_orderkey", "modele", F.size("colonnes").cast("long").alias("nb_colonnes"),
                    F.col("seuil_modele").alias("seuil"), "source")


def unknown_model(spark, sf_dir):
    """JOI-9 ML-10: requests naming a model that is not loaded."""
    _, rejected = R.split_known_model(_orders_requests(spark, sf_dir), _registry(spark))
    return rejected


def roles_report(spark, sf_dir):
    """ML-7 ML-8 ML-9 AGG-3 AGG-4: column roles from a branch table."""
    o = _t(spark, sf_dir, "orders")
    steps = (F.when(F.col("o_orderstatus") == "F", F.array(F.lit("OneHotEncoder")))
             .when(F.col("o_orderstatus") == "O",
                   F.array(F.lit("SimpleImputer"), F.lit("StandardScaler")))
             .otherwise(F.array(F.lit("OrdinalEncoder"))))
    branches = o.select(F.lit("top1").alias("name"), steps.alias("steps"),
                        F.col("o_orderpriority").alias("column"), F.col("o_orderkey").alias("pos"))
    rep = R.roles_report(branches)
    return rep.select("name", "role", F.array_join("colonnes", ",").alias("colonnes"),
                      F.col("nb_colonnes").cast("long").alias("nb_colonnes"))


# ------------------------------------------------------------ DEL-*

def _price(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")


def _scaled(df, stats):
    out = SC.apply_scaler(df, stats, suffix="_s")
    return out.select("l_orderkey", "l_linenumber",
                      F.round("l_extendedprice_s", 6).alias("scaled"))


def standardise(spark, sf_dir):
    """DEL-3: (x - mean) / population deviation."""
    df = _price(spark, sf_dir)
    return _scaled(df, SC.fit_standard(df, ["l_extendedprice"]))


def minmax(spark, sf_dir):
    """DEL-4: (x - min) / (max - min)."""
    df = _price(spark, sf_dir)
    return _scaled(df, SC.fit_minmax(df, ["l_extendedprice"]))


def robust(spark, sf_dir):
    """DEL-5: (x - median) / (p75 - p25), exact distributed quantiles."""
    df = _price(spark, sf_dir)
    return _scaled(df, SC.fit_robust(df, ["l_extendedprice"], exact=True))


def impute_stat(spark, sf_dir):
    """DEL-6: missing label -> mean of the present labels."""
    j = _t(spark, sf_dir, "documents").select("doc_id").join(
        _t(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    fills = SC.fit_impute_mean(j, ["quality"])
    out = SC.apply_impute(j, fills, suffix="_filled")
    return out.select("doc_id", F.round("quality_filled", 6).alias("quality_filled"))


def impute_median(spark, sf_dir):
    """DEL-6: exact median fill; a column without any value stays missing."""
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"),
        F.lit(None).cast("double").alias("nothing"))
    return SC.apply_impute(o, SC.fit_impute_median(o, ["price", "nothing"]))


def one_hot(spark, sf_dir):
    """DEL-2: one indicator per priority (vocabulary from the data, size-checked)."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    vocab = SC.vocabulary(o, "o_orderpriority")
    return SC.one_hot(o, "o_orderpriority", vocab, prefix="oh").drop("o_orderpriority")


def one_hot_sparse(spark, sf_dir):
    """DEL-2: the index of every order's customer in a distributed vocabulary of customers."""
    o = _t(spark, sf_dir, "orders")
    return SP.one_hot_rows(o, "o_orderkey", "o_custkey", SP.vocabulary_index(o, "o_custkey"))


def merged_statistics(spark, sf_dir):
    """DEL-3 DEL-4 DEL-6: statistics kept per batch of lineitem (a ship month each) and merged."""
    li = _t(spark, sf_dir, "lineitem").withColumn("batch", F.date_trunc("month", F.col("l_shipdate").cast("timestamp")))
    merged = STAT.merge_statistics(STAT.batch_statistics(li, ["l_quantity", "l_extendedprice", "l_discount"], batch="batch"))
    return merged.select("column", "n", F.round("mean", 4).alias("mean"),
                         F.round(F.sqrt(F.col("m2") / F.col("n")), 4).alias("deviation"), "low", "high")


def model_fit(spark, sf_dir):
    """DEL-1 DEL-7 DEL-8: fit a logistic model with pyspark.ml, score everything."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    docs = SC.apply_function(docs, "n_chars", lambda c: F.log1p(c), out="log_chars")
    train = docs.join(_t(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    m = SC.fit_logistic(train, ["n_chars", "log_chars"], "quality", name="fitted")
    scored = SC.score(docs, m, proba_digits=6)
    return scored.select("doc_id", SC.PROBA, SC.PREDICTION)


# ------------------------------------------------------------ governance

def _erasure_requests(spark, sf_dir):
    return _t(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select("c_custkey")


def erase_users(spark, sf_dir):
    """GOV-1 JOI-5: erase users (negative balance) and all their results."""
    users = _t(spark, sf_dir, "customer")
    results = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    out = G.erase_and_write(spark, users, results, _erasure_requests(spark, sf_dir),
                            user_key="c_custkey", owner_col="o_custkey")
    return spark.read.parquet(out.results_path)


def erase_report(spark, sf_dir):
    """GOV-1: deleted / kept counts of the erasure job."""
    users = _t(spark, sf_dir, "customer")
    results = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    out = G.erase_and_write(spark, users, results, _erasure_requests(spark, sf_dir),
                            user_key="c_custkey", owner_col="o_custkey")
    return out.report


def _registration(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    name = F.concat(F.lit(" u"), (F.col("user_id") * 11).cast("string"), F.lit(" "))
    incoming = ev.select(F.when(F.col("event_id") % 500 != 7, name).alias("username"), "event_id", "ts")
    stored = _t(spark, sf_dir, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("username"))
    return G.register_unique(incoming, stored, order_cols=["ts", "event_id"])


def register_unique(spark, sf_dir):
    """GOV-2 JOI-6 FLT-9: first request per stripped name, not already stored."""
    accepted, _ = _registration(spark, sf_dir)
    return accepted.select("username", "event_id")


def register_rejected(spark, sf_dir):
    """GOV-2: every other request with its reason."""
    _, rejected = _registration(spark, sf_dir)
    return rejected.select("username", "event_id", "reason")


def _registration_files(spark, sf_dir):
    """The registration requests of ``events`` as three files, in the order of their arrival."""
    src = scratch_path(spark, "registrations")
    ev = _t(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 500 != 7, F.concat(F.lit(" u"), (F.col("user_id") * 11).cast("string"), F.lit(" ")))
        .alias("username"), "event_id", "ts")
    cuts = ev.agg(*(F.percentile_approx("ts", q).alias(f"q{i}") for i, q in enumerate((0.3, 0.6)))).first()
    for part in (F.col("ts") <= cuts[0], (F.col("ts") > cuts[0]) & (F.col("ts") <= cuts[1]), F.col("ts") > cuts[1]):
        ev.where(part).coalesce(1).write.mode("append").parquet(src)
    return src, ev.schema


def _stream_register(spark, sf_dir):
    src, schema = _registration_files(spark, sf_dir)
    stored = _t(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("username"))
    return RG.register_files(spark, src, schema, stored, ["ts", "event_id"], scratch_path(spark, "registered"),
                             scratch_path(spark, "registered-ckpt"), max_files_per_trigger=1)


def stream_register(spark, sf_dir):
    """GOV-2 JOI-6 STR-1: names registered as requests arrive, in three batches; state keyed by name."""
    return _stream_register(spark, sf_dir).where(F.col("reason").isNull()).select("username", "event_id")


def stream_register_rejected(spark, sf_dir):
    """GOV-2 STR-1: the other requests of the stream, each with its reason."""
    return _stream_register(spark, sf_dir).where(F.col("reason").isNotNull()).select("username", "event_id", "reason")


def _stream_dedup(spark, sf_dir):
    """Events out of order over eight files: every fifth is sent again in the next file,
    every 50th comes three files late."""
    src = scratch_path(spark, "requests")
    ev = _t(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), "ts", "event_type")
    lo, hi = ev.agg(F.min(DD.micros("ts")), F.max(DD.micros("ts"))).first()
    step = (hi - lo) / 8
    own = F.least(F.floor((DD.micros("ts") - lo) / step), F.lit(7))
    sent = F.when(F.col("request_id") % 50 == 9, F.array(own + 3)).when(
        F.col("request_id") % 5 == 0, F.array(own, own + 1)).otherwise(F.array(own))
    files = ev.withColumn("file", F.explode(sent)).where(F.col("file") < 8)
    for i in range(8):
        files.where(F.col("file") == i).drop("file").coalesce(1).write.mode("append").parquet(src)
    return DD.dedup_files(spark, src, ev.schema, "request_id", "ts", 1.5 * step / 1e6, scratch_path(spark, "deduped"),
                          scratch_path(spark, "deduped-ckpt"), max_files_per_trigger=1)


def stream_dedup(spark, sf_dir):
    """STR-1: requests that arrive once, although some are sent again and out of order."""
    return _stream_dedup(spark, sf_dir)[0].select("request_id", "ts", "event_type")


def stream_late(spark, sf_dir):
    """STR-1: the side table of requests that came after the watermark."""
    return _stream_dedup(spark, sf_dir)[1].select("request_id", "side")


def validate_lengths(spark, sf_dir):
    """GOV-3 SCA-17 FLT-8 FLT-12: first failing rule per account request."""
    c = _t(spark, sf_dir, "customer")
    username = F.substring(F.col("c_name"), 1, F.col("c_nationkey"))
    password = F.when(F.col("c_nationkey") < 4, F.substring("c_mktsegment", 1, 3)) \
        .otherwise(F.col("c_mktsegment"))
    ident = F.concat(F.col("c_custkey").cast("string"),
                     F.when(F.col("c_nationkey") == 7, F.lit("x")).otherwise(F.lit("")))
    return c.select("c_custkey", G.validation_reason(username, password, ident).alias("reason"))


def orphan_audit(spark, sf_dir):
    """GOV-5 JOI-4: events linked to no customer."""
    ev = _t(spark, sf_dir, "events").select("event_id", (F.col("user_id") * 11).alias("employe_id"))
    return G.orphans(ev, _t(spark, sf_dir, "customer"), features_key="c_custkey")


def orphan_repair(spark, sf_dir):
    """GOV-5 JOI-4: ON DELETE SET NULL applied to the links."""
    ev = _t(spark, sf_dir, "events").select("event_id", (F.col("user_id") * 11).alias("employe_id"))
    return G.repair_orphans(ev, _t(spark, sf_dir, "customer"), features_key="c_custkey")


# ------------------------------------------------------------ ingest / sinks

def table_count(spark, sf_dir):
    """AGG-1: COUNT(*) of a table."""
    return _t(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def load_if_empty(spark, sf_dir):
    """SRC-3 SRC-4 SNK-4: create if absent, load only when empty (run twice)."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = scratch_path(spark, "orders-load")
    IN.create_table_if_absent(spark, path, o.schema)
    IN.load_if_empty(spark, path, o)
    IN.create_table_if_absent(spark, path, o.schema)   # no-op: exists
    IN.load_if_empty(spark, path, o)                   # no-op: not empty
    return spark.read.parquet(path)


def evolve_schema(spark, sf_dir):
    """SNK-3: append rows carrying a new column; older rows read it as null."""
    path = scratch_path(spark, "evolve")
    old = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"),
                                               F.col("c_name").alias("name"))
    new = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"),
                                               F.col("s_name").alias("name"),
                                               F.col("s_nationkey").alias("nationkey"))
    old.write.parquet(path)
    SK.append_evolving(path, new)
    return SK.read_evolved(spark, path).select("id", "name", "nationkey")


def csv_roundtrip(spark, sf_dir):
    """SRC-1 SRC-2 SNK-2: write CSV, read it back with the three-type rule."""
    path = scratch_path(spark, "part-csv")
    _t(spark, sf_dir, "part").write.option("header", True).csv(path)
    return IN.read_csv_table(spark, path, id_col=None)


def positional_join(spark, sf_dir):
    """SRC-3 SRC-4 SRC-5 SRC-8 SNK-4: two-source bootstrap keyed by position, joined on the key."""
    o = _t(spark, sf_dir, "orders")
    xp, yp = scratch_path(spark, "x-csv"), scratch_path(spark, "y-csv")
    (o.select("o_orderkey", "o_totalprice", "o_orderpriority").orderBy("o_orderkey")
     .write.option("header", True).csv(xp))
    (o.orderBy("o_orderkey").select("o_orderstatus")
     .write.option("header", True).csv(yp))
    fx, fy = scratch_path(spark, "features-table"), scratch_path(spark, "labels-table")
    IN.ingest_features_and_labels(spark, xp, yp, fx, fy)
    return spark.read.parquet(fx).join(spark.read.parquet(fy), "id", "inner")


QUERIES = {
    "directory_prefix": directory_prefix,
    "directory_all": directory_all,
    "employee_record": employee_record,
    "label_filter": label_filter,
    "label_flag": label_flag,
    "missing_keys": missing_keys,
    "history_by_owner": history_by_owner,
    "history_topk": history_topk,
    "history_counts": history_counts,
    "history_display": history_display,
    "name_ilike": name_ilike,
    "detail_two_source": detail_two_source,
    "lenient_float": lenient_float,
    "derived_ratio_product": derived_ratio_product,
    "encode_ok": encode_ok,
    "encode_rejected": encode_rejected,
    "layout_numeric": layout_numeric,
    "layout_mixed": layout_mixed,
    "layout_aligned": layout_aligned,
    "impute_defaults": impute_defaults,
    "logistic_score": logistic_score,
    "score_and_append": score_and_append,
    "score_by_model": score_by_model,
    "score_by_model_rejected": score_by_model_rejected,
    "score_by_registry": score_by_registry,
    "score_by_registry_rejected": score_by_registry_rejected,
    "stream_score": stream_score,
    "stream_to_results": stream_to_results,
    "stream_enrich": stream_enrich,
    "registry_lookup": registry_lookup,
    "unknown_model": unknown_model,
    "roles_report": roles_report,
    "standardise": standardise,
    "minmax": minmax,
    "robust": robust,
    "impute_stat": impute_stat,
    "impute_median": impute_median,
    "history_of_owner": history_of_owner,
    "history_no_owner": history_no_owner,
    "record_one": record_one,
    "results_json": results_json,
    "strict_numbers": strict_numbers,
    "append_mixed": append_mixed,
    "erase_then_append": erase_then_append,
    "requests_ok": requests_ok,
    "requests_rejected": requests_rejected,
    "one_hot": one_hot,
    "one_hot_sparse": one_hot_sparse,
    "merged_statistics": merged_statistics,
    "model_fit": model_fit,
    "erase_users": erase_users,
    "erase_report": erase_report,
    "register_unique": register_unique,
    "register_rejected": register_rejected,
    "stream_register": stream_register,
    "stream_register_rejected": stream_register_rejected,
    "stream_dedup": stream_dedup,
    "stream_late": stream_late,
    "validate_lengths": validate_lengths,
    "orphan_audit": orphan_audit,
    "orphan_repair": orphan_repair,
    "table_count": table_count,
    "load_if_empty": load_if_empty,
    "evolve_schema": evolve_schema,
    "csv_roundtrip": csv_roundtrip,
    "positional_join": positional_join,
}
