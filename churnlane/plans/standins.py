"""How the driver's tables stand in for the scoring service's tables.

features = documents (key doc_id), labels = labels (label quality),
results = orders (id o_orderkey, owner o_custkey) or events (id event_id,
owner user_id, link user_id for purchases), users = customer, requests =
events (features = the ``props`` JSON), numeric frame = lineitem.

The toy models below are documented test models, not anyone's trained
coefficients: the service's trained model is not available.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane.operators.scoring import LogisticModel

# Toy model over lineitem numbers (standardised inputs).
LINEITEM_MODEL = LogisticModel(
    name="top1",
    columns=["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    intercept=-0.5,
    weights={"l_quantity": 0.8, "l_extendedprice": 0.6, "l_discount": -0.4, "l_tax": 0.3},
    scaler={"l_quantity": (25.5, 14.4), "l_extendedprice": (38000.0, 23000.0),
            "l_discount": (0.05, 0.032), "l_tax": (0.04, 0.026)},
)

# Toy model over orders (the stored "results" probability).
ORDERS_MODEL = LogisticModel(
    name="top1", columns=["montant"], intercept=-2.0, weights={"montant": 1.0},
    scaler={"montant": (0.0, 100000.0)})

# Toy model over request features (events.props holds {"k": n}).
EVENTS_MODEL = LogisticModel(
    name="top1", columns=["k", "frequence_deplacement"], intercept=-1.0,
    weights={"k": 0.03, "frequence_deplacement": 0.5}, scaler={"k": (50.0, 29.0)})

# Second toy model over request features, with a one-hot input (aligned layout).
EVENTS_MODEL_B = LogisticModel(
    name="top2", columns=["k", "statut_marital"], intercept=0.5, weights={"k": -0.02},
    onehot={"statut_marital": {"single": 0.7}})

# The loaded registry used by per-request model choice.
EVENTS_MODELS = {"top1": EVENTS_MODEL, "top2": EVENTS_MODEL_B}

# Contract used for the layout queries over orders.
ORDERS_CONTRACT = ["montant", "frequence_deplacement", "heure_supplementaires", "absente"]

# Model registry used by the registry queries (JSON bundle descriptions).
REGISTRY_ROWS = [
    # a pipeline whose first step is a column transformer with a transformer nested in one branch
    ("top1", '{"v1.best": {"type": "Pipeline", "predict": true, "steps": ['
             '{"type": "ColumnTransformer", "transformers": ['
             '{"name": "overtime", "columns": ["heure_supplementaires"], '
             '"transformer": {"type": "MyOneHotThing"}}, '
             '{"name": "pay", "columns": ["revenu_mensuel", "age", "age"], "transformer": {"type": "Pipeline", '
             '"steps": [{"type": "SimpleImputer"}, {"type": "FunctionTransformer", "func": "log1p"}]}}, '
             '{"name": "inner", "columns": ["genre"], "transformer": {"type": "ColumnTransformer", '
             '"transformers": [{"name": "grade", "steps": ["RobustScaler"], "columns": "xy"}]}}, '
             '{"name": "rest", "steps": ["MinMaxScaler"], "columns": "drop"}, '
             '{"name": "none", "steps": ["MinMaxScaler"], "columns": 3}]}, '
             '{"type": "LogisticRegression", "feature_names_in_": ["age", "genre"]}]}, '
             '"scaler": {"type": "RobustScaler", "transform": true}, '
             '"columns": 12, "colonnes": ["age", "revenu_mensuel"], "threshold": 0.4}'),
    ("top2", '{"type": "LogisticRegression", "predict": true}'),
    ("top3", '{"scaler": {"type": "StandardScaler", "transform": true}}'),
]


def travel_text(priority: Column) -> Column:
    """Category text per order priority; '4-NOT SPECIFIED' maps to an unknown value."""
    return (F.when(priority == "1-URGENT", F.lit("Fréquent"))
            .when(priority == "2-HIGH", F.lit(" Travel_Rarely "))
            .when(priority == "3-MEDIUM", F.lit("AUCUN"))
            .when(priority == "5-LOW", F.lit(None).cast("string"))
            .otherwise(F.lit("not specified")))


def overtime_text(status: Column) -> Column:
    return (F.when(status == "F", F.lit("Oui")).when(status == "O", F.lit(" non "))
            .otherwise(F.lit(None).cast("string")))


def model_for_status(status: Column) -> Column:
    return (F.when(status == "F", F.lit("top1")).when(status == "O", F.lit("top2"))
            .otherwise(F.lit("top3")))


def orders_as_results(orders: DataFrame) -> DataFrame:
    """orders -> stored results rows (probability from the toy orders model)."""
    from churnlane.operators.scoring import score
    base = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("id_user"),
        F.col("o_orderstatus").alias("prenom"), F.col("o_orderpriority").alias("nom"),
        F.col("o_totalprice").alias("montant"))
    scored = score(base, ORDERS_MODEL)
    return scored.withColumns({"employe_id": F.lit(None).cast("long"),
                               "details": F.lit(None).cast("string")})


def events_as_requests(events: DataFrame) -> DataFrame:
    """events -> scoring requests (features = props JSON)."""
    purchase = F.col("event_type") == "purchase"
    return events.select(
        F.col("event_id").alias("request_id"),
        F.lit("top1").alias("modele"),
        F.col("props").alias("features"),
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type")).alias("prenom"),
        F.when(F.col("event_type") == "click", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string"))).alias("nom"),
        F.when(purchase, F.col("user_id")).alias("employe_id"),
        F.col("user_id").alias("id_user"),
    )


def events_model_choice(event_type: Column) -> Column:
    """Model named by each request: errors name a model that is not loaded."""
    return (F.when(event_type == "error", F.lit("ghost"))
            .when(event_type == "click", F.lit("top2")).otherwise(F.lit("top1")))


def events_as_results(events: DataFrame) -> DataFrame:
    """events -> stored results with a link for purchases, JSON details otherwise."""
    from churnlane.operators.results import details_json
    purchase = F.col("event_type") == "purchase"
    link = F.when(purchase, F.col("user_id"))
    return events.select(F.col("event_id").alias("id"), F.col("user_id").alias("id_user"),
                         link.alias("employe_id"), details_json(F.col("props"), link).alias("details"))


# Models as data: one toy model per part, of five kinds.

def part_registry(part: DataFrame) -> DataFrame:
    """One registry bundle per part; its kind is p_partkey % 5.

    0 numbers only, 1 one-hot text with strict categories, 2 text that is not
    among its one-hot roles, 3 categories as numbers, 4 as 1 but lenient.
    """
    kind = F.col("p_partkey") % 5
    columns = (F.when(kind == 0, '["k", "revenu_mensuel"]').when(kind == 2, '["k", "statut_marital", "heure_supplementaires"]')
               .when(kind == 3, '["k", "frequence_deplacement"]').otherwise('["k", "statut_marital"]'))
    onehot = F.when(kind == 2, '"heure_supplementaires"').when(kind == 3, "").otherwise('"statut_marital"')
    unknown = F.when(kind == 4, "ignore").otherwise("error")
    return part.select(F.concat(F.lit("p"), F.col("p_partkey")).alias("name"), F.concat(
        F.lit('{"model": {"type": "Pipeline", "predict": true, "handle_unknown": "'), unknown,
        F.lit('", "steps": [{"type": "ColumnTransformer", "transformers": [{"name": "o", "columns": ['), onehot,
        F.lit('], "steps": ["OneHotEncoder"]}]}]}, "colonnes": '), columns, F.lit("}")).alias("metadata"))


def part_coefficients(part: DataFrame) -> DataFrame:
    """The weights of ``part_registry``'s models, a row per coefficient."""
    kind = F.col("p_partkey") % 5
    none = F.lit(None).cast("double")

    def row(when, feature, category, weight, center=none, scale=none):
        return F.when(when, F.struct(F.lit(feature).alias("feature"), F.lit(category).cast("string").alias("category"),
                                     weight.alias("weight"), center.alias("center"), scale.alias("scale")))

    text = kind.isin(1, 2, 4)
    rows = F.array(
        row(F.lit(True), "__intercept__", None, (F.col("p_partkey") % 3) * F.lit(-0.5)),
        row(F.lit(True), "k", None, F.col("p_size") / F.lit(100.0), F.lit(50.0), F.lit(29.0)),
        row(kind == 0, "revenu_mensuel", None, (F.col("p_partkey") % 7) * F.lit(0.01)),
        row(text, "statut_marital", "single", F.lit(0.5)), row(text, "statut_marital", "Married", F.lit(-0.25)),
        row(kind == 2, "heure_supplementaires", "oui", F.lit(0.125)),
        row(kind == 3, "frequence_deplacement", None, F.lit(0.3)))
    return (part.select(F.concat(F.lit("p"), F.col("p_partkey")).alias("model"),
                        F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("model", "r.*"))


def events_as_registry_requests(events: DataFrame) -> DataFrame:
    """events -> requests that name one of ``part_registry``'s models (some name none of them)."""
    i = F.col("event_id")
    status = (F.when(F.col("event_type") == "error", "alien")
              .otherwise(F.element_at(F.array(*map(F.lit, ("single", "Married", "divorced", ""))), (i % 4 + 1).cast("int"))))
    travel = F.element_at(F.array(*map(F.lit, ("Frequent", "2", " rare "))), (i % 3 + 1).cast("int"))
    features = F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), F.lit(', "statut_marital": "'), status,
                        F.lit('", "frequence_deplacement": "'), travel,
                        F.lit('", "heure_supplementaires": "oui", "revenu_mensuel": '), F.col("user_id"), F.lit("}"))
    return events.select(i.alias("request_id"), F.concat(F.lit("p"), i % 2500).alias("modele"), features.alias("features"))
