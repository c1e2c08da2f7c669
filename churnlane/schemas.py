"""Declared schemas and the fixed values the scoring contract depends on."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# FIXED VALUES - must equal the scoring service's contract for equal results.
# --------------------------------------------------------------------------

# Model input columns, in this exact order (15 columns).
MODEL_COLUMNS = [
    "age",
    "revenu_mensuel",
    "annees_dans_l_entreprise",
    "distance_domicile_travail",
    "annes_sous_responsable_actuel",
    "satisfaction_employee_environnement",
    "niveau_hierarchique_poste",
    "satisfaction_min",
    "poste_x_niveau",
    "formations_par_an",
    "statut_marital",
    "frequence_deplacement",
    "heure_supplementaires",
    "hs_et_salaire_bas",
    "jeune_faible_anciennete",
]

# Categorical columns of the contract.
CATEGORICAL_COLUMNS = ["statut_marital", "frequence_deplacement", "heure_supplementaires"]

# Category dictionaries: normalised text (strip + lower) -> code.
CATEGORY_CODES = {
    "heure_supplementaires": {
        "non": 0, "no": 0, "0": 0, "false": 0,
        "oui": 1, "yes": 1, "1": 1, "true": 1,
    },
    "frequence_deplacement": {
        "aucun": 0, "aucune": 0, "non-travel": 0, "nontravel": 0, "0": 0,
        "occasionnel": 1, "travel_rarely": 1, "travelrarely": 1, "rare": 1, "1": 1,
        "frequent": 2, "fréquent": 2, "travel_frequently": 2, "travelfrequently": 2, "2": 2,
    },
    "statut_marital": {
        "célibataire": 0, "celibataire": 0, "single": 0, "0": 0,
        "marié(e)": 1, "marie(e)": 1, "marié": 1, "marie": 1, "married": 1, "1": 1,
        "divorcé(e)": 2, "divorce(e)": 2, "divorcé": 2, "divorce": 2, "divorced": 2, "2": 2,
    },
}

# Key names searched, in priority order, when resolving model metadata.
MODEL_KEYS = ["model", "modele", "estimator", "clf", "classifier",
              "pipeline", "best_model", "best_estimator"]
SCALER_KEYS = ["scaler", "preprocessor", "preprocesseur", "transformer", "scaler_x", "encoder"]
COLUMN_KEYS = ["columns", "colonnes", "features", "feature_names", "feature_names_in_", "X_columns"]
THRESHOLD_KEYS = ["threshold", "seuil", "best_threshold", "optimal_threshold"]

# Preprocessing step names that make a column "numeric"; any step name
# containing ONEHOT_MARKER makes it "onehot"; anything else is "other".
NUMERIC_STEPS = ["StandardScaler", "MinMaxScaler", "RobustScaler",
                 "SimpleImputer", "FunctionTransformer"]
ONEHOT_MARKER = "OneHot"

DEFAULT_THRESHOLD = 0.37
LABEL_POSITIVE = "Quitte"
LABEL_NEGATIVE = "Reste"
DEFAULT_FIRST_NAME = "John"
DEFAULT_LAST_NAME = "Doe"
DIRECTORY_LABEL_PREFIX = "Employé #"
GROUND_TRUTH_POSITIVE = "Oui"

# Registry provenance tags.
SOURCE_EXTRACTED = "extraction_automatique"
SOURCE_EXTRACTION_FAILED = "defaut_extraction_echouee"
SOURCE_NOT_LOADED = "defaut_modele_non_charge"

# Detail-view provenance tags.
FEATURES_FROM_TABLE = "employes_features"
FEATURES_FROM_JSON = "details_json"

# Input-form defaults per column (imputation, FE-6).
FORM_DEFAULTS = {
    "age": 36,
    "revenu_mensuel": 4919,
    "annees_dans_l_entreprise": 5,
    "distance_domicile_travail": 7,
    "annes_sous_responsable_actuel": 3,
    "satisfaction_employee_environnement": 3,
    "niveau_hierarchique_poste": 2,
    "satisfaction_min": 2,
    "poste_x_niveau": 6,
    "formations_par_an": 0.3,
    "hs_et_salaire_bas": 0,
    "jeune_faible_anciennete": 0,
}

# Account field length bounds (inclusive).
USERNAME_LENGTH = (3, 80)
PASSWORD_LENGTH = (4, 128)

# --------------------------------------------------------------------------
# Declared table schemas.
# --------------------------------------------------------------------------

RESULTS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("prenom", T.StringType(), True),
    T.StructField("nom", T.StringType(), True),
    T.StructField("modele_utilise", T.StringType(), True),
    T.StructField("probabilite_de_quitter", T.DoubleType(), True),
    T.StructField("prediction", T.IntegerType(), True),
    T.StructField("libelle_prediction", T.StringType(), True),
    T.StructField("seuil_applique", T.DoubleType(), True),
    T.StructField("employe_id", T.LongType(), True),
    T.StructField("details", T.StringType(), True),
    T.StructField("id_user", T.LongType(), True),
])

USERS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("username", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType(), True),
    T.StructField("modele", T.StringType(), True),
    T.StructField("features", T.StringType(), True),   # JSON object text
    T.StructField("seuil", T.DoubleType(), True),
    T.StructField("prenom", T.StringType(), True),
    T.StructField("nom", T.StringType(), True),
    T.StructField("employe_id", T.LongType(), True),
    T.StructField("id_user", T.LongType(), True),
])

# How the service names the input layouts in a prediction.
LAYOUT_NAMES = {"aligned": "dataframe_aligne", "mixed": "dataframe_mixte", "numeric": "dataframe_float64"}
