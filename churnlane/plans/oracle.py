"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Plain SQL over the driver's views.  Only the toy models and stand-in values
are shared with the Spark side; rules, grammars and word lists are written out
here on their own.  Literal doubles are cast explicitly (DuckDB reads ``0.37`` as DECIMAL).
"""

from __future__ import annotations

from churnlane.operators.scoring import LogisticModel
from churnlane.plans import standins as SI


# Python's float grammar: digit groups may hold single underscores.
FLOAT_SQL = ("(?i)^[+-]?([0-9](_?[0-9])*([.]([0-9](_?[0-9])*)?)?|[.][0-9](_?[0-9])*)"
             "(e[+-]?[0-9](_?[0-9])*)?$")
SPECIAL_SQL = "(?i)^[+-]?(nan|inf|infinity)$"


def _d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def margin_sql(m: LogisticModel, col_sql: dict[str, str] | None = None) -> str:
    col_sql = col_sql or {}
    z = _d(m.intercept)
    for c, w in m.weights.items():
        x = f"CAST({col_sql.get(c, c)} AS DOUBLE)"
        if c in m.scaler:
            center, scale = m.scaler[c]
            x = f"(({x} - {_d(center)}) / {_d(scale)})"
        z = f"({z} + {_d(w)} * {x})"
    for c, cats in m.onehot.items():
        for value, w in cats.items():
            z = f"({z} + CASE WHEN {col_sql.get(c, c)} = '{value}' THEN {_d(w)} ELSE {_d(0)} END)"
    return z


def proba_sql(m: LogisticModel, col_sql: dict[str, str] | None = None) -> str:
    return f"({_d(1.0)} / ({_d(1.0)} + exp(-({margin_sql(m, col_sql)}))))"


def pred_sql(p: str, t: str = _d(0.37)) -> str:
    return f"CAST(CASE WHEN {p} >= {t} AND NOT isnan({p}) THEN 1 ELSE 0 END AS INTEGER)"


def label_sql(pred: str) -> str:
    return f"CASE WHEN {pred} = 1 THEN 'Quitte' ELSE 'Reste' END"


def lenient_sql(raw: str) -> str:
    v = f"regexp_replace(replace({raw}, ',', '.'), '^\\s+|\\s+$', '', 'g')"
    return (f"CASE WHEN {raw} IS NULL OR {raw} = '' THEN {_d(0)} "
            f"WHEN regexp_matches({v}, '{FLOAT_SQL}') THEN TRY_CAST(replace({v}, '_', '') AS DOUBLE) "
            f"WHEN regexp_matches({v}, '{SPECIAL_SQL}') THEN "
            f"CASE WHEN lower({v}) LIKE '%nan' THEN CAST('nan' AS DOUBLE) ELSE TRY_CAST({v} AS DOUBLE) END "
            f"ELSE {_d(0)} END")


DIR_BASE = """
SELECT d.doc_id, concat('Doc #', CAST(d.doc_id AS VARCHAR)) AS libelle, l.quality
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""

ORDERS_P = proba_sql(SI.ORDERS_MODEL, {"montant": "o_totalprice"})
RESULTS_CTE = f"""
WITH r AS (
  SELECT o_orderkey AS id, o_custkey AS id_user, o_orderstatus AS prenom,
         o_orderpriority AS nom, {ORDERS_P} AS p
  FROM orders)
"""

EVENTS_P = proba_sql(SI.EVENTS_MODEL, {
    "k": "COALESCE(TRY_CAST(json_extract(props, '$.k') AS DOUBLE), 0.0)",
    "frequence_deplacement": "0.0"})
_PURCHASE = "event_type = 'purchase'"
SCORED_EVENTS = f"""
WITH s AS (SELECT *, {EVENTS_P} AS p FROM events)
SELECT {{extra}}
  CASE WHEN event_type = 'view' THEN 'John' ELSE event_type END AS prenom,
  CASE WHEN event_type = 'click' THEN 'Doe' ELSE 'U' || CAST(user_id AS VARCHAR) END AS nom,
  'top1' AS modele_utilise,
  round(p, 6) AS probabilite_de_quitter,
  {pred_sql('p')} AS prediction,
  {label_sql(pred_sql('p'))} AS libelle_prediction,
  {_d(0.37)} AS seuil_applique,
  CASE WHEN {_PURCHASE} THEN user_id END AS employe_id,
  user_id AS id_user,
  CASE WHEN COALESCE(CASE WHEN {_PURCHASE} THEN user_id END, 0) = 0
       THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS details_k
FROM s
"""

K_JSON = "COALESCE(TRY_CAST(json_extract(props, '$.k') AS DOUBLE), 0.0)"
P_TOP1 = proba_sql(SI.EVENTS_MODEL, {"k": K_JSON, "frequence_deplacement": "0.0"})
P_TOP2 = proba_sql(SI.EVENTS_MODEL_B, {"k": K_JSON, "statut_marital": "''"})
BY_MODEL = f"""
WITH s AS (
  SELECT event_id AS request_id,
         CASE event_type WHEN 'error' THEN 'ghost' WHEN 'click' THEN 'top2' ELSE 'top1' END AS modele,
         CASE WHEN event_type = 'click' THEN {P_TOP2} ELSE {P_TOP1} END AS p
  FROM events)
"""

TRAVEL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Fréquent' WHEN '2-HIGH' THEN ' Travel_Rarely '
  WHEN '3-MEDIUM' THEN 'AUCUN' WHEN '5-LOW' THEN NULL ELSE 'not specified' END"""
TRAVEL_CODE = """CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 2.0 WHEN '2-HIGH' THEN 1.0
  WHEN '3-MEDIUM' THEN 0.0 WHEN '5-LOW' THEN 0.0 END AS DOUBLE)"""
OVERTIME = "CASE o_orderstatus WHEN 'F' THEN 'Oui' WHEN 'O' THEN ' non ' END"
OVERTIME_CODE = "CAST(CASE o_orderstatus WHEN 'F' THEN 1.0 ELSE 0.0 END AS DOUBLE)"
ENC = f"""
SELECT o_orderkey, {TRAVEL} AS valeur, {TRAVEL_CODE} AS code,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN
    'unknown value for ''frequence_deplacement'': not specified. expected: [0, 1, 2, aucun, aucune, frequent, fréquent, non-travel, nontravel, occasionnel, rare, travel_frequently, travel_rarely, travelfrequently, travelrarely]'
  END AS reason
FROM orders
"""

LI_P = proba_sql(SI.LINEITEM_MODEL)

ERASED = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"
SURVIVOR = "EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id * 11)"

REG = """
WITH inc AS (
  SELECT 'u' || CAST(user_id * 11 AS VARCHAR) AS username, event_id, ts FROM events WHERE event_id % 500 <> 7
  UNION ALL SELECT NULL, event_id, ts FROM events WHERE event_id % 500 = 7),
r AS (SELECT *, row_number() OVER (PARTITION BY username ORDER BY ts, event_id) AS rn FROM inc),
s AS (SELECT DISTINCT 'u' || CAST(c_custkey AS VARCHAR) AS username FROM customer)
"""

DIRTY = f"""
SELECT l_orderkey, l_linenumber,
  CASE l_linenumber
    WHEN 1 THEN replace(CAST(l_quantity AS VARCHAR), '.', ',')
    WHEN 2 THEN ' ' || CAST(l_extendedprice AS VARCHAR) || ' '
    WHEN 3 THEN 'abc'
    WHEN 4 THEN ''
    WHEN 5 THEN NULL
    WHEN 6 THEN '+' || CAST(l_partkey AS VARCHAR) || 'e-3'
    ELSE CAST(l_quantity AS VARCHAR) || 'd' END AS raw
FROM lineitem
"""

FPA = "CASE l_returnflag WHEN 'R' THEN CAST(l_discount AS VARCHAR) WHEN 'A' THEN 'abc' END"

# Requests that name a model per part: the five kinds of models written out.
BY_REGISTRY = """
WITH r AS (
  SELECT event_id AS request_id, 'p' || (event_id % 2500) AS modele, CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
         CAST(user_id AS DOUBLE) AS revenu,
         CASE WHEN event_type = 'error' THEN 'alien' ELSE ['single', 'Married', 'divorced', ''][event_id % 4 + 1] END AS statut,
         ['Frequent', '2', ' rare '][event_id % 3 + 1] AS travel
  FROM events),
m AS (
  SELECT 'p' || p_partkey AS modele, p_partkey % 5 AS kind, (p_partkey % 3) * CAST(-0.5 AS DOUBLE) AS b,
         p_size / CAST(100 AS DOUBLE) AS wk, (p_partkey % 7) * CAST(0.01 AS DOUBLE) AS wr FROM part),
j AS (
  SELECT r.*, kind, b + wk * ((k - 50) / 29) AS base, wr,
         CASE statut WHEN 'single' THEN CAST(0.5 AS DOUBLE) WHEN 'Married' THEN CAST(-0.25 AS DOUBLE) END AS ws,
         CASE statut WHEN 'Married' THEN '1.0' WHEN 'divorced' THEN '2.0' ELSE '0.0' END AS code
  FROM r LEFT JOIN m USING (modele)),
s AS (
  SELECT *, kind IS NOT NULL AND (kind IN (0, 3) OR statut <> 'alien') AND (kind NOT IN (1, 2) OR ws IS NOT NULL) AS fits,
         base + CASE kind WHEN 0 THEN wr * revenu WHEN 2 THEN ws + CAST(0.125 AS DOUBLE)
           WHEN 3 THEN CAST(0.3 AS DOUBLE) * CASE travel WHEN ' rare ' THEN 1 ELSE 2 END ELSE coalesce(ws, 0) END AS z
  FROM j),
p AS (SELECT *, 1 / (1 + exp(-z)) AS p, ' of ' || chr(39) || 'statut_marital' || chr(39) AS where_,
             chr(39) || statut || chr(39) AS shown FROM s)
"""


# Eight files of events: every fifth again in the next file, every 50th three files late.
SENT = """
WITH span AS (SELECT epoch_us(min(ts)) AS lo, (epoch_us(max(ts)) - epoch_us(min(ts))) / 8 AS step FROM events),
own AS (SELECT event_id, ts, event_type, least(floor((epoch_us(ts) - lo) / step), 7)::INTEGER AS f FROM events, span),
sent AS (
  SELECT event_id, ts, event_type, CASE WHEN event_id % 50 = 9 THEN f + 3 ELSE f END AS f FROM own
  UNION ALL SELECT event_id, ts, event_type, f + 1 FROM own WHERE event_id % 50 <> 9 AND event_id % 5 = 0),
newest AS (SELECT f, max(max(epoch_us(ts))) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
           FROM sent WHERE f < 8 GROUP BY f),
arrived AS (SELECT event_id, ts, event_type, coalesce(epoch_us(ts) < seen - 1.5 * step, false) AS late
            FROM sent JOIN newest USING (f), span)
"""


ORACLE = {
    "directory_prefix": DIR_BASE + " WHERE CAST(d.doc_id AS VARCHAR) LIKE '1%' ORDER BY d.doc_id",
    "directory_all": DIR_BASE + " ORDER BY d.doc_id",
    "employee_record": """
        SELECT d.*, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
        WHERE d.doc_id IN (SELECT user_id FROM events)""",
    "label_filter": DIR_BASE + " WHERE l.quality = 1 ORDER BY d.doc_id",
    "label_flag": f"""SELECT *, COALESCE(quality = 1, false) AS already_left FROM ({DIR_BASE})
                      ORDER BY doc_id""",
    "missing_keys": """SELECT DISTINCT doc_id, 'not_found' AS reason FROM documents
                       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "history_by_owner": RESULTS_CTE + f"""
        SELECT id, id_user, prenom, nom, 'top1' AS modele_utilise,
               round(p, 6) AS probabilite_de_quitter, {pred_sql('p')} AS prediction,
               {label_sql(pred_sql('p'))} AS libelle_prediction, {_d(0.37)} AS seuil_applique
        FROM r WHERE id_user IN (SELECT user_id FROM events)
        ORDER BY id_user, id DESC""",
    "history_topk": """
        SELECT id, id_user, o_totalprice, position FROM (
          SELECT o_orderkey AS id, o_custkey AS id_user, o_totalprice,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS position
          FROM orders) WHERE position <= 20""",
    "history_counts": "SELECT o_custkey AS id_user, count(*) AS nb FROM orders GROUP BY o_custkey",
    "history_display": RESULTS_CTE + f"""
        SELECT id, concat_ws(' ', prenom, nom) AS nom_complet,
               {label_sql(pred_sql('p'))} AS libelle_prediction,
               printf('%.2f%%', p * 100.0) AS risque,
               printf('%.2f%%', 100.0 - p * 100.0) AS complement,
               round(p, 4) AS probabilite_4
        FROM r""",
    "name_ilike": """
        SELECT c_custkey, c_name, c_mktsegment FROM customer
        WHERE c_name ILIKE 'customer#%1' AND c_mktsegment ILIKE 'building'
        ORDER BY c_custkey DESC""",
    "detail_two_source": f"""
        SELECT e.event_id AS id,
          CASE WHEN e.{_PURCHASE} THEN e.user_id END AS employe_id,
          CASE WHEN e.{_PURCHASE} THEN 'employes_features' ELSE 'details_json' END AS source_features,
          CASE WHEN NOT e.{_PURCHASE} THEN CAST(json_extract(e.props, '$.k') AS BIGINT) END AS k,
          CASE WHEN e.{_PURCHASE} THEN c.c_name END AS c_name,
          CASE WHEN e.{_PURCHASE} THEN c.c_acctbal END AS c_acctbal,
          CAST(CASE WHEN e.{_PURCHASE} THEN (CASE WHEN c.c_custkey IS NULL THEN 0 ELSE 4 END)
               ELSE len(json_keys(e.props)) END AS BIGINT) AS n_features
        FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id AND e.{_PURCHASE}""",
    "lenient_float": f"SELECT *, {lenient_sql('raw')} AS val FROM ({DIRTY})",
    "derived_ratio_product": f"""
        SELECT l_orderkey, l_linenumber,
          round(CASE WHEN fpa IS NULL OR fpa = '' THEN
                  (CASE WHEN (l_quantity - 25) <> 0
                        THEN CAST(l_linenumber AS DOUBLE) / (l_quantity - 25) ELSE 0.0 END)
                ELSE {lenient_sql('fpa')} END, 6) AS formations_par_an,
          round(CAST(l_linenumber AS DOUBLE) * (l_tax * 100), 6) AS poste_x_niveau
        FROM (SELECT *, {FPA} AS fpa FROM lineitem)""",
    "encode_ok": f"SELECT o_orderkey, valeur, code FROM ({ENC}) WHERE reason IS NULL",
    "encode_rejected": f"SELECT o_orderkey, valeur, reason FROM ({ENC}) WHERE reason IS NOT NULL",
    "layout_numeric": f"""
        SELECT o_orderkey, o_totalprice AS montant, {TRAVEL_CODE} AS frequence_deplacement,
               {OVERTIME_CODE} AS heure_supplementaires, {_d(0)} AS absente
        FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "layout_mixed": f"""
        SELECT o_orderkey, o_totalprice AS montant, COALESCE({TRAVEL}, '') AS frequence_deplacement,
               COALESCE({OVERTIME}, '') AS heure_supplementaires, {_d(0)} AS absente
        FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "layout_aligned": f"""
        SELECT o_orderkey, o_totalprice AS montant, COALESCE({TRAVEL}, '') AS frequence_deplacement,
               {OVERTIME_CODE} AS heure_supplementaires, {_d(0)} AS absente
        FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "impute_defaults": """
        SELECT d.doc_id, COALESCE(l.quality, -1) AS quality, COALESCE(l.toxic, -1) AS toxic
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "logistic_score": f"""
        SELECT l_orderkey, l_linenumber, 'top1' AS modele_utilise,
               round({LI_P}, 6) AS probabilite_de_quitter, {pred_sql(LI_P)} AS prediction,
               {label_sql(pred_sql(LI_P))} AS libelle_prediction, {_d(0.37)} AS seuil_applique
        FROM lineitem""",
    "score_and_append": SCORED_EVENTS.replace("{extra}", ""),
    "stream_score": SCORED_EVENTS.replace("{extra}", "event_id AS request_id,"),
    "stream_to_results": SCORED_EVENTS.replace("{extra}", ""),
    "score_by_model": BY_MODEL + f"""
        SELECT request_id, modele AS modele_utilise, round(p, 6) AS probabilite_de_quitter,
               {pred_sql('p')} AS prediction, {label_sql(pred_sql('p'))} AS libelle_prediction,
               {_d(0.37)} AS seuil_applique
        FROM s WHERE modele <> 'ghost'""",
    "score_by_model_rejected": """
        SELECT event_id AS request_id, 'ghost' AS modele, 'unknown_model' AS reason
        FROM events WHERE event_type = 'error'""",
    "one_hot_sparse": """
        SELECT o_orderkey, i AS "index" FROM orders
        JOIN (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS i
              FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)) USING (o_custkey)""",
    "merged_statistics": " UNION ALL ".join(f"""
        SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS deviation,
               min(CAST({c} AS DOUBLE)) AS low, max(CAST({c} AS DOUBLE)) AS high FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")),
    "score_by_registry": BY_REGISTRY + f"""
        SELECT request_id, modele AS modele_utilise, round(p, 6) AS probabilite_de_quitter,
               {pred_sql('p')} AS prediction, {label_sql(pred_sql('p'))} AS libelle_prediction,
               CASE WHEN kind = 2 THEN 'dataframe_mixte' WHEN kind = 3 AND travel <> '2' THEN 'dataframe_float64'
                    ELSE 'dataframe_aligne' END AS format_entree,
               CAST(CASE WHEN kind = 2 THEN 3 ELSE 2 END AS BIGINT) AS nb_colonnes
        FROM p WHERE fits""",
    "score_by_registry_rejected": BY_REGISTRY + """
        SELECT request_id, modele, CASE WHEN kind IS NULL THEN 'unknown_model'
          WHEN statut = 'alien' THEN 'unknown value for ' || chr(39) || 'statut_marital' || chr(39)
            || ': alien. expected: [0, 1, 2, celibataire, célibataire, divorce, divorce(e), divorced, divorcé, '
            || 'divorcé(e), marie, marie(e), marié, marié(e), married, single]'
          ELSE 'no layout fits. dataframe_aligne: unknown category ' || CASE kind WHEN 1 THEN shown ELSE code END || where_
            || ' | dataframe_mixte: unknown category ' || shown || where_
            || ' | dataframe_float64: unknown category ' || code || where_ END AS reason
        FROM p WHERE NOT fits""",
    "stream_enrich": """
        SELECT e.event_id, e.user_id, c.c_name, c.c_acctbal
        FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id""",
    "registry_lookup": f"""
        SELECT o_orderkey,
          CASE o_orderstatus WHEN 'F' THEN 'top1' WHEN 'O' THEN 'top2' ELSE 'top3' END AS modele,
          CAST(CASE o_orderstatus WHEN 'F' THEN 2 ELSE 15 END AS BIGINT) AS nb_colonnes,
          CASE o_orderstatus WHEN 'F' THEN {_d(0.4)} ELSE {_d(0.37)} END AS seuil,
          CASE WHEN o_orderstatus IN ('F', 'O') THEN 'extraction_automatique'
               ELSE 'defaut_modele_non_charge' END AS source
        FROM orders""",
    "unknown_model": """
        SELECT o_orderkey, 'top3' AS modele, 'unknown_model' AS reason
        FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""",
    "roles_report": """
        WITH b AS (
          SELECT 'top1' AS name,
                 CASE o_orderstatus WHEN 'F' THEN 'onehot' WHEN 'O' THEN 'numeriques'
                      ELSE 'autres' END AS role,
                 o_orderpriority AS col, o_orderkey AS pos FROM orders),
        f AS (SELECT name, role, col, min(pos) AS first_pos FROM b GROUP BY name, role, col)
        SELECT name, role, string_agg(col, ',' ORDER BY first_pos) AS colonnes,
               count(*) AS nb_colonnes
        FROM f GROUP BY name, role""",
    "standardise": """
        WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS sd FROM lineitem)
        SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / sd, 6) AS scaled
        FROM lineitem, s""",
    "minmax": """
        WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
        SELECT l_orderkey, l_linenumber, round((l_extendedprice - lo) / (hi - lo), 6) AS scaled
        FROM lineitem, s""",
    "robust": """
        WITH s AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1,
                          quantile_cont(l_extendedprice, 0.5) AS q2,
                          quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
        SELECT l_orderkey, l_linenumber, round((l_extendedprice - q2) / (q3 - q1), 6) AS scaled
        FROM lineitem, s""",
    "impute_stat": """
        WITH j AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
        SELECT doc_id, round(COALESCE(CAST(quality AS DOUBLE), (SELECT avg(quality) FROM j)), 6)
               AS quality_filled
        FROM j""",
    "one_hot": """
        SELECT o_orderkey,
          CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS oh_1_URGENT,
          CAST(CASE WHEN o_orderpriority = '2-HIGH' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS oh_2_HIGH,
          CAST(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS oh_3_MEDIUM,
          CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1.0 ELSE 0.0 END AS DOUBLE)
            AS oh_4_NOT_SPECIFIED,
          CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS oh_5_LOW
        FROM orders""",
    "erase_users": f"""
        SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN {ERASED}""",
    "erase_report": f"""
        SELECT (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS users_deleted,
               (SELECT count(*) FROM orders WHERE o_custkey IN {ERASED}) AS results_deleted,
               CAST(0 AS BIGINT) AS unknown_users,
               (SELECT count(*) FROM customer) - (SELECT count(*) FROM customer WHERE c_acctbal < 0)
                 AS users_kept,
               (SELECT count(*) FROM orders WHERE o_custkey NOT IN {ERASED}) AS results_kept""",
    "register_unique": REG + """
        SELECT username, event_id FROM r
        WHERE rn = 1 AND username IS NOT NULL AND length(username) BETWEEN 3 AND 80
          AND username NOT IN (SELECT username FROM s)""",
    "register_rejected": REG + """
        SELECT username, event_id,
               CASE WHEN username IS NULL THEN 'missing_username'
                    WHEN length(username) NOT BETWEEN 3 AND 80 THEN 'username_length'
                    WHEN username IN (SELECT username FROM s) THEN 'already_exists'
                    ELSE 'duplicate' END AS reason
        FROM r WHERE username IS NULL OR length(username) NOT BETWEEN 3 AND 80
                     OR rn > 1 OR username IN (SELECT username FROM s)""",
    "stream_register": REG + """
        SELECT username, event_id FROM r
        WHERE rn = 1 AND username IS NOT NULL AND length(username) BETWEEN 3 AND 80
          AND username NOT IN (SELECT username FROM s)""",
    "stream_register_rejected": REG + """
        SELECT username, event_id,
               CASE WHEN username IS NULL THEN 'missing_username'
                    WHEN length(username) NOT BETWEEN 3 AND 80 THEN 'username_length'
                    WHEN username IN (SELECT username FROM s) THEN 'already_exists'
                    ELSE 'duplicate' END AS reason
        FROM r WHERE username IS NULL OR length(username) NOT BETWEEN 3 AND 80
                     OR rn > 1 OR username IN (SELECT username FROM s)""",
    "stream_dedup": SENT + """
        SELECT DISTINCT event_id AS request_id, ts, event_type FROM arrived WHERE NOT late""",
    "stream_late": SENT + "SELECT event_id AS request_id, 'late' AS side FROM arrived WHERE late",
    "validate_lengths": """
        SELECT c_custkey,
          CASE WHEN NOT regexp_matches(ident, '^[0-9]+$') THEN 'id_not_integer'
               WHEN NOT (length(trim(username)) BETWEEN 3 AND 80) THEN 'username_length'
               WHEN NOT (length(password) BETWEEN 4 AND 128) THEN 'password_length' END AS reason
        FROM (SELECT c_custkey, substring(c_name, 1, c_nationkey) AS username,
                     CASE WHEN c_nationkey < 4 THEN substring(c_mktsegment, 1, 3)
                          ELSE c_mktsegment END AS password,
                     CAST(c_custkey AS VARCHAR) ||
                       CASE WHEN c_nationkey = 7 THEN 'x' ELSE '' END AS ident
              FROM customer)""",
    "history_of_owner": RESULTS_CTE + f"""
        SELECT id, prenom, nom, round(p, 6) AS probabilite_de_quitter
        FROM r WHERE id_user = 7 AND prenom ILIKE '%f%' ORDER BY id DESC""",
    "history_no_owner": """
        SELECT o_orderkey AS id, o_custkey AS id_user FROM orders
        WHERE o_custkey IN (SELECT user_id * 7 FROM events WHERE event_type <> 'error')""",
    "record_one": """SELECT d.*, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
                     WHERE d.doc_id = 11 LIMIT 1""",
    "results_json": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 4 > 0 THEN o_totalprice END AS p
        FROM orders""",
    "strict_numbers": """
        SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN NULL
          WHEN 1 THEN l_quantity WHEN 2 THEN NULL ELSE -l_quantity * 100 END AS strict,
          CASE l_linenumber % 4 WHEN 2 THEN 0 WHEN 0 THEN 0 WHEN 3 THEN -l_quantity * 100
            ELSE l_quantity END AS leading
        FROM lineitem""",
    "append_mixed": """
        SELECT count(*) AS n_rows, count(*) AS n_ids, 1 AS first_id, count(*) AS last_id,
               sum(user_id) AS users FROM events""",
    "erase_then_append": """
        SELECT (SELECT count(*) FROM events WHERE user_id % 2 = 1) + count(*) AS n_rows,
               count(*) + (SELECT count(*) FROM events WHERE user_id % 2 = 1) AS n_ids,
               count(*) + 1 AS first_new_id FROM events""",
    "requests_ok": f"""
        SELECT event_id AS request_id, round(1 / (1 + exp(-(
            CAST(-1.0 AS DOUBLE) + CAST(0.03 AS DOUBLE) *
              ((CASE WHEN event_id % 10 = 5 THEN 6 ELSE CAST(props->>'k' AS DOUBLE) END) - 50.0) / 29.0))), 6)
          AS probabilite_de_quitter
        FROM events WHERE event_id % 10 > 4""",
    "requests_rejected": """
        SELECT event_id AS request_id, CASE event_id % 10 WHEN 0 THEN 'missing_features'
          WHEN 1 THEN 'features_not_json' WHEN 2 THEN 'features_not_an_object'
          WHEN 3 THEN 'value of ''k'' is not finite' ELSE 'missing_model' END AS reason
        FROM events WHERE event_id % 10 <= 4""",
    "impute_median": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN
            (SELECT quantile_cont(o_totalprice, 0.5) FROM orders WHERE o_orderkey % 3 <> 0)
            ELSE o_totalprice END AS price, CAST(NULL AS DOUBLE) AS nothing
        FROM orders""",
    "orphan_audit": f"""
        SELECT e.event_id, e.user_id * 11 AS employe_id FROM events e WHERE NOT {SURVIVOR}""",
    "orphan_repair": f"""
        SELECT e.event_id, CASE WHEN {SURVIVOR} THEN e.user_id * 11 END AS employe_id FROM events e""",
    "table_count": "SELECT count(*) AS n FROM lineitem",
    "load_if_empty": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "evolve_schema": """
        SELECT c_custkey AS id, c_name AS name, CAST(NULL AS INTEGER) AS nationkey FROM customer
        UNION ALL
        SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nationkey FROM supplier""",
    "csv_roundtrip": """
        SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice
        FROM part""",
    "positional_join": """
        SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey, o_totalprice,
               o_orderpriority, o_orderstatus
        FROM orders""",
}
