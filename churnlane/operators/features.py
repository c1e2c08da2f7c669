"""Feature engineering: derivation, category encoding, contract layouts.

FE-1 derive, FE-2 encode (ok | rejected), FE-3 numeric layout, FE-4 mixed
layout, FE-5 aligned layout, FE-6 impute, FE-7 carry descriptive fields,
PRJ-6 contract projection, JOI-7 dictionary lookup, AGG-5 accepted values.

A feature value can come from a typed table column or from a free-form JSON
object (a request's ``features``).  Both are wrapped in :class:`Value`, which
keeps the value's *kind* (null / number / boolean / string) as a Column, so
the rules that depend on the Python type of the value (T8: a number goes
through the encoder unchecked, a boolean is encoded through its text) hold
per row even when the JSON types vary from row to row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane import schemas as S
from churnlane.functions import clean

NULL, NUMBER, BOOL, STRING = "null", "number", "bool", "string"


def qcol(name: str) -> Column:
    """A column by its literal name (names may contain dots or spaces)."""
    return F.col("`" + name.replace("`", "``") + "`")
REASON = "_reason"


@dataclass
class Value:
    """One feature value: its kind, its text form and its numeric form.

    ``static`` is the kind when every non-null row has it (a typed column);
    rules then compile to plain arithmetic instead of per-row kind tests.
    It is None for JSON values, whose kind varies per row.
    """
    kind: Column   # one of NULL / NUMBER / BOOL / STRING
    text: Column   # str(value) as the service would print it; null for NULL
    num: Column    # double for NUMBER / BOOL, else null
    static: str | None = None

    @staticmethod
    def number(c: Column) -> "Value":
        c = c.cast("double")
        return Value(F.when(c.isNull(), F.lit(NULL)).otherwise(F.lit(NUMBER)),
                     _num_text(c), c, NUMBER)

    @staticmethod
    def absent() -> "Value":
        return Value(F.lit(NULL), F.lit(None).cast("string"), F.lit(None).cast("double"), NULL)


def _num_text(c: Column) -> Column:
    # Python prints whole floats as "35.0"; integers stay integers when the
    # input was integral, which the caller handles via from_column.
    return c.cast("string")


def from_column(df: DataFrame, name: str) -> Value:
    """Wrap a typed column; an absent column is an absent value."""
    if name not in df.columns:
        return Value.absent()
    dtype = df.schema[name].dataType
    c = qcol(name)
    if isinstance(dtype, T.BooleanType):
        return Value(F.when(c.isNull(), F.lit(NULL)).otherwise(F.lit(BOOL)),
                     F.when(c, F.lit("True")).when(~c, F.lit("False")),
                     c.cast("double"), BOOL)
    if isinstance(dtype, (T.IntegralType,)):
        return Value(F.when(c.isNull(), F.lit(NULL)).otherwise(F.lit(NUMBER)),
                     c.cast("string"), c.cast("double"), NUMBER)
    if isinstance(dtype, T.NumericType):
        return Value.number(c)
    c = c.cast("string")
    return Value(F.when(c.isNull(), F.lit(NULL)).otherwise(F.lit(STRING)), c,
                 F.lit(None).cast("double"), STRING)


def from_variant(v: Column, key: str) -> Value:
    """Wrap ``v[key]`` of a VARIANT object, keeping the JSON type per row."""
    field = F.try_variant_get(v, f"$.{key}", "variant")
    typ = F.schema_of_variant(field)
    kind = (F.when(field.isNull() | (typ == "VOID") | (typ == "NULL"), F.lit(NULL))
            .when(typ == "BOOLEAN", F.lit(BOOL))
            .when(typ.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"),
                  F.lit(NUMBER))
            .otherwise(F.lit(STRING)))
    as_text = F.try_variant_get(field, "$", "string")
    text = (F.when(kind == BOOL, F.initcap(as_text))
            .when(kind == STRING, F.coalesce(as_text, F.to_json(field)))
            .when(kind == NUMBER, as_text))
    num = F.when(kind.isin(NUMBER, BOOL), F.try_variant_get(field, "$", "double"))
    return Value(kind, text, num)


def values_from_json(json_col, keys: list[str]) -> tuple[Column, dict[str, Value]]:
    """Parse a JSON-object text column (as VARIANT) and wrap ``keys``.

    Expression form (for small projections); prefer :func:`with_json_values`
    on a DataFrame, which computes each field once.
    """
    v = F.try_parse_json(clean._c(json_col))
    return v, {k: from_variant(v, k) for k in keys}


def json_path(key: str) -> str | None:
    """A variant path for one top-level key (dots allowed), or None when the
    key holds both quote characters and no path can name it."""
    if "'" not in key:
        return f"$['{key}']"
    if '"' not in key:
        return f'$["{key}"]'
    return None


def _field_of(v: Column, key: str) -> Column:
    path = json_path(key)
    if path is not None:
        return F.try_variant_get(v, path, "variant")
    return F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), F.lit(key))


def with_json_values(df: DataFrame, json_col: str, keys: list[str]) -> tuple[DataFrame, dict[str, Value]]:
    """Parse ``json_col`` once and materialise each key's kind/text/number.

    Three stacked projections: the VARIANT, then each key's field, then its
    kind / text / number.  The rules then reference plain columns, so the
    parse and the per-key type tests run once per row instead of once per
    use (the optimizer keeps expensive shared expressions un-inlined).
    Helper columns are named by position (``_cl_<i>...``), so any key text is
    safe, and are dropped by :func:`prepare`.
    """
    if not keys:
        return df, {}
    # of a repeated key the last value counts, as the service's parser has it
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    out = df.withColumn("_cl_variant", F.try_parse_json(qcol(json_col)))
    out = out.withColumns({f"_cl_{i}__f": _field_of(F.col("_cl_variant"), k)
                           for i, k in enumerate(keys)})
    out = out.withColumns({f"_cl_{i}__t": F.schema_of_variant(F.col(f"_cl_{i}__f"))
                           for i in range(len(keys))})
    kinds = {}
    for i in range(len(keys)):
        field, typ = F.col(f"_cl_{i}__f"), F.col(f"_cl_{i}__t")
        kinds[f"_cl_{i}__k"] = (
            F.when(field.isNull() | typ.isin("VOID", "NULL"), F.lit(NULL))
            .when(typ == "BOOLEAN", F.lit(BOOL))
            .when(typ.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
                  | typ.startswith("DECIMAL"), F.lit(NUMBER))
            .otherwise(F.lit(STRING)))
    out = out.withColumns(kinds)
    fields = []
    for i in range(len(keys)):
        field, kind = F.col(f"_cl_{i}__f"), F.col(f"_cl_{i}__k")
        as_text = F.try_variant_get(field, "$", "string")
        fields += [
            kind.alias(f"_cl_{i}__kind"),
            F.when(kind == BOOL, F.initcap(as_text))
            .when(kind == STRING, F.coalesce(as_text, F.to_json(field)))
            .when(kind == NUMBER, as_text).alias(f"_cl_{i}__s"),
            F.when(kind.isin(NUMBER, BOOL), F.try_variant_get(field, "$", "double"))
            .alias(f"_cl_{i}__n"),
        ]
    # inline(array(struct)) materialises the per-key values once per row: a
    # later filter on them (ok | rejected) cannot be pushed below this
    # Generate, so it does not re-run the parse inside the filter condition.
    helper = [c for c in out.columns if c.startswith("_cl_")]
    out = out.select(*[qcol(c) for c in out.columns if c not in helper],
                     F.inline(F.array(F.struct(*fields))))
    return out, {k: Value(F.col(f"_cl_{i}__kind"), F.col(f"_cl_{i}__s"), F.col(f"_cl_{i}__n"))
                 for i, k in enumerate(keys)}


def request_problem(requests: DataFrame, features_col: str, model_col: str | None = None,
                    parsed: Column | None = None) -> Column:
    """FLT-12: why a request cannot be scored at all, null when it can.

    ``features`` must be there and be a JSON object, the model must be named
    and a threshold, where the table has the column, must be given and be a number.
    ``parsed`` is the features' VARIANT where the caller has it already.
    """
    requests.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    raw = qcol(features_col)
    kind = F.schema_of_variant(F.try_parse_json(raw) if parsed is None else parsed)
    out = (F.when(raw.isNull(), F.lit("missing_features"))
           .when(kind.isNull(), F.lit("features_not_json"))
           .when(~kind.startswith("OBJECT"), F.lit("features_not_an_object")))
    if model_col is not None:
        out = F.when(qcol(model_col).isNull(), F.lit("missing_model")).otherwise(out)
    if "seuil" in requests.columns:
        seuil = F.col("seuil").cast("double")
        out = F.coalesce(out, F.when(seuil.isNull() | F.isnan(seuil), F.lit("missing_threshold")))
    return out


def values_from_columns(df: DataFrame, keys: list[str]) -> dict[str, Value]:
    return {k: from_column(df, k) for k in keys}


# ---------------------------------------------------------------- SCA-1 / 18

def is_blank(x: Value) -> Column:
    """SCA-18 on a value: null, or the empty string."""
    if x.static == NULL:
        return F.lit(True)
    if x.static in (NUMBER, BOOL):
        return x.num.isNull()
    if x.static == STRING:
        return clean.is_blank(x.text)
    return (x.kind == NULL) | ((x.kind == STRING) & (x.text == ""))


def lenient_float(x: Value, default: float = 0.0) -> Column:
    """SCA-1 on a value (number/boolean -> float, text -> guarded parse)."""
    if x.static == NULL:
        return F.lit(float(default))
    if x.static in (NUMBER, BOOL):
        return F.coalesce(x.num, F.lit(float(default)))
    if x.static == STRING:
        return clean.to_float(x.text, default=default)
    return (F.when(x.kind.isin(NUMBER, BOOL), x.num)
            .when(x.kind == STRING, clean.to_float(x.text, default=default))
            .otherwise(F.lit(float(default))))


def numeric(c: Column) -> Value:
    return Value.number(c)


# ---------------------------------------------------------------------- FE-1

def derive(vals: dict[str, Value]) -> dict[str, Value]:
    """FE-1: fill formations_par_an / poste_x_niveau only where blank.

    A supplied non-blank value is kept and passed through the lenient float
    (so a bad text becomes 0.0 and is not recomputed).  Idempotent.
    """
    out = dict(vals)
    get = lambda k: vals.get(k, Value.absent())
    fpa, pxn = get("formations_par_an"), get("poste_x_niveau")
    exp = lenient_float(get("annee_experience_totale"))
    nb = lenient_float(get("nb_formations_suivies"))
    ratio = clean.safe_ratio(nb, exp)
    product = lenient_float(get("niveau_hierarchique_poste")) * lenient_float(get("niveau_education"))
    out["formations_par_an"] = numeric(F.when(is_blank(fpa), ratio).otherwise(lenient_float(fpa)))
    out["poste_x_niveau"] = numeric(F.when(is_blank(pxn), product).otherwise(lenient_float(pxn)))
    # Derived values are never null, so their kind is a number on every row.
    return out


# ---------------------------------------------------------------------- FE-2

def code_map(column: str) -> Column:
    """JOI-7: the column's dictionary as a literal map (fixed, tiny)."""
    codes = S.CATEGORY_CODES.get(column, {})
    if not codes:
        return F.create_map().cast("map<string,double>")
    pairs = []
    for k, v in codes.items():
        pairs += [F.lit(k), F.lit(float(v))]
    return F.create_map(*pairs)


def accepted_values(column: str) -> str:
    """AGG-5: sorted distinct accepted texts, as shown in the rejection reason."""
    return ", ".join(sorted(set(S.CATEGORY_CODES.get(column, {}).keys())))


def encode(column: str, x: Value) -> tuple[Column, Column]:
    """FE-2: (code, unknown flag).

    blank -> 0.0; a number passes through as float (not checked against the
    dictionary); text and booleans are normalised (strip + lower) and looked
    up; anything not found is unknown (code null, flag true).
    """
    if x.static == NULL:
        return F.lit(0.0), F.lit(False)
    if x.static == NUMBER:
        return F.coalesce(x.num, F.lit(0.0)), F.lit(False)
    looked = F.try_element_at(code_map(column), clean.strip_lower(x.text))
    is_number = F.lit(False) if x.static in (STRING, BOOL) else (x.kind == NUMBER)
    code = (F.when(is_blank(x), F.lit(0.0))
            .when(is_number, x.num)
            .otherwise(looked))
    unknown = ~is_blank(x) & ~is_number & looked.isNull()
    return code, unknown


def unknown_reason(column: str, x: Value) -> Column:
    return F.concat(F.lit(f"unknown value for '{column}': "), F.coalesce(x.text, F.lit("")),
                    F.lit(f". expected: [{accepted_values(column)}]"))


def raw_text(x: Value) -> Column:
    """FE-4: category kept as raw text (no strip / lower); null -> ''."""
    return F.coalesce(x.text, F.lit(""))


# ------------------------------------------------------------ FE-3 / 4 / 5

NUMERIC_LAYOUT, MIXED_LAYOUT, ALIGNED_LAYOUT = "numeric", "mixed", "aligned"


def onehot_set(onehot: list[str] | None) -> set[str]:
    """T12: an empty one-hot list means every categorical column is text."""
    return set(onehot) if onehot else set(S.CATEGORICAL_COLUMNS)


def layout_columns(vals: dict[str, Value], columns: list[str], layout: str,
                   onehot: list[str] | None = None) -> tuple[list[Column], Column]:
    """Project values onto the contract ``columns`` in order (PRJ-6).

    Returns the output columns and a reason Column (null when the row is
    fine).  Absent columns become 0.0 (numbers) or '' (text).  The reason
    reflects the numeric encoding of every categorical column, as the service
    always builds the numeric layout: an unknown category rejects the row
    whatever layout the model uses.  A number that is not finite rejects it too.
    """
    vals = derive(vals)
    text_cols = set()
    if layout == MIXED_LAYOUT:
        text_cols = set(S.CATEGORICAL_COLUMNS)
    elif layout == ALIGNED_LAYOUT:
        text_cols = onehot_set(onehot)
    out, reasons = [], []
    for c in columns:
        x = vals.get(c, Value.absent())
        if c in S.CATEGORICAL_COLUMNS:
            code, unknown = encode(c, x)
            reasons.append(F.when(unknown, unknown_reason(c, x)))
            if c in text_cols:
                out.append(raw_text(x).alias(c))
            else:
                out.append(code.alias(c))
        elif c in text_cols:          # aligned: a non-categorical one-hot column
            out.append(raw_text(x).alias(c))
        else:
            number = lenient_float(x).cast("double")
            reasons.append(F.when(F.isnan(number) | (F.abs(number) == float("inf")),
                                  F.lit(f"value of '{c}' is not finite")))
            out.append(number.alias(c))
    reason = F.coalesce(*reasons) if len(reasons) > 1 else (
        reasons[0] if reasons else F.lit(None).cast("string"))
    return out, reason


def prepare(df: DataFrame, vals: dict[str, Value], columns: list[str],
            layout: str = NUMERIC_LAYOUT, onehot: list[str] | None = None,
            keep: list[str] | None = None) -> DataFrame:
    """One select: kept columns + contract columns + ``_reason``."""
    cols, reason = layout_columns(vals, columns, layout, onehot)
    keep = keep or []
    return df.select(*[qcol(k) for k in keep], *cols, reason.alias(REASON))


def split_ok_rejected(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ok rows (reason null, reason column dropped) and rejected rows."""
    ok = prepared.where(F.col(REASON).isNull()).drop(REASON)
    rejected = prepared.where(F.col(REASON).isNotNull())
    return ok, rejected


# ---------------------------------------------------------------------- FE-6

def impute_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """FE-6: fill missing inputs with fixed per-column defaults."""
    defaults = S.FORM_DEFAULTS if defaults is None else defaults
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.na.fill(present) if present else df


def pack_descriptive(cols: list[str]) -> Column:
    """FE-7: carry unscored descriptive fields as one JSON text column."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
