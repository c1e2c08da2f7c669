"""Scoring: logistic model as a column expression, threshold and label.

ML-1 score (one layout chosen per model), ML-2 predict, ML-3 label, SCA-5
threshold (inclusive, NaN-safe: T2), SCA-6 label text, SCA-9 positive-class
probability, DEL-1 logistic regression (fit with pyspark.ml, scored as an
expression), DEL-2 one-hot, DEL-3 standard scaler (population deviation),
DEL-4 min-max, DEL-5 robust scaler (exact distributed quantiles), DEL-6
imputer, DEL-7 function transformer, DEL-8 external scaler before the model.

The model is metadata bounded by the number of features, never by the data:
its coefficients become literals in one expression, which whole-stage
codegen compiles.  Statistics (mean, deviation, quantiles) are computed by
one distributed aggregate and likewise become literals (Estimator -> Model).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane import schemas as S
from churnlane.operators import features as FE
from churnlane.session import cut_lineage

PROBA, PREDICTION, LABEL, THRESHOLD = ("probabilite_de_quitter", "prediction",
                                       "libelle_prediction", "seuil_applique")


@dataclass
class LogisticModel:
    """Coefficients of a (possibly scaled, possibly one-hot) logistic model."""
    name: str
    columns: list[str]
    intercept: float
    weights: dict[str, float] = field(default_factory=dict)
    # DEL-8: per-column (center, scale) applied before the weights.
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    # DEL-2: per-column {category text: weight} for one-hot encoded inputs.
    onehot: dict[str, dict[str, float]] = field(default_factory=dict)
    threshold: float | None = None

    @property
    def layout(self) -> str:
        """ML-1: one layout per model, from its roles (not per-row trial)."""
        return FE.ALIGNED_LAYOUT if self.onehot else FE.NUMERIC_LAYOUT

    def margin(self, col: Callable[[str], Column] = FE.qcol) -> Column:
        """b + sum(w * scaled x) + one-hot terms; ``col`` resolves input names."""
        z = F.lit(float(self.intercept))
        for c, w in self.weights.items():
            x = col(c).cast("double")
            if c in self.scaler:
                center, scale = self.scaler[c]
                x = (x - F.lit(float(center))) / F.lit(float(scale))
            z = z + F.lit(float(w)) * x
        for c, cats in self.onehot.items():
            for value, w in cats.items():
                z = z + F.when(col(c) == F.lit(value), F.lit(float(w))).otherwise(F.lit(0.0))
        return z

    def probability(self, col: Callable[[str], Column] = FE.qcol) -> Column:
        """SCA-9: positive-class probability, 1 / (1 + exp(-z))."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(col)))


def model_from_table(coefficients: DataFrame, name: str) -> LogisticModel:
    """Build a model from a coefficient table.

    Columns: model, feature, category (null for numeric), weight,
    center, scale (nullable).  A feature named '__intercept__' holds the
    intercept; '__threshold__' an optional saved threshold.  The table is
    model metadata: one row per coefficient of the models to be loaded.
    """
    return _model(name, coefficients.where(F.col("model") == name).toLocalIterator())


def models_from_table(coefficients: DataFrame) -> dict[str, LogisticModel]:
    """Every model of the table, in one job."""
    rows: dict[str, list] = {}
    for r in coefficients.toLocalIterator():
        rows.setdefault(r["model"], []).append(r)
    return {name: _model(name, own) for name, own in rows.items()}


def _model(name: str, rows) -> LogisticModel:
    m = LogisticModel(name=name, columns=[], intercept=0.0)
    for r in rows:
        if r["feature"] == "__intercept__":
            m.intercept = float(r["weight"])
        elif r["feature"] == "__threshold__":
            m.threshold = float(r["weight"])
        elif r["category"] is not None:
            m.onehot.setdefault(r["feature"], {})[r["category"]] = float(r["weight"])
            if r["feature"] not in m.columns:
                m.columns.append(r["feature"])
        else:
            m.weights[r["feature"]] = float(r["weight"])
            if r["center"] is not None and r["scale"] is not None:
                m.scaler[r["feature"]] = (float(r["center"]), float(r["scale"]))
            if r["feature"] not in m.columns:
                m.columns.append(r["feature"])
    return m


def threshold_predicate(p: Column, t: Column) -> Column:
    """FLT-10 / T2: ``p >= t`` inclusive, and NaN never passes."""
    return (p >= t) & ~F.isnan(p)


def binarise(p: Column, t: Column) -> Column:
    """SCA-5: 1 if p >= t (NaN-safe) else 0."""
    return F.when(threshold_predicate(p, t), F.lit(1)).otherwise(F.lit(0)).cast("int")


def label_text(pred: Column) -> Column:
    """SCA-6: 1 -> Quitte, else Reste."""
    return F.when(pred == 1, F.lit(S.LABEL_POSITIVE)).otherwise(F.lit(S.LABEL_NEGATIVE))


def score(df: DataFrame, model: LogisticModel, threshold=S.DEFAULT_THRESHOLD,
          proba_digits: int | None = None) -> DataFrame:
    """ML-2 + ML-3: add probability, class, label, threshold and model name.

    ``df`` holds the model's columns (already aligned).  ``threshold`` is the
    request's (T11): a float or a Column (per-row ``seuil``).
    """
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    p = model.probability()
    scored = df.withColumns({"_cl_p": p, THRESHOLD: t.cast("double")})
    pred = binarise(F.col("_cl_p"), F.col(THRESHOLD))
    proba = F.col("_cl_p") if proba_digits is None else F.round("_cl_p", proba_digits)
    return (scored.withColumns({
        "modele_utilise": F.lit(model.name),
        PROBA: proba,
        PREDICTION: pred,
        LABEL: label_text(pred),
    }).drop("_cl_p"))


def score_with(df: DataFrame, predict: Callable, columns: list[str],
               out_col: str = PROBA) -> DataFrame:
    """Arbitrary model plug-in (2.13): ``predict(pandas_frame) -> array``.

    Runs per Arrow batch through mapInPandas.  Use only when the model is not
    expressible as columns; the logistic path above stays JVM-side.
    """
    import numpy as np

    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.DoubleType(), True)])

    def run(batches):
        for pdf in batches:
            out = np.asarray(predict(pdf[columns].astype("float64")))
            proba = out[:, 1] if out.ndim == 2 and out.shape[1] >= 2 else out.ravel()
            yield pdf.assign(**{out_col: proba.astype("float64")})

    return df.mapInPandas(run, schema)


# ---------------------------------------------------------------- DEL-3..6

def fit_standard(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """DEL-3: center = mean, scale = population standard deviation."""
    row = df.agg(*[F.avg(c).alias(f"{c}__m") for c in cols],
                 *[F.stddev_pop(c).alias(f"{c}__s") for c in cols]).first()
    return {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols}


def fit_minmax(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """DEL-4: center = min, scale = max - min."""
    row = df.agg(*[F.min(c).alias(f"{c}__lo") for c in cols],
                 *[F.max(c).alias(f"{c}__hi") for c in cols]).first()
    return {c: (row[f"{c}__lo"], row[f"{c}__hi"] - row[f"{c}__lo"]) for c in cols}


def exact_quantiles_of(df: DataFrame, cols: list[str], probs: list[float],
                       accuracy: int = 1000) -> dict[str, list[float]]:
    """Exact linearly-interpolated quantiles of several columns, in two scans.

    Position h = (n - 1) * q; the value is x[floor h] + frac * (x[floor h + 1]
    - x[floor h]).  One ``percentile_approx`` brackets every rank of every
    column; one more scan counts the values below each bracket and keeps those
    inside (about 6 / ``accuracy`` of the rows per rank), which are then
    counted by value and ranked on their own.  A bracket that misses its rank
    (it would break the sketch's error bound) is widened to the whole column,
    so the result is exact either way.  A column without values gives NaN.
    """
    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    slack = 3.0 / accuracy
    sides = [s for q in probs for s in (max(0.0, q - slack), min(1.0, q + slack))]
    first = x.agg(*[F.count(f"x{i}").alias(f"n{i}") for i in range(len(cols))],
                  *[F.percentile_approx(f"x{i}", sides, accuracy).alias(f"p{i}") for i in range(len(cols))]).first()
    brackets = []  # (column, probability, low, high)
    for i in range(len(cols)):
        if first[f"n{i}"]:
            p = first[f"p{i}"]
            brackets += [(i, j, p[2 * j], p[2 * j + 1]) for j in range(len(probs))]
    found: dict[tuple[int, int], float] = {}
    while brackets:
        inside = F.array(*[F.when((F.col(f"x{i}") >= lo) & (F.col(f"x{i}") <= hi),
                                  F.struct(F.lit(b).alias("b"), F.col(f"x{i}").alias("x")))
                           for b, (i, _, lo, hi) in enumerate(brackets)])
        below = x.agg(*[F.count(F.when(F.col(f"x{i}") < lo, 1)).alias(f"b{b}")
                        for b, (i, _, lo, _) in enumerate(brackets)]).first()
        counts = cut_lineage(x.select(F.explode(F.filter(inside, lambda s: s.isNotNull())).alias("s"))
                             .groupBy("s.b", "s.x").agg(F.count(F.lit(1)).alias("n")))
        again = []
        for b, (i, j, lo, hi) in enumerate(brackets):
            n, h = first[f"n{i}"], (first[f"n{i}"] - 1) * probs[j]
            ranks = [int(h), min(int(h) + 1, n - 1)]
            got = _at_ranks(counts.where(F.col("b") == b).select("x", "n"), [r - below[f"b{b}"] for r in ranks])
            if None in got:
                again.append((i, j, float("-inf"), float("inf")))
            else:
                found[i, j] = got[0] + (h - int(h)) * (got[1] - got[0])
        brackets = again
    return {c: [found.get((i, j), float("nan")) for j in range(len(probs))] for i, c in enumerate(cols)}


def _at_ranks(counts: DataFrame, ranks: list[int]) -> list[float | None]:
    """The values at 0-based ``ranks`` of a table (x, n) of distinct values; None outside it.

    Running counts per range partition plus the partitions' offsets (one row
    each); only the rows at the ranks reach the driver.
    """
    ranged = cut_lineage(counts.repartitionByRange("x").withColumn("pid", F.spark_partition_id()))
    inner = Window.partitionBy("pid").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("pid").agg(F.sum("n").alias("tot")).select(
        "pid", F.coalesce(F.sum("tot").over(before), F.lit(0)).alias("off"))
    cum = (ranged.withColumn("cum", F.sum("n").over(inner)).join(F.broadcast(offsets), "pid")
           .select("x", (F.col("cum") + F.col("off")).alias("upto"), "n"))
    wanted = F.lit(False)
    for r in set(ranks):
        wanted = wanted | ((F.col("upto") - F.col("n") <= r) & (F.col("upto") > r))
    hits = cum.where(wanted).collect()   # one row per rank at most
    return [next((float(t["x"]) for t in hits if t["upto"] - t["n"] <= r < t["upto"]), None) for r in ranks]


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float]:
    """Exact quantiles of one column (see :func:`exact_quantiles_of`)."""
    return exact_quantiles_of(df, [col], probs)[col]


def fit_robust(df: DataFrame, cols: list[str], exact: bool = True,
               accuracy: int = 10000) -> dict[str, tuple[float, float]]:
    """DEL-5: center = median, scale = p75 - p25.

    ``exact=True`` uses :func:`exact_quantiles_of`, all columns at once;
    otherwise one ``percentile_approx`` aggregate (bounded memory sketch).
    """
    out = {}
    if exact:
        for c, (q25, q50, q75) in exact_quantiles_of(df, cols, [0.25, 0.5, 0.75]).items():
            out[c] = (q50, q75 - q25)
        return out
    row = df.agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy).alias(c)
                   for c in cols]).first()
    for c in cols:
        q25, q50, q75 = row[c]
        out[c] = (q50, q75 - q25)
    return out


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]],
                 suffix: str = "") -> DataFrame:
    """(x - center) / scale with literals; a zero scale leaves x - center."""
    cols = {}
    for c, (center, scale) in stats.items():
        s = scale if scale not in (0, None) else 1.0
        cols[c + suffix] = (F.col(c).cast("double") - F.lit(float(center))) / F.lit(float(s))
    return df.withColumns(cols)


def fit_impute_mean(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """DEL-6: per-column mean of the present values (None when none is present)."""
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fit_impute_median(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """DEL-6: per-column exact median of the present values (None when none is present)."""
    medians = exact_quantiles_of(df, cols, [0.5])
    return {c: None if math.isnan(m) else m for c, (m,) in medians.items()}


def apply_impute(df: DataFrame, fills: dict[str, float | None], suffix: str = "") -> DataFrame:
    """Fill missing values; a column without a fill (all missing at the fit) stays as it is."""
    return df.withColumns({
        c + suffix: F.col(c).cast("double") if v is None else F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
        for c, v in fills.items()})


def one_hot(df: DataFrame, col: str, categories: list[str], prefix: str | None = None) -> DataFrame:
    """DEL-2: one indicator column (double) per known category.

    Columns are named by the category; of categories whose names would be
    the same, the later ones get their position in the vocabulary as well.
    """
    prefix = prefix or col
    names: dict[str, str] = {}
    for i, v in enumerate(categories):
        name = f"{prefix}_{_safe(v)}"
        names[name if name not in names else f"{name}_{i}"] = v
    return df.withColumns({
        name: F.when(F.col(col) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)) for name, v in names.items()})


def _safe(v: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in str(v))


def vocabulary(df: DataFrame, col: str, max_size: int = 10_000) -> list[str]:
    """Distinct categories of ``col``, sorted: one per indicator column of :func:`one_hot`.

    More than ``max_size`` are an error, and never go to the driver.
    """
    vals = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_size + 1).collect()
    if len(vals) > max_size:
        raise ValueError(f"{col} has more than {max_size} categories")
    return sorted(r[0] for r in vals)


def apply_function(df: DataFrame, col: str, fn: Callable[[Column], Column],
                   out: str | None = None) -> DataFrame:
    """DEL-7: a function transformer is a column expression."""
    return df.withColumn(out or col, fn(F.col(col)))


# ---------------------------------------------------------------- DEL-1 fit

def fit_logistic(df: DataFrame, feature_cols: list[str], label_col: str, name: str,
                 standardize: bool = True, max_iter: int = 50,
                 reg_param: float = 0.0) -> LogisticModel:
    """DEL-1 / DEL-8: fit with pyspark.ml, return the model as coefficients.

    Standardisation statistics come from one aggregate; the fitted
    weights apply to the standardised columns, so scoring is one expression.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    stats = fit_standard(df, feature_cols) if standardize else {}
    prepared = apply_scaler(df, stats, suffix="__z") if standardize else df
    inputs = [c + "__z" for c in feature_cols] if standardize else feature_cols
    assembled = VectorAssembler(inputCols=inputs, outputCol="_cl_vec",
                                handleInvalid="keep").transform(
        prepared.select(*inputs, F.col(label_col).cast("double").alias("_cl_y")))
    lr = LogisticRegression(featuresCol="_cl_vec", labelCol="_cl_y", maxIter=max_iter,
                            regParam=reg_param, standardization=False)
    fitted = lr.fit(assembled)
    coefs = fitted.coefficients.toArray().tolist()
    return LogisticModel(name=name, columns=list(feature_cols), intercept=fitted.intercept,
                         weights=dict(zip(feature_cols, coefs)), scaler=stats)
