"""Statistics that are kept per batch and merged: fits without reading old rows again (DEL-3..6).

A batch leaves one row per column: its moments (count, mean, sum of squared
deviations), its extremes and a KLL sketch of its quantiles.  Rows of any
number of batches merge into the row of their union, so a scaler or an imputer
is fitted on the history by reading a few numbers per batch.  Mean, deviation
and extremes are those of the whole (but for the order of float sums);
quantiles are within the sketch's rank error, about 1.65 % at the default k of
200 and 0.3 % at 1,000 or so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATISTICS = "column string, n long, missing long, mean double, m2 double, low double, high double, sketch binary"


def batch_statistics(df: DataFrame, cols: list[str], batch: str | None = None, k: int = 1000) -> DataFrame:
    """One row of statistics per column of ``cols`` (and per value of the column ``batch``, when given).

    Nulls and NaN count as missing.  A column without values has n = 0 and
    nulls.  One scan; rows are merged map-side.
    """
    keys = [batch] if batch else []
    entries = F.array(*(F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
                                 .alias("x")) for c in cols))
    rows = df.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.column", "e.x")
    return rows.groupBy(*keys, "column").agg(
        F.count("x").alias("n"), F.count_if(F.col("x").isNull()).alias("missing"), F.avg("x").alias("mean"),
        (F.var_pop("x") * F.count("x")).alias("m2"), F.min("x").alias("low"), F.max("x").alias("high"),
        F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch"))


def merge_statistics(stats: DataFrame, k: int = 1000) -> DataFrame:
    """The statistics of the union of all batches, one row per column; merged rows may be merged again.

    The squared deviations of a union are those inside its parts plus those of
    the parts' means about the whole's.
    """
    n, mean = F.col("n"), F.col("mean")
    merged = stats.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.sum(n * mean).alias("_cl_sum"),
        F.sum("m2").alias("_cl_m2"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    whole = merged.select("column", "n", "missing", F.when(F.col("n") > 0, F.col("_cl_sum") / F.col("n")).alias("mean"),
                          "_cl_m2", "low", "high", "sketch")
    between = (stats.select("column", "n", F.col("mean").alias("_cl_mean")).join(whole.select("column", "mean"), "column")
               .groupBy("column").agg(F.sum(n * F.pow(F.col("_cl_mean") - F.col("mean"), 2)).alias("_cl_between")))
    return whole.join(between, "column").select(
        "column", "n", "missing", "mean", (F.col("_cl_m2") + F.col("_cl_between")).alias("m2"), "low", "high", "sketch")


def quantiles(stats: DataFrame, probs: list[float]) -> DataFrame:
    """(column, quantiles) read from the sketches; null where a column has no values."""
    ranks = F.array(*map(F.lit, map(float, probs)))
    return stats.select("column", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", ranks)).alias("quantiles"))


def _rows(stats: DataFrame, cols: list[str]) -> dict:
    """The statistics of the wanted columns, a row each (bounded by the features of a model)."""
    return {r["column"]: r for r in stats.where(F.col("column").isin(cols)).collect()}


def standard_of(stats: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """DEL-3 from merged statistics: center = mean, scale = population standard deviation."""
    rows = _rows(stats.select("column", "mean", F.sqrt(F.col("m2") / F.col("n")).alias("s")), cols)
    return {c: (rows[c]["mean"], rows[c]["s"]) for c in cols}


def minmax_of(stats: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """DEL-4 from merged statistics: center = min, scale = max - min."""
    rows = _rows(stats.select("column", "low", (F.col("high") - F.col("low")).alias("s")), cols)
    return {c: (rows[c]["low"], rows[c]["s"]) for c in cols}


def robust_of(stats: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """DEL-5 from merged statistics: center = median, scale = p75 - p25, within the sketch's error."""
    rows = _rows(quantiles(stats, [0.25, 0.5, 0.75]), cols)
    return {c: (q[1], q[2] - q[0]) for c in cols if (q := rows[c]["quantiles"])}


def fills_of(stats: DataFrame, cols: list[str], median: bool = False) -> dict[str, float | None]:
    """DEL-6 from merged statistics: the mean, or the sketch's median, of the present values."""
    if median:
        rows = _rows(quantiles(stats, [0.5]), cols)
        return {c: rows[c]["quantiles"][0] if rows[c]["quantiles"] else None for c in cols}
    rows = _rows(stats.select("column", "mean"), cols)
    return {c: rows[c]["mean"] for c in cols}
