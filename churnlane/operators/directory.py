"""Directory and record queries over features LEFT JOIN labels.

JOI-1 directory, JOI-2 record, FLT-3 point lookup, FLT-4 id prefix search,
FLT-6 positive-label filter, FLT-7 missing keys, FLT-11 warning flag, SRT-2
ascending key order, PRJ-3 directory entry, PRJ-4 ``f.*, c.label``, PRJ-5
all columns but the key, LIM-1 first row, LIM-2 optional limit.

Features and labels are equal-sized at scale, so the join is left to
Catalyst/AQE (sort-merge, runtime broadcast or skew split by real size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane import schemas as S

LONG_MAX = 9_223_372_036_854_775_807


def prefix_ranges(key: Column, q: str) -> Column | None:
    """Range form of ``CAST(key AS STRING) LIKE 'q%'`` for digit-only ``q``.

    Non-negative integers whose decimal text starts with q are exactly
    ``q``, ``q0..q9``, ``q00..q99``, ...  These BETWEEN ranges reach the
    Parquet scan as pushed filters (row-group skipping); the text predicate
    alone cannot.  Returns None when q is not a plain digit string.
    """
    if not q.isdigit() or not q.isascii():
        return None
    if q.startswith("0"):
        return key == 0 if q == "0" else F.lit(False)
    base = int(q)
    cond, scale = None, 1
    while base * scale <= LONG_MAX:
        lo, hi = base * scale, min((base + 1) * scale - 1, LONG_MAX)
        c = key.between(lo, hi)
        cond = c if cond is None else (cond | c)
        scale *= 10
    return cond


def id_prefix_filter(key: Column, q: str | None) -> Column | None:
    """FLT-4: ``CAST(key AS TEXT) LIKE 'q%'`` with q stripped; blank q -> None.

    User wildcards stay live (same as the service).  For digit-only q the
    equivalent ranges are ANDed in so the filter is pushed to the scan.
    """
    if q is None or not str(q).strip():
        return None
    q = str(q).strip()
    pred = key.cast("string").like(q + "%")
    ranges = prefix_ranges(key, q)
    return pred if ranges is None else (ranges & pred)


def directory(features: DataFrame, labels: DataFrame, key: str = "id",
              label_col: str = "a_quitte_l_entreprise", q: str | None = None,
              label_prefix: str = S.DIRECTORY_LABEL_PREFIX, labels_key: str | None = None,
              limit: int | None = None) -> DataFrame:
    """JOI-1 + FLT-4 + SRT-2 + PRJ-3: (key, libelle, label) sorted by key."""
    labels_key = labels_key or key
    f = features.select(key)
    pred = id_prefix_filter(F.col(key), q)
    if pred is not None:
        f = f.where(pred)
    lab = labels.select(F.col(labels_key).alias(key), label_col)
    out = (f.join(lab, key, "left")
           .select(key, F.concat(F.lit(label_prefix), F.col(key).cast("string")).alias("libelle"),
                   label_col)
           .orderBy(F.col(key).asc_nulls_last()))
    return out.limit(limit) if limit is not None else out


def with_positive_flag(directory_df: DataFrame, label_col: str,
                       positive=S.GROUND_TRUTH_POSITIVE, flag: str = "already_left") -> DataFrame:
    """FLT-11: boolean flag, false when the label is missing."""
    return directory_df.withColumn(flag, F.coalesce(F.col(label_col) == F.lit(positive),
                                                    F.lit(False)))


def positives(directory_df: DataFrame, label_col: str, positive=S.GROUND_TRUTH_POSITIVE) -> DataFrame:
    """FLT-6: keep rows whose label is the positive value (null excluded)."""
    return directory_df.where(F.col(label_col) == F.lit(positive))


def record(features: DataFrame, labels: DataFrame, ident, key: str = "id",
           label_col: str = "a_quitte_l_entreprise") -> DataFrame:
    """JOI-2 + FLT-3 + LIM-1: one record (``f.*, c.label``) or no row."""
    f = features.where(F.col(key) == F.lit(ident))
    return f.join(labels.select(key, label_col), key, "left").limit(1)


def records(features: DataFrame, labels: DataFrame, requested: DataFrame, key: str = "id",
            label_col: str = "a_quitte_l_entreprise", requested_key: str | None = None) -> DataFrame:
    """JOI-2 batch form: records for every requested key (semi-join).

    Requested keys are de-duplicated first (partial aggregate), so a key
    requested by a third of all rows reaches the join as one row per task.
    """
    req = requested.select(F.col(requested_key or key).alias(key)).distinct()
    f = features.join(req, key, "left_semi")
    return f.join(labels.select(key, label_col), key, "left")


def missing_keys(requested: DataFrame, table: DataFrame, key: str = "id",
                 table_key: str | None = None, requested_key: str | None = None) -> DataFrame:
    """FLT-7: requested keys absent from ``table`` (the batch 'not found')."""
    req = requested.select(F.col(requested_key or key).alias(key)).distinct()
    present = table.select(F.col(table_key or key).alias(key))
    return req.join(present, key, "left_anti").withColumn("reason", F.lit("not_found"))


def without_key(df: DataFrame, key: str = "id") -> DataFrame:
    """PRJ-5: every column except the key."""
    return df.drop(key)
