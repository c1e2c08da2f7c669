"""Join helpers: broadcast only behind a proven row bound.

A side is broadcast only after counting it up to ``max_rows + 1`` rows (the
count stops early); beyond the bound the join is left to Catalyst/AQE, which
picks sort-merge (with skew splitting) or a runtime broadcast by real size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.session import cut_lineage


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_bounded(big: DataFrame, small: DataFrame, on, how: str = "left",
                 max_rows: int = 1_000_000) -> DataFrame:
    """Join ``big`` to ``small``, broadcasting ``small`` only if it is proven small.

    Nothing is cached: the bound check reads at most ``max_rows + 1`` rows of
    ``small`` and the join reads it again.  The answer does not depend on the
    bound; past it Catalyst and AQE choose by real size.
    """
    if row_count_at_most(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keys holding at least ``min_rows`` rows (one partial aggregate).

    At most ``total rows / min_rows`` keys qualify, so the result is small.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_cl_rows"))
    return counts.where(F.col("_cl_rows") >= min_rows).select(key)


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                how: str = "left", salts: int = 16, min_rows: int = 1_000_000) -> DataFrame:
    """Equi-join that splits hot keys of ``big`` over ``salts`` tasks.

    Rows of ``big`` whose key is hot get a salt 0..salts-1 (spread by a hash
    of the row); the ``small`` rows of those keys are replicated once per
    salt; every other row keeps salt 0 and is not replicated.  The join then
    runs on (key, salt), so one key's rows are no longer bound to one task.
    Works for inner, left, left_semi and left_anti joins (``big`` is the
    left side): partner rows are present in every salt, so a row finds a
    match in its own salt exactly when it has one at all.  Independent of
    AQE skew handling; use when a key may hold a large share of ``big``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("salted_join supports inner, left, left_semi and left_anti joins")
    hot = hot_keys(big, big_key, min_rows).withColumn("_cl_hot", F.lit(True))
    hot = cut_lineage(hot)   # counted once; the checkpoint is cleaned with the DataFrame
    hot_s = hot.withColumnRenamed(big_key, small_key)
    # A deterministic spread (a retried task puts each row in the same salt);
    # hash functions reject map and variant columns, so those are left out.
    hashable = [f.name for f in big.schema.fields
                if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in hashable]), F.lit(salts))
    b = (join_bounded(big, hot, big_key, "left", max_rows=100_000)
         .select(*big.columns,
                 F.when(F.col("_cl_hot"), spread).otherwise(F.lit(0)).alias("_cl_salt")))
    s = (join_bounded(small, hot_s, small_key, "left", max_rows=100_000)
         .select(*small.columns, F.explode(F.when(
             F.col("_cl_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
             .alias("_cl_salt")))
    cond = (b[big_key] == s[small_key]) & (b["_cl_salt"] == s["_cl_salt"])
    if how in ("left_semi", "left_anti"):
        return b.join(s, cond, how).drop("_cl_salt")
    return b.join(s, cond, how).drop(b["_cl_salt"]).drop(s["_cl_salt"])
