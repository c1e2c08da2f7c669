"""Governance jobs: erasure, unique registration, validation, integrity.

GOV-1 / JOI-5 cascading erasure, GOV-2 / JOI-6 / FLT-9 unique registration,
GOV-3 / SCA-17 / FLT-8 / FLT-12 field validation, GOV-5 / JOI-4 orphan audit
and set-null repair.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from churnlane import schemas as S
from churnlane.functions import clean
from churnlane.operators.joins import join_bounded, salted_join
from churnlane.session import cut_lineage, scratch_path
from churnlane.sources.sinks import OWNER_BUCKET, carry_ledger, owner_bucket

# Largest id set broadcast to every task (a long hash set of ~2M keys stays
# well under 100 MB); larger sets take the shuffle join.
MAX_BROADCAST_IDS = 2_000_000


# ---------------------------------------------------------------- GOV-1

def erase(users: DataFrame, results: DataFrame, requested: DataFrame,
          user_key: str = "id", owner_col: str = "id_user",
          requested_key: str | None = None, salts: int = 0,
          hot_min_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """GOV-1 + JOI-5: remove users and, with them, all their results.

    Returns (users kept, results kept, unknown requested ids).  Both removals
    are anti joins on the same erased-id set, so they agree by construction.
    ``salts`` > 0 splits owners with at least ``hot_min_rows`` results over
    that many tasks in the results anti join (``joins.salted_join``).
    """
    req = requested.select(F.col(requested_key or user_key).alias("_cl_uid")).distinct()
    erased = users.select(F.col(user_key).alias("_cl_uid")).join(req, "_cl_uid", "left_semi")
    unknown = req.join(erased, "_cl_uid", "left_anti").withColumnRenamed("_cl_uid", user_key)
    # The erased-id set is usually far smaller than the results: broadcast it
    # when proven small so the results are filtered in place, unshuffled.
    # Otherwise both sides shuffle on the owner; AQE splits a hot owner.
    users_kept = join_bounded(users.withColumn("_cl_uid", F.col(user_key)), erased, "_cl_uid",
                              "left_anti", max_rows=MAX_BROADCAST_IDS).drop("_cl_uid")
    if salts:
        erased_ids = erased.withColumnRenamed("_cl_uid", "_cl_eid")
        results_kept = salted_join(results, erased_ids, owner_col, "_cl_eid", "left_anti",
                                   salts, hot_min_rows)
    else:
        results_kept = join_bounded(results.withColumn("_cl_uid", F.col(owner_col)), erased,
                                    "_cl_uid", "left_anti", max_rows=MAX_BROADCAST_IDS) \
            .drop("_cl_uid")
    return users_kept, results_kept, unknown


@dataclass
class ErasureOutcome:
    users_path: str
    results_path: str
    report: DataFrame


def erase_and_write(spark: SparkSession, users: DataFrame, results: DataFrame,
                    requested: DataFrame, user_key: str = "id", owner_col: str = "id_user",
                    requested_key: str | None = None, salts: int = 0,
                    hot_min_rows: int = 1_000_000, users_out: str | None = None,
                    results_out: str | None = None, old_results_path: str | None = None) -> ErasureOutcome:
    """GOV-1 as a job: write both new versions to NEW paths, then validate.

    Never overwrites what it reads.  The new versions go to ``users_out`` and
    ``results_out`` (without them: under the scratch root).  With
    ``old_results_path`` its id ledger goes over to the new results, so ids of
    erased rows are never given again.  Deleted rows are counted on their own,
    as the rows that match the erased set; unless rows before = kept + deleted
    holds for both tables, the job raises and the old versions stay in use.
    On success the caller points its readers at the new paths (catalog
    location or pointer file).
    """
    users_kept, results_kept, unknown = erase(users, results, requested, user_key,
                                              owner_col, requested_key, salts, hot_min_rows)
    up = users_out or scratch_path(spark, "users")
    rp = results_out or scratch_path(spark, "results")
    users_kept.write.parquet(up)
    results_kept.write.parquet(rp)
    if old_results_path is not None:
        carry_ledger(spark, old_results_path, rp)
    asked = requested.select(F.col(requested_key or user_key).alias("_cl_uid")).distinct()
    erased = users.select(F.col(user_key).alias("_cl_uid")).join(asked, "_cl_uid", "left_semi").distinct()
    gone_u = users.join(erased, users[user_key] == erased["_cl_uid"], "left_semi").count()
    gone_r = results.join(erased, results[owner_col] == erased["_cl_uid"], "left_semi").count()
    after_u = spark.read.parquet(up).count()
    after_r = spark.read.parquet(rp).count()
    if (users.count(), results.count()) != (after_u + gone_u, after_r + gone_r):
        raise RuntimeError("erasure does not add up: rows before differ from kept + deleted")
    n_unknown = unknown.count()
    report = spark.createDataFrame(
        [(gone_u, gone_r, n_unknown, after_u, after_r)],
        "users_deleted long, results_deleted long, unknown_users long, "
        "users_kept long, results_kept long")
    return ErasureOutcome(up, rp, report)


def erase_buckets(spark: SparkSession, table: str, buckets: int, users: DataFrame, requested: DataFrame,
                  user_key: str = "id", owner_col: str = "id_user", requested_key: str | None = None,
                  users_out: str | None = None, rewritten_out: str | None = None) -> ErasureOutcome:
    """GOV-1 on a results table of owner buckets: only buckets that hold an erased owner are read and written.

    ``table`` is a catalog table of ``sinks.write_owner_buckets`` with the same
    ``buckets``.  The erased ids give at most ``buckets`` bucket numbers, which
    become a partition filter of the scan.  The rows that stay are written to
    a new path in one pass, which also counts the rows on both sides; only then
    does the catalog point each rewritten bucket at its new folder, one
    statement a bucket.  Old folders stay until their readers are done.  A run
    that ends between two statements is simply run again: the buckets already
    moved lose nothing more.

    ``results_kept`` of the report counts untouched buckets from their
    file footers (no column is read).  ``results_path`` is the rewritten folder.
    """
    asked = cut_lineage(requested.select(F.col(requested_key or user_key).alias("_cl_uid")).where("_cl_uid is not null").distinct())
    erased = cut_lineage(users.select(F.col(user_key).alias("_cl_uid")).join(asked, "_cl_uid", "left_semi").distinct())
    touched = [r[0] for r in erased.select(owner_bucket(F.col("_cl_uid"), buckets)).distinct().collect()]
    up, rp = users_out or scratch_path(spark, "users"), rewritten_out or scratch_path(spark, "results")
    on_users, on_results = Observation(), Observation()

    def flagged(rows: DataFrame, key: str) -> DataFrame:
        return join_bounded(rows.withColumn("_cl_uid", F.col(key)), erased.withColumn("_cl_gone", F.lit(True)), "_cl_uid",
                            "left", max_rows=MAX_BROADCAST_IDS)

    def counted(rows: DataFrame, seen: Observation, keep: list[str]) -> DataFrame:
        gone = F.col("_cl_gone").isNotNull()
        return (rows.observe(seen, F.count_if(gone).alias("gone"), F.count_if(~gone).alias("kept"))
                .where(~gone).select(*keep))

    counted(flagged(users, user_key), on_users, users.columns).write.parquet(up)
    results = spark.table(table)
    gone_r = kept_r = 0
    if touched:
        rows = results.where(F.col(OWNER_BUCKET).isin(touched))
        counted(flagged(rows, owner_col), on_results, results.columns).write.partitionBy(OWNER_BUCKET).parquet(rp)
        gone_r, kept_r = on_results.get["gone"], on_results.get["kept"]
        left = {r[0] for r in spark.read.parquet(rp).select(OWNER_BUCKET).distinct().collect()} if kept_r else set()
        stored = {r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        for b in touched:
            part = f"PARTITION ({OWNER_BUCKET}={b})"
            if b in left:
                spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{rp}/{OWNER_BUCKET}={b}'")
            elif str(b) in stored:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {part}")
        spark.sql(f"REFRESH TABLE {table}")
    untouched = results.where(~F.col(OWNER_BUCKET).isin(touched)) if touched else results
    report = spark.createDataFrame(
        [(on_users.get["gone"], gone_r, asked.join(erased, "_cl_uid", "left_anti").count(), on_users.get["kept"],
          kept_r + untouched.count())],
        "users_deleted long, results_deleted long, unknown_users long, users_kept long, results_kept long")
    return ErasureOutcome(up, rp, report)


# ---------------------------------------------------------------- GOV-2

def register_unique(incoming: DataFrame, stored: DataFrame, name_col: str = "username",
                    order_cols: list[str] | None = None,
                    stored_name_col: str | None = None, salts: int = 0,
                    hot_min_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """GOV-2 + JOI-6 + FLT-9: accept the first request per stripped name.

    Returns (accepted, rejected), together all of ``incoming``.  Rejected
    reasons, in this order: ``missing_username`` (null), ``username_length``
    (GOV-3), ``already_exists`` (the name is stored) or ``duplicate`` (an
    earlier request in this batch has it).  The first request per name is found with a min-aggregate on the
    ordering struct (partial aggregation: a hot name costs one row per map
    task), not a window that would sort every duplicate in one task.
    ``salts`` > 0 also splits a hot name's requests over that many tasks
    when they are matched back to the first one.
    """
    key = clean.strip(F.col(name_col))
    inc = incoming.withColumn("_cl_name", key)
    if order_cols:   # must be unique per request, e.g. (ts, request id)
        inc = inc.withColumn("_cl_ord", F.struct(*[F.col(c) for c in order_cols]))
    else:            # arrival order: materialise once so both reads agree
        inc = inc.withColumn("_cl_ord", F.struct(F.monotonically_increasing_id().alias("m")))
        inc = inc.checkpoint(eager=True)
    bad = F.when(F.col("_cl_name").isNull(), F.lit("missing_username")).otherwise(
        validation_reason(username=F.col("_cl_name")))
    inc = inc.withColumn("_cl_bad", bad)
    invalid = inc.where(F.col("_cl_bad").isNotNull())
    inc = inc.where(F.col("_cl_bad").isNull())   # null names never reach the joins
    firsts = inc.groupBy("_cl_name").agg(F.min("_cl_ord").alias("_cl_first"))
    names = stored.select(clean.strip(F.col(stored_name_col or name_col)).alias("_cl_name")) \
        .distinct().withColumn("_cl_exists", F.lit(True))
    if salts:
        firsts_k = firsts.withColumnRenamed("_cl_name", "_cl_fname")
        tagged = salted_join(inc, firsts_k, "_cl_name", "_cl_fname", "inner", salts,
                             hot_min_rows).drop("_cl_fname").join(names, "_cl_name", "left")
    else:
        tagged = (inc.join(firsts, "_cl_name", "inner")
                  .join(names, "_cl_name", "left"))
    reason = (F.when(F.col("_cl_exists"), F.lit("already_exists"))
              .when(F.col("_cl_ord") != F.col("_cl_first"), F.lit("duplicate")))
    tagged = tagged.withColumn("reason", reason)
    out_cols = [c for c in incoming.columns if c != name_col]
    accepted = tagged.where(F.col("reason").isNull()).select(
        F.col("_cl_name").alias(name_col), *out_cols)
    rejected = tagged.where(F.col("reason").isNotNull()).select(
        F.col("_cl_name").alias(name_col), *out_cols, "reason").unionByName(invalid.select(
            F.col("_cl_name").alias(name_col), *out_cols, F.col("_cl_bad").alias("reason")))
    return accepted, rejected


def users_from_registrations(spark: SparkSession, accepted: DataFrame, users_path: str,
                             name_col: str = "username") -> DataFrame:
    """GOV-2 + SCA-23: append accepted names to the users table.

    Ids continue after the stored maximum; ``created_at`` is the job's UTC
    timestamp (one value for the whole batch, like a default at insert).
    """
    from churnlane.sources.ingest import create_table_if_absent, with_dense_id
    from churnlane.sources.sinks import reserve_ids

    create_table_if_absent(spark, users_path, S.USERS_SCHEMA)
    rows = accepted.select(F.col(name_col).alias("username")).checkpoint(eager=True)
    n = rows.count()
    if n == 0:
        return spark.read.parquet(users_path)
    numbered = with_dense_id(rows, "id", start=reserve_ids(spark, users_path, n)).select(
        "id", "username", F.current_timestamp().alias("created_at"))
    numbered.write.mode("append").parquet(users_path)
    return spark.read.parquet(users_path)


# ---------------------------------------------------------------- GOV-3

def validation_reason(username: Column | None = None, password: Column | None = None,
                      ident: Column | None = None, require_ident: bool = False) -> Column:
    """GOV-3 + SCA-17 + FLT-8 + FLT-12: first failing rule, null when valid."""
    checks = []
    if require_ident and ident is not None:
        checks.append((ident.isNull() | (ident.cast("string") == ""), "missing_id"))
    if ident is not None:
        checks.append((ident.isNotNull() & ~clean.digits_only(ident), "id_not_integer"))
    if username is not None:
        lo, hi = S.USERNAME_LENGTH
        checks.append((~clean.length_between(clean.strip(username), lo, hi), "username_length"))
    if password is not None:
        lo, hi = S.PASSWORD_LENGTH
        checks.append((~clean.length_between(password, lo, hi), "password_length"))
    out = None
    for cond, reason in checks:
        out = F.when(cond, F.lit(reason)) if out is None else out.when(cond, F.lit(reason))
    return out if out is not None else F.lit(None).cast("string")


# ---------------------------------------------------------------- GOV-5

def orphans(results: DataFrame, features: DataFrame, link_col: str = "employe_id",
            features_key: str = "id") -> DataFrame:
    """GOV-5 / JOI-4 audit: results whose link points to no features row."""
    keys = features.select(F.col(features_key).alias("_cl_k"))
    linked = results.where(F.col(link_col).isNotNull())
    return linked.join(keys, linked[link_col] == keys["_cl_k"], "left_anti")


def repair_orphans(results: DataFrame, features: DataFrame, link_col: str = "employe_id",
                   features_key: str = "id", spread: int = 64) -> DataFrame:
    """GOV-5 / JOI-4 repair: ON DELETE SET NULL for dangling links.

    One scan and one join: rows without a link are spread over ``spread``
    extra key values, which no features row has, instead of meeting in one
    partition; ``spread`` does not change the result.
    """
    keys = features.select(F.col(features_key).alias("_cl_k"), F.lit(0).alias("_cl_s0")).distinct()
    own = [F.col(c) for c, t in results.dtypes if not t.startswith(("map", "variant"))]
    tagged = results.withColumn("_cl_s", F.when(
        F.col(link_col).isNull(), F.pmod(F.xxhash64(*own), F.lit(spread)).cast("int") + 1).otherwise(F.lit(0)))
    same = (tagged[link_col] == keys["_cl_k"]) & (tagged["_cl_s"] == keys["_cl_s0"])
    return (tagged.join(keys, same, "left")
            .withColumn(link_col, F.when(F.col("_cl_k").isNotNull(), F.col(link_col)))
            .select(*results.columns))
