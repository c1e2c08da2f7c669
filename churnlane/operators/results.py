"""Stored predictions: append, owner-scoped history, detail view.

SNK-1 append with ids, SNK-5 rows as JSON on demand, FLT-1 owner filter,
FLT-2 case-insensitive name patterns, FLT-5 / GOV-4 owner scoping, SRT-1
newest first, PRJ-1 history columns, PRJ-2 detail, PRJ-7 display row, LIM-2
top-k per owner, AGG-2 counts, JOI-3 features from table or stored JSON,
SCA-19 / SCA-20 JSON out / in.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlane import schemas as S
from churnlane.functions import clean
from churnlane.operators.joins import salted_join
from churnlane.sources.ingest import with_dense_id
from churnlane.sources.sinks import carry_ledger, reserve_ids

HISTORY_COLUMNS = ["id", "prenom", "nom", "modele_utilise", "probabilite_de_quitter",
                   "prediction", "libelle_prediction", "seuil_applique", "id_user", "employe_id"]


# ---------------------------------------------------------------- SNK-1

def details_json(features_json, employe_id) -> "F.Column":
    """SNK-1: JSON copy of the features only when no employee is linked.

    Mirrors the service: a link of 0 counts as 'no link' when saving (T10).
    Nulls and non-ASCII text are kept (SCA-19).
    """
    parsed = F.try_parse_json(clean._c(features_json))
    text = F.coalesce(F.to_json(parsed), F.lit("{}"))
    return F.when(F.coalesce(clean._c(employe_id), F.lit(0)) == 0, text)


def saved_rows(saves: DataFrame, features_col: str = "features") -> DataFrame:
    """SNK-1 save route (SCA-16, T17): already computed predictions to store.

    Absent fields take their declared defaults (prenom John, nom Doe,
    features {}, employe_id null); an explicit null name is kept, unlike
    the predict path, which also replaces null and ''.  ``details`` holds the
    features JSON only when no employee is linked.
    """
    cols = set(saves.columns)
    feats = F.col(features_col) if features_col in cols else F.lit("{}")
    link = F.col("employe_id").cast("long") if "employe_id" in cols else F.lit(None).cast("long")
    out = saves.withColumns({
        "prenom": F.col("prenom") if "prenom" in cols else F.lit(S.DEFAULT_FIRST_NAME),
        "nom": F.col("nom") if "nom" in cols else F.lit(S.DEFAULT_LAST_NAME),
        "employe_id": link,
        "details": details_json(feats, link),
    })
    keep = [f.name for f in S.RESULTS_SCHEMA.fields if f.name != "id"]
    return out.select(*[(F.col(c) if c in out.columns else F.lit(None)).cast(
        S.RESULTS_SCHEMA[c].dataType).alias(c) for c in keep])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The results table, whatever wrote it.

    Every append has its own ``batch=`` folder; the read lists files at any
    depth under the declared schema, so rows that an older version appended
    at the table's root are read with them.
    """
    return spark.read.schema(S.RESULTS_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def _append(spark: SparkSession, path: str, rows: DataFrame, folder: str, key: str | None,
            owner_col: str) -> int:
    cols = [f.name for f in S.RESULTS_SCHEMA.fields if f.name != "id"]
    prepared = rows.select(*[F.col(c).cast(S.RESULTS_SCHEMA[c].dataType).alias(c) for c in cols])
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = prepared.count()
        if n:
            numbered = with_dense_id(prepared, "id", start=reserve_ids(spark, path, n, key=key))
            (numbered.select("id", *cols).sortWithinPartitions(owner_col, "id")
             .write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={folder}"))
    finally:
        prepared.unpersist()
    return n


def append_results(spark: SparkSession, path: str, rows: DataFrame,
                   owner_col: str = "id_user") -> int:
    """SNK-1: append ``rows`` (results columns without ``id``) to ``path``.

    New ids continue after the last reserved id (see :func:`reserve_ids`).
    The rows get a ``batch=`` folder of their own, as a stream's batches do,
    so both kinds of append are read together (:func:`read_results`).
    ``rows`` must be deterministic (scoring is): it is persisted for the
    append and read twice (counts per partition, then numbering); a lost
    executor recomputes the same rows.  Each partition is sorted by owner
    before writing (no shuffle), so row-group min/max statistics let
    owner-scoped history reads skip most of the file.  Returns the number
    of rows appended.
    """
    return _append(spark, path, rows, f"job-{uuid.uuid4().hex}", None, owner_col)


def append_batch(spark: SparkSession, path: str, rows: DataFrame, batch_key: str,
                 owner_col: str = "id_user") -> int:
    """SNK-1 for a micro-batch, idempotent under replay.

    The batch's ids are reserved under ``batch_key`` (a replay gets the same
    range) and its rows overwrite their own folder ``batch=<key>``, so a
    batch re-run after a failure rewrites identical content instead of
    appending twice.  The batch is persisted only for the append and released
    afterwards, so a long-running stream accumulates neither cache nor
    checkpoint files.  Returns the number of rows written.
    """
    return _append(spark, path, rows, batch_key, batch_key, owner_col)


def cluster_results(spark: SparkSession, path: str, out: str, rows_per_file: int = 2_000_000,
                    owner_col: str = "id_user", row_group_bytes: int = 16 << 20) -> int:
    """SNK-1 / SRT-1 / FLT-1: a new version of the results table, ordered by (owner, id).

    Appends leave a folder each, and an owner's rows in all of them.  The
    rewrite range-partitions all rows by (owner, id), so a file holds
    neighbouring owners, a hot owner is spread over as many files as its rows
    need, and the min/max of the row groups let a history read only its
    share.  ``out`` is a new path whose ids go on where those of ``path``
    end; appends may follow there.  Nothing of ``path`` is changed.  Returns the
    number of rows, which must be the same on both sides.
    """
    rows = read_results(spark, path)
    n = rows.count()
    files = max(1, -(-n // rows_per_file))
    (rows.repartitionByRange(files, owner_col, "id").sortWithinPartitions(owner_col, "id").write
     .option("parquet.block.size", row_group_bytes).parquet(f"{out.rstrip('/')}/batch=clustered-{uuid.uuid4().hex}"))
    carry_ledger(spark, path, out)
    if read_results(spark, out).count() != n:
        raise RuntimeError("the clustered version has another number of rows; the old one stays in use")
    return n


# ---------------------------------------------------------------- history

def history(results: DataFrame, owner, prenom: str | None = None, nom: str | None = None,
            limit: int | None = None, literal: bool = False) -> DataFrame:
    """FLT-1/2/5 + SRT-1 + SRT-3 + PRJ-1: one owner's predictions, newest first
    (the newest row is the first one, as the page prepends it).

    No owner -> empty result.  prenom / nom: case-insensitive patterns,
    stripped; a falsy value skips the filter (" " is not falsy: it becomes
    the empty pattern); wildcards stay live unless ``literal`` (T13).
    """
    if owner is None:
        return results.select(*HISTORY_COLUMNS).where(F.lit(False))
    df = name_search(results.where(F.col("id_user") == F.lit(owner)), "prenom", "nom",
                     prenom, nom, literal)
    out = df.select(*HISTORY_COLUMNS).orderBy(F.col("id").desc_nulls_last())
    return out.limit(limit) if limit is not None else out


def history_for_owners(results: DataFrame, owners: DataFrame, owner_col: str = "id_user",
                       id_col: str = "id", columns: list[str] | None = None) -> DataFrame:
    """GOV-4 batch form: the histories of a set of owners, each newest first."""
    cols = columns or HISTORY_COLUMNS
    owners = owners.select(owner_col).distinct()   # a hot owner collapses map-side
    return (results.join(owners, owner_col, "left_semi")
            .select(*cols).orderBy(F.col(owner_col).asc(), F.col(id_col).desc_nulls_last()))


def name_search(df: DataFrame, first_col: str, last_col: str,
                prenom: str | None, nom: str | None, literal: bool = False) -> DataFrame:
    """FLT-2 + SCA-12 on any table: both patterns ANDed, falsy -> skipped.

    ``literal`` escapes % and _ so the text matches as typed.
    """
    for col, value in ((first_col, prenom), (last_col, nom)):
        if value:
            pattern = value.strip()
            df = df.where(F.col(col).ilike(clean.like_escape(pattern) if literal else pattern))
    return df


def topk_per_owner(results: DataFrame, k: int = 20, owner_col: str = "id_user",
                   id_col: str = "id", salts: int = 16) -> DataFrame:
    """LIM-2: the ``k`` newest rows of every owner (rank column ``position``).

    Ranked in two steps, by (owner, salt) and then by owner: Spark's partial
    limit before the shuffle stops at a threshold of ``k``, and beyond it the
    first step still splits a hot owner, so that the second one gets at most
    ``salts * k`` rows of an owner at any ``k``.
    """
    salt = F.pmod(F.xxhash64(id_col), F.lit(salts))
    newest = F.col(id_col).desc()
    part = Window.partitionBy(owner_col, "_cl_salt").orderBy(newest)
    some = (results.withColumn("_cl_salt", salt).withColumn("_cl_rank", F.row_number().over(part))
            .where(F.col("_cl_rank") <= k).drop("_cl_salt", "_cl_rank"))
    w = Window.partitionBy(owner_col).orderBy(newest)
    return (some.withColumn("position", F.row_number().over(w))
            .where(F.col("position") <= k)
            .withColumn("position", F.col("position").cast("long")))


def counts_per_owner(results: DataFrame, owner_col: str = "id_user") -> DataFrame:
    """AGG-2: ``nb`` per owner (partial + final aggregate)."""
    return results.groupBy(owner_col).agg(F.count(F.lit(1)).alias("nb"))


def display(results: DataFrame, proba_col: str = "probabilite_de_quitter") -> DataFrame:
    """PRJ-7 + SCA-7 + SCA-8: id, full name, label, risk text and complement."""
    p = F.col(proba_col)
    return results.select(
        "id",
        F.concat_ws(" ", "prenom", "nom").alias("nom_complet"),
        "libelle_prediction",
        clean.percent_text(p).alias("risque"),
        clean.complement_percent_text(p).alias("complement"),
        F.round(p, 4).alias("probabilite_4"),
    )


def as_json_rows(df: DataFrame) -> DataFrame:
    """SNK-5: each row as one JSON object text (nulls kept)."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


# ---------------------------------------------------------------- JOI-3

def detail(results: DataFrame, features: DataFrame, features_key: str = "id",
           link_col: str = "employe_id", details_col: str = "details",
           owner=None, owner_col: str = "id_user", salts: int = 0,
           hot_min_rows: int = 1_000_000) -> DataFrame:
    """JOI-3 + PRJ-2 + PRJ-5 + SCA-20: every result with its features.

    Linked rows (link not null) take the features table row (all columns
    but its key) as JSON; an unmatched link gives ``{}``.  Unlinked rows
    parse the stored ``details`` JSON (null / empty -> ``{}``).  Adds
    ``source_features``.  The results are scanned once; rows without a link
    (often most) are spread over extra key values that match nothing, so they
    never pile into one shuffle partition.
    ``owner`` scopes the rows (FLT-5): another owner's row is not found.
    ``salts`` > 0 splits employees linked by at least ``hot_min_rows`` results
    over that many tasks (see ``joins.salted_join``); 0 leaves skew to AQE.
    """
    if owner is not None:
        results = results.where(F.col(owner_col) == F.lit(owner))
    feat_cols = [c for c in features.columns if c != features_key]
    # The feature columns travel as one struct; JSON is built after the join,
    # only for the rows that matched, not for the whole features table.
    packed = features.select(F.col(features_key).alias("_cl_fk"),
                             F.struct(*[F.col(c) for c in feat_cols]).alias("_cl_feat"))
    raw = F.col(details_col)
    stored = F.when(clean.is_blank(raw), F.lit("{}")).otherwise(
        F.coalesce(F.to_json(F.try_parse_json(raw)), F.lit("{}")))
    from_table = F.coalesce(F.to_json("_cl_feat", {"ignoreNullFields": "false"}), F.lit("{}"))
    if salts:
        with_link = results.where(F.col(link_col).isNotNull())
        linked = (salted_join(with_link, packed, link_col, "_cl_fk", "left", salts, hot_min_rows)
                  .withColumns({"features": from_table, "source_features": F.lit(S.FEATURES_FROM_TABLE)})
                  .drop("_cl_fk", "_cl_feat"))
        unlinked = (results.where(F.col(link_col).isNull())
                    .withColumns({"features": stored, "source_features": F.lit(S.FEATURES_FROM_JSON)}))
        return linked.unionByName(unlinked).drop(details_col)
    own = [F.col(c) for c, t in results.dtypes if not t.startswith(("map", "variant"))]
    tagged = results.withColumn("_cl_s", F.when(
        F.col(link_col).isNull(), F.pmod(F.xxhash64(*own), F.lit(64)).cast("int") + 1).otherwise(F.lit(0)))
    packed = packed.withColumn("_cl_s0", F.lit(0))
    same = (F.col(link_col) == F.col("_cl_fk")) & (F.col("_cl_s") == F.col("_cl_s0"))
    linked = F.col(link_col).isNotNull()
    return (tagged.join(packed, same, "left")
            .withColumns({"features": F.when(linked, from_table).otherwise(stored),
                          "source_features": F.when(linked, F.lit(S.FEATURES_FROM_TABLE)).otherwise(
                              F.lit(S.FEATURES_FROM_JSON))})
            .drop("_cl_s", "_cl_s0", "_cl_fk", "_cl_feat", details_col))
