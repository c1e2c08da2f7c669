"""Rewrites that touch only what they must: erasure by owner bucket, clustered results."""

import glob
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from churnlane.operators import governance as G
from churnlane.operators import results as RS
from churnlane.sources import sinks as SK


def _results(spark, n=4000):
    owner = F.when(F.col("id") % 10 < 3, F.lit(7)).when(F.col("id") % 97 != 0, F.col("id") % 400)
    return spark.range(n).select("id", owner.alias("id_user"), F.concat(F.lit("r"), "id").alias("prenom"))


def _owners(spark):
    return spark.createDataFrame([(i, f"u{i}") for i in range(350)], "id long, username string")


def test_erasure_reads_and_writes_touched_buckets_only(spark):
    table, before = f"erase_{uuid.uuid4().hex}", _results(spark)
    SK.write_owner_buckets(before, table, "id_user", buckets=64, files_per_bucket=3)
    assert spark.table(table).count() == 4000
    files = set(spark.table(table).inputFiles())
    asked = spark.createDataFrame([(7,), (11,), (None,), (999,), (7,)], "id long")
    out = G.erase_buckets(spark, table, 64, _owners(spark), asked)
    want = {(r.id, r.id_user) for r in before.collect() if r.id_user not in (7, 11)}
    assert {(r.id, r.id_user) for r in spark.table(table).select("id", "id_user").collect()} == want
    old = G.erase_and_write(spark, _owners(spark), before, asked.where("id is not null"))
    assert out.report.collect() == old.report.collect()
    now = set(spark.table(table).inputFiles())
    touched = {f.split("owner_bucket=")[1].split("/")[0] for f in now - files}
    assert len(touched) <= 2 and len(now & files) >= 50           # every other bucket keeps its files
    again = G.erase_buckets(spark, table, 64, spark.read.parquet(out.users_path), asked)
    assert again.report.first()[:3] == (0, 0, 3) and set(spark.table(table).inputFiles()) == now


def test_erasure_scan_is_pruned_by_partition(spark):
    table = f"erase_{uuid.uuid4().hex}"
    SK.write_owner_buckets(_results(spark, 500), table, "id_user", buckets=16)
    picked = [r[0] for r in spark.createDataFrame([(7,), (11,)], "o long").select(SK.owner_bucket(F.col("o"), 16)).collect()]
    df = spark.table(table).where(F.col(SK.OWNER_BUCKET).isin(picked))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(owner_bucket" in plan or "PartitionFilters: [owner_bucket" in plan
    assert len(df.inputFiles()) <= len(spark.table(table).inputFiles())


def test_bucket_without_rows_left_goes(spark):
    table = f"erase_{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "c")], "id long, id_user long, prenom string")
    SK.write_owner_buckets(rows, table, "id_user", buckets=1)
    G.erase_buckets(spark, table, 1, _owners(spark), spark.createDataFrame([(5,)], "id long"))
    assert [r.id for r in spark.table(table).collect()] == [3]
    nothing = G.erase_buckets(spark, table, 1, _owners(spark), spark.createDataFrame([(9999,)], "id long"))
    assert nothing.report.first() == (0, 0, 1, 350, 1)


def _groups_of(path, owner):
    """(row groups whose range holds the owner, all row groups) of the files below ``path``."""
    hit = total = 0
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        col = [meta.schema.column(i).name for i in range(meta.num_columns)].index("id_user")
        for g in range(meta.num_row_groups):
            total += 1
            stats = meta.row_group(g).column(col).statistics
            hit += stats is not None and stats.has_min_max and stats.min <= owner <= stats.max
    return hit, total


def test_clustered_results_keep_a_history_in_few_row_groups(spark, tmp_dir):
    path, out = f"{tmp_dir}/results", f"{tmp_dir}/clustered"
    for i in range(12):
        rows = spark.range(200).select(F.lit("x").alias("prenom"), F.when(
            F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 50 != 1, F.col("id") + i).alias("id_user"))
        RS.append_results(spark, path, rows.select("*", *[F.lit(None).alias(c) for c in (
            "nom", "modele_utilise", "probabilite_de_quitter", "prediction", "libelle_prediction", "seuil_applique",
            "employe_id", "details")]))
    assert RS.cluster_results(spark, path, out, rows_per_file=100) == 2400
    whole = {tuple(r) for r in RS.read_results(spark, path).collect()}
    assert {tuple(r) for r in RS.read_results(spark, out).collect()} == whole
    hit_before, total_before = _groups_of(path, 101)
    hit, total = _groups_of(out, 101)
    assert total >= 20 and hit <= 2 and hit / total < hit_before / total_before / 5
    spread, _ = _groups_of(out, 5)
    assert 6 <= spread <= 12                                       # a third of all rows: a hot owner has files of its own
    ids = [r.id for r in RS.history(RS.read_results(spark, out), 101).collect()]
    assert ids == [r.id for r in RS.history(RS.read_results(spark, path), 101).collect()] and ids
    RS.append_results(spark, out, spark.createDataFrame([("late", 101)], "prenom string, id_user long").select("*", *[
        F.lit(None).alias(c) for c in ("nom", "modele_utilise", "probabilite_de_quitter", "prediction",
                                       "libelle_prediction", "seuil_applique", "employe_id", "details")]))
    assert RS.history(RS.read_results(spark, out), 101).first().id == 2401
