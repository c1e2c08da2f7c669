"""GOV-1..5: erasure, unique registration, validation, orphans."""

from pyspark.sql import functions as F

from churnlane.operators import governance as G


def test_erase_cascades(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, username string")
    results = spark.createDataFrame([(10, 1), (11, 2), (12, 2), (13, None)], "rid long, id_user long")
    req = spark.createDataFrame([(2,), (9,)], "id long")
    uk, rk, unknown = G.erase(users, results, req)
    assert sorted(r.id for r in uk.collect()) == [1, 3]
    assert sorted(r.rid for r in rk.collect()) == [10, 13]
    assert [r.id for r in unknown.collect()] == [9]


def test_erase_and_write_report(spark):
    users = spark.createDataFrame([(1,), (2,)], "id long")
    results = spark.createDataFrame([(10, 1), (11, 2), (12, 2)], "rid long, id_user long")
    out = G.erase_and_write(spark, users, results, spark.createDataFrame([(2,)], "id long"))
    r = out.report.first()
    assert (r.users_deleted, r.results_deleted, r.unknown_users, r.users_kept, r.results_kept) == \
        (1, 2, 0, 1, 1)
    assert spark.read.parquet(out.results_path).count() == 1


def test_register_unique(spark):
    incoming = spark.createDataFrame(
        [(" alice ", 1), ("bob", 2), ("alice", 3), ("carol", 4), ("bob ", 5)], "username string, t int")
    stored = spark.createDataFrame([("carol",)], "username string")
    acc, rej = G.register_unique(incoming, stored, order_cols=["t"])
    assert sorted((r.username, r.t) for r in acc.collect()) == [("alice", 1), ("bob", 2)]
    assert sorted((r.username, r.t, r.reason) for r in rej.collect()) == [
        ("alice", 3, "duplicate"), ("bob", 5, "duplicate"), ("carol", 4, "already_exists")]


def test_register_unique_arrival_order(spark):
    incoming = spark.createDataFrame([("xxx",), ("xxx",), ("yyy",), (None,), ("z",)], "username string").coalesce(1)
    acc, rej = G.register_unique(incoming, spark.createDataFrame([], "username string"))
    assert sorted(r.username for r in acc.collect()) == ["xxx", "yyy"]
    assert sorted(r.reason for r in rej.collect()) == ["duplicate", "missing_username", "username_length"]


def test_validation_reasons(spark):
    df = spark.createDataFrame([("ab", "pass", "1"), ("abc", "pas", "2"), ("abcd", "passw", "3x"),
                                ("good", "secret", "42"), (" ab ", "secret", "7")],
                               "u string, p string, i string")
    rows = df.select(G.validation_reason(F.col("u"), F.col("p"), F.col("i")).alias("r")).collect()
    assert [r.r for r in rows] == ["username_length", "password_length", "id_not_integer", None,
                                   "username_length"]


def test_orphans_audit_and_repair(spark):
    results = spark.createDataFrame([(1, 8), (2, 9), (3, None)], "id long, employe_id long")
    feats = spark.createDataFrame([(8,)], "id long")
    assert [r.id for r in G.orphans(results, feats).collect()] == [2]
    fixed = {r.id: r.employe_id for r in G.repair_orphans(results, feats).collect()}
    assert fixed == {1: 8, 2: None, 3: None}


def test_required_id_rule(spark):
    df = spark.createDataFrame([(None,), ("",), ("12",)], "i string")
    rows = df.select(G.validation_reason(ident=F.col("i"), require_ident=True).alias("r")).collect()
    assert [r.r for r in rows] == ["missing_id", "missing_id", None]


def test_users_from_registrations_ids_and_timestamp(spark, tmp_dir):
    path = f"{tmp_dir}/users"
    first = spark.createDataFrame([("alice",), ("bob",)], "username string")
    G.users_from_registrations(spark, first, path)
    users = G.users_from_registrations(spark, spark.createDataFrame([("carol",)], "username string"),
                                       path)
    rows = sorted(users.collect(), key=lambda r: r.id)
    assert [(r.id, r.username) for r in rows] == [(1, "alice"), (2, "bob"), (3, "carol")]
    assert all(r.created_at is not None for r in rows)
    assert dict((f.name, f.dataType.simpleString()) for f in users.schema.fields) == {
        "id": "bigint", "username": "string", "created_at": "timestamp"}
