"""The command line: each service operation as a batch job."""

import json
import os

from pyspark.sql import functions as F

from churnlane import cli


def _csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_cli_end_to_end(spark, tmp_dir, capsys):
    _csv(f"{tmp_dir}/X/x.csv", "age,statut_marital\n41,Single\n30,Married\n25,Single\n")
    _csv(f"{tmp_dir}/Y/y.csv", "a_quitte_l_entreprise\nOui\nNon\nNon\n")
    fx, fy = f"{tmp_dir}/fx", f"{tmp_dir}/fy"
    cli.main(["ingest", "--features-csv", f"{tmp_dir}/X", "--labels-csv", f"{tmp_dir}/Y",
              "--features-out", fx, "--labels-out", fy], spark)
    cli.main(["directory", "--features", fx, "--labels", fy, "--q", "1", "--out", f"{tmp_dir}/dir"], spark)
    assert [r.id for r in spark.read.parquet(f"{tmp_dir}/dir").collect()] == [1]

    coef = spark.createDataFrame([("top1", "__intercept__", None, 0.0, None, None),
                                  ("top1", "age", None, 0.1, 30.0, 10.0)],
                                 "model string, feature string, category string, weight double, "
                                 "center double, scale double")
    coef.write.parquet(f"{tmp_dir}/coef")
    reqs = spark.createDataFrame(
        [(1, "top1", json.dumps({"age": 41}), "Ana", None, None, 7),
         (2, "ghost", json.dumps({"age": 20}), None, None, 2, 7),
         (3, "top1", json.dumps({"age": 20}), "", "X", 2, 8)],
        "request_id long, modele string, features string, prenom string, nom string, "
        "employe_id long, id_user long")
    reqs.write.parquet(f"{tmp_dir}/reqs")
    res = f"{tmp_dir}/results"
    cli.main(["predict", "--requests", f"{tmp_dir}/reqs", "--coefficients", f"{tmp_dir}/coef",
              "--results", res, "--rejected", f"{tmp_dir}/rej"], spark)
    stored = spark.read.parquet(res)
    assert stored.count() == 2 and spark.read.parquet(f"{tmp_dir}/rej").count() == 1
    assert {(r.prenom, r.nom) for r in stored.collect()} == {("Ana", "Doe"), ("John", "X")}

    bundle = json.dumps({"model": {"type": "L", "predict": True}, "colonnes": ["age"]})
    spark.createDataFrame([("top1", bundle)], "name string, metadata string").write.parquet(f"{tmp_dir}/registry")
    cli.main(["predict", "--requests", f"{tmp_dir}/reqs", "--coefficients", f"{tmp_dir}/coef",
              "--registry", f"{tmp_dir}/registry", "--results", f"{tmp_dir}/results2"], spark)
    same = ["prenom", "nom", "probabilite_de_quitter", "prediction", "details"]
    again = spark.read.parquet(f"{tmp_dir}/results2").select(same).collect()
    assert sorted(again) == sorted(stored.select(same).collect())
    cli.main(["cluster", "--results", res, "--out", f"{tmp_dir}/clustered"], spark)
    assert spark.read.parquet(f"{tmp_dir}/clustered").count() == 2

    cli.main(["history", "--results", res, "--owner", "7", "--out", f"{tmp_dir}/h"], spark)
    assert spark.read.parquet(f"{tmp_dir}/h").count() == 1
    cli.main(["detail", "--results", res, "--features", fx, "--owner", "8", "--out", f"{tmp_dir}/d"],
             spark)
    d = spark.read.parquet(f"{tmp_dir}/d").first()
    assert d.source_features == "employes_features" and json.loads(d.features)["age"] == 30

    users = spark.createDataFrame([(7, "bob"), (8, "eve")], "id long, username string")
    users.write.parquet(f"{tmp_dir}/users")
    capsys.readouterr()
    cli.main(["erase", "--users", f"{tmp_dir}/users", "--results", res, "--ids", "7,99"], spark)
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (out["users_deleted"], out["results_deleted"], out["unknown_users"]) == (1, 1, 1)
    assert spark.read.parquet(out["results_path"]).where(F.col("id_user") == 7).count() == 0


def test_cli_register_appends_to_users_table(spark, tmp_dir):
    from churnlane import schemas as S
    users = f"{tmp_dir}/users"
    spark.createDataFrame([], S.USERS_SCHEMA).write.parquet(users)
    reqs = spark.createDataFrame([(" ann ", 1), ("bob", 2), ("ann", 3)], "username string, t int")
    reqs.write.parquet(f"{tmp_dir}/reqs")
    cli.main(["register", "--requests", f"{tmp_dir}/reqs", "--users", users, "--users-out", users,
              "--order", "t", "--rejected", f"{tmp_dir}/rej"], spark)
    cli.main(["register", "--requests", f"{tmp_dir}/reqs", "--users", users, "--users-out", users,
              "--order", "t"], spark)
    stored = sorted((r.id, r.username) for r in spark.read.parquet(users).collect())
    assert stored == [(1, "ann"), (2, "bob")]                       # second run: all exist
    assert [r.reason for r in spark.read.parquet(f"{tmp_dir}/rej").collect()] == ["duplicate"]


def test_cli_stream_predict_picks_up_new_files_only(spark, tmp_dir):
    coef = spark.createDataFrame([("top1", "__intercept__", None, 0.0, None, None),
                                  ("top1", "age", None, 0.1, 30.0, 10.0)],
                                 "model string, feature string, category string, weight double, "
                                 "center double, scale double")
    coef.write.parquet(f"{tmp_dir}/coef")
    schema = ("request_id long, modele string, features string, prenom string, nom string, "
              "employe_id long, id_user long")

    def drop(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/in/{name}")

    args = ["stream-predict", "--source", f"{tmp_dir}/in/*", "--coefficients", f"{tmp_dir}/coef",
            "--results", f"{tmp_dir}/res", "--rejected", f"{tmp_dir}/rej",
            "--checkpoint", f"{tmp_dir}/ckpt", "--max-files", "1"]
    drop("a", [(1, "top1", json.dumps({"age": 40}), "A", None, None, 1),
               (2, "ghost", "{}", None, None, None, 1)])
    drop("b", [(3, "top1", json.dumps({"age": 20}), None, None, None, 2)])
    cli.main(args, spark)
    drop("c", [(4, "top1", json.dumps({"age": 30}), None, None, None, 2)])
    cli.main(args, spark)
    res = spark.read.parquet(f"{tmp_dir}/res")
    assert sorted(r.id for r in res.collect()) == [1, 2, 3]
    assert spark.read.parquet(f"{tmp_dir}/rej").count() == 1
