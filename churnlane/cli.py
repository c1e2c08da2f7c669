"""Command line: one batch Spark job per operation of the scoring service.

    python -m churnlane <command> [options]

Inputs are Parquet paths (CSV for ``ingest``; a registry is Parquet or JSON
lines with ``name`` and ``metadata``).  Results are written to ``--out``
(Parquet); only one record or model description can be printed instead.  Every command builds
one DataFrame plan over whole tables; nothing is collected beyond ``show``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.operators import directory as D
from churnlane.operators import governance as G
from churnlane.operators import registry as R
from churnlane.operators import results as RS
from churnlane.operators.model_tables import predict_with_registry
from churnlane.operators.predict import as_results_rows, predict_with_models
from churnlane.operators.scoring import models_from_table
from churnlane.sources import ingest as IN


def _read(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".json") or path.endswith(".jsonl"):
        return spark.read.json(path)
    return spark.read.parquet(path)


def _emit(df: DataFrame, out: str | None) -> DataFrame:
    """Write to ``out``; commands about one record or model may print it as a JSON line instead."""
    if out:
        df.write.mode("overwrite").parquet(out)
    else:
        for line in df.toJSON().toLocalIterator():
            print(line)
    return df


def cmd_ingest(spark, a):
    loaded = IN.ingest_features_and_labels(spark, a.features_csv, a.labels_csv,
                                           a.features_out, a.labels_out)
    print(json.dumps({"features_loaded": loaded[0], "labels_loaded": loaded[1]}))


def cmd_predict(spark, a):
    if a.registry:   # models as data: contracts from the bundles, weights from the coefficients
        scored, rejected = predict_with_registry(_read(spark, a.requests), _read(spark, a.registry),
                                                 _read(spark, a.coefficients))
    else:
        scored, rejected = predict_with_models(_read(spark, a.requests),
                                               _load_models(spark, a.coefficients))
    if a.rejected:
        rejected.write.mode("overwrite").parquet(a.rejected)
    n = RS.append_results(spark, a.results, as_results_rows(scored))
    print(json.dumps({"appended": n}))


def cmd_stream_predict(spark, a):
    from pyspark import StorageLevel

    from churnlane import schemas as S
    from churnlane.streaming.score_stream import foreach_batch_append, read_stream

    models = _load_models(spark, a.coefficients)
    try:
        schema = spark.read.format(a.format).load(a.source).schema
    except Exception:  # no file yet: the declared request schema
        schema = S.REQUEST_SCHEMA

    def sink(batch, batch_id):
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            key = f"{a.name}-{batch_id}"
            scored, rejected = predict_with_models(batch, models)
            RS.append_batch(spark, a.results, as_results_rows(scored), key)
            if a.rejected:
                rejected.write.mode("overwrite").parquet(f"{a.rejected.rstrip('/')}/batch={key}")
        finally:
            batch.unpersist()

    q = foreach_batch_append(read_stream(spark, a.source, schema, fmt=a.format,
                                         max_files_per_trigger=a.max_files), sink, a.checkpoint)
    q.awaitTermination()
    print(json.dumps({"results": a.results}))


def _load_models(spark, path):
    return models_from_table(_read(spark, path))


def cmd_columns(spark, a):
    req = spark.createDataFrame([(a.model,)], "modele string")
    _emit(R.contract_for(req, _read(spark, a.registry)), a.out)


def cmd_describe(spark, a):
    _emit(R.describe(_read(spark, a.registry), a.model), a.out)


def cmd_history(spark, a):
    _emit(RS.history(RS.read_results(spark, a.results), a.owner, a.prenom, a.nom, a.limit), a.out)


def cmd_cluster(spark, a):
    print(json.dumps({"rows": RS.cluster_results(spark, a.results, a.out), "results_path": a.out}))


def cmd_detail(spark, a):
    det = RS.detail(RS.read_results(spark, a.results), _read(spark, a.features), owner=a.owner)
    if a.id is not None:
        det = det.where(F.col("id") == a.id)
    _emit(det, a.out)


def cmd_directory(spark, a):
    _emit(D.directory(_read(spark, a.features), _read(spark, a.labels), key=a.key,
                      label_col=a.label, q=a.q, limit=a.limit), a.out)


def cmd_record(spark, a):
    _emit(D.record(_read(spark, a.features), _read(spark, a.labels), a.id, key=a.key,
                   label_col=a.label), a.out)


def cmd_register(spark, a):
    accepted, rejected = G.register_unique(_read(spark, a.requests), _read(spark, a.users)
                                           .select("username"), order_cols=a.order or None)
    if a.rejected:
        rejected.write.mode("overwrite").parquet(a.rejected)
    G.users_from_registrations(spark, accepted, a.users_out)
    print(json.dumps({"users": a.users_out}))


def cmd_erase(spark, a):
    ids = spark.createDataFrame([(int(x),) for x in a.ids.split(",")], "id long") \
        if a.ids else _read(spark, a.ids_path).select(F.col(a.ids_column).alias("id"))
    out = G.erase_and_write(spark, _read(spark, a.users), RS.read_results(spark, a.results), ids,
                            users_out=a.users_out, results_out=a.results_out, old_results_path=a.results)
    rep = out.report.first().asDict()
    print(json.dumps({"users_path": out.users_path, "results_path": out.results_path, **rep}))


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="churnlane")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("ingest", help="load features and labels CSVs with positional ids")
    s.add_argument("--features-csv", required=True)
    s.add_argument("--labels-csv", required=True)
    s.add_argument("--features-out", required=True)
    s.add_argument("--labels-out", required=True)
    s.set_defaults(fn=cmd_ingest)

    s = sub.add_parser("predict", help="score requests with the model each names and append")
    s.add_argument("--requests", required=True, help="request_id, modele, features JSON, ...")
    s.add_argument("--coefficients", required=True, help="model coefficient table")
    s.add_argument("--registry", help="model bundles: contracts, roles and options, joined as data")
    s.add_argument("--results", required=True)
    s.add_argument("--rejected")
    s.set_defaults(fn=cmd_predict)

    s = sub.add_parser("stream-predict", help="score request files as they arrive (stream)")
    s.add_argument("--source", required=True, help="folder receiving request files")
    s.add_argument("--format", default="parquet")
    s.add_argument("--coefficients", required=True)
    s.add_argument("--results", required=True)
    s.add_argument("--rejected")
    s.add_argument("--checkpoint", required=True, help="stream checkpoint (shared storage)")
    s.add_argument("--name", default="requests", help="stream name used in batch keys")
    s.add_argument("--max-files", type=int, help="files per micro-batch")
    s.set_defaults(fn=cmd_stream_predict)

    for name, fn, help_ in (("columns", cmd_columns, "a model's column contract"),
                            ("describe", cmd_describe, "a model's inspection summary")):
        s = sub.add_parser(name, help=help_)
        s.add_argument("--registry", required=True)
        s.add_argument("--model", required=True)
        s.add_argument("--out")
        s.set_defaults(fn=fn)

    s = sub.add_parser("history", help="an owner's predictions, newest first")
    s.add_argument("--results", required=True)
    s.add_argument("--owner", type=int)
    s.add_argument("--prenom")
    s.add_argument("--nom")
    s.add_argument("--limit", type=int)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_history)

    s = sub.add_parser("cluster", help="rewrite the results to a new path in owner order")
    s.add_argument("--results", required=True)
    s.add_argument("--out", required=True, help="the new version (a new path)")
    s.set_defaults(fn=cmd_cluster)

    s = sub.add_parser("detail", help="predictions with their features (table or stored JSON)")
    s.add_argument("--results", required=True)
    s.add_argument("--features", required=True)
    s.add_argument("--owner", type=int)
    s.add_argument("--id", type=int)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_detail)

    s = sub.add_parser("directory", help="features joined to labels, optional id prefix")
    s.add_argument("--features", required=True)
    s.add_argument("--labels", required=True)
    s.add_argument("--key", default="id", help="key column of both tables")
    s.add_argument("--label", default="a_quitte_l_entreprise", help="label column")
    s.add_argument("--q")
    s.add_argument("--limit", type=int)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_directory)

    s = sub.add_parser("record", help="one employee's features and label")
    s.add_argument("--features", required=True)
    s.add_argument("--labels", required=True)
    s.add_argument("--key", default="id", help="key column of both tables")
    s.add_argument("--label", default="a_quitte_l_entreprise", help="label column")
    s.add_argument("--id", type=int, required=True)
    s.add_argument("--out")
    s.set_defaults(fn=cmd_record)

    s = sub.add_parser("register", help="accept the first request per unique username")
    s.add_argument("--requests", required=True, help="username (+ ordering columns)")
    s.add_argument("--users", required=True)
    s.add_argument("--users-out", required=True,
                   help="users table the accepted names are appended to (usually --users)")
    s.add_argument("--order", nargs="*", help="columns giving the request order")
    s.add_argument("--rejected")
    s.set_defaults(fn=cmd_register)

    s = sub.add_parser("erase", help="delete users and all their predictions")
    s.add_argument("--users", required=True)
    s.add_argument("--results", required=True)
    g = s.add_mutually_exclusive_group(required=True)
    g.add_argument("--ids", help="comma separated user ids")
    g.add_argument("--ids-path", help="table of user ids to erase")
    s.add_argument("--ids-column", default="id")
    s.add_argument("--users-out", help="new users table (default: under the scratch root)")
    s.add_argument("--results-out", help="new results table (default: under the scratch root)")
    s.set_defaults(fn=cmd_erase)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = build_parser().parse_args(argv)
    if spark is None:
        from churnlane.session import get_spark
        spark = get_spark()
    args.fn(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
