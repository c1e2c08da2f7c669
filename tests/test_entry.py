"""Driver contract, streaming = batch, and oracle parity on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from churnlane.plans import catalogue as C
from churnlane.session import scratch_path
from churnlane.streaming import score_stream as ST

SF_SMALL = "/root/testdata/sf0.001"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["doc_id", "libelle", "quality"] and len(rows) > 0
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


def test_every_query_has_an_oracle_or_is_declared():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert set(qs) - set(oracle) == E.NO_ORACLE


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(set(C.QUERIES) - E.NO_ORACLE))
def test_query_matches_oracle_smallest_scale(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    srows = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    idx = [dcols.index(c) for c in sorted(cols)]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert sorted(cols) == sorted(dcols)
    assert srows == drows


def test_stream_equals_batch(spark):
    batch = {tuple(r) for r in C._score_events(C._t(spark, SF_SMALL, "events"))
             .select("request_id", "probabilite_de_quitter", "prediction").collect()}
    schema = C._t(spark, SF_SMALL, "events").schema
    out = ST.score_stream(spark, SF_SMALL, schema,
                          lambda s: C._score_events(s).select("request_id", "probabilite_de_quitter",
                                                              "prediction"),
                          scratch_path(spark, "t-out"), scratch_path(spark, "t-ckpt"),
                          glob="events.parquet")
    assert {tuple(r) for r in out.collect()} == batch


def test_stream_restart_adds_nothing(spark):
    schema = C._t(spark, SF_SMALL, "events").schema
    out_p, ck = scratch_path(spark, "r-out"), scratch_path(spark, "r-ckpt")

    def transform(s):
        return s.select("event_id", "user_id")

    first = ST.score_stream(spark, SF_SMALL, schema, transform, out_p, ck, glob="events.parquet")
    n = first.count()
    again = ST.score_stream(spark, SF_SMALL, schema, transform, out_p, ck, glob="events.parquet")
    assert again.count() == n == C._t(spark, SF_SMALL, "events").count()


def test_stream_to_results_ids_and_replay(spark):
    from pyspark.sql import functions as F
    from churnlane.operators.predict import as_results_rows
    from churnlane.operators.results import append_batch, read_results
    path = scratch_path(spark, "sr")
    schema = C._t(spark, SF_SMALL, "events").schema
    back = ST.stream_to_results(spark, SF_SMALL, schema,
                                lambda b: as_results_rows(C._score_events(b)), path,
                                scratch_path(spark, "sr-ckpt"), "t", glob="events.parquet")
    n = C._t(spark, SF_SMALL, "events").count()
    assert sorted(r.id for r in back.select("id").collect()) == list(range(1, n + 1))
    # replaying batch 0 rewrites the same rows with the same ids
    rows = as_results_rows(C._score_events(C._t(spark, SF_SMALL, "events")))
    append_batch(spark, path, rows, "t-0")
    again = read_results(spark, path)
    assert again.count() == n and again.agg(F.max("id")).first()[0] == n


def test_bench_measure_contract(spark):
    import json as _json

    import bench
    out = bench.measure(spark, SF_SMALL, ["directory_prefix", "history_topk"], runs=1)
    line = _json.dumps(out)
    assert "\n" not in line and out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"directory_prefix", "history_topk"}
    assert out["value"] > 0 and "errors" not in out
    assert set(bench.HEADLINE) <= set(E.queries())
