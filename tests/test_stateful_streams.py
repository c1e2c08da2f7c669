"""Registration and deduplication of streams against their batch or brute-force twins."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.operators.governance import register_unique
from churnlane.streaming import dedup as DD
from churnlane.streaming import registration as RG

REQUEST = "username string, seq long, note string"


def _file(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _batches():
    rows = []
    for i in range(240):
        name = [f" user{i % 37} ", "hot", None, "x", "", f"stored{i % 4}", f"late{i}"][i % 7]
        rows.append((name, i if i % 31 else None, f"n{i}"))
    # inside a batch the order is not the order of the numbers
    return [sorted(rows[a: a + 80], key=lambda r: r[2], reverse=True) for a in (0, 80, 160)]


def _stored(spark):
    return spark.createDataFrame([("stored1 ",), ("stored3",), (None,)], "username string")


def test_streamed_registration_equals_batch_across_a_restart(spark, tmp_dir):
    schema = T._parse_datatype_string(REQUEST)
    first, second, third = _batches()
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"

    def run():
        return RG.register_files(spark, src, schema, _stored(spark), ["seq", "note"], out, ck, max_files_per_trigger=1)

    _file(spark, src, first, REQUEST)
    _file(spark, src, second, REQUEST)
    assert run().count() == 160
    assert run().count() == 160                      # nothing new, nothing repeated
    _file(spark, src, third, REQUEST)
    got = {(r.note, r.username, r.reason) for r in run().collect()}
    assert len(got) == 240
    # batch twin: arrival (the batch) first, then the order columns
    whole = [(*r, b) for b, part in enumerate((first, second, third)) for r in part]
    ok, no = register_unique(spark.createDataFrame(whole, REQUEST + ", b int"), _stored(spark), order_cols=["b", "seq", "note"])
    assert got == {(r.note, r.username, None) for r in ok.collect()} | {(r.note, r.username, r.reason) for r in no.collect()}


def test_registration_without_stored_names_and_with_a_ttl(spark, tmp_dir):
    schema = T._parse_datatype_string(REQUEST)
    src = f"{tmp_dir}/in"
    _file(spark, src, [("anna", 2, "b"), ("anna", 1, "a"), ("bert", 3, "c")], REQUEST)
    got = RG.register_files(spark, src, schema, None, ["seq"], f"{tmp_dir}/out", f"{tmp_dir}/ck", ttl_ms=1)
    assert {(r.note, r.reason) for r in got.collect()} == {("a", None), ("b", "duplicate"), ("c", None)}
    _file(spark, src, [("anna", 9, "d")], REQUEST)   # its name was forgotten long ago
    got = RG.register_files(spark, src, schema, None, ["seq"], f"{tmp_dir}/out", f"{tmp_dir}/ck", ttl_ms=1)
    assert {(r.note, r.reason) for r in got.collect()} >= {("d", None)}


EVENT = "rid long, ts timestamp, v string"
T0 = datetime(2024, 1, 1)


def _at(minutes):
    return T0 + timedelta(minutes=minutes)


def _brute(batches, delay):
    """Rows by output, one batch after the other: (accepted ids, side rows)."""
    newest, seen, accepted, side = None, set(), [], []
    for rows in batches:
        mark = None if newest is None else newest - delay
        for rid, ts, v in rows:
            if rid is None:
                side.append((v, DD.NO_ID))
            elif ts is None:
                side.append((v, DD.NO_TIME))
            elif mark is not None and ts < mark:
                side.append((v, DD.LATE))
            elif rid not in seen:
                seen.add(rid)
                accepted.append((rid, ts))
        newest = max([t for _, t, _ in rows if t is not None] + ([newest] if newest else []), default=newest)
    return accepted, side


@pytest.mark.parametrize("restart", [False, True])
def test_dedup_of_out_of_order_input(spark, tmp_dir, restart):
    schema = T._parse_datatype_string(EVENT)
    batches = []
    for b in range(5):
        rows = [(b * 100 + i, _at(60 * b + i), f"{b}-{i}") for i in range(50)]
        rows += [(r[0], r[1], r[2] + "again") for r in rows[::5]]
        if b:
            rows += [((b - 1) * 100 + i, _at(60 * (b - 1) + i), f"{b}-{i}retry") for i in range(3, 40, 7)]
            rows += [(9000 + b * 10 + i, _at(60 * (b - 1) + i), f"{b}-{i}slow") for i in range(5)]
        if b >= 3:
            rows += [(8000 + b * 10 + i, _at(60 * (b - 3) + i), f"{b}-{i}late") for i in range(4)]
        rows += [(None, _at(60 * b), f"{b}noid"), (7000 + b, None, f"{b}notime"), (None, None, f"{b}nothing")]
        batches.append(rows[::-1])
    src, delay = f"{tmp_dir}/in", timedelta(minutes=90)

    def run():
        return DD.dedup_files(spark, src, schema, "rid", "ts", delay.total_seconds(), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                              max_files_per_trigger=1)

    for b, rows in enumerate(batches):
        _file(spark, src, rows, EVENT)
        if restart and b in (0, 2):
            run()
    accepted, side = run()
    want, want_side = _brute(batches, delay)
    assert sorted((r.rid, r.ts) for r in accepted.collect()) == sorted(want)
    assert sorted((r.v, r.side) for r in side.collect()) == sorted(want_side)
    assert any(s == DD.LATE for _, s in want_side)
    again, _ = run()
    assert again.count() == len(want)


def test_lateness_before_the_first_batch(spark):
    df = spark.createDataFrame([(1, _at(0), "a"), (None, _at(0), "b"), (2, None, "c")], EVENT)
    got = {r.v: r.s for r in df.select("v", DD.lateness("rid", "ts", None).alias("s")).collect()}
    assert got == {"a": DD.ON_TIME, "b": DD.NO_ID, "c": DD.NO_TIME}
    assert df.where(F.col("rid") == 1).select(DD.lateness("rid", "ts", int(_at(1).timestamp() * 1e6)).alias("s")).first().s == DD.LATE
