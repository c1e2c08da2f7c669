"""SRC-1..8, SNK-2..4: CSV scan, inference, positional keys, idempotent load."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.sources import ingest as IN


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_three_type_inference(spark, tmp_dir):
    _write(f"{tmp_dir}/x/a.csv",
           "i,f,g,b,d,s,n\n1,1.5,1,True,2024-01-01,x,NA\n2,2,NA,False,2024-01-02,3,\n")
    df = IN.read_csv_table(spark, f"{tmp_dir}/x", id_col=None)
    types = {f.name: type(f.dataType) for f in df.schema.fields}
    assert types == {"i": T.LongType, "f": T.DoubleType, "g": T.DoubleType, "b": T.StringType,
                     "d": T.StringType, "s": T.StringType, "n": T.DoubleType}
    rows = df.orderBy("i").collect()
    assert rows[0].b == "True" and rows[1].g is None and rows[0].s == "x"


def test_positional_ids_follow_file_order_across_splits(spark, tmp_dir):
    n = 3000
    lines = "".join(f"{i},row{i}\n" for i in range(n))
    _write(f"{tmp_dir}/y/part-0.csv", "v,name\n" + lines[: len(lines) // 2].rsplit("\n", 1)[0] + "\n")
    first = lines[: len(lines) // 2].count("\n")
    rest = "".join(f"{i},row{i}\n" for i in range(first, n))
    _write(f"{tmp_dir}/y/part-1.csv", "v,name\n" + rest)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")   # many splits per file
    try:
        df = IN.read_csv_table(spark, f"{tmp_dir}/y", id_col="id")
        rows = df.select("id", "v").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == n
    assert all(r.id == r.v + 1 for r in rows)


def test_ids_do_not_depend_on_how_later_jobs_split_the_files(spark, tmp_dir):
    n = 4000
    _write(f"{tmp_dir}/d/a.csv", "v,name\n" + "".join(f"{i},row{i}\n" for i in range(n)))
    (spark.range(n).select(F.col("id").alias("v")).coalesce(1).write
     .option("parquet.block.size", 4096).option("parquet.enable.dictionary", "false").parquet(f"{tmp_dir}/p"))
    size, number = "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"
    old = spark.conf.get(size)
    for first, second in (("4096", "1500"), ("1500", "64000"), ("64000", "2048")):
        try:
            spark.conf.set(size, first)
            csv = IN.read_csv_table(spark, f"{tmp_dir}/d", id_col="id")
            keyed = IN.with_positional_id(spark.read.parquet(f"{tmp_dir}/p"))
            spark.conf.set(size, second)   # later jobs would split the files otherwise
            for parts in ("1", "7"):
                spark.conf.set(number, parts)
                for df in (csv, keyed):
                    rows = df.select("id", "v").collect()
                    assert len(rows) == n and all(r.id == r.v + 1 for r in rows)
        finally:
            spark.conf.set(size, old)
            spark.conf.unset(number)


def test_dense_ids_for_computed_frames(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 3).alias("x")).checkpoint()
    ids = sorted(r.id for r in IN.with_dense_id(df, "id", start=11).collect())
    assert ids == list(range(11, 1011))


def test_create_and_load_are_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    rows = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    assert IN.create_table_if_absent(spark, path, schema) is True
    assert IN.create_table_if_absent(spark, path, schema) is False
    assert IN.load_if_empty(spark, path, rows) is True
    assert IN.load_if_empty(spark, path, rows) is False
    assert spark.read.parquet(path).count() == 2


def test_two_source_bootstrap(spark, tmp_dir):
    _write(f"{tmp_dir}/X/x.csv", "age,statut_marital\n41,Single\n30,Married\n")
    _write(f"{tmp_dir}/Y/y.csv", "a_quitte_l_entreprise\nOui\nNon\n")
    loaded = IN.ingest_features_and_labels(spark, f"{tmp_dir}/X", f"{tmp_dir}/Y",
                                           f"{tmp_dir}/fx", f"{tmp_dir}/fy")
    assert loaded == (True, True)
    x, y = spark.read.parquet(f"{tmp_dir}/fx"), spark.read.parquet(f"{tmp_dir}/fy")
    joined = {r.id: (r.age, r.a_quitte_l_entreprise) for r in x.join(y, "id").collect()}
    assert joined == {1: (41, "Oui"), 2: (30, "Non")}
    again = IN.ingest_features_and_labels(spark, f"{tmp_dir}/X", f"{tmp_dir}/Y",
                                          f"{tmp_dir}/fx", f"{tmp_dir}/fy")
    assert again == (False, False) and spark.read.parquet(f"{tmp_dir}/fx").count() == 2


def test_schema_evolution_helpers(spark, tmp_dir):
    from churnlane.sources import sinks as SK
    path = f"{tmp_dir}/evolve"
    spark.createDataFrame([(1, "a")], "id long, name string").write.parquet(path)
    SK.append_evolving(path, spark.createDataFrame([(2, "b", 7)], "id long, name string, extra int"))
    rows = sorted(SK.read_evolved(spark, path).collect(), key=lambda r: r.id)
    assert [(r.id, r.extra) for r in rows] == [(1, None), (2, 7)]
    df = SK.ensure_columns(spark.createDataFrame([(1,)], "id long"),
                           [T.StructField("id", T.LongType()), T.StructField("details", T.StringType())])
    assert df.columns == ["id", "details"] and df.first().details is None


def test_id_ledger_continues_legacy_table(spark, tmp_dir):
    from churnlane.sources.sinks import reserve_ids
    path = f"{tmp_dir}/legacy"
    spark.createDataFrame([(5,), (9,)], "id long").write.parquet(path)
    assert reserve_ids(spark, path, 3) == 10          # scanned once: max id 9
    assert reserve_ids(spark, path, 2) == 13          # from the ledger now
    assert spark.read.parquet(path).count() == 2      # the ledger is not read as data


def test_headers_with_dots_and_spaces(spark, tmp_dir):
    _write(f"{tmp_dir}/z/a.csv", "a.b,c d,e\n1,x,2.5\n2,y,NA\n")
    df = IN.read_csv_table(spark, f"{tmp_dir}/z", id_col="id")
    assert df.columns == ["id", "a.b", "c d", "e"]
    rows = df.orderBy("id").collect()
    assert [(r["id"], r["a.b"], r["c d"], r["e"]) for r in rows] == [(1, 1, "x", 2.5), (2, 2, "y", None)]


def test_compact_ledger_keeps_continuation_and_every_key(spark, tmp_dir):
    from churnlane.sources.sinks import compact_ledger, reserve_ids
    path = f"{tmp_dir}/ledgered"
    firsts = [reserve_ids(spark, path, 5, key=f"s-{b}") for b in range(6)]
    assert firsts == [1, 6, 11, 16, 21, 26]
    assert compact_ledger(spark, path) == 1 + 6
    assert [reserve_ids(spark, path, 5, key=f"s-{b}") for b in range(6)] == firsts   # any batch replays
    assert reserve_ids(spark, path, 3) == 31                 # continuation kept


def test_two_writers_never_share_a_range(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    from churnlane.sources.sinks import reserve_ids
    path = f"{tmp_dir}/raced"
    with ThreadPoolExecutor(8) as pool:
        firsts = sorted(pool.map(lambda _: reserve_ids(spark, path, 4), range(24)))
    assert firsts == list(range(1, 97, 4))


def test_load_if_empty_refuses_to_drop_columns(spark, tmp_dir):
    import pytest
    IN.create_table_if_absent(spark, f"{tmp_dir}/t", T.StructType([T.StructField("id", T.LongType())]))
    with pytest.raises(ValueError):
        IN.load_if_empty(spark, f"{tmp_dir}/t", spark.createDataFrame([(1, 2)], "id long, other long"))
