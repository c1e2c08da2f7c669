"""Sparse one-hot encoding with a vocabulary that stays distributed (DEL-2).

``scoring.one_hot`` makes a column per category and asks the driver for the
vocabulary, which suits a few hundred.  Here the vocabulary is a table (value,
index): distinct values are range-partitioned, and each partition counts on
from the ones before it.  Rows find their index by a join and keep it instead
of a vector of mostly zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.operators.joins import join_bounded, salted_join
from churnlane.session import cut_lineage
from churnlane.sources.ingest import with_dense_id

#: Vocabulary entries that may be broadcast; larger ones are joined by a shuffle.
MAX_BROADCAST_VALUES = 1_000_000


def vocabulary_index(df: DataFrame, col: str) -> DataFrame:
    """(value, index): the distinct values of ``col`` in their order, numbered from 0; nulls have no index.

    A hot value is one row per map task; the values are sorted by ranges, and
    only row counts per range meet.  Checkpointed, so an index stays.
    """
    values = df.select(F.col(col).alias("value")).where("value is not null").distinct()
    ranged = cut_lineage(values.repartitionByRange("value").sortWithinPartitions("value"))
    return cut_lineage(with_dense_id(ranged, "index", start=0).select("value", "index"))


def indexed(df: DataFrame, col: str, vocabulary: DataFrame, out: str, salts: int | None = None,
            max_broadcast: int = MAX_BROADCAST_VALUES) -> DataFrame:
    """``df`` with the index of ``col`` in ``out``; null for nulls and for values the vocabulary lacks.

    Small vocabularies are broadcast after a size check.  Otherwise ``salts``
    spreads hot values over tasks; without it AQE splits their partitions.
    """
    names = vocabulary.select(F.col("value").alias("_cl_value"), F.col("index").alias(out))
    rows = df.withColumn("_cl_key", F.col(col))
    if salts:
        joined = salted_join(rows, names, "_cl_key", "_cl_value", "left", salts=salts)
    else:
        joined = join_bounded(rows, names.withColumnRenamed("_cl_value", "_cl_key"), "_cl_key", "left", max_rows=max_broadcast)
    return joined.select(*df.columns, out)


def one_hot_rows(df: DataFrame, key: str, col: str, vocabulary: DataFrame, **options) -> DataFrame:
    """(key, index): the place of the one in each row's vector; rows without a known value have none."""
    return indexed(df.select(key, col), col, vocabulary, "_cl_index", **options).where("_cl_index is not null") \
        .select(key, F.col("_cl_index").alias("index"))


def one_hot_vectors(df: DataFrame, cols: list[str], vocabularies: dict[str, DataFrame], out: str = "features",
                    **options) -> DataFrame:
    """``df`` with one sparse vector (size, indices, values) over the vocabularies of ``cols``, side by side.

    Nulls and unknown values leave their part of the vector empty.
    """
    sizes = {c: vocabularies[c].count() for c in cols}
    rows, offset, parts = df, 0, []
    for i, c in enumerate(cols):
        rows = indexed(rows, c, vocabularies[c], f"_cl_index_{i}", **options)
        parts.append(F.col(f"_cl_index_{i}") + F.lit(offset))
        offset += sizes[c]
    at = F.filter(F.array(*parts), lambda x: x.isNotNull())
    vector = F.struct(F.lit(offset).cast("long").alias("size"), at.alias("indices"),
                      F.transform(at, lambda _: F.lit(1.0)).alias("values"))
    return rows.withColumn(out, vector).select(*df.columns, out)
