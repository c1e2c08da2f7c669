"""The corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's documents.

All stages decide by row, so rows that share an id or have none are judged one
by one.  An empty table gives an empty table.  Texts are read whole, whatever
their length.  Further columns are kept as they are; names that begin with
``_cl_`` are reserved for the stages' own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlane.llm import decontam, langid, mixing, ngram_join
from churnlane.llm.queries import sharding_of
from churnlane.session import ensure_checkpoint_dir, read_table, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or like none of the languages, go.

    A null or empty text has no letters.  Rows without a ``lang`` teach nothing
    but are judged; equal rows get equal verdicts; of languages with equal
    cosines the first by name is taken, which does not matter for staying.
    """
    ensure_checkpoint_dir(spark)
    return langid.confident(docs, langid.learn(docs.where(~langid.held_out())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of the smallest id, rows without an id last.

    Documents without words (null, empty or blank text) are in no group and
    all stay; of rows equal in id and text one stays.
    """
    ensure_checkpoint_dir(spark)
    return ngram_join.one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go, by the contamination rule of ``decontam.contaminated``.

    A null or empty text has no words and stays; equal rows go together; an
    empty benchmark, or items without words, remove nothing.
    """
    ensure_checkpoint_dir(spark)
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, 0 to 3 times.

    The null source is a source of its own, the last.  Rows without words have
    size 0; rows equal in id, source and size share their copies.
    """
    ensure_checkpoint_dir(spark)
    return mixing.materialise(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row of the mix, in the columns of op10.

    A null text has 16 bytes and the checksum of nothing; a null id is a key
    like any other, so its rows share a shard; repeated rows get slots of
    their own.
    """
    ensure_checkpoint_dir(spark)
    return sharding_of(docs)


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: Learned prototypes and hash draws are beyond SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
