"""Chat formatting: logged snapshots of one conversation collapse into the longest, then render.

Loggers write a conversation again after each turn.  A conversation whose
turns are the first turns of a longer one is dropped; of equal ones the
smallest id stays.  Each turn is hashed with its place, and the running XOR of
these hashes identifies every prefix of a conversation, so prefixes are found
by equality: an anti-join of whole conversations with all shorter prefixes.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNKNOWN_ROLE = "unknown"


def _turn_hash(seed: int, place: Column) -> Column:
    """Hash of a turn and its place; null and empty texts and roles differ."""
    return F.xxhash64(F.lit(seed), place, F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def numbered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, k, n, role, text, p1, p2): turns with their place from 1 and the hashes of the prefix they end."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    whole = Window.partitionBy("conv")
    run = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("k", F.row_number().over(whole.orderBy(*order)))
    rows = rows.withColumn("h1", _turn_hash(1, F.col("k"))).withColumn("h2", _turn_hash(2, F.col("k")))
    return rows.select("conv", "k", F.max("k").over(whole).alias("n"), "role", "text",
                       F.bit_xor("h1").over(run).alias("p1"), F.bit_xor("h2").over(run).alias("p2"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of ``numbered`` turns: conversations that are no prefix of a longer one.

    Equal conversations are one, under the smallest id; ``n_copies`` counts them.
    """
    full = (turns.where(F.col("k") == F.col("n")).groupBy("n", "p1", "p2")
            .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_copies")))
    shorter = turns.where(F.col("k") < F.col("n")).select(F.col("k").alias("n"), "p1", "p2").distinct()
    return (full.join(shorter, ["n", "p1", "p2"], "left_anti")
            .select("conv", F.col("n").cast("long").alias("n_turns"), "n_copies"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv, n_turns, n_copies, rendered), one row per maximal conversation.

    Turns are ordered by number (null last), then role and text; each renders
    as ``<|role|>``, a line break and its text, joined by line breaks.  A null
    role renders as ``unknown``, a null text as empty.  Turns without a
    conversation id form one conversation, whose id is null; it has no say in
    which id stays for equal conversations.  An empty table gives no rows;
    other columns are ignored.
    """
    all_turns = numbered(turns, conv_col, turn_col, role_col, text_col)
    stay = maximal(all_turns).withColumnRenamed("conv", "stay")
    kept = all_turns.join(stay, F.col("conv").eqNullSafe(F.col("stay")))
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit(UNKNOWN_ROLE)), F.lit("|>\n"), F.coalesce("text", F.lit("")))
    return (kept.groupBy("conv").agg(
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"),
        F.array_sort(F.collect_list(F.struct("k", line.alias("line")))).alias("lines"))
        .select(F.col("conv").alias(conv_col), "n_turns", "n_copies",
                F.array_join(F.col("lines.line"), "\n").alias("rendered")))
