"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words.  Whole copies that all its
documents are certain to get are allocated first; the rest of the target is a
sample without repetition: documents are ranked by their random odds
``U / (1 - U)`` over their inclusion odds ``p / (1 - p)`` and taken in that
order up to the target; one last document closes the gap as well as it can.

No source is gathered in one task: ranks are cut into bins, the sums of the
bins decide which bins are taken whole, and only the bin that the target
falls into is ranked row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from churnlane.session import cut_lineage

BINS = 1 << 14
#: Rows of per-source tables that may be broadcast; beyond that they are joined by shuffle.
MAX_STRATA = 100_000
MOST_COPIES = 3


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sources`` (source, ...) with ``weight``: the cycle repeated in code point order, null last.

    Ordinals come from a range sort and the row counts of its partitions (one
    row per partition), so no task sees all sources.
    """
    order = [F.col("source").isNull(), F.col("source")]
    dealt = cut_lineage(sources.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("_cl_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_cl_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_cl_part").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    start = sizes.select("_cl_part", before.alias("start"))
    place = F.row_number().over(Window.partitionBy("_cl_part").orderBy(*order)) - 1 + F.col("start")
    weights = F.array(*[F.lit(w) for w in cycle])
    return (dealt.join(start, "_cl_part")
            .withColumn("weight", F.get(weights, F.pmod(place, F.lit(len(cycle))).cast("int")).cast("long"))
            .drop("_cl_part", "start"))


def targets(weighted: DataFrame, total: int | None = None, most: int = MOST_COPIES) -> DataFrame:
    """``weighted`` (source, source_size, weight, ...) with ``target``.

    The targets share ``total`` words (default: all words) by weight.  A
    target above ``most`` times its source's size stops there, and the excess
    is shared again by weight among the others until none is above.
    """
    weighted = cut_lineage(weighted)
    if total is None:
        total = weighted.agg(F.sum("source_size")).first()[0] or 0
    capped, frozen, open_weight = F.lit(False), 0, None
    while True:  # each round freezes at least one more source, or is the last
        row = weighted.agg(F.sum(F.when(~capped, F.col("weight"))).alias("w"),
                           F.sum(F.when(capped, F.col("source_size") * most)).alias("s")).first()
        open_weight, frozen = row["w"] or 0, row["s"] or 0
        if not open_weight:
            break
        share = F.col("weight") * F.lit(total - frozen) / F.lit(open_weight)
        above = capped | (share > F.col("source_size") * most)
        if weighted.where(above & ~capped).limit(1).count() == 0:
            break
        weighted = cut_lineage(weighted.withColumn("_cl_capped", above))
        capped = F.col("_cl_capped")
    stop = (F.col("source_size") * most).cast("double")
    share = (F.col("weight") * F.lit(total - frozen) / F.lit(open_weight)).cast("double") if open_weight else stop
    return weighted.withColumn("target", F.when(capped, stop).otherwise(share)).drop("_cl_capped")


def uniform(seed: str, *keys: Column) -> Column:
    """A fixed draw in (0, 1) for a row: 52 bits of an md5 of seed and keys."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def pareto_rank(draw: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds; certain rows (p >= 1) rank first, impossible ones (p <= 0) last."""
    odds = (draw / (1 - draw)) / (inclusion / (1 - inclusion))
    return (F.when(inclusion >= 1, F.lit(0.0)).when(inclusion <= 0, F.lit(float("inf"))).otherwise(odds))


def take_in_order(rows: DataFrame, stratum: str, rank: str, size: str, wanted: str, tie: list[str],
                  bins: int = BINS) -> DataFrame:
    """``rows`` with ``chosen``: per stratum the first in rank order whose sizes sum to ``wanted`` at most.

    What is left open then goes to one more row, the largest that fits (the
    first in rank of those).  Bins of the rank only save ranking whole strata;
    the choice is the same at any number of bins.  Null strata form one
    stratum; ``tie`` must tell rows apart.
    """
    # monotone in rank and spread over 0..1 for any odds
    spot = F.col(rank) / (1 + F.col(rank))
    spot = F.when(F.isnan(spot), F.lit(1.0)).otherwise(spot)
    binned = rows.withColumn("_cl_bin", F.least(F.floor(spot * bins), F.lit(bins - 1)).cast("int"))
    sums = binned.groupBy(stratum, "_cl_bin").agg(F.sum(size).alias("sum"), F.first(wanted).alias("want"))
    run = Window.partitionBy(stratum).orderBy("_cl_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("sum").over(run))
    sums = sums.select(F.col(stratum).alias("_cl_s"), F.col("_cl_bin").alias("_cl_b"),
                       (F.col("upto") - F.col("sum")).alias("_cl_before"),
                       (F.col("upto") <= F.col("want")).alias("_cl_whole"),
                       (F.col("upto") - F.col("sum") > F.col("want")).alias("_cl_none"))
    known = binned.join(sums, binned[stratum].eqNullSafe(sums["_cl_s"]) & (F.col("_cl_bin") == F.col("_cl_b")))
    edge = ~F.col("_cl_whole") & ~F.col("_cl_none")
    order = Window.partitionBy(stratum, "_cl_bin").orderBy(rank, *tie).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = known.where(edge).withColumn(
        "chosen", F.col("_cl_before") + F.sum(size).over(order) <= F.col(wanted))
    whole = known.where(~edge).withColumn("chosen", F.col("_cl_whole"))
    first = cut_lineage(ranked.unionByName(whole).drop(
        "_cl_s", "_cl_b", "_cl_bin", "_cl_before", "_cl_whole", "_cl_none"))
    gap = first.groupBy(F.col(stratum).alias("_cl_s")).agg(
        (F.first(wanted) - F.sum(F.when(F.col("chosen"), F.col(size)).otherwise(0))).alias("_cl_gap"))
    left = first.join(F.broadcast(gap) if gap.count() <= MAX_STRATA else gap,
                      first[stratum].eqNullSafe(gap["_cl_s"]))
    fits = ~F.col("chosen") & (F.col(size) > 0) & (F.col(size) <= F.col("_cl_gap")) & (F.col(rank) < float("inf"))
    last = left.where(fits).groupBy(F.col(stratum).alias("_cl_f")).agg(
        F.max_by(F.struct(*tie), F.struct(F.col(size), -F.col(rank), *tie)).alias("_cl_last"))
    picked = left.join(F.broadcast(last) if last.count() <= MAX_STRATA else last,
                       first[stratum].eqNullSafe(last["_cl_f"]), "left")
    return (picked.withColumn("chosen", F.col("chosen") | F.coalesce(F.struct(*tie) == F.col("_cl_last"), F.lit(False)))
            .drop("_cl_s", "_cl_gap", "_cl_f", "_cl_last"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = "mix") -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for every row of ``docs``.

    ``size`` counts the text's words (null: 0), ``taken`` is ``copies`` times
    that; copies run from 0 to 3.  The null source is one source, the last.
    Draws depend on ``seed``, id and size, so reruns agree; rows equal in all
    three are interchangeable.  An empty table gives an empty result, and a
    source without words has target 0 and takes nothing.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                        word_count(F.col(text_col)).alias("size"), F.monotonically_increasing_id().alias("row"))
    sized = cut_lineage(sized)  # the texts are read once, and rows keep their numbers
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = targets(source_weights(sources)).select(
        F.col("source").alias("_cl_source"), "source_size", "target")
    rows = sized.join(aimed, sized["source"].eqNullSafe(aimed["_cl_source"])).drop("_cl_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sure = F.least(F.floor(ratio), F.lit(MOST_COPIES)).cast("int")
    rows = (rows.withColumn("sure", sure).withColumn("p", ratio - F.col("sure"))
            .withColumn("wanted", F.col("target") - F.col("sure") * F.col("source_size"))
            .withColumn("rank", pareto_rank(uniform(seed, F.col("id"), F.col("size")), F.col("p"))))
    chosen = take_in_order(rows, "source", "rank", "size", "wanted", ["id", "row"])
    copies = F.least(F.col("sure") + F.when(F.col("chosen") & (F.col("p") > 0), 1).otherwise(0), F.lit(MOST_COPIES))
    return chosen.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size",
                         "target", copies.cast("int").alias("copies"),
                         (copies * F.col("size")).cast("long").alias("taken"))


def materialise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, all columns kept.

    Rows that share id, source and size get the copies of one of them each.
    """
    plan = (mix(docs, id_col, text_col, source_col)
            .groupBy(F.col(id_col).alias("_cl_id"), F.col(source_col).alias("_cl_source"),
                     F.col("size").alias("_cl_size"))
            .agg(F.sum("copies").alias("_cl_sum"), F.count(F.lit(1)).alias("_cl_rows")))
    cols = docs.columns
    sized = docs.withColumn("_cl_n", word_count(F.col(text_col)))
    joined = sized.join(plan, sized[id_col].eqNullSafe(plan["_cl_id"])
                        & sized[source_col].cast("string").eqNullSafe(plan["_cl_source"])
                        & (F.col("_cl_n") == F.col("_cl_size")))
    times = F.floor(F.col("_cl_sum") / F.col("_cl_rows")).cast("int")
    more = F.col("_cl_sum") % F.col("_cl_rows")
    alone = joined.where("_cl_rows = 1").withColumn("_cl_times", F.col("_cl_sum").cast("int"))
    same = Window.partitionBy("_cl_id", "_cl_source", "_cl_size").orderBy(F.xxhash64(text_col))
    equal = joined.where("_cl_rows > 1").withColumn(
        "_cl_times", times + F.when(F.row_number().over(same) <= more, 1).otherwise(0))
    out = alone.unionByName(equal).withColumn("_cl_copy", F.explode(F.when(
        F.col("_cl_times") > 0, F.sequence(F.lit(1), F.col("_cl_times")))))
    return out.select(*cols)
