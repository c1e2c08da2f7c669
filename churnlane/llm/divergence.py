"""How far the sources of a language differ in their terms.

Every (language, source) group is a sorted array of (term id, count), cut into
blocks of the term ids.  A task takes one block of the arrays of an unordered
pair of groups: a galloping search finds the terms that both hold, and the
overlap, what one side holds alone and what both lack are priced separately.
The prices of a pair's blocks add up to its divergence, the same both ways.

Smoothed shares are integers: p = 1 + floor(SCALE * (count + 2) / (N + 2 * V)).
A price is floor((p - q)^2 / (p + q)).
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlane.llm.ship import ship
from churnlane.session import cut_lineage

SCALE = 1_000_000_000
#: Term ids of one block: 2 to this power.
BLOCK_BITS = 16
#: Distinct (group, term) entries a task holds before it lets its counts go.
HELD = 400_000

#: Terms are runs of letters A-Z, a-z and non-ASCII characters; only A-Z are lower-cased.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_terms(docs: DataFrame, lang_col: str = "lang", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group.

    Null values count as ''.  Tasks add up their own rows first, in memory of
    at most ``HELD`` entries beyond one text.
    """
    ship(docs.sparkSession)

    def rows(counts: dict, seen: dict):
        for (lang, source), terms in counts.items():
            found, n = list(terms), list(terms.values())
            for a in range(0, len(found), 100_000):
                part = found[a: a + 100_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()), pa.array(n[a: a + 100_000], pa.int64()),
                    pa.array([seen[lang, source][t] for t in part], pa.int64()),
                ], ["lang", "source", "term", "n", "docs"])

    def count(batches):
        counts, seen, held = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c) for c in range(3))):
                group = lang.as_py(), source.as_py()
                terms, own = text.as_py().encode().translate(_TERMS).split(), counts[group]
                held -= len(own)
                own.update(terms)
                seen[group].update(set(terms))
                held += len(own)
                if held >= HELD:
                    yield from rows(counts, seen)
                    counts, seen, held = defaultdict(Counter), defaultdict(Counter), 0
        yield from rows(counts, seen)

    def plain(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    parts = (docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source"), plain(text_col).alias("text"))
             .mapInArrow(count, "lang string, source string, term string, n long, docs long"))
    return (parts.repartition("lang", "term").groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def kept_terms(counts: DataFrame, least_docs: int = 10) -> tuple[DataFrame, DataFrame]:
    """((lang, source, term, n), (lang, term, lang_n, term_id)) of terms in ``least_docs`` documents of their language.

    Both are checkpointed, so that the ids stay as they are.
    """
    # counts are dealt by (lang, term) already: the window needs no exchange, and the texts are counted once
    lang_docs = F.sum("docs").over(Window.partitionBy("lang", "term"))
    groups = cut_lineage(counts.withColumn("lang_docs", lang_docs).where(F.col("lang_docs") >= least_docs)
                         .select("lang", "source", "term", "n"))
    terms = groups.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    return groups, cut_lineage(terms.withColumn("term_id", F.monotonically_increasing_id()))


def share(count: str, total: str, terms: str) -> Column:
    """p of a count as an exact integer; null where the language keeps no terms."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(19,0))"
                  f" div nullif(cast({total} + 2 * {terms} as decimal(19,0)), 0))")


def price(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def gallop(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """For ascending ``needles`` the first place in ascending ``hay`` that is not smaller.

    Needles are placed in strides that halve: each starts where its left
    neighbour of the wider stride stands, doubles its step until it is past
    its value, and closes in on the place by halves.
    """
    n, m = len(needles), len(hay)
    place = np.zeros(n, dtype=np.int64)
    stride = 1 << max(0, n - 1).bit_length()
    first = True
    while stride:
        at = np.arange(0, n, 2 * stride) if first else np.arange(stride, n, 2 * stride)
        if len(at):
            value = needles[at]
            low = np.zeros(len(at), np.int64) if first else place[at - stride].copy()
            step = np.ones(len(at), dtype=np.int64)
            going = np.flatnonzero(low < m)
            while len(going):  # hay[low - 1] < value holds; double the step while hay[low + step - 1] < value
                probe = low[going] + step[going] - 1
                going = going[(probe < m) & (hay[np.minimum(probe, m - 1)] < value[going])]
                low[going] += step[going]
                step[going] *= 2
            high = np.minimum(low + step - 1, m)
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) // 2
                less = hay[middle] < value[open_]
                low[open_[less]] = middle[less] + 1
                high[open_[~less]] = middle[~less]
                open_ = open_[low[open_] < high[open_]]
            place[at] = low
        if first:
            first = False
        stride //= 2
    return place


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``share`` of many counts: SCALE in three steps of long division, exact below 9e15."""
    size, rest = total + 2 * terms, counts + 2
    whole = np.zeros_like(rest)
    for _ in range(3):
        rest = rest * 1000
        whole = whole * 1000 + rest // size
        rest = rest % size
    return whole + 1


def _price(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) ** 2 // (p + q)).sum())


def merge_price(a: tuple, b: tuple, a_total: int, b_total: int, terms: int) -> tuple[int, int]:
    """(price of the terms that one side holds or both, number of those terms) of two (ids, counts)."""
    if len(a[0]) > len(b[0]):
        a, b, a_total, b_total = b, a, b_total, a_total
    place = gallop(a[0], b[0])
    both = np.zeros(len(place), dtype=bool)
    inside = place < len(b[0])
    both[inside] = b[0][place[inside]] == a[0][inside]
    p, q = _shares(a[1], a_total, terms), _shares(b[1], b_total, terms)
    no_p, no_q = (_shares(np.zeros(1, np.int64), t, terms) for t in (a_total, b_total))
    alone = np.ones(len(q), dtype=bool)
    alone[place[both]] = False
    value = _price(p[both], q[place[both]]) + _price(p[~both], no_q) + _price(no_p, q[alone])
    return value, len(p) + int(alone.sum())


def _cogrouped(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block of an unordered pair of groups: each side has a row or none."""

    def side(t: pa.Table) -> tuple:
        if not t.num_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(t.column(c)[0].values.to_numpy() for c in ("ids", "counts"))

    one = (left if left.num_rows else right).select(["lang", "a", "b", "a_total", "b_total", "terms"]).to_pylist()[0]
    value, held = merge_price(side(left), side(right), one["a_total"], one["b_total"], one["terms"])
    return pa.table({"lang": pa.array([one["lang"]], pa.string()), "a": pa.array([one["a"]], pa.string()),
                     "b": pa.array([one["b"]], pa.string()), "value": pa.array([value], pa.int64()),
                     "held": pa.array([held], pa.int64())})


def _pair_values(groups: DataFrame, terms: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, both ways."""
    blocks = F.expr(f"pmod(xxhash64(term), greatest(1, (terms + (1 << {BLOCK_BITS}) - 1) >> {BLOCK_BITS}))")
    per_lang = sizes.groupBy("lang").agg(F.first("terms").alias("terms"))
    numbered = terms.join(per_lang, "lang").select("lang", "term", "term_id", blocks.alias("block"))
    entries = F.array_sort(F.collect_list(F.struct("term_id", "n")))
    arrays = (groups.join(numbered, ["lang", "term"]).groupBy("lang", "source", "block")
              .agg(entries.alias("e"))
              .select("lang", "source", "block", F.col("e.term_id").alias("ids"), F.col("e.n").alias("counts")))
    arrays = cut_lineage(arrays)
    a = sizes.select("lang", F.col("source").alias("a"), F.col("total").alias("a_total"), "terms")
    b = sizes.select("lang", F.col("source").alias("b"), F.col("total").alias("b_total"))
    pairs = a.join(b, "lang").where("a < b")
    key = ["lang", "a", "b", "block"]

    def side(name: str) -> DataFrame:
        rows = pairs.join(arrays.withColumnRenamed("source", name), ["lang", name])
        # aliases give the two sides columns of their own; both come from the same tables
        return rows.select(*(F.col(c).alias(c) for c in (*key, "a_total", "b_total", "terms", "ids", "counts"))).groupBy(*key)

    merged = (side("a").cogroup(side("b"))
              .applyInArrow(_cogrouped, "lang string, a string, b string, value long, held long")
              .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("held").alias("held")))
    absent = (pairs.withColumn("p", share("0L", "a_total", "terms")).withColumn("q", share("0L", "b_total", "terms"))
              .withColumn("each", F.coalesce(price("p", "q"), F.lit(0).cast("long"))))
    whole = (absent.join(merged, ["lang", "a", "b"], "left")
             .select("lang", "a", "b", F.expr("coalesce(value, 0) + each * (terms - coalesce(held, 0))").alias("value")))
    return whole.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"),
                        "value").select("lang", "x.source", "x.item", "value")


def _ranked(rows: DataFrame, part: str, most: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    out = rows.withColumn("rank", F.row_number().over(order))
    if most is not None:
        out = out.where(F.col("rank") <= most)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, least_docs: int = 10, top_terms: int = 10, lang_col: str = "lang",
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): divergences of sources, and the terms a source overuses.

    Part ``pair``: every other source of the language with the summed price over
    all kept terms.  Part ``term``: the ``top_terms`` kept terms of which the
    group has a larger share than its language has.  Ranks start at 1 per group
    and part, by value descending, then item in UTF-8 order.

    Null text, language and source count as ''.  A group without kept terms
    still stands in part ``pair`` (its shares are those of absent terms); a
    language without kept terms has only zeros.  Repeated rows count as often
    as they stand; ids and other columns are ignored.  An empty table gives an
    empty result.
    """
    cols = {"lang_col": lang_col, "source_col": source_col, "text_col": text_col}
    groups, terms = kept_terms(count_terms(docs, **cols), least_docs)
    every = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang_col, "lang"), (source_col, "source")))).distinct()
    totals = groups.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    sizes = cut_lineage(every.join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
                        .na.fill(0, ["total", "terms", "lang_total"]))
    over = (groups.join(terms, ["lang", "term"]).join(sizes, ["lang", "source"])
            .withColumn("p", share("n", "total", "terms")).withColumn("q", share("lang_n", "lang_total", "terms"))
            .where("p > q").select("lang", "source", F.col("term").alias("item"), price("p", "q").alias("value")))
    return (_ranked(_pair_values(groups, terms, sizes), "pair", None)
            .unionByName(_ranked(over, "term", top_terms)))
