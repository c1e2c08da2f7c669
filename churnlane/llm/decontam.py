"""Benchmark decontamination: windows of benchmark items found in training texts.

DataFrame and SQL functions only.  Each window of an item is looked up by its
anchor, its longest word: a training text's words are tested against the hash
set of anchors, and only where an anchor stands is the whole window compared
with the broadcast window table.  The test set is small next to the corpus,
but its size is checked: beyond ``max_windows`` windows nothing is broadcast
and the same join runs on shuffled keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane.llm.chunks import MAX_KEYS, row_key
from churnlane.operators.joins import join_bounded
from churnlane.session import cut_lineage

#: Windows that may be broadcast; about 0.2 KB each.
MAX_WINDOWS = 200_000
_WORD = r"[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, then runs of digits, a-z and non-ASCII characters."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER),
                                F.lit(_WORD), F.lit(0))


def windows(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(win, len, anchor, off, item_ids): the distinct windows of all items.

    ``off`` is where in the window its anchor stands, from 0.  An item with
    fewer than ``width`` words, but not none, is one window.
    """
    w = items.select(F.col(id_col).cast("string").alias("item"), item_words(F.col(text_col)).alias("w")) \
        .where(F.size("w") > 0)
    starts = w.select("item", "w", F.explode(
        F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(width - 1), F.lit(1)))).alias("s"))
    cut = starts.select("item", F.slice("w", F.col("s"), F.lit(width)).alias("ws"))
    longest = F.array_max(F.transform("ws", F.length))
    off = F.array_position(F.transform("ws", F.length), longest).cast("int") - 1
    return (cut.select("item", F.array_join("ws", " ").alias("win"), F.size("ws").alias("len"),
                       F.get("ws", off).alias("anchor"), off.alias("off"))
            .groupBy("win", "len", "anchor", "off").agg(F.sort_array(F.collect_set("item")).alias("items")))


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", width: int = 13,
         max_windows: int = MAX_WINDOWS) -> DataFrame:
    """(id, n_words, n_hit, items, spans) for every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window, ``items``
    are the ids (text, sorted) of the items whose windows occur, ``spans`` the
    occurrences as (start, len), words counted from 0.  A null or empty text
    has no words; an empty ``items`` table or null item texts hit nothing; an
    item id may be null (it hits words, but names nothing).  Rows with equal
    ids stay separate rows.
    """
    wins = windows(items, item_id_col, item_text_col, width)
    known = wins.limit(max_windows + 1).collect()  # bounded by the limit, not by the table
    words = docs.select(F.col(id_col).alias("id"), item_words(F.col(text_col)).alias("w"))
    words = words.withColumn("row", F.monotonically_increasing_id())
    if len(known) <= max_windows:
        met = _by_anchor(words, wins, sorted({r["anchor"] for r in known}))
    else:
        lengths = sorted(r["len"] for r in wins.select("len").distinct().collect())  # 1 to width
        met = _by_window(words, wins, lengths)
    return (met.groupBy("id", "row", "n_words")
            .agg(F.collect_set("span").alias("spans"),
                 F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
            .select(F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"),
                    F.size(F.array_distinct(F.flatten(F.transform(
                        "spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))))
                    .cast("long").alias("n_hit"),
                    "items", F.sort_array("spans").alias("spans")))


def _by_anchor(words: DataFrame, wins: DataFrame, anchors: list[str]) -> DataFrame:
    """Occurrences through the hash set of anchors and the broadcast window table."""
    if anchors:
        spot = F.filter(F.transform("w", lambda x, i: F.when(x.isin(anchors), i)), lambda i: i.isNotNull())
    else:
        spot = F.array().cast("array<int>")
    at = words.select("id", "row", "w", F.size("w").alias("n_words"), F.explode_outer(spot).alias("p"))
    at = at.withColumn("word", F.get("w", F.col("p")))
    start = F.col("p") - F.col("off")
    same = ((F.col("word") == F.col("anchor")) & (start >= 0)
            & (F.array_join(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("len")), " ") == F.col("win")))
    return at.join(F.broadcast(wins), same, "left").select(
        "id", "row", "n_words", F.when(F.col("win").isNotNull(), F.struct(start.alias("start"), "len")).alias("span"),
        "items")


def _by_window(words: DataFrame, wins: DataFrame, lengths: list[int]) -> DataFrame:
    """The same through a shuffled join on the window's text, for test sets too large to broadcast."""
    starts = F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1))
    spots = F.flatten(F.transform(starts, lambda s: F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.size("w") - s),
        lambda n: F.struct(s.alias("start"), n.alias("len"), F.array_join(F.slice("w", s + 1, n), " ").alias("text")))))
    at = words.select("id", "row", F.size("w").alias("n_words"), F.explode_outer(spots).alias("span"))
    return (at.join(wins, (F.col("span.text") == F.col("win")) & (F.col("span.len") == wins["len"]), "left")
            .select("id", "row", "n_words",
                    F.when(F.col("win").isNotNull(), F.struct("span.start", "span.len")).alias("span"), "items"))


def contaminated() -> Column:
    """A document is contaminated when hit words are a twentieth of its words or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns kept, that are not contaminated.

    Every row is judged by its own text, also one without an id or of a repeated id.
    """
    bad = _hits_by_key(docs, items, id_col, text_col).where(contaminated()).select("_cl_key").distinct()
    keyed = docs.withColumn("_cl_key", row_key(id_col, text_col))
    # the keys are kept, so that counting them does not search the texts twice
    bad = cut_lineage(bad)
    return join_bounded(keyed, bad, "_cl_key", "left_anti", max_rows=MAX_KEYS).select(*docs.columns)


def _hits_by_key(docs: DataFrame, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``hits`` with each row's ``_cl_key`` for its id: rows of one key have one text, and so equal hits."""
    keyed = docs.select(row_key(id_col, text_col).alias("_cl_key"), F.col(text_col).alias("text"))
    return hits(keyed, items, "_cl_key", "text")


def without_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, clean_text): the words (normalised) outside every occurrence, joined by one space."""
    found = _hits_by_key(docs, items, id_col, text_col).select("_cl_key", "spans").where(F.size("spans") > 0) \
        .dropDuplicates(["_cl_key"])
    covered = F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))
    both = docs.select(id_col, row_key(id_col, text_col).alias("_cl_key"), item_words(F.col(text_col)).alias("w")).join(
        found.select("_cl_key", covered.alias("gone")), "_cl_key", "left")
    kept = F.filter("w", lambda x, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    return both.select(id_col, F.array_join(kept, " ").alias("clean_text"))
