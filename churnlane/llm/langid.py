"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1/-1.  A trigram's vector binds (multiplies)
its letters' vectors, each permuted (rotated) by its place in the trigram; a
text's vector bundles (adds) the vectors of all its trigrams, and a language's
prototype those of all its learning texts.  A text gets the language whose
prototype has the largest cosine with it.

Bundling is linear, so texts are first counted by trigram and the counts are
multiplied with the trigrams' vectors.  Prototypes are learned from counts
summed by language in Spark: their size is languages x trigram codes, which
does not grow with the corpus.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.kernels import slices
from churnlane.llm.ship import ship

DIMENSIONS = 512
#: Letter codes: 0 is a gap, 1 to 26 are a to z, other letters share the rest by code point.
CODES = 64
#: A guard on the size of the broadcast prototypes, not a limit on rows.
MAX_LANGUAGES = 2000
UNDETERMINED = "und"
_DOCS = 48


@functools.cache
def _letter_codes() -> np.ndarray:
    """Code of every code point: 0 for what is no letter; case is folded."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            table[cp] = low - 96 if 97 <= low <= 122 else 27 + low % (CODES - 27)
    return table


@functools.cache
def _letter_vectors() -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(0, 2, size=(CODES, DIMENSIONS)).astype(np.float32) * 2 - 1


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    v = _letter_vectors()
    a, b, c = codes // (CODES * CODES), codes // CODES % CODES, codes % CODES
    return np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]


def _trigrams(buf: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of a run of texts, and the text of each.

    Every run of other characters is one gap, and a text has a gap at either
    end, so one letter already has a trigram; trigrams without a letter in
    the middle (gap between two words) count too.
    """
    chars = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = (buf & 0xC0) != 0x80  # first bytes of code points
    at = np.concatenate([[0], np.cumsum(lead)])[offsets]
    code = np.zeros(len(chars) + 2 * (len(at) - 1), dtype=np.int64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    code[np.arange(len(chars)) + 2 * doc + 1] = _letter_codes()[chars]
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at) + 2)
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0) | (owner[1:] != owner[:-1])
    code, owner = code[keep], owner[keep]
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tri = code[:-2] * (CODES * CODES) + code[1:-1] * CODES + code[2:]
    whole = owner[:-2] == owner[2:]
    return tri[whole], owner[:-2][whole]


def _text_runs(texts: pa.Array):
    """(first row, trigram codes, owner, rows) a few documents at a time."""
    for a, _, buf, off in slices(texts):
        for i in range(0, len(off) - 1, _DOCS):
            o = off[i: i + _DOCS + 1]
            tri, own = _trigrams(buf[o[0]: o[-1]], o - o[0])
            yield a + i, tri, own, len(o) - 1


def profile_counts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, trigram, n) over all rows with a language; one partial sum per task travels."""

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for a, tri, own, n in _text_runs(batch.column("text")):
                names = langs[a: a + n]
                for name in set(names):
                    mine = np.array([x == name for x in names])[own]
                    total = seen.setdefault(name, np.zeros(CODES ** 3, dtype=np.int64))
                    total += np.bincount(tri[mine], minlength=CODES ** 3)
        for name, total in seen.items():
            k = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(k), pa.string()), pa.array(k, pa.int32()),
                                              pa.array(total[k])], ["lang", "trigram", "n"])

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(count, "lang string, trigram int, n long")
            .groupBy("lang", "trigram").agg(F.sum("n").alias("n")))


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their unit prototypes.

    Rows without a language are skipped; null and empty texts add nothing.
    No labelled row gives no language, and then every text is undetermined.
    """
    ship(docs.sparkSession)
    counts = profile_counts(docs, lang_col, text_col)
    rows = counts.groupBy("lang").agg(F.collect_list("trigram").alias("t"), F.collect_list("n").alias("n"))
    langs, protos = [], []
    for r in rows.toLocalIterator():  # one language at a time
        langs.append(r["lang"])
        t, n = np.array(r["t"], np.int64), np.array(r["n"], np.float64)
        v = np.zeros(DIMENSIONS)
        for i in range(0, len(t), 8192):
            v += n[i: i + 8192] @ trigram_vectors(t[i: i + 8192])
        protos.append(v)
        if len(langs) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
    order = sorted(range(len(langs)), key=langs.__getitem__)
    p = np.array([protos[i] for i in order]).reshape(len(order), DIMENSIONS)
    norm = np.linalg.norm(p, axis=1, keepdims=True)
    return [langs[i] for i in order], (p / np.where(norm > 0, norm, 1)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text",
            carry: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``carry`` with ``lang_pred`` and ``score`` for every row of ``docs``.

    ``score`` is the cosine with the best prototype, cut to 0..1; on equal
    cosines the smaller language name wins.  A null text, or one without a
    letter, is ``und`` with score 0.  Only ``text_col`` is read for the
    prediction; other columns are carried as they are.
    """
    ship(docs.sparkSession)
    langs, protos = model
    names = np.array([*langs, UNDETERMINED], dtype=object)
    inner = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(carry, inner)], F.col(text_col).alias("text"))
    schema = ", ".join([*(f"{n} {rows.schema[n].dataType.simpleString()}" for n in inner),
                        "lang_pred string", "score double"])

    def classify(batches):
        flag = np.zeros(CODES ** 3, dtype=bool)
        place = np.zeros(CODES ** 3, dtype=np.int64)
        for batch in batches:
            best = np.full(batch.num_rows, len(langs))
            score = np.zeros(batch.num_rows)
            for a, tri, own, n in _text_runs(batch.column("text")):
                if not len(tri) or not langs:
                    continue
                flag[tri] = True
                distinct = np.flatnonzero(flag)
                flag[distinct] = False
                place[distinct] = np.arange(len(distinct))
                counts = np.bincount(own * len(distinct) + place[tri], minlength=n * len(distinct))
                v = counts.reshape(n, -1).astype(np.float32) @ trigram_vectors(distinct)
                norm = np.linalg.norm(v, axis=1)
                cos = (v @ protos.T) / np.where(norm > 0, norm, 1)[:, None]
                has = np.bincount(own[tri > 0], minlength=n) > 0
                best[a: a + n] = np.where(has, cos.argmax(axis=1), len(langs))
                score[a: a + n] = np.where(has, cos.max(axis=1).clip(0, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in inner), pa.array(names[best], pa.string()), pa.array(score)],
                [*inner, "lang_pred", "score"])

    out = rows.mapInArrow(classify, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(inner, carry)], "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text, modulo 3, is 1 (never for a null id)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def confident(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text",
              least: float = 0.05) -> DataFrame:
    """Rows of ``docs``, all columns kept, whose text has a language with score ``least`` or more."""
    cols = docs.columns
    named = predict(docs, model, text_col, carry=tuple(cols))
    ok = (F.col("_cl_lang") != UNDETERMINED) & (F.col("_cl_score") >= least)
    return named.toDF(*cols, "_cl_lang", "_cl_score").where(ok).select(*cols)
