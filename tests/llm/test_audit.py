"""Piece encoding, source divergence and periodic runs against the library or brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.llm import divergence, pieces, runs
from churnlane.llm.queries import QUERIES, planted_repeats, tokenizer_path
from llm import brute
from llm.conftest import ODD

BITS = ["a", "the ", " ", "   ", "\n", "\t", "\0", "é", "ß", "日本", "𝔘", "<s>", "<0x0A>", "</s>", "▁", "▁▁", "1", "23", "½",
        "!!", "🙂", "\r\n", "ing", "foo", "<unk>", "�", "x" * 40, " " * 27]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def _packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_pieces_equal_the_library(spark, frame, odd, library):
    path, rng = tokenizer_path("piece_bpe_32k.model"), random.Random(3)
    texts = [*ODD, *("".join(rng.choices(BITS, k=rng.randint(0, 30))) for _ in range(600)), "a" * 20000, " ", "▁"]
    for begin, end in ((True, True), (False, False)):
        rows = pieces.round_trip(frame(enumerate(texts)), path, begin=begin, end=end, check=True).collect()
        got = {r.doc_id: r for r in rows}
        for i, t in enumerate(texts):
            ids = library.encode(t or "", add_bos=begin, add_eos=end)
            r = got[i]
            assert (r.n_tokens, bytes(r["ids"]), r.decoded) == (len(ids), _packed(ids), library.decode(ids)), repr(t)
            assert r.library_agrees
    assert pieces.round_trip(odd, path).count() == odd.count()
    assert pieces.round_trip(frame([]), path).count() == 0
    small = pieces.round_trip(frame([(1, "ab"), (1, "ab"), (None, "ab")]), path).collect()
    assert len({bytes(r["ids"]) for r in small}) == 1 and sorted(str(r.doc_id) for r in small) == ["1", "1", "None"]


@pytest.mark.parametrize("short", [0, 1000])
def test_both_agendas_merge_alike(monkeypatch, library, short):
    monkeypatch.setattr(pieces, "SHORT", short)
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        model = pieces.PieceModel(f.read())
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choices(["a", "e", "n", "t", "th", "ing", " ", "  ", "z", "é", "日", "\n"], k=rng.randint(0, 60)))
        assert model.encode(text) == _packed(library.encode(text))


def test_any_ids_decode_as_in_the_library(spark, library):
    rng = random.Random(4)
    cases = [[rng.choice([0, 1, 2, 259, rng.randrange(3, 259), rng.randrange(259, 32000)])
              for _ in range(rng.randint(0, 9))] for _ in range(3000)]
    rows = spark.createDataFrame([(i, _packed(c)) for i, c in enumerate(cases)] + [(-1, None)],
                                 "ids long, packed binary")
    got = {r["ids"]: r.text for r in pieces.decode(rows, tokenizer_path("piece_bpe_32k.model"), "packed").collect()}
    assert got.pop(-1) is None
    assert got == {i: library.decode(c) for i, c in enumerate(cases)}


def test_other_models_are_refused(spark, tmp_path, frame):
    raw = open(tokenizer_path("piece_bpe_32k.model"), "rb").read()
    (tmp_path / "m.model").write_bytes(raw + bytes([0x12, 0x02, 0x18, 0x01]))  # the trainer's type: unigram
    with pytest.raises(ValueError):
        pieces.round_trip(frame([]), str(tmp_path / "m.model"))


def test_gallop_is_a_lower_bound():
    rng = np.random.default_rng(0)
    for _ in range(400):
        a = np.unique(rng.integers(0, rng.integers(1, 400), size=rng.integers(0, 60)))
        b = np.unique(rng.integers(0, rng.integers(1, 400), size=rng.integers(0, 300)))
        assert (divergence.gallop(a, b) == np.searchsorted(b, a)).all()


@pytest.mark.parametrize("bits", [16, 3])
def test_divergence_matches_brute_force(frame, monkeypatch, bits):
    monkeypatch.setattr(divergence, "BLOCK_BITS", bits)
    monkeypatch.setattr(divergence, "HELD", 50)
    rng = random.Random(11)
    vocab = [f"{a}{b}" for a in "abcdeÉß日" for b in ("x", "Y", "ž", "")]
    rows = []
    for i in range(260):
        lang, source = rng.choice(["en", "de", None, "", "rare"]), rng.choice([None, "", "s1", "s2", "é", "z"])
        if lang == "rare" and rng.random() < 0.9:
            lang = "en"
        k = rng.choice([0, 1, 8, 30])
        rows.append((i, rng.choice([None, " ", "1 2 3"]) if k == 0 else " 7,".join(rng.choices(vocab, k=k)), lang, source))
    rows += [(1000 + i, t, "odd", "s") for i, t in enumerate(ODD)] + [(1, "same text", "twice", "s")] * 12
    rows += [(None, "other same", "twice", "t")]
    got = divergence.audit(frame(rows)).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == brute.divergences([(r[2], r[3], r[1]) for r in rows])


def test_divergence_of_nothing(frame):
    assert divergence.audit(frame([])).collect() == []
    got = divergence.audit(frame([(1, None, "x", "a"), (2, "", "x", "b")])).collect()
    assert {tuple(r) for r in got} == {("x", "a", "pair", "b", 0, 1), ("x", "b", "pair", "a", 0, 1)}


def test_shares_are_exact_for_large_counts(spark):
    counts = [0, 1, 10**6, 10**12, 7 * 10**14]
    want = [1 + 10**9 * (c + 2) // (10**15 + 2 * 12345) for c in counts]
    assert divergence._shares(np.array(counts), 10**15, 12345).tolist() == want
    df = spark.createDataFrame([(c, 10**15, 12345) for c in counts], "n long, total long, terms long")
    assert [r.p for r in df.select(divergence.share("n", "total", "terms").alias("p")).collect()] == want


def _periodic_texts(rng, k):
    out = []
    for _ in range(k):
        words = [rng.choice("abcdefghijklmnopqrst"[:rng.choice([1, 2, 3, 20])]) for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.6:
            unit, at = [rng.choice("abc") for _ in range(rng.randint(1, 12))], rng.randint(0, len(words))
            words[at:at] = unit * rng.randint(2, 15) + unit[:rng.randint(0, len(unit))]
        if rng.random() < 0.3 and out:
            words = words + out[-1] + out[-1]
        out.append(words)
    return out


@pytest.mark.parametrize("pairs", [50, 1000, 1_000_000])
def test_runs_match_brute_force(monkeypatch, pairs):
    monkeypatch.setattr(runs, "PAIRS", pairs)
    rng = random.Random(pairs)
    for _ in range(25):
        texts, least = _periodic_texts(rng, rng.randint(1, 30)), rng.choice([2, 12])
        for words, found in zip(texts, runs.runs_of(texts, least)):
            assert [tuple(r) for r in found.tolist()] == brute.word_runs(words, least)


def test_extensions_are_common_prefixes():
    rng = np.random.default_rng(1)
    for n, letters in ((1, 1), (40, 1), (500, 2), (700, 1), (900, 3)):
        words = rng.integers(1, letters + 1, size=n)
        if n == 900:
            words = np.tile(words[:150], 6)
        text = np.concatenate([words, [9]])
        index = runs.Extensions(text)
        i, j = rng.integers(0, n + 1, size=(2, 300))
        i, j = i[i != j], j[i != j]

        def plain(a, b):
            k = 0
            while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
                k += 1
            return k

        if len(i):
            assert index.common(i, j).tolist() == [plain(a, b) for a, b in zip(i, j)]


def test_runs_query_rows(frame, monkeypatch):
    monkeypatch.setattr(runs, "SLICE_WORDS", 300)
    rng = random.Random(9)
    docs = dict(enumerate(" \t".join(w) for w in _periodic_texts(rng, 150)))
    docs |= {500 + i: t[:4000] if t else t for i, t in enumerate(ODD)} | {600: "é ß " * 40 + "q " + "y z w " * 5, 601: "a b " * 6}
    got = {r.doc_id: tuple(r)[1:] for r in
           runs.with_digest(runs.periodic_runs(frame(docs.items()), edit=planted_repeats)).collect()}
    want = {}
    for k, t in docs.items():
        want[k] = brute.runs_row([w.decode() for w in planted_repeats(k, [w.encode() for w in brute.WORD.findall(t or "")])])
    assert got == want


def test_runs_of_odd_rows(frame, odd):
    assert runs.periodic_runs(odd).count() == odd.count()
    assert runs.with_digest(runs.periodic_runs(frame([]))).count() == 0
    rows = runs.with_digest(runs.periodic_runs(frame([(None, "a " * 20), (None, "a " * 20), (None, None)]))).collect()
    assert sorted(r.n_runs for r in rows) == [0, 1, 1]
    long = [f"w{i}" for i in range(30_000)]
    found = runs.periodic_runs(frame([(1, " ".join(long + long))])).first()
    assert [tuple(r) for r in found.runs] == [(0, 60_000, 30_000)] and len(found.kept_text.split()) == 30_000


def test_planted_repeats_are_periodic():
    import zlib
    keys = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0]
    words = [f"w{i}".encode() for i in range(90)]
    assert keys
    for k in keys:
        g = zlib.crc32(str(k).encode()) // 10
        a = g % 90
        p = 1 + (90 - a) // (3 + g % 8)
        out = planted_repeats(k, words)
        assert out[:a] == words[:a] and all(out[i] == out[i + p] for i in range(a, 90 - p))
    assert planted_repeats(1 if 1 not in keys else 2, words) == words and planted_repeats(keys[0], []) == []


def test_queries_read_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    out = QUERIES["op11_sentencepiece"](spark, sf)
    assert out.count() == n and out.where(~F.col("library_agrees")).count() == 0
    found = QUERIES["op13_periodic_runs"](spark, sf)
    assert found.count() == n and isinstance(found.schema["exponent_milli"].dataType, T.LongType)
