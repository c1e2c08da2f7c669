import random

import pytest
from pyspark.sql import functions as F

from churnlane.llm import chat, decontam, langid, quality, tokens
from churnlane.llm.queries import tokenizer_path
from llm import brute
from llm.conftest import ODD


def test_token_counts_equal_the_library(odd, frame):
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(5)
    bits = ["a", "the ", " ", "\n", "\t", "\x1c", "\x85", "é", "ß", "日本", "𝔘", "'s", "12", "½", "<|endoftext|>", "<|end",
            "!!", "…", "🙂", "\r\n", "'ll"]
    texts = [*ODD, *("".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(400)), "a" * 20000]
    got = {r.doc_id: r for r in tokens.count_tokens(frame(enumerate(texts)), path).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512), repr(t)
    assert tokens.count_tokens(odd, path).count() == odd.count()
    assert tokens.count_tokens(frame([]), path).count() == 0


def test_other_tokenizers_are_refused(frame):
    with pytest.raises(ValueError):
        tokens.count_tokens(frame([]), tokenizer_path("word_bpe_49k.json"))


@pytest.mark.parametrize("most", [200_000, 2])
def test_contamination_matches_brute_force(spark, frame, odd, most):
    rng = random.Random(2)
    vocab = [f"W{i}é" if i % 9 == 0 else f"Word{i}" for i in range(60)]
    items = {i: " ".join(rng.choices(vocab, k=rng.randint(1, 25))) for i in range(12)} | {98: None, 99: ", ."}
    docs = {}
    for i in range(60):
        parts = [" ".join(rng.choices(vocab, k=rng.randint(0, 40)))]
        if i % 3 == 0:
            parts += [items[i % 12].upper() if i % 2 else items[i % 12].replace(" ", " -- ")]
        docs[i] = ", ".join(parts)
    docs |= {100 + i: t for i, t in enumerate(ODD)}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), brute.sha(",".join(r["items"])), r.bad)
           for r in decontam.hits(frame(docs.items()), bench, max_windows=most)
           .withColumn("bad", decontam.contaminated()).collect()}
    assert got == brute.contamination(docs, items)
    kept = decontam.drop_contaminated(frame(docs.items()), bench)
    assert kept.count() == sum(not v[4] for v in got.values()) and "chunk" in kept.columns
    none = bench.where("false")
    assert decontam.hits(odd, none).where("n_hit > 0").count() == 0
    assert decontam.hits(odd, none).count() == odd.count()
    assert decontam.hits(frame([]), bench).count() == 0
    clean = {r.doc_id: r.clean_text for r in decontam.without_spans(frame(docs.items()), bench).collect()}
    assert all((len(clean[k].split(" ")) if clean[k] else 0) == n - h for k, (n, h, *_) in got.items())


def test_quality_matches_brute_force(frame, odd):
    rng = random.Random(8)
    docs = dict(enumerate(ODD))
    for i in range(100, 160):
        vocab = [f"v{j}" for j in range(rng.choice([3, 30, 300]))] + ["the", "|", "a,"]
        docs[i] = "\n".join(" ".join(rng.choices(vocab, k=rng.randint(0, 30))) for _ in range(rng.randint(1, 9)))
    got = {r.doc_id: tuple(r)[1:] for r in quality.judge(frame(docs.items())).collect()}
    assert {k: v[:6] for k, v in got.items()} == {k: brute.quality_base(t) for k, t in docs.items()}
    assert not any(v[5] and v[6] for v in got.values())
    assert quality.judge(odd).count() == odd.count() and quality.judge(frame([])).count() == 0


def test_quality_order_does_not_change_the_verdict(frame):
    docs = [(i, t) for i, t in enumerate(["the cat sat on a mat " * 3 + " ".join(f"x{j}" for j in range(60)),
                                          "| ".join(f"x{j}" for j in range(80)), "1 2 3 4 " + "5 6 " * 40])]
    for rules in (quality.RULES, quality.RULES[::-1]):
        assert [r.kept for r in quality.judge(frame(docs), rules=rules).orderBy("doc_id").collect()] == \
            [True, False, False]


def test_chat_collapse_and_render(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"),
            (3, 1, "assistant", "yo"), (4, 0, "user", "hi"), (4, 1, "assistant", "other"), (5, 0, None, None),
            (6, 0, None, ""), (7, 2, "b", "t"), (7, 2, "a", "t"), (7, None, "z", "late"), (None, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("k", F.lit(0))
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.format_chats(df).collect()}
    assert got == {2: (2, 2, "<|user|>\nhi\n<|assistant|>\nyo"), 4: (2, 1, "<|user|>\nhi\n<|assistant|>\nother"),
                   5: (1, 1, "<|unknown|>\n"), 6: (1, 1, "<|unknown|>\n"),
                   7: (3, 1, "<|a|>\nt\n<|b|>\nt\n<|z|>\nlate")}
    assert chat.format_chats(df.where("false")).count() == 0


def test_language_held_out_accuracy(spark, odd, frame):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(docs.where(~langid.held_out()))
    out = langid.predict(docs.where(langid.held_out()), model, carry=("lang",))
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98
    got = langid.predict(odd, model, carry=("doc_id", "text", "n_words")).collect()
    assert len(got) == odd.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1
    assert langid.learn(frame([]))[0] == []
    assert {r.lang_pred for r in langid.predict(odd, langid.learn(frame([]))).collect()} == {"und"}
    assert langid.confident(odd, model).columns == odd.columns
