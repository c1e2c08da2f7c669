import random

import numpy as np
import pytest

from churnlane.llm import line_dedup, ngram_join, substring
from llm import brute


def _corpus(seed=3, n=120):
    """Prose with exact copies, a family of near copies, shared passages and repeated lines."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]

    def text(k):
        return "\n".join(" ".join(rng.choices(vocab, k=rng.randint(3, 14))) for _ in range(k))

    base, passage = text(12), " ".join(rng.choices(vocab, k=40))
    docs = {}
    for i in range(n):
        kind = i % 6
        if kind == 0:
            words = base.split(" ")
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            docs[i] = " ".join(words)
        elif kind == 1:
            docs[i] = docs.get(i - 12, text(6))
        elif kind == 2:
            docs[i] = text(2) + "\n" + passage + "\n" + text(rng.randint(1, 4))
        elif kind == 3:
            docs[i] = "\n".join(["common line of the site", "Is onhe. " * rng.randint(1, 9), text(3)])
        else:
            docs[i] = text(rng.randint(1, 9))
    return docs


@pytest.mark.parametrize("small_group", [1, 6])
def test_components_match_brute_force(frame, small_group):
    docs = _corpus()
    got = ngram_join.jaccard_components(frame(docs.items()), small_group=small_group).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(docs)
    assert len({r.component_id for r in got}) < len(docs) - 10


def test_one_per_component_keeps_all_columns(frame):
    docs = _corpus()
    want = {k for k, (_, c) in brute.components(docs).items() if k == c}
    got = ngram_join.one_per_component(frame(docs.items()))
    assert got.columns == frame([(0, "x")]).columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_components_of_odd_rows(odd, frame):
    rows = ngram_join.jaccard_components(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:  # equal texts lie under equal ids here, so each id is its own component
        assert r.component_id == r.doc_id
    assert ngram_join.jaccard_components(frame([])).count() == 0


@pytest.mark.parametrize("width", [13, 5, 30])
def test_substring_matches_brute_force(frame, width):
    docs = _corpus()
    got = substring.with_digest(substring.remove_repeats(frame(docs.items()), width=width)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.kept_words(docs, width)


def test_substring_of_odd_rows(odd, frame):
    rows = substring.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.n_removed == 0 for r in rows)  # copies under one id do not remove each other
    assert sorted({r.kept_text for r in rows if r.doc_id in (0, 1, 2, 3)}) == [""]
    assert substring.remove_repeats(frame([])).count() == 0


@pytest.mark.parametrize("small_run", [2, 64])
def test_lines_match_brute_force(frame, small_run):
    docs = _corpus()
    got = line_dedup.with_digest(line_dedup.remove_similar_lines(frame(docs.items()), small_run=small_run)).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in got} == brute.kept_lines(docs)


def test_lines_of_odd_rows(odd, frame):
    rows = line_dedup.remove_similar_lines(odd).collect()
    assert len(rows) == odd.count()
    assert {r.kept_text for r in rows if r.doc_id == 3} == {"\n\n"}  # lines without words stay
    assert {(r.n_lines, r.kept_text) for r in rows if r.doc_id == 0} == {(1, "")}
    assert line_dedup.remove_similar_lines(frame([])).count() == 0


def test_signatures_of_linked_sets_always_meet():
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(3, 60))
        a = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        drop = int(rng.integers(0, n // 4 + 1))
        b = np.concatenate([a[drop:], rng.integers(1, 1 << 63, int(rng.integers(0, 3)), dtype=np.uint64)])
        common = n - drop
        if 4 * common < 3 * (n + len(b) - common) or set(a) == set(b):
            continue
        sig, own = ngram_join.signatures([np.sort(a), np.sort(b)])
        assert set(sig[own == 0]) & set(sig[own == 1])


def test_many_chunks_match_brute_force(frame):
    docs = _corpus(seed=5, n=240)
    rows = frame(docs.items()).coalesce(1)  # several chunks meet in each slice of the posting pass
    got = line_dedup.with_digest(line_dedup.remove_similar_lines(rows, per_chunk=16)).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in got} == brute.kept_lines(docs)
    got = ngram_join.jaccard_components(rows, per_chunk=16).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(docs)
    got = substring.with_digest(substring.remove_repeats(rows, per_chunk=16)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.kept_words(docs)


@pytest.mark.parametrize("small_run", [2, 64])
def test_lines_of_one_long_document(frame, small_run):
    rng = random.Random(8)
    lines = []
    for f in range(3):  # the second line goes, and is all that puts the lines after it away
        centre = [f"c{f}x{i}" for i in range(40)]
        leaves = [" ".join(rng.sample(centre, 32)) for _ in range(120)]
        lines += [leaves[0], " ".join(centre), *leaves[1:]]
    docs = {1: "\n".join(lines), 2: "\n".join(rng.sample(lines, 50))}
    got = line_dedup.with_digest(line_dedup.remove_similar_lines(frame(docs.items()), small_run=small_run)).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in got} == brute.kept_lines(docs)


def test_runs_to_revisit_are_stored_in_blocks():
    import numpy as np
    import pyarrow as pa
    n = line_dedup.BLOCK * 3 + 5  # sets of four words under one, no two of them similar
    text = "\n".join(f"a b{i} c{i} d{i}" for i in range(n))
    c = line_dedup._Chunk(pa.table({"id": [1], "text": [text]}), np.zeros(line_dedup.COUNTERS, np.uint8))
    word = np.full(n, 1 << 20, np.uint64)
    order = np.arange(n)
    planes = (c.set_of[:n].tobytes() + np.zeros(n, np.uint64).tobytes() + line_dedup._narrow(np.ones(n, np.int64))
              + line_dedup._narrow(order) + line_dedup._narrow(np.zeros(n, np.int64))
              + line_dedup._narrow(np.full(n, 4)) + line_dedup._narrow(np.zeros(n, np.int64)))
    table = pa.table({"bucket": [0], "base": [0], "words": [line_dedup.pack48(word)], "entries": [planes]})
    met = line_dedup._meeting(64)(table).to_pylist()
    assert max(len(r["run"]) for r in met if r["kind"] == 3) <= 32 * line_dedup.BLOCK
    opened = {r["a"]: r["c"] for r in met if r["kind"] == 2}
    assert len(opened) == n - line_dedup.FIRST
    block = {r["b"]: r["run"] for r in met if r["kind"] == 3}
    got = set()
    for j in block:
        for i in range(j + 1):
            rows = pa.RecordBatch.from_pydict({"one": [block[i]], "two": [block[j]], "same": [i == j],
                                               "todo": [[s for s, k in opened.items() if k == j]]})
            for out in line_dedup._block_pairs([rows]):
                got.update(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
    sets = c.set_of[:n].view(np.int64).tolist()
    assert got == {(sets[i], sets[j]) for j in range(line_dedup.FIRST, n) for i in range(j)}


def test_one_per_component_decides_by_row(frame):
    rng = random.Random(2)
    one, two, three = (" ".join(f"{k}{rng.randrange(900)}" for _ in range(30)) for k in "xyz")
    rows = [(1, one), (2, one + " more"), (2, two), (None, three), (None, three + " more"), (None, three),
            (5, two + " end"), (6, "alone"), (6, "alone"), (7, None), (7, None), (None, None), (None, one)]
    got = [(r.doc_id, r.text) for r in ngram_join.one_per_component(frame(rows)).collect()]
    assert {r for r in got if r[0] is None and r[1]} <= {(None, three), (None, three + " more")}
    assert sum(r[0] is None and r[1] is not None for r in got) == 1
    assert sorted((r for r in got if r[0] is not None), key=str) == sorted(
        [(1, one), (2, two), (6, "alone"), (7, None), (7, None)], key=str)
    assert got.count((None, None)) == 1 and len(got) == 7


def test_long_lines_of_few_words_in_common_do_not_become_candidates():
    """Sets of 70 to 300 words under one rare word: 64 parities leave many pairs, the wider ones the similar pair only."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(3000)]
    sizes = (70, 100, 130, 200, 300)
    lines = [" ".join(["rare", *rng.sample(vocab, sizes[i % 5])]) for i in range(150)]
    lines.append(" ".join(lines[2].split()[:-3] + ["x", "y", "z"]))
    n = len(lines)
    text = "\n".join(lines)
    words = line_dedup.Words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), lower=False).hashes()
    level = np.full(line_dedup.COUNTERS, 9, np.uint8)
    level[int(words[0] % line_dedup.U64(line_dedup.COUNTERS))] = 1
    table = pa.table({"id": pa.array([1], pa.int64()), "text": [text]})
    c = line_dedup._Chunk(table, level)
    posted = line_dedup._postings(c, 1, np.zeros(1, np.int64))
    for small in (n + 1, 4):  # runs paired at once, and large ones
        sets = c.set_of.astype(np.int64)
        pairs = {(r["a"], r["b"]) for i in range(len(posted))
                 for r in line_dedup._meeting(small)(posted.slice(i, 1)).to_pylist() if r["kind"] == 0}
        assert (sets[2], sets[n - 1]) in pairs and len(pairs) < 30


def test_sketches_of_many_sets_at_once():
    rng = np.random.default_rng(5)
    n = np.array([1, 2, 16, 17, 40, 300, 64, 5])
    at = np.cumsum(n) - n
    words = rng.integers(0, 1 << 63, n.sum(), dtype=np.uint64)
    got = line_dedup._sketches(words, at[::-1], n[::-1])[::-1]

    def odd(i, bits):
        return {b for b in range(bits)
                if sum(int(w) >> 16 & bits - 1 == b for w in words[at[i]: at[i] + n[i]]) % 2}

    assert [len(x) * 8 for x in got] == [64, 64, 64, 128, 256, 2048, 256, 64]
    for i, x in enumerate(got):
        assert set(np.flatnonzero(np.unpackbits(np.frombuffer(x, np.uint8))).tolist()) == odd(i, len(x) * 8)
    pairs = [(i, j) for i in range(len(n)) for j in range(len(n))]
    want = [len(odd(i, b) ^ odd(j, b)) for i, j in pairs for b in [8 * min(len(got[i]), len(got[j]))]]
    assert line_dedup._odd_parities([got[i] for i, _ in pairs], [got[j] for _, j in pairs]).tolist() == want


def test_sets_of_lines_are_known_without_cutting_texts_again():
    import pyarrow as pa
    ids = [7, None, 3, 3, -5, 9, None]
    texts = ["a b\n\nb a\nc", None, "x y\nx y", "a b", "", " \n", "c\nd e\n"]
    table = pa.table({"id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()),
                      "key": pa.array(range(len(ids)), pa.int64())})
    c = line_dedup._Chunk(table, np.zeros(line_dedup.COUNTERS, np.uint8))
    chunk = np.array([1, 0, 1, 1, 0, 0, 1])
    posted = line_dedup._held_sets(c, chunk, np.arange(len(ids)))
    met = [r for i in range(len(posted)) for r in line_dedup._meeting(64)(posted.slice(i, 1)).to_pylist()]
    assert {(r["kind"], r["a"]) for r in met} == {(5, 0), (5, 1)}
    for k in (0, 1):
        rows = np.flatnonzero(chunk == k)[::-1]
        held = [r["run"] for r in met if r["a"] == k]
        got = line_dedup._Lines(table.take(rows), held)
        want = line_dedup._Chunk(table.take(rows), np.zeros(line_dedup.COUNTERS, np.uint8))
        for name in ("ids", "lines", "set_of", "doc", "number"):
            assert getattr(got, name).tolist() == getattr(want, name).tolist()
        assert got.set_of[got.first].tolist() == sorted(set(want.set_of.tolist()) - {0})
        with pytest.raises(RuntimeError):  # a text that was not there in the first pass
            line_dedup._Lines(table.take(rows).set_column(2, "key", pa.array(rows + 100)), held)


def test_earliest_candidates_of_every_entry_of_a_run():
    rng = np.random.default_rng(3)
    lengths = [70, 200, line_dedup.BLOCK, line_dedup.BLOCK + 1, 3 * line_dedup.BLOCK + 7]
    n = sum(lengths)
    word = np.repeat(np.arange(1, len(lengths) + 1, dtype=np.uint64) << np.uint64(50), lengths)
    sets = rng.permutation(n).astype(np.int64)
    ids = rng.integers(-(1 << 62), 1 << 62, n) // rng.choice([1, 1 << 60], n)  # some are equal
    size = rng.integers(2, 200, n)
    place = rng.integers(0, size // 4 + 1)
    planes = [rng.integers(0, 1 << 63, n, dtype=np.uint64) & np.uint64(0x1111) for _ in range(4)]
    line = rng.integers(0, 3, n)
    r = line_dedup._Runs(word, sets, planes[0], ids, line, size, place, np.zeros(n, np.int64), *planes[1:])
    assert r.sets.tolist() == sets[np.lexsort((sets, line, ids, word))].tolist()
    got = []
    starts = np.cumsum([0, *lengths])
    for i, j in r.in_runs(starts[:3]):
        got += zip(i.tolist(), j.tolist())
    for s, end in zip(starts[3:-1].tolist(), starts[4:].tolist()):
        for k in range(s, end, line_dedup.BLOCK):
            i, j = r.first_of(s, k, min(k + line_dedup.BLOCK, end))
            got += zip(i.tolist(), j.tolist())
    want, full = [], 0
    for s, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
        for j in range(s + 1, end):
            i = np.arange(s, j)
            a, b = r.size[i], r.size[j]
            ok = ((4 * np.minimum(a, b) >= 3 * np.maximum(a, b))
                  & (7 * np.minimum(a - r.place[i], b - r.place[j]) >= 3 * (a + b)))
            i = i[ok]
            i = i[line_dedup._close(r.size, r.parity, i, np.full(len(i), j))][: line_dedup.FIRST]
            full += len(i) == line_dedup.FIRST
            want += [(int(x), j) for x in i]
    assert sorted(got) == sorted(want) and 0 < full < n


def _shared_line(n=150):
    """Texts of one line that all hold and words of their own, with a few near copies."""
    rng = random.Random(21)
    vocab = [f"v{i}" for i in range(3000)]
    line = " ".join(rng.choices(vocab, k=13))
    docs = {i: line + "\n" + " ".join(rng.choices(vocab, k=rng.randint(18, 24))) for i in range(n)}
    return docs | {n + i: docs[i] + " more" for i in range(0, n, 10)}


def test_texts_of_one_common_line_make_no_blocks(frame, monkeypatch):
    docs = _shared_line()
    monkeypatch.delattr(ngram_join, "_links_across")  # all pairs of the sets that a common passage brings together
    got = ngram_join.jaccard_components(frame(docs.items())).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(docs)
    assert len({r.component_id for r in got}) == 150


@pytest.mark.parametrize("small_group, rare_group", [(1, 1), (1, 3), (2, 64)])
def test_large_groups_lose_no_link(frame, small_group, rare_group):
    docs = _corpus(seed=9) | {1000 + i: t for i, t in _shared_line(40).items()}
    got = ngram_join.jaccard_components(frame(docs.items()), small_group=small_group, rare_group=rare_group,
                                        per_chunk=32).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(docs)


def test_parities_never_differ_more_than_the_sets():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = (rng.integers(1, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64) for _ in range(2))
        b = np.concatenate([a[: int(rng.integers(0, len(a) + 1))], b[: int(rng.integers(0, len(b)))]])
        if len(b):
            assert ngram_join._differ(ngram_join._parity(a), ngram_join._parity(b)) <= len(np.setxor1d(a, b))
    assert ngram_join._differ(ngram_join._parity(a), ngram_join._parity(a)) == 0
