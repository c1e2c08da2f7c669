"""Near-duplicate lines removed over the whole corpus by an exact set-similarity join.

A line is the set of its distinct words.  Words are ordered by rarity, and two
sets that reach the similarity share a word among the first
``n - ceil(3 n / 4) + 1`` of each (prefix filter).  Sets meet under these
words; pairs pass when their sizes (length filter), the places of the shared
word (positional filter) and the parities of their words (bitmaps of 64 bits,
128 or 256 for large sets) leave the similarity possible, then wider bitmaps in
proportion to the sets, and are then verified on the whole sets.  A
line goes when an earlier line is similar enough.

Rarity comes from a table of counters by word hash: any order that all lines
agree on is correct, a better one only makes fewer candidates, so the table
has a fixed size at any corpus size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.chunks import bucket_bits, chunked, dealt, release
from churnlane.llm.kernels import U64, Words, binary, mix64, pack48, slices, starts_of, to_long, unpack48
from churnlane.llm.ship import ship
from churnlane.session import scratch_path

#: Similarity bound: den * intersection >= num * union.
NUM, DEN = 3, 4
#: Counters of word frequencies (by hash); one byte each when broadcast.
COUNTERS = 1 << 19
#: Bytes of text cut into words at a time: the work arrays stay in the CPU's cache.
SLICE = 1 << 17
#: Sets under one word up to this number are paired whole at once.
SMALL_RUN = 64
#: In larger runs, each set is first paired with so many earlier candidates.
FIRST = 8
#: Entries of a stored run per row.
BLOCK = 512
#: Pairs compared by their parities at a time.
PAIRS = 1 << 19
#: Sets of so many words meet under 128 and under 256 parity bits; 64 would tell too few of them apart.
HALVED, QUARTERED = 64, 128
#: Parity bits of a set's sketch per word.
SKETCH = 4
_SLICES = 16
_NO_ID = np.iinfo(np.int64).max
_LINE_BREAK = 10


def _line_edges(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines of a slice of texts start, and its end; lines of each text.  A break ends its line."""
    breaks = np.flatnonzero(buf == _LINE_BREAK)
    # a line ends before its break; each text has one line more than breaks
    owner = np.searchsorted(off, breaks, side="right") - 1
    lines = np.bincount(owner, minlength=len(off) - 1) + 1
    cuts = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
    return np.concatenate([cuts, [len(buf)]]), lines


def _line_words(texts: pa.Array):
    """Per slice: words of every line, as (Words over lines, lines per text)."""
    for _, _, buf, off in slices(texts, SLICE):
        edges, lines = _line_edges(buf, off)
        yield Words(buf, edges, lower=False), lines


def _counter(h: np.ndarray) -> np.ndarray:
    return (h & U64(COUNTERS - 1)).astype(np.int64)


def word_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """Level (rounded log2 of the count) of each counter; the counters are added up in Spark."""
    ship(docs.sparkSession)

    def count(batches):
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                at = [_counter(Words(buf, off, lower=False).hashes())
                      for _, _, buf, off in slices(batch.column("text").slice(i, 1024), SLICE)]
                total += np.bincount(np.concatenate(at), minlength=COUNTERS)
        size = COUNTERS // _SLICES
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_SLICES), pa.int32()),
             binary([total[i * size: (i + 1) * size].tobytes() for i in range(_SLICES)])], ["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS // _SLICES, dtype=np.int64)
        for x in table.column("sums").to_pylist():
            total += np.frombuffer(x, np.int64)
        return pa.table({"part": table.column("part").slice(0, 1), "sums": binary([total.tobytes()])})

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "part int, sums binary")
            .groupBy("part").applyInArrow(add, "part int, sums binary").collect())  # _SLICES rows
    total = np.zeros(COUNTERS, dtype=np.int64)
    for r in rows:
        size = COUNTERS // _SLICES
        total[r["part"] * size: (r["part"] + 1) * size] = np.frombuffer(r["sums"], np.int64)
    return np.round(2 * np.log2(total + 1)).astype(np.uint8)


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return np.array([_NO_ID if x is None else x for x in column.to_pylist()], np.int64)


class _Chunk:
    """Lines of a chunk's texts as rarity-ordered word sets.

    ``set_of`` has for each line its set's id, or 0 for a line without words.
    """

    def __init__(self, table: pa.Table, level: np.ndarray):
        self.ids = _ids(table.column("id"))
        keys, sizes, lines = [], [], []
        for w, n in _line_words(table.column("text")):
            h = w.hashes()
            # rarest first; the hash orders words of one level
            k = (level[_counter(h)].astype(np.uint64) << U64(56)) | (h >> U64(8))
            for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
                if b - a > 1:
                    k[a:b].sort()
            line = np.repeat(np.arange(w.n_docs), w.counts)
            keep = np.ones(len(k), dtype=bool)
            keep[1:] = (k[1:] != k[:-1]) | (line[1:] != line[:-1])
            keys.append(k[keep])
            sizes.append(np.bincount(line[keep], minlength=w.n_docs))
            lines.append(n)
        none = np.zeros(0, np.int64)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else none
        self.lines = np.concatenate(lines) if lines else none  # per text
        self.at = starts_of(self.sizes)
        self.doc = np.repeat(np.arange(len(self.lines)), self.lines)
        self.number = np.arange(len(self.doc)) - starts_of(self.lines)[self.doc]  # of the line in its text
        total = np.zeros(len(self.keys) + 1, dtype=np.uint64)
        np.cumsum(mix64(self.keys + U64(5)), out=total[1:])
        fold = mix64(total[self.at[1:]] - total[self.at[:-1]] + self.sizes.astype(np.uint64))
        self.set_of = np.where(self.sizes > 0, fold | U64(1), U64(0))


def _held_sets(c: _Chunk, chunk: np.ndarray, key: np.ndarray) -> pa.Table:
    """The sets of the lines of each text, one row per chunk: bucket -1 - chunk, for ``_Lines`` of that chunk.

    ``key`` is a hash of each text.
    """
    order = np.argsort(chunk, kind="stable")
    at = starts_of(c.lines)
    cut = np.flatnonzero(_leads(chunk[order])) if len(order) else np.zeros(0, np.int64)
    held = []
    for a, b in zip(cut, [*cut[1:], len(order)]):
        x = order[a:b]
        held.append(len(x).to_bytes(8, "little") + c.ids[x].tobytes() + key[x].tobytes() + c.lines[x].tobytes()
                    + b"".join([c.set_of[at[d]: at[d + 1]].tobytes() for d in x]))
    return pa.table({"bucket": pa.array(-1 - chunk[order[cut]], pa.int32()),
                     "base": pa.array(np.zeros(len(cut), np.int64)),
                     "words": binary([b""] * len(cut)), "entries": binary(held)})


class _Lines:
    """Lines of a chunk's texts, their sets as ``_held_sets`` noted them, and the sets' first places.

    The texts are not cut into words again.
    """

    def __init__(self, table: pa.Table, held: list[bytes]):
        self.ids = _ids(table.column("id"))
        known = {}
        for raw in held:
            n = int.from_bytes(raw[:8], "little")
            ids, key, lines = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(3, n)
            sets = np.frombuffer(raw, np.uint64, offset=8 + 24 * n)
            at = starts_of(lines).tolist()
            known.update(zip(zip(ids.tolist(), key.tolist()), [sets[a:b] for a, b in zip(at, at[1:])]))
        try:
            sets = [known[x] for x in zip(self.ids.tolist(), table.column("key").to_pylist())]
        except KeyError:
            raise RuntimeError("a text without its sets: the documents changed between two reads") from None
        self.lines = np.array([len(x) for x in sets], np.int64)  # per text
        self.set_of = np.concatenate(sets)
        self.doc = np.repeat(np.arange(len(sets)), self.lines)
        self.number = np.arange(len(self.doc)) - starts_of(self.lines)[self.doc]  # of the line in its text
        # the first line of each set, by id and line number
        has = np.flatnonzero(self.set_of)
        order = has[np.lexsort((self.number[has], self.ids[self.doc[has]], self.set_of[has]))]
        self.first = order[_leads(self.set_of[order])]  # one line per set, by set id
        self.names = self.set_of[self.first]


def _narrow(x: np.ndarray) -> bytes:
    """Non-negative numbers in 1, 2, 4 or 8 bytes each, whichever the largest needs, behind that width."""
    most = int(x.max()) if len(x) else 0
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _wide(raw: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    width = raw[at]
    end = at + 1 + n * width
    return np.frombuffer(raw[at + 1: end], f"<u{width}").astype(np.int64), end


def _more(size: np.ndarray, *planes: np.ndarray) -> bytes:
    """The half and the two quarters of the sets that are large enough to have them, see ``_Parity``."""
    return b"".join(p[size >= least].tobytes() for p, least in zip(planes, (HALVED, QUARTERED, QUARTERED)))


def _read_more(raw: bytes, at: int, size: np.ndarray) -> list[np.ndarray]:
    """What ``_more`` wrote, 0 for the smaller sets."""
    out = []
    for least in (HALVED, QUARTERED, QUARTERED):
        x = np.flatnonzero(size >= least)
        plane = np.zeros(len(size), dtype=np.uint64)
        plane[x] = np.frombuffer(raw, np.uint64, len(x), at) if len(x) else 0
        at += 8 * len(x)
        out.append(plane)
    return out


def _leads(*keys: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before in one of the ``keys``."""
    lead = np.zeros(len(keys[0]), dtype=bool)
    lead[:1] = True
    for k in keys:
        lead[1:] |= k[1:] != k[:-1]
    return lead


def _nth(x: np.ndarray) -> np.ndarray:
    """The number of each row among those equal to it, which stand together."""
    at = np.arange(len(x))
    return at - np.maximum.accumulate(np.where(_leads(x), at, 0))


def _postings(c: _Chunk, bits: int, chunk: np.ndarray) -> pa.Table:
    """The prefix words of the sets, by bucket: word, set, parities, first id and line, its chunk, size, place.

    ``chunk`` has the chunk of each text; for the other chunks that a set
    stands in, its first word is given once each, with the first place there.
    Ids travel above the least of them.
    """
    has = np.flatnonzero(c.sizes > 0)
    has = has[np.lexsort((c.number[has], c.ids[c.doc[has]], chunk[c.doc[has]], c.set_of[has]))]
    has = has[_leads(c.set_of[has], chunk[c.doc[has]])]  # one line per set and chunk
    has = has[np.lexsort((chunk[c.doc[has]], c.number[has], c.ids[c.doc[has]], c.set_of[has]))]
    lead = _leads(c.set_of[has])
    first, other = has[lead], has[~lead]
    n = c.sizes[first]
    prefix = n - (NUM * n + DEN - 1) // DEN + 1
    place = np.arange(prefix.sum()) - np.repeat(starts_of(prefix)[:-1], prefix)
    line = np.concatenate([np.repeat(first, prefix), other])
    place = np.concatenate([place, np.zeros(len(other), np.int64)])
    mixed = mix64(c.keys)
    word = mixed[c.at[line] + place]
    # four times 64 parities, by the next two bits of the word's hash
    at = mixed >> U64(56)
    bit, at = U64(1) << (at >> U64(2)), at & U64(3)
    full = np.flatnonzero(c.sizes)

    def odd(bits: np.ndarray) -> np.ndarray:
        out = np.zeros(len(c.sizes), dtype=np.uint64)
        out[full] = np.bitwise_xor.reduceat(bits, c.at[full]) if len(full) else 0
        return out

    parity, half, quarter = odd(bit), odd(bit * (at & U64(1))), [odd(bit * (at == U64(q))) for q in (0, 1)]
    order = np.argsort(word, kind="stable")
    word, line, place = word[order], line[order], place[order]
    bucket = (word >> U64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(word) else np.zeros(0, np.int64)
    end = np.concatenate([cut[1:], [len(word)]]).astype(np.int64)
    ids = c.ids[c.doc]
    base = int(ids.min()) if len(ids) else 0
    above = np.where(ids == _NO_ID, 0, ids.astype(np.uint64) - U64(base % (1 << 64)) + U64(1))  # 0: no id

    n, sets = c.sizes[line], c.set_of[line].tobytes()
    narrow = [_narrow(x) for x in (above[line], c.number[line], chunk[c.doc[line]], n, place)]
    parity = parity[line].tobytes()
    more = [(starts_of(n >= least), p[line[n >= least]].tobytes())
            for p, least in zip((half, *quarter), (HALVED, QUARTERED, QUARTERED))]
    high, low = (word >> U64(32)).astype(np.uint32).tobytes(), (word >> U64(16)).astype(np.uint16).tobytes()

    def planes(a: int, b: int) -> bytes:
        return b"".join([sets[8 * a: 8 * b], parity[8 * a: 8 * b],
                         *[x[:1] + x[1 + x[0] * a: 1 + x[0] * b] for x in narrow],
                         *[p[8 * before[a]: 8 * before[b]] for before, p in more]])

    cut, end = cut.tolist(), end.tolist()
    return pa.table({"bucket": pa.array(bucket[cut], pa.int32()),
                     "base": pa.array(np.full(len(cut), base), pa.int64()),
                     "words": binary([high[4 * a: 4 * b] + low[2 * a: 2 * b] for a, b in zip(cut, end)]),
                     "entries": binary([planes(a, b) for a, b in zip(cut, end)])})


def _repeated(x: np.ndarray) -> np.ndarray:
    """Where the values stand that stand more than once."""
    order = np.argsort(x)
    same = x[order][1:] == x[order][:-1]
    out = np.zeros(len(x), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return np.flatnonzero(out)


def _ranks(x: np.ndarray) -> np.ndarray:
    """Dense ranks of the values, from 0."""
    order = np.argsort(x)
    out = np.empty(len(x), dtype=np.int64)
    out[order] = np.cumsum(_leads(x[order])) - 1
    return out


def _sorted_by(*keys: np.ndarray) -> np.ndarray:
    """The order by the ``keys``, the first one first: one sort by the first three, packed, then of what they leave equal."""
    n = len(keys[0])
    bits = n.bit_length()
    if 3 * bits > 64 or not n:
        return np.lexsort(keys[::-1])
    packed = np.zeros(n, dtype=np.uint64)
    for x in keys[:3]:
        least = x.min()
        x = x - least if int(x.max()) - int(least) < 1 << bits else _ranks(x)
        packed = (packed << U64(bits)) | x.astype(np.uint64)
    order = np.argsort(packed)
    tied = ~_leads(packed[order])
    tied[:-1] |= tied[1:]
    x = order[tied]
    order[tied] = x[np.lexsort((*[k[x] for k in keys[:2:-1]], packed[x]))]
    return order


class _Runs:
    """Postings sorted by word and, as ``_later`` decides, first id, line and set; one entry per word and set."""

    def __init__(self, *columns):
        # a word that stands once can neither pair sets nor tell of copies
        again = _repeated(columns[0])
        columns = [x[again] for x in columns]
        word, sets, parity, ids, line, size, place, chunk, half, first, second = columns
        # rows of one word and set share this sum, others only by chance
        x = _repeated(mix64(word) + sets.view(np.uint64))
        order = x[np.lexsort((chunk[x], line[x], ids[x], sets[x], word[x]))]
        keep = _leads(word[order], sets[order])
        # all places of a set meet under its first word: where it stands again, in a later document
        lead = np.maximum.accumulate(np.where(keep, np.arange(len(order)), 0))
        again = ~keep & (place[order] == 0) & (ids[order] > ids[order][lead]) & (chunk[order] != chunk[order][lead])
        self.copies = np.unique(np.stack([sets[order][again], chunk[order][again]], axis=1), axis=0)
        stays = np.ones(len(word), dtype=bool)
        stays[order[~keep]] = False
        stays = np.flatnonzero(stays)
        order = stays[_sorted_by(word[stays], ids[stays], line[stays], sets[stays])]
        w = word[order]
        again = np.zeros(len(w), dtype=bool)
        again[1:] = w[1:] == w[:-1]
        shared = again.copy()
        shared[:-1] |= again[1:]
        order = order[shared]
        self.word, self.sets, self.ids = word[order], sets[order], ids[order]
        self.parity = _Parity(parity[order], half[order], first[order], second[order])
        self.line = line[order]
        self.size, self.place = size[order].astype(np.int32), place[order].astype(np.int32)
        self.chunk = chunk[order]  # where the set first stands
        lead = np.ones(len(self.word), dtype=bool)
        lead[1:] = self.word[1:] != self.word[:-1]
        self.at = np.maximum.accumulate(np.where(lead, np.arange(len(lead)), 0))
        self.length = np.bincount(self.at, minlength=len(lead))[self.at]

        self.reach, self.needs = _reach(self.size, self.place)

    def passing(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of entries pass."""
        return _passing(self.reach, self.needs, self.size, self.parity, i, j)

    def in_runs(self, starts: np.ndarray):
        """As ``first_of``, of all entries of the runs from ``starts``, of ``BLOCK`` entries at most, in several parts."""
        earlier = np.tri(BLOCK, k=-1, dtype=bool)
        one, two, held = [], [], 0
        for k, s in enumerate(starts.tolist()):
            n = int(self.length[s])
            reach, needs = self.reach[s: s + n], self.needs[s: s + n]
            at = np.flatnonzero((reach >= needs[:, None]) & (reach[:, None] >= needs) & earlier[:n, :n])
            j = at // n
            one.append(at - j * n + s)
            two.append(j + s)
            held += len(at)
            if held > PAIRS or k == len(starts) - 1:
                i, j = np.concatenate(one), np.concatenate(two)
                x = np.flatnonzero(_close(self.size, self.parity, i, j))
                i, j = i[x], j[x]
                x = _nth(j) < FIRST
                yield i[x], j[x]
                one, two, held = [], [], 0

    def first_of(self, start: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j) that pass of the entries j in a .. b of the run from ``start``, with its earliest i < j each.

        At most ``FIRST`` for an entry.  Entries are compared in rectangles, which widen.
        """
        one, two, found = [], [], np.zeros(b - a, dtype=np.int64)
        left, width = start, SMALL_RUN
        while left < b:
            j = a + np.flatnonzero(found < FIRST)
            j = j[j > left]
            if not len(j):
                break
            right = min(left + width, b)
            y, x = np.nonzero((self.reach[None, left:right] >= self.needs[j, None])
                              & (self.reach[j, None] >= self.needs[None, left:right]))
            i, j = x + left, j[y]
            x = np.flatnonzero(i < j)
            x = x[_close(self.size, self.parity, i[x], j[x])]
            i, j = i[x], j[x]  # by j, then i
            x = found[j - a] + _nth(j) < FIRST
            i, j = i[x], j[x]
            found += np.bincount(j - a, minlength=b - a)
            one.append(i)
            two.append(j)
            left, width = right, min(2 * width, BLOCK)
        none = [np.zeros(0, np.int64)]
        return np.concatenate(one + none), np.concatenate(two + none)


class _Parity:
    """Parities of sets: 64 bits, one half of 128 (from ``HALVED`` words on), two quarters of 256 (from ``QUARTERED``).

    The other halves and quarters follow from these, as their sums are the parities of fewer bits.
    """

    def __init__(self, *planes: np.ndarray):
        self.planes = planes

    def odd(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many parities differ in pairs of entries, at 64, 128 or 256 bits (``level`` 0, 1, 2)."""
        d = [p[i] ^ p[j] for p in self.planes[: (1, 2, 4)[level]]]
        if level == 0:
            return np.bitwise_count(d[0])
        if level == 1:
            d = [d[1], d[0] ^ d[1]]
        elif level == 2:
            d = [d[2], d[3], d[1] ^ d[3], d[0] ^ d[1] ^ d[2]]
        return np.sum([np.bitwise_count(x).astype(np.int64) for x in d], axis=0)


def _reach(size: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers per entry: a pair passes the length and positional filters if each one's first reaches the other's second.

    For sizes a, b and the place p in a, the words that a has left suffice if
    (NUM + DEN) * (a - p) >= NUM * (a + b), that is DEN * a - (NUM + DEN) * p >= NUM * b.
    With p = 0 or more this holds only for sizes that pass the length filter.
    """
    return DEN * size - (NUM + DEN) * place, NUM * size


def _close(size, parity: _Parity, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of entries the parities leave."""
    a, b = size[i].astype(np.int64), size[j].astype(np.int64)
    least, both = np.minimum(a, b), a + b
    slack = both - 2 * -(-NUM * both // (NUM + DEN))
    ok = parity.odd(0, i, j) <= slack
    for level, floor in ((1, HALVED), (2, QUARTERED)):
        y = np.flatnonzero(ok & (least >= floor))
        if len(y):
            ok[y] = parity.odd(level, i[y], j[y]) <= slack[y]
    return ok


def _passing(reach, needs, size, parity: _Parity, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of entries the length, positional and parity filters leave."""
    ok = (reach[i] >= needs[j]) & (reach[j] >= needs[i])
    x = np.flatnonzero(ok)
    ok[x] = _close(size, parity, i[x], j[x])
    return ok


def _read_postings(table: pa.Table) -> _Runs:
    parts = []
    for w, e, base in zip(*(table.column(c).to_pylist() for c in ("words", "entries", "base"))):
        n = len(w) // 6
        above, at = _wide(e, 16 * n, n)
        line, at = _wide(e, at, n)
        chunk, at = _wide(e, at, n)
        size, at = _wide(e, at, n)
        place, at = _wide(e, at, n)
        parts.append((unpack48(w), np.frombuffer(e, np.int64, n), np.frombuffer(e, np.uint64, n, 8 * n),
                      np.where(above == 0, _NO_ID, above - 1 + base), line, size, place, chunk, *_read_more(e, at, size)))
    return _Runs(*(np.concatenate(x) for x in zip(*parts)))


#: kind 0: a candidate pair (a, b); 1: set a first stands in chunk b; 2: set a is left open in block c of run b;
#: 3: block b of run a, to revisit; 4: set a, which stands in chunk b, first stands in another chunk, under a smaller id;
#: 5: what chunk a's texts have for sets, see ``_held_sets``.
_MET = "kind int, a long, b long, c long, run binary"


def _met_rows(kind: int, a, b, c=None, run=None) -> pa.Table:
    n = len(a)
    return pa.table({"kind": pa.array([kind] * n, pa.int32()),
                     "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                     "c": pa.nulls(n, pa.int64()) if c is None else pa.array(c, pa.int64()),
                     "run": pa.nulls(n, pa.binary()) if run is None else binary(run)})


def _meeting(small: int):
    """Function of one bucket: candidates (a earlier, b); sets left open, and the runs they are in."""

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:  # of ``_held_sets``
            n = len(table)
            return _met_rows(5, [-1 - bucket] * n, [0] * n, None, table.column("entries").to_pylist())
        r = _read_postings(table)
        one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def take(i, j):
            ok = r.passing(i, j)
            one.append(r.sets[i[ok]])
            two.append(r.sets[j[ok]])

        rank = np.arange(len(r.word)) - r.at
        later = np.flatnonzero((r.length <= small) & (rank > 0))
        d = 1
        while len(later):
            take(later - d, later)
            d += 1
            later = later[rank[later] >= d]
        found = np.zeros(len(r.word), dtype=np.int64)

        def add(i, j):
            one.append(r.sets[i])
            two.append(r.sets[j])
            np.add.at(found, j, 1)

        large = np.flatnonzero((r.length > small) & (rank == 0))
        for i, j in r.in_runs(large[r.length[large] <= BLOCK]):
            add(i, j)
        for s in large[r.length[large] > BLOCK].tolist():
            end = s + int(r.length[s])
            for k in range(s, end, BLOCK):
                add(*r.first_of(s, k, min(k + BLOCK, end)))
        a, b = np.concatenate(one), np.concatenate(two)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        keep = a != b
        keep[1:] &= (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[keep], b[keep]
        unsure = found >= FIRST
        packed, members, of_run, number = [], [a, b], [], []
        run = to_long(r.word)
        for s in np.unique(r.at[unsure]):
            end = s + r.length[s]
            members.append(r.sets[s:end])
            for k in range(s, end, BLOCK):
                e = slice(k, min(k + BLOCK, end))
                of_run.append(run[s])
                number.append((k - s) // BLOCK)
                packed.append(_packed(r.sets[e], r.size[e], r.place[e], [p[e] for p in r.parity.planes]))
        x = np.flatnonzero(unsure)
        known, at = np.unique(r.sets, return_index=True)
        used = np.isin(known, np.concatenate(members))
        return pa.concat_tables([
            _met_rows(0, a, b), _met_rows(1, known[used], r.chunk[at[used]].astype(np.int64)),
            _met_rows(2, r.sets[x], run[x], (x - r.at[x]) // BLOCK), _met_rows(3, of_run, number, None, packed),
            _met_rows(4, r.copies[:, 0], r.copies[:, 1])])

    return meet


def _packed(sets, size, place, planes: list[np.ndarray]) -> bytes:
    """Entries of a run: their number, then column by column."""
    return (len(sets).to_bytes(8, "little") + sets.tobytes() + planes[0].tobytes() + _narrow(size) + _narrow(place)
            + _more(size, *planes[1:]))


def _unpacked(raw: bytes) -> list[np.ndarray]:
    """Set, size, place and the planes of the parities."""
    n = int.from_bytes(raw[:8], "little")
    size, at = _wide(raw, 8 + 16 * n, n)
    place, at = _wide(raw, at, n)
    return [np.frombuffer(raw, np.int64, n, 8), size, place, np.frombuffer(raw, np.uint64, n, 8 + 8 * n),
            *_read_more(raw, at, size)]


def _block_pairs(batches):
    """All candidates of the open sets ``todo`` of block ``two`` in the block ``one`` of the same run."""
    for batch in batches:
        for one, two, same, todo in zip(*(batch.column(c).to_pylist() for c in ("one", "two", "same", "todo"))):
            v = [np.concatenate(x) for x in zip(_unpacked(one), _unpacked(two))]
            sets, size, place, parity = *v[:3], _Parity(*v[3:])
            n = int.from_bytes(one[:8], "little")
            at = np.flatnonzero(np.isin(sets[n:], np.array(todo, np.int64)))
            j, i = np.repeat(at, n) + n, np.tile(np.arange(n), len(at))
            if same:  # earlier entries only
                i, j = i[i < j - n], j[i < j - n]
            ok = _passing(*_reach(size, place), size, parity, i, j)
            yield pa.RecordBatch.from_arrays([pa.array(sets[i[ok]]), pa.array(sets[j[ok]])], ["a", "b"])


def _rest_of_runs(met: DataFrame, done: DataFrame) -> DataFrame:
    """Candidates (a, b) of the open sets b that are not ``done``: each block of them with the run's blocks up to it.

    A row is a pair of blocks, and no task holds a whole run.
    """
    todo = (met.where("kind = 2").select(F.col("a").alias("set_id"), F.col("b").alias("run"), F.col("c").alias("j"))
            .join(done, "set_id", "left_anti").groupBy("run", "j").agg(F.collect_list("set_id").alias("todo")))
    blocks = met.where("kind = 3").select(F.col("a").alias("run"), F.col("b").alias("n"), F.col("run").alias("held"))
    one = blocks.select("run", F.col("n").alias("i"), F.col("held").alias("one"))
    two = blocks.select("run", F.col("n").alias("j"), F.col("held").alias("two"))
    pairs = todo.select("run", "j", "todo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("j"))).alias("i"))
    return (pairs.join(two, ["run", "j"]).join(one, ["run", "i"])
            .select("one", "two", (F.col("i") == F.col("j")).alias("same"), "todo")
            .mapInArrow(_block_pairs, "a long, b long").distinct())


def _sketches(words: np.ndarray, at: np.ndarray, n: np.ndarray) -> list[bytes]:
    """For each set ``words[at: at + n]``: parities in at least ``SKETCH`` bits a word (a power of two, 64 at least)."""
    out = np.empty(len(n), dtype=object)
    width = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(1, SKETCH * n))).astype(np.int64))
    for bits in np.unique(width).tolist():
        x = np.flatnonzero(width == bits)
        owner = np.repeat(np.arange(len(x)), n[x])
        place = np.arange(len(owner)) + np.repeat(at[x] - starts_of(n[x])[:-1], n[x])
        bit = (words[place] >> U64(16)).astype(np.int64) & (bits - 1)
        odd = np.bincount(owner * bits + bit, minlength=len(x) * bits) & 1
        packed = np.packbits(odd.astype(np.uint8)).tobytes()
        out[x] = [packed[i: i + bits // 8] for i in range(0, len(packed), bits // 8)]
    return out.tolist()


def _odd_parities(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """How many parities of each two sketches differ; those of several widths are folded to the narrower one."""
    out = np.zeros(len(left), dtype=np.int64)
    sizes = np.array([[len(x), len(y)] for x, y in zip(left, right)], dtype=np.int64).reshape(-1, 2)
    for widths in np.unique(sizes, axis=0):
        rows = np.flatnonzero((sizes == widths).all(axis=1))
        p, q = (np.frombuffer(b"".join([side[i] for i in rows]), np.uint8).reshape(len(rows), -1)
                for side in (left, right))
        least = int(widths.min())
        p, q = (np.bitwise_xor.reduce(v.reshape(len(rows), -1, least), axis=1) for v in (p, q))
        out[rows] = np.bitwise_count(p ^ q).sum(axis=1, dtype=np.int64)
    return out


def _may_be_similar(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) that the sketches leave.

    Each word that only one of two sets has turns one parity, so more odd
    parities than the similarity allows such words rule a pair out.
    """

    def check(batches):
        for batch in batches:
            both = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            odd = _odd_parities(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())
            yield batch.select(["a", "b"]).filter(pa.array(odd <= both - 2 * -(-NUM * both // (NUM + DEN)), pa.bool_()))

    left = words.select(F.col("set_id").alias("a"), F.col("sketch").alias("sa"), F.col("n").alias("na"))
    right = words.select(F.col("set_id").alias("b"), F.col("sketch").alias("sb"), F.col("n").alias("nb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", "na", "nb")
            .mapInArrow(check, "a long, b long"))


def _similar(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""

    def check(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("wa").to_pylist(), batch.column("wb").to_pylist()):
                both = np.concatenate([unpack48(x), unpack48(y)])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                ok.append(DEN * common >= NUM * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = words.select(F.col("set_id").alias("a"), F.col("words").alias("wa"))
    right = words.select(F.col("set_id").alias("b"), F.col("words").alias("wb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb").mapInArrow(check, "a long, b long")


_SET = "set_id long, chunk int, id long, line long, n long, sketch binary, words binary"
_OUT = "id long, n_lines long, n_removed long, kept_text string"


def remove_similar_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         small_run: int = SMALL_RUN, per_chunk: int = 1024) -> DataFrame:
    """(id, n_lines, n_removed, kept_text) for every row of ``docs``.

    Lines are cut at ``\\n``, words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A
    line with words is removed when an earlier line, by id and line number,
    has a word set of Jaccard similarity 3/4 or more (equal sets included);
    all lines are judged on the input, removed ones too.  Lines without words
    stay.  ``kept_text`` joins the kept lines by ``\\n``; a null text counts as
    empty, with one line.  Rows without an id come after all others, and
    between rows of one id or without one the line number alone decides; of
    lines that nothing puts in order, equal sets stay, and of similar sets the
    one of the larger hash goes.  Columns other than the two named are ignored.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "line-dedup")
    level = spark.sparkContext.broadcast(word_counts(docs, text_col))  # COUNTERS bytes
    key = F.xxhash64("text")
    texts = chunked(docs, id_col, text_col, per_chunk).withColumn("key", key)
    bits = bucket_bits(docs)

    def post(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = pa.Table.from_batches([batch.slice(i, 1024)])
                c = _Chunk(part, level.value)
                chunk = part.column("chunk").to_numpy().astype(np.int64)
                yield from _postings(c, bits, chunk).to_batches()
                yield from _held_sets(c, chunk, part.column("key").to_numpy()).to_batches()

    # the first pass needs no exchange of the texts: a row's chunk goes with its postings
    (dealt(docs, id_col, text_col, per_chunk).withColumn("key", key)
     .mapInArrow(post, "bucket int, base long, words binary, entries binary")
     .groupBy("bucket").applyInArrow(_meeting(small_run), _MET).write.partitionBy("kind").parquet(f"{path}/met"))
    met = spark.read.schema(_MET).parquet(f"{path}/met")
    release(spark)
    pairs = met.where("kind = 0").select("a", "b").distinct()

    # per chunk, the sets of its texts and the sets that a pass asks for
    held = met.where("kind = 5").select(F.lit(None).cast("long").alias("set_id"), F.col("a").cast("int").alias("chunk"),
                                        F.col("run").alias("held"))

    def asking(sets: DataFrame):
        return sets.withColumn("held", F.lit(None).cast("binary")).unionByName(held).groupBy("chunk")

    def asked(need: pa.Table) -> tuple[np.ndarray, list[bytes]]:
        return (need.column("set_id").drop_null().to_numpy(), need.column("held").drop_null().to_pylist())

    def known(table: pa.Table, need: pa.Table) -> pa.Table:
        """Words and first place, in this chunk, of the sets asked for."""
        empty = pa.table({"set_id": pa.array([], pa.int64()), "chunk": pa.array([], pa.int32()),
                          "id": pa.array([], pa.int64()), "line": pa.array([], pa.int64()),
                          "n": pa.array([], pa.int64()), "sketch": binary([]), "words": binary([])})
        if not len(table) or not len(need):
            return empty
        sets, held = asked(need)
        at = _Lines(table, held)
        x = at.first[np.isin(to_long(at.names), sets)]
        if not len(x):
            return empty
        x.sort()
        # only the lines asked for are cut into words
        found, i = [], 0
        for _, _, buf, off in slices(table.column("text")):
            edges, lines = _line_edges(buf, off)
            raw = buf.tobytes()
            here = x[np.searchsorted(x, i): np.searchsorted(x, i + len(edges) - 1)] - i
            found += [raw[a:b].removesuffix(b"\n") for a, b in zip(edges[here].tolist(), edges[here + 1].tolist())]
            i += len(edges) - 1
        ids = at.ids[at.doc[x]]
        c = _Chunk(pa.table({"id": pa.array(ids), "text": pa.array(found, pa.binary()).cast(pa.string())}), level.value)
        mixed = mix64(c.keys)
        return pa.table({"set_id": pa.array(to_long(c.set_of)),
                         "chunk": pa.array([table.column("chunk")[0].as_py()] * len(x), pa.int32()),
                         "id": pa.array(ids), "line": pa.array(at.number[x]),
                         "n": pa.array(c.sizes, pa.int64()),
                         "sketch": binary(_sketches(mixed, c.at[:-1], c.sizes)),
                         "words": binary([pack48(mixed[a:b]) for a, b in zip(c.at, c.at[1:])])})

    first = met.where("kind = 1").select(F.col("a").alias("set_id"), F.col("b").cast("int").alias("chunk")).distinct()
    (texts.groupBy("chunk").cogroup(asking(first)).applyInArrow(known, _SET)
     .write.parquet(f"{path}/words"))
    words = spark.read.schema(_SET).parquet(f"{path}/words")
    release(spark)

    def verified(candidates: DataFrame, name: str) -> DataFrame:
        # the sketches, a tenth of the words, go first; whole sets travel for the pairs they leave
        _may_be_similar(candidates, words).write.parquet(f"{path}/{name}-candidates")
        left = spark.read.schema("a long, b long").parquet(f"{path}/{name}-candidates")
        release(spark)
        _similar(left, words).write.parquet(f"{path}/{name}")
        return spark.read.schema("a long, b long").parquet(f"{path}/{name}")

    links = verified(pairs, "links")
    if met.where("kind = 2").limit(1).count():
        done = _later(links, words).select("set_id").distinct()
        links = links.unionByName(verified(_rest_of_runs(met, done).join(pairs, ["a", "b"], "left_anti"), "links2"))
    gone = _later(links, words).distinct()
    release(spark)

    answers = gone.unionByName(met.where("kind = 4").select(
        F.col("a").alias("set_id"), F.col("b").cast("int").alias("chunk")))

    def cut(table: pa.Table, got: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({"id": pa.array([], pa.int64()), "n_lines": pa.array([], pa.int64()),
                             "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})
        sets, held = asked(got)
        c = _Lines(table, held)
        out = np.isin(to_long(c.names), sets)
        place = np.searchsorted(c.names, c.set_of)
        keep = c.set_of == 0
        stays = c.first[~out]
        keep[stays] = True
        # lines that nothing orders before the first stay with it
        x = np.flatnonzero((c.set_of > 0) & ~keep)
        f = c.first[place[x]]
        tie = (c.ids[c.doc[x]] == c.ids[c.doc[f]]) & (c.number[x] == c.number[f]) & keep[f]
        keep[x[tie]] = True
        removed = np.bincount(c.doc[~keep], minlength=len(c.lines))
        kept, i = [], 0
        for a, b, buf, off in slices(table.column("text")):
            raw = buf.tobytes()
            edge = _line_edges(buf, off)[0].tolist()
            n = 0
            for d in range(a, b):
                m = n + int(c.lines[d])
                if removed[d]:
                    kept.append(b"\n".join([raw[edge[k]: edge[k + 1]].removesuffix(b"\n") if k < m - 1
                                            else raw[edge[k]: edge[k + 1]] for k in range(n, m) if keep[i + k]]))
                else:
                    kept.append(raw[edge[n]: edge[m]])
                n = m
            i += n
        return pa.table({"id": table.column("id"), "n_lines": pa.array(c.lines, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()),
                         "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    out = texts.groupBy("chunk").cogroup(asking(answers)).applyInArrow(cut, _OUT)
    return out.withColumnRenamed("id", id_col)


def _later(links: DataFrame, words: DataFrame) -> DataFrame:
    """(set_id, chunk) of the later set of each link, by first id, line number and hash."""
    place = words.select("set_id", "chunk", "id", "line")
    a = place.select(F.col("set_id").alias("a"), F.col("chunk").alias("ca"), F.struct("id", "line", "set_id").alias("pa"))
    b = place.select(F.col("set_id").alias("b"), F.col("chunk").alias("cb"), F.struct("id", "line", "set_id").alias("pb"))
    return (links.join(a, "a").join(b, "b").select(
        F.when(F.col("pa") < F.col("pb"), F.col("b")).otherwise(F.col("a")).alias("set_id"),
        F.when(F.col("pa") < F.col("pb"), F.col("cb")).otherwise(F.col("ca")).alias("chunk")))


def with_digest(result: DataFrame) -> DataFrame:
    """``kept_sha256`` instead of the text itself."""
    return result.select(*[c for c in result.columns if c != "kept_text"],
                         F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
