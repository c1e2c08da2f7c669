"""Exact Jaccard self-join of documents' word n-gram sets by PartEnum signatures.

Two documents link when the Jaccard similarity of their n-gram sets reaches
``num / den`` (3/4).  Sets of similar size differ in few elements, so with the
feature domain cut into enough parts one part must hold at most one
difference; cut that part into three and two of the thirds agree.  The
signatures of a set are the hashes of those pairs of thirds.

1. Texts are dealt into chunks once.  A count filter over half of the domain
   drops documents which cannot link: at most a quarter of a set may be
   missing from its partner, so the other elements occur elsewhere.
2. The rest emit PartEnum signatures for each pair of size bands that can
   hold a link.  Copies (equal sets) emit them once a chunk.
3. Sets that share a signature are paired.  A passage that many texts hold
   makes large groups, whose pairs would grow with the square of the input.
   The sets of large groups meet again by their rarest elements: at most a
   quarter of a set is missing from its partner, so of the rarest quarter and
   one more, counted over all sets of large groups, the two share one.
4. Pairs are verified on parities first, which bound the difference from
   below, and those left on the whole sets.  Components join the links.
5. Rare elements that many sets hold are those of families of near copies.
   There each set is paired with the group's hub only, and where a family is
   left in several components, the sets outside the main one are compared with
   all others, a block of sets at a time, so that no link between components
   is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.chunks import (
    BLOB,
    MAX_KEYS,
    bucket_bits,
    chunked,
    held_elsewhere,
    held_times,
    pack,
    release,
    row_key,
    unpacked,
)
from churnlane.llm.components import components
from churnlane.llm.kernels import U64, binary, mix64, pack48, shingle_sets, starts_of, to_long, unpack48
from churnlane.operators.joins import join_bounded
from churnlane.session import scratch_path

#: Similarity bound: den * intersection >= num * union.
NUM, DEN = 3, 4
#: Independent partitions of the domain for sets that leave too many parts empty.
SEEDS = 4
_HALF = U64(1) << U64(63)

#: Groups of one signature up to this size are paired whole at once.
SMALL_GROUP = 6
#: Sets that share a rare element are paired whole up to this number.
RARE_GROUP = 64
#: Sets whose signatures are made at a time.
_BATCH = 1000

_OUT = "kind int, id long, n long, set_id long, elements binary, h1 long, h2 long"
_SIGS = "bucket int, sigs binary, owner binary, sets binary"
_SETS = "set_id long, rank long, elements binary, parity binary"


def size_bands(largest: int) -> list[tuple[int, int]]:
    """Size bands [low, high], each about 15.5 % wide, up to ``largest``."""
    bands, low = [], 1
    while low <= max(1, largest):
        high = low * 231 // 200
        bands.append((low, high))
        low = high + 1
    return bands


def instances(bands: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """For each band: the instances (number, differences k, parts) its sets take part in.

    An instance is a pair of bands (i, j) that can hold a link
    (``num * low_j <= den * high_i``); two linked sets of it differ in at most
    ``(den - num) * (high_i + high_j) / (den + num)`` elements.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in bands]
    for i, (_, high) in enumerate(bands):
        for j in range(i, len(bands)):
            if NUM * bands[j][0] > DEN * high:
                break
            k = (DEN - NUM) * (high + bands[j][1]) // (DEN + NUM)
            least = (k + 2) // 2
            inst = (i * 64 + (j - i), k, least + (least + 3) // 4 if k else 1)
            out[i].append(inst)
            if j != i:
                out[j].append(inst)
    return out


def _fold(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit identity of each set (order-free)."""
    if not len(starts) - 1:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(sets) + 1, dtype=np.uint64)
    np.cumsum(mix64(sets + U64(77)), out=total[1:])
    return mix64(total[starts[1:]] - total[starts[:-1]] + np.diff(starts).astype(np.uint64))


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of distinct non-empty sets: (signature, index of its set).

    Parts are counted with a reserve: an instance with ``least`` needed parts
    uses about a quarter more, ``spare``.  A set with at most ``spare`` parts
    that yield an empty signature always shares a non-empty one with a linked
    set.  Other sets emit the next seed's signatures too, and after the last
    seed also their empty ones, so that two of them still meet.
    """
    if not sets:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.array([len(s) for s in sets])
    bands = size_bands(int(sizes.max()))
    inst = instances(bands)
    band = np.searchsorted([b[1] for b in bands], sizes)
    sig_parts, own_parts = [], []
    for x, s in enumerate(sets):
        for number, k, parts in inst[band[x]]:
            if k == 0:  # only equal sets link, and those are one set already
                continue
            spare = parts - (k + 2) // 2
            for seed in range(SEEDS):
                salt = U64(((number * SEEDS + seed) * 0x9E3779B97F4A7C15 + 0x51ED) % (1 << 64))
                e = mix64(s + salt)
                cell = ((e >> U64(40)) % U64(parts)).astype(np.int64) * 3 + (e & U64(0xFFFF)).astype(np.int64) % 3
                cells = np.zeros(parts * 3, dtype=np.uint64)
                np.add.at(cells, cell, mix64(e))
                cells = cells.reshape(parts, 3)
                count = np.bincount(cell, minlength=parts * 3).reshape(parts, 3)
                full = count.sum(axis=1, keepdims=True) > count
                poor = int((~full.all(axis=1)).sum()) > spare
                place = np.arange(parts * 3, dtype=np.uint64).reshape(parts, 3) * U64(0xA24BAED4963EE407)
                sig = mix64(cells.sum(axis=1, keepdims=True, dtype=np.uint64) - cells + place + salt)
                if not poor or seed < SEEDS - 1:
                    sig = sig[full]
                sig_parts.append(sig.ravel())
                own_parts.append(np.full(sig.size, x))
                if not poor:
                    break
    if not sig_parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(sig_parts), np.concatenate(own_parts)


def _rows(kind: int, ids, n, set_ids, elements, h1=None, h2=None) -> pa.Table:
    return pa.table({"kind": pa.array([kind] * len(n), pa.int32()), "id": ids, "n": pa.array(n, pa.int64()),
                     "set_id": set_ids, "elements": elements,
                     "h1": pa.nulls(len(n), pa.int64()) if h1 is None else h1,
                     "h2": pa.nulls(len(n), pa.int64()) if h2 is None else h2})


def _by_bucket(sig: np.ndarray, own: np.ndarray, names: np.ndarray, bits: int) -> list[pa.Array]:
    """Columns of _SIGS: a row for each bucket (the leading ``bits``) of the signatures of sets called ``names``."""
    order = np.argsort(sig, kind="stable")
    sig, own = sig[order], own[order]
    bucket = (sig >> U64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(sig) else []
    ends = [*cut[1:], len(sig)]
    some = [np.unique(own[a:b], return_inverse=True) for a, b in zip(cut, ends)]
    return [pa.array([int(bucket[a]) for a in cut], pa.int32()),
            binary([pack48(sig[a:b]) for a, b in zip(cut, ends)]),
            binary([x.astype(np.uint16).tobytes() for _, x in some]),
            binary([names[u].tobytes() for u, _ in some])]


def _signed(batches):
    """Signature rows of (set_id, elements): one per bucket and batch of sets."""
    for whole in batches:
        for i in range(0, whole.num_rows, _BATCH):
            batch = whole.slice(i, _BATCH)
            names = batch.column("set_id").to_numpy(zero_copy_only=False).astype(np.int64)
            sig, own = signatures([unpack48(x) for x in batch.column("elements").to_pylist()])
            yield pa.RecordBatch.from_arrays(_by_bucket(sig, own, names, batch.column("bits")[0].as_py()),
                                             ["bucket", "sigs", "owner", "sets"])


def _groups(table: pa.Table, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and names of one bucket that several sets share, by signature.

    A name has ``width`` numbers, the set's id first; a signature's sets are in
    the order of the second, if there is one.
    """
    sig, names = [], []
    for h, o, s in zip(*(table.column(c).to_pylist() for c in ("sigs", "owner", "sets"))):
        sig.append(unpack48(h))
        names.append(np.frombuffer(s, np.int64).reshape(-1, width)[np.frombuffer(o, np.uint16)])
    sig, names = np.concatenate(sig), np.concatenate(names)
    order = np.argsort(sig, kind="stable")
    sig, names = sig[order], names[order]
    shared = np.zeros(len(sig), dtype=bool)
    shared[1:] = sig[1:] == sig[:-1]
    shared[:-1] |= shared[1:]
    sig, names = sig[shared], names[shared]
    order = np.lexsort((*names.T[:2], sig))
    sig, names = sig[order], names[order]
    keep = np.ones(len(sig), dtype=bool)
    keep[1:] = (sig[1:] != sig[:-1]) | (names[1:, 0] != names[:-1, 0])
    return sig[keep], names[keep]


def _distinct_pairs(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """(a, b) with a < b, each once."""
    a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = a != b
    keep[1:] &= (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return pa.table({"a": pa.array(a[keep], pa.int64()), "b": pa.array(b[keep], pa.int64())})


def _run_of(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: the first entry of its run of equal signatures, and the run's length."""
    lead = np.ones(len(sig), dtype=bool)
    lead[1:] = sig[1:] != sig[:-1]
    at = np.maximum.accumulate(np.where(lead, np.arange(len(sig)), 0))
    return at, np.bincount(at, minlength=len(sig))[at]


def _meeting(small: int):
    """Function of one bucket: pairs (a, b) of the sets of groups of up to ``small``, and (a, null) the sets of larger ones."""

    def meet(table: pa.Table) -> pa.Table:
        sig, names = _groups(table)
        sets = names[:, 0]
        _, size = _run_of(sig)
        pairs = []
        for d in range(1, small):
            i = np.flatnonzero((sig[d:] == sig[:-d]) & (size[d:] <= small))
            pairs.append((sets[i], sets[i + d]))
        large = np.unique(sets[size > small])
        return pa.concat_tables([_distinct_pairs(pairs), pa.table({
            "a": pa.array(large, pa.int64()), "b": pa.nulls(len(large), pa.int64())})])

    return meet


def _rare_meeting(whole: int):
    """Function of one bucket: candidate pairs (a, b, hub) of sets that share a rare element.

    Groups of up to ``whole`` sets are paired whole, but for pairs whose sizes
    rule a link out; in a larger one every set is paired with the group's hub
    only, the set of the least document.
    """

    def meet(table: pa.Table) -> pa.Table:
        sig, names = _groups(table, 3)
        sets, n = names[:, 0], names[:, 2]
        at, size = _run_of(sig)
        pairs = []
        for d in range(1, whole):
            i = np.flatnonzero((sig[d:] == sig[:-d]) & (size[d:] <= whole))
            if not len(i):
                break
            x, y = n[i], n[i + d]
            i = i[DEN * np.minimum(x, y) >= NUM * np.maximum(x, y)]
            pairs.append((sets[i], sets[i + d]))
        member = np.flatnonzero(size > whole)
        both, star = _distinct_pairs(pairs), _distinct_pairs([(sets[at[member]], sets[member])])
        return pa.concat_tables([t.append_column("hub", pa.array([k] * len(t), pa.bool_()))
                                 for t, k in ((both, False), (star, True))])

    return meet


def _met_by_rarest(sets: DataFrame, whole: int, bits: int, per_chunk: int = 1024) -> DataFrame:
    """Candidate pairs (a, b, hub) of all ``sets`` (set_id, rank, elements) that link, by their rarest elements.

    Linked sets share ``num / den`` of the larger one.  In any one order of the
    elements, each has a shared one among its first n - ceil(n * num / den) + 1,
    and the least shared one is among them in both.  The order is by how many
    sets hold an element, so what many hold comes last.
    """
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = max(1, math.ceil(sets.count() / per_chunk))
    dealt = (sets.select("set_id", "rank", "elements", F.pmod(F.xxhash64("set_id"), F.lit(count)).cast("int").alias("chunk"))
             .repartition(max(1, min(count, parts)), "chunk"))

    def counted(table: pa.Table):
        each = [unpack48(x) for x in table.column("elements").to_pylist()]
        elements = np.concatenate(each)
        distinct, back, times = np.unique(elements >> U64(24), return_inverse=True, return_counts=True)
        return np.array([len(x) for x in each]), elements, distinct << U64(24), back, times

    def ask(table: pa.Table) -> pa.Table:
        _, _, distinct, _, times = counted(table)
        return pack(distinct, times.astype(np.uint32), bits, table.column("chunk")[0].as_py(), short=True)

    answers = held_times(dealt.groupBy("chunk").applyInArrow(ask, BLOB), 1)

    def emit(table: pa.Table, got: pa.Table) -> pa.Table:
        n, elements, distinct, back, _ = counted(table)
        held = unpacked(got, 1, len(distinct), whole=True)[back]
        own = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((elements, held, own))
        first = np.arange(len(own)) - starts_of(n)[own] < (n - (NUM * n + DEN - 1) // DEN + 1)[own]
        names = np.stack([*(table.column(c).to_numpy().astype(np.int64) for c in ("set_id", "rank")), n], axis=1)
        return pa.table(_by_bucket(elements[order][first], own[first], names, bits),
                        names=["bucket", "sigs", "owner", "sets"])

    return (dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(emit, _SIGS)
            .groupBy("bucket").applyInArrow(_rare_meeting(whole), "a long, b long, hub boolean"))


def _common(left: list[np.ndarray], right: list[np.ndarray], tile: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each left with each right set."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    x, y = np.concatenate(left), np.concatenate(right)
    xi = np.repeat(np.arange(len(left)), [len(s) for s in left])
    yi = np.repeat(np.arange(len(right)), [len(s) for s in right])
    both = np.intersect1d(x, y)
    for i in range(0, len(both), tile):
        part = both[i: i + tile]
        grid = []
        for values, owner, n in ((x, xi, len(left)), (y, yi, len(right))):
            at = np.searchsorted(part, values).clip(0, len(part) - 1)
            ok = part[at] == values
            g = np.zeros((n, len(part)), dtype=np.float32)
            g[owner[ok], at[ok]] = 1
            grid.append(g)
        out += grid[0] @ grid[1].T
    return out


def _block_links(batches):
    """Links between two blocks of a cluster that join different components: a forest of them."""
    for batch in batches:
        for row in batch.to_pylist():
            left, right = row["one"], row["two"]
            x, y = ([unpack48(e["elements"]) for e in side] for side in (left, right))
            common = _common(x, y)
            sizes = np.add.outer([len(s) for s in x], [len(s) for s in y])
            lx, ly = (np.array([e["label"] for e in side], np.int64) for side in (left, right))
            ok = (DEN * common >= NUM * (sizes - common)) & np.not_equal.outer(lx, ly)
            root: dict[int, int] = {}

            def find(v: int) -> int:
                while root.get(v, v) != v:
                    v = root[v]
                return v

            a, b = [], []
            for i, j in zip(*np.nonzero(ok)):
                p, q = find(int(lx[i])), find(int(ly[j]))
                if p != q:
                    root[max(p, q)] = min(p, q)
                    a.append(left[i]["set_id"])
                    b.append(right[j]["set_id"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _links_across(stars: DataFrame, sets: DataFrame, label: DataFrame, block: int = 256) -> DataFrame:
    """Links that join components of ``label`` inside the clusters that large groups of ``stars`` form.

    Sets of one large group are in one cluster, joined by its hub.  In a
    cluster of several components all sets outside the main one are compared
    with all sets, block by block: a row is a pair of blocks, not of sets, and
    no task holds more than two blocks.
    """
    cluster = components(stars)
    hot = (cluster.join(label.select(F.col("node"), F.col("label").alias("lab")), "node", "left")
           .select(F.col("node").alias("set_id"), F.col("label").alias("cluster"),
                   F.coalesce("lab", "node").alias("label")))
    sizes = hot.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    shape = (sizes.groupBy("cluster").agg(F.max_by("label", F.struct("n", "label")).alias("main"),
                                          F.max("n").alias("n_main"), F.sum("n").alias("n"))
             .where("n > n_main")
             .select("cluster", "main", F.ceil(F.col("n_main") / block).alias("mains"),
                     F.ceil((F.col("n") - F.col("n_main")) / block).alias("rests")))
    placed = hot.join(shape, "cluster").withColumn(
        "side", (F.col("label") != F.col("main")).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("set_id"), F.when(F.col("side") == 1, F.col("rests")).otherwise(F.col("mains"))))
    blocks = (placed.select("set_id", "cluster", "label", "side", "block").join(sets.select("set_id", "elements"), "set_id")
              .groupBy("cluster", "side", "block")
              .agg(F.collect_list(F.struct("set_id", "label", "elements")).alias("sets")))
    rest = shape.select("cluster", "mains", "rests", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("i"))
    pairs = (rest.select("cluster", "i", F.lit(1).alias("side"), F.explode(
        F.sequence(F.col("i"), F.col("rests") - 1)).alias("j"))
        .unionByName(rest.select("cluster", "i", F.lit(0).alias("side"), F.explode(
            F.sequence(F.lit(0), F.col("mains") - 1)).alias("j"))))
    one = blocks.where("side = 1").select("cluster", F.col("block").alias("i"), F.col("sets").alias("one"))
    two = blocks.select("cluster", "side", F.col("block").alias("j"), F.col("sets").alias("two"))
    return (pairs.join(one, ["cluster", "i"]).join(two, ["cluster", "side", "j"]).select("one", "two")
            .mapInArrow(_block_links, "a long, b long"))


def _parity(elements: np.ndarray) -> bytes:
    """For each of 2**k bits (as many as elements, 64 at least) whether an odd number of elements falls on it."""
    bits = max(64, 1 << (len(elements) - 1).bit_length())
    place = ((elements >> U64(16)) & U64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1, bitorder="little").tobytes()


def _differ(x: bytes, y: bytes) -> int:
    """The number of bits in which two parities differ, the longer one folded: never more than their sets' differences."""
    if len(x) < len(y):
        x, y = y, x
    p, n = int.from_bytes(x, "little"), len(x)
    while n > len(y):
        n //= 2
        p = (p & ((1 << 8 * n) - 1)) ^ (p >> 8 * n)
    return (p ^ int.from_bytes(y, "little")).bit_count()


def _with_parity(batches):
    for batch in batches:
        yield batch.append_column("parity", binary([_parity(unpack48(x)) for x in batch.column("elements").to_pylist()]))


def _with_both(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """The pairs (a, b) with ``columns`` of both sets, as a_ and b_."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("set_id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns)), side)
    return pairs


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, decided on the whole sets.

    Whole sets travel only for pairs whose parities allow a link: linked sets
    differ in at most ``(den - num) / (den + num)`` of both sizes.
    """

    def near(batches):
        for batch in batches:
            ok = [(DEN + NUM) * _differ(x, y) <= (DEN - NUM) * (n + m) for x, y, n, m in zip(
                *(batch.column(c).to_pylist() for c in ("a_parity", "b_parity", "a_n", "b_n")))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def check(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("a_elements").to_pylist(), batch.column("b_elements").to_pylist()):
                both = np.concatenate([unpack48(x), unpack48(y)])
                n = len(both)
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                ok.append(DEN * common >= NUM * (n - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    sized = sets.withColumn("n", (F.octet_length("elements") / 6).cast("long"))
    left = _with_both(pairs, sized, "n", "parity").mapInArrow(near, "a long, b long")
    return _with_both(left, sets, "elements").mapInArrow(check, "a long, b long")


def _candidates(docs: DataFrame, id_col: str, text_col: str, width: int, path: str,
                per_chunk: int = 1024) -> DataFrame:
    """Writes and returns (kind 0) every row's id, set size, set id and text hashes, (kind 2) the sets that may link."""
    texts = chunked(docs, id_col, text_col, per_chunk)
    bits = bucket_bits(docs)

    def counted(table: pa.Table):
        sets, sizes = shingle_sets(table.column("text"), width, lower=True)
        half = sets < _HALF
        distinct, back, times = np.unique((sets[half] >> U64(23)) << U64(24), return_inverse=True, return_counts=True)
        return sets, sizes, half, distinct, back, times

    def ask(table: pa.Table) -> pa.Table:
        _, _, _, distinct, _, times = counted(table)
        return pack(distinct, (times > 1).astype(np.uint8), bits, table.column("chunk")[0].as_py(), short=True)

    answers = held_elsewhere(texts.groupBy("chunk").applyInArrow(ask, BLOB), 1, short=True)

    def emit(table: pa.Table, got: pa.Table) -> pa.Table:
        if not len(table):
            none = pa.array([], pa.int64())
            return _rows(0, none, [], none, binary([]))
        sets, sizes, half, distinct, back, _ = counted(table)
        known = unpacked(got, 1, len(distinct))[back]
        at = starts_of(sizes)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        total = np.bincount(doc[half], minlength=len(sizes))
        found = np.bincount(doc[half], weights=known, minlength=len(sizes)).astype(np.int64)
        # linked sets miss at most (den - num) / den of their elements
        alive = (sizes > 0) & (found >= total - sizes * (DEN - NUM) // DEN)
        set_ids = to_long(_fold(sets, at))
        ids = table.column("id").combine_chunks()
        order_id = np.array([np.iinfo(np.int64).max if x is None else x for x in ids.to_pylist()], np.int64)
        # equal sets of this chunk are one: the row of the least id speaks for them
        best: dict[int, int] = {}
        for d in np.flatnonzero(alive):
            s = int(set_ids[d])
            if s not in best or order_id[d] < order_id[best[s]]:
                best[s] = int(d)
        keep = list(best.values())
        return pa.concat_tables([
            _rows(0, ids, sizes, pa.array(set_ids, pa.int64(), mask=sizes == 0), pa.nulls(len(sizes), pa.binary()),
                  table.column("h1"), table.column("h2")),
            _rows(2, pa.array(order_id[keep], pa.int64()), sizes[keep], pa.array(set_ids[keep], pa.int64()),
                  binary([pack48(sets[at[d]: at[d + 1]]) for d in keep]))])

    key = row_key("id", "text")
    keyed = texts.withColumns({"h1": key["h1"], "h2": key["h2"]})
    (keyed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(emit, _OUT)
     .write.partitionBy("kind").parquet(path))
    return docs.sparkSession.read.schema(_OUT).parquet(path)


def _met(sets: DataFrame, meet, schema: str, bits: int) -> DataFrame:
    """``meet`` over the signatures of ``sets`` (set_id, elements), bucket by bucket."""
    return (sets.select("set_id", "elements", F.lit(bits).alias("bits"))
            .mapInArrow(_signed, _SIGS).groupBy("bucket").applyInArrow(meet, schema))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = 5, small_group: int = SMALL_GROUP, per_chunk: int = 1024,
                       rare_group: int = RARE_GROUP) -> DataFrame:
    """(id, n_shingles, component_id, set_id) for every row of ``docs``.

    ``n_shingles`` counts the distinct ``width``-word n-grams of the whole
    text (A-Z lower-cased); a text with fewer words, but not none, has one,
    and a null or empty text none.  ``component_id`` is the smallest id
    reachable over links, its own included; a document without n-grams links
    with nothing.  Rows with equal ids stay separate rows.  A row without an
    id never names a component; alone, its component is null.  Columns other
    than the two named are ignored, so their names cannot clash.
    """
    return (_component_rows(docs, id_col, text_col, width, small_group, per_chunk, rare_group)
            .select(F.col("key.id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("best.id", "key.id").alias("component_id"), "set_id"))


def _component_rows(docs: DataFrame, id_col: str, text_col: str, width: int = 5, small_group: int = SMALL_GROUP,
                    per_chunk: int = 1024, rare_group: int = RARE_GROUP) -> DataFrame:
    """(key, n, set_id, best) for every row: its ``row_key``, and the key of the first row of its component.

    The first row is the one of the least id, rows without an id last;
    ``best`` is null for a row without n-grams.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "ngram-join")
    pair, bits = "a long, b long", bucket_bits(docs)
    parts = _candidates(docs, id_col, text_col, width, f"{path}/parts", per_chunk)
    release(spark)
    # one row per set; any of its rows will do, its least id ranks it
    rank = parts.where("kind = 2").groupBy("set_id").agg(
        F.min("id").alias("rank"), F.min_by("elements", "id").alias("elements"))
    rank.mapInArrow(_with_parity, _SETS).write.parquet(f"{path}/sets")
    sets = spark.read.schema(_SETS).parquet(f"{path}/sets")

    _met(sets, _meeting(small_group), pair, bits - 1).write.parquet(f"{path}/met")
    met = spark.read.schema(pair).parquet(f"{path}/met")
    release(spark)
    pairs, stars = met.where("b is not null"), None
    large = met.where("b is null").select(F.col("a").alias("set_id"))
    if large.limit(1).count():
        sets.join(large.distinct(), "set_id", "left_semi").select("set_id", "rank", "elements").write.parquet(f"{path}/large")
        hot = spark.read.schema("set_id long, rank long, elements binary").parquet(f"{path}/large")
        _met_by_rarest(hot, rare_group, bits).write.parquet(f"{path}/met2")
        again = spark.read.schema(f"{pair}, hub boolean").parquet(f"{path}/met2")
        pairs, stars = pairs.unionByName(again.select("a", "b")), again.where("hub").select("a", "b")
        release(spark)
    _verified(pairs.distinct(), sets).write.parquet(f"{path}/links")
    links = spark.read.schema(pair).parquet(f"{path}/links")
    label = components(links)

    if stars is not None and stars.limit(1).count():
        _links_across(stars, sets, label).write.parquet(f"{path}/links2")
        rest = spark.read.schema(pair).parquet(f"{path}/links2")
        if rest.limit(1).count():
            # the stars of the first links stand for them
            label = components(label.toDF("a", "b").unionByName(rest))
    release(spark)

    rows = parts.where("kind = 0").select(F.struct("id", "h1", "h2").alias("key"), "n", "set_id")
    least = rows.where("set_id is not null").groupBy("set_id").agg(
        F.min(F.struct(F.col("key.id").isNull().alias("no_id"), "key")).alias("first"))
    tagged = (least.join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
              .select("set_id", "first", F.coalesce("label", "set_id").alias("label")))
    comp = tagged.groupBy("label").agg(F.min("first").alias("first"))
    by_set = tagged.select("set_id", "label").join(comp, "label").select("set_id", F.col("first.key").alias("best"))
    return rows.join(by_set, "set_id", "left").select("key", "n", "set_id", "best")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay: one row of each component, all columns kept.

    It is the row of the smallest id, rows without an id last; of rows that
    agree in id the text's hashes decide, and of rows that agree in both any
    one stays.  Rows without n-grams all stay.
    """
    path = scratch_path(docs.sparkSession, "one-per-component")
    own = _component_rows(docs, id_col, text_col).where("best is not null")
    # the keys that do not all stay; first: one row of them does
    (own.groupBy("key").agg(F.first("best").alias("best"), F.count(F.lit(1)).alias("times"))
     .select("key", F.expr("key <=> best").alias("first"), "times").where("times > 1 or not first")
     .write.parquet(path))
    some = docs.sparkSession.read.schema(
        "key struct<id: bigint, h1: bigint, h2: bigint>, first boolean, times long").parquet(path)
    keyed = docs.withColumn("_cl_key", row_key(id_col, text_col))
    keys = some.select(F.col("key").alias("_cl_key"))
    # up to MAX_KEYS keys the rows are filtered where they are read, and no text is shuffled
    stay = join_bounded(keyed, keys, "_cl_key", "left_anti", max_rows=MAX_KEYS).select(*docs.columns)
    repeated = some.where("first").select(F.col("key").alias("_cl_key"))
    if repeated.limit(1).count():
        again = join_bounded(keyed, repeated, "_cl_key", "left_semi", max_rows=MAX_KEYS)
        stay = stay.unionByName(again.dropDuplicates(["_cl_key"]).select(*docs.columns))
    return stay
