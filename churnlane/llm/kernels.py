"""Vectorised text kernels that run inside Arrow tasks.

All of them work on the UTF-8 bytes of a batch of texts at once (numpy), so a
task never loops over words in Python.  Byte classes are enough because every
separator of the contracts is ASCII and UTF-8 continuation bytes are >= 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at a time; bounds the work arrays (about 50x this).
SLICE_BYTES = 4 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * U64(2) + U64(1)
_STEP = U64(0x9E3779B97F4A7C15)
_COEF = _rng.integers(1, 1 << 63, size=64, dtype=np.uint64) * U64(2) + U64(1)


def _inverse_odd(x: int) -> int:
    return pow(int(x), -1, 1 << 64)


_STEP_INV = U64(_inverse_odd(_STEP))
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64; only the usual slice length stays cached."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        if size > SLICE_BYTES + 1:
            return table
        _powers[name] = have = table
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(29)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(32)
    return x


def byte_class(separators: list[int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[separators] = False
    return table


#: Words are [^\x20\x09-\x0D]+
WORD_BYTES = byte_class([0x20, *range(0x09, 0x0E)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """Word boundaries and 64-bit word hashes of a slice of texts.

    ``buf`` are the bytes, ``starts``/``ends`` the words in them, and words
    ``first[d]:first[d + 1]`` belong to text ``d`` of the slice.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool):
        if lower:
            buf = _LOWER[buf]
        self.buf, self.offsets, n = buf, offsets, len(buf)
        inside = WORD_BYTES[buf]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(n, dtype=bool)
        if n:
            after[-1] = False
            after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.n_docs = len(offsets) - 1
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        n = len(self.buf)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.buf] * _power_table("p", _STEP, n), out=total[1:])
        h = total[self.ends] - total[self.starts]
        h *= _power_table("i", _STEP_INV, n)[self.starts] if n else U64(1)
        return mix64(h + (self.ends - self.starts).astype(np.uint64))


def slices(texts: pa.Array, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of texts of about ``size`` (SLICE_BYTES); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    size = size or SLICE_BYTES
    _, off_buf, data = texts.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64)[texts.offset: texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + size, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b, raw[off[a]: off[b]], off[a: b + 1] - off[a]
        a = b


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive entries, document borders ignored."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = words[:n] * _COEF[0]
    for j in range(1, width):
        h += words[j: j + n] * _COEF[j % 64]
    return mix64(h)


def shingle_sets(texts: pa.Array, width: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, and their count per text.

    A text with fewer than ``width`` words, but not none, has one shingle: its
    whole sequence.  A text without words has none.
    """
    parts, sizes = [], []
    for _, _, buf, off in slices(texts):
        w = Words(buf, off, lower)
        wh = w.hashes()
        g = window_hashes(wh, width)
        last = w.first[1:] - width + 1
        sets = []
        for d in range(w.n_docs):
            a, b, end = w.first[d], last[d], w.first[d + 1]
            if b > a:
                s = g[a:b]
                s.sort()
            elif end > a:
                whole = wh[a:end]
                s = mix64((whole * _COEF[: end - a]).sum(dtype=np.uint64, keepdims=True)
                          + U64(0xA5A5 + int(end - a)))
            else:
                sizes.append(0)
                continue
            if len(s) > 1:
                keep = np.empty(len(s), dtype=bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                s = s[keep]
            sets.append(s)
            sizes.append(len(s))
        if sets:
            parts.append(np.concatenate(sets))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(sizes, dtype=np.int64)


def starts_of(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def to_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, type=pa.binary())


def pack48(x: np.ndarray) -> bytes:
    """The leading 48 bits of each value, 6 bytes each (two planes)."""
    return (x >> U64(32)).astype(np.uint32).tobytes() + ((x >> U64(16)) & U64(0xFFFF)).astype(np.uint16).tobytes()


def unpack48(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    high = np.frombuffer(raw, np.uint32, n).astype(np.uint64)
    return (high << U64(32)) | (np.frombuffer(raw, np.uint16, n, 4 * n).astype(np.uint64) << U64(16))


def pack40(x: np.ndarray) -> bytes:
    """The leading 40 bits of each value, 5 bytes each."""
    return (x >> U64(32)).astype(np.uint32).tobytes() + ((x >> U64(24)) & U64(0xFF)).astype(np.uint8).tobytes()


def unpack40(raw: bytes) -> np.ndarray:
    n = len(raw) // 5
    high = np.frombuffer(raw, np.uint32, n).astype(np.uint64)
    return (high << U64(32)) | (np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.uint64) << U64(24))
