"""SentencePiece encoding and decoding for merge-type vocabularies.

The symbols of a text are its characters.  An agenda holds the adjacent pairs
whose concatenation is a piece, by score; the pair of highest score, leftmost on
ties, is merged until the agenda is empty.  A long part has a heap for it; short
parts of one length are merged together, a row of an array each (numpy).  What is left becomes piece ids, or
one id per UTF-8 byte where a character has no piece.

A text is cut where no piece can reach across (before a space mark that follows
another character, around characters that occur in single-character pieces
only), so parts are merged on their own and short ones are remembered.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.llm.ship import ship

#: Fixed values of the model file: the mark of a space, and the kinds of pieces.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
_BPE = 2
#: Short parts whose ids a task remembers, about, in two halves; the older one goes when the newer is full.
REMEMBERED = 250_000
SHORT = 32
_NONE = np.iinfo(np.int64).max
_EMPTY = np.uint64(np.iinfo(np.uint64).max)


def _fields(raw: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of every field of a protocol buffer message."""
    at, end = 0, len(raw)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError("not a SentencePiece model file")
            size = varint()
        yield tag >> 3, raw[at: at + size]
        at += size


class _Remembered(dict):
    """Packed ids by part; a part that is not there is packed each time."""

    def __init__(self, pack):
        super().__init__()
        self._pack = pack

    def __missing__(self, part: str) -> bytes:
        return self._pack(part)


class PieceModel:
    """Pieces, scores and special ids of a model file, with ``encode`` and ``decode``."""

    def __init__(self, raw: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(raw):
            if number == 1:
                p = dict(_fields(value))
                pieces.append((p[1].decode(), struct.unpack("<f", p.get(2, bytes(4)))[0], p.get(3, NORMAL)))
            elif number in (2, 3):
                (trainer if number == 2 else normalizer).update(_fields(value))
        kinds = {k for _, _, k in pieces}
        plain = (trainer.get(3, 1) == _BPE and trainer.get(35, 0) and not trainer.get(24, 0)
                 and not normalizer.get(2) and not normalizer.get(4, 1) and normalizer.get(5, 1)
                 and not kinds & {USER_DEFINED, UNUSED})
        if not plain:
            raise ValueError("only byte-fallback BPE models without normalisation rules, "
                             "user-defined or unused pieces are supported")
        self.prefix = bool(normalizer.get(3, 1))
        self.size = len(pieces)
        special = [i for i, (_, _, k) in enumerate(pieces) if k in (CONTROL, UNKNOWN)]
        named = {p: i for i, (p, _, k) in enumerate(pieces) if k == CONTROL}
        self.bos = named.get(trainer.get(78, b"<s>").decode())
        self.eos = named.get(trainer.get(79, b"</s>").decode())
        self.unk_text = trainer.get(44, b" \xe2\x81\x87 ").decode()
        places = {score: i for i, score in enumerate(sorted({s for _, s, k in pieces if k == NORMAL}, reverse=True))}
        #: A piece's place by score, the highest first; equal scores share a place.
        self.rank = {p: places[s] for p, s, k in pieces if k == NORMAL}
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        #: What an id stands for in bytes; None for control and unknown pieces.
        self.raw = [None if k in (CONTROL, UNKNOWN) else
                    bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() for p, _, k in pieces]
        self.kind = [k for _, _, k in pieces]
        self.special = np.zeros(self.size, dtype=bool)
        self.special[special] = True
        self._parts = self._cutter()
        self._pair_table()
        self._packed = _Remembered(self._pack)
        self._older: dict[str, bytes] = {}

    def _cutter(self) -> re.Pattern:
        """Parts of a normalised text between which no piece can stand."""
        longer = [p for p in self.rank if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            return re.compile(r"[\s\S]+")
        joined = set("".join(longer))
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
        return re.compile(f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def merged(self, part: str) -> list[str]:
        """The pieces left of one part once its agenda, a heap over linked symbols, is empty."""
        rank, symbols, n = self.rank.get, list(part), len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # an entry is one number: the place of its score among all scores, then its position
        bits = n.bit_length()
        mask = (1 << bits) - 1
        agenda = [r << bits | i for i in range(n - 1) if (r := rank(symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            i = entry & mask
            j = after[i]
            if j >= n or not symbols[i]:
                continue
            pair = symbols[i] + symbols[j]
            # one of the two was merged meanwhile: the symbols make up another pair
            if rank(pair) != entry >> bits:
                continue
            symbols[i], symbols[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(pair + symbols[k])) is not None:
                    heapq.heappush(agenda, r << bits | i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] + pair)) is not None:
                heapq.heappush(agenda, r << bits | h)
        return [s for s in symbols if s]

    def _pack(self, part: str) -> bytes:
        out: list[int] = []
        for piece in self.merged(part):
            i = self.ids.get(piece)
            if i is None:
                out += [self.byte_ids[b] for b in piece.encode()]
            else:
                out.append(i)
        return struct.pack(f"<{len(out)}I", *out)

    def _pair_table(self) -> None:
        """Hash table (open addressing) of every two pieces whose concatenation is a piece: its score's place and id."""
        left, right, whole = [], [], []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                x, y = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if x is not None and y is not None:
                    left.append(x)
                    right.append(y)
                    whole.append(i)
        key = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self._bits = max(10, (4 * len(key)).bit_length())
        self._keys = np.full(1 << self._bits, _EMPTY, dtype=np.uint64)
        self._whole = np.zeros(1 << self._bits, dtype=np.int64)
        names = {i: p for p, i in self.ids.items()}
        self._place = np.full(self.size, _NONE, dtype=np.int64)
        for i, p in names.items():
            self._place[i] = self.rank[p]
        todo, at, whole = np.arange(len(key)), self._slot(key), np.array(whole, np.int64)
        while len(todo):
            free = todo[self._keys[at[todo]] == _EMPTY]
            _, one = np.unique(at[free], return_index=True)
            free = free[one]
            self._keys[at[free]], self._whole[at[free]] = key[free], whole[free]
            todo = todo[self._keys[at[todo]] != key[todo]]
            at[todo] = (at[todo] + 1) & ((1 << self._bits) - 1)
        codes = np.full(0x110000, -1, dtype=np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                codes[ord(p)] = i
        self._codes = codes

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the score, id) of each concatenation; the place is _NONE where it is no piece."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at, out = self._slot(key), np.full(len(key), -1, dtype=np.int64)
        todo = np.arange(len(key))
        while len(todo):
            held = self._keys[at[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self._whole[at[todo[hit]]]
            todo = todo[~hit & (held != _EMPTY)]
            at[todo] = (at[todo] + 1) & ((1 << self._bits) - 1)
        return np.where(out < 0, _NONE, self._place[out]), out

    def _pack_alike(self, symbols: np.ndarray) -> list[bytes]:
        """Packed ids of parts of one length, given as rows of their characters' ids; each has its agenda in a row."""
        n, width = symbols.shape
        agenda = np.full((n, width), _NONE, dtype=np.int64)
        whole = np.zeros((n, width), dtype=np.int64)
        if width > 1:
            place, ids = self._joined(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
            agenda[:, :-1], whole[:, :-1] = place.reshape(n, -1), ids.reshape(n, -1)
        # links to the next and to the previous symbol; column width stands for none
        after = np.tile(np.arange(1, width + 1), (n, 1))
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        alive = np.ones((n, width), dtype=bool)
        row = np.arange(n)
        while len(row):
            i = agenda[row].argmin(axis=1)  # the best score, the first of equal ones
            going = agenda[row, i] < _NONE
            row, i = row[going], i[going]
            j = after[row, i]
            symbols[row, i] = whole[row, i]
            alive[row, j] = False
            agenda[row, j] = _NONE
            k = after[row, j]
            after[row, i] = k
            inner = k < width
            r, x, y = row[inner], i[inner], k[inner]
            before[r, y] = x
            agenda[row, i] = _NONE
            agenda[r, x], whole[r, x] = self._joined(symbols[r, x], symbols[r, y])
            h = before[row, i]
            inner = h >= 0
            r, x, y = row[inner], h[inner], i[inner]
            agenda[r, x], whole[r, x] = self._joined(symbols[r, x], symbols[r, y])
        raw = symbols[alive].astype("<u4").tobytes()
        ends = np.cumsum(alive.sum(axis=1)) * 4
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _learn(self, parts: Iterable[str]) -> None:
        """Remember the ids of new short parts."""
        known, older, alike = self._packed, self._older, {}
        for p in parts:
            if p in older:
                known[p] = older[p]
            elif len(p) <= SHORT:
                alike.setdefault(len(p), []).append(p)
        for same in alike.values():
            codes = self._codes[np.frombuffer("".join(same).encode("utf-32-le"), np.uint32)].reshape(len(same), -1)
            plain = (codes >= 0).all(axis=1)
            if not plain.all():  # characters without a piece
                known.update((p, self._pack(p)) for p, ok in zip(same, plain.tolist()) if not ok)
                same, codes = [p for p, ok in zip(same, plain.tolist()) if ok], codes[plain]
            if same:
                known.update(zip(same, self._pack_alike(codes.astype(np.int64))))

    def encode_many(self, texts: list[str], begin: bool = False, end: bool = False) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        lead = SPACE if self.prefix else ""
        find = self._parts.findall
        cut = [find(lead + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self._packed) >= REMEMBERED:  # what is still in use comes back from the older half
            self._older, self._packed = self._packed, _Remembered(self._pack)
        self._learn(set(chain.from_iterable(cut)).difference(self._packed))
        first = struct.pack("<I", self.bos) if begin else b""
        last = struct.pack("<I", self.eos) if end else b""
        packed = self._packed.__getitem__
        return [first + b"".join(map(packed, parts)) + last for parts in cut]

    def encode(self, text: str, begin: bool = False, end: bool = False) -> bytes:
        """``encode_many`` of one text."""
        return self.encode_many([text], begin, end)[0]

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become one U+FFFD each."""
        ids = np.frombuffer(packed, "<u4")
        if len(ids) and int(ids.max()) >= self.size:
            raise ValueError("an id is beyond the vocabulary")
        text = np.flatnonzero(~self.special[ids])
        if not len(text):
            return self._slow(ids.tolist())
        a, b = int(text[0]), int(text[-1]) + 1
        inner = ids[a:b].tolist()
        if b - a == len(text) and all(self.kind[i] == CONTROL for i in (*ids[:a].tolist(), *ids[b:].tolist())):
            try:
                whole = b"".join(map(self.raw.__getitem__, inner)).decode()
            except UnicodeDecodeError:
                return self._slow(ids.tolist())
            lead = self.prefix and self.kind[inner[0]] == NORMAL and whole.startswith(" ")
            return whole[1:] if lead else whole
        return self._slow(ids.tolist())

    def _slow(self, ids: list[int]) -> str:
        out: list[str] = []
        run = bytearray()
        fresh = self.prefix  # a leading space is still the dummy prefix

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[at: at + size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�")
                at += size
            run.clear()

        for i in ids:
            if self.kind[i] == BYTE:
                run += self.raw[i]
                continue
            flush()
            fresh = fresh and not any(out)
            if self.kind[i] == UNKNOWN:
                out.append(self.unk_text)
            elif self.kind[i] != CONTROL:
                piece = self.raw[i].decode()
                if fresh and piece.startswith(" "):
                    piece, fresh = piece[1:], False
                out.append(piece)
        flush()
        return "".join(out)


_loaded: dict[int, tuple] = {}


def _shared(spark, model_path: str):
    """The model file as a broadcast: a vocabulary, it does not grow with the data."""
    ship(spark)
    with open(model_path, "rb") as f:
        raw = f.read()
    PieceModel(raw)  # unsupported files fail here, not in a task
    return spark.sparkContext.broadcast(raw)


def _model(shared, check: bool) -> tuple:
    key = hash(shared.value)
    if key not in _loaded or (check and _loaded[key][1] is None):
        library = None
        if check:
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        _loaded.clear()
        _loaded[key] = PieceModel(shared.value), library
    return _loaded[key]


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
               begin: bool = True, end: bool = True, check: bool = False) -> DataFrame:
    """(id, n_tokens, ids, decoded[, library_agrees]) for every row of ``docs``.

    ``ids`` are packed little-endian unsigned 32-bit integers, ``decoded`` the
    text that they give back.  With ``check`` the sentencepiece library encodes
    each Arrow batch as well and ``library_agrees`` says whether its ids are the
    same.  Null and empty texts have no ids but begin and
    end.  Ids are carried as they are, repeated and null ones too; other
    columns are ignored; an empty table gives an empty table.
    """
    shared = _shared(docs.sparkSession, model_path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        model, library = _model(shared, check)
        for whole in batches:
            # a batch of long texts is taken apart, so that its results stay small
            step = max(1, min(whole.num_rows, (4 << 20) * whole.num_rows // max(1, whole.nbytes)))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                texts = batch.column(1).fill_null("").to_pylist()
                packed = model.encode_many(texts, begin, end)
                back = [model.decode(p) for p in packed]
                cols = [batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()),
                        pa.array(packed, pa.binary()), pa.array(back, pa.string())]
                if check:
                    ids = library.encode(texts, add_bos=begin, add_eos=end, num_threads=1)
                    cols.append(pa.array([struct.pack(f"<{len(i)}I", *i) == p for i, p in zip(ids, packed)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, names)

    names = ["id", "n_tokens", "ids", "decoded"] + ["library_agrees"] * check
    schema = f"id {kind}, n_tokens long, ids binary, decoded string" + ", library_agrees boolean" * check
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``rows`` with the text of their packed ids in ``out_col``; null ids give null."""
    shared = _shared(rows.sparkSession, model_path)

    def run(batches):
        model, _ = _model(shared, False)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            text = pa.array([None if p is None else model.decode(p) for p in col], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, out_col])

    if out_col in rows.columns:
        raise ValueError(f"column {out_col} exists")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())]))
