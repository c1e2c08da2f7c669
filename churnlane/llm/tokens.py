"""Token counts by byte-pair merging with a heap over a linked list of symbols.

The count of a piece is its number of bytes less the number of merges: the
adjacent pair of lowest rank (leftmost on ties) is popped from a heap and
merged until no ranked pair is left.  No identifiers are produced.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.ship import ship

#: Fixed value: how the byte-level pre-tokenizer cuts a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct short pieces whose counts a task remembers; the memory is emptied when full.
REMEMBERED = 400_000
_SHORT = 48


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return table


class HeapBpe(dict):
    """Counts by piece; missing pieces are merged and, when short, remembered."""

    def __init__(self, spec: dict):
        super().__init__()
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and spec.get("normalizer") is None
                 and not model.get("dropout") and not model.get("ignore_merges")
                 and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
        if not plain:
            raise ValueError("only plain byte-level BPE tokenizers are supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or match single words are not supported")
        back = _byte_chars()

        def raw(symbol: str) -> bytes:
            return bytes(back[c] for c in symbol)

        number = {bytes([b]): b for b in range(256)}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            whole = number.setdefault(left + right, len(number))
            self.pairs.setdefault((number[left], number[right]), (rank, whole))
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pieces = regex.compile(PIECES)

    def merged(self, piece: bytes) -> int:
        """Symbols left of one piece."""
        pairs, ids, n = self.pairs, list(piece), len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            hit = pairs.get((ids[i], ids[i + 1]))
            if hit is not None:
                heap.append((hit[0], i, ids[i], ids[i + 1], hit[1]))
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two was merged meanwhile
            left -= 1
            ids[i], ids[j] = whole, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                hit = pairs.get((whole, ids[k]))
                if hit is not None:
                    heapq.heappush(heap, (hit[0], i, whole, ids[k], hit[1]))
            h = before[i]
            if h >= 0:
                hit = pairs.get((ids[h], whole))
                if hit is not None:
                    heapq.heappush(heap, (hit[0], h, ids[h], whole, hit[1]))
        return left

    def __missing__(self, piece: str) -> int:
        n = self.merged(piece.encode())
        if len(piece) <= _SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a text; each added token in it is one."""
        if self.added is None or not self.added.search(text):
            return sum(map(self.__getitem__, self.pieces.findall(text)))
        parts = self.added.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces.findall(p))) for p in parts)


_loaded: dict[int, HeapBpe] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``tokenizer_path`` is a byte-level BPE tokenizer file (.json), read on the
    driver and broadcast (a vocabulary, it does not grow with the data).  Null
    and empty texts have no tokens.  Ids are carried as they are, repeated and
    null ones too; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    HeapBpe(spec)  # unsupported files fail here, not in a task
    slim = {"model": spec["model"] | {"vocab": {}}, "pre_tokenizer": spec["pre_tokenizer"],
            "normalizer": spec["normalizer"], "added_tokens": spec["added_tokens"]}
    shared = spark.sparkContext.broadcast(json.dumps(slim))
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        key = shared.id if hasattr(shared, "id") else hash(shared.value)
        bpe = _loaded.get(key)
        if bpe is None:
            _loaded.clear()
            bpe = _loaded[key] = HeapBpe(json.loads(shared.value))
        for batch in batches:
            text = batch.column("text").fill_null("")
            tokens = [bpe.count(t.as_py()) for t in text]
            size = pc.cast(pc.binary_length(text.cast(pa.binary())), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), size, pa.array(tokens, pa.int64())],
                                             ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
