"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut at added tokens, then into pieces by the pattern of the byte
level pre-tokenizer. Each piece starts as one symbol a byte; a heap holds the
ranks of the adjacent pairs that can merge, and the pair of lowest rank,
leftmost on ties, is merged until none is left. The count of a piece is its
number of bytes less its number of merges. Symbols are known by the rank of
the merge that made them; no token identifier is looked up or emitted.

Cost is ``n log n`` in the length of a piece, so one piece without a space of
any length is fine. Counts of short pieces are remembered per task in a table
of bounded size. Scale: one narrow pass, no shuffle; the merges (a fixed file)
are broadcast.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the byte-level pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED_PIECES = 400_000
REMEMBERED_CHARS = 40


def byte_characters() -> dict[str, int]:
    """The byte each printable stand-in character of a byte-level vocabulary means."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Merges:
    """Merge ranks of a byte-level BPE file.

    Symbols 0 to 255 are bytes, symbol ``256 + r`` is the product of merge
    ``r`` (of the first such merge, if several make the same string).
    """

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True)
        if model["type"] != "BPE" or not plain or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE file")
        symbols: dict[str, int] = byte_characters()
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            product = symbols.setdefault(left + right, 256 + rank)
            self.ranks.setdefault(symbols[left] << 32 | symbols[right], (rank, product))
        self.added = [token["content"] for token in spec.get("added_tokens", [])]

    def count(self, piece: bytes) -> int:
        """Tokens of one piece."""
        n = len(piece)
        if n < 2:
            return n
        ranks = self.ranks
        symbol = list(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if found := ranks.get(symbol[i] << 32 | symbol[i + 1]):
                heap.append((found[0], i, found[1], symbol[i], symbol[i + 1]))
        heapq.heapify(heap)
        merged = 0
        while heap:
            _, i, product, left, right = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue  # one side has been merged meanwhile
            symbol[i], symbol[j] = product, -1
            merged += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := ranks.get(product << 32 | symbol[k]):
                    heapq.heappush(heap, (found[0], i, found[1], product, symbol[k]))
            h = before[i]
            if h >= 0 and (found := ranks.get(symbol[h] << 32 | product)):
                heapq.heappush(heap, (found[0], h, found[1], symbol[h], product))
        return n - merged


class _Known(dict):
    """Counts of short pieces; a missing one is computed."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.count = merges.count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece.encode())
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED_PIECES:
                self.clear()
            self[piece] = n
        return n


class Counter:
    """Counts whole texts; remembers the counts of short pieces."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.pieces = regex.compile(PATTERN).findall
        longest_first = sorted(merges.added, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first))).split if longest_first else None
        self.known = _Known(merges)

    def __call__(self, text: str) -> int:
        added = any(token in text for token in self.merges.added)
        parts = self.cut(text) if added else [text]
        count = self.known.__getitem__
        return len(parts) - 1 + sum(sum(map(count, self.pieces(part))) for part in parts)


def load_merges(path: str) -> Merges:
    with open(path, encoding="utf-8") as file:
        return Merges(json.load(file))


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    ``path``: the vocabulary file, read by the driver. ``docs`` needs
    ``doc_id`` and ``text``; other columns are not read. A null text counts as
    empty (0 tokens, not over the limit), a null ``doc_id`` stays null, and
    repeated rows are counted each; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_merges(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            counts = [counter(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size, F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
