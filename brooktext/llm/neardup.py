"""Near-duplicate documents: b-bit MinHash signatures and a multi-index Hamming join.

A document's set is its distinct word shingles. Documents of equal sets are
one text from here on. A signature has 40 symbols of 16 bits, each the lowest
bits of a minimum over the set. Two signatures differ in few symbols if the
sets are similar. The join finds pairs by pigeonhole: signatures are cut into
8 chunks of 5 symbols, and two that differ in at most 15 symbols have a chunk
with at most one difference. Allowing for that one error by leaving out each
symbol of a chunk in turn, the pair shares one of 40 keys: the join misses no
pair within distance 15, and pairs of sets that are 0.8 similar or more share
a key with probability above 0.9999. Shared keys lead to exact comparison of
the full sets; see ``neighbours`` for how large groups are handled.

Scale: one pass over the texts for signatures (40 keys of 8 bytes for each
distinct set), one join to fetch the sets of those documents that share a key,
and joins of pairs with these sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooktext.llm.arrays import Texts, lower_ascii, mix, slices, split_words, whole_hashes, window_hashes, word_hashes
from brooktext.llm.neighbours import shared_keys, similar_components
from brooktext.sources.workspace import discard, materialize

CHUNKS, CHUNK = 8, 5
SYMBOLS = CHUNKS * CHUNK
# Words of 64 parity bits of a set, see ``parities``.
PARITY_WORDS = 32
_SEEDS = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def shingle_sets(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within each, and where each row's begin.

    A row with fewer words than ``width`` has its whole word sequence as one
    shingle, one without words has none.
    """
    lowered = lower_ascii(texts)
    words = split_words(lowered)
    hashes = word_hashes(lowered, words)
    shingles, first = window_hashes(hashes, words, width)
    rows = words.rows()[first] if len(first) else first
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    rows = np.concatenate([rows, short])
    shingles = np.concatenate([shingles, whole_hashes(hashes, words)[short]])
    order = np.lexsort((shingles, rows))
    rows, shingles = rows[order], shingles[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (shingles[1:] != shingles[:-1])
    return shingles[new], np.searchsorted(rows[new], np.arange(len(texts.rows) + 1))


def signatures(shingles: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """``[row, symbol]`` of the rows that have shingles."""
    filled = borders[:-1][np.diff(borders) > 0]
    out = np.empty((len(filled), SYMBOLS), dtype=np.uint16)
    for k, seed in enumerate(_SEEDS):
        values = (shingles ^ seed) * (seed | np.uint64(1))
        values ^= values >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(values, filled) & np.uint64(0xFFFF) if len(filled) else 0
    return out


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """The 40 keys of each signature: a chunk, less one of its symbols."""
    keys = []
    for chunk in range(CHUNKS):
        for left_out in range(CHUNK):
            used = [chunk * CHUNK + k for k in range(CHUNK) if k != left_out]
            value = np.zeros(len(symbols), dtype=np.uint64)
            for at in used:
                value = value << np.uint64(16) | symbols[:, at]
            keys.append(mix(value ^ np.uint64((chunk * CHUNK + left_out + 1) * 0x9E3779B97F4A7C15 % 2**64)))
    return np.stack(keys, axis=1)


def _sign(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, symbols``; equal sets have equal ``set_a, set_b, n_shingles``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                shingles, borders = shingle_sets(texts, width)
                sizes = np.diff(borders)
                sums = np.zeros((2, len(shingles) + 1), dtype=np.uint64)
                np.cumsum(mix(shingles), out=sums[0, 1:])
                np.cumsum(mix(shingles ^ _SEEDS[0]), out=sums[1, 1:])
                both = sums[:, borders[1:]] - sums[:, borders[:-1]]
                symbols = np.zeros((len(sizes), SYMBOLS), dtype=np.uint16)
                symbols[sizes > 0] = signatures(shingles, borders)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(texts.rows.start, len(texts.rows)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(both[0].view(np.int64)),
                        pa.array(both[1].view(np.int64)),
                        pa.array([row.tobytes() for row in symbols], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "symbols"],
                )

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, set_a long, set_b long, symbols binary")


def _keys(signed: DataFrame) -> DataFrame:
    """``id, keys``: the keys of each row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = b"".join(batch.column("symbols").to_pylist())
                keys = chunk_keys(np.frombuffer(raw, np.uint16).reshape(-1, SYMBOLS)).view(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, SYMBOLS, dtype=np.int32), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["id", "keys"])

    return signed.select("id", "symbols").mapInArrow(cut, "id long, keys array<long>")


def parities(shingles: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """``[row, word]``: each shingle toggles one of 2048 bits of its row.

    Two rows differ in at most as many bits as their sets differ in shingles,
    so the bits rule out pairs without ever losing one.
    """
    bits = 64 * PARITY_WORDS
    out = np.zeros((len(borders) - 1, PARITY_WORDS), dtype=np.int64)
    for first in range(0, len(out), 512):
        last = min(first + 512, len(out))
        rows = np.repeat(np.arange(last - first), np.diff(borders[first : last + 1]))
        at = (shingles[borders[first] : borders[last]] % np.uint64(bits)).astype(np.int64)
        odd = np.bincount(rows * bits + at, minlength=(last - first) * bits) & 1
        out[first:last] = np.packbits(odd.astype(np.uint8).reshape(-1, bits), axis=1).view(np.int64)
    return out


def _sets_of(docs: DataFrame, width: int) -> DataFrame:
    """``id, n, shingles, parity``: full sets as sorted packed hashes, their sizes and parity bits."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                shingles, borders = shingle_sets(texts, width)
                packed = [shingles[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:], strict=True)]
                words = parities(shingles, borders)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(texts.rows.start, len(texts.rows)),
                        pa.array(np.diff(borders)),
                        pa.array(packed, pa.binary()),
                        pa.array(list(words), pa.list_(pa.int64())),
                    ],
                    ["id", "n", "shingles", "parity"],
                )

    return docs.select("id", "text").mapInArrow(build, "id long, n long, shingles binary, parity array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("id_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("id_b"), F.col("shingles").alias("set_b"))
    joined = pairs.join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b"))
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Words are lower-cased (A-Z); two documents are linked if
    ``100 * common >= percent * union`` of their shingle sets, and a component
    is named after its smallest ``doc_id``, the one kept. ``docs`` needs
    ``doc_id, text``; other columns are not read. A null text or one without
    words has an empty set, is linked with nothing and kept; a row of null
    ``doc_id`` is linked with nothing, has a null component and is kept;
    repeated rows of a ``doc_id`` share its component and are each kept with
    it (ids are meant to be unique); no rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(_sign(docs, width), "signatures")
    equal = ["set_a", "set_b", "n_shingles"]
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    first = usable.groupBy(*equal).agg(F.min("doc_id").alias("id"), F.min("symbols").alias("symbols"))
    distinct = materialize(first, "distinct_sets")
    every = materialize(_keys(distinct).select(F.explode("keys").alias("key"), "id"), "keys")
    keys = shared_keys(every)
    discard(every)
    wanted = keys.select("id").distinct()
    texts = docs.join(wanted, F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id"])
    sets = materialize(_sets_of(texts.withColumnRenamed("doc_id", "id"), width), "sets")

    def near(left: str, right: str) -> Column:
        n, m = F.col(f"{left}n"), F.col(f"{right}n")
        words = range(PARITY_WORDS)
        differ = sum(F.bit_count(F.col(f"{left}p{k}").bitwiseXOR(F.col(f"{right}p{k}"))) for k in words)
        fits = F.least(n, m) * 100 >= F.greatest(n, m) * percent
        return fits & (differ * (100 + percent) <= (n + m) * (100 - percent))

    details = sets.select("id", "n", *[F.get("parity", F.lit(k)).alias(f"p{k}") for k in range(PARITY_WORDS)])
    found = similar_components(keys, details, near, lambda pairs: _confirm(pairs, sets, percent))
    discard(keys, sets)
    named = distinct.select(*equal, "id").join(found.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
    named = named.select(*[F.col(c).alias(f"same_{c}") for c in equal], F.coalesce("component", "id").alias("named"))
    same = F.lit(True)
    for c in equal:
        same = same & (F.col(c) == F.col(f"same_{c}"))
    joined = signed.join(named, same & F.col("doc_id").isNotNull(), "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.coalesce("named", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("named", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
