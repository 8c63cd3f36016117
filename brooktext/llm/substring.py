"""Removal of repeated passages: every window of words that an earlier document holds.

Method, fixed-block anchors. The reference index holds the non-overlapping
blocks of 7 words of every document; every rolling window of 7 words of every
document probes it. Two equal windows of 13 words always share a whole block
of either document, since 13 = 2 * 7 - 1, so each repeat has an anchor. Around
the anchors the hits are extended word by word: the windows of 13 words that
hold an anchor are compared with each other, and runs of windows that also
start in a document of smaller id merge to maximal exact repeats.

Scale. A word costs one packed probe entry (about 7 bytes) in the first
exchange. Only documents with an anchor take part in the second, with the
windows around their anchors. The text itself is shuffled twice, by
``doc_id``, to meet its anchors and its repeats. A passage that many documents
share is combined in each slice before it is sent (see ``exchange``); no pair
of documents is ever made. Each exchange ends in a staged table.

Windows are equal if their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooktext.llm import exchange
from brooktext.llm.arrays import Texts, Words, groups, slices, split_words, unpack, window_hashes, word_hashes
from brooktext.llm.exchange import Entries
from brooktext.sources.workspace import discard, materialize

WINDOW = 13


def _windows(texts: Texts, words: Words, width: int) -> Entries:
    hashes, first = window_hashes(word_hashes(texts, words), words, width)
    rows = words.rows()[first]
    return Entries(hashes, rows, first - words.offsets[rows])


def _probe_slice(texts: Texts, ids: np.ndarray, window: int, bits: int) -> Iterator[tuple]:
    """Probes of a slice; a block that two of its documents share is an anchor of both at once."""
    words = split_words(texts)
    entries = _windows(texts, words, (window + 1) // 2)
    long_enough = words.counts[entries.rows] >= window
    entries = entries.take(np.flatnonzero(long_enough))
    order = np.argsort(entries.hashes, kind="stable")
    first = groups(entries.hashes[order])
    size = np.diff(np.append(first, len(order)))
    rows = entries.rows[order]
    shared = rows[first] != rows[first + size - 1] if len(first) else np.zeros(0, bool)
    shared_entry = np.repeat(shared, size)
    # Where several documents hold the hash, the first entry stands for all; an aligned one if there is one.
    block = entries.positions[order] % ((window + 1) // 2) == 0
    rank = np.arange(len(order)) + np.where(block, 0, len(order))
    chosen = np.minimum.reduceat(rank, first) % max(len(order), 1) if len(first) else first
    send = ~shared_entry
    send[chosen[shared]] = True
    yield from exchange.answer(ids[rows[shared_entry]], entries.positions[order[shared_entry]], bits)
    yield from exchange.send(entries.take(np.sort(order[send])), ids, bits, keep=4)


def _anchored(block: int):
    def judge(hashes: np.ndarray, ids: np.ndarray, positions: np.ndarray) -> np.ndarray:
        first = groups(hashes)
        size = np.diff(np.append(first, len(hashes)))
        low, high = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
        indexed = np.maximum.reduceat(positions % block == 0, first)
        return np.repeat((low != high) & indexed, size)

    return judge


def _extend_slice(texts: Texts, ids: np.ndarray, anchors: list[np.ndarray], window: int, bits: int) -> Iterator[tuple]:
    """Windows around anchors. Those that an earlier document of the slice holds are answered here."""
    words = split_words(texts)
    entries = _windows(texts, words, window)
    marked = np.zeros(len(words.starts) + 1, dtype=np.int64)
    for row, at in enumerate(anchors):
        marked[words.offsets[row] + at + 1] = 1
    seen = np.cumsum(marked)
    start = words.offsets[entries.rows] + entries.positions
    entries = entries.take(np.flatnonzero(seen[start + window // 2 + 1] > seen[start]))
    if not len(entries.hashes):
        return
    owner = ids[entries.rows]
    order = np.argsort(entries.hashes, kind="stable")
    first = groups(entries.hashes[order])
    least = np.minimum.reduceat(owner[order], first)
    repeated = owner[order] > np.repeat(least, np.diff(np.append(first, len(order))))
    yield from exchange.answer(owner[order[repeated]], entries.positions[order[repeated]], bits)
    yield from exchange.send(entries.take(np.sort(order[~repeated])), ids, bits, keep=8)


def _repeated(hashes: np.ndarray, ids: np.ndarray, positions: np.ndarray) -> np.ndarray:
    first = groups(hashes)
    least = np.minimum.reduceat(ids, first)
    return ids > np.repeat(least, np.diff(np.append(first, len(hashes))))


def _positions(column: pa.Array, i: int) -> np.ndarray:
    """The packed positions of row ``i``; none for a null."""
    return unpack(column[i].as_py() or b"", np.uint32).astype(np.int64)


def _ids(batch: pa.RecordBatch, rows: range) -> np.ndarray:
    return batch.column("doc_id").slice(rows.start, len(rows)).to_numpy(zero_copy_only=False)


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, positions``: words at which a window starts that an earlier document also holds.

    A staged table with one row for each document that has any. ``docs``: ``doc_id, text``.
    """
    if window % 2 == 0:
        raise ValueError("the window must be odd: blocks are half of it, rounded up")
    bits = exchange.bucket_bits(docs)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for texts in slices(batch.column("text")):
                    yield from _probe_slice(texts, _ids(batch, texts.rows), window, bits)

        return exchange.to_batches(rows())

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                anchors = batch.column("anchors")
                for texts in slices(batch.column("text")):
                    own = [_positions(anchors, i) for i in texts.rows]
                    yield from _extend_slice(texts, _ids(batch, texts.rows), own, window, bits)

        return exchange.to_batches(rows())

    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    probes = known.mapInArrow(probe, exchange.WIRE_DDL)
    anchors = materialize(exchange.meet(probes, 4, bits, _anchored((window + 1) // 2)), "anchors")
    by_doc = anchors.select(F.col("doc_id").alias("anchor_doc"), F.col("positions").alias("anchors"))
    around = known.join(by_doc, F.col("doc_id") == F.col("anchor_doc"))
    windows = around.select("doc_id", "text", "anchors").mapInArrow(extend, exchange.WIRE_DDL)
    found = materialize(exchange.meet(windows, 8, bits, _repeated), "repeats")
    discard(anchors)
    return found


def _cut_slice(texts: Texts, starts: list[np.ndarray], window: int) -> Iterator[tuple]:
    words = split_words(texts)
    change = np.zeros(len(words.starts) + window + 1, dtype=np.int64)
    for row, at in enumerate(starts):
        first = words.offsets[row] + np.unique(at)
        change[first] += 1
        change[first + window] -= 1
    removed = np.cumsum(change)[: len(words.starts)] > 0
    data = texts.data.tobytes()
    for row in range(len(texts.rows)):
        a, b = words.offsets[row], words.offsets[row + 1]
        gone = removed[a:b]
        kept = np.flatnonzero(~gone) + a
        text = b" ".join([data[s:e] for s, e in zip(words.starts[kept].tolist(), words.ends[kept].tolist(), strict=True)])
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
        yield int(b - a), int(gone.sum()), text.decode(), edges.tolist()


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every document without the words covered by a window that an earlier document holds.

    Returns ``doc_id, n_words, n_removed, kept_text`` (kept words joined by
    one space) and ``repeats``, the maximal repeats as ``[start, end)`` word
    numbers one after the other. ``docs`` needs ``doc_id`` and ``text``; other
    columns are not read. Windows are judged on the input. A null text has no
    words and an empty ``kept_text``; texts below the window length lose
    nothing; a document of null id is compared with none and kept whole;
    equal rows of the same ``doc_id`` are not earlier than each other and come
    out alike (ids are meant to be unique); no rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = repeated_windows(docs, window)
    by_doc = found.select(F.col("doc_id").alias("found_doc"), F.col("positions").alias("starts"))
    joined = docs.join(by_doc, F.col("doc_id") == F.col("found_doc"), "left").select("doc_id", "text", "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column("starts")
            for texts in slices(batch.column("text")):
                rows = list(_cut_slice(texts, [_positions(starts, i) for i in texts.rows], window))
                n_words, n_removed, kept, repeats = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(texts.rows.start, len(texts.rows)),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.string()),
                        pa.array(repeats, pa.list_(pa.int32())),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_text", "repeats"],
                )

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string, repeats array<int>")
