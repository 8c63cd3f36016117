"""Benchmark passages in training documents: rare n-gram seeds and Smith-Waterman alignment.

Words are lower-cased (A-Z). Seeds are the rare word sequences of the test
items. A 3-word sequence is rare if ``FEW_ITEMS`` items or fewer hold it, or if
it brings together no more than ``PAIRS`` documents and items for each document
of the table (documents that hold it, counted over all of them, times items).
A sequence that is not rare is lengthened word by word, to both sides, until
it is, or has ``LONGEST`` words or the item ends. So a copy of which
``LONGEST`` words in a row are left as they were always holds a seed, and one
with three in a row does unless all such sequences are common among items.

A document that holds a seed is aligned around it with the whole item: a local
alignment of words (match 2, other word or gap -1). Its score must reach
``THRESHOLD`` of the best possible one, ``2 * item words``, or that of
``EXCERPT`` matched words, so excerpts of long items are found. Inserted,
dropped and changed words cost little, so edited copies are found too. An item
of fewer than ``MIN_ITEM_WORDS`` words must be held whole and unchanged.

Texts that share a seed by chance are ruled out by bounds that no alignment
exceeds: the best run of the text if each of its words that the item holds
anywhere were a match, and the same for the item.

Scale: two narrow passes over the documents (counts of the sequences that
several items hold, then alignments) for each block of items. A block has
about ``BLOCK_WORDS`` words, is broadcast, and is released before the next is
read, so the driver holds one block however long the benchmark is. Equal items
are aligned once. The documents are never shuffled, and a passage that many
documents hold is just many independent rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooktext.llm.arrays import Texts, Words, groups, lower_ascii, slices, split_words, window_hashes, word_hashes
from brooktext.sources.workspace import discard, materialize

SEED_WORDS = 3
LONGEST = 5
FEW_ITEMS = 4
PAIRS = 0.1
MIN_ITEM_WORDS = 8
THRESHOLD = 0.5
EXCERPT = 25
BLOCK_WORDS = 1_000_000
MATCH, OTHER, GAP = 2, -1, -1


def align(region: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and where in ``region`` it ends."""
    column = np.arange(len(region) + 1) * -GAP
    above = np.zeros(len(region) + 1, dtype=np.int64)
    best, end = 0, 0
    for word in item:
        step = np.zeros_like(above)
        step[1:] = above[:-1] + np.where(region == word, MATCH, OTHER)
        np.maximum(step, above + GAP, out=step)
        np.maximum(step, 0, out=step)
        # Gaps along the row: the best of all places to the left, less their distance.
        above = np.maximum.accumulate(step + column) - column
        top = int(above.argmax())
        if above[top] > best:
            best, end = int(above[top]), top
    return best, end


@dataclass
class Sequences:
    """Distinct hashes of sequences of ``width`` words, in order, and their places in items.

    The places of sequence ``g`` are ``item[borders[g]:borders[g + 1]]`` and
    ``position`` likewise.
    """

    width: int
    hashes: np.ndarray
    borders: np.ndarray
    item: np.ndarray
    position: np.ndarray
    maybe: np.ndarray

    @staticmethod
    def of(width: int, hashes: np.ndarray, item: np.ndarray, position: np.ndarray) -> Sequences:
        order = np.argsort(hashes, kind="stable")
        hashes, item, position = hashes[order], item[order], position[order]
        first = groups(hashes)
        maybe = np.zeros(1 << max(10, (16 * len(first)).bit_length()), dtype=bool)
        maybe[hashes[first] & np.uint64(len(maybe) - 1)] = True
        return Sequences(width, hashes[first], np.append(first, len(hashes)), item, position, maybe)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are known, and their numbers."""
        if not len(self.hashes):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at = np.flatnonzero(self.maybe[hashes & np.uint64(len(self.maybe) - 1)])
        number = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[number] == hashes[at]
        return at[same], number[same]


@dataclass
class Items:
    """Word hashes of different items; ``offsets`` are the borders of their words in ``hashes``."""

    keys: list[str]
    hashes: np.ndarray
    offsets: np.ndarray

    @staticmethod
    def of(keys: list[str], texts: list[str]) -> Items:
        kept, hashes, counts = [], [np.zeros(0, dtype=np.uint64)], [0]
        for part in slices(pa.array(texts, pa.string())):
            whole, split = _words(part)
            # Without two sequences to tell it by, an item is no evidence.
            long = split.counts >= SEED_WORDS
            kept += [keys[row] for row in np.array(part.rows)[long]]
            hashes.append(whole[np.repeat(long, split.counts)])
            counts += split.counts[long].tolist()
        return Items(kept, np.concatenate(hashes), np.cumsum(counts))

    def words(self, item: int) -> np.ndarray:
        return self.hashes[self.offsets[item] : self.offsets[item + 1]]

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        return window_hashes(self.hashes, Words(self.offsets[:-1], self.offsets[1:], self.offsets), width)

    def item_of(self, first: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, first, side="right") - 1

    def held(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By width, the sequences that more than ``FEW_ITEMS`` items hold, in order, and by how many."""
        told = {}
        for width in range(SEED_WORDS, LONGEST):
            hashes, first = self.windows(width)
            item = self.item_of(first)
            order = np.lexsort((item, hashes))
            hashes, item = hashes[order], item[order]
            new = np.ones(len(hashes), dtype=bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (item[1:] != item[:-1])
            distinct, items = np.unique(hashes[new], return_counts=True)
            told[width] = distinct[items > FEW_ITEMS], items[items > FEW_ITEMS]
        return told

    def seeds(self, common: dict[int, np.ndarray]) -> list[Sequences]:
        """The seeds of all items by width; ``common`` holds, by width, the hashes that are not rare."""
        told, wanted = [], None
        for width in range(SEED_WORDS, LONGEST + 1):
            hashes, first = self.windows(width)
            # Places by the first word; a place is wanted if a shorter common sequence lies in it.
            taken = np.ones(len(first), dtype=bool) if wanted is None else wanted[first]
            longer = np.isin(hashes, common[width]) & taken if width in common else np.zeros(len(first), dtype=bool)
            item = self.item_of(first)
            start, end = self.offsets[item], self.offsets[item + 1]
            stays = taken & ~(longer & (end - start > width))
            told.append(Sequences.of(width, hashes[stays], item[stays], (first - start)[stays]))
            wanted = np.zeros(len(self.hashes), dtype=bool)
            wanted[first[longer]] = True
            wanted[(first - 1)[longer & (first > start)]] = True
        return [sequences for sequences in told if len(sequences.hashes)]


def _words(texts: Texts) -> tuple[np.ndarray, Words]:
    """Hashes of the words of lower-case texts, and whose they are."""
    lowered = lower_ascii(texts)
    words = split_words(lowered)
    return word_hashes(lowered, words), words


def _least(words: np.ndarray, threshold: float) -> float:
    """The score that an alignment with an item must reach."""
    if len(words) < MIN_ITEM_WORDS:
        return MATCH * len(words)
    return min(threshold * MATCH * len(words), MATCH * EXCERPT)


def _most(words: np.ndarray, known: np.ndarray) -> int:
    """The score of the best run of ``words`` if each one that ``known`` (in order) holds were a match: no alignment has more."""
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    total = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(np.where(known[at] == words, MATCH, max(OTHER, GAP)), out=total[1:])
    return int((total - np.minimum.accumulate(total)).max())


def _aligned(texts: Texts, items: Items, seeds: list[Sequences], threshold: float) -> Iterator[tuple[int, int, float, int]]:
    """``row, item, score, end`` of the best alignment of each row and item that share a seed, where it is good enough."""
    hashes, split = _words(texts)
    offsets, hits = split.offsets, []
    for known_seeds in seeds:
        windows, first = window_hashes(hashes, split, known_seeds.width)
        at, seed = known_seeds.find(windows)
        places = np.diff(known_seeds.borders)[seed]
        start = np.repeat(known_seeds.borders[seed], places) + np.arange(places.sum()) - np.repeat(np.cumsum(places) - places, places)
        row = np.repeat(np.searchsorted(offsets, first[at], side="right") - 1, places)
        hits.append((row, known_seeds.item[start], np.repeat(first[at], places) - known_seeds.position[start]))
    if not hits:
        return
    row, item, diagonal = (np.concatenate(column) for column in zip(*hits, strict=True))
    if not len(row):
        return
    order = np.lexsort((diagonal, item, row))
    row, item, diagonal = row[order], item[order], diagonal[order]
    lengths = np.diff(items.offsets)
    known: dict[int, np.ndarray] = {}
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > lengths[item[1:]])
    border = np.append(np.flatnonzero(new), len(row))
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for a, b in zip(border[:-1], border[1:], strict=True):
        words = items.words(item[a])
        least = _least(words, threshold)
        # Each gap costs a point of the best possible score, so no alignment that reaches ``least`` drifts further.
        room = max(0, int(MATCH * len(words) - least)) + 1
        low = max(int(offsets[row[a]]), int(diagonal[a]) - room)
        high = min(int(offsets[row[a] + 1]), int(diagonal[b - 1]) + len(words) + room)
        region = hashes[low:high]
        if item[a] not in known:
            known[item[a]] = np.unique(words)
        if _most(region, known[item[a]]) < least or _most(words, np.unique(region)) < least:
            continue
        score, end = align(region, words)
        if score < least:
            continue
        told = (score / (MATCH * len(words)), low + end - int(offsets[row[a]]))
        key = (int(row[a]), int(item[a]))
        if key not in best or told[0] > best[key][0]:
            best[key] = told
    for (r, i), (score, end) in best.items():
        yield r, i, score, end


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, score, end_word``: documents that hold a copy of a benchmark item.

    One row for each such pair; ``score`` is the share of the best possible
    one, ``end_word`` the number of words before the end of the aligned part.
    ``docs`` needs ``doc_id, text``, ``benchmark`` needs ``item_id, text``;
    other columns are not read. A null text holds nothing; items of fewer than
    ``SEED_WORDS`` words are no evidence and are skipped; a row of null
    ``doc_id`` is reported under null; repeated rows and repeated items are
    reported each; the first of equal alignments counts; an empty table on
    either side gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    given = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    items = materialize(given.withColumn("item_key", F.sha2("text", 256)), "benchmark_items")
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).first()["n"] or 0
    blocks = int(-(-total // BLOCK_WORDS)) or 1
    found = [_contaminated_by(docs, items, block, blocks, threshold) for block in range(blocks)]
    keys = items.select("item_id", F.col("item_key").alias("own_key"))
    pairs = reduce(DataFrame.unionAll, found).join(keys, F.col("item_key") == F.col("own_key"))
    told = materialize(pairs.select("doc_id", "item_id", "score", "end_word"), "contaminated_pairs")
    discard(items, *found)
    return told


def _contaminated_by(docs: DataFrame, items: DataFrame, block: int, blocks: int, threshold: float) -> DataFrame:
    """``doc_id, item_key, score, end_word`` for the items of one block, staged."""
    own = items.where(F.pmod(F.xxhash64("item_key"), F.lit(blocks)) == block).select("item_key", "text").distinct()
    rows = own.orderBy("item_key").collect()
    known = Items.of([row["item_key"] for row in rows], [row["text"] for row in rows])
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((known, known.seeds(_common(docs, known))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, seeds = shared.value
        for batch in batches:
            ids, found = batch.column("doc_id"), []
            for texts in slices(batch.column("text")):
                for row, item, value, end in _aligned(texts, items, seeds, threshold):
                    found.append((ids[texts.rows[row]].as_py(), items.keys[item], value, end))
            if found:
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_key", "score", "end_word"])

    told = materialize(docs.mapInArrow(score, "doc_id long, item_key string, score double, end_word long"), "contaminated")
    shared.destroy()
    return told


def _common(docs: DataFrame, items: Items) -> dict[int, np.ndarray]:
    """By width, the hashes of the sequences of ``items`` that are not rare."""
    held = {width: found for width, found in items.held().items() if len(found[0])}
    if not held:
        return {}
    shared = docs.sparkSession.sparkContext.broadcast({w: Sequences.of(w, h, np.zeros_like(h), np.zeros_like(h)) for w, (h, _) in held.items()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts = 0, {w: np.zeros(len(known.hashes), dtype=np.int64) for w, known in shared.value.items()}
        for batch in batches:
            rows += batch.num_rows
            for texts in slices(batch.column("text")):
                hashes, split = _words(texts)
                for width, known in shared.value.items():
                    windows, first = window_hashes(hashes, split, width)
                    at, number = known.find(windows)
                    row = np.searchsorted(split.offsets, first[at], side="right") - 1
                    once = np.unique(row * len(known.hashes) + number) % max(1, len(known.hashes))
                    counts[width] += np.bincount(once, minlength=len(known.hashes))
        told = [(0, 0, rows)] + [(w, int(g), int(n[g])) for w, n in counts.items() for g in np.flatnonzero(n)]
        columns = [pa.array(c, t) for c, t in zip(zip(*told, strict=True), [pa.int32(), pa.int64(), pa.int64()], strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["width", "number", "n"])

    counted = docs.select("text").mapInArrow(count, "width int, number long, n long").groupBy("width", "number").agg(F.sum("n").alias("n"))
    docs_with = {w: np.zeros(len(h), dtype=np.int64) for w, (h, _) in held.items()}
    rows = 0
    for row in counted.collect():  # no more rows than sequences of the block
        if row["width"]:
            docs_with[row["width"]][row["number"]] = row["n"]
        else:
            rows = row["n"]
    shared.destroy()
    return {w: h[docs_with[w] * n > PAIRS * rows] for w, (h, n) in held.items()}


_TYPES = [pa.int64(), pa.string(), pa.float64(), pa.int64()]
