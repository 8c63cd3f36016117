"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

Method. Shards of text get a Burrows-Wheeler transform each; transforms are
merged by interleave refinement, which yields common prefixes and intervals of
equal ones without sorting suffixes of different shards against each other
(see ``bwt``). Every byte covered by a window of an interval of two or more goes.

Scale. One merge over the whole corpus would be one task. Windows are therefore
dealt to buckets by their minimiser, the smallest hash of the 32-byte strings in
them: equal windows have equal minimisers, so all places of a window meet in
one bucket, and each bucket is merged by itself. Consecutive windows of one
minimiser travel as one piece. Pieces are first grouped by minimiser and content
hash on narrow rows, without their text: a piece whose minimiser occurs once
goes nowhere, equal pieces go as one with a weight. Buckets are numbered by the
bytes to be merged, so their size does not depend on the data. A minimiser with
more different pieces than ``MOST_PIECES`` (a line in a third of all documents,
with other text around it) is split by further minimisers of the same windows,
level by level; on the last level a window is a piece of its own, and equal
ones are one. Equal documents are one document with a count.

Pieces are told apart by two 64-bit hashes, documents by their MD5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooktext.llm.arrays import _BYTE_ROOT, _BYTE_VALUES, Texts, groups, mix, slices, span_hashes
from brooktext.llm.bwt import repeated_places
from brooktext.sources.workspace import discard, materialize

WINDOW = 200
GRAM = 32
# Windows in a piece; longer runs of one minimiser (text of a short period) are cut.
MOST_WINDOWS = 256
# Different pieces of one minimiser that are merged in one task; more are split further, on so many levels.
MOST_PIECES = 4096
LEVELS = 3
# Bytes of pieces for one merge.
BUCKET_BYTES = 40 << 10
# Texts are hashed in stretches of so many bytes.
STRETCH = 512 << 10

PIECE = "doc binary, weight long, start long, windows int, held int, key long, content long"
SPLIT = "parent_key long, parent_content long, start long, windows int, held int, key long, content long, weight long, text binary"
FOUND = "key long, content long, runs array<struct<first:int,last:int>>"
_LEVEL = np.uint64(0x9FB21C651E98DF25)


# --- windows and their minimisers -----------------------------------------------


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of each ``width`` neighbours, doubling the width as far as it goes."""
    n, reach, out = len(values) - width + 1, 1, values
    while 2 * reach <= width:
        out = best(out[:-reach], out[reach:])
        reach *= 2
    return best(out[:n], out[width - reach : width - reach + n])


def _pieces(data: np.ndarray, offsets: np.ndarray, window: int, gram: int, level: int, most: int) -> tuple[np.ndarray, ...]:
    """Row, place in ``data``, windows, minimiser, occurrences of it and content hash of all pieces."""
    nothing = tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    if len(data) < window:
        return nothing
    values = _BYTE_VALUES[data]
    at = slice(0, len(data) - gram + 1), slice(gram, len(data) + 1)
    hashes = span_hashes(values, *at, _BYTE_ROOT, np.full(1, gram, dtype=np.uint64))
    if level:
        hashes = mix(hashes ^ (np.uint64(level) * _LEVEL))
    width = window - gram + 1
    least = _sliding(hashes, width, np.minimum)
    # A run: windows one after the other, in one text, of one minimiser; long ones are cut.
    n = len(least)
    new = np.ones(n, dtype=bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[offsets[:-1][offsets[:-1] < n]] = True
    outside = np.zeros(n + 1, dtype=np.int32)
    ends = offsets[1:] - window + 1
    np.add.at(outside, np.clip(np.maximum(ends, offsets[:-1]), 0, n), 1)
    np.add.at(outside, np.minimum(offsets[1:], n), -1)
    inside = np.cumsum(outside[:-1]) == 0
    new[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, n))
    first, windows = first[inside[first]], windows[inside[first]]
    if not len(first):
        return nothing
    cuts = -(-windows // most)
    part = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    start = np.repeat(first, cuts) + part * most
    windows = np.minimum(np.repeat(windows, cuts) - part * most, most)
    of = np.searchsorted(offsets, start, side="right") - 1
    minimiser = least[start]
    # Grams that are the minimiser of some window, and how many of each piece's own it holds.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    candidates = np.flatnonzero(_sliding(padded, width, np.maximum) == hashes)
    a = np.searchsorted(candidates, start)
    b = np.searchsorted(candidates, start + windows + width - 1)
    each = b - a
    index = np.repeat(a - (np.cumsum(each) - each), each) + np.arange(each.sum())
    same = hashes[candidates[index]] == np.repeat(minimiser, each)
    held = np.bincount(np.repeat(np.arange(len(a)), each), weights=same, minlength=len(a)).astype(np.int64)
    content = span_hashes(values, start, start + windows + window - 1, _BYTE_ROOT)
    return of, start, windows, held, minimiser.view(np.int64), content.view(np.int64)


def _stretches(texts: Texts, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``data, offsets, shift``: a slice as it is, one very long text in overlapping stretches."""
    if len(texts.rows) > 1 or len(texts.data) <= STRETCH:
        yield texts.data, texts.offsets, 0
        return
    for first in range(0, len(texts.data) - window + 1, STRETCH):
        part = texts.data[first : first + STRETCH + window - 1]
        yield part, np.array([0, len(part)]), first


def _document_pieces(long_texts: DataFrame, window: int, gram: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text"), STRETCH):
                for data, offsets, shift in _stretches(texts, window):
                    of, start, windows, held, key, content = _pieces(data, offsets, window, gram, 0, MOST_WINDOWS)
                    rows = pa.array(of + texts.rows.start)
                    columns = [
                        *[batch.column(name).take(rows) for name in ("doc", "copies")],
                        pa.array(start - offsets[of] + shift),
                        *[pa.array(v.astype(np.int32)) for v in (windows, held)],
                        *[pa.array(v) for v in (key, content)],
                    ]
                    yield pa.RecordBatch.from_arrays(columns, [part.split(" ")[0] for part in PIECE.split(", ")])

    return long_texts.select("doc", "copies", "text").mapInArrow(cut, PIECE)


def _binary(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The stretches of ``data`` as an Arrow column."""
    ends = np.cumsum(lengths)
    index = np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data[index])])


# --- from pieces to the places of repeated windows ------------------------------


def _shared(pieces: DataFrame, name: str) -> DataFrame:
    """The pieces whose minimiser occurs twice, all others are repeated nowhere; a staged table."""
    by_key = pieces.groupBy(F.col("key").alias("of_key")).agg(F.sum("weight").alias("total"), F.max("held").alias("most"))
    shared = materialize(by_key.where("total > 1 OR most > 1").select("of_key"), "shared_minimisers")
    kept = materialize(pieces.join(shared, F.col("key") == F.col("of_key"), "left_semi"), name)
    discard(shared)
    return kept


def _judged(grouped: DataFrame, name: str) -> DataFrame:
    """Different pieces with ``hot``, whether their minimiser has too many of them; a staged table."""
    pieces = materialize(grouped, name)
    by_key = pieces.groupBy(F.col("key").alias("of_key")).agg((F.count("*") > MOST_PIECES).alias("hot"))
    judged = materialize(pieces.join(by_key, F.col("key") == F.col("of_key")).drop("of_key"), name)
    discard(pieces)
    return judged


def _texts_of(pieces: DataFrame, long_texts: DataFrame, window: int) -> DataFrame:
    """``key, content, weight, text`` of pieces (``doc, start, windows``) cut out of their documents."""
    place = F.struct("start", "windows", "key", "content", "weight")
    by_doc = pieces.groupBy(F.col("doc").alias("of_doc")).agg(F.collect_list(place).alias("places"))
    joined = long_texts.join(by_doc, F.col("doc") == F.col("of_doc")).select("text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("places")
            for texts in slices(batch.column("text")):
                own = lists.slice(texts.rows.start, len(texts.rows))
                at, of = own.flatten(), np.repeat(np.arange(len(texts.rows)), own.value_lengths().to_numpy())
                start, windows = at.field("start").to_numpy(), at.field("windows").to_numpy()
                # Columns of about a slice each, so that no batch outgrows the pieces of a few texts.
                lengths = windows.astype(np.int64) + window - 1
                for a in range(0, len(of), 4096):
                    b = slice(a, a + 4096)
                    cut_out = _binary(texts.data, texts.offsets[of[b]] + start[b], lengths[b])
                    columns = [*[at.field(c).slice(a, 4096) for c in ("key", "content", "weight")], cut_out]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "content", "weight", "text"])

    return joined.mapInArrow(cut, "key long, content long, weight long, text binary")


def _merged(strings: DataFrame, total_bytes: int, window: int, stride: int) -> DataFrame:
    """``key, content, runs``: runs of repeated windows ``[first, last)`` in each piece that has any."""
    buckets = max(1, -(-total_bytes // BUCKET_BYTES))

    def judge(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        text = table.column("text").combine_chunks()
        lengths = pc.binary_length(text).to_numpy()
        data = np.frombuffer(b"".join(text.to_pylist()), np.uint8)
        places = repeated_places(data, lengths, table.column("weight").to_numpy(), window, stride)
        keys, contents, runs = [], [], []
        key, content = table.column("key").to_numpy(), table.column("content").to_numpy()
        for k, at in enumerate(places):
            if len(at):
                cuts = np.flatnonzero(np.diff(at) > 1)
                first, last = at[np.append(0, cuts + 1)], at[np.append(cuts, len(at) - 1)] + 1
                keys.append(key[k])
                contents.append(content[k])
                runs.append([{"first": int(a), "last": int(b)} for a, b in zip(first, last, strict=True)])
        run = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        columns = [pa.array(keys, pa.int64()), pa.array(contents, pa.int64()), pa.array(runs, run)]
        return pa.RecordBatch.from_arrays(columns, ["key", "content", "runs"])

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            borders = np.append(groups(bucket), len(bucket))
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
                if bucket[a] != current and held:
                    yield judge(held)
                    held = []
                current = bucket[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield judge(held)

    dealt = strings.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(by_bucket, FOUND)


def _split_further(strings: DataFrame, level: int, window: int, gram: int) -> DataFrame:
    """The pieces of pieces, by the minimisers of another level; on the last, every window is a piece of its own."""
    last = level > LEVELS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent = batch.column("key").to_numpy()
            for texts in slices(batch.column("text")):
                of, start, windows, held, key, content = _pieces(texts.data, texts.offsets, window, gram, level, 1 if last else MOST_WINDOWS)
                rows = pa.array(of + texts.rows.start)
                key = content if last else mix(parent[of + texts.rows.start].view(np.uint64) * _LEVEL + key.view(np.uint64)).view(np.int64)
                columns = [
                    batch.column("key").take(rows),
                    batch.column("content").take(rows),
                    pa.array(start - texts.offsets[of]),
                    *[pa.array(v.astype(np.int32)) for v in (windows, held)],
                    *[pa.array(v) for v in (key, content)],
                    batch.column("weight").take(rows),
                    _binary(texts.data, start, windows + window - 1),
                ]
                yield pa.RecordBatch.from_arrays(columns, [part.split(" ")[0] for part in SPLIT.split(", ")])

    return strings.mapInArrow(cut, SPLIT)


def _placed(parts: DataFrame, found: DataFrame, *by: str) -> DataFrame:
    """Runs of pieces put at the places of ``parts``: ``by, runs``."""
    run = F.struct((F.col("start") + F.col("r.first")).alias("first"), (F.col("start") + F.col("r.last")).alias("last"))
    theirs = found.select(F.col("key").alias("of_key"), F.col("content").alias("of_content"), "runs")
    joined = parts.join(theirs, (F.col("key") == F.col("of_key")) & (F.col("content") == F.col("of_content")))
    return joined.select(*by, F.explode("runs").alias("r"), "start").groupBy(*by).agg(F.collect_list(run).alias("runs"))


def _places(pieces: DataFrame, strings_of, level: int, window: int, gram: int, stride: int) -> DataFrame:
    """``key, content, runs`` of judged pieces; hot ones by way of the next level."""
    size = pieces.groupBy("hot").agg(F.sum(F.col("windows") + (window - 1)).alias("bytes")).collect()
    size = {row.hot: row.bytes for row in size}
    found = materialize(_merged(strings_of(pieces.where("NOT hot")), size.get(False) or 0, window, stride), "repeats")
    if not size.get(True):
        return found
    every = materialize(_split_further(strings_of(pieces.where("hot")), level + 1, window, gram), "split_pieces")
    split = _shared(every, "split_pieces")
    discard(every)
    grouped = split.groupBy("key", "content").agg(
        F.sum("weight").alias("weight"), F.max("held").alias("held"), F.max("windows").alias("windows"), F.first("text").alias("text")
    )
    below = _judged(grouped, "split_judged")
    deeper = _places(below, lambda wanted: wanted.select("key", "content", "weight", "text"), level + 1, window, gram, stride)
    parents = _placed(split, deeper, "parent_key", "parent_content")
    run = F.transform("runs", lambda r: F.struct(r["first"].cast("int").alias("first"), r["last"].cast("int").alias("last")))
    whole = found.unionByName(parents.select(F.col("parent_key").alias("key"), F.col("parent_content").alias("content"), run.alias("runs")))
    whole = materialize(whole, "repeats")
    discard(found, split, below, deeper)
    return whole


def _cut_out(judged: DataFrame, window: int) -> DataFrame:
    """``doc, n_removed, n_spans, kept`` of ``doc, text, runs``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("runs")
            for texts in slices(batch.column("text")):
                own = lists.slice(texts.rows.start, len(texts.rows))
                lengths = np.array([len(x) if x is not None else 0 for x in own.to_pylist()] if own.null_count else own.value_lengths().to_numpy())
                at = own.flatten()
                base = texts.offsets[:-1][np.repeat(np.arange(len(lengths)), lengths)]
                change = np.zeros(len(texts.data) + 1, dtype=np.int32)
                np.add.at(change, base + at.field("first").to_numpy(), 1)
                np.add.at(change, base + at.field("last").to_numpy() + window - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = gone.copy()
                edge[1:] &= ~gone[:-1]
                inner = texts.offsets[:-1][texts.offsets[:-1] < len(gone)]
                edge[inner] = gone[inner]
                total = np.concatenate(([0], np.cumsum(gone)))[texts.offsets]
                spans = np.concatenate(([0], np.cumsum(edge)))[texts.offsets]
                kept = np.flatnonzero(~gone)
                offsets = (texts.offsets - total).astype(np.int32)
                raw = pa.py_buffer(texts.data[kept])
                columns = [
                    batch.column("doc").slice(texts.rows.start, len(texts.rows)),
                    pa.array(np.diff(total).astype(np.int64)),
                    pa.array(np.diff(spans).astype(np.int64)),
                    pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), raw]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "n_removed", "n_spans", "kept"])

    return judged.select("doc", "text", "runs").mapInArrow(cut, "doc binary, n_removed long, n_spans long, kept binary")


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row of ``docs`` (``doc_id``, ``text``).

    A byte goes if a string of ``window`` bytes that covers it starts at
    another place too, in any document or the same one; matches lie within
    one document, overlaps count, and strings are judged on the input. ``kept``
    is binary, as a cut may fall inside a character. A null text is empty; a
    text shorter than ``window`` loses nothing; rows of equal text, whatever
    their ids, repeat each other whole; null and repeated ids are kept as they
    are; other columns are not read; no rows give no rows.
    """
    stride = next(k for k in (8, 4, 2, 1) if window % k == 0)
    if not 8 <= gram < window:
        raise ValueError("a gram must be shorter than the window, and of 8 bytes at least")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.octet_length(text).cast("long")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), size.alias("n_bytes"))
    whole = F.unhex(F.md5(F.col("text")))
    rows = known.select(
        "doc_id", "n_bytes", F.when(F.col("n_bytes") >= window, whole).alias("of_doc"),
        F.when(F.col("n_bytes") < window, F.encode("text", "UTF-8")).alias("short"),
    )
    rows = materialize(rows, "rows")
    texts = known.where(F.col("n_bytes") >= window).select(whole.alias("doc"), "text")
    texts = materialize(texts.groupBy("doc").agg(F.first("text").alias("text"), F.count("*").alias("copies")), "texts")

    every = materialize(_document_pieces(texts, window, gram), "pieces")
    parts = _shared(every, "pieces")
    discard(every)
    one = F.min(F.struct("doc", "start"))
    grouped = parts.groupBy("key", "content").agg(
        F.sum("weight").alias("weight"), F.max("held").alias("held"), F.max("windows").alias("windows"), one.alias("one")
    )
    judged = _judged(grouped.select("key", "content", "weight", "held", "windows", "one.doc", "one.start"), "judged_pieces")
    found = _places(judged, lambda wanted: _texts_of(wanted, texts, window), 0, window, gram, stride)
    runs = _placed(parts, found, "doc").withColumnRenamed("doc", "cut_doc")
    runs = materialize(runs, "runs")
    discard(parts, judged, found)
    cut = _cut_out(texts.join(runs, F.col("doc") == F.col("cut_doc"), "left"), window)
    cut = materialize(cut, "cut_texts")
    discard(texts, runs)
    joined = rows.join(cut, F.col("of_doc") == F.col("doc"), "left")
    return joined.select(
        "doc_id", "n_bytes",
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("n_removed", "n_spans")],
        F.coalesce("short", "kept").alias("kept"),
    )
