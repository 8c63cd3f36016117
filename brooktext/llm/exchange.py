"""Meetings of equal hashes from all rows of a table, in packed rows.

A task hashes a slice of texts, sorts the entries by the upper bits of the
hash into buckets, and sends one packed row for each slice and bucket; one
task then sees all entries of a bucket. Before sending, a slice answers what
it can answer alone and sends one representative of an entry that many of its
rows share. So a hash that a third of all rows hold arrives as one entry a
slice, not one a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brooktext.llm.arrays import groups, mix, pack, unpack

WIRE = pa.schema(
    [
        ("bucket", pa.int32()),
        ("ids", pa.binary()),
        ("starts", pa.binary()),
        ("hashes", pa.binary()),  # null in a finished answer, whose bucket is that of its documents
        ("places", pa.binary()),
    ]
)
WIRE_DDL = "bucket int, ids binary, starts binary, hashes binary, places binary"
ANSWERS = "doc_id long, positions binary"


@dataclass
class Entries:
    """Hashes with the row (of the slice) and the word position they come from."""

    hashes: np.ndarray
    rows: np.ndarray
    positions: np.ndarray

    def take(self, index: np.ndarray) -> Entries:
        return Entries(self.hashes[index], self.rows[index], self.positions[index])


def send(entries: Entries, ids: np.ndarray, bits: int, keep: int) -> Iterator[tuple]:
    """Packed rows of a slice's entries; ``keep`` bytes of each hash go along.

    Entries come in the order of rows and positions. With 4 bytes kept beside
    the bucket's bits, two different hashes of a bucket meet by chance at a
    rate of its number of entries over 2**32, whatever the number of buckets
    (which grows with the data); with 8 bytes the whole hash is compared.
    """
    bucket = (entries.hashes >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    borders = np.append(groups(bucket[order]), len(order))
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        part = entries.take(order[a:b])
        first = groups(part.rows)
        if keep == 4:
            hashes = (part.hashes >> np.uint64(32 - bits)).astype(np.uint32)
        else:
            hashes = part.hashes
        yield (
            int(bucket[order[a]]),
            pack(ids[part.rows[first]]),
            pack(first.astype(np.uint32)),
            pack(hashes),
            pack(part.positions.astype(np.uint32)),
        )


def answer(doc_ids: np.ndarray, positions: np.ndarray, bits: int) -> Iterator[tuple]:
    """Finished answers, one packed row for each bucket of documents."""
    home = (mix(doc_ids.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((positions, doc_ids, home))
    home, doc_ids, positions = home[order], doc_ids[order], positions[order].astype(np.uint32)
    borders = np.append(groups(home), len(home))
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        first = groups(doc_ids[a:b])
        yield int(home[a]), pack(doc_ids[a:b][first]), pack(first.astype(np.uint32)), None, pack(positions[a:b])


def to_batches(rows: Iterator[tuple], size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), WIRE, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=WIRE)


Judge = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _entries(rows: list[tuple], dtype: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, documents and positions of packed rows; no hashes for answers."""
    hashes = [unpack(row[2], dtype) for row in rows if row[2] is not None]
    positions = [unpack(row[3], np.uint32) for row in rows]
    doc_ids = []
    for row, own in zip(rows, positions, strict=True):
        starts = unpack(row[1], np.uint32).astype(np.int64)
        doc_ids.append(np.repeat(unpack(row[0], np.int64), np.diff(np.append(starts, len(own)))))
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype), np.concatenate(doc_ids), np.concatenate(positions)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The packed rows of each bucket; batches come in order of bucket."""
    current, rows = None, []
    for batch in batches:
        for bucket, *row in zip(*[batch.column(name).to_pylist() for name in WIRE.names], strict=True):
            if bucket != current and rows:
                yield current, rows
                rows = []
            current = bucket
            rows.append(tuple(row))
    if rows:
        yield current, rows


def meet(packed: DataFrame, keep: int, bits: int, judge: Judge) -> DataFrame:
    """All entries of a bucket together: ``doc_id, positions`` of those ``judge`` picks.

    ``judge(hashes, doc_ids, positions)`` gets a bucket sorted by hash and
    returns a mask. The answers go through a second, smaller exchange by
    document, with those that a slice gave alone; every document that has any
    gets one row. A task holds one bucket at a time; the number of buckets
    follows the number of shuffle partitions.
    """
    dtype = np.uint32 if keep == 4 else np.uint64

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers() -> Iterator[tuple]:
            for bucket, rows in _by_bucket(batches):
                yield from ((bucket, *row) for row in rows if row[2] is None)
                asked = [row for row in rows if row[2] is not None]
                if asked:
                    hashes, doc_ids, positions = _entries(asked, dtype)
                    order = np.argsort(hashes, kind="stable")
                    chosen = order[judge(hashes[order], doc_ids[order], positions[order])]
                    yield from answer(doc_ids[chosen], positions[chosen], bits)

        return to_batches(answers())

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_bucket(batches):
            _, doc_ids, positions = _entries(rows, dtype)
            order = np.lexsort((positions, doc_ids))
            doc_ids, positions = doc_ids[order], positions[order]
            first = groups(doc_ids)
            borders = np.append(first, len(doc_ids)).tolist()
            packed = [pack(positions[a:b]) for a, b in zip(borders[:-1], borders[1:], strict=True)]
            columns = [pa.array(doc_ids[first], pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "positions"])

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket").sortWithinPartitions("bucket")

    return dealt(dealt(packed).mapInArrow(judged, WIRE_DDL)).mapInArrow(merged, ANSWERS)


def bucket_bits(df: DataFrame) -> int:
    """Bits that give at least one bucket for each shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4, (partitions - 1).bit_length())
