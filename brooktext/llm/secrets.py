"""Secrets in texts: fixed patterns, and a linear-chain conditional random field for the rest.

The patterns give the base spans, which always stay. The field tags tokens as
begin, inside or outside of a secret and is decoded by Viterbi; its spans are
added where no base span lies. Tokens are runs of letters, digits and
``_+/.-`` or runs of other marks. Features are the token's shape (length,
kinds of characters), the words and shapes beside it, and its shape together
with two features of the whole text (share of digits, rate of assignments).

The field learns from the base spans of a bounded sample: of about
``SAMPLE_DOCS`` texts those with a base span and one in 32 of the others, less
those with a key-like token, of which nobody has said that it is no secret. In
every second text it learns without the words, as those are what the patterns
look at; so it also learns what values look like after words that the patterns
do not list. Scale: one narrow pass; the
weights (``TABLE`` rows) are broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooktext.llm.arrays import Texts, mix, slices, span_hashes
from brooktext.llm.chains import viterbi
from brooktext.llm.crf import Model, SlotFeatures, bounded_sample, train
from brooktext.sources.workspace import discard, materialize

KINDS = ("assign", "access", "hex", "crf")
SAMPLE_DOCS = 20_000
SAMPLE_PARTITIONS = 12
TABLE = 1 << 16
SLOTS = 11
STATES = 3  # outside, begin, inside
SPANS = "array<struct<kind:string,start:int,end:int>>"

# The base patterns. They are ASCII, so they can be matched on UTF-8 bytes.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
KEYWORD = re.compile(rb"pass|secret|token|api", re.IGNORECASE)

_CLASS = np.full(256, 2, dtype=np.int8)  # 0 space, 1 word, 2 mark
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_CLASS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+/.-"]] = 1
_CLASS[128:] = 1
_ROOT = 0xC2B2AE3D27D4EB4F
_LENGTHS = np.array([2, 3, 5, 9, 13, 20, 28, 41])
_COARSE = np.array([9, 16, 24])


def base_spans(data: bytes) -> list[tuple[int, int, int, int]]:
    """``(kind, start, end, start of the value)`` of the base matches, in bytes.

    Runs below the length of their kind are dropped after matching. For
    ``access`` and ``hex`` the length can stand in the pattern, as a shorter
    run holds no longer one; for ``assign`` it cannot.
    """
    found = []
    if KEYWORD.search(data):
        for m in ASSIGN.finditer(data):
            if m.end(2) - m.start(2) >= 6:
                found.append((0, m.start(), m.end(), m.start(2)))
    found += [(1, m.start(), m.end(), m.start()) for m in ACCESS.finditer(data)]
    found += [(2, m.start(), m.end(), m.start()) for m in HEX.finditer(data)]
    return sorted(found, key=lambda span: (span[1], span[0]))


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


def split_tokens(texts: Texts) -> Tokens:
    kind = _CLASS[texts.data]
    change = np.ones(len(kind) + 1, dtype=bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[texts.offsets] = True
    borders = np.flatnonzero(change)
    starts, ends = borders[:-1], borders[1:]
    filled = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[filled], ends[filled]
    return Tokens(starts, ends, np.searchsorted(starts, texts.offsets))


def _beside(values: np.ndarray, rows: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` tokens further on in the same text, 0 beyond its ends."""
    out = np.zeros_like(values)
    if by < 0:
        same = rows[:by] == rows[-by:]
        out[-by:] = np.where(same, values[:by], 0)
    else:
        same = rows[by:] == rows[:-by]
        out[:-by] = np.where(same, values[by:], 0)
    return out


def token_features(texts: Texts, tokens: Tokens, hide_words: bool = False) -> SlotFeatures:
    """Features of all tokens; ``hide_words``: without words in every second text."""
    data, starts, ends = texts.data, tokens.starts, tokens.ends
    n = len(starts)
    if not n:
        return SlotFeatures(np.zeros((0, SLOTS), dtype=np.int32), tokens.offsets)
    rows = np.repeat(np.arange(len(texts.rows)), np.diff(tokens.offsets))
    capital = (data >= 65) & (data <= 90)
    lower = np.where(capital, data + np.uint8(32), data)
    digit = (data >= 48) & (data <= 57)
    small = (data >= 97) & (data <= 122)
    counts = {}
    for name, mask in (("digit", digit), ("capital", capital), ("small", small), ("hex", digit | (data >= 97) & (data <= 102))):
        sums = np.concatenate(([0], np.cumsum(mask)))
        counts[name] = sums[ends] - sums[starts]
        if name == "digit":
            digits_of_text = sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]
    size = ends - starts
    letters = counts["capital"] + counts["small"]
    coarse = ((np.searchsorted(_COARSE, size, side="right") * 2 + (counts["digit"] > 0)) * 2 + (letters > 0)).astype(np.uint64) + np.uint64(1)
    shape = np.searchsorted(_LENGTHS, size, side="right")
    for name in ("digit", "capital", "small"):
        shape = shape * 2 + (counts[name] > 0)
    plain = counts["digit"] + counts["capital"] + counts["small"]
    shape = (shape * 2 + (plain < size)) * 2 + (counts["hex"] == size)
    shape = shape * 4 + np.minimum(counts["digit"] * 4 // size, 3)
    shape = (shape * 2 + (_CLASS[data[starts]] == 2) + 1).astype(np.uint64)
    word = span_hashes(lower.astype(np.uint64) + np.uint64(1), starts, ends, _ROOT)

    length = np.maximum(np.diff(texts.offsets), 1)
    sums = np.concatenate(([0], np.cumsum((data == ord("=")) | (data == ord(":")))))
    assigns = sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]
    of_text = np.minimum(digits_of_text * 32 // length, 7) * 8 + np.minimum(assigns * 512 // length, 7)
    if hide_words:
        word = np.where(rows % 2 == 0, word, 0)
    mark = np.where(_CLASS[data[starts]] == 2, shape, 0)
    near = shape[:, None] * np.uint64(1 << 32)
    slots = [
        shape,
        word,
        _beside(word, rows, -1),
        _beside(word, rows, -2),
        _beside(word, rows, -3),
        _beside(word, rows, 1),
        near[:, 0] + _beside(shape, rows, -1),
        near[:, 0] + _beside(shape, rows, 1),
        near[:, 0] + of_text[rows].astype(np.uint64),
        coarse,
        coarse * np.uint64(1 << 32) + _beside(mark, rows, -1) * np.uint64(1 << 12) + _beside(mark, rows, -2),
    ]
    ids = [mix(slot * np.uint64(64) + np.uint64(k)) >> np.uint64(64 - 16) for k, slot in enumerate(slots)]
    return SlotFeatures(np.stack(ids, axis=1).astype(np.int32), tokens.offsets)


def _learned_features(texts: Texts) -> SlotFeatures:
    return token_features(texts, split_tokens(texts), hide_words=True)


def _weak_labels(texts: Texts, features: SlotFeatures, labels: list) -> np.ndarray:
    """Begin and inside for the tokens of base values, outside for all others."""
    tokens = split_tokens(texts)
    states = np.zeros(len(tokens.starts), dtype=np.int64)
    data = texts.data.tobytes()
    for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True):
        for _, _, end, value in base_spans(data[a:b]):
            first = int(np.searchsorted(tokens.ends, a + value, side="right"))
            last = int(np.searchsorted(tokens.starts, a + end))
            states[first:last] = 2
            states[first : first + 1] = 1
    return states


def learn_secrets(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    drawn = bounded_sample(known, "doc_id", sample_docs)
    assigns = r"(?i:pass(word|wd)|secret|token|api_?key)[\"']? *[:=]"
    hinted = F.col("text").rlike(f"{assigns}|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}")
    order = F.xxhash64("doc_id", "text")
    key_like = F.col("text").rlike("(?=[A-Za-z+_-]*[0-9])(?=[0-9+_-]*[A-Za-z])[A-Za-z0-9+_-]{20,}")
    drawn = drawn.where(hinted | ((F.pmod(order, F.lit(32)) == 0) & ~key_like))
    dealt = drawn.repartition(SAMPLE_PARTITIONS, order).sortWithinPartitions(order)
    staged = materialize(dealt.select("text", F.lit(0).alias("label")), "secret_sample")
    model = train(staged, _learned_features, _weak_labels, TABLE, STATES)
    discard(staged)
    return model


def _found(texts: Texts, model: Model) -> Iterator[tuple[list, list]]:
    tokens = split_tokens(texts)
    features = token_features(texts, tokens)
    states = viterbi(features.emissions(model.weights), tokens.offsets, model.transitions, model.initial)
    raw = texts.data.tobytes()
    points = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))  # code points before each byte
    tagged = np.flatnonzero(states)
    row_of = np.searchsorted(tokens.offsets, tagged, side="right") - 1
    by_row: dict[int, list[list[int]]] = {}
    for token, row in zip(tagged.tolist(), row_of.tolist(), strict=True):
        spans = by_row.setdefault(row, [])
        if states[token] == 2 and spans and spans[-1][2] == token - 1:
            spans[-1][1:] = [int(tokens.ends[token]), token]
        else:
            spans.append([int(tokens.starts[token]), int(tokens.ends[token]), token])
    for row in range(len(texts.rows)):
        a, b = int(texts.offsets[row]), int(texts.offsets[row + 1])
        base = base_spans(raw[a:b])
        added = [
            (3, start - a, end - a)
            for start, end, _ in by_row.get(row, [])
            if not any(start - a < hit[2] and hit[1] < end - a for hit in base)
        ]

        def in_points(spans: list, a: int = a) -> list[dict]:
            at = points[a]
            return [{"kind": KINDS[k], "start": int(points[a + s] - at), "end": int(points[a + e] - at)} for k, s, e in spans]

        yield in_points([hit[:3] for hit in base]), in_points(added)


def find_secrets(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, base, added`` of every row: spans of the patterns and spans that the field adds.

    Spans are ``kind, start, end`` in code points, end exclusive, by start,
    then kind. ``docs`` needs ``doc_id`` and ``text``; other columns are not
    read. A null text counts as empty and has no span; rows of null ``doc_id``
    are searched but not learned from; repeated rows are searched each; no
    rows give no rows. Without any base span to learn from nothing is added.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(learn_secrets(docs, sample_docs))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for texts in slices(batch.column("text")):
                base, added = zip(*_found(texts, shared.value), strict=True)
                ids = batch.column("doc_id").slice(texts.rows.start, len(texts.rows))
                yield pa.RecordBatch.from_arrays([ids, pa.array(base, kind), pa.array(added, kind)], ["doc_id", "base", "added"])

    return docs.mapInArrow(search, f"doc_id long, base {SPANS}, added {SPANS}")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, by start, then kind as listed, comma-joined."""
    listed = F.array(*[F.lit(kind) for kind in KINDS])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(listed, s["kind"]).alias("rank"),
            s["end"].alias("end"),
            F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")).alias("told"),
        ),
    )
    return F.array_join(F.transform(F.sort_array(keyed), lambda s: s["told"]), ",")
