"""Burrows-Wheeler transforms of shards of strings, and their merge by interleave refinement.

Strings are read in words of a few bytes (``stride``), so a suffix is preceded by
the word that ends where it starts. A shard's suffixes are sorted once and give
its transform: for each suffix in order the word before it, and where the suffix
that starts with that word lies in the same order. Shards are merged without
sorting suffixes of different shards against each other: the interleave starts
with the shards one after the other, and each round puts it in the order of
the words before (a stable sort of one word each) and follows them back. After
``k`` rounds the interleave is right for the first ``k`` words, and a border
between neighbours that first shows in round ``k`` says how long a prefix they have in
common. Suffixes without an equal partner are finished: so are all that lead
back from them, and they leave the interleave.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Shards are at most about so large.
SHARD_BYTES = 16 << 10


@dataclass
class Strings:
    """Strings one after the other in ``data``, each followed by ``stride`` closing bytes that belong to none."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    stride: int

    @classmethod
    def of(cls, data: np.ndarray, lengths: np.ndarray, stride: int) -> Strings:
        lengths = lengths.astype(np.int64)
        starts = np.cumsum(lengths + stride) - (lengths + stride)
        padded = np.zeros(int((lengths + stride).sum()), dtype=np.uint8)
        shift = np.repeat(np.arange(len(lengths)) * stride, lengths)
        padded[np.arange(len(data)) + shift] = data
        return cls(padded, starts, lengths, stride)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths + self.stride)


def word_ranks(strings: Strings) -> np.ndarray:
    """The rank of the word at each place, from 1; 0 at the closing places."""
    stride, n = strings.stride, len(strings.data)
    tail = np.concatenate([strings.data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray((n,), dtype=">u8", buffer=tail, strides=(1,)).astype(np.uint64) >> np.uint64(64 - 8 * stride)
    closing = np.ones(n, dtype=bool)
    closing[np.arange(int(strings.lengths.sum())) + np.repeat(np.arange(len(strings.lengths)) * stride, strings.lengths)] = False
    order = np.argsort(words)
    in_order = words[order]
    ranks = np.empty(n, dtype=np.uint32)
    ranks[order] = np.cumsum(np.concatenate(([True], in_order[1:] != in_order[:-1])), dtype=np.uint32)
    ranks[closing] = 0
    return ranks


def stable_order(values: np.ndarray, most: int) -> np.ndarray:
    """Stable order of integers up to ``most``: each is packed with its place, and plain numbers are sorted."""
    n = len(values)
    if n <= 1 << 16 and most < 1 << 16:
        packed = (values.astype(np.uint32) << np.uint32(16)) | np.arange(n, dtype=np.uint32)
        packed.sort()
        return packed & np.uint32(0xFFFF)
    if n <= 1 << 16 and most < 1 << 48:
        packed = (values.astype(np.uint64) << np.uint64(16)) | np.arange(n, dtype=np.uint64)
        packed.sort()
        return packed & np.uint64(0xFFFF)
    if n <= 1 << 32 and most < 1 << 32:
        packed = (values.astype(np.uint64) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
        packed.sort()
        return packed & np.uint64(0xFFFFFFFF)
    return np.argsort(values, kind="stable")


def sort_shard(ranks: np.ndarray, ends: np.ndarray, stride: int, window: int) -> np.ndarray:
    """The order of a shard's suffixes by their first ``window`` bytes or more, by doubling.

    ``ends``: for each place the last closing place of its string.
    """
    key, step = ranks, 0
    places = np.arange(len(ranks))
    while True:
        most = int(key.max(initial=0))
        order = stable_order(key, most).astype(np.int64)
        in_order = key[order]
        new = np.concatenate(([False], in_order[1:] != in_order[:-1]))
        rank = np.empty(len(key), dtype=np.uint64)
        rank[order] = np.cumsum(new, dtype=np.uint64)
        different = int(new.sum()) + 1
        step = 2 * step if step else stride
        if step >= window or different >= len(key):
            return order
        key = rank * np.uint64(different) + rank[np.minimum(places + step, ends)]


@dataclass
class Transform:
    """A shard's transform, shards one after the other: places in order, the word before, and its suffix's number."""

    places: np.ndarray
    before: np.ndarray
    back: np.ndarray
    most: int  # the largest word


def transform(strings: Strings, ranks: np.ndarray, window: int) -> Transform:
    """The transforms of all shards of ``strings``; a shard is a run of whole strings."""
    stride = strings.stride
    owner = strings.owner()
    ends = (strings.starts + strings.lengths + stride - 1)[owner]
    # A suffix at the start of a string is preceded by nothing (word 0) and leads back to a closing place.
    places = np.arange(len(ranks))
    at_start = places < (strings.starts[owner] + stride)
    lead = np.where(at_start, places + strings.lengths[owner], places - stride)
    shard = (strings.starts // SHARD_BYTES)[owner]
    borders = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(ranks)]))
    order = np.empty(len(ranks), dtype=np.int64)
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        order[a:b] = a + sort_shard(ranks[a:b], ends[a:b] - a, stride, window)
    number = np.empty(len(ranks), dtype=np.int32)
    number[order] = places
    before = np.where(at_start, 0, ranks[lead]).astype(ranks.dtype)
    return Transform(order, before[order], number[lead[order]], int(ranks.max(initial=0)))


def merge(parts: Transform, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first ``rounds`` words with another: their places, and where each interval starts.

    The interleave is an array of suffix numbers; within a shard it never
    departs from the shard's own order but for equal prefixes.
    """
    interleave = np.arange(len(parts.places), dtype=np.int32)
    interval = np.zeros(len(interleave), dtype=np.int32)
    starts = np.zeros(0, dtype=np.int64)
    for _ in range(rounds):
        before = parts.before[interleave]
        order = stable_order(before, parts.most)
        before, interval = before[order], interval[order]
        interleave = parts.back[interleave[order]]
        border = np.ones(len(interleave) + 1, dtype=bool)
        np.not_equal(before[1:], before[:-1], out=border[1:-1])
        border[1:-1] |= interval[1:] != interval[:-1]
        # The common prefix of neighbours ends at a border; an interval of one suffix is finished.
        shared = ~(border[1:] & border[:-1])
        interval = np.cumsum(border[:-1], dtype=np.int32)[shared]
        interleave = interleave[shared]
        if not len(interleave):
            break
    if len(interleave):
        starts = np.flatnonzero(np.concatenate(([True], interval[1:] != interval[:-1])))
    return parts.places[interleave], starts


def repeated_places(data: np.ndarray, lengths: np.ndarray, weights: np.ndarray, window: int, stride: int) -> list[np.ndarray]:
    """For each string the places where a window starts that starts elsewhere too.

    ``weights``: how often each string stands for itself; a window in a string of weight two is repeated.
    """
    strings = Strings.of(data, lengths, stride)
    ranks = word_ranks(strings)
    found, starts = merge(transform(strings, ranks, window), window // stride)
    owner = strings.owner()
    last = strings.starts + strings.lengths - window
    whole = found <= last[owner[found]]
    often = np.zeros(len(strings.data), dtype=bool)
    if len(found):
        held = np.add.reduceat(np.where(whole, weights[owner[found]], 0), starts)
        each = np.diff(np.append(starts, len(found)))
        often[found[whole & (np.repeat(held, each) > 1)]] = True
    # A window alone in its interval left the merge; it is repeated if its string is.
    heavy = weights > 1
    out = []
    for k in range(len(lengths)):
        a = strings.starts[k]
        n = max(int(lengths[k]) - window + 1, 0)
        out.append(np.arange(n) if heavy[k] else np.flatnonzero(often[a : a + n]))
    return out
