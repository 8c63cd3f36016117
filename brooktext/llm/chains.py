"""Linear chains over many sequences at once: forward-backward and Viterbi.

Scores are products of emission and transition weights. Sequences are cut into
blocks of 32 steps; the transfer matrices of all blocks are built side by
side, a short pass links the blocks of each sequence, and all blocks are then
filled side by side. The result is that of the plain recursion, in numpy
steps that do not grow with the number of sequences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 32
RESCALE = 4  # steps between two rescalings; the factors of one step stay above exp(-120)


def _sum_step(t: np.ndarray, a: np.ndarray) -> np.ndarray:
    return (t @ a.reshape(len(t), -1)).reshape(a.shape)


def _max_step(t: np.ndarray, a: np.ndarray) -> np.ndarray:
    out = np.empty_like(a)
    for to in range(len(t)):
        np.multiply(t[to, 0], a[0], out=out[to])
        for at in range(1, len(t)):
            np.maximum(out[to], t[to, at] * a[at], out=out[to])
    return out


def _rescale(a: np.ndarray, axes: tuple[int, ...] = (0,)) -> None:
    top = a.max(axis=axes, keepdims=True)
    np.divide(a, top, out=a, where=top > 0)


def _weights(scores: np.ndarray, axis: int | None = None) -> np.ndarray:
    """Scores as factors; 60 below the best counts as 60, so nothing underflows."""
    return np.exp(np.maximum(scores - scores.max(axis=axis, keepdims=True), -60.0))


@dataclass
class Messages:
    """Factors and messages of all steps, states first."""

    emissions: np.ndarray
    transitions: np.ndarray
    forward: np.ndarray
    backward: np.ndarray

    def marginals(self) -> np.ndarray:
        both = self.forward * self.backward
        return (both / both.sum(axis=0)).T

    def pair_counts(self, offsets: np.ndarray) -> np.ndarray:
        """Expected number of each transition inside the sequences."""
        n = self.forward.shape[1]
        inner = np.ones(max(n - 1, 0), dtype=bool)
        inner[offsets[(offsets > 0) & (offsets < n)] - 1] = False
        a = self.forward[:, :-1][:, inner]
        b = (self.emissions[:, 1:] * self.backward[:, 1:])[:, inner]
        total = (a * (self.transitions @ b)).sum(axis=0)
        return (a / total) @ b.T * self.transitions


def messages(
    emissions: np.ndarray, offsets: np.ndarray, transitions: np.ndarray, initial: np.ndarray, best_path: bool = False
) -> Messages:
    """Forward and backward messages; sequence ``i`` is steps ``offsets[i]:offsets[i + 1]``.

    All scores are logarithms: ``emissions[step, state]``, ``transitions[from, to]``.
    """
    forth = _max_step if best_path else _sum_step
    n, states = emissions.shape
    e = np.ascontiguousarray(_weights(emissions, 1).T) if n else np.zeros((states, 0))
    t, pi = _weights(transitions), _weights(initial)
    if n == 0:
        return Messages(e, t, e, e)
    to_next, to_last = np.ascontiguousarray(t.T), np.ascontiguousarray(t)
    lengths = np.diff(offsets)
    per = -(-lengths // BLOCK)  # blocks of each sequence
    block_first = np.concatenate(([0], np.cumsum(per)))
    total = int(block_first[-1])
    sequence = np.repeat(np.arange(len(lengths)), per)
    begin = offsets[sequence] + (np.arange(total) - block_first[sequence]) * BLOCK
    size = np.minimum(BLOCK, offsets[sequence + 1] - begin)
    # Long blocks first, so that those still running at a step are a leading part.
    order = np.argsort(-size, kind="stable")
    place = np.empty(total, dtype=np.int64)
    place[order] = np.arange(total)
    begin, size = begin[order], size[order]
    running = [int(np.searchsorted(-size, -step, side="left")) for step in range(BLOCK)]
    steps = np.minimum(begin[None, :] + np.arange(BLOCK)[:, None], n - 1)
    e_by_step = [e[:, steps[step, :k]] for step, k in enumerate(running)]

    transfer = np.zeros((states, states, total))  # to, from, block
    for state in range(states):
        transfer[state, state] = e_by_step[0][state]
    for step in range(1, BLOCK):
        k = running[step]
        if not k:
            break
        moved = forth(to_next, np.ascontiguousarray(transfer[:, :, :k])) * e_by_step[step][:, None, :]
        if step % RESCALE == 0:
            _rescale(moved, (0, 1))
        transfer[:, :, :k] = moved
    _rescale(transfer, (0, 1))

    into = np.ones((states, total))  # weight on the first step of a block from all before it
    after = np.ones((states, total))  # weight on its last step from all behind it
    some = np.flatnonzero(per)
    into[:, place[block_first[some]]] = pi[:, None]
    by_blocks = some[np.argsort(-per[some], kind="stable")]
    join = np.max if best_path else np.sum
    for step in range(1, int(per.max())):
        live = by_blocks[: int(np.searchsorted(-per[by_blocks], -step, side="left"))]
        here, before = place[block_first[live] + step], place[block_first[live] + step - 1]
        out = forth(to_next, join(transfer[:, :, before] * into[None, :, before], axis=1))
        _rescale(out)
        into[:, here] = out
        end = block_first[live + 1] - 1 - step
        here, behind = place[end], place[end + 1]
        back = forth(to_last, join(transfer[:, :, behind] * after[:, None, behind], axis=0))
        _rescale(back)
        after[:, here] = back

    forward, backward = np.empty((states, n)), np.empty((states, n))
    a = into * e_by_step[0]
    forward[:, begin] = a
    for step in range(1, BLOCK):
        k = running[step]
        if not k:
            break
        a = forth(to_next, np.ascontiguousarray(a[:, :k])) * e_by_step[step]
        if step % RESCALE == 0:
            _rescale(a)
        forward[:, steps[step, :k]] = a
    b = after
    backward[:, begin + size - 1] = b
    for step in range(BLOCK - 2, -1, -1):
        # Blocks of more than step + 1 steps go one step back; shorter ones have not begun.
        k = running[step + 1]
        if not k:
            continue
        moved = forth(to_last, e_by_step[step + 1] * b[:, :k])
        if step % RESCALE == 0:
            _rescale(moved)
        b[:, :k] = moved
        backward[:, steps[step, :k]] = moved
    _rescale(forward)
    _rescale(backward)
    return Messages(e, t, forward, backward)


def viterbi(emissions: np.ndarray, offsets: np.ndarray, transitions: np.ndarray, initial: np.ndarray) -> np.ndarray:
    """The best state at each step, by max-marginals; the lowest state on ties."""
    return messages(emissions, offsets, transitions, initial, best_path=True).marginals().argmax(axis=1)
