import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from brooktext.llm import chains
from brooktext.llm.arrays import pack, slices, split_words, unpack, window_hashes, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\r\x0b\x0cé漢\U0001f600 ", max_size=30)), max_size=8)


@settings(deadline=None, max_examples=60)
@given(TEXTS, st.integers(1, 40))
def test_words_and_windows_of_slices(texts, limit):
    found, hashes = [], {}
    for part in slices(pa.array(texts, pa.string()), limit):
        split = split_words(part)
        own = [part.data[a:b].tobytes().decode() for a, b in zip(split.starts, split.ends, strict=True)]
        whole = word_hashes(part, split)
        windows, first = window_hashes(whole, split, 3)
        for value, at in zip(windows.tolist(), first.tolist(), strict=True):
            assert hashes.setdefault(value, own[at : at + 3]) == own[at : at + 3]
        for i in range(len(part.rows)):
            found.append(own[split.offsets[i] : split.offsets[i + 1]])
    assert found == [WORD.findall(text or "") for text in texts]
    assert len({tuple(v) for v in hashes.values()}) == len(hashes)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_pack_is_undone_by_unpack(values):
    assert unpack(pack(np.array(values, dtype=np.uint32)), np.uint32).tolist() == values


def plain_messages(e, t, initial, reduce):
    forward, backward = [initial + e[0]], [np.zeros(len(initial))]
    for step in e[1:]:
        forward.append(reduce(forward[-1][:, None] + t, 0) + step)
    for step in e[:0:-1]:
        backward.append(reduce(t + (step + backward[-1])[None], 1))
    both = np.exp((x := np.array(forward) + np.array(backward[::-1])) - x.max(axis=1, keepdims=True))
    return both / both.sum(axis=1, keepdims=True)


def test_chains_equal_the_plain_recursion():
    random = np.random.default_rng(0)
    lengths = [0, 1, 5, 32, 33, 64, 65, 200, 0, 31]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    e, t, initial = random.normal(size=(offsets[-1], 3)) * 3, random.normal(size=(3, 3)), random.normal(size=3)
    for best, reduce in ((False, lambda x, a: np.log(np.exp(x).sum(a))), (True, lambda x, a: x.max(a))):
        got = chains.messages(e, offsets, t, initial, best).marginals()
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            if b > a:
                np.testing.assert_allclose(got[a:b], plain_messages(e[a:b], t, initial, reduce), atol=1e-9)


def test_viterbi_is_the_best_of_all_paths():
    random = np.random.default_rng(1)
    e, t, initial = random.normal(size=(7, 3)), random.normal(size=(3, 3)), random.normal(size=3)
    paths = np.stack(np.meshgrid(*[range(3)] * 7, indexing="ij"), -1).reshape(-1, 7)
    scores = initial[paths[:, 0]] + e[range(7), paths].sum(axis=1) + t[paths[:, :-1], paths[:, 1:]].sum(axis=1)
    assert chains.viterbi(e, np.array([0, 7]), t, initial).tolist() == paths[scores.argmax()].tolist()


def test_expected_pairs_sum_to_the_steps():
    random = np.random.default_rng(2)
    offsets = np.array([0, 4, 4, 50])
    sent = chains.messages(random.normal(size=(50, 3)), offsets, random.normal(size=(3, 3)), np.zeros(3))
    assert np.isclose(sent.pair_counts(offsets).sum(), 3 + 45)
