from collections import Counter

import numpy as np
import pytest

from brooktext.llm import bwt, suffixes
from brooktext.llm.suffixes import remove_repeated_bytes
from made_up import words


def brute(rows, window):
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[p : p + window] for t in texts for p in range(len(t) - window + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - window + 1):
            if seen[t[p : p + window]] > 1:
                gone[p : p + window] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc_id, len(t), int(gone.sum()), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def told(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


def hard_rows(odd_rows):
    passage = " ".join(words(40, 60))
    rows = [row[:2] for row in odd_rows]
    rows += [(20 + k, " ".join(words(60 + k, 9 + k)) + passage[k * 7 : k * 7 + 260] + "é漢" * (k % 3)) for k in range(10)]
    rows += [(40, "abc" * 150), (41, "a" * 700), (42, "a" * 199), (43, "x" + passage), (None, passage)]
    rows += [(50, passage + " | " + passage), (51, words(77, 1)[0] * 90)]
    return rows


def test_repeats_against_brute_force(spark, table, odd_rows):
    rows = hard_rows(odd_rows)
    given = table([(i, text, "en", "a") for i, text in rows])
    assert told(remove_repeated_bytes(given)) == brute(rows, 200)


@pytest.mark.parametrize("levels", [0, 2])
def test_frequent_minimisers_are_split_without_loss(spark, monkeypatch, levels):
    monkeypatch.setattr(suffixes, "MOST_PIECES", 2)
    monkeypatch.setattr(suffixes, "LEVELS", levels)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 500)
    monkeypatch.setattr(suffixes, "STRETCH", 300)
    monkeypatch.setattr(bwt, "SHARD_BYTES", 256)
    line = "one line that all of these documents hold."
    rows = [(k, f"{words(k, 2)[0]}{k} {line} {words(k % 7, 3)[1]}{k % 5}") for k in range(40)]
    rows += [(100, "ab" * 400 + line), (101, line * 30), (102, line[:30] + "?" + line), (103, line)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert told(remove_repeated_bytes(given, 24, 8)) == brute(rows, 24)


def test_one_very_long_text_is_read_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "STRETCH", 5_000)
    text = " ".join(words(5, 9_000))
    rows = [(1, text), (2, "start " + text[20_000:21_000] + " end"), (3, text[4_900:5_300])]
    given = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert told(remove_repeated_bytes(given)) == brute(rows, 200)


def test_no_documents(spark, table):
    assert remove_repeated_bytes(table([])).collect() == []
    assert told(remove_repeated_bytes(table([(None, None, None, None)]))) == [(None, 0, 0, 0, b"")]


@pytest.mark.parametrize("stride", [1, 2, 4, 8])
def test_merged_transforms_against_counting(monkeypatch, stride):
    random = np.random.default_rng(stride)
    for trial in range(25):
        monkeypatch.setattr(bwt, "SHARD_BYTES", int(random.choice([40, 300, 1 << 16])))
        window, base = 8 * int(random.integers(1, 4)), random.integers(0, 1 + trial % 4, 400).astype(np.uint8)
        strings = []
        for _ in range(random.integers(1, 12)):
            a = random.integers(0, 350)
            strings.append(base[a : a + random.integers(1, 200)].copy())
            strings[-1][random.integers(0, len(strings[-1]))] ^= random.integers(0, 2) * 9
        weights = random.choice([1, 1, 2], len(strings))
        lengths = np.array([len(s) for s in strings])
        got = bwt.repeated_places(np.concatenate(strings), lengths, weights, window, stride)
        seen = Counter()
        for s, weight in zip(strings, weights, strict=True):
            for p in range(len(s) - window + 1):
                seen[s[p : p + window].tobytes()] += int(weight)
        want = [[p for p in range(len(s) - window + 1) if seen[s[p : p + window].tobytes()] > 1] for s in strings]
        assert [g.tolist() for g in got] == want


def test_common_prefixes_end_where_strings_do():
    # NUL bytes of a text are not the end of another one.
    strings = [b"abcdefgh\0\0\0\0\0\0\0\0", b"zabcdefgh", b"abcdefgh\0\0\0\0\0\0\0\0z"]
    data, lengths = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
    got = bwt.repeated_places(data, lengths, np.ones(3, dtype=np.int64), 16, 8)
    assert [g.tolist() for g in got] == [[0], [], [0]]
