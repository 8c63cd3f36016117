"""Languages of words and texts by a linear-chain conditional random field.

Words are runs of letters, in lower case. Features of a word are the word
itself (a learned lexicon), its first and last one to three bytes (affixes)
and its two and three byte sequences, all hashed into one table of weights.
The states are the languages; transitions are learned too, so a text may
switch between languages. Forward-backward gives each word's posterior, and a
text gets the language of the highest mean posterior, which is its score.

Learning uses a bounded sample: about ``SAMPLE_DOCS`` texts of each language,
whole, from the rows whose ``crc32(doc_id)`` is not divisible by 5. Labels,
sources and ids are no input of a prediction. Scale: applying the model is one
narrow pass; the weights (``TABLE`` rows) are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooktext.llm.arrays import Texts, slices, span_hashes, split_words, word_hashes
from brooktext.llm.chains import messages
from brooktext.llm.crf import Features, Model, bounded_sample, train
from brooktext.sources.workspace import discard, materialize

SAMPLE_DOCS = 300
TABLE = 1 << 16
# Bytes of text that a task labels at once, beside whole rows of documents.
KEEP_SLICE = 256 << 10
SAMPLE_PARTITIONS = 12
UNKNOWN = "und"

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[ord("a") : ord("z") + 1] = _LETTERS[ord("A") : ord("Z") + 1] = _LETTERS[128:] = True
_ROOT = 0x8CB92BA72F3D8DD7


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return ((hashes * np.uint64(2 * kind + 1)) >> np.uint64(64 - 16)).astype(np.int32)


def word_features(texts: Texts) -> Features:
    """Affixes, byte sequences and the word itself of all words of some lower-case texts."""
    words = split_words(texts, ~_LETTERS)
    _, example, types = np.unique(word_hashes(texts, words), return_index=True, return_inverse=True)
    starts, ends = words.starts[example], words.ends[example]
    n, size = len(starts), ends - starts
    data = texts.data.astype(np.uint64) + np.uint64(1)
    ids = [_bucket(span_hashes(data, starts, ends, _ROOT), 0)]
    for k in (1, 2, 3):
        ids.append(_bucket(span_hashes(data, starts, np.minimum(starts + k, ends), _ROOT), k))
        ids.append(_bucket(span_hashes(data, np.maximum(ends - k, starts), ends, _ROOT), 3 + k))
    kind = [np.arange(n)] * len(ids)
    values = [np.ones(n)] * len(ids)
    for k in (2, 3):
        number = np.maximum(size - k + 1, 0)
        owner = np.repeat(np.arange(n), number)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number) + starts[owner]
        ids.append(_bucket(span_hashes(data, at, at + k, _ROOT), 6 + k))
        kind.append(owner)
        values.append(1.0 / number[owner])
    ids, kind, values = np.concatenate(ids), np.concatenate(kind), np.concatenate(values)
    order = np.argsort(kind, kind="stable")
    borders = np.searchsorted(kind[order], np.arange(n + 1))
    return Features(ids[order], values[order], borders, types.ravel(), words.offsets)


def _row_labels(texts: Texts, features: Features, labels: list) -> np.ndarray:
    return np.repeat([labels[row] for row in texts.rows], np.diff(features.offsets)).astype(np.int64)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: those whose ``crc32`` of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learn_languages(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], Model]:
    """The languages found in ``lang`` and a model of them; held-out rows and null labels are not used."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    known = known.where(~held_out()).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    sample = bounded_sample(known, "doc_id", sample_docs, group="lang")
    dealt = sample.repartition(SAMPLE_PARTITIONS, F.xxhash64("doc_id")).sortWithinPartitions(F.xxhash64("doc_id", "lang"))
    staged = materialize(dealt.select("lang", "text"), "language_sample")
    languages = [row["lang"] for row in staged.select("lang").distinct().orderBy("lang").collect()]
    index = F.array_position(F.array([F.lit(x) for x in languages]), F.col("lang")) - 1 if languages else F.lit(0)
    labelled = staged.select("text", index.cast("int").alias("label"))

    def lower(texts: Texts) -> Features:
        return word_features(_lower(texts))

    model = train(labelled, lower, _row_labels, TABLE, max(len(languages), 1), joined=True)
    discard(staged)
    return languages, model


def _lower(texts: Texts) -> Texts:
    column = pa.array([texts.text(i) for i in range(len(texts.rows))], pa.string())
    lowered = next(slices(pc.utf8_lower(column), 1 << 62))
    return Texts(texts.rows, lowered.data, lowered.offsets)


def _shares(texts: Texts, learned: Model) -> tuple[np.ndarray, np.ndarray]:
    """For each of some lower-case texts the mean posterior of each language, and whether it has words."""
    features = word_features(texts)
    sent = messages(features.emissions(learned.weights), features.offsets, learned.transitions, learned.initial)
    sums = np.zeros((len(features.types) + 1, len(learned.initial)))
    np.cumsum(sent.marginals(), axis=0, out=sums[1:])
    counts = np.diff(features.offsets)
    shares = (sums[features.offsets[1:]] - sums[features.offsets[:-1]]) / np.maximum(counts, 1)[:, None]
    return shares, counts > 0


def _lettered(column: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(column, r"\p{L}").to_numpy(zero_copy_only=False)


def keep_identified(docs: DataFrame, least_score: float = 0.0, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is known.

    Goes: a null text, one without a letter, one whose best language has a
    score below ``least_score``. See ``identify_languages`` for the other
    cases; if nothing can be learned, every text with a letter stays.
    """
    languages, model = learn_languages(docs, sample_docs)
    shared = docs.sparkSession.sparkContext.broadcast((languages, model))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, learned = shared.value
        for batch in batches:
            column = pc.utf8_lower(batch.column("text").fill_null(""))
            told = _lettered(column).astype(bool).copy()
            for texts in slices(column, KEEP_SLICE) if names else ():
                shares, worded = _shares(texts, learned)
                told[texts.rows.start : texts.rows.stop] &= worded & (shares.max(axis=1) >= least_score)
            yield batch.filter(pa.array(told, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def word_languages(docs: DataFrame, languages: list[str], model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, shares``: the share of each language in the words of a text."""
    shared = docs.sparkSession.sparkContext.broadcast((languages, model))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, learned = shared.value
        for batch in batches:
            column = pc.utf8_lower(batch.column("text").fill_null(""))
            lettered = _lettered(column)
            for texts in slices(column):
                own = slice(texts.rows.start, texts.rows.stop)
                shares, worded = _shares(texts, learned)
                best = shares.argmax(axis=1)
                told = lettered[own] & worded & bool(names)
                listed = zip(shares[:, : len(names)].tolist(), told, strict=True)
                by_name = [dict(zip(names, s, strict=True)) if t else {} for s, t in listed]
                score = np.where(told, np.clip(shares.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(own.start, len(texts.rows)),
                        pa.array([names[b] if t else UNKNOWN for b, t in zip(best, told, strict=True)], pa.string()),
                        pa.array(score),
                        pa.array(by_name, pa.map_(pa.string(), pa.float64())),
                    ],
                    ["doc_id", "lang_pred", "score", "shares"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double, shares map<string,double>")


def identify_languages(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, shares`` of every row of ``docs``, learned from ``docs`` itself.

    ``docs`` needs ``doc_id, text, lang``; other columns are not read. A null
    text or one without a letter is ``und`` with score 0, and so is every text
    if no row can be learned from. Rows of null ``doc_id`` are predicted but
    not learned from; repeated rows are predicted each; ties go to the
    language first in code-point order; no rows give no rows.
    """
    languages, model = learn_languages(docs, sample_docs)
    predicted = word_languages(docs, languages, model)
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "shares")
