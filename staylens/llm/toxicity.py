"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score is a logistic function of its words
and word beginnings, and a document is toxic unless all its sentences are harmless:
``1 - prod(1 - p(sentence))`` (noisy-or).  Weights are learnt from document labels alone,
and the sentence scores then say which sentences gave offence.

A sentence ends at a stop of any script, at a line break, and after ``STRETCH`` words, so that a
text without stops is no single sentence of any length.  The bias, which each sentence carries
whatever its words, is a leak of the noisy-or: it stands for offences in words that were not
learnt.  It is fitted with the weights and divided out of a document's score, which would
otherwise grow towards 1 with the number of harmless sentences.  A sentence without a weighted
word thus adds nothing, however often it comes.  In documents of more than ``USUAL`` sentences the
bias falls by the logarithm of their number, in learning and scoring, so that the offences
expected of harmless sentences are no more in a long document than in one of ``USUAL``.

Word beginnings let the weights of a stem carry over to its inflected forms.  Weights are
not negative: a word can make a sentence worse, but harmless words around an offending one
do not hide it, however many there are.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.labels import SAMPLE_CHARS, SAMPLE_ROWS, held_out, labelled_sample

TOXIC = 0.5
PREFIXES = (3, 4, 5, 6)
STOPS = ".!?\n\r\u0085\u2028\u2029\u0589\u061f\u06d4\u0964\u0965\u1362\u203c\u2047\u2048\u2049\u3002\uff01\uff0e\uff1f\uff61"
SENTENCE = re.compile(f"[^{STOPS}]+[{STOPS}]*")
WORD = re.compile(r"\w+")
USUAL = 100  # sentences of a document up to which each has the same bias
STRETCH = 40  # words of a sentence that are scored together; a longer one is cut
REMEMBERED = 300_000  # words whose weight a task keeps at hand


def stretches(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and words of each sentence that has a word, and of each stretch of a long one."""
    for found in SENTENCE.finditer(text):
        start, stop = found.span()
        words = WORD.findall(text, start, stop)
        if len(words) > STRETCH:
            firsts = [m.start() for m in islice(WORD.finditer(text, start, stop), STRETCH, None, STRETCH)]
            yield from (
                (a, b, words[k * STRETCH : (k + 1) * STRETCH])
                for k, (a, b) in enumerate(zip([start, *firsts], [*firsts, stop], strict=True))
            )
        elif words:
            yield start, stop, words


def features(word: str) -> list[str]:
    """The word, marked, and its beginnings."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) >= n)]


def longer(sentences):
    """By how much the bias falls in documents of so many sentences."""
    return np.log(np.maximum(sentences, USUAL) / USUAL)


@dataclass
class Model:
    """Weights of features; what is not listed weighs nothing."""

    bias: float
    weights: dict[str, float]
    known: dict[str, float] = field(default_factory=dict)

    def sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """Start, length and log-odds of each sentence that has a word."""
        known, low = self.known, text.lower()
        exact = len(low) == len(text)  # else lower-casing moved letters: cut first, lower-case then
        for start, stop, words in stretches(low if exact else text):
            total = self.bias
            for word in set(words if exact else WORD.findall(" ".join(words).lower())):
                weight = known.get(word)
                if weight is None:
                    weight = sum(self.weights.get(f, 0.0) for f in features(word))
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = weight
                total += weight
            yield start, stop - start, total

    def score(self, text: str | None) -> tuple[float, int | None, int | None, float]:
        """Of the document, and where its worst sentence lies and how that scores."""
        odds = list(self.sentences(text or ""))
        if not odds:
            return 0.0, None, None, 0.0
        start, length, worst = max(odds, key=lambda s: s[2])  # the first of equals
        fall = longer(len(odds))
        leak = np.logaddexp(0.0, self.bias - fall)
        harmless = (leak - np.logaddexp(0.0, np.array([o for _, _, o in odds]) - fall)).sum()
        return max(float(-np.expm1(harmless)), 0.0), start, length, float(1 / (1 + np.exp(-worst)))


def fit(
    texts: list[str], y: list[int], least: int = 4, kept: int = 20_000, steps: int = 250, rate: float = 0.1, decay: float = 2e-5
) -> Model:
    """Learn from whole texts and document labels by gradient steps on the noisy-or likelihood.

    Features of fewer than ``least`` documents are left out, as are those beyond the ``kept``
    ones that most mark toxic documents.  Without both labels the model knows no weight.
    """
    y = np.asarray(y, float)
    n, n_toxic = len(y), float(y.sum())
    if not n_toxic or n_toxic == n:
        return Model(20.0 if n_toxic else -20.0, {})
    in_all, in_toxic = Counter(), Counter()
    for text, toxic in zip(texts, y, strict=True):
        seen = {f for w in set(WORD.findall(text.lower())) for f in features(w)}
        in_all.update(seen)
        if toxic:
            in_toxic.update(seen)
    share = n_toxic / n
    telling = {}
    for f, c in in_all.items():
        if c >= least and (excess := (in_toxic[f] - c * share) / np.sqrt(c * share * (1 - share))) > 2:
            telling[f] = excess
    number = {f: k for k, f in enumerate(sorted(sorted(telling), key=lambda f: -telling[f])[:kept])}
    del in_all, in_toxic
    known: dict[str, tuple[int, ...]] = {}
    sentence, columns, owner = array("q"), array("q"), array("q")
    for d, text in enumerate(texts):
        for _, _, words in stretches(text.lower()):
            for word in sorted(set(words)):
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = tuple(number[f] for f in features(word) if f in number)
                columns.extend(ids)
                sentence.extend([len(owner)] * len(ids))
            owner.append(d)
    sentence, columns, owner = np.array(sentence, np.int64), np.array(columns, np.int64), np.array(owner, np.int64)
    sizes = np.bincount(owner, minlength=n)
    fall = longer(sizes)[owner]
    w, bias = np.zeros(len(number)), -4.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        z = bias - fall + np.bincount(sentence, w[columns], len(owner))
        p = 1 / (1 + np.exp(-z))
        harmless = np.bincount(owner, -np.logaddexp(0, z), n)  # log of no sentence being toxic
        pull = np.where(y > 0, 1 / np.maximum(np.expm1(-harmless), 1e-9), -1.0)
        on_z = pull[owner] * p
        gradient = np.append(np.bincount(columns, on_z[sentence], len(w)) / n - decay, on_z.sum() / n)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, bias = np.maximum(w + move[:-1], 0), bias + move[-1]
        if not sizes.any():
            break
    return Model(float(bias), {f: float(w[k]) for f, k in number.items() if abs(w[k]) > 1e-3})


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit on about ``rows`` labelled documents of at most ``chars`` characters, never on held-out ones."""
    return fit(*labelled_sample(docs, labels, "toxic", rows, chars))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``toxicity``: the score of the whole text, and start, length and score of its worst sentence.

    Offsets count code points.  Texts without a word (NULL and empty ones too) score 0 and
    have no worst sentence.  A column ``toxicity`` of the input is replaced, others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct(
        [("score", pa.float64()), ("worst_start", pa.int32()), ("worst_length", pa.int32()), ("worst_score", pa.float64())]
    )

    @F.arrow_udf("struct<score: double, worst_start: int, worst_length: int, worst_score: double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            columns = zip(*(shared.value.score(t.as_py()) for t in texts), strict=True)
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)] if len(texts) else [pa.array([], f.type) for f in kind],
                fields=list(kind),
            )

    return docs.withColumn("toxicity", score(F.col("text").cast("string")))


def offending_sentences(docs: DataFrame, model: Model, least: float = TOXIC) -> DataFrame:
    """One row per sentence that scores ``least`` or more: ``doc_id``, ``start``, ``length``, ``score``, ``sentence``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = np.log(least / (1 - least))
        for batch in batches:
            rows = [
                (i, start, length, 1 / (1 + np.exp(-odds)), text[start : start + length])
                for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for start, length, odds in shared.value.sentences(text or "")
                if odds >= bound
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "length", "score", "sentence"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(locate, "doc_id bigint, start int, length int, score double, sentence string")


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents: ``doc_id``, ``held_out``, ``score``, ``predicted``, and the worst sentence."""
    out = scored(docs.select("doc_id", "text"), train(docs, labels))
    return out.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= TOXIC).cast("int").alias("predicted"),
        F.col("toxicity.worst_start").alias("worst_start"),
        F.col("toxicity.worst_length").alias("worst_length"),
        F.col("toxicity.worst_score").alias("worst_score"),
    )
