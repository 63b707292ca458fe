"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are hashed n-grams of one to three characters of the lower-cased text, with
log-scaled counts times inverse document frequency, normalised to unit length.  Document
frequencies are counted in Spark over all documents that may be learnt from.  Weights are
fitted with follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties) on a
bounded sample, and a temperature fitted on a part of the sample that the weights have not
seen makes the scores calibrated.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.labels import SAMPLE_CHARS, drawn, held_out, learnable
from staylens.llm.rows import columns_of, small_batches, unused

BITS = 16
WIDTH = 1 << BITS
ORDERS = (1, 2, 3)
PER_LANGUAGE = 1_500  # documents of a language that weights are fitted on, about
SAMPLE = 60_000  # documents of all languages together, about; with more than 40 languages each has fewer
UNKNOWN = "und"
CERTAIN = 0.5  # documents whose best language is less likely are rejected
LETTER = regex.compile(r"\p{L}")
PIECE = 1 << 18  # characters hashed at once


def ngrams(text: str) -> np.ndarray:
    """How often each bin's n-grams occur in the whole text."""
    counts = np.zeros(WIDTH)
    text = f" {text.lower()} "
    for start in range(0, len(text), PIECE):
        part = text[start : start + PIECE + ORDERS[-1] - 1]  # n-grams that begin in this piece
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        value = np.zeros(len(codes), np.uint64)
        for n in range(1, ORDERS[-1] + 1):
            m = min(len(codes) - n + 1, PIECE)
            if m <= 0:
                break
            value = value[:m] * np.uint64(0x100000001B3) + codes[n - 1 : n - 1 + m] + np.uint64(1)
            if n in ORDERS:
                bins = (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
                counts += np.bincount(bins.astype(np.int64), minlength=WIDTH)
    return counts


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, rows = np.zeros(WIDTH, np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            table += ngrams(text.as_py()) > 0
            rows += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([rows], pa.int64()), pa.array([zlib.compress(table.tobytes(), 1)], pa.binary())], names=["docs", "counts"]
    )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, rows = np.zeros(WIDTH, np.int64), 0
    for batch in batches:
        for docs, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            table += np.frombuffer(zlib.decompress(counts), np.int64)
            rows += docs
    yield pa.RecordBatch.from_arrays(
        [pa.array([rows], pa.int64()), pa.array([zlib.compress(table.tobytes(), 1)], pa.binary())], names=["docs", "counts"]
    )


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Log of documents by documents with a bin's n-grams, over all rows of ``docs`` (``text``).

    Partial tables of a fixed size are added up in tasks, a few hundred of them at a time at most.
    """
    kind = "docs bigint, counts binary"
    parts = docs.where("text is not null").select("text").mapInArrow(_frequencies, kind)
    groups = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.repartition(min(groups, 64)).mapInArrow(_add_up, kind)
    rows = parts.collect()  # at most 64 tables of WIDTH numbers
    table = sum((np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in rows), np.zeros(WIDTH, np.int64))
    total = sum(r["docs"] for r in rows)
    return np.log((1 + total) / (1 + table)).astype(np.float32) + np.float32(0.1)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bins of a text and how often they occur, in numbers as short as they may be: many texts are held while weights are fitted."""
    counts = ngrams(text)
    bins = np.flatnonzero(counts)
    most = int(counts.max(initial=0))
    return bins.astype(np.min_scalar_type(WIDTH - 1)), counts[bins].astype(np.min_scalar_type(most))


def weighted(bins: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins and their weights, of unit length."""
    bins = bins.astype(np.int64)
    values = (1 + np.log(counts.astype(float))) * idf[bins]
    return bins, values / max(np.sqrt((values**2).sum()), 1e-12)


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of a text and their weights, of unit length."""
    return weighted(*counted(text), idf)


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    """Weights by bin and language; a language's last row is its bias."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def margins(self, bins: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[bins] + self.weights[WIDTH]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and probability; ``und`` and 0 for texts without a letter, or if nothing was learnt."""
        if not self.languages or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0
        p = _softmax(self.margins(*vector(text, self.idf)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit(
    texts: list[str], languages: list[str], idf: np.ndarray, epochs: int = 3, rate: float = 0.5, smooth: float = 1.0,
    l1: float = 0.002, l2: float = 0.01, seed: int = 5,
) -> Model:
    """Fit weights on nine texts in ten and the temperature on the tenth."""
    names = sorted(set(languages))
    model = Model(names, idf, np.zeros((WIDTH + 1, len(names)), np.float32))
    if not names:
        return model
    held = [counted(t) for t in texts]
    target = np.array([names.index(x) for x in languages])
    order = np.random.default_rng(seed).permutation(len(texts))
    apart = order[: len(order) // 10]
    z = np.zeros((WIDTH + 1, len(names)))
    n = np.zeros_like(z)
    for _ in range(epochs):
        for i in order[len(apart) :]:
            bins, values = weighted(*held[i], idf)
            bins, values = np.append(bins, WIDTH), np.append(values, 1.0)
            zi, ni = z[bins], n[bins]
            w = np.where(np.abs(zi) > l1, (np.sign(zi) * l1 - zi) / ((smooth + np.sqrt(ni)) / rate + l2), 0.0)
            p = _softmax(values @ w)
            p[target[i]] -= 1
            g = values[:, None] * p
            more = ni + g**2
            z[bins] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / rate * w
            n[bins] = more
    weights = np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((smooth + np.sqrt(n)) / rate + l2), 0.0)
    model.weights = weights.astype(np.float32)
    if len(apart):
        margins = np.stack([model.margins(*weighted(*held[i], idf)) for i in apart])
        grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
        losses = [-np.log(_softmax(margins / t)[np.arange(len(apart)), target[apart]] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(losses))])
    return model


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, chars: int = SAMPLE_CHARS) -> Model:
    """Learn from the text and language of documents that are not held out.

    Document frequencies come from all of them; weights from about ``per_language`` documents
    of a language and ``SAMPLE`` in all, of at most ``chars`` characters.  NULL texts and languages teach nothing.
    Every value of ``lang`` is learnt; each takes about a megabyte of the driver while weights are fitted.
    """
    small_batches(docs.sparkSession)
    known = docs.where(learnable() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    idf = inverse_frequencies(known)
    short = known.where(F.char_length("text") <= chars)
    one = F.min_by("doc_id", F.xxhash64("doc_id")).alias("one")  # a rare language is not left to the draw
    sizes = short.groupBy("lang").agg(F.count("*").alias("count"), one)
    share = F.least(F.lit(float(per_language)), F.lit(float(SAMPLE)) / F.count("*").over(Window.partitionBy())) / F.col("count")
    sizes = sizes.select("lang", "one", share.alias("share"))  # a row a language, far less than the weights that it gets
    taken = drawn("doc_id", F.col("share")) | (F.col("doc_id") == F.col("one"))
    drawn_rows = short.join(F.broadcast(sizes), "lang").where(taken)
    sample = drawn_rows.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("row"))
    sample = sample.orderBy("doc_id").select("row.text", "row.lang").toPandas()
    return fit(sample["text"].tolist(), sample["lang"].tolist(), idf)


def identified(docs: DataFrame, model: Model, name: str = "language") -> DataFrame:
    """Add the column ``name``: ``lang_pred`` and ``score`` of the whole text, in place and without a shuffle.

    Only ``text`` is read.  NULL texts and texts without a letter are ``und`` with score 0.  A
    column of that name in the input is replaced; other columns are kept.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [shared.value.predict(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["lang_pred", "score"],
            )

    return docs.withColumn(name, predict(F.col("text").cast("string")))


def accepted(docs: DataFrame, model: Model, least: float = CERTAIN) -> DataFrame:
    """The documents in a learnt language, with a score of ``least`` or more, all columns as they were."""
    name = unused(docs, "language")  # beside the columns, so that a row that waits for its result has its text once
    found = F.col(name)
    rows = identified(docs, model, name)
    return rows.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least)).select(*columns_of(docs))


def predictions(docs: DataFrame) -> DataFrame:
    """Languages of all documents: ``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    out = identified(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")
