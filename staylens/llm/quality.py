"""Document quality: gradient-boosted trees over document statistics.

Trees are grown on histograms of binned statistics (logistic loss, second-order gains) on a
bounded sample of labelled rows, then flattened into arrays of features, thresholds and leaf
values, one complete tree per row, which numpy walks for a whole batch of documents at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.labels import SAMPLE_CHARS, SAMPLE_ROWS, held_out, labelled_rows
from staylens.llm.rows import columns_of, small_batches, unused
from staylens.llm.words import shingle_hashes, text_buffer, word_hashes

ACCEPTED = 0.3
STATISTICS = (
    "bytes", "words", "word_length", "upper", "digits", "symbols", "spaces", "lines", "stops",
    "commas", "bars", "marks", "non_ascii", "distinct_words", "top_word", "distinct_shingles",
    "distinct_lines", "line_bytes", "closed_lines", "lower_starts",
)
GROUP_BYTES = 2 << 20

# byte classes that statistics count
_CLASS = np.zeros(256, np.int64)
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "symbols": b"#$%&*@^~<>{}[]\\=+_/",
    "spaces": b" \t", "lines": b"\n", "stops": b".", "commas": b",;:", "bars": b"|", "marks": b"!?",
    "lower": b"abcdefghijklmnopqrstuvwxyz", "non_ascii": bytes(range(128, 256)),
}
for _k, _members in enumerate(_KINDS.values(), 1):
    _CLASS[list(_members)] = _k


def _line_statistics(text: str) -> tuple[float, float, float]:
    lines = [x for x in text.split("\n") if x]
    if not lines:
        return 1.0, 0.0, 0.0
    closed = sum(x[-1] in ".!?" for x in lines)
    starts = sum(x[0].islower() for x in lines)
    return len(set(lines)) / len(lines), closed / len(lines), starts / len(lines)


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct hashes each document has, and how often its most frequent one occurs."""
    keys, counts = np.unique((owner.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)), return_counts=True)
    of = (keys >> np.uint64(48)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, of, counts)
    return np.bincount(of, minlength=n), top


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text, computed over the whole text; NULL counts as empty."""
    data, offsets = text_buffer(column)
    n, first = len(column), 0
    out = np.zeros((n, len(STATISTICS)))
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, "right")) - 1
        last = min(max(last, first + 1), n, first + 60_000)
        m = last - first
        part, ends = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        size = np.diff(ends)
        k = len(_KINDS) + 1
        owner = np.repeat(np.arange(m), size)
        count = dict(zip(["", *_KINDS], np.bincount(owner * k + _CLASS[part], minlength=m * k).reshape(m, k).T, strict=True))
        words, starts = word_hashes(part, ends)
        n_words = np.diff(starts)
        letters = count["upper"] + count["lower"] + count["digits"] + count["non_ascii"]
        kinds, top = _distinct(np.repeat(np.arange(m), n_words), words, m)
        shingles, s_ends = shingle_hashes(words, starts)
        s_kinds, _ = _distinct(np.repeat(np.arange(m), np.diff(s_ends)), shingles, m)
        lines = np.array([_line_statistics(t or "") for t in column.slice(first, m).to_pylist()]).reshape(m, 3)
        total, some = np.maximum(size, 1), np.maximum(n_words, 1)
        alphabet = np.maximum(count["upper"] + count["lower"], 1)
        out[first:last] = np.stack(
            [
                np.log1p(size), np.log1p(n_words), letters / some, count["upper"] / alphabet,
                *(count[c] / total for c in ("digits", "symbols", "spaces", "lines", "stops", "commas", "bars", "marks", "non_ascii")),
                kinds / some, top / some, s_kinds / np.maximum(np.diff(s_ends), 1),
                lines[:, 0], size / (count["lines"] + 1), lines[:, 1], lines[:, 2],
            ],
            axis=1,
        )
        first = last
    return out


@dataclass
class Trees:
    """Complete binary trees, flattened: inner nodes and leaves of each tree are one row."""

    depth: int
    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        margin, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            margin += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-margin))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    ridge: float = 1.0, least: float = 2.0,
) -> Trees:
    """Boost trees on labelled rows.  Without rows, or with one label only, no tree is grown."""
    y = np.asarray(y, float)
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves, width = 2**depth - 1, 2**depth, x.shape[1] if len(x) else len(STATISTICS)
    model = Trees(depth, base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not len(y) or y.min() == y.max():
        return model
    edges = np.full((width, bins - 1), np.inf)
    binned = np.zeros((len(x), width), np.int64)
    for f in range(width):
        cuts = np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
        edges[f, : len(cuts)] = cuts
        binned[:, f] = np.searchsorted(cuts, x[:, f], "left")  # above a cut: to the right
    cell = binned + np.arange(width) * bins
    margin = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            start, here = 2**level - 1, 2**level
            place = ((node - start)[:, None] * (width * bins) + cell).ravel()
            shape = (here, width, bins)
            g = np.bincount(place, np.repeat(gradient, width), here * width * bins).reshape(shape).cumsum(2)
            h = np.bincount(place, np.repeat(curvature, width), here * width * bins).reshape(shape).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least) | (all_h - h < least)] = 0
            best = gain[:, :, :-1].reshape(here, -1).argmax(1)
            at_feature, at_bin = best // (bins - 1), best % (bins - 1)
            worth = gain[np.arange(here), at_feature, at_bin] > 1e-9
            feature[start : start + here] = np.where(worth, at_feature, 0)
            threshold[start : start + here] = np.where(worth, edges[at_feature, at_bin], np.inf)
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - inner
        leaf = rate * np.bincount(at, gradient, leaves) / (np.bincount(at, curvature, leaves) + ridge)
        margin += leaf[at]
        model.feature = np.vstack([model.feature, feature])
        model.threshold = np.vstack([model.threshold, threshold])
        model.leaf = np.vstack([model.leaf, leaf])
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Trees:
    """Fit on about ``rows`` labelled documents of at most ``chars`` characters, never on held-out ones.

    Tasks compute the statistics, so that the driver gets numbers and no texts.
    """

    @F.arrow_udf("array<double>")
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in batches:
            ends = pa.array(np.arange(len(text) + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.ListArray.from_arrays(ends, pa.array(statistics(text).ravel(), pa.float64()))

    small_batches(docs.sparkSession)
    found = labelled_rows(docs, labels, "quality", rows, chars)
    found = found.select("doc_id", described("text").alias("x"), "y").orderBy("doc_id").select("x", "y").toPandas()
    return fit(np.array(found["x"].tolist(), float).reshape(len(found), len(STATISTICS)), found["y"].to_numpy(int))


def scored(docs: DataFrame, model: Trees, name: str = "quality_score") -> DataFrame:
    """Add the column ``name`` (0 to 1) to every row of ``docs``, in place and without a shuffle.

    Only ``text`` is read; NULL counts as empty, and empty texts are scored like any.  A
    column of that name in the input is replaced; other columns are kept.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in batches:
            yield pa.array(shared.value.score(statistics(text)))

    return docs.withColumn(name, score(F.col("text").cast("string")))


def accepted(docs: DataFrame, model: Trees, least: float = ACCEPTED) -> DataFrame:
    """The documents that score ``least`` or more, all columns as they were."""
    name = unused(docs, "quality_score")  # beside the columns, so that a row that waits for its score has its text once
    return scored(docs, model, name).where(F.col(name) >= least).select(*columns_of(docs))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    out = scored(docs.select("doc_id", "text"), train(docs, labels))
    return out.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= ACCEPTED).cast("int").alias("predicted"),
    )
