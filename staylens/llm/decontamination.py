"""Benchmark passages in training documents, found in a distributed positional index.

``build_index`` stores, for each run of documents, every word's postings: the word's hash
and the delta-coded positions where it stands.  A row of the index is complete for its
documents, so that it is made, stored and searched where its documents are; nothing is
shuffled.  ``exact_matches`` looks phrases up by their rarest word in the row and intersects
the offset-adjusted postings of the others in order of rarity; ``near_matches`` finds
stretches that hold all words of a phrase in any order.

Words are compared by 64-bit hash.  Positions count words, with one empty position between
documents, so that no phrase runs from one document into the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.workspace import stored
from staylens.llm.fetch import with_marks
from staylens.llm.rows import columns_of, small_batches, text_digest, unused
from staylens.llm.words import text_buffer, word_hashes

WINDOW = 13
RUN_BYTES = 4 << 20  # text of one index row; a longer document has a row of its own
BLOCK_WORDS = 250_000  # words of benchmark items looked up in one pass over the index
INDEX = (
    "run string, doc_ids array<bigint>, digests array<string>, n_words array<int>, terms binary, ends binary, postings binary"
)
MATCH = "run string, ordinal int, doc_id bigint, item_id bigint, start int, stop int"


def _runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Split a batch's texts into runs of about ``RUN_BYTES``."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + RUN_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for first, last in _runs(offsets):
            lo, hi = offsets[first], offsets[last]
            words, starts = word_hashes(data[lo:hi], offsets[first : last + 1] - lo)
            counts = np.diff(starts)
            at = np.arange(len(words), dtype=np.int64) + np.repeat(np.arange(last - first), counts)
            order = np.argsort(words, kind="stable")
            words, at = words[order], at[order]
            fresh = np.ones(len(words), bool)
            fresh[1:] = words[1:] != words[:-1]
            delta = np.diff(at, prepend=0)
            delta[fresh] = at[fresh]
            heads = np.flatnonzero(fresh)
            yield pa.RecordBatch.from_pydict(
                {
                    "run": [f"{part}-{made}"],
                    "doc_ids": pa.array([batch.column("doc_id").slice(first, last - first).to_pylist()], pa.list_(pa.int64())),
                    "digests": pa.array([batch.column("digest").slice(first, last - first).to_pylist()], pa.list_(pa.string())),
                    "n_words": pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                    "terms": [words[heads].tobytes()],
                    "ends": [np.append(heads[1:], len(words)).astype(np.uint32).tobytes() if len(heads) else b""],
                    "postings": [delta.astype(np.uint32).tobytes()],
                }
            )
            made += 1


def build_index(docs: DataFrame) -> DataFrame:
    """Positional index of all words of ``docs`` (``doc_id``, ``text``), stored in the shared folder.

    NULL texts have no words.  Rows that repeat and NULL ids are kept: a document is known by
    its ``run`` and its ordinal there.  An empty table gives an empty index.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), text_digest().alias("digest")
    )
    return stored(rows.mapInArrow(_index_rows, INDEX), "positional-index")


class Run:
    """One index row, decoded."""

    def __init__(self, row: dict):
        self.name, self.doc_ids = row["run"], row["doc_ids"]
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.ends = np.frombuffer(row["ends"], np.uint32).astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.deltas = np.frombuffer(row["postings"], np.uint32)
        counts = np.asarray(row["n_words"], np.int64)
        self.doc_starts = np.concatenate([[0], np.cumsum(counts + 1)])[:-1]
        self._decoded: dict[int, np.ndarray] = {}

    def find(self, words: np.ndarray) -> np.ndarray:
        """Place of each word among the terms, -1 where it is absent."""
        if not len(self.terms):
            return np.full(words.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def positions(self, term: int) -> np.ndarray:
        if term not in self._decoded:
            self._decoded[term] = np.cumsum(self.deltas[self.starts[term] : self.ends[term]], dtype=np.int64)
        return self._decoded[term]

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Positions where the terms stand one after another."""
        rarest = np.argsort(self.ends[terms] - self.starts[terms], kind="stable")
        found = self.positions(int(terms[rarest[0]])) - rarest[0]
        for k in rarest[1:]:
            there = self.positions(int(terms[k]))
            at = np.minimum(np.searchsorted(there, found + k), len(there) - 1)
            found = found[there[at] == found + k]
            if not len(found):
                break
        return found

    def stretch(self, terms: np.ndarray, size: int) -> np.ndarray:
        """Starts of stretches of ``size`` positions that begin with one of the terms and hold all of them."""
        terms = np.unique(terms)
        rarest = terms[np.argsort(self.ends[terms] - self.starts[terms], kind="stable")]
        anchors = self.positions(int(rarest[0]))
        near = []
        for term in rarest:
            there = self.positions(int(term))
            at = np.searchsorted(anchors, there)
            after = np.where(at < len(anchors), anchors[np.minimum(at, len(anchors) - 1)], np.iinfo(np.int64).max)
            near.append(there[after - there < size])
        starts = np.unique(np.concatenate(near))
        document = np.searchsorted(self.doc_starts, starts, "right")
        for term in rarest:
            there = self.positions(int(term))
            at = np.searchsorted(there, starts)
            found = there[np.minimum(at, len(there) - 1)]
            good = (at < len(there)) & (found < starts + size)
            good &= np.searchsorted(self.doc_starts, found, "right") == document
            starts, document = starts[good], document[good]
        return starts

    def place(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ordinal of the document and the word number in it."""
        ordinal = np.searchsorted(self.doc_starts, position, "right") - 1
        return ordinal, position - self.doc_starts[ordinal]


def item_windows(ids: list, texts: list, size: int = WINDOW) -> dict[int, tuple[np.ndarray, list[list]]]:
    """Distinct windows of items by length: word hashes, and the ids of the items that have each."""
    data, offsets = text_buffer(pa.array(texts, pa.large_string()))
    words, starts = word_hashes(data, offsets)
    owners: dict[bytes, set] = {}
    for item, start, stop in zip(ids, starts[:-1], starts[1:], strict=True):
        n = int(stop - start)
        for k in range(max(n - size + 1, min(n, 1))):
            owners.setdefault(words[start + k : start + min(k + size, n)].tobytes(), set()).add(item)
    by_length: dict[int, tuple[list, list]] = {}
    for window, items in owners.items():
        rows, names = by_length.setdefault(len(window) // 8, ([], []))
        rows.append(window)
        names.append(sorted(items, key=lambda i: (i is not None, i)))
    return {n: (np.frombuffer(b"".join(r), np.uint64).reshape(-1, n), names) for n, (r, names) in by_length.items()}


def _joined(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Unite spans that touch or overlap."""
    start = stop = None
    for a, b in sorted(spans):
        if start is not None and a <= stop:
            stop = max(stop, b)
            continue
        if start is not None:
            yield start, stop
        start, stop = a, b
    if start is not None:
        yield start, stop


def _search(windows: dict, slop: int | None):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                run, hits = Run(row), {}
                for length, (words, owners) in windows.items():
                    terms = run.find(words)
                    for k in np.flatnonzero((terms >= 0).all(axis=1)):
                        if slop is None:
                            found, size = run.phrase(terms[k]), length
                        else:
                            found, size = run.stretch(terms[k], length + slop), length + slop
                        ordinals, at = run.place(found)
                        for ordinal, start in zip(ordinals.tolist(), at.tolist(), strict=True):
                            for item in owners[k]:
                                hits.setdefault((ordinal, item), []).append((start, start + size))
                out = [
                    (run.name, ordinal, run.doc_ids[ordinal], item, start, stop)
                    for (ordinal, item), spans in hits.items()
                    for start, stop in (_joined(spans) if slop is None else sorted(set(spans)))
                ]
                columns = list(zip(*out, strict=True)) if out else [[]] * 6
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["run", "ordinal", "doc_id", "item_id", "start", "stop"],
                )

    return search


def _matches(index: DataFrame, items: DataFrame, size: int, slop: int | None) -> DataFrame:
    """Look items up in blocks: a block's words are bounded, and every item is in one block."""
    items = items.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = total // (4 * BLOCK_WORDS) + 1
    found = None
    for block in range(blocks):
        here = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        rows = here.collect()  # a block, bounded by BLOCK_WORDS on average
        windows = item_windows([r["item_id"] for r in rows], [r["text"] for r in rows], size)
        some = index.mapInArrow(_search(windows, slop), MATCH)
        found = some if found is None else found.unionByName(some)
    return found


def exact_matches(index: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Where windows of ``size`` words of ``items`` (``item_id``, ``text``) stand in the documents.

    One row per document, item and longest stretch of words inside occurrences:
    ``start`` and ``stop`` number words from 0.  An item of fewer words, but not none, is one
    window.  Items that repeat are one; NULL texts have no window.
    """
    return _matches(index, items, size, None)


def near_matches(index: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 5) -> DataFrame:
    """Stretches of ``size + slop`` words that begin with a word of a window and hold all its words, in any order."""
    return _matches(index, items, size, slop)


def contamination(index: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """How much of each document stands inside benchmark passages.

    One row per document row: ``doc_id``, ``digest`` of the text, ``n_words``, ``n_hit``, ``n_items``, ``item_ids`` (ascending as
    texts) and ``contaminated``: some word is hit, and at least one in twenty.  Items without an id are
    one item together: it counts in ``n_items``, but has no name to stand in ``item_ids``.
    """
    documents = index.select("run", F.posexplode(F.arrays_zip("doc_ids", "digests", "n_words")).alias("ordinal", "doc")).select(
        "run",
        "ordinal",
        F.col("doc.doc_ids").alias("doc_id"),
        F.col("doc.digests").alias("digest"),
        F.col("doc.n_words").cast("bigint").alias("n_words"),
    )
    hits = (
        exact_matches(index, items, size)
        .groupBy("run", "ordinal")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
            F.max(F.col("item_id").isNull().cast("int")).alias("unnamed"),
        )
        .withColumn(
            "n_hit",
            F.aggregate(
                "spans",
                F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
                lambda acc, s: F.struct(
                    (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(acc["upto"], s["start"]))).alias("n"),
                    F.greatest(acc["upto"], s["stop"]).alias("upto"),
                ),
                lambda acc: acc["n"].cast("bigint"),
            ),
        )
    )
    hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return documents.join(hits, ["run", "ordinal"], "left").select(
        "run",
        "ordinal",
        "doc_id",
        "digest",
        "n_words",
        hit.alias("n_hit"),
        F.coalesce(F.size("item_ids") + F.col("unnamed"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, all columns as they were.

    Only rows that marks of the contaminated ones let pass are joined with them, so that most texts
    stay where they are read and are neither shuffled nor sorted.
    """
    found = contamination(build_index(docs), items, size).where("contaminated")
    found = found.select(
        F.col("digest").alias(unused(docs, "bad_text")), F.col("doc_id").alias(unused(docs, "bad_id"))
    ).distinct()
    found = stored(found, "contaminated")
    key, mark = unused(docs, "text_key"), unused(docs, "mark")
    bad_text, bad_id = found.columns
    keyed = docs.withColumn(key, text_digest()).withColumn(mark, F.xxhash64(key, F.col("doc_id").cast("bigint")))
    told = unused(keyed, "marked")
    keyed = with_marks(keyed, mark, found.select(F.xxhash64(bad_text, bad_id).alias(mark)), told)
    same = (F.col(key) == F.col(bad_text)) & F.col("doc_id").cast("bigint").eqNullSafe(F.col(bad_id))
    clear, suspect = keyed.where(~F.col(told)), keyed.where(told).join(found, same, "left_anti")
    return clear.unionByName(suspect).select(*columns_of(docs))
