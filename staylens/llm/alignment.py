"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded twice, by a byte-level BPE vocabulary (A) and by a sentencepiece model
(B), and each token is taken as the bytes it stands for.  Byte offsets where tokens of both
lists end are found by a galloping intersection: the ends of the list that has fewer tokens
drive, and each looks for its place in the longer list by steps that double, starting where
it would stand if tokens were of even length, and then by halving.  Offsets common to both
cut the text into groups; the ranks of two such offsets, taken from each other, tell how many
tokens of either list a group holds, and the places of two neighbours which tokens of the
longer list one token overlaps.

Two tokens that end at one offset are linked.  One's bytes then end with the other's, so that
only pairs of ids of which one ends with the other can ever be linked.  There are some hundred
thousand of them, whatever the corpus: they are numbered from the vocabularies alone, their
counts over the corpus fit a table of fixed length, and that table may pass the driver.

Rows: NULL and empty texts, and texts whose tokens do not give back a space and the text (a
sentencepiece model may rewrite characters), have no tokens.  Rows with a repeated or NULL id
each keep a row.  Very long texts are encoded whole.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.workspace import stored
from staylens.llm.packing import tokenizer

GROUP_BYTES = 1 << 20  # text encoded in one step
CHUNK = 4096  # pairs in one row while counts are added up
SPACE = "▁"


@dataclass
class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the pairs of ids that can end together."""

    encode_a: object
    encode_b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    pairs: np.ndarray  # id of A times the number of ids of B, plus id of B; ascending

    def __post_init__(self):
        self.sizes_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.shown = [f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"]
        self.shown += [f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"]

    @property
    def pair_b(self) -> np.ndarray:
        return self.pairs % len(self.bytes_b)


def _ending_pairs(bytes_a: list[bytes], bytes_b: list[bytes]) -> np.ndarray:
    """All pairs of ids of which one's bytes end with the other's."""
    found = []
    for swapped, longer, shorter in ((False, bytes_a, bytes_b), (True, bytes_b, bytes_a)):
        ids: dict[bytes, list[int]] = {}
        for i, token in enumerate(shorter):
            ids.setdefault(token, []).append(i)
        for i, token in enumerate(longer):
            for k in range(len(token)):
                for j in ids.get(token[k:], ()):
                    found.append(j * len(bytes_b) + i if swapped else i * len(bytes_b) + j)
    return np.unique(np.array(found, np.int64))


_loaded: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    """The tokenizers of two files, kept at hand by each worker."""
    if (path_a, path_b) not in _loaded:
        encoding = tokenizer(path_a).encoding
        bytes_a = [b"?"] * encoding.n_vocab
        for token in encoding.token_byte_values():
            bytes_a[encoding.encode_single_token(token)] = token
        model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_b = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())
        made = Vocabularies(
            encoding.encode_ordinary,
            lambda texts: model.encode(texts, num_threads=1),
            bytes_a,
            bytes_b,
            _ending_pairs(bytes_a, bytes_b),
        )
        _loaded[path_a, path_b] = made
    return _loaded[path_a, path_b]


def gallop(values: np.ndarray, into: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """The first place in ``into[low:high]`` (ascending) whose entry is not less than the value; ``high`` if there is none.

    From ``guess`` (in ``low:high``) steps double, up or down, until the place is between two
    probes; then the range is halved.  All values take each step at once.
    """
    up = into[guess] < values
    first, last = np.where(up, guess + 1, low), np.where(up, high, guess)
    going, reach = np.arange(len(values)), 1
    while len(going):
        rises = up[going]
        probe = np.where(rises, guess[going] + reach, guess[going] - reach)
        inside = (probe < high[going]) & (probe >= low[going])
        less = into[np.where(inside, probe, guess[going])] < values[going]
        further = inside & (less == rises)
        moved = going[further]
        first[moved] = np.where(rises[further], probe[further] + 1, first[moved])
        last[moved] = np.where(rises[further], last[moved], probe[further])
        done = going[inside & ~further]
        last[done] = np.where(up[done], probe[inside & ~further], last[done])
        first[done] = np.where(up[done], first[done], probe[inside & ~further] + 1)
        going, reach = moved, reach * 2
    going = np.flatnonzero(first < last)
    while len(going):
        middle = (first[going] + last[going]) >> 1
        less = into[middle] < values[going]
        first[going] = np.where(less, middle + 1, first[going])
        last[going] = np.where(less, last[going], middle)
        going = going[first[going] < last[going]]
    return first


@dataclass
class Aligned:
    """Tokens of some texts, laid end to end, and where lists end together."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    starts_a: np.ndarray  # place of each text's first token, and the end
    starts_b: np.ndarray
    ends_a: np.ndarray  # byte offsets, counted over all texts
    ends_b: np.ndarray
    offsets: np.ndarray  # byte offset of each text
    last_a: np.ndarray  # place of the last token of each group
    last_b: np.ndarray
    starts_groups: np.ndarray
    drives_a: np.ndarray  # by text: A has no more tokens than B
    place: np.ndarray  # of each driving token's end in the longer list; by text, A's or B's tokens


def _encoded(texts: list[str | None], v: Vocabularies) -> tuple[list, list, np.ndarray]:
    ids_a: list[list[int]] = [[] for _ in texts]
    ids_b: list[list[int]] = [[] for _ in texts]
    sizes = np.zeros(len(texts) + 1, np.int64)
    some = [k for k, text in enumerate(texts) if text]
    for k, b in zip(some, v.encode_b([texts[k] for k in some]) if some else (), strict=True):
        text = " " + texts[k]
        a, data = v.encode_a(text), text.encode()
        if b"".join(map(v.bytes_b.__getitem__, b)) == data and b"".join(map(v.bytes_a.__getitem__, a)) == data:
            ids_a[k], ids_b[k], sizes[k + 1] = a, b, len(data)
    return ids_a, ids_b, np.cumsum(sizes)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    out = np.empty(starts[-1], np.int64)
    for x, start, end in zip(lists, starts[:-1], starts[1:], strict=True):
        out[start:end] = x
    return out, starts


def align_texts(texts: list[str | None], v: Vocabularies) -> Aligned:
    """Align the two token lists of each text."""
    ids_a, ids_b, offsets = _encoded(texts, v)
    (ids_a, starts_a), (ids_b, starts_b) = _flat(ids_a), _flat(ids_b)
    ends_a, ends_b = np.cumsum(v.sizes_a[ids_a]), np.cumsum(v.sizes_b[ids_b])
    n_a, n_b = np.diff(starts_a), np.diff(starts_b)
    drives_a = n_a <= n_b
    partner = np.full(len(ids_a), -1, np.int64)
    driving = np.where(drives_a, n_a, n_b)
    heads = np.zeros(len(driving) + 1, np.int64)
    np.cumsum(driving, out=heads[1:])
    place = np.zeros(heads[-1], np.int64)
    for by_a, ends, starts, n, into, other_starts, other_n in (
        (True, ends_a, starts_a, n_a, ends_b, starts_b, n_b),
        (False, ends_b, starts_b, n_b, ends_a, starts_a, n_a),
    ):
        chosen = np.flatnonzero((drives_a == by_a) & (n > 0))
        if not len(chosen):
            continue
        text = np.repeat(chosen, n[chosen])
        rank = np.arange(len(text)) - np.repeat(np.cumsum(n[chosen]) - n[chosen], n[chosen])
        own = starts[text] + rank
        low, high = other_starts[text], other_starts[text + 1]
        found = gallop(ends[own], into, low, high, low + rank * other_n[text] // n[text])
        place[heads[text] + rank] = found
        same = into[np.minimum(found, high - 1)] == ends[own]
        if by_a:
            partner[own[same]] = found[same]
        else:
            partner[found[same]] = own[same]
    last_a = np.flatnonzero(partner >= 0)
    return Aligned(
        ids_a,
        ids_b,
        starts_a,
        starts_b,
        ends_a,
        ends_b,
        offsets,
        last_a,
        partner[last_a],
        np.searchsorted(last_a, starts_a),
        drives_a,
        place,
    )


def written_groups(found: Aligned, v: Vocabularies) -> list[str]:
    """Groups of each text as ``a1,a2|b1;a3|b2,b3``: decimal ids in order."""
    ends_group_a, ends_group_b = np.zeros(len(found.ids_a), bool), np.zeros(len(found.ids_b), bool)
    ends_group_a[found.last_a] = ends_group_b[found.last_b] = True
    group_a, group_b = np.cumsum(ends_group_a) - ends_group_a, np.cumsum(ends_group_b) - ends_group_b
    codes = np.empty(len(found.ids_a) + len(found.ids_b), np.int64)
    before = np.concatenate([[0], found.last_b + 1])
    codes[np.arange(len(found.ids_a)) + before[group_a]] = found.ids_a * 2 + ends_group_a
    if len(found.ids_b):
        at = np.arange(len(found.ids_b)) + found.last_a[group_b] + 1
        codes[at] = (found.ids_b + len(v.bytes_a)) * 2 + ends_group_b
    cuts = (found.starts_a + found.starts_b).tolist()
    shown = v.shown.__getitem__
    return ["".join(map(shown, codes[i:j].tolist()))[:-1] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _steps(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of a batch, about ``GROUP_BYTES`` at a time, and the place of the first."""
    texts, size, first = [], 0, 0
    for text in column.to_pylist():
        texts.append(text)
        size += len(text or "")
        if size >= GROUP_BYTES:
            yield first, texts
            first, texts, size = first + len(texts), [], 0
    if texts:
        yield first, texts


def _digests(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(*paths)
        for batch in batches:
            for first, texts in _steps(batch.column("text")):
                found = align_texts(texts, v)
                groups = written_groups(found, v)
                codes = found.ids_a[found.last_a] * len(v.bytes_b) + found.ids_b[found.last_b]
                links = np.searchsorted(v.pairs, codes).astype("<i4")
                n_groups = np.diff(found.starts_groups)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array(np.diff(found.starts_a), pa.int64()),
                        pa.array(np.diff(found.starts_b), pa.int64()),
                        pa.array(n_groups, pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in groups], pa.string()),
                        pa.array([x.tobytes() for x in np.split(links, found.starts_groups[1:-1])], pa.binary()),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
                )

    return run


def _blobs(table: np.ndarray) -> pa.RecordBatch:
    """The chunks of a table of counts in which anything was counted."""
    chunks = [(k, table[i : i + CHUNK]) for k, i in enumerate(range(0, len(table), CHUNK))]
    chunks = [(k, c) for k, c in chunks if c.any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in chunks], pa.int32()), pa.array([zlib.compress(c.tobytes(), 1) for _, c in chunks], pa.binary())],
        names=["chunk", "counts"],
    )


def _partial_counts(n_pairs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(n_pairs, np.int64)
        for batch in batches:
            links = np.frombuffer(b"".join(batch.column("links").to_pylist()), "<i4")
            table += np.bincount(links, minlength=n_pairs)
        yield _blobs(table)

    return run


def _summed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(zlib.decompress(counts), np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([zlib.compress(c.tobytes(), 1) for c in sums.values()], pa.binary())],
        names=["chunk", "counts"],
    )


def pair_counts(linked: DataFrame, v: Vocabularies) -> np.ndarray:
    """How many links of the corpus hold each pair of ids, in the order of ``v.pairs``.

    The table's length is set by the vocabularies (some megabytes), not by the corpus, so
    that each task may hold one and the driver the sum.
    """
    kind = "chunk int, counts binary"
    parts = linked.select("links").mapInArrow(_partial_counts(len(v.pairs)), kind)
    table = np.zeros(len(v.pairs), np.int64)
    for row in parts.repartition("chunk").mapInArrow(_summed_counts, kind).collect():
        part = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
        table[row["chunk"] * CHUNK : row["chunk"] * CHUNK + len(part)] = part
    return table


def _weighed(told):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = told.value  # by pair: its count, and whether that is the highest of its id of B
        for batch in batches:
            links = batch.column("links").to_pylist()
            sizes = np.array([len(x) // 4 for x in links], np.int64)
            pairs = np.frombuffer(b"".join(links), "<i4")
            ends = np.concatenate([[0], np.cumsum(sizes)])
            sums = [np.concatenate([[0], np.cumsum(x[pairs], dtype=np.int64)])[ends] for x in (best, counts)]
            kept = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")]
            made = [pa.array(sizes, pa.int64()), *(pa.array(np.diff(x), pa.int64()) for x in sums)]
            yield pa.RecordBatch.from_arrays(
                [*kept, *made, batch.column("groups_sha256")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return run


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: tokens of both, groups, links, and how common the links are in the corpus.

    ``n_best`` counts the links whose pair is the most frequent of its id of B (ties included),
    ``count_sum`` adds up the counts of all links.  Texts are encoded once; the pairs of each
    document are stored, counted, and read again.
    """
    spark = docs.sparkSession
    kind = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary"
    linked = stored(_inputs(docs).mapInArrow(_digests((path_a, path_b)), kind), "token-links")
    v = vocabularies(path_a, path_b)
    counts, pair_b = pair_counts(linked, v), v.pair_b
    best = np.zeros(len(v.bytes_b), np.int64)
    np.maximum.at(best, pair_b, counts)
    told = spark.sparkContext.broadcast((counts, counts == best[pair_b]))
    kind = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return linked.mapInArrow(_weighed(told), kind)


def _groups(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(*paths)
        for batch in batches:
            for first, texts in _steps(batch.column("text")):
                found = align_texts(texts, v)
                text = np.searchsorted(found.starts_groups, np.arange(len(found.last_a)), "right") - 1
                ends = found.ends_a[found.last_a]
                arrays = []
                for last, ids, starts in ((found.last_a, found.ids_a, found.starts_a), (found.last_b, found.ids_b, found.starts_b)):
                    cuts = np.concatenate([[0], last + 1])
                    arrays += [pa.array(cuts[:-1] - starts[text], pa.int64())]
                    arrays += [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))]
                begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)).take(pa.array(text)),
                        pa.array(np.arange(len(text)) - found.starts_groups[text], pa.int64()),
                        pa.array(begin - found.offsets[text], pa.int64()),
                        pa.array(ends - found.offsets[text], pa.int64()),
                        *arrays,
                    ],
                    names=["doc_id", "group", "start_byte", "end_byte", "first_a", "ids_a", "first_b", "ids_b"],
                )

    return run


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per group: its bytes in space + text, and the tokens of both lists with the rank of the first."""
    kind = (
        "doc_id bigint, group bigint, start_byte bigint, end_byte bigint, "
        "first_a bigint, ids_a array<int>, first_b bigint, ids_b array<int>"
    )
    return _inputs(docs).mapInArrow(_groups((path_a, path_b)), kind)


def overlap_ranges(found: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of the longer list (over all texts) whose bytes each driving token overlaps."""
    n = np.where(found.drives_a, np.diff(found.starts_a), np.diff(found.starts_b))
    first = np.zeros(len(found.place), np.int64)
    at = 0
    for k, size in enumerate(n.tolist()):
        own, other = (found.ends_a, found.ends_b) if found.drives_a[k] else (found.ends_b, found.ends_a)
        own_start = (found.starts_a if found.drives_a[k] else found.starts_b)[k]
        other_start = (found.starts_b if found.drives_a[k] else found.starts_a)[k]
        place = found.place[at : at + size]
        met = other[place] == own[own_start : own_start + size]
        first[at : at + size] = np.concatenate([[other_start], (place + met)[:-1]])[:size]
        at += size
    return first, found.place


def _overlaps(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(*paths)
        for batch in batches:
            for begin, texts in _steps(batch.column("text")):
                found = align_texts(texts, v)
                first, last = overlap_ranges(found)
                n = np.where(found.drives_a, np.diff(found.starts_a), np.diff(found.starts_b))
                text = np.repeat(np.arange(len(texts)), n)
                rank = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
                other = np.where(found.drives_a, found.starts_b[:-1], found.starts_a[:-1])[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, len(texts)).take(pa.array(text)),
                        pa.array(np.where(found.drives_a, "a", "b")[text], pa.string()),
                        pa.array(rank, pa.int64()),
                        pa.array(first - other, pa.int64()),
                        pa.array(last - other, pa.int64()),
                    ],
                    names=["doc_id", "side", "token", "first_other", "last_other"],
                )

    return run


def overlaps(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """For each token of the list with fewer tokens (``side``): the ranks of the first and last token it overlaps in the other."""
    kind = "doc_id bigint, side string, token bigint, first_other bigint, last_other bigint"
    return _inputs(docs).mapInArrow(_overlaps((path_a, path_b)), kind)
