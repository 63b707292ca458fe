"""Packing documents into sequences by cutting-stock column generation.

A document's ids are cut into full sequences and a remainder.  Remainders are packed from
their length histogram alone, which has at most ``capacity - 1`` bars whatever the corpus:
a linear program chooses how often to use which pattern (numbers of remainders of each
length that fit one sequence), new patterns are priced by a knapsack dynamic program over
the dual values, and the use counts are rounded down.  Patterns are assigned to documents by
rank: remainders of a length are numbered, and a pattern takes a run of numbers.

What rounding leaves over is laid end to end into the gaps of patterns and then into sequences
of its own, cut where a place is full; the very last ids go into sequences of powers of two,
which need no padding.  Where that is too little for the gaps, uses of the patterns with the
widest gaps are given up, whole runs of ranks at a time, and their remainders are cut as well.
A remainder's pieces follow from its length and rank, so that the driver lists none of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.workspace import stored
from staylens.llm.rows import small_batches, text_digest

CAPACITY = 2048
END = 1  # id after each document
ROUNDS = 200  # of column generation; stopping early costs some padding, never a document
GAP = 1e-3  # relative distance to the lower bound at which column generation stops
LANE = 20_000  # remainders of one length numbered in one task, about
REMEMBERED = 300_000  # pieces of text whose ids a task keeps at hand

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
UNUSUAL = regex.compile(r"\s\s|^\s|\s$|[^\S \n]")


class Tokenizer:
    """Ids of a byte-level BPE vocabulary file, as ``tokenizers`` gives them without special tokens put around.

    The file's added tokens are found inside texts, the longest first, and split them.  The
    merging is done by ``tiktoken``, which gives the same ids and takes less time.
    A single space or line break between other characters always starts a new piece, so that
    most texts split into pieces with a plain ``split`` and are looked up piece by piece.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model = made["model"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in shown}
        letters.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)})
        ranks = {}
        for token, number in model["vocab"].items():
            if all(c in letters for c in token):
                ranks[bytes(letters[c] for c in token)] = number
        self.added = {t["content"]: np.array([t["id"]], np.uint32) for t in made.get("added_tokens") or ()}
        odd = [t["content"] for t in made.get("added_tokens") or () if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
        if odd:
            raise ValueError(f"added tokens that take spaces or whole words are not supported: {odd}")
        for token in self.added:
            ranks.pop(token.encode(), None)
        longest = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile(f"({'|'.join(map(regex.escape, longest))})").split if longest else None
        self.encoding = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        made = np.array(self.encoding.encode_ordinary(piece), np.uint32).tobytes()
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[piece] = made
        return made

    def ids(self, text: str) -> np.ndarray:
        """Ids of the whole text."""
        if self.split is None or not any(token in text for token in self.added):
            return self._ids(text)
        parts = self.split(text)  # every second one is an added token
        return np.concatenate([self.added[part] if k % 2 else self._ids(part) for k, part in enumerate(parts)])

    def _ids(self, text: str) -> np.ndarray:
        """Ids of a text without added tokens."""
        if not text or UNUSUAL.search(text):
            return np.array(self.encoding.encode_ordinary(text), np.uint32)
        known, out = self.known, []
        for n, line in enumerate(text.split("\n")):
            if n:
                out.append(known.get("\n") or self._piece("\n"))
            first, *rest = line.split(" ")
            out.append(known.get(first) or self._piece(first))
            for word in rest:
                word = " " + word
                out.append(known.get(word) or self._piece(word))
        return np.frombuffer(b"".join(out), np.uint32)


_tokenizers: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


def _document_ids(path: str, text: str) -> np.ndarray:
    return np.append(tokenizer(path).ids(text), np.uint32(END)).astype("<u4")


# ---------------------------------------------------------------- the plan


def _knapsack(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable pattern: ``value[l]`` for each length; returns its value and its counts by length."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    worth = np.maximum(value, 0)
    for c in range(1, capacity + 1):
        with_ = worth[1 : c + 1] + best[c - 1 :: -1][:c]
        k = int(with_.argmax())
        best[c], last[c] = with_[k], k + 1
    counts, c = np.zeros(capacity + 1, np.int64), capacity
    while c > 0:
        if value[last[c]] > 0:
            counts[last[c]] += 1
        c -= int(last[c])
    return float(best[capacity]), counts


def _greedy(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A first basis: take the longest that fits, and use the pattern until one of its lengths is used up.

    Each pattern uses up one length that no later pattern holds, so that the patterns are a
    basis (triangular, in that order), and the use counts meet the demand exactly.
    """
    left, alive = counts.astype(float), np.flatnonzero(counts)
    basis, amount = [], []
    while len(alive):
        pattern, room, among = np.zeros(len(counts)), capacity, alive
        while len(among) and among[0] <= room:
            at = int(np.searchsorted(among, room, "right")) - 1
            length = int(among[at])
            pattern[length] = min(room // length, np.ceil(left[length]))
            room -= int(pattern[length]) * length
            among = among[:at]
        used = np.flatnonzero(pattern)
        ratios = left[used] / pattern[used]
        gone, times = used[ratios.argmin()], ratios.min()
        left[used] = np.maximum(left[used] - times * pattern[used], 1e-12)
        left[gone] = 0
        alive = alive[alive != gone]
        basis.append(pattern)
        amount.append(times)
    return np.array(basis).T, np.array(amount)


def patterns(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS, gap: float = GAP) -> list[tuple[np.ndarray, int]]:
    """Patterns and whole use counts, no more of any length than ``counts`` has.

    Revised simplex: the basis starts with greedy patterns; each round the most valuable
    pattern under the dual values enters, and its value also gives the lower bound that says
    when to stop.  Use counts are rounded down.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return []
    basis, amount = _greedy(counts, capacity)
    basis = basis[lengths]
    inverse = np.linalg.inv(basis)
    for _ in range(rounds):
        value = np.zeros(capacity + 1)
        value[lengths] = inverse.sum(axis=0)
        worth, found = _knapsack(value, capacity)
        if 1 - 1 / worth <= gap:  # the program's optimum is at least amount.sum() / worth
            break
        entering = found[lengths].astype(float)
        direction = inverse @ entering
        going = np.flatnonzero(direction > 1e-9)
        ratios = amount[going] / direction[going]
        leaving = int(going[ratios.argmin()])
        step = ratios.min()
        row = inverse[leaving] / direction[leaving]
        inverse -= np.outer(direction, row)
        inverse[leaving] = row
        amount = np.maximum(amount - step * direction, 0)
        amount[leaving] = step
        basis[:, leaving] = entering
    out, left = [], counts.copy()
    for k in np.argsort(-amount, kind="stable"):
        pattern = np.zeros_like(left)
        pattern[lengths] = np.round(basis[:, k]).astype(np.int64)
        used = pattern > 0
        times = min(int(amount[k] + 1e-6), int((left[used] // pattern[used]).min()))
        if times > 0:
            out.append((pattern, times))
            left -= pattern * times
    return out


@dataclass
class Plan:
    """Where every remainder goes, in tables whose sizes depend on the lengths alone.

    ``runs`` are ranks that stay whole: the remainders ``first`` to ``stop - 1`` of a length,
    ``each`` to a sequence.  Rank ``r`` of a run lies in sequence ``base + (r - first) // each`` at
    ``offset + (r - first) % each * length``.

    All others are laid end to end, the longest first: rank ``r`` of a length begins at ``at + (r -
    first) * length`` of that line, by its row of ``tails``.  ``places`` says where the line
    goes: from ``at`` on, ``times`` sequences from ``base`` on take ``size`` ids each, at ``offset``.
    """

    runs: np.ndarray  # length, first, stop, base, each, offset
    tails: np.ndarray  # length, first, stop, at
    places: np.ndarray  # at, base, times, offset, size
    sequences: int

    def cut(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Pieces of a remainder of the line: start in it, length, sequence and offset there."""
        _, first, _, at = self.tails[np.flatnonzero(self.tails[:, 0] == length)[0]].tolist()
        start = at + (rank - first) * length
        stop, here, out = start + length, start, []
        k = int(np.searchsorted(self.places[:, 0], here, "right")) - 1
        while here < stop:
            begins, base, times, offset, size = self.places[k].tolist()
            nth, inside = divmod(here - begins, size)
            if nth >= times:
                k += 1
                continue
            take = min(size - inside, stop - here)
            out.append((here - start, take, base + nth, offset + inside))
            here += take
        return out


def _filled(chosen: list[tuple[np.ndarray, int]], counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Give up uses of the patterns with the widest gaps until the leftovers can fill all other gaps.

    A use that is given up closes its gap and frees its ids: ``capacity`` fewer are lacking.
    """
    sizes = np.arange(len(counts))
    left = counts - sum((p * t for p, t in chosen), np.zeros_like(counts))
    lacking = sum((capacity - int(sizes @ p)) * t for p, t in chosen) - int(sizes @ left)
    out = []
    for pattern, times in sorted(chosen, key=lambda c: int(sizes @ c[0])):  # stable: widest gap first
        full = int(sizes @ pattern) == capacity
        given = 0 if full else max(0, min(times, -(-lacking // capacity)))
        lacking -= given * capacity
        if times > given:
            out.append((pattern, times - given))
    return out


def plan(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """Place all remainders of a length histogram (``counts[l]`` of length ``l``)."""
    taken, sequence = np.zeros(len(counts), np.int64), 0
    runs, gaps = [], []
    for pattern, times in _filled(patterns(counts, capacity, rounds), counts, capacity):
        offset = 0
        for length in np.flatnonzero(pattern)[::-1]:
            each = int(pattern[length])
            runs.append((length, taken[length], taken[length] + each * times, sequence, each, offset))
            taken[length] += each * times
            offset += each * int(length)
        if offset < capacity:
            gaps.append((sequence, times, offset))
        sequence += times
    tails, total = [], 0
    for length in np.flatnonzero(counts - taken)[::-1]:
        tails.append((length, taken[length], counts[length], total))
        total += int(length) * int(counts[length] - taken[length])
    # gaps of patterns, full sequences, then powers of two
    places, held = [], 0
    for first, times, offset in gaps:
        places.append((held, first, times, offset, capacity - offset))
        held += times * (capacity - offset)
    left = max(total - held, 0)
    if left >= capacity:
        places.append((held, sequence, left // capacity, 0, capacity))
        held, sequence, left = held + left // capacity * capacity, sequence + left // capacity, left % capacity
    while left:
        size = 1 << (left.bit_length() - 1)
        places.append((held, sequence, 1, 0, size))
        held, sequence, left = held + size, sequence + 1, left - size
    return Plan(
        np.array(runs, np.int64).reshape(-1, 6), np.array(tails, np.int64).reshape(-1, 4),
        np.array(places, np.int64).reshape(-1, 5), sequence,
    )


# ---------------------------------------------------------------- the job

PIECES = pa.list_(pa.struct([("at", pa.int32()), ("length", pa.int32()), ("sequence_id", pa.int64()), ("offset", pa.int64())]))


def _tokenized(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            full, sizes, rest, sums = [], [], [], []
            for text in batch.column("text"):
                ids = _document_ids(path, text.as_py())
                whole = len(ids) // capacity
                data = ids.tobytes()
                step = 4 * capacity
                full.append([zlib.crc32(data[k * step : (k + 1) * step]) for k in range(whole)])
                sizes.append(len(ids))
                rest.append(len(ids) % capacity)
                sums.append(zlib.crc32(data[whole * step :]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()),
                    pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.int32()), pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "text_key", "doc_tokens", "full", "rest", "rest_crc32"],
            )

    return run


def _cut_sums(path: str, capacity: int):
    """Checksums of pieces of the documents that are cut: by text, start in the remainder and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            rows = []
            for key, text, cuts in zip(
                batch.column("text_key").to_pylist(), batch.column("text"), batch.column("cuts").to_pylist(), strict=True
            ):
                ids = _document_ids(path, text.as_py())
                base = len(ids) // capacity * capacity
                for cut in cuts:
                    start, length = base + cut["at"], cut["length"]
                    rows.append((key, cut["at"], length, zlib.crc32(ids[start : start + length].tobytes())))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["text_key", "at", "length", "crc32"]
            )

    return run


def _ranked(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """Number the remainders of each length from 0, by lanes, so that no task holds a whole length."""
    lanes = F.array(*(F.lit(int(n) // LANE + 1) for n in counts))
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("text_key", "doc_id"), F.get(lanes, F.col("rest"))))
    sizes = rows.groupBy("rest", "lane").agg(F.count("*").alias("n"))
    before = Window.partitionBy("rest").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("rest", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("rest", "lane").orderBy("doc_id", "text_key")
    rows = rows.withColumn("inside", F.row_number().over(inside) - 1).join(sizes, ["rest", "lane"])
    return rows.withColumn("rank", F.col("first") + F.col("inside")).drop("lane", "first", "inside")


def _placed(made: Plan):
    """Sequence and offset of every remainder that is not cut, -1 for the others."""
    runs = made.runs[np.lexsort((made.runs[:, 1], made.runs[:, 0]))]
    stride = int(runs[:, 2].max(initial=0)) + 1
    keys = runs[:, 0] * stride + runs[:, 1]

    def run(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = length.to_numpy(zero_copy_only=False).astype(np.int64), rank.to_numpy(zero_copy_only=False)
        at = np.full(len(rank), -1)
        if len(keys):
            at = np.searchsorted(keys, length * stride + np.minimum(rank, stride - 1), "right") - 1
        hit = runs[np.maximum(at, 0)] if len(keys) else np.zeros((len(rank), 6), np.int64)
        good = (at >= 0) & (hit[:, 0] == length) & (rank < hit[:, 2]) & (rank >= hit[:, 1])
        k = np.where(good, rank - hit[:, 1], 0)
        each = np.maximum(hit[:, 4], 1)
        sequence = np.where(good, hit[:, 3] + k // each, -1)
        offset = np.where(good, hit[:, 5] + k % each * length, -1)
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence", "offset"])

    return run


def _pieces(made: Plan):
    """Pieces of every remainder that is cut."""

    def run(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = [made.cut(*row) for row in zip(length.to_pylist(), rank.to_pylist(), strict=True)]
        names = ("at", "length", "sequence_id", "offset")
        return pa.array([[dict(zip(names, piece, strict=True)) for piece in row] for row in found], PIECES)

    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Lay all documents (``doc_id``, ``text``) into sequences of at most ``capacity`` ids.

    One row per piece: ``doc_id``, ``start`` and ``length`` in the document's ids,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset`` there.  A document's ids are
    those of its text, then the id ``END``; NULL texts are empty.  Rows that repeat are packed
    each, NULL ids too.  An empty table has no piece.  Sequences are numbered from 0 without
    gaps: those of remainders first, then the full ones.  A text of any length is tokenized whole in
    one task, which then holds its ids; its full sequences are placed like all others.
    """
    small_batches(docs.sparkSession)
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("text_key", text_digest())
    kind = "doc_id bigint, text_key string, doc_tokens bigint, full array<bigint>, rest int, rest_crc32 bigint"
    tokens = stored(base.select("doc_id", "text_key", "text").mapInArrow(_tokenized(path, capacity), kind), "tokens")

    bars = tokens.where("rest > 0").groupBy("rest").count().collect()  # at most capacity - 1 rows
    counts = np.zeros(capacity, np.int64)
    for bar in bars:
        counts[bar["rest"]] = bar["count"]
    made = plan(counts, capacity, rounds)

    ranked = _ranked(tokens.where("rest > 0").drop("full"), counts)
    place = F.arrow_udf(_placed(made), "struct<sequence: bigint, offset: bigint>")
    ranked = stored(ranked.withColumn("place", place(F.col("rest"), F.col("rank"))), "ranked")
    start = F.col("doc_tokens") - F.col("rest")
    whole = ranked.where("place.sequence >= 0").select(
        "doc_id", start.alias("start"), F.col("rest").cast("bigint").alias("length"), F.col("rest_crc32").alias("ids_crc32"),
        "doc_tokens", F.col("place.sequence").alias("sequence_id"), F.col("place.offset").alias("offset"),
    )

    # the line of what is cut; a text's pieces are at most the ways to cut one remainder, however often it repeats
    pieces = F.arrow_udf(_pieces(made), "array<struct<at: int, length: int, sequence_id: bigint, offset: bigint>>")
    cut = ranked.where("place.sequence < 0").select(
        "doc_id", "text_key", "doc_tokens", start.alias("first"), F.explode(pieces(F.col("rest"), F.col("rank"))).alias("piece")
    )
    cut = stored(cut.select("doc_id", "text_key", "doc_tokens", "first", "piece.*"), "cut")
    wanted = cut.groupBy("text_key").agg(F.collect_set(F.struct("at", "length")).alias("cuts"))
    # stored, so that the planner knows its size when it decides how the texts meet it
    texts = base.join(stored(wanted, "cut-texts"), "text_key").groupBy("text_key")
    texts = texts.agg(F.first("text").alias("text"), F.first("cuts").alias("cuts"))
    sums = texts.mapInArrow(_cut_sums(path, capacity), "text_key string, at int, length int, crc32 bigint")
    cut = cut.join(sums, ["text_key", "at", "length"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), F.col("length").cast("bigint").alias("length"),
        F.col("crc32").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )

    # full sequences are numbered after those of remainders, by how many full ones each file part holds
    full = tokens.where(F.size("full") > 0).withColumn("lane", F.pmod(F.xxhash64("text_key", "doc_id"), F.lit(4096)))
    lanes = full.groupBy("lane").agg(F.sum(F.size("full")).alias("n"))
    before = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)  # at most 4096 rows
    lanes = lanes.select("lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("lane").orderBy("doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("inside", F.coalesce(F.sum(F.size("full")).over(inside), F.lit(0))).join(F.broadcast(lanes), "lane")
    full = full.select("doc_id", "doc_tokens", "first", "inside", F.posexplode("full").alias("k", "crc32")).select(
        "doc_id", (F.col("k").cast("bigint") * capacity).alias("start"), F.lit(capacity).cast("bigint").alias("length"),
        F.col("crc32").alias("ids_crc32"), "doc_tokens",
        (F.lit(made.sequences) + F.col("first") + F.col("inside") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    return whole.unionByName(cut).unionByName(full)

