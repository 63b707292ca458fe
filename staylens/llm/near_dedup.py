"""Near-duplicate documents by improved consistent weighted sampling.

A text is a weighted set of shingles (five consecutive words): log-scaled count times a
damped inverse document frequency, so that passages which many documents share weigh less
than a text's own words.  Consistent weighted sampling draws, for each of ``BANDS * ROWS``
draws, one shingle with a chance in proportion to its weight; two texts draw the same with
the probability of their weighted Jaccard similarity.  Texts that agree in all draws of a
band are candidates, and a candidate pair is linked if its exact weighted Jaccard similarity
reaches the threshold.  Linked texts form classes.

Document frequencies are counted over all documents into a table of fixed width.

Work stays linear in the size of a group.  Equal texts are one node.  In a bucket every node
is compared with one hub, not with every other, and in a second round with a few other hubs if
they are not yet in one class.  Only where a bucket's nodes are then still in different
classes, nodes of different classes are compared, by many more draws first, so that no link
between different classes is lost.  Two nodes are compared in one of the buckets they share, and a
large bucket is cut into lanes, so that no task compares more than a lane with a bucket.

Joins of the rounds are merge joins: broadcast, their sides would go through the driver, texts among them.
Rows that are dealt out are narrow: nodes are numbered, buckets hold numbers alone, a draw is
kept as one byte, a further draw as four bits, and a text goes to the hub it is compared with.
"""

from __future__ import annotations

import math
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.workspace import stored
from staylens.llm.components import flattened, merged
from staylens.llm.fetch import marked_rows
from staylens.llm.rows import small_batches, text_digest, unused
from staylens.llm.words import mix, shingle_hashes, text_buffer, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 3  # a pair at similarity 0.8 shares no band with probability 0.0002
AGREEMENT = 20 / 36  # share of equal draws below which no text is compared; 0.8 is 3.7 deviations above
FINE = 512  # further draws of the texts that are still apart after the rounds with hubs
PLANES = 4  # bits of each further draw
LANE = 512  # nodes of a bucket that one task compares with the whole bucket, about
SPREAD = 0.25  # how much more than the most frequent shingle the rarest weighs
HUB_HASHES = 3  # masks that order numbers anew; each gives a bucket two hubs
WIDTH_BITS = 20  # of the document frequency table
CHUNK = 4096  # bins of the table in one row while it is added up
DRAW_BITS = 14  # of the tables of random variables
GROUP_BYTES = 1 << 19  # text looked at in one numpy step

Weighted = tuple[np.ndarray, np.ndarray, np.ndarray]


def _groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Shingles of a batch, some documents at a time: first and last document, document of each shingle, hash."""
    data, offsets = text_buffer(column)
    first, n = 0, len(column)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, "right")) - 1
        last = min(max(last, first + 1), n, first + 60_000)
        words, starts = word_hashes(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        shingles, ends = shingle_hashes(words, starts, SHINGLE)
        yield first, last, np.repeat(np.arange(last - first, dtype=np.uint64), np.diff(ends)), shingles
        first = last


def _counted(owner: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document, 48 bits of their hash, and how often they occur."""
    keys, counts = np.unique((owner << np.uint64(48)) | (shingles >> np.uint64(16)), return_counts=True)
    return (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1), counts


def _bins(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(48 - WIDTH_BITS)).astype(np.int64)


def _partial_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, rows = np.zeros(1 << WIDTH_BITS, np.int32), 0
    for batch in batches:
        rows += batch.num_rows
        for _, _, owner, shingles in _groups(batch.column("text")):
            bins = _bins(_counted(owner, shingles)[1])
            table += np.bincount(bins, minlength=len(table)).astype(np.int32)
    chunks = [table[i : i + CHUNK] for i in range(0, len(table), CHUNK)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(chunks)), pa.int32()),
            pa.array([zlib.compress(c.tobytes(), 1) for c in chunks], pa.binary()),
            pa.array([rows] + [0] * (len(chunks) - 1), pa.int64()),
        ],
        names=["chunk", "counts", "docs"],
    )


def _summed_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    docs = 0
    for batch in batches:
        for chunk, counts, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(zlib.decompress(counts), np.int32)
            sums[chunk] = sums.get(chunk, 0) + part.astype(np.int64)
            docs += n
    if sums:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([zlib.compress(v.tobytes(), 1) for v in sums.values()], pa.binary()),
                pa.array([docs] + [0] * (len(sums) - 1), pa.int64()),
            ],
            names=["chunk", "counts", "docs"],
        )


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Damped inverse document frequency by bin, from 1 (in all documents) to ``1 + SPREAD`` (in hardly any).

    The damping keeps the similarity of two texts close to their plain Jaccard similarity, so
    that a large group of near copies, whose common shingles are frequent for being copied, is
    not torn apart.

    The table has ``2 ** WIDTH_BITS`` bins whatever the input is, so that its few megabytes
    may go through the driver and be broadcast.
    """
    kind = "chunk int, counts binary, docs bigint"
    parts = docs.select("text").mapInArrow(_partial_frequencies, kind)
    rows = parts.repartition("chunk").mapInArrow(_summed_frequencies, kind).collect()
    table, total = np.zeros(1 << WIDTH_BITS, np.int64), 0
    for row in rows:
        at = row["chunk"] * CHUNK
        table[at : at + CHUNK] += np.frombuffer(zlib.decompress(row["counts"]), np.int64)
        total += row["docs"]
    rarity = np.log1p(total / np.maximum(table, 1)) / math.log(2 + total)
    return (1 + SPREAD * rarity.clip(0, 1)).astype(np.float32)


def _weights(shingles: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(counts)).astype(np.float32) * idf[_bins(shingles)]


POOL = 1 << 18  # random variables that the draws' tables are cut from, a few megabytes a worker
_pool: list[np.ndarray] = []


def _draw_table(draw: int) -> tuple[np.uint64, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Multiplier of a draw, and its random variables, picked by a shingle's hash.

    Tables are stretches of one pool; the multiplier deals shingles to places anew for each draw.
    With ``r`` and ``c`` Gamma(2, 1) and ``beta`` uniform, a shingle of weight ``w`` has the level
    ``t = floor(log w / r + beta)`` and the key ``log c - r (t - beta + 1)``; the least key is drawn.
    """
    if not _pool:
        rng = np.random.default_rng(7)
        r, c, beta = rng.gamma(2, 1, POOL), rng.gamma(2, 1, POOL), rng.random(POOL)
        _pool.extend(t.astype(np.float32) for t in (1 / r, beta, np.log(c) + r * (beta - 1), r))
    rng = np.random.default_rng([7, draw])
    odd = np.uint64(int(rng.integers(1 << 62, 1 << 63)) * 2 + 1)
    start = int(rng.integers(POOL - (1 << DRAW_BITS)))
    return (odd, *(t[start : start + (1 << DRAW_BITS)] for t in _pool))


def draws(
    owner: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n_draws: int, first: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The documents that have shingles, and 32 bits for the shingle and level that each draw picks."""
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    picked = np.zeros((len(heads), n_draws), np.uint32)
    if not len(heads):
        return owner[heads], picked
    log_weight, size = np.log(weights), len(shingles)
    level, some = np.empty(size, np.float32), np.empty(size, np.float32)
    spot, name = np.empty(size, np.int64), np.empty(size, np.uint64)
    for k in range(n_draws):
        odd, inverse, beta, high, r = _draw_table(first + k)
        np.multiply(shingles, odd, out=name)
        np.right_shift(name, np.uint64(64 - DRAW_BITS), out=spot.view(np.uint64))
        np.take(inverse, spot, out=level, mode="clip")
        level *= log_weight
        np.take(beta, spot, out=some, mode="clip")
        level += some
        np.floor(level, out=level)
        np.right_shift(name, np.uint64(12), out=name)
        name ^= level.astype(np.int64).view(np.uint64) * np.uint64(2654435761)
        name &= np.uint64(0xFFFFFFFF)
        np.take(r, spot, out=some, mode="clip")
        level *= some
        np.take(high, spot, out=some, mode="clip")
        some -= level
        bits = some.view(np.int32)
        order = (bits ^ ((bits >> 31) | np.int32(-(1 << 31)))).view(np.uint32).astype(np.uint64)
        order <<= np.uint64(32)
        order |= name
        picked[:, k] = np.minimum.reduceat(order, heads).astype(np.uint32)
    return owner[heads], picked


def _folded(picked: np.ndarray, bits: int) -> np.ndarray:
    """So many bits of each draw: equal for equal draws, and by chance for others."""
    return (picked * np.uint32(2654435761)) >> np.uint32(32 - bits)


def _signatures(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n_draws = idf.value, BANDS * ROWS
        band = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            for first, last, owner, shingles in _groups(batch.column("text")):
                owner, shingles, counts = _counted(owner, shingles)
                weights = _weights(shingles, counts, table)
                having, picked = draws(owner, shingles, weights, n_draws)
                mass = np.bincount(owner, weights, last - first)
                keys = np.zeros((len(having), BANDS), np.uint64)
                for row in range(ROWS):
                    keys = mix(keys + picked[:, row::ROWS].astype(np.uint64) + band * np.uint64(1 << 33))
                part = batch.slice(first, last - first)
                sizes = np.zeros(last - first, np.int32)
                sizes[having] = 1
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("node"),
                        pa.array(mass, pa.float64()),
                        pa.ListArray.from_arrays(ends * n_draws, pa.array(_folded(picked, 8).astype(np.uint8).ravel().view(np.int8))),
                        pa.ListArray.from_arrays(ends * BANDS, pa.array(keys.ravel().view(np.int64))),
                    ],
                    names=["doc_id", "node", "mass", "draws", "keys"],
                )

    return run


def _planes(side: str = "") -> list[str]:
    """Columns of the bits of further draws, the first one first."""
    return [f"{side}fine", *(f"{side}fine_{p}" for p in range(1, PLANES))]


def _fine_draws(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, owner, shingles in _groups(batch.column("text")):
                owner, shingles, counts = _counted(owner, shingles)
                having, picked = draws(owner, shingles, _weights(shingles, counts, idf.value), FINE, BANDS * ROWS)
                ids = batch.column("id").slice(first, last - first).take(pa.array(having))
                ends = pa.array(np.arange(len(having) + 1, dtype=np.int32) * (FINE // 64))
                bits = _folded(picked, PLANES)
                planes = [(bits >> np.uint32(PLANES - 1 - p) & np.uint32(1)).astype(np.uint8) for p in range(PLANES)]
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.packbits(p, axis=1).view(np.int64).ravel())) for p in planes]
                yield pa.RecordBatch.from_arrays([ids, *lists], names=["id", *_planes()])

    return run


def weighted_set(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of one text, ascending, and their weights."""
    _, _, owner, shingles = next(_groups(pa.array([text], pa.large_string())))
    _, shingles, counts = _counted(owner, shingles)
    return shingles, _weights(shingles, counts, idf).astype(np.float64)


def weighted_jaccard(one: tuple, other: tuple) -> float:
    """Sum of the lesser weights by the sum of the greater; 0 if neither has a shingle."""
    if len(one[0]) > len(other[0]):
        one, other = other, one
    if not len(one[0]):
        return 0.0
    at = np.minimum(np.searchsorted(other[0], one[0]), len(other[0]) - 1)
    both = other[0][at] == one[0]
    least = np.minimum(one[1][both], other[1][at[both]]).sum()
    return float(least / (one[1].sum() + other[1].sum() - least))


SET_SHINGLES = 3_000_000  # of the weighted sets that a task keeps at hand


class _Sets:
    """Weighted sets of the latest texts: pairs of one group ask for the same ones again and again."""

    def __init__(self, idf: np.ndarray):
        self.idf, self.held, self.size = idf, OrderedDict(), 0

    def of(self, node: int, text: pa.Scalar) -> tuple:
        if node not in self.held:
            made = self.held[node] = weighted_set(text.as_py(), self.idf)
            self.size += len(made[0])
            while self.size > SET_SHINGLES and len(self.held) > 1:
                self.size -= len(self.held.popitem(last=False)[1][0])
        self.held.move_to_end(node)
        return self.held[node]


def _verified(idf, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(idf.value)
        for batch in batches:
            u, v, similar = [], [], []
            ids = (batch.column(c).to_pylist() for c in ("a", "b"))
            for a, b, text, hub_text in zip(*ids, batch.column("text"), batch.column("hub_text"), strict=True):
                similarity = weighted_jaccard(sets.of(a, text), sets.of(b, hub_text))
                if similarity >= threshold:
                    u.append(a)
                    v.append(b)
                    similar.append(similarity)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(similar, pa.float64())], names=["u", "v", "similarity"]
            )

    return run


def _equal(one: str, other: str) -> Column:
    return F.size(F.filter(F.zip_with(F.col(one), F.col(other), lambda x, y: x == y), lambda same: same))


def _promising(threshold: float) -> Column:
    """Weights and draws of ``a_`` and ``b_`` allow the pair to reach the threshold."""
    ma, mb = F.col("a_mass"), F.col("b_mass")
    return (F.least(ma, mb) >= threshold * 0.999 * F.greatest(ma, mb)) & (_equal("a_draws", "b_draws") >= round(AGREEMENT * BANDS * ROWS))


def _still_promising(threshold: float) -> Column:
    """The bits of further draws allow it too; a pair at the threshold fails with probability 0.0002."""
    same = (1 + threshold) / 2  # unlike draws have equal bits half the time
    least = same - 3.5 * (same * (1 - same) / FINE) ** 0.5
    differ = F.aggregate(F.zip_with("a_fine", "b_fine", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return differ <= int((1 - least) * FINE)


def _finely_promising(threshold: float) -> Column:
    """All bits of further draws allow it too, which tells more sharply; a pair at the threshold fails with probability 0.0001."""
    same = threshold + (1 - threshold) / 2**PLANES
    least = same - 3.7 * (same * (1 - same) / FINE) ** 0.5

    def differ(i: int) -> Column:
        planes = zip(_planes("a_"), _planes("b_"), strict=True)
        return F.bit_count(reduce(Column.bitwiseOR, (F.get(F.col(x), F.lit(i)).bitwiseXOR(F.get(F.col(y), F.lit(i))) for x, y in planes)))

    return reduce(add, map(differ, range(FINE // 64))) <= int((1 - least) * FINE)


def _first_shared() -> Column:
    """``key`` is the least of the buckets that ``a`` and ``b`` share."""
    return F.array_min(F.array_intersect("a_keys", "b_keys")) == F.col("key")


def _pairs_across(told: DataFrame, nodes: DataFrame, fine: DataFrame, threshold: float) -> DataFrame:
    """Pairs (``a``, ``b``, no pair twice) of nodes of different classes that share an open bucket and may be similar enough.

    A pair that shares many buckets is taken from one of them: nodes of different classes leave all their
    buckets open.  A node stands in one lane of its bucket on one side, and in all lanes on the other.
    """
    rest = told.join(nodes.select("id", "mass", "draws", "keys").join(fine, "id"), "id")
    names = ("root", "mass", "draws", "keys", *_planes())
    lanes = F.ceil(F.col("n") / LANE)

    def side(name: str, lane: Column) -> list[Column]:
        return ["key", lane.alias("lane"), F.col("id").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in names)]

    one = rest.select(*side("a", F.pmod(F.xxhash64("id"), lanes)))
    other = rest.select(*side("b", F.explode(F.sequence(F.lit(0).cast("bigint"), lanes - 1))))
    other = other.withColumnsRenamed({"key": "other_key", "lane": "other_lane"})
    here = (F.col("key") == F.col("other_key")) & (F.col("lane") == F.col("other_lane")) & (F.col("a_root") < F.col("b_root"))
    likely = _still_promising(threshold) & _finely_promising(threshold) & _promising(threshold)
    return one.join(other, here & likely & _first_shared()).select("a", "b")


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted``, with ``text``, stored; it has ``node`` and ``doc_id`` of the node's row to be read.

    Other rows are dropped at the scan, copies of the text as well.
    """
    wanted = stored(wanted, "wanted")
    mark = F.xxhash64("node", "doc_id")
    some = marked_rows(texts.withColumn("mark", mark), "mark", wanted.select(mark.alias("mark")))
    some = some.groupBy("node").agg(F.first("text").alias("text"))
    return stored(some.join(wanted.drop("doc_id").hint("merge"), "node").drop("node"), "candidate-texts")


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs of nodes (``a``, ``b``; no pair twice) whose whole texts are similar enough: ``u``, ``v``, ``similarity``.

    A text is dealt to each ``b`` it is compared with; that one's text is there once.
    """
    sides = pairs.select(F.col("a").alias("id"), F.col("b").alias("with")).unionByName(
        pairs.select(F.col("b").alias("id"), F.lit(None).cast("bigint").alias("with"))
    )
    sides = sides.groupBy("id").agg(F.collect_list("with").alias("hubs"), F.max(F.col("with").isNull()).alias("is_hub"))
    chosen = _texts_of(texts, nodes.select("id", "node", "doc_id").join(sides, "id"))
    some = chosen.select(F.col("id").alias("a"), "text", F.explode("hubs").alias("b"))
    hubs = chosen.where("is_hub").select(F.col("id").alias("b"), F.col("text").alias("hub_text"))
    joined = some.join(hubs.hint("merge"), "b").select("a", "b", "text", "hub_text")
    found = joined.mapInArrow(_verified(idf, threshold), "u bigint, v bigint, similarity double")
    return stored(found, "links")


def _open_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members (``key``, ``id``), with their classes, of the buckets that hold more than one class; ``n`` is a bucket's size."""
    told = members.select("key", "id").join(found.withColumnRenamed("node", "id").hint("merge"), "id", "left")
    told = stored(told.select("key", "id", F.coalesce("root", "id").alias("root")), "bucket-classes")
    apart = told.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n")).where("x <> y")
    return stored(told.join(apart.select("key", "n").hint("merge"), "key"), "open-buckets")


def _drawn_pairs(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (``a``, ``b``, no pair twice) that weights and draws allow, with ``equal``, the number of equal draws."""
    light = nodes.select("id", "mass", "draws")
    joined = pairs.join(light.toDF("a", "a_mass", "a_draws").hint("merge"), "a").join(light.toDF("b", "b_mass", "b_draws").hint("merge"), "b")
    return joined.where(_promising(threshold)).select("a", "b", _equal("a_draws", "b_draws").alias("equal"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Classes of near-duplicate documents, and the links between different texts they rest on.

    The first table has one row per row of ``docs``: ``doc_id``, ``node`` (digest of the text),
    ``class_node`` and ``class_id`` (the least id in the class).  The second has ``u``, ``v``
    (digests) and ``similarity``.  NULL and empty texts are equal texts.  A text of fewer than
    five words is one shingle; texts without any word are in a class with equal texts only.
    Rows that repeat are in one class.  NULL ids are least of none: a class of only such
    rows has the class_id NULL.  Other columns than ``doc_id`` and ``text`` are not read.
    """
    if threshold < THRESHOLD:
        raise ValueError(f"bands and filters are laid out for similarities of {THRESHOLD} and more")
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    base = base.withColumn("node", text_digest())
    idf = spark.sparkContext.broadcast(document_frequencies(base))
    kind = "doc_id bigint, node string, mass double, draws array<tinyint>, keys array<bigint>"
    rows = stored(base.select("doc_id", "node", "text").mapInArrow(_signatures(idf), kind), "signatures")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("mass", "draws", "keys")))
    nodes = stored(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")

    members = nodes.select("id", F.explode(F.array_distinct("keys")).alias("key"))
    shared = members.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top")).where("hub < top")
    members = stored(members.join(shared.select("key", "hub"), "key"), "buckets")

    # every node with the likeliest of the least nodes of its buckets
    hubs = members.where("id <> hub").groupBy(F.col("id").alias("a")).agg(F.collect_set("hub").alias("hubs"))  # a bucket of each band at most
    pairs = hubs.select("a", F.explode("hubs").alias("b"))
    best = _drawn_pairs(pairs, nodes, threshold).groupBy("a").agg(F.max(F.struct("equal", "b")).alias("best"))
    links = _links(stored(best.select("a", "best.b"), "first-pairs"), nodes, base, idf, threshold)
    found = flattened(links.select(F.col("u").alias("node"), F.col("v").alias("root")))  # a node has one hub, which is less

    # where a bucket's nodes are still apart, with a few other hubs
    told = _open_members(members, found)
    masks = [0x2545F4914F6CDD1D * (i + 1) % (1 << 63) for i in range(HUB_HASHES)]
    hubs = [f(F.struct(F.col("id").bitwiseXOR(F.lit(mask)), "id", "root")) for mask in masks for f in (F.min, F.max)]
    ends = told.groupBy("key").agg(F.array_distinct(F.array(*(F.struct(h["id"].alias("id"), h["root"].alias("root")) for h in hubs))).alias("hubs"))
    pairs = told.join(ends.hint("merge"), "key").select("id", "root", F.explode("hubs").alias("hub")).where("root <> hub.root")
    pairs = pairs.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
    pairs = stored(_drawn_pairs(pairs, nodes, threshold).select("a", "b"), "further-pairs")
    if not pairs.isEmpty():
        further = _links(pairs, nodes, base, idf, threshold)
        links, found = links.unionByName(further), merged(further, found)
        told = _open_members(told, found)

    # what is still apart in a bucket is compared across classes
    texts = _texts_of(base, nodes.select("id", "node", "doc_id").join(told.select("id").distinct(), "id"))
    kind = ", ".join(["id bigint", *(f"{c} array<bigint>" for c in _planes())])
    fine = stored(texts.mapInArrow(_fine_draws(idf), kind), "fine-draws")
    across = stored(_pairs_across(told, nodes, fine, threshold), "pairs-across")
    if not across.isEmpty():
        further = _links(across, nodes, base, idf, threshold)
        links, found = links.unionByName(further), merged(further, found)

    classes = nodes.join(found.toDF("id", "root"), "id", "left").select("node", "doc_id", "id", F.coalesce("root", "id").alias("root"))
    least = classes.groupBy("root").agg(F.min("node").alias("class_node"), F.min("doc_id").alias("class_id"))
    classes = stored(classes.join(least, "root").select("id", "node", "class_node", "class_id"), "classes")
    names = classes.select("id", "node")
    links = links.join(names.toDF("u", "one"), "u").join(names.toDF("v", "other"), "v")
    links = links.select(F.least("one", "other").alias("u"), F.greatest("one", "other").alias("v"), "similarity")
    return rows.select("doc_id", "node").join(classes.drop("id"), "node"), links


def without_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class: the one with the least id, all columns as they were."""
    classes, _ = near_duplicates(docs, threshold)
    key, kept_id = unused(docs, "text_key"), unused(docs, "kept_id")
    least = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_node")
    ids = stored(least.agg(F.min("node").alias(key), F.first("class_id").alias(kept_id)).drop("class_node"), "kept")  # a row per class
    rows = docs.withColumn(key, text_digest()).join(ids, key).where(F.col("doc_id").cast("bigint").eqNullSafe(F.col(kept_id)))
    return rows.dropDuplicates([key]).drop(key, kept_id)
