"""Join of documents by the Jaccard similarity of their shingle sets, through parity sketches.

Shingles are hashed to 64 bits.  A set of ``n`` shingles is drawn as a sketch of ``K`` words of
64 bits: a shingle belongs to the word that its leading bits name, and is added to it by
exclusive or.  A shingle that only one of two sets has changes one word, so that no more words
differ than the sets have shingles apart; a second sketch of 2,048 single bits, in which each
shingle turns one bit over, has a Hamming distance that bounds the same number from below.

Sets of sizes ``a`` and ``b`` with similarity ``t`` are at most ``D = (a + b)(1 - t) / (1 + t)``
shingles apart.  Sizes are cut into bands of ratio ``t``, each with a sketch layout of its own,
and a set is laid out in its band and in the one below, where its smaller partners are.  By the
pigeonhole principle a set with more than ``D`` words that are not empty has one of them in
common with each partner, and so two sets meet by an equality join on (layout, place, word);
empty words, which unlike sets share, are not joined on.  A set with too few such words also
joins on all its words, empty ones included, with sets that have too few as well.  No pair is
lost, and unlike sets meet only by sharing the whole content of a word.

Work stays linear in a group of like sets.  Equal sets are one node.  In a bucket all nodes are
compared with the least; only where nodes of a bucket are then still in different classes, they
are compared across classes.  Pairs pass the single-bit sketches first and are verified on the
whole sets, which are made again where a pair is verified: a text, which is shorter than its set, is
dealt to the hub it is compared with.  Nodes are numbered for pairs and classes.  A key that holds
more than its share of all rows, seen in a sample, is split over many buckets whose least nodes
are compared in turn.

Words are split by blanks and lower-cased in A-Z; fewer words than a shingle has are one
shingle.  NULL texts and texts without words have an empty set, which is like nothing.  NULL
ids are least of none.  Rows that repeat keep a row each.  Other columns than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.workspace import stored
from staylens.llm.components import merged
from staylens.llm.fetch import marked_rows
from staylens.llm.words import mix, shingle_hashes, text_buffer, word_hashes

SHINGLE = 5
PERCENT = 80
LEAST_PERCENT = 70  # below, sets have hardly enough words that are not empty
BITS, COARSE = 2048, 512  # of the sketch of single bits, and of the same folded, which rows of buckets carry
MARK_BITS = 48  # of a node's digest, while nodes meet in buckets
GROUP_BYTES = 1 << 19  # text looked at in one step
SAMPLE = 64  # one document in so many is looked at for keys with very many rows
HOT_ROWS, HOT_PART = 50, 10_000  # a key is split if the sample has so many of its rows, and more than that part of all
SPLIT = 20_000  # rows of a split key in one bucket, about

BLANK = [32, *range(9, 14)]
IN_WORD = np.ones(256, bool)
IN_WORD[BLANK] = False


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Place and ascending distinct shingle hashes of every text of a batch."""
    data, offsets = text_buffer(column)
    first, n = 0, len(column)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        words, starts = word_hashes(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], IN_WORD)
        shingles, ends = shingle_hashes(words, starts, SHINGLE)
        for k in range(first, last):
            yield k, np.unique(shingles[ends[k - first] : ends[k - first + 1]])
        first = last


# ---------------------------------------------------------------- sketches


@dataclass
class Layouts:
    """Bands of set sizes, and how many words the sketch of each band has."""

    percent: int
    edges: np.ndarray  # least size of each band
    words: np.ndarray

    def apart(self, total: int) -> int:
        """Shingles that two like sets are apart at most, if their sizes add up to ``total``."""
        return total * (100 - self.percent) // (100 + self.percent)


@lru_cache
def layouts(percent: int = PERCENT) -> Layouts:
    if not LEAST_PERCENT <= percent < 100:
        raise ValueError(f"similarities from {LEAST_PERCENT} to 99 percent can be joined on")
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] * 100 // percent + 1)
    # of K words, K (1 - exp(-n / K)) are not empty; they must be more than the shingles apart
    needed, ratio = 1.04 * (100 - percent) / percent, 0.01
    while ratio * (1 - math.exp(-1 / ratio)) < needed:
        ratio += 0.001
    greatest = np.array(edges[1:]) - 1
    return Layouts(percent, np.array(edges[:-1]), np.ceil(ratio * greatest).astype(np.int64) + 4)


def _keys(layout: int, family: int, places: np.ndarray, words: np.ndarray) -> np.ndarray:
    spot = mix(places.astype(np.uint64) + np.uint64((layout * 2 + family) << 40))
    return mix(words ^ spot) >> np.uint64(64 - MARK_BITS)


def bucket_keys(shingles: np.ndarray, how: Layouts) -> np.ndarray:
    """The keys by which a set that is not empty meets all its partners."""
    n = len(shingles)
    band = int(np.searchsorted(how.edges, n, "right")) - 1
    out = []
    for layout in {band, max(band - 1, 0)}:
        size = int(how.words[layout])
        places = ((shingles >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        heads = np.flatnonzero(np.diff(places, prepend=np.uint64(size)))
        words = np.bitwise_xor.reduceat(shingles, heads)
        places = places[heads]
        out.append(_keys(layout, 0, places, words))
        greatest = n * 100 // how.percent if layout == band else int(how.edges[layout + 1]) - 1
        if len(heads) <= how.apart(n + greatest):
            full = np.zeros(size, np.uint64)
            full[places.astype(np.int64)] = words
            out.append(_keys(layout, 1, np.arange(size), full))
    return np.concatenate(out).view(np.int64)


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """2,048 bits, of which each shingle turns one over, as 32 numbers.

    Folded by exclusive or they are a sketch of fewer bits, of which the same holds.
    """
    bits = np.bincount((shingles >> np.uint64(5)) & np.uint64(BITS - 1), minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def folded(sketch: np.ndarray) -> np.ndarray:
    return np.bitwise_xor.reduce(sketch.reshape(BITS // COARSE, -1))


# ---------------------------------------------------------------- nodes and buckets


def _digest(shingles: np.ndarray) -> str:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()


def _mark(node: str) -> int:
    return int(node[: MARK_BITS // 4], 16)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, sketches = [], [], []
        for _, shingles in shingle_sets(batch.column("text")):
            nodes.append(_digest(shingles) if len(shingles) else None)
            sizes.append(len(shingles))
            sketches.append(bit_sketch(shingles))
        marks = pa.array([_mark(x) if x else None for x in nodes], pa.int64())
        lists = []
        for bits, some in ((BITS, sketches), (COARSE, [folded(x) for x in sketches])):
            flat = np.concatenate(some) if some else np.zeros(0, np.int64)
            ends = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * (bits // 64))
            lists.append(pa.ListArray.from_arrays(ends, pa.array(flat)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, pa.string()), marks, pa.array(sizes, pa.int64()), *lists],
            names=["doc_id", "text_hash", "node", "mark", "n", "sketch", "coarse"],
        )


KNOWN = 1 << 20  # nodes a task remembers, so that copies are put into buckets once


def _bucketed(percent: int, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        how, (hot_keys, parts) = layouts(percent), hot.value
        known: set[int] = set()
        for batch in batches:
            keys, marks = [], []
            for _, shingles in shingle_sets(batch.column("text")):
                if not len(shingles):
                    continue
                mark = _mark(_digest(shingles))
                if mark in known:
                    continue
                if len(known) >= KNOWN:
                    known.clear()
                known.add(mark)
                keys.append(bucket_keys(shingles, how))
                marks.append(np.full(len(keys[-1]), mark, np.int64))
            if not keys:
                continue
            key, mark = np.concatenate(keys), np.concatenate(marks)
            part = np.zeros(len(key), np.int32)
            if len(hot_keys):
                at = np.minimum(np.searchsorted(hot_keys, key), len(hot_keys) - 1)
                found = hot_keys[at] == key
                part[found] = 1 + mix(mark[found].view(np.uint64)) % parts[at[found]].astype(np.uint64)
            for start in range(0, len(key), 1 << 16):
                end = start + (1 << 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[start:end]), pa.array(part[start:end]), pa.array(mark[start:end])], names=["key", "part", "mark"]
                )

    return run


ROWS = "key bigint, part int, mark bigint"


def _hot_keys(base: DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys with very many rows, and into how many buckets to split them.

    They are told from a sample of documents; what is found decides only how rows are dealt,
    not what is compared.  No more than ``HOT_PART`` keys can be found.
    """
    spark = base.sparkSession
    nothing = spark.sparkContext.broadcast((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    some = base.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text")
    counts = some.mapInArrow(_bucketed(percent, nothing), ROWS).groupBy("key").agg(F.count("*").alias("n"))
    counts = stored(counts.where(F.col("n") > 1), "key-sample")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where((F.col("n") >= HOT_ROWS) & (F.col("n") * HOT_PART > total)).orderBy("key").collect()
    keys = np.array([r["key"] for r in found], np.int64)
    return keys, np.array([-(-r["n"] * SAMPLE // SPLIT) + 1 for r in found], np.int64)


# ---------------------------------------------------------------- pairs


def _like(percent: int) -> Column:
    """Sizes and single-bit sketches of ``a_`` and ``b_`` allow the pair to be linked."""
    differ = F.aggregate(
        F.zip_with("a_sketch", "b_sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )
    a, b = F.col("a_n"), F.col("b_n")
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (differ * (100 + percent) <= (a + b) * (100 - percent))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: set[str] = set()
    for batch in batches:
        nodes, places = [], []
        for k, shingles in shingle_sets(batch.column("text")):
            node = _digest(shingles)
            if node in known:
                continue
            if len(known) >= KNOWN:
                known.clear()
            known.add(node)
            nodes.append(node)
            places.append(k)
        texts = batch.column("text").take(pa.array(places, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), texts.cast(pa.string())], names=["node", "text"])


HELD_SHINGLES = 3_000_000  # of the sets that a task keeps at hand


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, np.ndarray] = OrderedDict()
        size = 0
        for batch in batches:
            u, v, both, either = [], [], [], []
            pairs, hub_texts = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True), batch.column("hub_text")
            for (k, one), (a, b) in zip(shingle_sets(batch.column("text")), pairs, strict=True):
                if a not in held:
                    held[a] = next(shingle_sets(hub_texts.slice(k, 1)))[1]
                    size += len(held[a])
                    while size > HELD_SHINGLES and len(held) > 1:
                        size -= len(held.popitem(last=False)[1])
                held.move_to_end(a)
                other = held[a]
                common = len(np.intersect1d(one, other, assume_unique=True))
                union = len(one) + len(other) - common
                if 100 * common >= percent * union:
                    u.append(a)
                    v.append(b)
                    both.append(common)
                    either.append(union)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (u, v, both, either)], names=["u", "v", "common", "total"])

    return run


def _verify(pairs: DataFrame, base: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of pairs of a hub ``a`` and a node ``b`` (no pair twice), those whose whole sets are similar enough."""
    sides = pairs.select(F.col("b").alias("id"), F.col("a").alias("with")).unionByName(
        pairs.select(F.col("a").alias("id"), F.lit(None).cast("bigint").alias("with"))
    )
    sides = sides.groupBy("id").agg(F.collect_list("with").alias("hubs"), F.max(F.col("with").isNull()).alias("is_hub"))
    wanted = stored(nodes.select("id", "node", "text_hash").join(sides, "id"), "wanted")
    texts = marked_rows(base, "text_hash", wanted).select("text").mapInArrow(_texts, "node string, text string")
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    texts = stored(texts.join(wanted.drop("text_hash"), "node").drop("node"), "candidate-texts")
    some = texts.select(F.col("id").alias("b"), "text", F.explode("hubs").alias("a"))
    hubs = texts.where("is_hub").select(F.col("id").alias("a"), F.col("text").alias("hub_text"))
    joined = some.join(hubs, "a").select("a", "b", "text", "hub_text")
    return stored(joined.mapInArrow(_verified(percent), "u bigint, v bigint, common bigint, total bigint"), "links")


def _named(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of marks (``a_mark``, ``b_mark``) as pairs of nodes whose whole sketches allow a link."""
    side = nodes.select("mark", "id", "n", "sketch")
    pairs = pairs.join(side.toDF("a_mark", "a", "a_n", "a_sketch"), "a_mark").join(side.toDF("b_mark", "b", "b_n", "b_sketch"), "b_mark")
    return pairs.where(_like(percent)).drop("a_mark", "b_mark", "a_n", "b_n", "a_sketch", "b_sketch")


def jaccard_links(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Documents by class, and links between different sets that the classes rest on.

    The first table has a row per row of ``docs``: ``doc_id``, ``n_shingles``, ``node`` (digest of
    the set, NULL if it is empty) and ``component_id``, the least id that links reach.  The second has
    ``u``, ``v`` (nodes), ``common`` and ``total`` (sizes of intersection and union); together its
    links join all nodes of a class, but within a class not every link is among them.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    kind = "doc_id bigint, text_hash bigint, node string, mark bigint, n bigint, sketch array<bigint>, coarse array<bigint>"
    rows = stored(base.mapInArrow(_described, kind), "sets")
    nodes = rows.where("n > 0").groupBy("node").agg(
        *(F.first(c).alias(c) for c in ("mark", "n", "sketch", "coarse")),
        F.min("text_hash").alias("text_hash"),
        F.min("doc_id").alias("doc_id"),
    )
    nodes = stored(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")

    hot = spark.sparkContext.broadcast(_hot_keys(base, percent))
    bucket = Window.partitionBy("key", "part")
    dealt = base.select("text").mapInArrow(_bucketed(percent, hot), ROWS)
    dealt = dealt.withColumns({"hub": F.min("mark").over(bucket), "top": F.max("mark").over(bucket)})
    members = dealt.where("hub < top or part > 0").dropDuplicates(["key", "part", "mark"])  # copies met in other tasks
    members = stored(members.select("key", "part", "mark", "hub"), "buckets")

    # every node with the least of its buckets, and the least of split buckets with the least of all
    hubs = members.where("part > 0").select("key", "hub").distinct()
    heads = hubs.groupBy("key").agg(F.min("hub").alias("head"))
    pairs = members.where("hub <> mark").select("hub", "mark")
    pairs = pairs.unionByName(hubs.join(heads, "key").where("head <> hub").select(F.col("head").alias("hub"), F.col("hub").alias("mark")))
    # like sets meet in many buckets; a pair that met but once is left to the comparison across classes
    pairs = pairs.groupBy("hub", "mark").agg(F.count("*").alias("met")).where("met > 1")
    light = nodes.select("mark", "n", "coarse")
    pairs = pairs.join(light.toDF("hub", "a_n", "a_sketch"), "hub").join(light.toDF("mark", "b_n", "b_sketch"), "mark")
    pairs = pairs.where(_like(percent)).select(F.col("hub").alias("a_mark"), F.col("mark").alias("b_mark"), "met")
    pairs = stored(_named(pairs, nodes, percent).where("a <> b"), "hub-pairs")

    # first the hub that a node meets most often, then what hubs are left in other classes
    best = pairs.groupBy("b").agg(F.max(F.struct("met", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
    links = _verify(stored(best, "first-pairs"), base, nodes, percent)
    found = merged(links)
    left = pairs.join(found.toDF("a", "a_root"), "a", "left").join(found.toDF("b", "b_root"), "b", "left")
    left = left.where(~F.coalesce("a_root", "a").eqNullSafe(F.coalesce("b_root", "b"))).select("a", "b")
    left = stored(left.join(best, ["a", "b"], "left_anti"), "further-pairs")
    if not left.isEmpty():
        further = _verify(left, base, nodes, percent)
        links, found = links.unionByName(further), merged(further, found)

    # nodes of one key that are still in different classes are compared across classes
    classes = nodes.join(found.toDF("id", "root"), "id", "left").withColumn("class", F.coalesce("root", "id"))
    classes = stored(classes.select("mark", "class", "n", "coarse"), "classes")
    told = stored(members.select("key", "mark").join(classes.select("mark", "class"), "mark"), "bucket-classes")
    apart = told.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y").select("key")
    rest = told.join(apart, "key").join(classes, ["mark", "class"]).select("key", "mark", "class", "n", "coarse")
    one = rest.toDF("key", "a_mark", "a_class", "a_n", "a_sketch")
    other = rest.toDF("other_key", "b_mark", "b_class", "b_n", "b_sketch")
    across = one.join(other, (F.col("key") == F.col("other_key")) & (F.col("a_class") < F.col("b_class")) & _like(percent))
    across = across.select("a_mark", "b_mark").distinct()
    across = _named(across, nodes, percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    compared = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = stored(across.join(compared, ["a", "b"], "left_anti"), "pairs-across")
    if not across.isEmpty():
        further = _verify(across, base, nodes, percent)
        links, found = links.unionByName(further), merged(further, found)

    told = nodes.select("id", "node", "doc_id").join(found.toDF("id", "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = told.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    told = stored(told.select("id", "node", "root").join(least, "root").select("id", "node", "component_id"), "class-ids")
    links = links.join(told.select(F.col("id").alias("u"), F.col("node").alias("one")), "u")
    links = links.join(told.select(F.col("id").alias("v"), F.col("node").alias("other")), "v")
    links = links.select(F.col("one").alias("u"), F.col("other").alias("v"), "common", "total")
    told = told.drop("id")
    ids = rows.select("doc_id", F.col("n").alias("n_shingles"), "node")
    empty = ids.where("node is null").withColumn("component_id", F.col("doc_id"))
    return ids.join(told, "node").select(*empty.columns).unionByName(empty), links
