"""Hard negatives by a multiway hyperplane tree with stored distance ranges.

Vectors are taken as whole numbers, ``floor(256 * x)``, and compared by inner product.  For a
metric, a row ``x`` gets one more coordinate ``sqrt(M^2 - |x|^2)``, with ``M`` the greatest
length, and an anchor gets 0 there.  The squared distance of an anchor ``q`` from a row is then
``|q|^2 + M^2 - 2 <q, x>``, so that a window of scores is an annulus around the anchor.

A node of the tree has up to ``FANOUT`` split points, and a row goes to the nearest one: the
cells are bounded by hyperplanes.  The split points come from a bounded sample; then every row
descends, and for each split point and each sibling subtree the least and greatest distance of
the point from *all* rows below that sibling are stored.  A search measures the anchor's
distance from the split points; a sibling is left out if the range of distances that its
stored range allows does not meet the annulus.  Leaves that remain are scanned exactly, so
that the results are those of a full scan.

The tree is small and may be broadcast; rows and anchors are not.  Leaves are cut into blocks
of about ``BLOCK`` rows.  An anchor is sent to the blocks that it has to look at; each task
holds one block at a time and lets the anchors stream past.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.workspace import stored

SCALE = 256
FANOUT = 16
SAMPLE = 4096  # rows that split points are drawn from; a bound on the tree, not on the search
SAMPLE_NUMBERS = 1 << 22  # components of those rows, for very long vectors
LEAF = 24  # sampled rows below which a node is not split further
BLOCK = 8192  # rows scanned at a time
ANCHORS = 256  # anchors compared with a block at a time
RELABELLED, ANCHOR_STEP, CLASSES = 7, 100, 10
POSITIVES, NEGATIVES = 5, 10
LOWEST, HIGHEST = 30, 90  # of a hundred parts of the positive's score
SLACK = 1e-6  # of M, for rounding in distances


def quantised(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))


def vectors(rows: DataFrame, relabelled: int = RELABELLED, classes: int = CLASSES) -> DataFrame:
    """``row``, ``vec_id``, ``label``, ``q`` of the rows that take part, stored.

    Rows with a NULL id, label or vector, a component that is NULL or not finite, or a length
    whose square passes ``2 ** 61`` (their scores fit no BIGINT) are left out.  Where ``vec_id``
    is divisible by ``relabelled``, the label becomes ``(label + 1) % classes``.
    """
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    square = F.aggregate(vec, F.lit(0.0), lambda s, x: s + F.pow(x * SCALE, F.lit(2.0)) + F.abs(x * SCALE) * 2 + 1)
    label = F.when(F.col("vec_id") % relabelled == 0, (F.col("label").cast("bigint") + 1) % classes).otherwise(F.col("label").cast("bigint"))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    kept = kept.where(~bad).where(square < 2.0**61)
    made = kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), quantised(vec).alias("q"))
    return stored(made.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "q"), "vectors")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as exact integers.

    No partial sum passes the product of the lengths; below ``2 ** 52`` floating point is exact.
    """
    x, y = anchors.astype(np.float64), rows.astype(np.float64)
    longest = [np.sqrt((m * m).sum(axis=1).max(initial=0.0)) for m in (x, y)]
    if longest[0] * longest[1] < 2.0**52:
        return (x @ y.T).astype(np.int64)
    return anchors @ rows.T


@dataclass
class Node:
    points: np.ndarray  # split points, whole numbers
    heights: np.ndarray  # their further coordinates
    squares: np.ndarray
    children: list[int]  # number of a node, or for leaf k the number -1 - k
    number: int
    low: np.ndarray = field(default=None)  # [i, j]: least distance of point i from the rows below child j
    high: np.ndarray = field(default=None)


@dataclass
class Tree:
    nodes: list[Node]
    leaves: int
    longest: float  # M squared
    width: int


def _squares(q: np.ndarray) -> np.ndarray:
    return (q.astype(np.float64) ** 2).sum(axis=1)


def _point_distances(node: Node, q: np.ndarray, heights: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Distances of rows from a node's split points, with the further coordinate."""
    flat = squares[:, None] + node.squares - 2 * (q.astype(np.float64) @ node.points.astype(np.float64).T)
    return np.sqrt(np.maximum(flat + (heights[:, None] - node.heights) ** 2, 0))


def build(sample: np.ndarray, longest: float, width: int, fanout: int = FANOUT, leaf: int = LEAF, seed: int = 13) -> Tree:
    """Split points, each node's chosen far apart among some sampled rows."""
    rng, tree = np.random.default_rng(seed), Tree([], 0, longest, width)
    heights = np.sqrt(np.maximum(longest - _squares(sample), 0))
    squares = _squares(sample)

    def grow(rows: np.ndarray) -> int:
        # candidates for split points, without equal ones; the next is always the one farthest from those chosen
        tried = rng.permutation(rows)[: 3 * fanout] if len(rows) >= leaf else rows[:0]
        if len(tried):
            tried = tried[np.unique(sample[tried], axis=0, return_index=True)[1]]
        if len(tried) < 2:
            tree.leaves += 1
            return -tree.leaves
        node = Node(sample[tried[:1]], heights[tried[:1]], squares[tried[:1]], [], len(tree.nodes))
        chosen = [0]
        while len(chosen) < min(fanout, len(tried)):
            far = _point_distances(node, sample[tried], heights[tried], squares[tried]).min(axis=1)
            far[chosen] = -1
            chosen.append(int(far.argmax()))
            at = tried[chosen]
            node.points, node.heights, node.squares = sample[at], heights[at], squares[at]
        tree.nodes.append(node)
        near = _point_distances(node, sample[rows], heights[rows], squares[rows]).argmin(axis=1)
        parts = [rows[near == k] for k in range(len(chosen))]
        if max(map(len, parts)) == len(rows):  # no progress
            parts = [p[:0] for p in parts]
        node.children = [grow(p) for p in parts]
        return node.number

    grow(np.arange(len(sample)))
    return tree


def descend(tree: Tree, q: np.ndarray, ranges: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Leaf of each row; ``ranges`` gathers, by node, the least and greatest distances of points from rows below each child."""
    leaf = np.zeros(len(q), np.int32)
    if not tree.nodes:
        return leaf
    squares = _squares(q)
    heights = np.sqrt(np.maximum(tree.longest - squares, 0))
    todo = [(0, np.arange(len(q)))]
    while todo:
        number, at = todo.pop()
        if not len(at):
            continue
        node = tree.nodes[number]
        away = _point_distances(node, q[at], heights[at], squares[at])
        near = away.argmin(axis=1)
        for k, child in enumerate(node.children):
            below = near == k
            if not below.any():
                continue
            if ranges is not None:
                k_points = len(node.children)
                seen = ranges.setdefault(node.number, np.stack([np.full((k_points, k_points), np.inf), np.full((k_points, k_points), -np.inf)]))
                seen[0, :, k] = np.minimum(seen[0, :, k], away[below].min(axis=0))
                seen[1, :, k] = np.maximum(seen[1, :, k], away[below].max(axis=0))
            if child >= 0:
                todo.append((child, at[below]))
            else:
                leaf[at[below]] = -1 - child
    return leaf


def surviving(tree: Tree, q: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """By anchor and leaf: may the leaf hold a row whose score is in one of the anchor's windows ``least`` to ``most``?

    ``least`` and ``most`` have a column for each window; an empty window has ``least > most``.
    """
    out = np.zeros((len(q), max(tree.leaves, 1)), bool)
    squares = _squares(q)
    wide = squares[:, None] + tree.longest
    some = least <= most
    slack = SLACK * np.sqrt(tree.longest + squares.max(initial=0.0)) + SLACK
    inner = np.sqrt(np.maximum(wide - 2.0 * np.where(some, most, 0), 0)) - slack
    outer = np.sqrt(np.maximum(wide - 2.0 * np.where(some, least, 0), 0)) + slack
    if not tree.nodes:
        out[:, 0] = some.any(axis=1)
        return out
    flat = np.zeros(len(q))
    todo = [(0, np.flatnonzero(some.any(axis=1)))]
    while todo:
        number, at = todo.pop()
        if not len(at):
            continue
        node = tree.nodes[number]
        away = _point_distances(node, q[at], flat[at], squares[at])
        for k, child in enumerate(node.children):
            if not np.isfinite(node.low[0, k]):  # no row is below
                continue
            nearest = np.maximum(node.low[:, k] - away, away - node.high[:, k]).max(axis=1)
            farthest = (away + node.high[:, k]).min(axis=1)
            meets = some[at] & (nearest[:, None] <= outer[at]) & (farthest[:, None] >= inner[at])
            left = at[meets.any(axis=1)]
            if child >= 0:
                todo.append((child, left))
            else:
                out[left, -1 - child] = True
    return out


@dataclass
class Index:
    """Rows by block, and what a search needs to know of them."""

    rows: DataFrame  # row, vec_id, label, q, leaf, block
    tree: Tree
    first_block: np.ndarray  # of each leaf; leaves with few rows share a block
    last_block: np.ndarray
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]  # row, label, q of the sampled rows


def _placed(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = descend(tree.value, _matrix(batch.column("q"), tree.value.width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    return run


def _ranges(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[int, np.ndarray] = {}
        leaves = np.zeros(max(tree.value.leaves, 1), np.int64)
        for batch in batches:
            q = _matrix(batch.column("q"), tree.value.width)
            leaves += np.bincount(descend(tree.value, q, ranges), minlength=len(leaves))
        rows = [(-1, 0, k, 0.0, 0.0, int(n)) for k, n in enumerate(leaves) if n]
        for number, seen in ranges.items():
            size = seen.shape[1]
            rows += [(number, i, j, float(seen[0, i, j]), float(seen[1, i, j]), 0) for i in range(size) for j in range(size) if np.isfinite(seen[0, i, j])]
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
        names = ["node", "point", "child", "low", "high", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def build_index(rows: DataFrame, fanout: int = FANOUT, sample_rows: int = SAMPLE, block: int = BLOCK) -> Index:
    """Index all of ``rows`` (as ``vectors`` gives them).

    Split points come from at most ``sample_rows`` rows, fewer if they are very long; all rows
    descend, and ranges and block sizes count all rows.
    """
    spark = rows.sparkSession
    size = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    width, longest = rows.agg(F.max(F.size("q")), F.max(size)).first()
    width, longest = max(int(width or 0), 1), float(longest or 0) * (1 + 1e-12) + 1
    few = max(min(sample_rows, SAMPLE_NUMBERS // width), 64)
    drawn = rows.select(F.xxhash64("row", F.lit("sample")).alias("h"), "row", "label", "q").orderBy("h", "row").limit(few).toArrow()
    q = _matrix(drawn.column("q"), width)
    sample = (drawn.column("row").to_numpy(), drawn.column("label").to_numpy(), q)
    tree = build(q, longest, width, fanout)
    shared = spark.sparkContext.broadcast(tree)
    told = rows.select("q").mapInArrow(_ranges(shared), "node int, point int, child int, low double, high double, n bigint")
    # as many rows as the tree has pairs of siblings, whatever the input
    told = told.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect()
    for node in tree.nodes:
        k = len(node.children)
        node.low, node.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    counts = np.zeros(max(tree.leaves, 1), np.int64)
    for t in told:
        if t["node"] < 0:
            counts[t["child"]] = t["n"]
        else:
            tree.nodes[t["node"]].low[t["point"], t["child"]] = t["low"]
            tree.nodes[t["node"]].high[t["point"], t["child"]] = t["high"]
    first, last = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    at, filled = 0, 0
    for k, n in enumerate(counts.tolist()):
        if filled and filled + n > block:
            at, filled = at + 1, 0
        first[k] = at
        last[k] = at + max(-(-n // block) - 1, 0)
        at, filled = int(last[k]), filled + n if n <= block else block
    placed = rows.mapInArrow(_placed(shared), "row bigint, vec_id bigint, label bigint, q array<bigint>, leaf int")
    spread = spark.createDataFrame([(k, int(f), int(b - f + 1)) for k, (f, b) in enumerate(zip(first, last, strict=True))], "leaf int, first bigint, n bigint")
    # one row per leaf of the tree
    placed = placed.join(F.broadcast(spread), "leaf").withColumn("block", F.col("first") + F.pmod(F.xxhash64("row"), F.col("n")))
    placed = placed.select("row", "vec_id", "label", "q", "leaf", "block")
    return Index(stored(placed, "indexed-vectors"), tree, first, last, sample)


def _best(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """By anchor: the k-th best score among the chosen sampled rows, the least number if there are fewer."""
    least = np.iinfo(np.int64).min
    held = np.where(among, scores, least)
    if held.shape[1] < k:
        return np.full(len(held), least)
    return np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]


SENT = "block bigint, part int, row bigint, vec_id bigint, label bigint, q array<bigint>, leaf int, least array<bigint>, most array<bigint>, leaves array<int>"


def _sent(told, k: int, same_label: bool):
    """Anchors, once for each block they must look at, with the leaves of it that may hold a result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, first, last, (rows, labels, sample) = told.value
        top = np.iinfo(np.int64).max // 4
        for whole in batches:
            for start in range(0, whole.num_rows, ANCHORS):
                batch = whole.slice(start, ANCHORS)
                n = batch.num_rows
                q, label = _matrix(batch.column("q"), tree.width), batch.column("label").to_numpy()
                least = _matrix(batch.column("least"), max(1, int(pc.max(pc.list_value_length(batch.column("least"))).as_py() or 1)))
                most = _matrix(batch.column("most"), least.shape[1])
                used = np.arange(least.shape[1]) < np.diff(batch.column("least").offsets.to_numpy())[:, None]
                least, most = np.where(used, least, 0), np.where(used, most, -1)
                if len(rows):
                    # sampled rows are rows: the k-th best of them bounds the k-th best of all
                    scores = products(q, sample)
                    among = (label[:, None] == labels) == same_label
                    among &= rows != batch.column("row").to_numpy()[:, None]
                    for w in range(least.shape[1]):
                        inside = among & (scores <= most[:, w : w + 1])
                        least[:, w] = np.maximum(least[:, w], _best(scores, inside, k))
                least, most = np.clip(least, -top, top), np.clip(most, -top, top)
                alive = surviving(tree, q, least, most)
                who, where, which = [], [], []
                for a in range(n):
                    leaves = np.flatnonzero(alive[a])
                    by_block: dict[int, list[int]] = {}
                    for leaf in leaves.tolist():
                        for b in range(int(first[leaf]), int(last[leaf]) + 1):
                            by_block.setdefault(b, []).append(leaf)
                    who += [a] * len(by_block)
                    where += list(by_block)
                    which += list(by_block.values())
                taken = batch.take(pa.array(who, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(where, pa.int64()),
                        pa.array([1] * len(who), pa.int32()),
                        taken.column("row"),
                        taken.column("vec_id"),
                        taken.column("label"),
                        taken.column("q"),
                        pa.nulls(len(who), pa.int32()),
                        pa.array([least[a, used[a]].tolist() for a in who], pa.list_(pa.int64())),
                        pa.array([most[a, used[a]].tolist() for a in who], pa.list_(pa.int64())),
                        pa.array(which, pa.list_(pa.int32())),
                    ],
                    schema=_SENT,
                )

    return run


_SENT = pa.schema(
    [
        ("block", pa.int64()),
        ("part", pa.int32()),
        ("row", pa.int64()),
        ("vec_id", pa.int64()),
        ("label", pa.int64()),
        ("q", pa.list_(pa.int64())),
        ("leaf", pa.int32()),
        ("least", pa.list_(pa.int64())),
        ("most", pa.list_(pa.int64())),
        ("leaves", pa.list_(pa.int32())),
    ]
)
FOUND = "anchor_row bigint, anchor_id bigint, turn int, vec_id bigint, score bigint, found_row bigint"


def _scanned(width: int, k: int, same_label: bool):
    """The best ``k`` of each window in each block; the rows of a block come before its anchors."""

    def scan(block: list[pa.Table], anchors: pa.Table) -> pa.RecordBatch:
        held = block[0]
        rows, ids, labels, leaf = (held[c].to_numpy() for c in ("row", "vec_id", "label", "leaf"))
        q = block[1]
        out: list[list] = [[] for _ in range(6)]
        scores = products(_matrix(anchors["q"], width), q)
        a_rows, a_ids, a_labels = (anchors[c].to_numpy() for c in ("row", "vec_id", "label"))
        windows = zip(anchors["least"].to_pylist(), anchors["most"].to_pylist(), anchors["leaves"].to_pylist(), strict=True)
        for a, (least, most, leaves) in enumerate(windows):
            fits = np.isin(leaf, leaves) & ((labels == a_labels[a]) == same_label) & (rows != a_rows[a])
            fits &= (scores[a] >= min(least)) & (scores[a] <= max(most))
            at = np.flatnonzero(fits)
            at = at[np.lexsort((ids[at], -scores[a, at]))]
            mine = scores[a, at]
            for turn, (low, high) in enumerate(zip(least, most, strict=True)):
                start = np.searchsorted(-mine, -high)
                chosen = at[start : start + k]
                chosen = chosen[scores[a, chosen] >= low]
                n = len(chosen)
                for c, x in zip(out, ([a_rows[a]] * n, [a_ids[a]] * n, [turn] * n, ids[chosen], scores[a, chosen], rows[chosen]), strict=True):
                    c.extend(x)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ["anchor_row", "anchor_id", "turn", "vec_id", "score", "found_row"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            blocks, kinds = table["block"].to_numpy(), table["part"].to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)], strict=True):
                if start == end:
                    continue
                if blocks[start] != now:
                    now, parts, held = blocks[start], [], None
                piece = table.slice(start, end - start)
                if kinds[start] == 0:
                    parts.append(piece)
                    continue
                if held is None and parts:
                    joined = pa.concat_tables(parts).combine_chunks()
                    held, parts = [joined, _matrix(joined["q"], width)], []
                for k in range(0, piece.num_rows, ANCHORS) if held else ():
                    yield scan(held, piece.slice(k, ANCHORS).combine_chunks())

    return run


def search(index: Index, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The ``k`` best rows of each window of each anchor: ``anchor_row``, ``anchor_id``, ``turn``, ``rank``, ``vec_id``, ``score``, ``found_row``.

    ``anchors`` has ``row``, ``vec_id``, ``label``, ``q`` and arrays ``least`` and ``most`` with
    an entry for each window (``turn`` counts them from 0).  Only rows of the same label, or
    only rows of other labels, are found; never the anchor's own row.  Ties go to smaller ids.
    """
    spark = anchors.sparkSession
    told = spark.sparkContext.broadcast((index.tree, index.first_block, index.last_block, index.sample))
    sent = anchors.select("row", "vec_id", "label", "q", "least", "most").mapInArrow(_sent(told, k, same_label), SENT)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("least", "array<bigint>"), ("most", "array<bigint>"), ("leaves", "array<int>"))]
    rows = index.rows.select("block", F.lit(0).alias("part"), "row", "vec_id", "label", "q", "leaf", *none)
    dealt = rows.unionByName(sent).repartition("block").sortWithinPartitions("block", "part")
    found = dealt.mapInArrow(_scanned(index.tree.width, k, same_label), FOUND)
    order = Window.partitionBy("anchor_row", "turn").orderBy(F.desc("score"), "vec_id", "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    step: int = ANCHOR_STEP,
) -> DataFrame:
    """For each anchor and each of its positives, rows of other labels that score somewhat lower than the positive.

    Anchors are the rows whose ``vec_id`` is divisible by ``step``.  An anchor's positives are
    the ``positives`` best rows of its label, itself left out.  A negative's score, in hundred
    parts of the positive's, is between ``lowest`` and ``highest``; a positive with a negative
    score has none.  Rows that repeat are rows of their own, so that an anchor's copy with its
    label is a positive; an anchor that repeats gives its rows again.  A vector shorter than others ends in
    zeros.  For rows that take no part see ``vectors``; other columns are not read.
    """
    kept = vectors(rows)
    index = build_index(kept)
    anchors = kept.where(F.col("vec_id") % step == 0)
    everything = F.array(F.lit(-(1 << 62)).cast("bigint")), F.array(F.lit(1 << 62).cast("bigint"))
    best = search(index, anchors.withColumns({"least": everything[0], "most": everything[1]}), positives, True)
    best = stored(best.select("anchor_row", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # exact even if a hundred times the score fits no BIGINT
    score = F.col("positive_score").cast("decimal(38,0)")
    least, most = F.ceil(score * lowest / 100), F.floor(score * highest / 100)
    windows = best.withColumns({"least": least.cast("bigint"), "most": most.cast("bigint")})
    windows = windows.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "least", "most"))).alias("w"))  # ``positives`` at most
    asked = anchors.join(windows, F.col("row") == F.col("anchor_row"))
    asked = asked.select("row", "vec_id", "label", "q", F.col("w.least").alias("least"), F.col("w.most").alias("most"))
    found = search(index, asked, negatives, False)
    found = found.select("anchor_row", "anchor_id", (F.col("turn") + 1).alias("turn"), F.col("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    best = best.withColumnRenamed("rank", "turn")
    return found.join(best, ["anchor_row", "turn"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", F.col("turn").alias("positive_rank")
    )
