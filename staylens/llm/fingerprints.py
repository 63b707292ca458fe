"""Threshold-scaled fingerprints of documents (DataFrame functions only).

A text's shingles (five consecutive words, or all words of a shorter text) are hashed to
52 bits.  Every hash below a fixed fraction of that range is kept, whatever the text's
length, so that sketches of very unequal texts can be merged and compared: both hold the
same sample of the hash space.  Short texts, for which the fraction would keep next to
nothing, also keep their smallest hashes up to a floor; a sketch then is exact below the
bound that it states.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACE = 1 << 52
SHINGLE = 5
FRACTION = 1 / 16
FLOOR = 64
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def shingle_values(text: Column, size: int = SHINGLE) -> Column:
    """Distinct 52-bit hashes of a text's shingles, ascending; none for NULL or a text without words."""
    words = F.transform(
        F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != ""),
        lambda w: F.xxhash64(w),
    )
    # the bound variable keeps the word list from being computed once per shingle
    return F.transform(
        F.array(words),
        lambda h: F.sort_array(
            F.array_distinct(
                F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .when(F.size(h) < size, F.array(F.shiftrightunsigned(F.xxhash64(h), 12)))
                .otherwise(
                    F.transform(
                        F.sequence(F.lit(0), F.size(h) - size),
                        lambda i: F.shiftrightunsigned(F.xxhash64(*(F.get(h, i + k) for k in range(size))), 12),
                    )
                )
            )
        ),
    )[0]


def sketch(text: Column, fraction: float = FRACTION, floor: int = FLOOR) -> Column:
    """``struct<bound: bigint, hashes: array<bigint>>``: all hashes of the text below ``bound``."""
    limit = int(SPACE * fraction)

    def kept(values: Column) -> Column:
        below = F.size(F.filter(values, lambda v: v < limit))
        some = F.greatest(below, F.least(F.size(values), F.lit(floor)))
        hashes = F.slice(values, 1, some)
        bound = (
            F.when(some == F.size(values), F.lit(SPACE))
            .when(some == below, F.lit(limit))
            .otherwise(F.element_at(hashes, -1) + 1)
        )
        return F.struct(bound.cast("bigint").alias("bound"), hashes.alias("hashes"))

    return F.transform(F.array(shingle_values(text)), kept)[0]


def merge(one: Column, other: Column) -> Column:
    """The sketch of two texts' shingles together."""
    bound = F.least(one["bound"], other["bound"])
    union = F.array_union(one["hashes"], other["hashes"])
    return F.struct(bound.alias("bound"), F.sort_array(F.filter(union, lambda v: v < bound)).alias("hashes"))


def _shared(one: Column, other: Column) -> tuple[Column, Column, Column]:
    bound = F.least(one["bound"], other["bound"])
    a = F.filter(one["hashes"], lambda v: v < bound)
    b = F.filter(other["hashes"], lambda v: v < bound)
    return F.size(F.array_intersect(a, b)), F.size(a), F.size(b)


def likeness(one: Column, other: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1; 1 for two sketches without any hash."""
    both, a, b = _shared(one, other)
    union = a + b - both
    empty = (F.size(one["hashes"]) == 0) & (F.size(other["hashes"]) == 0)
    return F.when(empty, 1.0).when(union == 0, 0.0).otherwise(both / union)


def containment(one: Column, other: Column) -> Column:
    """Estimated share of the first sketch's shingles that the second has; 0 if it has none."""
    both, a, _ = _shared(one, other)
    return F.when(a == 0, 0.0).otherwise(both / a)


def as_text(made: Column) -> Column:
    """A sketch as a string: the bound and the hashes, 13 hex digits each."""
    digits = F.transform(made["hashes"], lambda v: F.lpad(F.hex(v), 13, "0"))
    return F.lower(F.concat(F.lpad(F.hex(made["bound"]), 14, "0"), F.array_join(digits, "")))


def _segment(key: Column, bounds: list[int]) -> Column:
    """How many bounds are not above the key, found in two steps of about sqrt(n) each."""
    if not bounds:
        return F.lit(0)
    width = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    firsts = F.array(*(F.lit(g[0]) for g in groups))
    fine = F.array(*(F.array(*(F.lit(b) for b in g)) for g in groups))
    group = F.size(F.filter(firsts, lambda b: b <= key))
    inside = F.size(F.filter(F.get(fine, group - 1), lambda b: b <= key))
    return F.when(group == 0, 0).otherwise((group - 1) * width + inside)


def with_next(docs: DataFrame, carried: list[str], key: str = "doc_id", tie: str = "text") -> DataFrame:
    """Add ``next``, a struct of the ``carried`` columns of the row that follows in key order.

    The row after the last is the first.  NULL keys come first; equal keys are ordered by
    ``tie``.  The key range is cut into segments at quantiles (the driver sees one number a
    segment); each row goes to its segment, and the first row of a segment also to the
    segment before it, so that no segment has to see another.  One shuffle, no single task.
    """
    spark: SparkSession = docs.sparkSession
    segments = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    shares = [i / segments for i in range(1, segments)]
    cuts = docs.select(F.percentile_approx(place, shares, 100_000).alias("cuts")).first()["cuts"]
    segment = _segment(place, sorted(set(cuts or [])))
    firsts = docs.select(place.alias("k"), segment.alias("s")).groupBy("s").agg(F.min("k").alias("k"))
    firsts = sorted((r["s"], r["k"]) for r in firsts.collect())  # one row a segment
    if not firsts:
        return docs.withColumn("next", F.struct(*carried))
    before = {k: (firsts[i - 1][0], i == 0) for i, (_, k) in enumerate(firsts)}
    target = F.create_map(*(F.lit(x) for k, (s, _) in before.items() for x in (k, s)))
    home = F.struct(segment.alias("segment"), F.lit(True).alias("own"), F.lit(False).alias("wrapped"))
    copy = F.struct(
        F.element_at(target, place).alias("segment"),
        F.lit(False).alias("own"),
        (place == firsts[0][1]).alias("wrapped"),
    )
    order = Window.partitionBy("at.segment").orderBy("at.wrapped", F.col(key).asc_nulls_first(), "at.own", tie)
    following = F.lead(F.struct(*carried)).over(order)
    return (
        docs.withColumn("at", F.explode(F.when(place.isin(list(before)), F.array(home, copy)).otherwise(F.array(home))))
        .withColumn("next", following)
        .where("at.own")
        .drop("at")
    )


def edited(text: Column, after: Column) -> Column:
    """The text with its last quarter of code points replaced by the start of the following text."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(after, F.lit(1), quarter))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses.

    NULL texts count as empty.  Texts without words have an empty sketch; two of those are
    alike (1.0), one of those and any other are not (0.0).  Rows that repeat are fingerprinted
    each; an only document follows itself.  Columns other than ``doc_id`` and ``text`` are not read.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("made", sketch(F.col("text")))
    paired = with_next(base, ["text", "made"])
    out = paired.withColumn("changed", edited(F.col("text"), F.col("next.text")))
    out = out.withColumn("changed_made", sketch(F.col("changed")))
    return out.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("changed").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("made")).alias("fingerprint"),
        as_text(F.col("changed_made")).alias("edited_fingerprint"),
        likeness(F.col("made"), F.col("changed_made")).alias("near_edited"),
        likeness(F.col("made"), F.col("next.made")).alias("near_next"),
        containment(F.col("made"), F.col("changed_made")).alias("contained_edited"),
    )


def merged(docs: DataFrame, by: str, text: str = "text") -> DataFrame:
    """One sketch per group: the union of its documents' sketches below the group's lowest bound.

    Hashes of a document are exploded before they are grouped, so that a group of any size is
    reduced map-side to its distinct hashes.
    """
    made = docs.select(by, sketch(F.col(text)).alias("made"))
    bounds = made.groupBy(by).agg(F.min("made.bound").alias("bound"))
    hashes = made.select(by, F.explode("made.hashes").alias("hash")).distinct()
    condition = [hashes[by].eqNullSafe(bounds[by]), hashes["hash"] < bounds["bound"]]
    joined = bounds.join(hashes, reduce(lambda a, b: a & b, condition), "left")
    return joined.groupBy(bounds[by], bounds["bound"]).agg(F.sort_array(F.collect_list("hash")).alias("hashes"))
