"""What the classifiers share: the held-out fold and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
SAMPLE_ROWS = 8_000  # labelled rows a classifier is fitted on, about
SAMPLE_CHARS = 20_000  # longer texts are scored like all others, but not fitted on


def held_out(key: str = "doc_id") -> Column:
    """Rows that no classifier learns from: crc32 of the id as text is divisible by five.  NULL ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def learnable(key: str = "doc_id") -> Column:
    """Rows that may be learnt from: the id is known and not held out."""
    return F.col(key).isNotNull() & ~held_out(key)


def drawn(key: str, share: Column | float) -> Column:
    """A repeatable draw of about that share of keys."""
    return F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1_000_000)) < F.lit(1_000_000) * share


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """``doc_id``, ``y``, ``text`` of about ``rows`` labelled documents outside the held-out fold.

    Labels that are NULL are left out; of several labels of an id the greatest counts, and of
    several texts of an id the least.  The draw is by a hash of the id, so that it does not
    depend on how the tables lie.
    """
    known = labels.where(F.col(label).isNotNull() & learnable()).groupBy("doc_id").agg(F.max(label).alias("y"))
    total = known.count()
    known = known.where(drawn("doc_id", rows / max(total, 1)))
    short = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.char_length("text") <= chars)
    # about ``rows`` rows of two numbers, whatever the labels table holds
    return short.join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS
) -> tuple[list[str], list[int]]:
    """Texts and labels of ``labelled_rows``, in the order of their ids."""
    found = labelled_rows(docs, labels, label, rows, chars).orderBy("doc_id").select("text", "y").toPandas()
    return found["text"].tolist(), found["y"].astype(int).tolist()
