"""Columns that operators add to tables of any shape."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 3 << 20  # of texts that a task sends to its Python worker at once, about


def unused(table: DataFrame, name: str) -> str:
    """``name``, or that with underscores, such that the table has no such column."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_digest(text: str = "text") -> Column:
    """Digest that equal texts share; NULL counts as empty."""
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session have about ``BATCH_BYTES`` at most.

    Spark bounds them by 10,000 rows and 64 MB, which a task and its worker each hold several times:
    as vectors that grow by doubling, as rows that wait for their result, as texts.  A lower bound stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)i?b?", spark.conf.get(name).strip().lower()).groups()
    if not 0 < int(number) << 10 * " kmgtp".index(unit or " ") <= BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def columns_of(table: DataFrame) -> list[Column]:
    """All columns by name, also names with dots."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in table.columns]
