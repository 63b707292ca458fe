"""Column helpers for text, numbers and dates.

They never raise under ANSI mode: text that cannot be read becomes NULL.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.functions.rules import NON_LATIN_PATTERN, YEAR_PATTERN

# Every character that counts as white space in a Unicode strip.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Decimal digits of the other scripts of the basic plane, ten in a row each.
_NATIVE = "".join(c for c in map(chr, range(0x80, 0x10000)) if c.isdecimal())
_NATIVE_VALUES = "".join(str(unicodedata.decimal(c)) for c in _NATIVE)
# Raised, lowered and circled digits: a digit filter keeps them, but they make
# the text unreadable as an integer.
_MARKED_DIGITS = "\u00b2\u00b3\u00b9\u2070-\u2079\u2080-\u2089\u2460-\u2468"

_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def unicode_pattern(pattern: str) -> str:
    r"""Make ``\s``, ``\d``, ``\w`` and ``\b`` of a Java pattern follow Unicode."""
    return "(?U)" + pattern


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (``F.trim`` alone takes only spaces)."""
    return F.trim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def ascii_digits(text: Column) -> Column:
    """Write decimal digits of other scripts as 0-9."""
    return F.translate(text, _NATIVE, _NATIVE_VALUES)


def digits(text: Column) -> Column:
    """All digits of the text joined, as BIGINT: ``MAD 1,450`` -> 1450, ``72.50`` -> 7250."""
    return ascii_digits(F.regexp_replace(text, rf"[^\p{{Nd}}{_MARKED_DIGITS}]+", "")).try_cast("bigint")


def decimals(text: Column) -> Column:
    """Decimal digits joined, as BIGINT; raised digits and the like are skipped."""
    return ascii_digits(F.regexp_replace(text, r"[^\p{Nd}]+", "")).try_cast("bigint")


def safe_double(text: Column) -> Column:
    """Finite decimal number or NULL; rejects ``nan``, ``inf``, ``8.4f`` and ``8.4d``."""
    return F.regexp_extract(strip(text), _FLOAT, 0).try_cast("double")


def part(text: Column, marker: str, index: int) -> Column:
    """``index``-th piece of the text split at a literal marker, NULL when absent."""
    return F.get(F.split(text, r"\Q" + marker + r"\E"), F.lit(index))


def after_last(text: Column, marker: str) -> Column:
    return strip(F.substring_index(text, marker, -1))


def before_first(text: Column, marker: str) -> Column:
    return F.substring_index(text, marker, 1)


def contains_any(text: Column, tokens: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for token in tokens:
        found = found | text.contains(token)
    return found


def field_name(text: Column) -> Column:
    """Lower case with spaces and hyphens as underscores."""
    return F.translate(F.lower(text), " -", "__")


def year_of(text: Column) -> Column:
    """First free-standing 20xx year in the text."""
    return F.regexp_extract(text, unicode_pattern(YEAR_PATTERN), 1).try_cast("int")


def latin_only(text: Column) -> Column:
    """Drop everything outside basic Latin letters, digits, white space and ``- , . '``."""
    # Java leaves the four separator controls out of \s.
    pattern = NON_LATIN_PATTERN.replace(r"\s", r"\s\x1c-\x1f")
    return F.regexp_replace(text, unicode_pattern(pattern) + "+", "")


def mapped(text: Column, table: Mapping[str, str]) -> Column:
    """Exact lookup in a fixed table, other values unchanged."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), text), text)


def number_text(value: Column) -> Column:
    """Shortest decimal text of a DOUBLE, without an exponent for ordinary sizes.

    Plain casts switch to an exponent below 1e-3 and from 1e7 on.
    """
    size = F.abs(value)
    plain = value.cast("string")
    fixed = F.regexp_replace(value.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    odd = (size > 0) & ((size < 1e-3) | (size >= 1e7)) & (size >= 1e-4) & (size < 1e16)
    return F.when(odd, fixed).otherwise(plain)
