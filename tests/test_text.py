from __future__ import annotations

import random
import re

from staylens.functions import text as X
from staylens.functions.rules import TRAVELER_TYPE_MAP


def test_strip_takes_unicode_space(evaluate):
    values = ["\t a ", "　b c \n", "\x1cd\x1f", "", " ", None]
    assert evaluate(values, X.strip) == [v.strip() if v is not None else None for v in values]


def test_strip_like_the_language_on_random_text(evaluate):
    rng = random.Random(1)
    alphabet = "ab \t\n\r\x0b\x0c\x1d\x85      　​"
    values = ["".join(rng.choices(alphabet, k=rng.randrange(9))) for _ in range(300)]
    assert evaluate(values, X.strip) == [v.strip() for v in values]


def test_digits(evaluate):
    values = ["MAD 1,450", "€ 72.50", " ", "free", None, "١٬٤٥٠ درهم", "25 m²", "９9"]
    assert evaluate(values, X.digits) == [1450, 7250, None, None, None, 1450, None, 99]


def test_digits_as_specified_on_random_text(evaluate):
    """Keep what counts as a digit, read the rest as an integer."""

    def spec(text):
        kept = "".join(c for c in text if c.isdigit())
        try:
            return int(kept)
        except ValueError:
            return None

    rng = random.Random(2)
    values = ["".join(rng.choices("0123456789,. €xMAD²٣۵-", k=rng.randrange(15))) for _ in range(300)]
    assert evaluate(values, X.digits) == [spec(v) for v in values]


def test_decimals_skip_raised_digits(evaluate):
    assert evaluate(["25 m²", "1,234", "x"], X.decimals) == [25, 1234, None]


def test_safe_double(evaluate):
    values = ["8.4", "9", "1_000", "8.4f", "8.4d", "x", "nan", "inf", " 7.5\n", "-1.5", "+2", ".5", "5.", "1e2", "", None]
    expected = [8.4, 9.0, None, None, None, None, None, None, 7.5, -1.5, 2.0, 0.5, 5.0, 100.0, None, None]
    assert evaluate(values, X.safe_double) == expected


def test_part_is_literal_and_absent_is_null(evaluate):
    values = ["Scored 8.0", "8.0", "Scored 7 Scored 6", None]
    assert evaluate(values, lambda c: X.part(c, "Scored ", 1)) == ["8.0", None, "7 ", None]
    assert evaluate(["a.b"], lambda c: X.part(c, ".", 1)) == ["b"]


def test_year(evaluate):
    values = ["Stayed in May 2024", "May", "2025", "12024", "in2024", "1999 and 2031-2032", None, "(2019)"]
    assert evaluate(values, X.year_of) == [2024, None, 2025, None, None, 2031, None, 2019]


def test_latin_only_on_random_text(evaluate):
    rng = random.Random(3)
    alphabet = "abcXYZ019 -,.'\t éï日!@#/()\x1e"
    values = ["".join(rng.choices(alphabet, k=rng.randrange(20))) for _ in range(300)]
    spec = [re.sub(r"[^a-zA-Z0-9\s\-,\.']", "", v) for v in values]
    assert evaluate(values, X.latin_only) == spec


def test_field_name_and_mapping(evaluate):
    values = ["Solo traveller", "Group of friends", "Groups of friends", "Digital-nomad", "Couple"]
    expected = ["solo_travelers", "groups_friends", "groups_of_friends", "digital_nomad", "couples"]
    assert evaluate(values, lambda c: X.mapped(X.field_name(c), TRAVELER_TYPE_MAP)) == expected


def test_number_text_has_no_exponent(evaluate):
    values = [8.4, 9.0, 0.0005, -0.00025, 12345678.5, 35.77378314, -5.787120301, 0.0, 31.6291635943574, None]
    expected = [repr(v) if v is not None else None for v in values]
    assert evaluate(values, X.number_text, "x double") == expected
