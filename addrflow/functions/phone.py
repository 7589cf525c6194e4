"""Indian mobile recovery: prefix stripping, ten-digit extraction, E.164 output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from addrflow.config import COUNTRY_CALLING_CODE
from addrflow.functions.text import remove_hyphen, remove_space

# Fixed values (patterns the results must agree with):
MOBILE_TEN = r"[6-9][0-9]{9}"
ANY_DIGIT = r"\p{Nd}"
ZERO_PREFIXED = r"^0\p{Nd}{10}\z"  # 0 + ten digits (11 chars, all digits)
PLUS_CC_PREFIXED = r"^\+91\p{Nd}{10}\z"  # +91 + ten digits
CC_PREFIXED = r"^91\p{Nd}{10}\z"  # 91 + ten digits

# Numbers in a free text. A token is a word with a letter, or a number: digits, spaces and hyphens, with
# the word glued to its end, if any. Both engines read these alike: no lookaround, no repeated group
# (which would recurse on a long list of numbers).
NUMBER_TOKEN = r"[\p{L}\p{Nd}]*\p{L}[\p{L}\p{Nd}]*|\+?\p{Nd}[\p{Nd} -]*(?:\p{L}[\p{L}\p{Nd}]*)?"
GLUED_WORD = r"\p{Nd}*\p{L}[\p{L}\p{Nd}]*\z"  # a token's part that belongs to a word
NUMBER_BREAK = r"[ -][ -]+"  # two separators end a number


def digit_count(c: Column) -> Column:
    """Number of Unicode decimal digits."""
    return F.regexp_count(c, F.lit(ANY_DIGIT))


def strip_prefix(c: Column) -> Column:
    """0+10 digits -> drop 1; +91+10 -> drop 3; 91+10 -> drop 2; anything else unchanged."""
    return (
        F.when(c.rlike(ZERO_PREFIXED), F.substring(c, 2, 1 << 30))
        .when(c.rlike(PLUS_CC_PREFIXED), F.substring(c, 4, 1 << 30))
        .when(c.rlike(CC_PREFIXED), F.substring(c, 3, 1 << 30))
        .otherwise(c)
    )


def ten_digits(c: Column) -> Column:
    """The [6-9]+9-digit run when the text holds exactly ten digits, else ''."""
    return F.when(digit_count(c) == 10, F.regexp_extract(c, MOBILE_TEN, 0)).otherwise(F.lit(""))


def e164(c: Column) -> Column:
    return F.concat(F.lit(COUNTRY_CALLING_CODE), c)


def candidates(c: Column) -> Column:
    """Comma-separated pieces after space/hyphen removal, each prefix-stripped."""
    return F.transform(F.split(remove_hyphen(remove_space(c)), ","), strip_prefix)


def recover_mobiles(c: Column) -> Column:
    """array<string> of E.164 mobiles found in one phone field (duplicates kept)."""
    tens = F.transform(candidates(c), ten_digits)
    return F.transform(F.filter(tens, lambda t: t != F.lit("")), e164)


def mobile_set(first: Column, second: Column, recover: bool = True) -> Column:
    """De-duplicated mobiles of two phone fields; recovery off -> always empty."""
    if not recover:
        return F.array().cast("array<string>")
    return F.array_distinct(F.concat(recover_mobiles(first), recover_mobiles(second)))


def number_runs(text: Column) -> Column:
    """array<string>: the maximal number runs of a free text.

    A run is digits with single spaces or hyphens between them (and a leading +). Neither side touches
    another digit, nor a letter: codes such as ``a9876543210f`` hold no number. Runs are whole, so a longer
    number never gives a shorter one.
    """
    tokens = F.regexp_extract_all(text, F.lit(NUMBER_TOKEN), F.lit(0))
    numbers = F.transform(tokens, lambda t: F.regexp_replace(t, GLUED_WORD, ""))
    runs = F.flatten(F.transform(F.filter(numbers, lambda t: t != ""), lambda t: F.split(t, NUMBER_BREAK)))
    return F.filter(runs, lambda r: r != "")


def text_mobiles(text: Column) -> Column:
    """array<string>: the mobiles of a free text, each number run recovered as a whole field."""
    return F.array_distinct(F.flatten(F.transform(number_runs(text), recover_mobiles)))
