"""Text cleaning: whitespace and control removal, the 'missing' test, field cleanup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (Java character classes the results must agree with):
# every char with Character.isWhitespace or Character.isSpaceChar
WHITESPACE = r"[\p{Z}\t\n\x0B\f\r\x1C-\x1F]"
# ISO control chars U+0000-U+001F and U+007F-U+009F
CONTROL = r"[\x00-\x1F\x7F-\x9F]"
# String.trim(): every char <= U+0020 at either end (\z: end of input, not before a line end)
JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+\z"
# the same characters as a set, for Spark's trim(str, chars)
JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x21))
TRAILING_COMMA = r",\z"
MISSING_MARK = "\\N"  # the two characters backslash and N
NAN_MARK = "nan"


def remove_space(c: Column) -> Column:
    """Drop every whitespace/space char; NULL becomes ''."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), WHITESPACE, "")


def remove_control(c: Column) -> Column:
    """Drop ISO control chars (NULL stays NULL)."""
    return F.regexp_replace(c, CONTROL, "")


def remove_hyphen(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def is_missing(c: Column) -> Column:
    """NULL, the text \\N, '' or only whitespace."""
    return c.isNull() | (c == F.lit(MISSING_MARK)) | (remove_space(c) == F.lit(""))


def clean_field(c: Column) -> Column:
    """Name/address/city cleanup.

    NULL, \\N and 'nan' (exact, before trimming) -> ''; otherwise trim, drop one trailing
    comma, then drop control chars (no second trim).
    """
    trimmed = F.trim(c, F.lit(JAVA_TRIM_CHARS))
    return F.when(c.isNull() | c.isin(MISSING_MARK, NAN_MARK), F.lit("")).otherwise(
        remove_control(F.regexp_replace(trimmed, TRAILING_COMMA, ""))
    )


def compact(c: Column) -> Column:
    """Whitespace then control removal (contacts and pincodes)."""
    return remove_control(remove_space(c))


def normalize_country(c: Column) -> Column:
    return F.upper(compact(c))


def is_country(c: Column, code: str = "IN") -> Column:
    """Case-insensitive country test; NULL -> false."""
    return F.coalesce(F.upper(c) == F.lit(code.upper()), F.lit(False))


def address_fingerprint(mobile: Column, *fields: Column) -> Column:
    """Lower-cased, space-free concatenation of a mobile and address fields."""
    return F.lower(remove_space(F.concat(*[F.coalesce(x, F.lit("")) for x in (mobile, *fields)])))
