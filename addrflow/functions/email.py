"""E-mail syntax check (dot-atom local part, then a domain or a [literal])."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: RFC 822 address syntax as the source job's validator accepts it for space-free
# text (one address of an address list, checked strictly):
# * addr-spec: dot-separated atoms (no controls, space, DEL, ()<>,;:\"[]@ or dot) or one quoted
#   string (backslash escapes) right before '@'; then dot-separated labels of letters, digits and
#   '-', or a [literal];
# * or a display phrase (atoms/quoted strings) followed by <addr-spec>; text after '>' is ignored;
# * empty list entries (leading or trailing commas) are skipped.


def _pattern(possessive: bool) -> str:
    """The address rule; with ``possessive`` every loop is possessive (``*+``, ``++``).

    Each loop is unambiguous (its delimiter is excluded from the class it follows), so both forms
    accept the same strings. Java needs the possessive form: it runs a greedy group loop by
    recursion, which overflows the task's stack on a long run of dots or escapes; possessive loops
    run iteratively. RE2 (the SQL twin) has no possessive syntax and needs none.
    """
    star, plus = ("*+", "++") if possessive else ("*", "+")
    atom = r'[^\x00-\x20\x7F()<>,;:\\"\[\]@.]' + plus
    quoted = rf'"[^"\\]{star}(?:\\.[^"\\]{star}){star}"'
    label = r"[\p{L}\p{Nd}-]" + plus
    addr_spec = (
        rf"(?:{atom}(?:\.{atom}){star}|{quoted})@(?:{label}(?:\.{label}){star}|\[[^\x00-\x20\x7F\[\]]{star}\])"
    )
    text = r'[^()<>,;:"\[\]]' + star
    phrase = rf"{text}(?:{quoted}{text}){star}"
    return rf"^,{star}(?:{addr_spec}|{phrase}<{addr_spec}>{text}),{star}\z"


EMAIL = _pattern(possessive=True)  # Spark (Java regex)
EMAIL_RE2 = _pattern(possessive=False)  # SQL twin (RE2)


def is_valid_email(c: Column) -> Column:
    """Syntax test; NULL -> false."""
    return F.coalesce(c.rlike(EMAIL), F.lit(False))


def email_set(first: Column, second: Column) -> Column:
    """De-duplicated (case-sensitive) valid e-mails of two fields."""
    return F.array_distinct(
        F.array_compact(F.array(F.when(is_valid_email(first), first), F.when(is_valid_email(second), second)))
    )
