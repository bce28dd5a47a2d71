"""Text expressions: trimming, header names, null tokens, lenient numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ALIAS_TO_TARGET, NULL_TOKENS

# White space of the Unicode standard and the ASCII separators, as Python's str.strip takes it.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with `value` evaluated once.

    Also keeps the body out of the generated row code: a method beyond the size the
    JVM compiles would run interpreted, which costs far more than this detour.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def apart(c: Column) -> Column:
    """The value as it is, by a detour: Spark compiles the columns next to it in parts.

    Otherwise all of a wide row's columns become one method, beyond the size the JVM compiles.
    """
    return let(c, lambda v: v)


def strip(c: Column) -> Column:
    """Trim white space of every kind, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def _plain(c: Column) -> Column:
    """Begins and ends with a visible ASCII character, so that nothing is to be trimmed."""
    return (c >= "!") & (c < "\x7f") & F.substring(c, -1, 1).between("!", "~")


def strip_cell(c: Column) -> Column:
    """`strip` of a column, which is cheap to name several times; most cells have nothing to trim."""
    return F.when(_plain(c), c).otherwise(strip(c))


def blank_to_null(c: Column) -> Column:
    """Trimmed text of a column; the null tokens become null."""

    def filled(s: Column) -> Column:
        return F.when(~s.isin(*NULL_TOKENS), s)

    return F.when(_plain(c), filled(c)).otherwise(filled(strip(c)))


def decimal_point(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("."))


def to_number(c: Column) -> Column:
    """Text to double; a decimal comma is accepted, anything not a plain number is null.

    The character test keeps out what a cast would take: 45d, NaN, Infinity. Scans have
    trimmed their cells, so only blanks are trimmed here.
    """
    s = decimal_point(F.trim(c))
    number = F.when(~s.rlike(r"[^0-9+\-.eE]"), s.try_cast("double"))
    # 1e400 is no number either.
    return F.when(F.abs(number) < float("inf"), number)


def header_key(c: Column) -> Column:
    """Column form of `schema.header_name`."""
    snake = F.regexp_replace(F.lower(strip(c)), r"[^\p{L}\p{N}]+", "_")
    return F.regexp_replace(snake, r"^_+|_+$", "")


def header_target(c: Column) -> Column:
    """Raw target column of a header text, null when the header is unknown."""
    lookup = F.create_map(*[F.lit(x) for pair in ALIAS_TO_TARGET.items() for x in pair])
    return F.try_element_at(lookup, F.replace(header_key(c), F.lit("_"), F.lit("")))
