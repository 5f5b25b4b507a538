"""Text helpers as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set for regular expressions.
WHITESPACE_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def trimmed(value: Column) -> Column:
    """Strip Unicode white space at both ends (``trim`` alone strips blanks only)."""
    return F.btrim(value, F.lit(WHITESPACE))


def normalized(value: Column, *, trim: bool = True, collapse: bool = True) -> Column:
    """Normalise a key: runs of white space become one blank, the ends are stripped."""
    if collapse:
        value = F.regexp_replace(value, WHITESPACE_CLASS + "+", " ")
    return trimmed(value) if trim else value


def contains_any(value: Column, words: Sequence[str]) -> Column:
    """True where the lower-cased value contains one of the words."""
    if not words:
        return F.lit(False)
    return F.lower(value).rlike("|".join(re.escape(word) for word in words))


def clipped(value: Column, length: int | None, suffix: str = "") -> Column:
    """Cut to ``length`` characters, if given; ``suffix`` marks values that were cut."""
    if length is None:
        return value
    if not suffix:
        return F.substring(value, 1, length)
    cut = F.concat(F.substring(value, 1, length), F.lit(suffix))
    return F.when(F.length(value) > length, cut).otherwise(value)
