"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Text accepted as a number.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(c: Column) -> Column:
    """Remove Unicode whitespace at both ends (a native trim, no regular expression)."""
    return F.btrim(c, F.lit(WHITESPACE))


def folded(c: Column) -> Column:
    """Trimmed lower-case text, the canonical form of a category value."""
    return F.lower(strip(c))


def lookup_key(c: Column) -> Column:
    """Trimmed upper-case text, the canonical form of a lookup name."""
    return F.upper(strip(c))


def code_prefix(c: Column, length: int = 2) -> Column:
    return F.substring(c, 1, length)


def title(c: Column) -> Column:
    return F.initcap(c)


def parse_number(c: Column) -> Column:
    """Text to double; anything that is not wholly a number becomes NULL."""
    text = strip(c)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def fingerprint(c: Column) -> Column:
    """Order-free token fingerprint: lower case, punctuation dropped, distinct tokens sorted."""
    tokens = F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_join(F.array_sort(F.array_distinct(F.filter(tokens, lambda t: t != ""))), " ")
