"""Column functions over text: blank test, fixed-width pieces, prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import BLANK_CODE_POINTS


def _cp(c: int) -> str:
    return "\\x{%x}" % c


def blank_class() -> str:
    """Regex character class body matching Python's whitespace set.

    Written as ``\\x{..}`` escapes, which both Java regex and RE2 accept.
    """
    return "".join(_cp(c) for c in BLANK_CODE_POINTS)


def not_blank(col: Column | str) -> Column:
    """True when the text holds a character outside Python's whitespace set
    (``str.strip()`` would leave something). Null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike("[^" + blank_class() + "]")


def pieces(col: Column | str, width: int) -> Column:
    """Consecutive, non-overlapping pieces of ``width`` code points, last one
    short; empty text gives an empty array. One left-to-right regex pass, so
    the cost is linear in the text length however long the text is."""
    if width < 1:
        raise ValueError("width must be >= 1")
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit("(?s).{1,%d}" % width), F.lit(0))


def with_prefix(col: Column | str, prefix: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(prefix), c)


def excerpt(col: Column | str, n: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, 1, n)
