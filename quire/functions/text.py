"""String expressions: Unicode strip, line split, blank tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.  Python's str.strip() removes Unicode White_Space plus the
# four separators U+001C..U+001F; Java's (?U)\s covers the former only.
STRIP_PATTERN = r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$"
# Universal newlines of a text-mode file: \r\n, \r and \n end a line.
LINE_BREAK_PATTERN = r"\r\n|\r|\n"


def ustrip(col: Column | str) -> Column:
    """Strip white space at both ends, Unicode-aware (like Python ``str.strip``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, STRIP_PATTERN, "")


def split_lines(col: Column | str) -> Column:
    """Split a text into its lines the way a text-mode file iterates them."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, LINE_BREAK_PATTERN, -1)


def is_nonempty(col: Column | str) -> Column:
    """Null and '' are empty; white space alone is not (record-stream rule)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c != F.lit(""))


def single_line(col: Column | str) -> Column:
    """Replace line breaks by one space so a text survives a one-record-per-line sink."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, LINE_BREAK_PATTERN, " ")
