"""String helpers with the Java semantics the jobs were written against.

All functions take and return Columns and use only built-in expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder written for a blank field in delimited output (fixed value).
BLANK = " "


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_not_blank(c) -> Column:
    """Not null, not empty and not only whitespace (NULL -> false)."""
    return F.coalesce(col(c).rlike(r"[^\s\x1C-\x1F]"), F.lit(False))


def is_blank(c) -> Column:
    return ~is_not_blank(c)


def blank_to_space(c) -> Column:
    """Field value for delimited text: the value, or a single space if blank."""
    return F.when(is_not_blank(c), col(c)).otherwise(F.lit(BLANK))


def java_split(c, delimiter: str) -> Column:
    """``String.split(delimiter)`` for a literal delimiter.

    Java drops trailing empty strings (Spark's ``split`` keeps them) and an
    input made only of delimiters yields an empty array; an empty input
    yields one empty string.  NULL stays NULL.  The input is referenced twice:
    split an expensive one in a projection of its own.
    """
    d = re.escape(delimiter)
    pieces = F.split(F.regexp_replace(col(c), f"(?:{d})+\\z", ""), d)
    return F.when(col(c).rlike(f"^(?:{d})+\\z"), F.array().cast("array<string>")).otherwise(pieces)


def first_nonblank_id(*cols) -> Column:
    """First id that is not the single-space placeholder.

    Mirrors ``CASE WHEN a != ' ' THEN a WHEN b != ' ' ... ELSE NULL``: an empty
    string counts as present, NULL falls through to the next id.
    """
    return F.coalesce(*[F.when(col(c) != F.lit(BLANK), col(c)) for c in cols])

