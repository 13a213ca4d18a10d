"""Percent-decoding and ``k=v&k=v`` parsing for device report logs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from applens.functions.text import col, is_blank

# Words whose presence in upper(model) + upper(brand) marks a report as noise
# (fixed values).
NOISE_WORDS = ["ADB", "DAEMON", "ERROR", "WARNING", "CANNOT"]


def url_decode(c, charset: str = "GBK") -> Column:
    """Form-URL decoding with a given byte charset (``+`` is a space, runs of
    ``%XX`` are bytes in ``charset``); NULL when an escape is malformed.

    This calls the JVM's own form decoder through Spark's built-in
    ``try_reflect``: one expression per value, no Python, and exactly the
    decoder the reports were produced for.
    """
    return F.try_reflect(F.lit("java.net.URLDecoder"), F.lit("decode"), col(c), F.lit(charset))


def qs_value(c, key: str) -> Column:
    """Value of ``key`` in ``k=v&k=v`` text: the last occurrence wins, a key
    without ``=`` or a missing key gives ``''``, and only the text up to a
    second ``=`` counts.  A single codegen'd regex per key."""
    pattern = f"(?s)^(?:.*&)?{re.escape(key)}(?:=([^&]*))?(?:&|\\z)"
    return F.substring_index(F.regexp_extract(col(c), pattern, 1), "=", 1)


def qs_invalid(c) -> Column:
    """A parameter made only of ``=`` has no key; the report is unreadable."""
    return F.coalesce(col(c).rlike(r"(?:^|&)=+(?:&|\z)"), F.lit(False))


def qs_map(c) -> Column:
    """``k=v&k=v`` text -> map; of a repeated key the last value stays.

    Entries are folded from the end, so no map ever holds a key twice and the
    session's policy for such keys does not matter.
    """
    key = lambda t: F.substring_index(t, "=", 1)

    def entries(pairs: Column) -> Column:
        last = F.filter(pairs, lambda t, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda u: key(u) == key(t)))
        return F.transform(last, lambda t: F.struct(key(t).alias("k"), F.coalesce(F.get(F.split(t, "="), F.lit(1)), F.lit("")).alias("v")))

    # the one-element array binds the split text to a name, so it is split once
    pairs = F.filter(F.split(F.regexp_replace(col(c), r"&+\z", ""), "&"), lambda t: t != "")
    return F.map_from_entries(F.transform(F.array(pairs), entries)[0])


def is_noise(model, brand) -> Column:
    """Blank model or brand, or a noise word anywhere in model+brand."""
    both = F.concat(F.upper(col(model)), F.upper(col(brand)))
    pattern = "|".join(NOISE_WORDS)
    return is_blank(model) | is_blank(brand) | both.rlike(pattern)
