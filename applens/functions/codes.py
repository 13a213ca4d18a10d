"""Small scalar codecs: packed coordinates, obfuscated app lists, string ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applens.functions.text import col, is_blank

# -- packed coordinates --------------------------------------------------------
# An 18-digit long: 3 integer + 6 fraction digits of longitude, then the same
# for latitude.  NULL and 0 mean "no fix" and read as 0.0.
GEO_DIGITS = 18


def _geo_digits(geo) -> Column:
    s = col(geo).cast("string")
    return F.when(F.length(s) >= GEO_DIGITS, s).otherwise(F.lpad(s, GEO_DIGITS, "0"))


def _geo_part(geo, start: int) -> Column:
    d = _geo_digits(geo)
    value = F.concat(F.substring(d, start, 3), F.lit("."), F.substring(d, start + 3, 6))
    return (F.when(col(geo).isNull() | (col(geo) == 0), F.lit(0.0))
            .otherwise(value.cast("double")))


def geo_longitude(geo) -> Column:
    return _geo_part(geo, 1)


def geo_latitude(geo) -> Column:
    return _geo_part(geo, 10)


# -- obfuscated app lists ---------------------------------------------------------
# Text is written as ``n<hex code unit>`` per character, the whole string is
# cut into chunks of max(3, len % 7) characters and each chunk is reversed.
# After decoding, ``@ # $`` stand for ``.`` and ``* %`` for ``;`` (fixed values).
_OBF_FROM = "@#$*%"
_OBF_TO = "...;;"


_WIDTHS = (3, 4, 5, 6)  # max(3, len % 7) can only take these values


def _reverse_groups(n: int) -> tuple[str, str]:
    """Regex capturing ``n`` characters and the replacement writing them back
    in reverse order."""
    return "(.)" * n, "".join(f"${i}" for i in range(n, 0, -1))


def _chunk_reverse(s: Column) -> Column:
    """Cut into chunks of max(3, len % 7) characters and reverse each chunk.

    The whole chunks are reversed by one literal regex per width (``(.)(.)(.)``
    -> ``$3$2$1``, applied left to right), the shorter rest by ``reverse``.
    """
    n = F.length(s)
    width = F.greatest(n % 7, F.lit(3))
    whole = n - n % width
    head, out = F.substring(s, F.lit(1), whole), None
    for w in _WIDTHS:
        pat, rep = _reverse_groups(w)
        branch = F.regexp_replace(head, "(?s)" + pat, rep)
        out = F.when(width == w, branch) if out is None else out.when(width == w, branch)
    return F.concat(out, F.reverse(F.substring(s, whole + 1, n)))


_HEX = "[0-9A-Fa-f]"
_UNIT_END = "(?=n|\\z)"


def _units_body(reversed_text: Column) -> Column:
    # drop the part before the first unit and trailing empty units
    return F.regexp_replace(F.regexp_replace(reversed_text, "^[^n]*", ""), "n+\\z", "")


# A UTF-16 surrogate without its other half stands for no character and is read as U+FFFD.
_HIGH, _LOW = "n[dD][89abAB][0-9A-Fa-f]{2}", "n[dD][c-fC-F][0-9A-Fa-f]{2}"


def _pair_surrogates(units: Column) -> Column:
    lows = F.regexp_replace(units, f"(?<!{_HIGH}){_LOW}", "nfffd")
    return F.regexp_replace(lows, f"{_HIGH}(?!{_LOW})", "nfffd")


def _decode_body(body: Column) -> Column:
    u = F.regexp_replace(body, f"n{_HEX}*({_HEX}{{4}}){_UNIT_END}", "n$1")
    for digits, pad in ((3, "0"), (2, "00"), (1, "000")):
        u = F.regexp_replace(u, f"n({_HEX}{{{digits}}}){_UNIT_END}", f"n{pad}$1")
    u = _pair_surrogates(u)
    return F.translate(F.decode(F.unhex(F.regexp_replace(u, "n", "")), "UTF-16BE"), _OBF_FROM, _OBF_TO)


def _valid_body(body: Column) -> Column:
    return body.rlike(f"^(?:n{_HEX}+)*\\z")


def deobfuscate(c) -> Column:
    """Obfuscated list -> plain text; blank -> NULL; a bad hex unit -> NULL.

    After un-reversing, the text is ``<ignored>n<hex>n<hex>...``: each unit is
    a UTF-16 code unit in hex (a longer value keeps its low 16 bits).  Units
    are normalised to four digits with regex rewrites and decoded in one
    ``decode(unhex(..), 'UTF-16BE')``.  For large inputs prefer
    :func:`with_deobfuscated`, which evaluates each step once.
    """
    s = col(c)
    body = _units_body(_chunk_reverse(s))
    return F.when(~is_blank(s) & _valid_body(body), _decode_body(body))


def with_deobfuscated(df: DataFrame, c: str, out: str) -> DataFrame:
    """``df`` plus ``out = deobfuscate(c)``, one projection per step so that no
    intermediate string is computed twice."""
    keep = [x for x in df.columns if x != out]
    staged = df.select(*keep, _chunk_reverse(F.col(c)).alias("_rev"))
    staged = staged.select(*keep, "_rev", _units_body(F.col("_rev")).alias("_body"))
    return staged.select(*keep, F.when(~is_blank("_rev") & _valid_body(F.col("_body")),
                                       _decode_body(F.col("_body"))).alias(out))


# -- 32-bit string hash ids ---------------------------------------------------------

def java_string_hash(c) -> Column:
    """``String.hashCode`` (over UTF-16 code units) as a signed 32-bit int.

    Kept for parity with ids produced by older jobs; it collides, so new
    tables should use :func:`applens.operators.ids.dense_index`.
    """
    units = F.regexp_extract_all(F.hex(F.encode(col(c), "UTF-16BE")), F.lit("[0-9A-F]{4}"), F.lit(0))
    h = F.aggregate(units, F.lit(0).cast("bigint"),
                    lambda acc, u: (acc * 31 + F.conv(u, 16, 10).cast("bigint")) % F.lit(4294967296))
    return F.when(h >= 2147483648, h - 4294967296).otherwise(h).cast("int")
