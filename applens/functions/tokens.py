"""App-list tokens reported by devices -> (signature crc, package, app name).

A device reports its installed apps as one ``;``-separated string whose token
shape depends on the report's ``processType``:

* ``1`` and any other / missing type: ``<pkg>.<crc>``
* ``2``: ``<pkg>.<crc>``, or ``<pkg>_<filecrc>.<signcrc>.<partition>`` when the
  last ``.``-segment is a single character
* ``3``: ``<pkg>&<app name>.<filecrc>.<signcrc>.<partition>``

Parsing stops at the first token that does not fit its shape; the tokens
before it are kept (the valid prefix).  Everything is a native expression
(``transform``/``slice``), without Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from applens.functions.text import col, java_split

CRC_WIDTH = 8

ELEMENT_TYPE = "struct<crc:string,pkg:string,appname:string>"


def crc_pad(c) -> Column:
    """Left-fill a CRC shorter than 8 characters with zeros; longer ones unchanged.

    (``lpad`` alone would truncate values longer than the width.)
    """
    c = col(c)
    return F.when(F.length(c) < CRC_WIDTH, F.lpad(c, CRC_WIDTH, "0")).otherwise(c)


def _before_last(t: Column, ch: str) -> Column:
    return F.regexp_extract(t, "(?s)^(.*)" + ("\\" + ch), 1)


def _has(t: Column, ch: str) -> Column:
    return F.instr(t, ch) > 0


def _element(crc, pkg, appname=None) -> Column:
    return F.struct(crc_pad(crc).alias("crc"), pkg.alias("pkg"),
                    (appname if appname is not None else F.lit(None).cast("string"))
                    .alias("appname"))


def _parse_dotted(t: Column) -> Column:
    # <pkg>.<crc>
    return F.when(_has(t, "."), _element(F.substring_index(t, ".", -1),
                                         _before_last(t, ".")))


def _parse_type2(t: Column) -> Column:
    last = F.substring_index(t, ".", -1)
    after_us = F.substring_index(t, "_", -1)
    pieces = java_split(after_us, ".")
    split_form = F.when(_has(t, "_") & (F.size(pieces) >= 2),
                        _element(F.try_element_at(pieces, F.lit(2)), _before_last(t, "_")))
    return F.when(F.length(last) == 1, split_form).otherwise(_parse_dotted(t))


def _parse_type3(t: Column) -> Column:
    pkg = F.substring_index(t, "&", 1)
    rest = F.substring(t, F.instr(t, "&") + 1, F.lit(2 ** 31 - 1))
    no_part = _before_last(rest, ".")          # drop the partition
    crc = F.substring_index(no_part, ".", -1)  # signature crc
    no_crc = _before_last(no_part, ".")        # drop it
    appname = _before_last(no_crc, ".")        # drop the file crc
    ok = _has(t, "&") & _has(rest, ".") & _has(no_part, ".") & _has(no_crc, ".")
    return F.when(ok, _element(crc, pkg, appname))


def parse_app_token(t: Column, process_type: Column) -> Column:
    """One token -> struct<crc,pkg,appname>, or NULL when it does not parse."""
    return (F.when(process_type == "2", _parse_type2(t))
            .when(process_type == "3", _parse_type3(t))
            .otherwise(_parse_dotted(t)))


def parse_app_list(apps, process_type) -> Column:
    """``;``-separated app list -> array of parsed tokens (valid prefix).

    NULL list -> NULL (the caller treats the whole report as unreadable).
    """
    apps, process_type = col(apps), col(process_type)
    tokens = java_split(apps, ";")
    parsed = F.transform(tokens, lambda t: parse_app_token(t, process_type))

    def prefix(p: Column) -> Column:
        stop = F.array_position(F.transform(p, lambda e: e.isNull()), True)      # 0: none
        return F.slice(p, F.lit(1), F.when(stop == 0, F.size(p)).otherwise(stop - 1).cast("int"))

    # the one-element array binds the parsed list to a name, so it is built once
    return F.transform(F.array(parsed), prefix)[0]


def format_app_list(parsed) -> Column:
    """Parsed list -> ``crc,pkg[,appname];...``."""
    return F.array_join(
        F.transform(col(parsed), lambda e: F.concat_ws(",", e["crc"], e["pkg"], e["appname"])),
        ";")
