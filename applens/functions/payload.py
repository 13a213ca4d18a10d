"""Compressed click-log payloads.

A payload is base64 text (``*`` written for ``/``) of a ZIP stream holding one
deflated entry.  Devices write the local header and the data but never the
central directory, so archive readers that start from the end (Python's
``zipfile``) cannot open it.  Decoding therefore walks the local header and
inflates the raw deflate stream that follows it.

Base64 and the header are read by column expressions.  What goes to Python is
one binary slice a row, the entry's data behind a byte that tells how it is
kept; an Arrow UDF inflates it straight from the Arrow buffer.
"""

from __future__ import annotations

import base64
import struct
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from applens.functions.text import col

try:  # ship this module's helpers with the UDF so executors need no install
    import sys as _sys
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, KeyError):  # pragma: no cover
    pass

_LOCAL_HEADER = b"PK\x03\x04"
_HEADER_BYTES = 30
_STORED, _DEFLATED = b"\0", b"\1"
_LONGEST = 2 ** 31 - 1


def _bytes_of_base64(text: Column) -> Column:
    """Base64 decode of the plain and the URL-safe alphabet that skips other
    characters and tolerates missing padding (a trailing lone character carries
    no full byte)."""
    def decoded(clean: Column) -> Column:
        extra = F.length(clean) % 4
        whole = F.when(extra == 1, F.substring(clean, F.lit(1), F.length(clean) - 1)).otherwise(clean)
        return F.unbase64(F.concat(whole, F.when(extra == 2, "==").when(extra == 3, "=").otherwise("")))
    return _bound(F.regexp_replace(F.translate(text, "-_", "+/"), "[^A-Za-z0-9+/]+", ""), decoded)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: the one-element array gives it a name.  ``use`` must not
    bind further values: a Python UDF over a lambda that uses the variable of an outer one is not planned."""
    return F.transform(F.array(value), use)[0]


def _number(data: Column, at: int, width: int) -> Column:
    """Little-endian unsigned number of ``width`` bytes at offset ``at``."""
    parts = [F.conv(F.hex(F.substring(data, at + 1 + i, 1)), 16, 10).cast("bigint") * (1 << 8 * i) for i in range(width)]
    return sum(parts[1:], parts[0])


def _first_entry(data: Column) -> Column:
    """Bytes of a ZIP stream -> how its first entry is kept and the entry's data (all that follows, if deflated).

    No local header gives an empty entry: an empty stream has none.
    """
    start = (_number(data, 26, 2) + _number(data, 28, 2) + (_HEADER_BYTES + 1)).cast("int")
    is_entry = (F.length(data) >= _HEADER_BYTES) & (F.substring(data, 1, 4) == F.lit(_LOCAL_HEADER))
    is_stored = _number(data, 8, 2) == 0
    size = F.least(_number(data, 18, 4), F.lit(_LONGEST)).cast("int")
    return F.when(data.isNull(), None).when(~is_entry, F.lit(_STORED)).when(
        is_stored, F.concat(F.lit(_STORED), F.substring(data, start, size))).otherwise(
        F.concat(F.lit(_DEFLATED), F.substring(data, start, F.lit(_LONGEST))))


def _inflated(entry: memoryview) -> bytes | None:
    """The entry's text bytes; None for a damaged deflate stream."""
    if entry[:1] == _STORED:
        return entry[1:].tobytes()
    inflater = zlib.decompressobj(-zlib.MAX_WBITS)
    try:
        body = inflater.decompress(entry[1:]) + inflater.flush()
    except zlib.error:
        return None
    return body if inflater.eof else None      # else the stream stops before its final block


@F.arrow_udf(StringType())
def _inflate_udf(entries: pa.Array) -> pa.Array:
    if not len(entries):
        return pa.array([], pa.string())
    entries = entries.cast(pa.large_binary())
    _, offsets, data = entries.buffers()
    edges = memoryview(offsets).cast("q")[entries.offset:entries.offset + len(entries) + 1].tolist()
    view, known = memoryview(data if data is not None else b""), entries.is_valid().to_pylist()
    bodies = [_inflated(view[a:b]) if ok else None for a, b, ok in zip(edges, edges[1:], known)]
    try:
        return pa.array(bodies, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:                    # some body is not UTF-8
        return pa.array([None if b is None else b.decode("utf-8", errors="replace") for b in bodies], pa.string())


# Marked nondeterministic only so the optimizer evaluates each call exactly
# where it is written: a filter on parsed fields would otherwise be pushed
# below the projection and the payloads inflated twice (once per node).
_inflate_once = _inflate_udf.asNondeterministic()


def unzip_payload(c) -> Column:
    """base64 ZIP text -> text of its first entry; NULL in -> NULL out, no entry -> ``''``, damaged -> NULL."""
    return _inflate_once(_bound(_bytes_of_base64(col(c)), _first_entry))


def payload_text(c) -> Column:
    """Raw payload field (``*`` for ``/``) -> decompressed text."""
    return unzip_payload(F.translate(col(c), "*", "/"))


# -- encoding side: what a device sends ------------------------------------

def zip_entry_without_directory(text: str, name: str = "0") -> bytes:
    """One deflated entry with a data descriptor and no central directory."""
    raw = text.encode("utf-8")
    comp = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    data = comp.compress(raw) + comp.flush()
    fname = name.encode()
    header = struct.pack("<4sHHHHHIIIHH", _LOCAL_HEADER, 20, 0x0808, 8, 0, 0,
                         0, 0, 0, len(fname), 0)
    descriptor = struct.pack("<4sIII", b"PK\x07\x08", zlib.crc32(raw) & 0xFFFFFFFF,
                             len(data), len(raw))
    return header + fname + data + descriptor


def encode_payload(text: str | None) -> str | None:
    """Text -> payload field as written in the log (``/`` sent as ``*``)."""
    if text is None:
        return None
    return base64.b64encode(zip_entry_without_directory(text)).decode().replace("/", "*")


@F.pandas_udf(StringType())
def _encode_udf(s: pd.Series) -> pd.Series:
    return s.map(encode_payload, na_action="ignore")


_encode_once = _encode_udf.asNondeterministic()


def encode_payload_col(c) -> Column:
    return _encode_once(col(c))
