"""Launcher click logs: ``ip|sec.millis|payload`` -> routed click lines.

The same :func:`parse_click_lines` serves the batch job and the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.functions import dates
from applens.functions.payload import payload_text
from applens.functions.text import blank_to_space, java_split


def _at(arr, i: int):
    return F.try_element_at(arr, F.lit(i))


def parse_click_lines(lines: DataFrame, value_col: str = "value",
                      keep: list[str] | None = None, zone: str = "UTC") -> DataFrame:
    """Raw lines -> ``route`` (``yyyy/MM/dd/`` of the server time), ``line``,
    plus the typed fields (``imeis, ip, server_ms, server_time, brand, model,
    apps``), ``ok`` and ``reject``.  Unreadable reports have ``ok = false`` and the reason:
    ``missing_field``, ``bad_time``, ``bad_payload`` (not decodable), ``bad_body`` (no device, phone or app
    part) or ``bad_app`` (an app without its third part).

    The body ``id1-id2&brand&model|pkg&crc&t1,t2;...`` is split in stages
    so no split is evaluated twice.  One app without its third part makes the whole report
    unreadable.  Records are filed under the server's receive date, so late
    data lands in the day it arrived; nothing is dropped for lateness.
    """
    keep = keep if keep is not None else [c for c in lines.columns if c != value_col]
    h = lines.select(*keep, F.split(F.col(value_col), r"\|", 3).alias("_h"))
    h = h.select(*keep, _at("_h", 1).alias("ip"),
                 dates.parse_sec_millis(_at("_h", 2)).alias("server_ms"),
                 _at("_h", 3).alias("_payload"), (F.size("_h") == 3).alias("_whole"))
    b = h.select(*keep, "ip", "server_ms", "_whole",
                 payload_text(F.when(F.col("server_ms").isNotNull() & F.col("_whole"), F.col("_payload"))).alias("_body"))
    b = b.select(*keep, "ip", "server_ms", "_whole", F.col("_body").isNotNull().alias("_decoded"),
                 java_split("_body", "|").alias("_pieces"))
    b = b.select(*keep, "ip", "server_ms", "_whole", "_decoded", F.size("_pieces").alias("_np"),
                 java_split(_at("_pieces", 1), "&").alias("_phone"),
                 java_split(_at("_pieces", 2), ";").alias("_tokens"))
    b = b.select(*keep, "ip", "server_ms", "_whole", "_decoded", "_np", "_phone", "_tokens",
                 F.transform("_tokens", lambda a: java_split(a, "&")).alias("_details"))
    apps = F.transform(F.arrays_zip(F.col("_tokens").alias("raw"), F.col("_details").alias("d")),
                       lambda z: F.struct(
                           _at(z["d"], 1).alias("pkg"),
                           _at(z["d"], 2).alias("crc"),
                           java_split(_at(z["d"], 3), ",").alias("clicks"),
                           z["raw"].alias("raw")))
    imeis = F.array_join(java_split(_at("_phone", 1), "-"), ";")
    b = b.select(*keep, "ip", "server_ms", imeis.alias("imeis"),
                 _at("_phone", 2).alias("brand"), _at("_phone", 3).alias("model"),
                 apps.alias("_apps"),
                 (F.when(~F.col("_whole"), "missing_field")
                  .when(F.col("server_ms").isNull(), "bad_time")
                  .when(~F.col("_decoded"), "bad_payload")
                  .when(~F.coalesce((F.col("_np") >= 2) & (F.size("_phone") >= 3) & (F.size("_tokens") > 0)
                                    & (F.length(imeis) > 0), F.lit(False)), "bad_body")
                  .when(F.exists("_details", lambda d: F.size(d) < 3), "bad_app")).alias("reject"))
    parsed = b.select(
        *keep, "ip", "server_ms",
        dates.format_epoch_ms("server_ms", zone=zone).alias("server_time"),
        dates.date_route("server_ms", zone=zone).alias("route"),
        "imeis", "brand", "model", "reject",
        F.transform("_apps", lambda a: F.struct(
            a["pkg"].alias("pkg"), a["crc"].alias("crc"), a["clicks"].alias("clicks"),
            F.size(a["clicks"]).alias("n_clicks"), a["raw"].alias("raw"))).alias("apps"),
        F.col("reject").isNull().alias("ok"))
    app_text = F.array_join(F.transform("apps", lambda a: F.concat(a["raw"], F.lit("&"),
                                                                   a["n_clicks"].cast("string"))), ";")
    line = F.concat_ws("|", "imeis", blank_to_space("ip"), F.col("server_ms").cast("string"),
                       blank_to_space("server_time"), blank_to_space("brand"),
                       blank_to_space("model"), app_text)
    return parsed.withColumn("line", F.when(F.col("ok"), line))


def click_lines(parsed: DataFrame) -> DataFrame:
    """Readable reports only: (route, line) ready for the date-routed sink."""
    return parsed.where("ok").select("route", "line")


def click_rejects(parsed: DataFrame, value_cols: list[str] | None = None) -> DataFrame:
    """Quarantine output: what :func:`click_lines` leaves out and why, with the kept columns named."""
    return parsed.where(~F.col("ok")).select(*(value_cols or []), "ip", "server_ms", "reject")


def clicks_per_app(parsed: DataFrame) -> DataFrame:
    """Total clicks and number of reports per app package."""
    apps = parsed.where("ok").select("imeis", F.explode("apps").alias("a"))
    return (apps.groupBy(F.col("a.pkg").alias("pkg"))
            .agg(F.sum(F.col("a.n_clicks").cast("bigint")).alias("clicks"),
                 F.count(F.lit(1)).alias("reports")))
