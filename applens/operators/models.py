"""New phone models: parse device reports, drop noise, compare to a catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.functions import dates, querystring as qs
from applens.functions.text import is_not_blank


def parse_reports(lines: DataFrame, value_col: str = "value", charset: str = "GBK",
                  keep: list[str] | None = None, zone: str = "UTC") -> DataFrame:
    """``ip|sec.millis|k=v&...`` (percent-encoded in ``charset``) -> typed fields.

    Adds ``ip, server_ms, posttime, params`` (the decoded query string),
    upper-cased ``model`` and ``brand`` (``''`` when absent) and ``reject``
    (NULL for readable reports, else the reason).  The whole line is decoded
    first; a bad escape, a missing ``|`` field, a time that is no number or no
    date, or a parameter without a key makes the report unreadable.  Every step is a
    built-in expression.
    """
    keep = keep if keep is not None else [c for c in lines.columns if c != value_col]
    df = lines.select(*keep, F.col(value_col),
                      qs.url_decode(F.col(value_col), charset).alias("_decoded"))
    df = df.select(*keep, value_col, "_decoded", F.split("_decoded", r"\|", 3).alias("_p"))
    df = df.select(*keep, value_col, "_decoded", F.size("_p").alias("_np"),
                   F.try_element_at("_p", F.lit(1)).alias("ip"),
                   dates.parse_sec_millis(F.try_element_at("_p", F.lit(2))).alias("server_ms"),
                   F.try_element_at("_p", F.lit(3)).alias("params"))
    reject = (F.when(F.col("_decoded").isNull(), F.lit("bad_escape"))
              .when(F.col("_np") < 3, F.lit("missing_field"))
              .when(F.col("server_ms").isNull(), F.lit("bad_time"))
              .when(qs.qs_invalid("params"), F.lit("bad_param")))
    return df.select(
        *keep, value_col, "ip", "server_ms",
        dates.format_epoch_ms("server_ms", zone=zone).alias("posttime"), "params",
        F.upper(qs.qs_value("params", "model")).alias("model"),
        F.upper(qs.qs_value("params", "brand")).alias("brand"),
        reject.alias("reject"))


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject").isNull())


def rejected(parsed: DataFrame) -> DataFrame:
    """Quarantine output: the unreadable reports and why."""
    return parsed.where(F.col("reject").isNotNull())


def drop_noise(parsed: DataFrame) -> DataFrame:
    return readable(parsed).where(~qs.is_noise("model", "brand"))


def distinct_models(parsed: DataFrame) -> DataFrame:
    """Distinct (model, brand) pairs of clean reports (partial aggregation
    map-side, so a hot model costs one row per task before the shuffle)."""
    return drop_noise(parsed).select("model", "brand").distinct()


def known_models(phone_models: DataFrame, manufacturers: DataFrame) -> DataFrame:
    """Catalogue pairs: model code -> manufacturer name (left join, so a model
    whose manufacturer is unknown has a NULL brand), de-duplicated, upper-cased
    where present."""
    up = lambda c: F.when(is_not_blank(c), F.upper(c)).otherwise(F.col(c))
    # models are de-duplicated before the join, so a maker of very many rows costs its distinct models
    codes = phone_models.select("phonemodelcode", "manufacturerid").distinct()
    return (codes.join(manufacturers.select("manufacturerid", "manufacturername").distinct(), "manufacturerid", "left")
            .select(up("phonemodelcode").alias("model"), up("manufacturername").alias("brand"))
            .distinct())


def new_models(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs not in the catalogue.  A NULL catalogue brand never matches."""
    return candidates.join(known, ["model", "brand"], "left_anti")
