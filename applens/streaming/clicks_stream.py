"""Launcher click stream: source -> shared click parser -> date-routed text.

* source: Kafka when the connector is deployed, otherwise a directory of text
  files; only the message value is used;
* transform: :func:`applens.operators.clicks.parse_click_lines`, the same code
  the batch job runs;
* sink: text files partitioned by the server-receive day, with a checkpoint,
  so each micro-batch is committed exactly once and a restarted query
  neither loses nor duplicates lines.  Late records are appended to the day
  they were received on; there is no watermark because nothing is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from applens.operators.clicks import click_lines, parse_click_lines
from applens.sinks.text import route_columns

DEFAULT_TRIGGER = "60 seconds"


def read_click_source(spark: SparkSession, kind: str = "text", path: str | None = None,
                      options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame with one ``value`` string per log line."""
    if kind == "kafka":
        reader = spark.readStream.format("kafka")
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def start_click_etl(source: DataFrame, out_root: str, checkpoint: str,
                    trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False,
                    compression: str | None = None, query_name: str | None = None,
                    zone: str = "UTC") -> StreamingQuery:
    """Readable reports, filed under their receive day in ``zone``."""
    routed = route_columns(click_lines(parse_click_lines(source, zone=zone)))
    w = (routed.select("line", "year", "month", "day").writeStream
         .format("text").outputMode("append")
         .option("path", out_root).option("checkpointLocation", checkpoint)
         .partitionBy("year", "month", "day"))
    return _start(w, trigger, available_now, compression, query_name)


def start_click_rejects(source: DataFrame, out_root: str, checkpoint: str,
                        trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False,
                        compression: str | None = None, query_name: str | None = None) -> StreamingQuery:
    """Quarantine: the raw lines that the other stream leaves out, under ``reject=<reason>``, by a query of its own."""
    parsed = parse_click_lines(source.select("value", F.col("value").alias("_line")), keep=["_line"])
    rejects = parsed.where(~F.col("ok")).select(F.col("_line").alias("value"), "reject")
    w = (rejects.writeStream.format("text").outputMode("append")
         .option("path", out_root).option("checkpointLocation", checkpoint).partitionBy("reject"))
    return _start(w, trigger, available_now, compression, query_name)


def _start(w, trigger: str | None, available_now: bool, compression: str | None, query_name: str | None) -> StreamingQuery:
    if compression:
        w = w.option("compression", compression)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def run_until_caught_up(source: DataFrame, out_root: str, checkpoint: str, **kw) -> None:
    """Process everything currently available, then stop (tests, backfills)."""
    finish(start_click_etl(source, out_root, checkpoint, available_now=True, **kw))


def finish(query: StreamingQuery) -> None:
    """Wait for a run over what is available to end; a failure is raised."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
