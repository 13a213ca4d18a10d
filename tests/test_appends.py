"""Routed appends and the stream after failures: every line once."""

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from applens.functions.payload import encode_payload
from applens.operators.clicks import click_lines, parse_click_lines
from applens.sinks import text as sink
from applens.streaming import clicks_stream as stream
from conftest import rows

SCHEMA = "route string, line string"


def _lines(spark, tag, n=40):
    return spark.createDataFrame([(f"2020/0{1 + i % 3}/07/", f"{tag}-{i}") for i in range(n)], SCHEMA).repartition(3)


def _all(spark, root):
    return sorted(rows(sink.read_routed(spark, root)))


def test_a_batch_run_again_appends_nothing_twice(spark, tmp_dir):
    root = f"{tmp_dir}/out"
    a, b = _lines(spark, "a"), _lines(spark, "b")
    for df, name in ((a, "monday"), (b, "tuesday"), (a, "monday"), (b, "tuesday")):
        sink.append_batch(df, root, name, compression="gzip")
    assert _all(spark, root) == sorted(rows(a) + rows(b))
    assert os.listdir(f"{root}/_batches") == []
    files = glob.glob(f"{root}/year=*/month=*/day=*/*")
    assert files and all(f.endswith(".gz") for f in files if not f.endswith(".crc"))
    with pytest.raises(ValueError):
        sink.append_batch(a, root, "../b")


def test_a_batch_that_failed_before_and_between_its_renames(spark, tmp_dir):
    root = f"{tmp_dir}/out"
    a, b = _lines(spark, "a"), _lines(spark, "b")
    sink.append_batch(a, root, "monday")
    broken = b.withColumn("line", F.when(F.col("line") == "b-39", F.raise_error(F.lit("lost"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="lost"):
        sink.append_batch(broken, root, "tuesday")
    assert _all(spark, root) == sorted(rows(a))              # readers see nothing of it
    # killed after some of its files were put in place
    sink.append_batch(b, root, "tuesday")
    placed = sorted(glob.glob(f"{root}/year=2020/month=02/day=07/tuesday-*"))
    assert placed
    for f in placed:
        os.remove(f)
    sink.append_batch(b, root, "tuesday")
    assert _all(spark, root) == sorted(rows(a) + rows(b))


def test_batches_appended_at_the_same_time(spark, tmp_dir):
    root = f"{tmp_dir}/out"
    lots = [_lines(spark, f"lot{i}") for i in range(4)]
    threads = [threading.Thread(target=sink.append_batch, args=(df, root, f"lot{i}")) for i, df in enumerate(lots)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert _all(spark, root) == sorted(r for df in lots for r in rows(df))


def test_a_stream_killed_between_its_output_and_its_commit(spark, tmp_dir):
    src, out, checkpoint = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/checkpoint"
    os.makedirs(src)
    for n in range(3):
        with open(f"{src}/{n}.log", "w") as f:
            f.writelines(f"1.1.{n}.{i}|{1600000000 + 86400 * i}.25{n}|{encode_payload('1-2&acme&x|com.a&ab&1,2;')}\n" for i in range(4))

    def run():
        source = stream.read_click_source(spark, "text", src, max_files_per_trigger=1)
        stream.run_until_caught_up(source, out, checkpoint)

    run()
    assert len(glob.glob(f"{checkpoint}/commits/[0-9]*")) == 3   # a batch per file
    def forget(*folders):                                        # as if the last batch had never been written there
        for f in (x for folder in folders for x in (f"{folder}/2", f"{folder}/.2.crc")):
            os.remove(f)

    forget(f"{checkpoint}/commits")
    run()
    batch = click_lines(parse_click_lines(spark.read.text(src)))
    assert _all(spark, out) == sorted(rows(batch))
    # and one whose sink log is gone as well: its output is written anew, the files of the first try are not read
    forget(f"{checkpoint}/commits", f"{out}/_spark_metadata")
    run()
    assert _all(spark, out) == sorted(rows(batch))


def test_the_appended_batches_parse_each_line_once(spark, monkeypatch):
    from applens.plans import queries

    parsed = spark.sparkContext.accumulator(0)

    def parse(x):
        parsed.add(1)
        return x

    once = F.udf(parse, "string").asNondeterministic()
    lines = _lines(spark, "a").withColumn("event_id", F.substring_index("line", "-", -1).cast("int"))
    monkeypatch.setattr(queries, "_clicks", lambda *_: lines.select("event_id", "route", once("line").alias("line")).withColumn("ok", F.col("line").isNotNull()))
    assert sorted(rows(queries.q_routed_appends(spark, ""))) == sorted(rows(lines, "route", "line"))
    assert parsed.value == 40
