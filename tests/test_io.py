"""Sources and sinks: delimited text, routed text, streaming."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from applens.operators.clicks import click_lines, parse_click_lines
from applens.functions.payload import encode_payload
from applens.sinks.text import write_routed, write_single_file
from applens.sources import text as txt
from applens.streaming.clicks_stream import read_click_source, run_until_caught_up
from conftest import rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_read_delimited_ratings(spark, tmp_dir):
    _write(f"{tmp_dir}/r/ratings.dat", "1::10::4.5::978300760\n2::11::3.0::978300769\n")
    r = txt.read_ratings(spark, f"{tmp_dir}/r")
    assert rows(r) == [(1, 10, 4.5, 978300760, 0), (2, 11, 3.0, 978300769, 9)]
    _write(f"{tmp_dir}/p/personal.txt", "0::10::5\n0::12::0\n")
    p = txt.read_ratings(spark, f"{tmp_dir}/p", fields=3).where("rating > 0")
    assert rows(p) == [(0, 10, 5.0)]


def test_comma_ratings_must_have_three_fields(spark, tmp_dir):
    _write(f"{tmp_dir}/ok/a.csv", "1,1,5.0\n1,2,1.0\n")
    assert txt.read_ratings(spark, f"{tmp_dir}/ok", sep=",", fields=3, strict_width=True).count() == 2
    _write(f"{tmp_dir}/bad/a.csv", "1,1,5.0\n1,2,1.0,9\n")
    with pytest.raises(Exception, match="not 3 fields"):
        txt.read_ratings(spark, f"{tmp_dir}/bad", sep=",", fields=3, strict_width=True).collect()
    _write(f"{tmp_dir}/nan/a.csv", "1,x,5.0\n")
    with pytest.raises(Exception):
        txt.read_ratings(spark, f"{tmp_dir}/nan", sep=",", fields=3).collect()


def test_line_count_matches_text_reader(spark, tmp_dir):
    texts = ["a\nb\n", "a\n\n", "", "one", "x\r\ny\rz"]
    for n, t in enumerate(texts):
        with open(f"{tmp_dir}/f{n}.txt", "w", newline="") as f:
            f.write(t)
    by_reader = sum(txt.read_lines(spark, f"{tmp_dir}/f{n}.txt").count() for n in range(len(texts)))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert df.select(F.sum(txt.line_count("text"))).first()[0] == by_reader
    assert txt.explode_lines(df, "text").count() == by_reader


def test_routed_text_appends_do_not_collide(spark, tmp_dir):
    root = f"{tmp_dir}/routed"
    df = spark.createDataFrame([("2020/09/13/", "a"), ("2017/04/27/", "b")], "route string, line string")
    threads = [threading.Thread(target=write_routed, args=(df, root), kwargs={"concurrent_writers": True})
               for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    back = spark.read.text(root)
    assert back.count() == 6
    assert sorted(rows(back.groupBy("day").count())) == [(13, 3), (27, 3)]
    write_routed(df, f"{tmp_dir}/gz", compression="gzip")
    assert any(f.endswith(".gz") for _, _, fs in os.walk(f"{tmp_dir}/gz") for f in fs)
    write_single_file(df, f"{tmp_dir}/single")
    assert len([f for f in os.listdir(f"{tmp_dir}/single") if f.startswith("part-")]) == 1


def _log(ip, ts, body):
    return f"{ip}|{ts}|{encode_payload(body)}\n"


def test_click_stream_exactly_once_and_late_data(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    body = "111-222&acme&x1|com.a&ab12&1600000000000;"
    _write(f"{src}/b1.log", _log("1.1.1.1", "1600000000.250", body) + _log("1.1.1.2", "1600000001.000", body))
    run_until_caught_up(read_click_source(spark, "text", src), out, ckpt)
    assert spark.read.text(out).count() == 2
    run_until_caught_up(read_click_source(spark, "text", src), out, ckpt)     # nothing new
    assert spark.read.text(out).count() == 2
    # a late batch (older receive date) goes to its own day; no duplicates of earlier lines
    _write(f"{src}/b2.log", _log("1.1.1.3", "1599800000.000", body) + "garbage line\n")
    run_until_caught_up(read_click_source(spark, "text", src), out, ckpt)
    back = spark.read.text(out)
    assert back.count() == 3
    assert sorted(rows(back.groupBy("day").count())) == [(11, 1), (13, 2)]
    # the stream wrote exactly what the batch parser produces for the same lines
    batch = click_lines(parse_click_lines(spark.read.text(src))).select("line")
    assert sorted(rows(back.select(F.col("value").alias("line")))) == sorted(rows(batch))


def test_item_dimension_last_line_wins(spark, tmp_dir):
    _write(f"{tmp_dir}/movies/movies.dat", "1::First::x\n2::Second\n1::First again\n")
    items = txt.parse_items(txt.read_lines(spark, f"{tmp_dir}/movies"))
    assert sorted(rows(items)) == [(1, "First again"), (2, "Second")]


def test_click_stream_gzip_output(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _write(f"{src}/b1.log", _log("1.1.1.1", "1600000000.250", "1-2&b&m|com.a&ab12&1,2;"))
    run_until_caught_up(read_click_source(spark, "text", src), out, ckpt, compression="gzip")
    files = [f for _, _, fs in os.walk(out) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert rows(spark.read.text(out).select("value")) == [
        ("1;2|1.1.1.1|1600000000250|2020-09-13 12:26:40|b|m|com.a&ab12&1,2&2",)]


def test_last_line_wins_over_files_of_any_size(spark, tmp_dir):
    _write(f"{tmp_dir}/items/a.dat", "1::old\n2::first\n")
    _write(f"{tmp_dir}/items/b.dat", "1::new\n" + "".join(f"{i}::name {i}\n" for i in range(10, 4000)))
    _write(f"{tmp_dir}/items/c.dat", "2::second\n2::third\n")
    items = txt.parse_items(txt.read_ordered_lines(spark, f"{tmp_dir}/items"), pos_col="pos")
    assert {r["item_id"]: r["name"] for r in items.where("item_id < 3").collect()} == {1: "new", 2: "third"}


def test_a_line_of_a_separator_with_special_characters(spark):
    df = spark.createDataFrame([("1.*2.*3.5",)], "value string")
    assert rows(txt.parse_delimited_ratings(df, sep=".*", fields=3)) == [(1, 2, 3.5)]
