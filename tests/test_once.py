"""Small scans are dealt out, large ones left alone; two outputs of one parse read their input once."""

import os

from pyspark.sql import functions as F

from applens.functions.payload import encode_payload
from applens.plans import jobs
from applens.session import kept
from applens.sources import derived as dv, text as txt
from applens.sources.tables import spread
from applens.operators import kv
from conftest import rows


def test_a_scan_of_few_splits_is_dealt_out_and_a_wide_one_is_not(spark, tmp_dir):
    spark.range(0, 100, 1, 1).write.parquet(f"{tmp_dir}/one")
    spark.range(0, 100, 1, 12).write.parquet(f"{tmp_dir}/many")
    one, many = (spark.read.parquet(f"{tmp_dir}/{x}") for x in ("one", "many"))
    assert spread(one, 3).rdd.getNumPartitions() == 3 and sorted(r[0] for r in rows(spread(one, 3))) == list(range(100))
    wide = many.repartition(12)
    assert spread(wide, 12) is wide and spread(wide, 5) is wide


def test_two_outputs_of_one_parse(spark):
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def parse(x):
        parsed.add(1)
        return x

    with kept(spark.range(40).select(parse("id").alias("x"))) as once:
        assert once.where("x < 30").count() == 30
        assert once.where("x >= 30").count() == 10
    assert parsed.value == 40 and not once.storageLevel.useMemory


def test_click_batch_with_rejects_writes_both_from_one_parse(spark, tmp_dir):
    good = "ip|1600000000.250|" + encode_payload("a-b&br&mo|p&c&1;")
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.log", "w") as f:
        f.write(f"{good}\nno time|x|y\n{good}\nshort\n")
    jobs.click_batch(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", rejects=f"{tmp_dir}/bad")
    assert spark.read.text(f"{tmp_dir}/out").count() == 2
    assert sorted(rows(spark.read.parquet(f"{tmp_dir}/bad").select("raw", "reject"))) == [("no time|x|y", "bad_time"), ("short", "missing_field")]
    jobs.click_batch(spark, f"{tmp_dir}/in", f"{tmp_dir}/out2")
    assert spark.read.text(f"{tmp_dir}/out2").count() == 2


def test_widths_say_where_the_strict_reader_stops(spark):
    lines = spark.createDataFrame([("1,2,3.5",), ("1,2",), ("1,2,3,4",), ("",)], "value string")
    assert rows(txt.check_widths(lines).select("width", "abort")) == [(3, False), (2, True), (4, True), (1, True)]


def test_a_date_of_digits_is_compared_as_text_first(spark):
    keys = [("0" * 32 + "20240115x",), ("0" * 32 + "20240116x",), ("0" * 31 + "20240115x",)]
    df = spark.createDataFrame(keys, "rowkey string")
    hit = kv.rowkey_date_filter(df, "20240115", regex=True)
    assert rows(hit) == keys[:1]
    condition = hit._jdf.queryExecution().optimizedPlan().toString()
    assert condition.index("substring") < condition.index("RLIKE")
    assert rows(kv.rowkey_date_filter(df, "2024011[6]", regex=True)) == keys[1:2]


def test_the_table_of_characters_covers_its_rows():
    chars = dv.gbk_characters()
    assert len(chars) == 71 * 94 == len(set(chars)) and "�" not in chars
    assert chars[0] == "啊" and "华" in chars and "米" in chars
