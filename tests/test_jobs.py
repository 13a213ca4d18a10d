"""End-to-end jobs on small invented inputs written to a temp folder."""

import hashlib

import pytest

from applens.operators import arrivals as arr, ratings as rt
from applens.plans import jobs


def test_count_lines(spark, tmp_dir):
    with open(f"{tmp_dir}/log.txt", "w") as f:
        f.write("a\nb\nc\n")
    assert jobs.count_lines(spark, f"{tmp_dir}/log.txt") == 3


def _kv(spark, path):
    rows = []
    for i in range(20):
        key = hashlib.md5(str(i).encode()).hexdigest() + ("20170426" if i % 2 else "20170427") + str(i)
        scf = {"processType": "1", "appList": f"com.a{i}.{i:x};", "acceptTimestamp": str(1600000000250 + i),
               "packagelist": f"p{i}", "cdate": "20170426"}
        rows.append((key, scf))
    spark.createDataFrame(rows, "rowkey string, scf map<string,string>").write.mode("overwrite").parquet(path)
    return rows


def test_kv_export_and_prefix_lookup(spark, tmp_dir):
    rows = _kv(spark, f"{tmp_dir}/kv")
    jobs.kv_export(spark, f"{tmp_dir}/kv", "20170426", f"{tmp_dir}/out")
    out = spark.read.text(f"{tmp_dir}/out")
    assert out.count() == 10 and out.select("day").distinct().count() == 1
    with open(f"{tmp_dir}/ids.txt", "w") as f:
        f.write("\n".join([rows[3][0][:4], rows[3][0][:4], "zzzz", ""]) + "\n")
    jobs.kv_prefix_lookup(spark, f"{tmp_dir}/ids.txt", f"{tmp_dir}/kv", f"{tmp_dir}/hits")
    hits = [r[0] for r in spark.read.text(f"{tmp_dir}/hits").collect()]
    first = min(k for k, _ in rows if k.startswith(rows[3][0][:4]))
    assert len(hits) == 2 and all(h.startswith(first + "|") for h in hits)


def test_extract_app_detail(spark, tmp_dir):
    schema = ("firstimei string, secondimei string, thirdimei string, "
              "applist array<struct<signcrc32:string,pkg:string,appname:string>>, arrivetimes int, "
              "year string, month string, day string")
    src = spark.createDataFrame([("i1", " ", " ", [("c", "p", "n")], 1, "2017", "05", "01"),
                                 ("i2", " ", " ", [("c", "p", "n")], 1, "2017", "06", "01")], schema)
    src.write.mode("overwrite").partitionBy("year", "month", "day").parquet(f"{tmp_dir}/arrivals")
    jobs.extract_app_detail(spark, f"{tmp_dir}/arrivals", "201705", f"{tmp_dir}/detail")
    out = spark.read.parquet(f"{tmp_dir}/detail")
    assert [r["imei"] for r in out.collect()] == ["i1"]


def test_new_phone_models(spark, tmp_dir):
    with open(f"{tmp_dir}/pre.log", "w") as f:
        f.write("1.1.1.1|1600000000.250|model=mi5&brand=%D0%A1%C3%D7\n"
                "1.1.1.1|1600000000.250|model=known&brand=b\n"
                "1.1.1.1|bad|model=x&brand=y\n")
    known = spark.createDataFrame([("KNOWN", "B")], "model string, brand string")
    jobs.new_phone_models(spark, f"{tmp_dir}/pre.log", known, f"{tmp_dir}/new", f"{tmp_dir}/rej")
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/new").collect()] == [("MI5", "小米")]
    assert spark.read.parquet(f"{tmp_dir}/rej").select("reject").first()[0] == "bad_time"


def _ratings_files(tmp_dir):
    import random
    rnd = random.Random(5)
    lines, mine = [], []
    for u in range(1, 25):
        for i in range(1, 30):
            if rnd.random() < 0.5:
                r = 1 + ((u * i) % 5)
                lines.append(f"{u}::{i}::{float(r)}::{978300000 + rnd.randrange(100000)}")
    for i in (1, 2, 3):
        mine.append(f"0::{i}::{float(i)}")
    mine.append("0::4::0")
    with open(f"{tmp_dir}/ratings.dat", "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(f"{tmp_dir}/personalRatings.txt", "w") as f:
        f.write("\n".join(mine) + "\n")
    with open(f"{tmp_dir}/movies.dat", "w") as f:
        f.write("\n".join(f"{i}::Item {i}::Genre" for i in range(1, 35)) + "\n")


def test_movielens_job(spark, tmp_dir):
    _ratings_files(tmp_dir)
    res = jobs.movielens(spark, tmp_dir + "/", out=f"{tmp_dir}/top")
    assert res["n_ratings"] > 0 and res["best"][0] in (8, 12)
    assert res["test_rmse"] == res["test_rmse"] and res["baseline_rmse"] > 0
    top = spark.read.json(f"{tmp_dir}/top")
    assert top.count() > 0 and top.where("item_id in (1, 2, 3)").count() == 0   # already rated


def test_als_evaluation_job(spark, tmp_dir):
    import random
    rnd = random.Random(9)
    rows = [(f"dev{u}", f"com.app{i}", float(1 + (u + i) % 5), 1494400000000 + rnd.randrange(10 ** 6),
             "2017", "05", "10")
            for u in range(20) for i in range(15) if rnd.random() < 0.6]
    df = spark.createDataFrame(rows, "imei string, pkg string, rating double, lasttimestamp bigint, "
                                     "year string, month string, day string")
    df.write.mode("overwrite").partitionBy("year", "month", "day").parquet(f"{tmp_dir}/rating_table")
    res = jobs.als_evaluation(spark, f"{tmp_dir}/rating_table", "2017", "05", "10")
    assert res["best"][0] in (8, 12) and res["validation_rmse"] == res["validation_rmse"]


def test_als_demo_job(spark, tmp_dir):
    with open(f"{tmp_dir}/test.data", "w") as f:
        f.write("\n".join(f"{u},{i},{1 + (u * i) % 5}" for u in range(1, 6) for i in range(1, 6)) + "\n")
    mse = jobs.als_demo(spark, f"{tmp_dir}/test.data", f"{tmp_dir}/model", rank=3, iters=5)
    assert mse >= 0


ARRIVALS = ("firstimei string, secondimei string, thirdimei string, applist array<struct<signcrc32:string,pkg:string,appname:string>>, "
            "arrivetimes int, year string, month string, day string")


def _reports(spark, days):
    return spark.createDataFrame([("id", " ", " ", [("c", f"p{y}{m}{d}", "n")], 1, y, m, d) for y, m, d in days], ARRIVALS)


@pytest.mark.parametrize("month", [f"{m:02d}" for m in range(1, 13)])
def test_month_rewrite_from_a_partitioned_source(spark, tmp_dir, month):
    source, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    other = "03" if month == "02" else "02"
    _reports(spark, [("2016", month, "07"), ("2016", month, "08"), ("2016", other, "08")]).write.partitionBy("year", "month", "day").parquet(source)
    read = lambda: sorted((r["month"], r["day"]) for r in arr.read_app_detail(spark, out).collect())
    for m in (month, other):
        jobs.extract_app_detail(spark, source, "2016" + m, out)
    assert read() == sorted([(month, "07"), (month, "08"), (other, "08")])
    _reports(spark, [("2016", month, "07"), ("2016", month, "09")]).write.mode("overwrite").partitionBy("year", "month", "day").parquet(source)
    jobs.extract_app_detail(spark, source, "2016" + month, out)
    assert read() == sorted([(month, "07"), (month, "08"), (month, "09"), (other, "08")])
    jobs.extract_app_detail(spark, source, "2016" + month, out, replace_whole_month=True)
    assert read() == sorted([(month, "07"), (month, "09"), (other, "08")])


def test_month_without_rows_is_left_alone(spark, tmp_dir):
    source, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    _reports(spark, [("2016", "05", "07")]).write.partitionBy("year", "month", "day").parquet(source)
    jobs.extract_app_detail(spark, source, "201605", out)
    with pytest.raises(ValueError):
        arr.write_app_detail(spark, arr.explode_app_detail(arr.read_arrivals(spark, source), "201606"), out, replace_whole_month="201605")
    assert arr.read_app_detail(spark, out).count() == 1


def test_month_rewrite_of_catalogue_tables(spark):
    spark.sql("DROP TABLE IF EXISTS arrivals_src")
    spark.sql("DROP TABLE IF EXISTS app_detail_out")
    _reports(spark, [("2016", "05", "07"), ("2016", "05", "09")]).write.partitionBy("year", "month", "day").saveAsTable("arrivals_src")
    spark.sql(f"CREATE TABLE app_detail_out ({arr.APP_DETAIL_DDL}) USING parquet PARTITIONED BY (year, month, day)")
    old = _reports(spark, [("2016", "05", "07"), ("2016", "05", "08"), ("2016", "06", "01")])
    arr.write_app_detail(spark, arr.explode_app_detail(old), "app_detail_out")
    jobs.extract_app_detail(spark, "arrivals_src", "201605", "app_detail_out", replace_whole_month=True)
    got = sorted((r["month"], r["day"]) for r in arr.read_app_detail(spark, "app_detail_out").collect())
    assert got == [("05", "07"), ("05", "09"), ("06", "01")]
    spark.sql("DROP TABLE arrivals_src")
    spark.sql("DROP TABLE app_detail_out")


def test_every_job_can_be_started():
    starts = {"count-lines": ["x"], "jdbc-preview": ["u", "t", "c", "--lower", "1", "--upper", "2"], "als-demo": ["r", "m"],
              "movielens": ["h"], "als-evaluation": ["t", "2024", "01", "15", "--model-path", "m"], "kv-export": ["k", "d", "o"],
              "kv-prefix-lookup": ["i", "k", "o"], "extract-app": ["a", "201605", "o"],
              "new-phone-models": ["l", "o", "--known", "k"], "click-batch": ["p", "o"], "click-stream": ["s", "o", "c"]}
    for name, args in starts.items():
        assert jobs.parser().parse_args([name, *args]).job == name
    with pytest.raises(SystemExit):
        jobs.main(["click-stream", "s", "o", "c", "--kafka-bootstrap", "host:1"])
    with pytest.raises(SystemExit):
        jobs.main(["new-phone-models", "l", "o"])


def test_evaluation_keeps_its_best_model_and_id_maps(spark, tmp_dir, monkeypatch):
    from applens.operators import recommend
    monkeypatch.setattr(recommend, "GRID_TWO_WAY", {"rank": [2], "reg": [0.1], "iters": [2]})
    rows_ = [(f"u{i % 9}", f"a{i % 7}", float(i % 5), i, "2024", "01", "05") for i in range(300)]
    rt.write_rating_table(spark.createDataFrame(rows_, rt.RATING_TABLE_DDL), f"{tmp_dir}/t")
    out = jobs.als_evaluation(spark, f"{tmp_dir}/t", "2024", "01", "05", model_path=f"{tmp_dir}/m")
    assert out["best"] == (2, 0.1, 2)
    model, users, items = jobs.load_recommender(spark, f"{tmp_dir}/m")
    assert users.count() == 9 and items.count() == 7
    scored = recommend.score_for_user(model, users.where("user = 'u3'").first()["user_id"], items)
    assert scored.join(items, "item_id").count() == 7


def test_click_batch_quarantines(spark, tmp_dir):
    from applens.functions.payload import encode_payload
    import os
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a", "w") as f:
        f.write("ip|1600000000.250|" + encode_payload("a-b&br&mo|p&c&1;") + "\nip|9223372036854775.807|x\n")
    jobs.click_batch(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", rejects=f"{tmp_dir}/bad")
    assert spark.read.text(f"{tmp_dir}/out").count() == 1
    assert [r["reject"] for r in spark.read.parquet(f"{tmp_dir}/bad").collect()] == ["bad_time"]


def test_stream_survives_an_overflowing_time(spark, tmp_dir):
    from applens.functions.payload import encode_payload
    from applens.streaming import clicks_stream as cs
    import os
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a", "w") as f:
        f.write("ip|9223372036854775.807|x\nip|1600000000.250|" + encode_payload("a-b&br&mo|p&c&1;") + "\n")
    source = cs.read_click_source(spark, "text", f"{tmp_dir}/in")
    cs.run_until_caught_up(source, f"{tmp_dir}/out", f"{tmp_dir}/cp", zone="Asia/Shanghai")
    q = cs.start_click_rejects(source, f"{tmp_dir}/bad", f"{tmp_dir}/cp2", available_now=True)
    q.awaitTermination()
    assert spark.read.text(f"{tmp_dir}/out").count() == 1
    assert [(r["value"], r["reject"]) for r in spark.read.text(f"{tmp_dir}/bad").collect()] == [("ip|9223372036854775.807|x", "bad_time")]
