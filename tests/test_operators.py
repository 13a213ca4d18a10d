"""Operator semantics on small invented fixtures (FIXTURES.md sections A/B)."""

import hashlib
import random

from pyspark.sql import functions as F

from applens.operators import arrivals as arr, clicks as clk, ids, kv, lookup, models, ratings as rt
from applens.functions.payload import encode_payload
from conftest import rows


def test_splits_partition_the_input(spark):
    data = [(u, i, float(r), ts) for u, i, r, ts in
            [(1, 1, 5.0, 1000 + d) for d in range(10)] + [(2, 3, 0.0, 2009), (2, 3, 4.0, -7)]]
    r = spark.createDataFrame(data, "user_id int, item_id int, rating double, ts bigint")
    a, b, c = rt.split_three_way(r)
    assert a.count() + b.count() + c.count() == r.count()
    assert sorted(rows(a.unionByName(b).unionByName(c).drop("bucket"))) == sorted(rows(r))
    t, v = rt.split_two_way(r)
    assert t.count() + v.count() == r.count()
    counts = rt.split_counts(r).first().asDict()
    assert counts["n_training"] == 7 and counts["n_validation"] == 2 and counts["n_test"] == 3


def test_metrics_denominators(spark):
    train = spark.createDataFrame([(1, 10, 4.0), (2, 10, 2.0)], "user_id int, item_id int, rating double")
    val = spark.createDataFrame([(3, 10, 4.0), (3, 10, 4.0), (4, 99, 1.0)],
                                "user_id int, item_id int, rating double")
    model = rt.item_mean_model(train)          # item 10 -> 3.0, item 99 unseen
    joined = rt.actual_vs_predicted(model, val)
    assert joined.count() == 2                  # duplicate pair: 2 rows, not 4
    assert rt.mse(joined).first()["mse"] == 1.0
    assert abs(rt.rmse_all_rows(model, val).first()["rmse"] - (2 / 3) ** 0.5) < 1e-12
    assert rt.rmse_predicted_rows(joined).first()["rmse"] == 1.0
    guarded = rt.guard_predictions(rt.predict(model, val))
    assert guarded.count() == 2                 # NaN for the unseen item is dropped


def test_new_models_anti_join(spark):
    cand = spark.createDataFrame([("A", "X"), ("B", "Y"), ("C", None), ("D", "Z")], "model string, brand string")
    known = spark.createDataFrame([("A", "X"), ("C", None), ("D", "W")], "model string, brand string")
    new = models.new_models(cand, known)
    semi = cand.join(known, ["model", "brand"], "left_semi")
    assert sorted(rows(new)) == [("B", "Y"), ("C", None), ("D", "Z")]
    assert new.count() + semi.count() == cand.count()


def test_parse_reports_and_rejects(spark):
    lines = [(1, "1.2.3.4|1600000000.250|model=mi+5&brand=%D0%A1%C3%D7&brand=xiaomi"),
             (2, "1.2.3.4|12x|model=a&brand=b"), (3, "1.2.3.4|1.5|model=%zz"),
             (4, "1.2.3.4|1.5"), (5, "ip|1.5|model=ab&brand=DaeMon"), (6, "ip|1.5|model=&brand=b"),
             (7, "ip|1.5|=&model=a")]
    p = models.parse_reports(spark.createDataFrame(lines, "id int, value string"))
    got = {r["id"]: (r["model"], r["brand"], r["reject"]) for r in p.collect()}
    assert got[1] == ("MI 5", "XIAOMI", None)
    assert got[2][2] == "bad_time" and got[3][2] == "bad_escape" and got[4][2] == "missing_field"
    assert got[7][2] == "bad_param"
    clean = {r["id"] for r in models.drop_noise(p).collect()}
    assert clean == {1}


def test_explode_app_detail(spark):
    schema = ("firstimei string, secondimei string, thirdimei string, "
              "applist array<struct<signcrc32:string,pkg:string,appname:string>>, arrivetimes int, "
              "year string, month string, day string")
    data = [(" ", "", "c", [("s1", "p1", "n1"), ("s2", "p2", None)], 3, "2017", "05", "01"),
            (None, " ", "c2", [("s3", "p3", "n3")], 1, "2017", "05", "31"),
            ("a", "b", "c", None, 1, "2017", "05", "02"),
            ("a", "b", "c", [], 1, "2017", "05", "03"),
            ("z", "b", "c", [("s4", "p4", "n4")], 2, "2017", "06", "01")]
    df = spark.createDataFrame(data, schema)
    out = arr.explode_app_detail(df, "201705")
    assert out.columns == arr.APP_DETAIL_COLUMNS
    assert sorted(rows(out), key=str) == sorted([("", "n1", "p1", "s1", 3, "2017", "05", "01"),
                                                 ("", None, "p2", "s2", 3, "2017", "05", "01"),
                                                 ("c2", "n3", "p3", "s3", 1, "2017", "05", "31")], key=str)


def test_monthly_overwrite_dynamic_vs_whole_month(spark, tmp_dir):
    path = f"{tmp_dir}/app_detail"
    schema = arr.APP_DETAIL_DDL
    first = spark.createDataFrame([("i1", "a", "p", "c", 1, "2017", "05", "01"),
                                   ("i2", "a", "p", "c", 1, "2017", "05", "02"),
                                   ("i3", "a", "p", "c", 1, "2017", "06", "01")], schema)
    arr.write_app_detail(spark, first, path)
    again = spark.createDataFrame([("i9", "a", "p", "c", 1, "2017", "05", "01")], schema)
    arr.write_app_detail(spark, again, path)               # dynamic: 05/02 and June stay
    assert sorted(r["imei"] for r in arr.read_app_detail(spark, path).collect()) == ["i2", "i3", "i9"]
    arr.write_app_detail(spark, again, path, replace_whole_month="201705")   # 05/02 emptied
    t = arr.read_app_detail(spark, path)
    assert sorted(r["imei"] for r in t.collect()) == ["i3", "i9"]
    assert t.schema["month"].dataType.simpleString() == "string"
    assert t.where("month = '05'").count() == 1


def test_month_days_table(spark):
    months = spark.createDataFrame([("202402",), ("201612",)], "yyyymm string")
    out = arr.month_days_table(months)
    got = {m: n for m, n in rows(out.groupBy("yyyymm").count())}
    assert got == {"202402": 29, "201612": 31}
    assert out.where("yyyymm = '201612'").select("next_month").distinct().first()[0] == "201701"


def test_prefix_lookup_matches_brute_force(spark):
    rnd = random.Random(7)
    keys = sorted({hashlib.md5(str(i).encode()).hexdigest() + "2024" for i in range(400)})
    table = spark.createDataFrame([(k, f"pk{n}", f"d{n % 3}") for n, k in enumerate(keys)],
                                  "rowkey string, packagelist string, cdate string")
    ids_ = [k[:rnd.choice([1, 2, 3])] for k in rnd.sample(keys, 30)] + ["zz", "", "0", "0"]
    id_df = spark.createDataFrame([(n, i) for n, i in enumerate(ids_)], "n int, id string")
    got = sorted(rows(lookup.prefix_first_match(id_df, table, value_cols=["packagelist", "cdate"])
                      .select("n", "id", "rowkey", "packagelist")))
    expect = []
    for n, i in enumerate(ids_):
        if not i.strip():
            continue
        hits = [k for k in keys if k.startswith(i)]
        if hits:
            expect.append((n, i, hits[0], f"pk{keys.index(hits[0])}"))
    assert got == sorted(expect)


def test_prefix_lookup_plan_has_no_cartesian(spark):
    table = spark.createDataFrame([("abc1",), ("abd2",)], "rowkey string")
    id_df = spark.createDataFrame([("ab",), ("abd",)], "id string")
    plan = lookup.prefix_first_match(id_df, table)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_dense_index(spark):
    names = ["b", "a", "c", "a", None, "é", "B"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = dict(rows(ids.dense_index(df, "name", num_partitions=3)))
    expect = {v: i + 1 for i, v in enumerate(sorted({n for n in names if n is not None},
                                                     key=lambda s: s.encode()))}
    assert got == expect


def test_kv_report_lines(spark):
    scf = {"processType": "1", "appList": "com.a.12ab;", "acceptTimestamp": "1600000000250",
           "firstImei": " ", "phoneBrand": None}
    bad_time = dict(scf, acceptTimestamp="x")
    no_apps = dict(scf, appList=None)
    df = spark.createDataFrame([("k1", scf), ("k2", bad_time), ("k3", no_apps)],
                               "rowkey string, scf map<string,string>")
    out = rows(kv.report_lines(df))
    assert len(out) == 1 and out[0][1] == "2020/09/13/"
    fields = out[0][2].split("|")
    assert len(fields) == 23 and fields[1] == "1" and fields[13] == "000012ab,com.a"
    assert fields[6] == " " and fields[11] == " " and fields[22] == "1600000000250"
    lines = rows(kv.key_list_date_line(spark.createDataFrame(
        [("k", {"packagelist": "p"})], "rowkey string, scf map<string,string>")))
    assert lines == [("k", "k|p|null")]


def test_rowkey_filters(spark):
    df = spark.createDataFrame([("a" * 32 + "20240115x", {}), ("a" * 32 + "20240116", {}), ("short", {})],
                               "rowkey string, scf map<string,string>")
    assert kv.rowkey_date_filter(df, "20240115").count() == 1
    assert kv.rowkey_date_filter(df, "2024011[56]", regex=True).count() == 2


def _click(ip, ts, body):
    return f"{ip}|{ts}|{encode_payload(body)}"


def test_click_parse(spark):
    good = "111-222&acme&x1|com.a&ab12&1600000100000,1600000200000;cn.k&cd34&1600000300000;"
    lines = [(1, _click("1.2.3.4", "1600000000.250", good)),
             (2, _click("", "1600000000.250", good)),
             (3, _click("1.2.3.4", "1600000000.250", "111&b&m|com.a&ab12&1;com.b&2")),
             (4, "1.2.3.4|1600000000.250|%%%notbase64"),
             (5, _click("1.2.3.4", "1600000000.250", "&b&m|com.a&1&1")),
             (6, _click("1.2.3.4", "16000000x", good))]
    p = clk.parse_click_lines(spark.createDataFrame(lines, "id int, value string"))
    got = {r["id"]: (r["ok"], r["route"], r["line"]) for r in p.collect()}
    assert got[1] == (True, "2020/09/13/",
                      "111;222|1.2.3.4|1600000000250|2020-09-13 12:26:40|acme|x1|"
                      "com.a&ab12&1600000100000,1600000200000&2;cn.k&cd34&1600000300000&1")
    assert got[2][2].split("|")[1] == " "
    for bad in (3, 4, 5, 6):
        assert got[bad][0] is False and got[bad][2] is None
    per_app = dict((r["pkg"], (r["clicks"], r["reports"])) for r in clk.clicks_per_app(p).collect())
    assert per_app == {"com.a": (4, 2), "cn.k": (2, 2)}


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_stay_exact_and_pre_aggregate(spark):
    # a third of the table shares one prefix, a third of the reports one package
    n = 3000
    keys = [("aaa" + f"{i:06d}" if i % 3 == 0 else hashlib.md5(str(i).encode()).hexdigest(), f"p{i}")
            for i in range(n)]
    table = spark.createDataFrame(keys, "rowkey string, packagelist string").repartition(8)
    ids_ = spark.createDataFrame([("aaa",)] * 500 + [("aa",), (keys[1][0][:5],)], "id string")
    hits = lookup.prefix_first_match(ids_, table, value_cols=["packagelist"])
    got = hits.groupBy("id", "rowkey").count().collect()
    assert {(r["id"], r["rowkey"], r["count"]) for r in got} == {
        ("aaa", "aaa000000", 500), ("aa", min(k for k, _ in keys if k.startswith("aa")), 1),
        (keys[1][0][:5], min(k for k, _ in keys if k.startswith(keys[1][0][:5])), 1)}
    asked = ids_.select(F.col("id").alias("prefix")).distinct()
    plan = _physical(lookup.first_key_per_prefix(table, asked, [2, 3, 5]))
    assert "partial_min" in plan
    # values are fetched by key for the winners alone: the first shuffle carries no list
    assert all("packagelist" not in line for line in plan.splitlines() if "Exchange" in line)

    apps = [("hot" if i % 3 == 0 else f"app{i % 50}", 1 + i % 4) for i in range(n)]
    df = spark.createDataFrame(apps, "pkg string, n int").repartition(8)
    agg = df.groupBy("pkg").agg(F.sum("n").alias("clicks"))
    assert agg.where("pkg = 'hot'").first()["clicks"] == sum(c for p, c in apps if p == "hot")
    assert "partial_sum" in _physical(agg)


def test_rating_profile_exact_and_approx(spark):
    r = spark.range(0, 5000).select((F.col("id") % 300).cast("int").alias("user_id"),
                                    (F.col("id") % 70).cast("int").alias("item_id"),
                                    F.lit(1.0).alias("rating"))
    exact = rt.rating_profile(r).first()
    approx = rt.rating_profile(r, approx=True, rsd=0.02).first()
    assert (exact["n_ratings"], exact["n_users"], exact["n_items"]) == (5000, 300, 70)
    assert abs(approx["n_users"] - 300) <= 15 and abs(approx["n_items"] - 70) <= 4


def test_one_bad_time_is_a_reject_and_not_the_end(spark):
    lines = spark.createDataFrame([(1, "1.1.1.1|9223372036854775.807|x"), (2, "1.1.1.1|1600000000.250"),
                                   (3, "ip|1600000000.250|" + encode_payload("a-b&br&mo|p&c&1;"))], "id int, value string")
    got = {r["id"]: r["reject"] for r in clk.parse_click_lines(lines).collect()}
    assert got == {1: "bad_time", 2: "missing_field", 3: None}
    damaged = "ip|1600000000.250|" + encode_payload("a-b&br&mo|p&c&1;")[:40]
    more = spark.createDataFrame([(4, damaged), (5, "ip|1600000000.250|" + encode_payload("a-b&br|p&c&1;")),
                                  (6, "ip|1600000000.250|" + encode_payload("a-b&br&mo|p&c;"))], "id int, value string")
    assert {r["id"]: r["reject"] for r in clk.click_rejects(clk.parse_click_lines(more), ["id"]).collect()} == {
        4: "bad_payload", 5: "bad_body", 6: "bad_app"}
    reports = spark.createDataFrame([(1, "ip|9223372036854775.807|model=a&brand=b")], "id int, value string")
    assert models.parse_reports(reports).first()["reject"] == "bad_time"
    fields = {"appList": "com.a.1", "processType": "1"}
    store = spark.createDataFrame([("k1", {**fields, "acceptTimestamp": "9223372036854775807"}),
                                   ("k2", {**fields, "acceptTimestamp": "1600000000250"}),
                                   ("k3", {"acceptTimestamp": "1600000000250"})], "rowkey string, scf map<string,string>")
    assert [r["rowkey"] for r in kv.report_lines(store).collect()] == ["k2"]
    assert {r["rowkey"]: r["reject"] for r in kv.rejected_reports(store).collect()} == {"k1": "bad_time", "k3": "no_app_list"}


def test_day_route_follows_the_zone(spark):
    late = 1_600_000_000_250 + 6 * 3_600_000          # 18:26 UTC: the next day in Shanghai
    store = spark.createDataFrame([("k", {"appList": "a.1", "acceptTimestamp": str(late)})], "rowkey string, scf map<string,string>")
    assert kv.report_lines(store).first()["route"] == "2020/09/13/"
    assert kv.report_lines(store, zone="Asia/Shanghai").first()["route"] == "2020/09/14/"
    r = spark.createDataFrame([(f"ip|{late // 1000}.250|model=a&brand=b",)], "value string")
    assert models.parse_reports(r, zone="Asia/Shanghai").first()["posttime"].startswith("2020-09-14")


def test_dense_ids_are_dense_at_any_width(spark):
    for n, parts in ((20_000, 8), (20_000, 200), (300_000, 8)):
        keys = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"))
        out = ids.dense_index(keys.unionAll(keys.limit(100)), "k", num_partitions=parts)
        row = out.agg(F.count("*"), F.count_distinct("dense_id"), F.min("dense_id"), F.max("dense_id")).first()
        assert tuple(row) == (n, n, 1, n)
    some = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(300_000))
    got = {r["k"]: r["dense_id"] for r in out.where("dense_id % 50000 = 1").collect()}
    assert got == {some[i]: i + 1 for i in range(0, 300_000, 50_000)}


def test_blank_id_list_gives_no_rows_and_all_columns(spark):
    ids_ = spark.createDataFrame([("",), (" ",), (None,)], "id string")
    table = spark.createDataFrame([("abc", "p", "d")], "rowkey string, packagelist string, cdate string")
    out = lookup.prefix_first_match(ids_, table, value_cols=["packagelist", "cdate"])
    assert out.columns == ["id", "rowkey", "packagelist", "cdate"] and out.count() == 0


def test_nothing_scored_is_not_perfect(spark):
    model = spark.createDataFrame([(1, 3.0)], "item_id int, prediction double")
    data = spark.createDataFrame([(1, 9, 4.0, 8), (2, 9, 5.0, 9)], "user_id int, item_id int, rating double, ts bigint")
    assert rt.rmse_all_rows(model, data).first()["rmse"] is None
    assert rt.rmse_all_rows(model, data.limit(0)).first()["rmse"] is None
    out = rt.mean_baseline(data, model).first()
    assert out["model_rmse"] is None and out["improvement_pct"] is None


def test_baseline_does_not_cancel(spark):
    r = spark.range(100_000).select(F.col("id").cast("int").alias("user_id"), F.lit(1).alias("item_id"),
                                    (F.lit(1e8) + (F.col("id") % 5) * 2e-4).alias("rating"), F.col("id").alias("ts"))
    out = rt.mean_baseline(r, rt.item_mean_model(r.where("ts % 10 < 6"))).first()
    assert 0 < out["baseline_rmse"] < 1e-3


def test_metrics_use_one_join(spark):
    model = spark.createDataFrame([(1, 3.0)], "item_id int, prediction double")
    data = spark.createDataFrame([(1, 1, 4.0, 8)], "user_id int, item_id int, rating double, ts bigint")
    for df in (rt.actual_vs_predicted(model, data), rt.rmse_all_rows(model, data)):
        assert _physical(df).count("Join") == 1


def test_kv_table_by_date_prunes(spark, tmp_dir):
    rows_ = [(hashlib.md5(str(i).encode()).hexdigest() + f"202401{1 + i % 20:02d}" + "u", {"processType": str(i)}) for i in range(60)]
    path = f"{tmp_dir}/kv"
    kv.write_kv_table(spark.createDataFrame(rows_, "rowkey string, scf map<string,string>"), path)
    hit = kv.rowkey_date_filter(kv.read_kv_table(spark, path), "20240115", regex=True)
    assert hit.count() == 3 and "PartitionFilters: [isnotnull(keydate" in _physical(hit)
    pattern = kv.rowkey_date_filter(kv.read_kv_table(spark, path), "2024011[56]", regex=True)
    assert pattern.count() == 6


def test_known_models_of_a_maker_with_very_many_rows(spark):
    phones = spark.createDataFrame([("M1", 1)] * 500 + [("M2", 1), ("m1", 2), ("x", 9)], "phonemodelcode string, manufacturerid int")
    makers = spark.createDataFrame([(1, "A"), (2, "b")], "manufacturerid int, manufacturername string")
    assert sorted(rows(models.known_models(phones, makers)), key=str) == [("M1", "A"), ("M1", "B"), ("M2", "A"), ("X", None)]
