"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the shared tables (through the derived inputs in
``applens.sources.derived``) and runs the library's operators over all of
their rows.  Computed doubles are rounded to 6 decimals so the result can be
compared value-for-value with the DuckDB oracle in ``oracles.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from applens.functions import codes, dates, tokens
from applens.functions import querystring as qs
from applens.functions.text import java_split
from applens.operators import arrivals as arr
from applens.operators import clicks as clk
from applens.operators import ids, kv, lookup, models, ratings as rt, recommend, topn
from applens.session import pinned, remove_path, scratch_path
from applens.sinks.text import append_batch, read_routed
from applens.sources import derived as dv
from applens.sources import text as txt
from applens.streaming import clicks_stream as stream

PERSONAL_USER = 0          # the person the personal ratings belong to
TOP_N = 50
SCAN_DAY = ("2024", "01", "15")
KV_SCAN_DATE = "20240115"
OVERWRITE_MONTH = "199607"

Query = Callable[[SparkSession, str], DataFrame]


def r6(c):
    return F.round(c, 6)


# -- ratings ------------------------------------------------------------------

def _ratings(spark, sf):
    return txt.parse_delimited_ratings(dv.ratings_lines(spark, sf))


def _splits(spark, sf):
    return rt.split_three_way(_ratings(spark, sf))


def q_line_count(spark, sf):
    docs = dv.table(spark, sf, "documents")
    return docs.agg(F.count(F.lit(1)).alias("n_docs"),
                    F.sum(txt.line_count("text")).cast("bigint").alias("n_lines"))


def q_parse_ratings_delim(spark, sf):
    return _ratings(spark, sf)


def q_strict_ratings(spark, sf):
    """Stored comma ratings by width: how many lines have it, how many the strict reader would abort on, and, of those that it
    takes, how many it returns and their rating total."""
    def read(path):
        lines = txt.check_widths(txt.read_lines(spark, f"{path}/all"))
        widths = lines.groupBy("width").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("abort").alias("n_abort"))
        lines.where(~F.col("abort")).select("value").write.text(f"{path}/good")
        good = txt.read_ratings(spark, f"{path}/good", sep=",", fields=3, strict_width=True)
        strict = good.agg(F.lit(3).alias("width"), F.count("rating").alias("n_strict"), r6(F.sum("rating")).alias("rating_total"))
        return widths.join(F.broadcast(strict), "width", "left")

    return _from_stored(spark, "strict-ratings", lambda p: dv.comma_ratings(spark, sf).select("value").write.text(f"{p}/all"), read)


def q_personal_ratings(spark, sf):
    lines = dv.personal_lines(spark, sf)
    return rt.personal(txt.parse_delimited_ratings(lines, fields=3), PERSONAL_USER)


def q_rating_profile(spark, sf):
    return rt.rating_profile(_ratings(spark, sf))


def q_split_three_way(spark, sf):
    r = _ratings(spark, sf)
    return r.select("user_id", "item_id", "rating", "ts", rt.split_label_three_way().alias("split"))


def q_split_two_way(spark, sf):
    r = _ratings(spark, sf)
    return r.select("user_id", "item_id", "rating", "ts", rt.split_label_two_way().alias("split"))


def q_split_counts(spark, sf):
    return rt.split_counts(_ratings(spark, sf))


def q_union_training(spark, sf):
    r = _ratings(spark, sf)
    training, _, _ = rt.split_three_way(r)
    return rt.union_training(training, rt.personal(r, PERSONAL_USER))


def _model_and_validation(spark, sf):
    training, validation, _ = _splits(spark, sf)
    return rt.item_mean_model(training), validation


def q_actual_vs_predicted(spark, sf):
    model, validation = _model_and_validation(spark, sf)
    j = rt.actual_vs_predicted(model, validation)
    return j.select("user_id", "item_id", "rating", "ts", r6("prediction").alias("prediction"))


def q_mse(spark, sf):
    model, validation = _model_and_validation(spark, sf)
    m = rt.mse(rt.actual_vs_predicted(model, validation))
    return m.select(r6("mse").alias("mse"), "n_pairs")


def q_rmse_all_rows(spark, sf):
    model, validation = _model_and_validation(spark, sf)
    return rt.rmse_all_rows(model, validation).select(r6("rmse").alias("rmse"), "n_predicted", "n_rows")


def q_rmse_predicted_rows(spark, sf):
    model, validation = _model_and_validation(spark, sf)
    out = rt.rmse_predicted_rows(rt.actual_vs_predicted(model, validation))
    return out.select(r6("rmse").alias("rmse"), "n_predicted")


def q_prediction_guard(spark, sf):
    model, validation = _model_and_validation(spark, sf)
    scored = rt.predict(model, validation.select("user_id", "item_id", "rating"))
    return rt.guard_predictions(scored).select("user_id", "item_id", "rating",
                                               r6("prediction").alias("prediction"))


def q_mean_baseline(spark, sf):
    r = _ratings(spark, sf)
    training, _, _ = rt.split_three_way(r)
    out = rt.mean_baseline(r, rt.item_mean_model(training))
    return out.select(r6("mean_rating").alias("mean_rating"), r6("baseline_rmse").alias("baseline_rmse"),
                      r6("model_rmse").alias("model_rmse"),
                      F.round("improvement_pct", 2).alias("improvement_pct"), "n_test")


# -- arrivals -------------------------------------------------------------------

def _rating_table(spark, sf):
    """Daily-partitioned rating table (device, app, rating, last time)."""
    ev = dv.table(spark, sf, "events")
    ms = dates.epoch_millis("ts")
    return ev.select(F.col("user_id").cast("string").alias("imei"),
                     F.concat(F.lit("com.app"), F.get_json_object("props", "$.k")).alias("pkg"),
                     F.col("value").alias("rating"), ms.alias("lasttimestamp"),
                     *dates.route_parts(ms))


def _from_stored(spark, name, write, read) -> DataFrame:
    """What ``read`` takes from a table that ``write`` stores in the shared folder, which is removed again."""
    path = scratch_path(spark, name)
    try:
        write(path)
        return pinned(read(path))
    finally:
        remove_path(spark, path)


def q_partition_scan(spark, sf):
    return _from_stored(spark, "rating-table", lambda p: rt.write_rating_table(_rating_table(spark, sf), p),
                        lambda p: rt.read_rating_day(spark, p, *SCAN_DAY))


def q_first_nonblank_id(spark, sf):
    return arr.resolve_imei(dv.customer_ids(spark, sf)).select("c_custkey", "imei")


def q_app_detail_explode(spark, sf):
    return arr.explode_app_detail(dv.arrivals(spark, sf))


def q_month_days(spark, sf):
    months = (dv.table(spark, sf, "orders")
              .select(F.date_format("o_orderdate", "yyyyMM").alias("yyyymm")).distinct())
    return arr.month_days_table(months)


def q_monthly_partition_overwrite(spark, sf):
    """All days are written; then one month is rewritten whole from reports of which those of every third day are gone."""
    def write(path):
        source, detail = f"{path}/reports", f"{path}/detail"
        dv.arrivals(spark, sf).write.parquet(source)
        reports = arr.read_arrivals(spark, source)
        arr.write_app_detail(spark, arr.explode_app_detail(reports), detail)
        fewer = reports.where(F.col("day").cast("int") % 3 != 0)
        arr.write_app_detail(spark, arr.explode_app_detail(fewer, OVERWRITE_MONTH), detail, replace_whole_month=OVERWRITE_MONTH)

    return _from_stored(spark, "app-detail", write,
                        lambda p: arr.read_app_detail(spark, f"{p}/detail").groupBy("year", "month", "day")
                        .agg(F.count(F.lit(1)).alias("n_rows")))


# -- phone models -------------------------------------------------------------------

def _reports(spark, sf):
    return models.parse_reports(dv.preinstall_lines(spark, sf))


def q_query_string_map(spark, sf):
    p = models.readable(_reports(spark, sf)).withColumn("_m", qs.qs_map("params"))
    m = F.col("_m")
    return p.select("event_id", "posttime", "model", "brand", m["ver"].alias("ver"),
                    F.size(m).alias("n_params"))


def q_noise_filter(spark, sf):
    return models.drop_noise(_reports(spark, sf)).select("event_id", "model", "brand")


def q_distinct_models(spark, sf):
    return models.distinct_models(_reports(spark, sf))


def _known(spark, sf):
    return models.known_models(dv.phone_models(spark, sf), dv.manufacturers(spark, sf))


def q_known_models(spark, sf):
    return _known(spark, sf)


def q_new_models(spark, sf):
    return models.new_models(models.distinct_models(_reports(spark, sf)), _known(spark, sf))


def q_malformed_rows(spark, sf):
    """Quarantined rows of all three kinds of report, with their reasons."""
    reports = models.rejected(_reports(spark, sf)).select(F.lit("phone").alias("kind"), F.col("event_id").cast("string").alias("id"), "reject")
    parsed = clk.parse_click_lines(dv.click_lines(spark, sf))
    clicks = clk.click_rejects(parsed, ["event_id"]).select(F.lit("click").alias("kind"), F.col("event_id").cast("string").alias("id"), "reject")
    keyed = kv.rejected_reports(dv.kv_table(spark, sf)).select(F.lit("kv").alias("kind"), F.col("rowkey").alias("id"), "reject")
    return reports.unionAll(clicks).unionAll(keyed)


def q_gbk_url_decode(spark, sf):
    return dv.gbk_texts(spark, sf).select("c_custkey", qs.url_decode("value", "GBK").alias("decoded"))


# -- key-value export -------------------------------------------------------------------

def q_kv_scan_rowkey_regex(spark, sf):
    t = kv.rowkey_date_filter(dv.kv_table(spark, sf), KV_SCAN_DATE, regex=True)
    return t.select("rowkey", F.col("scf")["processType"].alias("processType"))


def q_kv_project(spark, sf):
    return kv.project(dv.kv_table(spark, sf))


def q_kv_text_format(spark, sf):
    return kv.key_list_date_line(dv.kv_table(spark, sf))


def q_delimited_line(spark, sf):
    return kv.report_lines(dv.kv_table(spark, sf))


def q_nonblank_filter(spark, sf):
    lines = kv.nonblank(dv.routed_lines(spark, sf))
    return lines.groupBy("route").agg(F.count(F.lit(1)).alias("n_lines"))


def q_app_token_parse(spark, sf):
    p = kv.project(dv.kv_table(spark, sf), ["processType", "appList"]).where(F.col("appList").isNotNull())
    return p.select("rowkey", "processType",
                    tokens.format_app_list(tokens.parse_app_list("appList", "processType")).alias("apps"))


def q_crc_pad(spark, sf):
    p = kv.project(dv.kv_table(spark, sf), ["counterCrc32"])
    return p.select("rowkey", F.col("counterCrc32").alias("crc"), tokens.crc_pad("counterCrc32").alias("padded"))


def q_split_trailing(spark, sf):
    p = kv.project(dv.kv_table(spark, sf), ["appList"]).where(F.col("appList").isNotNull())
    return p.select("rowkey", F.size(java_split("appList", ";")).alias("n_tokens"),
                    F.size(F.split("appList", ";")).alias("n_pieces"))


def q_prefix_first_match(spark, sf):
    t = kv.project(dv.kv_table(spark, sf), ["packagelist", "cdate"])
    return lookup.prefix_first_match(dv.id_list(spark, sf), t, value_cols=["packagelist", "cdate"])


def q_date_route(spark, sf):
    p = models.readable(_reports(spark, sf))
    return p.select("event_id", "server_ms", dates.date_route("server_ms").alias("route"),
                    *dates.route_parts("server_ms"))


# -- click log -------------------------------------------------------------------

def _clicks(spark, sf):
    return clk.parse_click_lines(dv.click_lines(spark, sf))


def q_log_header(spark, sf):
    return _clicks(spark, sf).select("event_id", "ip", "server_ms", "server_time")


def q_payload_decode(spark, sf):
    lines = dv.click_lines(spark, sf)
    from applens.functions.payload import payload_text
    return lines.select("event_id", payload_text(F.try_element_at(F.split("value", r"\|", 3), F.lit(3))).alias("body"))


def q_click_log_parse(spark, sf):
    return _clicks(spark, sf).where("ok").select("event_id", "route", "line")


def q_clicks_per_app(spark, sf):
    return clk.clicks_per_app(_clicks(spark, sf))


def _streamed(spark, sf, name, start, read) -> DataFrame:
    """Two runs of a stream over click logs that arrive in two lots, a file per micro-batch.

    The second run starts from the first one's checkpoint.  Every file holds lines of all days, so
    each micro-batch but the first is late for the days it adds to.
    """
    def write(path):
        lines = dv.click_lines(spark, sf)
        for lot in (0, 1):
            lines.where(F.col("event_id") % 2 == lot).select("value").repartition(3).write.mode("append").text(f"{path}/in")
            source = stream.read_click_source(spark, "text", f"{path}/in", max_files_per_trigger=1)
            stream.finish(start(source, f"{path}/out", f"{path}/checkpoint", available_now=True))

    return _from_stored(spark, name, write, lambda p: read(f"{p}/out"))


def q_stream_routed_lines(spark, sf):
    """What the click stream files under each day, read back from its directories after a restart."""
    return _streamed(spark, sf, "stream-lines", stream.start_click_etl, lambda p: read_routed(spark, p))


def q_stream_rejects(spark, sf):
    """What the stream's quarantine holds of each reason."""
    def read(path):
        back = spark.read.schema("value string, reject string").text(path)
        return back.groupBy("reject").agg(F.count(F.lit(1)).alias("n_lines"))

    return _streamed(spark, sf, "stream-rejects", stream.start_click_rejects, read)


def q_routed_appends(spark, sf):
    """Click lines appended by two batches at once, gzip, both with lines of every day, and one of them run again.

    The lines are parsed once and stored for the batches: a filter is not taken below the parse, so each batch
    would parse those of the others too.
    """
    from concurrent.futures import ThreadPoolExecutor

    def write(path):
        _clicks(spark, sf).where("ok").select("event_id", "route", "line").write.parquet(f"{path}/parsed")
        lines = spark.read.parquet(f"{path}/parsed")
        lots = [lines.where(F.col("event_id") % 3 == 0), lines.where(F.col("event_id") % 3 != 0)]
        with ThreadPoolExecutor(2) as pool:
            list(pool.map(lambda at: append_batch(lots[at], f"{path}/out", f"lot{at}", compression="gzip"), (0, 1)))
        append_batch(lots[1], f"{path}/out", "lot1", compression="gzip")

    return _from_stored(spark, "routed-appends", write, lambda p: read_routed(spark, f"{p}/out"))


# -- ids ---------------------------------------------------------------------------

def q_java_hash_id(spark, sf):
    p = dv.table(spark, sf, "part")
    return p.select("p_partkey", "p_name", codes.java_string_hash("p_name").alias("name_hash"))


def q_dense_id(spark, sf):
    return ids.dense_index(dv.table(spark, sf, "customer"), "c_name")


# -- items and recommendations -------------------------------------------------------------------

def _items(spark, sf):
    return txt.parse_items(dv.items_lines(spark, sf))


def q_item_name_lookup(spark, sf):
    rated = _ratings(spark, sf).select("item_id").distinct()
    return rated.join(_items(spark, sf), "item_id")


def q_unrated_candidates(spark, sf):
    return recommend.unrated_candidates(_items(spark, sf), _ratings(spark, sf), PERSONAL_USER)


def q_top_n_items(spark, sf):
    training, _, _ = _splits(spark, sf)
    model = rt.item_mean_model(training)
    items = _items(spark, sf)
    cands = recommend.unrated_candidates(items, _ratings(spark, sf), PERSONAL_USER)
    scored = rt.predict(model, cands).withColumn("prediction", r6("prediction"))
    return recommend.top_n(scored, items, TOP_N)


def q_preview_limit(spark, sf):
    t = arr.resolve_imei(dv.customer_ids(spark, sf))
    return t.select(F.col("c_custkey").alias("id"), "imei").orderBy("id").limit(10)


# -- codecs -------------------------------------------------------------------

def q_packed_geo(spark, sf):
    g = dv.geo_reports(spark, sf)
    cells = g.select(F.floor(codes.geo_longitude("geo")).alias("lon_cell"),
                     F.floor(codes.geo_latitude("geo")).alias("lat_cell"))
    return cells.groupBy("lon_cell", "lat_cell").agg(F.count(F.lit(1)).alias("n"))


def q_deobfuscate_list(spark, sf):
    p = kv.project(dv.kv_table(spark, sf), ["appList"]).where(F.col("appList").isNotNull())
    hidden = p.select("rowkey", dv.hide_text(F.translate("appList", ".;", "@*")).alias("hidden"))
    return codes.with_deobfuscated(hidden, "hidden", "text").select("rowkey", "text")


# -- ALS: what does not depend on the solver is checked against SQL -------------------------------------------------------------------

def _als_inputs(spark, sf):
    r = _ratings(spark, sf)
    training, validation = rt.split_two_way(r)
    return r, training, validation


def als_predictions(spark, sf):
    """Validation rows whose user and item were trained on, with their prediction."""
    _, training, validation = _als_inputs(spark, sf)
    model = recommend.fit(training, rank=8, reg=0.1, max_iter=10)
    return recommend.score(model, validation).select("user_id", "item_id", "rating", "prediction")


def q_als_predict(spark, sf):
    """Validation rows that get a usable prediction: those whose user and item were trained on."""
    return als_predictions(spark, sf).select("user_id", "item_id", "rating", (F.abs("prediction") < 1000).alias("usable"))


def _against_stored(spark, path, error) -> DataFrame:
    """The rows of ``<path>/grid`` beside what the stored predictions of their settings give: rows, scored rows, ``error`` of
    them; whether that is the error reported, and whether the winner is the first of the least."""
    again = (spark.read.parquet(f"{path}/predictions").groupBy(F.col("trial").cast("int").alias("place"))
             .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.isnan("prediction")).alias("n_scored"), error.alias("stored")))
    both = spark.read.parquet(f"{path}/grid").join(again, "place")
    least = both.agg(F.min(F.struct("validation_rmse", "place")).alias("least"))
    return (both.crossJoin(F.broadcast(least))          # one row
            .withColumn("error_matches", F.abs(F.col("stored") - F.col("validation_rmse")) < 1e-9)
            .withColumn("winner_is_least", F.col("best") == (F.col("place") == F.col("least.place"))))


def q_als_grid(spark, sf):
    """ALS over the two-way grid against its stored predictions: rows and scored rows of each setting, whether its error, over
    scored rows, is that of the stored rows, and whether the winner is the first of the least errors."""
    def write(path):
        with recommend.held(_ratings(spark, sf)) as r:
            training, validation = rt.split_two_way(r)
            res = recommend.grid_search(training, validation, recommend.GRID_TWO_WAY, parallelism=4, keep=f"{path}/predictions", cache=False)
        _grid_rows(spark, res, None).write.parquet(f"{path}/grid")

    def read(path):
        usable = F.when(F.col("prediction") < 1000, (F.col("rating") - F.col("prediction")) ** 2)
        return _against_stored(spark, path, F.sqrt(F.avg(usable))).select(
            "place", "rank", "reg", "iters", "n_rows", "n_scored", (F.col("validation_rmse") > 0).alias("scored"), "error_matches", "winner_is_least")

    return _from_stored(spark, "als-grid-two-way", write, read)


def _als_top(spark, sf):
    """All ratings, the person's scored items, and the best of them."""
    r, training, _ = _als_inputs(spark, sf)
    model = recommend.fit(training, rank=8, reg=0.1, max_iter=10)
    items = _items(spark, sf)
    cands = recommend.unrated_candidates(items, r, PERSONAL_USER)
    scored = pinned(recommend.score_for_user(model, PERSONAL_USER, cands))     # counted and ranked
    return r, scored, recommend.top_n(scored, items, TOP_N)


def als_top_items(spark, sf):
    """The person's best unrated items: rank, item_id, name, prediction and a line to print."""
    return _als_top(spark, sf)[2]


def q_als_top_n(spark, sf):
    """Ranks of the listed items, how many were scored, and whether each is unrated and no better than the one before."""
    r, scored, top = _als_top(spark, sf)
    mine = r.where(F.col("user_id") == PERSONAL_USER).select("item_id").distinct().withColumn("rated", F.lit(True))
    best_first = F.coalesce(F.col("prediction") <= F.lag("prediction").over(Window.orderBy("rank")), F.lit(True))
    n_scored = F.lit(scored.count()).alias("n_scored")
    return (top.withColumn("ordered", best_first).join(mine, "item_id", "left")
            .select("rank", n_scored, F.col("rated").isNull().alias("unrated"), "ordered"))


def _three_way_grid(spark, sf, trainer=None, keep=None):
    """(result, test error) of the three-way grid: all rows count in an error, the winner is scored on the third split."""
    with recommend.held(_ratings(spark, sf)) as r:
        training, validation, test = rt.split_three_way(r)
        res = recommend.grid_search(training, validation, recommend.GRID_THREE_WAY, all_rows_denominator=True, parallelism=4,
                                    trainer=trainer, keep=keep, cache=False)
        return res, recommend.rmse_over_all(res.model, test)


def _grid_rows(spark, res, test_rmse) -> DataFrame:
    """A row per setting: its error, whether it won, and the winner's error on the test split."""
    rows = [(i, rk, rg, it, e, won, test_rmse if won else None) for i, (rk, rg, it, e) in enumerate(res.trials)
            for won in [(rk, rg, it) == (res.rank, res.reg, res.iters)]]
    return spark.createDataFrame(rows, "place int, rank int, reg double, iters int, validation_rmse double, best boolean, test_rmse double")


def q_grid_three_way(spark, sf):
    """The 16 settings of the three-way grid over a predictor that SQL can fit as well: errors, winner and its test error."""
    grid = _grid_rows(spark, *_three_way_grid(spark, sf, recommend.fit_item_bias))
    return grid.withColumn("validation_rmse", r6("validation_rmse")).withColumn("test_rmse", r6("test_rmse"))


def als_grid_errors(spark, sf):
    """The same with ALS: 16 fits."""
    return _grid_rows(spark, *_three_way_grid(spark, sf))


def q_als_grid_three_way(spark, sf):
    """ALS over the three-way grid against its stored predictions: rows and scored rows of each setting, whether its error is
    that of the stored rows, and whether the winner is the first of the least stored errors."""
    def write(path):
        res, test_rmse = _three_way_grid(spark, sf, keep=f"{path}/predictions")
        _grid_rows(spark, res, test_rmse).write.parquet(f"{path}/grid")

    def read(path):
        e2 = F.when(~F.isnan("prediction"), (F.col("rating") - F.col("prediction")) ** 2)
        return _against_stored(spark, path, F.sqrt(F.sum(e2) / F.count(F.lit(1)))).select(
            "place", "rank", "reg", "iters", "n_rows", "n_scored", "error_matches", "winner_is_least",
            (F.col("best") == F.col("test_rmse").isNotNull()).alias("winner_tested"))

    return _from_stored(spark, "als-grid", write, read)


def q_model_round_trip(spark, sf):
    """A model is saved, read back and scored beside the first: rows, rows scored by either, and whether all predictions agree."""
    _, training, validation = _als_inputs(spark, sf)
    model = recommend.fit(training, rank=8, reg=0.1, max_iter=10)

    def read(path):
        def scored(m, sign):
            return recommend.score(m, validation).select("user_id", "item_id", "rating", "prediction", F.lit(sign).alias("sign"))
        both = scored(model, 1).unionAll(scored(recommend.ALSModel.load(path), -1))
        per_row = both.groupBy("user_id", "item_id", "rating", "prediction").agg(
            F.sum("sign").alias("surplus"), F.count_if(F.col("sign") > 0).alias("n_before"), F.count_if(F.col("sign") < 0).alias("n_after"))
        out = per_row.agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after"), F.bool_and(F.col("surplus") == 0).alias("all_equal"))
        n_rows = validation.agg(F.count(F.lit(1)).alias("n_rows"))
        return n_rows.crossJoin(out)              # a row each

    return _from_stored(spark, "als-model", lambda p: model.write().save(p), read)


def q_all_users_top_n(spark, sf):
    """Every user's best unrated items, by whole-number factors that SQL can sum up as well."""
    return topn.top_unrated(dv.user_factors(spark, sf), dv.item_factors(spark, sf), _ratings(spark, sf), TOP_N)


def als_all_users_top(spark, sf):
    """Every user's best unrated items by a fitted model, with names."""
    r, training, _ = _als_inputs(spark, sf)
    model = recommend.fit(training, rank=8, reg=0.1, max_iter=10)
    return topn.recommend_for_all(model, r, _items(spark, sf), TOP_N)


def q_als_all_users(spark, sf):
    """Per user: how many items were listed, whether all are unrated, and whether they are in order."""
    top = pinned(als_all_users_top(spark, sf))
    mine = _ratings(spark, sf).select("user_id", "item_id").distinct().withColumn("rated", F.lit(True))
    before = F.lag("prediction").over(Window.partitionBy("user_id").orderBy("rank"))
    listed = top.withColumn("falls", F.coalesce(F.col("prediction") <= before, F.lit(True))).join(mine, ["user_id", "item_id"], "left")
    return listed.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_listed"), F.bool_and(F.col("rated").isNull()).alias("unrated"),
                                         F.bool_and("falls").alias("ordered"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}

# What the solver returns, registered beside the queries that check it: no SQL gives these numbers.
SOLVER_QUERIES: dict[str, Query] = {"als_predictions": als_predictions, "als_top_items": als_top_items,
                                    "als_all_users_top": als_all_users_top, "als_grid_errors": als_grid_errors}
