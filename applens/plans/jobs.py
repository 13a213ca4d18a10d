"""Batch and streaming jobs, one per workflow of the original job set.

Run as ``python -m applens.plans.jobs <job> [args]``.  Every job reads its
inputs from paths/options given by the caller, composes the operators of
``applens.operators`` and writes through Spark's writers; nothing is collected
to the driver except small summaries that are printed.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.operators import arrivals as arr
from applens.operators import clicks
from applens.operators import kv as kvops
from applens.operators import lookup, models, ratings as rt, recommend, topn
from applens.operators.ids import dense_index
from applens.session import build_session, kept
from applens.sinks.text import write_routed, write_single_file
from applens.sources import jdbc, text as txt
from applens.sources.tables import read_table, spread


def count_lines(spark: SparkSession, path: str) -> int:
    return txt.read_lines(spark, path).count()


def jdbc_preview(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                 partitions: int, props: dict, n: int = 10) -> DataFrame:
    t = jdbc.read_range_partitioned(spark, url, table, column, lower, upper, partitions, props)
    return t.orderBy(column).limit(n)


def als_demo(spark: SparkSession, ratings_path: str, model_path: str, rank: int = 10,
             iters: int = 10, reg: float = 0.01, blocks: int | None = None) -> float | None:
    """Train on comma ratings, score the training pairs, save and reload."""
    r = txt.read_ratings(spark, ratings_path, sep=",", fields=3, strict_width=True)
    model = recommend.fit(r, rank=rank, max_iter=iters, reg=reg, blocks=blocks)
    mse = rt.mse(model.transform(r).where(~F.isnan("prediction"))).first()["mse"]
    model.write().overwrite().save(model_path)
    recommend.ALSModel.load(model_path)
    return mse


def _improvement(base: float | None, score: float | None) -> str | None:
    return None if not base or score is None else "%1.2f" % ((base - score) / base * 100)


def _constant_rmse(fit: DataFrame, test: DataFrame) -> float | None:
    """RMSE on ``test`` of always predicting the mean rating of ``fit``."""
    mean = fit.agg(F.avg("rating")).first()[0]
    return test.agg(F.sqrt(F.avg((F.col("rating") - F.lit(mean)) ** 2))).first()[0]


def movielens(spark: SparkSession, home: str, user_id: int = 0, out: str | None = None,
              model_path: str | None = None, parallelism: int = 1, blocks: int | None = None,
              all_users_out: str | None = None) -> dict:
    """Three-way split, grid search, test RMSE, baseline and top-50 for one user, and for every user under
    ``all_users_out``; the best model is saved under ``model_path``."""
    ratings = txt.read_ratings(spark, f"{home.rstrip('/')}/ratings.dat")
    mine = txt.read_ratings(spark, f"{home.rstrip('/')}/personalRatings.txt", fields=3)
    mine = rt.personal(mine, user_id)
    items = txt.parse_items(txt.read_ordered_lines(spark, f"{home.rstrip('/')}/movies.dat"), pos_col="pos")
    profile = rt.rating_profile(ratings).first().asDict()
    with recommend.held(ratings, blocks) as kept:
        training, validation, test = rt.split_three_way(kept)
        training = rt.union_training(training, mine)
        best = recommend.grid_search(training, validation.select("user_id", "item_id", "rating"),
                                     recommend.GRID_THREE_WAY, all_rows_denominator=True,
                                     parallelism=parallelism, blocks=blocks, cache=False)
        if model_path:
            best.model.write().overwrite().save(model_path)
        test_rmse = recommend.rmse_over_all(best.model, test)
        base = _constant_rmse(training.select("rating").unionByName(validation.select("rating")), test)
        if all_users_out:
            rated = kept.select("user_id", "item_id").unionByName(mine.select("user_id", "item_id"))
            topn.recommend_for_all(best.model, rated, items, 50).write.mode("overwrite").parquet(all_users_out)
    cands = recommend.unrated_candidates(items, mine, user_id)
    top = recommend.top_n(recommend.score_for_user(best.model, user_id, cands), items, 50)
    if out:
        top.write.mode("overwrite").json(out)
    return {**profile, "best": (best.rank, best.reg, best.iters), "validation_rmse": best.rmse,
            "test_rmse": test_rmse, "baseline_rmse": base, "improvement": _improvement(base, test_rmse)}


def als_evaluation(spark: SparkSession, source: str, year: str, month: str, day: str,
                   model_path: str | None = None, parallelism: int = 1, blocks: int | None = None) -> dict:
    """Two-way split of one day of a partitioned rating table (a path or a catalogue name), grid search,
    baseline comparison.  Device/app strings get dense integer ids.

    With ``model_path`` the best model goes to ``<model_path>/model`` and the maps
    from ids to strings to ``<model_path>/users`` and ``<model_path>/items``; :func:`load_recommender` reads them back.
    """
    raw = rt.read_rating_day(spark, source, year, month, day)
    users = dense_index(raw, "user", "user_id")
    apps = dense_index(raw, "app", "item_id")
    r = (raw.join(users, "user").join(apps, "app")
         .select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating",
                 (F.col("lasttimestamp") % 10).alias("bucket")))
    with recommend.held(r, blocks) as kept:
        training, validation = rt.split_two_way(kept)
        best = recommend.grid_search(training, validation, recommend.GRID_TWO_WAY, parallelism=parallelism, blocks=blocks, cache=False)
        base = _constant_rmse(training.select("rating").unionByName(validation.select("rating")), validation)
    if model_path:
        best.model.write().overwrite().save(f"{model_path}/model")
        users.write.mode("overwrite").parquet(f"{model_path}/users")
        apps.write.mode("overwrite").parquet(f"{model_path}/items")
    return {"best": (best.rank, best.reg, best.iters), "validation_rmse": best.rmse,
            "baseline_rmse": base, "improvement": _improvement(base, best.rmse)}


def load_recommender(spark: SparkSession, model_path: str):
    """(model, users, items) as :func:`als_evaluation` saved them."""
    return (recommend.ALSModel.load(f"{model_path}/model"), spark.read.parquet(f"{model_path}/users"),
            spark.read.parquet(f"{model_path}/items"))


def kv_prefix_lookup(spark: SparkSession, ids_path: str, kv_source: str, out: str,
                     single_file: bool = False) -> None:
    """First key-value row per id prefix, written as ``key|list|date`` text.

    ``single_file=True`` funnels the result through one task (only for id
    lists known to be small); by default every task writes its own part."""
    ids_ = txt.read_lines(spark, ids_path).select(F.col("value").alias("id"))
    table = kvops.project(read_table(spark, kv_source), ["packagelist", "cdate"])
    hit = lookup.prefix_first_match(ids_, table, value_cols=["packagelist", "cdate"])
    lines = hit.select(F.concat_ws("|", "rowkey", F.coalesce("packagelist", F.lit("null")),
                                   F.coalesce("cdate", F.lit("null"))).alias("line"))
    if single_file:
        write_single_file(lines, out)
    else:
        lines.write.mode("overwrite").text(out)


def kv_export(spark: SparkSession, kv_source: str, date_arg: str, out_root: str,
              regex: bool = True, zone: str = "UTC", rejects: str | None = None) -> None:
    """Reports of one date -> 23-field lines appended under their day in ``zone``; unreadable ones go to ``rejects``.

    A table that ``kv.write_kv_table`` stored is scanned for that date alone.
    """
    kv = kvops.rowkey_date_filter(read_table(spark, kv_source), date_arg, regex=regex)
    write_routed(kvops.report_lines(kv, zone), out_root)
    if rejects:      # decided on two fields; no list is parsed for it
        kvops.rejected_reports(kv, zone).write.mode("append").parquet(rejects)


def extract_app_detail(spark: SparkSession, arrivals_source: str, yyyymm: str, out: str,
                       replace_whole_month: bool = False) -> None:
    """Explode one month of nested reports into the daily app-detail table; either may be a path or a catalogue table."""
    detail = arr.explode_app_detail(arr.read_arrivals(spark, arrivals_source), yyyymm)
    arr.write_app_detail(spark, detail, out, replace_whole_month=yyyymm if replace_whole_month else None)


def click_batch(spark: SparkSession, path: str, out_root: str, zone: str = "UTC", rejects: str | None = None) -> None:
    """Click log files -> date-routed lines; unreadable reports go to ``rejects`` with their reason."""
    lines = spread(txt.read_lines(spark, path))
    if not rejects:
        write_routed(clicks.click_lines(clicks.parse_click_lines(lines, zone=zone)), out_root)
        return
    parsed = clicks.parse_click_lines(lines.withColumn("raw", F.col("value")), keep=["raw"], zone=zone)
    raw = F.when(~F.col("ok"), F.col("raw")).alias("raw")
    with kept(parsed.select(raw, "ip", "server_ms", "route", "line", "ok", "reject")) as once:
        write_routed(clicks.click_lines(once), out_root)
        clicks.click_rejects(once, ["raw"]).write.mode("append").parquet(rejects)


def new_phone_models(spark: SparkSession, log_path: str, known: DataFrame, out: str,
                     rejects: str | None = None, zone: str = "UTC") -> None:
    """Clean (model, brand) pairs from report logs that the catalogue lacks."""
    parsed = models.parse_reports(spread(txt.read_lines(spark, log_path)), zone=zone)
    if not rejects:
        models.new_models(models.distinct_models(parsed), known).write.mode("append").parquet(out)
        return
    line = F.when(F.col("reject").isNotNull(), F.col("value")).alias("value")
    with kept(parsed.select(line, "model", "brand", "reject")) as once:
        models.new_models(models.distinct_models(once), known).write.mode("append").parquet(out)
        models.rejected(once).select("value", "reject").write.mode("append").parquet(rejects)


def _props(pairs: list[str]) -> dict:
    return dict(p.split("=", 1) for p in pairs)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="applens")
    ap.add_argument("--shuffle-partitions", type=int, default=None, help="initial shuffle width")
    ap.add_argument("--shuffle-bytes", type=int, default=None,
                    help="bytes the job will shuffle, from which a width is derived (else the default in applens.session)")
    sub = ap.add_subparsers(dest="job", required=True)

    def job(name: str, *positional: str, **options) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for x in positional:
            p.add_argument(x)
        for x, kw in options.items():
            p.add_argument("--" + x.replace("_", "-"), **kw)
        return p

    number, zone, text = {"type": int}, {"default": "UTC"}, {}
    als = {"model_path": text, "parallelism": {"type": int, "default": 1}, "blocks": number}
    jdbc_options = {"prop": {"action": "append", "default": [], "metavar": "NAME=VALUE"}}
    job("count-lines", "path")
    job("jdbc-preview", "url", "table", "column", **jdbc_options, lower={"type": int, "required": True},
        upper={"type": int, "required": True}, partitions={"type": int, "default": 20}, rows={"type": int, "default": 10})
    job("als-demo", "ratings_path", "model_path", blocks=number)
    job("movielens", "home", out=text, all_users_out=text, user={"type": int, "default": 0}, **als)
    job("als-evaluation", "source", "year", "month", "day", **als)
    job("kv-export", "kv_source", "date", "out_root", zone=zone, rejects=text, literal={"action": "store_true"})
    job("kv-prefix-lookup", "ids_path", "kv_source", "out", single_file={"action": "store_true"})
    job("extract-app", "arrivals_source", "yyyymm", "out", replace_whole_month={"action": "store_true"})
    job("new-phone-models", "log_path", "out", known={"help": "(model, brand) pairs: a path or a catalogue table"},
        url={"help": "or a database with the two catalogue tables"}, models_table=text, makers_table=text,
        **jdbc_options, rejects=text, zone=zone)
    job("click-batch", "path", "out_root", zone=zone, rejects=text)
    job("click-stream", "source", "out_root", "checkpoint", kafka_bootstrap=text, topic=text, zone=zone,
        rejects={"help": "folder for unreadable lines; needs --rejects-checkpoint"}, rejects_checkpoint=text)
    return ap


def main(argv: list[str] | None = None) -> None:
    ap = parser()
    a = ap.parse_args(argv)
    if a.job == "click-stream" and a.kafka_bootstrap and not a.topic:
        ap.error("--kafka-bootstrap needs --topic")
    if a.job == "click-stream" and bool(a.rejects) != bool(a.rejects_checkpoint):
        ap.error("--rejects and --rejects-checkpoint go together")
    if a.job == "new-phone-models" and not (a.known or a.url and a.models_table and a.makers_table):
        ap.error("give --known, or --url with --models-table and --makers-table")
    spark = build_session(app_name=f"applens-{a.job}", shuffle_partitions=a.shuffle_partitions, shuffle_bytes=a.shuffle_bytes)
    if a.job == "count-lines":
        print(f"{a.path}: {count_lines(spark, a.path)} lines")
    elif a.job == "jdbc-preview":
        jdbc_preview(spark, a.url, a.table, a.column, a.lower, a.upper, a.partitions, _props(a.prop), a.rows).show(a.rows)
    elif a.job == "als-demo":
        print(json.dumps({"mse": als_demo(spark, a.ratings_path, a.model_path, blocks=a.blocks)}))
    elif a.job == "movielens":
        print(json.dumps(movielens(spark, a.home, a.user, a.out, a.model_path, a.parallelism, a.blocks,
                                   a.all_users_out)))
    elif a.job == "als-evaluation":
        print(json.dumps(als_evaluation(spark, a.source, a.year, a.month, a.day, a.model_path, a.parallelism, a.blocks)))
    elif a.job == "kv-export":
        kv_export(spark, a.kv_source, a.date, a.out_root, not a.literal, a.zone, a.rejects)
    elif a.job == "kv-prefix-lookup":
        kv_prefix_lookup(spark, a.ids_path, a.kv_source, a.out, a.single_file)
    elif a.job == "extract-app":
        extract_app_detail(spark, a.arrivals_source, a.yyyymm, a.out, a.replace_whole_month)
    elif a.job == "new-phone-models":
        known = (read_table(spark, a.known) if a.known
                 else jdbc.read_known_models(spark, a.url, a.models_table, a.makers_table, props=_props(a.prop)))
        new_phone_models(spark, a.log_path, known, a.out, a.rejects, a.zone)
    elif a.job == "click-batch":
        click_batch(spark, a.path, a.out_root, a.zone, a.rejects)
    elif a.job == "click-stream":
        from applens.streaming.clicks_stream import read_click_source, start_click_etl, start_click_rejects
        if a.kafka_bootstrap:
            src = read_click_source(spark, "kafka", options={
                "kafka.bootstrap.servers": a.kafka_bootstrap, "subscribe": a.topic})
        else:
            src = read_click_source(spark, "text", a.source)
        start_click_etl(src, a.out_root, a.checkpoint, zone=a.zone)
        if a.rejects:
            start_click_rejects(src, a.rejects, a.rejects_checkpoint)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
