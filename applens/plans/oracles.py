"""DuckDB SQL for each deterministic query in ``queries.py``.

Derived inputs come from the same expression lists as the Spark side
(``applens.sources.derived`` rendered in the DuckDB dialect); the work on top
of them is written independently in plain SQL.  Of the ALS queries only what
does not depend on the solver is returned and checked.
"""

from __future__ import annotations

from applens.operators.kv import KV_FIELDS
from applens.operators.recommend import GRID_THREE_WAY, GRID_TWO_WAY
from applens.plans import queries as Q
from applens.sources import derived as dv
from applens.sources.derived import DUCK as D

RAW_EVENT_COLS = [("event_id", "event_id"), ("event_type", "event_type"),
                  ("user_id", "user_id"), ("props", "props"), ("ts", "ts"), ("k_", "k_")]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


R = dv.cte(D, "ratings", dv.ratings_exprs(D), dv.events_source(D))
KV = dv.cte(D, "kv", dv.kv_exprs(D) + [(f"ev_{a}", b) for a, b in RAW_EVENT_COLS], dv.events_source(D))
MODEL = "model AS (SELECT item_id, avg(rating) AS prediction FROM ratings WHERE ts % 10 < 6 GROUP BY item_id)"
VAL = "val AS (SELECT * FROM ratings WHERE ts % 10 >= 6 AND ts % 10 < 8)"
PRE = dv.cte(D, "pre", dv.preinstall_expected(D) + [("ts", "ts")], dv.events_source(D))
CIDS = dv.cte(D, "ids", dv.customer_ids_exprs(D), "customer")
PARENTS = dv.cte(D, "parents", dv.arrival_parent_exprs(D), "orders")
APPS = dv.cte(D, "apps", dv.arrival_app_exprs(D), "lineitem")
IDLIST = dv.cte(D, "idlist", dv.id_list_exprs(D), "customer")
FIRST_ID = "coalesce(nullif(firstimei, ' '), nullif(secondimei, ' '), nullif(thirdimei, ' '))"


def _blank(x: str) -> str:
    return f"CASE WHEN coalesce(regexp_matches({x}, '[^\\s]'), false) THEN {x} ELSE ' ' END"


def _kv_for_apps() -> str:
    # kv_expected_apps() refers to event columns; expose them under their names
    cols = ", ".join(f"ev_{a} AS {a}" for a, _ in RAW_EVENT_COLS)
    return f"kva AS (SELECT kv.*, {cols} FROM kv)"


def _kv_line() -> str:
    fields = []
    for f in KV_FIELDS:
        src = f"({dv.kv_expected_apps(D)})" if f == "appList" else f
        fields.append(_blank(src))
    route = "strftime(make_timestamp(CAST(acceptTimestamp AS BIGINT) * 1000), '%Y/%m/%d/')"
    return (f"lines AS (SELECT rowkey, {route} AS route, concat_ws('|', {', '.join(fields)}) AS line "
            f"FROM kva WHERE appList IS NOT NULL AND acceptTimestamp != 'n/a')")


def _click_cte() -> str:
    p = dv.click_body_parts(D)
    exprs = [("event_id", "event_id"), ("ts", "ts"), ("ip", p["ip"]), ("n_apps", p["n_apps"]),
             ("truncated", p["truncated"]), ("corrupt", p["corrupt"]),
             ("pkg0", dv._app(D, 0)), ("pkg1", dv._app(D, 1)), ("pkg2", dv._app(D, 2)),
             ("line", dv.click_expected_line(D))]
    return dv.cte(D, "click", exprs, dv.events_source(D))


def _body_cte() -> str:
    exprs = [(a, b) for a, b in dv.click_report_exprs(D)]
    return dv.cte(D, "reports", exprs, dv.events_source(D))


_TOP = f"""{_with(R, MODEL)}, cands AS (
  SELECT DISTINCT CAST(p_partkey AS INT) AS item_id FROM part p
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = {Q.PERSONAL_USER} AND r.item_id = p.p_partkey)),
scored AS (SELECT c.item_id, round(m.prediction, 6) AS prediction FROM cands c JOIN model m USING (item_id)),
top AS (SELECT * FROM scored ORDER BY prediction DESC, item_id ASC LIMIT {Q.TOP_N}),
ranked AS (SELECT CAST(row_number() OVER (ORDER BY prediction DESC, item_id ASC) AS INT) AS rank,
           t.item_id, p.p_name AS name, t.prediction
           FROM top t LEFT JOIN part p ON p.p_partkey = t.item_id)
SELECT rank, item_id, name, prediction, printf('%2d: %s', rank, name) AS listing FROM ranked"""

_MEAN_BASELINE = f"""{_with(R, MODEL)}, stats AS (
  SELECT (SELECT avg(rating) FROM ratings WHERE ts % 10 < 8) AS mean_rating),
test AS (SELECT r.rating, m.prediction FROM ratings r LEFT JOIN model m USING (item_id) WHERE r.ts % 10 >= 8),
agg AS (
  SELECT s.mean_rating,
         sqrt(avg((s.mean_rating - t.rating) * (s.mean_rating - t.rating))) AS baseline_rmse,
         sqrt(coalesce(sum(CASE WHEN t.prediction IS NOT NULL
                                THEN (t.rating - t.prediction) * (t.rating - t.prediction) END), 0)
              / count(*)) AS model_rmse,
         count(*) AS n_test
  FROM test t, stats s GROUP BY s.mean_rating)
SELECT round(mean_rating, 6) AS mean_rating, round(baseline_rmse, 6) AS baseline_rmse,
       round(model_rmse, 6) AS model_rmse,
       round((baseline_rmse - model_rmse) / baseline_rmse * 100, 2) AS improvement_pct, n_test
FROM agg"""

_PRE_OK = "NOT bad_time AND NOT bad_escape"
_NOISE = "(model = '' OR brand = '' OR regexp_matches(model || brand, 'ADB|DAEMON|ERROR|WARNING|CANNOT'))"
_KNOWN = """known AS (
  SELECT DISTINCT upper(pm.phonemodelcode) AS model, upper(mf.manufacturername) AS brand
  FROM (SELECT p_type AS phonemodelcode, p_size AS manufacturerid FROM part) pm
  LEFT JOIN (SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) AS manufacturerid, p_brand AS manufacturername
             FROM part) mf USING (manufacturerid))"""
_DISTINCT_MODELS = f"dm AS (SELECT DISTINCT model, brand FROM pre WHERE {_PRE_OK} AND NOT {_NOISE})"

_ORACLES: dict[str, str] = {
    "line_count": """SELECT count(*) AS n_docs,
        CAST(sum(CASE WHEN length(text) = 0 THEN 0 ELSE
            len(string_split_regex(regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n')) END) AS BIGINT)
        AS n_lines FROM documents""",
    "parse_ratings_delim": _with(R) + "SELECT user_id, item_id, rating, ts, ts % 10 AS bucket FROM ratings",
    "personal_ratings": _with(dv.cte(D, "mine", dv.personal_exprs(D), dv.events_source(D)))
        + f"SELECT user_id, item_id, rating FROM mine WHERE user_id = {Q.PERSONAL_USER} AND rating > 0",
    "rating_profile": _with(R) + """SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users,
        count(DISTINCT item_id) AS n_items FROM ratings""",
    "split_three_way": _with(R) + """SELECT user_id, item_id, rating, ts,
        CASE WHEN ts % 10 < 6 THEN 'training' WHEN ts % 10 < 8 THEN 'validation' ELSE 'test' END AS split
        FROM ratings""",
    "split_two_way": _with(R) + """SELECT user_id, item_id, rating, ts,
        CASE WHEN ts % 10 < 8 THEN 'training' ELSE 'validation' END AS split FROM ratings""",
    "split_counts": _with(R) + """SELECT count(*) AS n_ratings,
        count(*) FILTER (WHERE ts % 10 < 6) AS n_training,
        count(*) FILTER (WHERE ts % 10 >= 6 AND ts % 10 < 8) AS n_validation,
        count(*) FILTER (WHERE ts % 10 >= 8) AS n_test,
        count(*) FILTER (WHERE ts % 10 < 8) AS n_training_80,
        count(*) FILTER (WHERE ts % 10 >= 8) AS n_validation_20 FROM ratings""",
    "union_training": _with(R) + f"""SELECT user_id, item_id, rating FROM ratings WHERE ts % 10 < 6
        UNION ALL SELECT user_id, item_id, rating FROM ratings
        WHERE user_id = {Q.PERSONAL_USER} AND rating > 0""",
    "actual_vs_predicted": _with(R, MODEL, VAL) + """SELECT v.user_id, v.item_id, v.rating, v.ts,
        round(m.prediction, 6) AS prediction FROM val v JOIN model m USING (item_id)""",
    "mse": _with(R, MODEL, VAL) + """SELECT round(avg((v.rating - m.prediction) * (v.rating - m.prediction)), 6) AS mse,
        count(*) AS n_pairs FROM val v JOIN model m USING (item_id)""",
    "rmse_all_rows": _with(R, MODEL, VAL) + """SELECT round(sqrt(coalesce(sum(
            CASE WHEN m.prediction IS NOT NULL THEN (v.rating - m.prediction) * (v.rating - m.prediction) END), 0)
            / count(*)), 6) AS rmse,
        count(m.prediction) AS n_predicted, count(*) AS n_rows FROM val v LEFT JOIN model m USING (item_id)""",
    "rmse_predicted_rows": _with(R, MODEL, VAL) + """SELECT
        round(sqrt(avg((v.rating - m.prediction) * (v.rating - m.prediction))), 6) AS rmse,
        count(*) AS n_predicted FROM val v JOIN model m USING (item_id)""",
    "prediction_guard": _with(R, MODEL, VAL) + """SELECT v.user_id, v.item_id, v.rating,
        round(m.prediction, 6) AS prediction FROM val v JOIN model m USING (item_id) WHERE m.prediction < 1000""",
    "mean_baseline": _MEAN_BASELINE,
    "partition_scan": f"""SELECT CAST(user_id AS VARCHAR) AS "user",
        'com.app' || json_extract_string(props, '$.k') AS app, value AS rating, (epoch_us(ts) // 1000) AS lasttimestamp
        FROM events WHERE strftime(ts, '%Y') = '{Q.SCAN_DAY[0]}' AND strftime(ts, '%m') = '{Q.SCAN_DAY[1]}'
        AND strftime(ts, '%d') = '{Q.SCAN_DAY[2]}'""",
    "first_nonblank_id": _with(CIDS) + f"SELECT c_custkey, {FIRST_ID} AS imei FROM ids",
    "app_detail_explode": _with(PARENTS, APPS) + f"""SELECT {FIRST_ID} AS imei, a.appname, a.pkg, a.signcrc32,
        p.arrivetimes, p.year, p.month, p.day FROM parents p JOIN apps a ON a.l_orderkey = p.o_orderkey""",
    "month_days": """WITH months AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS yyyymm FROM orders),
        starts AS (SELECT yyyymm, CAST(strptime(yyyymm || '01', '%Y%m%d') AS DATE) AS s FROM months),
        days AS (SELECT yyyymm, s, unnest(generate_series(s, s + INTERVAL 1 MONTH - INTERVAL 1 DAY,
                                                          INTERVAL 1 DAY)) AS d FROM starts)
        SELECT yyyymm, strftime(s + INTERVAL 1 MONTH, '%Y%m') AS next_month, strftime(d, '%Y') AS year,
               strftime(d, '%m') AS month, strftime(d, '%d') AS day FROM days""",
    "monthly_partition_overwrite": _with(PARENTS, APPS) + """SELECT p.year, p.month, p.day, count(*) AS n_rows
        FROM parents p JOIN apps a ON a.l_orderkey = p.o_orderkey
        WHERE NOT (p.year = '""" + Q.OVERWRITE_MONTH[:4] + """' AND p.month = '""" + Q.OVERWRITE_MONTH[4:] + """'
                   AND CAST(p.day AS INTEGER) % 3 = 0) GROUP BY p.year, p.month, p.day""",
    "query_string_map": _with(PRE) + f"""SELECT event_id, posttime, model, brand, ver,
        CAST(3 AS INTEGER) AS n_params FROM pre WHERE {_PRE_OK}""",
    "noise_filter": _with(PRE) + f"SELECT event_id, model, brand FROM pre WHERE {_PRE_OK} AND NOT {_NOISE}",
    "distinct_models": _with(PRE, _DISTINCT_MODELS) + "SELECT model, brand FROM dm",
    "known_models": _with(_KNOWN) + "SELECT model, brand FROM known",
    "new_models": _with(PRE, _DISTINCT_MODELS, _KNOWN) + """SELECT d.model, d.brand FROM dm d
        WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.model = d.model AND k.brand = d.brand)""",
    "malformed_rows": _with(PRE, _click_cte(), KV) + """SELECT 'phone' AS kind, CAST(event_id AS VARCHAR) AS id,
        CASE WHEN bad_escape THEN 'bad_escape' ELSE 'bad_time' END AS reject FROM pre WHERE bad_escape OR bad_time
        UNION ALL SELECT 'click', CAST(event_id AS VARCHAR), CASE WHEN corrupt THEN 'bad_body' ELSE 'bad_app' END
        FROM click WHERE corrupt OR truncated
        UNION ALL SELECT 'kv', rowkey, CASE WHEN appList IS NULL THEN 'no_app_list' ELSE 'bad_time' END
        FROM kv WHERE appList IS NULL OR acceptTimestamp = 'n/a'""",
    "gbk_url_decode": _with(dv.cte(D, "t", dv.gbk_text_exprs(D, True), f"customer, (SELECT '{dv.gbk_characters()}' AS chars)")) + "SELECT * FROM t",
    "strict_ratings": _with(dv.cte(D, "t", dv.comma_rating_exprs(D) + [("rating", "value")], dv.events_source(D))) + """SELECT width,
        count(*) AS n_lines, count(*) FILTER (WHERE width <> 3) AS n_abort, CASE WHEN width = 3 THEN count(*) END AS n_strict,
        CASE WHEN width = 3 THEN round(sum(rating), 6) END AS rating_total FROM t GROUP BY width""",
    "kv_scan_rowkey_regex": _with(KV) + f"""SELECT rowkey, processType FROM kv
        WHERE regexp_matches(rowkey, '^.{{32}}{Q.KV_SCAN_DATE}.*$')""",
    "kv_project": _with(KV) + f"SELECT rowkey, {', '.join(KV_FIELDS)} FROM kv",
    "kv_text_format": _with(KV) + """SELECT rowkey,
        rowkey || '|' || coalesce(packagelist, 'null') || '|' || coalesce(cdate, 'null') AS line FROM kv""",
    "delimited_line": _with(KV, _kv_for_apps(), _kv_line()) + "SELECT rowkey, route, line FROM lines",
    "nonblank_filter": _with(dv.cte(D, "lines", dv.routed_exprs(D), dv.events_source(D))) + """
        SELECT route, count(*) AS n_lines FROM lines WHERE trim(route) <> '' AND trim(line) <> '' GROUP BY route""",
    "app_token_parse": _with(KV, _kv_for_apps()) + f"""SELECT rowkey, processType,
        {dv.kv_expected_apps(D)} AS apps FROM kva WHERE appList IS NOT NULL""",
    "crc_pad": _with(KV) + "SELECT rowkey, counterCrc32 AS crc, lpad(counterCrc32, 8, '0') AS padded FROM kv",
    "split_trailing": _with(KV) + """SELECT rowkey,
        CAST(len(string_split(regexp_replace(appList, ';+$', ''), ';')) AS INTEGER) AS n_tokens,
        CAST(len(string_split(appList, ';')) AS INTEGER) AS n_pieces FROM kv WHERE appList IS NOT NULL""",
    "prefix_first_match": _with(KV, IDLIST) + """, best AS (
        SELECT i.c_custkey, i.id, min(k.rowkey) AS rowkey,
               arg_min({'p': k.packagelist, 'c': k.cdate}, k.rowkey) AS v
        FROM idlist i JOIN kv k ON starts_with(k.rowkey, i.id)
        WHERE i.id <> '' GROUP BY i.c_custkey, i.id)
        SELECT c_custkey, id, rowkey, v.p AS packagelist, v.c AS cdate FROM best""",
    "date_route": _with(PRE) + f"""SELECT event_id, (epoch_us(ts) // 1000) AS server_ms, strftime(ts, '%Y/%m/%d/') AS route,
        strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
        FROM pre WHERE {_PRE_OK}""",
    "log_header": _with(_click_cte()) + """SELECT event_id, ip, (epoch_us(ts) // 1000) AS server_ms,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS server_time FROM click""",
    "payload_decode": _with(_body_cte()) + """SELECT event_id,
        CASE WHEN corrupt THEN '' ELSE body END AS body FROM reports""",
    "click_log_parse": _with(_click_cte()) + """SELECT event_id, strftime(ts, '%Y/%m/%d/') AS route, line
        FROM click WHERE NOT truncated AND NOT corrupt""",
    "clicks_per_app": _with(_click_cte()) + """, ok AS (SELECT * FROM click WHERE NOT truncated AND NOT corrupt)
        SELECT pkg, CAST(sum(n) AS BIGINT) AS clicks, count(*) AS reports FROM (
          SELECT pkg0 AS pkg, 1 AS n FROM ok
          UNION ALL SELECT pkg1, 2 FROM ok WHERE n_apps >= 2
          UNION ALL SELECT pkg2, 3 FROM ok WHERE n_apps >= 3) GROUP BY pkg""",
    "java_hash_id": """SELECT p_partkey, p_name,
        CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS name_hash FROM (
          SELECT p_partkey, p_name, list_reduce(
            list_transform(string_split(p_name, ''), lambda c: CAST(unicode(c) AS BIGINT)),
            lambda acc, x: (acc * 31 + x) % 4294967296, CAST(0 AS BIGINT)) AS h FROM part)""",
    "dense_id": """SELECT c_name, CAST(dense_rank() OVER (ORDER BY c_name) AS BIGINT) AS dense_id
        FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL)""",
    "item_name_lookup": _with(R) + """SELECT r.item_id, p.p_name AS name
        FROM (SELECT DISTINCT item_id FROM ratings) r JOIN part p ON p.p_partkey = r.item_id""",
    "unrated_candidates": _with(R) + f"""SELECT DISTINCT CAST(p_partkey AS INTEGER) AS item_id,
        CAST({Q.PERSONAL_USER} AS INTEGER) AS user_id FROM part p
        WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = {Q.PERSONAL_USER}
                          AND r.item_id = p.p_partkey)""",
    "top_n_items": _TOP,
    "preview_limit": _with(CIDS) + f"SELECT c_custkey AS id, {FIRST_ID} AS imei FROM ids ORDER BY id LIMIT 10",
    "packed_geo": _with(dv.cte(D, "geo", dv.geo_exprs(D), dv.events_source(D))) + """SELECT
        CAST(floor(lon) AS BIGINT) AS lon_cell, CAST(floor(lat) AS BIGINT) AS lat_cell, count(*) AS n FROM (
          SELECT CASE WHEN geo IS NULL OR geo = 0 THEN 0 ELSE lon_micro / 1000000.0 END AS lon,
                 CASE WHEN geo IS NULL OR geo = 0 THEN 0 ELSE lat_micro / 1000000.0 END AS lat FROM geo)
        GROUP BY ALL""",
    "deobfuscate_list": _with(KV) + "SELECT rowkey, appList AS text FROM kv WHERE appList IS NOT NULL",
}

_TRAINED = "trained AS (SELECT * FROM ratings WHERE ts % 10 < 8)"

_ORACLES |= {
    "als_predict": _with(R, _TRAINED) + """SELECT v.user_id, v.item_id, v.rating, true AS usable FROM ratings v
        WHERE v.ts % 10 >= 8 AND v.user_id IN (SELECT user_id FROM trained) AND v.item_id IN (SELECT item_id FROM trained)""",
    "als_top_n": _with(R, _TRAINED) + f""", scored AS (
        SELECT DISTINCT p_partkey FROM part WHERE p_partkey IN (SELECT item_id FROM trained)
          AND p_partkey NOT IN (SELECT item_id FROM ratings WHERE user_id = {Q.PERSONAL_USER})
          AND EXISTS (SELECT 1 FROM trained WHERE user_id = {Q.PERSONAL_USER}))
        SELECT CAST(r.range AS INTEGER) AS rank, n AS n_scored, true AS unrated, true AS ordered
        FROM (SELECT count(*) AS n FROM scored) s, range(1, {Q.TOP_N} + 1) r WHERE r.range <= n""",
}

_PRODUCT = " + ".join(f"u.f{j} * i.f{j}" for j in range(dv.FACTORS))
_UNRATED = "NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = {u} AND r.item_id = {i})"

_ORACLES |= {
    "all_users_top_n": _with(R, dv.cte(D, "u", dv.user_factor_exprs(D), "(SELECT DISTINCT user_id FROM events)"),
                             dv.cte(D, "i", dv.item_factor_exprs(D), "part")) + f"""SELECT * FROM (
        SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, item_id) AS INTEGER) AS rank, item_id, prediction
        FROM (SELECT u.user_id, i.item_id, {_PRODUCT} AS prediction FROM u CROSS JOIN i
              WHERE {_UNRATED.format(u='u.user_id', i='i.item_id')}) WHERE prediction < 1000) WHERE rank <= {Q.TOP_N}""",
    "als_all_users": _with(R, _TRAINED) + f""", u AS (SELECT DISTINCT user_id FROM trained),
        i AS (SELECT DISTINCT p_partkey AS item_id FROM part WHERE p_partkey IN (SELECT item_id FROM trained))
        SELECT CAST(user_id AS BIGINT) AS user_id, least(count(*), {Q.TOP_N}) AS n_listed, true AS unrated, true AS ordered
        FROM u CROSS JOIN i WHERE {_UNRATED.format(u='u.user_id', i='i.item_id')} GROUP BY user_id""",
}

_ROUTED = _with(_click_cte()) + "SELECT strftime(ts, '%Y/%m/%d/') AS route, line FROM click WHERE NOT truncated AND NOT corrupt"

_ORACLES |= {
    "stream_routed_lines": _ROUTED,
    "routed_appends": _ROUTED,
    "stream_rejects": _with(_click_cte()) + """SELECT CASE WHEN corrupt THEN 'bad_body' ELSE 'bad_app' END AS reject,
        count(*) AS n_lines FROM click WHERE truncated OR corrupt GROUP BY 1""",
}

def _settings(grid) -> str:
    """The settings of a grid in their order, as a table."""
    rows = [(k, r, i) for k in grid["rank"] for r in grid["reg"] for i in grid["iters"]]
    return "g AS (SELECT * FROM (VALUES " + ", ".join(
        f"(CAST({at} AS INTEGER), CAST({k} AS INTEGER), CAST({r} AS DOUBLE), CAST({i} AS INTEGER))"
        for at, (k, r, i) in enumerate(rows)) + ") AS g(place, rank, reg, iters))"


_FIRST_SPLIT = "learnt AS (SELECT * FROM ratings WHERE ts % 10 < 6)"

_ORACLES |= {
    "grid_three_way": _with(R, _FIRST_SPLIT, _settings(GRID_THREE_WAY)) + """, mean AS (SELECT avg(rating) AS m FROM learnt),
        model AS (SELECT place, item_id, m + sum(rating - m) / (count(*) + reg * rank) * (1 - power(0.5, iters)) AS prediction
                  FROM learnt, mean, g GROUP BY place, item_id, m, reg, rank, iters),
        error AS (SELECT place, ts % 10 >= 8 AS test, sqrt(sum((rating - prediction) * (rating - prediction)) / any_value(n)) AS rmse
                  FROM (SELECT *, count(*) OVER (PARTITION BY ts % 10 >= 8) AS n FROM ratings WHERE ts % 10 >= 6) r JOIN model USING (item_id)
                  GROUP BY ALL),
        best AS (SELECT place AS winner FROM error WHERE NOT test ORDER BY rmse, place LIMIT 1)
        SELECT g.*, round(v.rmse, 6) AS validation_rmse, place = winner AS best, CASE WHEN place = winner THEN round(t.rmse, 6) END AS test_rmse
        FROM g JOIN (SELECT place, rmse FROM error WHERE NOT test) v USING (place) JOIN (SELECT place, rmse FROM error WHERE test) t USING (place), best""",
    "als_grid_three_way": _with(R, _FIRST_SPLIT, _settings(GRID_THREE_WAY), VAL) + """, n AS (SELECT count(*) AS n_rows,
          count(*) FILTER (WHERE user_id IN (SELECT user_id FROM learnt) AND item_id IN (SELECT item_id FROM learnt)) AS n_scored FROM val)
        SELECT g.*, n_rows, n_scored, true AS error_matches, true AS winner_is_least, true AS winner_tested FROM g, n""",
    "als_grid": _with(R, _TRAINED, _settings(GRID_TWO_WAY)) + """, n AS (SELECT count(*) AS n_rows,
          count(*) FILTER (WHERE user_id IN (SELECT user_id FROM trained) AND item_id IN (SELECT item_id FROM trained)) AS n_scored
          FROM ratings WHERE ts % 10 >= 8)
        SELECT g.*, n_rows, n_scored, true AS scored, true AS error_matches, true AS winner_is_least FROM g, n""",
    "model_round_trip": _with(R, _TRAINED) + """SELECT count(*) AS n_rows, n_before, n_before AS n_after, true AS all_equal
        FROM (SELECT *, count(*) FILTER (WHERE user_id IN (SELECT user_id FROM trained) AND item_id IN (SELECT item_id FROM trained))
                OVER () AS n_before FROM ratings WHERE ts % 10 >= 8) GROUP BY n_before""",
}


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
