"""The same results in plain SQL over the driver's tables."""

from __future__ import annotations

LOG = """log AS (
SELECT session_id, idx, elapsed_time, level,
 CASE WHEN level<=4 THEN '0-4' WHEN level<=12 THEN '5-12' ELSE '13-22' END AS level_group,
 event_name,
 CASE k % 6 WHEN 0 THEN 'basic' WHEN 1 THEN 'undefined' WHEN 2 THEN 'close' WHEN 3 THEN 'open' WHEN 4 THEN 'prev' ELSE 'next' END AS name,
 CASE WHEN k % 7 < 3 THEN cast(k % 7 AS double) END AS page,
 CASE WHEN k % 11 <> 0 THEN value * 4 - 500 END AS room_coor_x,
 CASE WHEN k % 11 <> 0 THEN cast(k * 9 - 400 AS double) END AS room_coor_y,
 CASE WHEN k % 11 <> 0 THEN cast(floor(value / 50) * 50 AS double) END AS screen_coor_x,
 CASE WHEN k % 11 <> 0 THEN cast((k % 4) * 100 AS double) END AS screen_coor_y,
 CASE WHEN event_name = 'view' THEN value END AS hover_duration,
 CASE WHEN k % 5 <> 0 THEN concat('text ', CASE WHEN k % 2 = 0 THEN 'this is it' ELSE 'you can do that' END) END AS text,
 CASE WHEN k % 4 <> 0 THEN concat('fq', cast(k % 9 AS varchar)) END AS fqid,
 concat('room.', cast(k % 4 AS varchar)) AS room_fqid,
 CASE WHEN k % 3 <> 0 THEN concat('tx.', cast(k % 8 AS varchar)) END AS text_fqid
FROM (SELECT user_id AS session_id, event_id AS idx, event_type AS event_name, value, cast(props->>'k' AS int) AS k,
 date_sub('millisecond', t0, ts) AS elapsed_time, cast(ntile(23) OVER (PARTITION BY user_id ORDER BY event_id) AS int) - 1 AS level
 FROM (SELECT *, min(ts) OVER (PARTITION BY user_id) AS t0 FROM events) e) b)"""

DELTAS = (
    LOG
    + """,
d AS (
SELECT session_id, idx, elapsed_time, level, level_group, event_name, name, page, room_coor_x, room_coor_y,
 screen_coor_x, screen_coor_y, hover_duration, text, coalesce(fqid, 'fqid_None') AS fqid, room_fqid,
 coalesce(text_fqid, 'text_fqid_None') AS text_fqid,
 cast(least(greatest(coalesce(elapsed_time - lag(elapsed_time) OVER w, 0), 0), 1000000000) AS bigint) AS elapsed_time_diff,
 cast(least(greatest(coalesce(lead(elapsed_time) OVER w - elapsed_time, 0), 0), 1000000000) AS bigint) AS elapsed_time_diff_to,
 abs(screen_coor_x - lag(screen_coor_x) OVER w) AS location_x_diff,
 abs(screen_coor_y - lag(screen_coor_y) OVER w) AS location_y_diff
FROM log WINDOW w AS (PARTITION BY session_id, level_group ORDER BY idx))"""
)

ANSWERS = """answers AS (
SELECT session_id, q, concat(cast(session_id AS varchar), '_q', cast(q AS varchar)) AS label_id,
 CASE WHEN (session_id*7 + q*13) % 10 < 6 THEN 1 ELSE 0 END AS correct,
 cast((session_id*31 + q*17) % 1000 AS int) AS p1000,
 cast((session_id*31 + q*17) % 1000 AS double) / 1000.0 AS p
FROM (SELECT DISTINCT user_id AS session_id FROM events) s CROSS JOIN (SELECT cast(unnest(range(1, 19)) AS int) AS q) n)"""

NUMERIC = ("page", "room_coor_x", "room_coor_y", "screen_coor_x", "screen_coor_y", "hover_duration", "elapsed_time_diff")
CATEGORY = ("event_name", "name", "fqid", "room_fqid", "text_fqid")
WORDS = ("that", "this", "it", "you", "can", "is", "do")
FLAGS = (1000000, 5000000, 10000000, 50000000, 100000000, 200000000)
SHARES = (0.1, 0.2, 0.4, 0.6, 0.8, 0.9)
KEYS = "session_id, level_group"


def on_log(body: str) -> str:
    return f"WITH {DELTAS}\n{body}"


def more(ctes: str, body: str) -> str:
    return f"WITH {DELTAS},\n{ctes}\n{body}"


def mean(x, name):
    places = 4 if name.endswith(("et_mean", "elapsed_time_diff_mean")) else 7
    return f"round(avg(cast({x} AS double)), {places}) AS {name}"


def std(x, name):
    return f"round(stddev_samp(cast({x} AS double)), 2) AS {name}"


def quantile(x, share, name):
    values = f"list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL))"
    n = f"count({x})"
    return f"{values}[cast(floor(({n} - 1) * cast({share} AS double) + 0.5) AS bigint) + 1] AS {name}"


def by_value(column: str, source: str = "d") -> str:
    et, x = "elapsed_time_diff", "location_x_diff"
    skip = {"fqid": " AND fqid <> 'fqid_None'", "text_fqid": " AND text_fqid <> 'text_fqid_None'"}.get(column, "")
    return f"""SELECT {KEYS}, '{column}' AS dimension, cast({column} AS varchar) AS value, count(*) AS n,
 {mean(et, 'et_mean')}, {std(et, 'et_std')}, max({et}) AS et_max, min({et}) AS et_min, cast(sum({et}) AS bigint) AS et_sum,
 {mean(x, 'x_mean')}, {std(x, 'x_std')}, max({x}) AS x_max, min({x}) AS x_min
FROM {source} WHERE {column} IS NOT NULL{skip} GROUP BY session_id, level_group, value"""


def _pick(select: str, column: str) -> str:
    return on_log(f"SELECT {KEYS}, value, {select} FROM ({by_value(column)}) v")


WORD_ROWS = "words AS (SELECT d.*, w.word FROM d, (SELECT unnest([" + ", ".join(f"'{w}'" for w in WORDS) + "]) AS word) w WHERE contains(d.text, w.word))"

LEVEL_TIMES = """spans AS (SELECT session_id, level_group, level, max(elapsed_time) AS elapsed_time_max, min(elapsed_time) AS elapsed_time_min
 FROM d GROUP BY session_id, level_group, level),
times AS (SELECT *, elapsed_time_max - elapsed_time_min AS elapsed_time_total, next_min - elapsed_time_max AS level_diff
 FROM (SELECT *, lead(elapsed_time_min) OVER (PARTITION BY session_id, level_group ORDER BY level) AS next_min FROM spans) t)"""

LIMITS = """limits AS (SELECT session_id, level_group, max(start) + 20000000 AS max_threshold FROM
 (SELECT session_id, level_group, level, min(elapsed_time) AS start FROM d WHERE level IN (4, 12, 22) GROUP BY session_id, level_group, level) s
 GROUP BY session_id, level_group),
above AS (SELECT d.* FROM d JOIN limits USING (session_id, level_group) WHERE elapsed_time > max_threshold)"""

COMBOS = """cells AS (SELECT session_id, level_group, fqid, level, room_fqid, cast(sum(elapsed_time_diff) AS bigint) AS et_sum, count(*) AS n
 FROM d GROUP BY ALL),
tcells AS (SELECT session_id, level_group, text_fqid, level, cast(sum(elapsed_time_diff) AS bigint) AS et_sum, count(*) AS n
 FROM d GROUP BY ALL),
totals AS (SELECT level_group, count(DISTINCT session_id) AS sessions FROM d GROUP BY level_group),
flr0 AS (SELECT level_group, fqid, level, room_fqid, count(DISTINCT session_id) AS support FROM d GROUP BY ALL),
flr1 AS (SELECT flr0.* FROM flr0 JOIN totals USING (level_group) WHERE support >= floor(round(sessions * 0.1, 9))),
flr AS (SELECT * FROM flr1 WHERE (level_group, fqid) IN (SELECT level_group, fqid FROM flr1 GROUP BY level_group, fqid HAVING count(*) > 1)),
tl0 AS (SELECT level_group, text_fqid, level, count(DISTINCT session_id) AS support FROM d GROUP BY ALL),
tl1 AS (SELECT tl0.* FROM tl0 JOIN totals USING (level_group) WHERE support >= floor(round(sessions * 0.3, 9))),
tl AS (SELECT * FROM tl1 WHERE (level_group, text_fqid) IN (SELECT level_group, text_fqid FROM tl1 GROUP BY level_group, text_fqid HAVING count(*) > 1))"""

NAVIGATE = """nav AS (SELECT session_id, level_group, room_fqid, cast(floor(room_coor_x / 200) AS bigint) AS room_x,
 cast(floor(room_coor_y / 200) AS bigint) AS room_y FROM d WHERE event_name = 'click' AND fqid = 'fqid_None'),
popularity AS (SELECT *, CASE WHEN sessions <= 3 THEN 1 WHEN sessions <= 7 THEN 2 WHEN sessions <= 11 THEN 3 WHEN sessions >= 16 THEN 5 ELSE 4 END AS category
 FROM (SELECT level_group, room_fqid, room_x, room_y, count(DISTINCT session_id) AS sessions FROM nav GROUP BY ALL) c)"""

GRID = """grid AS (SELECT session_id, level_group, room_fqid, cast(floor(room_coor_x / 180) AS bigint) AS room_x,
 cast(floor(room_coor_y / 180) AS bigint) AS room_y, count(*) AS n FROM d
 WHERE event_name = 'click' AND fqid = 'fqid_None' AND room_coor_x IS NOT NULL AND room_coor_y IS NOT NULL
 AND ((level_group = '0-4' AND room_fqid IN ('room.0', 'room.1')) OR (level_group = '5-12' AND room_fqid IN ('room.0', 'room.1', 'room.2'))
  OR (level_group = '13-22' AND room_fqid IN ('room.0', 'room.3'))) GROUP BY ALL),
xs AS (SELECT *, row_number() OVER (PARTITION BY level_group, room_fqid ORDER BY room_x) - 1 AS px, count(*) OVER (PARTITION BY level_group, room_fqid) AS nx
 FROM (SELECT DISTINCT level_group, room_fqid, room_x FROM grid) a),
ys AS (SELECT *, row_number() OVER (PARTITION BY level_group, room_fqid ORDER BY room_y) - 1 AS py, count(*) OVER (PARTITION BY level_group, room_fqid) AS ny
 FROM (SELECT DISTINCT level_group, room_fqid, room_y FROM grid) a),
slots AS (SELECT grid.*, px * ny + py AS slot, nx * ny AS grid_size FROM grid JOIN xs USING (level_group, room_fqid, room_x) JOIN ys USING (level_group, room_fqid, room_y)),
clipped AS (SELECT session_id, level_group, room_fqid, room_x, room_y, least(n, 3) AS n FROM grid),
rooms AS (SELECT level_group, room_fqid, count(DISTINCT session_id) AS sessions FROM clipped GROUP BY ALL),
dense AS (SELECT s.session_id, s.level_group, s.room_fqid, c.room_x, c.room_y, coalesce(k.n, 0) AS n
 FROM (SELECT DISTINCT session_id, level_group, room_fqid FROM clipped) s
 JOIN (SELECT DISTINCT level_group, room_fqid, room_x, room_y FROM clipped) c USING (level_group, room_fqid)
 LEFT JOIN clipped k USING (session_id, level_group, room_fqid, room_x, room_y)),
scale AS (SELECT level_group, room_fqid, room_x, room_y, count(*) AS sessions, avg(cast(n AS double)) AS mean,
 CASE WHEN min(n) = max(n) THEN 1.0 ELSE stddev_pop(cast(n AS double)) END AS scale FROM dense GROUP BY ALL)"""

SWEEP = """marks AS (SELECT q, i, correct, CASE WHEN p1000 > 600 + i THEN 1 ELSE 0 END AS positive FROM answers, (SELECT unnest(range(0, 51)) AS i) t),
counts AS (SELECT q, i, sum(CASE WHEN correct = 1 AND positive = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN correct = 0 AND positive = 1 THEN 1 ELSE 0 END) AS fp,
 sum(CASE WHEN correct = 1 AND positive = 0 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN correct = 0 AND positive = 0 THEN 1 ELSE 0 END) AS tn FROM marks GROUP BY q, i),
total AS (SELECT i, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, sum(tn) AS tn FROM counts GROUP BY i),
sweep AS (SELECT *, {f1} AS macro_f1 FROM total)"""

F1 = """((CASE WHEN 2*tp+fp+fn > 0 THEN cast(2*tp AS double) / (2*tp+fp+fn) ELSE 0 END)
 + (CASE WHEN 2*tn+fp+fn > 0 THEN cast(2*tn AS double) / (2*tn+fp+fn) ELSE 0 END))
 / ((CASE WHEN 2*tp+fp+fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN 2*tn+fp+fn > 0 THEN 1 ELSE 0 END))"""
COUNTS = "cast(tp AS bigint) AS tp, cast(fp AS bigint) AS fp, cast(fn AS bigint) AS fn, cast(tn AS bigint) AS tn"
THRESHOLD = "(600 + i) / cast(1000 AS double) AS threshold"


def scored(body: str, answers: str = ANSWERS) -> str:
    return f"WITH {answers},\n{SWEEP.format(f1=F1)}\n{body}"


def _first() -> dict[str, str]:
    o = {}
    o["scan_event_log"] = f"WITH {LOG} SELECT * FROM log"
    o["filter_level_group"] = f"WITH {LOG} SELECT * FROM log WHERE level_group = '5-12'"
    o["distinct_sessions"] = "SELECT DISTINCT user_id AS session_id FROM events"
    o["fill_sentinels"] = f"""WITH {LOG} SELECT session_id, idx, coalesce(fqid, 'fqid_None') AS fqid,
 coalesce(text_fqid, 'text_fqid_None') AS text_fqid FROM log"""
    o["event_deltas"] = on_log("""SELECT session_id, level_group, idx, page, elapsed_time_diff, elapsed_time_diff_to,
 location_x_diff, location_y_diff, fqid, text_fqid FROM d""")
    o["gap_flags"] = on_log(
        "SELECT session_id, idx, "
        + ", ".join(f"CASE WHEN elapsed_time_diff >= {n} THEN 1 ELSE 0 END AS elapsed_time_over{n}" for n in FLAGS)
        + " FROM d"
    )
    o["gap_flag_sums"] = on_log(
        f"SELECT {KEYS}, "
        + ", ".join(f"cast(sum(CASE WHEN elapsed_time_diff >= {n} THEN 1 ELSE 0 END) AS bigint) AS elapsed_time_over{n}" for n in FLAGS)
        + f" FROM d GROUP BY {KEYS}"
    )
    o["cap_gap"] = on_log("""SELECT session_id, idx, CASE WHEN elapsed_time_diff >= 50000000 THEN cast(50000000 AS bigint)
 ELSE elapsed_time_diff END AS elapsed_time_diff FROM d""")
    o["grid_bins"] = f"""WITH {LOG} SELECT session_id, idx, cast(floor(room_coor_x / 200) AS bigint) AS room_x,
 cast(floor(room_coor_y / 200) AS bigint) AS room_y, cast(floor(room_coor_x / 180) AS bigint) AS grid_x,
 cast(floor(room_coor_y / 180) AS bigint) AS grid_y FROM log"""
    o["session_counts"] = on_log(f"SELECT {KEYS}, count(idx) AS session_number FROM d GROUP BY {KEYS}")
    o["session_distincts"] = on_log(
        f"SELECT {KEYS}, " + ", ".join(f"count(DISTINCT {c}) AS {c}_unique" for c in CATEGORY) + f" FROM d GROUP BY {KEYS}"
    )
    o["numeric_stats"] = on_log(
        f"SELECT {KEYS}, "
        + ", ".join(
            f"{mean(c, c + '_mean')}, {std(c, c + '_std')}, min({c}) AS {c}_min, max({c}) AS {c}_max" for c in NUMERIC
        )
        + f" FROM d GROUP BY {KEYS}"
    )
    o["numeric_quantiles"] = on_log(
        f"SELECT {KEYS}, "
        + ", ".join(quantile(c, s, f"{c}_quantile{round(s * 10)}") for c in NUMERIC for s in SHARES)
        + f" FROM d GROUP BY {KEYS}"
    )
    full = "n, et_std, et_mean, et_max, et_min, et_sum"
    o["by_event_name"] = _pick("n, et_mean, et_std, et_max, et_min", "event_name")
    o["by_event_name_move"] = _pick("x_mean, x_std, x_max, x_min", "event_name")
    o["by_name"] = _pick("n, et_mean, et_max, et_min, et_std", "name")
    o["by_room"] = _pick(full, "room_fqid")
    o["by_fqid"] = _pick(full, "fqid")
    o["by_text_fqid"] = _pick(full, "text_fqid")
    o["by_level"] = _pick("n, et_std, et_mean, et_sum", "level")
    o["by_level_group"] = _pick("n, et_std, et_mean, et_sum", "level_group")
    o["word_features"] = more(WORD_ROWS, f"SELECT {KEYS}, value, n, et_mean, et_std, et_max, et_sum FROM ({by_value('word', 'words')}) v")
    o["value_stats_one_pass"] = more(
        WORD_ROWS,
        " UNION ALL ".join(
            by_value(c) for c in ("event_name", "name", "room_fqid", "fqid", "text_fqid", "level", "level_group")
        )
        + " UNION ALL "
        + by_value("word", "words"),
    )
    for key, column, shares, skip in (
        ("by_event_name_quantiles", "event_name", SHARES, ""),
        ("by_text_quantiles", "text_fqid", (0.2, 0.7, 0.9), " WHERE text_fqid <> 'text_fqid_None'"),
        ("by_room_quantiles", "room_fqid", (0.2, 0.7, 0.9), ""),
    ):
        o[key] = on_log(
            f"SELECT {KEYS}, {column} AS value, "
            + ", ".join(quantile("elapsed_time_diff", s, f"elapsed_time_diff_quantile{round(s * 10)}") for s in shares)
            + f" FROM d{skip} GROUP BY {KEYS}, {column}"
        )
    return o


# --- levels, milestones, combinations, clicks ---------------------------------


def _second() -> dict[str, str]:
    o = {}
    o["level_times"] = more(LEVEL_TIMES, "SELECT * FROM times")
    parts = [f"max(elapsed_time_total) FILTER (WHERE level = {n}) AS elapsed_time_total_level_{n}" for n in range(23)]
    for n in range(23):
        if n not in (4, 12, 22):
            gap = f"max(level_diff) FILTER (WHERE level = {n})"
            parts.append(f"CASE WHEN {gap} < 0 THEN {gap} WHEN {gap} >= 0 THEN 0 END AS elapsed_time_level_diff_fixed_{n}")
    for low, high in ((0, 4), (5, 12), (13, 22)):
        parts.append(f'max(elapsed_time_max) FILTER (WHERE level BETWEEN {low} AND {high}) AS "elapsed_time_max{low}-{high}"')
    for low, high, name in ((0, 4, "0_3_min4"), (5, 12, "5-11_min12"), (13, 22, "13-21_min22")):
        late = f"(max(elapsed_time_max) FILTER (WHERE level BETWEEN {low} AND {high - 1}) - min(elapsed_time_min) FILTER (WHERE level = {high}))"
        parts.append(f'CASE WHEN {late} > 0 THEN {late} WHEN {late} <= 0 THEN 0 END AS "elapsed_time_diff_fixed_max{name}"')
    o["level_time_features"] = more(LEVEL_TIMES, f"SELECT {KEYS}, {', '.join(parts)} FROM times GROUP BY {KEYS}")
    o["session_thresholds"] = more(LIMITS, "SELECT * FROM limits")
    o["above_threshold_features"] = more(
        LIMITS,
        " UNION ALL ".join(
            f"""SELECT {KEYS}, '{c}' AS dimension, cast({c} AS varchar) AS value, count(*) AS n,
 cast(sum(elapsed_time_diff_to) AS bigint) AS diff_to_sum FROM above GROUP BY {KEYS}, {c}"""
            for c in ("room_fqid", "event_name", "level")
        ),
    )

    rules = (
        ("0-4", "both_texts", "both_texts", "text = 'text this is it' OR text = 'text you can do that'"),
        ("0-4", "click_fq1", "click_fq1", "(event_name = 'click' AND fqid = 'fq1') OR fqid = 'fq2'"),
        ("5-12", "fq3_fq4", "fq3_to_fq4", "fqid = 'fq3' OR fqid = 'fq4'"),
        ("13-22", "tx1_fq5", "tx1_fq5", "text_fqid = 'tx.1' OR fqid = 'fq5'"),
    )
    spans = []
    for group, name, index_name, rule in rules:
        for column, alias in (("elapsed_time", f"{name}_duration"), ("idx", f"{index_name}_indexCount")):
            span = f"max({column}) FILTER (WHERE {rule}) - min({column}) FILTER (WHERE {rule})"
            spans.append(f"CASE WHEN level_group = '{group}' THEN coalesce({span}, 0) END AS {alias}")
    o["milestone_features"] = on_log(f"SELECT {KEYS}, {', '.join(spans)} FROM d GROUP BY {KEYS}")
    steps = []
    for group, name, before, after in (
        ("0-4", "to_tx2", "fqid = 'fq1'", "text_fqid = 'tx.2'"),
        ("5-12", "found_tx5", "text_fqid = 'tx.4'", "text_fqid = 'tx.5'"),
    ):
        for column, suffix in (("elapsed_time", "et"), ("idx", "id")):
            step = f"min({column}) FILTER (WHERE {after}) - max({column}) FILTER (WHERE {before})"
            steps.append(f"CASE WHEN level_group = '{group}' THEN {step} END AS {name}_{suffix}")
    o["milestone_transitions"] = on_log(f"SELECT {KEYS}, {', '.join(steps)} FROM d GROUP BY {KEYS}")

    o["frequent_fqid_level_room"] = more(COMBOS, "SELECT * FROM flr")
    o["frequent_text_level"] = more(COMBOS, "SELECT * FROM tl")
    o["combo_features"] = more(
        COMBOS,
        """SELECT session_id, level_group, concat(fqid, '_', room_fqid, '_', cast(level AS varchar)) AS combo, et_sum, n
 FROM cells SEMI JOIN flr USING (level_group, fqid, level, room_fqid)
UNION ALL SELECT session_id, level_group, concat(text_fqid, '_', cast(level AS varchar)) AS combo, et_sum, n
 FROM tcells SEMI JOIN tl USING (level_group, text_fqid, level)""",
    )
    o["event_level_counts"] = on_log(
        f"SELECT {KEYS}, event_name, level, count(*) AS n FROM d WHERE event_name IN ('view', 'click', 'purchase') GROUP BY ALL"
    )
    o["event_name_pair_counts"] = on_log(
        f"SELECT {KEYS}, event_name, name, count(*) AS n FROM d WHERE event_name IN ('click', 'view') GROUP BY ALL"
    )
    o["repeat_clicks"] = on_log(f"""SELECT {KEYS}, max(clicks) AS click_same_max,
 nullif(count(*) FILTER (WHERE clicks >= 5), 0) AS click_same_over FROM
 (SELECT {KEYS}, screen_coor_x, screen_coor_y, count(*) AS clicks FROM d WHERE screen_coor_x IS NOT NULL GROUP BY ALL) p GROUP BY {KEYS}""")
    o["cell_popularity"] = more(NAVIGATE, "SELECT * FROM popularity")
    o["navigate_category_counts"] = more(
        NAVIGATE,
        """SELECT session_id, nav.level_group, nav.room_fqid, coalesce(category, 1) AS category, count(*) AS n
 FROM nav LEFT JOIN popularity p ON nav.level_group = p.level_group AND nav.room_fqid = p.room_fqid AND nav.room_x = p.room_x AND nav.room_y = p.room_y
 GROUP BY ALL""",
    )
    o["room_grid_counts"] = more(GRID, "SELECT * FROM slots")
    o["room_grid_clipped"] = more(GRID, "SELECT * FROM clipped")
    o["room_grid_axes"] = more(
        GRID,
        """SELECT level_group, room_fqid, 'room_x' AS axis, room_x AS bin, px AS position, nx AS length FROM xs
 UNION ALL SELECT level_group, room_fqid, 'room_y', room_y, py, ny FROM ys""",
    )
    o["one_hot_cells"] = more(
        GRID,
        """SELECT session_id, level_group, room_fqid, 'room_x' AS axis, room_x AS bin, cast(sum(n) AS bigint) AS n FROM grid GROUP BY ALL
 UNION ALL SELECT session_id, level_group, room_fqid, 'room_y', room_y, cast(sum(n) AS bigint) FROM grid GROUP BY ALL""",
    )
    o["room_grid_scale"] = more(
        GRID, "SELECT level_group, room_fqid, room_x, room_y, sessions, round(mean, 7) AS mean, round(scale, 7) AS scale FROM scale"
    )
    o["room_grid_scaled"] = more(
        GRID,
        """SELECT session_id, level_group, room_fqid, room_x, room_y, round((n - mean) / scale, 6) AS scaled
 FROM clipped JOIN scale USING (level_group, room_fqid, room_x, room_y)""",
    )
    o["room_grid_variance"] = more(
        GRID,
        """SELECT level_group, room_fqid, max(sessions) AS sessions, round(sum(v), 6) AS total_variance,
 cast(0 AS double) AS mean0, cast(0 AS double) AS mean1, cast(0 AS double) AS covariance
 FROM (SELECT level_group, room_fqid, room_x, room_y, count(*) AS sessions, var_samp(n / scale) AS v FROM dense
 JOIN (SELECT level_group, room_fqid, room_x, room_y, scale FROM scale) s USING (level_group, room_fqid, room_x, room_y) GROUP BY ALL) c
 GROUP BY level_group, room_fqid""",
    )
    return o


# --- cleaning, labels, evaluation ---------------------------------------------

SAMPLE = "sample AS (SELECT session_id FROM (SELECT DISTINCT user_id AS session_id FROM events) s ORDER BY md5(concat(cast(session_id AS varchar), ':42')), session_id LIMIT 10)"
FOLD = "('0x' || substr(md5(concat(cast(session_id AS varchar), ':42')), 1, 8))::bigint"
ORIGINALS = "originals AS (SELECT user_id AS session_id FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type = 'signup') >= 10)"
PART_ID = """parts AS (SELECT user_id AS session_id, cast(concat(cast(20 + user_id % 4 AS varchar), strftime(t0, '%m%d%H%M%S'),
 lpad(cast(user_id AS varchar), 5, '0')) AS bigint) AS stamp FROM (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id) f)"""


def _third() -> dict[str, str]:
    o = {}
    o["exclude_listed_sessions"] = f"WITH {LOG} SELECT session_id, idx FROM log WHERE session_id NOT IN (3, 5, 8)"
    o["exclude_sessions"] = f"""WITH {LOG} SELECT session_id, idx FROM log WHERE session_id NOT IN
 (SELECT session_id FROM log GROUP BY session_id HAVING count(room_coor_x) < 0.88 * count(*))"""
    o["exclude_short_sessions"] = f"""WITH {LOG} SELECT session_id, idx FROM log WHERE session_id IN
 (SELECT session_id FROM log WHERE level_group = '0-4' GROUP BY session_id HAVING count(*) >= 15)"""
    o["sample_sessions"] = f"WITH {LOG}, {SAMPLE} SELECT session_id, idx, event_name FROM log WHERE session_id IN (SELECT session_id FROM sample)"
    o["sample_labels"] = f"WITH {ANSWERS}, {SAMPLE} SELECT label_id, correct FROM answers WHERE session_id IN (SELECT session_id FROM sample)"
    o["scan_labels"] = f"WITH {ANSWERS} SELECT label_id AS session_id, correct FROM answers"
    o["split_label_ids"] = f"""WITH {ANSWERS} SELECT label_id AS session_id, correct, cast(split_part(label_id, '_', 1) AS bigint) AS session,
 cast(substr(split_part(label_id, '_', 2), 2) AS int) AS q FROM answers"""
    o["session_time_parts"] = f"""WITH {PART_ID} SELECT session_id, cast(substr(s, 1, 2) AS int) AS year, cast(substr(s, 3, 2) AS int) + 1 AS month,
 cast(substr(s, 5, 2) AS int) AS day, cast(substr(s, 7, 2) AS int) AS hour, cast(substr(s, 9, 2) AS int) AS minute, cast(substr(s, 11, 2) AS int) AS second
 FROM (SELECT session_id, cast(stamp AS varchar) AS s FROM parts) p"""
    o["session_weights"] = f"""WITH {PART_ID} SELECT session_id, CASE substr(cast(stamp AS varchar), 1, 2) WHEN '20' THEN 0.5::double WHEN '21' THEN 0.8::double
 WHEN '22' THEN 1.5::double ELSE 1.0::double END AS weight FROM parts"""
    o["noise_features"] = """SELECT session_id, concat('random', cast(i AS varchar)) AS feature,
 cast(('0x' || substr(md5(concat(cast(session_id AS varchar), ':42:', cast(i AS varchar))), 1, 8))::bigint % 999 + 1 AS double) AS value
 FROM (SELECT DISTINCT user_id AS session_id FROM events) s, (SELECT unnest(range(0, 30)) AS i) n"""
    o["assign_folds"] = f"SELECT session_id, cast({FOLD} % 5 AS int) AS fold FROM (SELECT DISTINCT user_id AS session_id FROM events) s"
    routing = "CASE WHEN q <= 3 THEN '0-4' WHEN q <= 13 THEN '5-12' ELSE '13-22' END"
    o["question_routing"] = f"WITH {ANSWERS} SELECT session_id, q, {routing} AS level_group FROM answers"
    priors = "0.728, 0.978, 0.933, 0.8, 0.548, 0.776, 0.736, 0.612, 0.734, 0.505, 0.642, 0.86, 0.275, 0.707, 0.481, 0.733, 0.684, 0.95"
    o["oof_init"] = f"WITH {ANSWERS} SELECT session_id, q, cast(([{priors}])[q] AS double) AS p FROM answers"
    o["oof_init_learned"] = f"""WITH {ANSWERS}, f AS (SELECT session_id, q, correct, cast({FOLD} % 5 AS int) AS fold FROM answers),
 t AS (SELECT q, fold, count(*) AS n, sum(correct) AS s FROM f GROUP BY q, fold), w AS (SELECT q, sum(n) AS n, sum(s) AS s FROM t GROUP BY q)
 SELECT session_id, q, cast(w.s - t.s AS double) / (w.n - t.n) AS p FROM f JOIN t USING (q, fold) JOIN w USING (q)"""
    o["labels_for_question"] = f"WITH {ANSWERS} SELECT session_id, correct FROM answers WHERE q = 7"
    o["question_subset"] = f"WITH {ANSWERS} SELECT session_id, q, correct, p FROM answers WHERE q IN (1, 4, 14)"
    o["truth_matrix"] = (
        f"WITH {ANSWERS} SELECT session_id, "
        + ", ".join(f"max(correct) FILTER (WHERE q = {q}) AS q{q}" for q in range(1, 19))
        + " FROM answers GROUP BY session_id"
    )
    o["threshold_sweep"] = scored(f"SELECT {THRESHOLD}, {COUNTS}, round(macro_f1, 9) AS macro_f1 FROM sweep")
    best = "best AS (SELECT i FROM sweep ORDER BY macro_f1 DESC, i LIMIT 1)"
    o["best_threshold"] = scored(f"SELECT {THRESHOLD}, {COUNTS}, round(macro_f1, 9) AS macro_f1 FROM sweep ORDER BY sweep.macro_f1 DESC, i LIMIT 1")
    o["macro_f1_fixed"] = scored(f"SELECT {THRESHOLD}, {COUNTS}, round(macro_f1, 9) AS macro_f1 FROM sweep WHERE i = 20")
    o["macro_f1_by_question"] = scored(
        f"SELECT q, {THRESHOLD}, {COUNTS}, round({F1}, 9) AS macro_f1 FROM counts WHERE i = (SELECT i FROM ({best[9:-1]}) b)"
    )
    subset = ANSWERS.replace("answers AS (", "everyone AS (", 1) + f",\n{ORIGINALS},\nanswers AS (SELECT * FROM everyone WHERE session_id IN (SELECT session_id FROM originals))"
    o["macro_f1_originals"] = scored(f"SELECT {THRESHOLD}, {COUNTS}, round(macro_f1, 9) AS macro_f1 FROM sweep", subset)
    rounds = f"rounds AS (SELECT q, cast({FOLD} % 5 AS int) AS fold, cast(sum(correct) AS bigint) AS best_iteration FROM answers GROUP BY q, fold)"
    o["mean_best_iterations"] = f"WITH {ANSWERS}, {rounds} SELECT q, cast(trunc(avg(cast(best_iteration AS double))) AS int) AS best_iteration FROM rounds GROUP BY q"
    o["write_oof"] = f"WITH {ANSWERS} SELECT session_id, q, p FROM answers"
    o["csv_roundtrip"] = (
        f"WITH {ANSWERS} SELECT session_id, "
        + ", ".join(f'max(p) FILTER (WHERE q = {q}) AS "{q - 1}"' for q in range(1, 19))
        + " FROM answers GROUP BY session_id"
    )
    o["load_dictionaries"] = more(
        f"{COMBOS},\n{NAVIGATE}",
        """SELECT 'flr_list' AS dictionary, level_group, fqid AS a, room_fqid AS b, level AS i, cast(NULL AS bigint) AS j, cast(NULL AS int) AS category FROM flr
 UNION ALL SELECT 'tl_list', level_group, text_fqid, NULL, level, NULL, NULL FROM tl
 UNION ALL SELECT 'navigate_master', level_group, room_fqid, NULL, cast(room_x AS int), room_y, category FROM popularity""",
    )
    o["run_results_table"] = scored(f"""SELECT 'overall' AS score, round(macro_f1, 9) AS value FROM (SELECT * FROM sweep ORDER BY macro_f1 DESC, i LIMIT 1) s
 UNION ALL SELECT concat('q', cast(q AS varchar)), round({F1}, 9) FROM counts WHERE i = (SELECT i FROM sweep ORDER BY macro_f1 DESC, i LIMIT 1)""")
    return o


# --- long feature table ---------------------------------------------------------

CTES = f"{DELTAS},\n{WORD_ROWS},\n{LEVEL_TIMES},\n{LIMITS},\n{COMBOS},\n{NAVIGATE}"
S = "concat('grp', level_group)"


def _name(template: str, value: str = "''") -> str:
    parts = template.replace("{c}", "|c|").replace("{S}", "|s|").split("|")
    return "concat(" + ", ".join(value if p == "c" else S if p == "s" else f"'{p}'" for p in parts) + ")"


def _rows(source: str, columns, block="base", value="''", zero=()) -> str:
    """Long rows of ``source`` for (column, template) pairs."""
    return "\nUNION ALL ".join(
        f"""SELECT session_id, level_group, '{block}' AS block, {_name(t, value)} AS feature, {str(c in zero).lower()} AS zero,
 cast("{c}" AS double) AS value FROM {source} WHERE "{c}" IS NOT NULL"""
        for c, t in columns
    )


def _body(sql: str) -> str:
    """The part of a generated query after its shared definitions."""
    return sql[sql.rindex("\nSELECT ") + 1 :]


def feature_ctes() -> str:
    first, second = _first(), _second()
    wide = {
        "t_counts": (_body(first["session_counts"]), ["session_number"], ""),
        "t_distinct": (_body(first["session_distincts"]), [f"{c}_unique" for c in CATEGORY], ""),
        "t_stats": (_body(first["numeric_stats"]), [f"{c}_{k}" for c in NUMERIC for k in ("mean", "std", "min", "max")], ""),
        "t_quantiles": (_body(first["numeric_quantiles"]), [f"{c}_quantile{round(q * 10)}" for c in NUMERIC for q in SHARES], ""),
        "t_flags": (_body(first["gap_flag_sums"]), [f"elapsed_time_over{n}" for n in FLAGS], ""),
        "t_levels": (_body(second["level_time_features"]), None, ""),
        "t_spans": (_body(second["milestone_features"]), None, "extra_"),
        "t_steps": (_body(second["milestone_transitions"]), None, "extra_"),
        "t_repeat": (_body(second["repeat_clicks"]), ["click_same_max", "click_same_over"], ""),
    }
    ctes, rows = [CTES], []
    for name, (body, columns, extra) in wide.items():
        if columns is None:
            pieces = body.split(" FROM ")[0] if name == "t_levels" else body
            columns = [w.strip('",') for w in _aliases(pieces)]
        ctes.append(f"{name} AS ({body})")
        rows.append(_rows(name, [(c, f"{c}_{extra}{{S}}") for c in columns]))
    et = {k: (f"et_{k}", "{c}_ET_" + k + "_{S}") for k in ("mean", "std", "max", "min", "sum")}
    full = [et[k] for k in ("std", "mean", "max", "min", "sum")]
    short = [et[k] for k in ("std", "mean", "sum")]
    for c, label, stats in (
        ("event_name", "_event_name_counts{S}", [et[k] for k in ("mean", "std", "max", "min")] + [(f"x_{k}", "{c}_ET_" + k + "_x{S}") for k in ("mean", "std", "max", "min")]),
        ("name", "_name_counts{S}", [et[k] for k in ("mean", "max", "min", "std")]),
        ("room_fqid", "_room_fqid_counts{S}", full),
        ("fqid", "_fqid_counts{S}", full),
        ("text_fqid", "_text_fqid_counts{S}", full),
        ("level", "_LEVEL_count{S}", short),
        ("level_group", "_LEVEL_group_count{S}", short),
    ):
        ctes.append(f"v_{c} AS ({by_value(c)})")
        rows.append(_rows(f"v_{c}", [("n", "{c}" + label), *stats], value="value", zero=("n",)))
    ctes.append(f"v_word AS ({by_value('word', 'words')})")
    rows.append(_rows("v_word", [("n", "word_{c}_{S}")] + [(f"et_{k}", "word_" + k + "_{c}_{S}") for k in ("mean", "std", "max", "sum")], value="value", zero=("n",)))
    for key, shares, tag in (("by_event_name_quantiles", SHARES, ""), ("by_text_quantiles", (0.2, 0.7, 0.9), "text_"), ("by_room_quantiles", (0.2, 0.7, 0.9), "room_")):
        ctes.append(f"q_{key} AS ({_body(first[key])})")
        rows.append(_rows(f"q_{key}", [(f"elapsed_time_diff_quantile{round(q * 10)}", "{c}_" + tag + f"ET_quantile{round(q * 10)}_{{S}}") for q in shares], value="value"))
    lv = "cast(level AS varchar)"
    rows.append(_rows("(SELECT * FROM cells SEMI JOIN flr USING (level_group, fqid, level, room_fqid)) c", [("et_sum", "{c}_ET_sum_{S}"), ("n", "{c}_counts{S}")], value=f"concat(fqid, '_', room_fqid, '_', {lv})", zero=("n",)))
    rows.append(_rows("(SELECT * FROM tcells SEMI JOIN tl USING (level_group, text_fqid, level)) c", [("et_sum", "{c}_ET_sum_{S}"), ("n", "{c}ET_count_{S}")], value=f"concat(text_fqid, '_', {lv})", zero=("n",)))
    ctes.append(f"c_levels AS ({_body(second['event_level_counts'])}),\nc_pairs AS ({_body(second['event_name_pair_counts'])})")
    rows.append(_rows("c_levels", [("n", "{c}_count_{S}")], value=f"concat(event_name, '_', {lv})", zero=("n",)))
    rows.append(_rows("c_pairs", [("n", "{c}_count_{S}")], value="concat(event_name, '_', name)", zero=("n",)))
    late = second["above_threshold_features"]
    ctes.append(f"c_above AS ({late[late.index('SELECT session_id, level_group, ' + chr(39) + 'room_fqid'):]})")
    rows.append(_rows("(SELECT * FROM c_above WHERE level_group <> '13-22') a", [("n", "index_count_{c}_{S}_above"), ("diff_to_sum", "elapsed_time_diff_to_{c}_{S}_above")], "above", "value", ("n",)))
    nav = second["navigate_category_counts"]
    ctes.append(f"c_nav AS ({nav[nav.index('SELECT session_id, nav.level_group'):]})")
    rows.append(_rows("c_nav", [("n", "navigate_index_count{c}_{S}")], "navigate", "concat(room_fqid, '_', cast(category AS varchar))", ("n",)))
    ctes.append("feats AS (" + "\nUNION ALL ".join(rows) + ")")
    ctes.append("""members AS (SELECT DISTINCT session_id, level_group, 'base' AS block FROM d
 UNION ALL SELECT DISTINCT session_id, level_group, 'above' FROM above WHERE level_group <> '13-22'
 UNION ALL SELECT DISTINCT session_id, level_group, 'navigate' FROM nav)""")
    ctes.append("""listed AS (SELECT level_group, 'above' AS block, concat('index_count_', cast(level AS varchar), '_grp', level_group, '_above') AS feature, true AS zero, cast(NULL AS double) AS value
 FROM (SELECT unnest(['0-4', '5-12']) AS level_group) g, (SELECT unnest(range(0, 23)) AS level) l),
named AS (SELECT level_group, block, feature, zero, value FROM feats UNION ALL SELECT level_group, block, feature, zero, value FROM listed)""")
    ctes.append(_summary("summary", "named", "members"))
    ctes.append("""kept AS (SELECT * FROM summary WHERE cast(sessions - present AS double) / sessions <= CASE WHEN feature LIKE '%\\_above' ESCAPE '\\' THEN 0.997 ELSE 0.97 END
 AND (low < high OR sessions > present))""")
    return ",\n".join(ctes)


def _summary(name: str, rows: str, members: str) -> str:
    return f"""{name} AS (SELECT level_group, block, feature, zero, sessions, CASE WHEN zero THEN members ELSE n END AS present,
 CASE WHEN zero AND n < members THEN least(low, 0) ELSE low END AS low, CASE WHEN zero AND n < members THEN greatest(high, 0) ELSE high END AS high
 FROM (SELECT level_group, block, feature, zero, count(value) AS n, min(value) AS low, max(value) AS high FROM {rows} GROUP BY ALL) f
 JOIN (SELECT level_group, block, count(*) AS members FROM {members} GROUP BY ALL) b USING (level_group, block)
 JOIN (SELECT level_group, count(*) AS sessions FROM {members} WHERE block = 'base' GROUP BY ALL) t USING (level_group))"""


def _aliases(select: str) -> list[str]:
    import re

    return re.findall(r' AS ("[^"]+"|\w+?)(?=,|$| FROM d)', select)


DROPPED = {
    "0-4": ("session_number_grp0-4", "no_such_feature"),
    "5-12": ("fq1_ET_mean_grp5-12", "tx.1_text_ET_quantile2_grp13-22"),
    "13-22": ("tx.1_text_ET_quantile2_grp13-22",),
}


def _round(column: str) -> str:
    return f"""round({column}, CASE WHEN feature LIKE '%std%' THEN 2 WHEN feature LIKE '%mean%' AND feature NOT LIKE '%ET_mean%' AND feature NOT LIKE 'word%'
 AND feature NOT LIKE 'elapsed%' THEN 7 ELSE 4 END) AS {column}"""


def _fourth() -> dict[str, str]:
    base = f"WITH {feature_ctes()}"
    o = {}
    o["join_feature_blocks"] = f"{base}\nSELECT session_id, level_group, block, feature, zero, {_round('value')} FROM feats"
    o["feature_summary"] = f"{base}\nSELECT level_group, block, feature, zero, sessions, present, {_round('low')}, {_round('high')} FROM summary"
    o["prune_features"] = f"{base}\nSELECT level_group, block, feature, sessions, present FROM kept"
    o["feature_catalog"] = f"{base}\nSELECT level_group, feature, (level_group, feature) IN (SELECT level_group, feature FROM kept) AS kept FROM summary"
    o["drop_listed_features"] = f"{base}\nSELECT level_group, feature, present FROM kept WHERE (level_group, feature) NOT IN ({', '.join(repr((g, n)) for g, names in DROPPED.items() for n in names)})"
    merged = f"""kf AS (SELECT f.* FROM feats f SEMI JOIN kept USING (level_group, feature)),
s2 AS (SELECT session_id FROM members WHERE level_group = '5-12' AND block = 'base'), s3 AS (SELECT session_id FROM members WHERE level_group = '13-22' AND block = 'base'),
mf AS (SELECT * FROM kf UNION ALL SELECT session_id, '5-12', concat(block, '@0-4'), feature, zero, value FROM kf SEMI JOIN s2 USING (session_id) WHERE level_group = '0-4'
 UNION ALL SELECT session_id, '13-22', concat(block, '@5-12'), feature, zero, value FROM kf SEMI JOIN s3 USING (session_id) WHERE level_group = '5-12'
 UNION ALL SELECT session_id, '13-22', concat(block, '@0-4'), feature, zero, value FROM kf SEMI JOIN s2 USING (session_id) SEMI JOIN s3 USING (session_id) WHERE level_group = '0-4'),
mm AS (SELECT * FROM members UNION ALL SELECT session_id, '5-12', concat(block, '@0-4') FROM members SEMI JOIN s2 USING (session_id) WHERE level_group = '0-4'
 UNION ALL SELECT session_id, '13-22', concat(block, '@5-12') FROM members SEMI JOIN s3 USING (session_id) WHERE level_group = '5-12'
 UNION ALL SELECT session_id, '13-22', concat(block, '@0-4') FROM members SEMI JOIN s2 USING (session_id) SEMI JOIN s3 USING (session_id) WHERE level_group = '0-4'),
{_summary('msummary', 'mf', 'mm')}"""
    o["cumulative_group_merge"] = f"{base},\n{merged}\nSELECT level_group, block, feature, zero, sessions, present, {_round('low')}, {_round('high')} FROM msummary"
    o["fill_missing_features"] = f"{base},\n{FILLED}\nSELECT session_id, level_group, feature, {_round('value')} FROM filled"
    groups = "CASE WHEN q <= 3 THEN '0-4' WHEN q <= 13 THEN '5-12' ELSE '13-22' END"
    o["chain_features"] = f"""{base},
{FILLED},
{ANSWERS}
SELECT a.session_id, a.q, a.correct, n_features, n_missing, coalesce((SELECT string_agg(cast(p1000 AS varchar), ',' ORDER BY b.q) FROM answers b
 WHERE b.session_id = a.session_id AND b.q < a.q), '') AS earlier
FROM answers a JOIN (SELECT session_id, level_group, count(*) AS n_features, count(*) FILTER (WHERE value = -1) AS n_missing FROM filled GROUP BY ALL) c
 ON c.session_id = a.session_id AND c.level_group = {groups}"""
    o["fit_vocabulary"] = f"""WITH {DELTAS}, {_VALUES}
SELECT level_group, dimension, value, support FROM ({_SUPPORTED})"""
    return o


# Every kept feature of every session: its value, 0 for a count in the block, else -1.
FILLED = """filled AS (SELECT m.session_id, m.level_group, k.feature, coalesce(f.value, CASE WHEN k.zero AND i.session_id IS NOT NULL THEN 0 END, -1) AS value
 FROM members m JOIN kept k ON m.block = 'base' AND k.level_group = m.level_group
 LEFT JOIN feats f ON f.session_id = m.session_id AND f.level_group = m.level_group AND f.feature = k.feature
 LEFT JOIN members i ON i.session_id = m.session_id AND i.level_group = m.level_group AND i.block = k.block)"""
_VALUES = """vals AS (SELECT DISTINCT session_id, level_group, 'fqid' AS dimension, fqid AS value, 0.5 AS share FROM d WHERE fqid <> 'fqid_None'
 UNION ALL SELECT DISTINCT session_id, level_group, 'text_fqid', text_fqid, 0.45 FROM d WHERE text_fqid <> 'text_fqid_None')"""
_SUPPORTED = """SELECT level_group, dimension, value, count(*) AS support, any_value(share) AS share, any_value(sessions) AS sessions
 FROM vals JOIN (SELECT level_group, count(DISTINCT session_id) AS sessions FROM d GROUP BY level_group) t USING (level_group)
 GROUP BY level_group, dimension, value HAVING count(*) >= greatest(floor(round(any_value(sessions) * any_value(share), 9)), 1)"""


def _new_log() -> str:
    """Features of the sessions with odd ids: dictionaries, vocabulary and pruning of the even ones."""
    even = "session_id % 2 = 0"
    ctes = feature_ctes()
    for old in (
        "AS sessions FROM d GROUP BY level_group",
        "AS support FROM d GROUP BY ALL",
        "AS sessions FROM nav GROUP BY ALL",
        "value FROM feats UNION ALL",
        "AS members FROM members GROUP BY ALL",
    ):
        assert old in ctes
        name = old.split(" FROM ")[1].split(" ")[0]
        ctes = ctes.replace(old, old.replace(f"FROM {name}", f"FROM {name} WHERE {even}"))
    ctes = ctes.replace("AS sessions FROM members WHERE block = 'base'", f"AS sessions FROM members WHERE {even} AND block = 'base'")
    words = f"{_VALUES},\nvocabulary AS ({_SUPPORTED})".replace("FROM vals JOIN", f"FROM (SELECT * FROM vals WHERE {even}) v JOIN").replace(
        "FROM d GROUP BY level_group", f"FROM d WHERE {even} GROUP BY level_group"
    )
    for dimension, tables in (("fqid", ("v_fqid",)), ("text_fqid", ("v_text_fqid", "q_by_text_quantiles"))):
        for t in tables:
            assert f"FROM {t} WHERE" in ctes
            listed = f"(SELECT * FROM {t} SEMI JOIN (SELECT level_group, value FROM vocabulary WHERE dimension = '{dimension}') w USING (level_group, value)) l"
            ctes = ctes.replace(f"FROM {t} WHERE", f"FROM {listed} WHERE")
    ctes = ctes.replace("\nt_counts AS (", f"\n{words},\nt_counts AS (", 1)
    return f"WITH {ctes},\n{FILLED}\nSELECT session_id, level_group, feature, {_round('value')} FROM filled WHERE session_id % 2 = 1"


# Of all cuts between two neighbouring numbers of events, the first of greatest gain by weighted Gini impurity; a side's share of
# right answers is the forest's score (of both together if they foretell the same answer), and the boosted tree's margin is that share from -1 to 1.
STUMPS = """obs AS (SELECT a.session_id, a.q, a.correct, cast(e.x AS double) AS x, k.kind,
  CASE WHEN k.kind = 'forest' THEN 1.0 WHEN a.session_id % 3 = 0 THEN 0.5 WHEN a.session_id % 3 = 1 THEN 1.0 ELSE 2.0 END AS w
 FROM answers a JOIN (SELECT session_id, level_group, count(*) AS x FROM d GROUP BY ALL) e
  ON e.session_id = a.session_id AND e.level_group = CASE WHEN a.q <= 3 THEN '0-4' WHEN a.q <= 13 THEN '5-12' ELSE '13-22' END,
  (SELECT unnest(['forest', 'boosted']) AS kind) k),
steps AS (SELECT kind, q, x, cast(sum(w) AS double) AS n, cast(sum(w * correct) AS double) AS s FROM obs GROUP BY ALL),
run AS (SELECT kind, q, x, sum(n) OVER u AS ln, sum(s) OVER u AS ls, sum(n) OVER t AS n, sum(s) OVER t AS s, max(x) OVER t AS top FROM steps
 WINDOW u AS (PARTITION BY kind, q ORDER BY x), t AS (PARTITION BY kind, q)),
gains AS (SELECT *, 2 * (s / n) * (1 - s / n) - ln / n * 2 * (ls / ln) * (1 - ls / ln) - (n - ln) / n * 2 * ((s - ls) / (n - ln)) * (1 - (s - ls) / (n - ln)) AS gain
 FROM run WHERE x < top),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind, q ORDER BY round(gain, 12) DESC, x) AS r FROM gains) g WHERE r = 1 AND gain > 1e-12),
whole AS (SELECT DISTINCT kind, q, n, s FROM run),
shares AS (SELECT o.session_id, o.q, o.kind, CASE WHEN b.x IS NULL OR (o.kind = 'forest' AND (2 * b.ls > b.ln) = (2 * (b.s - b.ls) > b.n - b.ln)) THEN t.s / t.n WHEN o.x <= b.x THEN b.ls / b.ln ELSE (b.s - b.ls) / (b.n - b.ln) END AS share
 FROM obs o JOIN whole t USING (kind, q) LEFT JOIN best b USING (kind, q))
SELECT session_id, q, kind, round(CASE WHEN kind = 'forest' THEN share ELSE 1 / (1 + exp(-2 * (2 * share - 1))) END, 6) AS p FROM shares"""


def _models() -> dict[str, str]:
    """What is determined of model results: every session and question once, with a probability; rounds as saved."""
    scores = f"WITH {ANSWERS} SELECT session_id, q, true AS valid FROM answers"
    o = {n: scores for n in ("oof_boosted", "oof_forest", "oof_boosted_early_stop", "oof_weighted", "train_final")}
    o["stump_scores"] = f"WITH {DELTAS},\n{ANSWERS},\n{STUMPS}"
    o["score_new_log"] = f"{scores} WHERE session_id % 2 = 1"
    o["new_log_features"] = _new_log()
    o["save_models"] = f"""WITH {ANSWERS} SELECT q, cast(k AS int) AS fold, true AS same_rounds, 3 AS rounds
 FROM (SELECT DISTINCT q FROM answers) a, range(2) r(k)"""
    return o


def all_oracles() -> dict[str, str]:
    return {**_first(), **_second(), **_third(), **_fourth(), **_models()}
