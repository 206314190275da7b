"""Current state, journals, retention, joins and plain aggregates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pulsebook.catalog import query, split_form
from pulsebook.functions.timecols import recent
from pulsebook.operators import cells, changes, current
from pulsebook.plans import adapters as a
from pulsebook.session import work_folder
from pulsebook.sources import sinks

TIE = "event_id"
LATE = datetime(2024, 2, 10)


def _latest_sql(view: str, key: str) -> str:
    return f"SELECT * FROM {view} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY time DESC, event_id DESC) = 1"


@query("u1_ping_current", "ping", _latest_sql("ping", "ip"))
def u1_ping(spark, d):
    return current.latest(a.ping(spark, d), "ip", "time", TIE)


@query("u1_temp_current", "temp", _latest_sql("temp", "location"))
def u1_temp(spark, d):
    return current.latest(a.temp(spark, d), "location", "time", TIE)


@query("u1_electro_current", "electro", _latest_sql("electro", "location"))
def u1_electro(spark, d):
    return current.latest(a.electro(spark, d), "location", "time", TIE)


@query("u1_dehydrator_current", "dehydrator", _latest_sql("dehydrator", "ip"))
def u1_dehydrator(spark, d):
    return current.latest(a.dehydrator(spark, d), "ip", "time", TIE)


@query("a1_latest_order", "", """SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def a1(spark, d):
    return current.latest(a.table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey")


TEMP_CHANGES = """WITH changes AS (SELECT * FROM temp WINDOW w AS (PARTITION BY location ORDER BY time, event_id)
    QUALIFY abs(temperature - lag(temperature) OVER w) < 5 AND temperature <> lag(temperature) OVER w),
    cur AS (SELECT * FROM temp QUALIFY row_number() OVER (PARTITION BY location ORDER BY time DESC, event_id DESC) = 1)
    """


def _temp_changes(spark, d):
    return changes.changes_within(a.temp(spark, d), "location", "time", "temperature", 5, tie=TIE)


@query("u3_heartbeat", "temp", TEMP_CHANGES + "SELECT * FROM changes UNION ALL SELECT * FROM cur")
def u3(spark, d):
    return current.heartbeat(_temp_changes(spark, d), current.latest(a.temp(spark, d), "location", "time", TIE))


@query(
    "u4_dual_write", "temp",
    TEMP_CHANGES + """SELECT 'archive' AS journal, * FROM changes UNION ALL
    SELECT 'hot' AS journal, * FROM changes WHERE time >= TIMESTAMP '2024-02-10' - INTERVAL 31 DAYS""",
)
def u4(spark, d):
    folder = work_folder(spark, "journals")
    hot, archive = f"{folder}/hot", f"{folder}/archive"
    found = _temp_changes(spark, d)
    for _ in range(2):  # a repeated batch changes nothing
        sinks.journal(found, hot, archive, "time", "batch-0")
    sinks.expire(spark, hot, LATE)
    kept = sinks.read_hot(spark, hot, found.columns, "time", LATE)
    return sinks.read_journal(spark, archive, found.columns).withColumn("journal", F.lit("archive")).unionByName(
        kept.withColumn("journal", F.lit("hot"))
    )


@query("u4_hot_minus_archive", "temp", TEMP_CHANGES + """SELECT location, count(*) AS heartbeats FROM
    (SELECT * FROM cur EXCEPT ALL SELECT * FROM changes) GROUP BY location""")
def u4_invariant(spark, d):
    found = _temp_changes(spark, d)
    hot = current.heartbeat(found, current.latest(a.temp(spark, d), "location", "time", TIE)).distinct()
    return hot.exceptAll(found).groupBy("location").agg(F.count(F.lit(1)).alias("heartbeats"))


@query("u5_retain", "temp", "SELECT * FROM temp WHERE time >= TIMESTAMP '2024-02-10' - INTERVAL 31 DAYS")
def u5(spark, d):
    return current.retain(a.temp(spark, d), "time", LATE)


@query("p12_expired", "temp", "SELECT * FROM temp WHERE TIMESTAMP '2024-02-10' - time > INTERVAL 31 DAYS")
def p12(spark, d):
    return a.temp(spark, d).filter(~recent("time", LATE))


@query(
    "u7_apply_flags", "ev cell_registry",
    """WITH commands AS (SELECT controller, CAST(u AS INTEGER) AS cell,
      arg_max(CASE WHEN k % 2 = 0 THEN 'do' ELSE 'not' END, (time, event_id)) AS new
      FROM ev WHERE event_type = 'signup' GROUP BY ALL)
    SELECT r.controller, r.cell, coalesce(c.new, r."check") AS "check" FROM cell_registry r
    LEFT JOIN commands c ON r.controller = c.controller AND r.cell = c.cell""",
)
def u7(spark, d):
    commands = a.polls_base(spark, d).filter(a.is_type("signup")).select(
        "controller", F.col("u").cast("int").alias("cell"), "time", TIE,
        F.when(F.col("k") % 2 == 0, "do").otherwise("not").alias("check"),
    )
    return current.apply_flags(a.cell_registry(spark, d), commands, ["controller", "cell"], "time", "check", TIE)


@query("p16_known_commands", "vent_events", "SELECT u, time, event_id, cmd FROM vent_events "
       "WHERE cmd IN ('auto_on', 'auto_off', 'v5_on', 'v5_off')")
def p16(spark, d):
    x = a.vent_events(spark, d).select("u", "time", TIE, "cmd")
    return current.known_commands(x, "cmd", ["auto_on", "auto_off", "v5_on", "v5_off"])


@query("p6_monitored", "ev cell_registry", """SELECT e.* FROM ev e SEMI JOIN (SELECT * FROM cell_registry
    WHERE "check" <> 'not') r ON e.controller = r.controller AND e.u = r.cell""")
def p6(spark, d):
    reg = a.cell_registry(spark, d).withColumnRenamed("cell", "u")
    return current.monitored(a.polls_base(spark, d), reg, ["controller", "u"])


@query("p9_complete", "temp_gaps", """SELECT *, temperature IS NULL AS rejected FROM temp_gaps""")
def p9(spark, d):
    good, bad = current.complete_rows(a.temp_gaps(spark, d), ["temperature"])
    return good.withColumn("rejected", F.lit(False)).unionByName(bad.withColumn("rejected", F.lit(True)))


# -- joins -------------------------------------------------------------------------


@query("j1_registry_current", "ping equipment", """SELECT e.*, c.time, c.event_id, c.state FROM equipment e JOIN (
    SELECT * FROM ping QUALIFY row_number() OVER (PARTITION BY ip ORDER BY time DESC, event_id DESC) = 1) c
    ON e.ip = c.ip""")
def j1(spark, d):
    return a.equipment(spark, d).join(u1_ping(spark, d), "ip")


@query("j2_journal_registry", "ping_changes equipment",
       "SELECT p.*, e.name, e.location FROM ping_changes p JOIN equipment e ON p.ip = e.ip")
def j2(spark, d):
    journal = changes.changes(a.ping(spark, d), "ip", "time", ["state"], TIE)
    return journal.join(a.equipment(spark, d).select("ip", "name", "location"), "ip")


@query("j4_current_thresholds", "temp thresholds", """SELECT t.location, t.temperature, l.id, l.blue, l.yellow, l.red
    FROM thresholds l JOIN (SELECT location, arg_max(temperature, (time, event_id)) AS temperature FROM temp
    GROUP BY location) t ON t.location = l.location""")
def j4(spark, d):
    now = u1_temp(spark, d).select("location", "temperature")
    return now.join(a.thresholds(spark, d).select("location", "id", "blue", "yellow", "red"), "location")


@query("j5_current_with_average", "dehydrator averages", """SELECT c.ip, c.c_life, c.time, v.average FROM (
    SELECT * FROM dehydrator QUALIFY row_number() OVER (PARTITION BY ip ORDER BY time DESC, event_id DESC) = 1) c
    JOIN averages v ON c.ip = v.ip AND c.c_life = v.last_hour""")
def j5(spark, d):
    from pulsebook.catalog.histories import a7

    now = u1_dehydrator(spark, d).select("ip", "c_life", "time")
    avg = a7(spark, d).select("ip", F.col("last_hour").alias("c_life"), "average")
    return now.join(avg, ["ip", "c_life"])


@query("j6_latest_lookup", "dehydrator", """SELECT d.ip, d.time, d.event_id, d.c_life FROM dehydrator d JOIN (
    SELECT ip, arg_max(c_life, (time, event_id)) AS c_life FROM dehydrator GROUP BY ip) c
    ON d.ip = c.ip AND d.c_life = c.c_life""")
def j6(spark, d):
    x = a.dehydrator(spark, d).select("ip", "time", TIE, "c_life")
    now = current.latest(x, "ip", "time", TIE).select("ip", "c_life")
    return x.join(now, ["ip", "c_life"])


@query("j7_zip_by_key", "temp thresholds", """SELECT l.id, l.location, t.temperature FROM thresholds l LEFT JOIN (
    SELECT location, arg_max(temperature, (time, event_id)) AS temperature FROM temp GROUP BY location) t
    ON t.location = l.location""")
def j7(spark, d):
    now = u1_temp(spark, d).select("location", "temperature")
    return a.thresholds(spark, d).select("id", "location").join(now, "location", "left")


@query("j8_drawing_elements", "equipment", """SELECT concat('Sheet.', s_suppkey) AS title, s_name AS element, e.ip
    FROM supplier JOIN (SELECT ip, coalesce(nullif(visio_name, ''), 'NULL') AS visio_name FROM equipment) e
    ON e.visio_name = concat('Sheet.', s_suppkey)""")
def j8(spark, d):
    from pulsebook.functions.values import text_or_null_word

    elements = a.table(spark, d, "supplier").select(
        F.concat(F.lit("Sheet."), F.col("s_suppkey").cast("string")).alias("title"), F.col("s_name").alias("element")
    )
    named = a.equipment(spark, d).select("ip", text_or_null_word("visio_name").alias("title"))
    return elements.join(named, "title")


@query("j9_registered", "", "SELECT * FROM events SEMI JOIN customer ON user_id = c_custkey")
def j9(spark, d):
    reg = a.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return current.registered(a.table(spark, d, "events"), reg, "user_id")


@query("j10_renamed", "ping", """SELECT coalesce('172.16.0.' || s.s_suppkey, p.ip) AS ip, p.time, p.event_id, p.state
    FROM ping p LEFT JOIN supplier s ON p.ip = concat('10.', s_suppkey // 65536, '.', (s_suppkey // 256) % 256, '.',
    s_suppkey % 256)""")
def j10(spark, d):
    s = F.col("s_suppkey")
    renames = a.table(spark, d, "supplier").select(
        a.address(s).alias("old"), F.concat(F.lit("172.16.0."), s.cast("string")).alias("new")
    )
    return current.renamed(a.ping(spark, d), renames, "ip")


COMPAT = r"""WITH offs AS (SELECT controller, line_no, CAST(cell AS VARCHAR) AS cell, event FROM cell_events
      WHERE event = 'off'),
    ons AS (SELECT e.controller, e.line_no, CAST(r.cell AS VARCHAR) AS cell, e.event FROM cell_events e
      JOIN cell_registry r ON e.controller = r.controller AND suffix(CAST(e.cell AS VARCHAR), CAST(r.cell AS VARCHAR))
      WHERE e.event = 'on'),
    last AS (SELECT controller, cell, arg_max(event, line_no) AS event FROM
      (SELECT * FROM offs UNION ALL SELECT * FROM ons) GROUP BY ALL)
    SELECT r.controller, r.cell, r."check", coalesce(l.event, 'on') AS status FROM cell_registry r
    LEFT JOIN last l ON r.controller = l.controller AND CAST(r.cell AS VARCHAR) = l.cell"""


@query("j11_suffix_match", "cell_events cell_registry", COMPAT)
def j11(spark, d):
    return cells.cell_status(a.cell_log(spark, d), a.cell_registry(spark, d), strict=False)


# -- aggregates --------------------------------------------------------------------


@query("a3_latest_time", "ev", "SELECT max(time) AS latest FROM ev")
def a3(spark, d):
    return a.polls_base(spark, d).agg(F.max("time").alias("latest"))


@query("a4_probe_result", "ev", """SELECT ip, date_trunc('hour', time) AS poll, bool_or(event_type <> 'error') AS state
    FROM ev GROUP BY ALL""")
def a4(spark, d):
    base = a.polls_base(spark, d).select(
        "ip", F.timestamp_add("HOUR", F.hour("time"), F.to_date("time").cast("timestamp_ntz")).alias("poll"),
        (~a.is_type("error")).alias("received"),
    )
    return current.probe_result(base, "ip", "poll")


@query("a5_cell_status", "cell_status", "SELECT * FROM cell_status")
def a5(spark, d):
    return cells.cell_status(a.cell_log(spark, d), a.cell_registry(spark, d))


@query(
    "a5_with_previous", "cell_events cell_registry",
    """WITH day1 AS (SELECT controller, cell, arg_max(event, line_no) AS event FROM cell_events
      WHERE log_date < DATE '2024-01-15' GROUP BY ALL),
    day2 AS (SELECT controller, cell, arg_max(event, line_no) AS event FROM cell_events
      WHERE log_date >= DATE '2024-01-15' GROUP BY ALL)
    SELECT r.controller, r.cell, r."check", coalesce(day2.event, day1.event, 'on') AS status FROM cell_registry r
    LEFT JOIN day1 ON r.controller = day1.controller AND r.cell = day1.cell
    LEFT JOIN day2 ON r.controller = day2.controller AND r.cell = day2.cell""",
)
def a5_previous(spark, d):
    log, reg = a.cell_log(spark, d), a.cell_registry(spark, d)
    split = F.lit("2024-01-15").cast("date")
    before = cells.cell_status(log.filter(F.col("log_date") < split), reg)
    return cells.cell_status(log.filter(F.col("log_date") >= split), reg, previous=before)


@query("a6_failing_list", "cell_status", """SELECT controller, string_agg(concat('БС№', cell, '=off.'), ' '
    ORDER BY cell) AS failing FROM cell_status WHERE status = 'off' GROUP BY controller""")
def a6(spark, d):
    return current.failing_list(a5(spark, d), "controller")


@query("a6_failing_parts", "cell_status", """SELECT controller, part, string_agg(concat('БС№', cell, '=off.'), ' ' ORDER BY cell)
    AS failing FROM (SELECT *, (row_number() OVER (PARTITION BY controller ORDER BY cell) - 1) // 50 AS part FROM cell_status
    WHERE status = 'off') GROUP BY controller, part""")
def a6_parts(spark, d):
    return current.failing_parts(a5(spark, d), "controller", 50)


split_form("a6_failing_parts")


@query("a10_daily_counts", "ping_changes",
       "SELECT ip, CAST(time AS DATE) AS day, count(*) AS events FROM ping_changes GROUP BY ALL")
def a10(spark, d):
    journal = changes.changes(a.ping(spark, d), "ip", "time", ["state"], TIE)
    return current.daily_counts(journal, "ip", "time")


# -- sorts and limits --------------------------------------------------------------


@query("t5_last_8", "cell_log", """SELECT *, CAST(row_number() OVER (PARTITION BY controller ORDER BY line_no DESC)
    AS INTEGER) AS rank FROM cell_log QUALIFY row_number() OVER (PARTITION BY controller ORDER BY line_no DESC) <= 8""")
def t5(spark, d):
    return current.last_n(a.cell_log(spark, d), "controller", "line_no", 8)


@query("t6_keep_last_20", "cell_log", """SELECT * FROM cell_log QUALIFY row_number() OVER (PARTITION BY controller
    ORDER BY line_no DESC) <= 20""")
def t6(spark, d):
    return current.last_n(a.cell_log(spark, d), "controller", "line_no", 20).drop("rank")


@query("t7_newest_first", "ping_changes", "SELECT * FROM ping_changes ORDER BY time DESC, event_id DESC")
def t7(spark, d):
    journal = changes.changes(a.ping(spark, d), "ip", "time", ["state"], TIE)
    return journal.orderBy(F.col("time").desc(), F.col(TIE).desc())


@query("t9_first_row", "ev", "SELECT ip, arg_min(event_type, (time, event_id)) AS first_type, min(time) AS first_time "
       "FROM ev GROUP BY ip")
def t9(spark, d):
    return a.polls_base(spark, d).groupBy("ip").agg(
        F.min_by("event_type", F.struct("time", TIE)).alias("first_type"), F.min("time").alias("first_time")
    )


# -- sources and sinks over whole tables -------------------------------------------


@query("s10_scan", "", "SELECT * FROM lineitem")
def s10(spark, d):
    return a.table(spark, d, "lineitem")


@query(
    "s11_export_daily", "temp",
    """SELECT location, strftime(time, '%Y-%m-%d %H:%M:%S') AS shown_at, CAST(temperature AS VARCHAR) AS temperature
    FROM temp WHERE time BETWEEN TIMESTAMP '2024-01-19' AND TIMESTAMP '2024-01-20 12:00:00'""",
)
def s11(spark, d):
    from pulsebook.plans.reports import day_series

    path = work_folder(spark, "export")
    series = day_series(a.temp(spark, d), datetime(2024, 1, 20, 12), "location", ["temperature"]).drop("read_at")
    sinks.export_daily(series, path, "location")
    return sinks.read_export(spark, path, "shown_at string, temperature string", "location")


@query("s12_dated_report", "ev", """SELECT ip, CAST(time AS DATE) AS report_date, count(*) AS polls FROM ev
    WHERE CAST(time AS DATE) IN (DATE '2024-01-14', DATE '2024-01-15') GROUP BY ALL""")
def s12(spark, d):
    path = work_folder(spark, "reports")
    counts = current.daily_counts(a.polls_base(spark, d), "ip", "time").withColumnRenamed("events", "polls")
    for day in (datetime(2024, 1, 14).date(), datetime(2024, 1, 15).date(), datetime(2024, 1, 15).date()):
        one = counts.filter(F.col("day") == F.lit(day)).drop("day")
        sinks.write_report(one, path, day)
    return spark.read.parquet(path)


@query("s13_with_site", "temp", """SELECT *, 'rooms' AS site FROM temp UNION ALL
    SELECT concat('loc-', o_custkey), o_orderdate, o_orderkey, CAST(floor(o_totalprice / 10000) AS INTEGER), 'orders'
    FROM orders""")
def s13(spark, d):
    orders = a.table(spark, d, "orders").select(
        a.location(F.col("o_custkey")).alias("location"), F.col("o_orderdate").alias("time"),
        F.col("o_orderkey").alias(TIE), F.floor(F.col("o_totalprice") / 10000).cast("int").alias("temperature"),
    )
    return current.with_site({"rooms": a.temp(spark, d), "orders": orders})


@query("s14_report_dates", "ev", """SELECT r.report_date, count(e.time) AS polls FROM (SELECT CAST(unnest(range(
    DATE '2024-01-26', DATE '2024-02-01', INTERVAL 1 DAY)) AS DATE) AS report_date) r
    LEFT JOIN ev e ON CAST(e.time AS DATE) = r.report_date GROUP BY r.report_date""")
def s14(spark, d):
    counts = a.polls_base(spark, d).groupBy(F.to_date("time").alias("report_date")).agg(F.count("time").alias("polls"))
    dates = sinks.report_dates(spark, a.AS_OF.date())
    return dates.join(counts, "report_date", "left").withColumn("polls", F.coalesce("polls", F.lit(0)))
