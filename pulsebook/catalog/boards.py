"""Boards, reports and classes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from pulsebook.catalog import query
from pulsebook.catalog.histories import MARKS, dehydrator_journal
from pulsebook.functions import bands
from pulsebook.functions.timecols import dotted_date, ntz
from pulsebook.functions.values import ip_key
from pulsebook.operators import changes, current, runtime, snapshot
from pulsebook.plans import adapters as a
from pulsebook.plans import reports

TIE = "event_id"
DAY = date(2024, 1, 15)
IP_ORDER = """CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
    + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT)"""


def band_sql(v: str, y_min: int, y_max: int, r_min: int, r_max: int) -> str:
    i = f"CAST(trunc({v}) AS INTEGER)"
    return (
        f"CASE WHEN {i} < {r_min} OR {i} > {r_max} THEN 'red' WHEN {i} < {y_min} OR {i} > {y_max} THEN 'yellow' "
        f"WHEN {v} IS NOT NULL THEN 'green' END"
    )


SNAPSHOTS = """WITH marks AS (SELECT unnest([TIMESTAMP '2024-01-15 00:00:00', TIMESTAMP '2024-01-15 03:00:00',
      TIMESTAMP '2024-01-15 06:00:00', TIMESTAMP '2024-01-16 00:00:00', TIMESTAMP '2024-01-16 03:00:00',
      TIMESTAMP '2024-01-16 06:00:00']) AS mark),
    wanted AS (SELECT location, mark FROM (SELECT DISTINCT location FROM electro), marks),
    snaps AS (SELECT w.location, w.mark AS time, e.temp_sys, e.temp_akb
      FROM wanted w ASOF JOIN electro e ON w.location = e.location AND w.mark >= e.time),
    report AS (SELECT l.ip, l.own, l.location, s0.temp_sys AS sys_0, s0.temp_akb AS akb_0, s3.temp_sys AS sys_3,
        s3.temp_akb AS akb_3, s6.temp_sys AS sys_6, s6.temp_akb AS akb_6
      FROM power_sites l JOIN snaps s0 ON s0.location = l.location AND s0.time = TIMESTAMP '2024-01-15 00:00:00'
      JOIN snaps s3 ON s3.location = l.location AND s3.time = TIMESTAMP '2024-01-15 03:00:00'
      JOIN snaps s6 ON s6.location = l.location AND s6.time = TIMESTAMP '2024-01-15 06:00:00')
    """


def _snapshots(spark, d):
    s = snapshot.snapshot_asof(a.electro(spark, d), MARKS, "location", "time", ["temp_sys", "temp_akb"], TIE)
    return s.select("location", F.col("mark").alias("time"), "temp_sys", "temp_akb")


@query("r1_hour_report", "electro power_sites", SNAPSHOTS + "SELECT * FROM report")
def r1(spark, d):
    return reports.hour_report(_snapshots(spark, d), a.power_sites(spark, d), DAY)




@query("j3_hour_report_compat", "electro power_sites", SNAPSHOTS + "SELECT * FROM report")
def j3(spark, d):
    return reports.hour_report(_snapshots(spark, d), a.power_sites(spark, d), DAY, compat=True)


@query(
    "r1_coloured_report", "electro power_sites",
    SNAPSHOTS.rstrip() + f""", ordered AS (SELECT *, {IP_ORDER} AS ip_order FROM report),
    marked AS (SELECT *, CASE WHEN own <> coalesce(lag(own) OVER (ORDER BY ip_order), (SELECT arg_max(own, ip_order)
      FROM ordered)) THEN 1 ELSE 0 END AS moved FROM ordered),
    runs AS (SELECT * EXCLUDE (moved), CAST(sum(moved) OVER (ORDER BY ip_order) AS INTEGER) AS run FROM marked)
    SELECT *, {band_sql("sys_0", 20, 40, 15, 45)} AS sys_0_class, {band_sql("sys_3", 20, 40, 15, 45)} AS sys_3_class,
      {band_sql("sys_6", 20, 40, 15, 45)} AS sys_6_class, {band_sql("akb_0", 15, 27, 5, 35)} AS akb_0_class,
      {band_sql("akb_3", 15, 27, 5, 35)} AS akb_3_class, {band_sql("akb_6", 15, 27, 5, 35)} AS akb_6_class,
      CASE run WHEN 0 THEN 'FFFFFF' WHEN 1 THEN 'E9E9E9' WHEN 2 THEN 'E8DBB3' WHEN 3 THEN 'E9E9E9'
        WHEN 4 THEN 'CFEAF3' WHEN 5 THEN 'F9F9F9' WHEN 6 THEN 'F4F4AD' END AS run_colour FROM runs""",
)
def r1_coloured(spark, d):
    return reports.coloured_hour_report(r1(spark, d), sites=a.power_sites(spark, d))


@query(
    "r2_state_board", "ping equipment",
    f"""SELECT e.ip, {IP_ORDER.replace("ip,", "e.ip,")} AS ip_order, name, description,
      CASE WHEN state THEN 'PING_OK' WHEN NOT state THEN 'PING_NO' ELSE 'NULL' END AS state,
      coalesce(nullif(visio_name, ''), 'NULL') AS visio_name
    FROM equipment e JOIN (SELECT ip, arg_max(state, (time, event_id)) AS state FROM ping GROUP BY ip) c
    ON e.ip = c.ip ORDER BY 2""",
)
def r2(spark, d):
    now = current.latest(a.ping(spark, d), "ip", "time", TIE)
    return reports.state_board(a.equipment(spark, d), now).orderBy("ip_order")


@query(
    "r2_power_board", "electro power_sites",
    f"""SELECT l.ip, {IP_ORDER.replace("ip,", "l.ip,")} AS ip_order, l.location, temp_akb, temp_sys,
      CASE alarm_mains WHEN 0 THEN 'Есть 380' WHEN 1 THEN 'Нет  380' END AS mains,
      CAST(battery1v / 10.0 AS DECIMAL(10,1)) AS battery1v, CAST(battery2v / 10.0 AS DECIMAL(10,1)) AS battery2v,
      CAST(out_volt / 10.0 AS DECIMAL(10,1)) AS out_volt, CAST(out_ampr / 10.0 AS DECIMAL(10,1)) AS out_ampr,
      CAST(out_watt / 10.0 AS DECIMAL(10,1)) AS out_watt,
      {band_sql("temp_akb", 15, 27, 5, 35)} AS akb_class, {band_sql("temp_sys", 20, 40, 15, 45)} AS sys_class,
      {band_sql("battery1v // 10", 53, 55, 47, 60)} AS battery1_class,
      {band_sql("battery2v // 10", 53, 55, 47, 60)} AS battery2_class
    FROM power_sites l JOIN (SELECT * FROM electro QUALIFY row_number() OVER (PARTITION BY location
      ORDER BY time DESC, event_id DESC) = 1) c ON c.location = l.location""",
)
def r2_power(spark, d):
    now = current.latest(a.electro(spark, d), "location", "time", TIE)
    return reports.power_board(a.power_sites(spark, d), now)


RECENT = """SELECT ip, name, date_trunc('second', time) AS ping_time,
      CASE WHEN NOT state THEN 'пропал' WHEN state THEN 'восстановился' END AS event,
      CASE WHEN NOT state THEN 'red_log' WHEN state THEN 'green_log' END AS event_class
    FROM (SELECT p.*, e.name FROM ping_changes p JOIN equipment e ON p.ip = e.ip ORDER BY time DESC, event_id DESC
    LIMIT 10) ORDER BY time, event_id"""


def _ping_changes(spark, d):
    return changes.changes(a.ping(spark, d), "ip", "time", ["state"], TIE)


@query("r3_recent_events", "ping_changes equipment", RECENT)
def r3(spark, d):
    return reports.recent_events(_ping_changes(spark, d), a.equipment(spark, d), 10, TIE)


@query("r4_day_series", "temp", """SELECT location, time AS read_at, date_trunc('second', time) AS shown_at, temperature
    FROM temp WHERE time BETWEEN TIMESTAMP '2024-01-19' AND TIMESTAMP '2024-01-20 12:00:00' ORDER BY location, time""")
def r4(spark, d):
    series = reports.day_series(a.temp(spark, d), datetime(2024, 1, 20, 12), "location", ["temperature"])
    return series.orderBy("location", "read_at")


@query("r4_power_series", "electro", """SELECT location, time AS read_at, date_trunc('second', time) AS shown_at,
    temp_akb, temp_sys FROM electro WHERE time BETWEEN TIMESTAMP '2024-01-19' AND TIMESTAMP '2024-01-20 12:00:00'""")
def r4_power(spark, d):
    return reports.day_series(a.electro(spark, d), datetime(2024, 1, 20, 12), "location", ["temp_akb", "temp_sys"])


def _flag(c: str) -> str:
    return f"CASE WHEN NOT {c} THEN 'green' ELSE 'red' END"


@query(
    "r5_dehydrator_board", "dehydrator averages power_sites",
    f"""SELECT l.ip, l.location, c.c_life, c_temp, c_high, CAST(c__low / 10.0 AS DECIMAL(4,1)) AS c__low,
      CAST(c_humi / 10.0 AS DECIMAL(4,1)) AS c_humi, date_trunc('second', c.time) AS c_time, a_summ, a_exrt, a_high,
      a__low, a_humi, a_faul, v.average, {_flag("a_summ")} AS object_class, {_flag("a_exrt")} AS life_class,
      {_flag("a_high")} AS high_class, {_flag("a__low")} AS low_class, {_flag("a_humi")} AS humidity_class,
      {_flag("a_faul")} AS fault_class, CASE WHEN NOT a_faul THEN 'OK' ELSE 'NO' END AS fault_word,
      {band_sql("(v.average * 100)", 14, 26, 5, 45)} AS average_class, {band_sql("c_temp", 15, 27, 5, 35)} AS temp_class
    FROM power_sites l JOIN (SELECT * FROM dehydrator QUALIFY row_number() OVER (PARTITION BY ip
      ORDER BY time DESC, event_id DESC) = 1) c ON c.ip = l.ip
    LEFT JOIN averages v ON v.ip = c.ip AND v.last_hour = c.c_life""",
)
def r5(spark, d):
    marked = changes.marked_changes(a.dehydrator_line(spark, d), "ip", "time", a.WATCHED, TIE, null_safe=False)
    now = runtime.latest_with_average(marked, "ip", "c_life", "time", TIE)
    return reports.dehydrator_board(now, a.power_sites(spark, d))


@query("r6_action_history", "ev", """SELECT controller, time, event_id, u, CAST(row_number() OVER w AS INTEGER) AS rank
    FROM ev WHERE event_type = 'error' WINDOW w AS (PARTITION BY controller ORDER BY time DESC, event_id DESC)
    QUALIFY row_number() OVER w <= 8""")
def r6(spark, d):
    actions = a.polls_base(spark, d).filter(a.is_type("error")).select("controller", "time", TIE, "u")
    return reports.action_history(actions, "controller", "time", 8, TIE)


@query("b1_band_by_table", "electro", f"""SELECT location, event_id, metric, value, CASE metric
      WHEN 'temp_akb' THEN {band_sql("value", 15, 27, 5, 35)} WHEN 'temp_sys' THEN {band_sql("value", 20, 40, 15, 45)}
      ELSE {band_sql("value", 53, 55, 47, 60)} END AS band
    FROM (SELECT location, event_id, 'temp_akb' AS metric, CAST(temp_akb AS DECIMAL(10,1)) AS value FROM electro
      UNION ALL SELECT location, event_id, 'temp_sys', CAST(temp_sys AS DECIMAL(10,1)) FROM electro
      UNION ALL SELECT location, event_id, 'battery', CAST(battery1v / 10.0 AS DECIMAL(10,1)) FROM electro)""")
def b1(spark, d):
    def number(c):
        return c.cast("decimal(10,1)")

    long = a.electro(spark, d).select(
        "location", TIE, number(F.col("temp_akb")).alias("temp_akb"), number(F.col("temp_sys")).alias("temp_sys"),
        number(F.col("battery1v") / 10).alias("battery"),
    ).unpivot(["location", TIE], ["temp_akb", "temp_sys", "battery"], "metric", "value")
    return bands.band(long, "value", bands.bands_frame(spark)).select("location", TIE, "metric", "value", "band")


@query("b2_site_band", "temp thresholds", """SELECT l.location, t.temperature, CASE WHEN temperature >= red THEN 'red'
      WHEN temperature >= yellow THEN 'yellow' WHEN temperature <= blue THEN 'blue' WHEN temperature IS NOT NULL
      THEN 'green' END AS class FROM thresholds l LEFT JOIN (SELECT location, arg_max(temperature, (time, event_id))
      AS temperature FROM temp GROUP BY location) t ON t.location = l.location""")
def b2(spark, d):
    now = current.latest(a.temp(spark, d), "location", "time", TIE).select("location", "temperature")
    joined = a.thresholds(spark, d).join(now, "location", "left")
    return joined.select("location", "temperature", bands.site_band("temperature", "blue", "yellow", "red").alias("class"))


@query("b3_alarm_class", "dehydrator", f"SELECT ip, event_id, {_flag('a_summ')} AS summary_class, "
       f"{_flag('a_faul')} AS fault_class FROM dehydrator")
def b3(spark, d):
    return a.dehydrator(spark, d).select(
        "ip", TIE, bands.flag_class("a_summ").alias("summary_class"), bands.flag_class("a_faul").alias("fault_class")
    )


@query("b4_room_class", "vent_events", """SELECT u, event_id, temp, CASE WHEN temp >= 26 THEN 'red' WHEN temp <= 22
    THEN 'green' WHEN temp IS NOT NULL THEN 'yellow' END AS class FROM vent_events""")
def b4(spark, d):
    return a.vent_events(spark, d).select("u", TIE, "temp", bands.room_class("temp").alias("class"))


@query("b5_switch_class", "cell_registry", """SELECT controller, cell, CASE WHEN "check" = 'do' THEN 'green' ELSE 'gray'
    END AS class FROM cell_registry""")
def b5(spark, d):
    return a.cell_registry(spark, d).select("controller", "cell", bands.switch_class("check", "do").alias("class"))


@query("b6_critical", "electro", f"""SELECT * FROM (SELECT location, time, event_id, temp_sys, temp_akb,
    {band_sql("temp_sys", 20, 40, 15, 45)} AS sys_class, {band_sql("temp_akb", 15, 27, 5, 35)} AS akb_class
    FROM electro) WHERE sys_class = 'red' OR akb_class = 'red'""")
def b6(spark, d):
    rows = a.electro(spark, d).select("location", "time", TIE, "temp_sys", "temp_akb")
    rows = rows.withColumn("sys_class", bands.metric_band("temp_sys", "temp_sys"))
    rows = rows.withColumn("akb_class", bands.metric_band("temp_akb", "temp_akb"))
    return bands.critical(rows, "sys_class", "akb_class")


@query("t1_by_address", "equipment", f"SELECT *, {IP_ORDER} AS ip_order FROM equipment ORDER BY ip_order")
def t1(spark, d):
    return a.equipment(spark, d).withColumn("ip_order", ip_key("ip")).orderBy("ip_order")


@query("t2_by_owner", "power_sites", "SELECT * FROM power_sites ORDER BY own DESC, ip")
def t2(spark, d):
    return a.power_sites(spark, d).orderBy(F.col("own").desc(), "ip")


@query("t3_by_time", "temp", "SELECT location, date_trunc('second', time) AS shown_at, temperature FROM temp ORDER BY time")
def t3(spark, d):
    from pulsebook.functions.timecols import to_second

    ordered = a.temp(spark, d).orderBy("time")
    return ordered.select("location", to_second("time").alias("shown_at"), "temperature")


@query("t4_ten_newest", "ping_changes", """SELECT * FROM (SELECT * FROM ping_changes ORDER BY time DESC, event_id DESC
    LIMIT 10) ORDER BY time, event_id""")
def t4(spark, d):
    top = current.first_n_overall(_ping_changes(spark, d), [F.col("time").desc(), F.col(TIE).desc()], 10)
    return top.orderBy("time", TIE)


@query("t8_by_position", "thresholds", "SELECT * FROM thresholds ORDER BY id")
def t8(spark, d):
    return a.thresholds(spark, d).orderBy("id")


@query("s15_stamped_board", "ping equipment", """SELECT e.ip, e.name, c.state, TIMESTAMP '2024-01-31' AS as_of,
    '31.01.2024' AS shown_date FROM equipment e JOIN (SELECT ip, arg_max(state, (time, event_id)) AS state FROM ping
    GROUP BY ip) c ON e.ip = c.ip""")
def s15(spark, d):
    now = current.latest(a.ping(spark, d), "ip", "time", TIE).select("ip", "state")
    board = a.equipment(spark, d).select("ip", "name").join(now, "ip")
    return board.withColumn("as_of", ntz(a.AS_OF)).withColumn("shown_date", dotted_date("as_of"))


@query("r5_average_journal", "hours_seen", "SELECT ip, count(*) AS hours FROM hours_seen GROUP BY ip")
def r5_hours(spark, d):
    return dehydrator_journal(spark, d).groupBy("ip").agg(F.count_distinct("c_life").alias("hours"))
