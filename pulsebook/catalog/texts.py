"""Extraction from texts that Spark renders from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsebook.catalog import query
from pulsebook.functions.timecols import dotted_date, clock, file_day, stamp
from pulsebook.operators import cells
from pulsebook.plans import adapters as a
from pulsebook.session import work_folder
from pulsebook.sources import logs, registries, replies

TIE = "event_id"


@query("s1_registry", "equipment", r"""SELECT ip, concat('"', name, '"') AS name, description,
    CASE WHEN description <> 'MACHINERY' THEN coalesce(visio_name, '') END AS visio_name
    FROM equipment WHERE location NOT IN ('NATION_1', 'NATION_2')""")
def s1(spark, d):
    mark = F.when(F.col("location") == "NATION_1", "#").when(F.col("location") == "NATION_2", "//").otherwise("")
    name = F.concat(F.lit('"'), F.col("name"), F.lit('"'))
    short = F.concat_ws("|", F.concat(mark, F.col("ip")), name, F.col("description"))
    full = F.concat_ws("|", short, F.coalesce("visio_name", F.lit("")))
    lines = a.equipment(spark, d).select(F.when(F.col("description") == "MACHINERY", short).otherwise(full).alias("value"))
    return registries.parse_registry(lines)


@query("s2_cell_registry", "cell_registry", 'SELECT * FROM cell_registry')
def s2(spark, d):
    lines = a.cell_registry(spark, d).select(
        F.concat(F.col("cell").cast("string"), F.lit("\t"), F.col("check")).alias("value"),
        F.concat(F.lit("/srv/"), F.col("controller"), F.lit("/cells.txt")).alias("folder"),
    )
    return registries.parse_cell_registry(lines)


@query("s3_cell_log", "cell_log", "SELECT controller, log_date, line_no, line FROM cell_log")
def s3(spark, d):
    path = F.concat(F.lit("/tmp/"), F.col("controller"), F.lit("/"), file_day("log_date"), F.lit(".log"))
    files = a.cell_log(spark, d).withColumn("path", path).drop("controller", "log_date")
    return logs.with_log_place(files, "path").select("controller", "log_date", "line_no", "line")


def landed_log(spark, d):
    """The controllers' logs as text files."""
    folder = work_folder(spark, "cell-logs")
    logs.write_cell_log(a.cell_log(spark, d), folder, "line_no")
    return logs.read_cell_log(spark, f"{folder}/*/*.log")


@query("s3_read_cell_log", "cell_log", "SELECT controller, log_date, line FROM cell_log")
def s3_read(spark, d):
    return landed_log(spark, d).drop("line_no")


@query("a5_status_from_text", "cell_status", "SELECT * FROM cell_status")
def a5_text(spark, d):
    return cells.cell_status(landed_log(spark, d), a.cell_registry(spark, d))


def transcripts(base):
    """Device replies: no hours line on signup, no summary line on purchase, two spacings."""
    end = F.lit(replies.ESCAPE)

    def line(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts], end)

    t, k = F.col("t"), F.col("k")

    def alarm(name, raised):
        return line(name, " ALARM = ", F.when(raised, "FAIL").otherwise("OK"))

    gap = F.when(t % 2 == 0, " ").otherwise("  ")
    reply = F.concat(
        F.when(a.is_type("purchase"), "").otherwise(alarm("SUMMARY", a.is_type("error"))),
        alarm("EXCESSIVE RUN TIME", a.is_type("click")), alarm("HIGH PRESSURE", a.is_type("view")),
        alarm("LOW PRESSURE", t % 3 == 0), alarm("HIGH HUMIDITY", t % 5 == 0), alarm("COMPR FAULT", t % 7 == 0),
        F.when(a.is_type("signup"), "").otherwise(line("Current Compressor life:", gap, t + 1, " Hours > 0")),
        line("temp = ", t % 45, "C"), line("high pressure = ", t % 20, " psi >= 0"),
        line("low pressure = ", k % 9, ".", t % 10, "  psi >= 0"), line("humidity = ", k % 50, ".", t % 10, "% >= 0"),
    )
    return base.select("ip", "time", TIE, reply.alias("reply"))


@query("s4_dehydrator_reply", "ev", """SELECT ip, time, event_id, CAST(t + 1 AS SMALLINT) AS c_life,
    CAST(t % 45 AS SMALLINT) AS c_temp, CAST(t % 20 AS SMALLINT) AS c_high, CAST((k % 9) * 10 + t % 10 AS SMALLINT)
    AS c__low, CAST((k % 50) * 10 + t % 10 AS SMALLINT) AS c_humi, event_type IN ('purchase', 'error') AS a_summ,
    event_type = 'click' AS a_exrt, event_type = 'view' AS a_high, t % 3 = 0 AS a__low, t % 5 = 0 AS a_humi,
    t % 7 = 0 AS a_faul FROM ev WHERE event_type <> 'signup'""")
def s4(spark, d):
    return replies.extract_dehydrator(transcripts(a.polls_base(spark, d))).drop("reply")


METRICS = ["temp_sys", "temp_akb", "alarm_mains", "out_volt", "out_ampr", "out_watt", "battery1v", "battery2v"]


@query("s5_snmp_reply", "electro", """SELECT location, time, temp_sys, temp_akb, alarm_mains, out_volt, out_ampr,
    out_watt, battery1v, battery2v FROM electro WHERE alarm_mains <> 1""")
def s5(spark, d):
    long = a.electro(spark, d).unpivot(["location", "time", TIE], METRICS, "metric", "value")
    lost = (F.col("metric") == "alarm_mains") & (F.col("value") == 1)
    line = F.when(lost, "Timeout: No Response from 1.2.3.4").otherwise(
        F.concat(F.lit("iso.3.6.1.4.1 = INTEGER: "), F.col("value").cast("string"))
    )
    lines = long.select("location", "time", TIE, "metric", line.alias("line"))
    return replies.extract_snmp(lines, ["location", "time", TIE], "metric", "line", METRICS).drop(TIE)


@query("s6_weather_page", "", """SELECT page_id, url, CAST(page_id % 60 - 30 AS INTEGER) AS temperature FROM pages
    WHERE url LIKE '%ref=x%'""")
def s6(spark, d):
    c = (F.col("page_id") % 60 - 30).cast("string")
    widget = F.concat(F.lit('{"temperature":{"air":{"C":'), c, F.lit('.7,"F":0}}}'))
    page = F.when(F.col("url").contains("ref=x"), F.concat(F.col("html"), widget)).otherwise(F.col("html"))
    pages = a.table(spark, d, "pages").select("page_id", "url", page.alias("html"))
    return replies.extract_weather(pages).drop("html")


@query("s7_sensor_reply", "ev", """SELECT event_id, CASE WHEN event_type <> 'error' THEN
    CAST(t AS DECIMAL(5,1)) + CAST((k % 10) / 10.0 AS DECIMAL(2,1)) END::DECIMAL(5,1) AS temperature FROM ev""")
def s7(spark, d):
    text = F.when(a.is_type("error"), "Failed to get reading. Try again!").otherwise(
        F.concat_ws(".", F.col("t"), F.col("k") % 10)
    )
    return replies.extract_sensor(a.polls_base(spark, d).select(TIE, text.alias("reply"))).drop("reply")


@query("s7_room_sensor_reply", "ev", "SELECT event_id, t - 1 AS temperature FROM ev WHERE event_type <> 'error'")
def s7_room(spark, d):
    text = F.when(a.is_type("error"), "no data").otherwise(F.concat(F.lit("Temp = "), F.col("t").cast("string"), F.lit(" C")))
    return replies.extract_room_sensor(a.polls_base(spark, d).select(TIE, text.alias("reply"))).drop("reply")


@query("s8_ping_reply", "ev", "SELECT event_id, event_type <> 'error' AS received FROM ev")
def s8(spark, d):
    n = F.when(a.is_type("error"), "0").otherwise("1")
    text = F.concat(F.lit("1 packets transmitted, "), n, F.lit(" received, 0% packet loss"))
    return replies.extract_ping(a.polls_base(spark, d).select(TIE, text.alias("reply"))).drop("reply")


@query("s9_action_log", "ev", """SELECT event_id, CASE WHEN event_type <> 'signup' THEN date_trunc('second', time) END
    AS time, CASE WHEN event_type <> 'signup' THEN CAST(u AS INTEGER) END AS cell, CASE event_type WHEN 'error' THEN
    'Перезагрузка КБС' WHEN 'signup' THEN NULL ELSE 'Перезапуск g2' END AS action FROM ev""")
def s9_actions(spark, d):
    action = F.when(a.is_type("error"), logs.REBOOT_TEXT).otherwise(logs.RESTART_TEXT)
    number = F.when(a.is_type("click"), "229 ").otherwise("")
    line = F.concat(
        dotted_date("time", short=True), F.lit(" "), clock("time"), F.lit(" - "), number,
        F.lit("Отключилась Cell "), F.col("u").cast("string"), F.lit("; "), action,
    )
    lines = a.polls_base(spark, d).select(TIE, F.when(a.is_type("signup"), "").otherwise(line).alias("line"))
    return logs.parse_action_log(lines).drop("line")


@query("s9_process_log", "ev", """SELECT event_id, CASE WHEN event_type = 'error' THEN date_trunc('second', time) END
    AS time, strftime(time, '%H:%M:%S') AS clock, CASE WHEN event_type = 'error' THEN 60 END AS code_line,
    CASE WHEN event_type = 'signup' THEN '' ELSE 'НОРМА' END AS message FROM ev""")
def s9_process(spark, d):
    text = F.when(a.is_type("signup"), "").otherwise("НОРМА")
    old = F.concat(dotted_date("time", short=True), F.lit(" "), clock("time"), F.lit(" - 60 "), text)
    new = F.concat(clock("time"), F.lit(" - "), text)
    lines = a.polls_base(spark, d).select(TIE, F.when(a.is_type("error"), old).otherwise(new).alias("line"))
    return logs.parse_process_log(lines).drop("line")


@query("s9_vent_log", "ev", """SELECT event_id, CASE WHEN event_type <> 'signup' THEN date_trunc('second', time) END AS time,
    CASE WHEN event_type = 'view' THEN 'ON' END AS v1, CASE WHEN event_type = 'signup' THEN NULL
    WHEN event_type IN ('view', 'click') THEN 'OFF' ELSE 'ON' END AS v5, CASE WHEN event_type <> 'signup' THEN t END
    AS temp, CASE WHEN event_type <> 'signup' THEN 'ON' END AS auto FROM ev""")
def s9_vent(spark, d):
    tail = F.concat(F.lit("температура: "), F.col("t").cast("string"), F.lit(" / автоматика: ON"))
    word = F.when(a.is_type("click"), "выключена").otherwise(logs.VENT_ON_WORD)
    auto = F.concat(stamp("time"), F.lit(" / "), word, F.lit(" / "), tail)
    hand = F.concat(stamp("time"), F.lit(" | VENTILATION_V1_ON | VENTILATION_V5_OFF |/ "), tail)
    line = F.when(a.is_type("signup"), "broken line").when(a.is_type("view"), hand).otherwise(auto)
    return logs.parse_vent_log(a.polls_base(spark, d).select(TIE, line.alias("line"))).drop("line")
