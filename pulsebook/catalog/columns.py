"""Column-level operators: decodes, predicates, functions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from pulsebook.catalog import query
from pulsebook.functions import timecols as tc
from pulsebook.functions import values as v
from pulsebook.operators import changes
from pulsebook.plans import adapters as a

TIE = "event_id"


@query("p1_state_words", "ev", """SELECT event_id, CASE WHEN event_type = 'signup' THEN 'NULL'
    WHEN event_type <> 'error' THEN 'PING_OK' ELSE 'PING_NO' END AS state FROM ev""")
def p1(spark, d):
    state = F.when(~a.is_type("signup"), ~a.is_type("error"))
    return a.polls_base(spark, d).select(TIE, v.state_word(state).alias("state"))


@query("p2_null_word", "equipment", "SELECT ip, coalesce(nullif(visio_name, ''), 'NULL') AS visio_name FROM equipment")
def p2(spark, d):
    return a.equipment(spark, d).select("ip", v.text_or_null_word("visio_name").alias("visio_name"))


@query("p3_event_words", "ping_changes", """SELECT event_id, CASE WHEN state THEN 'восстановился' ELSE 'пропал' END
    AS event, CASE WHEN state THEN 'green_log' ELSE 'red_log' END AS event_class FROM ping_changes""")
def p3(spark, d):
    journal = changes.changes(a.ping(spark, d), "ip", "time", ["state"], TIE)
    return journal.select(TIE, v.event_word("state").alias("event"), v.event_class("state").alias("event_class"))


@query("p4_mains", "electro", """SELECT event_id, CASE alarm_mains WHEN 0 THEN 'Есть 380' WHEN 1 THEN 'Нет  380' END
    AS mains FROM electro""")
def p4(spark, d):
    return a.electro(spark, d).select(TIE, v.mains_word("alarm_mains").alias("mains"))


@query("p5_alarm", "ev", """SELECT event_id, NOT coalesce(CASE event_type WHEN 'error' THEN ' FAULT' WHEN 'signup'
    THEN NULL ELSE ' OK' END LIKE '%OK%', false) AS raised FROM ev""")
def p5(spark, d):
    reply = F.when(a.is_type("error"), " FAULT").when(~a.is_type("signup"), " OK")
    return a.polls_base(spark, d).select(TIE, v.alarm_raised(reply).alias("raised"))


@query("p7_comment_lines", "", """SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT starts_with(
    CASE l_returnflag WHEN 'A' THEN '#' WHEN 'N' THEN '//' ELSE '/' END, '#') AND NOT starts_with(
    CASE l_returnflag WHEN 'A' THEN '#' WHEN 'N' THEN '//' ELSE '/' END, '//')""")
def p7(spark, d):
    line = F.concat(
        F.when(F.col("l_returnflag") == "A", "#").when(F.col("l_returnflag") == "N", "//").otherwise("/"),
        F.col("l_orderkey").cast("string"),
    )
    rows = a.table(spark, d, "lineitem").filter(~v.is_comment(line))
    return rows.select("l_orderkey", "l_linenumber")


@query("p8_one_owner", "power_sites", "SELECT * FROM power_sites WHERE own = 'NATION_3'")
def p8(spark, d):
    return a.power_sites(spark, d).filter(F.col("own") == "NATION_3")


@query("p10_day_window", "temp",
       "SELECT * FROM temp WHERE time BETWEEN TIMESTAMP '2024-01-19' AND TIMESTAMP '2024-01-20 12:00:00'")
def p10(spark, d):
    return a.temp(spark, d).filter(tc.day_window("time", datetime(2024, 1, 20, 12)))


@query("p11_null_safe_changes", "temp_gaps", """SELECT * FROM temp_gaps WINDOW w AS (PARTITION BY location
    ORDER BY time, event_id) QUALIFY row_number() OVER w > 1 AND temperature IS DISTINCT FROM lag(temperature) OVER w""")
def p11(spark, d):
    return changes.changes(a.temp_gaps(spark, d), "location", "time", ["temperature"], TIE)


@query("p13_plain_changes", "temp_gaps", """SELECT * FROM temp_gaps WINDOW w AS (PARTITION BY location
    ORDER BY time, event_id) QUALIFY row_number() OVER w > 1 AND temperature <> lag(temperature) OVER w""")
def p13(spark, d):
    return changes.changes(a.temp_gaps(spark, d), "location", "time", ["temperature"], TIE, null_safe=False)


@query("p14_day_hour", "electro", """SELECT location, time, temp_sys FROM electro WHERE CAST(time AS DATE) =
    DATE '2024-01-15' AND hour(time) = 3""")
def p14(spark, d):
    x = a.electro(spark, d).select("location", "time", "temp_sys")
    return x.filter(tc.day_hour("time", date(2024, 1, 15), 3))


@query("f_time_functions", "ev", """SELECT event_id, date_trunc('second', time) AS f1_second,
    CAST(hour(time) AS INTEGER) AS f2_hour, CAST(time AS DATE) AS f3_date, strftime(time, '%Y-%m-%d') AS f3_text,
    TIMESTAMP '2024-01-31' AS f4_as_of, time - INTERVAL 1 DAY AS f5_day_before,
    date_diff('microsecond', time, TIMESTAMP '2024-01-31') AS f5_age_us,
    date_diff('microsecond', time, TIMESTAMP '2024-01-31') / 86400000000.0::DOUBLE AS f6_days,
    strftime(time, '%d.%m.%Y') AS f7_long, strftime(time, '%d.%m.%y') AS f7_short, strftime(time, '%H:%M:%S') AS f7_clock,
    strftime(time, '%y%m%d') AS f7_file, strftime(time, '%Y-%m-%d_%H:%M:%S') AS f7_stamp,
    CAST(CAST(time AS DATE) - 5 AS DATE) AS f8_five_days_before FROM ev""")
def f_time(spark, d):
    t = F.col("time")
    as_of = tc.ntz(a.AS_OF)
    return a.polls_base(spark, d).select(
        TIE, tc.to_second(t).alias("f1_second"), F.hour(t).alias("f2_hour"), F.to_date(t).alias("f3_date"),
        tc.dashed_date(t).alias("f3_text"), as_of.alias("f4_as_of"),
        F.timestamp_add("DAY", F.lit(-1), t).alias("f5_day_before"), tc.elapsed_us(t, as_of).alias("f5_age_us"),
        (tc.elapsed_us(t, as_of) / F.lit(float(tc.DAY_US))).alias("f6_days"), tc.dotted_date(t).alias("f7_long"),
        tc.dotted_date(t, short=True).alias("f7_short"), tc.clock(t).alias("f7_clock"),
        tc.file_day(t).alias("f7_file"), tc.stamp(t).alias("f7_stamp"),
        F.date_sub(F.to_date(t), 5).alias("f8_five_days_before"),
    )


@query("n_numeric_functions", "ev thresholds", """SELECT event_id, CAST(t / 7.0 AS DECIMAL(6,2)) AS n1_numeric,
    CAST(round(CAST(t + k / 100.0 AS DECIMAL(10,2)) + correction) AS INTEGER) AS n2_corrected,
    CASE WHEN type = 11 THEN replace(CAST(CAST(t + correction AS DECIMAL(10,1)) AS VARCHAR), '.0', '')
      ELSE CAST(CAST(t + correction AS DECIMAL(10,1)) AS VARCHAR) END AS n2_text,
    CAST(round(CAST(k / 100.0 AS DECIMAL(10,2)) * 10) AS SMALLINT) AS n3_tenths,
    CAST(t / 10.0 AS DECIMAL(4,1)) AS n4_from_tenths, CAST(CAST(k / 100.0 AS DECIMAL(4,1)) AS VARCHAR) AS n5_leading_zero,
    t AS n6_whole, abs(t - k) < 5 AS n7_strict, abs(t - k) <= 5 AS n7_inclusive, CAST(t * 100 // 1000 AS INTEGER)
    AS n8_from_milli, 1.0::DOUBLE / nullif(t, 0) AS n9_inverse, t * 100 AS n10_hundredfold
    FROM ev JOIN thresholds USING (location)""")
def n_numbers(spark, d):
    t, k = F.col("t"), F.col("k")
    reg = a.thresholds(spark, d).select("location", "correction", "type")
    cents = (k / F.lit(100).cast("decimal(5,0)")).cast("decimal(10,2)")
    return a.polls_base(spark, d).join(reg, "location").select(
        TIE, (t / F.lit(7).cast("decimal(3,0)")).cast("decimal(6,2)").alias("n1_numeric"),
        v.corrected((t + cents).cast("decimal(10,2)"), "correction").alias("n2_corrected"),
        v.corrected_text(t, "correction", "type").alias("n2_text"), v.tenths(cents).alias("n3_tenths"),
        v.from_tenths(t).alias("n4_from_tenths"), cents.cast("decimal(4,1)").cast("string").alias("n5_leading_zero"),
        v.whole_part(F.concat_ws(".", t, k)).alias("n6_whole"), v.within(t, k, 5).alias("n7_strict"),
        v.within(t, k, 5, inclusive=True).alias("n7_inclusive"), v.from_milli(t * 100).alias("n8_from_milli"),
        v.inverse(t).alias("n9_inverse"), (t * 100).alias("n10_hundredfold"),
    )


@query("g_text_functions", "", r"""SELECT doc_id, split_part(text, ' ', 3) AS g1_third, replace(text, ' ', '') AS g2_no_spaces,
    replace(text, ' ', '_') AS g2_joined, contains(text, 'the') AS g3_contains,
    regexp_matches(text, '[0-9]{2}') AS g3_pattern, starts_with(text, 'The') AS g4_prefix,
    replace(text, 'a', '-') AS g5_replaced, concat(lang, ': ', source) AS g6_concat,
    replace('site = [location]', '[location]', source) AS g7_template,
    CASE WHEN n_chars > 1000 THEN 'long' WHEN n_chars > 100 THEN 'middle' ELSE 'short' END AS g8_case FROM documents""")
def g_text(spark, d):
    text = F.col("text")
    return a.table(spark, d, "documents").select(
        "doc_id", F.coalesce(v.nth_field(text, " ", 3), F.lit("")).alias("g1_third"),
        v.without_spaces(text).alias("g2_no_spaces"), v.spaces_joined(text).alias("g2_joined"),
        text.contains("the").alias("g3_contains"), text.rlike("[0-9]{2}").alias("g3_pattern"),
        text.startswith("The").alias("g4_prefix"), F.replace(text, F.lit("a"), F.lit("-")).alias("g5_replaced"),
        F.concat("lang", F.lit(": "), "source").alias("g6_concat"),
        F.replace(F.lit("site = [location]"), F.lit("[location]"), F.col("source")).alias("g7_template"),
        F.when(F.col("n_chars") > 1000, "long").when(F.col("n_chars") > 100, "middle").otherwise("short").alias("g8_case"),
    )
