"""Order-dependent operators: journals, latches, counters, folds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pulsebook.catalog import query, split_form
from pulsebook.functions.values import ip_key, state_word
from pulsebook.operators import cells, changes, current, escalation, folds, latch, runtime, snapshot, watch
from pulsebook.operators.passes import written
from pulsebook.plans import adapters as a

TIE = "event_id"


@query("w1_ping_changes", "ping_changes", "SELECT * FROM ping_changes")
def w1_ping(spark, d):
    return changes.changes(a.ping(spark, d), "ip", "time", ["state"], TIE)


@query(
    "w1_electro_changes", "electro",
    """SELECT location, time, event_id, temp_sys, temp_akb FROM electro WINDOW w AS (PARTITION BY location ORDER BY time, event_id)
    QUALIFY row_number() OVER w > 1
    AND (temp_sys <> lag(temp_sys) OVER w OR temp_akb <> lag(temp_akb) OVER w)""",
)
def w1_electro(spark, d):
    e = a.electro(spark, d).select("location", "time", TIE, "temp_sys", "temp_akb")
    return changes.changes(e, "location", "time", ["temp_sys", "temp_akb"], TIE)


@query("w2_dehydrator_changes", "dehydrator_changes", "SELECT * FROM dehydrator_changes")
def w2(spark, d):
    return dehydrator_journal(spark, d)


@query(
    "w3_temp_within", "temp",
    """SELECT * FROM temp WINDOW w AS (PARTITION BY location ORDER BY time, event_id) QUALIFY abs(temperature - lag(temperature) OVER w) < 5 AND temperature <> lag(temperature)
    OVER w""",
)
def w3(spark, d):
    return changes.changes_within(a.temp(spark, d), "location", "time", "temperature", 5, tie=TIE)


@query(
    "p15_exempt_source", "temp",
    """SELECT * FROM temp WINDOW w AS (PARTITION BY location ORDER BY time, event_id)
    QUALIFY temperature <> lag(temperature) OVER w
    AND (abs(temperature - lag(temperature) OVER w) < 5 OR location = 'loc-0')""",
)
def p15(spark, d):
    return changes.changes_within(
        a.temp(spark, d), "location", "time", "temperature", 5, F.col("location") == a.EXEMPT, TIE
    )


@query(
    "w4_accept_within", "temp",
    """WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY location ORDER BY time, event_id) AS rn FROM temp),
    walk AS (
      SELECT location, time, event_id, temperature, rn, temperature AS last, true AS keep FROM numbered WHERE rn = 1
      UNION ALL
      SELECT n.location, n.time, n.event_id, n.temperature, n.rn,
        CASE WHEN abs(n.temperature - w.last) <= 10 THEN n.temperature ELSE w.last END,
        abs(n.temperature - w.last) <= 10
      FROM walk w JOIN numbered n ON n.location = w.location AND n.rn = w.rn + 1)
    SELECT location, time, event_id, temperature FROM walk WHERE keep""",
    recursive=True,
)
def w4(spark, d):
    return folds.accept_within(a.temp(spark, d), "location", "time", "temperature", 10, TIE)


@query(
    "w5_carry_forward", "temp_gaps",
    """SELECT location, time, event_id, last_value(temperature IGNORE NULLS) OVER (PARTITION BY location
    ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS temperature FROM temp_gaps""",
)
def w5(spark, d):
    return changes.carry_forward(a.temp_gaps(spark, d), "location", "time", "temperature", TIE)


LATCHED = """SELECT location, time, event_id, temperature, coalesce(last_value(CASE WHEN temperature > 26 THEN 'ON'
    WHEN temperature < 22 THEN 'OFF' END IGNORE NULLS) OVER (PARTITION BY location ORDER BY time, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'OFF') AS state FROM temp"""


@query("w6_latch", "temp", LATCHED)
def w6(spark, d):
    return latch.latch(a.temp(spark, d), "location", "time", "temperature", 26, 22, tie=TIE)


def power_report_rows(spark, d):
    """Current temperatures of every site under its owner, in address order."""
    now = current.latest(a.electro(spark, d).select("location", "time", TIE, "temp_sys"), "location", "time", TIE)
    rows = a.power_sites(spark, d).join(now, "location").select("ip", "location", "own", "temp_sys")
    return rows.withColumn("ip_order", ip_key("ip"))


def site_order(spark, d):
    return a.power_sites(spark, d).select(ip_key("ip").alias("ip_order"))


RUNS = """WITH cur AS (SELECT location, arg_max(temp_sys, (time, event_id)) AS temp_sys FROM electro GROUP BY location),
    rows_ AS (SELECT ip, location, own, temp_sys, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216
      + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536 + CAST(split_part(ip, '.', 3) AS BIGINT) * 256
      + CAST(split_part(ip, '.', 4) AS BIGINT) AS ip_order FROM power_sites JOIN cur USING (location)),
    marked AS (SELECT *, CASE WHEN own IS DISTINCT FROM coalesce(lag(own) OVER (ORDER BY ip_order),
      (SELECT arg_max(own, ip_order) FROM rows_)) THEN 1 ELSE 0 END AS moved FROM rows_)
    SELECT ip, location, own, temp_sys, ip_order, CAST(sum(moved) OVER (ORDER BY ip_order) AS INTEGER) AS run FROM marked"""


@query("w7_run_index", "electro power_sites", RUNS)
def w7(spark, d):
    return folds.run_index(power_report_rows(spark, d), "ip_order", "own", like=site_order(spark, d))


@query(
    "a9_run_index_plain", "electro power_sites",
    RUNS.replace("(SELECT arg_max(own, ip_order) FROM rows_)", "own"),
)
def a9(spark, d):
    return folds.run_index(power_report_rows(spark, d), "ip_order", "own", wrap=False, like=site_order(spark, d))


def watched(spark, d):
    """Every poll with its failing stations, from the log lines: one row per poll, written once."""
    polls = a.watch_polls(spark, d)
    read = watch.seen_events(cells.cell_events(a.watch_log(spark, d)), polls)
    return written(watch.first_failing_steps(read, a.watch_registry(spark, d), polls), "watched")


@query(
    "w8_patience", "watch_off",
    """WITH first_failing AS (SELECT controller, time, off[1].cell AS cell FROM watch_off),
    marked AS (SELECT *, sum(CASE WHEN cell IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY controller
      ORDER BY time) AS resets FROM first_failing)
    SELECT controller, time, cell, CAST(row_number() OVER (PARTITION BY controller, resets, cell ORDER BY time)
      AS BIGINT) AS counter FROM marked WHERE cell IS NOT NULL""",
)
def w8(spark, d):
    first = watched(spark, d).select("controller", "time", watch.first_failing_cell().alias("cell"))
    return escalation.patience_counters(first, "controller", "time", "cell")


ESCALATION = """WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY controller ORDER BY time) AS rn FROM watch_off),
    step AS (
      SELECT controller, CAST(0 AS BIGINT) AS rn, CAST(NULL AS TIMESTAMP) AS time, CAST(NULL AS INTEGER) AS cell,
        MAP([CAST(-1 AS INTEGER)], [0]) AS counts, false AS again, CAST(NULL AS DATE) AS lock, CAST(NULL AS DATE) AS floor,
        CAST(NULL AS TIMESTAMP) AS resume, CAST(NULL AS VARCHAR) AS action
      FROM (SELECT DISTINCT controller FROM watch_off)
      UNION ALL
      SELECT controller, rn, time, cell,
        CASE WHEN paused THEN counts WHEN cell IS NULL OR fires THEN MAP([CAST(-1 AS INTEGER)], [0])
          ELSE map_concat(counts, MAP([cell], [n])) END,
        CASE WHEN paused THEN again WHEN cell IS NULL THEN false WHEN fires THEN NOT again ELSE again END,
        CASE WHEN fires AND again THEN CAST(time AS DATE) ELSE lock END,
        CASE WHEN paused THEN floor WHEN fires THEN NULL WHEN cell IS NULL THEN CAST(time AS DATE) ELSE memory END,
        CASE WHEN paused THEN resume WHEN fires AND again THEN time + INTERVAL 10800 SECOND
          WHEN fires THEN time + INTERVAL 5400 SECOND ELSE NULL END,
        CASE WHEN fires AND again THEN 'reboot' WHEN fires THEN 'restart' END
      FROM (SELECT *, NOT paused AND cell IS NOT NULL AND n > 2 AND lock IS DISTINCT FROM CAST(time AS DATE) AS fires
        FROM (SELECT *, coalesce(counts[cell], 0) + 1 AS n
          FROM (SELECT *, list_filter(off, lambda x: x.since >= memory)[1].cell AS cell
            FROM (SELECT s.controller, p.rn, p.time, p.off, s.counts, s.again, s.lock, s.resume, s.floor,
                coalesce(s.floor, CAST(p.time AS DATE)) AS memory, coalesce(p.time < s.resume, false) AS paused
              FROM step s JOIN numbered p ON p.controller = s.controller AND p.rn = s.rn + 1)))))
    SELECT controller, time, cell, action, CASE action WHEN 'reboot' THEN 10800 ELSE 5400 END AS pause_s
    FROM step WHERE action IS NOT NULL"""


@query("w9_escalation", "watch_off", ESCALATION, recursive=True)
def w9(spark, d):
    return escalation.escalate_watch(watched(spark, d), "controller", "time", patience=2, waits=(5400, 10800))


@query(
    "w10_outages", "ping",
    """WITH edges AS (SELECT * FROM ping WINDOW w AS (PARTITION BY ip ORDER BY time, event_id)
      QUALIFY state <> coalesce(lag(state) OVER w, true)),
    paired AS (SELECT *, lead(time) OVER (PARTITION BY ip ORDER BY time, event_id) AS next FROM edges)
    SELECT ip, time AS lost, next AS restored, date_diff('microsecond', time, next) AS outage_us
    FROM paired WHERE NOT state""",
)
def w10(spark, d):
    return changes.outages(a.ping(spark, d), "ip", "time", "state", TIE)


@query(
    "w11_snapshot_diff", "ping",
    """WITH old AS (SELECT ip, CASE WHEN arg_max(state, (time, event_id)) THEN 'PING_OK' ELSE 'PING_NO' END AS s
      FROM ping WHERE time <= TIMESTAMP '2024-01-15' GROUP BY ip),
    new AS (SELECT ip, CASE WHEN arg_max(state, (time, event_id)) THEN 'PING_OK' ELSE 'PING_NO' END AS s
      FROM ping GROUP BY ip)
    SELECT ip, coalesce(old.s, 'PING_OK') AS old_state, new.s AS new_state FROM new LEFT JOIN old USING (ip)
    WHERE new.s <> coalesce(old.s, 'PING_OK')""",
)
def w11(spark, d):
    p = a.ping(spark, d)
    before = current.latest(p.filter(F.col("time") <= F.lit("2024-01-15").cast("timestamp_ntz")), "ip", "time", TIE)
    after = current.latest(p, "ip", "time", TIE)
    return changes.snapshot_diff(
        before.withColumn("state", state_word("state")), after.withColumn("state", state_word("state")),
        "ip", "state", "PING_OK",
    )


@query(
    "w11_state_changes", "ping_prev",
    """SELECT ip, time, event_id, CASE WHEN state THEN 'PING_OK' ELSE 'PING_NO' END AS state FROM ping_prev
    WHERE state <> coalesce(prev, true)""",
)
def w11_stream(spark, d):
    p = a.ping(spark, d).withColumn("state", state_word("state"))
    return changes.state_changes(p, "ip", "time", "state", "PING_OK", TIE)


MANUAL = """WITH carried AS (SELECT *, coalesce(last_value(CASE cmd WHEN 'auto_on' THEN 'ON' WHEN 'auto_off' THEN 'OFF'
      END IGNORE NULLS) OVER w, 'OFF') AS auto, last_value(temp IGNORE NULLS) OVER w AS held FROM vent_events
      WINDOW w AS (PARTITION BY u ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    asked AS (SELECT *, CASE WHEN auto = 'ON' AND held > 26 THEN 'ON' WHEN auto = 'ON' AND held < 22 THEN 'OFF'
      WHEN cmd = 'v5_on' THEN 'ON' WHEN cmd = 'v5_off' THEN 'OFF' END AS candidate FROM carried),
    states AS (SELECT u, time, event_id, held AS temp, cmd, auto, coalesce(last_value(candidate IGNORE NULLS) OVER (PARTITION BY u
      ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'OFF') AS state FROM asked)
    """


def _with_commands(spark, d):
    return latch.latch_line(a.vent_events(spark, d), "u", "time", "temp", "cmd", tie=TIE)


@query("w12_latch_with_commands", "vent_events", MANUAL + "SELECT * FROM states")
def w12(spark, d):
    return _with_commands(spark, d).rows()


@query(
    "w13_switch_journal", "vent_events",
    MANUAL + "SELECT * FROM states QUALIFY state <> lag(state) OVER (PARTITION BY u ORDER BY time, event_id)",
)
def w13(spark, d):
    return latch.switch_journal(_with_commands(spark, d), "u", "time", "state", TIE)


@query(
    "w14_counter_transitions", "dehydrator",
    """SELECT ip, time, event_id, c_life FROM dehydrator QUALIFY c_life <> lag(c_life) OVER (PARTITION BY ip
    ORDER BY time, event_id)""",
)
def w14(spark, d):
    x = a.dehydrator_line(spark, d).select("ip", "time", TIE, "c_life")
    return changes.changes(x, "ip", "time", ["c_life"], TIE, null_safe=False)


@query(
    "w15_daily_status", "cell_log cell_registry",
    r"""WITH days AS (SELECT controller, CAST(regexp_extract(line, 'cell (\d+)', 1) AS INTEGER) AS cell, log_date,
      arg_max(CASE WHEN line LIKE '%  off' THEN 'off' WHEN line LIKE '%  on' THEN 'on' END, line_no)
        FILTER (WHERE line LIKE '%  off' OR line LIKE '%  on') AS event
      FROM cell_log WHERE line LIKE 'cell %' GROUP BY ALL),
    held AS (SELECT controller, cell, log_date, last_value(event IGNORE NULLS) OVER (PARTITION BY controller, cell
      ORDER BY log_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS closing FROM days
      SEMI JOIN cell_registry USING (controller, cell))
    SELECT controller, cell, log_date, coalesce(lag(closing) OVER (PARTITION BY controller, cell ORDER BY log_date),
      'on') AS opening, coalesce(closing, 'on') AS closing FROM held""",
)
def w15(spark, d):
    return cells.daily_status(a.cell_log(spark, d), a.cell_registry(spark, d))


@query(
    "x7_silences", "ping",
    """WITH n AS (SELECT ip, time, lead(time) OVER (PARTITION BY ip ORDER BY time, event_id) AS next FROM ping)
    SELECT ip, time AS silent_from, next AS silent_to, date_diff('microsecond', time, next) AS silent_us
    FROM n WHERE date_diff('microsecond', time, next) > 43200 * 1000000::BIGINT""",
)
def x7(spark, d):
    return changes.silences(a.ping(spark, d), "ip", "time", 43_200, TIE)


# -- state at moments, counters ----------------------------------------------------

DAYS = [datetime(2024, 1, 15), datetime(2024, 1, 16)]
MARKS = snapshot.daily_marks(DAYS)


@query(
    "u2_snapshot_asof", "electro",
    """WITH marks AS (SELECT unnest([TIMESTAMP '2024-01-15 00:00:00', TIMESTAMP '2024-01-15 03:00:00',
      TIMESTAMP '2024-01-15 06:00:00', TIMESTAMP '2024-01-16 00:00:00', TIMESTAMP '2024-01-16 03:00:00',
      TIMESTAMP '2024-01-16 06:00:00']) AS mark),
    wanted AS (SELECT location, mark FROM (SELECT DISTINCT location FROM electro), marks)
    SELECT w.location, w.mark, e.time AS read_at, e.temp_sys, e.temp_akb
    FROM wanted w ASOF JOIN electro e ON w.location = e.location AND w.mark >= e.time""",
)
def u2(spark, d):
    return snapshot.snapshot_asof(a.electro(spark, d), MARKS, "location", "time", ["temp_sys", "temp_akb"], TIE)


@query(
    "j12_asof_weekly", "temp",
    """WITH marks AS (SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-10', INTERVAL 7 DAYS)) AS mark),
    wanted AS (SELECT location, mark FROM (SELECT DISTINCT location FROM temp), marks)
    SELECT w.location, w.mark, t.time AS read_at, t.temperature
    FROM wanted w ASOF JOIN temp t ON w.location = t.location AND w.mark >= t.time""",
)
def j12(spark, d):
    weeks = [datetime(2024, 1, 1), datetime(2024, 1, 8), datetime(2024, 1, 15), datetime(2024, 1, 22),
             datetime(2024, 1, 29), datetime(2024, 2, 5)]
    return snapshot.snapshot_asof(a.temp(spark, d), weeks, "location", "time", ["temperature"], TIE)


def dehydrator_journal(spark, d):
    return changes.changes(a.dehydrator_line(spark, d), "ip", "time", a.WATCHED, TIE, null_safe=False)


@query("a2_first_seen", "hours_seen", "SELECT * FROM hours_seen")
def a2(spark, d):
    return runtime.first_seen(dehydrator_journal(spark, d), "ip", "c_life", "time")


@query("a7_hours_per_day", "averages", "SELECT * FROM averages")
def a7(spark, d):
    return runtime.hours_per_day(dehydrator_journal(spark, d), "ip", "c_life", "time")


ARCHIVED = """WITH moved AS (SELECT ip, time, event_id, c_life FROM dehydrator QUALIFY c_life <> lag(c_life) OVER
      (PARTITION BY ip ORDER BY time, event_id))
    SELECT m.ip, m.time, m.event_id, m.c_life, CAST(a.average * 100 AS SMALLINT) AS average
    FROM moved m LEFT JOIN averages a ON a.ip = m.ip AND a.last_hour = m.c_life"""


@query("a8_archived_hours", "averages", ARCHIVED)
def a8(spark, d):
    moved = w14(spark, d)
    averages = runtime.hours_per_day(dehydrator_journal(spark, d), "ip", "c_life", "time")
    return runtime.archived_hours(moved, averages, "ip", "c_life")


@query("u6_attach_metric", "averages", ARCHIVED.replace("CAST(a.average * 100 AS SMALLINT) AS average", "a.average"))
def u6(spark, d):
    averages = runtime.hours_per_day(dehydrator_journal(spark, d), "ip", "c_life", "time")
    metric = averages.select("ip", F.col("last_hour").alias("c_life"), "average")
    return current.attach_metric(w14(spark, d), metric, ["ip", "c_life"])


for _name in (
    "w1_ping_changes", "w2_dehydrator_changes", "w3_temp_within", "w4_accept_within", "w5_carry_forward", "w6_latch",
    "w7_run_index", "w8_patience", "w9_escalation", "w10_outages", "w12_latch_with_commands", "x7_silences",
):
    split_form(_name)
