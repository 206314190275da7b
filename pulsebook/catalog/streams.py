"""Streaming forms. The table lands in three stretches of time; the stream is restarted for each."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pulsebook.catalog import ORACLES, QUERIES, histories, query, splitting
from pulsebook.functions.timecols import ntz
from pulsebook.functions.values import state_word
from pulsebook.plans import adapters as a
from pulsebook.session import work_folder
from pulsebook.sources import sinks
from pulsebook.sources.logs import write_cell_log
from pulsebook.streaming import batched, tables
from pulsebook.streaming.sources import run_stream, stream_cell_log, stream_table

TIE = "event_id"
CUTS = [None, datetime(2024, 1, 11), datetime(2024, 1, 21), None]


def parts_of(df, time, order=(0, 1, 2)):
    """The whole frame in three stretches of time; rows without a time are in the first."""
    for i in order:
        lo, hi = CUTS[i], CUTS[i + 1]
        part = df.filter(F.col(time) >= ntz(lo)) if lo else df
        yield part.filter((F.col(time) < ntz(hi)) | F.col(time).isNull()) if hi else part


def fed(spark, df, time, start, order=(0, 1, 2), parts=None, files=None):
    """Land the frame stretch by stretch and run the stream anew after each.

    ``start`` makes the writer from the stream; every run goes on from the checkpoint. A batch takes all that has
    landed, or ``files`` files.
    """
    folder = work_folder(spark, "stream")
    for part in parts or parts_of(df, time, order):
        part.write.mode("append").parquet(f"{folder}/landed")
        stream = stream_table(spark, f"{folder}/landed", df.schema, files)
        run_stream(start(stream, folder), f"{folder}/checkpoint")
    return folder


def appended(spark, df, time, operator):
    """What an append stream over the frame gives out."""
    schema = []

    def start(stream, folder):
        out = operator(stream)
        schema.append(out.schema)
        return out.writeStream.format("parquet").option("path", f"{folder}/out")

    folder = fed(spark, df, time, start)
    return spark.read.schema(schema[-1]).parquet(f"{folder}/out")


def batched_out(spark, df, time, start, parts=None, files=None):
    """What a batch-by-batch stream over the frame puts into its file sink."""
    def begin(stream, folder):
        return start(stream, f"{folder}/state", batched.file_sink(f"{folder}/out"))

    folder = fed(spark, df, time, begin, parts=parts, files=files)
    return spark.read.parquet(f"{folder}/out").drop("batch")


def events(spark, d):
    return a.table(spark, d, "events")


def ping(base):
    return base.select("ip", "time", TIE, (~a.is_type("error")).alias("state"))


def temp(base):
    return base.select("location", "time", TIE, F.col("t").alias("temperature"))


def like(name: str, batch: str):
    """Register a stream under the statement of its batch form."""

    def register(fn):
        QUERIES[name] = fn
        ORACLES[name] = ORACLES[batch]
        return fn

    return register


@like("x1_stream_states", "p1_state_words")
def x1(spark, d):
    def operator(stream):
        state = F.when(~a.is_type("signup"), ~a.is_type("error"))
        return a.with_base(stream).select(TIE, state_word(state).alias("state"))

    return appended(spark, events(spark, d), "ts", operator)


@like("x2_stream_latest", "u1_ping_current")
def x2(spark, d):
    def start(stream, folder):
        return tables.stream_latest(ping(a.with_base(stream)), "ip", "time", f"{folder}/table", TIE)

    folder = fed(spark, events(spark, d), "ts", start)
    return tables.CurrentTable(spark, f"{folder}/table").read()


def _journals(spark, d):
    def start(stream, folder):
        rows = ping(a.with_base(stream))
        sink = tables.journal_sink(f"{folder}/hot", f"{folder}/archive", "time")
        return batched.stream_changes(rows, "ip", "time", ["state"], TIE, f"{folder}/state", sink)

    return fed(spark, events(spark, d), "ts", start), ["ip", "time", TIE, "state"]


@like("x3_stream_changes", "w1_ping_changes")
def x3(spark, d):
    folder, columns = _journals(spark, d)
    return sinks.read_journal(spark, f"{folder}/archive", columns)


@query("x3_stream_hot_journal", "ping_changes",
       "SELECT * FROM ping_changes WHERE time >= TIMESTAMP '2024-02-10' - INTERVAL 31 DAYS")
def x3_hot(spark, d):
    folder, columns = _journals(spark, d)
    late = datetime(2024, 2, 10)
    sinks.expire(spark, f"{folder}/hot", late)
    return sinks.read_hot(spark, f"{folder}/hot", columns, "time", late)


@like("x3_stream_plain_changes", "p13_plain_changes")
def x3_plain(spark, d):
    gaps = F.when(~a.is_type("signup"), F.col("t")).alias("temperature")

    def start(stream, state, sink):
        rows = a.with_base(stream).select("location", "time", TIE, gaps)
        return batched.stream_changes(rows, "location", "time", ["temperature"], TIE, state, sink, null_safe=False)

    return batched_out(spark, events(spark, d), "ts", start)


@like("x3_stream_within", "p15_exempt_source")
def x3_within(spark, d):
    def start(stream, state, sink):
        rows = temp(a.with_base(stream))
        free = F.col("location") == a.EXEMPT
        return batched.stream_changes_within(rows, "location", "time", "temperature", TIE, state, sink, 5, free)

    return batched_out(spark, events(spark, d), "ts", start)


def _accept(spark, d):
    def start(stream, state, sink):
        rows = temp(a.with_base(stream))
        return batched.stream_accept_within(rows, "location", "time", "temperature", TIE, state, sink, 10)

    return batched_out(spark, events(spark, d), "ts", start)


@like("x4_stream_accept", "w4_accept_within")
def x4_accept(spark, d):
    return _accept(spark, d)


@like("x4_stream_accept_split", "w4_accept_within")
def x4_accept_split(spark, d):
    with splitting(spark, 200):
        return _accept(spark, d)


@like("x4_stream_latch", "w12_latch_with_commands")
def x4_latch(spark, d):
    def start(stream, state, sink):
        rows = a.vent_rows(a.with_base(stream))
        return batched.stream_latch_with_commands(rows, "u", "time", "temp", "cmd", TIE, state, sink)

    return batched_out(spark, events(spark, d), "ts", start)


LATEST = """SELECT max(time) FROM (SELECT time FROM ev UNION ALL SELECT time FROM watch_polls)"""


@query("x4_stream_escalate", "watch_off", histories.ESCALATION + f" AND time < ({LATEST}) - INTERVAL 6 HOURS", recursive=True)
def x4_escalate(spark, d):
    """Lines come up to five hours late, by chance, and polls are cut by the borders of files and stretches."""
    rows = batched.watch_rows(a.watch_log(spark, d), a.watch_polls(spark, d))
    landed = F.timestamp_add("MINUTE", F.pmod(F.coalesce("line_no", F.lit(0)) * 37, F.lit(300)), "time")
    files = [part.drop("_at") for part in parts_of(rows.withColumn("_at", landed), "_at")]

    def start(stream, state, sink):
        registry = a.watch_registry(spark, d)
        return batched.stream_watch(stream, registry, state, sink, delay=6 * 3600, patience=2, waits=(5400, 10800))

    return batched_out(spark, rows, "time", start, parts=files)


@query("x5_stream_cell_events", "cell_events", """SELECT controller, CAST(cell AS VARCHAR) AS cell,
    arg_max(log_date, line_no) AS log_date, max(line_no) AS line_no, arg_max(event, line_no) AS event
    FROM cell_events GROUP BY controller, cell""")
def x5(spark, d):
    def start(stream, folder):
        lines = a.cell_lines(a.with_base(stream)).drop("time")
        return tables.stream_cell_events(lines, f"{folder}/table")

    folder = fed(spark, events(spark, d), "ts", start)
    return tables.CurrentTable(spark, f"{folder}/table").read()


@query("x5_stream_cell_log", "cell_events", """SELECT controller, CAST(cell AS VARCHAR) AS cell,
    arg_max(log_date, line_no) AS log_date, arg_max(event, line_no) AS event FROM cell_events GROUP BY controller, cell""")
def x5_text(spark, d):
    """The same from text files: a stretch's lines land as new files of their controllers' days."""
    folder = work_folder(spark, "stream")
    for part in parts_of(a.cell_log(spark, d), "time"):
        write_cell_log(part, f"{folder}/landed", "line_no", whole=True)
        stream = stream_cell_log(spark, f"{folder}/landed/*/*.log")
        run_stream(tables.stream_cell_events(stream, f"{folder}/table"), f"{folder}/checkpoint")
    return tables.CurrentTable(spark, f"{folder}/table").read().select("controller", "cell", "log_date", "event")


@query(
    "x6_late_rows", "ping",
    """WITH taken AS (SELECT * FROM ping WHERE NOT (time >= TIMESTAMP '2024-01-11' AND time < TIMESTAMP '2024-01-21'
      AND ip IN (SELECT ip FROM ping WHERE time >= TIMESTAMP '2024-01-21')))
    SELECT * FROM taken WINDOW w AS (PARTITION BY ip ORDER BY time, event_id) QUALIFY state <> lag(state) OVER w""",
)
def x6(spark, d):
    """The middle stretch lands last: it is late for every device already seen in the last one."""
    return spark.read.parquet(f"{out_of_order(spark, d)}/out").drop("batch")


@query(
    "x6_refused_rows", "ping",
    """SELECT * FROM ping WHERE time >= TIMESTAMP '2024-01-11' AND time < TIMESTAMP '2024-01-21'
    AND ip IN (SELECT ip FROM ping WHERE time >= TIMESTAMP '2024-01-21')""",
)
def x6_refused(spark, d):
    return spark.read.parquet(f"{out_of_order(spark, d)}/late").drop("batch")


def out_of_order(spark, d):
    """The folder of a stream of changes whose middle stretch lands last."""

    def start(stream, folder):
        rows = ping(a.with_base(stream))
        sink, late = batched.file_sink(f"{folder}/out"), batched.file_sink(f"{folder}/late")
        return batched.stream_changes(rows, "ip", "time", ["state"], TIE, f"{folder}/state", sink, late=late)

    return fed(spark, events(spark, d), "ts", start, order=(0, 2, 1))


# -- allowed lateness --------------------------------------------------------------

LATE_HOURS = 30


def landings(time):
    """Five landings of six days. Most rows land within 25 hours of their time, one in forty lands up to a week late."""
    number = F.col(TIE)
    hours = F.when(F.pmod(number, F.lit(40)) == 7, F.pmod(number, F.lit(168))).otherwise(F.pmod(number * 7, F.lit(25)))
    day = F.unix_date(F.to_date(F.timestamp_add("HOUR", hours, time))) - F.unix_date(F.lit("2024-01-01").cast("date"))
    return F.least(F.greatest(F.floor(day / 6), F.lit(0)), F.lit(4)).cast("int")


def lands(df, time="time"):
    numbered = df.withColumn("_landing", landings(time))
    return [numbered.filter(F.col("_landing") == i).drop("_landing") for i in range(5)]


# The mark before each landing, and what had not passed it.
LANDED = f"""WITH landed AS (SELECT *, least(greatest(date_diff('day', DATE '2024-01-01', CAST(time + to_hours(
      CASE WHEN event_id % 40 = 7 THEN event_id % 168 ELSE event_id * 7 % 25 END) AS DATE)) // 6, 0), 4) AS landing FROM ping),
    marks AS (SELECT landing, max(max(time)) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      - INTERVAL {LATE_HOURS} HOUR AS mark FROM landed GROUP BY landing),
    judged AS (SELECT ip, time, event_id, state, coalesce(time < mark, false) AS late FROM landed JOIN marks USING (landing)),
    taken AS (SELECT ip, time, event_id, state FROM judged WHERE NOT late
      AND time < (SELECT max(time) FROM ping) - INTERVAL {LATE_HOURS} HOUR)
    """


def _lately(spark, d):
    """The folder of a stream of changes whose rows come out of order."""

    def start(stream, folder):
        sink, late = batched.file_sink(f"{folder}/out"), batched.file_sink(f"{folder}/late")
        return batched.stream_changes(
            stream, "ip", "time", ["state"], TIE, f"{folder}/state", sink, late=late, delay=LATE_HOURS * 3600
        )

    rows = a.ping(spark, d)
    return fed(spark, rows, "time", start, parts=lands(rows))


@query(
    "x6_lateness_changes", "ping",
    LANDED + "SELECT * FROM taken WINDOW w AS (PARTITION BY ip ORDER BY time, event_id) QUALIFY state <> lag(state) OVER w",
)
def x6_lateness(spark, d):
    """Rows within the allowed lateness give the answer of the batch operator over all rows taken."""
    return spark.read.parquet(f"{_lately(spark, d)}/out").drop("batch")


@query("x6_lateness_refused", "ping", LANDED + "SELECT ip, time, event_id, state FROM judged WHERE late")
def x6_lateness_refused(spark, d):
    """Rows later than allowed are handed out."""
    return spark.read.parquet(f"{_lately(spark, d)}/late").drop("batch")


@query(
    "x6_lateness_accept", "temp",
    """WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY location ORDER BY time, event_id) AS rn FROM temp),
    walk AS (
      SELECT location, time, event_id, temperature, rn, temperature AS last, true AS keep FROM numbered WHERE rn = 1
      UNION ALL
      SELECT n.location, n.time, n.event_id, n.temperature, n.rn,
        CASE WHEN abs(n.temperature - w.last) <= 10 THEN n.temperature ELSE w.last END,
        abs(n.temperature - w.last) <= 10
      FROM walk w JOIN numbered n ON n.location = w.location AND n.rn = w.rn + 1)
    SELECT location, time, event_id, temperature FROM walk WHERE keep
    AND time < (SELECT max(time) FROM temp) - INTERVAL 200 HOUR""",
    recursive=True,
)
def x6_lateness_accept(spark, d):
    """All rows are within the allowed lateness, so those up to the mark give the batch answer."""

    def start(stream, state, sink):
        return batched.stream_accept_within(
            stream, "location", "time", "temperature", TIE, state, sink, 10, delay=200 * 3600
        )

    rows = a.temp(spark, d)
    return batched_out(spark, rows, "time", start, parts=lands(rows))


@query(
    "x7_stream_sessions", "ping",
    """WITH gaps AS (SELECT *, CASE WHEN time - lag(time) OVER w <= INTERVAL 12 HOURS THEN 0 ELSE 1 END AS opens
      FROM ping WINDOW w AS (PARTITION BY ip ORDER BY time, event_id)),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY ip ORDER BY time, event_id) AS n FROM gaps)
    SELECT ip, min(time) AS first_read, max(time) AS last_read, count(*) AS reads FROM numbered GROUP BY ip, n
    HAVING max(time) + INTERVAL 12 HOURS <= (SELECT max(time) FROM ping) - INTERVAL 1 HOUR""",
)
def x7_sessions(spark, d):
    def start(stream, state, sink):
        rows = ping(a.with_base(stream)).select("ip", "time")
        return batched.stream_sessions(rows, "ip", "time", 12 * 3600, state, sink, delay=3600)

    return batched_out(spark, events(spark, d), "ts", start)


@like("x7_stream_sessions_split", "x7_stream_sessions")
def x7_sessions_split(spark, d):
    with splitting(spark, 200):
        return x7_sessions(spark, d)
