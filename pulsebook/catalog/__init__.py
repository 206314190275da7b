"""Named queries over the supplied tables, each with its equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from pulsebook.operators.sizing import SPLIT_ROWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Views of the tables used by many statements, in the order they build on each other.
VIEWS = {
    "ev": r"""SELECT event_id, ts AS time, user_id AS u, event_type, CAST(floor(value) AS INTEGER) AS t,
        CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k,
        concat('10.', user_id // 65536, '.', (user_id // 256) % 256, '.', user_id % 256) AS ip,
        concat('loc-', user_id) AS location, concat('ks', user_id % 4) AS controller FROM events""",
    "ping": "SELECT ip, time, event_id, event_type <> 'error' AS state FROM ev",
    "ping_prev": "SELECT *, lag(state) OVER w AS prev, row_number() OVER w AS rn FROM ping "
    "WINDOW w AS (PARTITION BY ip ORDER BY time, event_id)",
    "ping_changes": "SELECT ip, time, event_id, state FROM ping_prev WHERE rn > 1 AND state <> prev",
    "equipment": """SELECT concat('10.', c_custkey // 65536, '.', (c_custkey // 256) % 256, '.', c_custkey % 256) AS ip,
        c_name AS name, c_mktsegment AS description,
        CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN '' ELSE concat('Sheet.', c_custkey) END
        AS visio_name, n_name AS location FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "temp": "SELECT location, time, event_id, t AS temperature FROM ev",
    "temp_gaps": "SELECT location, time, event_id, CASE WHEN event_type <> 'signup' THEN t END AS temperature FROM ev",
    "thresholds": """SELECT CAST(c_custkey AS INTEGER) AS id,
        concat('10.', c_custkey // 65536, '.', (c_custkey // 256) % 256, '.', c_custkey % 256) AS ip,
        concat('loc-', c_custkey) AS location, CASE WHEN c_custkey % 2 = 0 THEN 22 ELSE 11 END AS type,
        CAST(c_custkey % 28 AS INTEGER) AS gpio, CAST(5 + c_custkey % 5 AS INTEGER) AS blue,
        CAST(40 + c_custkey % 10 AS INTEGER) AS yellow, CAST(80 + c_custkey % 20 AS INTEGER) AS red,
        CAST(c_custkey % 5 - 2 AS INTEGER) AS correction FROM customer""",
    "electro": """SELECT location, time, event_id, t % 60 AS temp_sys, k % 45 AS temp_akb,
        CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END AS alarm_mains,
        t % 200 + 400 AS out_volt, t % 90 AS out_ampr, t AS out_watt, t % 150 + 450 AS battery1v,
        k + 450 AS battery2v FROM ev""",
    "power_sites": """SELECT concat('10.', c_custkey // 65536, '.', (c_custkey // 256) % 256, '.', c_custkey % 256) AS ip,
        concat('loc-', c_custkey) AS location, n_name AS own FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dehydrator": """SELECT 1 + (row_number() OVER (PARTITION BY ip ORDER BY time, event_id) - 1) // 5
        AS c_life, CAST(t % 45 AS SMALLINT) AS c_temp, CAST(t % 20 AS SMALLINT) AS c_high,
        CAST(CASE WHEN k % 10 <> 0 THEN t END AS SMALLINT) AS c__low, CAST(k AS SMALLINT) AS c_humi, ip, time, event_id,
        event_type = 'error' AS a_summ, event_type = 'click' AS a_exrt, event_type = 'view' AS a_high,
        event_type = 'purchase' AS a__low, event_type = 'signup' AS a_humi, t % 7 = 0 AS a_faul FROM ev""",
    "dehydrator_changes": """SELECT * FROM dehydrator WINDOW w AS (PARTITION BY ip ORDER BY time, event_id) QUALIFY row_number() OVER w > 1 AND (
        coalesce(c_life <> lag(c_life) OVER w, false) OR coalesce(c__low <> lag(c__low) OVER w, false)
        OR coalesce(c_humi <> lag(c_humi) OVER w, false) OR coalesce(a_summ <> lag(a_summ) OVER w, false)
        OR coalesce(a_exrt <> lag(a_exrt) OVER w, false) OR coalesce(a_high <> lag(a_high) OVER w, false)
        OR coalesce(a__low <> lag(a__low) OVER w, false) OR coalesce(a_humi <> lag(a_humi) OVER w, false)
        OR coalesce(a_faul <> lag(a_faul) OVER w, false))""",
    "hours_seen": "SELECT ip, c_life, min(time) AS time FROM dehydrator_changes GROUP BY ip, c_life",
    "averages": """SELECT a.ip, a.c_life AS last_hour, a.time AS last_time, b.time AS before_time,
        TRY_CAST(1.0::DOUBLE / nullif(date_diff('microsecond', b.time, a.time) / 86400000000.0::DOUBLE, 0)
        AS DECIMAL(3,2)) AS average
        FROM hours_seen a JOIN hours_seen b ON a.ip = b.ip AND a.c_life = b.c_life + 1""",
    "cell_log": """SELECT controller, CAST(time AS DATE) AS log_date, event_id AS line_no,
        CASE event_type WHEN 'error' THEN concat('cell ', u, '  off') WHEN 'view' THEN concat('cell ', u, '  on')
        WHEN 'click' THEN concat('cell ', u, '  busy') ELSE 'link ok' END AS line, time FROM ev""",
    "cell_registry": """SELECT concat('ks', c_custkey % 4) AS controller, CAST(c_custkey AS INTEGER) AS cell,
        CASE WHEN c_custkey % 9 = 0 THEN 'not' ELSE 'do' END AS "check" FROM customer""",
    "cell_events": r"""SELECT controller, log_date, line_no, CAST(regexp_extract(line, 'cell (\d+)', 1) AS INTEGER) AS cell,
        CASE WHEN line LIKE '%off' THEN 'off' ELSE 'on' END AS event FROM cell_log
        WHERE line LIKE '%  off' OR line LIKE '%  on'""",
    "cell_status": """SELECT r.controller, r.cell, r."check", coalesce(e.event, 'on') AS status FROM cell_registry r
        LEFT JOIN (SELECT controller, cell, arg_max(event, line_no) AS event FROM cell_events GROUP BY ALL) e
        ON r.controller = e.controller AND r.cell = e.cell""",
    "watch_log": """SELECT concat('ks', u % 64) AS controller, u AS cell, CAST(time AS DATE) AS log_date, time,
        event_type = 'error' AS off FROM ev WHERE event_type IN ('error', 'view')""",
    "watch_registry": """SELECT concat('ks', c_custkey % 64) AS controller, CAST(c_custkey AS INTEGER) AS cell,
        CAST(c_nationkey AS BIGINT) * 1000000000 + c_custkey AS position FROM customer WHERE c_custkey % 9 <> 0""",
    "watch_polls": """SELECT controller, unnest(range(first, last + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) + INTERVAL 50 MINUTE AS time
        FROM (SELECT concat('ks', u % 64) AS controller, date_trunc('hour', min(time)) AS first,
          date_trunc('hour', max(time)) AS last FROM ev GROUP BY 1)""",
    "watch_read": """SELECT l.* FROM watch_log l JOIN (SELECT controller, CAST(time AS DATE) AS log_date, max(time) AS last
        FROM watch_polls GROUP BY 1, 2) p ON l.controller = p.controller AND l.log_date = p.log_date AND l.time <= p.last""",
    "watch_off": """SELECT a.controller, a.time, list({'since': e.log_date, 'position': a.position, 'cell': a.cell} ORDER BY a.position)
        FILTER (e.off) AS off FROM (SELECT p.controller, p.time, r.cell, r.position FROM watch_polls p LEFT JOIN (SELECT r.* FROM
          watch_registry r SEMI JOIN watch_read USING (controller, cell)) r ON r.controller = p.controller) a
        ASOF LEFT JOIN watch_read e ON a.controller = e.controller AND a.cell = e.cell AND a.time >= e.time
        GROUP BY a.controller, a.time""",
    "vent_events": """SELECT u, time, event_id, CASE WHEN event_type <> 'signup' THEN t % 50 END AS temp,
        CASE WHEN event_type = 'signup' THEN ['auto_on', 'auto_off', 'v5_on', 'v5_off', 'v1_on', 'v1_off'][k % 6 + 1]
        END AS cmd FROM ev""",
}
NEEDS = {
    "ping": ["ev"], "ping_prev": ["ping"], "ping_changes": ["ping_prev"], "temp": ["ev"], "temp_gaps": ["ev"],
    "electro": ["ev"], "dehydrator": ["ev"], "dehydrator_changes": ["dehydrator"],
    "hours_seen": ["dehydrator_changes"], "averages": ["hours_seen"], "cell_log": ["ev"],
    "cell_events": ["cell_log"], "cell_status": ["cell_registry", "cell_events"], "vent_events": ["ev"],
    "watch_log": ["ev"], "watch_polls": ["ev"], "watch_read": ["watch_log", "watch_polls"],
    "watch_off": ["watch_polls", "watch_registry", "watch_read"],
}


def statement(views: str, body: str, recursive: bool = False) -> str:
    """A statement with the named views, and what they need, in front."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        wanted.add(name)
        for n in NEEDS.get(name, []):
            need(n)

    for v in views.split():
        need(v)
    parts = [f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in wanted]
    head, comma = ("WITH RECURSIVE " if recursive else "WITH "), ", "
    if body.lstrip().upper().startswith("WITH "):
        parts.append(body.lstrip()[5:])
        return head + comma.join(parts)
    return (head + comma.join(parts) + " " if parts else "") + body


def query(name: str, views: str = "", sql: str | None = None, recursive: bool = False):
    """Register a query, with its statement when given."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = statement(views, sql, recursive)
        return fn

    return register


@contextmanager
def splitting(spark: SparkSession, rows: int):
    """Build plans that cut a key about every quarter of so many rows."""
    old = spark.conf.get(SPLIT_ROWS, None)
    spark.conf.set(SPLIT_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(SPLIT_ROWS) if old is None else spark.conf.set(SPLIT_ROWS, old)


def split_form(name: str, rows: int = 200) -> None:
    """Register a query's split form under its own name with the same statement."""
    plain = QUERIES[name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        with splitting(spark, rows):
            return plain(spark, folder)

    QUERIES[f"{name}_split"] = run
    if name in ORACLES:
        ORACLES[f"{name}_split"] = ORACLES[name]


def load() -> None:
    """Import the modules that register queries."""
    from pulsebook.catalog import (  # noqa: F401
        boards, columns, histories, maintenance, quality, texts,
    )
    from pulsebook.catalog import streams  # noqa: F401  (takes over statements of the others)
