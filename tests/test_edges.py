"""Hand-made rows for the rules."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsebook import catalog
from pulsebook.functions import bands, timecols, values
from pulsebook.operators import cells, changes, current, escalation, folds, latch, quality, runtime, snapshot
from pulsebook.plans import reports

T0 = datetime(2024, 1, 1)


def series(spark, items, kind="int"):
    rows = [("k", T0 + timedelta(minutes=i), i, v) for i, v in enumerate(items)]
    return spark.createDataFrame(rows, f"k string, time timestamp_ntz, id int, v {kind}")


def got(df, column="v"):
    return [r[column] for r in df.orderBy("id").collect()]


def test_change_skips_first_row(spark):
    df = series(spark, [True, True, False, False, True], "boolean")
    assert got(changes.changes(df, "k", "time", ["v"])) == [False, True]


def test_plain_inequality_ignores_null(spark):
    df = series(spark, [5, None, 5, 6])
    assert got(changes.changes(df, "k", "time", ["v"], null_safe=False)) == [6]
    assert got(changes.changes(df, "k", "time", ["v"])) == [None, 5, 6]


def test_unwatched_column_does_not_count(spark):
    df = series(spark, [1, 2, 3]).withColumn("w", F.lit(0))
    assert changes.changes(df, "k", "time", ["w"], null_safe=False).count() == 0


@pytest.mark.parametrize("items, want", [([20, 21, 40, 21, 22], [21, 22]), ([20, 25, 26], [26]), ([20, 20], [])])
def test_spike_against_raw_predecessor(spark, items, want):
    assert got(changes.changes_within(series(spark, items), "k", "time", "v", 5)) == want


def test_exempt_source(spark):
    df = series(spark, [20, 60, 60, 20])
    assert got(changes.changes_within(df, "k", "time", "v", 5, F.col("k") == "k")) == [60, 20]


def test_accept_against_last_accepted(spark):
    assert got(folds.accept_within(series(spark, [20, 31, 30, None, 20]), "k", "time", "v", 10)) == [20, 30, 20]


def test_carry_forward(spark):
    assert got(changes.carry_forward(series(spark, [None, 20, None, None, 23]), "k", "time", "v")) == [
        None, 20, 20, 20, 23,
    ]


def test_latch(spark):
    df = latch.latch(series(spark, [24, 27, 26, 22, 21, 26, 27]), "k", "time", "v", 26, 22)
    assert got(df, "state") == ["OFF", "ON", "ON", "ON", "OFF", "OFF", "ON"]


def test_latch_with_commands(spark):
    rows = [
        (0, 24, None), (1, None, "v5_on"), (2, 20, None), (3, None, "auto_on"), (4, None, "v5_on"), (5, 24, None),
        (6, None, "v5_on"), (7, 30, None), (8, None, "v5_off"), (9, None, "auto_off"), (10, None, "v5_off"),
    ]
    df = spark.createDataFrame(
        [("k", T0 + timedelta(minutes=i), i, t, c) for i, t, c in rows],
        "k string, time timestamp_ntz, id int, temp int, cmd string",
    )
    out = latch.latch_with_commands(df, "k", "time", "temp", "cmd")
    assert got(out, "state") == ["OFF", "ON", "ON", "OFF", "OFF", "OFF", "ON", "ON", "ON", "ON", "OFF"]
    assert got(latch.switch_journal(out, "k", "time"), "id") == [1, 3, 6, 10]


@pytest.mark.parametrize("owners, want", [("AABA", [0, 0, 1, 2]), ("AAB", [1, 1, 2]), ("AAA", [0, 0, 0])])
def test_run_index(spark, owners, want):
    df = spark.createDataFrame(list(enumerate(owners)), "id int, own string")
    assert got(folds.run_index(df, "id", "own"), "run") == want


def test_escalation_steps(spark):
    polls = [(T0 + timedelta(minutes=10 * i), "off") for i in range(13)]
    polls += [(T0 + timedelta(hours=3), "on"), (T0 + timedelta(days=1), "off")]
    rows = [("c", t, 7, s, 0) for t, s in polls]
    df = spark.createDataFrame(rows, "c string, time timestamp_ntz, cell int, status string, pos int")
    made = escalation.escalate(df, "c", "time", "cell", "status", "pos").orderBy("time").collect()
    assert [(r["time"], r["action"]) for r in made] == [
        (T0 + timedelta(minutes=50), "restart"), (T0 + timedelta(minutes=110), "reboot"),
    ]


def test_reboot_locks_the_day(spark):
    rows = [("c", T0 + timedelta(minutes=5 * i), 7, "off", 0) for i in range(600)]
    df = spark.createDataFrame(rows, "c string, time timestamp_ntz, cell int, status string, pos int")
    made = escalation.escalate(df, "c", "time", "cell", "status", "pos").orderBy("time").collect()
    by_day = {}
    for r in made:
        by_day.setdefault(r["time"].date(), []).append(r["action"])
    assert by_day[date(2024, 1, 1)] == ["restart", "reboot"]
    assert by_day[date(2024, 1, 2)] == ["restart", "reboot"]


def test_station_number_suffix(spark):
    lines = spark.createDataFrame(
        [("c", date(2024, 1, 1), 1, "cell 1  off"), ("c", date(2024, 1, 1), 2, "cell 11  on")],
        "controller string, log_date date, line_no int, line string",
    )
    reg = spark.createDataFrame([("c", 1, "do"), ("c", 2, "do")], "controller string, cell int, check string")

    def status(strict):
        rows = cells.cell_status(lines, reg, strict).collect()
        return {r["cell"]: r["status"] for r in rows}

    assert status(True) == {1: "off", 2: "on"}
    assert status(False) == {1: "on", 2: "on"}


def test_bands(spark):
    given = ["14.9", "15.0", "27.9", "28", "4.9", "5", "35.9", "36", ""]
    df = series(spark, given, "string").select("id", bands.band_of("v", 15, 27, 5, 35).alias("b"))
    want = ["yellow", "green", "green", "yellow", "red", "yellow", "yellow", "red", "red"]
    assert got(df, "b") == want


def test_null_band(spark):
    df = series(spark, [None, 20]).select(
        "id", bands.metric_band("v", "temp_akb").alias("a"), bands.metric_band("v", "temp_akb", True).alias("b")
    )
    assert [(r["a"], r["b"]) for r in df.orderBy("id").collect()] == [(None, "red"), ("green", "green")]


def test_room_class_includes_bounds(spark):
    df = series(spark, [22, 23, 25, 26]).select("id", bands.room_class("v").alias("c"))
    assert got(df, "c") == ["green", "yellow", "yellow", "red"]


def snapshots(spark):
    day = datetime(2024, 1, 5)
    rows = [("a", day, 1, 2), ("a", day + timedelta(minutes=9), 7, 8), ("a", day.replace(hour=3), 3, 4),
            ("a", day.replace(hour=6), 5, 6), ("b", day, 1, 1), ("b", day.replace(hour=6), 1, 1),
            ("a", day + timedelta(days=1), 9, 9)]
    snaps = spark.createDataFrame(rows, "location string, time timestamp_ntz, temp_sys int, temp_akb int")
    reg = spark.createDataFrame([("10.0.0.1", "a", "x"), ("10.0.0.2", "b", "x")], "ip string, location string, own string")
    return snaps, reg


def test_hour_report(spark):
    snaps, reg = snapshots(spark)
    rows = reports.hour_report(snaps, reg, date(2024, 1, 5)).collect()
    assert [tuple(r)[2:] for r in rows] == [("a", 1, 2, 3, 4, 5, 6)]
    both = reports.hour_report(snaps, reg, date(2024, 1, 5), compat=True).collect()
    assert sorted(tuple(r)[2:] for r in both) == [("a", 1, 2, 3, 4, 5, 6), ("a", 7, 8, 3, 4, 5, 6)]


def test_hours_per_day(spark):
    rows = [("d", 100, T0), ("d", 100, T0 + timedelta(hours=1)), ("d", 101, T0 + timedelta(hours=48)),
            ("d", 103, T0 + timedelta(hours=60)), ("e", 1, T0), ("e", 2, T0 + timedelta(seconds=1)), ("f", 1, T0),
            ("f", 2, T0)]
    df = spark.createDataFrame(rows, "ip string, c_life smallint, time timestamp_ntz")
    out = {(r["ip"], r["last_hour"]): r["average"] for r in runtime.hours_per_day(df, "ip", "c_life", "time").collect()}
    assert out == {("d", 101): Decimal("0.50"), ("e", 2): None, ("f", 2): None}


def test_retention_bound(spark):
    as_of = datetime(2024, 3, 1)
    rows = [(1, as_of - timedelta(days=31)), (2, as_of - timedelta(days=31, seconds=1)), (3, as_of)]
    df = spark.createDataFrame(rows, "id int, time timestamp_ntz")
    assert got(current.retain(df, "time", as_of), "id") == [1, 3]


def test_address_order(spark):
    df = spark.createDataFrame([("1.1.1.10",), ("1.1.1.9",), ("10.0.0.1",)], "ip string")
    assert [r["ip"] for r in df.orderBy(values.ip_key("ip")).collect()] == ["1.1.1.9", "1.1.1.10", "10.0.0.1"]


def test_ten_newest_shown_oldest_first(spark):
    rows = [(f"10.0.0.{i}", T0 + timedelta(seconds=i, microseconds=5), i % 2 == 0) for i in range(12)]
    df = spark.createDataFrame(rows, "ip string, time timestamp_ntz, state boolean")
    reg = df.select("ip", F.col("ip").alias("name"))
    out = reports.recent_events(df, reg).collect()
    assert [r["ping_time"] for r in out] == [T0 + timedelta(seconds=i) for i in range(2, 12)]
    assert (out[0]["event"], out[0]["event_class"], out[1]["event"]) == ("восстановился", "green_log", "пропал")


def test_snapshot_holds_over_empty_marks(spark):
    df = series(spark, [1, None, 3])
    marks = [T0 + timedelta(minutes=m) for m in (-1, 0, 1, 5, 9)]
    out = snapshot.snapshot_asof(df, marks, "k", "time", ["v"]).orderBy("mark").collect()
    assert [(r["mark"], r["v"]) for r in out] == [(marks[1], 1), (marks[2], None), (marks[3], 3), (marks[4], 3)]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, None, -1)], "id int, name string, n int")
    assert [tuple(r) for r in quality.check_unique(df, "id").collect()] == [(1, 2)]
    assert got(quality.check_not_null(df, ["name"]), "id") == [2]
    assert got(quality.check_range(df, F.col("n") >= 0), "id") == [2]
    parent = spark.createDataFrame([("a",)], "name string")
    assert [r["name"] for r in quality.check_fk(df, parent, "name").collect()] == ["b"]
    assert got(quality.with_defaults(df, {"n": 0}), "n").count(0) == 1


def test_current_seed_rows_break_foreign_key(spark):
    sites = spark.createDataFrame([("s-11", "n-1"), ("s-12", "n-2")], "location string, own string")
    seeded = spark.createDataFrame([("n-1", 35), ("n-2", 35)], "location string, temp int")
    assert quality.check_fk(seeded, sites, "location").count() == 2


def test_seconds_do_not_depend_on_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        odd = datetime(2024, 3, 10, 2, 30, 15, 250000)  # an hour that zone skips
        df = spark.createDataFrame([(1, odd)], "id int, time timestamp_ntz")
        row = df.select("id", timecols.to_second("time").alias("t"), timecols.elapsed_us(
            timecols.ntz(datetime(2024, 3, 10)), "time").alias("us")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["t"] == odd.replace(microsecond=0)
    assert row["us"] == (2 * 3600 + 30 * 60 + 15) * 1_000_000 + 250_000


def test_mains_and_alarm_words(spark):
    df = series(spark, [0, 1, 2, None]).select("id", values.mains_word("v").alias("m"))
    assert got(df, "m") == ["Есть 380", "Нет  380", None, None]
    df = series(spark, [" OK", " FAULT", None], "string").select("id", values.alarm_raised("v").alias("a"))
    assert got(df, "a") == [False, True, True]


BUSY = """w2_dehydrator_changes w14_counter_transitions a2_first_seen a7_hours_per_day a8_archived_hours u6_attach_metric
u1_dehydrator_current r5_dehydrator_board r5_average_journal j5_current_with_average j6_latest_lookup""".split()


def test_busy_address(spark, tmp_path):
    """200 000 polls of one address: more hours than a small integer counts."""
    source = Path("/root/testdata/sf0.001")
    for file in source.iterdir():
        if file.name != "events.parquet":
            (tmp_path / file.name).symlink_to(file)
    spark.range(200_000).select(
        F.col("id").alias("event_id"), F.timestamp_add("MINUTE", "id", F.lit(T0).cast("timestamp_ntz")).alias("ts"),
        F.lit(7).cast("bigint").alias("user_id"), F.lit("click").alias("event_type"), F.lit(5.5).alias("value"),
        F.lit('{"k": 12}').alias("props"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    catalog.load()
    counts = {name: catalog.QUERIES[name](spark, str(tmp_path)).count() for name in BUSY}
    assert counts["w14_counter_transitions"] == 39_999
    # The first hour opens the history and is no change.
    assert counts["a7_hours_per_day"] == counts["a2_first_seen"] - 1 == 39_998


def test_snapshot_at_very_many_marks(spark):
    """A hundred thousand marks, as a table: the plan holds none of them."""
    rows = [("a", T0 + timedelta(minutes=7 * i), i) for i in range(300)] + [("b", T0 + timedelta(minutes=1500), 1), ("c", None, 1)]
    df = spark.createDataFrame(rows, "k string, time timestamp_ntz, v int")
    first = F.lit(T0).cast("timestamp_ntz")
    marks = spark.range(100_000).select(F.timestamp_add("SECOND", F.col("id") * 3, first).alias("at"))
    out = snapshot.snapshot_asof(df, marks, "k", "time", ["v"])
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    found = out.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("v"), F.min("mark").alias("first")).collect()
    want = {}
    for k, ticks in (("a", [7 * 60 * i for i in range(300)]), ("b", [1500 * 60])):
        start = -(-ticks[0] // 3)
        values = [min((3 * m) // 420, 299) if k == "a" else 1 for m in range(start, 100_000)]
        want[k] = (len(values), sum(values), T0 + timedelta(seconds=3 * start))
    assert {r.k: (r.n, r.v, r["first"]) for r in found} == want


def test_snapshot_without_marks(spark):
    df = series(spark, [1, 2])
    assert snapshot.snapshot_asof(df, [], "k", "time", ["v"]).count() == 0
