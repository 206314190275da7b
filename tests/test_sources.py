"""Text sources and sinks on files."""

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from pulsebook.operators.cells import cell_status
from pulsebook.sources import logs, registries, replies, sinks
from pulsebook.streaming import tables
from pulsebook.streaming.sources import run_stream, stream_cell_log

T0 = datetime(2024, 1, 1)


def test_registry_file(spark, tmp_path):
    (tmp_path / "r.txt").write_text(
        '1.1.1.1|Gate "R1" x|Router|TT.24\n# 1.1.1.2|a|b|c\n//1.1.1.3|a|b|c\n1.1.1.4|Name|Text\n', encoding="utf8"
    )
    rows = [tuple(r) for r in registries.read_registry(spark, str(tmp_path / "r.txt")).collect()]
    assert rows == [("1.1.1.1", 'Gate "R1" x', "Router", "TT.24"), ("1.1.1.4", "Name", "Text", None)]


def test_cell_registry_files(spark, tmp_path):
    for c, text in {"ks1": "1\tdo\n21\tnot\n", "ks2": "7\tdo\n"}.items():
        (tmp_path / c).mkdir()
        (tmp_path / c / "cells.txt").write_text(text)
    rows = registries.read_cell_registry(spark, f"{tmp_path}/*/cells.txt").collect()
    assert sorted(tuple(r) for r in rows) == [("ks1", 1, "do"), ("ks1", 21, "not"), ("ks2", 7, "do")]


def test_log_keeps_line_order_over_split_files(spark, tmp_path):
    (tmp_path / "ks1").mkdir()
    lines = [f"cell {i % 3}  {'off' if i % 5 else 'on'}" for i in range(400)]
    (tmp_path / "ks1" / "240115.log").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = logs.read_cell_log(spark, f"{tmp_path}/*/*.log")
        assert df.select(F.spark_partition_id()).distinct().count() > 3
        rows = df.orderBy("line_no").collect()
        reg = spark.createDataFrame([("ks1", i, "do") for i in range(3)], "controller string, cell int, check string")
        status = {r["cell"]: r["status"] for r in cell_status(df, reg).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["line"] for r in rows] == lines
    assert {(r["controller"], r["log_date"]) for r in rows} == {("ks1", date(2024, 1, 15))}
    want = {}
    for line in lines:
        want[int(line.split()[1])] = line.split()[2]
    assert status == want


REPLY = """SUMMARY ALARM = OK
EXCESSIVE RUN TIME ALARM = OK
HIGH PRESSURE ALARM = FAIL
HIGH HUMIDITY ALARM = OK
COMPR FAULT ALARM = OK
Current Compressor life:{gap}666 Hours > 0
temp = 22C
high pressure = 11 psi >= 0
low pressure = 2.25  psi >= 0
humidity = 0.0% >= 0
"""


def test_transcripts(spark):
    rows = [(1, REPLY.format(gap=" ")), (2, REPLY.format(gap="  ").replace("\n", "\x1b")),
            (3, REPLY.replace("Current Compressor life:{gap}666 Hours > 0\n", ""))]
    out = replies.extract_dehydrator(spark.createDataFrame(rows, "id int, reply string")).orderBy("id").collect()
    assert [r["id"] for r in out] == [1, 2]
    for r in out:
        assert (r["c_life"], r["c_temp"], r["c_high"], r["c__low"], r["c_humi"]) == (666, 22, 11, 23, 0)
        flags = (r["a_summ"], r["a_exrt"], r["a_high"], r["a__low"], r["a_humi"], r["a_faul"])
        assert flags == (False, False, True, True, False, False)  # the low pressure line is missing


def test_weather_and_sensor(spark):
    pages = spark.createDataFrame(
        [(1, 'x{"temperature":{"air":{"C":-3.7,"F":25}}}'), (2, '{"temperature":{"air":{"C":12,"F":25}}}'), (3, "none")],
        "id int, html string",
    )
    assert [(r["id"], r["temperature"]) for r in replies.extract_weather(pages).orderBy("id").collect()] == [(1, -3), (2, 12)]
    texts = spark.createDataFrame([(1, "23.0"), (2, "Failed to get reading. Try again!")], "id int, reply string")
    assert [float(r["temperature"]) if r["temperature"] is not None else None for r in
            replies.extract_sensor(texts).orderBy("id").collect()] == [23.0, None]
    room = spark.createDataFrame([("Temp = 24 *C",), ("Humidity = 3",)], "reply string")
    assert [r["temperature"] for r in replies.extract_room_sensor(room).collect()] == [23]


def test_program_journals(spark):
    lines = spark.createDataFrame(
        [(1, "06.08.22 11:30:39 - Отключилась Cell 3; Перезапуск g2"),
         (2, "04.12.22 16:23:23 - 229 Отключилась Cell 0; Перезагрузка КБС"), (3, "garbage")], "id int, line string",
    )
    rows = logs.parse_action_log(lines).orderBy("id").collect()
    assert [(r["time"], r["cell"], r["action"]) for r in rows] == [
        (datetime(2022, 8, 6, 11, 30, 39), 3, logs.RESTART_TEXT),
        (datetime(2022, 12, 4, 16, 23, 23), 0, logs.REBOOT_TEXT), (None, None, None),
    ]
    lines = spark.createDataFrame([(1, "20:27:16 - НОРМА"), (2, "03.12.18 19:48:30 - 61   ")], "id int, line string")
    rows = logs.parse_process_log(lines).orderBy("id").collect()
    assert [(r["time"], r["clock"], r["code_line"], r["message"].strip()) for r in rows] == [
        (None, "20:27:16", None, "НОРМА"), (datetime(2018, 12, 3, 19, 48, 30), "19:48:30", 61, ""),
    ]


def test_journal_is_written_once(spark, tmp_path):
    rows = [("a", T0 + timedelta(days=i), i) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, time timestamp_ntz, v int")
    hot, archive = f"{tmp_path}/hot", f"{tmp_path}/archive"
    for _ in range(2):
        sinks.journal(df, hot, archive, "time", "one")
    as_of = T0 + timedelta(days=39, hours=1)
    assert len(sinks.expire(spark, hot, as_of)) == 8
    kept = sinks.read_hot(spark, hot, df.columns, "time", as_of)
    assert sorted(r["v"] for r in kept.collect()) == list(range(9, 40))
    every = sinks.read_journal(spark, archive, df.columns)
    assert every.count() == 40
    assert kept.exceptAll(every).count() == 0


def test_log_stream_goes_on_where_it_stopped(spark, tmp_path):
    (tmp_path / "log" / "ks1").mkdir(parents=True)

    def step(name, text):
        (tmp_path / "log" / "ks1" / name).write_text(text)
        stream = stream_cell_log(spark, f"{tmp_path}/log/*")
        run_stream(tables.stream_cell_events(stream, f"{tmp_path}/table"), f"{tmp_path}/checkpoint")
        return {r["cell"]: r["event"] for r in tables.CurrentTable(spark, f"{tmp_path}/table").read().collect()}

    assert step("240101.log", "cell 1  off\ncell 2  off\ncell 2  on\n") == {"1": "off", "2": "on"}
    assert step("b-240101.log", "noise\ncell 3  off\n") == {"1": "off", "2": "on", "3": "off"}
    assert step("240102.log", "cell 1  on\n") == {"1": "on", "2": "on", "3": "off"}


def test_logs_as_text_keep_the_order_of_lines(spark, tmp_path):
    rows = [(f"ks{i % 2}", date(2024, 1, 1 + i % 3), i, f"cell {i % 5}  {'off' if i % 7 % 2 else 'on'}") for i in range(900)] + [(None, None, 7, "link ok")]
    lines = spark.createDataFrame(rows, "controller string, log_date date, n long, line string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        logs.write_cell_log(lines, str(tmp_path / "parts"), "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = logs.read_cell_log(spark, f"{tmp_path}/parts/*/*.log")
    assert back.select("line_no.block.path").distinct().count() > 7  # some days are in several parts
    for c, d in {(r[0], r[1]) for r in rows[:-1]}:
        got = back.filter((F.col("controller") == c) & (F.col("log_date") == d)).orderBy("line_no").collect()
        assert [r.line for r in got] == [r[3] for r in rows if r[:2] == (c, d)]
    logs.write_cell_log(lines, str(tmp_path / "whole"), "n", whole=True)
    whole = logs.read_cell_log(spark, f"{tmp_path}/whole/*/*.log")
    assert whole.count() == 901 and whole.select("line_no.block.path").distinct().count() == 7


def test_line_with_a_word(spark):
    text = "one a\ntwo b\ntwo a\n\nlast"
    words = ["a", "two", "two a", "last", "none", "one"]
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(*[replies.line_with(F.split("t", "\n"), w).alias(w) for w in words])
    assert [tuple(r) for r in df.collect()] == [("one a", "two b", "two a", "last", None, "one a"), (None,) * 6, (None,) * 6]


def test_journals_work_changes_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(1, T0), (2, datetime(2024, 1, 2))], "k long, time timestamp_ntz").mapInArrow(count, "k long, time timestamp_ntz")
    sinks.journal(df, str(tmp_path / "hot"), str(tmp_path / "all"), "time", "1")
    assert seen.value == 2
    for name in ("hot", "all"):
        assert sorted(r.k for r in sinks.read_journal(spark, str(tmp_path / name), ["k"]).collect()) == [1, 2]
    sinks.journal(df.limit(0), str(tmp_path / "hot"), str(tmp_path / "all"), "time", "2")
    assert sinks.read_journal(spark, str(tmp_path / "hot"), ["k"]).count() == 2


def test_export_deals_sites_over_tasks(spark, tmp_path):
    """Small sites are one file each, by several tasks; a busy one is several files. Nulls and equal rows stay."""
    rows = [(f"s{i}", T0, i) for i in range(40)] + [("busy", T0, i) for i in range(200)] + [(None, T0, 1)] * 3
    df = spark.createDataFrame(rows, "site string, at timestamp_ntz, v int")
    sinks.export_daily(df, str(tmp_path / "out"), "site", file_rows=50)
    files = {d.name: [f.name.split("-")[1] for f in d.glob("part-*")] for d in (tmp_path / "out").glob("site=*")}
    assert len(files["site=busy"]) > 1 and all(len(files[f"site=s{i}"]) == 1 for i in range(40))
    assert len({files[f"site=s{i}"][0] for i in range(40)}) > 1
    got = spark.read.schema("at string, v string, site string").option("sep", "|").csv(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(at.strftime("%Y-%m-%d %H:%M:%S"), str(v), site) for site, at, v in rows], key=str
    )


def test_export_takes_no_task_per_site(spark, tmp_path):
    """S11 writes, lists and reads its sites in as many tasks as for one site."""
    events = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    at = datetime(2024, 1, 19, 12, 0, 0, 500)
    rows = [(2 * i + k, at, i, "view", None if k else i + 0.5, "{}") for i in range(600) for k in range(2)]
    spark.createDataFrame(rows, events).write.parquet(str(tmp_path / "events.parquet"))
    spark.sparkContext.setJobGroup("export", "export")
    try:
        got = driver.queries()["s11_export_daily"](spark, str(tmp_path)).collect()
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert sorted(map(tuple, got), key=str) == sorted(
        [("2024-01-19 12:00:00", None if k else str(i), f"loc-{i}") for i in range(600) for k in range(2)], key=str
    )
    seen = spark.sparkContext.statusTracker()
    stages = {s for j in seen.getJobIdsForGroup("export") for s in seen.getJobInfo(j).stageIds}
    assert sum(seen.getStageInfo(s).numTasks for s in stages if seen.getStageInfo(s)) < 200


def test_export_is_what_spark_writes_and_reads(spark, tmp_path):
    sites = [chr(c) for c in range(1, 128) if chr(c) != "/"] + ["a/b", "..", "", " ", "_x", ".x", None, "x=y", "%41", "a+b", "Ab", "ab", "Ж"]
    texts = ["x|y", 'q"q', "", None, " lead", "tail ", "new\nline", "cr\rx", "\\", "   "]
    wide = spark.createDataFrame([(s, T0, i, t) for s in sites for i, t in enumerate(texts)], "site string, at timestamp_ntz, v int, t string")
    cases = {
        "wide": (wide, "at string, v int, t string"), "none": (wide.limit(0), "at string, v int, t string"),
        "one": (wide.select("site", "t"), "t string"),
        "number": (wide.select(F.length("t").alias("site"), "at", F.lit(1.5).alias("d"), F.lit(True).alias("b")), "at timestamp_ntz, d double, b boolean"),
    }
    for name, (df, schema) in cases.items():
        ours, theirs = tmp_path / name / "ours", tmp_path / name / "theirs"
        sinks.export_daily(df, str(ours), "site")
        df.coalesce(1).write.partitionBy("site").option("sep", "|").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(str(theirs))

        def held(folder):
            return {d.name: Counter(line for f in d.glob("part-*") for line in f.read_bytes().split(b"\n")[:-1]) for d in folder.glob("site=*")}

        assert held(ours) == held(theirs) and (ours / "_SUCCESS").exists()
        read, plain = sinks.read_export(spark, str(ours), schema, "site"), spark.read.schema(f"{schema}, site string").option("sep", "|").csv(str(theirs))
        assert read.schema == plain.schema and Counter(map(tuple, read.collect())) == Counter(map(tuple, plain.collect()))


def test_export_takes_the_place_of_the_last_one_when_whole(spark, tmp_path):
    def fail(batches):
        yield from batches
        raise ValueError("a lost task")

    df = spark.createDataFrame([("a", 1), ("b", 2)], "site string, v int")
    out = tmp_path / "out"
    sinks.export_daily(df, str(out), "site")
    with pytest.raises(Exception, match="a lost task"):
        sinks.export_daily(df.mapInArrow(fail, df.schema), str(out), "site")
    assert sorted(map(tuple, sinks.read_export(spark, str(out), "v int", "site").collect())) == [(1, "a"), (2, "b")]
    sinks.export_daily(df.filter("v = 2"), str(out), "site")
    assert [d.name for d in out.glob("site=*")] == ["site=b"] and [d.name for d in tmp_path.iterdir()] == ["out"]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.export_daily(df.filter("v = 1"), str(out), "site")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert sorted(map(tuple, sinks.read_export(spark, str(out), "v int", "site").collect())) == [(1, "a"), (2, "b")]
