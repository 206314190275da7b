"""Split and unsplit plans must agree, row for row."""

import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsebook.operators import escalation, folds
from pulsebook.operators.changes import changes, outages
from pulsebook.operators.timeline import Timeline

T0 = datetime(2024, 1, 1)


def readings(n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else f"k{rnd.randrange(12)}"
        t = T0 + timedelta(minutes=rnd.randrange(n // 2))
        rows.append((key, t, i, rnd.choice([None, *range(20, 60)]), rnd.random() < 0.5))
    return rows


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(readings(), "k string, time timestamp_ntz, id int, v int, up boolean")


def rows(df):
    return sorted(df.collect(), key=str)


def ops(df):
    line = Timeline.of(df, "k", "time", "id")
    out = line.previous("p", "v").following("n", "v").carry(c=F.col("v")).running(s=F.lit(1), t=F.col("v"))
    return {
        "line": out.rows(),
        "changes": changes(df, "k", "time", ["v"], "id"),
        "outages": outages(df, "k", "time", "up", "id"),
        "accept": folds.accept_within(df, "k", "time", "v", 4, "id"),
        "accept0": folds.accept_within(df, "k", "time", "v", 0, "id"),
        "runs": folds.run_index(df, "id", "k"),
    }


def test_split_equals_plain(spark, frame):
    plain = {n: rows(d) for n, d in ops(frame).items()}
    assert max(sizes(Timeline.of(frame, "k", "time", "id"))) > 100
    for every in (7, 60):
        spark.conf.set("pulsebook.split.rows", str(every))
        try:
            assert max(sizes(Timeline.of(frame, "k", "time", "id"))) < 10 * every
            for name, df in ops(frame).items():
                assert rows(df) == plain[name], name
        finally:
            spark.conf.unset("pulsebook.split.rows")


def test_building_a_plan_runs_nothing(spark, split):
    df = spark.range(100).select(F.raise_error(F.lit("read")).cast("int").alias("k"), "id", F.lit(1).alias("v"))
    line = Timeline.of(df, "k", "id").previous("p", "v").following("n", "v").carry(c=F.col("v")).running(s=F.lit(1))
    line.last("l", "v").rows()
    folds.accept_within(df, "k", "id", "v")


def test_cuts_are_bounded(spark, split, monkeypatch):
    from pulsebook.operators import timeline

    monkeypatch.setattr(timeline, "MOST_CUTS", 10)
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), "id")
    line = Timeline.of(df, "k", "id")
    # Ten cuts and three keys; a cut at a key's first row leaves nothing before it.
    assert 10 <= line.df.select("k", "_slice").distinct().count() <= 13
    assert all(r["n"] == r["id"] // 3 + 1 for r in line.running(n=F.lit(1)).rows().collect())


def test_cuts_in_many_blocks(spark, split, monkeypatch):
    from pulsebook.operators import timeline

    monkeypatch.setattr(timeline, "BLOCK", 3)
    df = spark.range(900).select((F.col("id") % 2).alias("k"), "id")
    line = Timeline.of(df, "k", "id")
    assert max(sizes(line)) <= 30 and line.df.select("_slice").distinct().count() > 100
    assert all(r["n"] == r["id"] // 2 + 1 for r in line.running(n=F.lit(1)).rows().collect())


def test_cuts_of_another_frame(spark, split):
    df = spark.range(1000).select(F.lit("k").alias("k"), "id")
    line = Timeline.of(df, "k", "id", like=df.filter("id % 2 = 0"))
    assert line.df.select("_slice").distinct().count() > 50
    assert all(r["p"] == (r["id"] - 1 if r["id"] else None) for r in line.previous("q", "id").rows().select("id", F.col("q.id").alias("p")).collect())


def sizes(line):
    return [r["count"] for r in line.df.groupBy(*line.parts).count().collect()]


def test_one_time_is_cut_by_its_tie(spark, split):
    df = spark.range(600).select(
        F.lit("k").alias("k"), F.when(F.col("id") >= 50, F.lit(T0)).cast("timestamp_ntz").alias("time"), "id",
        (F.col("id") % 7).alias("v"), (F.col("id") % 3 == 0).alias("up"),
    )
    line = Timeline.of(df, "k", "time", "id")
    assert max(sizes(line)) <= 30
    got = {r["id"]: r["p"] and r["p"]["id"] for r in line.previous("p", "id").rows().collect()}
    assert got == {i: i - 1 if i else None for i in range(600)}


def test_every_heavy_key_is_cut(spark, split):
    df = spark.range(40_000).select((F.col("id") % 400).alias("k"), "id", F.hash("id").alias("time"))
    line = Timeline.of(df, "k", "time", "id")
    assert max(sizes(line)) <= 30


def test_text_order(spark, split):
    df = spark.range(500).select(F.lit(1).alias("k"), F.format_string("2024-01-01 00:00:%04d", "id").alias("time"), "id")
    line = Timeline.of(df, "k", "time", "id").previous("p", "id").running(n=F.lit(1))
    assert max(sizes(line)) <= 30
    assert all(r["n"] == r["id"] + 1 and (r["p"] is None if not r["id"] else r["p"]["id"] == r["id"] - 1)
               for r in line.rows().collect())


def test_null_and_nan_positions(spark, split):
    df = spark.createDataFrame(
        [(1, None if i % 9 == 0 else float("nan") if i % 11 == 0 else float(i), i) for i in range(300)],
        "k int, time double, id int",
    )
    line = Timeline.of(df, "k", "time", "id")
    assert max(sizes(line)) <= 30
    plain = F.lag(F.struct("id")).over(Window.partitionBy("k").orderBy("time", "id"))
    assert rows(line.previous("p", "id").rows().select("id", "p")) == rows(df.select("id", plain.alias("p")))


def test_plain_against_python(frame):
    want = []
    by_key = {}
    for k, t, i, v, up in sorted(readings(), key=lambda r: (r[1], r[2])):
        p = by_key.get(k)
        if p is not None and p != (v,):
            want.append(i)
        by_key[k] = (v,)
    assert sorted(r["id"] for r in changes(frame, "k", "time", ["v"], "id").collect()) == sorted(want)


def test_accept_against_python(frame):
    last, want = {}, []
    for k, t, i, v, up in sorted(readings(), key=lambda r: (r[1], r[2])):
        if v is not None and (k not in last or abs(v - last[k]) <= 4):
            want.append(i)
            last[k] = v
    got = folds.accept_within(frame, "k", "time", "v", 4, "id").collect()
    assert sorted(r["id"] for r in got) == sorted(want)


@pytest.mark.parametrize("limit", [0.5, 3.0, 10.0])
def test_reach_describes_every_start(limit):
    rnd = random.Random(limit)
    for _ in range(100):
        xs = [rnd.choice([rnd.uniform(0, 60), float(rnd.randrange(60))]) for _ in range(rnd.randrange(1, 30))]
        reach = folds.Reach(limit)
        for x in xs:
            reach.add(x)
        for s in [*xs, *[rnd.uniform(-20, 80) for _ in range(20)], *[x + limit for x in xs]]:
            state = s
            for x in xs:
                if x - limit <= state <= x + limit:
                    state = x
            hit = [r[4] for r in reach.rows() if (r[0] < s or (r[0] == s and r[1])) and (r[2] > s or (r[2] == s and r[3]))]
            assert len(hit) <= 1
            assert (hit[0] if hit else s) == state


def test_reach_of_wide_spread_values():
    rnd = random.Random(5)
    reach, start = folds.Reach(4.0), time.perf_counter()
    for _ in range(300_000):
        reach.add(rnd.uniform(0, 1e6))
    assert len(reach.rows()) > 10_000
    assert time.perf_counter() - start < 30


def polls(n=300, seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in ("hot", "a", "b"):
        t = T0
        for _ in range(n if c == "hot" else n // 10):
            t += timedelta(minutes=rnd.choice([1, 1, 1, 30]))
            bad = rnd.random() < 0.9
            for pos, cell in enumerate([5, 3, 8]):
                rows.append((c, t, cell, "off" if bad and rnd.random() < 0.6 else "on", pos))
    return rows


def plain_escalation(rows, patience, waits):
    by_poll = {}
    for c, t, cell, status, pos in rows:
        by_poll.setdefault((c, t), []).append((pos, cell, status))
    out, state = [], {}
    for (c, t), cells in sorted(by_poll.items()):
        s = state.setdefault(c, {"n": {}, "again": False, "lock": None, "until": None})
        if s["until"] and t < s["until"]:
            continue
        bad = [cell for _, cell, st in sorted(cells) if st == "off"]
        if not bad:
            s["n"], s["again"] = {}, False
            continue
        s["n"][bad[0]] = s["n"].get(bad[0], 0) + 1
        if s["n"][bad[0]] > patience and s["lock"] != t.date():
            action = "reboot" if s["again"] else "restart"
            if s["again"]:
                s["lock"] = t.date()
            wait = waits[1] if s["again"] else waits[0]
            s["again"] = not s["again"]
            s["n"], s["until"] = {}, t + timedelta(seconds=wait)
            out.append((c, t, bad[0], action, wait))
    return out


@pytest.mark.parametrize("heavy", [False, True])
def test_escalation_against_python(spark, heavy, request):
    if heavy:
        request.getfixturevalue("split")
    rows = polls()
    df = spark.createDataFrame(rows, "controller string, time timestamp_ntz, cell int, status string, pos int")
    got = escalation.escalate(df, "controller", "time", "cell", "status", "pos", patience=2)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain_escalation(rows, 2, (100, 200)))
    watched = escalation.escalate(df, "controller", "time", "cell", "status", "pos", patience=2, watch_only=True)
    assert watched.count() == 0


@pytest.mark.parametrize("heavy", [False, True])
def test_patience_against_python(spark, heavy, request):
    if heavy:
        request.getfixturevalue("split")
    rows = polls(120)
    df = spark.createDataFrame(rows, "controller string, time timestamp_ntz, cell int, status string, pos int")
    want, counts = [], {}
    by_poll = {}
    for c, t, cell, status, pos in rows:
        by_poll.setdefault((c, t), []).append((pos, cell, status))
    for (c, t), cells in sorted(by_poll.items()):
        bad = [cell for _, cell, st in sorted(cells) if st == "off"]
        if not bad:
            counts[c] = {}
            continue
        n = counts.setdefault(c, {})
        n[bad[0]] = n.get(bad[0], 0) + 1
        want.append((c, t, bad[0], n[bad[0]]))
    got = escalation.patience(df, "controller", "time", "cell", "status", "pos")
    assert sorted(tuple(r) for r in got.select("controller", "time", "cell", "counter").collect()) == sorted(want)
