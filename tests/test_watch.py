"""The station watch against the literal loop: read the day's log at each poll, fold it, check the list in order."""

import random
from datetime import datetime, timedelta

import pytest

from pulsebook.operators import cells, escalation, folds, watch
from pulsebook.streaming import batched
from pulsebook.streaming.sources import run_stream, stream_table

T0 = datetime(2024, 3, 1)
LINES = "controller string, time timestamp_ntz, log_date date, line_no long, line string"


def history(days=6, seed=1, lines=260, every=47):
    """Log lines and polls of two controllers; one has few stations, so that it is often healthy."""
    rnd = random.Random(seed)
    made, polls, n = [], [], 0
    for name, stations, share in (("busy", [3, 1, 12, 2, 7], 1.0), ("calm", [4, 9], 0.4)):
        for _ in range(int(lines * share)):
            t = T0 + timedelta(minutes=rnd.randrange(days * 1440))
            said = rnd.choice(["off", "on", "on", "busy"])
            made.append((name, t, t.date(), n, f"cell {rnd.choice(stations + [99])}  {said}"))
            n += 1
        t = T0 + timedelta(minutes=30)
        while t < T0 + timedelta(days=days):
            polls.append((name, t))
            t += timedelta(minutes=rnd.choice([every, every, 3]))
    made.sort(key=lambda r: (r[1], r[3]))
    registry = [("busy", c, "not" if c == 7 else "do", p) for p, c in enumerate([3, 1, 12, 2, 7])]
    return made, polls, registry + [("calm", 9, "do", 0), ("calm", 4, None, 1)]


def literally(lines, polls, registry, patience, waits, watch_only=False):
    """What the loop decides, and its patience counters."""
    made, counted = [], []
    for name in sorted({c for c, _ in polls}):
        stations = [(c, check) for k, c, check, _ in sorted(registry, key=lambda r: r[3]) if k == name]
        off, count, again, lock, until = {}, {}, False, None, None
        for t in sorted({t for c, t in polls if c == name}):
            if until and t < until:
                continue
            until = None
            for of, at, day, _, line in lines:
                if of == name and day == t.date() and at <= t:
                    cell, said = line.split()[1:]
                    if said in ("off", "on"):
                        off[int(cell)] = said == "off"
            bad = [c for c, check in stations if check != "not" and off.get(c)]
            if not bad:
                off, count, again = {}, {}, False
                continue
            count[bad[0]] = count.get(bad[0], 0) + 1
            counted.append((name, t, bad[0], count[bad[0]]))
            if not watch_only and count[bad[0]] > patience and lock != t.date():
                action, pause = ("reboot", waits[1]) if again else ("restart", waits[0])
                made.append((name, t, bad[0], action, pause))
                lock = t.date() if again else lock
                again, off, count, until = not again, {}, {}, t + timedelta(seconds=pause)
    return made, counted


def frames(spark, lines, polls, registry):
    return (
        spark.createDataFrame(lines, LINES), spark.createDataFrame(polls, "controller string, time timestamp_ntz"),
        spark.createDataFrame(registry, "controller string, cell int, check string, position long"),
    )


def steps(spark, lines, polls, registry):
    log, asked, stations = frames(spark, lines, polls, registry)
    return watch.first_failing_steps(watch.seen_events(cells.cell_events(log), asked), stations, asked)


@pytest.mark.parametrize("heavy", [False, True])
@pytest.mark.parametrize("seed, patience, waits, every", [(1, 1, (100, 200), 47), (2, 2, (5400, 90_000), 20), (3, 0, (7200, 10_800), 90)])
def test_decisions(spark, heavy, seed, patience, waits, every, request):
    if heavy:
        request.getfixturevalue("split")
    data = history(seed=seed, every=every, days=4)
    want, _ = literally(*data, patience, waits)
    got = escalation.escalate_watch(steps(spark, *data), "controller", "time", patience, waits)
    assert len(want) > 2 and sorted(map(tuple, got.collect())) == sorted(want)


def test_counters_of_a_watch_that_never_acts(spark):
    data = history(seed=4)
    made, counted = literally(*data, 1, (100, 200), watch_only=True)
    seen = steps(spark, *data)
    first = seen.select("controller", "time", watch.first_failing_cell().alias("cell"))
    got = escalation.patience_counters(first, "controller", "time", "cell")
    assert sorted(map(tuple, got.select("controller", "time", "cell", "counter").collect())) == sorted(counted)
    assert not made and escalation.escalate_watch(seen, "controller", "time", 1, watch_only=True).count() == 0


def poll(minute, *failing):
    return T0 + timedelta(minutes=minute), [{"since": d, "position": 0, "cell": c} for d, c in failing]


def test_slice_table_knows_every_state():
    """Any state run through a slice ends where the slice's table says."""
    rnd = random.Random(8)
    for _ in range(60):
        patience, waits = rnd.choice([0, 1, 3]), (rnd.choice([60, 3600]), rnd.choice([120, 50_000]))
        rules = escalation.Escalation(patience, waits, False)
        days = [(T0 + timedelta(days=d)).date() for d in range(-3, 4)]
        polls, minute = [], 0
        for _ in range(rnd.randrange(1, 120)):
            minute += rnd.choice([1, 30, 400])
            today = (T0 + timedelta(minutes=minute)).date()
            some = sorted({d for d in rnd.choices(days, k=rnd.randrange(0, 4)) if d <= today}, reverse=True)
            polls.append(poll(minute, *[(d, rnd.randrange(4)) for d in some]))
        table = escalation.SliceTable(rules, polls[0][0])
        for p in polls:
            table.take(*p)
        rows = table.rows()
        for _ in range(30):
            before = polls[0][0] - timedelta(minutes=rnd.randrange(1, 300))
            state = {"counts": {str(c): rnd.randrange(patience + 2) for c in range(4)}, "again": rnd.random() < 0.5,
                     "lock": rnd.choice([None, before.toordinal()]), "resume": None, "floor": rnd.choice(days[:3]).toordinal()}
            if rnd.random() < 0.4:
                state |= {"resume": before + timedelta(seconds=rnd.choice(waits)), "floor": None, "counts": {}}
            true, short = rules.like(**state), rules.like(**state | {"counts": dict(state["counts"])})
            for p in polls:
                true.poll(*p)
            for _, t, failing, *ends in rows:
                short.poll(t, failing)
                if short.reset:
                    short = escalation.Escalation(patience, waits, False, ends[escalation.RESETS.index(short.reset)])
                    break
            assert short.state() == true.state()


def test_a_slice_table_stays_small():
    rules = escalation.Escalation(5, (100, 200), False)
    table = escalation.SliceTable(rules, T0)
    for i in range(20_000):
        table.take(*poll(i, ((T0 + timedelta(minutes=i)).date(), i % 3)))
    assert len(table.head) < 2000 and len(table.runs) == 1


def test_events_after_the_last_poll_of_a_day_are_never_read(spark):
    lines = [("c", T0 + timedelta(hours=23), T0.date(), 1, "cell 1  off"), ("c", T0 + timedelta(hours=1), T0.date(), 0, "cell 2  off")]
    polls = [("c", T0 + timedelta(hours=22)), ("c", T0 + timedelta(hours=30))]
    registry = [("c", 1, "do", 0), ("c", 2, "do", 1), ("c", 3, "do", 2)]
    rows = steps(spark, lines, polls, registry).orderBy("time").collect()
    assert [[(s.cell, s.since) for s in r.failing] for r in rows] == [[(2, T0.date())], [(2, T0.date())]]


def test_nothing(spark):
    assert steps(spark, [], [("c", T0)], [("c", 1, "do", 0)]).collect()[0].failing == []
    seen = steps(spark, [], [], [])
    assert seen.count() == 0 and escalation.escalate_watch(seen, "controller", "time").count() == 0


def test_polls_cut_by_batches(spark, tmp_path):
    """Lines and polls land in files of any content and order within the allowed lateness, one file a batch."""
    lines, polls, registry = history(seed=5, days=2, lines=100, every=60)
    log, asked, stations = frames(spark, lines, polls, registry)
    rows = batched.watch_rows(log, asked)
    rnd = random.Random(6)
    data = sorted((r["time"] + timedelta(minutes=rnd.randrange(600)), tuple(r)) for r in rows.collect())
    size = -(-len(data) // 3)
    for i in range(3):
        part = spark.createDataFrame([r for _, r in data[i * size : (i + 1) * size]], rows.schema)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = stream_table(spark, f"{tmp_path}/in", rows.schema, files_per_batch=1)
    sink, late = batched.file_sink(f"{tmp_path}/out"), batched.file_sink(f"{tmp_path}/late")
    run_stream(batched.stream_watch(stream, stations, f"{tmp_path}/state", sink, 36_000, late, 1, (100, 200)), f"{tmp_path}/check")
    mark = max(r["time"] for r in rows.collect()) - timedelta(hours=10)
    want = [r for r in literally(lines, polls, registry, 1, (100, 200))[0] if r[1] < mark]
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    assert len(want) > 2 and sorted(map(tuple, got.collect())) == sorted(want)
    assert spark.read.parquet(f"{tmp_path}/late").count() == 0


def test_chain_holds_one_value(spark, split):
    """Slices of which some are all null, in a key that many starting values go through."""
    rnd = random.Random(9)
    values = [None if 200 <= i < 260 else rnd.uniform(0, 400) for i in range(900)]
    frame = spark.createDataFrame([("k", T0 + timedelta(minutes=i), i, v) for i, v in enumerate(values)], "k string, time timestamp_ntz, id int, v double")
    last, want = None, []
    for i, v in enumerate(values):
        if v is not None and (last is None or abs(v - last) <= 3):
            want.append(i)
            last = v
    assert sorted(r.id for r in folds.accept_within(frame, "k", "time", "v", 3, "id").collect()) == want
