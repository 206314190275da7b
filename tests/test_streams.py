"""Streams over several batches against the batch operators, and the tables they keep."""

import random
from datetime import datetime, timedelta

import pytest

from pulsebook.operators import changes, folds, latch
from pulsebook.streaming import batched, tables, waiting
from pulsebook.streaming.sources import run_stream, stream_table

T0 = datetime(2024, 1, 1)
SCHEMA = "k string, time timestamp_ntz, id bigint, v int, cmd string"
COMMANDS = ["auto_on", "auto_off", "v5_on", "v5_off"]


def rows(n=240):
    rnd = random.Random(5)
    out = []
    for i in range(n):
        command = rnd.choice(COMMANDS) if rnd.random() < 0.3 else None
        v = None if command else rnd.choice([None, *range(15, 45)])
        out.append((f"k{rnd.randrange(4)}", T0 + timedelta(minutes=i // 2), i, v, command))
    return out


def land(spark, path, parts, schema=SCHEMA):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    return stream_table(spark, f"{path}/in", spark.createDataFrame([], schema).schema, files_per_batch=1)


@pytest.fixture
def landed(spark, tmp_path):
    """Four files, one per batch, and the whole frame."""
    data = rows()
    stream = land(spark, tmp_path, [data[i * 60 : (i + 1) * 60] for i in range(4)])
    return stream, spark.createDataFrame(data, SCHEMA), tmp_path


def result(spark, path, start):
    """What a stream puts into its sink; ``start`` makes its writer from a state folder and the sink."""
    run_stream(start(f"{path}/state", batched.file_sink(f"{path}/out")), f"{path}/checkpoint")
    return batch(spark.read.parquet(f"{path}/out").drop("batch"))


def batch(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("null_safe", [True, False])
def test_changes(spark, landed, null_safe):
    stream, whole, path = landed
    got = result(spark, path, lambda state, sink: batched.stream_changes(stream, "k", "time", ["v", "cmd"], "id", state, sink, null_safe))
    assert got == batch(changes.changes(whole, "k", "time", ["v", "cmd"], "id", null_safe))


@pytest.mark.parametrize("exempt", [None, "k1"])
def test_changes_within(spark, landed, exempt):
    stream, whole, path = landed
    free = whole.k == exempt if exempt else None
    got = result(spark, path, lambda state, sink: batched.stream_changes_within(
        stream, "k", "time", "v", "id", state, sink, 5, stream.k == exempt if exempt else None))
    assert got == batch(changes.changes_within(whole, "k", "time", "v", 5, free, "id"))


def test_accept(spark, landed):
    stream, whole, path = landed
    got = result(spark, path, lambda state, sink: batched.stream_accept_within(stream, "k", "time", "v", "id", state, sink, 4))
    assert got == batch(folds.accept_within(whole, "k", "time", "v", 4, "id"))


def test_latch(spark, landed):
    stream, whole, path = landed
    got = result(spark, path, lambda state, sink: batched.stream_latch_with_commands(stream, "k", "time", "v", "cmd", "id", state, sink))
    out = spark.read.parquet(f"{path}/out").drop("batch")
    assert got == batch(latch.latch_with_commands(whole, "k", "time", "v", "cmd", tie="id").select(*out.columns))


def forms(stream, state, sink, **more):
    return {
        "changes": lambda: batched.stream_changes(stream, "k", "time", ["v", "cmd"], "id", state, sink, **more),
        "within": lambda: batched.stream_changes_within(stream, "k", "time", "v", "id", state, sink, 5, **more),
        "accept": lambda: batched.stream_accept_within(stream, "k", "time", "v", "id", state, sink, 4, **more),
        "latch": lambda: batched.stream_latch_with_commands(stream, "k", "time", "v", "cmd", "id", state, sink, **more),
    }


PLAIN = {
    "changes": lambda df: changes.changes(df, "k", "time", ["v", "cmd"], "id"),
    "within": lambda df: changes.changes_within(df, "k", "time", "v", 5, tie="id"),
    "accept": lambda df: folds.accept_within(df, "k", "time", "v", 4, "id"),
    "latch": lambda df: latch.latch_with_commands(df, "k", "time", "v", "cmd", tie="id"),
}


@pytest.mark.parametrize("form", sorted(PLAIN))
def test_lateness(spark, tmp_path, form):
    """Rows up to half an hour late, and a few that are later or have no time."""
    data, rnd = rows(), random.Random(7)
    order = sorted(data, key=lambda r: r[1] + timedelta(minutes=rnd.randrange(30)))
    parts = [order[i * 60 : (i + 1) * 60] for i in range(4)]
    lost = [("k1", T0 - timedelta(days=1), -1, 3, None), ("k2", None, -2, 3, None), ("k0", T0, 1000, 30, None)]
    parts[3] = parts[3] + lost
    stream = land(spark, tmp_path, parts)
    late = batched.file_sink(f"{tmp_path}/late")
    got = result(spark, tmp_path, lambda state, sink: forms(stream, state, sink, late=late, delay=1800)[form]())
    mark = max(r[1] for r in data) - timedelta(minutes=30)
    taken = spark.createDataFrame([r for r in data if r[1] < mark], SCHEMA)
    out = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    assert got == batch(PLAIN[form](taken).select(*out.columns))
    assert batch(spark.read.parquet(f"{tmp_path}/late").drop("batch")) == sorted(lost, key=str)


def test_rows_of_one_time_wait_for_each_other(spark, tmp_path):
    wait = waiting.Waiting(spark, str(tmp_path), "time", 0)
    frame = lambda *items: spark.createDataFrame([(T0 + timedelta(minutes=m), i) for m, i in items], "time timestamp_ntz, id int")
    given = []
    for n, part in enumerate([frame((1, 1), (2, 2)), frame((2, 3)), frame((3, 4), (1, 5))]):
        ready, late, _ = wait.release(part, n)
        given.append((sorted(r.id for r in ready.collect()), [r.id for r in late.collect()]))
    assert given == [([1], []), ([], []), ([2, 3], [5])]


def test_a_batch_that_runs_again_releases_the_same(spark, tmp_path):
    wait = waiting.Waiting(spark, str(tmp_path), "time", 60)
    part = spark.createDataFrame([(T0 + timedelta(minutes=m),) for m in range(5)], "time timestamp_ntz")
    wait.release(part, 0)
    more = spark.createDataFrame([(T0 + timedelta(minutes=m),) for m in range(5, 9)], "time timestamp_ntz")
    assert len({tuple(sorted(r.time for r in wait.release(more, 1)[0].collect())) for _ in range(3)}) == 1


def test_sessions(spark, tmp_path):
    rnd = random.Random(3)
    data = sorted((f"k{rnd.choice([0, 0, 0, 1, 2])}", T0 + timedelta(minutes=rnd.randrange(3000))) for _ in range(300))
    order = sorted(data, key=lambda r: r[1] + timedelta(minutes=rnd.randrange(60)))
    stream = land(spark, tmp_path, [order[i * 75 : (i + 1) * 75] for i in range(4)], "k string, time timestamp_ntz")
    got = result(spark, tmp_path, lambda state, sink: batched.stream_sessions(stream, "k", "time", 1200, state, sink, 3600))
    mark, want, open_ = max(t for _, t in data) - timedelta(hours=1), [], {}
    for k, t in sorted(data, key=lambda r: r[1]):
        if k in open_ and t - open_[k][1] <= timedelta(minutes=20):
            open_[k] = (open_[k][0], t, open_[k][2] + 1)
            continue
        if k in open_:
            want.append((k, *open_[k]))
        open_[k] = (t, t, 1)
    want += [(k, *s) for k, s in open_.items()]
    assert got == sorted([w for w in want if w[2] + timedelta(minutes=20) <= mark], key=str) and len(got) > 10


def test_current_table_survives_a_repeated_batch(spark, tmp_path):
    table = tables.CurrentTable(spark, f"{tmp_path}/t")
    assert table.read() is None
    for n in (0, 1, 2, 2):
        old = table.read(before=n)
        seen = 0 if old is None else old.first()["n"]
        table.replace(spark.createDataFrame([(seen + 1,)], "n int"), n)
    assert table.read().first()["n"] == 3
    assert table.records.numbers() == [1, 2]


def test_a_batch_of_one_key_writes_one_bucket(spark, tmp_path):
    table = tables.CurrentTable(spark, f"{tmp_path}/t", "k", 16)
    newer = lambda old, new: old.join(new, "k", "left_anti").unionByName(new)
    frame = lambda keys, v: spark.createDataFrame([(k, v) for k in keys], "k int, v int")
    table.merge(frame(range(200), 0), 0, newer)
    before = table.records.newest()["buckets"]
    for _ in range(2):
        table.merge(frame([7], 1), 1, newer)
    after = table.records.newest()["buckets"]
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    assert {tuple(r) for r in table.read().collect()} == {(k, int(k == 7)) for k in range(200)}
    table.merge(frame([500], 2), 2, newer)
    assert table.read().count() == 201 and table.read(before=1).count() == 200 if 0 in table.records.numbers() else True


def test_a_missing_batch_is_an_error(spark, tmp_path):
    table = tables.CurrentTable(spark, f"{tmp_path}/t", "k")
    table.merge(spark.createDataFrame([(1,)], "k int"), 0, lambda old, new: new)
    with pytest.raises(FileNotFoundError):
        table.read(before=2)
    with pytest.raises(FileNotFoundError):
        tables.CurrentTable(spark, f"{tmp_path}/other", "k").merge(spark.createDataFrame([(1,)], "k int"), 3, lambda old, new: new)


def test_a_batch_is_worked_out_once(spark, landed, monkeypatch):
    """The operator reads remembered and new rows from a table of their own, and leaves none behind."""
    stream, whole, path = landed
    seen, operator = [], batched.changes

    def spied(rows, *rest):
        seen.append(rows.inputFiles())
        return operator(rows, *rest)

    monkeypatch.setattr(batched, "changes", spied)
    got = result(spark, path, lambda state, sink: batched.stream_changes(stream, "k", "time", ["v"], "id", state, sink))
    assert got == batch(operator(whole, "k", "time", ["v"], "id"))
    assert len(seen) == 4 and all(files and all("/state/taken/" in f for f in files) for files in seen)
    assert not (path / "state" / "taken").exists()
