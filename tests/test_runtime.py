"""The last row with its average, in one look at the rows, against the operators it stands for."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from pulsebook.operators import changes, current, runtime

SCHEMA = "k string, time timestamp_ntz, tie long, c smallint, v int"


@pytest.mark.parametrize("seed", range(4))
def test_against_latest_and_hours_per_day(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        key = rng.choice(["a", "b", "c", "d", None])
        at = datetime(2024, 1, 1) + timedelta(hours=rng.randint(0, 900))
        rows.append((key, at, i, rng.choice([None, *range(12)]) if key != "d" else rng.choice([32766, 32767]), rng.randint(0, 2)))
    rows += [("one", datetime(2024, 1, 1), 1000, 5, 1), ("none", datetime(2024, 1, 1), 1001, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    marked = changes.marked_changes(df, "k", "time", ["c", "v"], "tie", null_safe=False)
    kept = changes.changes(df, "k", "time", ["c", "v"], "tie", null_safe=False)
    assert Counter(marked.filter("changed").drop("changed").collect()) == Counter(kept.collect())
    averages = runtime.hours_per_day(kept, "k", "c", "time").selectExpr("k", "last_hour AS c", "average")
    names = ["k", "time", "tie", "c", "v", "average"]
    want = current.latest(df, "k", "time", "tie").join(averages, ["k", "c"], "left").select(*names)
    got = runtime.latest_with_average(marked, "k", "c", "time", "tie").select(*names)
    assert Counter(got.collect()) == Counter(want.collect())


def test_no_rows(spark):
    marked = changes.marked_changes(spark.createDataFrame([], SCHEMA), "k", "time", ["c"], "tie")
    assert runtime.latest_with_average(marked, "k", "c", "time", "tie").count() == 0
