"""Resampling against a plain form of itself."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pulsebook.llm import resample


def test_crcs():
    rng = random.Random(21)
    items = [b""] + [rng.randbytes(rng.randint(1, 40)) for _ in range(3000)] + [rng.randbytes(5000)]
    assert resample.crc_matrices(items).tolist() == [zlib.crc32(x) for x in items]
    assert resample.crc_matrices([]).tolist() == []


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@pytest.mark.parametrize("text", ["", "A b-C9\u0000Éx İ ÀB", "🙂a b c", "__x__ 7:8;", "É" * 9])
def test_words(text):
    assert [w.decode() for w in resample.words(text)] == plain_words(text)


def plainly(rows, target, buckets, longest, seed, least, percent):
    def runs(text):
        own = plain_words(text)
        return [" ".join(own[i : i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]

    place = lambda w: zlib.crc32(w.encode()) % buckets
    s, t = (Counter(place(w) for x in texts for w in runs(x)) for texts in ([x for _, x in rows], target))
    S, T = s.total(), t.total()
    out = []
    for key, text in rows:
        own = runs(text)
        weight = sum(math.floor(1000 * math.log((t[place(w)] + 1) * (S + buckets) / ((s[place(w)] + 1) * (T + buckets)))) for w in own)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(own), weight, score, len(plain_words(text)) >= least])
    order = sorted((i for i in range(len(out)) if out[i][4]), key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0))
    ranks = {i: n for n, i in enumerate(order[: percent * len(order) // 100], 1)}
    return Counter((k, n, w, x, ranks.get(i)) for i, (k, n, w, x, _) in enumerate(out))


@pytest.mark.parametrize("buckets, longest, percent", [(10_000, 1, 10), (7, 2, 50), (100_000, 3, 100)])
def test_against_the_plain_form(spark, docs, buckets, longest, percent):
    rng = random.Random(22)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "ß9"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(400)]
    # Copies with one key tie in everything.
    rows += [(r.doc_id, r.text) for r in docs.collect()] + [(None, rows[0][1])] * 5 + [rows[1]] * 5
    target = [" ".join(rng.choices(vocabulary[:20], k=30)) for _ in range(20)] + [None, ""]
    frame = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "doc_id long, text string, score string, place int").repartition(7)
    goal = spark.createDataFrame([(t, "x") for t in target], "text string, key string")
    got = resample.resampled(frame, goal, buckets=buckets, longest=longest, percent=percent)
    assert got.columns == ["key", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == plainly(rows, target, buckets, longest, 2024, 20, percent)


def test_empty_tables(spark, docs, nothing):
    goal = spark.createDataFrame([("a b",)], "text string")
    assert resample.resampled(nothing, goal).count() == 0
    rows = resample.resampled(docs, goal.limit(0)).collect()
    assert len(rows) == docs.count()


def test_counts_do_not_depend_on_what_a_task_remembers(spark, monkeypatch):
    monkeypatch.setattr(resample, "REMEMBERED", 3)
    hasher = resample.Hasher(1000, 1)
    for _ in range(3):
        found, sizes, _ = hasher(["a b c d e", None, "e d"])
        assert found.tolist() == [zlib.crc32(w) % 1000 for w in (b"a", b"b", b"c", b"d", b"e", b"e", b"d")] and sizes.tolist() == [5, 0, 2]
    assert np.issubdtype(found.dtype, np.uint16)
