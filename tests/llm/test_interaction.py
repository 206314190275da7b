"""The audit against filters applied one after the other."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np

from pulsebook.llm import interaction


def fails(rows):
    """Sets of letters that each row (key, text, part) fails."""
    out = []
    for key, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = set()
        if len(words) < 200:
            own.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            own.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            own.add("C")
        if re.search("[#$%&*|]", text):
            own.add("D")
        number = lambda k: (k is None, k or 0)
        if any((t or "") == text and number(k) < number(key) for k, t, _ in rows):
            own.add("E")
        out.append(own)
    return out


def plainly(rows, good, toxic):
    sets, out = fails(rows), Counter()
    for part in {p or "" for _, _, p in rows}:
        mine = [(k, f) for (k, _, p), f in zip(rows, sets) if (p or "") == part]
        removed_in_all = Counter()
        steps = []
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                hit = [(k, f) for k, f in left if letter in f]
                left = [(k, f) for k, f in left if letter not in f]
                removed_in_all[letter] += len(hit)
                steps.append((letter, (
                    part, "".join(order), step, len(left), len(hit), sum(letter in f for _, f in mine) - len(hit), sum(f == {letter} for _, f in mine),
                    sum(k in good for k, _ in hit), sum(k in toxic for k, _ in hit),
                )))
        out.update((*row, removed_in_all[letter]) for letter, row in steps)
    return out


def test_against_filters_in_turn(spark, docs):
    rng = random.Random(31)
    words = ["alpha", "beta", "Gamma", "#x", "DELTA", "eps ilon"] + [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words[: rng.choice([3, 5, 306])], k=rng.choice([0, 5, 199, 200, 250]))) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(300)]
    rows += [(r.doc_id, r.text, r.lang) for r in docs.collect()] + [(None, texts[0], "en")] * 3 + [rows[5]] * 4
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 250)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    good, toxic = {k for k, q, _ in labels if q == 1 and k is not None}, {k for k, _, t in labels if t == 1 and k is not None}
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, part string, fails int").repartition(6)
    out = interaction.audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert Counter(map(tuple, out.collect())) == plainly(rows, good, toxic)


def test_a_text_of_very_many_copies_is_counted_before_it_moves(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frame = spark.range(20_000).selectExpr("id + 1 AS doc_id", "'same' AS text", "'en' AS lang")
    rows = interaction.failed_sets(frame, labels).collect()
    assert {(r.fails, r.n) for r in rows} == {(1 | 1 << 4, 19_999), (1, 1)}


def test_potential():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 10**12, interaction.SETS)
    game = interaction.removed_by(counts)
    found = interaction.potentials(game)
    # Efficiency: the Shapley values sum up to what all filters remove.
    assert sum(found[-1] - found[31 ^ 1 << i] for i in range(5)) == 60 * int(game[-1])


def test_empty_tables(spark, docs, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(nothing, labels).count() == 0
    assert interaction.audit(docs, labels).count() == 2 * 600


def test_very_long_text():
    assert interaction.failures("long " * 10**6) == 2 and interaction.failures("") == 1
