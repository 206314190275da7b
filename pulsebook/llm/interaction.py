"""How filters act together: what each removes in every order, and its Shapley share.

All that the audit needs of a part (a language) are 32 counts, one for each set of filters that a document can fail, so
documents are reduced to these before anything else. The removal game of a part gives a coalition of filters the
documents that it removes. Its Hart-Mas-Colell potential is built up over the 32 coalitions, smaller ones first:
P(S) = (v(S) + sum of P(S without i)) / |S|. A filter's Shapley value is the potential of all filters less that of all
others, and the step of a filter after others is the difference of two coalitions.

Equal texts are found by digest: copies are counted per digest, part and set before they are shuffled, so a text that a
third of all documents share is no hot key.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsebook.llm.common import query, slices, stage, table

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
_CAPITALS = bytes(range(65, 91))
_SIGNS = re.compile(rb"[#$%&*|]")


def failures(text: str) -> int:
    """The filters A to D that a text fails, as bits."""
    data = text.encode()
    # Bytes split at exactly the six white space characters of ASCII.
    own = data.split()
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    return (
        (len(own) < LEAST_WORDS)
        | (100 * len({*own}) < DISTINCT_PERCENT * len(own)) << 1
        | (100 * capitals > CAPITAL_PERCENT * len(text)) << 2
        | bool(_SIGNS.search(data)) << 3
    )


def _examined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        fails = pa.array([failures(t) for t in texts], pa.int32())
        digests = pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("part"), fails, digests], names=["key", "part", "fails", "digest"]
        )


def failed_sets(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Documents by ``part`` and ``fails`` (bits, A lowest): ``n``, and of these ``good`` and ``toxic`` ones.

    Text and part that are null count as empty. A row fails E if a row with a smaller key has the same text; null keys
    come after all others, and rows that share the smallest key all pass. A document is good (toxic) if any of its label
    rows says 1; null keys have no labels.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    found = rows.mapInArrow(_examined, f"key {kind}, part string, fails int, digest binary")
    # Repeated rows become one, so that a key of many rows is one row in the join.
    found = stage(found.groupBy("key", "part", "fails", "digest").agg(F.count("*").alias("n")), "failures")
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    no = F.lit(False)
    known = (
        found.where("key IS NOT NULL").join(marks, "key", "left")
        .withColumns({c: F.coalesce(c, no) for c in ("good", "toxic")})
        .unionByName(found.where("key IS NULL").withColumns({"good": no, "toxic": no}))
    )
    # Of each kind of copies how many, the smallest key, and how many rows have it.
    place = F.struct(F.col("key").isNull().alias("none"), "key")
    alike = ["digest", "part", "fails", "good", "toxic"]
    copies = known.groupBy(*alike).agg(F.sum("n").alias("n"), F.min(F.struct(place.alias("place"), (-F.col("n")).alias("less"))).alias("first"))
    kinds = F.struct("part", "fails", "good", "toxic", "n", "first")
    least = copies.groupBy("digest").agg(F.min("first.place").alias("least"))
    passed = F.when(F.col("first.place") == F.col("least"), -F.col("first.less")).otherwise(0)
    split = (
        copies.join(least, "digest")
        .select("part", "good", "toxic", F.explode(F.array(
            F.struct("fails", passed.alias("n")), F.struct((F.col("fails") + 16).alias("fails"), (F.col("n") - passed).alias("n")),
        )).alias("of"))
        .select("part", "good", "toxic", "of.*")
    )
    some = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return split.where("n > 0").groupBy("part", "fails").agg(F.sum("n").alias("n"), some(F.col("good")).alias("good"), some(F.col("toxic")).alias("toxic"))


def removed_by(counts: np.ndarray) -> np.ndarray:
    """For every coalition the documents that fail at least one of its filters."""
    sets = np.arange(SETS)
    return np.array([counts[sets & own != 0].sum() for own in sets])


def potentials(game: np.ndarray) -> list[int]:
    """The potential of every coalition, times the least common multiple of the coalitions' sizes: whole numbers."""
    scale = math.lcm(*range(1, len(FILTERS) + 1))
    out = [0] * SETS
    for own in range(1, SETS):
        members = [1 << i for i in range(len(FILTERS)) if own >> i & 1]
        out[own] = (scale * int(game[own]) + sum(out[own ^ m] for m in members)) // len(members)
    return out


def steps(counts: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> list[tuple]:
    """filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley of all orders."""
    game, good_game, toxic_game = (removed_by(x) for x in (counts, good, toxic))
    of_game, total = potentials(game), int(counts.sum())
    orders = math.factorial(len(FILTERS))
    scale = math.lcm(*range(1, len(FILTERS) + 1))
    shapley = [(of_game[-1] - of_game[(SETS - 1) ^ (1 << i)]) * orders // scale for i in range(len(FILTERS))]
    out = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = int(game[after] - game[before])
            out.append((
                name, step, total - int(game[after]), removed, int(game[1 << i]) - removed, int(counts[1 << i]),
                int(good_game[after] - good_game[before]), int(toxic_game[after] - toxic_game[before]), shapley[i],
            ))
            before = after
    return out


_COLUMNS = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            own = np.zeros((3, SETS), np.int64)
            for s in row["sets"]:
                own[:, s["fails"]] = s["n"], s["good"], s["toxic"]
            columns = list(zip(*steps(*own)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * len(columns[0])), pa.array(columns[0]), pa.array(columns[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in columns[2:])],
                names=["part", *_COLUMNS],
            )


def audit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step; see ``failed_sets`` for nulls, ties and repeated rows.

    Very long texts are examined whole, each in one task. An empty table has no parts and gives no rows; other columns
    are ignored.
    """
    counts = failed_sets(df, labels, key, text, part)
    # At most 32 sets a part.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets"))
    types = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COLUMNS[2:])
    return parts.mapInArrow(_audited, types)


SQL = rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
f AS (SELECT doc_id, part, [len(words) < {LEAST_WORDS}, 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words),
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > {CAPITAL_PERCENT} * length(text),
    regexp_matches(text, '[#$%&*|]'), doc_id > least] AS fails FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
x AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT part, o, i AS step, o[i] AS own, fails, n, good, toxic, fails[o[i]] AS hit,
    len(list_filter(range(1, 6), lambda k: k < i AND fails[o[k]])) > 0 AS gone,
    len(list_filter(range(1, 6), lambda k: fails[k])) = 1 AS one FROM g, o, x),
r AS (SELECT part, o, step, any_value(own) AS own, sum(n) FILTER (NOT gone AND NOT hit) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed,
    sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (hit AND one) AS unique_fails,
    sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(toxic) FILTER (hit AND NOT gone) AS toxic_lost FROM s GROUP BY 1, 2, 3)
SELECT part, array_to_string(list_transform(o, lambda k: substr('{FILTERS}', CAST(k AS INT), 1)), '') AS filter_order, step::INT AS step,
    coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
    coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    sum(coalesce(removed, 0)) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM r"""


@query("op13_filter_interaction", SQL)
def op13_filter_interaction(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove, one after the other, in all orders and for every language."""
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
