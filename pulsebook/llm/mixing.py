"""Mixing sources to target weights by Pfair scheduling.

A source's documents are cut into blocks. With the weight ``w`` of a source, its block ``j`` is released at slot
``floor(j / w)`` and due at ``ceil((j + 1) / w)``; every slot goes to the released block that is due first. At any
slot a source is then less than one block away from its share.

Weights are whole numbers of slots in a cycle of ``cycle`` slots. A cycle is scheduled once, on the driver
(``cycle`` steps, whatever the data), and every later cycle repeats it. When a source has no blocks left, the
others go on with their weights scaled up, by a schedule of their own; so there are at most two schedules per
source, and every document gets a place.

The number of a document within its source is the sum over earlier buckets of documents plus its number in its
bucket. Buckets are hashes of the key and of the row's file and number in it, so a source with a third of all rows is
numbered by many tasks, also where its keys are null or all alike. Only ids move for that; the rows themselves move
once, to their ranks. The order within a source is by hash: a shuffle.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulsebook.llm.common import identified, query, table

BLOCK_ROWS = 64
CYCLE = 1000
BUCKETS = 1 << 14
NONE = ""


def shares(weights: dict[str, float], cycle: int) -> dict[str, int]:
    """Whole slots per cycle, at least one each, by greatest remainders."""
    names = sorted(weights)
    if len(names) > cycle:
        raise ValueError("more sources than slots in a cycle")
    total = sum(weights.values())
    exact = {n: weights[n] / total * cycle for n in names}
    slots = {n: max(1, int(exact[n])) for n in names}
    while (left := cycle - sum(slots.values())) != 0:
        step = 1 if left > 0 else -1
        pick = max((n for n in names if slots[n] + step > 0), key=lambda n: step * (exact[n] - slots[n]))
        slots[pick] += step
    return slots


def pfair(slots: dict[str, int]) -> dict[str, list[int]]:
    """The slots of every source in one cycle: earliest deadline first among the released blocks."""
    cycle = sum(slots.values())
    due = lambda n, j: -(-(j + 1) * cycle // slots[n])
    waiting = [(0, n, 0) for n in sorted(slots)]
    ready: list[tuple[int, str, int]] = []
    heapq.heapify(waiting)
    places: dict[str, list[int]] = {n: [] for n in slots}
    for t in range(cycle):
        while waiting and waiting[0][0] <= t:
            _, n, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due(n, j), n, j))
        _, n, j = heapq.heappop(ready)
        places[n].append(t)
        if j + 1 < slots[n]:
            heapq.heappush(waiting, ((j + 1) * cycle // slots[n], n, j + 1))
    return places


def phases(blocks: dict[str, int], weights: dict[str, float], cycle: int) -> list[dict]:
    """Schedules one after the other: each lasts until the cycle in which its first source runs out.

    A phase holds, by source, the first block it places, how many, and the source's slots in a cycle.
    """
    left, first, start, out = dict(blocks), {n: 0 for n in blocks}, 0, []
    while left := {n: b for n, b in left.items() if b}:
        own = shares({n: weights[n] for n in left}, max(cycle, len(left)))
        rounds = max(1, min(left[n] // own[n] for n in left))
        places = pfair(own)
        placed = {n: min(left[n], own[n] * rounds) for n in left}
        out += [
            {"source": n, "first": first[n], "last": first[n] + placed[n], "start": start, "places": places[n], "cycle": sum(own.values())}
            for n in left
        ]
        start += rounds * sum(own.values())
        for n in left:
            first[n] += placed[n]
            left[n] -= placed[n]
    return out


def bucketed(rows: DataFrame, key: str, source: str, buckets: int) -> DataFrame:
    """The ids of ``rows`` with ``source``, hash and bucket; a file counts by its name, wherever its folder lies."""
    return rows.select(
        "id", F.coalesce(F.col(f"row.`{source}`").cast("string"), F.lit(NONE)).alias("source"),
        F.xxhash64(F.col(f"row.`{key}`").cast("string"), F.substring_index("id.file_path", "/", -1), "id.row_index").alias("h"),
    ).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))


def numbered(df: DataFrame, key: str, source: str, buckets: int) -> DataFrame:
    """``df`` packed in ``row``, with ``source`` and its number ``rank`` within the source, from 0."""
    rows = identified(df)
    ids = bucketed(rows, key, source, buckets)
    counts = ids.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most ``buckets`` rows per source.
    base = counts.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "bucket").orderBy("h", "id")
    ranks = ids.withColumn("number", F.row_number().over(within) - 1).join(base, ["source", "bucket"]).select(
        "id", "source", (F.col("base") + F.col("number")).alias("rank")
    )
    return rows.join(ranks, "id").select("row", "source", "rank")


def mixed(
    df: DataFrame, key: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None,
    block_rows: int = BLOCK_ROWS, cycle: int = CYCLE, buckets: int = BUCKETS,
) -> DataFrame:
    """``row`` (all columns as they came), ``source``, ``block``, ``slot``, ``place``: the mixture in order of ``place``.

    Without ``weights`` a source weighs the square root of its number of rows. A source that has no weight, or
    one not above 0, is placed after the others. Null sources are one source, named by the empty string, and
    null keys are spread like others. Nothing is dropped or repeated; repeated rows get places of their own. A block of
    fewer rows leaves the rest of its slot's places unused. An empty table gives an empty result.
    """
    ranked = numbered(df, key, source, buckets)
    sizes = {r["source"]: r["n"] for r in df.groupBy(F.coalesce(F.col(source).cast("string"), F.lit(NONE)).alias("source")).agg(F.count("*").alias("n")).collect()}
    given = {n: (weights.get(n, 0) if weights is not None else sizes[n] ** 0.5) for n in sizes}
    blocks = {n: -(-sizes[n] // block_rows) for n in sizes}
    plan = phases({n: b for n, b in blocks.items() if given[n] > 0}, given, cycle)
    end = max((p["start"] + -(-(p["last"] - p["first"]) // len(p["places"])) * p["cycle"] for p in plan), default=0)
    rest = sorted(n for n in sizes if not given[n] > 0)
    for n, before in zip(rest, accumulate([0, *(blocks[n] for n in rest)])):
        plan.append({"source": n, "first": 0, "last": blocks[n], "start": end + before, "places": [0], "cycle": 1})
    # One row per source and phase.
    spark = df.sparkSession
    schedule = spark.createDataFrame(
        [(p["source"], p["first"], p["last"], p["start"], p["places"], p["cycle"]) for p in plan],
        "source string, first long, last long, start long, places array<int>, cycle long",
    )
    block = F.floor(F.col("rank") / block_rows)
    of = schedule.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("first", "last", "start", "places", "cycle"))).alias("plan"))
    phase = F.filter("plan", lambda p: (p["first"] <= F.col("block")) & (F.col("block") < p["last"]))[0]
    j, n = F.col("block") - F.col("phase.first"), F.size("phase.places")
    slot = F.col("phase.start") + F.floor(j / n) * F.col("phase.cycle") + F.element_at("phase.places", (j % n + 1).cast("int"))
    return (
        ranked.withColumn("block", block).join(of, "source").withColumn("phase", phase).withColumn("slot", slot)
        .select("row", "source", "block", "slot", (F.col("slot") * block_rows + F.col("rank") % block_rows).alias("place"))
    )


@query("op4_pfair_mixing")
def op4_pfair_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's block, slot and place in a mixture that weighs sources by the root of their size."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixed(docs).select("row.doc_id", F.col("row.source").alias("source"), "block", "slot", "place")
