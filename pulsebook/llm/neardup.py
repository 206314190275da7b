"""Near duplicates by DartMinHash signatures, banded joining and exact verification.

1. A text is the multiset of its runs of five lower-case words; texts with equal multisets are one class and
   are represented by one row.
2. Representatives whose signatures agree in all of a band's coordinates share a bucket. With 30 bands of six
   coordinates two texts of similarity 0.8 miss each other in all bands once in nine thousand cases, those of
   0.9 practically never.
3. Every member is compared with its bucket's hub, the least row. Links make components.
4. In a bucket that still holds several components apart from the hub, members are compared with those of
   other components, in blocks of a bounded size; a block returns a spanning forest, never all its pairs.
   A pair of blocks is compared in one task, so a bucket of any size is spread.

Similarities are computed on the whole multisets (as 32-bit hashes), never estimated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsebook.llm.common import mix, query, stage, table
from pulsebook.llm.components import components
from pulsebook.llm.darts import TEXTS, multisets, signatures, strips

WORDS, SIMILARITY = 5, 0.8
BANDS, WIDTH = 30, 6
# A block of a bucket: rows, and bytes of their multisets.
BLOCK_ROWS, BLOCK_BYTES = 2048, 16 << 20
_COLUMNS = 8192


def _signed(words: int, bands: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                n = part.num_rows
                elements, counts, of = multisets(part.column("text").to_pylist(), words)
                edge = np.searchsorted(of, np.arange(n + 1))
                full = np.flatnonzero(np.diff(edge))
                found = [[] for _ in range(n)]
                if len(full):
                    ids = signatures(elements, counts, np.searchsorted(full, of), len(full), bands * width)
                    h = np.tile(np.arange(bands, dtype=np.uint64), (len(full), 1))
                    for c in range(width):
                        h = mix(h + ids[:, c::width])
                    for i, values in zip(full.tolist(), h.astype(np.int64)):
                        found[i] = values
                sets, digests = [], []
                for i in range(n):
                    own = strips(elements[edge[i] : edge[i + 1]], counts[edge[i] : edge[i + 1]])
                    sets.append(np.sort((own >> np.uint64(32)).astype("<u4")).tobytes())
                    digests.append(xxhash.xxh3_128_digest(np.sort(own).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("row"), pa.array(digests, pa.binary()), pa.array(sets, pa.binary()),
                     pa.array(found, pa.list_(pa.int64()))],
                    names=["key", "row", "digest", "items", "bands"],
                )

    return run


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays; a value that an array holds twice counts for itself each time."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _compared(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                a, b = np.frombuffer(x.as_buffer(), "<u4"), np.frombuffer(y.as_buffer(), "<u4")
                if min(len(a), len(b)) < least * max(len(a), len(b)):
                    keep.append(False)
                    continue
                common = _overlap(a, b)
                keep.append(common >= least * (len(a) + len(b) - common) - 1e-9)
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in ("u", "v")], names=["u", "v"])

    return run


def _links(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) that are similar."""
    return (
        pairs.join(sets.select(F.col("row").alias("u"), F.col("items").alias("left")), "u")
        .join(sets.select(F.col("row").alias("v"), F.col("items").alias("right")), "v")
        .mapInArrow(_compared(least), "u long, v long")
    )


def _forest(least: float):
    """Links between components within a block, or between two blocks, as a spanning forest."""

    def run(group: pa.Table) -> pa.Table:
        rows, roots, sides = (group.column(c).to_numpy() for c in ("row", "root", "side"))
        items = [np.frombuffer(x.as_buffer(), "<u4") for x in group.column("items").combine_chunks()]
        n, sizes = len(rows), np.array([len(x) for x in items])
        names, roots = np.unique(roots, return_inverse=True)
        parent = list(range(len(names)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        # The largest component's rows are compared with the others only.
        other = np.flatnonzero(roots != np.bincount(roots).argmax())
        values = np.concatenate(items) if n else np.zeros(0, "<u4")
        kinds, place, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = np.cumsum(times > 1) - 1
        whose = np.repeat(np.arange(n), sizes)
        use = times[place] > 1
        place, whose = shared[place[use]], whose[use]
        order = np.argsort(place, kind="stable")
        place, whose = place[order], whose[order]
        common = np.zeros((len(other), n), np.float32)
        for start in range(0, int(place[-1]) + 1 if len(place) else 0, _COLUMNS):
            a, b = np.searchsorted(place, (start, start + _COLUMNS))
            dense = np.zeros((n, _COLUMNS), np.float32)
            dense[whose[a:b], place[a:b] - start] = 1
            common += dense[other] @ dense.T
        similar = common >= least * (sizes[other][:, None] + sizes[None] - common) - 1e-3
        similar &= roots[other][:, None] != roots[None]
        out = []
        for i, j in zip(*np.nonzero(similar)):
            a, b = find(int(roots[other[i]])), find(int(roots[j]))
            if a != b:
                parent[a] = b
                out.append((int(rows[other[i]]), int(rows[j])))
        return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([y for _, y in out], pa.int64())})

    return run


def _crossed(buckets: DataFrame, roots: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links that a bucket's hub does not show."""
    rows = buckets.join(roots, F.col("row") == F.col("node"), "left").select(
        "value", "row", "hub", F.coalesce("root", "row").alias("root"), "bytes"
    )
    # What is linked to the hub may still link the others, but a bucket whose others are all one is done.
    apart = rows.where("row <> hub").groupBy("value").agg(
        F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"), F.sum("bytes").alias("bytes")
    ).where("a <> b").select(
        "value", F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    cut = rows.drop("bytes").where("row <> hub").join(apart, "value").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    spread = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "value", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "row", "root",
    )
    return spread.join(sets.select("row", "items"), "row").groupBy("value", "i", "j").applyInArrow(_forest(least), "u long, v long")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, least: float = SIMILARITY,
    bands: int = BANDS, width: int = WIDTH,
) -> DataFrame:
    """One row per input row: key, row, class_key, class_size, kept.

    Classes are the connected components of the links of weighted Jaccard similarity ``least`` or more. A
    class is named after its smallest key, whose row stays (null keys last; of rows that tie any one, and only
    one). A text of fewer than ``words`` words is one run; texts without words, null ones too, are one class.
    An empty table gives an empty result; other columns are ignored.
    """
    rows = df.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    signed = stage(
        rows.mapInArrow(_signed(words, bands, width), f"key {kind}, row long, digest binary, items binary, bands array<long>"),
        "signatures",
    )
    classes = signed.groupBy("digest").agg(F.min("row").alias("rep"))
    members = stage(signed.select("key", "row", "digest").join(classes, "digest").select("key", "row", "rep"), "members")
    banded = (
        signed.select("row", "bands", F.length("items").alias("bytes"))
        .join(members.where("row = rep").select("row"), "row", "left_semi")
        .select("row", "bytes", F.explode("bands").alias("value"))
    )
    hubs = banded.groupBy("value").agg(F.min("row").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = stage(banded.join(hubs, "value"), "buckets")
    pairs = buckets.where("row <> hub").select(F.col("row").alias("u"), F.col("hub").alias("v")).distinct()
    involved = buckets.select("row").distinct()
    sets = stage(signed.select("row", "items").join(involved, "row", "left_semi"), "sets")
    starred = stage(_links(pairs, sets, least), "starred")
    roots = components(starred)
    crossed = _crossed(buckets, roots, sets, least)
    roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(crossed))
    named = members.join(roots, F.col("rep") == F.col("node"), "left").select(
        "key", "row", F.coalesce("root", "rep").alias("root")
    )
    best = named.groupBy("root").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("best"), F.count("*").alias("class_size")
    )
    return named.join(best, "root").select(
        "key", "row", F.col("best.key").alias("class_key"), "class_size", (F.col("row") == F.col("best.row")).alias("kept")
    )


@query("op5_minhash_near_dedup")
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's class of near copies, its size, and who stays."""
    return near_duplicates(table(spark, folder, "documents")).select(
        F.col("key").alias("doc_id"), F.col("class_key").alias("class_id"), "class_size", "kept"
    )
