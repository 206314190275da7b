"""Exact duplicates by content-defined chunk recipes.

A text, without the characters that do not count, is cut where a rolling hash of its last 16 bytes says
so. Equal chunks get one identifier: a chunk is known by its 64-bit fingerprint, and two chunks are taken
for equal only if length and SHA-256 agree as well. A document is then the ordered list of its chunks'
identifiers, and documents are compared by these lists. The text itself is read once and never shuffled;
what moves is 44 bytes a chunk, and after that eight bytes a chunk that occurs twice.

A chunk that occurs in one document only makes the document unique, so such chunks get no identifier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsebook.llm.common import mix, query, slices, stage, table

IGNORED = b"\x20\x09\x0a\x0b\x0c\x0d"
SMALLEST, LARGEST = 256, 8192
# One cut in 1 024 bytes on average.
CUT_MASK = np.uint32(1023 << 22)
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of a text; the same bytes always give the same cuts."""
    n = len(data)
    if n <= SMALLEST:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step] << np.uint32(step)
    ends, last = [], 0
    for p in (np.flatnonzero((h & CUT_MASK) == 0) + 1).tolist():
        while p - last > LARGEST:
            last += LARGEST
            ends.append(last)
        if p - last >= SMALLEST:
            ends.append(p)
            last = p
    while n - last > LARGEST:
        last += LARGEST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


_CHUNK = pa.struct([("fp", pa.int64()), ("sha", pa.binary()), ("len", pa.int32())])
_OUT = pa.schema([("n_points", pa.int64()), ("digest", pa.binary()), ("chunks", pa.list_(_CHUNK))])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        points, digests, lists = [], [], []
        for raw in batch.column("text").to_pylist():
            points.append(len(raw) if raw else 0)
            data = (raw or "").encode().translate(None, IGNORED)
            digests.append(hashlib.sha256(data).digest())
            last, chunks = 0, []
            for end in cut_points(data):
                piece = data[last:end]
                fp = xxhash.xxh3_64_intdigest(piece)
                chunks.append({"fp": fp - (fp >> 63 << 64), "sha": hashlib.sha256(piece).digest(), "len": end - last})
                last = end
            lists.append(chunks)
        own = [pa.array(points, pa.int64()), pa.array(digests, pa.binary()), pa.array(lists, pa.list_(_CHUNK))]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("key", "row")), *own], names=["key", "row", *_OUT.names]
        )


def groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, ``row`` (its number), ``keep_key``, ``group_size``, ``kept``, ``digest``.

    Texts are equal when they are after deleting space, tab, line feed, vertical tab, form feed and carriage
    return. Null text counts as empty, and all empty texts are equal. Of a group the longest original text
    stays (code points), then the smallest key, null keys last; of rows that tie in all this any one, and
    only one. An empty table gives an empty result; other columns are ignored.
    """
    rows = df.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    found = stage(
        rows.mapInArrow(
            _chunked,
            f"key {kind}, row long, n_points long, digest binary, chunks array<struct<fp:long,sha:binary,len:int>>",
        ),
        "recipes",
    )
    pieces = found.select("row", F.posexplode("chunks").alias("pos", "chunk")).select("row", "pos", "chunk.*")
    named = stage(
        pieces.groupBy("fp", "sha", "len").agg(F.count("*").alias("n")).where("n > 1")
        .select("fp", "sha", "len", F.monotonically_increasing_id().alias("id")),
        "chunk-ids",
    )
    # One side holds one row per chunk; a chunk that very many documents share is split by the skew rule.
    lists = (
        pieces.join(named, ["fp", "sha", "len"])
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("ids"))
        .select("row", F.col("ids.id").alias("recipe"))
    )
    known = (
        found.select("key", "row", "n_points", "digest", F.size("chunks").alias("n_chunks"))
        .join(lists, "row", "left")
        .withColumn("recipe", F.when(F.col("n_chunks") == 0, F.array().cast("array<bigint>")).otherwise(F.col("recipe")))
    )
    shared = F.coalesce(F.size("recipe") == F.col("n_chunks"), F.lit(False))
    known = stage(known.withColumn("shared", shared), "recipe-lists")
    best = (
        known.where("shared").groupBy("recipe", "digest")
        .agg(
            F.count("*").alias("group_size"),
            F.min(F.struct((-F.col("n_points")).alias("n"), F.col("key").isNull().alias("none"), "key", "row")).alias("best"),
        )
    )
    several = known.where("shared").join(best, ["recipe", "digest"]).select(
        "key", "row", F.col("best.key").alias("keep_key"), "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"), "digest",
    )
    single = known.where("not shared").select(
        "key", "row", F.col("key").alias("keep_key"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest",
    )
    return several.unionByName(single)


SQL = r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept, text_sha256 FROM d"""


@query("op6_exact_dedup", SQL)
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal documents: who stays, how many they are, and the digest of the compared text."""
    return groups(table(spark, folder, "documents")).select(
        F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
