"""Best-fit decreasing packing of documents into sequences.

Best-fit decreasing looks at lengths only, and there are at most ``room`` of them, so the packing of any
number of documents is worked out from a histogram with ``room`` rows, on the driver: pieces of one length
are placed as runs. A segment tree over the remaining capacities finds the tightest open bin in logarithmic
time; all bins that are open at that capacity take the run in one step, exactly as if its pieces came one by
one. The result is a table of runs, which does not grow with the documents either.

Spark does the rest: tokenises, counts lengths, ranks the pieces of a length (a running number inside each
task plus the sum over earlier tasks, so that a length that a third of all documents share is no hot key) and
looks up each piece's bin.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulsebook.llm.common import few_at_a_time, query, slices, stage, table

ROOM = 2048
# Places that are numbered together where the order counts.
SPAN = 1 << 16
SPECIAL = "<|endoftext|>"
# Characters whose classes are the same in all versions of Unicode that the two libraries may follow.
_SETTLED = re.compile("[^\x00-ɏ‐-‧€]")
_LONG_RUN = re.compile(r"\S{5000}|\s{5000}")


class Encoder:
    """Ids of a byte-level BPE as ``tokenizers`` gives them.

    ``ranks`` names the same vocabulary as a list of ranks; texts in settled characters go through the
    faster encoder that reads it, all others through ``tokenizers`` itself.
    """

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        self.vocabulary, self.fast = vocabulary, None
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    @cached_property
    def slow(self):
        """Read when a text first asks for it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary)

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if self.fast is None or SPECIAL in text or _SETTLED.search(text) or _LONG_RUN.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())


def public_files() -> tuple[str, str, str]:
    """Vocabulary, ranks and pattern of the byte-level BPE with 50 257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def encoder(*files: str) -> Encoder:
    return Encoder(*files)


class OpenBins:
    """A segment tree over remaining capacities; a leaf holds the runs of bins with that capacity."""

    def __init__(self, room: int):
        self.size = 1 << room.bit_length()
        self.some = [False] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def _set(self, capacity: int, value: bool) -> None:
        node = self.size + capacity
        self.some[node] = value
        while node > 1:
            node >>= 1
            self.some[node] = self.some[2 * node] or self.some[2 * node + 1]

    def add(self, capacity: int, start: int, count: int) -> None:
        if count and capacity:
            self.runs[capacity].append((start, count))
            self._set(capacity, True)

    def take(self, length: int) -> tuple[int, int, int] | None:
        """The tightest capacity that holds ``length``, and a run of bins with it, removed."""
        node = self.size + length
        while not self.some[node]:
            while node & 1:
                node >>= 1
            if node <= 1:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        capacity = node - self.size
        start, count = self.runs[capacity].pop()
        if not self.runs[capacity]:
            self._set(capacity, False)
        return capacity, start, count


def best_fit_runs(counts: dict[int, int], room: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, first bin, pieces per bin, offset in the bin), and the number of bins."""
    bins, runs, opened = OpenBins(room), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity, start, count = bins.take(length) or (room, opened, -(-left // (room // length)))
            if start == opened:
                opened += count
            each = capacity // length
            used = min(count, -(-left // each))
            bins.add(capacity, start + used, count - used)
            placed = min(left, used * each)
            runs.append((length, rank, start, each, room - capacity))
            whole, rest = divmod(placed, each)
            bins.add(capacity - each * length, start, whole)
            if rest:
                bins.add(capacity - rest * length, start + whole, 1)
            rank, left = rank + placed, left - placed
    return runs, opened


def _tokenised(room: int, end_id: int, files: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(*files), Counter()
        for batch in slices(batches):
            counts, ordinals, whole, sums = [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                n = len(ids)
                short = n % room
                starts = [*([0] if short else []), *range(short, n, room)]
                counts.append(n)
                sums.append([zlib.crc32(ids[a : (short if short and not a else a + room)].tobytes()) for a in starts])
                ordinals.append(seen[short])
                whole.append(seen["whole"])
                if short:
                    seen[short] += 1
                seen["whole"] += n // room
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("place"), batch.column("part"), *(pa.array(x, pa.int64()) for x in (counts, ordinals, whole)),
                 pa.array(sums, pa.list_(pa.int64()))],
                names=["key", "place", "part", "n", "ordinal", "whole_before", "sums"],
            )

    return run


def _placed(room: int, runs: list, opened: int):
    by = {}
    for length, *run in runs:
        by.setdefault(length, []).append(run)
    by = {k: np.array(v, np.int64) for k, v in by.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("of", "piece", "start", "length", "crc", "bin", "offset")}
            columns = [batch.column(c).to_pylist() for c in ("n", "ordinal", "whole_before", "sums", "base", "whole_base")]
            for i, (n, ordinal, whole_before, sums, base, whole_base) in enumerate(zip(*columns)):
                short = n % room
                for piece, crc in enumerate(sums):
                    if short and not piece:
                        rank = base + ordinal
                        mine = by[short]
                        first, start, each, offset = mine[np.searchsorted(mine[:, 0], rank, "right") - 1].tolist()
                        row = (0, short, start + (rank - first) // each, offset + (rank - first) % each * short)
                    else:
                        k = piece - (short > 0)
                        row = (short + k * room, room, opened + whole_base + whole_before + k, 0)
                    for name, value in zip(out, (i, piece, row[0], row[1], crc, row[2], row[3])):
                        out[name].append(value)
            of = pa.array(out.pop("of"), pa.int64())
            taken = [batch.column(c).take(of) for c in ("key", "place")]
            kinds = [pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [*taken, *(pa.array(v, t) for v, t in zip(out.values(), kinds))], names=["key", "place", *out]
            )

    return run


def pack(
    df: DataFrame, key: str = "doc_id", text: str = "text", room: int = ROOM, end_id: int = 0,
    files: tuple[str, ...] | None = None, place: str | None = None,
) -> DataFrame:
    """One row per piece: key, piece, start, length, crc, bin, offset.

    A document is its ids and then ``end_id``; null and empty texts are ``end_id`` alone. Only a document
    longer than ``room`` is cut, into pieces of ``room`` after a first one that takes the remainder. Rows with
    the same key, null keys and equal texts are packed as separate documents. An empty table gives no rows;
    other columns are ignored.

    With ``place``, a column of different whole numbers, the packing keeps that order: pieces of one length are taken by
    it, and sequences are numbered by the place of their longest piece, which is the one at offset 0.
    """
    rows = df.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.lit(None).cast("long").alias("place") if place is None else F.col(place).cast("long").alias("place"),
    ).withColumn("part", F.spark_partition_id().cast("long") if place is None else F.floor(F.col("place") / SPAN))
    kind = dict(rows.dtypes)["key"]
    with few_at_a_time(df.sparkSession):
        tokens = stage(
            rows.mapInArrow(
                _tokenised(room, end_id, files or public_files()),
                f"key {kind}, place long, part long, n long, ordinal long, whole_before long, sums array<long>",
            ),
            "pieces",
        )
    short = (F.col("n") % room).alias("short")
    if place is not None:
        # At most SPAN documents in a part.
        alike, earlier = Window.partitionBy("part", short).orderBy("place"), Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        tokens = tokens.withColumn("ordinal", (F.row_number().over(alike) - 1).cast("long")).withColumn(
            "whole_before", F.coalesce(F.sum(F.floor(F.col("n") / room)).over(earlier), F.lit(0))
        )
    counted = tokens.groupBy("part", short).agg(F.count("*").alias("n"))
    before = Window.partitionBy("short").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("part", "short", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One row per task, not per document.
    tasks = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    wholes = tokens.groupBy("part").agg(F.sum(F.floor(F.col("n") / room)).alias("w")).select(
        "part", F.coalesce(F.sum("w").over(tasks), F.lit(0)).alias("whole_base")
    )
    histogram = {r["short"]: r["n"] for r in counted.groupBy("short").agg(F.sum("n").alias("n")).where("short > 0").collect()}
    runs, opened = best_fit_runs(histogram, room)
    placed = (
        tokens.withColumn("short", short).join(bases.join(wholes, "part"), ["part", "short"])
        .select("key", "place", "n", "ordinal", "whole_before", "sums", "base", "whole_base")
        .mapInArrow(
            _placed(room, runs, opened),
            f"key {kind}, place long, piece int, start long, length long, crc long, bin long, offset long",
        )
    )
    return placed.drop("place") if place is None else _renumbered(stage(placed, "placed")).drop("place")


def _renumbered(placed: DataFrame) -> DataFrame:
    """The bins numbered by the place of their longest piece."""
    firsts = placed.where("offset = 0").select("bin", "place", "piece", F.floor(F.col("place") / SPAN).alias("part"))
    # One row per SPAN documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = firsts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    number = (F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy("place", "piece")) - 1).alias("number")
    numbers = firsts.join(bases, "part").select("bin", number)
    return placed.join(numbers, "bin").select("key", "place", "piece", "start", "length", "crc", F.col("number").alias("bin"), "offset")


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2 048 ids: a row per piece, with its place."""
    return named(pack(table(spark, folder, "documents")))


def named(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        F.col("key").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
        F.col("bin").alias("sequence_id"), "offset",
    )
