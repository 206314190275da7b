"""Importance resampling of documents towards a target distribution of hashed word features.

A task keeps the buckets of words it has seen; new ones are grouped by their length in bytes into matrices of
uint8, whose CRCs are updated column by column and scattered back. A document is written once as the list of its
features' buckets, two bytes each; everything after that (corpus counts, weights) reads these lists, not the texts.
What reaches the driver is one count per bucket. Weights meet Gumbel noise that is a hash of the document, and the
highest scores are drawn by their exact place in a range-partitioned order, so no task ever holds all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pulsebook.llm.common import query, slices, stage, table

BUCKETS, LONGEST, SEED, LEAST_WORDS, PERCENT = 10_000, 1, 2024, 20, 10
POLYNOMIAL = 0xEDB88320
# Distinct features whose buckets a task remembers.
REMEMBERED = 1 << 19


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & np.uint32(1), (crc >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), crc >> np.uint32(1))
    return crc


_CRC = _crc_table()
_WORD_BYTES = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b > 127 else 32 for b in range(256))
# Lower case and white space between words in one step.
_PLAIN = bytes(_WORD_BYTES[b + 32] if 65 <= b <= 90 else _WORD_BYTES[b] for b in range(256))


def words(text: str) -> list[bytes]:
    """Runs of digits, letters a-z (A-Z are lowered) and characters beyond ASCII, in UTF-8."""
    return text.encode().translate(_PLAIN).split()


def features(text: str, longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` consecutive words, joined by one space."""
    own = words(text)
    return own + [b" ".join(own[i : i + n]) for n in range(2, longest + 1) for i in range(len(own) - n + 1)]


def crc_matrices(items: list[bytes]) -> np.ndarray:
    """The unsigned CRC-32 of every item, worked out for all items of one length at a time."""
    lengths = np.fromiter(map(len, items), np.int64, len(items))
    out = np.empty(len(items), np.uint32)
    order = np.argsort(lengths, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(lengths[order]) != 0]) if len(items) else []
    for at in np.split(order, first[1:]) if len(items) else []:
        matrix = np.frombuffer(b"".join([items[i] for i in at.tolist()]), np.uint8).reshape(len(at), lengths[at[0]])
        crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(matrix.T):
            crc = _CRC[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
        out[at] = ~crc
    return out


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


class Hasher:
    """Buckets of the features of texts."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest = buckets, longest
        self.known: dict[bytes, int] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all texts' features, how many each text has, and how many words."""
        own = [features(t or "", self.longest) for t in texts]
        new = sorted({*chain.from_iterable(own)} - self.known.keys())
        self.known.update(zip(new, (crc_matrices(new) % np.uint32(self.buckets)).tolist()))
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        found = np.fromiter(map(self.known.__getitem__, chain.from_iterable(own)), _kind(self.buckets), int(sizes.sum()))
        if len(self.known) > REMEMBERED:
            self.known = {}
        counts = sizes if self.longest == 1 else np.array([len(words(t or "")) for t in texts], np.int64)
        return found, sizes, counts


def _hashed(buckets: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(buckets, longest)
        for batch in slices(batches):
            found, sizes, counts = hasher(batch.column("text").to_pylist())
            width = np.dtype(_kind(buckets)).itemsize
            ends = pa.py_buffer(np.r_[0, np.cumsum(sizes * width)].astype("<i4").tobytes())
            lists = pa.Array.from_buffers(pa.binary(), len(sizes), [None, ends, pa.py_buffer(found.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes), pa.array(counts), lists], names=["key", "n_features", "n_words", "buckets"]
            )

    return run


def bucketed(df: DataFrame, key: str, text: str, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """One row per input row: ``key``, ``n_features``, ``n_words`` and ``buckets``, one number of two (four) bytes a feature."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(
        _hashed(buckets, longest), f"key {dict(rows.dtypes)['key']}, n_features long, n_words long, buckets binary"
    )


def _summed(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column("buckets"):
                total += np.bincount(np.frombuffer(raw.as_buffer(), _kind(buckets)), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    return run


def histogram(lists: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all rows; a task sends one row per bucket."""
    counted = lists.select("buckets").mapInArrow(_summed(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ratio) of the smoothed shares of each bucket, target over source."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(s)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gain[np.frombuffer(raw.as_buffer(), _kind(len(gain)))].sum()) for raw in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "n_features", "n_words")), pa.array(sums, pa.int64())],
                names=["key", "n_features", "n_words", "weight"],
            )

    return run


def noise(key: Column, seed: int) -> Column:
    """-1000 ln(-ln u) in whole numbers, u a hash of the key in (0, 1)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(
    df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """One row per input row: ``key``, ``n_features``, ``weight``, ``score`` and, for the drawn ones, ``rank`` from 1.

    Of the rows with ``least_words`` words or more, ``percent`` in a hundred (rounded down) are drawn: the highest scores,
    ties to the smaller key, null keys last, rows alike in both in any order. Null and empty texts have no features and
    weight 0; a null key is hashed as the empty string; rows with the same key have the same noise and are drawn each by
    itself. A text is held whole in one task. An empty target only smooths; an empty table gives no rows; other columns
    are ignored.
    """
    lists = stage(bucketed(df, key, text, buckets, longest), "buckets")
    wanted = bucketed(target, target_text, target_text, buckets, longest)
    gain = gains(histogram(lists, buckets), histogram(wanted, buckets))
    kind = dict(lists.dtypes)["key"]
    weighed = lists.mapInArrow(_weighed(gain), f"key {kind}, n_features long, n_words long, weight long")
    scored = stage(weighed.withColumn("score", F.col("weight") + noise(F.col("key"), seed)), "scores")
    own = ["key", "n_features", "weight", "score"]
    fit = scored.where(F.col("n_words") >= least_words).select(*own)
    order = [F.desc("score"), F.asc_nulls_last("key")]
    # Equal scores of one key are dealt by a number, so that they need not lie in one task.
    spread = F.xxhash64(F.monotonically_increasing_id())
    placed = stage(
        fit.withColumn("spread", spread).repartitionByRange(*order, "spread").sortWithinPartitions(*order, "spread").drop("spread")
        .withColumn("place", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("place", 33).alias("part")
    # One row per task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sizes = placed.groupBy(part).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.floor(F.sum("n").over(everything) * percent / 100).alias("drawn"),
    )
    rank = F.col("base") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.withColumn("part", part).join(F.broadcast(sizes), "part").select(*own, F.when(rank <= F.col("drawn"), rank).alias("rank"))
    rest = scored.where(F.col("n_words") < least_words).select(*own, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


_BITS = "[0, 0, 0, 0, 0, 0, 0, 0]"
SQL = rf"""WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, {_BITS}),
        lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, {POLYNOMIAL}) ELSE c // 2 END)) AS t),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM d) GROUP BY ALL),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY ALL),
hexes AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
bucket AS (SELECT word, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(0, length(h), 2), lambda i: ('0x' || substr(h, CAST(i + 1 AS INT), 2))::BIGINT)),
        lambda c, x: xor(c // 256, t[CAST(xor(c % 256, x) + 1 AS INT)]))) % {BUCKETS} AS bucket FROM hexes, crc),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN bucket USING (word) GROUP BY 1),
t AS (SELECT bucket, sum(n) AS t FROM bw JOIN bucket USING (word) GROUP BY 1),
size AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS all_s, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS all_t),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + {BUCKETS}) / ((s::DOUBLE + 1) * (all_t + {BUCKETS}))))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), size),
weight AS (SELECT doc_id, sum(n * gain)::BIGINT AS weight FROM dw JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY 1),
scored AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
    FROM d LEFT JOIN weight USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)"""


@query("op12_importance_resampling", SQL)
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the documents of 20 words or more, drawn towards the benchmark's words."""
    out = resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.withColumnRenamed("key", "doc_id")
