"""Exact top-k inner products by block-at-a-time pruning.

Vectors of whole numbers are kept in blocks of neighbouring ids. A block has a forward index (its vectors) and, per
dimension, its greatest and least value; what a query can reach in it at most is the sum over dimensions of the
better product. A query visits blocks by descending bound and stops when the bound falls below its k-th best
score. The score to beat comes from the query's own block at first.

Blocks are dealt into regions and queries into groups; every pair of a region and a group is a task of its own
with a bounded size, which returns k rows a query. No task sees all vectors, or all queries.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulsebook.llm.common import query, stage, table

BLOCK, REGION, GROUP = 512, 16, 2048
LOWEST = -(2**63)
# Sums below this are exact in double precision.
_EXACT = 2**53


def whole(vectors: list[list[float]], width: int, scale: float) -> np.ndarray:
    """floor(scale * x) of vectors padded with zeros, as doubles where these are exact, else as Python numbers."""
    x = np.zeros((len(vectors), width))
    for row, v in zip(x, vectors):
        row[: len(v)] = v
    with np.errstate(over="ignore"):
        y = np.floor(scale * x)
    if np.abs(y).max(initial=0) < _EXACT:
        return y
    return np.array([[int(scale * float(c) // 1) if np.isfinite(scale * c) else int(scale) * int(c) for c in row] for row in x], object)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exact."""
    if a.dtype != object and b.dtype != object:
        if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < _EXACT:
            return a @ b.T
        a, b = (np.array([[int(c) for c in row] for row in x], object).reshape(x.shape) for x in (a, b))
    return a.astype(object) @ b.T.astype(object) if a.size and b.size else np.zeros((len(a), len(b)), object)


def _packed(x: np.ndarray) -> bytes:
    return pickle.dumps(x.astype(np.int32) if x.dtype != object and np.abs(x).max(initial=0) < 2**31 else x)


def _unpacked(raw: bytes) -> np.ndarray:
    x = pickle.loads(raw)
    return x.astype(np.float64) if x.dtype == np.int32 else x


def _blocks(width: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, part, number = [], [], 0, 0

        def one() -> pa.RecordBatch:
            x = whole(vectors[:BLOCK], width, scale)
            row = {
                "block": [part << 32 | number], "ids": [np.array(ids[:BLOCK], "<i8").tobytes()], "index": [_packed(x)],
                "high": [_packed(x.max(axis=0, keepdims=True))], "low": [_packed(x.min(axis=0, keepdims=True))],
            }
            del ids[:BLOCK], vectors[:BLOCK]
            return pa.RecordBatch.from_pydict(row, _BLOCK)

        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            ids += batch.column("id").to_pylist()
            vectors += batch.column("vector").to_pylist()
            while len(ids) >= BLOCK:
                yield one()
                number += 1
        if ids:
            yield one()

    return run


_BLOCK = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("ids", "index", "high", "low"))])
_BLOCK_SQL = "block long, ids binary, index binary, high binary, low binary"


class Best:
    """The k best candidates of each query: score, id and the place of the candidate's row."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.found: list[list[tuple]] = [[] for _ in range(n)]
        self.least: list = [None] * n

    def take(self, i: int, scores, ids: np.ndarray, rows: np.ndarray) -> None:
        if self.least[i] is not None:
            good = np.flatnonzero(scores >= self.least[i])
            scores, ids, rows = scores[good], ids[good], rows[good]
        if not len(scores):
            return
        order = np.lexsort((rows, ids, -scores))[: self.k] if scores.dtype != object else sorted(
            range(len(scores)), key=lambda j: (-scores[j], ids[j], rows[j])
        )[: self.k]
        new = [(-int(scores[j]), int(ids[j]), int(rows[j])) for j in order]
        self.found[i] = sorted(self.found[i] + new)[: self.k]
        if len(self.found[i]) == self.k:
            worst = -self.found[i][-1][0]
            self.least[i] = worst if self.least[i] is None else max(self.least[i], worst)


def _queries(k: int, every: int):
    """The queries of a block, with the k-th best score in it as what others have to reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"row": [], "id": [], "vector": [], "least": []}
            for block, raw, index in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "index"))):
                ids, x = np.frombuffer(raw, "<i8"), _unpacked(index)
                rows = block * BLOCK + np.arange(len(ids))
                mine = np.flatnonzero(ids % every == 0)
                scores = _dot(x[mine], x)
                for i, own in zip(mine.tolist(), scores):
                    others = sorted(map(int, np.delete(own, i)), reverse=True)
                    out["row"].append(int(rows[i]))
                    out["id"].append(int(ids[i]))
                    out["vector"].append(_packed(x[i : i + 1]))
                    out["least"].append(str(others[k - 1]) if len(others) >= k else None)
            yield pa.RecordBatch.from_pydict(out, _QUERY)

    return run


_QUERY = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("vector", pa.binary()), ("least", pa.string())])


def _searched(k: int):
    def run(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        q = np.concatenate([_unpacked(v) for v in queries.column("vector").to_pylist()]) if queries.num_rows else np.zeros((0, 0))
        own = queries.column("row").to_numpy()
        best = Best(len(q), k)
        best.least = [None if v is None else int(v) for v in queries.column("least").to_pylist()]
        if len(q) and blocks.num_rows:
            high, low = (np.concatenate([_unpacked(v) for v in blocks.column(c).to_pylist()]) for c in ("high", "low"))
            bounds = _dot(np.maximum(q, 0), high) + _dot(np.minimum(q, 0), low)
            order = np.argsort(-bounds, axis=1, kind="stable")
            names = blocks.column("block").to_pylist()
            index = [_unpacked(v) for v in blocks.column("index").to_pylist()]
            ids = [np.frombuffer(v, "<i8") for v in blocks.column("ids").to_pylist()]
            rows = [b * BLOCK + np.arange(len(i)) for b, i in zip(names, ids)]
            for turn in range(order.shape[1]):
                at = order[:, turn]
                # Equal scores of smaller ids may still come, so only a bound below the k-th best ends a query.
                live = np.array([best.least[i] is None or bounds[i, at[i]] >= best.least[i] for i in range(len(q))])
                if not live.any():
                    break
                for b in np.unique(at[live]):
                    some = np.flatnonzero(live & (at == b))
                    for i, scores in zip(some.tolist(), _dot(q[some], index[b])):
                        other = rows[b] != own[i]
                        best.take(i, scores[other], ids[b][other], rows[b][other])
        out = {"row": [], "query_id": [], "vec_id": [], "other": [], "score": []}
        for i, (r, name) in enumerate(zip(own.tolist(), queries.column("id").to_pylist())):
            for score, vec, other in best.found[i]:
                for c, v in zip(out, (r, name, vec, other, str(-score))):
                    out[c].append(v)
        return pa.Table.from_pydict(out, _FOUND)

    return run


_FOUND = pa.schema([(c, pa.int64()) for c in ("row", "query_id", "vec_id", "other")] + [("score", pa.string())])


def top_k(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose key is divisible by ``every`` its k best other rows.

    Components become floor(scale * x); the score is the exact inner product, shortened to the range of a long if it
    is beyond. Ties go to the smaller key. Rows whose key or vector is null, or whose vector holds null or non-finite
    components, take no part; vectors of different lengths are padded with zeros. Rows with one key are rows of
    their own: each is a query, and a candidate for the others. An empty table gives an empty result; other columns
    are ignored.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(
        "id is not null and vector is not null"
    ).where(F.forall("vector", finite))
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    blocks = stage(
        rows.repartitionByRange("id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id())
        .mapInArrow(_blocks(width, scale), _BLOCK_SQL),
        "blocks",
    )
    queries = stage(blocks.select("block", "ids", "index").mapInArrow(_queries(k, every), "row long, id long, vector binary, least string"), "queries")
    n_blocks, n_queries = blocks.count(), queries.count()
    regions, groups = max(1, -(-n_blocks // REGION)), max(1, -(-n_queries // GROUP))
    left = blocks.withColumn("region", F.pmod(F.xxhash64("block"), F.lit(regions))).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = queries.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).withColumn(
        "region", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(regions - 1).cast("long")))
    )
    found = left.groupBy("region", "group").cogroup(right.groupBy("region", "group")).applyInArrow(
        _searched(k), "row long, query_id long, vec_id long, other long, score string"
    )
    # Numbers of any size in order; only k rows per query and region come here.
    best = Window.partitionBy("row").orderBy(F.col("score").cast("decimal(38,0)").desc(), "vec_id", "other")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id",
        F.least(F.greatest(F.col("score").cast("decimal(38,0)"), F.lit(LOWEST)), F.lit(-LOWEST - 1)).cast("long").alias("score"),
    )


SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS "rank", vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5"""


@query("op7_exact_top_k", SQL)
def op7_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five best other vectors of every fiftieth vector."""
    return top_k(table(spark, folder, "embeddings"))
