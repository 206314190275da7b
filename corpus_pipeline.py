"""The corpus pipeline: toxicity, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns all columns of
``docs`` as they came, but for the last, which returns the packing. Rows are carried whole in one struct, so columns
of any name pass. Write a stage's result before calling the next stage, as ``run`` does: a stage removes what the one
before it has staged. Null texts count as empty, repeated rows are rows of their own until a dedup stage keeps one of
them, empty tables pass through empty.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulsebook.llm import exact, mixing, neardup, packing, toxicity
from pulsebook.llm.common import STAGED, discard, stage, table


class _Stage:
    """A stage that first removes what the stage before it has staged."""

    staged: list[str] = []

    def __init__(self, step):
        self.step, self.__doc__ = step, step.__doc__

    def __call__(self, spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _Stage.staged)
        first = len(STAGED)
        out = self.step(spark, docs, sf_dir)
        _Stage.staged = STAGED[first:]
        return out


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows as ``row``, with an ``id`` that is the same in every evaluation.

    A row of a file is known by file and number; rows that come from elsewhere are written first.
    """
    packed = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    try:
        return docs.select(packed, F.struct("_metadata.file_path", "_metadata.row_index").alias("id"))
    except AnalysisException:
        return stage(docs.select(packed, F.monotonically_increasing_id().alias("id")), "numbered")


def _kept(docs: DataFrame, operator) -> DataFrame:
    """The rows that an operator keeps; keys are ordered by ``doc_id``, so the smallest stays."""
    rows = _numbered(docs)
    key = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("doc_id"), "id")
    kept = operator(rows.select(key.alias("key"), F.col("row.text").alias("text")), key="key", text="text")
    return rows.join(kept.where("kept").select("key.id"), "id", "left_semi").select("row.*")


def _in_order(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the ``place`` of each row in the order of the files' names and their rows."""
    own = [F.col("doc_id"), F.col("text")]
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("number")]
    try:
        rows = docs.select(*own, *at)
    except AnalysisException:
        rows = stage(docs.select(*own), "ordered").select(*own, *at)
    # One row per file.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("file").agg(F.max("number").alias("last"))
    bases = sizes.select("file", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "file").select("doc_id", "text", (F.col("base") + F.col("number")).alias("place"))


@_Stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; scored in one pass without moving texts between tasks."""
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text"))
    model, line = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(packed, model, line).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


@_Stage
def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return _kept(docs, exact.groups)


@_Stage
def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return _kept(docs, neardup.near_duplicates)


@_Stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files in the order of the mixture."""
    order = mixing.mixed(docs).select("row", "place")
    return order.repartitionByRange("place").sortWithinPartitions("place").select("row.*")


@_Stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in the sequences, which are numbered in the order of the rows, that of the mixture."""
    return packing.named(packing.pack(_in_order(docs), place="place"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact),
    ("MinHash near-dedup", drop_near),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]
# A tokeniser and learnt models have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
