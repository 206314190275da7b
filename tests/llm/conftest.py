import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use themselves.
    *(T.StructField(n, T.StringType()) for n in ("row", "key", "id", "bucket", "kept", "rank", "batch", "block", "mark", "place")),
])
PROSE = " ".join(f"word{i * 7919 % 1000} of{i % 13}" for i in range(300))


@pytest.fixture
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, null ids, exact and near copies, clashing names."""
    texts = [None, "", " \n", "x", PROSE, PROSE, PROSE.replace(" ", "  "), PROSE.replace("word0 ", "edited ", 1), PROSE[50:900],
             "call +1 (132) 555-1352 or a.b@mail.example.com, ip 10.0.0.255, card 4111 1111 1111 1111", "long " * 40000]
    rows = [(i, t, "en", [None, "a", "b"][i % 3], len(t or ""), *["r"] * 10) for i, t in enumerate(texts)]
    rows += [rows[4], rows[9], (None, PROSE, None, None, None, *[None] * 10)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
