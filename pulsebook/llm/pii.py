"""Personal data, and terms that give it away.

Base kinds (email, ip, card, phone) are patterns. Their matches' places come from ``split`` and
``regexp_extract_all``, which find the same matches: a match starts where the parts and matches before it end.

A term is sanitised when it discloses a protected entity, which is the value of a base span of any kind. An entity's
information is IC(e) = -log p(e) and what a term tells of it is the pointwise mutual information
PMI(t; e) = log(p(t, e) / (p(t) p(e))), with p the share of all documents that hold the one, or both. A term is telling
when PMI reaches ``share`` of IC; at a share of 1 it would have to occur with that entity only, below it a few mentions
elsewhere do not hide it. Pairs found in fewer than ``support`` different texts tell nothing, since in one text any rare
word occurs with one entity only. In the documents that hold the entity every occurrence of a telling term is sanitised.

Entities that the same rows hold tell and are told alike, and so are terms: both are put into classes by prints of 128
bits of their sets of rows, and what is paired in a row is its classes. A long list of addresses that two texts share,
and all words that only these two have, are one pair.

Everything is DataFrame functions; all frequencies are counted over all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pulsebook.llm.common import query, stage, table

# The base kinds as they are to be found, written so that matching takes linear time: possessive
# where giving back can't help, starting only where a run of the first part's characters starts or the match
# before ended, and without card numbers of fewer than 16 digits, which would be dropped.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SUPPORT, SHARE = 2, 0.9
TERM = r"[\p{L}][\p{L}\p{N}'-]{3,}+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of the longest number is right; ``digits`` has no other characters."""
    at = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    backwards = F.reverse(digits)

    def one(i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(at, F.lit(0), lambda s, i: s + F.coalesce(one(i), F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        # Longer parts are over 255 unless they start with zeros.
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3) & (
            F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 4).try_cast("int"), F.lit(0)) <= 255
        ))
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


MATCH = "array<struct<kind:string,i:int,gap:int,value:string>>"


def _found(text: Column, pattern: str) -> tuple[Column, Column]:
    """All matches in order, and the lengths of the gaps before them."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return values, F.slice(F.transform(F.split(text, pattern, -1), F.char_length), F.lit(1), F.size(values))


def _matches(text: Column, kind: str) -> Column:
    """All matches of a kind in order, each with the length of the gap before it."""
    values, gaps = _found(text, KINDS[kind])
    return F.transform(F.arrays_zip(values.alias("value"), gaps.alias("gap")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["value"].alias("value"),
    ))


def matches(text: Column) -> Column:
    """The matches of all kinds. What most texts lack is looked for first."""
    need = {
        "email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(KINDS["card"]), "phone": text.contains("+"),
    }
    return F.concat(*(F.when(need[k], _matches(text, k)).otherwise(F.array().cast(MATCH)) for k in KINDS))


def _placed(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows with a match, ``i``, ``gap`` and ``value``, with its ``start`` and ``end``."""
    length, order = F.char_length("value"), Window.partitionBy(*by).orderBy("i")
    return df.withColumn("end", F.sum(F.col("gap") + length).over(order)).withColumn("start", F.col("end") - length)


def _terms(text: Column) -> Column:
    """The different terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _prints() -> list[Column]:
    """Two prints of the set of rows of a group; rows differ, so that equal sets alone have equal prints."""
    return [F.bit_xor(F.xxhash64("row", F.lit(i))).alias(name) for i, name in enumerate(("first", "second"))]


def _prints_of_prints() -> list[Column]:
    return [F.bit_xor(name).alias(name) for name in ("first", "second")]


def _tells(n_both: Column, share: float) -> Column:
    """Whether PMI reaches its share of the entity's information."""
    n_all, n_entity = F.col("n_all"), F.col("n_entity")
    return F.log(n_all * n_both / (F.col("n_term") * n_entity)) >= share * F.log(n_all / n_entity) - 1e-9


def detect(
    df: DataFrame, key: str = "doc_id", text: str = "text", support: int = SUPPORT, share: float = SHARE,
) -> tuple[DataFrame, DataFrame]:
    """The input rows as ``key``, ``row``; and their spans: ``row``, ``kind``, ``start``, ``end`` (code points, end exclusive).

    Null and empty texts have no spans. Base spans of different kinds may overlap; a span of kind ``term``
    overlaps no base span, and a place that discloses several entities is one span. Equal texts get equal spans;
    repeated rows are rows of their own. An empty table gives empty results; other columns are ignored.
    """
    rows = df.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = stage(
        rows.select("key", "row", "text", matches(F.col("text")).alias("m"))
        # The texts without any match are not needed again.
        .select("key", "row", F.xxhash64("text").alias("same"), "m", F.when(F.size("m") > 0, F.col("text")).alias("text")),
        "matches",
    )
    base = stage(
        _placed(found.select("row", "same", F.explode("m").alias("m")).select("row", "same", "m.*"), ["row", "kind"])
        .where(F.coalesce(*(F.when(F.col("kind") == k, _valid(k, F.col("value"))) for k in KINDS))),
        "base-spans",
    )
    plain = F.when(F.col("kind").isin("card", "phone"), _digits(F.col("value"))).otherwise(F.lower("value"))
    holders = base.select("row", "same", F.concat_ws(":", "kind", plain).alias("entity")).distinct()
    # One row.
    n_all = found.agg(F.count("*").alias("n_all"))
    # What a pair of n_both = n_entity and support documents can't reach, no pair does.
    entities = holders.groupBy("entity", "same").agg(F.count("*").alias("n"), *_prints()).groupBy("entity").agg(
        F.sum("n").alias("n_entity"), F.count("*").alias("texts"), *_prints_of_prints()
    ).where(F.col("texts") >= support).crossJoin(F.broadcast(n_all)).select(
        "entity", F.struct("n_entity", "first", "second").alias("entities"), "n_entity", "n_all",
        (F.pow("n_entity", F.lit(share)) * F.pow("n_all", F.lit(1 - share)) * (1 + 1e-9)).alias("most"),
    )
    holders = stage(holders.join(entities, "entity").select("row", "same", "entities", "n_entity", "n_all", "most").distinct(), "holders")
    most = holders.agg(F.max("most").alias("limit"))
    # Counted in the tasks that read the texts; one row per task and different word moves.
    n_term = rows.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    rare = n_term.join(F.broadcast(most), (F.col("n_term") >= support) & (F.col("n_term") <= F.col("limit"))).select("term", "n_term")
    held = found.join(holders.select("row").distinct(), "row", "left_semi").select("row", F.explode(_terms(F.col("text"))).alias("term"))
    held = stage(held.join(rare, "term"), "held")
    alike = held.groupBy("term", "n_term").agg(F.count("*").alias("n_held"), *_prints()).where(F.col("n_held") >= support).select(
        "term", "n_held", F.struct("n_term", "first", "second").alias("terms")
    )
    named = stage(held.join(alike, "term").select("row", "term", "terms", "n_term", "n_held"), "named")
    pairs = stage(
        named.select("row", "terms", "n_term", "n_held").distinct().join(holders, "row")
        .where((F.col("n_term") <= F.col("most")) & _tells(F.least("n_held", "n_entity"), share))
        .select("row", "same", "entities", "n_entity", "n_all", "terms", "n_term"),
        "pairs",
    )
    telling = (
        pairs.groupBy("entities", "terms", "same").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("n_entity", "n_all", "n_term")))
        .groupBy("entities", "terms").agg(
            F.sum("n").alias("n_both"), F.count("*").alias("texts"), *(F.first(c).alias(c) for c in ("n_entity", "n_all", "n_term"))
        ).where((F.col("texts") >= support) & _tells(F.col("n_both"), share))
    )
    told = pairs.join(telling.select("entities", "terms"), ["entities", "terms"], "left_semi").select("row", "terms").distinct()
    marks = stage(named.join(told, ["row", "terms"], "left_semi").select("row", "term"), "marks")
    values, gaps = _found(F.col("text"), TERM)
    words = found.join(marks.select("row").distinct(), "row", "left_semi").select("row", F.posexplode(F.arrays_zip(values.alias("value"), gaps.alias("gap"))).alias("i", "w"))
    places = _placed(words.select("row", "i", "w.*"), ["row"]).withColumn("term", F.lower("value")).join(marks, ["row", "term"], "left_semi")
    added = places.join(
        base.select("row", F.col("start").alias("s"), F.col("end").alias("e")),
        (places["row"] == base["row"]) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end")), "left_anti",
    ).select("row", F.lit("term").alias("kind"), "start", "end")
    return found.select("key", "row"), base.select("row", "kind", "start", "end").unionByName(added)


def _listed(spans: DataFrame) -> DataFrame:
    """``row``, ``spans``: all spans of a row by kind as listed, then start."""
    rank = F.array_position(F.array(*(F.lit(k) for k in (*KINDS, "term"))), F.col("kind"))
    return spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "kind"))).alias("spans"))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def sanitised(df: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``key`` and ``text`` with every span replaced by its kind in brackets; of spans that overlap, by the first's."""
    packed = stage(df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("id")), "texts")
    keys, spans = detect(packed, "id", "text", **settings)
    listed = _listed(spans).join(keys, "row").select(F.col("key").alias("id"), F.expr("sort_array(transform(spans, s -> struct(s.start, s.end, s.kind)))").alias("spans"))
    cut = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda s, x: F.when(x["start"] < s["at"], F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out"))).otherwise(
            F.struct(x["end"].alias("at"), F.concat(
                s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit("["), x["kind"], F.lit("]")
            ).alias("out"))
        ),
        lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.length("text"))),
    )
    return packed.join(listed, "id", "left").select("key", F.when(F.col("spans").isNull(), F.col("text")).otherwise(cut).alias("text"))


@query("op10_pii")
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's base spans in numbers and as a digest, and all its spans."""
    keys, spans = detect(table(spark, folder, "documents"))
    joined = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    none = F.array().cast("array<struct<rank:bigint,start:bigint,end:bigint,kind:string>>")
    all_spans = F.coalesce("spans", none)
    return keys.join(_listed(spans), "row", "left").select(
        F.col("key").alias("doc_id"),
        *(F.size(_of_kind(all_spans, k)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(joined(F.filter(all_spans, lambda s: s["kind"] != "term")).cast("binary"), 256).alias("base_sha256"),
        joined(all_spans).alias("spans"),
    )
