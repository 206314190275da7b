"""Toxicity by class-conditional Kneser-Ney models over characters.

Two models, toxic and ordinary, predict each character from the four before it. Where a class has not seen
enough they back off to shared counts: Kneser-Ney continuation counts of the shorter strings over the whole
corpus, labelled or not. So a rare expression is judged by the strings it is made of, and what neither class
has seen cancels out.

The two log-likelihoods are compared over every ``WINDOW`` characters in a row. A text's ``mean`` is what the
toxic one has over the ordinary one beyond ``MARGIN``, summed over all windows and divided by the text's length;
below the margin differences are mostly those of style and of few counts, which in a long ordinary text would
add up to more than a few toxic words in a toxic one. A logistic curve makes the score of it.

Counts are Spark tables keyed by the whole string, and the continuation counts are made of all different strings of
the corpus by grouping them by their endings, so nothing of it has a fixed size. Where neither class has a string the
shared counts cancel out and what is left depends on its first four characters alone; so scoring needs the strings and
contexts of the labelled texts only, with their values. These are what is gathered and broadcast: labels are taken from
at most ``most_labels`` rows of each class, the ones whose hash of the id is smallest, which also bounds the broadcast
that marks them. Every text is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsebook.llm.common import mix, query, slices, stage, table

ORDER = 5
MOST_LABELS = 50_000
THRESHOLD = 0.3
DISCOUNT = 0.75
# Characters added to a text's length, so that a very short one is not judged by a few characters alone.
SHORT_TEXT = 100
WINDOW, MARGIN = 4, 2.0
FLOOR = 1e-3
_PIECE = 500_000
# Different strings that a counting task holds before it hands them on.
_HELD = 500_000
# Occurrences in texts labelled 0 and 1; in those of them that the curve is fitted on.
COUNTS = ("n_other", "n_toxic", "n_other_fit", "n_toxic_fit")
_CHAR = 21


def _letters() -> np.ndarray:
    """Code point to lower-case letter, 0 for what is no letter; beyond the first plane all counts as letters."""
    kinds = np.zeros(0x10000, np.uint32)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            kinds[c] = ord(low) if len(low) == 1 else c
    return kinds


_TABLE: list[np.ndarray] = []


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the texts in a row, each run of other characters one 0, and the number of each text."""
    if not _TABLE:
        _TABLE.append(_letters())
    # Every text gets a line feed at both ends, which also parts it from the next.
    joined = "".join(f"\n{t or ''}\n" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(texts)), [len(t or "") + 2 for t in texts])
    letters = np.where(codes < 0x10000, _TABLE[0][np.minimum(codes, 0xFFFF)], codes)
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0) | (of[1:] != of[:-1])
    return letters[keep], of[keep]


def _print(head: np.ndarray, tail: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit prints of strings."""
    return mix(mix(head.astype(np.uint64) + np.uint64(salt)) + tail.astype(np.uint64))


def _grouped(head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different string is first, and every string's number among these."""
    for salt in count():
        _, first, own = np.unique(_print(head, tail, salt), return_index=True, return_inverse=True)
        # Different strings with one print, which is hardly ever, are parted by another salt.
        if (head[first][own] == head).all() and (tail[first][own] == tail).all():
            return first, own


def _strings(letters: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of ORDER characters within a text, as their first three characters and the others, and their texts."""
    n = max(0, len(letters) - ORDER + 1)
    inside = np.flatnonzero(of[:n] == of[len(of) - n :]) if n else np.zeros(0, np.int64)
    a, b, c, d, e = (letters[inside + i].astype(np.int64) for i in range(ORDER))
    return a << 2 * _CHAR | b << _CHAR | c, d << _CHAR | e, of[inside]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with about ``_PIECE`` characters, or one text if that is longer."""
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        start = size = 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= _PIECE or i == len(texts) - 1:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, size = i + 1, 0


def _summed(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    head, tail, counts = (np.concatenate(x) for x in zip(*parts))
    first, own = _grouped(head, tail)
    total = [np.bincount(own, counts[:, i], len(first)).astype(np.int64) for i in range(len(COUNTS))]
    return head[first], tail[first], np.column_stack(total)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every different string with its counts; one that a task has handed on may come again."""
    parts: list[tuple] = []

    def packed() -> Iterator[pa.RecordBatch]:
        head, tail, counts = parts[0]
        for start in range(0, len(head), 200_000):
            end = start + 200_000
            yield pa.RecordBatch.from_arrays(
                [pa.array(head[start:end]), pa.array(tail[start:end]), *(pa.array(counts[start:end, i]) for i in range(len(COUNTS)))],
                names=["head", "tail", *COUNTS],
            )

    for batch, texts in _pieces(batches):
        head, tail, of = _strings(*characters(texts))
        if not len(of):
            continue
        first, own = _grouped(head, tail)
        marks = np.array([-1 if m is None else m for m in batch.column("mark").to_pylist()])[of]
        width = len(COUNTS) + 1
        counts = np.bincount(own * width + marks + 1, minlength=len(first) * width).reshape(-1, width)[:, 1:]
        parts.append((head[first], tail[first], counts))
        if sum(len(p[0]) for p in parts) > 2 * _HELD:
            parts = [_summed(parts)]
            if len(parts[0][0]) > _HELD:
                yield from packed()
                parts = []
    if parts:
        parts = [_summed(parts)]
        yield from packed()


def _low(chars: int):
    """The last ``chars`` characters of a string's head."""
    return F.col("head").bitwiseAND(F.lit((1 << chars * _CHAR) - 1))


def _valued(strings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The labelled strings and their contexts, with the differences ``whole`` of the two log-likelihoods, and ``apart``
    by models that have not seen the texts the curve is fitted on."""
    before = F.shiftright("tail", _CHAR)
    labelled = stage(strings.where(" + ".join(COUNTS) + " > 0"), "labelled-strings")
    # In how many ways each shorter string continues one to its left.
    ways = {4: stage(strings.groupBy(_low(2).alias("head"), "tail").agg(F.count("*").alias("ways")), "endings")}
    for width in (3, 2):
        ways[width] = ways[width + 1].groupBy(_low(width - 2).alias("head"), "tail").agg(F.sum("ways").alias("ways"))
    # Shared counts, from the shortest strings up.
    shared = None
    for width in (2, 3, 4):
        contexts = ways[width].groupBy("head", before.alias("before")).agg(F.sum("ways").alias("total"), F.count("*").alias("kinds"))
        own = ways[width]
        if width == 4:
            own = own.join(labelled.select(_low(2).alias("head"), "tail").distinct(), ["head", "tail"], "left_semi")
        own = own.withColumn("before", before).join(contexts, ["head", "before"])
        own = own.withColumn("lower", F.lit(1 / 65536)) if shared is None else (
            own.withColumn("end", _low(width - 3)).join(shared.select(F.col("head").alias("end"), "tail", F.col("shared").alias("lower")), ["end", "tail"])
        )
        shared = own.select("head", "tail", ((F.col("ways") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("lower")) / F.col("total")).alias("shared"))
    sums = {}
    for name in ("n_toxic", "n_other"):
        sums[f"{name}_whole"], sums[f"{name}_apart"] = F.col(name) + F.col(f"{name}_fit"), F.col(name)
    contexts = labelled.groupBy("head", before.alias("before")).agg(*(
        x for k, n in sums.items() for x in (F.sum(n).alias(f"total_{k}"), F.sum((n > 0).cast("long")).alias(f"kinds_{k}"))
    ))
    contexts = stage(contexts.select("head", "before", *(f"total_{k}" for k in sums), *(
        F.when(F.col(f"total_{k}") > 0, DISCOUNT * F.col(f"kinds_{k}") / F.col(f"total_{k}")).otherwise(1.0).alias(f"rest_{k}") for k in sums
    )), "contexts")

    def log(k: str):
        return F.log(F.greatest(sums[k] - DISCOUNT, F.lit(0.0)) / F.greatest(f"total_{k}", F.lit(1)) + F.col(f"rest_{k}") * F.col("shared"))

    def differences(of):
        return [(of(f"n_toxic_{k}") - of(f"n_other_{k}")).cast("float").alias(k) for k in ("whole", "apart")]

    known = labelled.withColumn("before", before).withColumn("end", _low(2)).join(
        shared.withColumnRenamed("head", "end"), ["end", "tail"]
    ).join(contexts, ["head", "before"])
    return known.select("head", "tail", *differences(log)), contexts.select(
        "head", F.col("before").alias("tail"), *differences(lambda k: F.log(f"rest_{k}"))
    )


class Strings:
    """Strings in a table that is looked up by many at a time and compares whole strings."""

    def __init__(self, head: np.ndarray, tail: np.ndarray):
        self.head, self.tail = head, tail
        self.places = np.full(2 << len(head).bit_length(), -1, np.int32)
        last = np.uint64(len(self.places) - 1)
        at, todo = (_print(head, tail) & last).astype(np.int64), np.arange(len(head))
        while len(todo):
            free = todo[self.places[at[todo]] < 0]
            self.places[at[free]] = free
            todo = todo[self.places[at[todo]] != todo]
            at[todo] = at[todo] + 1 & int(last)

    def find(self, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """Numbers of the strings, -1 for those that are not in the table."""
        last = len(self.places) - 1
        at = (_print(head, tail) & np.uint64(last)).astype(np.int64)
        out = self.places[at]
        todo = np.flatnonzero(out >= 0)
        while len(todo := todo[(self.head[out[todo]] != head[todo]) | (self.tail[out[todo]] != tail[todo])]):
            at[todo] = at[todo] + 1 & last
            out[todo] = self.places[at[todo]]
            todo = todo[out[todo] >= 0]
        return out


class Model:
    """Differences of the two log-likelihoods: by string, and by its first characters for strings not labelled."""

    def __init__(self, strings: Strings, seen: np.ndarray, contexts: Strings, unseen: np.ndarray):
        self.strings, self.contexts = strings, contexts
        # The last is found by the number -1.
        self.seen, self.unseen = np.append(seen, np.float32(np.nan)), np.append(unseen, np.float32(0))

    def means(self, texts: list[str | None]) -> np.ndarray:
        head, tail, of = _strings(*characters(texts))
        if not len(of):
            return np.zeros(len(texts))
        value = self.seen[self.strings.find(head, tail)]
        new = np.flatnonzero(np.isnan(value))
        value[new] = self.unseen[self.contexts.find(head[new], tail[new] >> _CHAR)]
        window = value.astype(np.float64)
        for i in range(1, WINDOW):
            window[:-i] += np.where(of[i:] == of[:-i], value[i:], 0)
        over = np.bincount(of, np.maximum(window - MARGIN, 0), len(texts))
        return over / (np.bincount(of, minlength=len(texts)) + SHORT_TEXT)


def curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's steps with a weak pull to 0."""
    if not len(x):
        return 1.0, 0.0
    scale = x.std() or 1.0
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.eye(2) * 1e-3, a.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def marked(df: DataFrame, labels: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """The rows with ``mark`` (1, 0, null) and ``fold`` (crc32 of the key as text, mod 4).

    Labels of fold 2 are never used. A key with both labels counts as labelled 1, labels other than 0 and 1
    as none.
    """
    known = (
        labels.select(F.col(key).alias("_key"), F.col(label).alias("mark")).where("mark in (0, 1) and _key is not null")
        .where(fold_of("_key") != 2)
        .groupBy("_key").agg(F.max("mark").alias("mark"))
    )
    chosen = [known.where(F.col("mark") == m).orderBy(F.xxhash64("_key"), "_key").limit(most) for m in (0, 1)]
    # At most 2 * most rows.
    small = F.broadcast(chosen[0].unionByName(chosen[1]))
    return df.join(small, F.col("key") == F.col("_key"), "left").drop("_key").withColumn("fold", F.coalesce(fold_of("key"), F.lit(0)))


def fold_of(key: str):
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4))


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        most_labels: int = MOST_LABELS) -> tuple[Model, tuple[float, float]]:
    """Count strings over all texts and fit the curve.

    All labels train the models. The curve is fitted on the texts of fold 3, scored by models that have not
    seen these.
    """
    rows = marked(df.select(F.col(key).alias("key"), F.col(text).alias("text")), labels, key, label, most_labels)
    strings = stage(
        rows.select("text", (F.col("mark") + F.when(F.col("fold") == 3, 2).otherwise(0)).cast("int").alias("mark"))
        .mapInArrow(_counted, "head long, tail long, " + ", ".join(f"{c} long" for c in COUNTS))
        .groupBy("head", "tail").agg(*(F.sum(c).alias(c) for c in COUNTS)),
        "strings",
    )
    known, contexts = ({n: t.column(n).to_numpy() for n in t.column_names} for t in (x.toArrow() for x in _valued(strings)))
    tables = Strings(known["head"], known["tail"]), Strings(contexts["head"], contexts["tail"])
    model, without_fit = (Model(tables[0], known[k], tables[1], contexts[k]) for k in ("whole", "apart"))
    apart = df.sparkSession.sparkContext.broadcast(without_fit)
    found = _scored(rows.where("fold = 3 and mark is not null"), apart, (1.0, 0.0)).select("mean", "mark").toArrow()
    apart.destroy()
    return model, curve(np.log(found.column("mean").to_numpy() + FLOOR), found.column("mark").to_numpy().astype(float))


def scored(rows: DataFrame, model: Model, line: tuple[float, float]) -> DataFrame:
    """``rows`` with a column ``text``: all other columns, ``mean`` and ``score``."""
    return _scored(rows, rows.sparkSession.sparkContext.broadcast(model), line)


def _scored(rows: DataFrame, held, line: tuple[float, float]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _pieces(batches):
            means = held.value.means(texts)
            scores = 1 / (1 + np.exp(-np.clip(np.log(means + FLOOR) * line[0] + line[1], -500, 500)))
            others = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in others), pa.array(means), pa.array(scores)], names=[*others, "mean", "score"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(run, ", ".join([*fields, "mean double", "score double"]))


def toxicity(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row per input row: key, held_out, score, predicted.

    Null and empty texts get the score of a mean of 0, as do texts with fewer than ORDER characters. Without
    usable labels every score is 0.5. Null keys are in no fold and count as not held out; repeated rows get
    equal scores. Neither the key nor any other column is an input of the score.
    """
    model, line = fit(df, labels, key, text, **settings)
    rows = df.select(F.col(key).alias("key"), F.coalesce(fold_of(key) == 2, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    return scored(rows, model, line).select(
        "key", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity(docs, labels).withColumnRenamed("key", "doc_id")
