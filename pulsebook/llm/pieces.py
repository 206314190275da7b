"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is cut into words at places that no piece of the vocabulary can span: before a space mark that follows
another character, and around characters that are in no piece of two or more. The distinct words of a block of texts
become one flat array of symbols. In each round the segmented minimum gives every word its best pair; all its
occurrences are merged at once, leftmost first where they overlap, and the array is compacted; words without a pair left
leave it. One by one, as the library works, gives the same unless a merge makes a pair that is at least as good as
the one being merged; the round sees that, and merges only the leftmost occurrence in such a word.

Only BPE models with byte fallback, no character map, no user-defined and no unused pieces are taken; others raise
``ValueError``. The model file is read here, field by field; the library is not called.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsebook.llm.common import query, slices, table

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NEVER = np.int32(2**31 - 1)
# Characters that are encoded together, and words whose ids a task remembers.
BLOCK, REMEMBERED, LONGEST_REMEMBERED = 1 << 19, 1 << 19, 64


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message in the wire format of protocol buffers."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        field, kind = divmod(number(), 8)
        if kind == 0:
            yield field, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield field, data[at : at + size]
        at += size


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    """Every byte that is in no character becomes a replacement character of its own."""
    return "�", error.start + 1


codecs.register_error("pulsebook.one_by_one", _one_by_one)


class Pieces:
    """Vocabulary and merges of a model; ``encode`` and ``decode`` work on many texts at once.

    A symbol is the id of a piece or, from ``size`` on, a character that is no piece.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = list(_fields(file.read()))
        rows = [{1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(v)) for f, v in model if f == 1]
        texts = [r[1].decode() for r in rows]
        scores = np.array([struct.unpack("<f", r[2])[0] for r in rows])
        kinds = [r[3] for r in rows]
        trainer = {3: 1, 35: 0, 44: b" \xe2\x81\x87 "} | dict(next((_fields(v) for f, v in model if f == 2), ()))
        shape = {2: b"", 3: 1, 4: 1, 5: 1} | dict(next((_fields(v) for f, v in model if f == 3), ()))
        if trainer[3] != 2 or not trainer[35] or shape[2] or shape[4] or not shape[5] or {*kinds} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("not a plain BPE model with byte fallback")
        self.size, self.lead = len(rows), SPACE if shape[3] else ""
        normal = {t: i for i, t in enumerate(texts) if kinds[i] == NORMAL}
        self.byte_ids = np.full(256, -1, np.int32)
        for i, t in enumerate(texts):
            if kinds[i] == BYTE:
                self.byte_ids[int(t[1:-1], 16)] = i
        # Symbols of single characters.
        self.symbols = np.arange(0x110000, dtype=np.int32) + self.size
        for t, i in normal.items():
            if len(t) == 1:
                self.symbols[ord(t)] = i
        # All pairs of symbols that join to a piece, ordered by one number for both.
        of = lambda t: normal.get(t, ord(t) + self.size if len(t) == 1 else None)
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.stride = self.size + 0x110000
        pairs = {}
        for t, i in normal.items():
            for cut in range(1, len(t)):
                a, b = of(t[:cut]), of(t[cut:])
                if a is not None and b is not None:
                    pairs[a * self.stride + b] = i
        self.keys = np.array(sorted(pairs) or [-1], np.int64)
        self.joined = np.array([pairs[k] for k in sorted(pairs)] or [0], np.int32)
        self.ranks = ranks[self.joined]
        inner = re.escape("".join(sorted({c for t in normal if len(t) > 1 for c in t} - {SPACE}))) or "a"
        apart = not any(re.search(f"[^{SPACE}]{SPACE}", t) for t in normal)
        self.words = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|[^{SPACE}{inner}]+" if apart else "(?s:.+)")
        # What a piece reads as: one flat array of bytes.
        plain = {CONTROL: lambda t: b"", UNKNOWN: lambda t: trainer[44], NORMAL: lambda t: t.replace(SPACE, " ").encode()}
        byte_of = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids) if i >= 0}
        surfaces = [byte_of[i] if kinds[i] == BYTE else plain[kinds[i]](t) for i, t in enumerate(texts)]
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.width = np.array([len(s) for s in surfaces], np.int64)
        self.begin = np.cumsum(self.width) - self.width
        self.spaced = np.array([kinds[i] == NORMAL and t.startswith(SPACE) for i, t in enumerate(texts)])
        self.control = np.array([k == CONTROL for k in kinds])
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.known = np.zeros(0, np.int32)
        self.starts = self.counts = np.zeros(0, np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair of symbols; ``NEVER`` where they join to none."""
        wanted = left.astype(np.int64) * self.stride + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER), self.joined[at]

    def merged(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of words (none empty) after all merges, one word after the other, and how many each has."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        rank, piece = np.full(len(symbols), NEVER), np.zeros(len(symbols), np.int32)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside], piece[inside] = self._pairs(symbols[inside], symbols[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[first, len(word)])
            best = np.repeat(np.minimum.reduceat(rank, first), size)
            ended = best == NEVER
            if ended.any():
                done.append((word[ended], symbols[ended]))
                live = ~ended
                symbols, word, rank, piece, best = symbols[live], word[live], rank[live], piece[live], best[live]
                if not len(symbols):
                    break
            # Of overlapping occurrences every second one, from the left.
            hits = np.flatnonzero(rank == best)
            opens = np.r_[True, np.diff(hits) != 1] | (word[hits] != np.r_[-1, word[hits[:-1]]])
            into = np.arange(len(hits)) - np.maximum.accumulate(np.where(opens, np.arange(len(hits)), 0))
            hits = hits[into % 2 == 0]
            new, own = piece[hits], word[hits]
            # A new pair as good as this one comes before the next occurrence of this one.
            touching = np.r_[False, (hits[1:] == hits[:-1] + 2) & (own[1:] == own[:-1])]
            has_left = (hits > 0) & (word[hits - 1] == own)
            before = np.where(touching, np.r_[0, new[:-1]], symbols[hits - 1])
            after_at = np.minimum(hits + 2, len(symbols) - 1)
            has_right = (hits + 2 < len(symbols)) & (word[after_at] == own)
            sooner = has_left & (self._pairs(before, new)[0] <= best[hits])
            sooner |= has_right & (self._pairs(new, symbols[after_at])[0] <= best[hits])
            if sooner.any():
                alone = np.isin(own, own[sooner])
                kept = ~alone | np.r_[True, own[1:] != own[:-1]]
                hits, new = hits[kept], new[kept]
            symbols[hits] = new
            stays = np.ones(len(symbols), bool)
            stays[hits + 1] = False
            at = np.cumsum(stays)[hits] - 1
            symbols, word, rank, piece = symbols[stays], word[stays], rank[stays], piece[stays]
            near = np.zeros(len(symbols), bool)
            near[at] = near[np.maximum(at - 1, 0)] = True
            rank[near] = NEVER
            changed = np.flatnonzero(near[:-1])
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed], piece[changed] = self._pairs(symbols[changed], symbols[changed + 1])
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(lengths), np.int64)
        word, symbols = (np.concatenate(x) for x in zip(*done))
        return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(lengths))

    def _learn(self, words: list[str]) -> None:
        """Ids of words that are not known yet."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols, counts = self.merged(self.symbols[points], np.array([len(w) for w in words]))
        raw = symbols >= self.size
        if raw.any():
            letters = symbols[raw] - self.size
            size = np.ones(len(symbols), np.int64)
            size[raw] += (letters > 0x7F).astype(np.int64) + (letters > 0x7FF) + (letters > 0xFFFF)
            word = np.repeat(np.repeat(np.arange(len(words)), counts), size)
            symbols, counts = np.repeat(symbols, size), np.bincount(word, minlength=len(words))
            symbols[symbols >= self.size] = self.byte_ids[np.frombuffer("".join(map(chr, letters.tolist())).encode(), np.uint8)]
        self.index.update(zip(words, range(len(self.counts), len(self.counts) + len(words))))
        self.starts = np.r_[self.starts, len(self.known) + np.cumsum(counts) - counts]
        self.counts = np.r_[self.counts, counts]
        self.known = np.r_[self.known, symbols]

    def _cut(self, text: str) -> Iterator[str]:
        """Parts of a text of about ``BLOCK`` characters, cut between words."""
        at = 0
        while len(text) - at > BLOCK:
            end = next((m.end() for m in self.words.finditer(text, at) if m.end() - at >= BLOCK), len(text))
            yield text[at:end]
            at = end
        if at < len(text):
            yield text[at:]

    def _blocks(self, texts: list[str]) -> Iterator[list[tuple[int, str]]]:
        block, size = [], 0
        for i, text in enumerate(texts):
            for part in self._cut(self.lead + text.replace(" ", SPACE) if text else ""):
                block.append((i, part))
                size += len(part)
                if size >= BLOCK:
                    yield block
                    block, size = [], 0
        if block:
            yield block

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has; an empty text has none."""
        ids, sizes = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        for block in self._blocks(texts):
            words = [self.words.findall(part) for _, part in block]
            fresh = {*chain.from_iterable(words)} - self.index.keys()
            if fresh:
                self._learn(sorted(fresh))
            seen = np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), np.int64)
            counts = self.counts[seen]
            ids.append(self.known[_spread(self.starts[seen], counts)])
            ends = np.cumsum([len(w) for w in words])
            total = np.r_[0, np.cumsum(counts)]
            np.add.at(sizes, [i for i, _ in block], total[ends] - total[ends - [len(w) for w in words]])
            if len(self.index) > REMEMBERED or any(len(w) > LONGEST_REMEMBERED for w in fresh):
                self._forget()
        return np.concatenate(ids), sizes

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of lists of ids; ids outside the vocabulary raise ``IndexError``."""
        out, at = [], 0
        for size in sizes.tolist():
            own = ids[at : at + size]
            shown = own[self.width[own] > 0]
            # Bytes on both sides of a control piece make no character together.
            ends = [*np.flatnonzero(self.control[own]).tolist(), size]
            parts = [self._bytes(own[a:b]).decode("utf-8", "pulsebook.one_by_one") for a, b in zip([0, *ends], ends)]
            text = "".join(parts)
            out.append(text[1:] if self.lead and len(shown) and self.spaced[shown[0]] else text)
            at += size
        return out

    def _bytes(self, ids: np.ndarray) -> bytes:
        parts = (ids[start : start + BLOCK] for start in range(0, len(ids), BLOCK))
        return b"".join(self.surface[_spread(self.begin[own], self.width[own])].tobytes() for own in parts)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``starts`` and are ``counts`` long."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + counts, counts)


@lru_cache(maxsize=2)
def model(path: str) -> Pieces:
    return Pieces(path)


def public_model() -> str:
    """The BPE model with 32 000 pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(ids, pa.int32()))


def _encoded(path: str, read_back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in slices(batches):
            ids, sizes = own.encode([t or "" for t in batch.column("text").to_pylist()])
            columns = {"key": batch.column("key"), "ids": _lists(ids, sizes)}
            if read_back:
                columns["decoded"] = pa.array(own.decode(ids, sizes), pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in slices(batches):
            lists = [np.array([i for i in ids or [] if i is not None], np.int64) for ids in batch.column("ids").to_pylist()]
            texts = own.decode(np.concatenate([np.zeros(0, np.int64), *lists]), np.array([len(x) for x in lists], np.int64))
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "text": pa.array(texts, pa.string())})

    return run


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, read_back: bool = False) -> DataFrame:
    """One row per input row: ``key``, ``ids`` (array of int), with ``read_back`` also ``decoded``, the ids' text.

    No begin or end ids. Null and empty texts have no ids. Long texts are encoded whole, in parts cut between words.
    Rows with the same or a null key stay rows of their own; an empty table gives none; other columns are ignored.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    return rows.mapInArrow(
        _encoded(path or public_model(), read_back), f"key {kind}, ids array<int>" + (", decoded string" if read_back else "")
    )


def decode(df: DataFrame, key: str = "key", ids: str = "ids", path: str | None = None) -> DataFrame:
    """One row per input row: ``key`` and ``text``; a null list reads as the empty text, null ids are passed over."""
    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(_decoded(path or public_model()), f"key {dict(rows.dtypes)['key']}, text string")


@query("op11_sentencepiece")
def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the text that they decode to, as digests."""
    return encode(table(spark, folder, "documents"), read_back=True).select(
        F.col("key").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
