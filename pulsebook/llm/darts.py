"""DartMinHash: weighted minwise signatures by throwing hashed darts.

Think of the plane over every element: one axis is weight, the other rank. Darts fall on it at random with one
dart per unit of area, and where they fall is a hash of the element alone. A set with weights ``w`` is hit by
the darts of its elements below its weights. Every dart belongs to one of ``k`` coordinates, and the
signature keeps, per coordinate, the hit of least rank. Two sets agree in a coordinate with the probability of
their weighted Jaccard similarity, sum of minima over sum of maxima.

Only ranks up to ``(k ln k + 2k) / sum of weights`` are looked at, which costs about ``k ln k`` darts whatever
the number of elements; for the few sets that leave a coordinate empty the bound is doubled.

Weights here are counts, so the plane over an element is cut into strips one unit wide, and a strip's darts are
the arrivals of a Poisson process along the rank axis: exponential gaps, each a hash of strip and number. A
coordinate's value is the rank of its dart itself, to 2**-32, which tells darts apart.
"""

from __future__ import annotations

import numpy as np
import xxhash

from pulsebook.llm.common import mix

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_RANK, _PLACE = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A5A5A5C3C3C3C3)
_UNIT = 2.0**-53


_EMPTY = np.uint64(2**64 - 1)
# Texts worked on at a time.
TEXTS = 500


def _throw(strips: np.ndarray, of: np.ndarray, bound: np.ndarray, k: int, n: int) -> np.ndarray:
    """Least rank per set and coordinate, of the darts below each set's bound."""
    best = np.full(n * k, _EMPTY)
    live, place, most, at, number = strips, of * k, bound[of], 0.0, 0
    while len(live):
        dart = mix(live + np.uint64((number * int(_GOLD)) % 2**64))
        at = at - np.log(((mix(dart ^ _RANK) >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT)
        hit = np.flatnonzero(at < most)
        live, place, most, at = live[hit], place[hit], most[hit], at[hit]
        where = place + ((dart[hit] >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(best, where, (at * 2.0**32).astype(np.uint64))
        number += 1
    return best.reshape(n, k)


def signatures(elements: np.ndarray, counts: np.ndarray, of: np.ndarray, n: int, k: int) -> np.ndarray:
    """Signatures of ``n`` sets, none of them empty; ``of`` says whose each element is."""
    owned = strips(elements, counts)
    owner = np.repeat(of, counts)
    bound = (k * np.log(k) + 2 * k) / np.bincount(of, counts, n)
    ranks = _throw(owned, owner, bound, k, n)
    while len(short := np.flatnonzero((ranks == _EMPTY).any(axis=1))):
        bound[short] *= 2
        place = np.full(n, -1)
        place[short] = np.arange(len(short))
        mine = place[owner] >= 0
        ranks[short] = _throw(owned[mine], place[owner[mine]], bound[short], k, len(short))
    return ranks


def strips(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One value per element and unit of weight: a weighted set as a plain one, with the same similarities."""
    level = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix(np.repeat(elements, counts) + level.astype(np.uint64) * _GOLD)


def shingle_hashes(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """48-bit hashes of all runs of ``width`` lower-case words, and whose they are; a shorter text is one run."""
    known: dict[str, int] = {}
    ids, sizes = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        words = (t or "").lower().split()
        sizes[i] = len(words)
        ids += [known.setdefault(w, len(known)) for w in words]
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
    # Words of a text, then ``width`` fillers, so that a shorter text has one run and runs end with their text.
    starts = np.cumsum(sizes + width) - sizes - width
    words = np.zeros(int((sizes + width).sum()), np.uint64)
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(len(ids))
    words[at] = table[np.array(ids, np.int64)] if ids else 0
    n = max(0, len(words) - width + 1)
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h += words[i : i + n] * np.uint64(pow(int(_GOLD), 2 * i + 1, 2**64))
    runs = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    of = np.repeat(np.arange(len(texts)), runs)
    first = np.repeat(starts - np.cumsum(runs) + runs, runs) + np.arange(len(of))
    return mix(h[first]) >> np.uint64(16), of


def multisets(texts: list[str | None], width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, their counts, and whose they are."""
    h, of = shingle_hashes(texts, width)
    h = np.sort(of.astype(np.uint64) << np.uint64(48) | h)
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    first = np.flatnonzero(new)
    h = h[first]
    return h & np.uint64(2**48 - 1), np.diff(np.append(first, len(new))), (h >> np.uint64(48)).astype(np.int64)
