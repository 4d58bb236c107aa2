"""Signatures of weighted sets (BagMinHash) and the shingles they are made of.

A document is the multiset of its five-word shingles; a shingle that stands w times has weight
w. The weight axis is cut into the intervals [0,1), [1,2), [2,4), [4,8), ...; for each shingle and
interval a Poisson process in time, whose rate is the interval's width, deals points (slot,
position in the interval). Points at positions below w count. A slot's signature is the time
of its first point. Two multisets agree in a slot with just the probability of their weighted
Jaccard similarity, as the points depend on the shingle alone.

Points are made in order of time for all shingles of a batch at once, up to a time by which
nearly every slot has its first point; only documents with an empty slot go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

SHINGLE_WORDS = 5
BANDS = 32
ROWS = 5
SLOTS = BANDS * ROWS
#: Words that are worked on at once, but for a longer single text.
BATCH_WORDS = 400_000
CACHED_WORDS = 150_000

# Multipliers of the public splitmix64 mixing function.
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * MIX_1
    z = (z ^ (z >> np.uint64(27))) * MIX_2
    return z ^ (z >> np.uint64(31))


def words_of(text: str | None) -> list[str]:
    """Runs without white space, in lower case."""
    return text.lower().split() if text else []


class WordHashes:
    """64-bit hashes of words, cached up to a bound."""

    def __init__(self) -> None:
        self._known: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        known = self._known
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of SHINGLE_WORDS words; of a shorter text one for all its words."""
    n = len(words)
    if not n:
        return words
    width = min(SHINGLE_WORDS, n)
    result = np.full(n - width + 1, np.uint64(width))
    for at in range(width):
        result = mix(result * STEP + words[at : n - width + 1 + at])
    return result


@dataclass
class Bags:
    """Distinct shingles of several documents with their counts, in order of document."""

    doc: np.ndarray
    shingle: np.ndarray
    count: np.ndarray
    docs: int

    @staticmethod
    def of(shingles: list[np.ndarray]) -> Bags:
        lengths = np.array([len(s) for s in shingles], dtype=np.int64)
        doc = np.repeat(np.arange(len(shingles)), lengths)
        flat = np.concatenate(shingles) if len(doc) else np.zeros(0, dtype=np.uint64)
        order = np.lexsort((flat, doc))
        doc, flat = doc[order], flat[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (flat[1:] != flat[:-1])
        starts = np.flatnonzero(new)
        count = np.diff(np.append(starts, len(doc)))
        return Bags(doc[starts], flat[starts], count, len(shingles))


def _streams(bags: Bags) -> tuple[np.ndarray, ...]:
    """One Poisson process per shingle and interval below its weight."""
    rows, keys, lows, widths = [], [], [], []
    level, low, width = 0, 0, 1
    at = np.arange(len(bags.doc))
    while len(at):
        rows.append(at)
        keys.append(mix(bags.shingle[at] ^ mix(np.full(1, level + 1, dtype=np.uint64))))
        lows.append(np.full(len(at), low))
        widths.append(np.full(len(at), width))
        low, width, level = low + width, max(1, low + width), level + 1
        at = at[bags.count[at] > low]
    if not rows:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none, none
    return tuple(np.concatenate(part) for part in (rows, keys, lows, widths))


def signatures(bags: Bags) -> np.ndarray:
    """Times of the first point, one row of SLOTS per document; infinite for an empty one."""
    row, key, low, width = _streams(bags)
    doc = bags.doc[row] if len(row) else row
    weight = np.bincount(bags.doc, weights=bags.count, minlength=bags.docs)
    result = np.full(bags.docs * SLOTS, np.inf)
    with np.errstate(divide="ignore"):
        limit = SLOTS * (np.log(SLOTS) + 4.0) / weight
    number = np.zeros(len(row), dtype=np.uint64)

    def draw(active: np.ndarray) -> np.ndarray:
        return mix(key[active] + number[active] * STEP)

    def wait(bits: np.ndarray, active: np.ndarray) -> np.ndarray:
        return -np.log1p(-((bits >> np.uint64(11)) * 2.0**-53)) / width[active]

    everything = np.arange(len(row))
    bits = draw(everything)
    time = wait(bits, everything)
    active = everything[time < limit[doc]] if len(row) else everything
    while len(active):
        while len(active):
            now = bits[active]
            slot = ((now & np.uint64(0x7FF)) * np.uint64(SLOTS) >> np.uint64(11)).astype(np.int64)
            counted, wide = active, width[active] > 1
            if wide.any():
                position = low[active] + (mix(now ^ STEP) % width[active].astype(np.uint64)).astype(np.int64)
                below = position < bags.count[row[active]]
                counted, slot = active[below], slot[below]
            np.minimum.at(result, doc[counted] * SLOTS + slot, time[counted])
            number[active] += np.uint64(1)
            fresh = draw(active)
            bits[active] = fresh
            time[active] += wait(fresh, active)
            active = active[time[active] < limit[doc[active]]]
        open_docs = np.isinf(result.reshape(bags.docs, SLOTS)).any(axis=1) & (weight > 0)
        limit[open_docs] *= 1.5
        active = everything[open_docs[doc]] if len(row) else everything
        active = active[time[active] < limit[doc[active]]] if len(active) else active
        while open_docs.any() and not len(active):
            limit[open_docs] *= 1.5
            active = everything[open_docs[doc] & (time < limit[doc])]
    return result.reshape(bags.docs, SLOTS)


def bands(signature: np.ndarray) -> np.ndarray:
    """BANDS hashes per document, each of ROWS slots and the band's number."""
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    result = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2]).copy()
    for at in range(ROWS):
        result = mix(result * STEP + bits[:, :, at])
    return result.view(np.int64)


def sketch(signature: np.ndarray) -> np.ndarray:
    """One byte per slot, for estimates."""
    return (mix(signature.view(np.uint64).copy()) & np.uint64(0xFF)).astype(np.uint8)


def items(shingles: np.ndarray) -> np.ndarray:
    """Sorted 48-bit numbers, one for each shingle and how often it has stood before.

    The overlap of two multisets is the number of items they share.
    """
    bag = Bags.of([shingles])
    first = np.repeat(np.cumsum(bag.count) - bag.count, bag.count)
    before = (np.arange(len(shingles)) - first).astype(np.uint64)
    repeated = np.repeat(bag.shingle, bag.count)
    return np.unique(mix(repeated + before * STEP) >> np.uint64(16))


def packed(numbers: np.ndarray) -> bytes:
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    whole = np.zeros((len(parts), 8), dtype=np.uint8)
    whole[:, :6] = parts
    return whole.view("<u8").ravel()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets given as items."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union if union else 0.0


def sized_batches(texts: list[str | None]) -> Iterator[tuple[int, int, list[list[str]]]]:
    """(from, to, words) of runs of texts that hold about BATCH_WORDS words."""
    start, held, size = 0, [], 0
    for at, text in enumerate(texts):
        words = words_of(text)
        held.append(words)
        size += len(words)
        if size >= BATCH_WORDS:
            yield start, at + 1, held
            start, held, size = at + 1, [], 0
    if held:
        yield start, len(texts), held
