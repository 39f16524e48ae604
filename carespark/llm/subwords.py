"""Hashed character n-grams of many words at a time, and word values kept between rows."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np

WORD_CHARS = 40            # longer words are worked out each time, not kept
WINDOW_CHARS = 1 << 16     # of words whose n-grams are in memory at a time
WORDS_KEPT = 150_000

# FIXED VALUES: odd multipliers of the rolling hash and of its last mix.
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _windows(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, words) of groups of at most WINDOW_CHARS, a longer word being a group of its own."""
    first, held = 0, 0
    for i, w in enumerate(words):
        if i > first and held + len(w) + 2 > WINDOW_CHARS:
            yield first, words[first:i]
            first, held = i, 0
        held += len(w) + 2
    if first < len(words):
        yield first, words[first:]


def gram_buckets(words: list[str], grams: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices of words, buckets) of all character n-grams of all words with their ends marked.

    Each gram of each word comes once, in an order that depends on the word alone; a word longer than
    a window comes by pieces. ``buckets`` is a power of two."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    most = max(grams)
    for first, group in _windows(words):
        sizes = np.fromiter(map(len, group), np.int64, len(group)) + 2
        codes = np.frombuffer("".join([f"<{w}>" for w in group]).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(group)), sizes) if len(group) > 1 else None
        for at in range(0, len(codes), WINDOW_CHARS):
            part = codes[at:at + WINDOW_CHARS + most - 1].astype(np.uint64) + np.uint64(1)
            starts = min(WINDOW_CHARS, len(codes) - at)
            own = owner[at:at + starts] if owner is not None else np.zeros(starts, np.int64)
            # characters from each place to the end of its word
            left = np.cumsum(sizes)[own] - np.arange(at, at + starts)
            for n in grams:
                here = np.flatnonzero(left >= n)
                h = part[here] + np.uint64(n)
                for k in range(1, n):
                    h = h * STEP + part[here + k]
                h = (h ^ (h >> np.uint64(32))) * MIX
                yield own[here] + first, (h >> shift).astype(np.int64)


def word_bucket(word: str, buckets: int) -> int:
    """The bucket of the word itself."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % buckets


def word_features(words: list[str], grams: tuple[int, ...], buckets: int) -> list[np.ndarray]:
    """All buckets of each word's features: the word and its n-grams."""
    owners, found = [np.arange(len(words))], [np.array([word_bucket(w, buckets) for w in words], np.int64)]
    for own, at in gram_buckets(words, grams, buckets):
        owners.append(own)
        found.append(at)
    owner, found = np.concatenate(owners), np.concatenate(found).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    return np.split(found[order], np.cumsum(np.bincount(owner, minlength=len(words)))[:-1]) if words else []


def summed_weights(words: list[str], weights: np.ndarray, grams: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the sum of its features' weights and their number."""
    total = weights[np.array([word_bucket(w, buckets) for w in words], np.int64)].astype(float) if words else np.empty(0)
    count = np.ones(len(words))
    for own, at in gram_buckets(words, grams, buckets):
        if not len(own):
            continue
        a, b = int(own[0]), int(own[-1]) + 1
        total[a:b] += np.bincount(own - a, weights[at], b - a)
        count[a:b] += np.bincount(own - a, minlength=b - a)
    return total, count


class WordValues:
    """Values of words, worked out for all new words of some rows together.

    What is kept is bounded: when it is full, the words of the rows at hand stay, which hold the
    common ones; long words go after their rows."""

    def __init__(self, work: Callable[[list[str]], Iterable]):
        self.work, self.kept = work, {}

    def of(self, rows: list[list[str]]) -> dict:
        """A dictionary that has all words of ``rows``."""
        used = set().union(*rows)
        new = sorted(used.difference(self.kept))
        if len(self.kept) + len(new) > WORDS_KEPT:
            self.kept = {w: self.kept[w] for w in used if w in self.kept}
        short = [w for w in new if len(w) <= WORD_CHARS]
        self.kept.update(zip(short, self.work(short)))
        if len(short) == len(new):
            return self.kept
        long = [w for w in new if len(w) > WORD_CHARS]
        return {w: self.kept[w] for w in used if len(w) <= WORD_CHARS} | dict(zip(long, self.work(long)))
