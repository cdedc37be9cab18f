"""Benchmark decontamination: SimHash windows of an item's size, multi-index Hamming blocks, exact check.

Every item has a SimHash of its words. A document's windows of the item's length are fingerprinted the
same way. Items of one length lie in ``BLOCKS`` tables by the bits of each block; a window within
``RADIUS`` bits of an item differs from it in at most ``RADIUS // BLOCKS`` bits of some block, so probing
each table that far finds all of them. What is found is held against the item by the weighted Jaccard
similarity of five-word shingles, repeats counted.

Fingerprints of words can lie further apart than the radius though the shingles are alike, as when a
block of an item is replaced by one repeated word. So an item is also held against every window that
has enough places where one of its own shingles begins: no window of similarity 0.8 has fewer, and
nothing depends on the fingerprints alone.

A window can only pass with 8/9 of its shingles in common with an item (at similarity 0.8), so windows
that hold too few shingles of any item are not fingerprinted: this is a bound, not a cut.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratascore.llm.common import lower_words, shingles, sign_bits

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 17
BLOCKS = 9
ITEM_CHARS = 32 << 20  # characters of items that one pass over the documents carries
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                   np.uint64)  # any odd numbers
MATCH = "array<struct<item_id: bigint, start_word: int, n_words: int, similarity: double>>"


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Shared weight over joined weight, each shingle weighing as often as it occurs."""
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return shared / (a.total() + b.total() - shared) if a or b else 0.0


def _hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class HammingBlocks:
    """Fingerprints by the bits of each block; ``near`` gives every one within the radius, and only those."""

    def __init__(self, marks: Sequence[int], radius: int = RADIUS, blocks: int = BLOCKS):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        self.marks, self.radius, self.tables = [int(m) for m in marks], radius, []
        for low, high in zip(cuts, cuts[1:], strict=False):
            mask, table = (1 << (high - low)) - 1, defaultdict(list)
            for at, m in enumerate(self.marks):
                table[(m >> low) & mask].append(at)
            flips = [sum(1 << b for b in c) for d in range(radius // blocks + 1) for c in combinations(range(high - low), d)]
            self.tables.append((low, mask, dict(table), flips))

    def near(self, mark: int) -> list[int]:
        found = set()
        for low, mask, table, flips in self.tables:
            own = (mark >> low) & mask
            for flip in flips:
                found.update(table.get(own ^ flip, ()))
        return sorted(at for at in found if (self.marks[at] ^ mark).bit_count() <= self.radius)


class ItemIndex:
    """Items by length, with their shingles and fingerprints; items of equal words are one, under the smallest id."""

    def __init__(self, items: Sequence[tuple[int, str]], radius: int = RADIUS, blocks: int = BLOCKS,
                 similarity: float = SIMILARITY):
        known: dict[tuple[bytes, ...], int] = {}
        for item, text in items:
            words = tuple(lower_words(text))
            if words and item is not None:
                known[words] = min(item, known.get(words, item))
        self.similarity = similarity
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for words in known for w in words}), 1)}
        by_length, grams = defaultdict(list), defaultdict(set)
        self.holders: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))  # by length: shingle, items
        for words, item in sorted(known.items(), key=lambda x: x[1]):
            by_length[len(words)].append((item, Counter(shingles(list(words), SHINGLE)), sign_bits(_hashes(words))))
            size = min(SHINGLE, len(words))
            ids = np.array([self.vocabulary[w] for w in words], np.uint64)
            own = set(self._grams(ids, size).tolist())
            grams[size].update(own)
            for gram in own:
                self.holders[len(words)][gram].append(len(by_length[len(words)]) - 1)
        self.lengths = {n: (own, HammingBlocks([m for _, _, m in own], radius, blocks)) for n, own in by_length.items()}
        self.grams = {size: np.array(sorted(own), np.uint64) for size, own in grams.items()}

    @staticmethod
    def _grams(ids: np.ndarray, size: int) -> np.ndarray:
        n = len(ids) - size + 1
        return (np.lib.stride_tricks.sliding_window_view(ids, size) * FACTORS[:size]).sum(axis=1, dtype=np.uint64) if n > 0 else ids[:0]

    def _hits(self, ids: np.ndarray, size: int) -> np.ndarray:
        """For each place, whether an item's shingle of ``size`` words begins there."""
        n = len(ids) - size + 1
        hit = np.zeros(max(n, 0), bool)
        if n > 0:
            unknown = np.concatenate([[0], np.cumsum(ids == 0)])
            at = np.nonzero(unknown[size:] == unknown[:-size])[0]
            if len(at):
                grams = (ids[at[:, None] + np.arange(size)] * FACTORS[:size]).sum(axis=1, dtype=np.uint64)
                own = self.grams[size]
                hit[at] = own[np.minimum(np.searchsorted(own, grams), len(own) - 1)] == grams
        return hit

    def _sharing(self, ids: np.ndarray, starts: np.ndarray, length: int, size: int, per_window: int, least: float) -> dict[int, list[int]]:
        """By start, the items of ``length`` words whose own shingles begin at ``least`` or more places of the window."""
        hits, holders = defaultdict(list), self.holders[length]
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        known = np.nonzero(unknown[size:] == unknown[:-size])[0]
        grams = (ids[known[:, None] + np.arange(size)] * FACTORS[:size]).sum(axis=1, dtype=np.uint64)
        for place, gram in zip(known.tolist(), grams.tolist(), strict=True):
            for which in holders.get(gram, ()):
                hits[which].append(place)
        found = defaultdict(list)
        for which, places in hits.items():
            if len(places) >= least - 1e-9:
                n = np.searchsorted(places, starts + per_window) - np.searchsorted(places, starts)
                for start in starts[n >= least - 1e-9].tolist():
                    found[start].append(which)
        return found

    def matches(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """Best window of each item found: item, first word, words, similarity."""
        words = lower_words(text)
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words], np.uint64)
        sums = {}
        for size in self.grams:
            hit = self._hits(ids, size)
            if hit.any():
                sums[size] = np.concatenate([[0], np.cumsum(hit)])
        best: dict[int, tuple[float, int, int]] = {}
        need = 2 * self.similarity / (1 + self.similarity)
        for length, (own, blocks) in self.lengths.items() if sums else ():
            size, width = min(SHINGLE, length), min(length, len(words))
            if size not in sums or width < size:
                continue
            per_window = width - size + 1
            common = sums[size][per_window:] - sums[size][:-per_window]
            # a window of m shingles and an item of k share at least s / (1 + s) of m + k
            least = need / 2 * (per_window + length - size + 1)
            starts = np.nonzero(common >= least - 1e-9)[0]
            if not len(starts):
                continue
            for group in np.split(starts, np.nonzero(np.diff(starts) > width)[0] + 1):
                first, last = int(group[0]), int(group[-1]) + width
                bits = np.unpackbits(_hashes(words[first:last]).view(np.uint8), bitorder="little").reshape(-1, 64)
                ones = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
                at = group - first
                sharing = self._sharing(ids[first:last], at, length, size, per_window, least)
                marks = np.packbits(2 * (ones[at + width] - ones[at]) > width, axis=1, bitorder="little").view(np.uint64)[:, 0]
                for start, mark in zip(group.tolist(), marks.tolist(), strict=True):
                    near = sorted({*blocks.near(mark), *sharing.get(start - first, ())})
                    window = Counter(shingles(words[start : start + width], SHINGLE)) if near else None
                    for which in near:
                        item, weights, _ = own[which]
                        found = weighted_similarity(window, weights)
                        if found >= self.similarity - 1e-12 and found > best.get(item, (0.0, 0, 0))[0]:
                            best[item] = (found, start, width)
        return [(item, start, width, found) for item, (found, start, width) in sorted(best.items())]


def _matcher(items: Broadcast) -> Callable[[Column], Column]:
    built: list[ItemIndex] = []  # once per worker and batch of columns

    @F.pandas_udf(MATCH)
    def run(texts: pd.Series) -> pd.Series:
        if not built:
            built.append(ItemIndex(items.value))
        names = ("item_id", "start_word", "n_words", "similarity")
        return pd.Series([[dict(zip(names, m, strict=True)) for m in built[0].matches(t)] for t in texts], dtype=object)

    return run


def item_matches(benchmark: DataFrame, text: Column, item_text: str = "text", item_key: str = "item_id",
                 item_chars: int = ITEM_CHARS) -> Column:
    """Array of the items that ``text`` holds, as ``MATCH``.

    Items travel to the tasks in passes of about ``item_chars`` characters, so a benchmark of any size is
    read whole and no pass outgrows that bound. A null text or item matches nothing; an empty benchmark
    gives empty arrays.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_key).cast("bigint").alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    passes = -(-chars // item_chars)
    part = F.pmod(F.xxhash64(F.trim(F.regexp_replace(F.lower("text"), r"[\x20\x09-\x0D]+", " "))), F.lit(max(passes, 1)))
    found = [F.array().cast(MATCH)]
    for number in range(passes):
        shared = spark.sparkContext.broadcast([(r.item, r.text) for r in items.where(part == number).collect()])
        found.append(_matcher(shared)(text))
    return F.concat(*found)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document and benchmark item in it: ``doc_id, item_id, start_word, n_words, similarity``.

    A document holds an item if one of its windows of the item's length (the whole text, if shorter)
    has weighted shingle similarity 0.8 or more; the best window is returned, the first of equals.
    Items of equal words are one, under the smallest id. Shingles are five words, or all words of a
    shorter item. Null and wordless texts hold nothing and are held by nothing; repeated rows are rows.
    """
    found = docs.select(F.col(key).alias("doc_id"), F.explode(item_matches(benchmark, F.col(text))).alias("m"))
    return found.select("doc_id", "m.item_id", "m.start_word", "m.n_words", "m.similarity")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay as they are."""
    return docs.where(F.size(item_matches(benchmark, F.col(text))) == 0)
