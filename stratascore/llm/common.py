"""Words, hashes, local components and distributed components, shared by the operators here."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratascore.session import materialize, release

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def lower_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at the six ASCII blanks; null has no words.

    ``bytes.lower`` and ``bytes.split`` touch ASCII only, which is what the definition asks for.
    """
    return [] if text is None else text.encode("utf-8", "replace").lower().split()


def shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    """``size`` words joined by a blank, repeats included; a shorter text is one shingle; none has none."""
    if not words:
        return iter(())
    if len(words) <= size:
        return iter((b" ".join(words),))
    return map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))


def shingle_hashes(words: list[bytes], size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle."""
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles(words, size), repeat(seed)), np.uint64)


def sign_bits(hashes: np.ndarray, weights: np.ndarray | None = None, block: int = 1 << 15) -> np.uint64:
    """SimHash: a bit is 1 if the hashes that have it hold over half of the weight; no hashes give 0."""
    ones = np.zeros(64)
    for at in range(0, len(hashes), block):
        bits = np.unpackbits(hashes[at : at + block].view(np.uint8), bitorder="little").reshape(-1, 64)
        if weights is None:
            ones += bits.astype(np.float32).sum(axis=0)
        else:
            ones += weights[at : at + block] @ bits
    total = len(hashes) if weights is None else weights.sum()
    return np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0]


def local_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1: the smallest node each one is linked to, by hooking and pointer jumping."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    return label


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of an undirected graph: (node, root), root the smallest node reachable.

    ``links`` has two bigint columns ``a`` and ``b``; nodes without a link do not appear. Alternating
    large-star and small-star steps (Kiveris et al. 2014) until the links no longer change. Each step
    is a minimum per node (combined before the shuffle) and a join, so a node with very many links is
    an ordinary skewed join; every round is written to the shared folder.
    """
    now = materialize(links.where("a <> b").selectExpr("greatest(a, b) AS hi", "least(a, b) AS lo").distinct(), name)
    mark = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
        if state == mark or state.n == 0:
            break
        mark = state
        both = now.selectExpr("hi AS u", "lo AS v").union(now.selectExpr("lo AS u", "hi AS v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.join(low, "u").where("v > u").selectExpr("v AS hi", "m AS lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        star = large.join(low, "hi").where("lo <> m").selectExpr("lo AS hi", "m AS lo")
        after = materialize(star.union(low.selectExpr("hi", "m AS lo")).distinct(), name)
        release(now)
        now = after
    roots = now.selectExpr("lo AS node", "lo AS root").distinct()
    return now.selectExpr("hi AS node", "lo AS root").union(roots)
