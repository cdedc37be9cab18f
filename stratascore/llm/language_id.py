"""Language identification with bit-sliced Bloom filters over character n-grams.

One filter per language would have to be asked for every language. Here the filters lie across: each
slot holds a bit per language, and the slots of an n-gram, joined by "and", give the languages that
contain it in one lookup. A text's n-grams are counted per language; a filter of fill ``q`` answers
``q ** PROBES`` of unknown n-grams by mistake, and that share is taken out of the count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS = (2, 3, 4)
SLOT_BITS = 20
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)  # one probe each, any odd numbers
PROBES = len(MULTIPLIERS)
ROWS_PER_LANGUAGE = 5_000  # documented bound of the labelled sample
MIN_SHARE = 0.002  # an n-gram belongs to a language if this share of its sampled documents has it
MAX_LANGUAGES = 1024
PIECE = 1 << 20
MIN_SCORE = 0.5
RUNS = re.compile(r"[^\W\d_]+")  # letters, and numerals such as fractions


def _words(text: str) -> list[str]:
    """Runs of ``str.isalpha``."""
    words = RUNS.findall(text)
    if "".join(words).isalpha():
        return words
    return "".join([c if c.isalpha() else " " for c in " ".join(words)]).split(" ")


def _pieces(text: str) -> Iterator[str]:
    """The text's words of letters in lower case between blanks, in pieces of bounded length."""
    for at in range(0, len(text), PIECE):
        words = [w for w in _words(text[at : at + PIECE].lower()) if w]
        if words:
            yield " " + " ".join(words) + " "


def _grams(piece: str) -> np.ndarray:
    """A 64-bit hash of every n-gram; those that are cut by a word's end keep the blank."""
    codes = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    found = []
    for n in ORDERS:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for i in range(n):
                h = (h ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            found.append(h)
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _slots(grams: np.ndarray, probe: int, slot_bits: int) -> np.ndarray:
    return ((grams * np.uint64(MULTIPLIERS[probe])) >> np.uint64(64 - slot_bits)).view(np.int64)


class LanguageFilter:
    """Slots x languages bits with each language's fill; small enough to broadcast, whatever the corpus."""

    def __init__(self, names: list[str], bits: np.ndarray, false_rate: np.ndarray | None = None):
        self.names, self.bits, self.slot_bits = names, bits, len(bits).bit_length() - 1
        if false_rate is None:
            false_rate = np.unpackbits(bits, axis=1, bitorder="little")[:, : len(names)].mean(axis=0) ** PROBES
        self.false_rate = false_rate

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """N-grams of the whole text found per language, and their number."""
        found, n = np.zeros(len(self.names)), 0
        for piece in _pieces(text):
            grams = _grams(piece)
            rows = self.bits[_slots(grams, 0, self.slot_bits)]
            for probe in range(1, PROBES):
                rows &= self.bits[_slots(grams, probe, self.slot_bits)]
            n += len(grams)
            found += np.unpackbits(rows, axis=1, count=len(self.names), bitorder="little").astype(np.float32).sum(axis=0)
        return found, n

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and the share of n-grams it truly knows; ``und`` and 0 without letters or languages."""
        if not text or not self.names:
            return "und", 0.0
        found, n = self.counts(text)
        if not n:
            return "und", 0.0
        true = (found / n - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)
        best = int(np.argmax(true))
        return self.names[best], float(min(max(true[best], 0.0), 1.0))


def _sample(docs: DataFrame, text: str, label: str, key: str, bound: int) -> DataFrame:
    """Labelled rows, about ``bound`` per language: a row is in if the hash of its key lies under the language's share."""
    rows = docs.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).alias("label"), F.xxhash64(F.lit("language"), F.col(key)).alias("h"))
    shares = {r.label: min(1.0, bound / r.n) for r in rows.groupBy("label").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(shares) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = F.coalesce(*[F.when(F.col("label") == name, F.lit(s)) for name, s in shares.items()], F.lit(0.0))
    return rows.where(F.pmod("h", F.lit(1 << 30)) < share * float(1 << 30))


def fit_filter(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
               bound: int = ROWS_PER_LANGUAGE, slot_bits: int = SLOT_BITS) -> LanguageFilter:
    """Learn from labelled rows: about ``bound`` per language, drawn by hash, is the documented sample.

    The driver receives at most one row per slot. Rows with a null text or label teach nothing; without
    any, the filter knows no language and answers ``und``.
    """
    sample = _sample(docs, text, label, key, bound).select("text", "label")

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, texts in frame.groupby("label")["text"]:
                for at in range(0, len(texts), 200):
                    own = [np.unique(np.concatenate([_grams(p) for p in _pieces(t)] or [np.empty(0, np.uint64)]))
                           for t in texts.iloc[at : at + 200]]
                    grams, n = np.unique(np.concatenate(own), return_counts=True)
                    yield pd.DataFrame({"label": name, "gram": grams.view(np.int64), "n": n})

    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return LanguageFilter([], np.zeros((2, 1), np.uint8))
    least = F.coalesce(*[F.when(F.col("label") == x, F.lit(max(1.0, MIN_SHARE * n))) for x, n in sizes.items()])
    number = F.coalesce(*[F.when(F.col("label") == x, F.lit(i)) for i, x in enumerate(names)])
    grams = sample.mapInPandas(gather, "label string, gram bigint, n bigint").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    grams = grams.where(F.col("n") >= least).select(number.alias("language"), "gram")

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame["gram"].to_numpy(np.int64).view(np.uint64)
            for probe in range(PROBES):
                yield pd.DataFrame({"language": frame["language"], "slot": _slots(values, probe, slot_bits)})

    bits = np.zeros((1 << slot_bits, (len(names) + 7) // 8), np.uint8)
    full = grams.mapInPandas(spread, "language int, slot bigint")
    full = full.withColumn("word", F.floor(F.col("language") / 32).cast("int")).groupBy("slot", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, language % 32)")).alias("mask")).toPandas()  # at most slots x words
    for word, part in full.groupby("word"):
        mask = part["mask"].to_numpy(np.int64)
        for byte in range(min(4, bits.shape[1] - 4 * word)):
            bits[part["slot"].to_numpy(), 4 * word + byte] = (mask >> (8 * byte)) & 255
    return LanguageFilter(names, bits)


def language_of(spark: SparkSession, model: LanguageFilter, text: Column) -> Column:
    """Struct ``lang_pred, score`` of each whole text."""
    shared = spark.sparkContext.broadcast((model.names, model.bits, model.false_rate))  # bounded by the slots

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        known = LanguageFilter(*shared.value)
        return pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    return run(text)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, learned from the rows that are not held out.

    ``und`` with score 0 stands for a null text, a text without letters, and any text if nothing was
    learned. A null key counts as an empty one and is not held out. Equal scores go to the first
    language by name. Repeated rows are rows; other columns are not read.
    """
    out = F.coalesce(held_out(key), F.lit(False))
    model = fit_filter(docs.where(~out), text, label, key)
    found = docs.select(F.col(key).alias("doc_id"), out.alias("held_out"),
                        language_of(docs.sparkSession, model, F.col(text)).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def keep_known(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
               min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows whose text is in no learned language: ``und``, or a score below ``min_score``.

    All columns stay as they are.
    """
    out = F.coalesce(held_out(key), F.lit(False))
    model = fit_filter(docs.where(~out), text, label, key)
    found = docs.withColumn("__found", language_of(docs.sparkSession, model, F.col(text)))
    return found.where((F.col("__found.lang_pred") != "und") & (F.col("__found.score") >= min_score)).drop("__found")
