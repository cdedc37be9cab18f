"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

P(word | before) = P(class | before) * P(word | class). The class softmax has hashed features of the
three words before: each alone (a bigram and two skips) and the nearest two together. Classes are
clusters of frequent words by the words beside them; the end of a text and the words outside the
frequent ones have a class each. Inside a class a word has its share of the class's training tokens.

Counts cover every training document. Frequent words are counted in one array per task; the others,
whose number grows with the corpus, are shuffled by their hash and never held in one place. Weights are
trained by distributed gradient updates: in each round every task makes one pass of Adagrad steps over
its documents from the common weights, and the tasks' weights are averaged per feature, each by how much
it has seen of it. Every training document is used once, in the round that its hash gives.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratascore.llm.common import lower_words
from stratascore.session import materialize, release

FREQUENT = 1 << 16  # words with an own number, by count in all training documents
PAIRS_AT_ONCE = 1 << 19  # counts that the driver receives at once
HELD_WORDS = 1 << 18  # different words that a task counts before it sends them
BESIDE = 64
CLASSES = 32
BUCKETS = 1 << 15
ROUNDS = 2
STEP = 0.5
CHUNK = 1 << 14
LONG = 32  # rows that one matrix product adds
SMOOTH = 0.1
END, OTHER, START = 0, 1, 2  # numbers before the frequent words, which begin at FIRST
FIRST = 3


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 10 == 0


class Vocabulary:
    """Frequent words with their numbers and classes."""

    def __init__(self, words: list[bytes], classes: np.ndarray):
        self.number = {w: i for i, w in enumerate(words, FIRST)}
        self.class_of = np.concatenate([[0, 1, 1], classes]).astype(np.int64)

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words and the end; words without one are ``OTHER``."""
        ids = np.empty(len(words) + 1, np.int64)
        ids[:-1] = np.fromiter(map(self.number.get, words, repeat(OTHER)), np.int64, len(words))
        ids[-1] = END
        return ids


def features(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashed features of every token, tokens x 4; ``starts`` is the first token of each one's text."""
    at = np.arange(len(ids))
    before = [np.where(at - k >= starts, ids[np.maximum(at - k, 0)], START) for k in (1, 2, 3)]
    parts = [*before, before[0] * (FREQUENT + FIRST) + before[1]]
    mixed = [(p.astype(np.uint64) * np.uint64(len(parts)) + np.uint64(j)) * np.uint64(0x9E3779B97F4A7C15) for j, p in enumerate(parts)]
    return np.stack([(m >> np.uint64(64 - BUCKETS.bit_length() + 1)).view(np.int64) for m in mixed]).T  # a column lies together


def _shifted_scores(weights: np.ndarray, bias: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores less a shift, their exponentials and the sums of those.

    One shift serves all tokens, unless a token's scores lie so far below it that its sum loses digits.
    """
    scores = weights.take(found[:, 0], axis=0)
    scores += bias
    for j in range(1, found.shape[1]):
        scores += weights.take(found[:, j], axis=0)
    for shift in (lambda: scores.max(initial=-np.inf), lambda: scores.max(axis=1, keepdims=True)):
        scores -= shift()
        powers = np.exp(scores)
        sums = powers.sum(axis=1, keepdims=True)
        if not len(sums) or sums.min() > 1e-20:
            break
    return scores, powers, sums


def log_softmax(weights: np.ndarray, bias: np.ndarray, found: np.ndarray) -> np.ndarray:
    scores, _, sums = _shifted_scores(weights, bias, found)
    scores -= np.log(sums)
    return scores


def group_sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of ``rows`` over stretches of ``order``, each from its ``first`` place and ``n`` long."""
    out = rows.take(order[first], axis=0)  # right for stretches of one
    some = (n > 1) & (n < LONG)
    if some.any():
        own = n[some]
        out[some] = np.add.reduceat(rows.take(order[np.repeat(some, n)], axis=0), np.cumsum(own) - own, axis=0)
    for i in np.flatnonzero(n >= LONG):  # at most one in LONG of the rows
        out[i] = np.ones(n[i], rows.dtype) @ rows.take(order[first[i] : first[i] + n[i]], axis=0)
    return out


class Trainer:
    """Adagrad on the log likelihood of the classes, one step per chunk of tokens."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights.copy(), bias.copy()
        self.squares = np.full(len(weights), 1e-3, np.float32)
        self.seen = np.zeros(len(weights), np.int64)

    def step(self, found: np.ndarray, classes: np.ndarray) -> None:
        _, error, sums = _shifted_scores(self.weights, self.bias, found)
        error /= -sums
        error[np.arange(len(classes)), classes] += 1
        for j in range(found.shape[1]):
            order = np.argsort(found[:, j].astype(np.uint16), kind="stable")  # 16 bits: a radix sort
            rows = found[order, j]
            first = np.nonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))[0]
            own, n = rows[first], np.diff(np.append(first, len(rows)))
            slope = group_sums(error, order, first, n)
            slope /= np.sqrt(n)[:, None].astype(np.float32)
            self.squares[own] += np.einsum("ij,ij->i", slope, slope) / np.float32(slope.shape[1])
            slope *= STEP / np.sqrt(self.squares[own])[:, None]
            self.weights[own] += slope
            self.seen[own] += n


def _chunks(texts: Iterator[str | None], vocabulary: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray, list[int], list[list[bytes]]]]:
    """Whole texts together up to about ``CHUNK`` tokens: numbers, text starts, lengths and words."""
    ids, words, size = [], [], 0
    for text in texts:
        words.append(lower_words(text))
        ids.append(vocabulary.ids(words[-1]))
        size += len(ids[-1])
        if size >= CHUNK:
            lengths = [len(x) for x in ids]
            yield np.concatenate(ids), np.repeat(np.cumsum([0, *lengths[:-1]]), lengths), lengths, words
            ids, words, size = [], [], 0
    if ids:
        lengths = [len(x) for x in ids]
        yield np.concatenate(ids), np.repeat(np.cumsum([0, *lengths[:-1]]), lengths), lengths, words


def _clusters(points: np.ndarray, k: int, seed: int = 5, rounds: int = 10) -> np.ndarray:
    """Spherical k-means with a fixed seed; rows without any count fall to the first cluster."""
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    rng = np.random.RandomState(seed)
    usable = np.nonzero(points.any(axis=1))[0]
    if len(usable) <= k:
        return np.arange(len(points)) % k
    centres = points[rng.choice(usable, k, replace=False)]
    label = np.zeros(len(points), np.int64)
    for _ in range(rounds):
        label = np.argmax(points @ centres.T, axis=1)
        for c in range(k):
            own = points[label == c]
            centre = own.sum(axis=0) if len(own) else points[rng.choice(usable)]
            centres[c] = centre / max(np.linalg.norm(centre), 1e-9)
    return label


def learn_vocabulary(train: DataFrame) -> Vocabulary:
    """Frequent words of all training rows, clustered by their neighbours there.

    The driver receives at most ``FREQUENT`` words and ``FREQUENT`` x ``BESIDE`` counts.
    """
    texts = train.select("text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[bytes] = Counter()
        for frame in frames:
            for text in frame["text"]:
                counts.update(lower_words(text))
                if len(counts) >= HELD_WORDS:
                    yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                    counts.clear()
        if counts:
            yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    words = texts.mapInPandas(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    words = words.where(F.length("word") <= 1024).orderBy(F.desc("n"), "word").limit(FREQUENT).toPandas()
    known = [bytes(w) for w in words["word"]]
    plain = Vocabulary(known, np.zeros(len(known)))
    beside = min(BESIDE, len(known))
    if not known:
        return plain
    shared = train.sparkSession.sparkContext.broadcast(known)

    def neighbours(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Vocabulary(shared.value, np.zeros(len(shared.value)))
        size = len(shared.value) * BESIDE
        total = np.zeros(size, np.int64)  # a task sends each pair once
        for frame in frames:
            for ids, starts, _, _ in _chunks(frame["text"], own):
                at = np.arange(len(ids))
                inside = (at > starts) & (ids != END)
                left, right = ids[np.maximum(at - 1, 0)][inside] - FIRST, ids[inside] - FIRST
                codes = np.concatenate([x[(x >= 0) & (y >= 0) & (y < beside)] * BESIDE + y[(x >= 0) & (y >= 0) & (y < beside)]
                                        for x, y in ((left, right), (right, left))])
                found, n = np.unique(codes, return_counts=True)
                total[found] += n
        found = np.flatnonzero(total)
        for start in range(0, len(found), 1 << 18):
            part = found[start : start + (1 << 18)]
            yield pd.DataFrame({"code": part, "n": total[part]})

    pairs = texts.mapInPandas(neighbours, "code bigint, n bigint").groupBy("code").agg(F.sqrt(F.sum("n")).cast("float").alias("root"))
    pairs = materialize(pairs, "lm-beside")
    points = np.zeros(len(known) * BESIDE, np.float32)
    for start in range(0, len(points), PAIRS_AT_ONCE):
        part = pairs.where(F.col("code").between(start, start + PAIRS_AT_ONCE - 1)).toArrow()
        points[part["code"].to_numpy()] = part["root"].to_numpy()
    release(pairs)
    points = points.reshape(-1, BESIDE)
    return Vocabulary(known, _clusters(points, CLASSES - 2) + 2)


def score_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Training rows are those whose crc32 of the id as text, modulo 10, is not 0 (a null id counts as an
    empty one). A null text is an empty one, which has one token, the end. ``base_score`` is the smoothed
    unigram score, ``score`` the model's; both are log10 probabilities in which all words unknown to the
    training rows share one place. Repeated rows are rows and are learned as often as they occur; other
    columns are not read. An empty table gives an empty result; without training rows the unigram has
    only the smoothing and the model an even softmax.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("held_out", held_out("doc_id"))
    train = rows.where("NOT held_out")
    vocabulary = learn_vocabulary(train)
    words = sorted(vocabulary.number, key=vocabulary.number.get)
    parts = (words, vocabulary.class_of[FIRST:])
    shared = spark.sparkContext.broadcast(parts)  # at most FREQUENT words of 1 KB
    n_ids = FIRST + len(words)

    # one pass: counts of frequent words per task, and a row per document and other word
    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, counts = Vocabulary(*shared.value), np.zeros(n_ids, np.int64)
        for frame in frames:
            taught, taken = ~frame["held_out"].to_numpy(bool), []
            hashes, n, others = [], [], np.zeros(len(frame), np.int64)
            for i, text in enumerate(frame["text"]):
                listed = lower_words(text)
                ids = own.ids(listed)
                if taught[i]:
                    taken.append(ids)
                rare = Counter([listed[at] for at in np.flatnonzero(ids == OTHER).tolist()])
                hashes.extend(map(xxhash.xxh64_intdigest, rare))
                n.extend(rare.values())
                others[i] = len(rare)
            if taken:
                counts += np.bincount(np.concatenate(taken), minlength=n_ids)
            yield pd.DataFrame({"kind": 0, "word": np.array(hashes, np.uint64).view(np.int64), "n": n,
                                "doc_id": frame["doc_id"].astype("Int64").repeat(others).array,
                                "mark": frame["mark"].to_numpy().repeat(others), "taught": taught.repeat(others)})
        at = np.nonzero(counts)[0]
        yield pd.DataFrame({"kind": 1, "word": at, "n": counts[at], "doc_id": pd.array([None] * len(at), "Int64"), "mark": 0, "taught": True})

    marked = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.hash("text").alias("mark"), "held_out", "text")
    gathered = marked.mapInPandas(gather, "kind int, word bigint, n bigint, doc_id bigint, mark int, taught boolean")
    gathered = materialize(gathered, "lm-counts", "kind")
    counts = np.zeros(n_ids, np.int64)
    listed = gathered.where("kind = 1").groupBy("word").agg(F.sum("n").alias("n")).toPandas()  # at most FREQUENT + 3 rows
    counts[listed["word"].to_numpy(np.int64)] = listed["n"].to_numpy(np.int64)
    rare = gathered.where("kind = 0").select("word", "n", "doc_id", "mark", "taught")
    known_rare = rare.groupBy("word").agg(F.sum(F.when(F.col("taught"), F.col("n")).otherwise(0)).alias("c"))
    facts = known_rare.where("c > 0").agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    rare_tokens, rare_words = int(facts.n), int(facts.v)
    counts[OTHER] = 0
    total, distinct = int(counts.sum()) + rare_tokens, int((counts > 0).sum()) + rare_words
    below = total + SMOOTH * (distinct + 1)
    per_row = rare.join(known_rare, "word").groupBy("doc_id", "mark").agg(
        F.sum("n").alias("rare_n"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * F.log10(F.col("c") + SMOOTH)).alias("rare_log"))

    # in-class shares; class OTHER holds the rare words and the place of the unknown ones
    class_of = vocabulary.class_of
    class_tokens = np.bincount(class_of, weights=counts, minlength=CLASSES)
    class_words = np.bincount(class_of[np.arange(n_ids) >= FIRST], minlength=CLASSES).astype(float)
    class_words[END] = 1
    class_tokens[OTHER] = rare_tokens
    class_words[OTHER] = rare_words + 1
    inside = np.log10((counts + SMOOTH) / (class_tokens + SMOOTH * class_words)[class_of])
    inside[[OTHER, START]] = 0.0
    rare_below = class_tokens[OTHER] + SMOOTH * class_words[OTHER]
    bias = np.log((class_tokens + 1) / (class_tokens + 1).sum()).astype(np.float32)
    weights = _train(train, parts, bias)
    model = spark.sparkContext.broadcast((weights, bias, inside, np.log10((counts + SMOOTH) / below), counts > 0))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Vocabulary(*shared.value)
        w, b, within, plain, seen = model.value
        for frame in frames:
            found = []
            for ids, starts, lengths, _ in _chunks(frame["text"], own):
                chosen = log_softmax(w, b, features(ids, starts))[np.arange(len(ids)), own.class_of[ids]] / np.log(10)
                first = np.cumsum([0, *lengths[:-1]])
                known = ids != OTHER
                found.append(np.stack([np.asarray(lengths, float), np.add.reduceat((~known).astype(float), first),
                                       np.add.reduceat((seen[ids] & known).astype(float), first),
                                       np.add.reduceat(np.where(known, plain[ids], 0.0), first),
                                       np.add.reduceat(chosen.astype(float) + within[ids], first)], axis=1))
            values = np.concatenate(found) if found else np.zeros((0, 5))
            out = frame[["doc_id", "mark", "held_out"]].copy()
            for i, name in enumerate(("n_tokens", "n_rare", "n_known")):
                out[name] = values[:, i].astype(np.int64)
            out["base"], out["own"] = values[:, 3], values[:, 4]
            yield out

    scored = marked.mapInPandas(score, "doc_id bigint, mark int, held_out boolean, n_tokens bigint, n_rare bigint, n_known bigint, base double, own double")
    scored = scored.withColumn("__id", F.coalesce("doc_id", F.lit(-1))).withColumn("__none", F.col("doc_id").isNull())
    per_row = per_row.select(F.coalesce("doc_id", F.lit(-1)).alias("__id"), F.col("doc_id").isNull().alias("__none"), "mark", "rare_n", "rare_known", "rare_log")
    joined = scored.join(per_row, ["__id", "__none", "mark"], "left")
    share = F.coalesce(F.col("n_rare") / F.col("rare_n"), F.lit(0.0))  # repeated rows have their sums together
    logs = F.coalesce(F.col("rare_log") * share, F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce(F.round(F.col("rare_known") * share), F.lit(0.0))).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_rare") * float(np.log10(below))).alias("base_score"),
        (F.col("own") + logs - F.col("n_rare") * float(np.log10(rare_below))).alias("score"))


def _train(train: DataFrame, parts: tuple[list[bytes], np.ndarray], bias: np.ndarray) -> np.ndarray:
    """Weights after ``ROUNDS`` rounds; a round sends each task's touched features, and the driver gets one row per bucket."""
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast(parts)
    weights = np.zeros((BUCKETS, CLASSES), np.float32)
    for number in range(ROUNDS):
        start = spark.sparkContext.broadcast(weights)
        chosen = train.where(F.pmod(F.xxhash64(F.lit("round"), "doc_id"), F.lit(ROUNDS)) == number).select("text")

        def learn(frames: Iterator[pd.DataFrame], start=start) -> Iterator[pd.DataFrame]:
            own, trainer = Vocabulary(*shared.value), Trainer(start.value, bias)
            for frame in frames:
                for ids, starts, _, _ in _chunks(frame["text"], own):
                    trainer.step(features(ids, starts), own.class_of[ids])
            at = np.nonzero(trainer.seen)[0]
            for i in range(0, len(at), 4096):
                part = at[i : i + 4096]
                seen = np.sqrt(trainer.seen[part])
                moved = (trainer.weights[part] - start.value[part]) * seen[:, None]
                yield pd.DataFrame({"bucket": part, "seen": seen, **{f"w{c}": moved[:, c] for c in range(CLASSES)}})

        schema = "bucket int, seen float, " + ", ".join(f"w{c} float" for c in range(CLASSES))
        moved = chosen.mapInPandas(learn, schema).groupBy("bucket").agg(
            F.sum("seen").alias("seen"), *[F.sum(f"w{c}").alias(f"w{c}") for c in range(CLASSES)]).toPandas()
        weights = weights.copy()
        step = moved[[f"w{c}" for c in range(CLASSES)]].to_numpy(np.float64) / np.maximum(moved[["seen"]].to_numpy(np.float64), 1e-9)
        weights[moved["bucket"].to_numpy()] += step.astype(np.float32)
    return weights
