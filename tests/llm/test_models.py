import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from stratascore.llm.lm_scoring import CLASSES, Trainer, log_softmax, score_texts
from stratascore.llm.token_counts import MARK, PieceTrie, count_tokens, load_pieces
from stratascore.llm.vector_search import Forest, nearest_vectors


def base_scores(rows):
    taught = Counter()
    for i, t in rows:
        if crc32(("" if i is None else str(i)).encode()) % 10:
            taught.update([*(t or "").encode().lower().split(), None])
    total, distinct = taught.total(), len(taught)
    out = []
    for i, t in rows:
        own = [*(t or "").encode().lower().split(), None]
        out.append((i, crc32(("" if i is None else str(i)).encode()) % 10 == 0, len(own), sum(taught[w] > 0 for w in own), total,
                    sum(math.log10((taught[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)))
    return out


@pytest.mark.parametrize("name", ["corpus", "edges"])
def test_base_score_and_counts(request, name):
    docs = request.getfixturevalue(name)
    got = sorted((tuple(r)[:6] for r in score_texts(docs).collect()), key=str)
    want = sorted(base_scores([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])


def test_rare_words_take_the_long_way(corpus, monkeypatch):
    """With almost no frequent words nearly all counts come from the shuffled ones; the base score stays."""
    from stratascore.llm import lm_scoring

    monkeypatch.setattr(lm_scoring, "FREQUENT", 20)
    got = sorted(tuple(r)[:6] for r in score_texts(corpus).collect())
    want = sorted(base_scores([(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]))
    assert [g[:5] for g in got] == [w[:5] for w in want] and [g[5] for g in got] == pytest.approx([w[5] for w in want])


def test_model_beats_unigram_on_held_out(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/documents.parquet")
    out = score_texts(docs).toPandas()
    out = out[out.held_out]
    assert out.score.sum() > out.base_score.sum() and (out.score < 0).all()


def test_model_is_a_distribution(corpus):
    """One-word texts over all known words, the unknown one and the end: their probabilities sum to at most one."""
    rows = corpus.select("doc_id", "text").collect()
    vocabulary = sorted({w for r in rows for w in r.text.lower().split()})
    probe = corpus.sparkSession.createDataFrame(
        [(r.doc_id, r.text) for r in rows] + [(10 * i, w) for i, w in enumerate([*vocabulary, "never-seen"], 1000)
                                             if crc32(str(10 * i).encode()) % 10 == 0], "doc_id bigint, text string")
    out = score_texts(probe).where("held_out AND doc_id >= 10000").toPandas()
    assert 0 < (10.0 ** out.score).sum() <= 1.0


def test_gradient_steps_raise_the_likelihood():
    rng = np.random.RandomState(0)
    found = rng.randint(0, CLASSES, (4000, 4)) + CLASSES * np.arange(4)
    classes = found[:, 0]
    trainer = Trainer(np.zeros((4 * CLASSES, CLASSES), np.float32), np.zeros(CLASSES, np.float32))
    values = []
    for _ in range(30):
        values.append(log_softmax(trainer.weights, trainer.bias, found)[np.arange(4000), classes].mean())
        trainer.step(found, classes)
    assert values[0] == pytest.approx(-math.log(CLASSES)) and values[-1] > -0.5
    assert np.exp(log_softmax(trainer.weights, trainer.bias, found)).sum(axis=1) == pytest.approx(np.ones(4000), abs=1e-4)


def test_lm_edges(no_docs, spark):
    assert score_texts(no_docs).count() == 0
    only_held = spark.createDataFrame([(i, "a b") for i in range(200) if crc32(str(i).encode()) % 10 == 0], "doc_id bigint, text string")
    rows = score_texts(only_held).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == pytest.approx(0.0) for r in rows)


@pytest.fixture(scope="module")
def pieces():
    return load_pieces()


def test_tokens_same_as_a_unigram_tokenizer(corpus, pieces):
    """An independent Viterbi over the same pieces agrees on the score; token counts differ in ties only."""
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    listed = list(pieces.items())
    other = Tokenizer(Unigram([("<unk>", -100.0), *listed], unk_id=0))
    words = sorted({w for r in corpus.select("text").collect() for w in r.text.split()})
    trie, differ = PieceTrie(pieces), 0
    for w in words:
        own, theirs = trie.count(w.encode()), other.encode(MARK + w).tokens
        if own != len(theirs):
            differ += 1
    assert differ <= len(words) // 1000


def plain_count(word, pieces, byte):
    text = MARK + word
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(text)
    for end in range(1, len(text) + 1):
        options = [(best[s][0] + pieces[text[s:end]], -best[s][1] - 1) for s in range(end) if text[s:end] in pieces]
        if not options:
            n = len(text[end - 1].encode())
            options = [(best[end - 1][0] + n * byte, -best[end - 1][1] - n)]
        score, n = max(options)
        best[end] = (score, -n)
    return best[-1][1]


def test_tokens_by_brute_force(edges, no_docs, pieces):
    trie = PieceTrie(pieces)
    small = PieceTrie(pieces, nodes=50)  # starts anew again and again
    rows = edges.select("doc_id", "text").collect()
    got = sorted((str(r.doc_id), r.n_pretokens, r.n_tokens) for r in count_tokens(edges, pieces).collect())
    want = []
    for r in rows:
        own = (r.text or "").split()
        known = {w: plain_count(w, pieces, trie.byte) for w in set(own)}
        want.append((str(r.doc_id), len(own), sum(known[w] for w in own)))
        assert small.document(r.text) == want[-1][1:]
    assert got == sorted(want)
    for w in ("漢字かな", "x" * 700, "naïve🙂", "a", "the" * 100):
        assert trie.count(w.encode()) == plain_count(w, pieces, trie.byte)
    assert count_tokens(no_docs, pieces).count() == 0 and trie.document(None) == (0, 0)


def exact(rows, k=20):
    vectors = {i: np.asarray(v, float) for i, v in rows}
    out = {}
    for q, x in vectors.items():
        if q % 20 == 0:
            out[q] = sorted(((-float((x * y).sum()), i) for i, y in vectors.items() if i != q))[:k]
    return out


def test_recall_on_the_given_vectors(spark, folder):
    table = spark.read.parquet(f"{folder.replace('0.001', '0.1')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want, got = exact(rows), {}
    for r in nearest_vectors(table).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in {f[1] for f in found}
        assert [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
        hits += len({f[1] for f in found} & {i for _, i in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_vectors_with_copies_and_faults(spark):
    rng = np.random.RandomState(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    rows += [(i, rows[3][1]) for i in range(200, 320)]  # a third of all is one vector
    bad = [(400, None), (420, [0.0] * 8), (440, [float("nan")] * 8), (460, [float("inf")] * 8), (480, [None] * 8), (500, [1.0, 2.0]), (None, rows[0][1]), (520, [])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + bad + rows[:5]], "vec_id bigint, embedding array<double>, score int").repartition(4)
    want, got = exact(rows), {}
    for r in nearest_vectors(table).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got.keys() == want.keys()
    for q, found in got.items():  # a table this small is compared whole, so the result is exact, ties included
        found.sort()
        assert [f[1] for f in found] == [i for _, i in want[q]]
        assert [f[2] for f in found] == pytest.approx([-s for s, _ in want[q]])


def test_many_units_find_the_same(spark, folder, monkeypatch):
    """Small groups of leaves and few queries a unit change the division of work, not the answers."""
    from stratascore.llm import vector_search

    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    monkeypatch.setattr(vector_search, "LEAF_ROWS", 32)
    whole = sorted(tuple(r) for r in nearest_vectors(table).collect())
    monkeypatch.setattr(vector_search, "GROUP_ROWS", 100)
    monkeypatch.setattr(vector_search, "UNIT_QUERIES", 5)
    monkeypatch.setattr(vector_search, "WALKS_PER_TASK", 4)
    assert sorted(tuple(r) for r in nearest_vectors(table).collect()) == whole and len(whole) == 25 * 20


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    rows = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest_vectors(few).collect())
    assert rows == [(0, 1, 3, 1.0), (0, 2, 20, 0.0), (20, 1, 3, 1.0), (20, 2, 0, 0.0)]
    assert nearest_vectors(few.limit(0)).count() == 0
    assert nearest_vectors(few.where("vec_id = 0")).count() == 0


def test_every_vector_has_one_leaf_a_tree():
    rng = np.random.RandomState(1)
    points = rng.normal(size=(500, 6))
    forest = Forest(points, float(np.linalg.norm(points, axis=1).max()), 16, trees=3)
    leaves = forest.leaves_of(points)
    assert leaves.shape == (500, 3) and len(np.unique(leaves)) == forest.n_leaves
    walked = list(forest.walk(forest.margins(points[:1])[0]))
    assert sorted(walked) == list(range(forest.n_leaves)) and walked[0] in leaves[0]


def test_words_and_classes_come_from_all_training_documents(spark, monkeypatch):
    from stratascore.llm import lm_scoring

    monkeypatch.setattr(lm_scoring, "SAMPLE_DOCS", 4, raising=False)  # the bound of a sample, which there was
    monkeypatch.setattr(lm_scoring, "HELD_WORDS", 16, raising=False)
    docs = spark.createDataFrame([(i, f"word{i} of text number{i} and word{i}") for i in range(300)], "doc_id bigint, text string").repartition(4)
    known = lm_scoring.learn_vocabulary(docs).number
    assert set(known) == {w.encode() for i in range(300) for w in (f"word{i}", f"number{i}", "of", "text", "and")}


def test_sums_of_groups_and_one_shift_for_all_tokens():
    from stratascore.llm.lm_scoring import LONG, group_sums

    rng = np.random.RandomState(3)
    sizes = np.array([1, 2, LONG - 1, LONG, 3 * LONG, 1, 1, 7])  # alone, few, many
    order = rng.permutation(sizes.sum())
    rows = rng.randint(-50, 50, (sizes.sum(), CLASSES)).astype(np.float32)
    first = np.cumsum(sizes) - sizes
    wanted = np.stack([rows[order[a : a + n]].sum(axis=0) for a, n in zip(first, sizes)])
    assert np.array_equal(group_sums(rows, order, first, sizes), wanted)
    weights = np.zeros((3, CLASSES), np.float32)
    weights[1], weights[2, 0] = -400, 60  # a token far below the others keeps its digits
    logs = log_softmax(weights, np.zeros(CLASSES, np.float32), np.array([[0], [1], [2]]))
    assert logs[:2] == pytest.approx(np.full((2, CLASSES), -np.log(CLASSES)), abs=1e-4)
    assert logs[2, 0] == pytest.approx(0, abs=1e-4)
    assert not len(log_softmax(weights, np.zeros(CLASSES, np.float32), np.zeros((0, 1), np.int64)))
