import random

import numpy as np

from stratascore.llm.common import components, local_labels, lower_words, shingles, sign_bits


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_local_labels():
    rng = random.Random(1)
    for _ in range(20):
        n = rng.randint(1, 60)
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, 50))]
        left, right = np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
        assert local_labels(n, left, right).tolist() == roots(n, pairs)


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(7, 7)]
    pairs += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = roots(400, pairs)
    assert found == {n: want[n] for p in pairs for n in p if p[0] != p[1] or n in found}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_words_and_shingles():
    assert lower_words("A\tÉb\x0bC\x0c d\u00a0e") == ["a".encode(), "Éb".encode(), b"c", "d\u00a0e".encode()]
    assert lower_words(None) == [] and list(shingles([], 3)) == []
    assert list(shingles([b"a", b"b"], 3)) == [b"a b"]
    assert list(shingles([b"a"] * 4, 3)) == [b"a a a"] * 2
    assert sign_bits(np.empty(0, np.uint64)) == 0
    assert sign_bits(np.array([5, 4], np.uint64)) == 4  # over half, not half
