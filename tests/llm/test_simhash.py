from collections import defaultdict

import pytest
import xxhash

from stratascore.llm import simhash_dedup
from stratascore.llm.simhash_dedup import close_links, keep_one_of_each, simhash_groups


def mark(text):
    w = [] if text is None else text.encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(marks, radius=3):
    parent = list(range(len(marks)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(marks)):
        for b in range(a):
            if (marks[a] ^ marks[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(marks))]


@pytest.mark.parametrize("name", ["corpus", "edges"])
def test_against_brute_force(request, name):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    marks = [mark(t) for _, t in rows]
    group = classes(marks)
    first = defaultdict(list)
    for (i, _), g in zip(rows, group):
        if i is not None:
            first[g].append(i)
    want = sorted((str(i), format(m, "016x"), min(first[g], default=None)) for (i, _), m, g in zip(rows, marks, group))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash_groups(docs).collect()) == want


@pytest.mark.parametrize("tile", [4, 4096])
def test_links_with_crowded_keys(spark, tile):
    """One key with far more fingerprints than a tile: dense chains, and a cloud around one fingerprint."""
    import random

    rng = random.Random(4)
    centre = rng.getrandbits(64)
    marks = {centre, 0, (1 << 64) - 1}
    for _ in range(150):
        x = centre
        for b in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << b
        marks.add(x)
    marks = sorted(marks | {rng.getrandbits(64) for _ in range(60)})
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    df = spark.createDataFrame([(m,) for m in signed], "fp bigint")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in close_links(df, tile=tile).collect()]
    assert all((a ^ b).bit_count() <= 63 for a, b in links)
    at = {m: i for i, m in enumerate(marks)}
    parent = list(range(len(marks)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(at[a]), find(at[b])
        parent[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(marks))] == classes(marks)


def test_keep_one(edges, no_docs):
    kept = keep_one_of_each(edges)
    assert kept.columns == edges.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    groups = {(r.doc_id, r.component_id) for r in simhash_groups(edges).collect()}
    assert sorted(map(str, ids)) == sorted({str(c) for _, c in groups})
    assert ids.count(18) == 1 and 11 not in ids and 10 in ids
    assert keep_one_of_each(no_docs).count() == 0
    assert simhash_groups(no_docs).count() == 0


def test_blocks_cover_the_radius():
    assert simhash_dedup.BLOCKS - simhash_dedup.RADIUS >= 1
