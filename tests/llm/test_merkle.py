import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stratascore.llm.merkle import folded, merkle_manifest, verified_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grow(digests, fanout=3):
    """The root and, per leaf, its (left, right) siblings from the bottom up."""
    proofs, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, place in enumerate(at):
            start = place - place % fanout
            proofs[i].append(("".join(level[start:place]), "".join(level[place + 1:start + fanout])))
            at[i] = place // fanout
        level = [h(*level[s:s + fanout]) for s in range(0, len(level), fanout)]
    return level[0], proofs


def by_hand(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r.source].append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for name in names:
        members = sorted(trees[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        built[name] = (members, *grow([leaf_of(r, r.text) for r in members]))
    root, upper = grow([built[name][1] for name in names]) if names else (None, [])
    found = []
    for name, above in zip(names, upper):
        members, subroot, proofs = built[name]
        for r, own in zip(members, proofs):
            proof = own + above
            cut = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and r.text is not None
            end = leaf_of(r, r.text.replace("\n", "") if cut else r.text)
            for left, right in proof:
                end = h(left, end, right)
            found.append((r.doc_id, leaf_of(r, r.text), subroot, root, h(*[a + b for a, b in proof]), end, end == root))
    return found


def same(got, want):
    return sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_manifest_by_hand(spark, edges):
    got = verified_manifest(edges).collect()
    assert same(got, by_hand(edges.collect()))


def test_many_sizes_of_trees(spark):
    """One source with over a third of the rows, sources of one row, line feeds in half of the texts."""
    rng = random.Random(4)
    sources = ["hot"] * 90 + [f"s{i}" for i in range(14)] + ["nine"] * 9 + ["ten"] * 10 + [None] * 28 + ["", "é", "z"]
    rows = [(i * 7 % 1000, None if i % 50 == 7 else f"line {i}\nmore" if rng.random() < 0.5 else f"line {i}", "en", s, i) for i, s in enumerate(sources)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(7)
    got = verified_manifest(docs).collect()
    assert same(got, by_hand(docs.collect()))
    assert {r.verified for r in got} == {True, False}


def test_rows_of_one_key(spark):
    """A third of the rows are copies of one row: each has a place and every place is proved."""
    rows = [(5, "same", "en", "a", 1)] * 60 + [(i, f"t{i}", "en", "a", 1) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(6)
    got = merkle_manifest(docs).withColumn("end", folded(F.col("leaf"), F.col("proof"))).collect()
    assert len(got) == 160 and all(r.end == r.root for r in got)
    assert len({r.root for r in got}) == 1 and len({tuple(map(tuple, r.proof)) for r in got}) == 160


@pytest.mark.parametrize("fanout", [2, 5])
def test_other_fanout(spark, corpus, fanout):
    got = merkle_manifest(corpus, fanout=fanout).withColumn("end", folded(F.col("leaf"), F.col("proof"))).collect()
    rows = corpus.collect()
    assert len(got) == len(rows) and all(r.end == r.root for r in got)
    for name in ("a", "c"):
        members = sorted((r for r in rows if r.source == name), key=lambda r: r.doc_id)
        want, _ = grow([leaf_of(r, r.text) for r in members], fanout)
        ids = {r.doc_id for r in members}
        assert {r.subroot for r in got if r.doc_id in ids} == {want}


def test_empty_and_single(spark, no_docs):
    got = verified_manifest(no_docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.collect() == []
    one = spark.createDataFrame([(None, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    row = verified_manifest(one).collect()[0]
    assert row.leaf == row.subroot == row.root == row.folded_root == h("-" * 5) and row.verified and row.proof_sha256 == h()
