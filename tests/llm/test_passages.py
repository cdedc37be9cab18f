import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import prose

from stratascore.llm.decontamination import HammingBlocks, ItemIndex, contaminated, keep_clean, weighted_similarity
from stratascore.llm.substring_dedup import (
    FUNCTIONS, WIDTH, _open_starts, _reduced, agreeing_places, alike_members, compact_windows, repeated_passages, shingle_codes, similar_passages,
)


def test_compact_windows_by_definition():
    rng = np.random.RandomState(1)
    for n, width in ((1, 1), (40, 5), (60, 10), (9, 10)):
        values = rng.permutation(n)
        want = set()
        for c in range(n):
            low, high = c, c
            while low > 0 and values[low - 1] > values[c]:
                low -= 1
            while high < n - 1 and values[high + 1] > values[c]:
                high += 1
            if high - low + 1 >= width:
                want.add((low, c, high))
        assert set(compact_windows(values, width)) == want


def test_interval_join_by_definition():
    rng = random.Random(6)
    for _ in range(200):
        anchors = [(rng.randrange(50), (rng.randrange(60) << 32) | (rng.randrange(20) << 16) | rng.randrange(20),
                    (rng.randrange(60) << 32) | (rng.randrange(20) << 16) | rng.randrange(20)) for _ in range(rng.randint(1, 15))]
        spans = []
        for key, a, b in anchors:
            left, right = min(a >> 16 & 0x7FFF, b >> 16 & 0x7FFF), min(a & 0x7FFF, b & 0x7FFF)
            spans.append(((a >> 32) - left, (a >> 32) + right, key % FUNCTIONS, (a >> 32, b >> 32, (a >> 32) - left, (a >> 32) + right)))
        spans = [s for s in spans if s[1] - s[0] + 1 >= 10]
        want = [s[3] for s in spans if len({o[2] for o in spans if min(s[1], o[1]) - max(s[0], o[0]) + 1 >= 10}) >= 2]
        assert agreeing_places(anchors, 10, 2) == want


def test_open_starts_by_definition():
    rng = random.Random(11)
    for _ in range(200):
        n = rng.randint(1, 200)
        places = [(rng.randrange(n + WIDTH - 1), rng.randrange(120), rng.randrange(120)) for _ in range(rng.randint(0, 3))]
        spans = [(s, s + rng.randint(1, 150)) for s in (rng.randrange(n) for _ in range(rng.randint(0, 2)))]
        want = [s for s in range(n) if any(c - left <= s <= c <= s + WIDTH - 1 <= c + right for c, left, right in places)
                and not any(x <= s and s + WIDTH <= y for x, y in spans)]
        packed = np.array([(c << 32) | (left << 16) | right for c, left, right in places], np.int64)
        assert _open_starts(packed, spans, n).tolist() == want


def test_equal_stretches_of_a_task():
    """Every code goes on once; all other documents that have it are linked to the one that goes on."""
    rng = random.Random(12)
    for _ in range(50):
        held = sorted({(rng.randrange(4), rng.randrange(30)) for _ in range(rng.randint(1, 40))})
        code = {x: rng.randrange(12) if rng.random() < 0.5 else 100 + x[1] for x in held}
        lone = [(d, np.array([s]), np.array([code[d, s]])) for d, s in held]
        out = _reduced(lone + lone[:2]).reindex(columns=["doc_id", "start_word", "end_word", "other_doc_id", "other_start", "other_end", "code"])
        going, met = out[out["code"].notna()], out[out["code"].isna()]
        first = {c: min(x for x in held if code[x] == c) for c in code.values()}
        assert sorted(zip(going["doc_id"], going["start_word"], strict=True)) == [x for x in held if first[code[x]][0] == x[0]]
        links = met.astype("int64", errors="ignore").to_dict("records")
        for d, s in held:
            other, at = first[code[d, s]]
            if other != d:
                assert any(r["doc_id"] == d and r["start_word"] <= s and s + 50 <= r["end_word"] and r["other_doc_id"] == other
                           and r["other_start"] - r["start_word"] == at - s for r in links)


def make_documents(spark):
    """Passages of 51 to 200 words, exact and with a changed word, in documents that share nothing else."""
    rng = random.Random(5)
    passages = [prose("en", n, 900 + n).split() for n in (51, 60, 120, 200)]
    line = prose("en", 14, 77).split()  # a line too short to count
    texts = []
    for i in range(60):
        text = prose(rng.choice(["en", "fr"]), rng.randint(10, 300), 2000 + i).split() + line
        if i % 3 == 0:
            own = list(passages[i // 3 % 4])
            if i % 6 == 0 and len(own) >= 120:
                own[len(own) // 2] = "changed"
            at = rng.randint(0, len(text))
            text = text[:at] + own + text[at:]
        texts.append((i, " ".join(text), "x", 1))
    texts += [(70, texts[1][1], "x", 1), (71, texts[1][1].upper(), "x", 1), (72, None, "x", 1), (73, "", "x", 1), (70, texts[1][1], "x", 1),
              (None, texts[1][1], "x", 1)]
    return spark.createDataFrame(texts, "doc_id bigint, text string, key string, other int").repartition(4), texts


def test_repeated_passages(spark):
    docs, texts = make_documents(spark)
    rows = repeated_passages(docs).collect()
    words = {i: t.lower().split() for i, t, *_ in texts if t and i is not None}
    parent = {i: i for i in words}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in rows:
        assert r.doc_id != r.other_doc_id and r.end_word - r.start_word >= 50
        a, b = words[r.doc_id][r.start_word:r.end_word], words[r.other_doc_id][r.other_start:r.other_end]
        x, y = (Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) for w in (a, b))
        assert weighted_similarity(x, y) == pytest.approx(r.similarity) and r.similarity >= 0.8
        p, q = find(r.doc_id), find(r.other_doc_id)
        parent[max(p, q)] = min(p, q)
    groups = {}
    for i, w in words.items():  # brute force: all stretches of 50 words
        for at in range(len(w) - 49):
            groups.setdefault(tuple(w[at:at + 50]), set()).add(i)
    for held in groups.values():
        assert len({find(i) for i in held}) == 1
    involved = {i for r in rows for i in (r.doc_id, r.other_doc_id)}
    assert {i for g in groups.values() if len(g) > 1 for i in g} <= involved
    assert not {72, 73} & involved
    assert all(i % 3 == 0 or i in (1, 70, 71) for i in involved)  # documents with the short line only are clean


def test_passages_edges(edges, no_docs):
    rows = repeated_passages(edges).collect()
    assert {(r.doc_id, r.other_doc_id) for r in rows} == {(11, 10), (12, 10)} or {(12, 11), (11, 10)} == {(r.doc_id, r.other_doc_id) for r in rows}
    assert repeated_passages(no_docs).count() == 0


def test_hamming_blocks_find_all():
    rng = random.Random(3)
    marks = [rng.getrandbits(64) for _ in range(300)]
    index = HammingBlocks(marks, 17, 9)
    for _ in range(60):
        x = rng.choice(marks)
        for b in rng.sample(range(64), rng.randint(0, 24)):
            x ^= 1 << b
        assert index.near(x) == [i for i, m in enumerate(marks) if (m ^ x).bit_count() <= 17]


def grams(w):
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute_force(text, items):
    """Best similarity of any window of the item's length, without fingerprints."""
    words, found = (text or "").lower().split(), {}
    for item, own in items.items():
        width = min(len(own), len(words))
        best = max((weighted_similarity(grams(words[s:s + width]), grams(own)) for s in range(len(words) - width + 1)), default=0)
        if own and width and best >= 0.8 - 1e-12:
            found[item] = best
    return found


def test_contaminated_against_brute_force(spark, benchmark_items):
    rng = random.Random(8)
    items = {r.item_id: (r.text or "").lower().split() for r in benchmark_items.collect() if r.item_id != 5}
    texts = []
    for i in range(60):
        text = prose("en", rng.randint(0, 120), 5000 + i).split()
        if i % 2:
            own = list(items[rng.choice([1, 2, 6, 7])])
            change = rng.choice(["none", "first", "last", "middle", "cut", "upper"])
            if change == "first":
                own[0] = "other"
            elif change == "last":
                own[-2:] = ["other"]
            elif change == "middle":
                own[len(own) // 2] = "other"
            elif change == "cut":
                own = own[: len(own) - 3]
            elif change == "upper":
                own = [w.upper() for w in own]
            at = rng.randint(0, len(text))
            text = text[:at] + own + text[at:]
        texts.append((i, "\n".join(text), "x"))
    texts += [(100, None, "x"), (101, "", "x"), (102, " ".join(items[7][:58]), "x"), (103, prose("de", 20000, 1) + " " + " ".join(items[2]), "x")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, similarity string").repartition(3)
    got = {}
    for r in contaminated(docs, benchmark_items).collect():
        got.setdefault(r.doc_id, {})[r.item_id] = r.similarity
    want = {i: f for i, t, _ in texts if (f := brute_force(t, items))}
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i])
    clean = keep_clean(docs, benchmark_items)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {t[0] for t in texts} - set(want)


def test_contaminated_edges(edges, no_docs, benchmark_items):
    assert contaminated(edges, benchmark_items).count() == 0
    assert contaminated(no_docs, benchmark_items).count() == 0
    assert keep_clean(edges, benchmark_items.limit(0)).count() == edges.count()


def test_items_in_several_passes(spark, benchmark_items):
    from pyspark.sql import functions as F

    from stratascore.llm.decontamination import item_matches

    items = benchmark_items.collect()
    docs = spark.createDataFrame([(i, f"x {r.text} y") for i, r in enumerate(items) if r.text], "doc_id bigint, text string")
    few = docs.select(F.sort_array(item_matches(benchmark_items, F.col("text"), item_chars=150)["item_id"]).alias("m"), "doc_id")
    one = docs.select(F.sort_array(item_matches(benchmark_items, F.col("text"))["item_id"]).alias("m"), "doc_id")
    assert sorted(few.collect()) == sorted(one.collect())


def test_index_of_no_items():
    assert ItemIndex([]).matches("some words here") == []


def test_passages_around_one_common_line(spark):
    """Every document has the same line; passages around it are shared by two each, and by no two the same."""
    line = prose("en", 44, 31).split()
    texts, pairs = [], 60
    for i in range(2 * pairs):
        shared = prose("fr", 8, 7000 + i % pairs).split()
        cut = i % pairs % 9
        passage = [*shared[:cut], *line, *shared[cut:]]
        text = [*prose("de", 30, 100 + i).split(), *passage, *prose("de", 30, 400 + i).split()]
        if i % 3 == 0:
            text += [*line, *prose("de", 25, 800 + i).split()]  # the line once more, before or after the passage
        if i % 5 == 0:
            text = [*prose("de", 25, 900 + i).split(), *line, *text]
        texts.append((i, " ".join(text)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    words = dict((i, t.split()) for i, t in texts)
    rows = repeated_passages(docs).collect()
    for r in rows:
        a, b = words[r.doc_id][r.start_word:r.end_word], words[r.other_doc_id][r.other_start:r.other_end]
        assert weighted_similarity(grams(a), grams(b)) == pytest.approx(r.similarity) and r.similarity >= 0.8
    found = {frozenset((r.doc_id, r.other_doc_id)) for r in rows}
    assert found == {frozenset((i, i + pairs)) for i in range(pairs)}


def one_word_off(words, kind):
    """A word more or less in the middle."""
    at = len(words) // 2
    return [*words[:at], "inserted", *words[at:]] if kind == "insert" else [*words[:at], *words[at + 1:]]


@pytest.mark.parametrize("kind", ["insert", "delete"])
@pytest.mark.parametrize("n", [52, 60, 70])
def test_both_sides_of_an_inserted_or_deleted_word(n, kind):
    """Places on one side of the word are enough, whichever it is; a common run elsewhere does not cut the passage."""
    passage = prose("en", n, n).split()
    near = one_word_off(passage, kind)
    stray = passage[-8:]
    codes = [shingle_codes([w.encode() for w in x]) for x in (
        [*prose("fr", 30, 1).split(), *passage, *prose("fr", 30, 2).split()],
        [*prose("de", 20, 3).split(), *near, *prose("de", 6, 4).split(), *stray, *prose("de", 20, 5).split()])]
    for place in ((30 + 3, 20 + 3), (30 + n - 8, 20 + len(near) - 8)):
        found = similar_passages(*codes, [place])
        assert len(found) == 1 and found[0][0] <= 30 + 1 and found[0][1] >= 30 + n - 5 and found[0][4] >= 0.8


def test_passages_with_inserted_and_deleted_words(spark):
    line = prose("en", 14, 78).split()
    texts, pairs = [], 200
    for i in range(pairs):
        passage = prose("fr", 52 + i % 18, 20_000 + i).split()
        for j, own in enumerate((passage, one_word_off(passage, ("insert", "delete")[i % 2]))):
            text = [*prose("de", 40, 30_000 + 2 * i + j).split(), *line, *prose("de", 9, 40_000 + 2 * i + j).split(), *own, *prose("de", 60, 50_000 + 2 * i + j).split()]
            texts.append((2 * i + j, " ".join(text)))
    rows = repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)).collect()
    assert all(r.similarity >= 0.8 for r in rows)
    found = {frozenset((r.doc_id, r.other_doc_id)) for r in rows}
    assert all(max(f) - min(f) == 1 and min(f) % 2 == 0 for f in found) and len(found) >= 0.99 * pairs


@pytest.mark.parametrize("n", [200, 500, 1000])
@pytest.mark.parametrize("blank", ["one word", "distinct words"])
def test_items_with_a_replaced_block(n, blank):
    """A block of an item is blanked out; by its shingles the copy is still alike."""
    rng = random.Random(n)
    items = {i: [f"w{rng.getrandbits(40)}" for _ in range(n)] for i in range(12)}
    index = ItemIndex([(i, " ".join(own)) for i, own in items.items()])
    for i, own in items.items():
        gone = int(n * (0.07 + 0.0015 * i))
        at = rng.randrange(5, n - gone - 5)
        copy = [*own[:at], *(["____"] * gone if blank == "one word" else [f"x{k}" for k in range(gone)]), *own[at + gone:]]
        text = " ".join([*prose("en", 40, i).split(), *copy, *prose("en", 40, 100 + i).split()])
        want = brute_force(text, {i: own})
        assert {m[0]: m[3] for m in index.matches(text)} == pytest.approx(want) and want


def test_members_alike_to_each_other_but_not_to_the_first(spark):
    """All have one long line, the first document beside it nothing; two each also have the rest of a passage, with one word changed."""
    line, pairs, texts = prose("en", 44, 61).split(), 60, []
    for i in range(2 * pairs):
        p = i % pairs
        before, after = prose("fr", 5, 61_000 + p).split(), prose("fr", 6, 62_000 + p).split()
        if i >= pairs:
            after[0] = "changed"
        texts.append((i + 1, " ".join([*prose("de", 40, 63_000 + i).split(), *before, *line, *after, *prose("de", 40, 64_000 + i).split()])))
    texts.append((0, " ".join([*prose("de", 40, 65_000).split(), *line, *prose("de", 40, 65_001).split()])))
    rows = repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(2)).collect()
    words = {i: t.split() for i, t in texts}
    for r in rows:
        a, b = words[r.doc_id][r.start_word:r.end_word], words[r.other_doc_id][r.other_start:r.other_end]
        assert weighted_similarity(grams(a), grams(b)) == pytest.approx(r.similarity) and r.similarity >= 0.8
    assert {frozenset((r.doc_id, r.other_doc_id)) for r in rows} == {frozenset((p + 1, p + 1 + pairs)) for p in range(pairs)}


def test_chain_of_alike_members():
    """The second is alike to the first and to the third, which is not alike to the first; members of one block wait for their own group."""
    words = [f"w{i}" for i in range(56)]
    texts = [[*words[:15], "z", *words[16:]], words, [*words[:40], "y", *words[41:]]]
    whole = [shingle_codes([w.encode() for w in x]) for x in texts]
    assert not similar_passages(whole[0], whole[2], [(30, 30)]) and similar_passages(whole[0], whole[1], [(30, 30)])
    held = [(doc, 7, 30, x.view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()) for doc, x in enumerate(whole)]
    found = alike_members([(0, *x) for x in held])
    assert {(f[0], f[3]) for f in found} == {(1, 0), (2, 1)} and all(f[6] >= 0.8 and f[1] >= 7 and f[2] - f[1] >= 50 for f in found)
    found = alike_members([(b, *x) for b, x in zip((0, 1, 1), held, strict=True)])
    assert {(f[0], f[3]) for f in found} == {(1, 0)}


def test_blocks_of_large_groups_and_copies(spark, monkeypatch):
    """Blocks of a few members give the links that one group gives, and every copy has one."""
    from stratascore.llm import substring_dedup

    docs, _ = make_documents(spark)
    want = components_of(repeated_passages(docs).collect())
    monkeypatch.setattr(substring_dedup, "BLOCK", 2)
    assert components_of(repeated_passages(docs).collect()) == want


def components_of(rows):
    parent = {i: i for r in rows for i in (r.doc_id, r.other_doc_id)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in rows:
        p, q = sorted((find(r.doc_id), find(r.other_doc_id)))
        parent[q] = p
    return {i: find(i) for i in parent}
