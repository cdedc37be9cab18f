import random

import pytest

COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, fingerprint string, root bigint, mark string, "
           "size string, target string, copies string, shard string, bytes int, score string, found string, key string, other string")
EXTRA = ("f", 1, "m", "s", "t", "c", "sh", 2, "sc", "fo", "k", "o")
PIECES = {
    "en": "the of and to in er th re tion ing ou ble ly st".split(),
    "fr": "le la de des eau eux ment que oi ch pa tre".split(),
    "de": "der die und sch ein heit keit ung ver pf lich zu".split(),
}


def words(lang, n, rng):
    return ["".join(rng.choice(PIECES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def prose(lang, n, seed):
    return " ".join(words(lang, n, random.Random(seed)))


def rows_of_edges():
    base = prose("en", 120, 1).split()
    near = [*base[:60], "changed", *base[61:]]
    long_text = prose("fr", 20_000, 2)
    rows = [
        (10, " ".join(base), "en", "b"), (11, " ".join(base).upper(), "en", "b"), (12, " ".join(near), "en", "a"),
        (13, None, "en", "a"), (14, "", "de", "a"), (15, " \n\t ", None, None), (16, long_text, "fr", "c"),
        (17, prose("de", 80, 3), None, None), (18, prose("de", 90, 4), "de", "a"), (18, prose("de", 90, 4), "de", "a"),
        (None, prose("fr", 70, 5), "fr", "c"), (19, "1234 --- !!!", "en", "b"), (20, "Word", "en", "b"),
        (21, "a " * 700, "en", "b"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty, blank and very long texts, ties, copies, repeated rows, clashing names."""
    return spark.createDataFrame(rows_of_edges(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def corpus(spark):
    """300 documents in three languages, three sources, one of them with over a third of the rows."""
    rng = random.Random(9)
    rows = []
    for i in range(300):
        lang = rng.choice(["en", "en", "fr", "de"])
        text = " ".join(words(lang, rng.randint(5, 150), rng))
        rows.append((i, text, lang, rng.choice(["a", "a", "b", "c"]), len(text), *EXTRA))
    for i in range(300, 340):
        rows.append((i, rows[i % 7][1], rows[i % 7][2], "c", 0, *EXTRA))
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


@pytest.fixture(scope="session")
def benchmark_items(spark):
    rows = [(1, prose("en", 40, 101)), (2, prose("de", 25, 102)), (3, None), (4, ""), (5, prose("en", 40, 101).upper()),
            (6, "three word item"), (7, prose("fr", 60, 103))]
    return spark.createDataFrame(rows, "item_id bigint, text string")
