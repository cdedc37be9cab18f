from collections import Counter
from itertools import combinations

import pytest

from stratascore.llm import url_rules
from stratascore.llm.language_id import MIN_SHARE, ORDERS, PROBES, _pieces, fit_filter, held_out, identify, keep_known
from stratascore.llm.url_rules import judge, mine_rules


def test_held_out_accuracy(corpus):
    found = identify(corpus).join(corpus.select("doc_id", "lang"), "doc_id").toPandas()
    out = found[found.held_out]
    assert len(out) > 40 and (out.lang_pred == out.lang).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_filter_finds_what_it_learned(corpus):
    """A Bloom filter has no false negatives, and its correction takes the expected share out."""
    model = fit_filter(corpus)
    assert model.names == ["de", "en", "fr"]
    texts = [(r.text, r.lang) for r in corpus.select("text", "lang").limit(30).collect()]
    for text, lang in texts:
        counts, n = model.counts(text)
        assert counts[model.names.index(lang)] > 0.6 * n and n > 0
    small = fit_filter(corpus, slot_bits=12)
    fill = small.false_rate ** (1 / PROBES)
    assert (fill > 0.05).all() and small.predict(texts[0][0])[0] == texts[0][1]


def test_language_edges(spark, edges, no_docs):
    found = {r.doc_id: r for r in identify(edges).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (13, 14, 15, 19))
    assert identify(edges).count() == edges.count()
    assert identify(no_docs).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert identify(unlabelled).first().lang_pred == "und"
    kept = keep_known(edges)
    assert kept.columns == edges.columns and not {13, 14, 15, 19} & {r.doc_id for r in kept.select("doc_id").collect()}


def test_numerals_are_no_letters(spark, corpus):
    texts = ["½²①", "Ⅷ ½", "12 _ ٣"]
    docs = spark.createDataFrame([(100_000 + i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    found = identify(corpus.select("doc_id", "text", "lang").union(docs)).where("doc_id >= 100000").collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 3
    assert list(_pieces("Ab½c 一二")) == [" ab c 一二 "]


def test_filter_by_sets_of_grams(spark, corpus):
    """Sets of n-grams per language, counted one by one, against the filter: nothing learned is missed, the rest is its false share."""
    grams = {}
    rows = corpus.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL").collect()
    sizes = Counter(r.lang for r in rows)
    for r in rows:
        own = {p[i : i + n] for p in _pieces(r.text) for n in ORDERS for i in range(len(p) - n + 1)}
        grams.setdefault(r.lang, Counter()).update(own)
    known = {x: {g for g, n in c.items() if n >= MIN_SHARE * sizes[x]} for x, c in grams.items()}
    model = fit_filter(corpus, slot_bits=14)
    extra = {x: [] for x in known}
    for r in rows[:40]:
        counts, n = model.counts(r.text)
        here = [p[i : i + k] for p in _pieces(r.text) for k in ORDERS for i in range(len(p) - k + 1)]
        assert n == len(here)
        for i, x in enumerate(model.names):
            true = sum(g in known[x] for g in here)
            assert counts[i] >= true
            extra[x].append((counts[i] - true, n - true))
    for i, x in enumerate(model.names):
        wrong, asked = map(sum, zip(*extra[x]))
        assert abs(wrong / max(asked, 1) - model.false_rate[i]) < 0.05


def test_labels_of_held_out_rows_teach_nothing(corpus):
    from pyspark.sql import functions as F

    changed = corpus.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify(corpus).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in identify(changed).collect()}


URLS = [
    (1, "https://Www.Example.ORG/es/7?x=1#top", "www.example.org", "/es/7", "example.org/es/", "block"),
    (2, "http://example.org/en/15", "example.org", "/en/15", "example.org/en/1", "block"),
    (3, "http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (4, "http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
    (5, "https://a.com/fr/1", "a.com", "/fr/1", "com/fr/", "allow"), (6, "https://a.com/de/", "a.com", "/de/", "com/de/", "block"),
    (7, "https://telecom/de/", "telecom", "/de/", None, None), (8, "no scheme", "", "", None, "allow"), (9, None, "", "", None, "allow"),
    (10, "x://org", "org", "", None, None), (11, "a://b://c/d", "b:", "//c/d", None, None), (12, "http://h?q=/org/", "h", "", None, None),
    (13, "http://org/", "org", "/", "org/", "allow"), (13, "http://org/", "org", "/", "org/", "allow"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", 1.0) for i, u, *_ in URLS], "page_id bigint, url string, host string, confidence double")
    rows = judge(pages).collect()
    assert len(rows) == len(URLS)
    for i, _, host, path, rule, verdict in URLS:
        r = next(x for x in rows if x.page_id == i)
        assert (r.host, r.path, r.rule) == (host, path, rule), i
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in judge(pages.where("page_id in (8, 9, 12)")).collect()} == {"allow"}


def test_mined_rules_by_brute_force(spark, folder):
    """Every token set of the labelled pages, counted one by one, gives the same rules and verdicts."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    host, path = url_rules.host_and_path(pages.url)
    rows = pages.select("page_id", url_rules.url_tokens(pages.url, host, path).alias("tokens"), url_rules.given_rule(host, path).verdict.alias("verdict")).collect()
    labelled = [(set(r.tokens), r.verdict) for r in rows if r.verdict]
    floor = 0.05
    at = {}
    for i, (tokens, _) in enumerate(labelled):
        for t in tokens:
            at.setdefault(t, set()).add(i)
    names = {t: min(u for u in at if at[u] == at[t]) for t in at if len(at[t]) >= floor * len(labelled) - 1e-9}
    named = lambda tokens: {names[t] for t in tokens if t in names}
    whole = spark.createDataFrame([(sorted(t), v) for t, v in labelled], "tokens array<string>, verdict string")
    assert url_rules.stand_ins(whole, floor) == names
    labelled = [(named(t), v) for t, v in labelled]
    want = {}
    for tokens, verdict in labelled:
        for k in range(1, len(tokens) + 1):
            for needs in combinations(sorted(tokens), k):
                total, by = want.get(needs, (0, Counter()))
                want[needs] = (total + 1, by + Counter([verdict]))
    rules = {(n, v): c[v] / total for n, (total, c) in want.items() for v in c
             if c[v] >= floor * len(labelled) - 1e-9 and c[v] / total >= 0.8}
    pruned = {(n, v): p for (n, v), p in rules.items()
              if not any(set(m) < set(n) and w == v and q >= p for (m, w), q in rules.items())}
    df = spark.createDataFrame([(sorted(t), v) for t, v in labelled], "tokens array<string>, verdict string")
    got = {(tuple(r.needs), r.says): r.confidence for r in mine_rules(df, floor).collect()}
    assert got == pytest.approx(pruned)
    judged = {r.page_id: r for r in judge(pages, min_support=floor).collect()}
    for r in rows:
        if not r.verdict:
            best = max(((p, want[n][1][v], len(n), v) for (n, v), p in pruned.items() if set(n) <= named(r.tokens)), default=(None, 0, 0, "allow"))
            assert (judged[r.page_id].verdict, judged[r.page_id].confidence) == (best[3], best[0])


def test_parts_deep_in_the_path_are_mined(spark):
    """A folder that is not the first one, a query value and a long ending, each with one verdict."""
    kinds = [("https://{}.com/de/x/casino/{}", "block"), ("https://{}.com/fr/x/library/{}", "allow"), ("https://{}.com/de/{}.download", "block"),
             ("https://{}.com/fr/{}?kind=essay", "allow")]
    rows = [(i, kinds[i % 4][0].format(f"h{i}", i)) for i in range(400)]
    asked = {1000: ("http://x.net/x/casino/1", "block"), 1001: ("http://x.net/x/library/2", "allow"), 1002: ("http://y.net/7.download", "block"),
             1003: ("http://z.net/7?kind=essay", "allow")}
    pages = spark.createDataFrame(rows + [(i, u) for i, (u, _) in asked.items()], "page_id bigint, url string")
    got = {r.page_id: r for r in judge(pages).where("page_id >= 1000").collect()}
    assert {i: r.verdict for i, r in got.items()} == {i: v for i, (_, v) in asked.items()}
    assert all(r.rule is None and r.confidence == 1.0 for r in got.values())
