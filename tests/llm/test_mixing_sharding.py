import random

import duckdb
import pytest
from oracle_check import compare

from stratascore.llm.mixing import MIX_SQL, mix_positions, mixed_order, plan_mix, source_targets
from stratascore.llm.sharding import SHARD_SQL, shard


@pytest.fixture(scope="module")
def con():
    return duckdb.connect()


def load(con, docs):
    import pandas as pd

    rows = docs.select("doc_id", "text", "source").toPandas()
    rows["doc_id"] = pd.array(rows["doc_id"], "Int64")
    con.execute("drop table if exists documents")
    con.register("given", rows)
    con.execute("create table documents as select doc_id::bigint as doc_id, text::varchar as text, source::varchar as source from given")


@pytest.mark.parametrize("name", ["corpus", "edges", "no_docs"])
def test_mix_same_as_sql(request, spark, con, name):
    docs = request.getfixturevalue(name)
    load(con, docs)
    assert compare(spark, con, "", lambda *_: mix_positions(docs), MIX_SQL) is None


def shared_out(sizes, weights, times=3):
    """Share by weight, stop those above their limit, share the rest again."""
    total, stopped = float(sum(sizes)), set()
    while True:
        rest = total - sum(times * sizes[i] for i in stopped)
        weight = sum(w for i, w in enumerate(weights) if i not in stopped)
        now = [times * s if i in stopped else rest * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, t in enumerate(now) if t > times * sizes[i] * (1 + 1e-12)}
        if not over or weight == 0:
            return now
        stopped |= over


def test_targets_by_repeated_sharing(spark):
    rng = random.Random(3)
    for _ in range(6):
        sizes = [rng.choice([0, 1, 10, 100, 5000]) + rng.randint(0, 9) for _ in range(rng.randint(1, 9))]
        if not sum(sizes):
            continue
        df = spark.createDataFrame([(False, chr(97 + i), s) for i, s in enumerate(sizes)], "__none boolean, __name string, source_size bigint")
        got = [r.target for r in source_targets(df).orderBy("__name").collect()]
        assert got == pytest.approx(shared_out(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))]))


def test_mix_meets_targets_and_order(corpus):
    plan = plan_mix(corpus, extra=["source"]).toPandas()
    for _, own in plan.groupby("source"):
        assert abs(own.taken.sum() - own.target.iloc[0]) <= own["size"].max()
    assert (plan.taken <= 3 * plan["size"]).all() and (plan.copies == plan.moments.map(len)).all()
    assert plan.moments.map(lambda m: all(0 <= x <= 1 for x in m)).all()
    early = plan[plan.source == "a"].moments.explode().dropna().mean()  # the ramp of "a" falls, that of "c" rises
    late = plan[plan.source == "c"].moments.explode().dropna().mean()
    assert early < 0.5 < late
    again = plan_mix(corpus.repartition(2), extra=["source"]).toPandas()
    key = ["doc_id"]
    assert plan.drop(columns="moments").sort_values(key).reset_index(drop=True).equals(again.drop(columns="moments").sort_values(key).reset_index(drop=True))


def test_positions_invert_the_demand(corpus):
    """At the position of a copy the integrated ramp of its source has asked for the words up to its middle."""
    plan = plan_mix(corpus, extra=["source"]).toPandas()
    slopes = {"a": -0.5, "b": 0.0, "c": 0.5}
    for name, own in plan.groupby("source"):
        copies = own.explode("moments").dropna(subset="moments")
        t, s = copies.moments.astype(float).to_numpy(), slopes.get(name)
        if s is None:
            continue
        order = t.argsort(kind="stable")
        size, t = copies["size"].to_numpy()[order], t[order]
        asked = ((1 - s) * t + s * t * t) * own.target.iloc[0]
        assert abs(asked - (size.cumsum() - size / 2)).max() < 1e-6 * own.target.iloc[0]
    sent = mix_positions(corpus).toPandas().first_position
    assert sent.dropna().is_monotonic_increasing and not sent.isna()[: sent.notna().sum()].any()
    runs = [mix_positions(corpus, buckets=n).toPandas().sort_values(["doc_id", "size"], ignore_index=True) for n in (1, 1 << 16)]
    assert runs[0].equals(runs[1])


def test_order_of_the_run(corpus):
    """Every copy stands where its position puts it."""
    rows = plan_mix(corpus).collect()
    want = [k for _, k in sorted((m, r.doc_id) for r in rows for m in r.moments)]
    assert [r.doc_id for r in mixed_order(corpus).collect()] == want


def test_mixed_rows(corpus, edges, no_docs):
    mixed = mixed_order(corpus)
    assert mixed.columns == corpus.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    want = {r.doc_id: r.copies for r in plan_mix(corpus).collect() if r.copies}
    assert counts == want
    assert mixed_order(edges).columns == edges.columns and mixed_order(no_docs).count() == 0


@pytest.mark.parametrize("limit", [300, 5_000, 1 << 24])
def test_shards_same_as_sql(spark, con, corpus, limit):
    from pyspark.sql import functions as F

    load(con, corpus)
    got = lambda *_: shard(corpus, limit).select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "shard", "shard_bytes")
    assert compare(spark, con, "", got, SHARD_SQL.format(limit=limit)) is None


def test_shards_fit(spark, edges, no_docs):
    rows = [(7, "x" * 40) for _ in range(50)] + [(8, "y" * 90), (8, "z" * 70), (None, None), (9, "w" * 500)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id bigint, text string, shard string").repartition(4)
    out = shard(docs, 100).toPandas()
    assert len(out) == len(rows) and list(out.columns) == ["doc_id", "text", "shard", "shard_bytes"]
    size = out.assign(n=out.text.map(lambda t: len(t or ""))).groupby("shard").agg(n=("n", "sum"), rows=("n", "size"), said=("shard_bytes", "max"))
    assert ((size.n <= 100) | (size.rows == 1)).all() and (size.n == size.said).all()
    whole = shard(edges)
    assert [c for c in whole.columns if c not in ("shard", "shard_bytes")] == [c for c in edges.columns if c != "shard"]
    assert whole.select("shard").distinct().collect()[0].shard == "*" and whole.count() == edges.count()
    assert shard(no_docs).count() == 0
