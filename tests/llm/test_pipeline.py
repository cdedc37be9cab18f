import corpus_pipeline
import pytest
from oracle_check import connect  # noqa: F401

import __spark_entry__ as entry
from stratascore.llm import decontamination, language_id, mixing, queries, sharding, simhash_dedup


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    for (name, stage), check in zip(corpus_pipeline.STAGES, [known, singles, clean, mixed, sharded], strict=True):
        out = stage(spark, docs, folder)
        assert (out.columns[: len(names)] if name == "sharding" else out.columns) == names
        check(spark, docs, out, folder)
        docs = spark.createDataFrame(out.toPandas(), out.schema) if out.count() else out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def known(spark, docs, out, folder):
    found = language_id.identify(docs).where(f"lang_pred <> 'und' AND score >= {language_id.MIN_SCORE}")
    assert ids(out) == ids(found) and len(ids(out)) > 0.95 * docs.count()


def singles(spark, docs, out, folder):
    groups = simhash_dedup.simhash_groups(docs).select("component_id").distinct()
    assert ids(out) == sorted(r.component_id for r in groups.collect()) and len(ids(out)) < docs.count()


def clean(spark, docs, out, folder):
    bad = {r.doc_id for r in decontamination.contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    assert ids(out) == sorted(set(ids(docs)) - bad)


def mixed(spark, docs, out, folder):
    want = {r.doc_id: r.copies for r in mixing.plan_mix(docs).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want


def sharded(spark, docs, out, folder):
    assert ids(out) == ids(docs)
    sizes = out.groupBy("shard").agg({"shard_bytes": "max"}).collect()
    assert all(r[1] <= sharding.LIMIT for r in sizes)


def test_run_is_the_stages(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "decontamination", "mixing", "sharding"]
    out = corpus_pipeline.run(spark, folder)
    assert {"shard", "shard_bytes", "doc_id", "text"} <= set(out.columns) and out.count() > 0


def test_stages_on_no_rows(spark, no_docs, folder):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, folder).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered(name):
    assert entry.queries()[name] is queries.QUERIES[name]


def test_entry_works_without_the_folders():
    import subprocess
    import sys
    from pathlib import Path

    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("stratascore.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name.partition(".queries")[0])
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
q = e.queries()
assert "pipeline" not in q and not any(n.startswith("op") and n[2].isdigit() for n in q) and len(q) > 100 and e.oracle_sql()
"""
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], check=True)
