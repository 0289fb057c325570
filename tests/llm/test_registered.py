"""Registered queries against DuckDB, the pipeline's stages against brute force, and the guard of the entry module."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_near_dup import brute as brute_classes
from tickloom.llm.queries import ORACLE_SQL, QUERIES

ROOT = Path(__file__).parents[2]


def comparable(rows):
    return sorted(str(tuple(str(v) for v in row)) for row in rows)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    actual, expected = QUERIES[name](spark, sf_dir), db.sql(ORACLE_SQL[name])
    columns = sorted(actual.columns)
    assert columns == sorted(expected.columns)
    assert comparable(actual.select(*columns).collect()) == comparable(expected.select(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= {*contract.queries()}


def test_pipeline_stages(spark, sf_dir):
    """Each stage on its own input: what it drops is what it is for, and the rest stays whole."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    junk = spark.createDataFrame([(10**9, "1234 5678 !!", "en", "s", 1), (10**9 + 1, None, None, None, None)], docs.schema)
    known = corpus_pipeline.language_id(spark, docs.unionByName(junk), sf_dir)
    assert sorted(known.collect()) == sorted(docs.collect())

    more = sf_dir.replace("0.001", "0.01")
    rated = spark.read.parquet(f"{more}/labels.parquet")
    good = corpus_pipeline.quality(spark, spark.read.parquet(f"{more}/documents.parquet"), more).select("doc_id").join(rated, "doc_id")
    bad = F.expr("toxic = 1 OR quality = 0")
    assert good.where(~bad).count() >= 0.95 * rated.where(~bad).count() and good.where(bad).count() <= 0.2 * rated.where(bad).count()

    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    firsts = {eval(c)[1] for c in brute_classes(pairs)}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()} == firsts

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {h[0] for h in map(eval, brute_hits(pairs, items)) if not h[4]}
    left = corpus_pipeline.decontamination(spark, docs, sf_dir)
    assert {r.doc_id for r in left.collect()} == clean and left.columns == corpus_pipeline.COLUMNS


def test_stages_on_odd_and_empty_documents(spark, odd_docs, no_docs, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            path = spark.conf.get("spark.checkpoint.dir") + f"/odd-{name}-{docs is no_docs}"
            docs.write.mode("overwrite").parquet(path)
            out = stage(spark, spark.read.parquet(path), sf_dir)
            assert out.count() <= docs.count()
            assert name == "byte_bpe" or out.columns == corpus_pipeline.COLUMNS


def test_documents_without_any_language_are_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*corpus_pipeline.COLUMNS).withColumn("lang", F.lit(None).cast("string"))
    junk = spark.createDataFrame([(10**9, "1234 5678 !!", None, "s", 1), (10**9 + 1, None, None, None, None)], docs.schema)
    kept = corpus_pipeline.language_id(spark, docs.unionByName(junk), sf_dir)
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    wordless = junk.withColumn("lang", F.lit("en")).unionByName(docs)
    assert corpus_pipeline.language_id(spark, wordless, sf_dir).count() == docs.count()


def test_the_rest_works_without_the_package(tmp_path):
    shutil.copytree(ROOT / "tickloom", tmp_path / "tickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql() and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})


def test_nothing_else_imports_the_package():
    for path in (ROOT / "tickloom").rglob("*.py"):
        assert "llm" in path.parts or "tickloom.llm" not in path.read_text()


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from tickloom.llm import common

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn"}.get(key, default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)
