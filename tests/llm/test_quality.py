import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import quality_model, quality_rules


def grades(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", quality_model.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))


def test_held_out_grades(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    docs, rated = spark.read.parquet(f"{folder}/documents.parquet"), grades(spark, folder)
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = quality_model.fit(docs, rated.where(~out))
    assert list(model.thresholds) == sorted(model.thresholds)
    rows = quality_model.predict(docs.join(rated.where(out), "doc_id"), model).select("grade", "expected_grade", "p_best", "selected").collect()
    share = lambda g: np.mean([r.selected for r in rows if r.grade == g])
    # Some 330 toxic documents teach few of their words; with 1,600 less than 2 % of the toxic ones are kept.
    assert share(2) > 0.97 and share(0) < 0.35 and share(1) < 0.15
    mean = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in range(3)]
    # Unseen toxic words leave a toxic text its good grade, so the two lower grades needn't come in order here.
    assert max(mean[:2]) < mean[2]


def test_toxic_texts_without_frequent_insults_go(spark, sf_dir):
    """Beginnings of words tell toxic texts whose words are rare."""
    folder = sf_dir.replace("0.001", "0.1")
    docs, rated = spark.read.parquet(f"{folder}/documents.parquet"), grades(spark, folder)
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = quality_model.fit(docs, rated.where(~out))
    rows = quality_model.predict(docs.join(rated.where(out), "doc_id"), model).select("grade", "expected_grade", "selected").collect()
    share, mean = ([np.mean([r[c] for r in rows if r.grade == g]) for g in range(3)] for c in ("selected", "expected_grade"))
    assert share[0] < 0.15 and share[1] < 0.15 and share[2] > 0.97 and mean == sorted(mean)


def test_odd_documents_and_ratings(spark, odd_docs, no_docs):
    schema = "doc_id long, grade int"
    rated = spark.createDataFrame([(1, 2), (1, 0), (2, 1), (5, 2), (6, 2), (None, 1), (7, None)], schema)
    rows = quality_model.predict(odd_docs, quality_model.fit(odd_docs, rated))
    assert rows.columns == odd_docs.drop("score").columns + [] or rows.count()
    got = rows.select("expected_grade", "p_best", "selected").collect()
    assert len(got) == odd_docs.count() and all(0 <= r.p_best <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    none = quality_model.fit(odd_docs, spark.createDataFrame([(1, 2)], schema))
    assert none is None and all(r.selected and r.p_best is None for r in quality_model.predict(odd_docs, none).collect())
    assert quality_model.predict(no_docs, quality_model.fit(odd_docs, rated)).count() == 0


def test_a_grade_without_documents_leaves_the_others(spark):
    docs = spark.createDataFrame([(i, ("stupid trash here " if i % 2 else "fine words here ") + f"and {i}") for i in range(40)], "doc_id long, text string")
    rated = spark.createDataFrame([(i, 0 if i % 2 else 2) for i in range(40)] + [(1000, 1)], "doc_id long, grade int")
    model = quality_model.fit(docs, rated)
    assert model.grades == [0, 2]
    assert {r.doc_id % 2 for r in quality_model.predict(docs, model).where("selected").collect()} == {0}


def test_a_fit_takes_little_memory_beside_its_features():
    rng = np.random.default_rng(1)
    n, each = 2000, 1000
    offsets, buckets = np.arange(0, n * each + 1, each), rng.integers(0, quality_model.WEIGHTS, n * each).astype(np.int32) % 50_000
    values, grade = rng.random(n * each).astype(np.float32), rng.integers(0, 3, n)
    tracemalloc.start()
    weights, _ = quality_model.fit_ordinal(offsets, buckets, values, grade, np.ones(n), 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * n * each and len(weights) == quality_model.WEIGHTS and not weights[50_000:].any()


def test_features_are_the_same_after_their_way_to_the_driver():
    texts = pa.array(["a fine fine text, and more of it", "", "a fine text", "A4 a fine!! text and more"])
    rows = pa.Table.from_batches(quality_model._feature_rows(iter([pa.RecordBatch.from_arrays([pa.array([0, 1, 2, 2]), texts], ["grade", "text"])])))
    offsets, buckets, values = quality_model.features(texts)
    often = np.isin(buckets, np.flatnonzero(np.bincount(buckets) >= 3))
    got = quality_model._frequent(rows)
    assert np.array_equal(got[0], [often[:i].sum() for i in offsets]) and np.array_equal(got[1], buckets[often]) and np.array_equal(got[2], values[often])
    assert sum(len(x) for x in rows.column("values").to_pylist()) < len(values) / 2


def test_gradient_finds_ordered_grades():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 400)
    offsets, buckets = np.arange(401), grade.astype(np.int64)
    weights, thresholds = quality_model.fit_ordinal(offsets, buckets, np.ones(400, dtype=np.float32), grade, np.ones(400), 4)
    assert list(weights[:4]) == sorted(weights[:4]) and list(thresholds) == sorted(thresholds)


LINES = [
    ("This is a sentence.", False),
    ("This one has no end", True),
    ("Home | About | News | Contact.", True),
    ("We use cookies here.", True),
    ("SHOUT!! IT!! OUT!! NOW!!", True),
    ("word### other*** more%%% text.", True),
    ("A line with a cookie " + "and much more to say " * 12 + "in the end.", False),
    ("»Quoted speech.«", True),
    ("Er sagte: »Ja.»", False),
]


@pytest.mark.parametrize("line, fails", LINES)
def test_line_rules(spark, line, fails):
    rows = spark.createDataFrame([(line,)], "line string").select(quality_rules.line_fails(F.col("line")).alias("f"))
    assert rows.first().f == fails


def test_rules_on_odd_documents(odd_docs, no_docs):
    rows = quality_rules.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(by[i].base_failed and not by[i].kept and by[i].n_words == 0 for i in (2, 3))
    assert by[4].n_words == 1 and by[4].n_failed_lines == 1
    assert by[5].n_words == 60_000 and not by[5].base_failed
    assert quality_rules.judge(no_docs).count() == 0


def test_documents_that_lose_too_much_go(spark):
    good = "Here is a line of plain prose that stays, as it ends like a sentence does in a book.\n"
    bad = "Menu | Start | News | Sport | Weather | Contact | About us and this long line of links\n"
    docs = [(1, "".join(" ".join(f"{w}{i}" for w in good.split()) + ".\n" for i in range(6)) + bad), (2, good + bad * 6 + "x y z. " * 5), (3, "same words again. " * 40)]
    rows = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[1].kept and "Menu" not in rows[1].clean_text and rows[1].n_failed_lines == 1
    assert not rows[2].kept and rows[2].n_dup_lines == 5
    assert rows[3].base_failed and rows[3].n_repeat_words == 120


def test_rules_have_no_python(spark, sf_dir):
    plan = quality_rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_crc_is_the_same_everywhere(spark):
    assert spark.range(1).select(F.crc32(F.lit("17").cast("binary")).alias("c")).first().c == zlib.crc32(b"17")
