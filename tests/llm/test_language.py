import zlib

from tickloom.llm import language


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    found = {r.doc_id: r for r in language.identify(docs).collect()}
    rows = docs.collect()
    assert len(found) == len(rows) == docs.count()
    assert all(found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [found[r.doc_id].lang_pred == r.lang for r in rows if found[r.doc_id].held_out]
    assert len(out) > 100 and sum(out) / len(out) > 0.99
    assert all(0 <= r.score <= 1 for r in found.values())


def test_only_text_matters(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    from pyspark.sql import functions as F

    model = language.fit(docs)
    a = language.predict(docs, model).select("doc_id", "lang_pred", "score")
    b = language.predict(docs.withColumn("lang", F.lit("zz")), model).select("doc_id", "lang_pred", "score")
    assert sorted(a.collect()) == sorted(b.collect())


def test_odd_documents(odd_docs, no_docs):
    rows = language.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and [by[i].score for i in (2, 3, 4)] == [0.0] * 3
    assert by[1].lang_pred != "und" and not any(r.held_out for r in rows if r.doc_id is None)
    assert language.identify(no_docs).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(docs).collect()] == [("und", 0.0)]


def test_long_texts_are_read_to_the_end():
    size = language.PIECE + 1000
    assert len(language.ngrams("ab" * size)) > 3 * size
