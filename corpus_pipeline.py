"""The corpus pipeline: language, quality, near-duplicates, benchmark passages, token ids.

run(spark, sf_dir) takes the documents table through STAGES; each stage works on all that the one
before kept, and its decisions take effect. Empty tables pass through with no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe, decontam, language, near_dup, quality_model
from tickloom.llm.common import table, work_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least posterior probability of the predicted language, and of the best grade.
LEAST_LANGUAGE_SCORE, LEAST_BEST_GRADE = 0.5, 0.5
#: Bytes of a batch that goes to Python: a worker holds a few times as much beside its model, and the executor outside its heap.
BATCH_BYTES = 1 << 21
BPE_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _batches(spark: SparkSession, size: int | None = BATCH_BYTES) -> None:
    """Limits the batches of this stage, which runs when its result is written; None: Spark's own limit."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if size is None:
        spark.conf.unset(name)
    else:
        spark.conf.set(name, str(size))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learned from them: those without letters or without a clear language go."""
    _batches(spark)
    model = language.fit(docs)
    if model is None:  # Nothing was learned, so only a text without letters can be rejected.
        return language.lettered(docs).select(*COLUMNS)
    found = language.predict(docs, model)
    return found.where((found.lang_pred != "und") & (found.score >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely of the best grade: toxic and poor ones go."""
    _batches(spark)
    labels = table(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels.select("doc_id", quality_model.grade_of(F.col("quality"), F.col("toxic")).alias("grade")))
    return quality_model.predict(docs, model, LEAST_BEST_GRADE).where("selected").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class."""
    _batches(spark)
    return near_dup.deduplicate(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold benchmark passages as a twentieth of their words or more."""
    _batches(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document left."""
    _batches(spark, None)  # Its blocks are cut from whole batches; smaller ones would be more.
    return bpe.round_trip(docs, BPE_PATH, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL can say only the fourth stage; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
