"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes one word border, and each run of two and
three characters is hashed to a bucket. Training counts buckets per language in Spark; the
log-probability matrix (languages x buckets, its size checked) goes to the tasks, which add up
its rows for all n-grams of a batch in numpy.

Defined results: `und` with score 0 if the text is null or has no letters, or if nothing was
learned; equal scores go to the language first in order; rows with a null lang teach nothing;
repeated rows count as often as they occur; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import map_arrow, slices, texts, with_columns

BUCKETS = 1 << 15
#: Training documents per language, about: those whose hashed id falls below a share are taken.
SAMPLE_PER_LANG = 4000
#: Languages at most; a corpus with more stops the job, it doesn't lose any.
MOST_LANGUAGES = 1000
ALPHA = 0.5
#: Characters worked on at a time.
PIECE = 1 << 18


class Model(NamedTuple):
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray  # buckets x languages


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngrams(text: str) -> np.ndarray:
    """Buckets of the 2- and 3-grams of a text; empty if it has no letters."""
    found = []
    for start in range(0, max(len(text), 1), PIECE):
        points = np.frombuffer(text[start : start + PIECE].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letters()[points]
        points = np.where(is_letter, points, 32)
        # One border in place of a run of other characters, and one at either end.
        points = np.concatenate(([32], points[is_letter | np.concatenate(([False], is_letter[:-1]))], [32])).astype(np.uint64)
        if not is_letter.any():
            continue
        if points[-2] == 32:
            points = points[:-1]
        two = points[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        three = two[:-1] * np.uint64(0x165667B19E3779F9) + points[2:] * np.uint64(0xD6E8FEB86659FD93)
        grams = np.concatenate((two, three))
        found.append((((grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int64) % BUCKETS)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for batch in slices(batches, 1):
        for lang, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)).to_pylist()):
            grams = ngrams(text)
            if len(grams):
                counts[lang] = counts.get(lang, 0) + np.bincount(grams, minlength=BUCKETS)
                documents[lang] = documents.get(lang, 0) + 1
    for lang, n in counts.items():
        at = np.flatnonzero(n)
        columns = [pa.array([lang] * (len(at) + 1), pa.string()), pa.array([-1, *at.tolist()], pa.int32()), pa.array([documents[lang], *n[at].tolist()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])


def fit(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> Model | None:
    """A model of the labelled rows of docs (doc_id, text, lang); None if they teach nothing.

    Counts of (language, bucket) come to the driver: MOST_LANGUAGES x BUCKETS at most.
    """
    labelled = docs.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text", "doc_id")
    per_lang = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(per_lang) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not per_lang:
        return None
    shares = F.create_map(*[F.lit(x) for lang, n in per_lang.items() for x in (lang, min(1.0, sample_per_lang / n))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = labelled.where(place < shares[F.col("lang")]).select("lang", "text")
    summed = map_arrow(sample, _count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = summed.toPandas()
    if rows.empty:
        return None
    languages = sorted(rows["lang"].unique())
    counts, documents = np.zeros((BUCKETS, len(languages))), np.zeros(len(languages))
    column = rows["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy()
    at, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    documents[column[at < 0]] = n[at < 0]
    counts[at[at >= 0], column[at >= 0]] = n[at >= 0]
    weights = np.log((counts + ALPHA) / (counts.sum(axis=0) + ALPHA * BUCKETS))
    return Model(languages, np.log(documents / documents.sum()), weights.astype(np.float32))


def score(model: Model, text: str) -> tuple[str, float]:
    """The likeliest language and its posterior probability."""
    grams = ngrams(text)
    if not len(grams):
        return "und", 0.0
    total = model.prior.copy()
    for start in range(0, len(grams), PIECE):
        buckets, n = np.unique(grams[start : start + PIECE], return_counts=True)
        total += n @ model.weights[buckets].astype(np.float64)
    best = int(np.argmax(total))
    return model.languages[best], float(1 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model: Model | None, drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of docs with lang_pred and score; docs needs a column text, and loses columns of these names and those of drop."""
    gone = ("lang_pred", "score", *drop)
    if model is None:
        return docs.drop(*gone).withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(column: pa.Array) -> list[pa.Array]:
        found = [score(shared.value, t.as_py()) for t in column]
        return [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]

    return with_columns(docs, scored, "lang_pred string, score double", gone)


def lettered(docs: DataFrame) -> DataFrame:
    """The rows of docs whose text has letters."""
    return with_columns(docs, lambda column: [pa.array([len(ngrams(t.as_py())) > 0 for t in column], pa.bool_())], "__lettered boolean").where("__lettered").drop("__lettered")


def held_out(doc_id: Column) -> Column:
    """Whether a document stays out of training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs (doc_id, text, lang), learned from those not held out."""
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")))
    return predict(rows.select("doc_id", "held_out", "text"), model, ("text",))
