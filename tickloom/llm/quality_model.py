"""Graded quality by ordinal cumulative-link regression on hashed text.

A text's features are its words and their beginnings of HEADS bytes (present or not), the shares of its token shapes, hashed to
buckets, and the share of words that repeat the word before. One weight per bucket, shared by all grades, gives a score s; ordered thresholds t give
P(grade <= j) = 1 / (1 + exp(s - t_j)). The expected grade and the probability of the best
grades (the tail) follow. The model is fitted to a bounded sample of rated documents, drawn by hashed id
and weighted back to the whole; all documents are scored, each in full, with the weights sent
to the tasks (their number is fixed). The threshold of the best grade then rises as far as a part of the
sample, held out from a fit of its own, keeps KEPT of its best grade: so the cut against the lower
grades doesn't hang on how rare they are.

Defined results: rows of ratings with a null doc_id or without a grade teach nothing; of several
ratings of a document the lowest counts; with fewer than two grades the model is None, and
every document gets a null grade and is selected; a null or empty text is scored by its absence of
features; repeated rows give repeated results; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import map_arrow, release, slices, texts, with_columns
from tickloom.llm.words import span_hashes, word_hashes

BUCKETS, SHAPES = 1 << 18, 1 << 10
#: Lengths in bytes of the word beginnings that are features; words of at most that length have none.
HEADS = (4, 7)
#: A bucket for each word, shape and word beginning, and one for words that repeat the word before.
WEIGHTS = BUCKETS + SHAPES + 1 + BUCKETS
#: The value of a shape that all tokens have; a word's value is 1.
SHAPE_SCALE = 25
#: Share of the sampled documents, and number of them, that must have a feature for it to get a weight.
LEAST_SHARE, LEAST_DOCUMENTS = 0.003, 3
#: Rated documents to learn from, about, dealt evenly over the grades.
SAMPLE = 9_000
#: Rounds of fitting, step, and penalty on squared weights.
ROUNDS, STEP, PENALTY = 150, 0.05, 2e-4
#: Features that the driver works on at a time.
BLOCK = 1 << 18
#: Characters' kinds in a token's shape: blanks end it; digits, capitals and other letters stand for themselves.
KIND = np.arange(256, dtype=np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[48:58], KIND[65:91], KIND[97:123], KIND[128:] = 48, 65, 97, 97


#: Share of the best grade's documents that the cut for it keeps at least; one sampled document in HELD_OUT chooses it, if LEAST_HELD of them are of that grade.
KEPT, HELD_OUT, LEAST_HELD = 0.99, 5, 100


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]


def features(column: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, buckets, values) of the features of each text."""
    bounds, hashes, heads = word_hashes(column, HEADS)
    offsets, buckets, values = [0], [], []
    for i, text in enumerate(column):
        words = np.unique(hashes[bounds[i] : bounds[i + 1]] >> np.uint64(46)).astype(np.int64)
        begun = np.unique(np.concatenate([h[at[bounds[i]] : at[bounds[i + 1]]] for h, at in heads]) >> np.uint64(46)).astype(np.int64)
        kinds = KIND[np.frombuffer(text.as_buffer() or b"", dtype=np.uint8)]
        kinds = kinds[np.concatenate(([True], kinds[1:] != kinds[:-1]))] if len(kinds) else kinds
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (kinds != 0).view(np.int8), [0]))))
        shapes, n = np.unique(span_hashes(kinds, edges[::2], edges[1::2]) >> np.uint64(54), return_counts=True)
        own = hashes[bounds[i] : bounds[i + 1]]
        again = np.float32(SHAPE_SCALE * (own[1:] == own[:-1]).mean() if len(own) > 1 else 0)
        buckets += [words, shapes.astype(np.int64) + BUCKETS, [BUCKETS + SHAPES], begun + (BUCKETS + SHAPES + 1)]
        values += [np.ones(len(words), dtype=np.float32), (SHAPE_SCALE * n / max(1, n.sum())).astype(np.float32), [again], np.ones(len(begun), dtype=np.float32)]
        offsets.append(offsets[-1] + len(words) + len(shapes) + 1 + len(begun))
    joined = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, dtype=t)
    return np.array(offsets), joined(buckets, np.int64), joined(values, np.float32)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _valued(buckets: np.ndarray) -> np.ndarray:
    """Whether a bucket's features have values of their own; the others' are 1."""
    return (buckets >= BUCKETS) & (buckets <= BUCKETS + SHAPES)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grade, buckets, and the values that aren't 1 throughout, in order: half of what goes to the driver otherwise."""
    for batch in slices(batches, 1):
        offsets, buckets, values = features(texts(batch.column(1)))
        own = _valued(buckets)
        held = np.concatenate(([0], np.cumsum(own)))[offsets]
        lists = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x)) for at, x in ((offsets, buckets.astype(np.int32)), (held, values[own]))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["grade", "buckets", "values"])


def _blocks(offsets: np.ndarray) -> list[tuple[int, int]]:
    """Rows [first, end) that have about BLOCK features together, one row at least."""
    ends = np.unique(np.concatenate(([0], np.searchsorted(offsets, np.arange(BLOCK, offsets[-1], BLOCK)), [len(offsets) - 1])))
    return list(zip(ends[:-1].tolist(), ends[1:].tolist()))


def _of_block(offsets: np.ndarray, first: int, end: int) -> tuple[slice, np.ndarray]:
    """The features of a block, and for each of them its row in the block."""
    return slice(offsets[first], offsets[end]), np.repeat(np.arange(end - first), np.diff(offsets[first : end + 1]))


def _scores(weights: np.ndarray, offsets: np.ndarray, buckets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sum of weights times values of each row."""
    out = np.zeros(len(offsets) - 1)
    for first, end in _blocks(offsets):
        part, row = _of_block(offsets, first, end)
        out[first:end] = np.bincount(row, weights=weights[buckets[part]] * values[part], minlength=end - first)
    return out


def fit_ordinal(offsets: np.ndarray, buckets: np.ndarray, values: np.ndarray, grade: np.ndarray, weight: np.ndarray, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the least penalised loss, by Adam over all rows. grade: 0 to n_grades - 1."""
    # A bucket that no row has keeps the weight 0, so only the others are fitted.
    used = np.zeros(WEIGHTS, dtype=bool)
    used[buckets] = True
    buckets = (np.cumsum(used) - 1).astype(np.int32)[buckets]
    w = np.zeros(np.count_nonzero(used))
    share = np.clip(np.cumsum(np.bincount(grade, weights=weight, minlength=n_grades))[:-1] / weight.sum(), 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(first), 1e-2))
    params = [w, np.concatenate((first[:1], gaps))]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for turn in range(1, ROUNDS + 1):
        t = np.cumsum(np.concatenate((params[1][:1], np.exp(params[1][1:]))))
        s = _scores(params[0], offsets, buckets, values)
        edges = np.concatenate(([-np.inf], t, [np.inf]))
        high, low = (1 / (1 + np.exp(np.clip(s - edges[grade + i], -40, 40))) for i in (1, 0))
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p * weight, low * (1 - low) / p * weight
        d_s = (d_high - d_low) / weight.sum()
        d_t = np.array([-(d_high[grade == j].sum() - d_low[grade == j + 1].sum()) / weight.sum() for j in range(n_grades - 1)])
        tail = np.cumsum(d_t[::-1])[::-1]
        d_w = np.zeros(len(w))
        for begin, end in _blocks(offsets):
            part, row = _of_block(offsets, begin, end)
            np.add.at(d_w, buckets[part].astype(np.int64), d_s[begin:end][row] * values[part])
        grads = [d_w + PENALTY * params[0], tail * np.concatenate(([1.0], np.exp(params[1][1:])))]
        for param, mean, square, grad in zip(params, means, squares, grads):
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            param -= STEP * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    weights = np.zeros(WEIGHTS, dtype=np.float32)
    weights[used] = params[0]
    return weights, np.cumsum(np.concatenate((params[1][:1], np.exp(params[1][1:]))))


def fit(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model of ratings (doc_id, grade) of docs (doc_id, text)."""
    rated = ratings.where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    # Ratings of other documents teach nothing, so a grade that only they have isn't one.
    rated = rated.join(docs.select("doc_id"), "doc_id", "left_semi")
    counts = {r["grade"]: r["n"] for r in rated.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    shares = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, min(1.0, sample / len(counts) / n))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = rated.where(place < shares[F.col("grade")])
    # The sample has about `sample` rows, whatever the table's size; so it is broadcast.
    own = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # A document's copies are held out together; -1 - grade stands for a grade that is.
    held = F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0
    own = own.select(F.when(held, -1 - F.col("grade")).otherwise(F.col("grade")).alias("grade"), "text")
    rows = map_arrow(own, _feature_rows, "grade int, buckets array<int>, values array<float>").toArrow()
    grades = sorted(counts)
    told = rows.column("grade").to_numpy()
    held = told < 0
    grade = np.searchsorted(grades, np.where(held, -1 - told, told))
    if len(np.unique(grade)) < len(grades):
        return None
    offsets, buckets, values = _frequent(rows)
    del rows
    weight = np.array([counts[g] for g in grades])[grade] / np.bincount(grade)[grade]
    weights, thresholds = fit_ordinal(offsets, buckets, values, grade, weight, len(grades))
    thresholds[-1] += _stricter(offsets, buckets, values, grade, weight, len(grades), held)
    del offsets, buckets, values
    release()
    return Model(weights, thresholds, grades)


def _frequent(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, buckets, values) of the features of _feature_rows that enough rows have."""
    lists = rows.column("buckets").combine_chunks()
    offsets = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
    buckets = lists.flatten().to_numpy()
    values = np.ones(len(buckets), dtype=np.float32)
    values[_valued(buckets)] = rows.column("values").combine_chunks().flatten().to_numpy()
    held = sum(np.bincount(buckets[i : i + BLOCK], minlength=WEIGHTS) for i in range(0, len(buckets), BLOCK))
    # Each text has a feature at least, that of repeated words.
    frequent = (held >= max(LEAST_DOCUMENTS, LEAST_SHARE * rows.num_rows))[buckets]
    upto = np.cumsum(frequent, dtype=np.int32)
    return np.where(offsets > 0, upto[offsets - 1], 0).astype(np.int64), buckets[frequent], values[frequent]


def _stricter(offsets: np.ndarray, buckets: np.ndarray, values: np.ndarray, grade: np.ndarray, weight: np.ndarray, n_grades: int, held: np.ndarray) -> float:
    """By how much the threshold of the best grade can rise so that of the rows held out from a fit of their own KEPT of that grade stay; 0 if too few are held out."""
    best = held & (grade == n_grades - 1)
    if best.sum() < LEAST_HELD or len(np.unique(grade[~held])) < n_grades:
        return 0.0
    sizes = np.diff(offsets)
    taken = np.repeat(~held, sizes)
    own = np.concatenate(([0], np.cumsum(sizes[~held])))
    weights, thresholds = fit_ordinal(own, buckets[taken], values[taken], grade[~held], weight[~held], n_grades)
    s = _scores(weights, offsets, buckets, values)[best]
    return max(0.0, float(np.quantile(s, 1 - KEPT)) - thresholds[-1])


def score(model: Model, column: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(expected grade, probability of the best grade) of each text."""
    offsets, buckets, values = features(column)
    s = _sums(model.weights[buckets] * values, offsets)
    above = 1 - 1 / (1 + np.exp(np.clip(s[:, None] - model.thresholds, -500, 500)))
    return model.grades[0] + above @ np.diff(model.grades), above[:, -1]


def predict(docs: DataFrame, model: Model | None, least: float = 0.5, drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of docs with expected_grade, p_best and selected (p_best of at least `least`), without columns of these names and of drop."""
    gone = ("expected_grade", "p_best", "selected", *drop)
    if model is None:
        return docs.drop(*gone).withColumns({"expected_grade": F.lit(None).cast("double"), "p_best": F.lit(None).cast("double"), "selected": F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(column: pa.Array) -> list[pa.Array]:
        grade, best = score(shared.value, column)
        return [pa.array(grade), pa.array(best), pa.array(best >= least)]

    return with_columns(docs, scored, "expected_grade double, p_best double, selected boolean", gone)


def grade_of(quality: Column, toxic: Column) -> Column:
    """0 for toxic, 1 for poor, 2 for good texts; null if that isn't told."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)
