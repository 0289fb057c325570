"""Benchmark decontamination by winnowing.

Of every `window - k + 1` consecutive k-grams of words the one with the least hash is kept (the
rightmost of equals). Two texts that share `window` words share all k-grams of that stretch, so
both keep the same one: its hash joins them, and the words around it, sent along, tell how far
the match extends. An item with fewer words than a window is one window, with one fingerprint.

Fingerprints of documents are thinned in the task that makes them by a bitmap of the benchmark's
fingerprints (its size is bounded; what it lets through wrongly goes at the join). The join is on
the fingerprint, with nothing gathered per key, so a passage that a third of the documents hold
is split by skew-join handling. Spans of one document meet at the end, at most one per word.

Defined results: a null or wordless text has n_words 0 and no hits; an item without words or with
a null id has no windows; repeated rows give repeated results; items with equal ids count once;
an empty benchmark hits nothing; an empty table gives no rows. Extra columns are ignored. Words are
compared by 64-bit hashes. Row numbers need an input whose partitions are read alike each time, a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bitmap, map_arrow, slices, texts
from tickloom.llm.words import mix, shingles, word_hashes

WINDOW, K = 13, 5
#: Bits of the benchmark's bitmap: 16 per fingerprint, within these bounds (16 MB at most).
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
#: Stand for the words before and after a text, each unlike any word of the other side.
NO_WORD, NO_ITEM_WORD = np.uint64(1), np.uint64(2)


def winnow(hashes: np.ndarray, k: int, width: int) -> np.ndarray:
    """First words of the k-grams kept: the least of each `width` in a row, the rightmost of equals."""
    grams = shingles(hashes, k)
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    least, at = grams[:n].copy(), np.zeros(n, dtype=np.int64)
    for i in range(1, width):
        lower = grams[i : i + n] <= least
        least[lower] = grams[i : i + n][lower]
        at[lower] = i
    return np.unique(at + np.arange(n))


def _around(hashes: np.ndarray, at: np.ndarray, window: int, k: int, blank: np.uint64) -> np.ndarray:
    """The words of all windows that hold the k-gram at `at`: window - k before it, itself, and as many behind."""
    reach = window - k
    padded = np.concatenate((np.full(reach, blank), hashes, np.full(window, blank)))
    return padded[at[:, None] + np.arange(2 * reach + k)]


def _whole(hashes: np.ndarray, at: np.ndarray, size: int, window: int, k: int, blank: np.uint64) -> np.ndarray:
    """The `size` words from `at` on, as wide as what _around gives."""
    out = np.full((len(at), 2 * (window - k) + k), blank)
    out[:, :size] = hashes[at[:, None] + np.arange(size)]
    return out


def _short_marks(hashes: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of whole short items, apart from those of k-grams and of other sizes."""
    return mix(shingles(hashes, size) ^ mix(np.array([size], dtype=np.uint64)))


def _item_rows(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        bounds, hashes = word_hashes(texts(batch.column(1)))
        for i, item in enumerate(batch.column(0)):
            own = hashes[bounds[i] : bounds[i + 1]]
            if len(own) == 0:
                continue
            if len(own) < window:
                marks, words, size = _short_marks(own, len(own)), _whole(own, np.array([0]), len(own), window, k, NO_ITEM_WORD), len(own)
            else:
                at = winnow(own, k, window - k + 1)
                marks, words, size = shingles(own, k)[at], _around(own, at, window, k, NO_ITEM_WORD), 0
            n = len(marks)
            columns = [pa.array([item.as_py()] * n, pa.string()), pa.array(marks.view(np.int64)), pa.array(np.full(n, size, dtype=np.int32)), pa.array([w.tobytes() for w in words], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "mark", "size", "item_words"])


def _doc_rows(batches: Iterator[pa.RecordBatch], bits: np.ndarray, sizes: list[int], window: int, k: int) -> Iterator[pa.RecordBatch]:
    mask = np.uint64(len(bits) * 8 - 1)

    def known(marks: np.ndarray) -> np.ndarray:
        place = marks & mask
        return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

    for batch in slices(batches, 1):
        bounds, hashes = word_hashes(texts(batch.column(1)))
        marks, ats, words, counts = [], [], [], []
        for i in range(batch.num_rows):
            own = hashes[bounds[i] : bounds[i + 1]]
            at = winnow(own, k, window - k + 1)
            found = shingles(own, k)[at] if len(at) else np.zeros(0, dtype=np.uint64)
            hit = known(found)
            parts = [(found[hit], at[hit], _around(own, at[hit], window, k, NO_WORD))] if hit.any() else []
            for size in sizes:
                if len(own) >= size:
                    found = _short_marks(own, size)
                    at = np.flatnonzero(known(found))
                    if len(at):
                        parts.append((found[at], at, _whole(own, at, size, window, k, NO_WORD)))
            counts.append(sum(len(p[0]) for p in parts))
            for m, a, w in parts:
                marks.append(m)
                ats.append(a)
                words += [x.tobytes() for x in w]
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
        joined = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, dtype=t)
        columns = [pa.array(joined(marks, np.uint64).view(np.int64)), pa.array(joined(ats, np.int32)), pa.array(words, pa.binary())]
        found = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, ["mark", "at", "words"]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds)), found], ["row", "n_words", "found"])


def _extend(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    """Spans [begin, end) of document words in an occurrence of an item's window; null where a fingerprint has none."""
    reach = window - k
    width = 2 * reach + k
    for batch in batches:
        get = dict(zip(batch.schema.names, batch.columns))
        valid = np.asarray(get["item_words"].is_valid()) & np.asarray(get["words"].is_valid())
        rows = np.flatnonzero(valid)
        matrix = lambda c: np.frombuffer(b"".join(get[c].take(pa.array(rows)).to_pylist()), dtype=np.uint64).reshape(-1, width)
        begin, end = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
        hit = np.zeros(batch.num_rows, dtype=bool)
        if len(rows):
            equal = matrix("words") == matrix("item_words")
            at, size = (get[c].take(pa.array(rows)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "size"))
            before = np.cumprod(equal[:, reach - 1 :: -1] if reach else equal[:, :0], axis=1).sum(axis=1)
            after = np.cumprod(equal[:, reach + k :], axis=1).sum(axis=1)
            long = (size == 0) & equal[:, reach : reach + k].all(axis=1) & (before + k + after >= window)
            run = np.cumprod(equal, axis=1).sum(axis=1)
            short = (size > 0) & (run >= size)
            hit[rows] = long | short
            begin[rows] = np.where(short, at, at - before)
            end[rows] = np.where(short, at + size, at + k + after)
        span = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], ["begin", "end"], mask=pa.array(~hit))
        items = pa.array(np.where(hit, np.array(get["item_id"].to_pylist(), dtype=object), None), pa.string())
        yield pa.RecordBatch.from_arrays([get["row"], get["n_words"], span, items], ["row", "n_words", "span", "item_id"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, items (sorted ids as strings), contaminated, for each row of docs (doc_id, text)."""
    spark = docs.sparkSession
    named = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = map_arrow(named, lambda b: _item_rows(b, window, k), "item_id string, mark long, size int, item_words binary")
    told = items.agg(F.count("*").alias("n"), F.collect_set(F.nullif("size", F.lit(0))).alias("sizes")).first()
    n_bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * told["n"]).bit_length()))
    bits = bitmap(items.select(F.col("mark").bitwiseAND(n_bits - 1).alias("place")), n_bits)
    shared, sizes = spark.sparkContext.broadcast(bits), sorted(told["sizes"])

    key = F.struct("doc_id", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("nr")).alias("row")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).select(key, "text")
    kind = rows.schema["row"].dataType.simpleString()
    found = map_arrow(rows, lambda b: _doc_rows(b, shared.value, sizes, window, k), f"row {kind}, n_words long, found array<struct<mark: long, at: int, words: binary>>")
    each = found.select("row", "n_words", F.explode_outer("found").alias("f")).select("row", "n_words", "f.at", "f.words", F.coalesce("f.mark", F.xxhash64("row")).alias("mark"))
    spans = each.join(items, "mark", "left").select("row", "n_words", "at", "words", "size", "item_words", "item_id")
    spans = map_arrow(spans, lambda b: _extend(b, window, k), f"row {kind}, n_words long, span struct<begin: long, end: long>, item_id string")
    ended = spans.groupBy("row").agg(F.max("n_words").alias("n_words"), F.collect_set("span").alias("spans"), F.collect_set("item_id").alias("items"))
    covered = F.aggregate(
        F.sort_array("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, s: F.struct((a.n + F.greatest(F.lit(0).cast("long"), s.end - F.greatest(s.begin, a.upto))).alias("n"), F.greatest(a.upto, s.end).alias("upto")),
        lambda a: a.n,
    )
    hit = ended.select("row.doc_id", "row.text_hash", "n_words", covered.alias("n_hit"), F.sort_array("items").alias("items"))
    return hit.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that aren't contaminated, with all their columns."""
    bad = decontaminate(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    # The row as a whole, so that no column of docs can clash with those of the join.
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col("doc_id").alias("own_id"), F.xxhash64(F.col("text").cast("string")).alias("own_hash"))
    return own.join(bad, F.col("own_id").eqNullSafe(F.col("bad_id")) & (F.col("own_hash") == F.col("bad_hash")), "left_anti").select("whole.*")
