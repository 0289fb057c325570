"""Ranked lexical search by the Best Position Algorithm over impact lists.

Queries are taken in blocks of a bounded number of terms. For a block, one pass over the documents
keeps of each text its number of terms and the frequencies of the block's terms; from these rows
come the statistics of the whole corpus. The rows are then searched shard by shard: a shard holds a
bounded number of postings, as an impact list for each term (documents by falling impact) and a row
of terms for each document, and Spark runs the shards side by side. A shard gives its best
k documents for each query, and the best of all shards' are the result.

In a shard, a query reads each of its lists from the best position on, that is behind the last place
up to which all places are seen. Each document met for the first time is accessed directly: its row
gives its whole score, and its places in all other lists, which count as seen too. The impacts at
the best positions add up to the most that an unseen document can score, and this bound falls
faster than one from the places read last, as direct accesses fill the gaps. The search of
a shard stops when that bound is strictly below the kth score found, so that no tie is lost, or when
the lists end.

Scores are whole numbers: a term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))) and a document with
it gets w * (10^9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L, as often as the query repeats the term.

Defined results: terms are compared by 64-bit hashes; a null text has no terms, on either side; a
query without hits gives no rows; equal scores are in order of doc_id, null ids last; rows of
documents are documents of their own even if they are equal; equal rows of queries count once, those
with equal ids but other texts are queries of their own; empty tables give no rows. Extra columns
are ignored, those of clashing names too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tickloom.llm.common import slices, stored, texts
from tickloom.llm.words import word_hashes

BEST = 10
#: Distinct terms of a query at most that one block of queries may add up to, one query at least; and queries of a block.
BLOCK_TERMS, BLOCK_QUERIES = 1 << 17, 1 << 12
#: Postings of a shard: some 100 MB of a task's memory.
SHARD = 1 << 21
#: Places that the first round reads of each list; each later round reads twice as many.
FIRST_READ = 16

Query = tuple[np.ndarray, np.ndarray]


def _blocks(queries: DataFrame) -> Iterator[tuple[list, list[Query]]]:
    """(ids, (terms, how often) of each), block by block."""
    ids, found, held = [], [], 0
    for row in queries.select("item_id", F.col("text").cast("string").alias("text")).distinct().toLocalIterator():
        terms, often = np.unique(word_hashes(texts(pa.array([row.text], pa.string())))[1], return_counts=True)
        if not len(terms):
            continue
        if ids and (held + len(terms) > BLOCK_TERMS or len(ids) == BLOCK_QUERIES):
            yield ids, found
            ids, found, held = [], [], 0
        ids.append(row.item_id)
        found.append((terms, often.astype(np.int64)))
        held += len(terms)
    if ids:
        yield ids, found


def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """doc_id, n (terms of the text), terms (places in the vocabulary, rising), tfs."""
    size = len(vocabulary)
    for batch in slices(batches, 1):
        bounds, hashes = word_hashes(texts(batch.column(1)))
        place = np.minimum(np.searchsorted(vocabulary, hashes), size - 1)
        known = np.flatnonzero(vocabulary[place] == hashes)
        doc = np.searchsorted(bounds, known, side="right") - 1
        pairs, tfs = np.unique(doc * size + place[known], return_counts=True)
        offsets = pa.array(np.searchsorted(pairs, np.arange(batch.num_rows + 1) * size).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (pairs % size, tfs)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds)), *lists], ["doc_id", "n", "terms", "tfs"])


class Shard:
    """Impact lists and rows of some documents."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int):
        held = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        self.ids, n = held.column(0), held.column(1).to_numpy()
        order = pc.sort_indices(self.ids, null_placement="at_end").to_numpy()
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        terms, tfs = held.column(2).flatten().to_numpy(), held.column(3).flatten().to_numpy().astype(np.int64)
        lengths = pc.list_value_length(held.column(2)).to_numpy()
        doc = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
        m = 25 + (75 * n * n_docs) // n_terms
        impact = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[doc]))
        # Postings without impact change no score.
        held = impact > 0
        self.doc, self.term, self.impact = doc[held], terms[held], impact[held]
        self.rows = np.searchsorted(self.doc, np.arange(len(lengths) + 1))
        self.lists = np.lexsort((-self.impact, self.term))
        self.starts = np.searchsorted(self.term[self.lists], np.arange(len(weights) + 1))
        self.place = np.empty(len(self.lists), dtype=np.int64)
        self.place[self.lists] = np.arange(len(self.lists))

    def best(self, terms: np.ndarray, often: np.ndarray, k: int, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) of the k best of a query, and the number of documents accessed. slot: -1 for every term of the vocabulary."""
        start, size = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        base = np.concatenate(([0], np.cumsum(size)))
        slot[terms] = np.arange(len(terms))
        seen, met, upto, read = np.zeros(base[-1], dtype=bool), np.zeros(len(self.rank), dtype=bool), np.zeros(len(terms), dtype=np.int64), FIRST_READ
        docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        while (upto < size).any():
            # Sorted access, from the best position of each list on.
            postings = np.concatenate([self.lists[s + u : s + min(u + read, n)] for s, u, n in zip(start, upto, size)])
            new = np.unique(self.doc[postings])
            new = new[~met[new]]
            met[new] = True
            if len(new):
                # Direct access: the whole rows of the documents met.
                length = self.rows[new + 1] - self.rows[new]
                first = np.concatenate(([0], np.cumsum(length)))
                row = np.repeat(self.rows[new] - first[:-1], length) + np.arange(first[-1])
                at = slot[self.term[row]]
                hit = at >= 0
                scores = np.concatenate((scores, np.add.reduceat(np.where(hit, self.impact[row] * often[at], 0), first[:-1])))
                docs = np.concatenate((docs, new))
                seen[base[at[hit]] + self.place[row[hit]] - start[at[hit]]] = True
            most = 0
            for i in range(len(terms)):
                left = seen[base[i] + upto[i] : base[i + 1]]
                gap = int(left.argmin()) if len(left) else 0
                upto[i] += len(left) if len(left) and left[gap] else gap
                if upto[i] < size[i]:
                    most += int(often[i] * self.impact[self.lists[start[i] + upto[i] - 1]])
            if len(scores) >= k and np.partition(scores, len(scores) - k)[len(scores) - k] > most:
                break
            read *= 2
        slot[terms] = -1
        chosen = np.lexsort((self.rank[docs], -scores))[:k]
        return docs[chosen], scores[chosen], len(docs)


def _search(batches: Iterator[pa.RecordBatch], queries: list[Query], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    slot = np.full(len(weights), -1, dtype=np.int64)

    def searched(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        shard = Shard(held, weights, n_docs, n_terms)
        found = [shard.best(terms, often, k, slot) for terms, often in queries]
        docs, scores = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        nrs = np.repeat(np.arange(len(queries)), [len(f[0]) for f in found])
        return pa.RecordBatch.from_arrays([pa.array(nrs), shard.ids.take(pa.array(docs)), pa.array(scores)], ["nr", "doc_id", "score"])

    held, postings = [], 0
    for batch in batches:
        held.append(batch)
        postings += len(batch.column(2).flatten())
        if postings >= SHARD:
            yield searched(held)
            held, postings = [], 0
    if postings:
        yield searched(held)


def _search_block(docs: DataFrame, ids: DataFrame, queries: list[Query], k: int) -> DataFrame | None:
    """item_id, rank, doc_id, score for the queries of a block; ids: nr, item_id."""
    vocabulary = np.unique(np.concatenate([terms for terms, _ in queries]))
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lambda b: _frequencies(b, vocabulary), f"doc_id {kind}, n long, terms array<int>, tfs array<int>"
    )
    postings = stored(counted, "postings")
    told = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    if not told.terms:
        return None
    # At most one row per term of the block.
    df = {r.term: r.df for r in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toLocalIterator()}
    weights = np.array([floor(1000 * log((2 * told.docs + 2) / (2 * df[i] + 1))) if i in df else 0 for i in range(len(vocabulary))], dtype=np.int64)
    placed = [(np.searchsorted(vocabulary, terms), often) for terms, often in queries]
    found = postings.where(F.size("terms") > 0).mapInArrow(
        lambda b: _search(b, placed, weights, told.docs, told.terms, k), f"nr long, doc_id {kind}, score long"
    )
    best = Window.partitionBy("nr").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(F.broadcast(ids), "nr").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents (doc_id, text) for each query (item_id, text)."""
    spark, item = docs.sparkSession, queries.schema["item_id"]
    found = []
    for ids, block in _blocks(queries):
        names = spark.createDataFrame(list(enumerate(ids)), StructType([StructField("nr", LongType()), item]))
        found.append(_search_block(docs, names, block, k))
    found = [f for f in found if f is not None]
    if not found:
        kinds = [item, StructField("rank", IntegerType()), docs.schema["doc_id"], StructField("score", LongType())]
        return spark.createDataFrame([], StructType(kinds))
    return reduce(DataFrame.unionByName, found)
