import re
from collections import Counter
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tickloom.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(item, [(doc, score)]) over all documents, best first."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for doc, c in held:
            m = 25 + 75 * c.total() * n_docs // max(1, n_terms)
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(map(str, out))


def found(spark, docs, items, **settings):
    got = ranked_search.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **settings)
    return sorted(str(tuple(r)) for r in got.collect())


def corpus(rng):
    common = "the of and in a "
    docs = [(i, common * rng.randint(0, 9) + prose(rng, rng.randint(1, 120))) for i in range(400)]
    words = " ".join(t for _, t in docs[:40]).split()
    docs += [(500 + i, "same text for many " + "ba " * (i % 3)) for i in range(60)]
    docs += [(1000, None), (1001, ""), (1002, "!? --"), (None, "same text without a number"), (7, docs[7][1]), (7, docs[7][1]), (1003, "x" * 50_000), (1004, "ba be bi " * 20_000), (1005, "Straße 日本語 ÀÉ été ΑΒΓ")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) + " the of") for i in range(30)]
    items += [(40, "same"), (41, "same same text text"), (42, "nowhereatall zzzz"), (43, None), (44, ""), (None, "text number"), (45, "THE Of ba"), (45, "THE Of ba"), (45, "another bi"), (46, "straße 日本語 Été αβγ")]
    return docs, items


def test_brute_force(spark, rng):
    docs, items = corpus(rng)
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, k=3) == brute(docs, items, k=3)


def test_blocks_and_shards_change_nothing(spark, rng, monkeypatch):
    docs, items = corpus(rng)
    monkeypatch.setattr(ranked_search, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 60)
    assert found(spark, docs[:80], items[:20]) == brute(docs[:80], items[:20])


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a b")], []) == [] and found(spark, [(1, None)], [(1, "a")]) == []
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "d d")], DOCS).withColumns({c: F.lit("other") for c in ("item_id", "nr", "rank", "score", "n", "terms")})
    items = spark.createDataFrame([(9, "C")], ITEMS).withColumns({c: F.lit("other") for c in ("doc_id", "nr", "rank", "score")})
    assert [(r.item_id, r.rank, r.doc_id) for r in ranked_search.search(docs, items).collect()] == [(9, 1, 2)]


def test_a_shard_stops_before_its_lists_end():
    """One document is far better than the others: the bound at the best positions rules these out."""
    n, weights = 20_000, np.array([9000, 8000, 7000])
    rng = np.random.default_rng(2)
    tfs = np.column_stack([rng.integers(1, 4, n) for _ in weights])
    tfs[777] = 500
    lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 3), pa.array(x.ravel().astype(np.int32))) for x in (np.tile(np.arange(3), (n, 1)), tfs)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.full(n, 100)), *lists], ["doc_id", "n", "terms", "tfs"])
    shard, slot = ranked_search.Shard([batch], weights, n, 100 * n), np.full(3, -1)
    docs, scores, accessed = shard.best(np.arange(3), np.array([1, 2, 1]), 1, slot)
    assert docs.tolist() == [777] and accessed < 200 and (slot == -1).all()
    docs, scores, accessed = shard.best(np.arange(3), np.array([1, 2, 1]), 10, slot)
    whole = (shard.impact.reshape(n, 3) * [1, 2, 1]).sum(axis=1)
    expected = np.lexsort((np.arange(n), -whole))[:10]
    assert docs.tolist() == expected.tolist() and scores.tolist() == whole[expected].tolist()
