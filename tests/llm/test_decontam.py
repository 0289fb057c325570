import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import decontam
from tickloom.llm.words import shingles, word_hashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n and item is not None else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit |= {*range(i, i + n)}
                    found |= own
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(map(str, out))


def found(spark, docs, items):
    got = decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    return sorted(str(tuple(r)) for r in got.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect())


def test_brute_force(spark, rng):
    from tests.llm.conftest import prose

    base = [prose(rng, 80) for _ in range(4)]
    items = [(1, base[0]), (2, base[1]), (3, "one TWO three"), (4, ""), (5, None), (None, base[2]), (6, base[0]), (7, "!!"), (8, " ".join(["aa"] * 30)), (9, "five words are in this"), (10, " ".join(base[3].split()[:13]))]
    docs = [(i, prose(rng, 30) + " " + " ".join(base[i % 4].split()[i : i + n]) + " " + prose(rng, 200 + i)) for i, n in enumerate([12, 13, 14, 40, 60, 5] * 3)]
    docs += [(100, "xx one two, THREE xx"), (101, None), (102, ""), (103, "aa " * 50), (104, base[2]), (105, "one two"), (None, base[0]), (106, base[0]), (106, base[0]), (107, "five words are in this five words are in this"), (108, base[0].lower().replace(" ", "; "))]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, []) == brute(docs, [])
    assert found(spark, [], items) == []


def test_clean_keeps_the_others_whole(spark, odd_docs):
    items = spark.createDataFrame([(1, "It is a small text, and it ends here.")], ITEMS)
    left = decontam.clean(odd_docs, items)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 2
    assert {r.doc_id for r in left.select("doc_id").collect()} == {2, 3, 4, 5, 6, 7, None}


def test_clean_with_columns_of_its_own_names(spark):
    docs = spark.createDataFrame([(1, "two words", 5, "h"), (2, "others here", 6, None)], "doc_id long, text string, bad_id long, bad_hash string").selectExpr("*", "doc_id AS own_id", "doc_id AS whole")
    left = decontam.clean(docs, spark.createDataFrame([(1, "Two words")], ITEMS))
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [(2, "others here", 6, None, 2, 2)]


@given(st.lists(st.integers(0, 4), min_size=13, max_size=60), st.integers(0, 40), st.lists(st.integers(0, 4), max_size=30))
@settings(max_examples=200, deadline=None)
def test_winnowing_finds_every_shared_window(a, at, more):
    a = np.array(a, dtype=np.uint64)
    at = min(at, len(a) - 13)
    b = np.concatenate((np.array(more, dtype=np.uint64), a[at : at + 13], np.array(more[::-1], dtype=np.uint64)))
    marks = lambda x: {int(shingles(x, 5)[i]) for i in decontam.winnow(x, 5, 9)}
    inside = {int(shingles(a[at : at + 13], 5)[i]) for i in decontam.winnow(a[at : at + 13], 5, 9)}
    assert inside <= marks(a) & marks(b)


@given(st.lists(st.text(st.sampled_from("aZ09 é日-_\n\x00{`"), max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_pattern(column):
    import pyarrow as pa

    bounds, hashes = word_hashes(pa.array(column, pa.string()))
    expected = [words(t) for t in column]
    assert np.diff(bounds).tolist() == list(map(len, expected))
    names = {}
    assert all(names.setdefault(w, h) == h for w, h in zip([w for x in expected for w in x], hashes.tolist()))
    assert len(set(names.values())) == len(names)
