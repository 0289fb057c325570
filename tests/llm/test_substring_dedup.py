import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tickloom.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"


def brute(docs, window=20):
    """(doc, words, removed words, what is kept) for each document; repeated rows are one document."""
    earliest, out = {}, {}
    for key in sorted(dict.fromkeys(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        words = WORD.findall(key[1] or "")
        gone = set()
        for i in range(len(words) - window + 1):
            if earliest.setdefault(tuple(words[i : i + window]), (key, i)) != (key, i):
                gone |= {*range(i, i + window)}
        out[key] = (key[0], len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone))
    return sorted(str(out[d]) for d in docs)


def found(spark, docs, parts=3):
    got = substring_dedup.deduplicate(spark.createDataFrame(docs, DOCS).repartition(parts)).collect()
    texts = {}
    for doc, text in docs:
        texts.setdefault((doc, len(WORD.findall(text or ""))), " ".join(WORD.findall(text or "")))
    for r in got:
        assert sum(s.end - s.begin for s in r.spans) == r.n_removed and (r.kept_text is None) == (r.n_removed == 0)
        assert all(a.end < b.begin for a, b in zip(r.spans, r.spans[1:]))
    return sorted(str((r.doc_id, r.n_words, r.n_removed, texts[r.doc_id, r.n_words] if r.kept_text is None else r.kept_text)) for r in got)


def corpus(rng):
    passage = prose(rng, 45)
    base = [prose(rng, n) for n in (15, 19, 20, 21, 40, 90, 300, 300)]
    docs = [(i, t) for i, t in enumerate(base)] + [(20 + i, t) for i, t in enumerate(base)]
    docs += [(100 + i, f"{prose(rng, i % 30)} {passage} {prose(rng, i % 17)}") for i in range(90)]
    for i in range(30):  # near copies: some words replaced, dropped or moved
        words = base[6].split()
        for _ in range(i % 7 + 1):
            words[rng.randrange(len(words))] = "changed"
        docs.append((300 + i, " ".join(words[rng.randrange(20) :])))
    docs += [(400, passage + " " + passage), (401, "a " * 200), (402, "a " * 30), (403, " ".join(["b", "c"] * 60)), (404, "\t".join(passage.split())), (405, passage.replace(" ", " "))]
    docs += [(500 + i, base[5] + " tail" * i) for i in range(25)]
    docs += [(600, None), (601, ""), (602, " \n\t"), (None, base[7]), (None, prose(rng, 30)), (603, prose(rng, 5000)), (2, base[2]), (2, base[2])]
    rng.shuffle(docs)
    return docs


def test_brute_force(spark, rng):
    docs = corpus(rng)
    expected = brute(docs)
    assert found(spark, docs) == expected
    unique = [d for d in docs if d[0] not in (None, 2)]  # ids that tell all documents apart
    assert found(spark, unique, 4) == brute(unique)


def test_batches_and_ranges_change_nothing(spark, rng, monkeypatch):
    docs = corpus(rng)
    monkeypatch.setattr(substring_dedup, "BATCH", 2000)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(spark, docs[:160], 5) == brute(docs[:160])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_equal_ids_with_other_texts_and_clashing_columns(spark, odd_docs, no_docs):
    text = " ".join(f"w{i}" for i in range(40))
    twice = spark.createDataFrame([(1, text), (1, text + " more"), (1, text)], DOCS)
    got = sorted((r.n_words, r.n_removed) for r in substring_dedup.deduplicate(twice).collect())
    assert got in ([(40, 0), (40, 0), (41, 40)], [(40, 40), (40, 40), (41, 0)])
    odd = odd_docs.withColumns({c: F.lit("other") for c in ("text_hash", "anchor", "begin", "spans", "n_removed", "0")})
    lost = {(r.doc_id, r.n_removed) for r in substring_dedup.deduplicate(odd).collect()}
    assert {d: n for d, n in lost if n} == {6: 60_000}
    assert substring_dedup.deduplicate(odd).count() == odd_docs.count() and substring_dedup.deduplicate(no_docs).count() == 0


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=6), st.integers(3, 7), st.integers(1, 3))
@settings(max_examples=200, deadline=None)
def test_runs_cover_each_window_once_by_its_own_anchor(texts, window, k):
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    hashes = (np.array([w for t in texts for w in t], dtype=np.uint64) + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
    begin, end, anchor = substring_dedup.runs(hashes, bounds, window, k)
    starts = [s for b, e in zip(begin, end) for s in range(b, e - window + 1)]
    assert starts == [s for a, b in zip(bounds[:-1], bounds[1:]) for s in range(a, b - window + 1)]
    anchors, own = {}, [a for b, e, a in zip(begin, end, anchor) for _ in range(b, e - window + 1)]
    for s, a in zip(starts, own):
        assert anchors.setdefault(tuple(hashes[s : s + window].tolist()), a) == a


@given(st.lists(st.text(st.sampled_from("aé日 \n\x0b\t\xa0"), max_size=20), max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_pattern(column):
    words = substring_dedup.Words(pa.array(column, pa.string()))
    expected = [WORD.findall(t) for t in column]
    assert np.diff(words.bounds).tolist() == list(map(len, expected))
    assert [t.decode() for t in words.joined(np.ones(len(words.starts), dtype=bool))] == [" ".join(w) for w in expected]
    assert [t.decode() for t in words.joined(np.arange(len(words.starts)) % 2 == 0)] == [
        " ".join(w for p, w in enumerate(ws, a) if p % 2 == 0) for a, ws in zip(words.bounds, expected)
    ]
