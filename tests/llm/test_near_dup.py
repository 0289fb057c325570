from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import prose
from tests.llm.test_decontam import words
from tickloom.llm import near_dup
from tickloom.llm.components import components


def brute(rows):
    """Classes of row numbers, by the exact similarity of all pairs of texts with a shared run."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets, by_run = [], defaultdict(list)
    for i, (_, text) in enumerate(rows):
        w = words(text)
        s = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
        for j in {j for g in s for j in by_run[g]}:
            if 10 * len(s & sets[j]) >= 8 * len(s | sets[j]):
                parent[root(i)] = root(j)
        sets.append(s)
        for g in s:
            by_run[g].append(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    order = lambda x: (x is None, x or 0)
    out = []
    for group in groups.values():
        first = min((rows[i][0] for i in group), key=order)
        out += [(rows[i][0], first, len(group)) for i in group]
    return sorted(map(str, out))


def found(df):
    return sorted(str(tuple(r)) for r in near_dup.classes(df).select("doc_id", "class_id", "class_size").collect())


def edited(rng, text, n):
    w = text.split(" ")
    for i in rng.sample(range(len(w)), n):
        w[i] = "edit" + str(rng.randint(0, 999))
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus(rng):
    """Unrelated texts, copies, chains of near copies, and texts that share a long passage without being alike."""
    passage, rows = prose(rng, 120), []
    for i in range(40):
        base = prose(rng, rng.randint(30, 300))
        rows += [base, base] if i % 5 == 0 else [base]
        rows += [edited(rng, base, len(base.split(" ")) // 60 + 1)] if i % 2 else []
    chain = prose(rng, 200)
    for _ in range(45):
        rows.append(chain)
        chain = edited(rng, chain, 3)
    rows += [passage + " " + prose(rng, 40) for _ in range(45)]
    rows += ["one two three", "One, two three!", "one two", None, "", "...", None]
    return [(i if i % 50 else None, t) for i, t in enumerate(rows)]


def test_brute_force(spark, corpus):
    assert found(spark.createDataFrame(corpus, "doc_id long, text string")) == brute(corpus)


def test_large_buckets_are_compared_round_by_round(spark, corpus, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL", 2)
    monkeypatch.setattr(near_dup, "CENTERS", 1)
    monkeypatch.setattr(near_dup, "MORE", 3)
    some = corpus[-75:]
    assert found(spark.createDataFrame(some, "doc_id long, text string").repartition(4)) == brute(some)


def test_one_row_of_each_class_stays(spark, odd_docs, no_docs):
    kept = near_dup.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, None, None, 5, 7]))
    assert near_dup.classes(no_docs).count() == 0 and near_dup.deduplicate(no_docs).count() == 0


@pytest.mark.parametrize("counted", [False, True])
def test_signatures_agree_as_often_as_sets_are_alike(counted):
    rng = np.random.default_rng(1)
    for n in (1, 3, 50, 900):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: n - n // 6], rng.integers(0, 1 << 62, n // 6).astype(np.uint64))))
        wa, wb = (rng.integers(1, 9, len(x)).astype(float) if counted else np.ones(len(x)) for x in (a, b))
        one, other = near_dup.signatures([(a, wa), (b, wb)], 3000)
        assert abs((one == other).mean() - near_dup.similarity(a, b, wa, wb)) < 0.05


def test_count_weights(spark):
    text = "a b c d e f g h i j "
    docs = spark.createDataFrame([(1, text), (2, text * 6)], "doc_id long, text string")
    assert near_dup.classes(docs, weights="count").select("class_id").distinct().count() == 2


def test_components(spark, rng):
    nodes = [f"{i:03d}" for i in range(120)]
    links = [(nodes[i], nodes[i + 1]) for i in range(0, 40)] + [(nodes[50], nodes[i]) for i in range(51, 90)] + [(nodes[95], nodes[95]), (nodes[90], nodes[99]), (nodes[99], nodes[90])]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {**{n: nodes[0] for n in nodes[:41]}, **{n: nodes[50] for n in nodes[50:90]}, nodes[90]: nodes[90], nodes[99]: nodes[90]}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_few_links_are_gathered_before_the_first_step(spark, rng, noted_jobs):
    links = [(f"{i:03d}", f"{i + 1:03d}") for i in range(60) if i % 20]
    rng.shuffle(links)
    table = spark.createDataFrame(links, "a string, b string").coalesce(2)
    want = components(table).collect()
    with noted_jobs() as stages:
        assert sorted(components(table, len(links)).collect()) == sorted(want)
        assert max(n for tasks in stages().values() for n in tasks) < 64
    assert components(table.limit(0), 0).count() == 0


def test_the_kept_rows_are_whole_whatever_their_columns_are_called(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, text, 99, "x"), (2, text, 77, "y"), (3, "other words that stand here alone", None, None)], "doc_id long, text string, kept_id long, first_hash string")
    docs = docs.withColumnRenamed("first_hash", "own_hash").selectExpr("*", "kept_id AS kept_hash", "kept_id AS first_id", "doc_id AS `a.b`")
    left = near_dup.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.where("doc_id <> 2").collect()))
