import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from tickloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = ["a", "s", "t", "ll", "re", "'", "'s", "'ll", "'ve", " ", "  ", "\n", "\t", "1", "٣", "é", "日", "!", "#", " ", "\x1c", "\U0001f600", "ʼ", "d", "m", "\0"]


@pytest.fixture(scope="module")
def reference():
    ranks = {w: i for i, w in enumerate(bpe.token_bytes(PATH))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_splitting_equals_the_pattern():
    assert bpe.CLASS_PATTERN == public_tokenizers.PATTERN
    rng = random.Random(5)
    for _ in range(1500):
        column = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(4)]
        n, at, words = bpe.pre_tokens(column, bpe.CLASS_PATTERN)
        expected = [regex.findall(bpe.CLASS_PATTERN, t) for t in column]
        assert n.tolist() == list(map(len, expected)) and [words[i] for i in at] == [w for x in expected for w in x]


def check(found, docs, reference):
    expected = []
    for r in docs.collect():
        text = r.text or ""
        ids = reference.encode_ordinary(text)
        expected.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_odd_documents(odd_docs, no_docs, reference):
    check(bpe.round_trip(odd_docs, PATH, bpe.CLASS_PATTERN), odd_docs, reference)
    assert bpe.round_trip(no_docs, PATH, bpe.CLASS_PATTERN).count() == 0


def test_many_blocks_and_a_table(spark, sf_dir, reference, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 20_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(bpe.round_trip(docs, PATH, bpe.CLASS_PATTERN), docs, reference)


def test_any_pattern(spark, reference):
    docs = spark.createDataFrame([(1, "some words, here")], "doc_id long, text string")
    ids = bpe.encode(docs, PATH, r"\w+|\W+").first().ids
    assert ids == [i for w in ("some", " ", "words", ", ", "here") for i in bpe.encoder(PATH).encode_ordinary(w)]


def test_decoding_nulls(spark):
    ids = spark.createDataFrame([(1, [0, 1]), (2, []), (3, None)], "doc_id long, ids array<int>")
    table = bpe.token_bytes(PATH)
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(ids, PATH).collect()} == {1: table[0] + table[1], 2: b"", 3: b""}
