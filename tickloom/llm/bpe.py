"""Byte-level BPE: every distinct word of the corpus is encoded once, and its ids are joined back.

Each task takes its texts in blocks, splits them into pre-tokens and sends every distinct pre-token
of a block once into the word shuffle; so a frequent word costs an entry per block and not one per
occurrence. The words of a block are numbered by bucket (a hash of the word), and those of one
bucket travel in one row. Equal words meet in their bucket, are encoded once, and the ids join the
blocks again under the same numbers. There the positions of the pre-tokens, which are such
numbers, put the ids together. Decoding joins the token-byte table, whose size the vocabulary
file bounds.

Defined results: a null text is an empty text, without ids; repeated rows are encoded as often
as they occur; a null doc_id stays null; an empty table gives no rows; extra columns are
ignored. Texts are never cut: a document longer than a block is a block of its own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import map_arrow, slices, texts
from tickloom.llm.words import BASE, mix, span_hashes

#: Bytes of text of a block, about: bounds the tasks that make it and put it together.
BLOCK_BYTES = 6 << 20
#: Bytes of text that are split at a time.
SLICE_BYTES = 1 << 20

#: The split that is done in numpy; fixed value, as any other pattern may be given.
CLASS_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OTHER, LETTER, NUMBER, SPACE = range(4)

#: Buckets of words, and words of a bucket that are kept in memory with their ids; more are encoded again.
WORD_BUCKETS, KEPT_WORDS = 1024, 1 << 19

WORD_SCHEMA = "bucket int, block long, start int, lengths binary, words binary"
BLOCK_SCHEMA = "block long, n_words int, doc_ids array<long>, lengths array<int>, positions binary"
PACK_SCHEMA = "owner long, start int, sizes binary, ids binary"


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id, from a file of base64 bytes and rank a line."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(word) for word, rank in map(bytes.split, filter(bytes.strip, lines))}
    return [ranks.get(i, b"") for i in range(max(ranks) + 1)]


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    """Merges a whole pre-token by rank; the pattern takes any string as one piece."""
    ranks = {word: rank for rank, word in enumerate(token_bytes(path)) if word}
    return tiktoken.Encoding("pre-token", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, as the regex library has them."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, every):
            out[ord(every[m.start()]) : ord(every[m.end() - 1]) + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


def class_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of CLASS_PATTERN start. points: code points of texts one after the other; firsts: where each begins.

    A pre-token is a run of one class, with one blank before it; white space before a text's
    next run gives up its last character, and a lone apostrophe takes the ending that follows.
    """
    n = len(points)
    kind = classes()[points]
    new = np.ones(n + 1, dtype=bool)
    new[1:n] = kind[1:] != kind[:-1]
    new[firsts[firsts < n]] = True
    edge = np.zeros(n + 1, dtype=bool)
    edge[firsts] = edge[n] = True
    at = np.flatnonzero(new)
    begin, end = at[:-1], at[1:]
    is_space = kind[begin] == SPACE
    goes_on = ~edge[end]  # another run of the same text follows
    lends = is_space & goes_on
    blank = lends & (points[end - 1] == 32)
    takes = np.concatenate(([False], blank[:-1]))  # this run has the blank before it
    start = np.zeros(n + 1, dtype=bool)
    start[(begin - takes)[~is_space]] = True
    start[begin[is_space & (~lends | (end - begin > 1) | ~blank)]] = True
    start[(end - 1)[lends & ~blank]] = True
    lone = np.flatnonzero((kind[begin] == OTHER) & (end - begin == 1) & (points[begin] == 39) & ~takes & goes_on)
    lone = lone[kind[end[lone]] == LETTER]
    if len(lone):
        after = end[lone]
        first, size = points[after], end[lone + 1] - after
        second = np.where(size > 1, points[np.minimum(after + 1, n - 1)], 0)
        short = np.isin(first, [ord(c) for c in "stmd"])
        long = np.zeros(len(lone), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (first == ord(a)) & (second == ord(b))
        hit = short | long
        start[after[hit]] = False
        rest = hit & (size > np.where(short, 1, 2))
        start[(after + np.where(short, 1, 2))[rest]] = True
    return np.flatnonzero(start[:n])


def pre_tokens(column: list[str], pattern: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(pre-tokens per text, index of each pre-token's word, the distinct words)."""
    if pattern != CLASS_PATTERN:
        found = [regex.findall(pattern, t) for t in column]
        index: dict[str, int] = {}
        positions = np.fromiter((index.setdefault(w, len(index)) for words in found for w in words), np.int64)
        return np.array([len(x) for x in found], dtype=np.int64), positions, list(index)
    text = "".join(column)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.cumsum([0, *map(len, column)])
    starts = class_starts(points, bounds[:-1])
    ends = np.append(starts[1:], len(points))
    _, first, positions = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
    words = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return np.diff(np.searchsorted(starts, bounds)), positions, words


def _pack(numbers: np.ndarray) -> bytes:
    """32-bit integers in few bytes: byte by byte, as their high bytes are much alike."""
    planes = np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1)


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, list[bytes], np.ndarray]]:
    """(block, doc_ids, lengths, positions, words by number, first number of each bucket); the same for the same rows in the same partition."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    doc_ids, lengths, positions, words, held = [], [], [], {}, 0

    def block():
        sizes, listed = np.concatenate(lengths), [w.encode("utf-8", "surrogatepass") for w in words]
        bucket = np.fromiter((crc32(w) % WORD_BUCKETS for w in listed), np.int64, len(listed))
        order = np.argsort(bucket, kind="stable")
        numbers = np.empty(len(order), dtype=np.int32)
        numbers[order] = np.arange(len(order))
        at = numbers[np.concatenate(positions)]
        # The name also tells what is in the block: if its rows came in another order, nothing would match and the job would fail.
        places = np.arange(len(at), dtype=np.uint64) | np.uint64(1)
        told = np.array([number], dtype=np.uint64) * np.uint64(BASE) + np.sum((at.astype(np.uint64) + np.uint64(1)) * places)
        return int(mix(told).view(np.int64)[0]), doc_ids, sizes, at, [listed[i] for i in order], np.searchsorted(bucket[order], np.arange(WORD_BUCKETS + 1))

    for batch in slices(batches, 1, SLICE_BYTES):
        column = texts(batch.column(1))
        size = column.nbytes
        if held and held + size > BLOCK_BYTES:
            yield block()
            doc_ids, lengths, positions, words, held, number = [], [], [], {}, 0, number + 1
        n, at, found = pre_tokens(column.to_pylist(), pattern)
        known = np.fromiter((words.setdefault(w, len(words)) for w in found), np.int32, len(found))
        doc_ids += batch.column(0).to_pylist()
        lengths.append(n)
        positions.append(known[at] if len(at) else np.zeros(0, dtype=np.int32))
        held += size
    if doc_ids:
        yield block()


def _word_rows(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for number, _, _, _, words, starts in _blocks(batches, pattern):
        buckets = np.flatnonzero(np.diff(starts))
        rows = [words[starts[b] : starts[b + 1]] for b in buckets]
        columns = [
            pa.array(buckets.astype(np.int32)),
            pa.array(np.full(len(buckets), number)),
            pa.array(starts[buckets].astype(np.int32)),
            pa.array([_pack(np.fromiter(map(len, r), np.int32, len(r))) for r in rows], pa.binary()),
            pa.array([packer.compress(b"".join(r)) for r in rows], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "start", "lengths", "words"])


def _block_rows(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[pa.RecordBatch]:
    for number, doc_ids, lengths, positions, words, _ in _blocks(batches, pattern):
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([len(words)], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([lengths.tolist()], pa.list_(pa.int32())), pa.array([_pack(positions)], pa.binary())],
            ["block", "n_words", "doc_ids", "lengths", "positions"],
        )


def _encode_words(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: each distinct word is encoded once, its ids go to all blocks that hold it."""
    encode, unpacker = encoder(path).encode_ordinary, zstandard.ZstdDecompressor()
    now, known = None, {}
    for batch in batches:
        rows = []
        for bucket, block, start, lengths, words in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != now or len(known) > KEPT_WORDS:
                now, known = bucket, {}
            ends, joined = np.cumsum(_unpack(lengths)).tolist(), unpacker.decompress(words)
            ids, begin = [], 0
            for end in ends:
                word, begin = joined[begin:end], end
                found = known.get(word)
                if found is None:
                    found = known[word] = encode(word.decode("utf-8", "surrogatepass"))
                ids.append(found)
            rows.append((block, start, _pack(np.fromiter(map(len, ids), np.int32, len(ids))), _pack(np.fromiter(chain.from_iterable(ids), np.int32))))
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["owner", "start", "sizes", "ids"])


def _assemble(blocks: pd.DataFrame, packs: pd.DataFrame) -> pd.DataFrame:
    """The ids of each document of a block, by the positions of its pre-tokens."""
    if len(blocks) != 1:
        raise ValueError("blocks and words don't match: store the documents first, their rows change from read to read")
    block, packs = blocks.iloc[0], packs.sort_values("start")
    joined = lambda c: np.concatenate([*map(_unpack, packs[c]), np.zeros(0, dtype=np.int32)])
    sizes, flat, positions = joined("sizes").astype(np.int64), joined("ids"), _unpack(block.positions)
    if len(sizes) != block.n_words:
        raise ValueError("blocks and words don't match: store the documents first, their rows change from read to read")
    begins = np.cumsum(sizes) - sizes
    cuts = np.cumsum(np.asarray(block.lengths, dtype=np.int64))
    out, begin = [], 0
    for end in cuts:
        words = positions[begin:end]
        n = sizes[words]
        ends = np.cumsum(n)
        out.append(flat[np.repeat(begins[words] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)])
        begin = end
    return pd.DataFrame({"doc_id": pd.array(block.doc_ids, dtype="Int64"), "ids": out})


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int>: the ids of each text, as tiktoken's encode_ordinary gives them.

    docs (doc_id, text) is read twice and must give the same rows in the same partitions, as a
    table does; other frames have to be stored first, else the job fails.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = map_arrow(rows, lambda b: _word_rows(b, pattern), WORD_SCHEMA)
    packs = map_arrow(words.repartition("bucket").sortWithinPartitions("bucket"), lambda b: _encode_words(b, path), PACK_SCHEMA)
    blocks = map_arrow(rows, lambda b: _block_rows(b, pattern), BLOCK_SCHEMA)
    return blocks.groupBy("block").cogroup(packs.groupBy("owner")).applyInPandas(_assemble, "doc_id long, ids array<int>")


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = token_bytes(path)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            decoded = [b"".join(map(table.__getitem__, ids.values.to_numpy().tolist())) if ids.is_valid else b"" for ids in part.column("ids")]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded binary: the token-byte table joined to every id, map-side, and put together in order.

    A null list decodes to no bytes; an id that the table lacks fails the job.
    """
    return map_arrow(encoded.select("doc_id", "ids"), lambda b: _decode(b, path), "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again."""
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return decode(encode(docs, path, pattern), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
