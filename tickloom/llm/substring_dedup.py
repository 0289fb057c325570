"""Substring dedup by seed and extend on winnowed anchors.

A window is WINDOW consecutive words; a window whose words also start earlier (in a document before,
or before it in its own) is a repeat, and every word in one goes. Each window has one anchor: of
its K-grams the one with the least hash, the rightmost of equals. Equal windows have equal
anchors at equal places, so anchors are the seeds. Windows of one anchor that follow each other
make a run, and a run extends from the start of its first window to the end of its last.

Seeds meet by a range partitioning on (anchor, run), sorted there, and one pass over the sorted rows
settles them: of runs with equal words all but the earliest are repeats as a whole; the earliest
of a run whose anchor has no other run is no repeat; the earliest of runs that share an anchor but
extend differently are open. Only the documents of open runs are read again, to compare these runs window by
window in the same way. What is settled inside one batch of documents is not sent at all, so a
passage that a third of all documents hold costs a row per batch; and as ranges may part an anchor's
runs, an anchor with a great many is no task's alone. At the ends of a range, where a neighbour may
hold another run of the anchor, a run counts as open, which costs work but changes nothing.
Overlapping repeats of a document join to maximal spans.

Defined results: order is by doc_id, nulls last, then by the text's hash, then by place; rows with
equal doc_id and text are one document, of which every row gets the result; null, empty and short
texts lose nothing; an empty table gives no rows. Words are compared by 64-bit hashes of a run or window
together with those of their anchor. Extra columns are ignored, those of clashing names too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import discard, slices, stored, texts
from tickloom.llm.keymap import maybe_in
from tickloom.llm.words import shingles, span_hashes

WINDOW, K = 20, 8
#: Bytes of text that are settled together before anything is sent.
BATCH = 1 << 22
KEY = ["doc_id", "text_hash"]

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SPANS, RUNS = "array<struct<begin: int, end: int>>", "array<struct<begin: int, end: int, anchor: long>>"


class Words:
    """The words of a batch of texts: bytes data[starts[i]:ends[i]]; those of text t are bounds[t] to bounds[t + 1]."""

    def __init__(self, column: pa.StringArray):
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = column.buffers()[2]
        self.data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, dtype=np.uint8)
        self.offsets = offsets - offsets[0]
        inside = ~SPACE[self.data]
        edge = np.zeros(len(self.data) + 1, dtype=bool)
        edge[self.offsets] = True
        before, after = np.concatenate(([False], inside[:-1])), np.concatenate((inside[1:], [False]))
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def joined(self, kept: np.ndarray) -> list[bytes]:
        """Each text's kept words, joined by one space."""
        size = np.where(kept, self.ends - self.starts, -1) + 1
        upto = np.concatenate(([0], np.cumsum(size)))
        out = np.full(upto[-1], 0x20, dtype=np.uint8)
        words = np.flatnonzero(kept)
        length = self.ends[words] - self.starts[words]
        first = np.concatenate(([0], np.cumsum(length)))
        step = np.arange(first[-1]) - np.repeat(first[:-1], length)
        out[np.repeat(upto[words], length) + step] = self.data[np.repeat(self.starts[words], length) + step]
        return [out[upto[a] : max(upto[a], upto[b] - 1)].tobytes() for a, b in zip(self.bounds[:-1], self.bounds[1:])]


def runs(hashes: np.ndarray, bounds: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, anchor): the words of runs of windows with one anchor, in order; the words of text t are bounds[t] to bounds[t + 1]."""
    none = np.zeros(0, dtype=np.int64)
    n = len(hashes) - window + 1
    if n <= 0:
        return none, none, none.astype(np.uint64)
    grams = shingles(hashes, k)
    least, at = grams[:n].copy(), np.zeros(n, dtype=np.int64)
    for i in range(1, window - k + 1):
        lower = grams[i : i + n] <= least
        np.copyto(least, grams[i : i + n], where=lower)
        at[lower] = i
    whole = np.zeros(len(hashes) + 1, dtype=np.int64)
    sizes = np.maximum(np.diff(bounds) - window + 1, 0)
    np.add.at(whole, bounds[:-1], sizes > 0)
    np.add.at(whole, bounds[:-1] + sizes, -(sizes > 0).astype(np.int64))
    start = np.flatnonzero(np.cumsum(whole)[:n] > 0)
    if not len(start):
        return none, none, none.astype(np.uint64)
    chosen = at[start] + start
    new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1))))
    last = np.concatenate((new[1:] - 1, [len(start) - 1]))
    return start[new], start[last] + window, grams[chosen[new]]


def _ranks(doc_ids: pa.Array, text_hashes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each row in the order of documents, equal for equal ones; whether it is the first of these)."""
    keys = pa.table({"id": doc_ids, "hash": text_hashes})
    order = pc.sort_indices(keys, sort_keys=[("id", "ascending"), ("hash", "ascending")], null_placement="at_end").to_numpy()
    codes = pc.dictionary_encode(doc_ids, null_encoding="encode").indices.to_numpy(zero_copy_only=False)[order]
    hashes = text_hashes.to_numpy()[order]
    new = np.concatenate(([True], (codes[1:] != codes[:-1]) | (hashes[1:] != hashes[:-1])))[: len(order)]
    rank, first = np.empty(len(order), dtype=np.int64), np.zeros(len(order), dtype=bool)
    rank[order] = np.cumsum(new)
    first[order] = new
    return rank, first


def _earliest(anchor: np.ndarray, extent: np.ndarray, rank: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Whether a row is the earliest of those with its anchor and extent."""
    order = np.lexsort((begin, rank, extent, anchor))
    new = np.concatenate(([True], (anchor[order][1:] != anchor[order][:-1]) | (extent[order][1:] != extent[order][:-1])))[: len(order)]
    out = np.zeros(len(order), dtype=bool)
    out[order] = new
    return out


def merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, begins, ends) of the maximal spans of each of n_docs documents; touching spans join."""
    if not len(doc):
        return np.zeros(n_docs + 1, dtype=np.int64), begin, end
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + doc * far)
    new = np.flatnonzero(np.concatenate(([True], begin[1:] + doc[1:] * far > reach[:-1])) | np.concatenate(([True], doc[1:] != doc[:-1])))
    last = np.concatenate((new[1:] - 1, [len(doc) - 1]))
    return np.searchsorted(doc[new], np.arange(n_docs + 1)), begin[new], reach[last] - doc[last] * far


def _lists(offsets: np.ndarray, **columns: np.ndarray) -> pa.ListArray:
    fields = [pa.array(c) for c in columns.values()]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(fields, list(columns)))


def _signed(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    """Of each text: the number and digest of its words, its runs that are still to be settled, and spans that are."""
    for batch in slices(batches, 2, BATCH):
        words = Words(texts(batch.column(2)))
        digests = [hashlib.sha256(t).hexdigest() for t in words.joined(np.ones(len(words.starts), dtype=bool))]
        hashes = words.hashes()
        begin, end, anchor = runs(hashes, words.bounds, window, k)
        rank, first = _ranks(batch.column(0), batch.column(1))
        doc = np.searchsorted(words.bounds, begin, side="right") - 1
        own = first[doc]  # Of equal rows one stands for all.
        begin, end, anchor, doc = begin[own], end[own], anchor[own], doc[own]
        extent = span_hashes(hashes, begin, end)
        begin, end = begin - words.bounds[doc], end - words.bounds[doc]
        left = _earliest(anchor, extent, rank[doc], begin)
        offsets, begins, ends = merged(doc[~left], begin[~left], end[~left], batch.num_rows)
        found = _lists(np.searchsorted(doc[left], np.arange(batch.num_rows + 1)), anchor=anchor[left].view(np.int64), extent=extent[left].view(np.int64), begin=begin[left].astype(np.int32), end=end[left].astype(np.int32))
        spans = _lists(offsets, begin=begins.astype(np.int32), end=ends.astype(np.int32))
        columns = [batch.column(0), batch.column(1), pa.array(np.diff(words.bounds)), pa.array(digests, pa.string()), found, spans]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_words", "words_sha256", "runs", "spans"])


def _settled(batches: Iterator[pa.RecordBatch], open_too: bool) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor, extent and order: the repeats, with a null anchor, and with open_too those that are open.

    From batch to batch goes one row, the first of the extent at hand, and whether its anchor is known to have others.
    """
    names = ["anchor", "extent", *KEY, "begin", "end"]
    carried, several = None, True  # Before the first row there may be others of its anchor in the range before.

    def rows(table: pa.Table, at: np.ndarray, repeats: bool) -> Iterator[pa.RecordBatch]:
        chosen = table.take(pa.array(at))
        anchor = pa.nulls(len(at), pa.int64()) if repeats else chosen["anchor"].combine_chunks()
        columns = [chosen[c].combine_chunks() for c in (*KEY, "begin", "end")]
        yield pa.RecordBatch.from_arrays([*columns, anchor], [*KEY, "begin", "end", "anchor"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_arrays(batch.columns, names=names)
        table = table if carried is None else pa.concat_tables([carried, table])
        held = carried is not None
        table = table.combine_chunks()
        anchor, extent, text_hash, begin = (table[c].to_numpy() for c in ("anchor", "extent", "text_hash", "begin"))
        ids = pc.dictionary_encode(table["doc_id"].combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        n = len(anchor)
        new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        new_extent = new_anchor | np.concatenate(([True], extent[1:] != extent[:-1]))
        first = np.maximum.accumulate(np.where(new_extent, np.arange(n), 0))
        same = (ids == ids[first]) & (text_hash == text_hash[first]) & (begin == begin[first])
        yield from rows(table, np.flatnonzero(~same), True)
        group = np.cumsum(new_anchor) - 1
        extents = np.bincount(group[new_extent])
        extents[0] += several
        if open_too:
            at = new_extent & (extents[group] > 1)
            at[0] &= not (held and several)  # Then it has been given already.
            yield from rows(table, np.flatnonzero(at), False)
        several = bool(extents[-1] > 1)
        carried = table.slice(first[-1], 1)
    if open_too and carried is not None and not several:
        yield from rows(carried, np.zeros(1, dtype=np.int64), False)


def _settle(occurrences: DataFrame, kind: str, open_too: bool) -> DataFrame:
    """doc_id, text_hash, begin, end, anchor (null for a repeat) of what is settled or open among occurrences."""
    ordered = occurrences.select("anchor", "extent", *KEY, "begin", "end").repartitionByRange("anchor", "extent")
    ordered = ordered.sortWithinPartitions("anchor", "extent", F.asc_nulls_last("doc_id"), "text_hash", "begin")
    return ordered.mapInArrow(lambda b: _settled(b, open_too), f"doc_id {kind}, text_hash long, begin int, end int, anchor long")


def _flat(column: pa.ListArray, *fields: str) -> tuple[np.ndarray, ...]:
    """(row, fields ...) of the structs in a list column."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), lengths), *(flat.field(f).to_numpy(zero_copy_only=False) for f in fields)


def _joined_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, n_words, spans (maximal), n_removed, open (runs that still hold a word that stays)."""
    for batch in batches:
        doc, begin, end = _flat(batch.column(3), "begin", "end")
        offsets, begins, ends = merged(doc, begin.astype(np.int64), end.astype(np.int64), batch.num_rows)
        removed = np.concatenate(([0], np.cumsum(ends - begins)))[offsets]
        spans = _lists(offsets, begin=begins.astype(np.int32), end=ends.astype(np.int32))
        doc, begin, end, anchor = _flat(batch.column(4), "begin", "end", "anchor")
        far = int(max(ends.max(initial=0), end.max(initial=0))) + 1
        span_doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        before = np.searchsorted(begins + span_doc * far, begin + doc * far, side="right") - 1
        inside = np.zeros(len(doc), dtype=bool)
        inside[before >= 0] = ((span_doc[before] == doc) & (ends[before] >= end))[before >= 0] if len(ends) else False
        order = np.lexsort((begin, doc))
        order = order[~inside[order]]
        runs_left = _lists(np.searchsorted(doc[order], np.arange(batch.num_rows + 1)), begin=begin[order].astype(np.int32), end=end[order].astype(np.int32), anchor=anchor[order].astype(np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], spans, pa.array(np.diff(removed)), runs_left], [*KEY, "n_words", "spans", "n_removed", "open"])


def _gather(found: DataFrame, kind: str) -> DataFrame:
    """One row per document of found (doc_id, text_hash, n_words, spans, open): as many entries as its text has windows at most."""
    together = found.groupBy(*KEY).agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"), F.flatten(F.collect_set("open")).alias("open"))
    return together.select(*KEY, "n_words", "spans", "open").mapInArrow(
        _joined_spans, f"doc_id {kind}, text_hash long, n_words long, spans {SPANS}, n_removed long, open {RUNS}"
    )


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The windows of open runs, with those that are repeats inside the batch; earliest: what is still to be settled."""
    for batch in slices(batches, 2, BATCH):
        words = Words(texts(batch.column(2)))
        rank, _ = _ranks(batch.column(0), batch.column(1))
        doc, begin, end, anchor = _flat(batch.column(3), "begin", "end", "anchor")
        n = end.astype(np.int64) - begin - window + 1
        first = np.concatenate(([0], np.cumsum(n)))
        start = np.repeat(begin - first[:-1], n) + np.arange(first[-1])
        doc, anchor = np.repeat(doc, n), np.repeat(anchor, n)
        extent = span_hashes(words.hashes(), start + words.bounds[doc], start + words.bounds[doc] + window).view(np.int64)
        left = _earliest(anchor, extent, rank[doc], start)
        at = pa.array(doc)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(extent), batch.column(0).take(at), batch.column(1).take(at), pa.array(start.astype(np.int32)), pa.array((start + window).astype(np.int32)), pa.array(left)],
            ["anchor", "extent", *KEY, "begin", "end", "earliest"],
        )


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of texts (doc_id, text_hash, text, spans, n_removed)."""
    for batch in slices(batches, 2, BATCH):
        words = Words(texts(batch.column(2)))
        doc, begin, end = _flat(batch.column(3), "begin", "end")
        change = np.zeros(len(words.starts) + 1, dtype=np.int64)
        np.add.at(change, words.bounds[doc] + begin, 1)
        np.add.at(change, words.bounds[doc] + end, -1)
        kept = words.joined(np.cumsum(change)[:-1] == 0)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *batch.columns[3:], pa.array(kept, pa.binary()).cast(pa.string())], [*KEY, "spans", "n_removed", "kept_text"])


def _same(one: DataFrame, other: DataFrame):
    return one["doc_id"].eqNullSafe(other["doc_id"]) & (one["text_hash"] == other["text_hash"])


def deduplicate(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """doc_id, n_words, words_sha256, n_removed, spans (begin, end: removed words), kept_text for each row of docs (doc_id, text).

    words_sha256 is the digest of all words joined by one space; kept_text is null where nothing was removed.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # Where ids tell documents apart nothing else need be sent along.
    unique = named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    named = named.select("doc_id", (F.lit(0).cast("long") if unique else F.xxhash64("text")).alias("text_hash"), "text")
    signed = stored(
        named.mapInArrow(
            lambda b: _signed(b, window, k),
            f"doc_id {kind}, text_hash long, n_words long, words_sha256 string, runs array<struct<anchor: long, extent: long, begin: int, end: int>>, spans {SPANS}",
        ),
        "signed",
    )
    rows = stored(signed.drop("runs"), "rows")
    met = stored(_settle(signed.select(*KEY, F.explode("runs").alias("run")).select(*KEY, "run.*"), kind, True), "met")
    discard(spark, signed)

    span, repeat = F.struct("begin", "end"), F.col("anchor").isNull()
    no_spans, no_runs = F.array().cast(SPANS), F.array().cast(RUNS)
    no_number = F.lit(None).cast("long").alias("n_words")
    told = rows.select(*KEY, "n_words", "spans", no_runs.alias("open"))
    each = met.select(*KEY, no_number, F.when(repeat, F.array(span)).otherwise(no_spans).alias("spans"), F.when(repeat, no_runs).otherwise(F.array(F.struct("begin", "end", "anchor"))).alias("open"))
    found = stored(_gather(told.unionByName(each), kind).where("n_removed > 0 OR size(open) > 0"), "found")

    # The texts of documents with open runs, and of those that lose a part, once for all.
    touched = found.where("n_removed < n_words").select(*KEY, "open")
    candidates = maybe_in(named, touched, KEY)
    held = candidates.join(touched, _same(candidates, touched)).select(candidates["doc_id"], candidates["text_hash"], "text", "open")
    held = stored(held.dropDuplicates(KEY), "texts")
    windows = stored(
        held.where("size(open) > 0").mapInArrow(lambda b: _windows(b, window), f"anchor long, extent long, doc_id {kind}, text_hash long, begin int, end int, earliest boolean"),
        "windows",
    )
    later = _settle(windows.where("earliest"), kind, False).select(*KEY, "begin", "end").unionByName(windows.where("NOT earliest").select(*KEY, "begin", "end"))
    later = later.select(*KEY, no_number, F.array(span).alias("spans"), no_runs.alias("open"))
    sure = found.select(*KEY, "n_words", "spans", no_runs.alias("open"))
    final = stored(_gather(sure.unionByName(later), kind).where("n_removed > 0").drop("open"), "spans")
    discard(spark, met, windows)

    part = final.where("n_removed < n_words")
    parted = held.join(part, _same(held, part)).select(held["doc_id"], held["text_hash"], "text", "spans", "n_removed")
    parted = parted.mapInArrow(_left, f"doc_id {kind}, text_hash long, spans {SPANS}, n_removed long, kept_text string")
    kept = parted.unionByName(final.where("n_removed = n_words").select(*KEY, "spans", "n_removed", F.lit("").alias("kept_text")))
    out = rows.join(kept, _same(rows, kept), "left")
    return out.select(rows["doc_id"], "n_words", "words_sha256", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce(kept["spans"], no_spans).alias("spans"), "kept_text")
