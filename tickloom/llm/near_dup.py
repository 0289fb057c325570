"""Near-duplicates by DartMinHash signatures and banded joining.

A document is the weighted set of its runs of five words. Darts are thrown at the plane of weight
and rank over each element, from hashes of the element alone, one per unit of area on average: an
element's weight is cut into the strips [0, 1), [1, 2), [2, 4) ..., and the darts of a strip come
by rank with exponential gaps. A dart under the element's weight counts; it belongs to one of the
signature's coordinates, and each coordinate keeps its earliest dart. Only darts up to a rank are
thrown at all, so that about k (ln k + 2) fall on a document, however many elements it has; if a
coordinate got none, the rank is doubled. Two sets agree on a coordinate with the probability of
their weighted Jaccard similarity.

Texts with equal sets are one class from the start and appear once from then on. `BANDS` bands of
`ROWS` coordinates join them: at similarity 0.8 a link goes unseen with probability 7e-5, above it
with less. Nothing is gathered per bucket. A text is first compared with the text it shares most
buckets with among their first members, and links are joined to components. Texts of buckets
that still hold several components go on: the rarest runs of each, as many as a text at the
threshold cannot do without (1 - similarity of them, and one), are the next buckets, so that texts
which only share a common passage part. Small buckets are compared in full (at most `SMALL`
members each), of larger ones some members are compared with all others and leave, round after
round, until every bucket is of one component. Each compared pair is decided by its exact similarity.

Defined results: a text of fewer than five words is one run of all its words; a text without
words, or null, is a class of its own; repeated rows and equal texts with different ids are one
class; the class id is the least doc_id of the class (nulls last); an empty table gives no
rows. Extra columns are ignored; those of clashing names too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import bitmap, discard, map_arrow, slices, stored, texts, work_path
from tickloom.llm.components import components
from tickloom.llm.words import BASE, mix, shingles, word_hashes

RUN, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
#: Members up to which a bucket is compared in full; members of larger ones compared in the first
#: round, and how many times more in each later one, when most members share a component.
SMALL, CENTERS, MORE = 64, 16, 8
#: Members of a large bucket that meet its centers in one task, about.
DEALT = 512
#: Bytes that go to Python at once where pairs of sets are compared; an executor holds a batch several times outside its heap.
PAIR_BYTES = 1 << 21
#: Bits of the map of keys whose sets are made: 16 MB at most.
MOST_BITS = 1 << 27

STEP = np.uint64(0xD1B54A32D192ED03)


def weighted_set(hashes: np.ndarray, run: int, counted: bool) -> tuple[np.ndarray, np.ndarray]:
    """(elements in order, weights): 1 each, or how often a run occurs."""
    if len(hashes) == 0:
        return hashes, np.zeros(0)
    found, n = np.unique(shingles(hashes, min(run, len(hashes))), return_counts=True)
    return found, n.astype(np.float64) if counted else np.ones(len(found))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """k coordinates for each non-empty weighted set: the names of the earliest darts."""
    out = np.zeros((len(sets), k), dtype=np.uint64)
    upto = np.array([(np.log(k) + 2) * k / w.sum() for _, w in sets])
    todo = np.arange(len(sets))
    while len(todo):
        element = np.concatenate([sets[i][0] for i in todo])
        weight = np.concatenate([sets[i][1] for i in todo])
        doc = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        first = np.full(len(todo) * k, np.inf)
        names = np.zeros(len(todo) * k, dtype=np.uint64)
        low, width, strip = 0.0, 1.0, 0
        while len(element):
            key = mix(element + np.array([strip + 1], dtype=np.uint64) * STEP)
            rank, limit, d, w = np.zeros(len(key)), upto[todo][doc], doc, weight
            darts = []
            while len(key):
                key = mix(key + STEP)
                rank = rank - np.log(_uniform(key)) / width
                alive = rank <= limit
                key, rank, limit, d, w = key[alive], rank[alive], limit[alive], d[alive], w[alive]
                place = mix(key ^ STEP)
                under = slice(None) if strip == 0 and (w >= 1).all() else low + width * _uniform(place) < w
                darts.append((key[under], rank[under], d[under] * k + (mix(place)[under] % np.uint64(k)).astype(np.int64)))
            name, rank, at = (np.concatenate(x) for x in zip(*darts))
            np.minimum.at(first, at, rank)
            best = rank == first[at]
            names[at[best]] = name[best]
            low, width, strip = (1.0, 1.0, 1) if strip == 0 else (low + width, width * 2, strip + 1)
            more = weight > low
            element, weight, doc = element[more], weight[more], doc[more]
        full = np.isfinite(first).reshape(-1, k).all(axis=1)
        out[todo[full]] = names.reshape(-1, k)[full]
        todo = todo[~full]
        upto[todo] *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.tile(np.arange(bands, dtype=np.uint64), (len(signature), 1))
    for i in range(rows):
        key = mix(key * np.uint64(BASE) + signature[:, i::rows][:, :bands])
    return key.view(np.int64)


def _key(elements: np.ndarray, weights: np.ndarray, counted: bool) -> bytes:
    return hashlib.blake2b(elements.tobytes() + (weights.tobytes() if counted else b""), digest_size=16).digest()


def _sign(batches: Iterator[pa.RecordBatch], run: int, bands: int, rows: int, counted: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2, 1 << 21):
        bounds, hashes = word_hashes(texts(batch.column(2)))
        sets = [weighted_set(hashes[a:b], run, counted) for a, b in zip(bounds[:-1], bounds[1:])]
        keys = [_key(*s, counted) if len(s[0]) else None for s in sets]
        places: dict[bytes, int] = {}
        for i, key in enumerate(keys):
            if key is not None:
                places.setdefault(key, i)
        found = dict(zip(places, band_keys(signatures([sets[i] for i in places.values()], bands * rows), bands, rows)))
        columns = [pa.array(keys, pa.binary()), pa.array([float(s[1].sum()) for s in sets]), pa.array([found.get(key) for key in keys], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "text_hash", "key", "weight", "bands"])


def _sets(batches: Iterator[pa.RecordBatch], run: int, counted: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1, 1 << 21):
        bounds, hashes = word_hashes(texts(batch.column(1)))
        sets = [weighted_set(hashes[a:b], run, counted) for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([s[0].tobytes() for s in sets], pa.binary()), pa.array([s[1].astype(np.float32).tobytes() if counted else b"" for s in sets], pa.binary())],
            ["key", "elements", "weights"],
        )


def similarity(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> float:
    """Sum of the smaller weights by the sum of the larger ones; of two empty sets 0. Elements in order."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    least = np.minimum(wa[i], wb[j]).sum()
    both = wa.sum() + wb.sum() - least
    return float(least / both) if both else 0.0


def _decide(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    def read(batch, side: str, i: int):
        elements = np.frombuffer(batch.column(f"elements_{side}")[i].as_buffer(), dtype=np.uint64)
        weights = np.frombuffer(batch.column(f"weights_{side}")[i].as_buffer(), dtype=np.float32).astype(np.float64)
        return elements, weights if len(weights) else np.ones(len(elements))

    for batch in batches:
        found = []
        for i in range(batch.num_rows):
            (a, wa), (b, wb) = read(batch, "a", i), read(batch, "b", i)
            found.append(similarity(a, b, wa, wb) >= least)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.bool_())], ["a", "b", "linked"])


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits set for the keys (a column key), MOST_BITS at most."""
    bits = min(MOST_BITS, max(1 << 20, 1 << (16 * keys.count()).bit_length()))
    return bitmap(keys.select(F.pmod(F.xxhash64("key"), F.lit(bits)).alias("place")), bits)


def _known(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = batch.column(0).to_numpy()
        hit = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        yield batch.filter(pa.array(hit))


def _sets_of(named: DataFrame, signed: DataFrame, members: DataFrame, run: int, counted: bool) -> DataFrame:
    """key, elements, weights of every key of members, from one text each."""
    wanted = members.select("key").distinct()
    place = F.xxhash64("doc_id", "text_hash")
    texts_of = signed.join(wanted, "key", "left_semi").groupBy("key").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"))
    texts_of = stored(texts_of.select(F.col("key").alias("set_key"), F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash")), "set-texts")
    bits = _bitmap(texts_of.select(F.xxhash64("rep_id", "rep_hash").alias("key")))
    shared, size = named.sparkSession.sparkContext.broadcast(bits), len(bits) * 8
    # The map keeps most other texts out of the shuffle; what it lets through wrongly goes at the join.
    found = named.withColumn("place", F.pmod(F.xxhash64(place), F.lit(size)))
    kind = found.select("place", "doc_id", "text_hash", "text").schema["doc_id"].dataType.simpleString()
    passed = map_arrow(found.select("place", "doc_id", "text_hash", "text"), lambda b: _known(b, shared.value), f"place long, doc_id {kind}, text_hash long, text string")
    same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash"))
    chosen = passed.join(texts_of, same).select(F.col("set_key").alias("key"), "text").dropDuplicates(["key"])
    return stored(map_arrow(chosen, lambda b: _sets(b, run, counted), "key binary, elements binary, weights binary"), "sets")


def _decide_pairs(pairs: DataFrame, sets: DataFrame, least: float, path: str) -> DataFrame:
    """Adds a, b, linked of pairs (a, b) to the table at path, and gives all of its rows."""
    side = lambda x: sets.select(F.col("key").alias(x), F.col("elements").alias(f"elements_{x}"), F.col("weights").alias(f"weights_{x}"))
    decided = map_arrow(pairs.join(side("a"), "a").join(side("b"), "b"), lambda b: _decide(b, least), "a binary, b binary, linked boolean")
    decided.write.mode("append").parquet(path)
    return sets.sparkSession.read.schema("a binary, b binary, linked boolean").parquet(path)


def _pair(one: str, other: str):
    return F.least(one, other).alias("a"), F.greatest(one, other).alias("b")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, elements in zip(batch.column(0), batch.column(1)):
            found = np.frombuffer(elements.as_buffer(), dtype=np.int64)
            for i in range(0, len(found), 1 << 16):
                part = found[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(part), pa.binary()), pa.array(part)], ["key", "run"])


def _rare_runs(keys: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """band (a run), key, weight, left (runs from this on): the first runs of each of keys (key, weight), by how many of them have a run, then by its hash.

    If the similarity of two sets is `least` or more, they share one of their first
    (1 - least) * n + 1 runs in any common order. Runs that one key alone has come first and join nothing.
    """
    exploded = stored(map_arrow(keys.join(sets, "key").select("key", "elements"), _runs, "key binary, run long"), "runs")
    common = exploded.groupBy("run").agg(F.count("*").alias("n")).where("n > 1")
    size = sets.select("key", F.floor(F.octet_length("elements") / 8).alias("size"))
    held = exploded.join(common, "run").join(keys, "key").join(size, "key")
    mine = Window.partitionBy("key")
    placed = held.withColumns({"nr": F.row_number().over(mine.orderBy("n", "run")), "known": F.count("*").over(mine)})
    first = placed.where(F.col("size") - F.col("known") + F.col("nr") <= F.floor((1 - least) * F.col("size") + 1e-9) + 1)
    return first.select(F.col("run").alias("band"), "key", "weight", (F.col("known") - F.col("nr") + 1).alias("left"))


def _others(members: DataFrame, *by: str) -> DataFrame:
    """Members as the second ones of pairs, by band and `by`."""
    return members.select("band", *by, *[F.col(c).alias(f"{c}2") for c in ("key", "weight", "component", "left")])


def _links(members: DataFrame, sets: DataFrame, least: float, counted: bool) -> DataFrame:
    """key, component of the keys with links. members: band, key, weight, center, center_weight."""
    spark, path = members.sparkSession, work_path(members.sparkSession, "decided")
    alike = lambda x, y: F.least(x, y) >= least * F.greatest(x, y)  # noqa: E731  else no similarity can be enough
    first = members.where((F.col("key") != F.col("center")) & alike("weight", "center_weight")).groupBy("key", "center").agg(F.count("*").alias("n"))
    first = first.groupBy("key").agg(F.max_by("center", F.struct("n", "center")).alias("center"))
    decided = _decide_pairs(first.select(*_pair("key", "center")).distinct(), sets, least, path)
    members, n_links, found, rare, turn = members.select("band", "key", "weight", F.col("weight").alias("left")), -1, None, False, 0
    while True:
        told = decided.where("linked").count()
        if told != n_links:  # else the components are still the same
            n_links, found = told, stored(components(decided.where("linked"), told).select(F.col("node").alias("key"), "component"), "components")
        placed = members.join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
        mixed = placed.groupBy("band").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
        live = stored(placed.join(mixed.select("band", "n"), "band"), "live")
        if live.isEmpty():
            return found
        if not rare and not counted:
            rare, members = True, stored(_rare_runs(live.select("key", "weight").distinct(), sets, least), "rare-runs")
            continue
        # Two sets that first meet at a run share no more than what is left of either from there on.
        enough = F.least("left", "left2") >= least / (1 + least) * (F.col("weight") + F.col("weight2")) - 1e-6
        open_pair = (F.col("component") != F.col("component2")) & alike("weight", "weight2") & enough
        small, large = live.where(F.col("n") <= SMALL), live.where(F.col("n") > SMALL)
        centers = stored(large.withColumn("nr", F.row_number().over(Window.partitionBy("band").orderBy("key"))).where(F.col("nr") <= CENTERS * MORE**turn).drop("nr"), "centers")
        pairs = small.join(_others(small), "band").where(open_pair & (F.col("key") < F.col("key2"))).select("key", "key2")
        # The members of a very large bucket are dealt over several tasks, each of which gets the bucket's centers.
        parts = F.ceil(F.col("n") / DEALT)
        dealt = large.withColumn("deal", F.pmod(F.xxhash64("key"), parts))
        each = centers.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        each = _others(each, "deal")
        pairs = pairs.unionByName(dealt.join(each, ["band", "deal"]).where(open_pair).select(*pairs.columns)).select(*_pair("key", "key2")).distinct()
        decided = _decide_pairs(stored(pairs.join(decided, ["a", "b"], "left_anti"), "pairs"), sets, least, path)
        members = stored(large.join(centers, ["band", "key"], "left_anti").select("band", "key", "weight", "left"), "members")
        discard(spark, live, centers)
        turn = min(turn + 1, 2)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Limits the bytes of a batch that goes to Python while the pairs are decided, which is done inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(PAIR_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def classes(docs: DataFrame, run: int = RUN, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, weights: str = "set") -> DataFrame:
    """doc_id, text_hash, class_id, class_size, kept (the first of its class) for every row of docs (doc_id, text).

    weights: "set" (each run of words counts 1) or "count" (as often as it occurs). text_hash is xxhash64
    of the text; rows with equal doc_id and text are kept or not kept alike.
    """
    counted, text = weights == "count", F.col("text").cast("string")
    named = docs.select("doc_id", text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    kind = named.schema["doc_id"].dataType.simpleString()
    signed = stored(
        map_arrow(named.select("doc_id", "text_hash", "text"), lambda b: _sign(b, run, bands, rows, counted), f"doc_id {kind}, text_hash long, key binary, weight double, bands array<long>"),
        "signatures",
    )
    # Weight and bands are the same for all rows of a key.
    unique = signed.where("key IS NOT NULL").groupBy("key").agg(F.first("weight").alias("weight"), F.first("bands").alias("bands"))
    banded = unique.select("key", "weight", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n"), F.min(F.struct("key", "weight")).alias("c")).where("n > 1")
    members = stored(banded.join(shared, "band").select("band", "key", "weight", F.col("c.key").alias("center"), F.col("c.weight").alias("center_weight")), "members")
    sets = _sets_of(named, signed, members, run, counted)
    with _small_batches(docs.sparkSession):
        found = _links(members, sets, least, counted)
    own = F.coalesce(F.hex("component"), F.hex("key"), F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")))
    placed = stored(signed.drop("bands").join(found, "key", "left").select("doc_id", "text_hash", own.alias("class")), "placed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    sizes = placed.groupBy("class").agg(F.count("*").alias("class_size"), F.min(order).alias("first"))
    rows_of = placed.join(sizes, "class").select("doc_id", "text_hash", F.col("first.doc_id").alias("class_id"), "class_size", order.eqNullSafe(F.col("first")).alias("kept"))
    discard(docs.sparkSession, members, sets)
    return rows_of


def deduplicate(docs: DataFrame, **settings) -> DataFrame:
    """One row of docs of each class, with all its columns."""
    first = classes(docs, **settings).where("kept").select(F.col("doc_id").alias("first_id"), F.col("text_hash").alias("first_hash")).distinct()
    # The row as a whole, so that no column of docs can clash with those of the join.
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col("doc_id").alias("own_id"), F.xxhash64(F.col("text").cast("string")).alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("first_id")) & (F.col("own_hash") == F.col("first_hash"))
    return own.join(first, same, "left_semi").dropDuplicates(["own_id", "own_hash"]).select("whole.*")
