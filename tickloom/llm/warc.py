"""Zstandard WARC archives: writing and reading .warc.zst with a dictionary.

An archive starts with its dictionary in a skippable frame (magic 0x184D2A5D) and holds one
Zstandard frame per record. Archives are written by Spark's own text writer, whose commit
protocol makes lost tasks harmless on any file system: a row is the bytes of a frame, and the
"line separator" is an empty skippable frame, which every Zstandard reader passes over.

Defined results: a null url leaves the header out; a null html is an empty payload; a null
page_id is smaller than any other and comes back as null; rows repeated with the largest
page_id of their payload are all responses; an empty table gives no archive and no rows. Extra
columns are ignored. Broken frames, headers, lengths or digests come back as rows with `error`.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import slices, texts, work_path

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
EMPTY_FRAME = "P*M\x18\0\0\0\0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

ID_PREFIX = "urn:page:"
RECORD_SCHEMA = (
    "archive string, frame_offset long, record_type string, record_id string, refers_to string, target_uri string, "
    "content_length long, payload_bytes long, payload_digest string, payload binary, error string"
)
#: Bounds for training an archive's dictionary: records, bytes, size of the dictionary.
DICT_RECORDS, DICT_SAMPLE_BYTES, DICT_BYTES = 400, 1 << 21, 1 << 15


def mark_revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """page_id, url, html, digest (hex), refers_to: the largest page_id with the payload, null for a response.

    Only (digest, largest id) pairs are grouped, pre-aggregated in each task. The join runs on the
    digest with nothing gathered per key, so a payload that fills a third of the table is split by
    skew-join handling; short payloads get a key of their own row and meet nothing.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= least_bytes
    newest = rows.where(large).groupBy(F.col("digest").alias("key")).agg(F.max("page_id").alias("newest"))
    keyed = rows.withColumn("key", F.when(large, F.col("digest")).otherwise(F.concat(F.lit("page "), F.coalesce(F.col("page_id").cast("string"), F.col("url"), F.lit("")))))
    refers = F.when(~F.col("newest").eqNullSafe(F.col("page_id")), F.col("newest"))
    return keyed.join(newest, "key", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _train(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    sample, size = [], 0
    for r in records[:DICT_RECORDS]:
        if size + len(r) <= DICT_SAMPLE_BYTES:
            sample.append(r)
            size += len(r)
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, size // 10)), sample) if len(sample) > 7 else None
    except zstandard.ZstdError:  # too little material
        return None


def _frames(batches: Iterator[pa.RecordBatch], date: str, level: int) -> Iterator[pa.RecordBatch]:
    packer = None
    for batch in slices(batches, 2):
        html = batch.column(2)
        records = [
            _record(p, u, h.encode(), d, r, date)
            for p, u, h, d, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), html.to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())
        ]
        frames = []
        if packer is None:
            trained = _train(records)
            if trained is not None:
                raw = zstandard.ZstdCompressor(level=level).compress(trained.as_bytes())
                frames.append(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
            packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
        frames += map(packer.compress, records)
        yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 1000, level: int = 3) -> None:
    """Writes one record per row of pages (page_id, url, html): an archive per task, each with a dictionary of its own."""
    frames = mark_revisits(pages, least_bytes).mapInArrow(lambda b: _frames(b, date, level), "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(path)


def split_frames(data: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(offset, content, error) of every frame; a broken frame ends the archive, as its end is unknown."""
    at, trained = 0, None
    while at < len(data):
        if len(data) - at < 8:
            yield at, None, "trailing bytes"
            return
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(data):
                yield at, None, "skippable frame is cut off"
                return
            if magic == DICTIONARY_MAGIC and at == 0:
                raw = data[8 : 8 + size]
                try:
                    raw = zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == FRAME_MAGIC else raw
                    trained = zstandard.ZstdCompressionDict(raw)
                except zstandard.ZstdError as e:
                    yield at, None, f"dictionary: {e}"
                    return
            at += 8 + size
            continue
        reader = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
        parts, pos = [], at
        try:
            while not reader.eof and pos < len(data):
                parts.append(reader.decompress(data[pos : pos + 65536]))
                pos = min(pos + 65536, len(data))
        except zstandard.ZstdError as e:
            yield at, None, f"frame: {e}"
            return
        if not reader.eof:
            yield at, None, "frame is cut off"
            return
        yield at, b"".join(parts), None
        at = pos - len(reader.unused_data)


def parse_record(record: bytes) -> dict:
    """The fields of RECORD_SCHEMA but archive and frame_offset; `error` tells what doesn't hold."""
    out: dict = dict.fromkeys(("record_type", "record_id", "refers_to", "target_uri", "content_length", "payload_bytes", "payload_digest", "payload", "error"))
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        return out | {"error": "no WARC header"}
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            return out | {"error": "bad header line"}
        fields.setdefault(name.strip().decode("utf-8", "replace").lower(), value.strip().decode("utf-8", "replace"))
    if missing := [x for x in REQUIRED if x not in fields]:
        return out | {"error": f"no {', '.join(missing)}"}
    out |= {"record_type": fields["warc-type"], "record_id": fields["warc-record-id"].strip("<>"), "target_uri": fields.get("warc-target-uri"), "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None}
    if not re.fullmatch(r"[0-9]+", fields["content-length"]):
        return out | {"error": "bad Content-Length"}
    out["content_length"] = size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        return out | {"error": "record and Content-Length differ"}
    block, http = rest[:size], {}
    if fields.get("content-type", "").startswith("application/http"):
        top, gap, block = block.partition(b"\r\n\r\n")
        if not gap:
            return out | {"error": "no end of the HTTP header"}
        http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in top.split(b"\r\n")[1:])}
    told = re.fullmatch(r"sha1:(?:([A-Z2-7]{32})|([0-9a-fA-F]{40}))", fields.get("warc-payload-digest", ""))
    digest = (base64.b32decode(told[1]).hex() if told[1] else told[2].lower()) if told else None
    length = http.get(b"content-length", b"")
    length = int(length) if re.fullmatch(rb"[0-9]+", length) else None
    if out["record_type"] == "revisit":
        if digest is None or not out["refers_to"]:
            return out | {"error": "revisit without digest or reference"}
        return out | {"payload_bytes": length, "payload_digest": digest}
    found = hashlib.sha1(block).hexdigest()
    out |= {"payload_bytes": len(block), "payload_digest": found, "payload": block}
    if length is not None and length != len(block):
        return out | {"error": "payload and HTTP Content-Length differ"}
    return out | ({"error": "payload and digest differ"} if digest not in (None, found) else {})


def _records(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    types = {"frame_offset": pa.int64(), "content_length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]

    def packed(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names)

    for batch in batches:
        for path, data in zip(batch.column(0), batch.column(1)):
            rows, held, path = [], 0, path.as_py()
            for offset, content, error in split_frames(data.as_py()):
                row = parse_record(content) if error is None else dict.fromkeys(names) | {"error": error}
                held += len(row["payload"] or b"") if payloads else 0
                rows.append(row | {"archive": path, "frame_offset": offset} | ({} if payloads else {"payload": None}))
                if held > 1 << 22 or len(rows) >= 4096:
                    yield packed(rows)
                    rows, held = [], 0
            if rows:
                yield packed(rows)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below path, RECORD_SCHEMA; an archive is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lambda b: _records(b, payloads), RECORD_SCHEMA)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes pages to archives in the shared folder and reads them back.

    page_id, payload_bytes, payload_digest, record_type, refers_to, error (null if the record is sound).
    """
    path = work_path(spark, "warc")
    write_warc(pages, path)
    page = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("long")
    return read_warc(spark, path, payloads=False).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"), "error"
    )
