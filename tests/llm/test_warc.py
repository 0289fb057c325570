import base64
import hashlib
import struct

import pytest
import zstandard

from tickloom.llm import warc
from tickloom.llm.common import work_path

PAGES = "page_id long, url string, html string, digest string, key string"
LONG = "<p>" + "word " * 300


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3)


def test_round_trip_and_revisits(spark):
    pages = [(1, "http://a.b/c d\r\n", LONG), (2, None, LONG), (3, "u", LONG), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", LONG), (8, "u", "é" * 500), (9, "u", "é" * 500), (3, "again", LONG)]
    found = warc.archive_pages(spark, rows_of(spark, pages)).collect()
    expected = []
    for page, _, html in pages:
        data = (html or "").encode()
        same = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        refers = max(same) if len(data) >= 1000 and page != max(same) else None
        expected.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers, None))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_empty_table(spark):
    assert warc.archive_pages(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_are_plain_zstandard_with_a_dictionary_first(spark):
    path = work_path(spark, "plain")
    warc.write_warc(rows_of(spark, [(i, "u", f"<p>page {i} {'text ' * (i % 40)}") for i in range(60)]).coalesce(1), path)
    (data,) = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    whole = zstandard.ZstdDecompressor(dict_data=trained).decompressobj(read_across_frames=True).decompress(data[8 + size :])
    assert whole.count(b"WARC/1.1\r\n") == 60
    frames = list(warc.split_frames(data))
    assert len(frames) == 60 and b"".join(f[1] for f in frames) == whole
    assert [f[2] for f in warc.split_frames(data[:-20])][-1] is not None


def test_payloads_and_headers_come_back(spark):
    path = work_path(spark, "payloads")
    warc.write_warc(rows_of(spark, [(1, "http://a/b", "ünï"), (2, None, None)]), path)
    got = {r.record_id: r for r in warc.read_warc(spark, path).collect()}
    assert bytes(got["urn:page:1"].payload).decode() == "ünï" and got["urn:page:1"].target_uri == "http://a/b"
    assert bytes(got["urn:page:2"].payload) == b"" and got["urn:page:2"].target_uri is None
    assert all(r.error is None for r in got.values())


def record(**changes):
    payload = b"abc"
    head = {"WARC-Type": "response", "WARC-Record-ID": "<urn:page:1>", "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Payload-Digest": "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode(), "Content-Length": "3"}
    head |= {k.replace("_", "-"): v for k, v in changes.items()}
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items() if v is not None) + b"\r\n" + payload + b"\r\n\r\n"


@pytest.mark.parametrize(
    "data, error",
    [
        (record(), None),
        (record(Content_Length="4"), "record and Content-Length differ"),
        (record(Content_Length="x"), "bad Content-Length"),
        (record(WARC_Date=None), "no warc-date"),
        (record(WARC_Payload_Digest="sha1:" + "0" * 40), "payload and digest differ"),
        (record(WARC_Type="revisit", WARC_Payload_Digest=None), "revisit without digest or reference"),
        (b"WARC/9\r\n\r\n", "no WARC header"),
        (record()[:-2], "record and Content-Length differ"),
        (record().replace(b"WARC-Type: ", b"WARC-Type "), "bad header line"),
    ],
)
def test_records_are_validated(data, error):
    assert warc.parse_record(data)["error"] == error


@pytest.mark.parametrize("data", [b"\x5d\x2a\x4d\x18\xff\0\0\0ab", b"garbage that is long", b"abc", b"\x28\xb5\x2f\xfd\0\0\0\0\0"])
def test_broken_archives_tell(data):
    assert list(warc.split_frames(data))[-1][2] is not None
