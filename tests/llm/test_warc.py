"""Archives of frames: round trip, revisits, and what a reader says of damaged ones."""

from __future__ import annotations

import base64
import hashlib
import io
import os
from collections import defaultdict
from urllib.parse import urlparse

import pytest
import zstandard

from trackside.llm import warc

PAGES = "page_id bigint, url string, html string, payload_bytes string, digest int, name string, row int"


def expected(rows, least=0):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[(html or "").encode()].append(page)
    found = []
    for payload, pages in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        pages = sorted(pages, key=lambda p: (p is None, p or 0))
        again = pages[1:] if len(payload) >= least else []
        for page in pages[: len(pages) - len(again)]:
            found.append((page, len(payload), digest, "response", None, None))
        found += [(page, len(payload), digest, "revisit", pages[0], None) for page in again]
    return sorted(found, key=str)


ROWS = [
    (1, "http://a/ b\r\nX: y", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "", None), (4, "http://é/", ""),
    (5, "u", "é" * 300_000), (6, "u", "é" * 300_000), (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (2, "u", "<p>one</p>"),
    (None, "u", "<p>one</p>"), (None, None, "no id"), (-8, "u", "<p>one</p>"), (9, "u", "x"), (10, "v", "x"),
]


def written(spark, tmp_path, rows, name="archives", **options):
    pages = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in rows], PAGES).repartition(3)
    pages.write.parquet(str(tmp_path / f"{name}-pages"))
    pages = spark.read.schema(PAGES).parquet(str(tmp_path / f"{name}-pages"))
    return warc.write_archives(pages, str(tmp_path / name), **options)


@pytest.mark.parametrize("least", [0, 2, 11])
def test_every_page_is_read_back(spark, tmp_path, least):
    archives = written(spark, tmp_path, ROWS, least=least)
    found = warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"
    )
    assert sorted([tuple(r) for r in found.collect()], key=str) == expected(ROWS, least)


def test_payloads_and_names(spark, tmp_path):
    records = warc.read_archives(written(spark, tmp_path, ROWS), payload=True).collect()
    first = {(r["page_id"], r["payload"]) for r in records if r["record_type"] == "response"}
    assert (5, ("é" * 300_000).encode()) in first and (7, b"\r\n\r\nWARC/1.1\r\n\r\n") in first
    assert all(r["payload"] is None for r in records if r["record_type"] == "revisit")
    uris = {r["target_uri"] for r in records}
    assert "http://%C3%A9/" in uris and all(" " not in u and "\n" not in u for u in uris)


def test_a_hot_payload_and_rolling_archives(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>page {i} says {i * i} and more</p>" * 20 if i % 3 else "hot") for i in range(900)]
    archives = written(spark, tmp_path, rows, archive_bytes=20_000)
    found = warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"
    )
    assert sorted([tuple(r) for r in found.collect()], key=str) == expected(rows)
    made, with_dictionary = archives.collect(), 0
    assert len(made) > 5
    for row in made:
        with open(urlparse(row["file"]).path, "rb") as file:
            data = file.read()
        assert len(data) == row["bytes"]
        with_dictionary += data[:4] == warc.DICTIONARY_FRAME.to_bytes(4, "little")
    # Only tasks with very few records have nothing to learn from.
    assert with_dictionary > 0


def test_no_pages(spark, tmp_path):
    archives = written(spark, tmp_path, [])
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


def test_leftovers_of_failed_attempts_are_not_read(spark, tmp_path):
    archives = written(spark, tmp_path, ROWS)
    (tmp_path / "archives" / "pages-left.warc.zst").write_bytes(b"cut off")
    assert warc.read_archives(archives).count() == len(ROWS)


def frames(*records: bytes, dictionary: bytes = b"", packed: bool = False) -> bytes:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor, data = zstandard.ZstdCompressor(dict_data=known), b""
    if dictionary:
        held = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
        data = warc.DICTIONARY_FRAME.to_bytes(4, "little") + len(held).to_bytes(4, "little") + held
    return data + b"".join(compressor.compress(r) for r in records)


def record(payload: bytes = b"<p>hello</p>", length: int | None = None, tail: bytes = b"\r\n\r\n", drop: str = "",
           digest: str | None = None, http: int | None = None) -> bytes:
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % (len(payload) if http is None else http) + payload
    fields = {
        "WARC-Type": "response", "WARC-Record-ID": "<urn:x-page:4:d>", "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{digest or warc.base32_sha1(payload)}",
        "Content-Length": str(len(block) if length is None else length),
    }
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in fields.items() if k.lower() != drop)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + tail


def problems(data: bytes) -> list:
    return [row["problem"] for row, _ in warc.read_file(io.BytesIO(data))]


def learnt() -> bytes:
    return zstandard.train_dictionary(2048, [os.urandom(40) + record(os.urandom(60)) for _ in range(100)]).as_bytes()


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_frames(packed):
    assert problems(frames(record(), record(b""), dictionary=learnt(), packed=packed)) == [None, None]
    assert problems(frames(record())) == [None]
    assert problems(b"") == []


@pytest.mark.parametrize(("data", "said"), [
    (record(length=5), "content-length is not that of the block"),
    (record(length=500), "content-length is not that of the block"),
    (record(tail=b""), "content-length is not that of the block"),
    (record() + record(), "content-length is not that of the block"),
    (record(drop="warc-date"), "no warc-date"),
    (record(drop="content-length"), "no content-length"),
    (record(digest="A" * 32), "the digest is not that of the payload"),
    (record(http=3), "the response's length is not that of the payload"),
    (b"no record", "no record header"),
    (b"", "no record header"),
    (record().replace(b"WARC/1.1", b"WARC/9.9"), "no record header"),
])
def test_a_bad_record_is_named_and_the_next_is_read(data, said):
    assert problems(frames(data, record())) == [said, None]


def test_damaged_files():
    whole = frames(record(os.urandom(500)), record(os.urandom(500)))
    assert problems(whole[:-200]) == [None, "the file ends within a frame"]
    assert problems(whole + b"rubbish")[:2] == [None, None] and problems(whole + b"rubbish")[2]
    held = frames(record(), dictionary=learnt())
    assert problems(held[:100]) == ["the file ends within a frame"]
    wrong = warc.DICTIONARY_FRAME.to_bytes(4, "little") + (4).to_bytes(4, "little") + b"none"
    assert problems(wrong + frames(record())) == ["the leading frame holds no dictionary"]
