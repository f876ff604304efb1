"""Web archives of Zstandard frames: one frame per record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.llm import filters
from trackside.llm.groups import attach
from trackside.llm.store import keep

#: Fixed values of the formats: number of the skippable frame that holds a dictionary, first bytes of a
#: Zstandard frame and of a Zstandard dictionary, version line and line end of a record.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = (0xFD2FB528).to_bytes(4, "little")
DICTIONARY = (0xEC30A437).to_bytes(4, "little")
VERSION, EOL = b"WARC/1.1", b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 1 << 26
#: A task's first payloads, up to so many and so many bytes of each, are what its dictionary is learnt from.
DICTIONARY_SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 1 << 13, 1 << 15
LEVEL = 3
#: Bytes that are read, hashed or compressed at once.
STEP = 1 << 16
#: At most so many tasks read archives; beyond that a task reads several, one after the other.
READERS = 50_000
#: A record's header block is no longer than this.
HEADER_BYTES = 1 << 20
_RECORDS_AT_ONCE = 1000
_PAYLOADS_AT_ONCE = 1 << 23

RECORDS = (
    "file string, record bigint, page_id bigint, record_type string, target_uri string, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, problem string"
)


# --- places ----------------------------------------------------------------

def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the store that Spark finds it in, so that Arrow finds it there too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    scheme, _, rest = uri.partition(":")
    return fs.FileSystem.from_uri(uri if rest.startswith("//") else f"{scheme}://{rest}")


# --- writing ---------------------------------------------------------------

def record_id(page_id: Column, digest: Column, row: Column | None = None) -> Column:
    """A name for a record that tells its page: a response by its payload, a revisit by its row as well."""
    parts = [F.coalesce(page_id.cast("string"), F.lit("")), digest, *([row.cast("string")] if row is not None else [])]
    return F.concat(F.lit("urn:x-page:"), F.concat_ws(":", *parts))


def _uri(text: str | None, otherwise: str) -> str:
    """A URI without blanks, controls or letters outside ASCII: these are written as %XX."""
    if not text:
        return otherwise
    return "".join(chr(b) if 0x20 < b < 0x7F and b not in b'<>"' else f"%{b:02X}" for b in text.encode())


def _head(version: bytes, fields: list[tuple[str, str]]) -> bytes:
    lines = [version, *(f"{name}: {value}".encode() for name, value in fields)]
    return EOL.join(lines) + EOL + EOL


def _head_of(row: dict, payload: bytes) -> bytes:
    """The record's header and the response header at the start of its block; the payload follows."""
    http = _head(b"HTTP/1.1 200 OK", [
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(row["payload_bytes"])),
    ])
    revisit = row["refers"] is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{row['name']}>"),
        ("WARC-Date", row["date"]),
        ("WARC-Target-URI", _uri(row["url"], row["name"])),
        ("WARC-Payload-Digest", f"sha1:{row['sha1']}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + len(payload))),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{row['refers']}>")]
    return _head(VERSION, fields) + http


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class _Archives:
    """Archives that a task writes one after the other, each under a name that no other attempt uses."""

    def __init__(self, folder: str, size: int = ARCHIVE_BYTES):
        self.store, self.folder = _store(folder)
        self.size = size
        self.store.create_dir(self.folder, recursive=True)
        self.waiting: list[tuple[bytes, bytes]] | None = []
        self.dictionary = b""
        self.out, self.written, self.records = None, 0, 0
        self.done: list[tuple[str, int, int]] = []

    def add(self, head: bytes, payload: bytes) -> None:
        if self.waiting is None:
            self._write(head, payload)
            return
        self.waiting.append((head, payload))
        if len(self.waiting) >= DICTIONARY_SAMPLES or len(payload) > STEP:
            self._start()

    def _start(self) -> None:
        """Learn the dictionary and write the records that have waited for it."""
        samples = [(head + payload)[:SAMPLE_BYTES] for head, payload in self.waiting]
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=8).as_bytes()
        except zstandard.ZstdError:
            made = b""  # too few samples, or all alike: archives may do without
        self.dictionary = made if made.startswith(DICTIONARY) else b""
        known = zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None
        self.compressor = zstandard.ZstdCompressor(LEVEL, dict_data=known, write_checksum=True)
        waiting, self.waiting = self.waiting, None
        for head, payload in waiting:
            self._write(head, payload)

    def _open(self) -> None:
        self.name = f"pages-{uuid.uuid4().hex}.warc.zst"
        # Arrow would compress a file of this name once more.
        self.out = self.store.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        self.written = self.records = 0
        if self.dictionary:
            frame = DICTIONARY_FRAME.to_bytes(4, "little") + len(self.dictionary).to_bytes(4, "little")
            self._put(frame + self.dictionary)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def _write(self, head: bytes, payload: bytes) -> None:
        if self.out is None:
            self._open()
        frame = self.compressor.compressobj(size=len(head) + len(payload) + 2 * len(EOL))
        self._put(frame.compress(head))
        for at in range(0, len(payload), STEP):
            self._put(frame.compress(payload[at : at + STEP]))
        self._put(frame.compress(EOL + EOL) + frame.flush())
        self.records += 1
        if self.written >= self.size:
            self._close()

    def _close(self) -> None:
        self.out.close()
        self.done.append((self.name, self.records, self.written))
        self.out = None

    def close(self) -> list[tuple[str, int, int]]:
        """(name, records, bytes) of all archives of the task."""
        if self.waiting:
            self._start()
        if self.out is not None:
            self._close()
        return self.done


_WRITTEN = ("page_id", "url", "html", "payload_bytes", "sha1", "name", "refers", "date")


def _verdicts(pages: DataFrame, least: int) -> DataFrame:
    """The pages as records: one response for each payload, the other rows of it as revisits without payload.

    Payloads are told apart by SHA-256. A filter of digests that may occur twice picks the rows that have
    to meet; the others pass straight through. Of the rows that meet one payload for each digest and
    task moves, and a revisit moves without its payload.
    """
    digest = F.col("digest")
    narrow = keep(pages.select("digest"), "digests")
    blocks = filters.blocks_for(narrow.count())
    marked = filters.flagged(
        pages, filters.seen_twice(narrow, "digest", blocks), digest, blocks, "__twice"
    ).withColumn("__twice", F.col("__twice") & (F.col("payload_bytes") >= least))
    alone = marked.filter("not __twice").withColumn("row", F.monotonically_increasing_id())
    name = F.when(F.col("payload_bytes") >= least, record_id(F.col("page_id"), digest)).otherwise(
        record_id(F.col("page_id"), digest, F.col("row"))
    )
    alone = alone.withColumn("name", name).withColumn("refers", F.lit(None).cast("string"))
    suspects = keep(
        marked.filter("__twice").drop("html").withColumn("row", F.monotonically_increasing_id()), "suspects"
    )
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "row", "url")).alias("first")
    groups = keep(suspects.groupBy("digest").agg(first, F.count(F.lit(1)).alias("copies")), "groups")
    bodies = marked.filter("__twice").groupBy("digest").agg(
        F.any_value("html").alias("html"), F.any_value("payload_bytes").alias("payload_bytes"),
        F.any_value("sha1").alias("sha1"), F.any_value("date").alias("date"),
    )
    firsts = bodies.join(groups, "digest").select(
        "*", F.col("first.page_id").alias("page_id"), F.col("first.url").alias("url"),
        record_id(F.col("first.page_id"), digest).alias("name"), F.lit(None).cast("string").alias("refers"),
    )
    again = attach(suspects, groups.filter("copies > 1"), "digest", "copies", suspects.count())
    again = again.filter(F.col("row") != F.col("first.row")).select(
        "*", F.lit(None).cast("string").alias("html"),
        record_id(F.col("page_id"), digest, F.col("row")).alias("name"),
        record_id(F.col("first.page_id"), digest).alias("refers"),
    )
    parts = [df.select(*_WRITTEN) for df in (alone, firsts, again)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least: int = 0, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write every row as a record and return the archives written: ``file, records, bytes``.

    The payload is the text in UTF-8, a null text an empty one. Of rows with equal payloads of at least
    ``least`` bytes that with the smallest id (null last, then the row stored first) is a response, the others are
    revisits that refer to it; smaller payloads are all responses. Ids are whole numbers, and may be null or
    repeat. A null or empty url is written as the record's own name, other urls with blanks, controls and
    letters outside ASCII as %XX. An empty table gives no archive. Other columns are not written.

    Tasks write archives under names of their own and report them in a table that Spark commits; what
    an attempt that failed has left in the folder is in no report and is never read.
    """
    folder = qualified(pages.sparkSession, path)
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    payload = F.encode(html, "UTF-8")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        html.alias("html"), F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha2(payload, 256).alias("digest"), F.sha1(payload).alias("sha1"), F.lit(date).alias("date"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, archive_bytes)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in _WRITTEN}
                row["sha1"] = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                body = b"" if row["refers"] is not None else row["html"].encode()
                archives.add(_head_of(row, body), body)
        done = archives.close()
        columns = list(zip(*done, strict=True)) if done else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{name}" for name in columns[0]], pa.string()),
             pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            ["file", "records", "bytes"],
        )

    made = _verdicts(rows, least).mapInArrow(run, "file string, records bigint, bytes bigint")
    return keep(made, "archives")


# --- reading ---------------------------------------------------------------

class Damaged(ValueError):
    """What a file holds is no archive of records, from here on."""


class _Source:
    """A file read in steps; what was read too much can be given back."""

    def __init__(self, file) -> None:
        self.file, self.back = file, b""

    def take(self, most: int = STEP) -> bytes:
        data, self.back = self.back or self.file.read(most), b""
        if len(data) > most:
            data, self.back = data[:most], data[most:]
        return data

    def exactly(self, n: int) -> bytes:
        parts, left = [], n
        while left:
            data = self.take(min(left, STEP))
            if not data:
                raise Damaged("the file ends within a frame")
            parts.append(data)
            left -= len(data)
        return b"".join(parts)

    def give_back(self, data: bytes) -> None:
        self.back = data + self.back


def read_dictionary(source: _Source) -> bytes:
    """The dictionary in the leading skippable frame, unpacked; empty if the file begins otherwise."""
    start = source.take(4)
    while 0 < len(start) < 4 and (more := source.take(4 - len(start))):
        start += more
    if start != DICTIONARY_FRAME.to_bytes(4, "little"):
        source.give_back(start)
        return b""
    data = source.exactly(int.from_bytes(source.exactly(4), "little"))
    if data.startswith(FRAME):
        try:
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        except zstandard.ZstdError as error:
            raise Damaged("the dictionary cannot be unpacked") from error
    if not data.startswith(DICTIONARY):
        raise Damaged("the leading frame holds no dictionary")
    return data


class _Frame:
    """The content of one frame, unpacked as it is read."""

    def __init__(self, source: _Source, unpacker: zstandard.ZstdDecompressor):
        self.source, self.frame, self.held = source, unpacker.decompressobj(), bytearray()

    def _fill(self) -> bool:
        if self.frame.eof:
            return False
        data = self.source.take()
        if not data:
            raise Damaged("the file ends within a frame")
        try:
            self.held += self.frame.decompress(data)
        except zstandard.ZstdError as error:
            raise Damaged("a frame cannot be unpacked") from error
        if self.frame.eof:
            self.source.give_back(self.frame.unused_data)
        return True

    def head(self) -> bytes | None:
        """Up to the empty line that ends a header, which is not part of it; none if there is no such line."""
        while (at := self.held.find(EOL + EOL)) < 0:
            if len(self.held) > HEADER_BYTES or not self._fill():
                return None
        head = bytes(self.held[:at])
        del self.held[: at + 2 * len(EOL)]
        return head

    def read(self, n: int) -> bytes:
        """Up to ``n`` bytes; fewer only where the frame ends."""
        while len(self.held) < n and self._fill():
            pass
        data = bytes(self.held[:n])
        del self.held[:n]
        return data

    def skip(self) -> int:
        """Go to the end of the frame; how many bytes that were."""
        passed = 0
        while data := self.read(STEP):
            passed += len(data)
        return passed


def _fields(head: bytes | None) -> tuple[bytes, dict[str, str]] | None:
    """First line and fields of a header; none if it is not made of such lines."""
    if head is None:
        return None
    first, *lines = head.split(EOL)
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip() or name.strip().lower().decode("latin-1") in fields:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return first, fields


def _page(name: str) -> int | None:
    """The page that a record is of, by the record's name."""
    parts = name.strip("<>").split(":")
    return int(parts[2]) if parts[:2] == ["urn", "x-page"] and parts[2].lstrip("-").isdigit() else None


NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")


def _read_record(frame: _Frame, payload: bool) -> tuple[dict, bytes | None]:
    """A frame's record, checked. ``problem`` says what is wrong with it; its frame is read to the end."""
    row: dict = dict.fromkeys(("page_id", "record_type", "target_uri", "payload_bytes", "payload_digest", "refers_to"))
    parts: list[bytes] = []

    def wrong(problem: str) -> tuple[dict, None]:
        frame.skip()
        return row | {"problem": problem}, None

    header = _fields(frame.head())
    if header is None or header[0] != VERSION:
        return wrong("no record header")
    fields = header[1]
    missing = [name for name in NEEDED if not fields.get(name)]
    if missing:
        return wrong(f"no {missing[0]}")
    row["page_id"] = _page(fields["warc-record-id"])
    row["record_type"], row["target_uri"] = fields["warc-type"], fields.get("warc-target-uri")
    row["refers_to"] = _page(fields.get("warc-refers-to", ""))
    if not fields["content-length"].isdecimal():
        return wrong("content-length is no number")
    http_head = frame.head()
    http = _fields(http_head)
    if http is None:
        return wrong("no response header")
    left = int(fields["content-length"]) - len(http_head) - 2 * len(EOL)
    sha1, size = hashlib.sha1(), 0
    while left > 0 and (data := frame.read(min(left, STEP))):
        sha1.update(data)
        size, left = size + len(data), left - len(data)
        if payload:
            parts.append(data)
    if left != 0 or frame.read(2 * len(EOL)) != EOL + EOL or frame.skip():
        return wrong("content-length is not that of the block")
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    length = http[1].get("content-length", "")
    if row["record_type"] == "revisit":
        if not said or not length.isdecimal() or size:
            return wrong("a revisit without digest and length of its payload")
        row["payload_bytes"], row["payload_digest"] = int(length), said
        return row | {"problem": None}, None
    row["payload_bytes"], row["payload_digest"] = size, base64.b32encode(sha1.digest()).decode()
    if length and length != str(size):
        return wrong("the response's length is not that of the payload")
    if said and said != row["payload_digest"]:
        return wrong("the digest is not that of the payload")
    return row | {"problem": None}, b"".join(parts) if payload else None


def read_file(file, payload: bool = False) -> Iterator[tuple[dict, bytes | None]]:
    """The records of one open archive. Where a frame is damaged the file ends, with a row that says so."""
    source = _Source(file)
    try:
        known = read_dictionary(source)
        known = zstandard.ZstdCompressionDict(known) if known else None
        unpacker = zstandard.ZstdDecompressor(dict_data=known)
        while start := source.take():
            source.give_back(start)
            yield _read_record(_Frame(source, unpacker), payload)
    except Damaged as damage:
        names = ("page_id", "record_type", "target_uri", "payload_bytes", "payload_digest", "refers_to")
        yield dict.fromkeys(names) | {"problem": str(damage)}, None


def read_archives(archives: DataFrame, payload: bool = False) -> DataFrame:
    """The records of the archives in column ``file``, a file a task: columns ``RECORDS``.

    With ``payload`` its bytes follow, null for revisits. A record that fails a check (header lines,
    needed fields, lengths of block and payload, digest, one record a frame) has its ``problem`` in
    words and what could be read of it; a frame that cannot be unpacked ends its file with such a row.
    A response's length and digest are those of the bytes read. A revisit's are
    those it was recorded with, and ``refers_to`` is the page of its response.
    """
    schema = RECORDS + (", payload binary" if payload else "")
    columns = [c.strip().split(" ")[0] for c in schema.split(",")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(c.strip().split(" ")[0], kinds[c.strip().split(" ")[1]]) for c in schema.split(",")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                store, path = _store(uri)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as file:
                    for i, (row, body) in enumerate(read_file(file, payload)):
                        rows.append(row | {"file": uri, "record": i, "payload": body})
                        held += len(body or b"")
                        if len(rows) >= _RECORDS_AT_ONCE or held >= _PAYLOADS_AT_ONCE:
                            yield pa.RecordBatch.from_pylist([{c: r[c] for c in columns} for r in rows], arrow)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([{c: r[c] for c in columns} for r in rows], arrow)

    files = archives.select("file")
    # By number: the names are too small for Spark to leave them in more than one task by itself.
    return files.repartition(max(1, min(READERS, files.count()))).mapInArrow(run, schema)
