"""WARC records in ZIP-packaged archives: written by tasks, read back by ranges without extraction.

An archive is a ZIP file with stored members: ``archive/data.warc.gz``, one gzip member per WARC record, and
``indexes/index.cdxj``, a sorted line per record: the turned host and path, the date, and as JSON its offset and length in
the first. Readers parse the end of central
directory (with its ZIP64 forms), the central directory and the members' local headers, then fetch each record's bytes
alone. Archives are written to the shared folder under a name of their own per attempt; only those that the finished
job has listed are read, so a repeated task leaves at most an unlisted file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import map_texts, small_batches
from tidemark.operators.joins import spread_join
from tidemark.session import shared_dir, stage

DATA = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
#: An archive is closed when its data has so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Records within so many bytes of each other are fetched together.
NEAR_BYTES = 1 << 20
#: A task reads about so many bytes of records.
TASK_BYTES = 4 << 20
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 0
LIMIT32 = 0xFFFFFFFF

# Signatures and layouts of the ZIP format: fixed values.
LOCAL = "<4sHHHHHLLLHH"
CENTRAL = "<4sHHHHHHLLLHHHHHLL"
END = "<4sHHHHLLH"
END64 = "<4sQHHLLQQQQ"
LOCATOR64 = "<4sLQL"
LOCAL_SIGN, CENTRAL_SIGN, END_SIGN, END64_SIGN, LOCATOR64_SIGN = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


#: Characters of a URL that stay as they are: all visible ones of ASCII.
VISIBLE = "".join(map(chr, range(33, 127)))


def target_uri(page_id: int | None, url: str | None) -> str:
    """The URL with all but visible ASCII percent-encoded as UTF-8; a name of its own for a page without one."""
    return quote(url, safe=VISIBLE, errors="replace") if url else f"urn:page:{page_id}"


def record_id(page_id: int | None, digest: str, *more: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, (page_id, digest, *more))))}>"


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, date: str) -> bytes:
    """A WARC record as one gzip member. A revisit keeps the payload's length and digest but not the payload.

    A response is named by its page and digest, so that revisits can refer to it; pages of equal id and payload share a name.
    """
    digest = digest32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if kind == "response" else b"")
    again = kind == "revisit"
    names = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(page_id, digest, kind, url) if again else record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": target_uri(page_id, url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{digest32(body)}",
        "WARC-Refers-To": record_id(refers_to, digest) if again else None,
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if again else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(body),
        # Extension fields: the ids of the pages.
        "WARC-Page-Id": page_id,
        "WARC-Refers-To-Page-Id": refers_to,
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in names.items() if v is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + body + b"\r\n\r\n") + packer.flush()


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by lower-cased name; white space around a value does not count."""
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def parse_record(raw: bytes) -> dict:
    """Headers of a record by lower-cased name (``http`` for those of the message) and its payload; the length must be
    as stated."""
    plain = zlib.decompress(raw, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = _fields(lines[1:])
    body = rest[: int(headers["content-length"])]
    if not lines[0].startswith("WARC/") or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = body.partition(b"\r\n\r\n")
    return headers | {"http": _fields(http.decode().split("\r\n")[1:]), "payload": payload}


def sort_key(uri: str) -> str:
    """The host's names from the last to the first, then the rest, lower-cased: ``com,example)/path``."""
    _, found, rest = uri.partition("://")
    if not found:
        return uri.lower()
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = rest[:end].rpartition("@")[2].lower()
    name, _, port = host.partition(":")
    turned = ",".join(reversed(name.split("."))) + (f":{port}" if port not in ("", "80", "443") else "")
    return f"{turned}){rest[end:].partition('#')[0].lower() or '/'}"


def index_line(uri: str, date: str, entry: dict) -> str:
    return f"{sort_key(uri)} {''.join(c for c in date if c.isdigit())} {json.dumps(entry)}"


class ZipWriter:
    """Stored members one after the other; ZIP64 fields where a size, an offset or the count needs them."""

    def __init__(self, out, limit: int = LIMIT32):
        self.out, self.limit, self.at, self.members = out, limit, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _field(self, *values: int) -> int:
        """The mark for a ZIP64 field if one of the values needs it, else 0."""
        return LIMIT32 if any(v >= self.limit for v in values) else 0

    def add(self, name: str, parts: list[bytes]) -> int:
        """Writes a member and returns the offset of its first byte."""
        size, crc, start = sum(map(len, parts)), 0, self.at
        for p in parts:
            crc = zlib.crc32(p, crc)
        extra = struct.pack("<HHQQ", 1, 16, size, size) if self._field(size) else b""
        size32 = LIMIT32 if extra else size
        self._put(struct.pack(LOCAL, LOCAL_SIGN, 45, 0x800, 0, 0, 33, crc, size32, size32, len(name), len(extra)) + name.encode() + extra)
        first = self.at
        for p in parts:
            self._put(p)
        self.members.append((name, crc, size, start))
        return first

    def close(self) -> None:
        directory = self.at
        for name, crc, size, start in self.members:
            wide = [v for v in (size, size, start) if self._field(v)]
            extra = struct.pack(f"<HH{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            size32, start32 = self._field(size) or size, self._field(start) or start
            self._put(struct.pack(CENTRAL, CENTRAL_SIGN, 45, 45, 0x800, 0, 0, 33, crc, size32, size32, len(name), len(extra), 0, 0, 0, 0, start32) + name.encode() + extra)
        length, count, end = self.at - directory, len(self.members), self.at
        if self._field(directory, length) or count >= 0xFFFF:
            self._put(struct.pack(END64, END64_SIGN, 44, 45, 45, 0, 0, count, count, length, directory))
            self._put(struct.pack(LOCATOR64, LOCATOR64_SIGN, 0, end, 1))
            self._put(struct.pack(END, END_SIGN, 0, 0, 0xFFFF, 0xFFFF, LIMIT32, LIMIT32, 0))
        else:
            self._put(struct.pack(END, END_SIGN, 0, 0, count, count, length, directory, 0))


@dataclass(frozen=True)
class Member:
    name: str
    crc: int
    offset: int
    size: int


def members(file, size: int) -> list[Member]:
    """Stored members of a ZIP file by its central directory, with the offset of their first byte.

    Only the end of the file, the directory and each member's local header are read. Compressed or encrypted members
    have no ranges to read and are refused.
    """

    def at(offset: int, n: int) -> bytes:
        file.seek(offset)
        return file.read(n)

    tail_at = max(size - struct.calcsize(END) - 0xFFFF, 0)
    tail = at(tail_at, size - tail_at)
    place = tail.rfind(END_SIGN, 0, max(len(tail) - struct.calcsize(END) + len(END_SIGN), 0))
    while place >= 0 and place + struct.calcsize(END) + struct.unpack_from(END, tail, place)[7] != len(tail):
        place = tail.rfind(END_SIGN, 0, place)
    if place < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    _, _, _, _, count, length, directory, _ = struct.unpack_from(END, tail, place)
    if count == 0xFFFF or LIMIT32 in (length, directory):
        sign, _, end64, _ = struct.unpack(LOCATOR64, at(tail_at + place - struct.calcsize(LOCATOR64), struct.calcsize(LOCATOR64)))
        if sign != LOCATOR64_SIGN:
            raise ValueError("no ZIP64 locator")
        sign, *_, count, length, directory = struct.unpack(END64, at(end64, struct.calcsize(END64)))
        if sign != END64_SIGN:
            raise ValueError("no ZIP64 end of central directory")
    raw, p, found = at(directory, length), 0, []
    for _ in range(count):
        sign, _, _, flags, method, _, _, crc, packed, plain, n, extra, note, _, _, _, start = struct.unpack_from(CENTRAL, raw, p)
        if sign != CENTRAL_SIGN:
            raise ValueError("broken central directory")
        name = raw[p + struct.calcsize(CENTRAL) : p + struct.calcsize(CENTRAL) + n].decode()
        fields = raw[p + struct.calcsize(CENTRAL) + n : p + struct.calcsize(CENTRAL) + n + extra]
        p += struct.calcsize(CENTRAL) + n + extra + note
        if LIMIT32 in (packed, plain, start):
            wide = _zip64(fields)
            plain = wide.pop(0) if plain == LIMIT32 else plain
            packed = wide.pop(0) if packed == LIMIT32 else packed
            start = wide.pop(0) if start == LIMIT32 else start
        if method or flags & 1:
            raise ValueError(f"{name} is not stored")
        local = struct.unpack(LOCAL, at(start, struct.calcsize(LOCAL)))
        if local[0] != LOCAL_SIGN:
            raise ValueError(f"no local header of {name}")
        found.append(Member(name, crc, start + struct.calcsize(LOCAL) + local[9] + local[10], packed))
    return found


def _zip64(fields: bytes) -> list[int]:
    p = 0
    while p + 4 <= len(fields):
        kind, n = struct.unpack_from("<HH", fields, p)
        if kind == 1:
            return list(struct.unpack_from(f"<{n // 8}Q", fields, p + 4))
        p += 4 + n
    raise ValueError("no ZIP64 field")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def classified(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, payload, kind, refers_to): payloads as UTF-8 bytes and the record type of each.

    Of equal payloads of at least ``least_bytes`` bytes the one with the largest page_id is the response (all rows
    with that page_id, if it repeats; a null is below any id), the others revisit it. Digests are grouped map-side,
    and only those of several ids are joined back, so a payload of very many pages is one hot key of a spread join.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    large = rows.filter(F.octet_length("payload") >= least_bytes)
    nameless = F.max(F.col("page_id").isNull()).alias("nameless")
    groups = large.groupBy("digest").agg(F.max("page_id").alias("newest"), F.min("page_id").alias("oldest"), nameless)
    groups = groups.filter("newest is not null and (newest != oldest or nameless)")
    groups = stage(groups.select(F.col("digest").alias("g_digest"), "newest"))
    joined = spread_join(rows, groups, [("digest", "g_digest")], "left")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    kind = F.when(revisit, "revisit").otherwise("response").alias("kind")
    return joined.select("page_id", "url", "payload", kind, F.when(revisit, F.col("newest")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the rows of :func:`classified` as archives and returns (path, size, records) of each, a written table.

    A task packs its rows in archives of about ARCHIVE_BYTES, which bounds its memory.
    """

    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def pack(rows: list[tuple[dict, bytes]]) -> tuple[str, int, int]:
        name = f"{folder}/{uuid.uuid4().hex}.wacz"
        store, path = _open(name)
        lines, offset = [], 0
        for page, raw in rows:
            uri = page["url"]
            entry = page | {"mime": "text/html", "status": "200", "filename": DATA}
            lines.append(index_line(uri, date, entry | {"offset": str(offset), "length": str(len(raw))}) + "\n")
            offset += len(raw)
        lines.sort()
        buffer = io.BytesIO()
        out = ZipWriter(buffer)
        out.add(DATA, [raw for _, raw in rows])
        out.add(INDEX, ["".join(lines).encode()])
        out.close()
        store.create_dir(_open(folder)[1], recursive=True)
        with store.open_output_stream(path) as sink:
            sink.write(buffer.getbuffer())
        return name, out.at, len(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, rows, total = [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                raw = record(row["page_id"], row["url"], row["payload"], row["kind"], row["refers_to"], date)
                uri = target_uri(row["page_id"], row["url"])
                rows.append(({"url": uri, "digest": f"sha1:{digest32(row['payload'])}"}, raw))
                total += len(raw)
                if total >= ARCHIVE_BYTES:
                    done.append(pack(rows))
                    rows, total = [], 0
        if rows:
            done.append(pack(rows))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["path", "size", "records"])

    return stage(small_batches(records).mapInArrow(work, "path string, size long, records long"))


def index_records(archives: DataFrame) -> DataFrame:
    """(path, offset, length) of every record, from the archives' directories and indexes; offsets are in the archive."""

    def work(batch: pa.RecordBatch):
        for name, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist()):
            store, path = _open(name)
            with store.open_input_file(path) as file:
                found = {m.name: m for m in members(file, size)}
                index = found[INDEX]
                file.seek(index.offset)
                raw = file.read(index.size)
            if zlib.crc32(raw) != index.crc:
                raise ValueError(f"{name}: broken index")
            lines = [json.loads(line.split(" ", 2)[2]) for line in raw.decode().split("\n") if line]
            offsets = [found[line["filename"]].offset + int(line["offset"]) for line in lines]
            columns = [[name] * len(lines), offsets, [int(line["length"]) for line in lines]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["path", "offset", "length"])

    types = [pa.string(), pa.int64(), pa.int64()]
    return map_texts(archives.select("path", "size"), work, "path string, offset long, length long", "path")


def read_records(index: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records at (path, offset, length).

    Records are dealt out by place, so one large archive is read by many tasks; neighbours are fetched with one read.
    A response's payload is checked against its digest.
    """

    def fetch(name: str, spans: list[tuple[int, int]]) -> Iterator[bytes]:
        store, path = _open(name)
        with store.open_input_file(path) as file:
            at = 0
            while at < len(spans):
                start, to = spans[at][0], at + 1
                while to < len(spans) and spans[to][0] + spans[to][1] - start <= NEAR_BYTES:
                    to += 1
                file.seek(start)
                raw = file.read(spans[to - 1][0] + spans[to - 1][1] - start)
                for offset, length in spans[at:to]:
                    yield raw[offset - start : offset - start + length]
                at = to

    def work(batch: pa.RecordBatch):
        by_path: dict[str, list[tuple[int, int]]] = {}
        for path, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
            by_path.setdefault(path, []).append((offset, length))
        rows = []
        for path, spans in by_path.items():
            for raw in fetch(path, sorted(spans)):
                r = parse_record(raw)
                digest = r["warc-payload-digest"].removeprefix("sha1:")
                n = int(r["http"]["content-length"])
                if r["warc-type"] == "response" and (len(r["payload"]) != n or digest32(r["payload"]) != digest):
                    raise ValueError(f"{path}: payload does not match its digest")
                ids = [int(r[k]) if k in r else None for k in ("warc-page-id", "warc-refers-to-page-id")]
                rows.append((ids[0], n, digest, r["warc-type"], ids[1]))
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    total = index.agg(F.sum("length")).first()[0] or 0
    place = F.floor(F.col("offset") / TASK_BYTES)
    dealt = index.select("path", "offset", "length").repartition(max(2, total // TASK_BYTES), "path", place)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return map_texts(dealt.sortWithinPartitions("path", "offset"), work, schema, "path")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes a record per row of ``pages`` to archives in the shared folder and reads all of them back.

    Null html is an empty payload; a null or empty url is named by the page's id; rows with a null page_id have a record
    without one. Repeated rows have a record each. An empty table gives no archive and no rows.
    """
    folder = f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}"
    archives = write_archives(classified(pages), folder)
    return read_records(stage(index_records(archives)))
