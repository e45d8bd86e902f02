"""ZIP-packaged WARC archives: written by Spark tasks, read back by their directories and indexes.

An archive is a ZIP file of stored (uncompressed) members: WARC files whose records are gzipped one by one, and a sorted
index with one line per record (page, member, offset, length). The reader never extracts: from the end of the file it
finds the end-of-directory record, in large archives by its ZIP64 locator, reads the central directory, locates members
through their local headers, reads the index and then byte ranges that hold records.

Of records with equal payloads of ``least`` bytes or more, that with the largest page_id is a response and the others are
revisits of it. The groups come from digests alone; only digests that occur twice are joined back to the pages.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import filesystem, fresh_path, publish, settle, ship, task_name, tasks_for

# Fixed values of the formats.
END, LOCATOR, END64, CENTRAL, LOCAL = b"PK\5\6", b"PK\6\7", b"PK\6\6", b"PK\1\2", b"PK\3\4"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}').urn}>"


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, not yet compressed. A revisit has HTTP headers and no payload."""
    digest = hashlib.sha1(payload)
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or f"urn:page:{page_id}")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest.hexdigest())}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(digest.digest()).decode()}",
            f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest.hexdigest())}",
                 f"X-Refers-To-Page: {'' if refers_to is None else refers_to}"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record and, of a response, its payload, verified against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    number = lambda k: int(fields[k]) if fields.get(k) else None
    return {"page_id": number("X-Page-Id"), "url": fields["WARC-Target-URI"],
            "payload_bytes": int(fields["X-Payload-Length"]) if payload is None else len(payload),
            "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page"),
            "payload": payload}


class ArchiveWriter:
    """Streams an archive: WARC members of about ``member_bytes``, then the index."""

    def __init__(self, stream, member_bytes: int = 16 << 20) -> None:
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member_bytes, self.buffer, self.members, self.lines, self.size = member_bytes, io.BytesIO(), 0, [], 0

    def add(self, page_id: int | None, data: bytes) -> None:
        packed = gzip.compress(data, 1, mtime=0)
        place = {"member": f"archive/data-{self.members:05d}.warc.gz", "offset": self.buffer.tell(), "length": len(packed)}
        self.lines.append(f"{'' if page_id is None else page_id} {json.dumps(place)}")
        self.buffer.write(packed)
        self.size += len(packed)
        if self.buffer.tell() >= self.member_bytes:
            self._flush()

    def _flush(self) -> None:
        if self.buffer.tell():
            self._member(f"archive/data-{self.members:05d}.warc.gz", self.buffer.getvalue())
            self.members += 1
            self.buffer = io.BytesIO()

    def _member(self, name: str, data: bytes) -> None:
        self.zip.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), data)

    def close(self) -> None:
        self._flush()
        self._member("indexes/index.cdxj", "\n".join(sorted(self.lines)).encode())
        self.zip.close()


class ArchiveReader:
    """Range reads over ``read(offset, length)`` of an archive of ``size`` bytes."""

    def __init__(self, read, size: int) -> None:
        self.read = read
        tail_at = max(0, size - 22 - FULL16)
        tail = read(tail_at, size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
            at = tail.rfind(END, 0, at + 3)  # the signature within the comment
        if at < 0:
            raise ValueError("not a ZIP archive")
        count, span, start = struct.unpack("<HII", tail[at + 10:at + 20])
        if FULL16 == count or FULL32 in (span, start):
            place = read(tail_at + at - 20, 20) if tail_at + at >= 20 else b""
            if place[:4] == LOCATOR:
                record64 = read(struct.unpack("<Q", place[8:16])[0], 56)
                if record64[:4] != END64:
                    raise ValueError("broken ZIP64 directory")
                count, span, start = struct.unpack("<QQQ", record64[32:56])
        self.members = self._directory(read(start, span), count)

    @staticmethod
    def _directory(data: bytes, count: int) -> dict[str, tuple[int, int, int]]:
        """Per member its compression method, stored size and local header's place."""
        out, at = {}, 0
        for _ in range(count):
            if data[at:at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            flags, method = struct.unpack("<HH", data[at + 8:at + 12])
            packed, full = struct.unpack("<II", data[at + 20:at + 28])
            names, extras, notes = struct.unpack("<HHH", data[at + 28:at + 34])
            place = struct.unpack("<I", data[at + 42:at + 46])[0]
            name = data[at + 46:at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
            extra, i = data[at + 46 + names:at + 46 + names + extras], 0
            while i + 4 <= len(extra):
                kind, size = struct.unpack("<HH", extra[i:i + 4])
                if kind == 1:  # ZIP64: what is full above, in this order
                    values = iter(struct.unpack(f"<{size // 8}Q", extra[i + 4:i + 4 + size // 8 * 8]))
                    full = next(values) if full == FULL32 else full
                    packed = next(values) if packed == FULL32 else packed
                    place = next(values) if place == FULL32 else place
                i += 4 + size
            out[name] = (method, packed, place)
            at += 46 + names + extras + notes
        return out

    def span(self, member: str) -> tuple[int, int]:
        """Where a stored member's bytes begin, and how many they are."""
        method, size, place = self.members[member]
        if method:
            raise ValueError(f"{member} is compressed")
        head = self.read(place, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header for {member}")
        return place + 30 + sum(struct.unpack("<HH", head[26:30])), size

    def index(self) -> list[dict]:
        start, size = self.span("indexes/index.cdxj")
        return [json.loads(line.split(" ", 1)[1]) for line in self.read(start, size).decode().split("\n") if line]

    def records(self, most: int = 4 << 20) -> Iterator[dict]:
        """All indexed records, neighbours fetched together in ranges of about ``most`` bytes."""
        starts = {m: self.span(m) for m in self.members if m.startswith("archive/")}
        group: list[tuple[int, int]] = []
        for at, size in [*sorted((starts[x["member"]][0] + x["offset"], x["length"]) for x in self.index()), (-1, 0)]:
            if group and (at != group[-1][0] + group[-1][1] or at + size - group[0][0] > most):
                data = self.read(group[0][0], sum(n for _, n in group))
                for place, n in group:
                    part = data[place - group[0][0]:place - group[0][0] + n]
                    yield parse(zlib.decompress(part, 31))
                group = []
            group.append((at, size))


def labelled(pages: DataFrame, least: int = 1000) -> DataFrame:
    """(page_id, url, html, record_type, refers_to) of (page_id, url, html), a null html as empty.

    Rows that share the largest page_id and the payload are all responses; a null page_id is the smallest."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.when(F.octet_length(html) >= least,
                                                   F.concat_ws(":", F.sha1(html), F.octet_length(html))).alias("digest"))
    groups = rows.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("best"),
                                                                   F.count(F.lit(1)).alias("n"))
    twice = settle(groups.where("n > 1").select("digest", "best"), "repeated-payloads")
    again = F.col("best").isNotNull() & ~F.col("best").eqNullSafe(F.col("page_id"))
    # small pages have no partner; each gets a key of its own, so that they aren't dealt to one task
    keyed = rows.withColumn("digest", F.coalesce("digest", F.concat(F.lit("small "), F.xxhash64("page_id", "url", "html").cast("string"))))
    return keyed.join(twice, "digest", "left").select(
        "page_id", "url", "html", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("best")).alias("refers_to"))


def write(pages: DataFrame, root: str, archive_bytes: int = 256 << 20) -> DataFrame:
    """Write the records of ``labelled`` pages to archives under ``root``; the settled list (path, bytes, records).

    Each task writes archives of its own, closed at ``archive_bytes``, which get their names when they are whole."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(root)
        store.create_dir(base, recursive=True)
        part, attempt = task_name()
        out, made, number, count = None, [], 0, 0

        def close() -> None:
            out.close()
            stream.close()
            publish(store, f"{base}/.{name}.{attempt}", f"{base}/{name}")
            made.append((f"{root.rstrip('/')}/{name}", store.get_file_info(f"{base}/{name}").size, count))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, count = f"pages-{part:06d}-{number:04d}.zip", 0
                    stream = store.open_output_stream(f"{base}/.{name}.{attempt}")
                    out = ArchiveWriter(stream)
                page_id, url, html, kind, refers_to = row
                out.add(page_id, record(page_id, url, html.encode(), kind, refers_to))
                count += 1
                if out.size >= archive_bytes:
                    close()
                    out, number = None, number + 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.int64()))], ["path", "bytes", "records"])

    return settle(pages.mapInArrow(run, "path string, bytes long, records long"), "archives")


def read(archives: DataFrame, payload: bool = False) -> DataFrame:
    """All records of (path, bytes) archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and
    with ``payload`` the response's bytes (null for revisits). Archives are dealt out by path over as many tasks as their
    bytes ask for."""
    ship(archives.sparkSession)
    total = archives.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    tasks = tasks_for(archives, total.n, total.bytes)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payload]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.binary()] * payload]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, place = filesystem(path)
                with store.open_input_file(place) as f:
                    held, weight = [], 0
                    for r in ArchiveReader(lambda at, n: f.read_at(n, at), size).records():
                        held.append(r)
                        weight += 1 + (r["payload_bytes"] if payload else 0) // 1000
                        if weight >= 5000:
                            yield _batch(held, names, types)
                            held, weight = [], 0
                    yield _batch(held, names, types)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.select("path", "bytes").repartition(tasks, "path").mapInArrow(run, schema + ", payload binary" * payload)


def _batch(rows: list[dict], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    archives = write(labelled(pages), fresh_path(pages.sparkSession, "warc"))
    return read(archives).drop("url")


ORACLE_SQL = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
FROM m"""
