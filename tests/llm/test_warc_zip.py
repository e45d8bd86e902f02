import gzip
import hashlib
import io
import zipfile

import pytest

from vantage.llm import warc_zip
from vantage.llm.common import fresh_path
from vantage.llm.warc_zip import ArchiveReader, ArchiveWriter, parse, record

BIG = "<p>" + "x" * 2000
ROWS = [(1, "http://a/", BIG), (2, None, BIG), (3, "http://c/\r\nX: y", BIG), (4, "u", "small"), (5, "u", "small"), (6, "u", None),
        (7, "u", ""), (8, "u", "é" * 499), (9, "u", "é" * 500), (10, "u", "é" * 500), (10, "u", "é" * 500), (None, "u", BIG),
        (11, "u", "long " * 100_000)]
SCHEMA = "page_id long, url string, html string, best string, digest string, record_type string"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "b", "d", "t") for r in rows], SCHEMA)


def expected(rows):
    best = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            best[data] = max(best.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = data in best and best[data] != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", best[data] if again else None))
    return sorted(out, key=repr)


def archive(records, **kw):
    out = io.BytesIO()
    writer = ArchiveWriter(out, **kw)
    for r in records:
        writer.add(r[0], record(*r))
    writer.close()
    return out.getvalue()


def reader(data):
    return ArchiveReader(lambda at, n: data[at:at + n], len(data))


RECORDS = [(i, f"http://x/{i}", f"page {i} ".encode() * 50, "response", None) for i in range(40)]


def test_edges_round_trip(spark):
    got = warc_zip.round_trip(frame(spark)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(ROWS)
    assert warc_zip.round_trip(frame(spark).limit(0)).collect() == []


def test_payloads_come_back(spark):
    archives = warc_zip.write(warc_zip.labelled(frame(spark)), fresh_path(spark, "w"), archive_bytes=100)
    assert archives.count() > 4  # closed at 100 bytes each
    got = warc_zip.read(archives, payload=True).collect()
    assert all(bytes(r.payload) in {(h or "").encode() for _, _, h in ROWS} for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit") and len(got) == len(ROWS)


def test_python_reads_what_we_write():
    data = archive(RECORDS, member_bytes=500)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
        warc = b"".join(gzip.decompress(z.read(n)) for n in sorted(z.namelist()) if n.startswith("archive/"))
    assert warc.count(b"WARC/1.1\r\n") == 40


@pytest.mark.parametrize("most", [1, 300, 1 << 20])
def test_records_by_ranges(most):
    got = sorted(reader(archive(RECORDS, member_bytes=700)).records(most), key=lambda r: r["page_id"])
    assert [(r["page_id"], r["payload"]) for r in got] == [(r[0], r[2]) for r in RECORDS]


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    data = archive(RECORDS, member_bytes=500)
    assert warc_zip.END64 in data and warc_zip.LOCATOR in data
    assert len(list(reader(data).records())) == 40


def test_comments_and_foreign_members():
    out = io.BytesIO(archive(RECORDS[:3]))
    with zipfile.ZipFile(out, "a") as z:
        z.comment = b"note PK\5\6 in a comment"
        z.writestr("extra.txt", "z" * 500, zipfile.ZIP_DEFLATED)
    r = reader(out.getvalue())
    assert len(list(r.records())) == 3
    with pytest.raises(ValueError, match="compressed"):
        r.span("extra.txt")


def test_broken_input_is_refused():
    with pytest.raises(ValueError, match="not a ZIP"):
        reader(b"nothing here")
    good = record(1, "u", b"payload", "response", None)
    with pytest.raises(ValueError, match="digest"):
        parse(good.replace(b"payload\r\n", b"pay1oad\r\n"))
    with pytest.raises(ValueError, match="not a WARC"):
        parse(b"HTTP/1.1 200\r\n\r\n")


def test_revisit_headers():
    got = record(1, "u", b"p" * 2000, "revisit", 9)
    assert b"WARC-Refers-To: " + warc_zip.record_id(9, hashlib.sha1(b"p" * 2000).hexdigest()).encode() in got
    assert len(got) < 1000 and parse(got)["payload_bytes"] == 2000


def test_many_archives_are_read_by_many_tasks(spark):
    """Adaptive execution may not merge the list of archives into one task, and no page without a partner meets another."""
    from pyspark.sql import functions as F

    pages = spark.range(0, 3000, 1, 40).selectExpr("id AS page_id", "concat('u', id) AS url", "repeat('x', int(id % 40)) AS html")
    archives = warc_zip.write(warc_zip.labelled(pages).repartition(60), fresh_path(spark, "many"), archive_bytes=1)
    assert archives.count() > 1000
    got = warc_zip.read(archives).withColumn("task", F.spark_partition_id())
    assert got.count() == 3000
    assert got.select("task").distinct().count() >= spark.sparkContext.defaultParallelism
    plan = warc_zip.labelled(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "small " in plan
