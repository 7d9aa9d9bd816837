import base64
import gzip
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import warc
from tests.llm.fixtures import rows

BLOCK_1 = b"1 0 someone\nURL IP-address Archive-date Content-type Archive-length\n"
BLOCK_2 = (
    b"2 0 someone\nURL IP-address Archive-date Content-type Result-code Checksum Location "
    b"Offset Filename Archive-length\n"
)


def arc(block, header, records):
    out = header % len(block) + b"\n" + block + b"\n"
    for head, body in records:
        out += head + b" %d\n" % len(body) + body + b"\n"
    return out


ONE = arc(
    BLOCK_1, b"filedesc://a.arc 0.0.0.0 19960923142103 text/plain %d",
    [
        (b"http://x.org/a 1.2.3.4 19960923142104 text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n<p>\nhi</p>"),
        (b"http://x.org/two words 1.2.3.4 199609231421 text/html", b"HTTP/1.0 200 OK\r\n\r\n"),
        (b"dns:x.org 9.9.9.9 19960923 text/dns", b"x.org A 1.2.3.4"),
    ],
)
TWO = arc(
    BLOCK_2, b"filedesc://b.arc 0.0.0.0 20010101000000 text/plain 200 - - 0 b.arc %d",
    [(b"https://y.org/ 5.6.7.8 20010101000001 text/html 404 abc - 99 b.arc", b"HTTP/1.1 404 No\r\n\r\nmissing")],
)


def test_both_versions_are_parsed_by_their_own_fields():
    one, two = list(warc.read_arc(ONE)), list(warc.read_arc(TWO))
    assert [r.version for r in one] == [1] * 4 and [r.version for r in two] == [2] * 2
    assert [warc.warc_type(r) for r in one] == ["warcinfo", "response", "response", "resource"]
    assert one[2].fields["URL"] == "http://x.org/two words"
    assert two[1].fields["Result-code"] == "404" and two[1].fields["IP-address"] == "5.6.7.8"
    assert one[1].body.endswith(b"<p>\nhi</p>")


def test_warc_parts_of_arc_records():
    parts = list(warc.convert("a.arc", ONE))
    page = parts[1]
    assert page.date == "1996-09-23T14:21:04Z" and page.content_type.startswith("application/http")
    want = base64.b32encode(hashlib.sha1(b"<p>\nhi</p>").digest()).decode()
    assert page.payload_digest == want and page.payload_bytes == 10
    assert parts[2].date == "1996-09-23T14:21:00Z" and parts[3].date == "1996-09-23T00:00:00Z"
    assert len({p.record for p in parts}) == 4 and uuid.UUID(page.record)
    assert list(warc.convert("elsewhere/a.arc", ONE)) == parts


@pytest.mark.parametrize(
    "damaged",
    [ONE[:-5], ONE.replace(b"text/dns 15", b"text/dns x"), ONE[ONE.index(b"http:"):], b"no line"],
)
def test_damaged_archives_raise(damaged):
    with pytest.raises(ValueError):
        list(warc.read_arc(damaged))


def expected(pages):
    first = {}
    for page_id, _, html in pages:
        if page_id is not None:
            key = html or ""
            first[key] = min(first.get(key, page_id), page_id)
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        response = first.get(html or "")
        role = ("response", None) if page_id == response else ("revisit", response)
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), *role))
    return sorted(out, key=repr)


PAGES = [
    (5, "http://a/", "<p>same</p>"), (3, "http://b/ c", "<p>same</p>"), (9, None, "<p>same</p>"),
    (4, "http://ü/\n", None), (6, "", ""), (7, "http://d/", "x\r\n\r\ny\nWARC/1.0\r\n"),
    (None, "http://e/", "<p>same</p>"), (8, "http://f/", "ünï \U0001f600" * 5000), (10, "dns:z", "<html>"),
]


def test_pages_survive_both_formats(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    pages = pages.withColumns({n: F.lit("x") for n in ("record", "head", "payload", "first", "value")})
    got = warc.archive_pages(spark, pages)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows(got.select(*names)) == expected(PAGES)
    by = {r.page_id: r for r in got.collect()}
    assert by[3].uri == "http://b/%20c" and by[9].uri == warc.NO_URL
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(spark, empty).collect() == []


def test_repeated_rows_and_many_archives(spark, tmp_path):
    pages = [(i // 2, f"http://h/{i}", f"body {i % 7}") for i in range(60)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2)
    arcs, out = f"file:{tmp_path}/arc", f"file:{tmp_path}/warc"
    warc.write_arc(frame, arcs, "20240131000000", records=10)
    files = sorted((tmp_path / "arc").glob("part-*"))
    assert len(files) in (6, 7)
    versions = [list(warc.read_arc(gzip.decompress(f.read_bytes())))[0].version for f in files]
    assert set(versions) == {1, 2}
    warc.write_warc(spark, arcs, out)
    got = warc.warc_records(spark, out)
    assert got.count() == 60 and got.filter("record_type = 'response'").count() == 7
    assert got.filter("record_type = 'revisit' and refers_to is null").count() == 0
    kinds = [
        fields["WARC-Type"] for f in (tmp_path / "warc").glob("part-*")
        for fields, _ in warc.read_warc(gzip.decompress(f.read_bytes()))
    ]
    assert kinds.count("warcinfo") == len(files) and kinds.count("revisit") == 53
