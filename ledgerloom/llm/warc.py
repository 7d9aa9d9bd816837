"""Legacy web archives: ARC files are parsed and written again as WARC.

An ARC file opens with a version block that names the fields of its header lines;
every record is a header line, as many bytes as the line declares, and a line feed.
From these the converter makes WARC records with identifiers, timestamps, types and
digests. Records of equal payloads become one response and revisits of it.

Archives are written and read by Spark's own file sources, so they can lie in any
store Spark reaches; an archive is read whole by one task, and its size is bounded by
the records it may hold.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import urllib.parse
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import written
from ledgerloom.sources.zones import shared_scratch

# Header fields of the two ARC versions (fixed values of the format).
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NO_ADDRESS = "0.0.0.0"
NO_URL = "http://invalid/"

RECORDS_PER_ARCHIVE = 4000
# Payloads below this many bytes are never revisits.
SHORTEST_REVISIT = 0
PAGE_HEADER = "X-Page-Id"
REFERS_HEADER = "X-Refers-To-Page-Id"
END_OF_RECORD = "\r\n\r\n"


def payload_digest(data: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing ARC -------------------------------------------------------------------


def _version_block(name: str, date: str, version: int) -> str:
    body = f"{version} 0 ledgerloom\n{ARC_FIELDS[version]}\n"
    url = f"filedesc://{name}"
    if version == 1:
        return f"{url} {NO_ADDRESS} {date} text/plain {len(body)}\n{body}"
    return f"{url} {NO_ADDRESS} {date} text/plain 200 - - 0 {name} {len(body)}\n{body}"


def _arc_url(url: str | None) -> str:
    """A URL fit for a header line: white space and controls are percent-encoded."""
    return urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~", encoding="utf-8") if url else NO_URL


def write_arc(pages: DataFrame, path: str, date: str, records: int = RECORDS_PER_ARCHIVE) -> None:
    """``page_id``, ``url``, ``html`` as ARC files, versions 1 and 2 by turns.

    The rows of a task come in order, so a version block before every ``records``
    records stands at the beginning of each file.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, version = 0, 1
        label = uuid.uuid4().hex
        for batch in batches:
            out: list[str] = []
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for page_id, url, html in zip(*columns, strict=True):
                if number % records == 0:
                    version = 1 + (number // records) % 2
                    name = f"{label}-{number // records}.arc"
                    out.append(_version_block(name, date, version))
                number += 1
                html = html or ""
                size = len(html.encode())
                named = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
                head = (
                    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
                    f"{named}Content-Length: {size}\r\n\r\n"
                )
                rest = "" if version == 1 else "200 - - 0 - "
                out.append(
                    f"{_arc_url(url)} {NO_ADDRESS} {date} text/html {rest}{len(head) + size}\n{head}{html}"
                )
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    rows = pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(lines, "value string")
    rows.write.option("lineSep", "\n").option("compression", "gzip").option(
        "maxRecordsPerFile", records + 1
    ).text(path)


# --- reading ARC, making WARC --------------------------------------------------------


@dataclass(frozen=True)
class ArcRecord:
    offset: int
    version: int
    fields: dict[str, str]
    body: bytes


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, the version block first; raises ValueError on a damaged one.

    A header line has the fields that the last version block names. URLs with blanks,
    which some crawlers wrote, are what is left of the other fields.
    """
    names: list[str] = []
    version, at = 0, 0
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"no header line at byte {at}")
        line = data[at:end].decode("utf-8").rstrip("\r")
        if not line:
            at = end + 1
            continue
        opening = line.startswith("filedesc://")
        length = line.rpartition(" ")[2]
        if not length.isdigit() or end + 1 + int(length) > len(data):
            raise ValueError(f"bad length {length!r} at byte {at}")
        body = data[end + 1:end + 1 + int(length)]
        if opening:
            described = body.decode("utf-8").split("\n")
            version, names = int(described[0].split(" ")[0]), described[1].split(" ")
        if not names:
            raise ValueError("records before a version block")
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ValueError(f"{len(values)} of {len(names)} fields at byte {at}")
        yield ArcRecord(at, version, dict(zip(names, values, strict=True)), body)
        at = end + 1 + int(length)


def _http_parts(body: bytes) -> tuple[bytes, bytes]:
    """Head with its empty line, and entity, of an HTTP message."""
    cut = body.find(b"\r\n\r\n")
    return (body[:cut + 4], body[cut + 4:]) if cut >= 0 else (b"", body)


def _http_field(head: str, name: str) -> str | None:
    for line in head.split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if colon and key.strip().lower() == name.lower():
            return value.strip()
    return None


def warc_date(date: str) -> str:
    """ISO 8601 of an ARC date of 8 to 14 digits."""
    full = date + "00000101000000"[len(date):] if len(date) < 14 else date[:14]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_type(record: ArcRecord) -> str:
    """What a record is by its content: an HTTP message is a response, whatever its URL."""
    if record.fields["URL"].startswith("filedesc://"):
        return "warcinfo"
    return "response" if record.body[:5] == b"HTTP/" else "resource"


@dataclass(frozen=True)
class WarcPart:
    """What an ARC record is as a WARC record."""

    record: str
    kind: str
    page_id: int | None
    payload_bytes: int
    payload_digest: str
    date: str
    uri: str
    address: str
    content_type: str
    head: str
    entity: bytes

    def block_digest(self) -> str:
        return payload_digest(self.head.encode() + self.entity)


def convert(archive: str, data: bytes) -> Iterator[WarcPart]:
    """WARC parts of every record of an ARC file.

    Identifiers are derived from the archive's name and the record's place in it, so
    converting again gives the same ones.
    """
    name = archive.rpartition("/")[2]
    for record in read_arc(data):
        kind = warc_type(record)
        head, entity = _http_parts(record.body) if kind == "response" else (b"", record.body)
        text = head.decode("utf-8")
        page = _http_field(text, PAGE_HEADER)
        content = {
            "response": "application/http; msgtype=response",
            "warcinfo": "application/warc-fields",
        }.get(kind, record.fields["Content-type"])
        yield WarcPart(
            str(uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{record.offset}")),
            kind,
            None if page is None else int(page),
            len(entity),
            payload_digest(entity),
            warc_date(record.fields["Archive-date"]),
            record.fields["URL"],
            record.fields["IP-address"],
            content,
            text,
            entity,
        )


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


_DIGEST_DDL = (
    "archive string, record string, page_id long, payload_bytes long, payload_digest string, "
    "date string, uri string"
)
_DIGEST = pa.schema(
    [
        ("archive", pa.string()), ("record", pa.string()), ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("date", pa.string()),
        ("uri", pa.string()),
    ]
)


def response_digests(spark: SparkSession, path: str) -> DataFrame:
    """What equal payloads are found by, for every response in the ARC files in ``path``."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive = batch.column(0)[i].as_py()
                rows = [
                    (archive, r.record, r.page_id, r.payload_bytes, r.payload_digest, r.date, r.uri)
                    for r in convert(archive, gzip.decompress(batch.column(1)[i].as_py()))
                    if r.kind == "response"
                ]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_DIGEST)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _DIGEST, strict=True)], schema=_DIGEST
                )

    return _archives(spark, path).mapInArrow(parse, _DIGEST_DDL)


def _record_text(part: WarcPart, first: dict | None) -> str:
    """A WARC record without its closing line feeds; a revisit of ``first`` has no payload."""
    lines = [
        "WARC/1.0",
        f"WARC-Type: {part.kind if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{part.record}>",
        f"WARC-Date: {part.date}",
    ]
    if part.kind == "warcinfo":
        lines.append(f"WARC-Filename: {part.uri}")
    else:
        lines += [f"WARC-Target-URI: {part.uri}", f"WARC-IP-Address: {part.address}"]
    block = part.head
    if first is None:
        block += part.entity.decode("utf-8")
        lines.append(f"WARC-Block-Digest: sha1:{part.block_digest()}")
    else:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: <urn:uuid:{first['record']}>",
            f"WARC-Refers-To-Target-URI: {first['uri']}",
            f"WARC-Refers-To-Date: {first['date']}",
        ]
        if first["page_id"] is not None:
            lines.append(f"{REFERS_HEADER}: {first['page_id']}")
    lines += [
        f"WARC-Payload-Digest: sha1:{part.payload_digest}",
        f"Content-Type: {part.content_type}",
        f"Content-Length: {len(block.encode())}",
    ]
    return "\r\n".join(lines) + "\r\n\r\n" + block


def write_warc(spark: SparkSession, arc: str, path: str, shortest: int = SHORTEST_REVISIT) -> None:
    """The ARC files in ``arc`` as WARC files: equal payloads once, then revisits.

    First digests alone are compared, the smallest page id of each payload being its
    response; ids that are null come last, and of equal ids the smallest record
    identifier. What was decided is gathered by archive, at most an entry for each of
    its records, and joins the archives as they are, still compressed; payloads are
    not moved but for that.
    """
    known = written(response_digests(spark, arc), "warc-digests")
    order = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "record", "date", "uri")
    firsts = known.filter(F.col("payload_bytes") >= shortest).groupBy(
        F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")
    ).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
    repeated = written(firsts.filter("copies > 1"), "warc-copies")
    same = (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes"))
    revisits = (
        known.join(repeated, same)
        .filter(F.col("record") != F.col("first.record"))
        .groupBy("archive")
        .agg(F.collect_list(F.struct("record", "first")).alias("revisits"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive = batch.column(0)[i].as_py()
                first_of = {r["record"]: r["first"] for r in batch.column(2)[i].as_py() or []}
                held: list[str] = []
                for part in convert(archive, gzip.decompress(batch.column(1)[i].as_py())):
                    held.append(_record_text(part, first_of.get(part.record)))
                    if len(held) == 200:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])
                        held = []
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])

    joined = _archives(spark, arc).join(revisits, F.col("path") == F.col("archive"), "left")
    lines = joined.select("path", "content", "revisits").mapInArrow(write, "value string")
    lines.write.option("lineSep", END_OF_RECORD).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_ARCHIVE
    ).text(path)


# --- reading WARC --------------------------------------------------------------------


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n") if end >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + length]
        if len(block) < length or data[end + 4 + length:end + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield fields, block
        at = end + 8 + length


RECORD_DDL = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, record_id string, uri string, date string"
)
_RECORD = pa.schema(
    [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
        ("uri", pa.string()), ("date", pa.string()),
    ]
)


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per response and revisit in the WARC files in ``path``.

    Digests of responses are computed from the payload and must agree with what the
    record says; revisits have no payload, so theirs are what the record says.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for fields, block in read_warc(gzip.decompress(batch.column(1)[i].as_py())):
                    kind = fields["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, entity = _http_parts(block)
                    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    text = head.decode("utf-8")
                    size = len(entity) if kind == "response" else int(_http_field(text, "Content-Length") or 0)
                    if kind == "response" and payload_digest(entity) != said:
                        raise ValueError(f"digest of {fields['WARC-Record-ID']} does not agree")
                    page, refers = _http_field(text, PAGE_HEADER), fields.get(REFERS_HEADER)
                    rows.append(
                        (
                            None if page is None else int(page), size, said, kind,
                            None if refers is None else int(refers),
                            fields["WARC-Record-ID"], fields["WARC-Target-URI"], fields["WARC-Date"],
                        )
                    )
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_RECORD)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _RECORD, strict=True)], schema=_RECORD
                )

    return _archives(spark, path).mapInArrow(parse, RECORD_DDL)


def archive_pages(spark: SparkSession, pages: DataFrame, date: str = "20240131000000") -> DataFrame:
    """Pages through ARC and WARC files and back: a row per page (``RECORD_DDL``).

    Takes ``page_id``, ``url``, ``html``; other columns are ignored. Null html is an
    empty payload, a null url a placeholder, a null id a record without one; repeated
    rows are records of their own. No rows give no rows.
    """
    arc, path = shared_scratch(spark, "arc"), shared_scratch(spark, "warc")
    write_arc(pages, arc, date)
    write_warc(spark, arc, path)
    return warc_records(spark, path)
