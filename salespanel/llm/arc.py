"""Legacy ARC archives, and their conversion to WARC.

An ARC record is a header line and as many bytes as its last field declares. Version 1 lines
have five fields, version 2 lines ten; a `filedesc` record says which version follows, and
archives may be concatenated. The converter reads lines from the right, as URLs may hold spaces,
and makes of each record what WARC asks for: an identifier (name-based UUID of where the record
stood and what it holds), the capture time in ISO form, the record type, and SHA-1 digests in
base32. Of records with equal payloads of at least `smallest` bytes the one with the largest
page id (then the largest record id) becomes the response; the others become revisits that
refer to it and carry the HTTP header only.

Files are written and read through Spark, so they can lie on anything Spark reads. A row of a
file is a run of records of about a megabyte; a file holds at most `chunks` of them, which
bounds what a task holds when it reads one. Blocks are bytes in any encoding; the writer of
text files passes them on as they are, with the record separator as its line separator. A file
is plain or gzip of any number of members, as legacy archives have one for each record. Payloads cross the network once, when each record
learns from the table of digests what it is; equal payloads meet there as digests, summed
before the shuffle, so a payload that a third of all records share is no hot spot. What is known
of the records without their blocks is stored, so that archives are read once for it.

Nulls: a null html is an empty payload, a null url is `-`, a null page id is left out of the
header and read back as null. Repeated pages are records of their own. An empty table makes
empty archives. Malformed archives raise ValueError with the place.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..params import cut_lineage, work_dir

CHUNK = 1 << 20
#: Of gzip: pages take 4 % more bytes than at the usual level 6, and a third of its time.
LEVEL = "FOUR"
#: Bytes given to a decompressor at once; what it leaves of them is looked at again.
FEED = 1 << 14
# Field names of the two header line versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length".split(),
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length".split(),
}
END_OF_RECORD = "\r\n\r\n"
GZIP = b"\x1f\x8b"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _url(url: str | None) -> str:
    return re.sub(r"[\r\n\t]", lambda m: f"%{ord(m[0]):02X}", url) if url else "-"


def http_message(page_id: int | None, payload: bytes) -> bytes:
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields in lower case, the header with its empty line, the payload."""
    at = block.find(b"\r\n\r\n")
    cut = len(block) if at < 0 else at + 4
    fields = {}
    for line in block[:cut].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields, block[:cut], block[cut:]


def arc_version_block(version: int, date: str) -> str:
    body = f"{version} 0 salespanel\n{' '.join(FIELDS[version])}\n"
    name = "filedesc://pages.arc"
    if version == 1:
        return f"{name} 0.0.0.0 {date} text/plain {len(body)}\n{body}"
    return f"{name} 0.0.0.0 {date} text/plain 200 - - 0 pages.arc {len(body)}\n{body}"


def arc_line(version: int, url: str, date: str, block: bytes) -> str:
    if version == 1:
        return f"{url} 0.0.0.0 {date} text/html {len(block)}\n"
    return f"{url} 0.0.0.0 {date} text/html 200 {base32_sha1(block)} - 0 pages.arc {len(block)}\n"


def arc_record(version: int, url: str, date: str, block: bytes) -> str:
    """A record whose block is text."""
    return arc_line(version, url, date, block) + block.decode()


@dataclass
class ArcRecord:
    offset: int
    version: int
    fields: dict[str, str]
    block: bytes


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of one or several concatenated archives, version blocks included."""
    at, version = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):  # records stand apart by a line feed
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"header line without an end at byte {at}")
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        if line.startswith("filedesc://"):
            words = data[end + 1 : end + 40].split(None, 1)
            version = int(words[0]) if words and words[0].isdigit() else None
        if version not in FIELDS:
            raise ValueError(f"no known version for the record at byte {at}")
        names = FIELDS[version]
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not a version {version} header line at byte {at}: {line[:80]!r}")
        stop = end + 1 + int(values[-1])
        if stop > len(data):
            raise ValueError(f"the record at byte {at} declares more bytes than there are")
        yield ArcRecord(at, version, dict(zip(names, values)), data[end + 1 : stop])
        at = stop


def iso_date(date: str) -> str:
    """14 digits as an ISO time; what is missing on the right is the start of the period."""
    d = date + "00000101000000"[len(date) :] if date.isdigit() else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(file: str, offset: int, payload_sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{offset}#{payload_sha1}')}>"


def warc_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.0\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields in lower case and the block of each record."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"not a record header at byte {at}")
        fields = {}
        for line in data[at:end].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.lower()] = value.strip()
        stop = end + 4 + int(fields["content-length"])
        if stop > len(data):
            raise ValueError(f"the record at byte {at} declares more bytes than there are")
        yield fields, data[end + 4 : stop]
        at = stop


def _chunked(records: Iterator[bytes], between: bytes, first: bytes) -> Iterator[bytes]:
    """Runs of records of about a megabyte; a longer record is a run of its own."""
    run, size = [first], 0
    for t in records:
        if size and size + len(t) > CHUNK:
            yield between.join(run)
            run, size = [first], 0
        run.append(t)
        size += len(t)
    if size:
        yield between.join(run)


def _rows(runs) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"value": pa.array(list(runs), pa.binary())})


def _write(values: DataFrame, path: str, between: str, chunks: int) -> str:
    (
        values.select(F.col("value").cast("string")).write.option("lineSep", between).option("compression", "gzip")
        .option("zlib.compress.level", LEVEL).option("maxRecordsPerFile", chunks).text(path)
    )
    return path


def write_arc(pages: DataFrame, path: str, date: str = "20010203040506", chunks: int = 32) -> str:
    """The pages as ARC files; runs of records take turns in being of version 1 and 2."""

    def run(batches):
        n = 0
        for batch in batches:
            ids, urls, pages = (batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "html"))
            n += 1
            version = 1 + n % 2
            records = (
                arc_line(version, _url(urls[i].as_py()), date, block).encode() + block
                for i in range(batch.num_rows)
                for block in (http_message(ids[i].as_py(), pages[i].as_py() or b""),)
            )
            for chunk in _chunked(records, b"\n", arc_version_block(version, date).encode()):
                yield _rows([chunk])

    made = pages.select("page_id", "url", F.col("html").cast("binary").alias("html")).mapInArrow(run, "value binary")
    return _write(made, path, "\n", chunks)


RECORD = "record_id string, warc_date string, url string, ip string, kind string, page_id long, payload_sha1 string, payload_bytes long"


def inflated(content: bytes) -> bytes:
    """What a file holds: all its gzip members in order, or its bytes as they are."""
    if not content.startswith(GZIP):
        return content
    view, at, out = memoryview(content), 0, []
    while at < len(content):
        if content[at] == 0 and not any(view[at:]):  # padding
            break
        start, member = at, zlib.decompressobj(31)
        while not member.eof:
            if at == len(content):
                raise ValueError(f"the gzip member at byte {start} is cut off")
            fed = view[at : at + FEED]
            try:
                out.append(member.decompress(fed))
            except zlib.error as e:
                raise ValueError(f"no readable gzip member at byte {start}: {e}") from e
            at += len(fed) - len(member.unused_data)
    return b"".join(out)


def read_arc(spark: SparkSession, path: str, blocks: bool) -> DataFrame:
    """One row per record but version blocks: what RECORD names, and the block if asked for."""
    schema = StructType.fromDDL(RECORD + (", block binary" if blocks else ""))
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                rows: list[tuple] = []
                size, name = 0, file.as_py().rsplit("/", 1)[-1]
                for r in parse_arc(inflated(content.as_py())):
                    url = r.fields["URL"]
                    if url.startswith("filedesc://"):
                        continue
                    http, _, payload = split_http(r.block)
                    known = r.block.startswith(b"HTTP/")
                    payload = payload if known else r.block
                    sha1 = base32_sha1(payload)
                    page = http.get("x-page-id") if known else None
                    row = (
                        record_id(name, r.offset, sha1), iso_date(r.fields["Archive-date"]), url,
                        r.fields["IP-address"], "response" if known else "resource",
                        int(page) if page else None, sha1, len(payload),
                    )
                    rows.append(row + ((r.block,) if blocks else ()))
                    size += len(r.block)
                    if size > 8 * CHUNK:
                        yield _table(rows, arrow)
                        rows, size = [], 0
                if rows:
                    yield _table(rows, arrow)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def _table(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow
    )


def originals(records: DataFrame, smallest: int = 0) -> DataFrame:
    """payload_sha1, payload_bytes, and the record that keeps each payload of at least
    `smallest` bytes."""
    first = F.struct(
        F.coalesce("page_id", F.lit(-(2**63))).alias("order"), "record_id", "url", "warc_date"
    )
    return (
        records.filter((F.col("payload_bytes") >= smallest) & (F.col("kind") == "response"))
        .groupBy("payload_sha1", "payload_bytes").agg(F.max(first).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )


def convert(spark: SparkSession, arc: str, warc: str, smallest: int = 0, chunks: int = 32) -> str:
    """The ARC files under `arc` as WARC files under `warc`."""
    slim = cut_lineage(read_arc(spark, arc, blocks=False), "records")
    first = originals(slim, smallest)
    revisits = (
        slim.filter("kind = 'response'").join(first, ["payload_sha1", "payload_bytes"])
        .filter(F.col("record_id") != F.col("first.record_id")).select("record_id", F.col("first").alias("to"))
    )
    whole = read_arc(spark, arc, blocks=True).join(revisits, "record_id", "left")
    names = [*StructType.fromDDL(RECORD).names, "block", "to"]

    def run(batches):
        info = warc_record(
            {"WARC-Type": "warcinfo", "WARC-Date": "1970-01-01T00:00:00Z",
             "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'salespanel')}>",
             "Content-Type": "application/warc-fields"},
            b"software: salespanel\r\nformat: WARC File Format 1.0\r\n",
        )
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            records = (_converted(dict(zip(names, (c[i].as_py() for c in columns)))) for i in range(batch.num_rows))
            for chunk in _chunked(records, END_OF_RECORD.encode(), info):
                yield _rows([chunk])

    return _write(whole.select(*names).mapInArrow(run, "value binary"), warc, END_OF_RECORD, chunks)


def _converted(r: dict) -> bytes:
    _, head, _ = split_http(r["block"])
    http = r["kind"] == "response"
    block = head if r["to"] else r["block"]
    headers = {
        "WARC-Type": "revisit" if r["to"] else r["kind"], "WARC-Target-URI": r["url"], "WARC-Date": r["warc_date"],
        "WARC-Record-ID": r["record_id"], "WARC-IP-Address": r["ip"],
        "Content-Type": "application/http; msgtype=response" if http else "application/octet-stream",
        "WARC-Payload-Digest": f"sha1:{r['payload_sha1']}", "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
    }
    if r["to"]:
        headers |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
            "WARC-Refers-To": r["to"]["record_id"], "WARC-Refers-To-Target-URI": r["to"]["url"],
            "WARC-Refers-To-Date": r["to"]["warc_date"],
        }
    return warc_record(headers, block)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_id, record_type, payload_bytes, payload_digest (of the full payload, as a
    revisit declares it and a response is read), to_id, intact (digests agree)."""
    schema = StructType.fromDDL(
        "page_id long, record_id string, record_type string, payload_bytes long, "
        "payload_digest string, to_id string, intact boolean"
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parse_warc(inflated(content.as_py())):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    http, _, payload = split_http(block) if kind != "resource" else ({}, b"", block)
                    declared = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "revisit":
                        size, digest = int(http.get("content-length", 0)), declared
                    else:
                        size, digest = len(payload), base32_sha1(payload)
                    page = http.get("x-page-id")
                    rows.append((
                        int(page) if page else None, fields["warc-record-id"], kind, size, digest,
                        fields.get("warc-refers-to"),
                        digest == declared and fields["warc-block-digest"] == f"sha1:{base32_sha1(block)}",
                    ))
                if rows:
                    yield _table(rows, arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def archive_pages(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """Pages to ARC, ARC to WARC, WARC read back: page_id, payload_bytes, payload_digest,
    record_type, refers_to, intact. The archives stay under the checkpoint folder."""
    spark = pages.sparkSession
    arc = write_arc(pages, work_dir(spark, "arc"))
    warc = convert(spark, arc, work_dir(spark, "warc"), smallest)
    back = cut_lineage(read_warc(spark, warc), "back")
    responses = back.filter("to_id is null").select(
        F.col("record_id").alias("to_id"), F.col("page_id").alias("refers_to")
    )
    return back.join(responses, "to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )
