"""Legacy ARC archives converted to WARC, written and read by Spark.

An ARC file begins with a ``filedesc:`` record whose body names the version and the fields of the record header lines: version 1 lines hold
URL, IP address, date, content type and length; version 2 lines hold result code, checksum, location, offset and file name before the
length. Records are cut by their declared lengths alone. The converter gives each record what WARC asks for and ARC lacks: an identifier
(made from URL, date and content, so the same record always gets the same one), a date in the new form, a type, and digests.

WARC files are written with the text writer (each row is a record, the line separator is the end of a record), so they land wherever
Spark can write; the bytes of a payload pass through unchanged. They are read as binary files of a bounded number of records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidence_spark.session import cut, small

V1, V2 = "URL IP-address Archive-date Content-type Archive-length", "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
EPOCH = "19700101000000"
#: Records per WARC file: a file is read as one row.
PER_FILE = 2000
RECORD = "record_id string, url string, date string, ip string, mime string, page_id long, http binary, payload binary, payload_bytes long, payload_digest string"


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    mime: str
    result: str | None
    content: bytes


def arc_file(records: list[ArcRecord], version: int, name: str = "legacy.arc") -> bytes:
    """An uncompressed ARC file of version 1 or 2."""
    body = f"{version} 0 unknown\n{V1 if version == 1 else V2}\n".encode()
    more = "" if version == 1 else f" 200 - - 0 {name}"
    out = [f"filedesc://{name} 0.0.0.0 {EPOCH} text/plain{more} {len(body)}\n".encode(), body, b"\n"]
    for r in records:
        extra = "" if version == 1 else f" {r.result or '-'} {base64.b32encode(hashlib.md5(r.content).digest()).decode().rstrip('=')} - {sum(map(len, out))} {name}"
        out += [f"{r.url} {r.ip} {r.date} {r.mime}{extra} {len(r.content)}\n".encode(), r.content, b"\n"]
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file after its file description. Fields are found by the names the file itself gives; URLs may hold spaces.

    A broken header line or a length beyond the file ends the file: nothing after it can be placed. Files without records give none.
    """
    at, fields = 0, V1.split()
    while at < len(data):
        if data[at: at + 1] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].decode("utf-8", "surrogateescape").rstrip("\r")
        described = line.startswith("filedesc:")
        parts = line.split(" ")
        n = len(parts) if described else len(fields)
        if end < 0 or len(parts) < n or not parts[-1].isdecimal() or end + 1 + int(parts[-1]) > len(data):
            return
        content, at = data[end + 1: end + 1 + int(parts[-1])], end + 1 + int(parts[-1])
        if described:
            lines = content.decode("utf-8", "replace").splitlines()
            fields = lines[1].split() if len(lines) > 1 else V2.split() if lines and lines[0].startswith("2") else V1.split()
            continue
        tail = dict(zip([f.lower() for f in fields[1:]], parts[len(parts) - n + 1:], strict=True))
        yield ArcRecord(" ".join(parts[: len(parts) - n + 1]), tail["ip-address"], tail["archive-date"], tail["content-type"], tail.get("result-code"), content)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload; content that is no HTTP message is all payload."""
    if content.startswith(b"HTTP/"):
        end = content.find(b"\r\n\r\n")
        return (content[: end + 4], content[end + 4:]) if end >= 0 else (content, b"")
    return b"", content


def http_field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower():
            return value.strip().decode("latin-1")
    return None


def warc_date(date: str) -> str:
    """A 14-digit ARC date (shorter ones are filled up) as WARC writes it; the epoch for what is none."""
    d = date if date.isdecimal() and len(date) <= 14 else EPOCH
    d += EPOCH[len(d):] if len(d) < 14 else ""
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def arc_archives(pages: DataFrame, per_file: int = 200) -> DataFrame:
    """(path, content): legacy archives of the pages as a crawler would have left them, version 1 for even and 2 for odd ids, made per batch.

    The payload is the html in UTF-8, empty for null; the id goes along as an HTTP field. Null URLs become ``urn:page:<id>``.
    """
    def run(frames):
        import pyarrow as pa

        for frame in frames:
            for k in range(0, frame.num_rows, per_file):
                part = frame.slice(k, per_file)
                files: dict[int, list[ArcRecord]] = {1: [], 2: []}
                for page, url, html in zip(part.column("page_id").to_pylist(), part.column("url").to_pylist(), part.column("html").cast(pa.large_binary()), strict=True):
                    payload = html.as_py() or b""
                    named = "" if page is None else str(page)
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\nX-Page-Id: {named}\r\n\r\n".encode()
                    clean = "".join(c if c > " " else "%%%02X" % ord(c) for c in url) if url else f"urn:page:{named}"
                    files[1 + (page or 0) % 2].append(ArcRecord(clean, "0.0.0.0", EPOCH, "text/html", "200", head + payload))
                made = [(f"{v}.arc", arc_file(records, v)) for v, records in files.items() if records]
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in made]), pa.array([c for _, c in made], pa.binary())], ["path", "content"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "path string, content binary")


def convert(arcs: DataFrame) -> DataFrame:
    """ARC files (path, content) to WARC records before they have a type: see RECORD. Null contents give no rows."""
    def run(frames):
        import pyarrow as pa

        schema = pa.schema([("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()), ("ip", pa.string()), ("mime", pa.string()), ("page_id", pa.int64()), ("http", pa.binary()),
                            ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
        for frame in frames:
            for data in frame.column("content"):
                rows = []
                for r in parse_arc(data.as_py() or b""):
                    head, payload = split_http(r.content)
                    name = http_field(head, b"X-Page-Id")
                    made = digest(payload)
                    rows.append((f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{r.url} {r.date} {name} {made}')}", r.url.encode("utf-8", "surrogateescape").decode("utf-8", "replace"), warc_date(r.date), r.ip, r.mime,
                                 int(name) if name else None, head, payload, len(payload), made))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return arcs.select("content").mapInArrow(run, RECORD)


def mark_revisits(records: DataFrame, least: int = 0) -> DataFrame:
    """Add warc_type and refers_to_id: of records with equal payloads of at least ``least`` bytes the one with the largest page_id is a
    response and the others revisit it; smaller payloads are all responses. Rows that share that page_id are all responses. Null ids are
    never the largest; if all are null, all are responses.

    Only digests met more than once are joined: broadcast while few, else by shuffle, where Spark splits hot digests.
    """
    enough = F.col("payload_bytes") >= least
    kept = records.where(enough).groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "record_id")).alias("last")).where(F.col("n") > 1)
    again = small(cut(kept.select(F.col("payload_digest").alias("_d"), F.col("last.page_id").alias("_last"), F.col("last.record_id").alias("_last_id"))))
    joined = records.join(again, (F.col("payload_digest") == F.col("_d")) & enough, "left")
    revisit = F.coalesce(F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last")), F.lit(False))
    return joined.select(records["*"], F.when(revisit, "revisit").otherwise("response").alias("warc_type"), F.when(revisit, F.col("_last_id")).alias("refers_to_id"))


def warc_record() -> Column:
    """A record as the bytes of a WARC file: named fields, a blank line and the block (the HTTP head alone for a revisit)."""
    revisit = F.col("warc_type") == "revisit"
    empty = F.lit("").cast("binary")
    size = F.octet_length("http") + F.when(revisit, 0).otherwise(F.octet_length("payload"))
    end = "\r\n"
    head = F.concat(
        F.lit(f"WARC/1.1{end}WARC-Type: "), F.col("warc_type"), F.lit(f"{end}WARC-Record-ID: <"), F.col("record_id"), F.lit(f">{end}WARC-Date: "), F.col("date"),
        F.lit(f"{end}WARC-Target-URI: "), F.col("url"), F.lit(f"{end}WARC-IP-Address: "), F.col("ip"), F.lit(f"{end}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"{end}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{end}WARC-Refers-To: <"), F.col("refers_to_id"), F.lit(">"))).otherwise(""),
        F.lit(f"{end}Content-Type: application/http; msgtype=response{end}Content-Length: "), size.cast("string"), F.lit(f"{end}{end}"))
    return F.concat(head.cast("binary"), F.col("http"), F.when(revisit, empty).otherwise(F.col("payload")))


def write_warc(records: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    """Write marked records as gzipped WARC files of at most ``per_file`` records."""
    rows = records.select(warc_record().cast("string").alias("value"))
    rows.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(path)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (lower-case names) and block of each record, cut by Content-Length. A broken record ends the file."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        size = fields.get("content-length", "")
        if not size.isdecimal() or end + 4 + int(size) > len(data):
            return
        yield fields, data[end + 4: end + 4 + int(size)]
        at = end + 4 + int(size)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, url, date, page_id, payload, payload_bytes, payload_digest and refers_to_id of every record of the WARC files
    in ``path``. A revisit has no payload; its length is that of its HTTP head's Content-Length. Digests of responses are taken from the
    payload itself, and a record whose field says otherwise is an error."""
    def run(frames):
        import gzip

        import pyarrow as pa

        for frame in frames:
            for data in frame.column("content"):
                raw, rows = data.as_py(), []
                for fields, block in parse_warc(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw):
                    head, payload = split_http(block)
                    page, said = http_field(head, b"X-Page-Id"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    response = fields["warc-type"] == "response"
                    if response and digest(payload) != said:
                        raise ValueError(f"record {fields.get('warc-record-id')} does not have its digest")
                    size = len(payload) if response else int(http_field(head, b"Content-Length") or 0)
                    rows.append((fields["warc-record-id"].strip("<>"), fields["warc-type"], fields.get("warc-target-uri"), fields.get("warc-date"), int(page) if page else None, payload if response else None, size, said,
                                 fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None))
                if rows:
                    c = list(zip(*rows, strict=True))
                    text = pa.string()
                    kinds = [text, text, text, text, pa.int64(), pa.binary(), pa.int64(), text, text]
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds, strict=True)], names)

    names = ["record_id", "record_type", "url", "date", "page_id", "payload", "payload_bytes", "payload_digest", "refers_to_id"]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "record_id string, record_type string, url string, date string, page_id long, payload binary, payload_bytes long, payload_digest string, refers_to_id string")


def archive_pages(pages: DataFrame, path: str, least: int = 0) -> DataFrame:
    """Write the pages as legacy archives, convert them, write the WARC files to ``path`` and read them back: a row per page with page_id,
    payload_bytes, payload_digest, record_type and refers_to (the page_id of the response).

    Null html is an empty payload. Equal payloads revisit each other whatever their URLs. Repeated rows are archived each. An empty table
    writes no record. Other columns are not read.
    """
    write_warc(mark_revisits(convert(arc_archives(pages)), least), path)
    back = read_warc(pages.sparkSession, path).select("record_id", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_to_id")
    first = back.where(F.col("record_type") == "response").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).dropDuplicates(["refers_to_id"])
    revisits = back.where(F.col("record_type") == "revisit").join(first, "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return back.where(F.col("record_type") == "response").select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(revisits.select(*columns, "refers_to"))
