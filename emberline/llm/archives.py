"""Legacy ARC archives, their conversion to WARC, and reading both back, all through Spark's own files."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm.common import shared_path

ARCHIVE_BYTES = 4 << 20
# The field lines that the version blocks of the two ARC versions declare.
FIELDS = {
    b"1": b"URL IP-address Archive-date Content-type Archive-length",
    b"2": b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
HTTP_KEY = b"X-Record-Key"
REVISIT = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- ARC


def arc_record(version: bytes, name: bytes, offset: int, url: bytes, ip: bytes, date: bytes, mime: bytes, body: bytes) -> bytes:
    """One URL record: its header line in the version's form, and the body of the declared length."""
    url = re.sub(rb"[\r\n]", lambda m: b"%%%02X" % m[0][0], url) or b"-"
    extra = b"" if version == b"1" else b" 200 - - %d %s" % (offset, name)
    return b" ".join([url, ip, date, mime]) + extra + b" %d\n" % len(body) + body + b"\n"


def arc_version_block(version: bytes, name: bytes, date: bytes) -> bytes:
    body = version + b" 0 archive\n" + FIELDS[version] + b"\n"
    return b"filedesc://%s 0.0.0.0 %s text/plain " % (name, date) + (
        b"" if version == b"1" else b"200 - - 0 %s " % name) + b"%d\n" % len(body) + body + b"\n"


def read_arc(data: bytes) -> Iterator[dict]:
    """The URL records of an archive, by the header lines and lengths that its version block declares."""
    at, fields, number = 0, None, 0
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            end = len(data)
        line = data[at:end].rstrip(b"\r")
        if not line:
            at = end + 1
            continue
        if fields is None:  # the version block: its own line ends with its length
            if not line.startswith(b"filedesc://"):
                raise ValueError("an ARC archive begins with a filedesc record")
            body = data[end + 1:end + 1 + int(line.rsplit(b" ", 1)[1])]
            head = body.split(b"\n")
            if head[0].split(b" ")[0] not in FIELDS:
                raise ValueError(f"unknown ARC version {head[0]!r}")
            fields = head[1].strip().lower().split(b" ")
            at = end + 1 + len(body)
            continue
        values = line.rsplit(b" ", len(fields) - 1)  # a URL may hold spaces
        if len(values) != len(fields):
            raise ValueError(f"an ARC header line has {len(values)} of {len(fields)} fields")
        record = dict(zip(fields, values, strict=True))
        size = int(record[b"archive-length"])
        if end + 1 + size > len(data):
            raise ValueError("an ARC record is shorter than its declared length")
        yield {"number": number, "url": record[b"url"], "ip": record[b"ip-address"], "date": record[b"archive-date"],
               "mime": record[b"content-type"], "body": data[end + 1:end + 1 + size]}
        number += 1
        at = end + 1 + size


def http_parts(url: bytes, body: bytes) -> tuple[bytes, bytes]:
    """(headers, payload) of a body; only http bodies have headers."""
    if not url.lower().startswith((b"http:", b"https:")) or not body.startswith(b"HTTP/"):
        return b"", body
    cut = body.find(b"\r\n\r\n")
    return (body, b"") if cut < 0 else (body[:cut + 4], body[cut + 4:])


def key_in(headers: bytes) -> int | None:
    found = re.search(rb"(?mi)^" + HTTP_KEY + rb": *(-?\d+)\r?$", headers)
    return int(found[1]) if found else None


# ---- WARC


def warc_date(date: bytes) -> bytes:
    """The time of an ARC date of 14 digits, or of the first of them, as WARC wants it."""
    digits = re.sub(rb"\D", b"", date)[:14]
    text = (digits + b"00010101000000"[len(digits):]).decode()
    return datetime.strptime(text, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ").encode()


def record_id(*parts: object) -> bytes:
    """An identifier that is the same whenever the record is made again."""
    return b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, "\n".join(map(str, parts)))).encode()


def warc_record(kind: bytes, body: bytes, **fields: bytes | None) -> bytes:
    head = [b"WARC/1.1", b"WARC-Type: " + kind]
    head += [k.replace("_", "-").encode() + b": " + v for k, v in fields.items() if v is not None]
    return b"\r\n".join([*head, b"Content-Length: %d" % len(body), b"", b""]) + body + b"\r\n\r\n"


def converted(record: dict, refers_to: int | None) -> bytes:
    """The WARC record that stands for an ARC record; a revisit of ``refers_to`` where that is given."""
    url, body = record["url"], record["body"]
    headers, payload = http_parts(url, body)
    key, digest, date = key_in(headers), digest_of(payload), warc_date(record["date"])
    common = {
        "WARC_Record_ID": record_id(url, date, digest, key), "WARC_Date": date, "WARC_Target_URI": url,
        "WARC_IP_Address": record["ip"] if record["ip"] != b"0.0.0.0" else None,
        "WARC_Payload_Digest": b"sha1:" + digest.encode(), "WARC_Payload_Length": b"%d" % len(payload),
        "WARC_Record_Key": None if key is None else b"%d" % key,
    }
    if refers_to is not None:
        return warc_record(b"revisit", headers, **common, WARC_Profile=REVISIT, WARC_Refers_To_Key=b"%d" % refers_to,
                           Content_Type=b"application/http; msgtype=response")
    if headers:
        return warc_record(b"response", body, **common, Content_Type=b"application/http; msgtype=response")
    return warc_record(b"resource", body, **common, Content_Type=record["mime"])


def read_warc(data: bytes) -> Iterator[dict]:
    """The records of an archive: fields (names in lower case) and body, by the declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        head = data[at:end].split(b"\r\n")
        if end < 0 or not head[0].startswith(b"WARC/"):
            raise ValueError("a WARC record begins with its version")
        fields = {k.strip().lower().decode(): v.strip() for k, v in (line.split(b":", 1) for line in head[1:])}
        size = int(fields["content-length"])
        body = data[end + 4:end + 4 + size]
        if len(body) < size:
            raise ValueError("a WARC record is shorter than its declared length")
        yield {**fields, "body": body}
        at = end + 4 + size + 4


# ---- as Spark jobs


def write_archives(archives: DataFrame, path: str, separator: str) -> None:
    """Writes each row's ``archive`` as a compressed file of its own; ``separator`` is how every archive ends.

    The bytes go through Spark's text writer, which writes them as they are.
    """
    (archives.select(F.col("archive").cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).option("lineSep", separator).option("compression", "gzip").text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def unpacked(content: bytes) -> bytes:
    return zlib.decompress(content, 47) if content[:2] == b"\x1f\x8b" else content


def arc_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(archive) rows of about ``ARCHIVE_BYTES``: the pages as ARC records, in version 1 and 2 by turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, size = 0, [], 0
        date = b"20240101000000"

        def closed():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["archive"])

        for batch in batches:
            for key, url, payload in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "payload")), strict=True):
                version, name = b"12"[made % 2:made % 2 + 1], b"part-%d.arc" % made
                if not held:
                    held.append(arc_version_block(version, name, date))
                tag = b"" if key is None else HTTP_KEY + b": %d\r\n" % key
                body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n" + tag + b"\r\n" + payload
                held.append(arc_record(version, name, size, url, b"0.0.0.0", date, b"text/html", body))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    made, held, size = made + 1, [], 0
        if held:
            yield closed()

    link = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("key"),
        F.when(link.rlike("(?i)^https?:"), link).otherwise(F.concat(F.lit("http://unknown/"), link)).cast("binary").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    return rows.mapInArrow(run, "archive binary")


def arc_to_warc(arcs: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(archive) rows: each ARC archive (path, content) as a WARC archive.

    Of records with equal payloads of at least ``least_bytes`` bytes, those with the largest record key are
    kept whole and the others become revisits of them. Which they are is settled on digests alone; a payload
    moves once, compressed and with its whole archive, so a payload that stands in any share of the records
    crowds no task.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = []
                for r in read_arc(unpacked(content)):
                    headers, payload = http_parts(r["url"], r["body"])
                    rows.append((path, r["number"], key_in(headers), digest_of(payload), len(payload)))
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                    ["path", "number", "key", "digest", "size"])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, later in zip(*(batch.column(c).to_pylist() for c in ("path", "content", "later")), strict=True):
                revisits = {x["number"]: x["best"] for x in later or ()}
                name = path.rsplit("/", 1)[-1].encode()
                info = warc_record(b"warcinfo", b"software: ARC conversion\r\nformat: WARC File Format 1.1\r\n",
                                   WARC_Record_ID=record_id(path), WARC_Date=b"2024-01-01T00:00:00Z", WARC_Filename=name,
                                   Content_Type=b"application/warc-fields")
                out = b"".join([info, *(converted(r, revisits.get(r["number"])) for r in read_arc(unpacked(content)))])
                yield pa.RecordBatch.from_arrays([pa.array([out[:-4]], pa.binary())], ["archive"])

    seen = arcs.mapInArrow(digests, "path string, number long, key long, digest string, size long").where(F.col("size") >= least_bytes)
    best = seen.groupBy("digest", "size").agg(F.max("key").alias("best"))
    later = (seen.join(best, ["digest", "size"]).where("best IS NOT NULL AND (key IS NULL OR key < best)")
             .groupBy("path").agg(F.collect_list(F.struct("number", "best")).alias("later")))  # at most an archive's records
    return arcs.join(later, "path", "left").select("path", "content", "later").mapInArrow(convert, "archive binary")


def warc_records(warcs: DataFrame) -> DataFrame:
    """(key, url, payload_bytes, payload_digest, record_type, refers_to) of all records but the archives' own.

    The digest of every whole payload is taken again and must agree with the declared one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = []
                for r in read_warc(unpacked(content)):
                    kind = r["warc-type"].decode()
                    if kind == "warcinfo":
                        continue
                    declared, size = r["warc-payload-digest"].decode().removeprefix("sha1:"), int(r["warc-payload-length"])
                    if kind != "revisit":
                        payload = http_parts(r["warc-target-uri"], r["body"])[1] if kind == "response" else r["body"]
                        if digest_of(payload) != declared or len(payload) != size:
                            raise ValueError(f"the payload of {r['warc-record-id']!r} is not as declared")
                    key, refers = r.get("warc-record-key"), r.get("warc-refers-to-key")
                    rows.append((None if key is None else int(key), r["warc-target-uri"].decode("utf-8", "replace"), size, declared, kind,
                                 None if refers is None else int(refers)))
                columns = list(zip(*rows, strict=True)) or [()] * 6
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                                 ["key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return warcs.mapInArrow(run, "key long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def convert_pages(pages: DataFrame, least_bytes: int = 0, **columns) -> DataFrame:
    """Writes pages as ARC archives, converts those to WARC archives, and reads these back, one row per page.

    Both kinds of archive are written to the shared folder. Null payloads are empty, null links become
    placeholders, pages with a null id are never the response that others refer to, and rows of one id and
    payload are all responses; an empty table gives no rows and other columns are ignored.
    """
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_archives(arc_archives(pages, **columns), arc, "\n")
    write_archives(arc_to_warc(read_archives(spark, arc), least_bytes), warc, "\r\n\r\n")
    return warc_records(read_archives(spark, warc))
