"""Legacy web archives (ARC, versions 1 and 2) converted to WARC, as Spark jobs over archive files.

Files are written with Spark's text sink (one record per row, its end as the line separator) and read whole, one
file a row, so they work on any store. A writer of ARC files starts a new one after so many records as make up
FILE_BYTES at most; records larger than that have files of their own. WARC files are bounded in the same way by
FILE_RECORDS and WARC_BYTES. Payloads are bytes throughout and need be no text.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, written

FILE_RECORDS, FILE_BYTES, WARC_BYTES = 2000, 64 << 20, 256 << 20
# How hard the text sink's gzip tries: beyond this level files hardly shrink, and the time grows.
GZIP = {"compression": "gzip", "zlib.compress.level": "FOUR"}
# The header lines of a version block, and the fields of a record line, by ARC version.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
NO_ADDRESS, NO_DATE = "0.0.0.0", "19700101000000"


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """ARC files of pages (page_id, url, html as string or binary): each file one or more records after a version block.

    Null html: an empty payload; null url: `unknown:`; blanks in a url are escaped. The page id is kept in a header line
    of the record's own HTTP head. Rows that repeat or share an id are a record each; other columns are ignored. An empty
    table leaves no records.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.coalesce(F.nullif("url", F.lit("")), F.lit("unknown:")), "[\\x00-\\x20\\x7f]", "%20").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"),
    )
    head = F.concat(F.lit("HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit("\r\n\r\n"))
    length = (F.octet_length(head) + F.octet_length("html")).cast("string")
    mime = F.lit("text/html")
    fields = {1: [F.col("url"), F.lit(NO_ADDRESS), F.lit(NO_DATE), mime, length], 2: [F.col("url"), F.lit(NO_ADDRESS), F.lit(NO_DATE), mime, F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc"), length]}[version]
    about = f"{version} 0 formfields\n{ARC_FIELDS[version]}\n"
    first = f"filedesc://pages.arc {NO_ADDRESS} {NO_DATE} text/plain " + ("200 - - 0 pages.arc " if version == 2 else "") + f"{len(about)}\n{about}"
    # The version block comes with each record's line, since rows of a file have no order of their own.
    lines = rows.select(F.concat(F.lit(first + "\n"), F.concat_ws(" ", *fields), F.lit("\n"), head, F.col("html").cast("string")).alias("value"), size_class().alias("size_class"))
    for size in sorted(r[0] for r in rows.select(size_class()).distinct().collect()):
        out = lines.where(F.col("size_class") == size).select("value")
        out.write.mode("append").option("lineSep", "\n").option("maxRecordsPerFile", max(1, FILE_RECORDS >> 3 * size)).options(**GZIP).text(path)
    if not rows.limit(1).count():
        lines.select("value").write.mode("append").text(path)


def size_class(size: Column | None = None, file_bytes: int = FILE_BYTES) -> Column:
    """0 for payloads of which FILE_RECORDS make up file_bytes at most, then one more for each factor of eight, and the last for all beyond."""
    size = F.octet_length("html") if size is None else size
    small = file_bytes // FILE_RECORDS
    classes = F.when(size <= small, 0)
    for k in range(1, 5):
        classes = classes.when(size <= small << 3 * k, k)
    return classes.otherwise(5)


def arc_records(content: bytes) -> Iterator[dict]:
    """The records of an ARC file; version blocks set the fields that follow, and are not records themselves.

    Record lines are split from the right by the version's number of fields, so an address may hold blanks. A line that
    still is none (no length at its end, too few fields) is passed over up to the next line that is one; at the end comes
    one entry {"skipped": bytes} where there were such lines.
    """
    fields = ARC_FIELDS[1].split()
    at = skipped = 0
    while at < len(content):
        if content[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = content.find(b"\n", at)
        if end < 0:
            skipped += len(content) - at
            break
        text = content[at:end].decode("utf-8", "replace").rstrip("\r")
        if text.startswith("filedesc:"):
            last = text.split(" ")[-1]
            size = int(last) if last.isdigit() else 0
            block = content[end + 1 : end + 1 + size].decode("utf-8", "replace").splitlines()
            version = block[0].split(" ")[0] if block else "1"
            fields = (block[1] if len(block) > 1 else ARC_FIELDS[2 if version == "2" else 1]).split()
            at = end + 1 + size
            continue
        line = text.rsplit(" ", len(fields) - 1)
        if len(line) != len(fields) or not line[-1].isdigit() or ":" not in line[0]:
            skipped += end + 1 - at
            at = end + 1
            continue
        size = int(line[-1])
        yield dict(zip(fields, line, strict=True)) | {"at": at, "block": content[end + 1 : end + 1 + size]}
        at = end + 1 + size
    if skipped:
        yield {"skipped": skipped}


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """The head of an HTTP response and its payload. A block without such a head (dns: and the like) is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [(k, len(s)) for s in (b"\r\n\r\n", b"\n\n") if (k := block.find(s)) >= 0]
    if not ends:
        return block, b""
    k, n = min(ends)
    return block[:k], block[k + n :]


def header_lines(head: bytes) -> dict[str, str]:
    """The header lines of a record or an HTTP head, without its first line."""
    return dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")[1:] if ": " in x)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324


def warc_date(stamp: str) -> str:
    s = (stamp if stamp.isdigit() else NO_DATE)[:14].ljust(14, "0")
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}T{s[8:10]}:{s[10:12]}:{s[12:14]}Z"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def unpacked(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


CONVERTED = "page_id long, url string, date string, address string, mime string, http binary, payload binary, payload_bytes long, payload_digest string, record_id string"


def convert_arc(files: DataFrame) -> DataFrame:
    """A row for each ARC record, with what its WARC record needs: identifier, time stamp, digest and length.

    Identifiers are made of the file's name, the record's place in it and its address, date and payload, so that equal
    records have different ones and another run has the same. Lines that are no record are left out; skipped_bytes counts them.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                rows: list[tuple] = []
                held, file = 0, path.as_py().rsplit("/", 1)[-1]
                for r in arc_records(unpacked(content.as_py())):
                    if "skipped" in r:
                        continue
                    head, payload = http_parts(r["block"])
                    own = header_lines(head).get("X-Page-Id", "-")
                    page_id = int(own) if own.lstrip("-").isdigit() else None
                    sha = digest(payload)
                    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{file} {r['at']} {r['URL']} {r['Archive-date']} {sha}")
                    rows.append((page_id, r["URL"], warc_date(r["Archive-date"]), r["IP-address"], r["Content-type"], head, payload, len(payload), sha, f"<urn:uuid:{name}>"))
                    held += len(payload)
                    if held > 2 << 20:
                        yield as_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    return files.mapInArrow(per_batch, CONVERTED)


def skipped_bytes(spark: SparkSession, path: str) -> DataFrame:
    """path and skipped of the ARC files that hold lines which are no record and belong to none."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                lost = sum(r.get("skipped", 0) for r in arc_records(unpacked(content.as_py())))
                if lost:
                    yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), pa.array([lost], pa.int64())], names=["path", "skipped"])

    return read_files(spark, path).mapInArrow(per_batch, "path string, skipped long")


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.string()] * 4, pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = [x.split()[0] for x in CONVERTED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def payloads_known(records: DataFrame) -> DataFrame:
    """payload_digest, payload_bytes and, of the records with an HTTP head, the last (page_id, record_id) that has it."""
    http = F.octet_length("http") > 0
    return records.groupBy("payload_digest", "payload_bytes").agg(F.max(F.when(http, F.struct("page_id", "record_id"))).alias("last"))


def with_types(records: DataFrame, known: DataFrame, at_least: int = 0) -> DataFrame:
    """record_type, refers_to and refers_id: of records with equal payloads of at_least bytes or more, the one with the largest page id is the response.

    A payload that very many pages share is one row after partial aggregation; the join's other side can be split. Of
    pages that tie in their id (or have none: those come last) the greatest identifier is the response. Records without
    an HTTP head are resources, and neither refer nor are referred to. known is what payloads_known finds in the records.
    """
    http = F.octet_length("http") > 0
    both = records.join(known.where(F.col("last").isNotNull() & (F.col("payload_bytes") >= at_least)), ["payload_digest", "payload_bytes"], "left")
    revisit = http & F.col("last").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("last.record_id"))
    return both.select(*records.columns, F.when(revisit, "revisit").when(http, "response").otherwise("resource").alias("record_type"), F.when(revisit, F.col("last.page_id")).alias("refers_to"), F.when(revisit, F.col("last.record_id")).alias("refers_id"))


def warc_text(records: DataFrame) -> Column:
    """A WARC/1.1 record without its closing blank lines. A revisit has the HTTP head but no payload, a resource the payload alone.

    Bytes pass through the string type as they are; nothing decodes them.
    """
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    http, payload = F.col("http").cast("string"), F.col("payload").cast("string")
    resource = F.col("record_type") == "resource"
    block = F.when(resource, payload).otherwise(F.concat(http, F.lit("\r\n\r\n"), F.when(revisit, "").otherwise(payload)))
    optional = F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", F.col("refers_id")), line("X-Refers-To-Page", F.coalesce(F.col("refers_to").cast("string"), F.lit("-"))))).otherwise("")
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("url")),
        line("WARC-IP-Address", F.col("address")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")), line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("X-Page-Id", F.coalesce(F.col("page_id").cast("string"), F.lit("-"))), optional,
        line("Content-Type", F.when(resource, F.col("mime")).otherwise("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block,
    )


def write_warc(records: DataFrame, path: str, classes: list[int]) -> None:
    """WARC files of the records, those of each size class apart, so that a file holds WARC_BYTES of payloads at most or a single record."""
    out = records.select(warc_text(records).alias("value"), size_class(F.col("payload_bytes"), WARC_BYTES).alias("size_class"))
    for size in classes or [0]:
        rows = out.where(F.col("size_class") == size).select("value")
        rows.write.mode("append").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", max(1, FILE_RECORDS >> 3 * size)).options(**GZIP).text(path)


def warc_records(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each record of a WARC file, by declared lengths."""
    at = 0
    while (at := content.find(b"WARC/", at)) >= 0:
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            return
        headers = header_lines(content[at:end])
        size = int(headers.get("Content-Length", "0"))
        yield headers, content[end + 4 : end + 4 + size]
        at = end + 4 + size


READ = "page_id long, url string, record_id string, date string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of WARC files (responses, revisits, resources). Digests and lengths are taken from the payload read, those of revisits from the header; payload is null where `payloads` is false."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda s: int(s) if s and s.lstrip("-").isdigit() else None
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for h, block in warc_records(unpacked(content.as_py())):
                    if h.get("WARC-Type") not in ("response", "revisit", "resource"):
                        continue
                    whole = h["WARC-Type"] != "revisit"
                    payload = block if h["WARC-Type"] == "resource" else http_parts(block)[1]
                    rows.append((
                        number(h.get("X-Page-Id")), h.get("WARC-Target-URI"), h.get("WARC-Record-ID"), h.get("WARC-Date"),
                        len(payload) if whole else number(h.get("X-Payload-Length")), digest(payload) if whole else h.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
                        h["WARC-Type"], number(h.get("X-Refers-To-Page")), payload if payloads else None,
                    ))
                if rows:
                    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in READ.split(", ")])

    return read_files(spark, path).mapInArrow(per_batch, READ)


def archive_to_warc(spark: SparkSession, arc_path: str, warc_path: str, at_least: int = 0) -> None:
    """Convert ARC files to WARC files, equal payloads of at_least bytes or more kept once.

    Records that repeat are a record each. A folder of ARC files without records gives WARC files without records; one
    without files is an error of the reader.
    """
    records = convert_arc(read_files(spark, arc_path))
    known = written(payloads_known(records), "payloads")
    classes = sorted(r[0] for r in known.select(size_class(F.col("payload_bytes"), WARC_BYTES)).distinct().collect())
    write_warc(with_types(records, known, at_least), warc_path, classes)
    dropped(known)
