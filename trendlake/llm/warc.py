"""WARC archives of pages: a writer with identical-payload revisits and a
salvage reader.

Writer.  One gzip member per record.  Pages are compared by payload length and
SHA-1; of equal payloads (of ``threshold`` bytes at least) the smallest id is
the ``response``, the others are ``revisit`` records without payload, whose
block keeps the HTTP head with the full length.  Only ids, lengths and digests
are grouped; the files go through Spark's own text writer and its commit, so
a lost task leaves no half archive: a row is a finished member and the line
separator is an empty gzip member.

Salvage reader.  One archive is one row of Spark's ``binaryFile`` source.  From
the first byte on, a gzip member (inflated whole, its CRC and length checked) or
a plain version line is expected; a record's head, Content-Length, end marks,
block digest and payload digest are checked.  After a failed check the reader
searches on for the next member or version line whose record passes all of
them, goes on from there, and logs the bytes between as a gap.  Good members
in whose text a record fails are searched in the same way; their gap names the
member's bytes.

Bounds.  An archive holds about ``ARCHIVE_BYTES`` of payload (a page is never
split); the reader holds one archive and one inflated member, and foreign
archives must stay below the 2 GB of a ``binaryFile`` row.

Defined cases: null html is the empty payload; null url writes no target; null
ids are last when the smallest is taken, and with no other id in their group
they are all responses; rows that repeat id and payload are all responses, or all
revisits of the smallest id; an empty table gives archives without records; an
empty file has neither records nor gaps; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm.common import scratch_path, ship_code, spread, table, written

ARCHIVE_BYTES = 32 << 20
SLICE_BYTES = 16 << 20
THRESHOLD = 0
DATE = "2024-01-01T00:00:00Z"
MAX_HEAD = 1 << 20
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"\x1f\x8b\x08|(?:(?<=\n)|(?<![\s\S]))WARC/1\.[01]\r\n")
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def member(data: bytes) -> bytes:
    """One gzip member."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


EMPTY_MEMBER = member(b"")


def sha1(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def sha1_column(payload):
    """Upper-case base32 SHA-1 of a binary Column, in built-in functions: each
    40 bits (10 hex digits) are 8 digits of base 32."""
    part = lambda i: F.lpad(F.conv(F.substring(F.sha1(payload), 10 * i + 1, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*[part(i) for i in range(4)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def page_urn(page: str | None) -> str:
    return "urn:page-without-id" if page is None else "urn:page:" + quote(page, safe="")


def build(page, url, payload: bytes, first=None, revisit: bool = False, date: str = DATE) -> bytes:
    """Bytes of one uncompressed WARC record."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{page_urn(page)}>"),
              ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<{page_urn(first)}>")]
    fields += [("WARC-Payload-Digest", "sha1:" + sha1(payload)), ("WARC-Block-Digest", "sha1:" + sha1(block)),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


# --- reading ---------------------------------------------------------------------

def _fields(text: bytes) -> dict[str, str]:
    found = {}
    for line in text.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            found[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return found


def _whole(value: str | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(r"[0-9]{1,18}", value) else None


def record_at(data: bytes, at: int):
    """(record, its end) of the record whose version line is at ``at``, or
    (None, what failed)."""
    line = _VERSION.match(data, at)
    if not line:
        return None, "no version line"
    head_end = data.find(b"\r\n\r\n", line.end() - 2, at + MAX_HEAD)
    if head_end < 0:
        return None, "head without end"
    fields = _fields(data[line.end():head_end])
    length = _whole(fields.get("content-length"))
    if length is None or "warc-type" not in fields or "warc-record-id" not in fields:
        return None, "head lacks a field"
    start, end = head_end + 4, head_end + 4 + length
    if data[end:end + 4] != b"\r\n\r\n":
        return None, "length does not fit"
    block = data[start:end]
    payload, told = block, length
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        told = _whole(_fields(http).get("content-length"))
        told = len(payload) if told is None else told
    kind = fields["warc-type"]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if fields.get("warc-block-digest", "").startswith("sha1:") and fields["warc-block-digest"][5:] != sha1(block):
        return None, "block digest differs"
    if kind != "revisit":
        if told != len(payload):
            return None, "payload length differs"
        own = sha1(payload)
        if digest and fields["warc-payload-digest"].startswith("sha1:") and digest != own:
            return None, "payload digest differs"
        digest = own
    return {"type": kind, "record_id": fields["warc-record-id"].strip("<>"), "target": fields.get("warc-target-uri"),
            "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "payload_bytes": told, "payload_digest": digest, "payload": payload}, end + 4


def _inflated(data, at: int):
    """(text, end) of the gzip member at ``at``, or (None, what failed)."""
    z, view, parts, pos = zlib.decompressobj(31), memoryview(data), [], at
    try:
        while not z.eof:
            if pos >= len(data):
                return None, "member is cut off"
            parts.append(z.decompress(view[pos:pos + (1 << 16)]))
            pos += 1 << 16
    except zlib.error as e:
        return None, "member is damaged: " + str(e)[:60]
    return b"".join(parts), min(pos, len(data)) - len(z.unused_data)


def salvage(data: bytes, members: bool = True):
    """Entries of an archive in order of bytes: ("record", start, end, record)
    and ("gap", start, end, what failed)."""
    at, gap, why = 0, None, None
    while at < len(data):
        if members and data.startswith(MAGIC, at):
            text, end = _inflated(data, at)
            if text is not None:
                inside = list(salvage(text, False))
                if not text or any(x[0] == "record" for x in inside):
                    if gap is not None:
                        yield "gap", gap, at, why
                        gap = None
                    for kind, _, _, what in inside:
                        yield kind, at, end, what if kind == "record" else "inside the member: " + what
                    at = end
                    continue
                # a whole member without any good record: quarantined as it stands
                failed = "inside the member: " + inside[0][3]
            else:
                end, failed = at + 1, end
        else:
            record, end = record_at(data, at)
            if record is not None:
                if gap is not None:
                    yield "gap", gap, at, why
                    gap = None
                yield "record", at, end, record
                at = end
                continue
            end, failed = at + 1, end
        if gap is None:
            gap, why = at, failed
        found = _START.search(data, end)
        at = found.start() if found else len(data)
    if gap is not None:
        yield "gap", gap, len(data), why


ENTRY = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("gap", pa.string()),
                   ("type", pa.string()), ("record_id", pa.string()), ("target", pa.string()),
                   ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("payload", pa.binary())])
ENTRY_DDL = ("path string, start long, end long, gap string, type string, record_id string, target string, "
             "refers_to string, payload_bytes long, payload_digest string, payload binary")


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record (``gap`` null) and per quarantined byte range (``gap``
    says which check failed first, ``start`` and ``end`` which bytes) of the
    archives in ``path``; records of a member carry the member's range.
    Without ``payload`` that column is null."""
    ship_code(spark)

    def read(batches):
        from trendlake.llm import warc
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                name, rows, size = name.as_py(), [], 0
                for kind, start, end, what in warc.salvage(data.as_buffer().to_pybytes()):
                    row = {"path": name, "start": start, "end": end}
                    row |= what if kind == "record" else {"gap": what}
                    if not payload:
                        row.pop("payload", None)
                    rows.append(row)
                    size += 200 + len(row.get("payload") or b"")
                    if size > warc.SLICE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=warc.ENTRY)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=warc.ENTRY)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path)
    return files.select("path", "content").mapInArrow(read, ENTRY_DDL)


# --- writing ---------------------------------------------------------------------

def write_archives(pages: DataFrame, path: str, threshold: int = THRESHOLD, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> None:
    """Write a record per row of ``pages`` to archives in the folder ``path``."""
    spark = pages.sparkSession
    ship_code(spark)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    key = rows.select("id", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("digest"))
    # every repeated payload with its smallest id: digests only, counted before they are shuffled
    repeated = written(key.where(F.col("n") >= threshold).groupBy("digest", "n")
                       .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")), "warc-digests")
    size = repeated.agg(F.sum(F.col("n") * F.col("copies")), F.sum("copies")).first()
    per_file = max(1, int(ARCHIVE_BYTES * size[1] / size[0])) if size[0] else 1 << 16
    found = spread(rows).withColumn("n", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    found = found.join(repeated.where("copies > 1"), ["digest", "n"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    found = found.select(F.col("id").cast("string").alias("page"), "url", "payload",
                         F.col("first").cast("string").alias("first"), revisit.alias("revisit"))

    def pack(batches):
        from trendlake.llm import warc
        for batch in batches:
            out, size = [], 0
            for page, url, payload, first, revisit in zip(*batch.columns):
                record = warc.build(page.as_py(), url.as_py(), payload.as_py(), first.as_py(), revisit.as_py())
                out.append(warc.member(record))
                size += len(out[-1])
                if size > warc.SLICE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    (found.mapInArrow(pack, "member binary").select(F.col("member").cast("string").alias("value"))
     .write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", per_file).text(path))


def archive_pages(pages: DataFrame, threshold: int = THRESHOLD, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", payload: bool = False) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back:
    the entries of ``read_archives`` with ``page`` (the id) and ``first`` (that of the
    response a revisit names) in the type of the ids."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, threshold, id_col, url_col, html_col)
    kind = pages.schema[id_col].dataType
    entries = read_archives(spark, path, payload)
    number = lambda c: F.url_decode(F.when(F.startswith(c, F.lit("urn:page:")), F.substring(c, 10, 1 << 30))).cast(kind)
    return entries.withColumns({"page": number(F.col("record_id")), "first": number(F.col("refers_to"))})


def op12_warc(spark, sf_dir):
    records = archive_pages(table(spark, sf_dir, "pages")).where("gap IS NULL")
    return records.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest",
                          F.col("type").alias("record_type"), F.col("first").alias("refers_to"))


OP12_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS n, sha1(b) AS h FROM p),
f AS (SELECT h, n, min(page_id) AS first FROM h GROUP BY h, n),
d AS (SELECT *, array_to_string([substr('{_BASE32}',
        1 + CAST((CAST('0x' || substr(h, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)
        FOR i IN range(32)], '') AS digest FROM h)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d JOIN f USING (h, n)
"""
