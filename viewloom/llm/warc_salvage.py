"""WARC archives: a writer that stores equal payloads once, and a reader that salvages what a damaged archive still holds.

Writing. Records are built in tasks and written by Spark's own text writer, so archives go to any store that Spark writes to
and a lost task is simply run again. Each record is a gzip member of its own (or plain). The text writer ends every row with a
separator: for plain records that is the last line break of the record; for members it is the last byte of the length field,
which is zero below 16 MB (a larger record is followed by an empty member, which ends with a zero).

Reading. At each place the reader expects a member or a version line. After a check that fails (member checksum, version,
headers, length, record end, block or payload digest) it searches for the next place at which a valid record begins, goes
on there, and gives the bytes between as a quarantined gap with the reason.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import query, scratch, stored, table

# Fixed values of the format.
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
MEMBER = b"\x1f\x8b\x08"

#: Bytes of payload that one archive holds, about: its number of records is this by their mean size.
ARCHIVE_BYTES = 32 << 20
#: Payloads from this size on are stored once.
LEAST_SHARED = 1000
#: Bytes of a member that are inflated at a time, and of records that are built at a time.
PIECE, BATCH = 1 << 16, 1 << 22
DATE = "2000-01-01T00:00:00Z"
NAME = "urn:page:"

_PLACE = re.compile(re.escape(MEMBER) + rb"|WARC/1\.[01]\r\n")
#: What a URL may hold as it is; the rest is percent-encoded, since a header is one line of ASCII.
_PLAIN = "%:/?#[]@!$&'()*+,;=-._~"


class Damaged(Exception):
    """Why no valid record begins at a place."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    payload: bytes
    version: str


def labelled(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def unlabelled(value: str) -> str | None:
    """Hex of a labelled SHA-1 in base 32 or hex; None for other algorithms."""
    name, _, digest = value.partition(":")
    try:
        if name.strip().lower() != "sha1":
            return None
        return digest.lower() if len(digest) == 40 else base64.b32decode(digest.upper()).hex()
    except ValueError:
        raise Damaged("unreadable digest") from None


def build(page_id: int | None, url: str | None, payload: bytes, sha1: str, of: int | None, date: str = DATE) -> bytes:
    """One record: a response with its payload, or a revisit of page `of` without it."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if of is None:
        block += payload
    named = f"{NAME}{page_id}" if page_id is not None else f"urn:sha1:{sha1}"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if of is None else 'revisit'}", f"WARC-Record-ID: <{named}>", f"WARC-Date: {date}"]
    if url:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_PLAIN, errors='replace')}")
    lines.append(f"WARC-Payload-Digest: {labelled(bytes.fromhex(sha1))}")
    lines.append(f"WARC-Block-Digest: {labelled(hashlib.sha1(block).digest())}")
    if of is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{NAME}{of}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def member(record: bytes, level: int = 1) -> bytes:
    """A gzip member that ends with a zero byte."""
    packed = zlib.compress(record, level, 31)
    return packed if packed[-1] == 0 else packed + zlib.compress(b"", level, 31)


def write_archives(pages: DataFrame, folder: str, compressed: bool = True, archive_bytes: int = ARCHIVE_BYTES, least_shared: int = LEAST_SHARED) -> None:
    """One record for each row of `pages` (page_id, url, html) in archives under `folder`; payload is the html, null as empty.

    Of rows with equal payloads of at least `least_shared` bytes, those with the largest page_id are responses and the others
    revisit them. Rows without page_id, and shorter payloads, are responses. Repeated rows have a record each. Payloads are told apart
    by SHA-1 and a second hash. An empty table gives no records. Further columns are not read.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"sha1": F.sha1("html"), "tag": F.xxhash64("html"), "bytes": F.octet_length("html").cast("long")})
    payloads = stored(rows.groupBy("sha1", "tag", "bytes").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")), f"{scratch(spark)}/payloads")
    total = payloads.agg(F.sum(F.col("n") * F.col("bytes")).alias("bytes"), F.sum("n").alias("n")).first()
    per_file = max(1, archive_bytes * (total["n"] or 0) // max(total["bytes"] or 1, 1))
    shared = payloads.where((F.col("n") > 1) & (F.col("bytes") >= least_shared)).select("sha1", "tag", "last")
    decided = rows.join(shared, ["sha1", "tag"], "left")  # few rows, or a hot payload that adaptive execution splits
    of = F.when(F.col("page_id") < F.col("last"), F.col("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "sha1", "of")]
            held, size = [], 0
            for at in range(batch.num_rows):
                page, url, html, sha1, of = (c[at].as_py() for c in columns)
                record = build(page, url, html, sha1, of)
                held.append(member(record)[:-1] if compressed else record[:-2])
                size += len(held[-1])
                if size >= BATCH or at == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).view(pa.utf8())], ["value"])
                    held, size = [], 0

    built = decided.select("page_id", "url", F.col("html").cast("binary").alias("html"), "sha1", of.alias("of")).mapInArrow(run, "value string")
    writer = built.write.option("lineSep", "\0" if compressed else "\r\n").option("maxRecordsPerFile", per_file)
    writer.text(folder)


def plain_record(data: bytes, at: int) -> tuple[Record, int]:
    """The record that begins at `at` with its version line, and where it ends."""
    if data[at : at + 8] not in VERSIONS:
        raise Damaged("no member or version line")
    start = data.find(END, at) + len(END)
    if start < at + len(END):
        raise Damaged("header without an end")
    version, *lines = data[at : start - len(END)].split(b"\r\n")
    if version not in VERSIONS:
        raise Damaged("no member or version line")
    headers: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (b" ", b"\t") and last:  # folded lines
            headers[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a name")
        last = name.strip().decode("utf-8", "replace").lower()
        headers[last] = value.strip().decode("utf-8", "replace")
    if not headers.get("warc-type") or not headers.get("warc-record-id") or not re.fullmatch("[0-9]{1,18}", headers.get("content-length", "")):
        raise Damaged("header without type, id or length")
    end = start + int(headers["content-length"])
    if data[end : end + len(END)] != END:
        raise Damaged("record doesn't end where its length says")
    block = data[start:end]
    payload = block.partition(END)[2] if headers.get("content-type", "").replace(" ", "").startswith("application/http") else block
    for name, part in (("warc-block-digest", block), ("warc-payload-digest", payload)):
        want = unlabelled(headers[name]) if name in headers else None
        if name == "warc-payload-digest" and headers["warc-type"] == "revisit":
            continue  # of a payload that isn't here
        if want and want != hashlib.sha1(part).hexdigest():
            raise Damaged(f"{name[5:].replace('-', ' ')} differs")
    return Record(headers, block, payload, version.decode()), end + len(END)


def inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the member at `at`, whose checksum and length zlib checks, and where it ends."""
    inflate, parts, to = zlib.decompressobj(31), [], at
    try:
        while not inflate.eof:
            piece = data[to : to + PIECE]
            if not piece:
                raise Damaged("member without an end")
            to += len(piece)
            parts.append(inflate.decompress(piece))
    except zlib.error as e:
        raise Damaged(f"member: {str(e).rpartition(': ')[2]}") from None
    return b"".join(parts), to - len(inflate.unused_data)


def record_at(data: bytes, at: int) -> tuple[list[Record], int]:
    """The records of the member, or the record with the version line, at `at`; none for an empty member."""
    if data[at : at + len(MEMBER)] != MEMBER:
        record, end = plain_record(data, at)
        return [record], end
    content, end = inflated(data, at)
    records, within = [], 0
    while within < len(content):
        record, within = plain_record(content, within)
        records.append(record)
    return records, end


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | None, str | None]]:
    """(offset, length, record, None) for each record of an archive, and (offset, length, None, reason) for each gap."""
    at = 0
    while at < len(data):
        try:
            records, end = record_at(data, at)
        except Damaged as why:
            records, end = [], at
            start, at = at, len(data)
            for place in _PLACE.finditer(data, start + 1):
                try:
                    records, end = record_at(data, place.start())
                except Damaged:
                    continue
                at = place.start()
                break
            yield start, at - start, None, str(why)
            if at == len(data):
                return
        for record in records:
            yield at, end - at, record, None
        at = end


FIELDS = "path string, offset bigint, length bigint, record_type string, record_id string, refers_to string, target_uri string, date string, payload_bytes bigint, payload_digest string, fault string"


def described(path: str, offset: int, length: int, record: Record | None, fault: str | None) -> dict:
    row = {"path": path, "offset": offset, "length": length, "fault": fault}
    if record is None:
        return row
    h = record.headers
    bare = lambda name: h[name].strip("<>") if name in h else None
    row |= {"record_type": h["warc-type"], "record_id": bare("warc-record-id"), "refers_to": bare("warc-refers-to"), "target_uri": h.get("warc-target-uri"), "date": h.get("warc-date")}
    if h["warc-type"] == "revisit":
        size = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})\r?$", record.block)
        return row | {"payload_bytes": int(size[1]) if size else None, "payload_digest": unlabelled(h.get("warc-payload-digest", ""))}
    return row | {"payload": record.payload, "payload_bytes": len(record.payload), "payload_digest": hashlib.sha1(record.payload).hexdigest()}


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """(path, offset, length, record_type, record_id, refers_to, target_uri, date, payload_bytes, payload_digest, fault,
    payload): a row for each record of the archives under `folder`, plain or in members, and one for each quarantined gap, with
    `fault`. A revisit's size and digest are those of the payload that it refers to, as its headers have them; a
    response's are taken from the payload itself. An archive is held whole by one task, so it may have 2 GB at most.
    """
    schema = FIELDS + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    shape = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                held, size = [], 0
                for found in salvage(content.as_py()):
                    row = described(path.as_py(), *found)
                    held.append({n: row.get(n) for n in names})
                    size += len(row.get("payload") or b"") if payloads else 0
                    if size >= BATCH or len(held) >= 4096:
                        yield pa.RecordBatch.from_pylist(held, shape)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, shape)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInArrow(run, schema)


def page_of(uri: str) -> Column:
    return F.regexp_extract(uri, f"^{NAME}(-?[0-9]+)$", 1).try_cast("long")


ORACLE = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM payloads
"""


@query("op12_warc_salvage", ORACLE)
def op12_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch(spark)}/archives"
    write_archives(table(spark, sf_dir, "pages"), folder)
    records = read_archives(spark, folder, payloads=False).where(F.col("fault").isNull())
    return records.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))
