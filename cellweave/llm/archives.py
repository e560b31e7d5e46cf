"""Legacy ARC archives, their conversion to WARC, and reading WARC back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import hot_join, may_match
from cellweave.session import cut_lineage, shared_folder

#: Payload bytes of an archive file, on average; a reader holds one file at a time.
FILE_BYTES = 16 << 20
SUFFIX = "*.txt.gz"
#: Payload bytes handed to Spark at once.
BATCH_BYTES = 4 << 20
#: The header lines of both versions of the ARC format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"

RECORDS = "page_id long, url string, ip string, date string, mime string, head string, payload binary, payload_bytes long, payload_digest string"
READ = "page_id long, record_type string, record_id string, refers_to_id string, payload_bytes long, payload_digest string, payload binary"


def digest(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    """The same identifier whenever the record is made again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}')}>"


def _url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")


def _records_per_file(rows: int, payload_bytes: int) -> int:
    """Rows of a file, its description among them, that hold about ``FILE_BYTES``."""
    return max(2, 1 + FILE_BYTES * rows // max(1, payload_bytes)) if rows else 2


def _write(records: DataFrame, path: str, per_file: int) -> None:
    """Records as they are, a line feed behind each, in gzip files of ``per_file`` rows."""
    records.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One ARC record per page, in files of about ``FILE_BYTES``; version 1 and 2 take turns.

    The payload is the page in UTF-8 behind HTTP headers; NULL is an empty payload.  Pages stay in
    the task that reads them: a description is put before every so many records, and the sink
    begins a new file there.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string"), F.col(html_col).cast("string").alias("html"))
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0))).first()
    per_file = _records_per_file(count, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        version = number % 2 + 1
        about = f"{version} 0 cellweave\n{ARC_FIELDS[version]}\n"
        extra = " 200 - - 0 -" if version == 2 else ""
        name = f"pages-{number:05d}.arc"
        start = f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(about)}\n{about}"
        written = 0
        for batch in batches:
            out = []
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if written % per_file == 0:
                    out.append(start)
                    written += 1
                html = html or ""
                size = len(html.encode())
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n{PAGE_HEADER}: {'' if page is None else page}\r\n\r\n"
                if version == 2:
                    extra = f" 200 {digest(html.encode())} - 0 {name}"
                out.append(f"{_url(url)} 0.0.0.0 {date} text/html{extra} {len(head) + size}\n{head}{html}")
                written += 1
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})

    _write(rows.mapInArrow(run, "value string"), path, per_file)


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one ARC file by the field list of its version and the declared lengths.

    The first record is the file's description, which names the version and the fields.  A header
    line with another number of fields, or a length beyond the file, is an error: nothing is
    skipped.
    """
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] == b"\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        parts = data[at : end if end >= 0 else len(data)].decode().rstrip("\r").split(" ")
        start, size = end + 1, int(parts[-1]) if parts[-1].isdigit() else -1
        if end < 0 or size < 0 or start + size > len(data):
            raise ValueError(f"an ARC record at byte {at} is cut off or has no length")
        block = data[start : start + size]
        at = start + size
        if fields is None:
            about = block.split(b"\n")
            version = int(about[0].split(b" ")[0])
            if not parts[0].startswith("filedesc://") or about[1].decode().rstrip("\r") != ARC_FIELDS.get(version):
                raise ValueError("an ARC file begins with a description of version 1 or 2")
            fields = ARC_FIELDS[version].split(" ")
            continue
        if len(parts) != len(fields):
            raise ValueError(f"an ARC header line has {len(parts)} fields, not {len(fields)}")
        yield dict(zip(fields, parts, strict=True)) | {"block": block}


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their blank line, and payload; a block without HTTP headers is all payload."""
    if block.startswith(b"HTTP/"):
        end = block.find(b"\r\n\r\n")
        if end >= 0:
            return block[: end + 4], block[end + 4 :]
    return b"", block


def _header(head: str, name: str) -> str | None:
    found = re.search(rf"(?im)^{name}:[ \t]*([^\r\n]*)", head)
    return found[1].strip() if found else None


def _page(head: str) -> int | None:
    value = _header(head, PAGE_HEADER)
    return int(value) if value else None


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["payload"] or b"")
        if size >= BATCH_BYTES or len(held) >= 10_000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split(" ") for x in ddl.split(", "))])


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all ARC files below ``path``, with payload digest and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(len(batch)):
                    for r in parse_arc(gzip.decompress(batch.column(0)[i].as_py())):
                        head, payload = _split_http(r["block"])
                        text = head.decode("latin-1")
                        yield {
                            "page_id": _page(text),
                            "url": r["URL"],
                            "ip": r["IP-address"],
                            "date": r["Archive-date"],
                            "mime": r["Content-type"],
                            "head": text,
                            "payload": payload,
                            "payload_bytes": len(payload),
                            "payload_digest": digest(payload),
                        }

        yield from _batches(rows(), _arrow(RECORDS))

    files = spark.read.format("binaryFile").option("pathGlobFilter", SUFFIX).load(path)
    return files.select("content").mapInArrow(run, RECORDS)


def to_warc_date(date: str) -> str:
    """``YYYYMMDDhhmmss``, or a leading part of it, as a WARC timestamp."""
    full = date + "00000101000000"[len(date) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def _warc(kind: str, rid: str, date: str, mime: str, block: bytes, more: list[tuple[str, str]]) -> bytes:
    """One record, but for the line feed of the writer that ends it."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", date), *more]
    head += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", mime), ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r"


def convert(arc: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write WARC files equivalent to the records of ``read_arc``.

    Of records with equal payloads of at least ``min_bytes`` the one with the largest page id is a
    response and the others are revisits, which refer to it and carry the HTTP headers only.
    Rows that share this largest id are all responses.
    """
    narrow = cut_lineage(arc.select("page_id", "payload_digest", "payload_bytes"))
    groups = narrow.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(
        F.max("page_id").alias("first"), F.count("*").alias("n")
    )
    groups = cut_lineage(groups.where("n > 1").withColumn("hashed", F.xxhash64("payload_digest")))
    # payloads without a copy, as far as the filter can tell, stay where they are
    marked, flag = may_match(arc, F.xxhash64("payload_digest"), groups, "hashed", groups.count())
    moved = hot_join(marked.where(F.col(flag).isNotNull()).drop(flag), groups.drop("hashed"), "payload_digest", "n", narrow.count(), how="left")
    rows = moved.unionByName(marked.where(F.col(flag).isNull()).drop(flag).withColumn("first", F.lit(None).cast("long")))
    per_file = _records_per_file(*narrow.agg(F.count("*"), F.coalesce(F.sum("payload_bytes"), F.lit(0))).first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        about = b"software: cellweave\r\nformat: WARC File Format 1.0\r\n"
        written = 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if written % per_file == 0:
                    info = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'file:{TaskContext.get().partitionId()}:{written}')}>"
                    out.append(_warc("warcinfo", info, to_warc_date(r["date"]), "application/warc-fields", about, []))
                    written += 1
                own, date = record_id(r["page_id"], r["payload_digest"]), to_warc_date(r["date"])
                more = [("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"]), ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}")]
                head, mime = r["head"].encode("latin-1"), "application/http; msgtype=response"
                if r["first"] is not None and r["first"] != r["page_id"]:
                    more += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(r["first"], r["payload_digest"]))]
                    out.append(_warc("revisit", own, date, mime, head, more))
                else:
                    out.append(_warc("response", own, date, mime, head + r["payload"], more))
                written += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    _write(rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")), path, per_file)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of every record, by the declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode().split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(head["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the WARC record at byte {at} does not end where its length says")
        yield head, data[start:stop]
        at = stop + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of all WARC files below ``path``.

    Length and digest are those of the full payload, also for a revisit, which has no payload of
    its own.  A response whose payload does not have its digest is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(len(batch)):
                    for head, block in parse_warc(gzip.decompress(batch.column(0)[i].as_py())):
                        kind = head["warc-type"]
                        if kind not in ("response", "revisit"):
                            continue
                        http, payload = _split_http(block)
                        text, declared = http.decode("latin-1"), head["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and digest(payload) != declared:
                            raise ValueError(f"{head['warc-record-id']} has another payload digest")
                        yield {
                            "page_id": _page(text),
                            "record_type": kind,
                            "record_id": head["warc-record-id"],
                            "refers_to_id": head.get("warc-refers-to"),
                            "payload_bytes": len(payload) if kind == "response" else int(_header(text, "Content-Length") or 0),
                            "payload_digest": declared,
                            "payload": payload if kind == "response" else None,
                        }

        yield from _batches(rows(), _arrow(READ))

    files = spark.read.format("binaryFile").option("pathGlobFilter", SUFFIX).load(path)
    return files.select("content").mapInArrow(run, READ)


def through_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page.

    Pages are written as ARC, converted to WARC, and read back.  NULL pages have an empty payload,
    NULL addresses are ``about:blank``; a NULL id is never the largest, and a group with no other
    id is all responses.  Repeated rows get records each.  An empty table gives an empty result;
    other columns are ignored.  A page must fit the memory of a task, as must a file.
    """
    spark = pages.sparkSession
    old, new = shared_folder(spark), shared_folder(spark)
    write_arc(pages, old)
    convert(read_arc(spark, old), new, min_bytes)
    back = cut_lineage(read_warc(spark, new).drop("payload"))
    told = back.where("record_type = 'revisit'").groupBy("refers_to_id").agg(F.count("*").alias("n"))
    responses = back.where("record_type = 'response'").groupBy("record_id").agg(F.max("page_id").alias("refers_to"))
    named = told.join(responses, F.col("refers_to_id") == F.col("record_id")).select("refers_to_id", "n", "refers_to")
    return hot_join(back, named, "refers_to_id", "n", back.count(), how="left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
