r"""WARC archives whose long records are cut into segments, and their reassembly.

Writing: pages with equal payloads share one response; the others revisit it. They meet by digest and length in
one join, whose tasks write the archives: payloads are shuffled once, and those of revisits go no further. A
response's HTTP message has chunked framing. Messages longer than a segment go on in continuation records. An
archive has a bounded number of records, so a page's segments may go on in another one.

Reading: archives are parsed by Content-Length. A record whose segments all lie in its archive is put together
there. The segments of the others are grouped by origin identifier and sorted by segment number in a shuffle,
and streamed through: a task holds one message at a time. Segment numbers must have no gap and the length must be
the one stated with the last segment; then the HTTP message is parsed and its chunks are decoded. Archives are
read once for the former and once for the latter.

A record that fails is returned with ``complete`` false and without payload: one without its segments, without
a usable Content-Length or with one that the archive does not bear out, with headers that are no UTF-8 or no
numbers where these are due, or with broken chunks. What cannot be read of it is null; reading goes on at the
next record.

Archives are files of Spark's text writer, whose line separator is the CRLF that ends a record: string
columns take any bytes. So they are written and read by whatever file system Spark knows. A reading task
holds one archive, of ``ARCHIVE_BYTES`` before compression or a little more.

Corner cases: a null page is the empty payload; repeated rows are all responses if theirs is the smallest
id, else revisits; a null id is a response on its own; ids are whole numbers; an empty table gives no archive
and no rows; other columns are not read.
"""

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.llm.common import stored

ARCHIVE_BYTES = 16 * 1024**2
SEGMENT_BYTES = 4096
CHUNK_BYTES = 1500
CRLF = b"\r\n"
HEX, NUMBER = re.compile(rb"[0-9A-Fa-f]{1,15}"), re.compile(r"-?[0-9]{1,18}")
#: Headers of a record, at most.
HEAD_BYTES = 1 << 20
KINDS = ("response", "revisit", "continuation")
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """Payload of a chunked body, or None if its framing is broken."""
    at, parts = 0, []
    while True:
        end = body.find(CRLF, at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not HEX.fullmatch(size):
            return None
        length = int(size, 16)
        at = end + 2
        if length == 0:
            return b"".join(parts) if body[at:] == CRLF or body.endswith(b"\r\n\r\n") else None
        if body[at + length : at + length + 2] != CRLF:
            return None
        parts.append(body[at : at + length])
        at += length + 2


def record(headers: dict[str, object], block: bytes) -> bytes:
    """A record without the CRLF that ends it."""
    lines = [b"WARC/1.1"] + [f"{k}: {v}".encode() for k, v in headers.items() if v is not None]
    return CRLF.join([*lines, b"Content-Length: %d" % len(block), b"", block]) + CRLF


def records_of(row_id: int, page_id, url, payload: bytes | None, name: str, refers_to, segment: int):
    """The records of a page, in their order."""
    urn = f"<urn:page:{row_id}>"
    base = {
        "WARC-Type": "revisit" if refers_to is not None else "response",
        "WARC-Record-ID": urn,
        "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Target-URI": None if url is None else "".join(c if c >= " " else "%%%02X" % ord(c) for c in url),
        "WARC-Page-ID": page_id,
        "WARC-Payload-Digest": f"sha1:{name}",
    }
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield record({**base, "WARC-Profile": profile, "WARC-Refers-To-Page-ID": refers_to}, b"")
        return
    message = HEAD + chunked(payload)
    parts = [message[k : k + segment] for k in range(0, len(message), segment)]
    if len(parts) == 1:
        yield record({**base, "Content-Type": "application/http;msgtype=response"}, message)
        return
    for k, part in enumerate(parts, 1):
        last = {"WARC-Segment-Total-Length": len(message)} if k == len(parts) else {}
        if k == 1:
            yield record({**base, "Content-Type": "application/http;msgtype=response", "WARC-Segment-Number": 1}, part)
        else:
            own = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:page:{row_id}:{k}>", "WARC-Date": base["WARC-Date"]}
            yield record({**own, "WARC-Segment-Origin-ID": urn, "WARC-Segment-Number": k, **last}, part)


def write_archives(
    pages: DataFrame, path: str, segment: int = SEGMENT_BYTES, least_revisit: int = 0, archive_bytes: int = ARCHIVE_BYTES,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> None:
    """Write ``pages`` as archives below ``path``; payloads below ``least_revisit`` bytes are always responses."""
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("payload")).withColumn(
        "row_id", F.monotonically_increasing_id()
    )
    # Equal payloads meet by their SHA-1 and length.
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload"))).withColumn("bytes", F.octet_length("payload"))
    firsts = rows.filter(F.col("bytes") >= least_revisit).groupBy("sha", "bytes").agg(F.min("page_id").alias("first"))
    again = F.col("first") < F.col("page_id")
    linked = rows.join(firsts, ["sha", "bytes"], "left").select(
        "row_id", "page_id", "url", F.when(F.coalesce(again, F.lit(False)), None).otherwise(F.col("payload")).alias("payload"),
        "sha", F.when(again, F.col("first")).alias("refers_to"),
    )

    def run(batches):
        for batch in batches:
            made, held = [], 0
            for row_id, page_id, url, payload, sha, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                for data in records_of(row_id, page_id, url, payload, base64.b32encode(sha).decode(), refers_to, segment):
                    made.append(data)
                    held += len(data)
                if held > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])
                    made, held = [], 0
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])

    # Headers and block of a record have a bounded size but for the URL, so an archive has too.
    per_archive = max(1, archive_bytes // (segment + 600))
    made = linked.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    made.write.mode("overwrite").option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_archive).text(path)


def unzipped(data: bytes) -> bytes:
    """Contents of a gzip file of one or more members, up to where one is damaged; other data as it is."""
    parts = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            for k in range(0, len(data), 1 << 16):
                parts.append(member.decompress(data[k : k + (1 << 16)]))
                if member.eof:
                    break
        except zlib.error:
            break
        data = member.unused_data + data[k + (1 << 16) :]
    return b"".join(parts) if parts else data


def parse(data: bytes):
    """(headers in lower case, block or None) of each record; None if its length is missing or cannot be right."""
    at = data.find(b"WARC/")
    while 0 <= at < len(data):
        end = data.find(b"\r\n\r\n", at, at + HEAD_BYTES)
        if end < 0:
            yield {}, None
            at = data.find(b"WARC/", at + 5)
            continue
        lines = data[at:end].split(CRLF)[1:]
        headers = {}
        for line in lines:
            name, _, value = line.partition(b":")
            try:
                headers[name.strip().lower().decode()] = value.strip().decode()
            except UnicodeDecodeError:
                headers["damaged"] = "yes"
        start = end + 4
        length = number(headers, "content-length")
        stop = start + length if length is not None and length >= 0 else -1
        # After its block a record ends with two line ends, and the next one or nothing follows.
        fits = start <= stop <= len(data) and data[stop : stop + 4].startswith((b"\r\n\r\n", b"\r\n")[stop + 4 > len(data)])
        fits = fits and data[stop + 4 : stop + 9] in (b"", b"WARC/")
        yield headers, data[start:stop] if fits and "damaged" not in headers else None
        at = data.find(b"WARC/", stop if fits else start)


def number(headers: dict, name: str) -> int | None:
    """A header's number, None if it is missing or no number."""
    value = headers.get(name, "")
    return int(value) if NUMBER.fullmatch(value) else None


PART = ["origin", "segment", "total", "page_id", "kind", "refers_to", "stated", "block"]
PART_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
PAGE = ["page_id", "payload", "payload_digest", "record_type", "refers_to", "complete"]
PAGE_TYPES = [pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.bool_()]


def batch_of(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def groups_of(data: bytes):
    """(whether all of a record is here, its parts) for each record of an archive."""
    loose: dict[str, list[tuple]] = {}
    for h, block in parse(data):
        kind = h.get("warc-type")
        if kind not in KINDS and block is not None:
            continue  # a record of another kind
        wrong = [n for n in ("warc-segment-number", "warc-segment-total-length", "warc-page-id", "warc-refers-to-page-id") if n in h and number(h, n) is None]
        origin = h.get("warc-segment-origin-id") or h.get("warc-record-id")
        part = (
            origin, number(h, "warc-segment-number") or 0, number(h, "warc-segment-total-length"), number(h, "warc-page-id"),
            kind, number(h, "warc-refers-to-page-id"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None, block,
        )
        if block is None or wrong or origin is None or (kind != "continuation" and "warc-segment-number" not in h):
            yield True, [part if not wrong else (*part[:-1], None)]
        else:
            loose.setdefault(origin, []).append(part)
    for parts in loose.values():
        parts.sort(key=lambda p: p[1])
        here = [p[1] for p in parts] == list(range(1, len(parts) + 1)) and parts[-1][2] is not None
        yield here, parts


def read_archives(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """(page_id, payload, payload_digest, record_type, refers_to, complete) of each page in the archives."""

    def whole(batches):
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for here, parts in groups_of(unzipped(data.as_py())):
                    if here:
                        rows.append(assembled(parts))
                        held += len(rows[-1][1] or b"")
                    if held > 4_000_000:
                        yield batch_of(rows, PAGE, PAGE_TYPES)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows, PAGE, PAGE_TYPES)

    def split(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = [part for here, parts in groups_of(unzipped(data.as_py())) if not here for part in parts]
                if rows:
                    yield batch_of(rows, PART, PART_TYPES)

    def join(batches):
        group: list[tuple] = []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][0] != row[0]:
                    out.append(assembled(group))
                    group = []
                group.append(row)
            if out:
                yield batch_of(out, PAGE, PAGE_TYPES)
        if group:
            yield batch_of([assembled(group)], PAGE, PAGE_TYPES)

    page = "page_id bigint, payload binary, payload_digest string, record_type string, refers_to bigint, complete boolean"
    schema = "origin string, segment bigint, total bigint, page_id bigint, kind string, refers_to bigint, stated string, block binary"
    content = spark.read.format("binaryFile").load(path).select("content")
    parts = content.mapInArrow(split, schema)
    parts = parts.repartition(tasks, "origin") if tasks else parts.repartition("origin")
    return content.mapInArrow(whole, page).union(parts.sortWithinPartitions("origin", "segment").mapInArrow(join, page))


def assembled(group: list[tuple]) -> tuple:
    """(page_id, payload, digest, record type, refers to, complete) of one record's segments, in their order."""
    _, segment, _, page_id, kind, refers_to, stated, block = group[0]
    if kind == "revisit" and block is not None:
        return page_id, None, stated, kind, refers_to, True
    payload = None
    if all(g[7] is not None for g in group):
        message = b"".join(g[7] for g in group)
        if segment == 0:
            whole = len(group) == 1 and kind == "response"
        else:
            numbers = [g[1] for g in group]
            whole = kind == "response" and numbers == list(range(1, len(group) + 1)) and group[-1][2] == len(message)
        if whole:
            head, _, body = message.partition(b"\r\n\r\n")
            payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    if payload is None:
        return page_id, None, stated, kind, None, False
    return page_id, payload, digest(payload), kind, None, True


def page_records(found: DataFrame) -> DataFrame:
    """Digest columns of ``read_archives``; a revisit takes its length from the response that it refers to."""
    # Stored without payloads, as it is read twice.
    rows = stored(
        found.select("page_id", F.octet_length("payload").cast("bigint").alias("bytes"), "payload_digest", "record_type", "refers_to", "complete"),
        "records",
    )
    answers = rows.filter("record_type = 'response' and complete").select(F.col("page_id").alias("answer"), F.col("bytes").alias("answer_bytes"), F.col("payload_digest").alias("answer_digest")).distinct()
    return rows.join(
        answers, (F.col("refers_to") == F.col("answer")) & (F.col("payload_digest") == F.col("answer_digest")), "left"
    ).select(
        "page_id", F.coalesce("bytes", "answer_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to",
        (F.col("complete") & (F.col("refers_to").isNull() | F.col("answer").isNotNull())).alias("complete"),
    )
