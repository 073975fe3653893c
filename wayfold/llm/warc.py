"""WARC archives with segmented records: written, read back, reassembled.

Payloads go into HTTP responses with chunked transfer framing. A block over SEGMENT bytes is cut: the
first part is the record itself (WARC-Segment-Number 1), the rest are ``continuation`` records that
name it in WARC-Segment-Origin-ID; the last one gives WARC-Segment-Total-Length. Of rows with equal
payloads the largest id is the ``response``, the others are ``revisit`` records without payload.

Files are written by Spark's text sink, one record a row, compressed, and closed after FILE_RECORDS records, so that a file
stays under FILE_RECORDS * (SEGMENT + a few kB) and can be read as one binary value. Reading parses
records one after the other; whole responses are decoded on the spot, and only segments are shuffled:
grouped by origin, ordered by number, checked against the total length, then decoded.

Defined cases: a null payload is empty; repeated rows (same id, URL and payload) are one
record identity and come back as often as they were written; rows that share the largest id are all
responses; a null id never makes a response of a group that has an id, and payload groups without any
id are responses; control and non-ASCII characters of URLs are percent-encoded in the header; a record with
missing segments or a wrong length or digest comes back with ``intact`` false, and once with a null id where its first
segment is missing; extra columns are ignored.

Archives of others are read too: names of headers in any case, files of one or of many gzip members or of none, responses without
a digest (of which one is worked out) or with one of another kind, records of other types, which are passed over. Nothing that is
wrong with a file ends the job. A record that is cut, or whose header cannot be read, comes back as a response with
``intact`` false and what is known of it, and reading goes on at the next record; a compressed file that is cut or broken
gives its records up to there, and one such row.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfold.llm.common import kept, small_batches

SEGMENT = 1 << 15
CHUNK = 1 << 13
FILE_RECORDS = 2000
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def pieces(data: bytes, size: int) -> list[bytes]:
    """Cuts UTF-8 text at ends of characters, each piece of at most ``size`` bytes (4 at least)."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:end])
        at = end
    return out


def chunked(data: bytes, size: int) -> bytes:
    framed = b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in pieces(data, size))
    return framed + b"0\r\n\r\n"


def dechunked(data: bytes) -> bytes:
    """The body of a chunked message; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = data.index(b"\r\n", at)
        size = int(data[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(data[at : at + size])
        at += size + 2


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def identity(*parts: object) -> str:
    h = hashlib.md5(repr(parts).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def _record(kind: str, own: str, block: bytes, **more: object) -> str:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", f"WARC-Date: {DATE}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines) + END + block.decode()


def records(page_id: int | None, url: str | None, html: str, first_id: int | None, first_url: str | None) -> Iterator[str]:
    """The records of one row; ``first`` is the response of its payload."""
    payload = html.encode()
    digest = digest_of(payload)
    target = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")
    head = {"WARC_Target_URI": target, "WARC_Payload_Digest": f"sha1:{digest}", "Wayfold_Id": "" if page_id is None else page_id}
    own = identity(page_id, url, digest)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if first_id is not None and page_id != first_id:
        refers = identity(first_id, first_url, digest)
        yield _record("revisit", own, http, **head, WARC_Profile=PROFILE, WARC_Refers_To=refers, Content_Type="application/http; msgtype=response")
        return
    block = http + chunked(payload, CHUNK)
    parts = pieces(block, SEGMENT)
    head["Content_Type"] = "application/http; msgtype=response"
    if len(parts) == 1:
        yield _record("response", own, block, **head)
        return
    yield _record("response", own, parts[0], **head, WARC_Segment_Number=1)
    for n, part in enumerate(parts[1:], 2):
        last = {"WARC_Segment_Total_Length": len(block)} if n == len(parts) else {}
        yield _record("continuation", identity(own, n), part, WARC_Segment_Origin_ID=own, WARC_Segment_Number=n, **last)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("html"),
    ).withColumns({"sha": F.unhex(F.sha1("html")), "size": F.octet_length("html")})
    first = rows.groupBy("sha", "size").agg(F.count("*").alias("times"), F.max(F.when(F.col("id").isNotNull(), F.struct("id", "url"))).alias("first"))
    several = first.where("times > 1 AND first IS NOT NULL").select("sha", "size", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"))
    joined = rows.join(several, ["sha", "size"], "left").select("id", "url", "html", "first_id", "first_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row in zip(*(batch.column(i) for i in range(5)), strict=True):
                for text in records(*(x.as_py() for x in row)):
                    held.append(text)
                    size += len(text)
                if size >= 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])

    out = joined.mapInArrow(run, "value string")
    out.write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip").text(path)


def unpacked(content: bytes) -> tuple[bytes, bool]:
    """(text of all gzip members, or the content itself if it is not compressed; whether it is whole)."""
    if content[:2] != b"\x1f\x8b":
        return content, True
    out, rest = [], content
    while rest[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            # in pieces, so that what comes before a broken place is not lost
            for at in range(0, len(rest), CHUNK):
                out.append(member.decompress(rest[at : at + CHUNK]))
                if member.eof:
                    rest = member.unused_data + rest[at + CHUNK :]
                    break
            else:
                return b"".join(out), False
        except zlib.error:
            return b"".join(out), False
    return b"".join(out), not rest.strip(b"\0")


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """(headers by lower-case name, block, whether the record could be read) of each record of an archive."""
    at = 0
    while True:
        while content[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(content):
            return
        end = content.find(b"\r\n\r\n", at)
        lines = content[at : end if end >= 0 else len(content)].decode("utf-8", "replace").split("\r\n")
        pairs = [line.partition(":") for line in lines[1:]]
        head = {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}
        fine = lines[0].startswith("WARC/") and all(colon and " " not in name.strip() for name, colon, _ in pairs)
        size = head.get("content-length", "")
        if end < 0 or not (size.isascii() and size.isdigit()) or not lines[0].startswith("WARC/"):
            yield head, b"", False
            at = content.find(b"\r\nWARC/1.", at + 1)
            if at < 0:
                return
            continue
        stop = end + 4 + int(size)
        block = content[end + 4 : stop]
        if stop > len(content):
            yield head, block, False
            return
        follows = content[stop : stop + 4] in (END.encode(), b"") or content[stop:].strip(b"\r\n") == b""
        yield head, block, fine and follows
        at = stop
        if not follows:  # the length is wrong
            at = content.find(b"\r\nWARC/1.", end)
            if at < 0:
                return


_PARSED = "id bigint, url string, type string, record string, refers string, origin string, number int, total bigint, digest string, size bigint, intact boolean, block binary"
_TYPES = [pa.int64(), *[pa.string()] * 5, pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
_NAMES = [p.split()[0] for p in _PARSED.split(", ")]


def _payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def checked(block: bytes, digest: str | None) -> tuple[int, bool, str | None]:
    """(payload size, whether framing and digest are right, the digest)."""
    try:
        payload = _payload(block)
    except ValueError:
        return 0, False, digest
    found = digest_of(payload)
    return len(payload), digest in (None, found), digest or found


def sha1_named(value: str | None) -> str | None:
    """The digest of a header in upper-case base32, if it is a SHA-1."""
    kind, colon, text = (value or "").partition(":")
    return text.upper() if colon and kind.lower() == "sha1" and len(text) == 32 else None


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.removeprefix("-").isdigit() and abs(int(text)) < 1 << 62 else None


def _row(head: dict[str, str], block: bytes, fine: bool) -> tuple | None:
    """A record as a row of ``_PARSED``; None for records of other types. What can't be read is a response that is not intact."""
    digest, number = sha1_named(head.get("warc-payload-digest")), _number(head.get("warc-segment-number"))
    kind, own = head.get("warc-type", "").lower(), head.get("warc-record-id")
    ident, url, total = _number(head.get("wayfold-id")), head.get("warc-target-uri"), _number(head.get("warc-segment-total-length"))
    origin = head.get("warc-segment-origin-id") or (own if number else None)
    cut = kind in ("response", "continuation") and number is not None and 0 < number < 1 << 31 and origin is not None
    if cut:  # putting it together tells whether it is whole
        return ident, url, kind, own, None, origin, number, total, digest, None, None, block
    if not fine or (kind in ("response", "revisit") and own is None) or kind in ("", "continuation"):
        return ident, url, "response", own, None, None, None, None, digest, 0, False, None
    if kind == "response":
        size, intact, digest = checked(block, digest)
        return ident, url, kind, own, None, None, None, None, digest, size, intact, None
    if kind == "revisit":
        return ident, url, kind, own, head.get("warc-refers-to"), None, None, None, digest, None, None, None
    return None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, payload_bytes, payload_digest, record_type, refers_to, intact) of every record, put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0

                def out() -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)

                text, whole = unpacked(content.as_py())
                last = True
                for head, block, last in parse(text):
                    if (row := _row(head, block, last)) is not None:
                        rows.append(row)
                        held += len(row[-1] or b"")
                    if held >= 8_000_000:
                        yield out()
                        rows, held = [], 0
                if not whole and last:  # else the record that was cut tells it
                    rows.append(_row({}, b"", False))
                if rows:
                    yield out()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, fine, digests = [], [], []
            for total, digest, parts in zip(*(batch.column(i) for i in (4, 5, 6)), strict=True):
                total, parts = total.as_py(), parts.as_py()
                block = b"".join(p["block"] for p in parts)
                size, ok, found_digest = checked(block, digest.as_py())
                digests.append(found_digest)
                whole = [p["number"] for p in parts] == list(range(1, len(parts) + 1)) and total == len(block)
                sizes.append(size)
                fine.append(ok and whole)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(digests, pa.string()), pa.array(sizes, pa.int64()), pa.array(fine, pa.bool_())], ["id", "url", "record", "times", "digest", "size", "intact"])

    # Written once, since the parts below read it several times; it has no payloads but those of segments.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "{*.txt.gz,*.warc.gz,*.warc}").load(path).select("content")
    found = kept(files.mapInArrow(run, _PARSED), "records")
    # Repeated rows have equal segments: one of each number is taken, and the first's count gives the rows back.
    # Without its first segment a record comes back once, with neither id nor URL.
    segments = found.where("number IS NOT NULL").groupBy("origin", "number", "block").agg(
        F.count("*").alias("times"), F.max("id").alias("id"), F.max("url").alias("url"), F.max("total").alias("total"), F.max("digest").alias("digest")
    )
    whole = segments.groupBy("origin").agg(
        F.max("id").alias("id"), F.max("url").alias("url"), F.coalesce(F.max(F.when(F.col("number") == 1, F.col("times"))), F.lit(1)).alias("times"),
        F.max("total").alias("total"), F.max("digest").alias("digest"), F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
    )
    built = whole.select("id", "url", F.col("origin").alias("record"), "times", "total", "digest", "parts").mapInArrow(
        joined, "id bigint, url string, record string, times bigint, digest string, size bigint, intact boolean"
    )
    built = built.withColumn("one", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))))
    names = ["id", "url", "record", "digest", "size", "intact"]
    responses = kept(found.where("type = 'response' AND number IS NULL").select(names).unionByName(built.select(names)), "responses")
    origin = responses.groupBy("record").agg(F.max("id").alias("first_id"), F.max("size").alias("first_size"), F.max("digest").alias("first_digest"), F.min("intact").alias("first_intact"))
    revisits = found.where("type = 'revisit'").select("id", "url", "refers", "digest").join(origin.withColumnRenamed("record", "refers"), "refers", "left")
    again = revisits.select(
        "id", "url", F.col("first_size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"),
        F.col("first_id").alias("refers_to"), F.coalesce(F.col("first_intact") & (F.col("first_digest") == F.col("digest")), F.lit(False)).alias("intact"),
    )
    return responses.select(
        "id", "url", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"),
        F.lit(None).cast("bigint").alias("refers_to"), "intact",
    ).unionByName(again)
