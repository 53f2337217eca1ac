"""WARC archives: a writer of segmented records, and a reader that puts the segments together again.

Writer: one record for each page. Of pages with equal payloads that with the smallest id becomes a ``response``, an
HTTP answer in chunked transfer framing; the others become ``revisit`` records that name it. A block longer than
``SEGMENT_BYTES`` is cut: the first part goes into the record itself, each further part into a ``continuation`` record
that names its origin and its number; the last one states the total length. Archives are gzipped WARC 1.1 files of
at most ``FILE_RECORDS`` records, so no file and no record is larger than a fixed size.

Reader: files are read by Spark as binary rows, a record each is cut out by its stated length (gzip members are
unpacked first). Continuations are grouped by origin, ordered by segment number, checked to be gapless and of the total
length stated, and joined; then the HTTP head is split off and the chunked framing decoded. A group is one payload, so
its size is that of a row. Anything that doesn't add up raises.

Defined cases: NULL or empty html is a payload of no bytes, compared like any other; of rows with the same id and payload
one is the response; a NULL id stands as an empty name, comes first and is read back as NULL; extra columns are not
written; an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage, staging_path
from .common import text_or_empty

SEGMENT_BYTES = 1 << 14
CHUNK_BYTES = 1 << 12
FILE_RECORDS = 1000
# Fixed values of the formats.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2000-01-01T00:00:00Z"

RECORD = "type string, id string, origin string, segment int, total long, uri string, refers_to string, digest string, block binary"
_ARROW = pa.schema(
    [("type", pa.string()), ("id", pa.string()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()),
     ("uri", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("block", pa.binary())]
)


def payload_digest(payload: Column) -> Column:
    """Base32 SHA-1 of a binary column: five hexadecimal digits make four of base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """Body of a chunked transfer; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk isn't as long as it says")
        parts.append(framed[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", len(block))] if value is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + block


def records(name: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None) -> list[bytes]:
    """Records of one page, without the line ends that close a record."""
    common = [("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
    common.append(("Content-Type", "application/http; msgtype=response"))
    if refers_to is not None:
        extra = [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
        return [_record([("WARC-Type", "revisit"), *common, *extra], HTTP_HEAD)]
    block = HTTP_HEAD + chunked(payload)
    parts = [block[i : i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    if len(parts) == 1:
        return [_record([("WARC-Type", "response"), *common], block)]
    out = [_record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1)], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{number}>"), ("WARC-Date", DATE), ("WARC-Target-URI", uri)]
        own += [("WARC-Segment-Number", number), ("WARC-Segment-Origin-ID", f"<{name}>")]
        own += [("WARC-Segment-Total-Length", len(block))] if number == len(parts) else []
        out.append(_record(own, part))
    return out


def _records_of(names: pa.Array, uris: pa.Array, payloads: pa.Array, digests: pa.Array, refers: pa.Array) -> pa.Array:
    rows = zip(*(x.to_pylist() for x in (names, uris, payloads, digests, refers)), strict=True)
    clean = lambda uri: uri and " ".join(uri.split())  # noqa: E731  no line ends in a header
    return pa.array([records(n, clean(u), p, d, r) for n, u, p, d, r in rows], pa.list_(pa.binary()))


def record_name(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), row)


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (``page_id, url, html``) as WARC files under ``path``. Runs jobs.

    Pages are staged once with a row number, which tells rows with one id apart. The first page of each payload is a
    minimum by digest; only digests that occur twice are joined back, with both sides shuffled plainly, so AQE splits
    a payload that many pages share.
    """
    payload = text_or_empty(F.col("html")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = stage(rows.withColumn("digest", payload_digest(F.col("payload"))), "pages")
    rank = F.struct(F.col("page_id").isNotNull().alias("known"), F.col("page_id"), F.col("row"))  # NULL first
    groups = rows.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    again = groups.where("n > 1").select("digest", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))
    rows = rows.join(stage(again, "repeated"), "digest", "left")
    revisit = F.col("first_row") != F.col("row")
    made = F.arrow_udf(_records_of, "array<binary>")(
        record_name(F.col("page_id"), F.col("row")),
        F.col("url"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")),
        F.col("digest"),
        F.when(revisit, record_name(F.col("first_id"), F.col("first_row"))),
    )
    lines = rows.select(F.explode(made).alias("record")).select(F.col("record").cast("string").alias("value"))  # bytes as they are
    out = lines.write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS)
    out.option("compression", "gzip").text(path)


def members(content: bytes) -> bytes:
    """Content without gzip, of any number of members."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content:
        one = zlib.decompressobj(31)
        parts.append(one.decompress(content) + one.flush())
        content = one.unused_data
    return b"".join(parts)


def parse(content: bytes) -> Iterator[dict]:
    """Records of one archive file."""
    content, at = members(content), 0
    while at < len(content):
        if content[at : at + 2] == b"\r\n":
            at += 2
            continue
        head = content.find(b"\r\n\r\n", at)
        if head < 0 or content[at : at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        lines = content[at:head].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields["content-length"])
        block = content[head + 4 : head + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at byte {at} is cut off")
        bare = lambda name: fields[name].strip("<>") if name in fields else None  # noqa: B023, E731
        number = lambda name: int(fields[name]) if name in fields else None  # noqa: B023, E731
        yield {
            "type": fields.get("warc-type"), "id": bare("warc-record-id"), "origin": bare("warc-segment-origin-id"),
            "segment": number("warc-segment-number"), "total": number("warc-segment-total-length"), "uri": fields.get("warc-target-uri"),
            "refers_to": bare("warc-refers-to"), "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, "block": block,
        }
        at = head + 4 + size


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            some, size = [], 0
            for record in parse(content.as_py()):
                some.append(record)
                size += len(record["block"])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(some, _ARROW)
                    some, size = [], 0
            if some:
                yield pa.RecordBatch.from_pylist(some, _ARROW)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records as they lie in the files, columns :data:`RECORD`."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parsed, RECORD)


def reassembled(found: DataFrame) -> DataFrame:
    """Records with the blocks of their continuations, in order and complete; other than ``continuation`` only."""
    key = F.coalesce("origin", "id")
    parts = found.where("segment IS NOT NULL").withColumn("of", key)
    head = F.col("type") != "continuation"
    whole = parts.groupBy("of").agg(
        *[F.max(F.when(head, F.col(c))).alias(c) for c in ("type", "uri", "refers_to", "digest")],
        F.max("total").alias("total"),
        F.array_sort(F.collect_list("segment")).alias("segments"),
        F.expr("listagg(block) WITHIN GROUP (ORDER BY segment)").alias("joined"),  # each part is copied once
    )
    gapless = F.col("segments") == F.sequence(F.lit(1), F.size("segments"))
    checked = F.when(gapless & F.col("type").isNotNull() & (F.length("joined") == F.col("total")), F.col("joined")).otherwise(
        F.raise_error(F.concat(F.lit("segments don't make up record "), F.col("of"))).cast("binary")
    )
    whole = whole.select("type", F.col("of").alias("id"), "uri", "refers_to", "digest", checked.alias("block"))
    return found.where("segment IS NULL").select("type", "id", "uri", "refers_to", "digest", "block").unionByName(whole)


def body_of(block: bytes) -> bytes:
    """Payload of an HTTP answer."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = [line.lower().replace(b" ", b"") for line in head.split(b"\r\n")[1:]]
    return unchunked(body) if b"transfer-encoding:chunked" in fields else body


def _payloads(types: pa.Array, blocks: pa.Array, digests: pa.Array) -> pa.Array:
    out = []
    for kind, block, stated in zip(types.to_pylist(), blocks.to_pylist(), digests.to_pylist(), strict=True):
        if kind != "response":
            out.append(None)
            continue
        payload = body_of(block)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if stated not in (None, digest):
            raise ValueError(f"payload has digest {digest}, its record says {stated}")
        out.append({"payload": payload, "digest": digest})
    return pa.array(out, pa.struct([("payload", pa.binary()), ("digest", pa.string())]))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``type, id, uri, refers_to, digest, payload``: whole records, responses with their decoded and verified payload."""
    read = F.arrow_udf(_payloads, "payload binary, digest string").asNondeterministic()
    found = reassembled(read_records(spark, path)).withColumn("_read", read("type", "block", "digest"))
    return found.select("type", "id", "uri", "refers_to", F.coalesce("_read.digest", "digest").alias("digest"), F.col("_read.payload").alias("payload"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``. Runs jobs."""
    spark = pages.sparkSession
    path = staging_path(spark, "warc")
    write_archives(pages, path)
    page_of = lambda c: F.split(c, ":")[2].try_cast("long")
    found = read_archives(spark, path).select(
        page_of(F.col("id")).alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        page_of(F.col("refers_to")).alias("refers_to"),
    )
    found = stage(found, "read-back")
    # A revisit has no payload of its own; its size is that of the response with the same digest.
    sizes = found.where("record_type = 'response'").select("payload_digest", F.col("payload_bytes").alias("_bytes")).distinct()
    revisited = found.where("record_type = 'revisit'").select("payload_digest").distinct()
    sizes = stage(sizes.join(revisited, "payload_digest", "left_semi"), "revisited")
    return found.join(sizes, "payload_digest", "left").select(
        "page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
