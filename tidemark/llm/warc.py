"""WARC archives written with an index, and read back by coalesced byte ranges.

Which record is a response and which one revisits another follows from digests alone, so it is settled on a narrow
table before payloads are read again. Every task then writes its records as gzip members, as .warc.gz files have them,
to files of its own in the shared folder, and returns the index rows (archive, offset, length, URL, digest); those are
committed as a table by Spark. A task that is run again writes new files under new names, and only files named in the
committed index count, so a lost executor does no harm. Readers sort the index rows they were given by archive and
offset, join neighbouring ranges and fetch each stretch with one read.

Payloads are not shuffled, unless the table of repeated payloads is too large to be broadcast.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import materialize, shared_dir, ship

#: Bytes after which a task starts another archive, gap that one read may span, and bytes that one read aims at.
ARCHIVE_BYTES, GAP_BYTES, READ_BYTES = 64 << 20, 64 << 10, 8 << 20
#: Repeated payloads (48 bytes each) up to which their table is broadcast.
BROADCAST_REPEATS = 200_000
END = b"\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: eight groups of five hex digits, each turned into four base32 digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_references(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Add payload_bytes, payload_digest and refers_to to (page_id, url, html); html is never null afterwards.

    Of records with equal payloads (SHA-256) of at least ``min_bytes`` bytes, that with the largest page_id is the
    response and the others refer to it; rows that repeat that page_id are responses, too. A null payload is empty.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.unhex(F.sha2(html, 256)).alias("_same"))
    groups = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("_same").agg(F.max("page_id").alias("_last"), F.count("*").alias("_n"))
    repeated = materialize(groups.filter("_n > 1").drop("_n"), "warc-repeated")
    if repeated.count() <= BROADCAST_REPEATS:
        repeated = F.broadcast(repeated)
    rows = rows.join(repeated, "_same", "left")
    refers = F.when(F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    return rows.select("page_id", "url", "html", "payload_bytes", base32_sha1(F.col("html")).alias("payload_digest"), refers.alias("refers_to"))


def record(page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to, date: str) -> bytes:
    """A response with an HTTP head and the payload, or a revisit with the head alone.

    A null URL becomes urn:page:<page_id>; blanks and control characters in URLs are percent-encoded.
    """
    name = f"urn:page:{page_id}"
    target = name if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}".encode() + END
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        *([] if refers_to is None else ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + END + block + END


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record; a ValueError if it is not one whole record."""
    head, sep, block = raw.partition(END)
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not sep or not lines[0].startswith("WARC/") or block[-4:] != END:
        raise ValueError("this is not one WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    if int(headers["Content-Length"]) != len(block) - 4:
        raise ValueError("the record's block is not as long as its header says")
    http, _, payload = block[:-4].partition(END)
    return headers | {"http": http.decode("latin-1"), "payload": payload}


def _store(path: str):
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write all rows of (page_id, url, html) to archives below ``path`` and return the committed index.

    Index: archive (file name), page_id, url, payload_digest, offset, length (of the gzip member). An empty table has
    an empty index. Rows that repeat a page_id are records of their own. Further columns are ignored.
    """
    ship(pages.sparkSession)
    store, root = _store(path)
    store.create_dir(root, recursive=True)

    schema = StructType.fromDDL("archive string, page_id long, url string, payload_digest string, offset long, length long")
    made = to_arrow_schema(schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        name, file, at = None, None, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, size, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if file is None or at >= ARCHIVE_BYTES:
                        if file is not None:
                            file.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        file = store.open_output_stream(f"{root}/{name}", compression=None)
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    raw = record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, size, refers, date)
                    member = packer.compress(raw) + packer.flush()
                    file.write(member)
                    rows.append((name, page_id, url, digest, at, len(member)))
                    at += len(member)
                yield _batch(rows, made)
        finally:
            if file is not None:
                file.close()

    return materialize(with_references(pages, min_bytes).mapInArrow(write, schema), "warc-index")


def stretches(rows: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, start, end) of the reads for (offset, length) rows in the order of their offsets."""
    at = 0
    while at < len(rows):
        start, end, upto = rows[at][0], sum(rows[at]), at + 1
        while upto < len(rows) and rows[upto][0] - end <= gap and sum(rows[upto]) - start <= most:
            end, upto = max(end, sum(rows[upto])), upto + 1
        yield at, upto, start, end
        at = upto


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _fetch(batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    store, root = _store(path)
    where, file = None, None
    for batch in batches:
        out = []
        wanted = zip(*(c.to_pylist() for c in batch.columns), strict=True)  # sorted by archive and offset
        for archive, part in itertools.groupby(wanted, key=lambda x: x[0]):
            if archive != where:
                where, file = archive, store.open_input_file(f"{root}/{archive}")
            rows = list(part)
            for first, after, start, end in stretches([r[3:5] for r in rows]):
                stretch = file.read_at(end - start, start)
                for _, page_id, digest, offset, length in rows[first:after]:
                    got = parse_record(zlib.decompress(stretch[offset - start : offset - start + length], 31))
                    if got["WARC-Payload-Digest"] != f"sha1:{digest}":
                        raise ValueError(f"page {page_id}: another digest in the index")
                    response = got["WARC-Type"] == "response"
                    if response and b32encode(hashlib.sha1(got["payload"]).digest()).decode() != digest:
                        raise ValueError(f"page {page_id}: the payload does not have its digest")
                    size = len(got["payload"]) if response else int(got["http"].rpartition("Content-Length: ")[2])
                    refers = None if response else int(got["WARC-Refers-To"][10:-1])
                    page = got["WARC-Record-ID"][10:-1]
                    out.append((None if page == "None" else int(page), got["WARC-Target-URI"], got["WARC-Type"], refers, size, digest, got["payload"])[: len(schema)])
        yield _batch(out, schema)


def read_archives(index: DataFrame, path: str, with_payload: bool = True) -> DataFrame:
    """Read the records of the index rows given (any selection): page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    A revisit's payload is empty; its length and digest are those of the full payload. A record that is not at its
    place, or does not have its digest, fails the job.
    """
    ship(index.sparkSession)
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = index.select("archive", "page_id", "payload_digest", "offset", "length")
    rows = rows.repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    schema = StructType.fromDDL("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string" + ", payload binary" * with_payload)
    made = to_arrow_schema(schema)
    return rows.mapInArrow(lambda batches: _fetch(batches, path, made), schema)


def op8(spark, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, min_bytes=0)
    return read_archives(index, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH base AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages),
digits AS (SELECT page_id, payload, list_transform(range(8), lambda i: CAST('0x' || substr(hex, CAST(i * 5 + 1 AS INTEGER), 5) AS BIGINT)) AS groups FROM base),
coded AS (SELECT page_id, payload, array_to_string(list_transform(groups, lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((g >> s) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest FROM digits),
last AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last_id FROM coded)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM last
"""
