"""WARC archives of web pages: written with segmented records, read back by segment reassembly.

Writing.  Of pages with equal payloads of at least MIN_REVISIT bytes, the one
with the largest page_id becomes a response, the others revisits that refer
to it; all other pages become responses.  A response's HTTP message is framed
in chunks; a record block beyond segment_bytes is cut into segments, the
first a response record, the others continuation records that name its
id and their segment number, the last with the total length.
A WARC record ends in two line breaks, so Spark's text writer with that as its
line separator writes the files, with Spark's commit protocol.

Reading.  Files are read whole (a file holds what one write task gave it, at
most RECORDS_PER_FILE records), parsed into records, and all segments are
grouped by the id of their origin, ordered by number, checked (numbers without
a gap, bytes equal to the total length) and joined; then the HTTP header is cut
off and the chunked framing decoded.  Records that are whole skip the grouping.

Edge cases: null html is the empty payload; empty pages have empty payloads and are always
responses; of repeated rows of the keeping page_id each is a response; pages of
a null id never keep a payload for others and revisit if another id can, else they are responses; a null url
is left out of the record; an archive that is damaged (bad length, missing
segment, broken chunk) raises ValueError; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, new_path, table
from .textvec import pieces

MIN_REVISIT = 1000
#: Ordinary pages are longer than this, so their records are segmented.
SEGMENT_BYTES = 4 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 2000
END = "\r\n\r\n"


def keepers(pages: DataFrame) -> DataFrame:
    """pages (page_id, html) with digest, payload_bytes and keeper: the page_id whose record holds the payload, null if it is the page's own."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.withColumns({"digest": F.sha1(body), "payload_bytes": F.octet_length(body).cast("long")})
    # Only (digest, page_id) pairs are shuffled, summed up by task first.
    same = rows.where(f"payload_bytes >= {MIN_REVISIT}").groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = materialise(same.select("digest", "keeper"), "warc-keepers")
    return rows.join(same, "digest", "left").withColumn("keeper", F.when(~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper")))


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("a chunk has no size")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk has the wrong length")
        out.append(body[at : at + size])
        at += size + 2


def record(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A WARC record without the two line breaks that end it."""
    lines = ["WARC/1.0", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers if v is not None], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def records_of(name: str, page_id, url, payload: bytes, digest: str, keeper, segment_bytes: int) -> list[bytes]:
    own = [("WARC-Record-ID", f"<urn:marlstone:{name}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")), ("X-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if keeper is not None:
        return [record("revisit", [*own, ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"), ("X-Refers-To-Page-ID", keeper)], b"HTTP/1.1 200 OK\r\n\r\n")]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        return [record("response", own, block)]
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [record("response", [*own, ("WARC-Segment-Number", 1)], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        headers = [("WARC-Record-ID", f"<urn:marlstone:{name}-{k}>"), ("WARC-Segment-Origin-ID", own[0][1]), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", len(block) if k == len(parts) else None)]
        out.append(record("continuation", headers, part))
    return out


def _write(segment_bytes: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, "html"):
            out: list[bytes] = []
            for page_id, url, html, digest, keeper in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "keeper")), strict=True):
                n += 1
                out += records_of(f"{task}-{n}", page_id, url, html or b"", digest, keeper, segment_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return run


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write pages (page_id, url, html) as gzip-compressed WARC files to path."""
    rows = keepers(pages).select("page_id", "url", F.col("html").cast("binary").alias("html"), "digest", "keeper")
    made = rows.mapInArrow(_write(segment_bytes), "record binary")
    # A binary value cast to string keeps its bytes, and the text writer writes them as they are.
    made.select(F.col("record").cast("string")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(data: bytes):
    """(headers, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError("no WARC record where one should begin")
        headers = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        begin = end + 4
        at = begin + int(headers["Content-Length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a record has the wrong length")
        yield headers, data[begin:at]
        at += 4


RECORDS = "origin string, segment int, total long, kind string, page_id long, refers_to long, digest string, block binary"


def _read(batches):
    import pyarrow as pa

    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [f.split()[0] for f in RECORDS.split(", ")]
    number = lambda v: None if v is None else int(v)
    for batch in batches:
        for content in batch.column("content"):
            inflate, rows, size = zlib.decompressobj(31), [], 0
            data = content.as_py()
            parts = []
            while data:  # a file may have several gzip members
                parts.append(inflate.decompress(data))
                data = inflate.unused_data
                inflate = zlib.decompressobj(31)
            for h, block in parse(b"".join(parts)):
                rows.append((h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"]), number(h.get("WARC-Segment-Number")), number(h.get("WARC-Segment-Total-Length")), h["WARC-Type"], number(h.get("X-Page-ID")), number(h.get("X-Refers-To-Page-ID")), h.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, block))
                size += len(block)
                if size > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _payload(batches):
    """The payload of each whole block, in place of it."""
    import pyarrow as pa

    for batch in pieces(batches, "block"):
        out = []
        for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block").to_pylist(), strict=True):
            head, _, body = block.partition(b"\r\n\r\n")
            if kind == "revisit":
                out.append(None)
            else:
                out.append(dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body)
        at = batch.schema.get_field_index("block")
        yield batch.set_column(at, "payload", pa.array(out, pa.binary()))


def read_archives(spark, path: str) -> DataFrame:
    """(kind, page_id, refers_to, digest, payload) of each page in the archives of a folder; a revisit's payload is null."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    records = files.mapInArrow(_read, RECORDS)
    fields = ("kind", "page_id", "refers_to", "digest")
    whole = records.where("segment is null").select(*fields, "block")
    # One payload's segments meet in one group: as much as the payload itself.
    parts = records.where("segment is not null").groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"), *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in fields]
    )
    n_bytes = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p["block"]))
    gapless = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    broken = F.raise_error(F.concat(F.lit("incomplete segments of "), F.col("origin")))
    joined = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["block"])), ""))
    parts = parts.select(*fields, F.when(gapless & (n_bytes == F.col("total")), joined).otherwise(broken).alias("block"))
    schema = "kind string, page_id long, refers_to long, digest string, payload binary"
    return whole.unionByName(parts).mapInArrow(_payload, schema)


def round_trip(pages: DataFrame, path: str | None = None, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each page, from archives written and read back."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc-archives")
    write_archives(pages, path, segment_bytes)
    back = read_archives(spark, path).select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to", "digest")
    back = materialise(back, "warc-read")
    # A revisit's length is that of the record it refers to, whose digest must be the one it states.
    held = back.where("record_type = 'response' and page_id is not null").select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("_n")).distinct()
    revisits = back.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "digest").join(held, ["refers_to", "digest"], "left")
    revisits = revisits.select("page_id", F.coalesce("_n", F.raise_error(F.lit("a revisit refers to no such record")).cast("long")).alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    whole = back.where("record_type = 'response'").select("page_id", "payload_bytes", F.when(F.col("payload_digest") == F.col("digest"), F.col("digest")).otherwise(F.raise_error(F.lit("a payload differs from its digest"))).alias("payload_digest"), "record_type", "refers_to")
    return whole.unionByName(revisits)


def query(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


ORACLE = """
with p as (select page_id, coalesce(html, '') as html from pages),
q as (select page_id, cast(octet_length(encode(html)) as bigint) as n, sha1(html) as h from p),
k as (select h, max(page_id) as keeper from q where n >= 1000 group by h)
select page_id, n as payload_bytes, h as payload_digest,
       case when n >= 1000 and keeper is not null and keeper is distinct from page_id then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and keeper is distinct from page_id then keeper end as refers_to
from q left join k using (h)
"""
