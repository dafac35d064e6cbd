"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own, so an archive can be read from any
member on.  A reading task gets a byte range, scans it for the gzip magic, and
accepts a candidate only if its content decodes to a WARC header and the members
after it follow without a gap up to the end of the range; it then owns the records
that start inside its range, the last of which may end beyond it.  Where the members
after the first valid candidate break off, the archive is followed from its beginning:
either the candidate stood inside a record (an archive within an archive), or the
archive is damaged, which is an error.  So is a last record after which no other begins.

Of records with equal payloads, the one with the smallest ``page_id`` is a
``response`` and the others are ``revisit`` records that refer to it and hold no
payload; payloads under ``least`` bytes are always stored.

Any folder of ``*.warc.gz`` files can be read, ours or not: a missing digest or length
is taken from the payload.

Rows and cases: null html is an empty payload, a null url has no target header (others
come back percent-encoded where they hold odd characters), a null ``page_id`` counts as
larger than all others and comes back as null; payloads that only such rows have are
all responses.  Of rows that repeat the smallest ``page_id`` one is the response (that
with the smallest url), the others revisit it.  Other columns are ignored; an empty
table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 18
#: Bytes of a reading task's range, payload bytes held for one, and tasks at most.
SPLIT = 8 << 20
HELD = 64 << 20
TASKS = 20_000
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1, from four numbers of 40 bits."""
    digits = F.concat(*(F.lpad(F.conv(F.substring(F.sha1(data), 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)))
    return F.translate(F.upper(digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member."""
    lines = [f"{k}: {v}" for k, v in [*headers, ("Content-Length", str(len(block)))]]
    data = ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~")))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size)), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    return member(headers, http if refers_to is not None else http + payload)


def write(pages: DataFrame, folder: str, least: int = 0) -> dict:
    """Write an archive for each partition; the manifest lists them.

    Only ids, sizes and digests are shuffled to find repeated payloads.  If these are
    few, their table is broadcast and no page moves; beyond, pages meet it in a join.
    """
    spark = pages.sparkSession
    storage.small_batches(spark)
    none = (1 << 63) - 1
    order = F.coalesce(F.col("page_id"), F.lit(none))
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.octet_length(html).alias("size"), base32_sha1(html).alias("digest"))
    counts = storage.stage(rows.filter(F.col("size") >= least).groupBy("digest", "page_id").agg(F.count("*").alias("n")), "digests")
    repeated = counts.groupBy("digest").agg(F.min(order).alias("first"), F.sum("n").alias("n"), F.count_if((F.col("n") > 1) & F.col("page_id").isNotNull()).alias("again")).filter("n > 1")
    first = storage.stage(repeated.select("digest", "first", (F.col("again") > 0).alias("again")), "firsts")
    if first.count() <= storage.BROADCAST_ROWS:
        first = F.broadcast(first)
    marked = rows.join(first, "digest", "left")
    known = F.col("first").isNotNull() & (F.col("first") < none) & (F.col("size") >= least)
    repeats = known & (order != F.col("first"))
    columns = ["page_id", "url", F.when(~repeats, F.col("html")).alias("html"), "size", "digest", F.when(repeats, F.col("first")).alias("refers_to")]
    twice = known & (order == F.col("first")) & F.coalesce("again", F.lit(False))
    single = marked.filter(~F.coalesce(twice, F.lit(False))).select(*columns, F.lit(1).cast("long").alias("copies"))
    if not counts.filter("n > 1 AND page_id IS NOT NULL").isEmpty():
        # Equal rows are counted, so that one of them can be the response.
        equal = marked.filter(twice).groupBy("page_id", "url", "size", "digest").agg(F.first("html").alias("html"), F.count("*").alias("copies"))
        least_url = equal.groupBy("digest", "page_id").agg(F.min(F.struct(F.col("url").isNull(), "url")).alias("u"))
        chosen = equal.join(least_url, ["digest", "page_id"]).withColumn("own", F.col("url").eqNullSafe(F.col("u.url")))
        response = chosen.filter("own").select("page_id", "url", "html", "size", "digest", F.lit(None).cast("long").alias("refers_to"), F.lit(1).cast("long").alias("copies"))
        rest = chosen.withColumn("left", F.col("copies") - F.col("own").cast("long")).filter("left > 0")
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("left") - 1, F.lit(storage.BATCH_ROWS).cast("long"))).alias("k")
        revisits = rest.select("page_id", "url", "size", "digest", "left", parts).select("page_id", "url", F.lit(None).cast("string").alias("html"), "size", "digest", F.col("page_id").alias("refers_to"), F.least(F.col("left") - F.col("k"), F.lit(storage.BATCH_ROWS).cast("long")).alias("copies"))
        single = single.unionByName(response).unionByName(revisits.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    marked = single

    def run(batches):
        from pyspark import TaskContext

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        name = f"pages-{TaskContext.get().partitionId():06d}.warc.gz"
        n = 0
        with storage.writing(f"{folder}/{name}") as out:
            out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"software: genespark\r\nformat: WARC/1.1\r\n"))
            for batch in chained(first, batches):
                for page_id, url, text, size, digest, refers_to, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = record(page_id, url, (text or "").encode("utf-8"), digest, size, refers_to)
                    for _ in range(copies):
                        out.write(data)
                    n += copies
            size = out.tell()
        yield pa.RecordBatch.from_pydict({"name": [name], "size": [size], "n": [n]})

    files = marked.mapInArrow(run, "name string, size long, n long").collect()  # a row an archive
    manifest = {"files": sorted([r.name, r.size] for r in files)}
    with storage.writing(f"{folder}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def chained(first, rest):
    yield first
    yield from rest


@dataclass
class Record:
    start: int
    headers: dict[str, str]
    block: bytes


class Broken(ValueError):
    """Not a WARC record in a gzip member."""


def header_of(data: bytes) -> tuple[dict[str, str], int] | None:
    """Headers and their length if ``data`` begins with all of them; None if more is needed."""
    if not data[:7] == b"WARC/1."[: len(data)]:
        raise Broken("no WARC version")
    end = data.find(b"\r\n\r\n")
    if end < 0:
        if len(data) > 1 << 16:
            raise Broken("no end of headers")
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not headers.get("content-length", "").isdigit() or "warc-type" not in headers:
        raise Broken("headers are missing")
    return headers, end + 4


def read_member(source, start: int, keep: bool) -> tuple[Record, int]:
    """The record of the member at ``start`` and where the next member begins."""
    inflate, source_at = zlib.decompressobj(31), start
    source.seek(start)
    parts, total, headers, length = [], 0, None, 0
    head = b""
    while not inflate.eof:
        data = source.read(CHUNK)
        if not data:
            raise Broken("the member has no end")
        source_at += len(data)
        try:
            out = inflate.decompress(data)
        except zlib.error as error:
            raise Broken(str(error)) from None
        total += len(out)
        if headers is None:
            head += out
            if found := header_of(head):
                headers, length = found
        if keep:
            parts.append(out)
    if headers is None or total < length + int(headers["content-length"]):
        raise Broken("the record is cut off")
    block = b"".join(parts)[length : length + int(headers["content-length"])] if keep else b""
    return Record(start, headers, block), source_at - len(inflate.unused_data)


def chain(source, start: int, end: int, size: int, keep: bool) -> Iterator[Record]:
    """Records that start in [start, end), member after member."""
    while start < min(end, size):
        found, start = read_member(source, start, keep)
        yield found


def candidates(source, start: int, end: int) -> Iterator[int]:
    """Offsets in [start, end) where the gzip magic stands."""
    at = start
    while at < end:
        source.seek(at)
        data = source.read(min(CHUNK, end - at) + len(MAGIC) - 1)
        for found in re.finditer(re.escape(MAGIC), data):
            yield at + found.start()
        at += CHUNK


def checked_chain(source, start: int, end: int, size: int) -> Iterator[Record]:
    """As ``chain``; then a record must begin where the last one ended, if the archive goes on."""
    for found, after in steps(source, start, end, size, True):
        yield found
        start = after
    if end <= start < size and not begins(source, start):
        raise Broken(f"no record begins at {start}")


def steps(source, start: int, end: int, size: int, keep: bool) -> Iterator[tuple[Record, int]]:
    while start < min(end, size):
        at = start
        try:
            found, start = read_member(source, at, keep)
        except Broken as error:
            raise Broken(f"the record at {at} is damaged: {error}") from None
        yield found, start


def begins(source, start: int) -> bool:
    """Whether a member with a WARC header begins here."""
    inflate, head = zlib.decompressobj(31), b""
    source.seek(start)
    try:
        while data := source.read(1 << 12):
            head += inflate.decompress(data)
            if header_of(head):
                return True
            if inflate.eof:
                return False
    except (Broken, zlib.error):
        return False
    return False


def read_range(source, start: int, end: int, size: int) -> Iterator[Record]:
    """The records that a range owns; a damaged archive raises an error.

    The records behind a candidate are held until they reach the range's end, up to
    ``HELD`` bytes; beyond that they are checked first and then read again.
    """
    if start == 0:
        yield from checked_chain(source, 0, end, size)
        return
    at = next((c for c in candidates(source, start, min(end, size)) if begins(source, c)), None)
    if at is None:
        return
    held, total, again = [], 0, False
    try:
        for found, _ in steps(source, at, end, size, True):
            total += len(found.block)
            if total > HELD:
                held, again = [], True
            if not again:
                held.append(found)
            elif held:
                held.clear()
    except Broken:
        # A magic inside a record, or damage: only the records before can tell.
        place = 0
        for _, place in steps(source, 0, start, size, False):
            pass
        if place >= end:
            return
        yield from checked_chain(source, place, end, size)
        return
    if again:
        yield from checked_chain(source, at, end, size)
        return
    yield from held
    # The last one's end isn't known from the records alone.
    if held:
        _, after = read_member(source, held[-1].start, False)
        if end <= after < size and not begins(source, after):
            raise Broken(f"no record begins at {after}")


def page_of(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if re.fullmatch(r"-?\d+", number) else None


def read(spark: SparkSession, folder: str, split: int = SPLIT) -> DataFrame:
    """page_id, url, payload (null in revisits), payload_bytes, payload_digest, record_type, refers_to of all archives of a folder.

    Spark lists the files; executors make the ranges of each.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def row(found: Record, name: str) -> tuple:
        kind, head = found.headers["warc-type"], found.headers
        payload = found.block.partition(b"\r\n\r\n")[2] if kind == "response" else None
        digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        own = None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest and own and "x-payload-length" in head and digest != own:
            raise ValueError(f"payload and digest differ in {name} at {found.start}")
        n = len(payload) if payload is not None else int(head["x-payload-length"]) if "x-payload-length" in head else None
        return page_of(head.get("warc-record-id")), head.get("warc-target-uri"), payload, n, own or digest, kind, page_of(head.get("warc-refers-to"))

    def run(batches):
        for batch in batches:
            for name, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                with storage.reading(name) as source:
                    for found in read_range(source, start, min(start + split, size), size):
                        if found.headers["warc-type"] not in ("response", "revisit"):
                            continue
                        rows.append(row(found, name))
                        held += len(rows[-1][2] or b"")
                        if held > storage.BATCH_BYTES or len(rows) >= storage.BATCH_ROWS:
                            yield to_batch(rows)
                            rows, held = [], 0
                yield to_batch(rows)

    def to_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows, strict=True)) or [()] * 7, schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length").filter("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long"))).alias("start"), F.col("length").alias("size"))
    n = files.agg(F.sum(F.ceil(F.col("length") / split))).first()[0] or 1
    return ranges.repartition(min(n, TASKS)).mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")
