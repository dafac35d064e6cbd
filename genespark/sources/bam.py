"""Reader and writer of BAM files (BGZF blocks of binary alignment records).

A file is read in byte ranges, each a row of a task.  A range begins at the first
record that starts in a block of its own.  Records carry no mark of their beginning,
so the place is found by trial: the first offset from which several plausible
records follow one another.  A range ends where its own chain of records passes
its bound, and that place must be the one that trial finds for the next range;
otherwise the reader raises.  The first range starts right behind the header, so by
induction every record is read once, whatever the trials found.

Rows and cases: a file without records gives no row, a range inside one long record
none either, a record without a reference has the seqid "*", as in SAM text, a
CIGAR of more than 65,535 parts is taken from its CG tag, damaged or truncated
blocks raise an error, a missing end marker doesn't.
"""

from __future__ import annotations

import contextlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Operations, tag sizes and the end marker of the format.
OPERATIONS = "MIDNSHP=X"
TAG_BYTES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
TAG_NUMBERS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I"}
END_MARKER = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")

#: Bytes of a file that one task reads, of a block's text at most, and rows of an Arrow batch.
RANGE = 32 << 20
BLOCK = 1 << 16
BATCH_ROWS = 4096
#: Bytes of a record before its name, and records that must follow one another in a trial.
HEAD = 36
CHAIN = 8
#: Flags of records that are left out: unmapped, secondary, supplementary.
LEFT_OUT = 0x904

SCHEMA = "name string, flag int, seqid string, start long, mapq int, cigar array<struct<op:string,len:bigint>>, xs string, nh int"


def _open(uri: str):
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem().open_input_file(unquote(parts.path))
    files, path = pafs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


def _block_size(head: bytes, at: int = 0) -> int | None:
    """Bytes of the BGZF block whose header stands at ``at``; None if none does."""
    if len(head) - at < 18 or head[at : at + 4] != b"\x1f\x8b\x08\x04":
        return None
    end = at + 12 + int.from_bytes(head[at + 10 : at + 12], "little")
    at += 12
    while at + 6 <= min(end, len(head)):
        size = int.from_bytes(head[at + 2 : at + 4], "little")
        if head[at : at + 2] == b"BC" and size == 2:
            return int.from_bytes(head[at + 4 : at + 6], "little") + 1
        at += 4 + size
    return None


def _inflate(block: bytes) -> bytes:
    data = zlib.decompress(block[12 + int.from_bytes(block[10:12], "little") : -8], -15, BLOCK)
    if struct.pack("<II", zlib.crc32(data), len(data)) != block[-8:]:
        raise ValueError("damaged block")
    return data


class Blocks:
    """The text of a file's blocks from one of them on, read as far as asked for.

    ``text`` holds it from ``done`` on; ``starts`` are the blocks' (place in the text, place in the file).
    """

    def __init__(self, source, at: int):
        self.source, self.next, self.size = source, at, source.size()
        self.text, self.done, self.starts = bytearray(), 0, []

    def more(self) -> bool:
        if self.next >= self.size:
            return False
        self.source.seek(self.next)
        raw = self.source.read(BLOCK + 512)
        size = _block_size(raw)
        if size is None or size > len(raw):
            raise ValueError(f"no whole block at byte {self.next}")
        try:
            data = _inflate(raw[:size])
        except (zlib.error, ValueError) as error:
            raise ValueError(f"damaged block at byte {self.next}") from error
        if data:
            self.starts.append((self.done + len(self.text), self.next))
        self.text += data
        self.next += size
        return True

    def get(self, at: int, n: int) -> bytes | None:
        """``n`` bytes at ``at``; None if the text ends before."""
        while self.done + len(self.text) < at + n:
            if not self.more():
                return None
        return bytes(self.text[at - self.done : at - self.done + n])

    def block(self, at: int) -> tuple[int, int]:
        """Where the block of a place stands in the file, and the place in it; the file's size at the end."""
        if self.get(at, 1) is None:
            return self.size, 0
        begin, spot = next(x for x in reversed(self.starts) if x[0] <= at)
        return spot, at - begin

    def forget(self, at: int) -> None:
        """Drop the text before ``at``, but for the block that holds it."""
        if at - self.done > 16 * BLOCK:
            keep = max(k for k, x in enumerate(self.starts) if x[0] <= at) if self.starts and self.starts[0][0] <= at else 0
            self.starts = self.starts[keep:]
            del self.text[: at - self.done]
            self.done = at


def header(blocks: Blocks) -> tuple[list[tuple[str, int]], int]:
    """Reference names and lengths, and where the records begin."""
    if blocks.get(0, 4) != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + _int(blocks, 4)
    n, at, found = _int(blocks, at), at + 4, []
    for _ in range(n):
        size = _int(blocks, at)
        found.append((_bytes(blocks, at + 4, size - 1).decode(), _int(blocks, at + 4 + size)))
        at += 8 + size
    return found, at


def _bytes(blocks: Blocks, at: int, n: int) -> bytes:
    found = blocks.get(at, n)
    if found is None:
        raise ValueError("the file ends within a record")
    return found


def _int(blocks: Blocks, at: int) -> int:
    return int.from_bytes(_bytes(blocks, at, 4), "little", signed=True)


def _plausible(blocks: Blocks, at: int, lengths: list[int]) -> int | None:
    """Where the record at ``at`` would end; None if there can be none."""
    head = blocks.get(at, HEAD)
    if head is None:
        return None
    size, ref, pos, n_name, _, _, n_ops, _, n_seq, mate, mate_pos, _ = struct.unpack("<iiiBBHHHiiii", head)
    if not (-1 <= ref < len(lengths) and -1 <= mate < len(lengths) and n_name and n_seq >= 0):
        return None
    if not (-1 <= pos <= (lengths[ref] if ref >= 0 else 1 << 31) and -1 <= mate_pos <= (lengths[mate] if mate >= 0 else 1 << 31)):
        return None
    if size < HEAD - 4 + n_name + 4 * n_ops + (n_seq + 1) // 2 + n_seq:
        return None
    name = blocks.get(at + HEAD, n_name)
    if name is None or name[-1] or not all(33 <= c < 127 for c in name[:-1]):
        return None
    ops = blocks.get(at + HEAD + n_name, 4 * n_ops)
    return at + 4 + size if ops is not None and all(c & 15 < len(OPERATIONS) for c in ops[::4]) else None


def first_record(source, at: int, lengths: list[int]) -> tuple[int, int]:
    """(block, place in it) of the first record that starts in a block at or after byte ``at``; (file size, 0) if none does."""
    end = source.size()
    while at < end:
        source.seek(at)
        raw = source.read(2 * BLOCK)
        k = raw.find(b"\x1f\x8b\x08\x04")
        while k >= 0:
            size = _block_size(raw, k)
            follows = size and (at + k + size == end or _block_size(_read(source, at + k + size, 512)))
            if follows:
                with contextlib.suppress(zlib.error, ValueError):
                    _inflate(_read(source, at + k, size))
                    return _first_in(Blocks(source, at + k), lengths)
            k = raw.find(b"\x1f\x8b\x08\x04", k + 1)
        at += max(1, len(raw) - 3)
    return end, 0


def _read(source, at: int, n: int) -> bytes:
    source.seek(at)
    return source.read(n)


def _first_in(blocks: Blocks, lengths: list[int]) -> tuple[int, int]:
    at = 0
    while blocks.get(at, 1) is not None:
        follow = at
        for _ in range(CHAIN):
            follow = _plausible(blocks, follow, lengths)
            if follow is None or blocks.get(follow, 1) is None:
                break
        if follow is not None and blocks.get(follow - 1, 1) is not None:
            return blocks.block(at)
        at += 1
        blocks.forget(at)
    return blocks.size, 0


def _tags(data: bytes, at: int) -> dict[str, object]:
    """The tags XS:A, NH and CG of a record."""
    found: dict[str, object] = {}
    while at + 3 <= len(data):
        name, kind = data[at : at + 2].decode("latin-1"), chr(data[at + 2])
        at += 3
        if kind in ("Z", "H"):
            at = data.index(0, at) + 1
        elif kind == "B":
            each, n = TAG_BYTES[chr(data[at])], int.from_bytes(data[at + 1 : at + 5], "little")
            if name == "CG":
                found[name] = data[at + 5 : at + 5 + each * n]
            at += 5 + each * n
        else:
            if kind == "A":
                found[name] = chr(data[at])
            elif name == "NH" and kind in TAG_NUMBERS:
                found[name] = struct.unpack_from(TAG_NUMBERS[kind], data, at)[0]
            at += TAG_BYTES[kind]
    return found


def _record(data: bytes, names: list[str], least_mapq: int) -> tuple | None:
    ref, pos, n_name, mapq, _, n_ops, flag, n_seq = struct.unpack_from("<iiBBHHHi", data)
    if flag & LEFT_OUT or mapq < least_mapq:
        return None
    at = HEAD - 4 + n_name
    ops, tags = data[at : at + 4 * n_ops], _tags(data, at + 4 * n_ops + (n_seq + 1) // 2 + n_seq)
    codes = struct.unpack(f"<{n_ops}I", ops)
    if n_ops == 2 and "CG" in tags and codes[0] == n_seq << 4 | 4:
        codes = struct.unpack(f"<{len(tags['CG']) // 4}I", tags["CG"])
    cigar = [{"op": OPERATIONS[c & 15], "len": c >> 4} for c in codes]
    xs = tags.get("XS") if tags.get("XS") in ("+", "-") else None
    return data[HEAD - 4 : at - 1].decode("latin-1"), flag, names[ref] if ref >= 0 else "*", pos, mapq, cigar, xs, tags.get("NH")


def records(source, begin: int, end: int, least_mapq: int) -> Iterator[tuple]:
    """Kept records that start in the blocks of the bytes [begin, end) of a file."""
    refs, first = header(Blocks(source, 0))
    names, lengths = [n for n, _ in refs], [n for _, n in refs]
    until = first_record(source, end, lengths) if end < source.size() else (source.size(), 0)
    if begin:
        spot, skip = first_record(source, begin, lengths)
    else:
        blocks = Blocks(source, 0)
        _bytes(blocks, 0, first)
        spot, skip = blocks.block(first)
    blocks, at = Blocks(source, spot), skip
    while (spot := blocks.block(at))[0] < end and blocks.get(at, 1) is not None:
        size = _int(blocks, at)
        if size < HEAD - 4:
            raise ValueError(f"damaged record in the block at byte {spot[0]}")
        found = _record(_bytes(blocks, at + 4, size), names, least_mapq)
        if found:
            yield found
        at += 4 + size
        blocks.forget(at)
    if spot != until:
        raise ValueError(f"records up to byte {end} end at {spot}, the next ones seem to begin at {until}; read the file in one range")


def bam(spark: SparkSession, path: str, least_mapq: int = 20, range_bytes: int = RANGE) -> DataFrame:
    """Primary alignments of BAM files, with the columns of ``readers.sam``."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("begin"))
    spread = ranges.repartition(F.xxhash64("path", "begin"))

    def read(batches):
        kind = pa.schema([("name", pa.string()), ("flag", pa.int32()), ("seqid", pa.string()), ("start", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.list_(pa.struct([("op", pa.string()), ("len", pa.int64())]))), ("xs", pa.string()), ("nh", pa.int32())])
        for batch in batches:
            for uri, size, begin in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                with _open(uri) as source:
                    held = []
                    for found in records(source, begin, min(size, begin + range_bytes), least_mapq):
                        held.append(found)
                        if len(held) == BATCH_ROWS:
                            yield _batch(held, kind)
                            held = []
                    if held:
                        yield _batch(held, kind)

    return spread.mapInArrow(read, SCHEMA)


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)


def _encoded(name: str, flag: int, ref: int, start: int, mapq: int, cigar: list, xs: str | None, nh: int | None) -> bytes:
    """A record without sequence; the bin is that of a record that isn't indexed."""
    codes = [c["len"] << 4 | OPERATIONS.index(c["op"]) for c in cigar]
    tags = (b"NHi" + struct.pack("<i", nh) if nh is not None else b"") + (b"XSA" + xs.encode() if xs else b"")
    if len(codes) > 65535:
        tags += b"CGBI" + struct.pack(f"<I{len(codes)}I", len(codes), *codes)
        codes = [4, sum(c["len"] for c in cigar if c["op"] in "MDN=X") << 4 | 3]
    label = name.encode("latin-1") + b"\0"
    body = struct.pack("<iiBBHHHiiii", ref, start, len(label), mapq, 0, len(codes), flag, 0, -1, -1, 0) + label + struct.pack(f"<{len(codes)}I", *codes) + tags
    return struct.pack("<i", len(body)) + body


def _deflated(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return bytes.fromhex("1f8b08040000000000ff060042430200") + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def write_bam(reads: DataFrame, references: dict[str, int], folder: str) -> None:
    """Write alignments (columns of ``bam``) as one BAM file a partition, unsorted, without sequences and qualities.

    A file appears by a rename when it is complete, so a task may be repeated.
    """
    number = {name: k for k, name in enumerate(references)}
    text = b"@HD\tVN:1.6\n"
    head = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(number))
    for name, length in references.items():
        head += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)

    def file(number_of: int, batches) -> int:
        parts = urlparse(folder)
        files, path = (pafs.LocalFileSystem(), unquote(parts.path)) if parts.scheme in ("", "file") else pafs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        target, part, n = f"{path}/part-{number_of:06d}.bam", f"{path}/_{uuid.uuid4().hex}.tmp", 0
        with files.open_output_stream(part) as out:
            held = bytearray(head)
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    name, flag, seqid, *rest = row
                    held += _encoded(name, flag, number.get(seqid, -1), *rest)
                    n += 1
                    while len(held) >= BLOCK - 256:
                        out.write(_deflated(bytes(held[: BLOCK - 256])))
                        del held[: BLOCK - 256]
            out.write(_deflated(bytes(held)) + END_MARKER)
        files.move(part, target)
        return n

    def write(batches):
        from pyspark import TaskContext

        yield pa.RecordBatch.from_pydict({"n": [file(TaskContext.get().partitionId(), batches)]})

    columns = [f.split(" ")[0] for f in ("name string", "flag int", "seqid string", "start long", "mapq int", "cigar x", "xs string", "nh int")]
    if reads.select(*columns).mapInArrow(write, "n long").agg(F.sum("n")).first()[0] is None:
        file(0, [])  # a table without partitions: a header alone
