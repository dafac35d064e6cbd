"""Token-ID output: canonical length-limited Huffman files with random access.

Ids get code lengths of at most ``max_bits`` by the package-merge method, from
their counts over all documents; codes are canonical, so a file needs only the
lengths.  The stream of ids, documents in ascending ``doc_id``, is written in
blocks that decode on their own.  A block lists the bit offset of every
``INTERVAL``-th id: from these checkpoints it is decoded in parallel lanes by one
table look-up per id.  A file ends with the places of its blocks, so ``Stream.read``
gets any stretch of the stream from the checkpoint before it, without the rest.

Rows and cases: a null text is an empty one (its only id is the end id), null
``doc_id`` sorts first and comes back as null, repeated ids and rows are all kept
(equal ids in the order of their ids' bytes), other columns are ignored, and an
empty table gives no file and no row.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage, tokens

MAGIC = b"IDHUF2\0\0"
INTERVAL = 128
BLOCK = 1 << 17
NULL_ID = -(1 << 63)
#: In place of a block's number of documents: the list of blocks follows.
INDEX = (1 << 32) - 1


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits``; 0 where the count is 0."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids don't fit codes of {max_bits} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, []
    flags = np.ones(len(leaves), dtype=bool)
    for _ in range(max_bits):
        is_leaf.append(flags)
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        place = np.argsort(both, kind="stable")
        level, flags = both[place], place < len(leaves)
    take = 2 * len(leaves) - 2
    for flags in reversed(is_leaf):
        n = int(flags[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


class Codebook:
    """Canonical codes for given lengths, and the decoding table."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, dtype=np.uint8)
        self.bits = int(self.lengths.max(initial=1))
        if self.bits > 24:
            raise ValueError("codes may have 24 bits at most")
        order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
        order = order[self.lengths[order] > 0]
        size = np.int64(1) << (self.bits - self.lengths[order].astype(np.int64))
        start = np.concatenate([[0], np.cumsum(size)])
        self.codes = np.zeros(len(self.lengths), dtype=np.int64)
        self.codes[order] = start[:-1] >> (self.bits - self.lengths[order].astype(np.int64))
        self.table = np.zeros(1 << self.bits, dtype=np.uint32)
        self.table[: start[-1]] = np.repeat(order.astype(np.uint32), size)
        self.steps = self.lengths[self.table].astype(np.int64)

    def check(self) -> int:
        return zlib.crc32(self.lengths.tobytes())

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bit stream of ids, and the bit offset of every INTERVAL-th."""
        n = self.lengths[ids].astype(np.int64)
        if not n.all():
            raise ValueError("an id without a code")
        end = np.cumsum(n)
        start = end - n
        word, shift = start >> 5, (64 - (start & 31) - n).astype(np.uint64)
        wide = self.codes[ids].astype(np.uint64) << shift  # in 64 unsigned bits that begin at its 32-bit word
        words = int(end[-1] + 31 >> 5) + 1 if len(ids) else 1
        # Codes don't overlap, so sums join them; each sum stays below 2**32.
        high = np.bincount(word, wide >> np.uint64(32), words)
        low = np.bincount(word + 1, wide & np.uint64(0xFFFFFFFF), words + 1)[:words]
        return (high + low).astype(">u4").tobytes(), start[::INTERVAL].astype("<u4")

    def unpack(self, payload: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ids of a block, decoded from all checkpoints side by side."""
        raw = np.frombuffer(payload + bytes(4), dtype=np.uint8).astype(np.int64)
        view = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        place, mask, top = offsets.astype(np.int64), (1 << self.bits) - 1, 32 - self.bits
        out = np.zeros((len(place), INTERVAL), dtype=np.uint32)
        last = len(view) - 1
        for k in range(min(INTERVAL, n)):
            code = view[np.minimum(place >> 3, last)] >> (top - (place & 7)) & mask
            out[:, k] = self.table[code]
            place = place + self.steps[code]
        return out.reshape(-1)[:n]


def write_block(out, book: Codebook, ids: np.ndarray, docs: list[tuple[int, int]]) -> None:
    """One block: counts, documents that end in it (id, end position), checkpoints, bits."""
    payload, offsets = book.pack(ids)
    out.write(struct.pack("<IIII", len(ids), len(docs), len(offsets), len(payload)))
    out.write(np.array([d for d, _ in docs], dtype="<i8").tobytes())
    out.write(np.array([e for _, e in docs], dtype="<u4").tobytes())
    out.write(offsets.tobytes())
    out.write(payload)


def write_file(out, book: Codebook, rows: Iterator[tuple[int | None, np.ndarray]]) -> tuple[int, int]:
    """Write (doc_id, ids) in the given order; returns documents and ids written."""
    out.write(MAGIC + struct.pack("<IQ", book.check(), 0))
    parts, docs, places, held, n_docs, n_ids = [], [], [], 0, 0, 0
    for doc_id, ids in rows:
        n_docs, n_ids = n_docs + 1, n_ids + len(ids)
        while held + len(ids) > BLOCK:
            parts.append(ids[: BLOCK - held])
            ids = ids[BLOCK - held :]
            places.append(out.tell())
            write_block(out, book, np.concatenate(parts), docs)
            parts, docs, held = [], [], 0
        parts.append(ids)
        held += len(ids)
        docs.append((NULL_ID if doc_id is None else doc_id, held))
    if docs:
        places.append(out.tell())
        write_block(out, book, np.concatenate(parts), docs)
    index = out.tell()
    out.write(struct.pack("<IIII", len(places), INDEX, 0, 0) + np.array(places, dtype="<u8").tobytes() + struct.pack("<Q", index))
    return n_docs, n_ids


def read_file(source, book: Codebook) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    """(doc_id, pieces of its ids) in the file's order, a block at a time."""
    magic, check, _ = struct.unpack("<8sIQ", source.read(20))
    if magic != MAGIC or check != book.check():
        raise ValueError("not a file of this codebook")
    held: list[np.ndarray] = []
    while head := source.read(16):
        n, n_docs, n_marks, size = struct.unpack("<IIII", head)
        if n_docs == INDEX:
            return
        doc_ids = np.frombuffer(source.read(8 * n_docs), dtype="<i8")
        ends = np.frombuffer(source.read(4 * n_docs), dtype="<u4").astype(np.int64)
        offsets = np.frombuffer(source.read(4 * n_marks), dtype="<u4")
        ids = book.unpack(source.read(size), offsets, n)
        at = 0
        for doc_id, end in zip(doc_ids.tolist(), ends.tolist(), strict=True):
            held.append(ids[at:end])
            yield None if doc_id == NULL_ID else doc_id, held
            held, at = [], end
        if at < n:
            held.append(ids[at:])


def block_places(source) -> np.ndarray:
    """Where the blocks of a file stand; all but the last hold ``BLOCK`` ids."""
    size = source.size()
    source.seek(size - 8)
    (index,) = struct.unpack("<Q", source.read(8))
    source.seek(index + 16)
    return np.frombuffer(source.read(size - 8 - index - 16), dtype="<u8")


def read_part(source, place: int, book: Codebook, low: int, high: int) -> np.ndarray:
    """The ids [low, high) of the block at ``place``, from the checkpoint before the first of them."""
    source.seek(place)
    n, n_docs, n_marks, size = struct.unpack("<IIII", source.read(16))
    high = min(high, n)
    first, after = low // INTERVAL, -(-high // INTERVAL)
    source.seek(place + 16 + 12 * n_docs + 4 * first)
    marks = np.frombuffer(source.read(4 * (min(after + 1, n_marks) - first)), dtype="<u4").astype(np.int64)
    begin, end = int(marks[0]) >> 3, (int(marks[-1]) >> 3) + 1 if after < n_marks else size
    source.seek(place + 16 + 12 * n_docs + 4 * n_marks + begin)
    ids = book.unpack(source.read(end - begin), marks[: after - first] - 8 * begin, min(after * INTERVAL, n) - first * INTERVAL)
    return ids[low - first * INTERVAL : high - first * INTERVAL]


class Stream:
    """Random access to the ids that ``write_ids`` wrote below ``folder``."""

    def __init__(self, folder: str):
        with storage.reading(f"{folder}/manifest.json") as source:
            manifest = json.loads(source.read())
        self.folder, self.files = folder, manifest["files"]
        self.starts = np.array([f["start"] for f in self.files], dtype=np.int64)
        self.size = sum(f["n_ids"] for f in self.files)
        self.book = Codebook(np.frombuffer(zlib.decompress(bytes.fromhex(manifest["lengths"])), dtype=np.uint8))

    def read(self, start: int, n: int) -> np.ndarray:
        """The ids [start, start + n) of the stream; fewer where it ends."""
        end, found = min(start + n, self.size), [np.zeros(0, dtype=np.uint32)]
        at = max(start, 0)
        while at < end:
            file = self.files[int(np.searchsorted(self.starts, at, side="right")) - 1]
            low, high = at - file["start"], min(end - file["start"], file["n_ids"])
            with storage.reading(f"{self.folder}/{file['name']}") as source:
                places = block_places(source)
                for k in range(low // BLOCK, -(-high // BLOCK)):
                    found.append(read_part(source, int(places[k]), self.book, max(low - k * BLOCK, 0), min(high - k * BLOCK, BLOCK)))
            at = file["start"] + high
        return np.concatenate(found)


def count_ids(staged: DataFrame, size: int) -> np.ndarray:
    """Counts of all ids of staged documents; what reaches the driver is bounded by the vocabulary."""

    def count(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for data, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total += np.bincount(tokens.unpacked(data, n), minlength=size) if n > size else 0
            short = [tokens.unpacked(d, n) for d, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if n <= size]
            if short:
                total += np.bincount(np.concatenate(short), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = staged.select("ids", "n").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, dtype=np.int64)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return counts


def stage_ids(docs: DataFrame, tokenizer: str, end_id: int) -> tuple[DataFrame, str]:
    """Encode all texts once: a staged table (doc_id, n, ids) and its folder."""

    def run(batches):
        encoder, end = tokens.encoder(tokenizer), tokens.id_bytes(end_id)
        for batch in batches:
            data = [x + end for x in encoder.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // 4 for x in data], pa.int64()), pa.array([tokens.packed(x, encoder.width(end_id)) for x in data], pa.binary())], ["doc_id", "n", "ids"])

    folder = storage.scratch(docs.sparkSession, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, ids binary")
    return storage.stage(rows, "tokens", folder), folder


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, max_bits: int = 16) -> dict:
    """Encode ``doc_id, text`` of all documents into files below ``folder``.

    Texts are tokenized once, into a staged table of narrow ids.  That gives the
    counts, and is then sorted by ``doc_id`` over range partitions, each of which
    writes a file.  Returns the manifest, which is also written as ``manifest.json``.
    """
    spark = docs.sparkSession
    storage.small_batches(spark)
    staged, staging = stage_ids(docs, tokenizer, end_id)
    size = max(tokens.encoder(tokenizer).size, end_id + 1)
    lengths = code_lengths(count_ids(staged, size), max_bits)
    packed = zlib.compress(lengths.tobytes())

    def write(batches):
        from pyspark import TaskContext

        book = Codebook(np.frombuffer(zlib.decompress(packed), dtype=np.uint8))

        def rows():
            for batch in batches:
                yield from zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)

        queue = ((doc_id, tokens.unpacked(data, n)) for doc_id, n, data in rows())
        first = next(queue, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        name = f"ids-{part:06d}.huf"
        with storage.writing(f"{folder}/{name}") as out:
            n_docs, n_ids = write_file(out, book, chain_first(first, queue))
        yield pa.RecordBatch.from_pydict({"part": [part], "name": [name], "n_docs": [n_docs], "n_ids": [n_ids]})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # range bounds are sampled to the driver, so the keys are of fixed width; the row's place splits equal rows of one id
    keyed = staged.select("*", F.xxhash64("ids").alias("digest"), F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("place"))
    keys = [F.col("doc_id").asc_nulls_first(), "n", "digest", "place"]
    ordered = keyed.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("doc_id", "n", "ids")
    files = ordered.mapInArrow(write, "part long, name string, n_docs long, n_ids long").collect()
    start, listed = 0, []
    for row in sorted(files, key=lambda r: r.part):  # one row a file
        listed.append({"name": row.name, "start": start, "n_docs": row.n_docs, "n_ids": row.n_ids})
        start += row.n_ids
    manifest = {"lengths": packed.hex(), "end_id": end_id, "files": listed}
    with storage.writing(f"{folder}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    storage.drop(spark, staging)
    return manifest


def chain_first(first, rest):
    yield first
    yield from rest


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32 (and ids if asked for)."""
    with storage.reading(f"{folder}/manifest.json") as source:
        manifest = json.loads(source.read())
    packed = bytes.fromhex(manifest["lengths"])

    def read(batches):
        book = Codebook(np.frombuffer(zlib.decompress(packed), dtype=np.uint8))
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: dict[str, list] = {k: [] for k in names}
                with storage.reading(f"{folder}/{name}") as source:
                    for doc_id, pieces in read_file(source, book):
                        crc, n = 0, 0
                        for piece in pieces:
                            crc, n = zlib.crc32(piece.astype("<u4").tobytes(), crc), n + len(piece)
                        row = [doc_id, start, n, crc] + ([np.concatenate(pieces).tolist()] if with_ids else [])
                        for key, value in zip(names, row, strict=True):
                            out[key].append(value)
                        start += n
                        if len(out["doc_id"]) >= storage.BATCH_ROWS:
                            yield pa.RecordBatch.from_pydict(out, schema=schema)
                            out = {k: [] for k in names}
                if out["doc_id"]:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)

    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int64()))] if with_ids else []))
    names = schema.names
    files = [(x["name"], x["start"]) for x in manifest["files"]]
    listed = spark.createDataFrame(files, "name string, start long").repartition(max(1, len(files)))
    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
