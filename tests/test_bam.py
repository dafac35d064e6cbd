import random
import struct

import pytest

from genespark.sources import bam, readers

REFS = {"chr1": 1 << 20, "chr2": 5000}


def alignments(spark, n=4000):
    rng = random.Random(1)
    rows = []
    for k in range(n):
        cigar = [("M", rng.randint(1, 90)), ("N", rng.randint(5, 400)), ("M", rng.randint(1, 90)), ("S", 3)][: rng.choice([1, 3, 4])]
        rows.append((f"read:{k}", rng.choice([0, 16, 83, 163, 4, 256, 2048]), rng.choice(["chr1", "chr2", "*"]), rng.randint(0, 4000), rng.choice([0, 19, 20, 60]), cigar, rng.choice(["+", "-", None]), rng.choice([1, 2, None])))
    rows.append(("long", 0, "chr1", 7, 60, [("M", 1), ("I", 1)] * 40000, None, 300))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, bam.SCHEMA)


def plain(rows):
    return sorted(((r[0], *r[1:5], [tuple(c) for c in r[5]], r[6], r[7]) for r in rows), key=lambda r: r[0])


@pytest.mark.parametrize("size", [700, 5000, 1 << 15, 1 << 25])
def test_every_record_is_read_once_at_any_range_size(spark, tmp_path, size):
    rows, table = alignments(spark)
    bam.write_bam(table.repartition(2), REFS, f"{tmp_path}/a")
    wanted = plain(r for r in rows if not r[1] & 0x904 and r[4] >= 20)
    assert plain(bam.bam(spark, f"{tmp_path}/a/*.bam", range_bytes=size).collect()) == wanted
    assert any(len(r[5]) == 80000 for r in wanted)


def test_same_rows_as_sam_text(spark, tmp_path):
    rows, table = alignments(spark, 500)
    bam.write_bam(table, REFS, f"{tmp_path}/a")
    lines = ["\t".join([n, str(f), c, str(s + 1), str(q), "".join(f"{k}{op}" for op, k in g), "*", "0", "0", "*", "*", *([f"NH:i:{h}"] if h is not None else []), *([f"XS:A:{x}"] if x else [])]) for n, f, c, s, q, g, x, h in rows]
    (tmp_path / "a.sam").write_text("\n".join(lines) + "\n")
    assert plain(bam.bam(spark, f"{tmp_path}/a").collect()) == plain(readers.sam(spark, f"{tmp_path}/a.sam").collect())


def test_empty_and_damaged_files(spark, tmp_path):
    _, table = alignments(spark, 2000)
    bam.write_bam(table.limit(0).coalesce(1), REFS, f"{tmp_path}/none")
    assert bam.bam(spark, f"{tmp_path}/none").collect() == []
    bam.write_bam(table.coalesce(1), REFS, f"{tmp_path}/a")
    (path,) = (tmp_path / "a").glob("*.bam")
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 1
    (tmp_path / "flipped.bam").write_bytes(data)
    (tmp_path / "cut.bam").write_bytes(path.read_bytes()[:-300])
    for name in ("flipped", "cut"):
        for size in (1 << 14, 1 << 25):
            with pytest.raises(Exception, match="block|record"):
                bam.bam(spark, f"{tmp_path}/{name}.bam", range_bytes=size).collect()


def test_tags_of_all_kinds():
    data = b"ASC\x05" + b"XZZabc\0" + b"XBBs" + struct.pack("<I2h", 2, 1, 2) + b"XFf" + bytes(4) + b"XSA-" + b"NHS\x02\x01" + b"HXH1F\0"
    assert bam._tags(data, 0) == {"XS": "-", "NH": 258}
