import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from genespark import runs
from genespark.operators import homology
from genespark.sources import readers

COMPLEMENT = str.maketrans("ACGT", "TGCA")
GENE = "gene_id string, line_no long, seqid string, start long, end long, strand string, attributes map<string,string>"
TX = "line_no long, transcript_id string, gene_id string, seqid string, start long, end long, strand string, exons array<struct<start:long,end:long>>, cds array<struct<start:long,end:long,phase:int>>"


def reverse(s):
    return s[::-1].translate(COMPLEMENT)


def kozak(context):
    weights = {0: {"A": 0.5, "G": 0.3, "C": 0.1, "T": 0.1}, 2: {"C": 0.4, "A": 0.3, "G": 0.2, "T": 0.1}, 6: {"G": 0.5, "A": 0.3, "C": 0.1, "T": 0.1}}
    got = [weights[k][context[k]] for k in weights] + [0.5] * (context[3:6] == "ATG")
    return sum(got) / len(got)


@pytest.fixture(scope="module")
def world():
    """A random scaffold with 30 genes of two to four exons on both strands."""
    rng = random.Random(5)
    seq = "".join(rng.choices("ACGT", k=12000))
    genes, transcripts = [], []
    for k in range(30):
        at, exons = 20 + 390 * k, []
        for _ in range(rng.randint(2, 4)):
            exons.append((at, at + rng.randint(30, 60)))
            at = exons[-1][1] + rng.randint(25, 45)
        strand, cds = "+-"[k % 2], [(s + 6 * (i == 0), e - 9 * (i == len(exons) - 1), rng.randint(0, 2)) for i, (s, e) in enumerate(exons)]
        genes.append((f"g{k:02}", 10 * k, "c", exons[0][0], exons[-1][1], strand, {"ID": f"g{k:02}"}))
        transcripts.append((10 * k + 1, f"t{k:02}", f"g{k:02}", "c", exons[0][0], exons[-1][1], strand, exons, cds if k != 4 else []))
    return seq, genes, transcripts


def tables(spark, world):
    seq, genes, transcripts = world
    return readers.genome_blocks(spark.createDataFrame([("c", seq)], "seqid string, seq string"), 1000), spark.createDataFrame(genes, GENE), spark.createDataFrame(transcripts, TX)


def moved_by_hand(seq, tx, w=30):
    *_, strand, exons, cds = tx
    if not cds:
        return exons, cds, False
    exons, cds, adjusted = list(exons), list(cds), False
    minus = strand == "-"
    first = cds[-1][1] if minus else cds[0][0]
    low, high = max(0, (first if minus else first - w) - 3), first + w
    best = None
    if high <= len(seq):
        piece = reverse(seq[low:high]) if minus else seq[low:high]
        for i in range(3, len(piece) - 4):
            if piece[i : i + 3] in ("ATG", "CTG", "GTG", "TTG"):
                place = high - i - 3 if minus else low + i
                best = max(best or (-9,), (0.6 * kozak(piece[i - 3 : i + 4]) + 0.4 * (1 - abs(place - first) / (2 * w)), place))
    if best and best[1] != first:
        adjusted, shift = True, best[1] - first
        if minus and cds[-1][0] < cds[-1][1] - shift:
            cds[-1] = (cds[-1][0], cds[-1][1] - shift, 0)
            exons[-1] = (exons[-1][0], max(exons[-1][1], cds[-1][1]))
        elif not minus and cds[0][0] + shift < cds[0][1]:
            cds[0] = (cds[0][0] + shift, cds[0][1], 0)
            exons[0] = (min(exons[0][0], cds[0][0]), exons[0][1])
    last = cds[0][0] if minus else cds[-1][1]
    piece = reverse(seq[max(0, last - w) : last]) if minus else seq[last : last + w]
    offset = (3 - cds[-1 if minus else 0][2]) % 3
    stops = [i for i in range(offset, len(piece) - 2, 3) if piece[i : i + 3] in ("TAA", "TAG", "TGA")]
    if piece[:3] not in ("TAA", "TAG", "TGA") and stops:
        shift = -stops[0] if minus else stops[0] + 3
        adjusted = adjusted or shift != 0
        if minus and cds[0][0] - shift < cds[0][1]:
            cds[0] = (cds[0][0] - shift, *cds[0][1:])
            exons[0] = (min(exons[0][0], cds[0][0]), exons[0][1])
        elif not minus and cds[-1][0] < cds[-1][1] + shift:
            cds[-1] = (cds[-1][0], cds[-1][1] + shift, cds[-1][2])
            exons[-1] = (exons[-1][0], max(exons[-1][1], cds[-1][1]))
    return exons, cds, adjusted


def test_boundaries_against_brute_force(spark, world):
    genome, _, transcripts = tables(spark, world)
    got = {r.transcript_id: ([tuple(e) for e in r.exons], [tuple(c) for c in r.cds], r.adjusted) for r in runs.adjust_boundaries(transcripts, genome, size=1000).collect()}
    assert got == {tx[1]: moved_by_hand(world[0], tx) for tx in world[2]}
    assert 5 < sum(adjusted for _, _, adjusted in got.values())


def test_evidence_against_brute_force(spark, world):
    _, genes, transcripts = tables(spark, world)
    rng = random.Random(8)
    introns = [(tx, a[1], b[0]) for tx in world[2] for a, b in zip(tx[7], tx[7][1:])]
    found = [("c", s + rng.choice((0, 0, 3, -4)), e + rng.choice((0, 0, 5)), "+", rng.choice((1, 3, 9))) for _, s, e in introns if rng.random() < 0.8]
    blocks = [("c", s + rng.randint(-5, 30), e, tx[6]) for tx in world[2] for s, e in tx[7] for _ in range(rng.randint(0, 9))]
    blocks = [b for b in blocks if b[1] < b[2]]
    junctions = spark.createDataFrame(found, "seqid string, start long, end long, strand string, reads int")
    rows = runs.score_evidence(genes, transcripts, junctions, spark.createDataFrame(blocks, "seqid string, start long, end long, strand string"))
    got = {r.gene_id: r for r in rows.collect()}
    index = {(j[1], j[2]): j[4] for j in found}
    assert len(got) == 30
    for tx in world[2]:
        r, exons = got[tx[2]], tx[7]
        supported = exact = 0
        for a, b in zip(exons, exons[1:]):
            near = [(abs(s - a[1]) + abs(e - b[0]), s, e, n) for (s, e), n in index.items() if abs(s - a[1]) <= 10 and abs(e - b[0]) <= 10]
            supported += bool(near) and min(near)[3] >= 3
            exact += (a[1], b[0]) in index
        depth = [[sum(s <= p < e and strand == tx[6] for _, s, e, strand in blocks) for p in range(*x)] for x in exons]
        assert (r.n_introns, r.n_introns_supported, r.n_introns_exact) == (len(exons) - 1, supported, exact)
        assert (r.n_exons, r.n_exons_expressed) == (len(exons), sum(median(d) >= 5 for d in depth))
        assert r.mean_exon_coverage == pytest.approx(sum(sum(d) / len(d) for d in depth) / len(depth))
        ends = (min(depth[0]) >= 5, min(depth[-1]) >= 5)
        assert (r.start_supported, r.stop_supported) == (ends if tx[6] == "+" else ends[::-1])
        assert r.aed == pytest.approx(0.5 * (1 - supported / r.n_introns) + 0.3 * (1 - r.n_exons_expressed / r.n_exons) + 0.2 * (1 - sum(ends) / 2))
    alone = {r.gene_id: r for r in runs.score_evidence(genes, transcripts, junctions).collect()}
    assert all(r.flags[-2:] == ["START_UNSUPPORTED", "STOP_UNSUPPORTED"] and "NO_EXON_EXPRESSION" not in r.flags and "LOW_EXON_COVERAGE" not in r.flags for r in alone.values())
    bare = runs.score_evidence(genes, transcripts.limit(0), junctions).first()
    assert (bare.aed, bare.evidence_level, bare.flags) == (1.0, "none", ["NO_TRANSCRIPTS"])


def test_refine_run(spark, world):
    genome, genes, transcripts = tables(spark, world)
    tx = world[2][2]
    (a, b) = tx[7][:2]
    junctions = spark.createDataFrame([("c", a[1] + 4, b[0] - 2, tx[6], 20)], "seqid string, start long, end long, strand string, reads int")
    probs = [[0.05, 0.05, 0.85, 0.05]] * 6000
    chunks = spark.createDataFrame([(0, "c", 0, 6000), (1, "c", 6000, 0)], "chunk_id int, seqid string, start long, end long")
    data = spark.createDataFrame([(0, probs), (1, probs)], "chunk_id int, probs array<array<double>>")
    changed, report, decisions = runs.refine_splices(transcripts, genome, junctions, size=1000)
    decided = decisions.collect()
    mine = [r for r in decided if r.transcript_id == tx[1] and r.intron_start == a[1]]
    assert [(r.decision, r.new_start, r.new_end, r.support) for r in mine] == [("nearby", a[1] + 4, b[0] - 2, 20)]
    sites = runs.corrections(decisions).filter(F.col("reason") == "rnaseq_junction").collect()
    assert sorted((r.site, r.shift, r.rnaseq_reads) for r in sites) == [("acceptor", -2, 20), ("donor", 4, 20)]
    for r in decided:  # the sites after the decision, read off the scaffold
        pair = world[0][r.new_start : r.new_start + 2], world[0][r.new_end - 2 : r.new_end]
        pair = tuple(map(reverse, pair)) if r.strand == "-" else pair
        assert r.is_canonical == (pair in (("GT", "AG"), ("GC", "AG")))
        assert r.decision != "rescue" or r.is_canonical
    assert any(r.decision == "rescue" for r in decided)
    refined, after = runs.refine_genes(genes, transcripts, genome, junctions, chunks, data)
    rows = {r.gene_id: r for r in refined.collect()}
    assert len(rows) == 30 and after.count() == 30 and report.count() == 30
    one = rows[tx[2]]
    assert "SPLICE_CORRECTED" in one.flags and one.splice_corrections >= 1 and one.attributes["ID"] == tx[2]
    assert one.attributes["junction_support"] == f"1/{len(tx[7]) - 1}" and one.attributes["flags"] == ",".join(one.flags)
    far = rows["g29"]  # no chunk there: no confidence, yet a row
    assert far.overall_score is None and "confidence_score" not in far.attributes and far.aed is not None


def test_homology_run(spark):
    row = lambda q, s, qs, qe, ss, se, ident=80.0, ev=1e-20: (q, s, ident, qs, qe, ss, se, ev, 100, 100)
    rows = [
        row("a", "p", 1, 95, 1, 90),
        row("b", "p2", 1, 40, 1, 40),
        row("c", "q1", 1, 45, 1, 90), row("c", "q2", 50, 98, 1, 90),
        row("d", "r", 1, 90, 1, 50), row("e", "r", 1, 90, 45, 95),
        row("f", "z", 1, 90, 1, 90, ev=0.5),
        row("t", "y", 1, 90, 1, 90),
    ]
    hits = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "query_id string, subject_id string, identity double, query_start int, query_end int, subject_start int, subject_end int, evalue double, query_length int, subject_length int, ord long")
    genes = spark.createDataFrame([(g, "s", 1000 * k, 1000 * k + 100) for k, g in enumerate("abcdeftn")], "gene_id string, seqid string, start long, end long")
    te = spark.createDataFrame([("s", 6000, 6040), ("s", 6030, 6050), ("s", 7000, 7100)], "seqid string, start long, end long")
    got = {r.gene_id: r for r in runs.validate(genes, hits, te).collect()}
    assert {g: r.status for g, r in got.items()} == {"a": "complete", "b": "partial", "c": "chimeric", "d": "fragmented", "e": "fragmented", "f": "no_hit", "t": "te_overlap", "n": "no_hit"}
    assert got["t"].te_overlap == pytest.approx(0.6) and got["d"].fragment_group == "r" and got["c"].chimera_subjects == "q1,q2"
    assert got["b"].flags == ["low_query_coverage", "low_subject_coverage"] and got["f"].flags == ["no_homology"]
    assert runs.validate(genes, hits.limit(0), None, homology.STRICT).filter("status = 'no_hit'").count() == 8
    scores = spark.createDataFrame([("a", 0.9, "WEAK_EXON, other"), ("x", None, None)], "gene_id string, overall_score double, flags string")
    splices = spark.createDataFrame([("a", "1/2", 0.25)], "gene_id string, junction_support string, aed double")
    table = {r.gene_id: r for r in runs.quality(scores, splices, runs.validate(genes, hits, te)).collect()}
    assert len(table) == 9 and table["a"].flags == ["WEAK_EXON"] and table["a"].tier == "medium" and table["a"].splice_score == 0.5
    assert table["a"].combined_aed == pytest.approx(0.4 * 0.25 + 0.4 * (1 - 0.95 * 0.8) + 0.2 * 0.1)
    assert table["f"].flags == ["NO_HOMOLOGY"] and table["f"].homology_score == 0.0 and table["x"].tier == "high"
    assert {k: v.count() for k, v in runs.tiers(runs.quality(scores, genes=genes)).items()} == {"high": 7, "medium": 1, "low": 0, "reject": 0}
