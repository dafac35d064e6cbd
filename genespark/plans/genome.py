"""Queries on genes laid over whole sequences: documents read as scaffolds, a gene every 400 bases."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import runs
from ..functions import dna
from ..operators import boundaries, genes, refine, splice, visual
from ..sources import readers, reports
from .binding import Plans
from .sequences import BUILT, SEQ, donor_sites, kozak_sql, pwm_sql, sequences

PLANS = Plans()
BLOCK = 1 << 12


def blocks(spark, sf_dir):
    return readers.genome_blocks(sequences(spark, sf_dir).withColumnRenamed("doc_id", "seqid"), BLOCK)


def spans(spark, sf_dir):
    """seqid, gene_id, o (the gene's place) and strand of every gene."""
    rows = sequences(spark, sf_dir).select(F.col("doc_id").alias("seqid"), F.floor(F.length("seq") / 400).alias("n")).filter("n > 0")
    rows = rows.select("seqid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"))
    return rows.selectExpr("seqid", "seqid * 1000 + k AS gene_id", "400 * k AS o", "CASE WHEN (seqid + k) % 2 = 0 THEN '+' ELSE '-' END AS strand")


def transcripts(spark, sf_dir):
    """One transcript a gene: three exons, three coding segments."""
    part = lambda a, b, *more: F.struct((F.col("o") + a).alias("start"), (F.col("o") + b).alias("end"), *more)
    phase = lambda k: ((F.col("gene_id") + 2 * k) % 3).cast("int").alias("phase")
    return spans(spark, sf_dir).select(
        F.lit(0).cast("long").alias("line_no"),
        F.col("gene_id").cast("string").alias("transcript_id"),
        "gene_id",
        "seqid",
        (F.col("o") + 40).alias("start"),
        (F.col("o") + 360).alias("end"),
        "strand",
        F.array(part(40, 120), part(160, 240), part(280, 360)).alias("exons"),
        F.array(part(52, 120, phase(0)), part(160, 240, phase(1)), part(280, 340, phase(2))).alias("cds"),
    )


def rc(text: str) -> str:
    return f"reverse(translate({text}, 'ACGT', 'TGCA'))"


G = SEQ + ", g0 AS (SELECT doc_id AS seqid, seq, unnest(range(0, length(seq) // 400)) AS k FROM d), g AS (SELECT seqid, seq, seqid * 1000 + k AS gene, 400 * k AS o, CASE WHEN (seqid + k) % 2 = 0 THEN '+' ELSE '-' END AS strand FROM g0)"
CDS = G + f", cs AS (SELECT *, substr(seq, o + 53, 68) || substr(seq, o + 161, 80) || substr(seq, o + 281, 60) AS fwd FROM g), coding AS (SELECT gene, CASE WHEN strand = '-' THEN {rc('fwd')} ELSE fwd END AS seq FROM cs)"


@PLANS.add(f"WITH {CDS} SELECT gene AS gene_id, length(seq) AS n, md5(seq) AS digest FROM coding")
def cds_assembly(spark, sf_dir):
    found = genes.coding_sequences(transcripts(spark, sf_dir), blocks(spark, sf_dir), BLOCK)
    return found.select("gene_id", F.length("seq").cast("long").alias("n"), F.md5("seq").alias("digest"))


AMINO = f"CASE WHEN regexp_full_match(c, '[TCAG]{{3}}') THEN substr('{dna.CODE}', 16 * (instr('TCAG', c[1]) - 1) + 4 * (instr('TCAG', c[2]) - 1) + instr('TCAG', c[3]), 1) ELSE 'X' END"
PROTEIN = CDS + f", cd AS (SELECT gene, k, substr(seq, 3 * k + 1, 3) AS c FROM (SELECT gene, seq, unnest(range(0, length(seq) // 3)) AS k FROM coding)), pr AS (SELECT gene, rtrim(string_agg({AMINO}, '' ORDER BY k), '*') AS protein FROM cd GROUP BY gene)"


@PLANS.add(f"WITH {PROTEIN} SELECT gene AS gene_id, length(protein) AS n, md5(protein) AS digest FROM pr WHERE protein <> ''")
def protein_extraction(spark, sf_dir):
    found = genes.proteins(genes.coding_sequences(transcripts(spark, sf_dir), blocks(spark, sf_dir), BLOCK))
    return found.select("gene_id", F.length("protein").cast("long").alias("n"), F.md5("protein").alias("digest"))


@PLANS.add(f"WITH {CDS} SELECT gene AS gene_id, regexp_full_match(seq, '[ATGCNatgcn]*') AS is_dna, regexp_full_match(seq, '[ACDEFGHIKLMNPQRSTVWXY*]*') AS is_protein, md5({rc('seq')}) AS complement FROM coding")
def alphabet_checks(spark, sf_dir):
    found = genes.coding_sequences(transcripts(spark, sf_dir), blocks(spark, sf_dir), BLOCK)
    return found.select("gene_id", dna.is_dna(F.col("seq")).alias("is_dna"), dna.is_protein(F.col("seq")).alias("is_protein"), F.md5(dna.reverse_complement_strict(F.col("seq"))).alias("complement"))


STRICT = PROTEIN + f", w AS (SELECT gene, string_agg({AMINO}, '' ORDER BY k) AS p FROM cd WHERE k < 66 GROUP BY gene)"


@PLANS.add(f"WITH {STRICT} SELECT gene AS gene_id, md5(string_split(p, '*')[1]) AS digest, length(string_split(p, '*')[1]) AS n FROM w")
def strict_translation(spark, sf_dir):
    """The first 198 bases of each coding sequence, up to a stop."""
    found = genes.coding_sequences(transcripts(spark, sf_dir), blocks(spark, sf_dir), BLOCK)
    protein = dna.translate_strict(F.substr("seq", F.lit(1), F.lit(198)), to_stop=True)
    return found.select("gene_id", protein.alias("p")).select("gene_id", F.md5("p").alias("digest"), F.length("p").cast("long").alias("n"))


def introns_of(spark, sf_dir):
    rows = spans(spark, sf_dir).select("seqid", F.col("gene_id").alias("gene"), "strand", F.explode(F.array(*(F.struct((F.col("o") + a).alias("intron_start"), (F.col("o") + b).alias("intron_end")) for a, b in ((120, 160), (240, 280))))).alias("i"))
    return rows.select("seqid", "gene", "strand", "i.*")


def junctions_of(spark, sf_dir):
    """Two genes of five have junctions at their introns: exact, or shifted, two of equal reads and distance."""
    rows = introns_of(spark, sf_dir).filter("gene % 5 < 2")
    copies = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    shift = "CASE WHEN gene % 5 = 0 THEN 0 ELSE (CASE WHEN side = 0 THEN 1 ELSE -1 END) * (1 + gene % 9) END"
    rows = rows.select("*", copies).filter("side = 0 OR gene % 5 = 1")
    return rows.selectExpr("seqid", f"intron_start + {shift} AS start", "intron_end AS end", "strand", "gene % 7 AS reads", "gene * 4 + side AS ord")


INT = G + """, i0 AS (SELECT seqid, seq, gene, strand, o, unnest([120, 240]) AS a FROM g), introns AS (SELECT seqid, seq, gene, strand, o, a, o + a AS s, o + a + 40 AS e FROM i0),
j0 AS (SELECT *, unnest([0, 1]) AS side FROM introns WHERE gene % 5 < 2), junctions AS (SELECT seqid, s + CASE WHEN gene % 5 = 0 THEN 0 ELSE (CASE WHEN side = 0 THEN 1 ELSE -1 END) * (1 + gene % 9) END AS js, e AS je, strand, gene % 7 AS reads FROM j0 WHERE side = 0 OR gene % 5 = 1)"""


def site(kind: str, at: str) -> str:
    """The bases of a site's matrix at a place of a scaffold, read on the strand."""
    before, n = {"donor": (3, 9), "acceptor": (16, 16)}[kind]
    piece = f"substr(seq, CAST({at} - {before} + 1 AS BIGINT), {n})"
    return f"CASE WHEN strand = '-' THEN {rc(piece)} ELSE {piece} END"


def pair(kind: str, at: str) -> str:
    piece = f"substr(seq, CAST({at} + {1 if kind == 'donor' else -1} AS BIGINT), 2)"
    return f"CASE WHEN strand = '-' THEN {rc(piece)} ELSE {piece} END"


def scored(kind: str, at: str) -> str:
    return f"(SELECT {pwm_sql('w', {'donor': dna.DONOR, 'acceptor': dna.ACCEPTOR}[kind])} FROM (SELECT {site(kind, at)} AS w))"


DECIDED = INT + f""", n0 AS (SELECT i.gene, i.a, i.seq, i.strand, js, je, reads, abs(s - js) + abs(e - je) AS shift FROM introns i JOIN junctions j ON i.seqid = j.seqid AND abs(s - js) <= 15 AND abs(e - je) <= 15 AND j.strand = i.strand AND reads >= 3),
n1 AS (SELECT *, {site('donor', 'js')} AS dw, {site('acceptor', 'je')} AS aw FROM n0), n2 AS (SELECT *, round(({pwm_sql('dw', dna.DONOR)}) + ({pwm_sql('aw', dna.ACCEPTOR)}), 9) AS pwm FROM n1),
near AS (SELECT *, row_number() OVER (PARTITION BY gene, a ORDER BY reads DESC, shift, pwm DESC, js, je) AS r FROM n2),
o1 AS (SELECT gene, a, seq, strand, s, e, unnest(range(-5, 6)) AS k FROM introns),
o2 AS (SELECT gene, a, k, {pair('donor', 's + k')} AS dp, {site('donor', 's + k')} AS dw, {pair('acceptor', 'e + k')} AS ap, {site('acceptor', 'e + k')} AS aw FROM o1),
bd AS (SELECT gene, a, k AS dk, score AS ds, row_number() OVER (PARTITION BY gene, a ORDER BY score DESC, k) AS r FROM (SELECT *, {pwm_sql('dw', dna.DONOR)} AS score FROM o2 WHERE dp IN ('GT', 'GC'))),
ba AS (SELECT gene, a, k AS ak, score AS sc, row_number() OVER (PARTITION BY gene, a ORDER BY score DESC, k) AS r FROM (SELECT *, {pwm_sql('aw', dna.ACCEPTOR)} AS score FROM o2 WHERE ap = 'AG')),
dec0 AS (SELECT i.seqid, i.gene, i.strand, i.o, i.a, i.seq, i.s, i.e, x.reads AS xr, n.reads AS nr, n.js, n.je, n.shift, ds, dk, sc, ak, {pair('donor', 'i.s').replace('strand', 'i.strand').replace('seq,', 'i.seq,')} || '-' || {pair('acceptor', 'i.e').replace('strand', 'i.strand').replace('seq,', 'i.seq,')} AS sites
 FROM introns i LEFT JOIN junctions x ON x.seqid = i.seqid AND x.js = i.s AND x.je = i.e LEFT JOIN near n ON n.r = 1 AND n.gene = i.gene AND n.a = i.a LEFT JOIN bd ON bd.r = 1 AND bd.gene = i.gene AND bd.a = i.a LEFT JOIN ba ON ba.r = 1 AND ba.gene = i.gene AND ba.a = i.a),
dec1 AS (SELECT *, CASE WHEN xr IS NOT NULL THEN 'exact' WHEN nr IS NOT NULL THEN 'nearby' WHEN sites NOT IN ('GT-AG', 'GC-AG') AND ds > 0 AND sc > 0 AND (dk <> 0 OR ak <> 0) THEN 'rescue' ELSE 'keep' END AS decision FROM dec0),
dec AS (SELECT *, CASE decision WHEN 'nearby' THEN js WHEN 'rescue' THEN s + dk ELSE s END AS ns, CASE decision WHEN 'nearby' THEN je WHEN 'rescue' THEN e + ak ELSE e END AS ne, coalesce(xr, nr, 0) AS support,
 CASE decision WHEN 'nearby' THEN 0.7::DOUBLE * least(1.0, ln(1 + nr) / ln(101)) + 0.3::DOUBLE * greatest(0.0, 1 - shift / 15) WHEN 'rescue' THEN least(1.0, (ds + sc) / 20) END AS confidence FROM dec1)"""


@PLANS.add(f"WITH {DECIDED} SELECT gene, s AS intron_start, e AS intron_end, decision, ns AS new_start, ne AS new_end, support, round(confidence, 6) AS confidence, {pair('donor', 'ns')} || '-' || {pair('acceptor', 'ne')} IN ('GT-AG', 'GC-AG') AS is_canonical FROM dec")
def splice_rescue(spark, sf_dir):
    """The decision for each intron with its real windows: exact, nearby, rescued or kept."""
    sites = runs.intron_sites(introns_of(spark, sf_dir), blocks(spark, sf_dir), 15, BLOCK)
    found = splice.refine_introns(sites, junctions_of(spark, sf_dir), slack=15)
    return found.select("gene", "intron_start", "intron_end", "decision", "new_start", "new_end", "support", F.round("confidence", 6).alias("confidence"), "is_canonical")


REFINED = DECIDED + """, two AS (SELECT gene, max(seqid) AS seqid, max(strand) AS strand, max(o) AS o, max(ns) FILTER (a = 120) AS s1, max(ne) FILTER (a = 120) AS e1, max(ns) FILTER (a = 240) AS s2, max(ne) FILTER (a = 240) AS e2, count(*) FILTER (support >= 3) AS n_supported, count(*) FILTER (ns <> s OR ne <> e) AS n_corrected, count(*) FILTER (decision = 'rescue') AS n_rescued FROM dec GROUP BY gene)"""


@PLANS.add(f"""WITH {REFINED} SELECT gene AS gene_id, concat_ws(';', (o + 40) || '-' || s1, e1 || '-' || s2, e2 || '-' || (o + 360)) AS exons, concat_ws(';', (o + 52) || '-' || least(o + 120, s1), greatest(o + 160, e1) || '-' || least(o + 240, s2), greatest(o + 280, e2) || '-' || (o + 340)) AS cds, o + 40 AS start, o + 360 AS "end" FROM two""")
def splice_refinement(spark, sf_dir):
    """Transcripts after all corrections of their introns."""
    changed, _, _ = runs.refine_splices(transcripts(spark, sf_dir), blocks(spark, sf_dir), junctions_of(spark, sf_dir), size=BLOCK)
    text = lambda c: F.array_join(F.transform(c, lambda e: F.concat_ws("-", e["start"].cast("string"), e["end"].cast("string"))), ";").alias(c)
    return changed.select("gene_id", text("exons"), text("cds"), "start", "end")


@PLANS.add(f"WITH {REFINED} SELECT gene AS gene_id, 2 AS n_introns, n_supported, n_corrected, round(n_supported / 2, 4) AS support_ratio, n_supported = 2 AS fully_supported FROM two")
def splice_gene_report(spark, sf_dir):
    _, found, _ = runs.refine_splices(transcripts(spark, sf_dir), blocks(spark, sf_dir), junctions_of(spark, sf_dir), size=BLOCK)
    rows = reports.splice_report(found)
    return rows.select("gene_id", "n_introns", "n_supported", "n_corrected", F.col("support_ratio").cast("double").alias("support_ratio"), "fully_supported")


MOVES = f"""mv AS (SELECT gene, a // 120 - 1 AS intron_index, decision, support, ns - s AS l, ne - e AS r, s, e, ns, ne, confidence, unnest(['donor', 'acceptor']) AS site FROM dec WHERE decision IN ('nearby', 'rescue')),
corr AS (SELECT gene, intron_index, 'rnaseq_junction' AS reason, site, CASE site WHEN 'donor' THEN s ELSE e END AS p, CASE site WHEN 'donor' THEN ns ELSE ne END AS q, CASE site WHEN 'donor' THEN l ELSE r END AS shift,
 0.7::DOUBLE * least(1.0, ln(1 + support) / ln(101)) + 0.3::DOUBLE * greatest(0.0, 1 - abs(CASE site WHEN 'donor' THEN l ELSE r END) / 15) AS confidence, support FROM mv WHERE decision = 'nearby' AND CASE site WHEN 'donor' THEN l ELSE r END <> 0
 UNION ALL SELECT gene, intron_index, 'canonical_rescue', CASE WHEN abs(l) >= abs(r) THEN 'donor' ELSE 'acceptor' END, CASE WHEN l <> 0 THEN s ELSE e END, CASE WHEN l <> 0 THEN ns ELSE ne END, CASE WHEN l <> 0 THEN l ELSE r END, confidence, support FROM mv WHERE decision = 'rescue' AND site = 'donor')"""


@PLANS.add(f"WITH {DECIDED}, {MOVES} SELECT gene AS gene_id, intron_index, site, p AS original_position, q AS corrected_position, shift, reason, round(confidence, 4) AS confidence, support AS rnaseq_reads FROM corr")
def splice_corrections(spark, sf_dir):
    tx = transcripts(spark, sf_dir)
    _, _, each = runs.refine_splices(tx, blocks(spark, sf_dir), junctions_of(spark, sf_dir), size=BLOCK)
    rows = reports.corrections_report(reports.with_intron_index(runs.corrections(each), tx))
    return rows.select("gene_id", F.col("intron_index").cast("long").alias("intron_index"), "site", "original_position", "corrected_position", "shift", "reason", F.col("confidence").cast("double").alias("confidence"), "rnaseq_reads")


@PLANS.add(f"WITH {DECIDED} SELECT concat_ws(chr(9), seqid, s, e, gene || '_intron' || (a // 120 - 1), 0, strand) AS line FROM dec WHERE support < 3")
def unsupported_introns(spark, sf_dir):
    tx = transcripts(spark, sf_dir)
    _, _, each = runs.refine_splices(tx, blocks(spark, sf_dir), junctions_of(spark, sf_dir), size=BLOCK)
    return reports.unsupported_bed(each, tx)


@PLANS.add(f"WITH {DECIDED} SELECT shift, count(*) AS n FROM (SELECT unnest([ns - s, ne - e]) AS shift FROM dec) WHERE shift <> 0 GROUP BY shift")
def splice_shift_counts(spark, sf_dir):
    sites = runs.intron_sites(introns_of(spark, sf_dir), blocks(spark, sf_dir), 15, BLOCK)
    return visual.shift_counts(splice.refine_introns(sites, junctions_of(spark, sf_dir), slack=15))


@PLANS.add(f"WITH {REFINED}, p AS (SELECT 'support' AS panel, CAST(least(9, floor(n_supported / 2 * 10)) AS INTEGER) AS bin FROM two UNION ALL SELECT 'corrections', CAST(n_corrected AS INTEGER) FROM two) SELECT panel, bin, count(*) AS n_genes FROM p GROUP BY ALL")
def splice_panels(spark, sf_dir):
    _, found, _ = runs.refine_splices(transcripts(spark, sf_dir), blocks(spark, sf_dir), junctions_of(spark, sf_dir), size=BLOCK)
    return visual.splice_panels(found)


@PLANS.add(f"""WITH {REFINED} SELECT gene AS gene_id, k, old_start, old_end, CASE k WHEN 0 THEN o + 40 WHEN 1 THEN e1 ELSE e2 END AS new_start, CASE k WHEN 0 THEN s1 WHEN 1 THEN s2 ELSE o + 360 END AS new_end FROM (SELECT *, o + 40 + 120 * k AS old_start, o + 120 + 120 * k AS old_end FROM (SELECT *, unnest([0, 1, 2]) AS k FROM two))""")
def splice_before_after(spark, sf_dir):
    tx = transcripts(spark, sf_dir)
    changed, _, _ = runs.refine_splices(tx, blocks(spark, sf_dir), junctions_of(spark, sf_dir), size=BLOCK)
    return visual.before_after(tx, changed).select(F.col("transcript_id").cast("long").alias("gene_id"), "k", "old_start", "old_end", "new_start", "new_end")


START = G + f""", sp AS (SELECT *, CASE WHEN strand = '-' THEN o + 337 ELSE o + 19 END AS lo, CASE WHEN strand = '-' THEN o + 370 ELSE o + 82 END AS hi, CASE WHEN strand = '-' THEN o + 340 ELSE o + 52 END AS cur FROM g),
pc AS (SELECT *, CASE WHEN strand = '-' THEN {rc('substr(seq, lo + 1, hi - lo)')} ELSE substr(seq, lo + 1, hi - lo) END AS piece FROM sp),
cand AS (SELECT gene, strand, lo, hi, cur, piece, unnest(range(3, length(piece) - 4)) AS i FROM pc), sel AS (SELECT *, substr(piece, i - 2, 7) AS ctx, CASE WHEN strand = '-' THEN hi - i - 3 ELSE lo + i END AS pos FROM cand WHERE substr(piece, i + 1, 3) IN ('ATG', 'CTG', 'GTG', 'TTG')),
sc AS (SELECT *, {kozak_sql('ctx')} AS kz FROM sel), tot AS (SELECT *, 0.6::DOUBLE * kz + 0.4::DOUBLE * (1 - abs(pos - cur) / 60.0::DOUBLE) AS total FROM sc),
bs AS (SELECT gene, pos - cur AS move, row_number() OVER (PARTITION BY gene ORDER BY total DESC, pos DESC, ctx DESC) AS r FROM tot),
st AS (SELECT pc.*, coalesce(move, 0) AS move FROM pc LEFT JOIN bs ON bs.gene = pc.gene AND bs.r = 1),
sh AS (SELECT *, move <> 0 AND CASE WHEN strand = '+' THEN o + 52 + move < o + 120 ELSE o + 280 < o + 340 - move END AS done FROM st),
af AS (SELECT *, CASE WHEN strand = '-' THEN {rc('substr(seq, o + 23, 30)')} ELSE substr(seq, o + 341, 30) END AS tail, CASE WHEN done THEN 0 WHEN strand = '-' THEN (3 - (gene + 4) % 3) % 3 ELSE (3 - gene % 3) % 3 END AS frame FROM sh),
sto AS (SELECT gene, min(p) AS p FROM (SELECT gene, tail, unnest(range(frame, 28, 3)) AS p FROM af) WHERE substr(tail, p + 1, 3) IN ('TAA', 'TAG', 'TGA') GROUP BY gene),
fin AS (SELECT af.*, CASE WHEN substr(tail, 1, 3) IN ('TAA', 'TAG', 'TGA') THEN 0 WHEN p IS NULL THEN 0 WHEN strand = '-' THEN p ELSE p + 3 END AS ext FROM af LEFT JOIN sto USING (gene)),
res AS (SELECT *, CASE WHEN strand = '+' THEN CASE WHEN done THEN o + 52 + move ELSE o + 52 END ELSE CASE WHEN o + 52 + ext < o + 120 THEN o + 52 + ext ELSE o + 52 END END AS clow, CASE WHEN strand = '+' THEN o + 340 + ext ELSE CASE WHEN done THEN o + 340 - move ELSE o + 340 END END AS chigh FROM fin)"""


def adjusted(spark, sf_dir):
    return runs.adjust_boundaries(transcripts(spark, sf_dir), blocks(spark, sf_dir), 30, size=BLOCK)


@PLANS.add(f"WITH {START} SELECT gene AS gene_id, clow AS cds_low, chigh AS cds_high, least(o + 40, clow) AS exon_low, greatest(o + 360, chigh) AS exon_high, move <> 0 OR ext <> 0 AS adjusted FROM res")
def boundary_adjustment(spark, sf_dir):
    """Starts and stops moved: the ends of coding regions and exons."""
    c, e = F.col("cds"), F.col("exons")
    return adjusted(spark, sf_dir).select("gene_id", c[0]["start"].alias("cds_low"), F.element_at(c, -1)["end"].alias("cds_high"), e[0]["start"].alias("exon_low"), F.element_at(e, -1)["end"].alias("exon_high"), "adjusted")


@PLANS.add(f"WITH {START}, l AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY kz DESC, i) - 1 AS k FROM sc) SELECT gene AS gene_id, k, pos AS position, ctx[4:6] AS codon, round(kz, 6) AS score, ((pos - cur) % 3 + 3) % 3 = 0 AS in_frame FROM l")
def start_codon_list(spark, sf_dir):
    """All start codons around each gene's start, best context first."""
    minus = F.col("strand") == "-"
    rows = spans(spark, sf_dir).withColumn("cur", F.col("o") + F.when(minus, 340).otherwise(52))
    low, high = boundaries.start_span(F.col("strand"), F.col("cur"), 30)
    spanned = rows.select("gene_id", "seqid", "strand", "cur", low.alias("start"), high.alias("end"))
    found = runs.windows(spanned, blocks(spark, sf_dir), ["gene_id", "strand", "cur"], BLOCK).withColumn("seq", dna.stranded(F.col("seq"), F.col("strand")))
    low, high = boundaries.start_span(F.col("strand"), F.col("cur"), 30)
    listed = F.posexplode(boundaries.start_list(F.col("seq"), low, high, F.col("strand"), F.col("cur"))).alias("k", "s")
    return found.select("gene_id", listed).select("gene_id", F.col("k").cast("long").alias("k"), "s.position", "s.codon", F.round("s.score", 6).alias("score"), "s.in_frame")


PHASE = G + f""", ph AS (SELECT gene, strand, o, seq, gene % 3 AS p0, (gene + 2) % 3 AS p1, (gene + 4) % 3 AS p2 FROM g),
pe AS (SELECT gene, CASE WHEN strand = '-' THEN list_filter([CASE WHEN p2 <> 0 THEN 0 END, CASE WHEN p1 <> 0 THEN 1 END, CASE WHEN p0 <> 2 THEN 2 END], lambda x: x IS NOT NULL) ELSE list_filter([CASE WHEN p0 <> 0 THEN 0 END, CASE WHEN p1 <> 2 THEN 1 END, CASE WHEN p2 <> 1 THEN 2 END], lambda x: x IS NOT NULL) END AS bad,
 CASE WHEN strand = '-' THEN {rc('substr(seq, o + 338, 3)')} ELSE substr(seq, o + 53, 3) END AS a, CASE WHEN strand = '-' THEN {rc('substr(seq, o + 50, 3)')} ELSE substr(seq, o + 341, 3) END AS z FROM ph)"""


@PLANS.add(f"WITH {PHASE} SELECT gene AS gene_id, array_to_string(bad, ',') AS phases, false AS whole, a IN ('ATG', 'CTG', 'GTG', 'TTG') AS has_start, z IN ('TAA', 'TAG', 'TGA') AS has_stop FROM pe")
def phase_errors(spark, sf_dir):
    found = runs.phase_check(transcripts(spark, sf_dir), blocks(spark, sf_dir), BLOCK)
    return found.select(F.col("transcript_id").cast("long").alias("gene_id"), F.array_join(F.transform("phases", lambda k: k.cast("string")), ",").alias("phases"), "whole", "has_start", "has_stop")


@PLANS.add(f"WITH {G} SELECT gene AS gene_id, 3 AS n_exons, 3 AS n_cds, 240 AS transcript_length, 208 AS cds_length, 320 AS gene_length, 'INVALID' AS note FROM g")
def transcript_structure(spark, sf_dir):
    """Counts and lengths, after an empty exon and segment were added and dropped again."""
    rows = transcripts(spark, sf_dir)
    for name in ("exons", "cds"):
        rows = rows.withColumn(name, F.array_append(name, F.col(name)[0].withField("end", F.col(name)[0]["start"])))
    rows = refine.validated(rows)
    return rows.select("gene_id", *(c.cast("long").alias(n) for n, c in genes.structure(F.col("exons"), F.col("cds")).items()), (F.col("end") - F.col("start")).alias("gene_length"), F.lit("INVALID").alias("note"))


@PLANS.add(f"WITH {BUILT}, nn AS (SELECT count(*) AS total FROM sites), sh AS (SELECT pos, base, n / total AS share FROM full_n, nn) SELECT CAST(pos AS INTEGER) AS pos, base, round(share, 6) AS share, round(CASE WHEN share > 0 THEN share * log2(share / 0.25::DOUBLE) ELSE 0.0 END, 6) AS bits FROM sh")
def splice_logo(spark, sf_dir):
    return visual.logo(donor_sites(spark, sf_dir)).select("pos", "base", F.round("share", 6).alias("share"), F.round("bits", 6).alias("bits"))


@PLANS.add(f"WITH {BUILT}, m AS (SELECT pos, base, round((n + 0.1::DOUBLE) / (sum(n) OVER (PARTITION BY pos) + 0.4::DOUBLE), 6) AS p FROM full_n) SELECT CAST(pos AS BIGINT) AS pos, max(p) FILTER (base = 'A') AS a, max(p) FILTER (base = 'C') AS c, max(p) FILTER (base = 'G') AS g, max(p) FILTER (base = 'T') AS t FROM m GROUP BY pos")
def pwm_json_round_trip(spark, sf_dir):
    """A built matrix written as JSON and read again."""
    matrix = dna.pwm_from_json(dna.pwm_to_json(dna.build_pwm(donor_sites(spark, sf_dir)), "donor"), "donor")
    return spark.createDataFrame([(k + 1, *(round(x, 6) for x in row)) for k, row in enumerate(matrix)], "pos long, a double, c double, g double, t double")
