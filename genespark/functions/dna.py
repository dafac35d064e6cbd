"""Column functions on nucleotide and protein sequences."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The standard genetic code for bases in the order T, C, A, G.
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
BASES = "TCAG"
# Complements of the IUPAC codes, both cases.
IUPAC = "ACGTURYSWKMBDHVNacgturyswkmbdhvn"
COMPLEMENT = "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"
STOPS = ("TAA", "TAG", "TGA")
STARTS = ("ATG", "CTG", "GTG", "TTG")
# Position weights of the start-codon context.
KOZAK = {0: {"A": 0.5, "G": 0.3, "C": 0.1, "T": 0.1}, 2: {"C": 0.4, "A": 0.3, "G": 0.2, "T": 0.1}, 6: {"G": 0.5, "A": 0.3, "C": 0.1, "T": 0.1}}
# Base frequencies (A, C, G, T) around donor and acceptor sites, and the background.
DONOR = [
    [0.35, 0.35, 0.15, 0.15],
    [0.60, 0.10, 0.20, 0.10],
    [0.10, 0.05, 0.80, 0.05],
    [0.00, 0.00, 1.00, 0.00],
    [0.00, 0.00, 0.00, 1.00],
    [0.55, 0.05, 0.25, 0.15],
    [0.65, 0.05, 0.15, 0.15],
    [0.15, 0.05, 0.60, 0.20],
    [0.20, 0.10, 0.20, 0.50],
]
ACCEPTOR = [
    [0.15, 0.35, 0.15, 0.35],
    [0.15, 0.35, 0.15, 0.35],
    [0.15, 0.35, 0.15, 0.35],
    [0.15, 0.35, 0.15, 0.35],
    [0.15, 0.35, 0.15, 0.35],
    [0.15, 0.35, 0.15, 0.35],
    [0.15, 0.35, 0.15, 0.35],
    [0.12, 0.38, 0.12, 0.38],
    [0.12, 0.38, 0.12, 0.38],
    [0.12, 0.38, 0.12, 0.38],
    [0.15, 0.40, 0.10, 0.35],
    [0.25, 0.25, 0.25, 0.25],
    [0.15, 0.60, 0.10, 0.15],
    [0.70, 0.10, 0.10, 0.10],
    [0.00, 0.00, 1.00, 0.00],
    [0.15, 0.15, 0.50, 0.20],
]
BACKGROUND = [0.27, 0.23, 0.23, 0.27]


def complement(seq: Column) -> Column:
    return F.translate(seq, IUPAC, COMPLEMENT)


def reverse_complement(seq: Column) -> Column:
    """IUPAC aware, keeps case (soft masking)."""
    return F.reverse(complement(seq))


def reverse_complement_strict(seq: Column) -> Column:
    """Anything but A, C, G, T and N becomes N."""
    return reverse_complement(F.regexp_replace(seq, "[^ACGTNacgtn]", "N"))


def stranded(seq: Column, strand: Column) -> Column:
    return F.when(strand == "-", reverse_complement(seq)).otherwise(seq)


def count_of(seq: Column, letters: str) -> Column:
    """How many characters of ``seq`` are among ``letters``."""
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def gc_content(seq: Column, skip_n: bool = True) -> Column:
    """Share of G and C; of all bases, or of A, C, G and T only. 0 if there is none."""
    total = count_of(seq, "ACGTacgt") if skip_n else F.length(seq)
    return F.when(total > 0, count_of(seq, "GCgc") / total).otherwise(F.lit(0.0))


def counts(seq: Column) -> dict[str, Column]:
    """Counts of A, C, G, T; everything else is N."""
    found = {b: count_of(seq, b + b.lower()) for b in "ACGT"}
    return found | {"N": F.length(seq) - count_of(seq, "ACGTacgt")}


def is_dna(seq: Column) -> Column:
    return seq.rlike("^[ATGCNatgcn]*$")


def is_protein(seq: Column) -> Column:
    return F.upper(seq).rlike(r"^[ACDEFGHIKLMNPQRSTVWXY*]*$")


def codon_at(seq: Column, at: Column) -> Column:
    return F.substr(seq, at.cast("int"), F.lit(3))


def codons(seq: Column, frame: Column | int = 0) -> Column:
    """All whole codons of a frame, in one pass (a substring at a place reads all characters before it)."""
    rest = seq if isinstance(frame, int) and frame == 0 else F.substr(seq, F.lit(1) + frame, F.length(seq))
    return F.regexp_extract_all(rest, F.lit("[\\s\\S]{3}"), 0)


def inframe(seq: Column, wanted: tuple[str, ...], frame: int = 0) -> Column:
    """0-based positions of the wanted codons in a frame of the whole sequence."""
    marked = F.transform(codons(seq, frame), lambda c, k: F.when(c.isin(*wanted), 3 * k + frame))
    return F.filter(marked, lambda p: p.isNotNull())


def amino_acid(codon: Column) -> Column:
    """One letter; X for a codon with any other base."""
    index = sum((F.instr(F.lit(BASES), F.substr(codon, F.lit(k + 1), F.lit(1))) - 1) * 4 ** (2 - k) for k in range(3))
    return F.when(codon.rlike("^[TCAG]{3}$"), F.substr(F.lit(CODE), (index + 1).cast("int"), F.lit(1))).otherwise("X")


def translate(seq: Column, to_stop: bool = False) -> Column:
    """Protein of all whole codons; U reads as T, a partial codon at the end is left out."""
    dna = F.translate(F.upper(seq), "U", "T")
    protein = F.array_join(F.transform(codons(dna), amino_acid), "")
    return F.substring_index(protein, "*", 1) if to_stop else protein


def translate_strict(seq: Column, to_stop: bool = False) -> Column:
    """As ``translate``, but a length that is no multiple of three is an error."""
    return F.when(F.length(seq) % 3 == 0, translate(seq, to_stop)).otherwise(F.raise_error(F.lit("sequence length is no multiple of 3")))


def splice_sites(seq: Column, start: Column, end: Column, strand: Column | None = None) -> tuple[Column, Column]:
    """First and last two bases of the intron [start, end) (0-based) of ``seq``.

    With ``strand`` the corrected reading: on the minus strand donor and acceptor
    change places.  Without it the low end is always the donor.
    """
    low, high = F.substr(seq, (start + 1).cast("int"), F.lit(2)), F.substr(seq, (end - 1).cast("int"), F.lit(2))
    if strand is None:
        return low, high
    minus = strand == "-"
    return F.when(minus, reverse_complement(high)).otherwise(low), F.when(minus, reverse_complement(low)).otherwise(high)


def splice_type(donor: Column, acceptor: Column) -> Column:
    pair = F.concat_ws("-", F.upper(donor), F.upper(acceptor))
    return F.when(pair.isin("GT-AG", "GC-AG", "AT-AC"), pair).otherwise("other")


def is_canonical(donor: Column, acceptor: Column, with_at_ac: bool = False) -> Column:
    kinds = ["GT-AG", "GC-AG"] + ["AT-AC"] * with_at_ac
    return splice_type(donor, acceptor).isin(kinds)


def log_ratios(matrix: list[list[float]], background: list[float] | None = None) -> list[list[float]]:
    """log2(p / background) by base; a probability of 0 adds nothing."""
    background = background or BACKGROUND
    return [[math.log2(p / b) if p > 0 and b > 0 else 0.0 for p, b in zip(row, background, strict=True)] for row in matrix]


def pwm_score(seq: Column, matrix: list[list[float]], background: list[float] | None = None) -> Column:
    """Sum of log ratios of a sequence as long as the matrix; null for another length."""
    total = F.lit(0.0)
    for k, row in enumerate(log_ratios(matrix, background)):
        base = F.upper(F.substr(seq, F.lit(k + 1), F.lit(1)))
        cell = F.lit(0.0)
        for letter, value in zip("ACGT", row, strict=True):
            cell = F.when(base == letter, value).otherwise(cell)
        total = total + cell
    return F.when(F.length(seq) == len(matrix), total)


def sliding(rows: DataFrame, keys: list[str], matrix: list[list[float]], column: str = "seq", step: int = 1) -> DataFrame:
    """Scores at all places of sequences, every ``step`` bases: keys, at, score.

    All windows of a sequence are cut in one pass, by a pattern that looks ahead.
    """
    windows = F.regexp_extract_all(column, F.lit(f"(?=(.{{{len(matrix)}}}))"), 1)
    places = rows.select(*keys, F.posexplode(windows).alias("at", "__window"))
    if step > 1:
        places = places.filter(F.col("at") % step == 0)
    return places.select(*keys, "at", pwm_score(F.col("__window"), matrix).alias("score"))


def build_pwm(sites: DataFrame, column: str = "site", pseudocount: float = 0.1) -> DataFrame:
    """Base probabilities by position (from 1) of aligned sites of one length: pos, base, p, a row a position and base.

    Other letters count for nothing; the counts are pre-aggregated where the sites are.
    """
    letters = sites.select(F.posexplode(F.split(F.upper(column), "")).alias("pos", "base")).filter(F.col("base") != "")
    found = letters.groupBy("pos").agg(*(F.count_if(F.col("base") == b).alias(b) for b in "ACGT"))
    total = sum((F.col(b) for b in "ACGT"), F.lit(0)) + 4 * pseudocount
    cells = F.explode(F.array(*(F.struct(F.lit(b).alias("base"), ((F.col(b) + pseudocount) / total).alias("p")) for b in "ACGT")))
    return found.select((F.col("pos") + 1).alias("pos"), cells.alias("c")).select("pos", "c.base", "c.p")


def pwm_to_json(pwm: DataFrame, site_type: str) -> str:
    """A built matrix (a few rows) as JSON: type, and a row of four probabilities for each position."""
    rows = pwm.groupBy("pos").pivot("base", list("ACGT")).agg(F.first("p")).orderBy("pos").collect()
    return json.dumps({"type": site_type, "bases": "ACGT", "matrix": [[r[b] for b in "ACGT"] for r in rows]})


def pwm_from_json(text: str | None, site_type: str) -> list[list[float]]:
    """The matrix of a JSON text, or the built-in one for ``donor`` or ``acceptor`` if there is none.

    Raises an error if a row lacks four numbers.
    """
    if not text:
        return {"donor": DONOR, "acceptor": ACCEPTOR}[site_type]
    matrix = json.loads(text)["matrix"]
    if any(len(row) != 4 for row in matrix):
        raise ValueError("a row of a matrix has four probabilities")
    return [[float(x) for x in row] for row in matrix]


def donor_window(seq: Column, at: Column) -> Column:
    """Three exon and six intron bases around a donor; null out of bounds."""
    return F.when((at >= 3) & (at + 6 <= F.length(seq)), F.substr(seq, (at - 2).cast("int"), F.lit(9)))


def acceptor_window(seq: Column, at: Column) -> Column:
    """The last 16 intron bases; null out of bounds."""
    return F.when((at >= 16) & (at <= F.length(seq)), F.substr(seq, (at - 15).cast("int"), F.lit(16)))


def kozak_score(context: Column) -> Column:
    """Mean weight of the bases at -3, -1 and +4 of a context of seven bases, with 0.5 for an ATG."""
    score, n = F.lit(0.0), F.lit(0)
    for at, weights in KOZAK.items():
        base = F.upper(F.substr(context, F.lit(at + 1), F.lit(1)))
        cell = F.lit(0.0)
        for letter, value in weights.items():
            cell = F.when(base == letter, value).otherwise(cell)
        score, n = score + cell, n + F.when(base.isin(*weights), 1).otherwise(0)
    atg = F.upper(F.substr(context, F.lit(4), F.lit(3))) == "ATG"
    score, n = score + F.when(atg, 0.5).otherwise(0.0), n + F.when(atg, 1).otherwise(0)
    return F.when((F.length(context) >= 7) & (n > 0), score / n).otherwise(F.lit(0.0))


def find_codons(seq: Column, wanted: tuple[str, ...], first: Column, last: Column, step: int = 1) -> Column:
    """0-based positions in [first, last] at which one of the codons begins; for windows of bounded size."""
    places = F.when(last >= first, F.sequence(first.cast("int"), last.cast("int"), F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda p: codon_at(seq, p + 1).isin(*wanted))


def wrapped(seq: Column, width: int = 60) -> Column:
    """A FASTA body with lines of ``width`` characters."""
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")
