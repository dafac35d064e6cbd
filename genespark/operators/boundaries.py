"""Start and stop codons: choice of a new position and its application.

Positions on the minus strand follow the established behaviour: the shift is
genomic, yet applied with the opposite sign.  ``corrected`` applies it as it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import dna


def start_score(context: Column, position: Column, current: Column, window: int) -> Column:
    """0.6 of the context score and 0.4 of the closeness."""
    return 0.6 * dna.kozak_score(context) + 0.4 * (1 - F.abs(position - current) / (F.lit(2.0) * window))


def start_in(piece: Column, low: Column, high: Column, strand: Column, current: Column, window: int = 30) -> Column:
    """Best start codon of a piece [low, high) of a scaffold, read on its strand: struct<score, position, context>.

    A candidate has three bases before it and two after it in the piece.  Its
    position is the low coordinate of the codon on either strand.  Ties go to the
    larger position.  Null without a candidate.
    """
    places = dna.find_codons(piece, dna.STARTS, F.lit(3), F.length(piece) - 5)
    context = lambda i: F.substr(piece, (i - 2).cast("int"), F.lit(7))
    position = lambda i: F.when(strand == "-", high - i - 3).otherwise(low + i)
    return F.array_max(F.transform(places, lambda i: F.struct(start_score(context(i), position(i), current, window).alias("score"), position(i).cast("long").alias("position"), context(i).alias("context"))))


def start_span(strand: Column, current: Column, window: int = 30) -> tuple[Column, Column]:
    """The piece in which a start is looked for: on both sides on plus, above the current end on minus."""
    first = F.when(strand == "-", current).otherwise(current - window)
    return F.greatest(F.lit(0), first - 3), current + window


def best_start(seq: Column, current: Column, window: int = 30) -> Column:
    """Best start codon of a plus-strand scaffold around ``current`` (0-based); null if the window passes its end."""
    plus = F.lit("+")
    low, high = start_span(plus, current, window)
    piece = F.substr(seq, (low + 1).cast("int"), (high - low).cast("int"))
    return F.when(high <= F.length(seq), start_in(piece, low, high, plus, current, window))


def frame_of(phase: Column) -> Column:
    return (3 - phase) % 3


def stop_in(piece: Column, frame: Column) -> Column:
    """Bases from the start of a piece, read on its strand, to its first in-frame stop, or null."""
    return F.when(F.length(piece) > 3, F.array_min(dna.find_codons(piece, dna.STOPS, frame, F.length(piece) - 3, 3)))


def stop_place(piece: Column, strand: Column, current: Column, frame: Column) -> Column:
    """New coding end for the piece that follows the current one in reading direction.

    ``current`` itself if a stop follows at once.  Else the end after the first
    in-frame stop on plus, the end before it on minus; null without one.
    """
    found = stop_in(piece, frame)
    return F.when(F.substr(piece, F.lit(1), F.lit(3)).isin(*dna.STOPS), current).otherwise(F.when(strand == "-", current - found).otherwise(current + found + 3))


def closest_stop(seq: Column, current: Column, window: int = 30, frame: Column | None = None) -> Column:
    """New coding end on a plus-strand scaffold: after the first in-frame stop that follows, or null; ``current`` if a stop follows at once."""
    piece = F.substr(seq, (current + 1).cast("int"), F.lit(window))
    return stop_place(piece, F.lit("+"), current, F.lit(0) if frame is None else frame)


def _put(parts: Column, at_first: Column, changed: Column) -> Column:
    """Replace the first or the last of sorted parts."""
    n = F.size(parts)
    return F.transform(parts, lambda p, k: F.when(F.when(at_first, k == 0).otherwise(k == n - 1), changed).otherwise(p))


def _shift(cds: Column, exons: Column, at_low: Column, delta: Column, reset_phase: bool) -> Column:
    """Move the low or the high end of the coding region, and the exon there if it is passed."""
    ordered, outer = F.array_sort(cds), F.array_sort(exons)
    part = F.when(at_low, F.try_element_at(ordered, F.lit(1))).otherwise(F.try_element_at(ordered, F.lit(-1)))
    start = F.when(at_low, part["start"] + delta).otherwise(part["start"])
    end = F.when(at_low, part["end"]).otherwise(part["end"] + delta)
    phase = F.lit(0) if reset_phase else part["phase"]
    new = F.struct(start.alias("start"), end.alias("end"), phase.cast("int").alias("phase"))
    exon = F.when(at_low, F.try_element_at(outer, F.lit(1))).otherwise(F.try_element_at(outer, F.lit(-1)))
    wide = F.struct(F.when(at_low, F.least(exon["start"], start)).otherwise(exon["start"]).alias("start"), F.when(at_low, exon["end"]).otherwise(F.greatest(exon["end"], end)).alias("end"))
    able = (F.size(cds) > 0) & (start < end)
    return F.struct(F.when(able, _put(ordered, at_low, new)).otherwise(cds).alias("cds"), F.when(able, _put(outer, at_low, wide)).otherwise(exons).alias("exons"))


def shift_start(cds: Column, exons: Column, strand: Column, shift: Column, corrected: bool = False) -> Column:
    """struct<cds, exons> with the coding start moved; the segment's phase becomes 0."""
    sign = F.when(strand == "+", 1).otherwise(1 if corrected else -1)
    return _shift(cds, exons, strand == "+", shift * sign, True)


def shift_stop(cds: Column, exons: Column, strand: Column, shift: Column, corrected: bool = False) -> Column:
    """struct<cds, exons> with the coding end moved."""
    sign = F.when(strand == "+", 1).otherwise(1 if corrected else -1)
    return _shift(cds, exons, strand != "+", shift * sign, False)


def start_list(piece: Column, low: Column, high: Column, strand: Column, current: Column) -> Column:
    """Start codons of a piece, best context first: array of struct<position, codon, score, in_frame>.

    Of equal scores those first in reading direction come first.
    """
    places = dna.find_codons(piece, dna.STARTS, F.lit(3), F.length(piece) - 5)
    context = lambda i: F.substr(piece, (i - 2).cast("int"), F.lit(7))
    position = lambda i: F.when(strand == "-", high - i - 3).otherwise(low + i).cast("long")
    rows = F.transform(places, lambda i: F.struct((-dna.kozak_score(context(i))).alias("minus"), i.alias("at")))
    return F.transform(F.array_sort(rows), lambda r: F.struct(position(r["at"]).alias("position"), F.substr(piece, (r["at"] + 1).cast("int"), F.lit(3)).alias("codon"), (-r["minus"]).alias("score"), (F.pmod(position(r["at"]) - current, F.lit(3)) == 0).alias("in_frame")))


def changes(old: Column, new: Column) -> Column:
    """What a boundary run changed: ``start_shifted:n`` and ``end_shifted:n`` by the outer ends of sorted segments."""
    low = lambda parts: F.array_min(F.transform(parts, lambda p: p["start"]))
    high = lambda parts: F.array_max(F.transform(parts, lambda p: p["end"]))
    note = lambda name, n: F.when(n != 0, F.concat(F.lit(f"{name}:"), n.cast("string")))
    marks = F.array(note("start_shifted", low(new) - low(old)), note("end_shifted", high(new) - high(old)))
    return F.filter(marks, lambda x: x.isNotNull())


def is_stop(codon: Column) -> Column:
    """Whether three bases, read on the strand, are a stop codon."""
    return F.upper(codon).isin(*dna.STOPS)


def phase_errors(cds: Column, strand: Column, start_codon: Column, stop_codon: Column) -> Column:
    """Errors of a coding region: struct<phases, whole, has_start, has_stop>.

    ``phases`` are the numbers (in reading direction) of segments whose phase isn't the
    coding length before them modulo 3; ``whole`` tells whether the length is a multiple of 3.
    """
    ordered = F.when(strand == "-", F.reverse(F.array_sort(cds))).otherwise(F.array_sort(cds))
    step = lambda s, p: F.struct((s["n"] + p["end"] - p["start"]).alias("n"), (s["k"] + 1).alias("k"), F.when(p["phase"] != s["n"] % 3, F.concat(s["bad"], F.array(s["k"]))).otherwise(s["bad"]).alias("bad"))
    empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("k"), F.array().cast("array<int>").alias("bad"))
    return F.aggregate(ordered, empty, step, lambda s: F.struct(s["bad"].alias("phases"), (s["n"] % 3 == 0).alias("whole"), F.upper(start_codon).isin(*dna.STARTS).alias("has_start"), is_stop(stop_codon).alias("has_stop")))
