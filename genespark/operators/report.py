"""Summaries and reports from small aggregates."""

from __future__ import annotations

import html
import json
from string import Template

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import qc

PAGE = Template("<!DOCTYPE html><html><head><meta charset='utf-8'><title>$title</title></head><body><h1>$title</h1>$body</body></html>")


def rate(n, total):
    """A share that is 0 where there is nothing."""
    return F.when(total > 0, n / total).otherwise(F.lit(0.0))


def evidence_summary(scores: DataFrame) -> DataFrame:
    """One row: genes, mean and median distance, genes of each level."""
    levels = [F.count_if(F.col("evidence_level") == k).alias(f"n_{k}") for k in ("full", "partial", "minimal", "none")]
    return scores.agg(F.count("*").alias("n_genes"), F.avg("aed").alias("mean_aed"), F.median("aed").alias("median_aed"), *levels)


def splice_summary(reports: DataFrame) -> DataFrame:
    """One row over gene reports: introns, rates of support, canonical sites and corrections."""
    total = reports.agg(F.count("*").alias("n_genes"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_introns", "n_supported", "n_corrected", "n_canonical")))
    return total.select("*", *(rate(F.col(f"n_{k}"), F.col("n_introns")).alias(f"{k}_rate") for k in ("supported", "corrected", "canonical")))


def validation_summary(results: DataFrame) -> DataFrame:
    """status, n, percent."""
    counts = results.groupBy("status").agg(F.count("*").alias("n"))
    total = F.broadcast(counts.agg(F.sum("n").alias("total")))  # one row
    return counts.join(total, F.lit(True)).select("status", "n", (100.0 * F.col("n") / F.col("total")).alias("percent"))


def tables(genes: DataFrame) -> dict[str, list[dict]]:
    """Tiers, severities, top flags, histograms and the first 1000 genes: all of bounded size."""
    flags = qc.flag_counts(genes).cache()
    rows = lambda df: [r.asDict() for r in df.collect()]
    out = {
        "tiers": rows(genes.groupBy("tier").agg(F.count("*").alias("n")).orderBy("tier")),
        "severities": rows(flags.groupBy("severity").agg(F.sum("n_genes").alias("n")).orderBy("severity")),
        "categories": rows(flags.groupBy("category").agg(F.sum("n_genes").alias("n")).orderBy("category")),
        "top_flags": rows(flags.orderBy(F.desc("n_genes"), "code").limit(15)),
        "confidence": rows(qc.histogram(genes, "confidence_score").orderBy("bin")),
        "genes": rows(genes.select("gene_id", "tier", "confidence_score", F.array_join("flags", ",").alias("flags")).orderBy("gene_id").limit(1000)),
    }
    flags.unpersist()
    return out


def as_json(genes: DataFrame) -> str:
    return json.dumps(tables(genes), default=str)


def as_html(genes: DataFrame, title: str = "Gene quality") -> str:
    body = ""
    for name, rows in tables(genes).items():
        head = "".join(f"<th>{html.escape(k)}</th>" for k in (rows[0] if rows else ()))
        cells = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r.values()) + "</tr>" for r in rows)
        body += f"<h2>{name}</h2><table><tr>{head}</tr>{cells}</table>"
    return PAGE.substitute(title=html.escape(title), body=body)


def as_text(genes: DataFrame) -> str:
    found = tables(genes)
    total = sum(r["n"] for r in found["tiers"])
    lines = [f"genes: {total}", *(f"{r['tier']}: {r['n']} ({100 * r['n'] / total:.1f} %)" for r in found["tiers"]), *(f"{r['code']}: {r['n_genes']}" for r in found["top_flags"])]
    return "\n".join(lines)
