"""Tables and small files that steps hand to each other: metrics, reports, chunk plans, predictions, databases."""

from __future__ import annotations

import json
import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import qc
from . import readers

# Names under which predictions are stored, in the order they are tried.
PREDICTIONS = ("predictions", "y_pred", "data/predictions")


def table(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table with a header, all strings (blank as null), with file and line_no."""
    rows = spark.read.csv(path, sep="\t", header=True, nullValue="", quote="")
    return rows.select(*rows.columns, F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line_no"))


def cell(text: Column) -> Column:
    """A cell's typed value: struct<kind, number, text>.

    Blank is null; a number with a dot is ``float``, one without is ``int``, anything
    else a ``string`` (so 1e-05 stays a string and 2.00e-10 is a float).
    """
    dotted = text.contains(".")
    number = F.when(dotted, text.try_cast("double")).otherwise(F.trim(text).try_cast("long").cast("double"))
    kind = F.when(text.isNull(), None).when(number.isNull(), "string").when(dotted, "float").otherwise("int")
    return F.struct(kind.alias("kind"), number.alias("number"), F.when(number.isNull(), text).alias("text"))


def metrics(spark: SparkSession, path: str, numbers: list[str] | None = None) -> DataFrame:
    """Metrics by gene, the last row of a gene counts; the key is gene_id, Gene or gene.

    Columns named in ``numbers`` come as doubles (null where they aren't numbers); with
    None every column but the key is a typed cell.
    """
    rows = table(spark, path)
    key = next(k for k in ("gene_id", "Gene", "gene") if k in rows.columns)
    rest = [c for c in rows.columns if c not in (key, "file", "line_no")]
    typed = [(cell(F.col(c)) if numbers is None else cell(F.col(c))["number"] if c in numbers else F.col(c)).alias(c) for c in rest]
    named = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("gene_id"), *typed, "file", "line_no")
    return named.groupBy("gene_id").agg(F.max_by(F.struct(*rest), F.struct("file", "line_no")).alias("r")).select("gene_id", "r.*")


def qc_table(spark: SparkSession, path: str) -> DataFrame:
    """An aggregated quality table: gene_id, tier, flags (registered codes only), the three scores.

    Distances aren't read back: a report made from the file has none.
    """
    rows = table(spark, path)
    number = lambda c: (F.col(c).try_cast("double") if c in rows.columns else F.lit(None).cast("double")).alias(c)
    flags = qc.known(F.split(F.coalesce("flag_codes", F.lit("")), r"\s*,\s*"))
    found = rows.filter("gene_id IS NOT NULL").select("gene_id", F.coalesce("tier", F.lit("unclassified")).alias("tier"), flags.alias("flags"), *map(number, ("confidence_score", "splice_score", "homology_score")), "file", "line_no")
    rest = [c for c in found.columns if c not in ("gene_id", "file", "line_no")]
    return found.groupBy("gene_id").agg(F.max_by(F.struct(*rest), F.struct("file", "line_no")).alias("r")).select("gene_id", "r.*")


EVIDENCE = "gene_id string, transcript_id string, seqid string, strand string, n_introns int, n_introns_supported int, n_introns_exact int, junction_support_ratio double, n_exons int, n_exons_expressed int, mean_exon_coverage double, exon_coverage_ratio double, start_supported boolean, stop_supported boolean, strand_consistent boolean, evidence_level string, aed double, flags array<string>"


def evidence_table(spark: SparkSession, path: str) -> DataFrame:
    """An evidence report read back; yes and no become booleans, flags an array."""
    rows = table(spark, path)
    columns = []
    for name, kind in (x.strip().split(" ") for x in EVIDENCE.split(", ")):
        if kind == "boolean":
            value = F.lower(name) == "yes"
        elif kind.startswith("array"):
            value = F.when(F.col(name).isNull(), F.array().cast(kind)).otherwise(F.split(name, ","))
        else:
            value = F.col(name).cast(kind)
        columns.append(value.alias(name))
    return rows.select(*columns)


def write_plan(chunks: DataFrame, path: str, strategy: str, parameters: dict | None = None) -> None:
    """A chunk plan as one JSON record in a folder: strategy, totals, parameters, chunks in their order.

    A plan has a row a chunk, so one record holds it.
    """
    listed = F.array_sort(F.collect_list(F.struct("chunk_id", "seqid", "start", "end", *(["gene_ids"] if "gene_ids" in chunks.columns else []))))
    size = F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0))
    plan = chunks.agg(F.lit(strategy).alias("strategy"), size.alias("total_bases"), F.lit(json.dumps(parameters or {})).alias("parameters"), F.count("*").alias("n_chunks"), listed.alias("chunks"))
    plan.write.json(path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of a plan: chunk_id, seqid, start, end, place (from 0)."""
    schema = "strategy string, total_bases long, parameters string, n_chunks long, chunks array<struct<chunk_id:string,seqid:string,start:long,end:long>>"
    return spark.read.schema(schema).json(path).select(F.posexplode("chunks").alias("place", "c")).select("c.*", F.col("place").cast("long").alias("place"))


def uniprot_fasta(entries: DataFrame) -> DataFrame:
    """FASTA records of flat-file entries (accession, taxon, seq): seqid, description with the taxon, seq."""
    head = F.concat_ws(" ", "accession", F.when(F.col("taxon") != "", F.concat(F.lit("OX="), "taxon")))
    return entries.filter(F.length("accession") > 0).select(F.col("accession").alias("seqid"), head.alias("description"), "seq")


def prediction_columns(rows: DataFrame) -> dict:
    """Where the class probabilities of a table stand, and whether scaffolds are named.

    The column is ``predictions``, ``y_pred`` or ``data/predictions``, else the first one that
    is an array (or an array of arrays) of numbers.  Raises an error without one.
    """
    types = dict(rows.dtypes)
    arrays = [c for c, t in types.items() if t.replace("array<", "").rstrip(">") in ("double", "float") and t.startswith("array<")]
    column = next((n for n in PREDICTIONS if n in types), arrays[0] if arrays else None)
    if column is None:
        raise ValueError(f"no predictions among the columns {sorted(types)}")
    return {"column": column, "batched": types[column].startswith("array<array<"), "seqids": "seqid" in types}


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions from Parquet, the interchange format: all columns, the probabilities as ``probs``."""
    rows = spark.read.parquet(path)
    return rows.withColumnRenamed(prediction_columns(rows)["column"], "probs")


def validate_predictions(rows: DataFrame, classes: int = 4) -> DataFrame:
    """One row: positions, those without ``classes`` numbers, those whose sum isn't 1 within a thousandth."""
    info = prediction_columns(rows)
    flat = rows.select(F.explode(info["column"]).alias("p")) if info["batched"] else rows.select(F.col(info["column"]).alias("p"))
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return flat.agg(F.count("*").alias("n_positions"), F.count_if(F.size("p") != classes).alias("n_wrong_size"), F.count_if(F.abs(total - 1) > 1e-3).alias("n_wrong_sum"))


def companions(path: str) -> list[str]:
    """Names under which the input of a predictions file may stand beside it, in order."""
    folder, name = posixpath.split(path)
    stem, ending = posixpath.splitext(name)
    names = [stem.replace("_predictions", "_input") + ending, stem.replace("predictions", "input") + ending, f"{stem}_input{ending}"]
    return [posixpath.join(folder, n) for n in dict.fromkeys(names) if n != name]


def find_companion(spark: SparkSession, path: str, attribute: str | None = None) -> str | None:
    """The first companion that exists; else the file that an attribute of the predictions names, in the same folder."""
    wanted = companions(path) + ([posixpath.join(posixpath.dirname(path), posixpath.basename(attribute))] if attribute else [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for uri in wanted:
        place = spark._jvm.org.apache.hadoop.fs.Path(uri)
        if place.getFileSystem(conf).exists(place):
            return uri
    return None


# Protein databases that searches may use, as (name, file, taxonomy filter).
DATABASES = (
    ("swissprot", "uniprot_sprot.fasta", None),
    ("swissprot_plants", "uniprot_sprot_plants.dat", "plants"),
    ("uniref90", "uniref90.fasta", None),
    ("uniref50", "uniref50.fasta", None),
)


def databases(spark: SparkSession, cache: str) -> DataFrame:
    """The catalogue of databases with their place below ``cache`` and whether they are there."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for name, file, kind in DATABASES:
        place = spark._jvm.org.apache.hadoop.fs.Path(posixpath.join(cache, file))
        rows.append((name, file, kind, place.toString(), place.getFileSystem(conf).exists(place)))
    return spark.createDataFrame(rows, "name string, file string, taxonomy string, path string, cached boolean")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """file and MD5 of each file of a folder or pattern."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.md5("content").alias("md5"))


def database_records(spark: SparkSession, path: str, taxa: list[str] | None = None) -> DataFrame:
    """Protein records of a database file, flat (``.dat``) or FASTA, of the given taxa only if there are any."""
    from ..operators.genes import taxon

    rows = uniprot_fasta(readers.uniprot_dat(spark, path)) if path.endswith((".dat", ".dat.gz")) else readers.fasta(spark, path)
    return rows.filter(taxon(F.col("description")).isin(*taxa)) if taxa else rows
