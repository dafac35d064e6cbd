import duckdb
import pytest

import __spark_entry__
from genespark.functions import dna
from genespark.plans import binding, genome, sequences


def lines_of(spark, folder, orders):
    """A lineitem table with so many lines in each order."""
    rows = [(order, line, 10 * order + line, line, float(line), f"1995-01-{line % 28 + 1:02}", 1.0) for order, n in orders.items() for line in range(1, n + 1)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_shipdate string, l_extendedprice double"
    spark.createDataFrame(rows, names).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_all_exons_and_junctions_of_all_genes(spark, tmp_path):
    folder = lines_of(spark, tmp_path, {3: 12, 4: 2, 7: 40})
    exons = binding.exons(spark, folder).collect()
    assert sorted((r.gene, r.rn, r.start, r.end) for r in exons) == [(g, k, g * 1000 + k * 100, g * 1000 + k * 100 + 20 + k) for g, n in ((3, 12), (4, 2), (7, 40)) for k in range(1, n + 1)]
    assert binding.gene_introns(spark, folder).groupBy("gene").count().orderBy("gene").collect() == [(3, 11), (4, 1), (7, 39)]
    assert binding.junctions(spark, folder).count() == 51


def texts_in(spark, folder, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_best_donor_of_the_whole_sequence(spark, tmp_path):
    site = "CAGGTAAGT"
    texts = ["C" * 300 + site + "C" * 100, "C" * 200 + site, site + "C" * 500 + site, "ACGTTGCANN" * 30]
    folder = texts_in(spark, tmp_path, [t.translate(str.maketrans("ACGTN", "abcdm")) for t in texts])
    ratios = dna.log_ratios(dna.DONOR)
    want = {}
    for k, text in enumerate(texts):
        scores = [round(sum(dict(zip("ACGT", row, strict=True)).get(b, 0.0) for b, row in zip(text[p : p + 9], ratios, strict=True)), 6) for p in range(len(text) - 8)]
        want[k] = (scores.index(max(scores)), max(scores))
    got = {r.doc_id: (r.best_at, r.best_score) for r in sequences.sliding_pwm_best(spark, folder).collect()}
    assert got == want and [want[k][0] for k in range(3)] == [300, 200, 0]


def test_short_and_empty_sequences(spark, tmp_path):
    # Letters a, b, c, d, m read as A, C, G, T, N.
    folder = texts_in(spark, tmp_path, ["abc" * 10, "dab", "", "m", None])
    by_doc = lambda query: {r.doc_id: tuple(r[1:]) for r in query(spark, folder).collect()}
    assert by_doc(sequences.gc_content) == {0: (0.666667, 0.666667), 1: (0.333333, 0.333333), 2: (0, 0), 3: (0, 0), 4: (0, 0)}
    assert by_doc(sequences.nucleotide_counts) == {0: (10, 10, 10, 0, 0), 1: (1, 1, 0, 1, 0), 2: (0,) * 5, 3: (0, 0, 0, 0, 1), 4: (None,) * 5}
    assert len(by_doc(sequences.reverse_complement)) == 5
    assert by_doc(sequences.translate_codons) == {0: ("T" * 10,) * 2, 1: ("Y", "Y"), 2: ("", ""), 3: ("", ""), 4: (None, None)}
    assert by_doc(sequences.splice_type_case) == {0: ("CG", "AC", "other", False)} | {k: (None,) * 4 for k in range(1, 5)}  # the middle third
    scores = by_doc(sequences.pwm_score)
    assert scores[0][0] is not None and scores[0][1] is None and all(scores[k] == (None, None) for k in range(1, 5))
    kozak = by_doc(sequences.kozak_score)
    assert kozak[0][0] is not None and all(kozak[k] == (None,) for k in range(1, 5))
    assert sorted(by_doc(sequences.sliding_pwm_best)) == [0]
    assert genome.transcripts(spark, folder).isEmpty() and genome.phase_errors(spark, folder).isEmpty() and genome.cds_assembly(spark, folder).isEmpty()
    assert by_doc(sequences.start_codon_best) == {} and by_doc(sequences.inframe_stops) == {}


@pytest.mark.parametrize("name", ["gc_content", "translate_codons"])
def test_registered_queries_equal_their_sql_on_odd_texts(spark, tmp_path, name):
    # 41 of 640 bases: the product with a million lies just under a half.
    texts = ["abc" * 10, "dab", "", "m", "ab", None, "b" * 41 + "a" * 599]
    folder = texts_in(spark, tmp_path, texts)
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet/*.parquet'")
        want = con.sql(__spark_entry__.oracle_sql()[name]).fetchall()
    got = [tuple(r) for r in __spark_entry__.queries()[name](spark, folder).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == {"gc_content": 7, "translate_codons": 3}[name]
