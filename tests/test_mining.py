"""Golden cases of mining, tables and sources."""

import re

from pyspark.sql import functions as F

from phenolith.functions import evidence, metrics, organisms, text
from phenolith.lexicons import GENERA, INVALID_SPECIES, PLANT_GENERA, STOP_WORDS, phenotype
from phenolith.operators import tables as ops
from phenolith.plans.mining import Options, mine
from phenolith.sources import readers

ARTICLES = "pmid string, pmc_id string, title string, text string, pub_year string"


def run(spark, texts, **options):
    rows = [(str(k), None, "t", t, "2020") for k, t in enumerate(texts)]
    return {(r["pmid"], r["organism"]): r for r in mine(spark.createDataFrame(rows, ARTICLES), Options("IAA production", **options)).collect()}


def test_score_value_and_method_of_a_full_sentence(spark):
    r = run(spark, ["Pantoea agglomerans produced 40 mg/L IAA, confirmed by Salkowski assay."])["0", "Pantoea agglomerans"]
    assert (r["evidence_score"], r["confidence"], r["performance_value"], r["performance_unit"], r["performance_method"]) == (14, "Very High", 40.0, "mg/L", "Salkowski Reagent Assay")


def test_cloning_hosts_need_the_word_isolated(spark):
    s = "Bacillus subtilis produced 40 mg/L IAA, confirmed by Salkowski assay."
    assert set(run(spark, [s, s + " It was isolated."])) == {("1", "Bacillus subtilis")}


def test_negative_mode_and_accessions(spark):
    found = run(spark, ["Rhizobium meliloti-1021 did not produce IAA. The genome was deposited as GCF_000009045.1."], negative_evidence=True)
    assert found["0", "Rhizobium meliloti"]["phenotype_status"] == "Negative" and found["0", "Rhizobium meliloti"]["genome_accession"] == "GCF_000009045.1"


def column(spark, expr, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(expr).collect()]


def test_sentences_join_after_abbreviations(spark):
    one, two, no = column(spark, text.sentences(F.col("x")), "Azotobacter vinelandii, A. chroococcum, and A. paspali fix N2.", "The amount of N. Growth was measured.", "")
    assert len(one) == 1 and len(two) == 2 and no == [""]


def test_names(spark):
    df = spark.createDataFrame([("Bacillus subtilis, B. licheniformis and Burkholderia x. B. cepacia",), ("Rhizobium meliloti-1021, Pseudomonas and, Salmonella species, Burkholderia two-component",)], "x string")
    got = [r["n"] for r in organisms.with_candidates(df, "x", "n").select("n").collect()]
    assert got == [["Bacillus licheniformis", "Bacillus subtilis"], ["Rhizobium meliloti"]]


def test_parse(spark):
    raw = F.col("x")
    cleaned = F.try_element_at(metrics.expand_powers(F.array(metrics.prepared(raw))), F.lit(1))
    df = spark.createDataFrame([(v,) for v in ("12.3 ± 0.4 mg/L", "10-20 mg/L", "2015", "1.5x10³ ppm", "SI = 2.5", "")], "x string").withColumn("c", cleaned)
    got = [r[0] and (r[0]["value"], r[0]["value_min"], r[0]["value_max"], r[0]["unit"]) for r in df.select(metrics.parsed(raw, F.col("c"))).collect()]
    assert got == [(12.3, 11.9, 12.7, "mg/L"), (15.0, 10.0, 20.0, "mg/L"), None, (1500.0, None, None, "ppm"), (2.5, None, None, "SI"), None]


def test_negation_stays_in_its_clause(spark):
    s = "x solubilized phosphate efficiently, but showed no siderophore production"
    for query, want in (("siderophore", True), ("phosphate solubilization", False)):
        p = phenotype(query)
        assert column(spark, evidence.negated(F.col("x"), text.term_offsets(F.col("x"), p.terms)), s) == [want]


def test_interference(spark):
    s = F.lower(F.lit("Unlike Escherichia coli, Bacillus subtilis produced IAA"))
    rows = spark.range(1).select(organisms.interfered(s, F.lit("Bacillus subtilis"), F.array(F.lit("Escherichia coli"))), organisms.interfered(s, F.lit("Escherichia coli"), F.array(F.lit("Bacillus subtilis"))))
    assert tuple(rows.first()) == (True, False)


def test_general_format(spark):
    values = [0.0, 12.5, 1500.0, 0.00001, 1234567.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(text.general_format(F.col("v")))
    assert [r[0] for r in df.collect()] == [f"{v:g}" for v in values]


def test_repair_names(spark):
    lines = ["# c", "", "q\ts\t562;999999999\tN/A\te", "a\tb\tc"]
    got = ops.repair_names(spark.createDataFrame(list(enumerate(lines)), "line_no long, value string"), spark.createDataFrame([("562", "Escherichia coli")], "tax_id string, name string"))
    assert [r["value"] for r in got.orderBy("line_no").collect()] == ["# c", "", "q\ts\t562;999999999\tEscherichia coli;N/A\te", "a\tb\tc"]


def test_genotype(spark):
    genes = [("1", "nifH", "x", None, "7", None, 0), ("1", "NIFH", "regulator NifA", None, "8", None, 1), ("2", None, None, "9", None, None, 2), (None, "nifH", "x", None, None, None, 3)]
    asm = [("1", "GCF_1", "Azo (a)", "reference genome", True, True, "Bacteria", 0), ("1", "GCF_2", "Azo (b) x", "reference genome", True, True, "Bacteria", 1), ("2", "GCF_3", "Rhi", "reference genome", True, True, "Bacteria", 2)]
    g = spark.createDataFrame(genes, "tax_id string, symbol string, description string, attr_uid string, id string, uid string, ord long")
    a = spark.createDataFrame(asm, "tax_id string, accession string, organism string, category string, annotated boolean, is_latest boolean, superkingdom string, ord long")
    assert [(r["Organism Name"], r["Genome Accession"], r["GeneID"]) for r in ops.genotype(g, a, "nifh").collect()] == [("Azo x", "GCF_2", "7"), ("Rhi", "GCF_3", "9")]


def test_merges(spark):
    a = spark.createDataFrame([("G", f"g{k}", "d") for k in range(8)] + [("H", "nifH", None), ("H", "NifH", "e"), (None, "x", "y")], "`Genome Accession` string, `Gene Symbol` string, `Gene Description` string")
    got = {r["Genome Accession"]: (r["Gene Count"], r["Confidence"]) for r in ops.merge_genes([a, spark.range(1)]).collect()}
    assert got == {"G": (8, "High"), "H": (2, "Low")}
    e = spark.createDataFrame([("1", "o", "2"), ("1", "o", "9"), ("2", None, "x")], "PMID string, organism string, performance_value string")
    assert [r["performance_value"] for r in ops.merge_evidence([e]).collect()] == ["2", "x"]


def test_article_xml(spark):
    xml = "<PubmedArticle><PMID>5</PMID><Article><ArticleTitle>T <i>x</i></ArticleTitle><Journal><JournalIssue><PubDate><MedlineDate>2019 Winter</MedlineDate></PubDate></JournalIssue></Journal><Abstract><AbstractText>a</AbstractText><AbstractText>b</AbstractText></Abstract></Article></PubmedArticle>"
    rows = readers.parse_articles(spark.createDataFrame([(xml,), ("<broken",), (None,)], "xml string")).collect()
    assert [(r["pmid"], r["text"], r["pub_year"], r["pmc_id"]) for r in rows] == [("5", "T . a b", "2019", None)]


def test_queries_are_named_and_paired():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def names_by_hand(t, unlisted):
    """Names in a text, by Python's regular expressions alone."""

    def canonical(genus, species):
        species = re.sub(r"^([a-z]+)[.-]\d\w*$", r"\1", species.lower())
        if len(species) < 3 or not species.isalpha() or species in INVALID_SPECIES + STOP_WORDS:
            return None
        open_ = unlisted and genus not in PLANT_GENERA and genus.lower() not in STOP_WORDS and len(genus) >= 4 and genus[1:].islower() and len(species) >= 4
        return f"{genus} {species}" if genus in GENERA or open_ else None

    full = [(m.start(), m[1], m[2]) for m in re.finditer(r"\b([A-Z][a-z]+)\s+([a-z0-9]+(?:[\.-][a-z0-9]+)?)\b", t or "")]
    found = {canonical(g, s) for _, g, s in full}
    for m in re.finditer(r"\b([A-Z])\.\s*([a-z]+(?:[\.-][a-z]+)?)\b", t or ""):
        before = {g for at, g, _ in full if at < m.start() and g[0] == m[1]}
        if len(before) == 1:
            found.add(canonical(*before, m[2]))
    return sorted(found - {None})


def test_candidates_of_every_document(spark, tmp_path):
    import __spark_entry__ as e

    texts = ["Bacillus subtilis et B. licheniformis dans le café", "Über Pseudomonas putida, P. fluorescens und Pantoea agglomerans; P. stutzeri", "Élan Rhizobium meliloti-1021 \u00a0Azotobacter\u00a0vinelandii", "été Bacillus subtilisé Ébacillus cereus", "Plain Bacillus cereus. Lorem ipsum dolor, L. amet", "Öl B. subtilis Bacillus x", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["organisms"] or [], r["candidates"] or []) for r in e.queries()["q_organism_candidates"](spark, str(tmp_path)).collect()}
    assert got == {k: (names_by_hand(t, False), names_by_hand(t, True)) for k, t in enumerate(texts)}
    assert got[0][0] == ["Bacillus licheniformis", "Bacillus subtilis"] and "Pantoea agglomerans" in got[1][0]

    import duckdb

    binomials = {tuple(r) for r in e.queries()["q_binomial_candidates"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert binomials == set(con.execute(e.oracle_sql()["q_binomial_candidates"]).fetchall())
    assert binomials == {(0, 1, 1), (1, 2, 2), (2, 2, 2), (4, 2, 2)}
