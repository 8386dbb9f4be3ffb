"""Queries that run the library's entry points on articles, tables and XML made from orders, with equivalent DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics, organisms
from ..operators import tables as ops
from ..sources import readers
from . import mining
from .queries import IAA, query, quoted, table

NAMES = ["Pantoea agglomerans", "Bacillus subtilis", "Pseudomonas putida", "Rhizobium meliloti", "Azotobacter vinelandii"]
RIVAL = "Escherichia coli"
VERBS = ["produced", "did not produce", "yielded", "was reviewed for", "produced and secreted"]
UNITS = ["mg/L", "µg/mL", "ppm"]
ASSAYS = ["Salkowski assay", "HPLC", ""]
LABELS = ["Salkowski Reagent Assay", "HPLC", "Not Explicitly Stated"]
#: Organisms whose assembly is known by name.
LISTED = ["Pantoea agglomerans", "Escherichia coli", "Azotobacter vinelandii"]


def _pick_sql(words: list[str], i: str) -> str:
    return f"list_extract([{quoted(words)}], CAST({i} AS INT) + 1)"


def _pick(words: list[str], i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), i.cast("int") + 1)


ARTICLES_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS pmid, o_orderkey AS k, CAST(year(o_orderdate) AS VARCHAR) AS pub_year, 'Soil bacteria ' || CAST(o_custkey AS VARCHAR) AS title,
  {_pick_sql(NAMES, "o_custkey % 5")} AS organism, o_orderkey % 5 AS verb, {_pick_sql(UNITS, "(o_orderkey // 5) % 3")} AS unit, o_custkey % 50 + 1 AS amount, o_custkey % 7 AS error,
  (o_orderkey // 15) % 3 AS assay, (o_orderkey // 45) % 3 = 0 AS rival, (o_orderkey // 135) % 2 = 0 AS isolated, o_orderkey % 2 = 0 AS reported,
  CASE WHEN (o_orderkey // 45) % 3 = 0 THEN 'Unlike {RIVAL}, ' ELSE '' END || {_pick_sql(NAMES, "o_custkey % 5")} || ' ' || {_pick_sql(VERBS, "o_orderkey % 5")} || ' ' || CAST(o_custkey % 50 + 1 AS VARCHAR) || ' ± ' || CAST(o_custkey % 7 AS VARCHAR)
  || ' ' || {_pick_sql(UNITS, "(o_orderkey // 5) % 3")} || ' IAA' || CASE WHEN (o_orderkey // 15) % 3 < 2 THEN ', confirmed by ' || {_pick_sql(ASSAYS, "(o_orderkey // 15) % 3")} ELSE '' END || '.' AS sentence
FROM orders"""


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An article per order: a sentence of evidence, some with another organism before it, some with the word isolated, some with an accession."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    part = lambda n, m: F.floor(k / n).cast("long") % m
    assay = F.when(part(15, 3) < 2, F.concat(F.lit(", confirmed by "), _pick(ASSAYS, part(15, 3)))).otherwise("")
    amount = F.concat((c % 50 + 1).cast("string"), F.lit(" ± "), (c % 7).cast("string"), F.lit(" "), _pick(UNITS, part(5, 3)))
    name = _pick(NAMES, c % 5)
    sentence = F.concat(F.when(part(45, 3) == 0, f"Unlike {RIVAL}, ").otherwise(""), name, F.lit(" "), _pick(VERBS, k % 5), F.lit(" "), amount, F.lit(" IAA"), assay, F.lit("."))
    accession = F.when(k % 2 == 0, F.concat(F.lit(" The genome of "), name, F.lit(" was deposited as GCF_"), F.lpad(k.cast("string"), 9, "0"), F.lit(".1."))).otherwise("")
    body = F.concat(sentence, F.when(part(135, 2) == 0, " It was isolated from soil.").otherwise(""), accession)
    return table(spark, sf_dir, "orders").select(k.cast("string").alias("pmid"), F.lit(None).cast("string").alias("pmc_id"), F.concat(F.lit("Soil bacteria "), c.cast("string")).alias("title"), body.alias("text"), F.year("o_orderdate").cast("string").alias("pub_year"))


# What an article's evidence is: the organism unless another genus stands before it, and that other one; hosts of cloning only where something was isolated.
FOUND_SQL = f"""
WITH a AS ({ARTICLES_SQL}), o AS (
  SELECT a.*, organism AS found FROM a WHERE NOT rival AND (organism <> 'Bacillus subtilis' OR isolated)
  UNION ALL SELECT a.*, '{RIVAL}' FROM a WHERE rival AND isolated)
SELECT *, 10 + CASE WHEN verb = 4 THEN 1 ELSE 0 END + CASE WHEN assay < 2 THEN 4 ELSE 0 END AS score,
  CASE WHEN reported AND found = organism THEN 'GCF_' || lpad(CAST(k AS VARCHAR), 9, '0') || '.1' WHEN found IN ({quoted(LISTED)}) THEN 'GCF_' || found ELSE '' END AS accession,
  CASE WHEN reported AND found = organism THEN 'Reported in Paper' WHEN found IN ({quoted(LISTED)}) THEN 'NCBI Lookup' ELSE '' END AS origin
FROM o"""
MINED = ["pmid", "pub_year", "organism", "phenotype_status", "confidence", "performance_value", "performance_unit", "performance_range", "performance_method", "performance_evidence_sentence", "genome_accession", "genome_source", "evidence_score"]
POSITIVE_SQL = f"""
SELECT pmid, pub_year, found AS organism, 'Positive' AS phenotype_status, CASE WHEN score >= 14 THEN 'Very High' ELSE 'High' END AS confidence, CAST(amount AS DOUBLE) AS performance_value, unit AS performance_unit,
  CAST(amount - error AS VARCHAR) || ' – ' || CAST(amount + error AS VARCHAR) AS performance_range, {_pick_sql(LABELS, "assay")} AS performance_method, sentence AS performance_evidence_sentence,
  accession AS genome_accession, origin AS genome_source, CAST(score AS INTEGER) AS evidence_score
FROM ({FOUND_SQL}) WHERE verb IN (0, 2, 4)"""


def mined(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    o = mining.Options("IAA production", **{"max_articles": None, **options})
    listed = spark.createDataFrame([(x, f"GCF_{x}") for x in LISTED], "organism string, accession string")
    return mining.mine(articles(spark, sf_dir), o, assemblies=listed)


@query(POSITIVE_SQL)
def q_mine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, sf_dir).select(*MINED)


@query(f"""SELECT pmid, found AS organism, 'Negative' AS phenotype_status, CASE WHEN assay < 2 THEN 'High' ELSE 'Medium' END AS confidence, CAST(CASE WHEN assay < 2 THEN 9 ELSE 5 END AS INTEGER) AS evidence_score, 'N/A' AS performance_metric, {_pick_sql(LABELS, "assay")} AS performance_method, accession AS genome_accession
FROM ({FOUND_SQL}) WHERE verb = 1""")
def q_negative_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, sf_dir, negative_evidence=True).select("pmid", "organism", "phenotype_status", "confidence", "evidence_score", "performance_metric", "performance_method", "genome_accession")


@query(f"""WITH t AS (SELECT * FROM ({ARTICLES_SQL}) WHERE CAST(pub_year AS INT) BETWEEN 1993 AND 1997 ORDER BY CAST(pub_year AS INT) DESC, pmid LIMIT 400)
SELECT organism, count(*) AS n, min(evidence_score) AS least_score FROM ({POSITIVE_SQL}) WHERE evidence_score >= 11 AND pmid IN (SELECT pmid FROM t) GROUP BY organism""")
def q_mine_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options of a run: years, the newest 400 articles (the feature), a least score, values required."""
    found = mined(spark, sf_dir, year_from=1993, year_to=1997, max_articles=400, min_score=11, strict_metric=True)
    return found.groupBy("organism").agg(F.count("*").alias("n"), F.min("evidence_score").alias("least_score"))


@query(f"""SELECT pmid, organism, performance_value, evidence_score, row_number() OVER (ORDER BY performance_value DESC NULLS LAST, evidence_score DESC, CAST(pub_year AS DOUBLE) DESC, organism, pmid) AS place FROM ({POSITIVE_SQL}) QUALIFY place <= 50""")
def q_evidence_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.preview(mined(spark, sf_dir), 50).select("pmid", "organism", "performance_value", "evidence_score", F.col("place").cast("long").alias("place"))


@query(f"""SELECT pmid, pub_year FROM ({ARTICLES_SQL}) WHERE contains(lower(title || ' ' || sentence), 'ppm iaa') AND CAST(pub_year AS INT) BETWEEN 1994 AND 1996 ORDER BY CAST(pub_year AS INT) DESC, pmid LIMIT 100""")
def q_select_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = mining.Options("ppm IAA", year_from=1994, year_to=1996, max_articles=100)
    return mining.select_articles(articles(spark, sf_dir), o).select("pmid", "pub_year")


@query("""WITH o AS (SELECT o_orderkey AS k, o_custkey % 40 + 1 AS near, o_custkey % 90 + 1 AS far, o_orderkey % 3 AS form FROM orders)
SELECT k, CAST(CASE WHEN form = 2 THEN far ELSE near END AS DOUBLE) AS value, CASE WHEN form = 2 THEN 'ppm' ELSE 'mg/L' END AS unit, CAST(CASE WHEN form = 0 THEN 2 ELSE 1 END AS INTEGER) AS n FROM o""")
def q_metric_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two values in a sentence: the one nearest to the phenotype's words holds, and one that stands nearer to another phenotype's does not count."""
    c, form = F.col("o_custkey"), F.col("o_orderkey") % 3
    near, far = (c % 40 + 1).cast("string"), (c % 90 + 1).cast("string")
    low = F.when(form == 0, F.concat(far, F.lit(" ppm of salt in the medium and then "), near, F.lit(" mg/l iaa")))
    low = low.when(form == 1, F.concat(far, F.lit(" ppm phosphate and then in the end "), near, F.lit(" mg/l iaa")))
    low = low.otherwise(F.concat(F.lit("iaa reached "), far, F.lit(" ppm although zinc stayed at "), near, F.lit(" mg/l zinc")))
    s = ops.spread(table(spark, sf_dir, "orders")).select(F.col("o_orderkey").alias("k"), low.alias("low"))
    return s.select("k", metrics.measure(F.col("low"), IAA).alias("m")).select("k", "m.value", "m.unit", "m.n")


@query(f"""WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS pmid, {_pick_sql(NAMES, "o_custkey % 5")} AS one, {_pick_sql(NAMES, "(o_custkey + 1 + o_orderkey % 4) % 5")} AS two, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS n, o_orderkey % 3 AS form FROM orders)
SELECT pmid, one AS organism, 'GCF_' || n || '.1' AS accession FROM o WHERE form <> 1 UNION ALL SELECT pmid, two, CASE WHEN form = 2 THEN 'GCF_' ELSE 'GCA_' END || n || CASE WHEN form = 2 THEN '.3' ELSE '.2' END FROM o""")
def q_reported_accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accessions of articles that name two organisms, outside and inside a genome context, and two kinds for one organism."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    one, two, n = _pick(NAMES, c % 5), _pick(NAMES, (c + 1 + k % 4) % 5), F.lpad(k.cast("string"), 9, "0")
    first = F.when(k % 3 == 1, F.concat(F.lit("Of "), one, F.lit(" see GCF_"), n, F.lit(".1 in a list. "), F.lit("x " * 120))).otherwise(F.concat(F.lit("The assembly of "), one, F.lit(" is GCF_"), n, F.lit(".1. ")))
    second = F.when(k % 3 == 2, F.concat(F.lit("The genomes of "), two, F.lit(" are PRJNA"), n, F.lit(" and GCF_"), n, F.lit(".3."))).otherwise(F.concat(F.lit("The genome of "), two, F.lit(" is GCA_"), n, F.lit(".2.")))
    rows = ops.spread(table(spark, sf_dir, "orders")).select(k.cast("string").alias("pmid"), F.concat(first, second).alias("body"))
    return mining.reported_accessions(organisms.with_candidates(rows, "body", "names"))


_ABBREVIATED = [
    ("Bacillus cereus and B. licheniformis", ["Bacillus cereus", "Bacillus licheniformis"]),
    ("Bacillus cereus, Burkholderia cepacia and B. licheniformis", ["Bacillus cereus", "Burkholderia cepacia"]),
    ("B. licheniformis before Bacillus cereus", ["Bacillus cereus"]),
    ("Pseudomonas putida, P. fluorescens, Rhizobium species and R. meliloti", ["Pseudomonas fluorescens", "Pseudomonas putida", "Rhizobium meliloti"]),
    ("Lorem ipsum with L. plantarum", []),
]


@query(f"""SELECT doc_id, list_extract([{", ".join("'" + "; ".join(n) + "'" for _, n in _ABBREVIATED)}], CAST(doc_id % 5 AS INT) + 1) AS names FROM documents""")
def q_abbreviated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abbreviated names take the one genus of their initial that stands before them."""
    rows = table(spark, sf_dir, "documents").select("doc_id", _pick([t for t, _ in _ABBREVIATED], F.col("doc_id") % 5).alias("t"))
    return organisms.with_candidates(rows, "t", "names").select("doc_id", F.array_join("names", "; ").alias("names"))


@query("""WITH u AS (SELECT 0 AS t, o_orderkey AS r, o_custkey AS pmid, o_orderpriority AS organism, o_totalprice AS v, NULL AS note FROM orders UNION ALL SELECT 1, o_orderkey, o_custkey % 200, o_orderpriority, -o_totalprice, o_orderstatus FROM orders)
SELECT pmid, organism, v AS performance_value, note FROM u QUALIFY row_number() OVER (PARTITION BY pmid, organism ORDER BY t, r) = 1""")
def q_merge_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of different columns and spelling; the first row of an article and organism holds."""
    o = table(spark, sf_dir, "orders")
    a = o.select(F.col("o_custkey").alias("pmid"), F.col("o_orderpriority").alias("organism"), F.col("o_totalprice").alias("performance_value"), F.col("o_orderkey").alias("_row"))
    b = o.select((F.col("o_custkey") % 200).alias("pmid"), F.col("o_orderpriority").alias("organism"), (-F.col("o_totalprice")).alias("performance_value"), F.col("o_orderstatus").alias("note"), F.col("o_orderkey").alias("_row"))
    return ops.merge_evidence([a, b])


@query("""WITH n AS (SELECT CAST(s_suppkey AS VARCHAR) AS tax, arg_max(name, s_acctbal) AS name, arg_max(acc, s_acctbal) AS acc FROM (SELECT s_suppkey % 60 AS s_suppkey, s_acctbal, s_name AS name, 'GCF_' || CAST(s_suppkey AS VARCHAR) AS acc FROM supplier WHERE s_nationkey % 2 = 0) GROUP BY 1),
g AS (SELECT CAST(p_partkey % 90 AS VARCHAR) AS tax, coalesce(CASE WHEN p_partkey % 3 < 2 THEN 'nif' || CASE WHEN p_partkey % 2 = 0 THEN 'H' ELSE 'h' END END, 'nifH') AS symbol, CASE WHEN p_partkey % 11 = 0 THEN 'putative regulator' ELSE p_name END AS descr, p_partkey AS k FROM part)
SELECT name AS "Organism Name", acc AS "Genome Accession", symbol AS "Gene Symbol", descr AS "Gene Description", CAST(k AS VARCHAR) AS "GeneID", tax AS "TaxID" FROM g JOIN n USING (tax) WHERE lower(symbol) = 'nifh' AND NOT contains(descr, 'regulator') QUALIFY row_number() OVER (PARTITION BY acc ORDER BY k) = 1""")
def q_genotype_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = table(spark, sf_dir, "supplier").where("s_nationkey % 2 = 0"), F.col("p_partkey")
    assemblies = s.select((F.col("s_suppkey") % 60).cast("string").alias("tax_id"), F.concat(F.lit("GCF_"), F.col("s_suppkey").cast("string")).alias("accession"), F.concat("s_name", F.lit(" (strain)")).alias("organism"), F.lit("reference genome").alias("category"), F.lit(True).alias("annotated"), F.lit(True).alias("is_latest"), F.lit("Bacteria").alias("superkingdom"), F.col("s_acctbal").alias("ord"))
    symbol = F.when(k % 3 < 2, F.concat(F.lit("nif"), F.when(k % 2 == 0, "H").otherwise("h")))
    none = F.lit(None).cast("string")
    genes = table(spark, sf_dir, "part").select((k % 90).cast("string").alias("tax_id"), symbol.alias("symbol"), F.when(k % 11 == 0, "putative regulator").otherwise(F.col("p_name")).alias("description"), none.alias("attr_uid"), F.when(k % 2 == 0, k.cast("string")).otherwise("").alias("id"), k.cast("string").alias("uid"), k.alias("ord"))
    return ops.genotype(genes, assemblies, "nifH").select("Organism Name", "Genome Accession", "Gene Symbol", "Gene Description", "GeneID", "TaxID")


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(year(o_orderdate) AS VARCHAR) AS y, o_orderpriority AS p, o_orderkey % 4 AS form FROM orders)
SELECT CAST(k AS VARCHAR) AS pmid, CASE WHEN form = 0 THEN 'PMC' || CAST(k AS VARCHAR) END AS pmc_id, 'On ' || p AS title, 'On ' || p || '. first ' || CASE WHEN form = 3 THEN '' ELSE 'second' END AS text, CASE WHEN form = 3 THEN '' ELSE y END AS pub_year FROM o WHERE k % 50 <> 7""")
def q_article_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article documents with the year of the issue, in free text, of the electronic article or none; markup inside a title; some do not parse."""
    k, y = F.col("o_orderkey"), F.year("o_orderdate").cast("string")
    form, at = k % 4, lambda *x: F.concat(*(F.lit(v) if isinstance(v, str) else v for v in x))
    date = F.when(form == 0, at("<PubDate><Year>", y, "</Year></PubDate>")).when(form == 1, at("<PubDate><MedlineDate>Spring ", y, "-x</MedlineDate></PubDate>")).otherwise("<PubDate/>")
    more = F.when(form == 2, at("<ArticleDate><Year>", y, "</Year></ArticleDate>")).otherwise("")
    abstract = F.when(form == 3, "<AbstractText>first </AbstractText>").otherwise("<AbstractText>first</AbstractText><AbstractText>second<i>x</i> tail</AbstractText>")
    pmc = F.when(form == 0, at("<ArticleIdList><ArticleId IdType='doi'>10/1</ArticleId><ArticleId IdType='pmc'>PMC", k.cast("string"), "</ArticleId></ArticleIdList>")).otherwise("")
    xml = at("<PubmedArticle><PMID>", k.cast("string"), "</PMID><Article><Journal><JournalIssue>", date, "</JournalIssue></Journal><ArticleTitle>On ", F.col("o_orderpriority"), "<sup>2</sup></ArticleTitle><Abstract>", abstract, "</Abstract>", more, "</Article>", pmc, F.when(k % 50 == 7, "<open>").otherwise(""), "</PubmedArticle>")
    return readers.parse_articles(ops.spread(table(spark, sf_dir, "orders")).select(xml.alias("xml")))


@query("""SELECT 'PMC' || CAST(page_id AS VARCHAR) AS pmc_id, '--- SECTION: Methods ---' || chr(10) || 'grown ' || url || CASE WHEN page_id % 2 = 0 THEN chr(10) || '--- SECTION: Data availability ---' || chr(10) || 'deposited' ELSE '' END AS full_text FROM pages""")
def q_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections by their titles, each marker before its paragraphs."""
    url = F.regexp_replace(F.regexp_replace("url", "&", "&amp;"), "<", "&lt;")
    end = F.when(F.col("page_id") % 2 == 0, "<sec><title>Data availability</title><p>deposited</p></sec>").otherwise("<sec><p>untitled</p></sec>")
    xml = F.concat(F.lit("<article><body><sec><title>Introduction</title><p>no</p></sec><sec><title>Methods</title><p>grown "), url, F.lit("</p></sec>"), end, F.lit("</body></article>"))
    return readers.parse_full_texts(table(spark, sf_dir, "pages").select(F.concat(F.lit("PMC"), F.col("page_id").cast("string")).alias("pmc_id"), xml.alias("xml")))


@query("""SELECT DISTINCT trim(t) AS tax_id FROM (SELECT unnest(string_split(CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CAST(o_custkey % 300 AS VARCHAR) || '; ' || CAST(o_orderkey % 300 AS VARCHAR) || ';N/A' END, ';')) AS t FROM orders) WHERE trim(t) NOT IN ('', 'N/A')""")
def q_tax_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.concat((F.col("o_custkey") % 300).cast("string"), F.lit("; "), (F.col("o_orderkey") % 300).cast("string"), F.lit(";N/A"))
    line = F.when(F.col("o_orderkey") % 9 == 0, "# comment\ta\t77777").otherwise(F.concat(F.lit("q\ts\t"), ids))
    return ops.tax_ids(table(spark, sf_dir, "orders").select(line.alias("value")))


@query(f"""SELECT (SELECT 2 * count(*) FROM orders) AS rows_before, (SELECT count(DISTINCT o_custkey) FROM orders) AS rows_after""")
def q_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pmid"), F.lit("x").alias("organism"), F.col("o_orderkey").alias("_row"))
    return ops.merge_counts([o, o], ops.merge_evidence([o, o]))
