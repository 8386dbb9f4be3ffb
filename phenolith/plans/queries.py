"""Queries that apply each operator to the test tables, with equivalent DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import evidence as ev
from ..functions import metrics, organisms, text
from ..lexicons import BAD_GENE_WORDS, CONFIRMATIONS, GENERA, INVALID_SPECIES, PLANT_GENERA, STOP_WORDS, STRONG_VERBS, phenotype
from ..operators import tables as ops

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# A sentence per line item, as the documents hold none of the vocabulary.
SPECIES = ["subtilis", "agglomerans", "putida", "meliloti", "vinelandii"]
GENUS = ["Bacillus", "Pantoea", "Pseudomonas", "Rhizobium", "Azotobacter"]
VERB = ["produced", "did not produce", "yielded", "was reviewed for", "secreted"]
UNIT = {"A": "mg/L", "N": "µg/mL", "R": "ppm"}
ASSAY = {"F": "Salkowski assay", "O": "HPLC"}
SYNTH_SQL = f"""
SELECT l_orderkey AS doc_id, l_linenumber AS ord, l_suppkey AS supp, l_quantity AS qty,
  list_extract([{quoted(GENUS)}], CAST(l_suppkey % 5 AS INT) + 1) || ' ' || list_extract([{quoted(SPECIES)}], CAST(l_partkey % 5 AS INT) + 1) AS organism,
  list_extract([{quoted(GENUS)}], CAST(l_suppkey % 5 AS INT) + 1) || ' ' || list_extract([{quoted(SPECIES)}], CAST(l_partkey % 5 AS INT) + 1) || ' '
  || list_extract([{quoted(VERB)}], CAST(l_linenumber % 5 AS INT) + 1) || ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' ± ' || CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) || ' '
  || CASE l_returnflag WHEN 'A' THEN 'mg/L' WHEN 'N' THEN 'µg/mL' ELSE 'ppm' END || ' IAA, confirmed by ' || CASE l_linestatus WHEN 'F' THEN 'Salkowski assay' ELSE 'HPLC' END || '.' AS text
FROM lineitem"""


def synth(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda words, c: F.element_at(F.array(*map(F.lit, words)), (F.col(c) % len(words)).cast("int") + 1)
    name = F.concat(pick(GENUS, "l_suppkey"), F.lit(" "), pick(SPECIES, "l_partkey"))
    unit = F.when(F.col("l_returnflag") == "A", UNIT["A"]).when(F.col("l_returnflag") == "N", UNIT["N"]).otherwise(UNIT["R"])
    amount = F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit(" ± "), F.round(F.col("l_discount") * 100).cast("long").cast("string"))
    sentence = F.concat(name, F.lit(" "), pick(VERB, "l_linenumber"), F.lit(" "), amount, F.lit(" "), unit, F.lit(" IAA, confirmed by "), F.when(F.col("l_linestatus") == "F", ASSAY["F"]).otherwise(ASSAY["O"]), F.lit("."))
    return ops.spread(table(spark, sf_dir, "lineitem")).select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("ord"), F.col("l_suppkey").alias("supp"), F.col("l_quantity").alias("qty"), name.alias("organism"), sentence.alias("text"))


IAA = phenotype("IAA production")
VERBS_SQL = " + ".join(f"CAST(regexp_matches(lower(text), '\\b{v}') AS INT)" for v in STRONG_VERBS)
SCORE_SQL = f"""(CASE WHEN contains(lower(text), 'iaa') THEN 2 ELSE 0 END + CASE WHEN v >= 1 THEN 3 ELSE 0 END + CASE WHEN v >= 2 THEN 1 ELSE 0 END
  + CASE WHEN regexp_matches(lower(text), '\\b({"|".join(CONFIRMATIONS)})') THEN 2 ELSE 0 END + 2)"""
SCORED_SQL = f"SELECT *, CASE WHEN contains(text, 'did not') THEN 0 ELSE {SCORE_SQL} - CASE WHEN contains(text, 'review') THEN 11 ELSE 0 END END AS score FROM (SELECT *, {VERBS_SQL} AS v FROM ({SYNTH_SQL}))"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.with_evidence(synth(spark, sf_dir), IAA, "text").withColumn("score", ev.strength())


@query(f"""WITH s AS ({SCORED_SQL}), b AS (SELECT doc_id, organism, max(score) AS score, arg_max(text, {{'s': score, 't': text}}) AS sentence FROM s WHERE score > 0 GROUP BY ALL)
SELECT doc_id, organism, CAST(score AS BIGINT) AS score, sentence, CASE WHEN score >= 14 THEN 'Very High' WHEN score >= 9 THEN 'High' WHEN score >= 5 THEN 'Medium' ELSE 'Low' END AS tier FROM b WHERE score >= 5""")
def q_best_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = scored(spark, sf_dir).groupBy("doc_id", "organism").agg(F.max(F.struct("score", "text")).alias("b"))
    return best.select("doc_id", "organism", F.col("b.score").cast("long").alias("score"), F.col("b.text").alias("sentence"), ev.tier(F.col("b.score")).alias("tier")).where("score >= 5")


@query(f"SELECT score, v AS n_verbs, count(*) AS n FROM ({SCORED_SQL}) GROUP BY ALL")
def q_evidence_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).groupBy("score", "n_verbs").agg(F.count("*").alias("n"))


@query(f"""SELECT contains(text, 'did not') AS negated, count(*) AS n, sum(CAST(5 + 2 + 2 AS BIGINT)) AS points FROM ({SYNTH_SQL}) GROUP BY ALL""")
def q_negation_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, points = scored(spark, sf_dir), ev.against()
    return s.groupBy("negated").agg(F.count("*").alias("n"), F.sum(points.cast("long")).alias("points"))


@query(f"""WITH m AS (SELECT text, regexp_extract(text, '(\\d+) ± (\\d+) (mg/L|µg/mL|ppm)', 1) AS c, regexp_extract(text, '(\\d+) ± (\\d+) (mg/L|µg/mL|ppm)', 2) AS e, regexp_extract(text, '(\\d+) ± (\\d+) (mg/L|µg/mL|ppm)', 3) AS u FROM ({SYNTH_SQL}))
SELECT CAST(c AS DOUBLE) AS value, CAST(c AS DOUBLE) - CAST(e AS DOUBLE) AS value_min, CAST(c AS DOUBLE) + CAST(e AS DOUBLE) AS value_max, u AS unit, count(*) AS n FROM m GROUP BY ALL""")
def q_metric_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = synth(spark, sf_dir).select(metrics.measure(F.col("text"), IAA).alias("m"))
    return m.groupBy("m.value", "m.value_min", "m.value_max", "m.unit").agg(F.count("*").alias("n"))


@query(f"SELECT organism, CASE WHEN contains(text, 'Salkowski') THEN 'Salkowski Reagent Assay' ELSE 'HPLC' END AS method, count(*) AS n FROM ({SYNTH_SQL}) GROUP BY ALL")
def q_method_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.with_evidence(synth(spark, sf_dir), IAA, "text").groupBy("organism", F.col("label").alias("method")).agg(F.count("*").alias("n"))


@query(f"""WITH s AS (SELECT DISTINCT doc_id, organism FROM ({SYNTH_SQL})), p AS (SELECT a.doc_id, a.organism AS target, b.organism AS other FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.organism <> b.organism)
SELECT target, other, split_part(target, ' ', 1) <> split_part(other, ' ', 1) AS interferes, count(*) AS n FROM p GROUP BY ALL""")
def q_interference(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the organisms of a text meet in one row of it, after one shuffle; the sentence depends on their names alone
    s = synth(spark, sf_dir).where("doc_id is not null").select("doc_id", "organism").repartition("doc_id").distinct().groupBy("doc_id").agg(F.collect_set("organism").alias("all"))
    pairs = s.select("all", F.explode("all").alias("target")).select("target", F.explode("all").alias("other")).where("target <> other").groupBy("target", "other").agg(F.count("*").alias("n"))
    said = F.lower(F.concat(F.lit("Unlike "), "other", F.lit(", "), "target", F.lit(" produced IAA.")))
    return pairs.select("target", "other", organisms.interfered(said, F.col("target"), F.array("other")).alias("interferes"), "n")


@query("""SELECT doc_id, CAST(len(string_split(regexp_replace(text, '([.?!])[ \t\n\r\f\v]', '\\1' || chr(1), 'g'), chr(1))) AS BIGINT) AS n FROM documents""")
def q_sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split("text", r"(?<=[.?!])[ \t\n\r\f\x0B]", -1)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(parts).cast("long").alias("n"))


# RE2's word boundaries and white space are ASCII's: other white space becomes a blank, other word characters an underscore, the rest an exclamation mark.
ASCII_SQL = "regexp_replace(regexp_replace(regexp_replace(text, '[\\x{85}\\p{Z}]', ' ', 'g'), '[^\\x00-\\x7F\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}]', '!', 'g'), '[^\\x00-\\x7F]', '_', 'g')"


@query(f"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all({ASCII_SQL}, '\\b[A-Z][a-z]+[ \t\n\x0B\f\r]+[a-z0-9]+(?:[.-][a-z0-9]+)?\\b')) AS m FROM documents),
w AS (SELECT doc_id, regexp_extract(m, '^[A-Za-z]+') AS genus, regexp_replace(regexp_extract(m, '[a-z0-9.-]+$'), '^([a-z]+)[.-][0-9][0-9a-z]*$', '\\1') AS species FROM m)
SELECT doc_id, count(*) AS n, count(DISTINCT genus || ' ' || species) AS n_distinct FROM w WHERE regexp_matches(species, '^[a-z]{{3,}}$') AND species NOT IN ({quoted(INVALID_SPECIES + STOP_WORDS)})
  AND (genus IN ({quoted(GENERA)}) OR (genus NOT IN ({quoted(PLANT_GENERA)}) AND lower(genus) NOT IN ({quoted(STOP_WORDS)}) AND length(genus) >= 4 AND length(species) >= 4)) GROUP BY doc_id""")
def q_binomial_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full names in every document, those that only look like one included."""
    m = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"(?U){organisms.FULL}"), F.lit(0))).alias("m"))
    names = m.select("doc_id", organisms.canonical(F.col("m"), unlisted=True).alias("name")).where("name is not null")
    return names.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("name").alias("n_distinct"))


@query()  # no SQL: RE2 has neither Unicode's word boundaries nor the look back for abbreviated names
def q_organism_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its names of listed genera, and with those that only look like one."""
    return organisms.with_candidates(organisms.with_candidates(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "organisms"), "text", "candidates", unlisted=True).drop("text")


@query("""WITH d AS (SELECT doc_id, string_split(lower(text), 'the') AS g FROM documents), e AS (SELECT doc_id, unnest(list_transform(range(1, len(g)), lambda i: list_sum(list_transform(g[1:i], lambda x: length(x))) + 3 * (i - 1))) AS pos FROM d WHERE len(g) > 1)
SELECT doc_id, count(*) AS n, CAST(min(pos) AS BIGINT) AS first_pos, CAST(max(pos) AS BIGINT) AS last_pos FROM e GROUP BY doc_id""")
def q_term_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", text.offsets(F.lower("text"), "the").alias("at")).where(F.size("at") > 0)
    return found.select("doc_id", F.size("at").cast("long").alias("n"), F.array_min("at").cast("long").alias("first_pos"), F.array_max("at").cast("long").alias("last_pos"))


@query("""WITH v AS (SELECT l_extendedprice * (1 - l_discount) AS x FROM lineitem), r AS (SELECT x, pow(10.0, 3 - floor(log10(abs(x)))) AS f FROM v)
SELECT round_even(x * f, 0) / f AS value, count(*) AS n FROM r GROUP BY ALL""")
def q_sig_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(text.significant(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("value")).agg(F.count("*").alias("n"))


_UNITS = ["ug/mL", "mg/L IAA", "mm halo", "nmol mg-1 h-1", "PSI", "%", "fold", "xyz"]


@query(f"""SELECT list_extract(['µg/mL', 'mg/L', 'mm', 'nmol mg h', 'SI', '%', 'fold', 'xyz'], CAST(l_partkey % 8 AS INT) + 1) AS unit, count(*) AS n FROM lineitem GROUP BY ALL""")
def q_unit_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(*map(F.lit, _UNITS)), (F.col("l_partkey") % 8).cast("int") + 1)
    return table(spark, sf_dir, "lineitem").groupBy(metrics.unit(raw).alias("unit")).agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'), m AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view')
SELECT a.event_id, m.event_id AS mention_id FROM a ASOF JOIN m ON a.user_id = m.user_id AND a.ts > m.ts""")
def q_last_mention_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one sort per user carries the last mention forward: no range join
    last = F.last(F.when(F.col("event_type") == "view", F.col("event_id")), True).over(Window.partitionBy("user_id").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1))
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "view"))
    return e.withColumn("mention_id", last).where("event_type = 'purchase' and mention_id is not null").select("event_id", "mention_id")


@query("""SELECT a.event_id, min(b.event_type) AS event_type FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts < a.ts WHERE a.event_type = 'error' AND b.event_type IN ('signup', 'view', 'click') GROUP BY a.event_id HAVING count(DISTINCT b.event_type) = 1""")
def q_unique_preceding(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.collect_set(F.when(F.col("event_type").isin("signup", "view", "click"), F.col("event_type"))).over(Window.partitionBy("user_id").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1))
    e = table(spark, sf_dir, "events").withColumn("k", kinds).where((F.col("event_type") == "error") & (F.size("k") == 1))
    return e.select("event_id", F.col("k")[0].alias("event_type"))


@query("SELECT o_custkey, arg_max(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) AS o_orderkey, arg_max(o_orderstatus, {'d': o_orderdate, 'k': o_orderkey}) AS o_orderstatus FROM orders GROUP BY o_custkey")
def q_last_wins_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("ord", F.struct("o_orderdate", "o_orderkey"))
    return ops.last_by(o, "o_custkey", "ord", "o_orderkey", "o_orderstatus")


@query(f"""WITH g AS (SELECT l_suppkey, p_brand AS symbol, p_type AS description, l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE lower(p_brand) = 'brand#11' AND NOT regexp_matches(lower(p_type), '{"|".join(BAD_GENE_WORDS)}'))
SELECT s_name AS organism, symbol, min(description) AS description, count(*) AS n FROM g JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name, symbol""")
def q_genotype(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where((F.lower("p_brand") == "brand#11") & ~F.lower("p_type").rlike(text.any_of(BAD_GENE_WORDS)))
    supplier = ops.lookup(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("organism")))
    hits = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").join(ops.lookup(part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("symbol"), F.col("p_type").alias("description"))), "l_partkey").join(supplier, "l_suppkey")
    return hits.groupBy("organism", "symbol").agg(F.min("description").alias("description"), F.count("*").alias("n"))


@query("""WITH g AS (SELECT l_orderkey, 'g' || CAST(l_partkey % 12 AS VARCHAR) AS gene FROM lineitem)
SELECT l_orderkey, string_agg(DISTINCT gene, ', ' ORDER BY gene) AS genes, count(DISTINCT gene) AS n, CASE WHEN count(DISTINCT gene) = 4 THEN 'High' ELSE 'Low' END AS confidence FROM g GROUP BY l_orderkey""")
def q_panel_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("Genome Accession"), F.concat(F.lit("g"), (F.col("l_partkey") % 12).cast("string")).alias("Gene Symbol"))
    m = ops.merge_genes([rows], panel=4)
    return m.select(F.col("Genome Accession").alias("l_orderkey"), F.col("Gene Symbol").alias("genes"), F.col("Gene Count").cast("long").alias("n"), F.col("Confidence").alias("confidence"))


@query("""WITH l AS (SELECT o_orderkey AS line_no, unnest([CAST(o_orderkey % 150 AS VARCHAR), 'N/A', CAST(o_custkey % 150 AS VARCHAR)]) AS t, unnest([1, 2, 3]) AS i FROM orders), n AS (SELECT CAST(s_suppkey AS VARCHAR) AS t, s_name AS name FROM supplier)
SELECT line_no, 'q' || chr(9) || 's' || chr(9) || string_agg(t, ';' ORDER BY i) || chr(9) || string_agg(coalesce(name, 'N/A'), ';' ORDER BY i) || chr(9) || 'e' AS value FROM l LEFT JOIN n USING (t) GROUP BY line_no""")
def q_id_list_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.concat((F.col("o_orderkey") % 150).cast("string"), F.lit(";N/A;"), (F.col("o_custkey") % 150).cast("string"))
    lines = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line_no"), F.concat(F.lit("q\ts\t"), ids, F.lit("\tN/A\te")).alias("value"))
    return ops.repair_names(lines, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("tax_id"), F.col("s_name").alias("name")))


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def q_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.first_by(table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h")), ["h"], "doc_id").drop("h")


@query("SELECT DISTINCT lang, source FROM documents")
def q_dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("lang", "source").distinct()


@query("SELECT o_orderkey AS id, o_orderstatus AS status, NULL::VARCHAR AS kind FROM orders UNION ALL BY NAME SELECT event_type AS kind, event_id AS id FROM events")
def q_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    # the union that ops.merge_evidence begins with
    return a.unionByName(table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), F.col("event_id").alias("id")), allowMissingColumns=True)


@query("SELECT doc_id, 'todo' AS state FROM documents ANTI JOIN labels USING (doc_id) UNION ALL SELECT doc_id, 'cached' FROM labels SEMI JOIN documents USING (doc_id)")
def q_resume_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo, done = ops.resume_split(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    return todo.select("doc_id", F.lit("todo").alias("state")).unionAll(done.select("doc_id", F.lit("cached").alias("state")))


@query("""SELECT doc_id, coalesce(CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN quality = 1 THEN 'good' END, '') AS value, CASE WHEN toxic = 1 THEN 'reported' WHEN quality = 1 THEN 'lookup' ELSE '' END AS origin FROM documents LEFT JOIN labels USING (doc_id)""")
def q_fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    first, second = F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("quality") == 1, "good")
    return d.select("doc_id", F.coalesce(first, second, F.lit("")).alias("value"), F.when(first.isNotNull(), "reported").when(second.isNotNull(), "lookup").otherwise("").alias("origin"))


@query("SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders QUALIFY place <= 100")
def q_topn_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = table(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(100)  # the feature: the newest N
    return top.select("o_orderkey", "o_custkey", F.row_number().over(Window.orderBy(F.desc("o_orderdate"), "o_orderkey")).cast("long").alias("place"))


@query("SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, regexp_matches(lower(html), 'result|method|experimental|availability|accession') AS wanted FROM pages")
def q_section_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"), F.lower("html").rlike("result|method|experimental|availability|accession").alias("wanted"))


@query(f"SELECT count(*) AS n_rows, count(DISTINCT organism) AS n_organisms, count(DISTINCT doc_id) AS n_articles FROM ({SYNTH_SQL})")
def q_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.summary(synth(spark, sf_dir).withColumnRenamed("doc_id", "pmid"))


@query("SELECT o_orderkey, year(o_orderdate) AS pub_year FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996")
def q_year_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").where(y.between(1994, 1996)).select("o_orderkey", y.cast("long").alias("pub_year"))


@query("SELECT page_id, TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS INT) AS n, coalesce(TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS INT) BETWEEN 1900 AND 2100, false) AS year_like FROM pages")
def q_year_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.regexp_extract("url", "/([0-9]+)", 1).try_cast("int")
    return table(spark, sf_dir, "pages").select("page_id", n.alias("n"), F.coalesce(n.between(1900, 2100), F.lit(False)).alias("year_like"))


