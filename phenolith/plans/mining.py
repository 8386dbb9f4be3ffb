"""Mining: articles -> evidence, one row per article and organism."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import evidence as ev
from ..functions import plain
from ..lexicons import EVIDENCE_COLUMNS, GENERA, KEYWORDS, Phenotype, phenotype
from ..operators.tables import spread

#: A row of evidence_rows(): what an article says of an organism.
PICK = "measured int, score int, first int, sent string, label string, metric string, value double, unit string, range string"
LEND = "ix int, lend_label string, lend_sent string"
REPORTED = "kind int, pos int, accession string"
_TYPES = {"int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}


@dataclass(frozen=True)
class Options:
    """What a run looks for. Without a category it is detected from the query."""

    query: str
    category: str | None = None
    max_articles: int | None = 100
    min_score: int = 5
    strict_metric: bool = False
    negative_evidence: bool = False
    verify_taxonomy: bool = False
    discover_genera: bool = False
    year_from: int | None = None
    year_to: int | None = None
    skip_genome: bool = False
    phenotype: Phenotype = field(init=False)

    def __post_init__(self):
        if self.discover_genera and not self.verify_taxonomy:
            raise ValueError("discover_genera needs verify_taxonomy")
        if self.year_from and self.year_to and self.year_from > self.year_to:
            raise ValueError("year_from is after year_to")
        if self.max_articles is not None and self.max_articles < 1:
            raise ValueError("max_articles must be at least 1")
        object.__setattr__(self, "phenotype", phenotype(self.query, self.category if self.category in KEYWORDS else None))


def chosen(articles: DataFrame, o: Options) -> DataFrame:
    """The articles of the years asked for, of them the newest max_articles (None: all); pmid decides ties."""
    rows, year = articles, F.col("pub_year").try_cast("int")
    if o.year_from or o.year_to:
        rows = rows.where(year.between(o.year_from or 1800, o.year_to or 3000))
    return rows.orderBy(year.desc_nulls_last(), "pmid").limit(o.max_articles) if o.max_articles else rows


def select_articles(articles: DataFrame, o: Options) -> DataFrame:
    """The search: chosen() of the articles with the query in title or text, about bacteria."""
    body = F.lower(F.concat_ws(" ", "title", "text"))
    return chosen(articles.where(F.contains(body, F.lit(o.query.lower())) & F.contains(body, F.lit("bacteria"))), o)


def _rows(schema: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _group(of: str, **renamed: str) -> Column:
    """A struct of columns, null where the first of them is."""
    names = [c.split()[0] for c in of.split(", ")]
    return F.when(F.col(names[0]).isNotNull(), F.struct(*(F.col(n).alias(renamed.get(n, n)) for n in names)))


def evidence_rows(articles: DataFrame, o: Options) -> DataFrame:
    """What each article (pmid, text, and full_text if there is any) says of each organism: its best sentence, one to borrow an assay from, the accession it reports, and whether any sentence speaks for the organism."""
    full = F.col("full_text") if "full_text" in articles.columns else F.lit(None).cast("string")
    body = F.concat(F.coalesce("text", F.lit("")), F.when(F.coalesce(full, F.lit("")) != "", F.concat(F.lit(" "), full)).otherwise(""))
    columns = f"pmid string, organism string, {PICK}, {LEND}, {REPORTED}, positive boolean"
    schema, p, unlisted, negative = _rows(columns), o.phenotype, o.discover_genera, o.negative_evidence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for pmid, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for organism, (pick, lend, reported, positive) in plain.article(plain.normalised(raw), p, unlisted, negative).items():
                    if pick:
                        *pick, value = pick
                        amount, low, high, unit = value or (None,) * 4
                        pick = (*pick, amount, unit, None if low is None else f"{low:g} – {high:g}")
                    rows.append((pmid, organism, *(pick or (None,) * 9), *(lend or (None,) * 3), *(reported or (None,) * 3), positive))
            yield _batch(rows, schema)

    return articles.where("pmid is not null").select("pmid", body.alias("body")).mapInArrow(run, columns)


def best(rows: DataFrame) -> DataFrame:
    """(pmid, organism) with pick, the best sentence (measured ones first, the first of equal scores), lend, reported and positive; a pmid of several articles counts as one."""
    s = rows.repartition("pmid").select("pmid", "organism", _group(PICK).alias("pick"), _group(LEND, lend_label="label", lend_sent="sent").alias("lend"), _group(REPORTED).alias("reported"), "positive")
    return s.groupBy("pmid", "organism").agg(F.max("pick").alias("pick"), F.min("lend").alias("lend"), F.min("reported").alias("reported"), F.bool_or("positive").alias("positive"))


def reported_accessions(rows: DataFrame) -> DataFrame:
    """(pmid, organism, accession) of rows (pmid, body, names): each genome accession named in a genome context goes to the organism mentioned last before it; the first of an organism holds, by kind and then place. Ties of position go to the first name."""
    columns = f"pmid string, organism string, {REPORTED}"
    schema = _rows(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([(pmid, n, *a) for pmid, body, names in zip(*(c.to_pylist() for c in batch.columns), strict=True) for n, a in plain.accessions(body or "", names or []).items()], schema)

    found = rows.select("pmid", "body", "names").mapInArrow(run, columns)
    return found.groupBy("pmid", "organism").agg(F.min(F.struct("kind", "pos", "accession")).alias("a")).select("pmid", "organism", "a.accession")


def mine(articles: DataFrame, o: Options, taxonomy: DataFrame | None = None, assemblies: DataFrame | None = None) -> DataFrame:
    """Evidence rows of chosen() articles, in their fixed columns.

    taxonomy: (name, tax_id, superkingdom), needed to verify names; assemblies: (organism, accession),
    looked up where the article reports none. An article is worked through once, where it is read; what
    it says of each organism is shuffled once, by pmid, which the join with the articles' columns needs too.
    """
    articles = chosen(articles, o)
    b = best(evidence_rows(spread(articles), o))
    none = F.lit(None)
    if o.negative_evidence:
        b = b.where(~F.col("positive"))
    elif o.strict_metric:
        b = b.where("pick.measured = 1")
    b = b.where(F.col("pick.score") >= o.min_score)
    borrowed = F.lit(not o.negative_evidence) & (F.col("pick.measured") == 1) & (F.col("pick.label") == plain.NOT_STATED) & F.col("lend").isNotNull()
    label = F.when(borrowed, F.concat(F.regexp_replace("lend.label", r" \(Reported\)$", ""), F.lit(" (Inferred)"))).otherwise(F.col("pick.label"))
    told = F.when(borrowed & (F.col("lend.sent") != F.col("pick.sent")), F.concat(F.lit("[RESULT]: "), "pick.sent", F.lit(" ... [METHOD CONTEXT]: "), "lend.sent")).otherwise(F.col("pick.sent"))
    b = b.withColumns({"label": label, "told": told, "accession": F.col("reported.accession")})
    if o.verify_taxonomy:
        listed = F.split("organism", " ")[0].isin(GENERA) | F.lit(not o.discover_genera)
        known = taxonomy.groupBy(F.col("name").alias("organism")).agg(F.min(F.struct("tax_id", "superkingdom")).alias("t"))
        b = b.join(known, "organism").where(listed | F.col("t.superkingdom").isin("Bacteria", "Archaea")).withColumn("taxonomy_id", F.col("t.tax_id")).drop("t")
    else:
        b = b.withColumn("taxonomy_id", F.lit(""))
    looked_up = none.cast("string")
    if assemblies is not None and not o.skip_genome:
        b = b.join(assemblies.groupBy("organism").agg(F.min("accession").alias("by_name")), "organism", "left")
        looked_up = F.col("by_name")
    source = F.when(F.col("accession").isNotNull(), "Reported in Paper").when(F.coalesce(looked_up, F.lit("")) != "", "NCBI Lookup").otherwise("")
    b = b.join(articles.select("pmid", "pmc_id", "pub_year", "title"), "pmid")
    columns: dict[str, Column] = {
        "pmc_id": F.coalesce(F.nullif("pmc_id", F.lit("")), F.lit("N/A")), "pub_year": F.coalesce("pub_year", F.lit("")), "phenotype": F.lit(o.query), "phenotype_status": F.lit("Negative" if o.negative_evidence else "Positive"),
        "confidence": ev.tier(F.col("pick.score")), "performance_value": F.col("pick.value"), "performance_unit": F.coalesce("pick.unit", F.lit("")), "performance_range": F.coalesce("pick.range", F.lit("")), "performance_metric": F.coalesce("pick.metric", F.lit("N/A")),
        "performance_method": F.col("label"), "performance_evidence_sentence": F.col("told"), "genome_accession": F.coalesce("accession", looked_up, F.lit("")), "genome_source": source, "evidence_score": F.col("pick.score"),
    }
    return b.withColumns(columns).select(*EVIDENCE_COLUMNS)


def preview(rows: DataFrame, n: int = 5) -> DataFrame:
    """The first n of ordered() rows, with their place."""
    top = ordered(rows).limit(n)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*evidence_order())))


def evidence_order() -> list[Column]:
    return [F.desc_nulls_last("performance_value"), F.desc_nulls_last("evidence_score"), F.col("pub_year").try_cast("double").desc_nulls_last(), F.asc_nulls_last("organism"), F.col("pmid").asc()]


def ordered(rows: DataFrame) -> DataFrame:
    """By value, score and year (all descending), then organism; nulls last, pmid decides ties."""
    return rows.orderBy(*evidence_order())
