"""Genotyping, merging, name repair and result caches, as DataFrame plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import any_of, stripped
from ..lexicons import BAD_GENE_WORDS, GENE_COLUMNS

#: Rows up to which a lookup table is sent to every executor; larger ones are joined by shuffle.
LOOKUP_ROWS = 200_000


def lookup(df: DataFrame, limit: int = LOOKUP_ROWS) -> DataFrame:
    """A lookup table of few columns, broadcast only if a count shows that it is small."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def spread(df: DataFrame) -> DataFrame:
    """df dealt over all cores if it comes in fewer partitions, for work that costs far more than the shuffle; large tables stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def last_by(df: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """One row per key: that of the greatest order (a later row overwrites an earlier one)."""
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(order)).alias("_last")).select(key, "_last.*")


def first_by(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key, by a grouped minimum with map-side combining, so that a key of very many rows is no hot group; null keys are equal to one another."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*(f"`{k}`" for k in keys)).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in rest)), F.struct(*order)).alias("_first"))
    return first.select(*(F.col(f"`{c}`") if c in keys else F.col(f"_first.`{c}`").alias(c) for c in df.columns))


def select_assemblies(assemblies: DataFrame, taxon: str = "Bacteria", level: str = "Reference") -> DataFrame:
    """The latest assemblies of a taxon (All: of any) and level: Reference, Annotated or Total."""
    rows = assemblies.where("is_latest")
    rows = rows if taxon == "All" else rows.where(F.col("superkingdom") == taxon)
    return {"Reference": rows.where("category = 'reference genome'"), "Annotated": rows.where("annotated"), "Total": rows}[level]


def gene_id(attribute: Column, plain: Column, uid: Column) -> Column:
    return F.coalesce(attribute, F.nullif(plain, F.lit("")), uid, F.lit(""))


def genotype(genes: DataFrame, assemblies: DataFrame, gene: str, taxon: str = "Bacteria", level: str = "Reference") -> DataFrame:
    """Genomes that have a gene: its symbol equals the name (a missing one counts as the name, for records found by their name), its
    description names no regulator, repressor, inhibitor or pseudogene, and its tax id has a selected
    assembly (of several the last). One row per accession, the first found, by organism name."""
    index = last_by(select_assemblies(assemblies, taxon, level).where("tax_id is not null").select("tax_id", "accession", "organism", "ord"), "tax_id", "ord", "accession", "organism")
    symbol, text = F.coalesce("symbol", F.lit(gene)), F.coalesce("description", F.lit(""))
    hits = genes.where(F.col("tax_id").isNotNull() & (F.lower(symbol) == gene.lower()) & ~F.lower(text).rlike(any_of(BAD_GENE_WORDS))).join(lookup(index), "tax_id")
    hits = hits.select(
        stripped(F.regexp_replace("organism", r"(?U)\s*\(.*?\)", "")).alias("Organism Name"), F.col("accession").alias("Genome Accession"), F.lit("Positive").alias("Genotype Status"),
        symbol.alias("Gene Symbol"), text.alias("Gene Description"), gene_id(F.col("attr_uid"), F.col("id"), F.col("uid")).alias("GeneID"), F.col("tax_id").alias("TaxID"), genes["ord"].alias("_ord"),
    )
    return first_by(hits, ["Genome Accession"], "_ord").drop("_ord").orderBy("Organism Name", "Genome Accession")


def merge_genes(tables: list[DataFrame], panel: int = 8) -> DataFrame:
    """One row per genome over tables with a `Genome Accession` column, others being left out: genes
    sorted and distinct, descriptions and ids in input order, and High confidence for exactly `panel`
    genes. Order is that of the tables and, in each, of `_row` (its row number) where it has one."""
    key = "Genome Accession"
    own = [t.withColumn("_table", F.lit(k)).withColumn("_row", F.col("_row") if "_row" in t.columns else F.monotonically_increasing_id()) for k, t in enumerate(tables) if key in t.columns]
    if not own:
        raise ValueError("no table has a Genome Accession column")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), own)
    order = F.struct("_table", "_row")
    in_order = lambda c, by: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v"))))), lambda x: x["v"]), by)
    how = {
        "Gene Symbol": F.array_join(F.array_sort(F.collect_set("Gene Symbol")), ", ") if "Gene Symbol" in rows.columns else None,
        "Gene Description": in_order("Gene Description", " | ") if "Gene Description" in rows.columns else None,
        "GeneID": in_order("GeneID", ", ") if "GeneID" in rows.columns else None,
        **{c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)) for c in ("Organism Name", "Genotype Status", "TaxID") if c in rows.columns},
    }
    out = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*(v.alias(c) for c, v in how.items() if v is not None)).orderBy(key)
    if "Gene Symbol" in out.columns:
        n = F.size(F.filter(F.split("Gene Symbol", ","), lambda x: F.trim(x) != ""))
        out = out.withColumn("Gene Count", n).withColumn("Confidence", F.when(n == panel, "High").otherwise("Low"))
    return out.select([c for c in GENE_COLUMNS if c in out.columns])


def merge_evidence(tables: list[DataFrame], keys: tuple[str, ...] = ("pmid", "organism")) -> DataFrame:
    """Union by name, the first row of each key (all columns where a key is missing), best values first. Column names are compared without case and outer spaces. Rows are in the order of tables and, in each, of `_row` (its row number) where it has one."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (t.withColumn("_table", F.lit(k)).withColumn("_row", F.col("_row") if "_row" in t.columns else F.monotonically_increasing_id()) for k, t in enumerate(tables)))
    by_name = {c.strip().lower(): c for c in rows.columns}
    found = [by_name[k] for k in keys if k in by_name]
    rows = first_by(rows, found, "_table", "_row").drop("_table", "_row") if len(found) == len(keys) else rows.drop("_table", "_row").distinct()
    value = by_name.get("performance_value")
    return rows.orderBy(F.col(f"`{value}`").try_cast("double").desc_nulls_last(), *found) if value else rows


def merge_counts(tables: list[DataFrame], merged: DataFrame) -> DataFrame:
    """(rows_before, rows_after) of a merge."""
    before = reduce(lambda a, b: a.unionAll(b), (t.select(F.lit(1)) for t in tables)).agg(F.count("*").alias("rows_before"))
    return before.crossJoin(merged.agg(F.count("*").alias("rows_after")))  # a row each


def tax_ids(lines: DataFrame, id_col: int = 2) -> DataFrame:
    """Distinct tax ids in `;` lists of tab-separated lines; comments, blank and short lines have none."""
    parts = F.split("value", "\t", -1)
    data = ~F.startswith("value", F.lit("#")) & (stripped(F.col("value")) != "") & (F.size(parts) > id_col)
    ids = F.explode(F.split(F.try_element_at(parts, F.lit(id_col + 1)), ";")).alias("t")
    return lines.where(data).select(ids).select(stripped(F.col("t")).alias("tax_id")).where("tax_id not in ('', 'N/A')").distinct()


def repair_names(lines: DataFrame, taxonomy: DataFrame, id_col: int = 2, name_col: int = 3) -> DataFrame:
    """(line_no, value) with the names of column name_col looked up from the tax ids in id_col, N/A where unknown; comments, blank and short lines pass.

    Ids are looked up once each; names go back to their lines by one join and one ordered aggregation.
    """
    parts = F.split("value", "\t", -1)
    fixable = ~F.startswith("value", F.lit("#")) & (stripped(F.col("value")) != "") & (F.size(parts) > name_col)
    names = taxonomy.where("tax_id is not null").groupBy("tax_id").agg(F.min("name").alias("name"))
    asked = lines.where(fixable).select("line_no", F.posexplode(F.split(F.try_element_at(parts, F.lit(id_col + 1)), ";")).alias("i", "t")).withColumn("tax_id", stripped(F.col("t")))
    told = asked.join(lookup(names), "tax_id", "left").groupBy("line_no").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("name", F.lit("N/A")).alias("name")))).alias("n"))
    fixed = F.array_join(F.concat(F.slice(parts, 1, name_col), F.array(F.array_join(F.transform("n", lambda x: x["name"]), ";")), F.slice(parts, name_col + 2, F.greatest(F.size(parts), F.lit(name_col + 2)))), "\t")
    return lines.join(told, "line_no", "left").select("line_no", F.when(F.col("n").isNotNull(), fixed).otherwise(F.col("value")).alias("value"))


def resume_split(articles: DataFrame, cache: DataFrame, key: str = "pmid") -> tuple[DataFrame, DataFrame]:
    """Articles still to be mined, and cache rows of those already mined."""
    return articles.join(cache.select(key).distinct(), key, "left_anti"), cache.join(articles.select(key).distinct(), key, "left_semi")


def summary(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct("organism").alias("n_organisms"), F.count_distinct("pmid").alias("n_articles"))
