"""Language identification of web pages by Bayesian evidence fusion.

Text likelihoods of byte trigrams meet the declared markup language, the address suffix and a host
prior. How far a declaration or suffix is to be trusted is counted, not assumed: the text posteriors
of all pages are summed by declaration, by suffix, and by host and domain, and hosts are smoothed
toward their domain, domains toward the global shares. A page's own posterior is left out of the sums
that speak for it, so that its text counts once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches, small_side, trimmed, written

#: Labelled texts on which trigrams are counted: those of the smallest hashes of their ids.
SAMPLE = 4_000
BUCKETS, TEXT_WEIGHT, STRENGTH = 8192, 0.1, 20.0
#: What has no visible text, in the order in which it is removed: pattern, and the end that each match must have.
HIDDEN = [
    (re.compile(r"<!--.*?-->", re.S), re.compile(r"-->")),
    *((re.compile(rf"<{x}\b.*?</{x}\s*>", re.S | re.I), re.compile(rf"</{x}\s*>", re.I)) for x in ("script", "style")),
    (re.compile(r"<[^>]*>"), re.compile(">")),
]
ENTITY = re.compile(r"&\w{1,8};")


def visible(html: str) -> str:
    """The text outside comments, scripts, styles, tags and entities, in time linear in the page's length.

    Nothing is looked for beyond the last end of its kind, so each beginning that is tried has an end.
    """
    for hidden, end in HIDDEN:
        last = max((m.end() for m in end.finditer(html)), default=0)
        html = hidden.sub(" ", html[:last]) + html[last:]
    return ENTITY.sub(" ", html)


def trigram_counts(text: str) -> np.ndarray:
    b = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BUCKETS)
    return np.bincount((b[:-2] * 961 + b[1:-1] * 31 + b[2:]) * 2654435761 >> 7 & (BUCKETS - 1), minlength=BUCKETS).astype(float)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages in order, and smoothed log probabilities of trigram buckets by language, from `sample` rows of docs with text and language at most: of repeated ids one row counts, rows without an id are left out."""
    rows = docs.select(docs[id_col].alias("id"), docs[lang_col].cast("string").alias("l"), docs[text_col].cast("string").alias("t")).where("id is not null and l is not null and t is not null")
    ids = rows.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)  # ids alone meet in one task

    @lean
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                total[lang] = total.get(lang, 0) + trigram_counts(text.as_py())
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["l", "bucket", "n"])

    picked = rows.join(F.broadcast(ids), "id").groupBy("id").agg(F.min(F.struct("l", "t")).alias("r")).select("r.l", "r.t")
    sums = picked.mapInArrow(counts, "l string, bucket long, n double").groupBy("l", "bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS rows a language at most
    langs = sorted({r["l"] for r in sums}) or ["und"]
    table = np.full((len(langs), BUCKETS), 0.5)
    for r in sums:
        table[langs.index(r["l"]), r["bucket"]] += r["n"]
    return langs, np.log(table / table.sum(1, keepdims=True))


def text_log_likelihood(html: Column, langs: list[str], table: np.ndarray) -> Column:
    """Array of log likelihoods of the visible text by language, tempered since neighbouring trigrams overlap; zeros without text."""

    @F.arrow_udf("array<double>")
    def run(pages: pa.Array) -> pa.Array:
        found = pa.array([(table @ trigram_counts(visible(p.as_py() or "")) * TEXT_WEIGHT).tolist() for p in pages], pa.list_(pa.float64()))
        trimmed()
        return found

    return run(html.cast("string"))


def _softmax(a: Column) -> Column:
    top = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
    return F.transform(e, lambda x: x / total)


def _sums(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    """Posterior mass by language of each group, summed with map-side combining."""
    return rows.groupBy(*by).agg(F.array(*(F.sum(F.col("post")[k]) for k in range(n))).alias("mass"))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", strength: float = STRENGTH) -> DataFrame:
    """(id, host, declared, text_language, language, confidence): one row per row of pages.

    Null or missing urls and declarations are values of their own, the empty string. A page without
    text gets what the other evidence says. Languages are those of the labelled texts; of ties the
    first in order. Repeated rows count as pages of their own. An empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    langs, table = train(docs)
    url, html = F.coalesce(pages[url_col].cast("string"), F.lit("")), F.coalesce(pages[html_col].cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    # one search in the first html tag alone: its beginning is found by substring, so no page takes more than linear time
    begins = F.instr(F.lower(html), F.lit("<html"))
    tag = F.when(begins > 0, F.substring_index(F.substring(html, begins, F.length(html)), ">", 1)).otherwise("")
    declared = F.substring(F.lower(F.regexp_extract(tag, r"(?is)^<html\b.*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)), 1, 2)
    rows = pages.select(pages[id_col].cast("long").alias("id"), host.alias("host"), declared.alias("declared"), text_log_likelihood(html, langs, table).alias("ll"))
    rows = written(rows.withColumns({"suffix": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2), "post": _softmax(F.col("ll"))}), "langid")
    n = len(langs)
    whole = rows.agg(*(F.sum(F.col("post")[k]) for k in range(n))).first()
    mass = np.array([x or 0.0 for x in whole]) + 1e-9
    share = F.array(*(F.lit(float(x)) for x in mass / mass.sum()))
    by_lang, pages_all = F.array(*(F.lit(float(x)) for x in mass)), float(mass.sum())

    def others(m: str) -> Column:
        """Mass without the page's own."""
        return F.zip_with(m, "post", lambda x, own: F.greatest(x - own, F.lit(0.0)))

    def likelihood(m: Column) -> Column:
        """log P(value | language), smoothed toward the value's share of all pages."""
        return F.zip_with(m, by_lang, lambda x, c: F.log((x + strength * (_total(m) + 1) / pages_all) / (c + strength)))

    def shrunk(m: Column, prior: Column) -> Column:
        return F.zip_with(m, prior, lambda x, p: (x + strength * p) / (_total(m) + strength))

    said = _sums(rows, ["declared"], n).withColumnRenamed("mass", "m_declared")
    suffix = _sums(rows, ["suffix"], n).withColumnRenamed("mass", "m_suffix")
    hosts = written(_sums(rows, ["host", "domain"], n), "langid-hosts")
    domains = hosts.groupBy("domain").agg(F.array(*(F.sum(F.col("mass")[k]) for k in range(n))).alias("m_domain"))
    priors = hosts.join(domains, "domain").select("host", F.col("mass").alias("m_host"), "m_domain")
    found = rows
    for side, key in ((said, "declared"), (suffix, "suffix"), (priors, "host")):
        found = found.join(small_side(written(side, f"langid-{key}")), key)
    for m in ("m_declared", "m_suffix", "m_host", "m_domain"):
        found = found.withColumn(m, others(m))
    found = found.withColumn("p_domain", shrunk(F.col("m_domain"), share)).withColumn("p_host", F.transform(shrunk(F.col("m_host"), F.col("p_domain")), lambda p: F.log(p)))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = _softmax(add(add(F.col("ll"), likelihood(F.col("m_declared"))), add(likelihood(F.col("m_suffix")), F.col("p_host"))))
    names = F.array(*map(F.lit, langs))
    best = lambda a: names[(F.array_position(a, F.array_max(a)) - 1).cast("int")]
    return found.withColumn("fused", fused).select("id", "host", "declared", best(F.col("ll")).alias("text_language"), best(F.col("fused")).alias("language"), F.array_max("fused").alias("confidence"))
