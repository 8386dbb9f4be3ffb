"""Readers of article XML, tables and tab-separated search hits."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..lexicons import SECTION_WORDS

ARTICLE = "pmid string, pmc_id string, title string, text string, pub_year string"
_YEAR = re.compile(r"(?:19|20)[0-9]{2}")
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parse(xml: bytes | None) -> ET.Element | None:
    """The root of a document, None where it does not parse. Prefixes are part of names, and nothing outside the document is read."""
    if xml is None:
        return None
    parser, tree = expat.ParserCreate("utf-8"), ET.TreeBuilder()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = tree.start, tree.end, tree.data
    try:
        parser.Parse(xml, True)
    except expat.ExpatError:
        return None
    return tree.close()


def _all(found: ET.Element | None) -> str:
    """All text in an element, "" without one."""
    return "" if found is None else "".join(found.itertext())


def publication_year(root: ET.Element) -> str:
    """Year of the issue, else the first year in its free-text date, else that of the electronic article, else ""."""
    first = lambda path: _all(next((x for a in root.iter("Article") for x in a.iterfind(path)), None))
    year = first("Journal/JournalIssue/PubDate/Year")
    if not year and (m := _YEAR.search(first("Journal/JournalIssue/PubDate/MedlineDate"))):
        year = m[0]
    return year or first("ArticleDate/Year")


def article(root: ET.Element) -> tuple[str, str | None, str, str, str]:
    """The columns of ARTICLE; an element's text is what stands before its first child element."""
    title = next(root.iter("ArticleTitle"), None)
    title = (title is not None and title.text) or ""
    pmc = next((x for x in root.iter("ArticleId") if x.get("IdType") == "pmc"), None)
    abstract = " ".join(x.text for x in root.iter("AbstractText") if x.text)
    return _all(next(root.iter("PMID"), None)), _all(pmc) or None, title, f"{title}. {abstract}", publication_year(root)


def full_text(root: ET.Element) -> str:
    """The wanted sections, each a marker and then all its paragraphs."""
    out = []
    for sec in root.iter("sec"):
        title = _all(sec.find("title")).translate(_SMALL)
        if any(w in title for w in SECTION_WORDS):
            out.append(f"--- SECTION: {next((t.text for t in sec.iterfind('title') if t.text), '')} ---")
            out += [p.text for p in sec.iter("p") if p.text]
    return "\n".join(out)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[ET.Element], pa.RecordBatch]]:
    """The documents of the first column that parse, and their rows: a document is parsed once."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            roots = [parse(x) for x in part.column(0).cast(pa.binary()).to_pylist()]
            fine = [r is not None for r in roots]
            yield [r for r in roots if r is not None], part.filter(pa.array(fine, pa.bool_()))


def parse_articles(rows: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One PubmedArticle document per row -> (pmid, pmc_id, title, text, pub_year); abstracts are joined by spaces and follow the title. Documents that do not parse are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ARTICLE.split(", ")]
        for roots, _ in _documents(batches):
            found = [article(r) for r in roots]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in range(len(names))], names=names)

    return rows.select(xml_col).mapInArrow(run, ARTICLE)


def parse_full_texts(rows: DataFrame, xml_col: str = "xml", id_col: str = "pmc_id") -> DataFrame:
    """(pmc_id, xml) -> (pmc_id, full_text): the sections whose titles speak of results, methods, data or accessions, in document order, each a marker and then all its paragraphs; those of a wanted section inside another one are repeated with it. Documents that do not parse are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for roots, part in _documents(batches):
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array([full_text(r) for r in roots], pa.string())], names=[id_col, "full_text"])

    return rows.select(xml_col, id_col).mapInArrow(run, StructType([rows.schema[id_col], StructField("full_text", StringType())]))


def read_csv_tables(spark: SparkSession, paths: list[str], needs: str | None = None, leave_out: str | None = None) -> list[DataFrame]:
    """A DataFrame of strings per CSV file, in order of path; quoted line ends and doubled quotes are kept. Files without the column `needs`, and the file `leave_out`, are skipped."""
    out = []
    for path in sorted(p for p in paths if p.rsplit("/", 1)[-1] != leave_out):
        df = spark.read.csv(path, header=True, multiLine=True, escape='"')
        if needs is None or needs in df.columns:
            out.append(df)
    return out


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of a text file; line_no increases in file order and is not consecutive."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value")
