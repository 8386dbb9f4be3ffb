"""Readers, writers and resumable mining on small files."""

import json

from pyspark.sql import functions as F

from phenolith.operators import tables as ops
from phenolith.plans.mining import Options, chosen, mine, ordered, preview
from phenolith.sources import readers, writers
from phenolith.streaming import resume

ARTICLES = "pmid string, pmc_id string, title string, text string, pub_year string"
SENTENCE = "Pantoea agglomerans produced 40 mg/L IAA, confirmed by Salkowski assay."


def test_csv_tables(spark, tmp_path):
    (tmp_path / "b.csv").write_text('Genome Accession,Note\nG1,"two\nlines, ""quoted"""\n')
    (tmp_path / "a.csv").write_text("Other\nx\n")
    (tmp_path / "merged.csv").write_text("Genome Accession\nG9\n")
    paths = [str(p) for p in tmp_path.iterdir()]
    got = readers.read_csv_tables(spark, paths, needs="Genome Accession", leave_out="merged.csv")
    assert [[tuple(r) for r in t.collect()] for t in got] == [[("G1", 'two\nlines, "quoted"')]]
    assert [t.columns for t in readers.read_csv_tables(spark, paths, leave_out="merged.csv")] == [["Other"], ["Genome Accession", "Note"]]


def test_lines_keep_their_order(spark, tmp_path):
    lines = ["# head", "", *(f"q{k}\ts\t{k}; {k + 1};N/A\tN/A" for k in range(40)), "short"]
    (tmp_path / "in.tsv").write_text("\n".join(lines) + "\n")
    read = readers.read_lines(spark, str(tmp_path / "in.tsv"))
    writers.save_lines(read, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text() for p in parts).splitlines() == lines
    assert {r["tax_id"] for r in ops.tax_ids(read).collect()} == {str(k) for k in range(41)}


def test_results_as_csv_and_json(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "b", c', None), ("2", "é\nf", 2.5)], "pmid string, sentence string, performance_value double")
    out = writers.save_results(df, str(tmp_path / "found.csv"), "both")
    assert [p.rsplit("/", 1)[1] for p in out] == ["found.csv", "found.json"]
    raw = next((tmp_path / "found.csv").glob("part-*")).read_bytes()
    assert raw.startswith("﻿pmid,".encode())
    again = spark.read.csv(out[0], header=True, multiLine=True, escape='"')
    assert [tuple(r)[:2] for r in again.orderBy("performance_value").collect()] == [("1", 'a "b", c'), ("2", "é\nf")]
    rows = [json.loads(x) for x in next((tmp_path / "found.json").glob("part-*")).read_text().splitlines()]
    assert rows[0] == {"pmid": "1", "sentence": 'a "b", c', "performance_value": None}
    assert not writers.save_if_any(df.limit(0), str(tmp_path / "none")) and not (tmp_path / "none").exists() and writers.save_if_any(df, str(tmp_path / "some"))
    assert writers.gene_file_name("All Bacteria", "a/b") == "GenoTy_All_Bacteria_a-b.csv"


def test_new_files_are_mined_once(spark, tmp_path):
    o = Options("IAA production", max_articles=1)
    rows = lambda *ids: spark.createDataFrame([(i, None, "t", SENTENCE, "2020") for i in ids], ARTICLES).coalesce(1)
    run = lambda: resume.mine_new_files(spark, f"{tmp_path}/in", ARTICLES, o, f"{tmp_path}/out", f"{tmp_path}/ck")
    found = lambda: sorted(r["pmid"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    rows("1", "2", "2").write.parquet(f"{tmp_path}/in")
    run()
    assert found() == ["1", "2"]
    run()  # nothing new
    rows("2", "3").write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert found() == ["1", "2", "3"]


def test_cache_files(spark, tmp_path):
    (tmp_path / "cache.json").write_text(json.dumps({"1": [{"organism": "X", "evidence_score": "5"}], "2": []}))
    (tmp_path / "broken.json").write_text("{")
    got = {r["pmid"]: r["rows"] for r in resume.import_cache(spark, str(tmp_path / "cache.json")).collect()}
    assert got == {"1": [{"organism": "X", "evidence_score": "5"}], "2": []}
    assert resume.import_cache(spark, str(tmp_path / "broken.json")).count() == 0


def test_sections_with_their_paragraphs(spark):
    inner = "<sec><title>Methods of more</title><p>c</p></sec>"
    xml = f"<article><sec><title>Results <i>x</i></title><p>a<i>b</i></p>{inner}</sec><sec><title>Other</title><p>no</p></sec><sec><p>no</p></sec></article>"
    rows = readers.parse_full_texts(spark.createDataFrame([("P", xml), ("Q", "<article/>"), ("R", "<x")], "pmc_id string, xml string")).collect()
    mark = "--- SECTION: {} ---".format
    assert {r["pmc_id"]: r["full_text"].split("\n") for r in rows} == {"P": [mark("Results "), "a", "c", mark("Methods of more"), "c"], "Q": [""]}


def test_options_choose_articles(spark):
    rows = [(str(k), None, "t", SENTENCE, y) for k, y in enumerate(["2019", "2021", None, "x", "2020", "2021"])]
    a = spark.createDataFrame(rows, ARTICLES)
    pick = lambda **k: [r["pmid"] for r in chosen(a, Options("IAA", **k)).collect()]
    assert pick(max_articles=3) == ["1", "5", "4"] and pick(max_articles=None, year_from=2020) == ["1", "4", "5"]
    found = mine(a, Options("IAA", max_articles=2))
    assert sorted(r["pmid"] for r in found.collect()) == ["1", "5"]
    assert [(r["pmid"], r["place"]) for r in preview(found, 1).collect()] == [("1", 1)] and [r["pmid"] for r in ordered(found).collect()] == ["1", "5"]


def test_merge_counts(spark):
    t = spark.range(3).select(F.lit("1").alias("pmid"), F.lit("o").alias("organism"))
    assert [tuple(r) for r in ops.merge_counts([t, t], ops.merge_evidence([t, t])).collect()] == [(6, 1)]


def test_a_document_is_parsed_once_and_one_with_two_roots_is_left_out(spark):
    from phenolith.sources import readers

    xml = "<PubmedArticle><PMID>5</PMID><Article><ArticleTitle>T</ArticleTitle><ArticleDate><Year>2019</Year></ArticleDate></Article></PubmedArticle>"
    rows = readers.parse_articles(spark.createDataFrame([(xml,), ("<a/><b/>",), ("<p:x/>",), ("",), (None,)], "xml string"))
    assert "xpath" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in rows.collect()] == [("5", None, "T", "T. ", "2019"), ("", None, "", ". ", "")]
