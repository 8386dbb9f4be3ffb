"""The steps on Python strings against Spark's expressions, and the plans that run them."""

import random

from pyspark.sql import functions as F

from phenolith.functions import plain
from phenolith.lexicons import phenotype
from phenolith.plans import mining

IAA = phenotype("IAA production")
ARTICLES = "pmid string, pmc_id string, title string, text string, pub_year string"
SAID = "Pantoea agglomerans produced 40 mg/L IAA, confirmed by Salkowski assay."
DENIED = "Pantoea agglomerans did not produce IAA."


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_mine_works_an_article_through_once(spark):
    text = plan(mining.mine(spark.createDataFrame([("1", None, "t", SAID, "2020")], ARTICLES), mining.Options("IAA production", max_articles=None)))
    assert text.count("MapInArrow") == 1 and "regexp_extract_all" not in text and "explode" not in text


def test_negative_mode_is_one_pass_and_a_pmid_of_two_articles_counts_as_one(spark):
    rows = [("1", None, "a", SAID, "2020"), ("1", None, "b", DENIED, "2021"), ("2", None, "c", DENIED, "2020"), (None, None, "d", DENIED, "2020")]
    found = mining.mine(spark.createDataFrame(rows, ARTICLES), mining.Options("IAA production", negative_evidence=True))
    assert plan(found).count("MapInArrow") == 1
    assert [(r["pmid"], r["organism"], r["title"], r["evidence_score"], r["performance_metric"]) for r in found.collect()] == [("2", "Pantoea agglomerans", "c", 5, "N/A")]


def test_preview_works_an_article_through_once(spark):
    rows = [(str(k), None, "t", SAID.replace("40", str(k + 1)), "2020") for k in range(30)]
    top = mining.preview(mining.mine(spark.createDataFrame(rows, ARTICLES), mining.Options("IAA production", max_articles=None)), 3)
    assert plan(top).count("MapInArrow") == 1 and "regexp_extract_all" not in plan(top)
    assert [(r["place"], r["pmid"], r["performance_value"]) for r in top.orderBy("place").collect()] == [(1, "29", 30.0), (2, "28", 29.0), (3, "27", 28.0)]


def test_measures_are_taken_in_one_pass(spark):
    from phenolith.functions import metrics

    said = ["X made 1,500 ± 3 mg/L IAA and 7 ppm zinc", "IAA 0.15 ppm", "IAA 2015 ppm", "auxin 10-20 µg/mL, 10-20 µg/mL", "none", "", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(said)], "k int, t string").select("k", metrics.measure(F.col("t"), IAA).alias("m"))
    assert "regexp" not in plan(df)
    none = (None,) * 4
    assert [(*r["m"],) for r in df.orderBy("k").collect()] == [(1, 1500.0, 1497.0, 1503.0, "mg/L"), (1, 0.15, None, None, "ppm"), (1, *none), (1, 15.0, 10.0, 20.0, "µg/mL"), (0, *none), (0, *none), (0, *none)]


def test_evidence_is_one_pass_and_negation_is_that_of_the_expressions(spark):
    from phenolith.functions import evidence, text

    r = random.Random(3)
    bits = ["X", "did not produce", "IAA", "auxin", ",", "but", "whereas", "however", "failed to", "no clear activity", "lacked", "nonproducing", "ſhow", "cafés", "it was not able to fix", "±", "undetectable", ";", "é", "indole"]
    said = [" ".join(r.choice(bits) for _ in range(r.randint(1, 9))) for _ in range(300)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(said)], "k int, sent string")
    told = evidence.with_evidence(df, IAA)
    assert "regexp" not in plan(told.select("negated"))
    got = [r["negated"] for r in told.orderBy("k").collect()]
    low = F.lower("sent")
    want = [r["x"] for r in df.select("k", evidence.negated(low, text.term_offsets(low, IAA.terms)).alias("x")).orderBy("k").collect()]
    assert got == want and any(got) and not all(got)


def test_score_comes_with_its_verbs(spark):
    from phenolith.functions import evidence

    df = spark.createDataFrame([("It produced and secreted IAA, biosynthesis confirmed",), ("reproduced",), (None,)], "sent string")
    told = evidence.with_evidence(df, IAA).select("n_verbs", "base", evidence.strength().alias("score"))
    assert "regexp" not in plan(told) and sorted(map(tuple, told.collect())) == [(0, 0, 0), (0, 0, 0), (3, 8, 8)]


def test_interference_pairs_organisms_without_a_join(spark):
    import __spark_entry__ as e

    text = plan(e.queries()["q_interference"](spark, "/root/testdata/sf0.001"))
    assert "Join" not in text and text.index("regexp_instr") < text.index("Generate")


def test_best_sentence_scores_in_one_pass(spark):
    import __spark_entry__ as e

    text = plan(e.queries()["q_best_sentence"](spark, "/root/testdata/sf0.001"))
    assert text.count("ArrowEvalPython") == 1 and "regexp" not in text and "RLIKE" not in text


def test_nearest_value_is_found_in_one_pass(spark):
    import __spark_entry__ as e

    text = plan(e.queries()["q_metric_nearest"](spark, "/root/testdata/sf0.001"))
    assert text.count("ArrowEvalPython") == 1 and "regexp" not in text


def test_reported_accessions_are_one_pass(spark):
    from phenolith.functions import organisms

    body = "The genome of Bacillus cereus is PRJNA12 and GCF_000000001.1. See GCF_000000009.1, deposited for B. cereus and Pantoea agglomerans as AB12345.1"
    found = mining.reported_accessions(organisms.with_candidates(spark.createDataFrame([("1", body), ("2", None)], "pmid string, body string"), "body", "names"))
    assert "regexp" not in plan(found) and sorted(map(tuple, found.collect())) == [("1", "Bacillus cereus", "GCF_000000001.1"), ("1", "Pantoea agglomerans", "AB12345.1")]
