"""Evidence in one sentence: assays, negation, score."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lexicons import CLAUSE_ENDS, NEGATIONS, Phenotype
from . import plain
from .text import offsets

EVIDENCE = pa.struct([("label", pa.string()), ("n_methods", pa.int32()), ("n_verbs", pa.int32()), ("base", pa.int32()), ("is_weak", pa.bool_()), ("negated", pa.bool_()), ("confirmed", pa.bool_())])


def with_evidence(df: DataFrame, p: Phenotype, sentence: str = "sent") -> DataFrame:
    """df with label, n_methods, n_verbs, base, is_weak, negated and confirmed of a sentence.

    The assays are listed ones, else a generic one marked as reported, else none (n_methods 0).
    """

    @F.arrow_udf("struct<label:string,n_methods:int,n_verbs:int,base:int,is_weak:boolean,negated:boolean,confirmed:boolean>")
    def run(sentences: pa.Array) -> pa.Array:
        rows = [plain.evidence(x or "", p) for x in sentences.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], field.type) for k, field in enumerate(EVIDENCE, 1)], fields=list(EVIDENCE))

    return df.withColumn("_evidence", run(F.col(sentence))).select(*df.columns, *(f"_evidence.{field.name}" for field in EVIDENCE))


def strength() -> Column:
    """The score from the columns of with_evidence(), interference apart. Order of effects: weak context, then negation resets."""
    return F.when(F.col("negated"), 0).otherwise(F.col("base") - F.when(F.col("is_weak"), 11).otherwise(0))


def against() -> Column:
    """The score of a negative report, from the same columns."""
    return 5 + F.when(F.col("confirmed"), 2).otherwise(0) + F.when(F.col("n_methods") > 0, 2).otherwise(0)


def negated(low: Column, terms: Column) -> Column:
    """Whether a negation begins in a clause that also holds one of the phenotype's terms (their offsets)."""
    ends = offsets(low, CLAUSE_ENDS)
    clause = lambda at: F.size(F.filter(ends, lambda e: (e > 0) & (e <= at)))
    nots = F.flatten(F.array(*(offsets(low, n, "(?iU)") for n in NEGATIONS)))
    return (F.size(terms) > 0) & low.rlike("(?iU)" + "|".join(NEGATIONS)) & F.arrays_overlap(F.transform(nots, clause), F.transform(terms, clause))


def tier(score: Column) -> Column:
    return F.when(score >= 14, "Very High").when(score >= 9, "High").when(score >= 5, "Medium").otherwise("Low")
