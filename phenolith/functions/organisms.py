"""Organism names: candidates, mentions, interference."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lexicons import GENERA, INVALID_SPECIES, PLANT_GENERA, STOP_WORDS
from . import plain

FULL = r"\b([A-Z][a-z]+)\s+([a-z0-9]+(?:[\.-][a-z0-9]+)?)\b"


def canonical(name: Column, unlisted: bool = False) -> Column:
    """`Genus species` of a name, or null: the genus is listed (or, with unlisted, looks like one) and the species is a word of letters that is no common word. A strain number after the species is cut."""
    words = F.split(F.regexp_replace(F.regexp_replace(name, r"^[.,;:()\[\]]+|[.,;:()\[\]]+$", ""), r"(?U)^\s+|\s+$", ""), r"(?U)\s+")
    genus, species = F.try_element_at(words, F.lit(1)), F.regexp_replace(F.lower(F.try_element_at(words, F.lit(2))), r"(?U)^([a-z]+)[.-]\d\w*$", "$1")
    fine = species.rlike(r"(?U)^\p{L}{3,}$") & ~species.isin(INVALID_SPECIES + STOP_WORDS)
    known = genus.isin(GENERA)
    if unlisted:
        known = known | (~genus.isin(PLANT_GENERA) & ~F.lower(genus).isin(STOP_WORDS) & genus.rlike(r"(?U)^.\p{Ll}{3,}$") & (F.length(species) >= 4))
    return F.when((F.size(words) >= 2) & fine & known, F.concat(genus, F.lit(" "), species))


def with_candidates(df: DataFrame, text: str, name: str, unlisted: bool = False) -> DataFrame:
    """df with the sorted distinct names in a text: full ones, and abbreviated ones whose initial has exactly one full genus before them."""

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else plain.names(x, unlisted) for x in texts.to_pylist()], pa.list_(pa.string()))

    return df.withColumn(name, run(F.col(text)))


def _parts(organism: Column) -> tuple[Column, Column]:
    """Lower-case genus, and the pattern of the abbreviated name. Names from canonical() hold letters only."""
    words = F.split(F.lower(organism), " ")
    return words[0], F.concat(F.substring(words[0], 1, 1), F.lit(r"\.\s*"), words[1])


def position(low: Column, organism: Column) -> Column:
    """Offset of the full name, else of the abbreviated one, else of the genus; -1 if none is there."""
    genus, short = _parts(organism)
    at = lambda n: F.when(n > 0, n - 1)
    return F.coalesce(at(F.instr(low, F.lower(organism))), at(F.regexp_instr(low, short)), F.instr(low, genus) - 1)


def interfered(low: Column, organism: Column, others: Column) -> Column:
    """Whether another genus stands at or before the organism in the sentence."""
    genus, own = _parts(organism)[0], position(low, organism)
    return (own >= 0) & F.exists(others, lambda o: (_parts(o)[0] != genus) & position(low, o).between(0, own))
