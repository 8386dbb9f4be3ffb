"""Measured values in sentences: extraction by distance, parsing, units."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicons import APPROXIMATE, UNIT_CONTEXT, UNITS, Phenotype
from . import plain
from .text import significant, stripped

NUMBER = r"(\d+(?:\.\d+)?)"
METRIC = "struct<raw:string,value:double,value_min:double,value_max:double,unit:string>"
MEASURE = pa.struct([("n", pa.int32()), ("value", pa.float64()), ("value_min", pa.float64()), ("value_max", pa.float64()), ("unit", pa.string())])


def expand_powers(values: Column) -> Column:
    """plain_numbers of each string of an array: a callback substitution, which Catalyst has no expression for. Values that cannot be written out become null."""

    @F.arrow_udf("array<string>")
    def run(lists: pa.Array) -> pa.Array:
        def one(v: str | None) -> str | None:
            try:
                return None if v is None else plain.plain_numbers(v)
            except (ValueError, OverflowError):
                return None

        return pa.array([None if x is None else [one(v) for v in x] for x in lists.to_pylist()], pa.list_(pa.string()))

    return run(values)


def unit(raw: Column) -> Column:
    """The display form of a unit: context words and exponents of -1 go, then a table."""
    u = F.lower(stripped(F.regexp_replace(stripped(F.regexp_replace(raw, f"(?iU){UNIT_CONTEXT}", "")), r"(?U)[-−]\s*1", "")))
    table = F.create_map(*(F.lit(x) for kv in UNITS.items() for x in kv))
    return F.coalesce(F.try_element_at(table, u), F.when(u != "", u).otherwise(stripped(raw)))


def prepared(raw: Column) -> Column:
    """raw without its index prefix and approximate qualifier, before powers are expanded."""
    return stripped(F.regexp_replace(F.regexp_replace(stripped(raw), r"(?iU)^(?:SI|PSI|index)\s*(?:=|of|:)\s*", ""), f"(?iU){APPROXIMATE}", ""))


def parsed(raw: Column, cleaned: Column) -> Column:
    """METRIC struct of a value: centre ± error, else the middle of a range, else a single number; null for years and where there is no number."""
    index = raw.rlike(r"(?iU)^\s*(?:SI|PSI|index)\s*(?:=|of|:)\s*")

    def number(pattern: str, group: int) -> Column:
        return significant(F.regexp_extract(cleaned, pattern, group).try_cast("double"))

    def rest(pattern: str) -> Column:
        tail = stripped(F.regexp_replace(stripped(F.regexp_extract(cleaned, f"(?Us){pattern}(.*)$", len(re.findall(r"\((?!\?)", pattern)) + 1)), "^/+", ""))
        u = unit(tail)
        return F.when(u != "", u).when(index, "SI").otherwise("")

    def metric(value: Column, low: Column, high: Column, u: Column) -> Column:
        return F.struct(raw.alias("raw"), value.alias("value"), low.alias("value_min"), high.alias("value_max"), u.alias("unit")).cast(METRIC)

    year = lambda x: x.between(1900, 2100)
    error, span, none = rf"{NUMBER}\s*±\s*{NUMBER}", rf"{NUMBER}\s*[-–]\s*{NUMBER}", F.lit(None).cast(METRIC)
    a, b = number(error, 1), number(error, 2)
    low, high = number(span, 1), number(span, 2)
    one = number(NUMBER, 1)
    return (
        F.when(cleaned.rlike(error), F.when(year(a), none).otherwise(metric(a, significant(a - b), significant(a + b), rest(error))))
        .when(cleaned.rlike(span), F.when(year(low) | year(high), none).otherwise(metric(significant((low + high) / 2), low, high, rest(span))))
        .when(cleaned.rlike(NUMBER), F.when(year(one), none).otherwise(metric(one, F.lit(None), F.lit(None), rest(NUMBER))))
    )


def measure(sentence: Column, p: Phenotype) -> Column:
    """Struct of a sentence: n, its distinct values of the phenotype, and value, value_min, value_max and unit of the one nearest to the phenotype's terms."""

    @F.arrow_udf("struct<n:int,value:double,value_min:double,value_max:double,unit:string>")
    def run(sentences: pa.Array) -> pa.Array:
        found = [plain.candidates(plain.plain_low(x or ""), p) for x in sentences.to_pylist()]
        rows = [(len(set(v)), *((plain.measured(v[0]) if v else None) or (None,) * 4)) for v in found]
        return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], field.type) for k, field in enumerate(MEASURE)], fields=list(MEASURE))

    return run(sentence)
