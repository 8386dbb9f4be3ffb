"""Text expressions: Column -> Column, all inside Catalyst.

Regular expressions carry (?U), so classes and case folding are Unicode's. Offsets count characters from 0.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicons import ABBREVIATIONS


def any_of(words: list[str]) -> str:
    """A pattern that finds any of the words as a substring."""
    return "|".join(re.escape(w) for w in words)


def found(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?iU){pattern}")


def stripped(text: Column) -> Column:
    """Without white space at both ends, tabs and line ends included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def matches(text: Column, pattern: Column | str, flags: str = "(?U)") -> Column:
    """array<struct<pos, m>> of all matches in order: gap and match lengths are added up."""
    p = F.lit(flags + pattern) if isinstance(pattern, str) else F.concat(F.lit(flags), pattern)
    pair = F.zip_with(F.split(text, p, -1), F.regexp_extract_all(text, p, F.lit(0)), lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    none = F.array().cast("array<struct<pos:int,m:string>>")

    def step(acc: Column, x: Column) -> Column:
        hit = F.struct((acc["at"] + F.length(x["g"])).alias("pos"), x["m"].alias("m"))
        return F.when(x["m"].isNull(), acc).otherwise(F.struct((acc["at"] + F.length(x["g"]) + F.length(x["m"])).alias("at"), F.concat(acc["out"], F.array(hit)).alias("out")))

    # most texts have no match: those cost one search
    return F.when(F.regexp_like(text, p), F.aggregate(pair, F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]).otherwise(none)


def offsets(text: Column, pattern: Column | str, flags: str = "(?U)") -> Column:
    return F.transform(matches(text, pattern, flags), lambda x: x["pos"])


def word_offsets(text: Column, word: str) -> Column:
    """Offsets of a literal word, looked for as a plain substring first."""
    return F.when(F.contains(text, F.lit(word)), offsets(text, re.escape(word))).otherwise(F.array().cast("array<int>"))


def term_offsets(text: Column, terms: list[str]) -> Column:
    """Offsets of each term in turn, as literal text."""
    return F.flatten(F.array(*(word_offsets(text, t) for t in terms))) if terms else F.array().cast("array<int>")


def sentences(text: Column) -> Column:
    """Split at one white-space character after . ? or !, but not after shapes like x.y. or Mr.; fragments after a known abbreviation, or after a single capital with a lower-case word next, are joined again."""
    parts = F.split(text, r"(?U)(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<=[.?!])\s", -1)

    def open_end(done: Column, nxt: Column) -> Column:
        last = F.regexp_extract(done, r"(?U)(\S+)\s*$", 1)
        initial = last.rlike(r"^[A-Z]\.$")
        return F.when(initial, nxt.rlike(r"(?U)^\s*[a-z]")).otherwise(F.lower(F.regexp_replace(last, r"\.+$", "")).isin(ABBREVIATIONS))

    def add(acc: Column, part: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(last, F.lit(" "), part)))
        return F.when((F.size(acc) > 0) & open_end(last, part), joined).otherwise(F.concat(acc, F.array(part)))

    return F.aggregate(parts, F.array().cast("array<string>"), add)


def significant(value: Column, digits: int = 4) -> Column:
    """value rounded half-even to significant digits; 0 stays 0."""
    factor = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(value))))
    return F.when(value == 0, F.lit(0.0)).otherwise(F.rint(value * factor) / factor)


def general_format(value: Column, digits: int = 6) -> Column:
    """A number as C's %.{digits}g writes it."""
    a = F.abs(value)
    scale = F.floor(F.log10(a)).cast("int")
    scale = scale + F.when(F.round(a / F.pow(F.lit(10.0), scale), digits - 1) >= 10, 1).otherwise(0)
    plain = F.array(*(F.format_number(value, d) for d in range(digits + 5)))
    text = F.replace(plain[F.greatest(F.lit(0), F.least(F.lit(digits + 4), digits - 1 - scale))], F.lit(","))
    trimmed = F.regexp_replace(text, r"(\.\d*?)0+$", "$1")
    trimmed = F.regexp_replace(trimmed, r"\.$", "")
    mantissa = F.regexp_replace(F.regexp_replace(F.format_number(value / F.pow(F.lit(10.0), scale), digits - 1), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    power = F.concat(mantissa, F.lit("e"), F.when(scale < 0, "-").otherwise("+"), F.lpad(F.abs(scale).cast("string"), 2, "0"))
    return F.when(value == 0, "0").when((scale < -4) | (scale >= digits), power).otherwise(trimmed)
