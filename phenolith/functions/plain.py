"""Mining's steps on Python strings: what a worker runs over a batch of articles or sentences.

Spark interprets higher-order functions and goes through a text once a regular expression, so a sentence
costs hundreds of microseconds there. Classes (white space, word characters) are those of Java's (?U):
patterns run on shape(), a copy of the same length in which characters that Python classes otherwise
have stand-ins, and results are cut from the text itself.
"""

from __future__ import annotations

import math
import re
import unicodedata
from functools import cache, lru_cache

from ..lexicons import (
    ABBREVIATIONS, ACCESSIONS, APPROXIMATE, CLAUSE_ENDS, CLONING_HOSTS, CONFIRMATIONS, GENERA, GENERIC_STRAINS, GENOME_WORDS, INVALID_SPECIES, MOLECULAR, NEGATIONS, PLANT_GENERA, QUALIFIERS,
    STOP_WORDS, STRONG_VERBS, UNIT_CONTEXT, UNITS, WEAK_CONTEXTS, Phenotype,
)

NOT_STATED = "Not Explicitly Stated"
FAR = 9999
LINE_END = r"\n\r\x85\u2028\u2029"
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_RUN = re.compile(f"[{SPACES}]+")


class _Shape(dict):
    """Code point -> stand-in where Python's class is not Java's, worked out once a character."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = unicodedata.category(c)
        word = kind[0] in "LM" or kind in ("Nd", "Nl", "Pc") or code in (0x200C, 0x200D) or 0x24B6 <= code <= 0x24E9 or 0x1F130 <= code <= 0x1F149 or 0x1F150 <= code <= 0x1F169 or 0x1F170 <= code <= 0x1F189
        mine = c.isalnum() or c == "_"
        self[code] = "\xaa" if word and not mine else "\xa1" if mine and not word or c.isspace() and c not in SPACES else c
        return self[code]


_SHAPE = _Shape()
#: Anything that may have a stand-in, or another case than its own and ASCII's.
_ODD = re.compile(r"[^\t-\r -~±µ–°·]")


def odd(text: str) -> bool:
    return _ODD.search(text) is not None


def shape(text: str) -> str:
    return text.translate(_SHAPE) if odd(text) else text


def stripped(text: str) -> str:
    return text.strip(SPACES)


class Pattern:
    """A pattern without regard to case, for texts in lower case: as it is where their characters have no other case, else with case folding."""

    def __init__(self, pattern: str):
        # a number that begins with a class, not with a repetition, lets the engine skip to digits
        pattern = re.sub(r"^\(\\d\+", r"(\\d\\d*", pattern)
        self.fast, self.folding = re.compile(pattern.lower()), re.compile(pattern, re.I)

    def on(self, folding: bool) -> re.Pattern:
        return self.folding if folding else self.fast


class Stems:
    """Words looked for at the beginning of a word: each as a plain substring first."""

    def __init__(self, words: list[str]):
        self.words = [(re.match(r"(?:\(\?:\w+\)\?)?(\w+)", w)[1], Pattern(rf"\b{w}")) for w in words]

    def count(self, low: str, folding: bool) -> int:
        if folding:
            return sum(p.folding.search(low) is not None for _, p in self.words)
        n = 0
        for stem, p in self.words:
            if stem in low and p.fast.search(low):
                n += 1
        return n

    def any(self, low: str, folding: bool) -> bool:
        if folding:
            return any(p.folding.search(low) for _, p in self.words)
        for stem, p in self.words:
            if stem in low and p.fast.search(low):
                return True
        return False


VERBS, CONFIRMED, QUALIFIED = Stems(STRONG_VERBS), Stems(CONFIRMATIONS), Stems(QUALIFIERS)
#: What a text must hold for each of NEGATIONS.
_NEGATION_WORDS = ["not", "not", "fail", "unable", "incapable", "no", "not", "not", "undetect", "negligible", "absence", "negative", "lack", "non"]
_NEGATIONS = [(w, Pattern(p)) for w, p in zip(_NEGATION_WORDS, NEGATIONS, strict=True)]
_CLAUSE_ENDS = re.compile(CLAUSE_ENDS)
_NOUN = "assay|method|technique|protocol|procedure|bioassay"
_NAME = rf"([A-Za-z][A-Za-z0-9\-]*(?:\s+[A-Za-z0-9\-]+){{0,4}}\s+(?:{_NOUN}))"
_NOUNS = [n for n in _NOUN.split("|") if n != "bioassay"]
_GENERIC = [re.compile(p, re.I) for p in (rf"(?:using|via|by|through)\s+(?:the\s+|an?\s+)?{_NAME}\b", rf"\b{_NAME}\s+(?:was|were)\s+(?:used|performed|conducted|employed|applied)\b")]


def word_offsets(text: str, word: str) -> list[int]:
    at, i = [], text.find(word)
    while i >= 0:
        at.append(i)
        i = text.find(word, i + len(word))
    return at


def term_offsets(text: str, terms: list[str]) -> list[int]:
    return [i for t in terms if t in text for i in word_offsets(text, t)]


def nearest(positions: list[int], at: int, default: int) -> int:
    return min((abs(p - at) for p in positions), default=default)


@cache
def _assays(p: Phenotype) -> list[tuple[str, int, str]]:
    place: dict[str, int] = {}
    return [(key, place.setdefault(label, len(place)), label) for key, label in p.methods.items() if not any(x in label.lower() for x in MOLECULAR)]


def methods(low: str, terms: list[int], p: Phenotype) -> list[str]:
    """Labels of the assays named, nearest to the phenotype's terms first."""
    rows = [(min(nearest(terms, x, 0) for x in word_offsets(low, key)), k, label) for key, k, label in _assays(p) if key in low]
    return list(dict.fromkeys(label for _, _, label in sorted(rows)))


def generic_method(sentence: str) -> str | None:
    """An assay named by its phrasing: the first match of each pattern, unless it is molecular."""
    shaped = shape(sentence)
    for g in _GENERIC:
        m = g.search(shaped)
        name = stripped(SPACE_RUN.sub(" ", sentence[m.start(1) : m.end(1)])).strip(" -") if m else ""
        if name and not any(x in name.lower() for x in MOLECULAR):
            return " ".join(w[:1].upper() + w[1:] if w == w.lower() else w for w in name.split(" "))
    return None


def negated(low: str, shaped: str, terms: list[int], folding: bool) -> bool:
    """Whether a negation begins in a clause that also holds one of the phenotype's terms."""
    if not terms:
        return False
    nots = [m.start() for w, p in _NEGATIONS if folding or w in low for m in p.on(folding).finditer(shaped)]
    if not nots:
        return False
    ends = [m.start() for m in _CLAUSE_ENDS.finditer(shaped) if m.start() > 0]
    clause = lambda at: sum(e <= at for e in ends)
    return not {clause(x) for x in nots}.isdisjoint(clause(t) for t in terms)


def evidence(sentence: str, p: Phenotype) -> tuple[str, str, int, int, int, bool, bool, bool]:
    """low, label, n_methods, n_verbs, base, is_weak, negated and confirmed of a sentence."""
    low = sentence.lower()
    folding = odd(low)
    shaped = low.translate(_SHAPE) if folding else low
    terms = term_offsets(low, p.terms)
    named = methods(low, terms, p)
    label, n = NOT_STATED, len(named)
    if named:
        label = ", ".join(named)
    elif any(x in low for x in _NOUNS):
        other = generic_method(sentence)
        label, n = (f"{other} (Reported)", 1) if other else (label, 0)
    verbs, confirmed = VERBS.count(shaped, folding), CONFIRMED.any(shaped, folding)
    base = (2 if terms else 0) + (3 if verbs else 0) + (verbs >= 2) + (2 if confirmed else 0) + QUALIFIED.any(shaped, folding) + (2 + min(n - 1, 2) if n else 0)
    return low, label, n, verbs, base, any(x in low for x in WEAK_CONTEXTS), negated(low, shaped, terms, folding), confirmed


# Measured values.

_COMMA = re.compile(r"(\d),(\d)")
_DIGIT, _YEAR, _WHOLE = re.compile(r"\d"), re.compile(r"\s*(?:19|20)\d\d\s*\Z"), re.compile(r"\d|(?:si|psi|index)\b", re.I)
_INDEX = re.compile(r"(?:SI|PSI|index)\s*(?:=|of|:)\s*", re.I)
_INDEX_LED = re.compile(rf"\s*{_INDEX.pattern}", re.I)
_APPROXIMATE = re.compile(APPROXIMATE, re.I)
_CONTEXT = re.compile(UNIT_CONTEXT.removesuffix(".*$") + rf"[^{LINE_END}]*\Z", re.I)
_MINUS_ONE = re.compile(r"[-−]\s*1")
_NUMBER = r"(\d+(?:\.\d+)?)"
_SUPERSCRIPT = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺", "0123456789-+")
_FORMS = [(re.compile(p, re.A), re.compile(f"{p}(.*)", re.S)) for p in (rf"{_NUMBER}\s*±\s*{_NUMBER}", rf"{_NUMBER}\s*[-–]\s*{_NUMBER}", _NUMBER)]


def plain_low(sentence: str) -> str:
    """Lower case, without thousands commas."""
    return (_COMMA.sub(r"\1\2", sentence) if "," in sentence else sentence).lower()


@cache
def _values(p: Phenotype) -> list[Pattern]:
    return [Pattern(x) for x in p.patterns]


def candidates(low: str, p: Phenotype) -> list[str]:
    """The values of a plain_low() sentence by distance to the phenotype's terms (stable), those nearer to a rival's left out."""
    if not _DIGIT.search(low):
        return []
    folding, rows, near = odd(low), [], None
    shaped = low.translate(_SHAPE) if folding else low
    for k, pattern in enumerate(_values(p)):
        for i, m in enumerate(pattern.on(folding).finditer(shaped)):
            if near is None:
                near, far = term_offsets(low, p.terms), term_offsets(low, p.rivals)
            dist, rival = nearest(near, m.start(), FAR), nearest(far, m.start(), FAR)
            if dist <= rival:
                value = low[m.start() : m.end()]
                if not _WHOLE.match(m[0]):
                    inner = pattern.folding.search(m[0])
                    value = value[inner.start(1) : inner.end(1)] if inner and inner.start(1) >= 0 else ""
                if not _YEAR.match(value):
                    rows.append((dist, k, i, rival, value))
    return [r[-1] for r in sorted(rows)]


def plain_numbers(text: str) -> str:
    """Powers of ten and e-notation written out, each with six significant digits."""
    power = lambda m: f"{float(m[1]) * 10.0 ** int(m[2].translate(_SUPERSCRIPT)):.6g}"
    text = re.sub(rf"{_NUMBER}\s*x\s*10([⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺]+)", power, text)
    text = re.sub(rf"{_NUMBER}\s*x\s*10\s*\^?\s*([+-]?\d+)", power, text)
    return re.sub(r"\d+(?:\.\d+)?[eE][+-]?\d+", lambda m: f"{float(m[0]):.6g}", text)


def significant(value: float, digits: int = 4) -> float:
    """value rounded half-even to significant digits; 0 stays 0."""
    if value == 0:
        return 0.0
    factor = math.pow(10.0, digits - 1 - math.floor(math.log10(abs(value))))
    return round(value * factor) / factor


def _without(pattern: re.Pattern, text: str) -> str:
    """text without the matches of a pattern."""
    out, at = [], 0
    for m in pattern.finditer(shape(text)):
        out.append(text[at : m.start()])
        at = m.end()
    return "".join(out) + text[at:] if at else text


def unit(raw: str) -> str:
    """The display form of a unit."""
    u = stripped(_without(_MINUS_ONE, stripped(_without(_CONTEXT, raw)))).lower()
    return UNITS.get(u) or u or stripped(raw)


def prepared(raw: str) -> str:
    """raw without its index prefix and approximate qualifier."""
    value = stripped(raw)
    for lead in (_INDEX, _APPROXIMATE):
        m = lead.match(shape(value))
        value = value[m.end() :] if m else value
    return stripped(value)


@lru_cache(65_536)
def parsed(raw: str, cleaned: str | None) -> tuple[float, float | None, float | None, str] | None:
    """value, value_min, value_max and unit; None for years, where there is no number, and where it is too large."""
    if cleaned is None:
        return None
    for k, (ascii_form, form) in enumerate(_FORMS):
        m = ascii_form.search(cleaned)
        if m is None:
            continue
        try:
            numbers = [significant(float(x)) for x in m.groups()]
            if any(1900 <= x <= 2100 for x in (numbers if k else numbers[:1])):
                return None
            a, b = numbers[0], numbers[-1]
            value, low, high = ((a, significant(a - b), significant(a + b)), (significant((a + b) / 2), a, b), (a, None, None))[k]
        except (OverflowError, ValueError):
            return None
        rest = form.search(shape(cleaned))
        u = unit(stripped(stripped(cleaned[rest.start(rest.re.groups) :]).lstrip("/")))
        return value, low, high, u or ("SI" if _INDEX_LED.match(shape(raw)) else "")
    return None


@lru_cache(65_536)
def measured(raw: str) -> tuple[float, float | None, float | None, str] | None:
    """parsed() of a value as it stands in a sentence."""
    try:
        return parsed(raw, plain_numbers(prepared(raw)))
    except (ValueError, OverflowError):
        return None


# Names.

# a boundary looked for behind the capital lets the engine skip to capitals
_FULL = re.compile(r"([A-Z](?<=\b.)[a-z]+)\s+([a-z0-9]+(?:[\.-][a-z0-9]+)?)\b")
_SHORT = re.compile(r"([A-Z](?<=\b.))\.\s*([a-z]+(?:[\.-][a-z]+)?)\b")
_STRAIN = re.compile(r"([a-z]+)[.-]\d\w*\Z")
_NO_SPECIES, _GENERA, _PLANTS, _STOP = frozenset(INVALID_SPECIES + STOP_WORDS), frozenset(GENERA), frozenset(PLANT_GENERA), frozenset(STOP_WORDS)
_HOSTS = frozenset(CLONING_HOSTS)


@lru_cache(65_536)
def canonical(genus: str, species: str, unlisted: bool) -> str | None:
    """`Genus species`, or None: as organisms.canonical()."""
    m = _STRAIN.match(species)
    species = m[1] if m else species
    if len(species) < 3 or not species.isalpha() or species in _NO_SPECIES:
        return None
    open_ = unlisted and len(genus) >= 4 and len(species) >= 4 and genus not in _PLANTS and genus.lower() not in _STOP
    return f"{genus} {species}" if open_ or genus in _GENERA else None


def names(text: str, unlisted: bool = False) -> list[str]:
    """The sorted distinct names in a text: full ones, and abbreviated ones whose initial has exactly one full genus before them."""
    shaped = shape(text)
    full = [(m.start(), m[1], m[2]) for m in _FULL.finditer(shaped)]
    found = {canonical(g, s, unlisted) for _, g, s in full}
    if full and "." in shaped:
        for m in _SHORT.finditer(shaped):
            before = {g for at, g, _ in full if at < m.start() and g[0] == m[1]}
            if len(before) == 1:
                found.add(canonical(*before, m[2], unlisted))
    found.discard(None)
    return sorted(found)


@lru_cache(65_536)
def _parts(organism: str) -> tuple[str, str, re.Pattern, re.Pattern]:
    """Lower-case name and genus, and the abbreviated name with ASCII's and with Unicode's white space."""
    name = organism.lower()
    genus, species = name.split(" ")[:2]
    short = rf"{genus[:1]}\.\s*{species}"
    return name, genus, re.compile(short, re.A), re.compile(short)


def position(low: str, organism: str) -> int:
    """Offset of the full name, else of the abbreviated one, else of the genus; -1 if none is there."""
    name, genus, short, _ = _parts(organism)
    at = low.find(name)
    if at < 0 and (m := short.search(low)):
        return m.start()
    return at if at >= 0 else low.find(genus)


def interfered(low: str, organism: str, others: list[str]) -> bool:
    """Whether another genus stands at or before the organism in the sentence."""
    if len(others) < 2 and organism in others:
        return False
    own, genus = position(low, organism), _parts(organism)[1]
    return own >= 0 and any(_parts(o)[1] != genus and 0 <= position(low, o) <= own for o in others)


# Articles.

_DEFINED = re.compile(r"\b([A-Z][a-z]+\s+[a-z]+)\s+\(([A-Z]\.\s*[a-z]+)\)")
_NORMAL = [("μ", "µ"), ("−", "-"), ("×", "x")]
_BREAK = re.compile(rf"\s(?<=[.?!]\s)(?<!\w\.\w[^{LINE_END}]\s)(?<![A-Z][a-z]\.\s)")
_INITIAL, _SMALL = re.compile(r"[A-Z]\.\Z"), re.compile(r"\s*[a-z]")
_ABBREVIATIONS = frozenset(ABBREVIATIONS)


def normalised(text: str) -> str:
    """text with the abbreviations that it defines written out, and mu, minus and times as unit patterns expect them."""
    if "(" in text:
        pairs = {}
        for m in _DEFINED.finditer(shape(text)):
            pairs[stripped(SPACE_RUN.sub(" ", text[m.start(2) : m.end(2)]))] = text[m.start(1) : m.end(1)]
        for abbr, full in pairs.items():
            text = text.replace(abbr, full)
    for was, becomes in _NORMAL:
        text = text.replace(was, becomes)
    return text


def sentences(body: str) -> list[str]:
    """As text.sentences(): split after . ? or !, fragments after abbreviations joined again."""
    shaped, out, at = shape(body), [], 0
    for m in [*_BREAK.finditer(shaped), None]:
        end = m.start() if m else len(body)
        part, kind = body[at:end], shaped[at:end]
        at = end + 1
        if out and _open_end(out[-1], kind):
            out[-1] = (f"{out[-1][0]} {part}", f"{out[-1][1]} {kind}")
        else:
            out.append((part, kind))
    return [s for s, _ in out]


def _open_end(done: tuple[str, str], nxt: str) -> bool:
    kept = done[1].rstrip()
    words = kept.rsplit(None, 1)
    if not words:
        return False
    last = done[0][len(kept) - len(words[-1]) : len(kept)]
    if _INITIAL.match(last):
        return _SMALL.match(nxt) is not None
    return last.rstrip(".").lower() in _ABBREVIATIONS


_ACCESSIONS = [re.compile(a) for a in ACCESSIONS]
#: What a text must hold for each of ACCESSIONS.
_ACCESSION_SIGNS = [re.compile(s) for s in ("GC[AF]_", r"[A-Z]\d{8}", "PRJ", "SAM", r"[A-Z]\d{5}")]


def accessions(body: str, names: list[str]) -> dict[str, tuple[int, int, str]]:
    """organism -> (kind, place, accession): as mining.reported_accessions()."""
    first: dict[str, tuple[int, int, str]] = {}
    if not names:
        return first
    shaped, low, named = shape(body), None, []
    for kind, (sign, pattern) in enumerate(zip(_ACCESSION_SIGNS, _ACCESSIONS, strict=True)):
        if not sign.search(shaped):
            continue
        for m in pattern.finditer(shaped):
            if low is None:
                low = body.lower()
                flat = shape(low)
                named = [(n, word_offsets(low, n.lower()) + [x.start() for x in _parts(n)[3].finditer(flat)]) for n in names]
            pos = m.start()
            window = low[max(0, pos - 200) : pos]
            if any(w in window for w in GENOME_WORDS):
                last = [(-max(before), n) for n, at in named if (before := [p for p in at if p < pos])]
                if last:
                    mine = (kind, pos, body[pos : m.end()])
                    name = min(last)[1]
                    first[name] = min(first.get(name, mine), mine)
    return first


def article(body: str, p: Phenotype, unlisted: bool, negative: bool) -> dict[str, list]:
    """organism -> [pick, lend, accession, positive] of a normalised() body.

    pick is the best sentence: (1 if measured, score, -place, sentence, label, metric, measured()) of those that
    speak for the organism, or of those that speak against it (without a metric); positive whether any speaks for it. Of equal
    scores the first sentence holds. lend is the first sentence that an assay can be borrowed from.
    """
    every = names(body, unlisted)
    out: dict[str, list] = {n: [None, None, a, False] for n, a in accessions(body, every).items()}
    wanted = every if "isolated" in body.lower() else [n for n in every if n not in _HOSTS]
    if not wanted:
        return out
    for ix, sent in enumerate(sentences(body)):
        low = sent.lower()
        generic = "the" in low or "this" in low
        generic = generic and any(x in low for x in GENERIC_STRAINS)
        told = None
        for n in wanted:
            _, genus, short, _ = _parts(n)
            if not (generic or genus in low or short.search(low)):
                continue
            if told is None:
                told = evidence(sent, p)
                _, label, n_methods, _, base, is_weak, is_negated, confirmed = told
                found = candidates(plain_low(sent), p)
                metric = "; ".join(dict.fromkeys(found)) if found else None
                root = p.root in low
            rival = interfered(low, n, every)
            score = (0 if is_negated else base - (11 if is_weak else 0)) - (10 if rival else 0)
            row = out.setdefault(n, [None, None, None, False])
            best = row[0]
            if score > 0:
                row[3] = True
                rank, points = (1, score + 5) if found else (0, score)
                if not negative and (best is None or (rank, points) > best[:2]):
                    row[0] = (rank, points, -ix, sent, label, metric, next(filter(None, map(measured, found)), None))
            if negative and is_negated and not is_weak and not rival:
                points = 5 + (2 if confirmed else 0) + (2 if n_methods else 0)
                if best is None or points > best[1]:
                    row[0] = (0, points, -ix, sent, label, None, None)
            if row[1] is None and root and label != NOT_STATED:
                row[1] = (ix, label, sent)
    return out
