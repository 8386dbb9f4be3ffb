"""Format-preserving pseudonyms for personal data.

Validated numbers, dates, addresses and secrets are mapped by a keyed Feistel permutation of all
values of their format: a card number becomes another that passes its check, a date another date, a
number that may be issued another that may be. Equal values get equal pseudonyms in every document, and
no table of them is kept. Whoever has the key can undo them, so there is no default key.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from collections.abc import Callable
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, trimmed

ROUNDS, LEAST_KEY = 10, 16
#: Session setting that holds the key in hexadecimal digits; Spark leaves settings with "secret" in their names out of its logs.
KEY_CONF = "spark.phenolith.pii.secret"

#: Shapes by kind, first match first; values are validated afterwards.
SHAPES = {
    "email": r"(?<![\w.%+-])[\w.%+-]{1,64}@[A-Za-z0-9][A-Za-z0-9-]{0,62}(?:\.[A-Za-z0-9][A-Za-z0-9-]{0,62}){0,8}\.[A-Za-z]{2,24}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "secret": r"(?<!\w)(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?!\w)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w+.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w.-]\d|\w)",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7})(?![\w]|-\d)",
    "ssn": r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w]|-\d)",
    "date": r"(?<![\w./-])(?:\d{4}-\d\d-\d\d|\d\d(?P<by>[./])\d\d(?P=by)\d{4})(?!\w|[./-]\d)",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)",
}
FOUND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in SHAPES.items()))
#: Every shape holds one of these, so a text without any is left as it is: two digits (iban, phone, card, ssn, date), @, digits around a dot (ip), 32 hex digits (secret).
HINT = re.compile(r"\d{2}|@|\d\.\d|[0-9a-f]{32}|[0-9A-F]{32}")


def session_key(spark: SparkSession) -> bytes:
    """The key in KEY_CONF; where it is unset, a random one that the session keeps, so that pseudonyms cannot be undone after it. Set one to link values across sessions."""
    if not spark.conf.get(KEY_CONF, None):
        spark.conf.set(KEY_CONF, secrets.token_hex(32))
    return checked(bytes.fromhex(spark.conf.get(KEY_CONF)))


def checked(key: bytes) -> bytes:
    if len(key) < LEAST_KEY:
        raise ValueError(f"the key of pseudonyms must have {LEAST_KEY} bytes or more")
    return key


def permute(value: int, size: int, kind: str, key: bytes, back: bool = False) -> int:
    """A keyed permutation of 0..size-1: a Feistel network on the next even number of bits, walked until it is below size."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    digest = lambda r, x: int.from_bytes(hashlib.blake2b(x.to_bytes(width, "big") + bytes([r]), key=key[:64], digest_size=64, person=hashlib.blake2b(f"{kind}:{size}".encode(), digest_size=16).digest()).digest() * (1 + width // 64), "big") & mask
    while True:
        left, right = value >> half, value & mask
        if back:
            for r in reversed(range(ROUNDS)):
                left, right = right ^ digest(r, left), left
        else:
            for r in range(ROUNDS):
                left, right = right, left ^ digest(r, right)
        value = left << half | right
        if value < size:
            return value


#: Characters that stand for one another: each is replaced by one of its own set.
SETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþßÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ")
PLACE = {c: (s, k) for s in SETS for k, c in enumerate(s)}


def characters(text: str, kind: str, key: bytes, back: bool) -> str:
    """Each character of SETS replaced within its set, all of them as one number; others stay."""
    value, size = 0, 1
    for c in text:
        if c in PLACE:
            s, k = PLACE[c]
            value, size = value * len(s) + k, size * len(s)
    if size > 1:
        shape = "".join(PLACE[c][0][0] if c in PLACE else c for c in text)
        value = permute(value, size, f"{kind}:{shape}", key, back)
    out = []
    for c in reversed(text):
        if c in PLACE:
            s = PLACE[c][0]
            value, k = divmod(value, len(s))
            c = s[k]
        out.append(c)
    return "".join(reversed(out))


def digits(text: str, n_fixed: int, kind: str, key: bytes, back: bool, check: Callable[[str], str] | None = None, sort: Callable[[str], object] = lambda body: None) -> str:
    """The digits of text after the first n_fixed permuted, separators in place; check gives the last digit from those before it.

    Numbers are permuted among those of the same sort: the permutation of all is walked until one is met.
    """
    plain = re.sub(r"\D", "", text)
    old = body = plain[n_fixed : len(plain) - bool(check)]
    while True:
        body = str(permute(int(body), 10 ** len(body), f"{kind}{len(body)}", key, back)).zfill(len(body))
        if sort(body) == sort(old):
            break
    new = plain[:n_fixed] + body
    if check:
        new += check(new)
    it = iter(new)
    return re.sub(r"\d", lambda _: next(it), text)


def issued_ssn(plain: str) -> bool:
    return plain[:3] not in ("000", "666") and plain[0] != "9" and plain[3:5] != "00" and plain[5:] != "0000"


def phone_sort(plain: str) -> tuple[bool, bool]:
    """Of ten digits: whether area code and exchange may begin as they do in North America."""
    return plain[0] in "23456789", plain[3] in "23456789"


def luhn_digit(body: str) -> str:
    odd = [int(c) for c in body[::-1]]
    return str(-(sum(sum(divmod(2 * d, 10)) for d in odd[::2]) + sum(odd[1::2])) % 10)


def _iban_rest(bban: str, country: str) -> int:
    return int("".join(str(int(c, 36)) for c in bban + country + "00")) % 97


#: Dates that are permuted among themselves.
FIRST, DAYS = date(1900, 1, 1).toordinal(), date(2100, 1, 1).toordinal() - date(1900, 1, 1).toordinal()


def _date(text: str) -> tuple[date, str] | None:
    try:
        day = date.fromisoformat(text) if text[4] == "-" else date(int(text[6:]), int(text[3:5]), int(text[:2]))
    except ValueError:
        return None
    return (day, text[2] if text[4] != "-" else "-") if 0 <= day.toordinal() - FIRST < DAYS else None


def pseudonym(kind: str, text: str, key: bytes, back: bool = False) -> str:
    """The pseudonym of a value of that shape; the value itself if it is not valid. back undoes it."""
    if kind == "email":
        local, _, domain = text.partition("@")
        return f"{characters(local, 'email', key, back)}@{domain}"
    if kind == "iban":
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or (_iban_rest(plain[4:], plain[:2]) + int(plain[2:4])) % 97 != 1:
            return text
        bban = characters(plain[4:], "iban", key, back)
        it = iter(plain[:2] + str(98 - _iban_rest(bban, plain[:2])).zfill(2) + bban)
        return "".join(" " if c == " " else next(it) for c in text)
    if kind == "secret":
        new = format(permute(int(text, 16), 16 ** len(text), f"secret{len(text)}", key, back), f"0{len(text)}x")
        return new.upper() if text.upper() == text else new
    if kind == "phone":
        n = len(re.sub(r"\D", "", text))
        if not 10 <= n <= 15:
            return text
        # the last ten digits; a country code and what follows it beyond these stay
        return digits(text, n - 10, "phone", key, back, sort=phone_sort)
    if kind == "card":
        plain = re.sub(r"\D", "", text)
        if len(plain) > 19 or len(set(plain)) == 1 or luhn_digit(plain[:-1]) != plain[-1]:
            return text
        # not one digit repeated, which does not count as a number
        return digits(text, 0, "card", key, back, luhn_digit, lambda body: len(set(body + luhn_digit(body))) == 1)
    if kind == "ssn":
        return digits(text, 0, "ssn", key, back, sort=issued_ssn) if issued_ssn(re.sub(r"\D", "", text)) else text
    if kind == "date":
        found = _date(text)
        if not found:
            return text
        day = date.fromordinal(FIRST + permute(found[0].toordinal() - FIRST, DAYS, "date", key, back))
        return day.isoformat() if found[1] == "-" else day.strftime(f"%d{found[1]}%m{found[1]}%Y")
    octets = text.split(".")
    if any(int(x) > 255 or x != str(int(x)) for x in octets):
        return text
    value = permute(int.from_bytes(map(int, octets)), 1 << 32, "ip", key, back)
    return ".".join(map(str, value.to_bytes(4)))


def redact(text: str, key: bytes, counts: dict[str, int] | None = None) -> str:
    """A whole text with its valid values replaced; counts gets the replacements by kind."""
    if not HINT.search(text):
        return text

    def new(m: re.Match) -> str:
        value = m.group()
        out = pseudonym(kind := m.lastgroup if m.lastgroup in SHAPES else next(k for k in SHAPES if m[k] is not None), value, key)
        if counts is not None and out != value:
            counts[kind] = counts.get(kind, 0) + 1
        return out

    return FOUND.sub(new, text)


def redacted(text: Column, key: bytes) -> Column:
    """struct(text, n): the text with pseudonyms and how many there are; a null text stays null, with 0."""

    @F.arrow_udf("struct<text string, n long>")
    def run(texts: pa.Array) -> pa.Array:
        new, n = [], []
        for t in texts:
            counts: dict[str, int] = {}
            new.append(redact(t.as_py(), key, counts) if t.is_valid else None)
            n.append(sum(counts.values()))
        found = pa.StructArray.from_arrays([pa.array(new, pa.string()), pa.array(n, pa.int64())], ["text", "n"])
        trimmed()
        return found

    return run(text.cast("string"))


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """docs with text_col replaced and a count n_pseudonyms (a column of that name is replaced), row by row: no shuffle, and repeated rows stay equal."""
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() != "n_pseudonyms"]
    # the columns of docs travel in one struct, so that none of them can clash
    done = docs.select(F.struct(*(docs[f"`{c}`"] for c in names)).alias("doc"), redacted(docs[f"`{text_col}`"], checked(key)).alias("new"))
    return done.select(*(F.col("new.text").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in names), F.col("new.n").alias("n_pseudonyms"))
