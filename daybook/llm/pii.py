"""Personal data: patterns propose spans, validators confirm them, words around them move the score.

Kinds of ``BASE`` are kept whenever their pattern and validator agree, whatever their score. Kinds of ``ADDED`` start
from a prior and are kept from ``KEPT`` on: a span whose validator proves something (mod-97 of an account number, an
address of full form) starts above it, one that only looks right (digit groups of a social security number, a telephone
number without a country code, a date) needs a word of its kind within ``AROUND`` characters, and a word that speaks of
something else (invoice, version, order) takes it down. An added span that overlaps a base span, or an added one of
higher score (then earlier start, then order of kinds), is left out.

Patterns read whole texts, once per kind and in time linear in the text: none can begin again inside what it has
already passed. Places are code points, ends are exclusive.

A null or empty text has no span. Repeated rows are searched each; a null doc_id is like any other. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from ipaddress import AddressValueError, IPv6Address
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import ship, slices, table

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ip6", "mac", "ssn", "tel", "birth")
KINDS = BASE + ADDED
KEPT = 0.5
AROUND = 40  # characters read on each side for context

# Possessive repeats and look-behinds only keep a pattern from trying again inside a run it has read; matches stay the same.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f:]{3,39}(?![0-9A-Za-z:.])")
_MAC = re.compile(r"(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}([:-])(?:[0-9A-Fa-f]{2}\1){4}[0-9A-Fa-f]{2}(?![0-9A-Za-z:-])")
_SSN = re.compile(r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])")
_TEL = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")
_DATE = re.compile(
    r"(?<![0-9/.-])(?:(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])([/.])(?:0?[1-9]|[12][0-9]|3[01])\1(?:19|20)[0-9]{2})(?![0-9/-])"
)

# Lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "BR": 29, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26,
    "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25,
    "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ip6": 0.6, "mac": 0.6, "ssn": 0.4, "tel": 0.4, "birth": 0.1}
NEARBY, AGAINST = 0.45, 0.3

# Words that raise the score of a kind, in the languages of the texts, and words that lower any score.
SUPPORT = {
    "email": "email mail contact courriel correo",
    "ip": "ip address host server adresse",
    "card": "card credit visa mastercard payment karte carte tarjeta",
    "phone": "phone tel call mobile fax telephone telefon téléphone teléfono",
    "iban": "iban account bank konto compte cuenta",
    "ip6": "ip ipv6 address host",
    "mac": "mac device hardware adapter",
    "ssn": "ssn social security insurance",
    "tel": "phone tel call mobile fax telephone telefon téléphone teléfono",
    "birth": "born birth birthday dob geboren geburtsdatum né née naissance nacido nacida nacimiento",
}
_SUPPORT = {k: frozenset(words.split()) for k, words in SUPPORT.items()}
DOUBT = frozenset("invoice order version isbn part serial ticket model rechnung facture factura".split())
_WORD = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """An account number in compact form: its country's length, and 1 modulo 97 with the first four behind."""
    if IBAN_LENGTHS.get(account[:2]) != len(account):
        return False
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every local part reaches back to the last character that cannot be in one, or to the match before."""
    behind, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > behind and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            yield start, domain.end()
            behind = domain.end()
        # Local parts hold no sign, so none of them is read twice.
        behind = max(behind, sign + 1)
        sign = text.find("@", behind)


def _base(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _emails(text):
        yield "email", start, end
    for m in _IP.finditer(text) if "." in text else ():
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m.group())) <= 15:
            yield "phone", m.start(), m.end()


def _added(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _IBAN.finditer(text):
        # The words behind an account number may look like more of it.
        size = IBAN_LENGTHS.get(m.group()[:2], 0)
        end, seen = m.start(), 0
        while end < m.end() and seen < size:
            seen += text[end] != " "
            end += 1
        if seen == size and (end == len(text) or not text[end].isalnum()) and mod97(text[m.start() : end].replace(" ", "")):
            yield "iban", m.start(), end
    if ":" in text:
        for m in _IP6.finditer(text):
            try:
                groups = m.group().count(":")
                if groups == 7 or ("::" in m.group() and groups >= 3):
                    IPv6Address(m.group())
                    yield "ip6", m.start(), m.end()
            except AddressValueError:
                pass
    for m in _MAC.finditer(text) if ":" in text or "-" in text else ():
        yield "mac", m.start(), m.end()
    for m in _SSN.finditer(text) if "-" in text else ():
        yield "ssn", m.start(), m.end()
    for m in _TEL.finditer(text):
        yield "tel", m.start(), m.end()
    for m in _DATE.finditer(text):
        yield "birth", m.start(), m.end()


def scored(text: str, kind: str, start: int, end: int) -> Span:
    """The span with its prior, moved by the whole words within ``AROUND`` characters on either side."""
    left, right = max(0, start - AROUND), min(len(text), end + AROUND)
    while left and left < start and text[left - 1].isalpha():
        left += 1  # a word that reaches further back is not read in part
    while right < len(text) and right > end and text[right].isalpha():
        right -= 1
    words = set(_WORD.findall(text[left:start].lower())) | set(_WORD.findall(text[end:right].lower()))
    score = PRIOR[kind]
    if words & _SUPPORT[kind]:
        score += NEARBY
    if words & DOUBT:
        score -= AGAINST
    return Span(kind, start, end, min(1.0, max(0.0, score)))


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of a text, each by start, then order of kinds."""
    if not text:
        return [], []
    order = lambda s: (s.start, KINDS.index(s.kind))
    base = sorted((scored(text, *found) for found in _base(text)), key=order)
    proposed = [s for s in (scored(text, *found) for found in _added(text)) if s.score >= KEPT]
    kept: list[Span] = []
    if proposed:
        proposed.sort(key=lambda s: (-s.score, *order(s)))
        taken = sorted((s.start, s.end) for s in base)
        merged: list[list[int]] = []
        for a, b in taken:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        free = _Taken([(a, b) for a, b in merged])
        for s in proposed:
            if free.add(s.start, s.end):
                kept.append(s)
    return base, sorted(kept, key=order)


class _Taken:
    """Disjoint stretches, in order; adds one if it overlaps none."""

    def __init__(self, stretches: list[tuple[int, int]]):
        self.stretches = stretches

    def add(self, start: int, end: int) -> bool:
        at = bisect_left(self.stretches, (start, end))
        if at < len(self.stretches) and self.stretches[at][0] < end:
            return False
        if at and self.stretches[at - 1][1] > start:
            return False
        self.stretches.insert(at, (start, end))
        return True


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())])
FOUND = "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double, base: boolean>>"


def detect(documents: DataFrame) -> DataFrame:
    """doc_id and all spans (by start, then kind) of every row."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                rows = []
                for text in batch["text"].slice(a, b - a).to_pylist():
                    base, added = find(text)
                    spans = [(s, True) for s in base] + [(s, False) for s in added]
                    spans.sort(key=lambda x: (x[0].start, KINDS.index(x[0].kind)))
                    rows.append([(*s, is_base) for s, is_base in spans])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, b - a), pa.array(rows, pa.list_(SPAN))], names=["doc_id", "spans"]
                )

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, FOUND)


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind; overlapping base spans become one, named by the first."""
    base, added = find(text)
    out, at = [], 0
    for s in sorted(base + added, key=lambda s: (s.start, KINDS.index(s.kind))):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return text if not out else "".join(out) + text[at:]


def masked(documents: DataFrame) -> DataFrame:
    """The rows, with all their columns, whose text has its personal data replaced."""

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([mask(t) for t in batch["text"].to_pylist()], batch["text"].type)
            at = batch.schema.get_field_index("text")
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], schema=batch.schema)

    ship(documents.sparkSession)
    return documents.mapInArrow(replace, documents.schema)


def digest(found: DataFrame) -> DataFrame:
    """Per row the number of base spans by kind, a hash of them, and all spans as text."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(detect(table(spark, sf_dir, "documents")))
