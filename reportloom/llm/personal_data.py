"""Personal data in texts: patterns propose spans, checksums confirm them, nearby context words adjust the score.

Each finder reads a text once from left to right, also where a text is one run of digits or letters of any length.
Positions are code points, ends exclusive. The four base kinds (email, ip, card, phone) are kept whatever their score; the
kinds that the method adds need a score of `MIN_SCORE`.

Cases: a null text is empty; a text without spans gives an empty list; repeated rows give repeated rows; null ids stay.
Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_step, texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "national_id", "local_phone", "birth_date")
KINDS = BASE_KINDS + ADDED_KINDS
#: Score of a proposed span of each kind before its context is looked at; a passed checksum is part of it.
START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "national_id": 0.3, "local_phone": 0.3, "birth_date": 0.2}
CONTEXT_GAIN, CONTEXT_LOSS, MIN_SCORE = 0.35, 0.3, 0.5
#: Characters before and after a span in which context words count.
CONTEXT_CHARS = 48

#: Context words by kind, and words that speak against personal data.
CONTEXT_WORDS = {
    "email": "email e-mail mail contact",
    "ip": "ip address host server client",
    "card": "card credit debit visa mastercard amex payment",
    "phone": "phone telephone tel mobile call fax",
    "iban": "iban bank account transfer konto",
    "national_id": "ssn social security national identity passport",
    "local_phone": "phone telephone tel mobile call fax",
    "birth_date": "born birth birthday dob geboren",
}
AGAINST_WORDS = "version release isbn invoice order serial example"

#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    country: int(length)
    for length, countries in (
        row.split(":")
        for row in (
            "15:NO|16:BE|18:DK FI FK FO GL NL SD|19:MK SI|20:AT BA EE KZ LT LU MN XK|21:CH HR LI LV|22:BG BH CR DE GB GE IE ME RS VA|"
            "23:AE GI IL IQ OM SO TL|24:AD CZ ES MD PK RO SA SE SK TN VG|25:LY PT ST|26:IS TR|27:BI DJ FR GR IT MC MR SM|"
            "28:AL AZ BY CY DO GT HU LB NI PL SV|29:BR EG PS QA UA|30:JO KW MU YE|31:MT SC|32:LC|33:RU"
        ).split("|")
    )
    for country in countries.split()
}

EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
ALNUM = re.compile("[A-Za-z0-9]")
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.)-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
BIRTH_DATE = re.compile(r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9])")
_WORD = re.compile(r"[\w-]+")
_WORDS = {kind: frozenset(words.split()) for kind, words in CONTEXT_WORDS.items()}
_AGAINST = frozenset(AGAINST_WORDS.split())
_DIGIT = re.compile("[0-9]")
#: One pass tells whether any finder that starts from a digit can match at all.
_TWO_DIGITS = re.compile(r"[0-9][\x20./-]?[0-9]|[0-9]\)")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Only the run of local characters in front of an at sign can start a match, so the signs are visited, not all places."""
    free, at = 0, text.find("@")
    while at >= 0:
        head = text[free:at]
        start = free + len(head.rstrip(EMAIL_LOCAL))
        found = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 38 and 16 <= len(digits := digits_of(m.group())) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """The number ends where its country's length or, in other countries, the longest end of a token that passes mod-97 puts it.

    What follows it in a run of capitals and digits is no part of it, and a run is searched on behind a start that fails.
    """
    free = 0
    for m in IBAN_START.finditer(text):
        start = m.start()
        if start < free:
            continue
        run = IBAN.match(text, start)
        if not run:
            continue
        places = [i for i in range(start, run.end()) if text[i] != " "]
        length = IBAN_LENGTHS.get(text[start : start + 2])
        for n in (length,) if length else range(min(34, len(places)), 14, -1):
            if n > len(places):
                continue
            end = places[n - 1] + 1
            if not ALNUM.match(text, end) and mod97(text[start:end]):
                yield start, end
                free = end
                break


def national_ids(text: str) -> Iterator[tuple[int, int]]:
    for m in NATIONAL_ID.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def local_phones(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in LOCAL_PHONE.finditer(text))


def birth_dates(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in BIRTH_DATE.finditer(text))


def score(text: str, kind: str, start: int, end: int) -> float:
    around = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    words = {w.lower() for w in _WORD.findall(around)}
    gain = CONTEXT_GAIN if words & _WORDS[kind] else 0.0
    loss = CONTEXT_LOSS if words & _AGAINST else 0.0
    return round(min(1.0, max(0.0, START_SCORE[kind] + gain - loss)), 4)


def find(text: str) -> list[Span]:
    """All spans by kind as in KINDS, then by start. An added kind yields to spans of base kinds that it overlaps."""
    found: list[Span] = []
    digits = _TWO_DIGITS.search(text) is not None
    finders = [("email", emails, "@" in text), ("ip", ips, digits or "." in text and _DIGIT.search(text)), ("card", cards, digits), ("phone", phones, "+" in text)]
    for kind, finder, possible in finders:
        if possible:
            found += [Span(kind, s, e, score(text, kind, s, e)) for s, e in finder(text)]
    if not digits:
        return found
    taken = sorted((x.start, x.end) for x in found)
    for kind, finder in (("iban", ibans), ("national_id", national_ids), ("local_phone", local_phones), ("birth_date", birth_dates)):
        for s, e in finder(text):
            if not any(a < e and s < b for a, b in taken) and (points := score(text, kind, s, e)) >= MIN_SCORE:
                found.append(Span(kind, s, e, points))
    return found


def listed(found: list[Span]) -> str:
    return ",".join(f"{x.kind}:{x.start}:{x.end}" for x in found)


SPANS = "doc_id long, spans array<struct<kind: string, start: int, end: int, score: double>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
DIGEST = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """`doc_id` and the spans with their scores, for each row of `docs`."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [[{"kind": x.kind, "start": x.start, "end": x.end, "score": x.score} for x in find(t)] for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, _SPANS)], ["doc_id", "spans"])

    return arrow_step(texts(docs), step, SPANS)


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [find(t) for t in batch["text"].to_pylist()]
        base = [[x for x in spans if x.kind in BASE_KINDS] for spans in found]
        counts = [pa.array([sum(x.kind == kind for x in spans) for spans in base], pa.int64()) for kind in BASE_KINDS]
        digests = pa.array([hashlib.sha256(listed(spans).encode()).hexdigest() for spans in base])
        names = ["doc_id", *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *counts, digests, pa.array([listed(s) for s in found], pa.string())], names)

    return arrow_step(texts(docs), step, DIGEST)


def masked(docs: DataFrame) -> DataFrame:
    """`doc_id` and the text with each span replaced by its kind in angle brackets; of overlapping spans the first one counts."""

    def mask(text: str) -> str:
        out, free = [], 0
        for x in sorted(find(text), key=lambda x: (x.start, -x.end)):
            if x.start >= free:
                out += [text[free : x.start], f"<{x.kind}>"]
                free = x.end
        return "".join([*out, text[free:]])

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([mask(t) for t in batch["text"].to_pylist()], pa.string())], ["doc_id", "text"])

    return arrow_step(texts(docs), step, "doc_id long, text string")
