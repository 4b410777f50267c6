"""Personal data (operator 4).

Regular expressions propose spans, validators confirm them (Luhn for cards,
mod 97 for account numbers, value ranges for the others) and context words near
a span adjust its score. Four base kinds are accepted on pattern and validator
alone. Further kinds, whose patterns also match innocent numbers, start from a
lower score and are kept only with a valid checksum or a fitting word nearby;
those of :mod:`secrets` are credentials, addresses and identity numbers.

Each text is scanned whole and on its own in batches, so nothing is shuffled and
memory is bounded by one batch.

Defined results: a NULL text is empty; repeated rows are scanned alike; an empty
table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from txrisk.llm import secrets

BASE_KINDS = ("email", "ip", "card", "phone")
# Kinds in the order in which spans with one start are listed.
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone", *secrets.FINDERS)

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A start inside a run of digits cannot match where the run's first digit did
# not, so it need not be tried; long runs stay linear.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![+0-9().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")

# Characters of an account number by country code.
IBAN_LENGTHS = {
    code: int(length)
    for length, codes in (
        x.split(":") for x in (
            "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK"
            " 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL"
            " 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR"
            " 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA"
            " 30:JO,KW,MU 31:MT,SC 32:LC 33:RU"
        ).split()
    )
    for code in codes.split(",")
}

WORD = re.compile(r"[^\W\d_]+")
CONTEXT = {
    "iban": {"iban", "account", "konto", "compte", "cuenta", "bank", "banque", "banco"},
    "ssn": {"ssn", "social", "security", "insurance", "taxpayer"},
    "local_phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "téléfono",
                    "téléphone", "teléfono"},
    **secrets.CONTEXT,
}
WINDOW = 48
PATTERN_SCORE = {"iban": 0.3, "ssn": 0.35, "local_phone": 0.35, **secrets.PATTERN_SCORE}
CHECKSUM_BONUS = 0.5
CONTEXT_BONUS = 0.4
ACCEPT = 0.7


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(number)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Check digits of an account number: letters count from ten on."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _valid_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in text.split("."))


def _valid_card(text: str) -> bool:
    number = digits(text)
    return 14 <= len(number) <= 19 and luhn(number)


def _valid_phone(text: str) -> bool:
    return 10 <= len(digits(text)) <= 15


def _valid_ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their ``@`` in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_PART:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    found += [Span("email", start, end, 1.0) for start, end in email_spans(text)]
    for kind, pattern, valid in (("ip", IP, _valid_ip), ("card", CARD, _valid_card)):
        found += [Span(kind, *m.span(), 1.0) for m in pattern.finditer(text) if valid(m[0])]
    if "+" in text:
        found += [Span("phone", *m.span(), 1.0) for m in PHONE.finditer(text) if _valid_phone(m[0])]
    return found


def context_score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]
    hit = any(w.lower() in CONTEXT[kind] for w in WORD.findall(near))
    return CONTEXT_BONUS if hit else 0.0


def iban_spans(text: str) -> Iterator[tuple[int, int]]:
    """Valid account numbers. The pattern may run on into the next words, so a
    number may end at any space of the proposal: first where its country's
    length says, then at the last end that is valid. After a proposal without
    a valid end the search goes on inside it."""
    at = 0
    while m := IBAN.search(text, at):
        start, at = m.start(), m.start() + 1
        ends = [m.end(), *(k for k in range(m.end() - 1, start, -1) if text[k] == " ")]
        proposed = [(end, text[start:end].replace(" ", "")) for end in ends]
        known = IBAN_LENGTHS.get(m[0][:2])
        for end, compact in sorted(proposed, key=lambda x: len(x[1]) != known):
            if 15 <= len(compact) <= 34 and mod97(compact):
                yield start, end
                at = end
                break


def free(spans: Iterable[Span], taken: list[Span]) -> list[Span]:
    """The spans that overlap none of those taken."""
    blocked: list[list[int]] = []  # apart from each other, in order
    for start, end in sorted((s.start, s.end) for s in taken):
        if blocked and start <= blocked[-1][1]:
            blocked[-1][1] = max(end, blocked[-1][1])
        else:
            blocked.append([start, end])
    ends = [end for _, end in blocked]

    def overlaps(span: Span) -> bool:
        at = bisect_left(ends, span.start + 1)  # the first that ends after its start
        return at < len(blocked) and blocked[at][0] < span.end

    return [s for s in spans if not overlaps(s)]


def scored_spans(text: str, taken: list[Span]) -> list[Span]:
    """Spans of the further kinds whose score reaches the limit and that do not
    overlap a base span, nor, for the kinds of ``secrets``, one found before."""
    proposed = (
        ("iban", ((*span, CHECKSUM_BONUS) for span in iban_spans(text))),
        ("ssn", ((*m.span(), 0.0) for m in SSN.finditer(text) if _valid_ssn(m[0]))),
        ("local_phone", ((*m.span(), 0.0) for m in LOCAL_PHONE.finditer(text))),
        *((kind, find(text)) for kind, find in secrets.FINDERS.items()),
    )
    found: list[Span] = []
    for kind, spans in proposed:
        accepted = []
        for start, end, bonus in spans:
            score = PATTERN_SCORE[kind] + context_score(kind, text, start, end) + bonus
            if score >= ACCEPT:
                accepted.append(Span(kind, start, end, min(1.0, score)))
        if accepted:
            found += free(accepted, taken + found if kind in secrets.FINDERS else taken)
    return found


_DIGIT = re.compile(r"[0-9]")


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text by start, then kind. Offsets are code points."""
    if not text or not ("@" in text or "-----BEGIN " in text or _DIGIT.search(text)):
        return []
    base = base_spans(text)
    return sorted(
        base + scored_spans(text, base), key=lambda s: (s.start, KINDS.index(s.kind), s.end)
    )


SCHEMA = (
    "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string,"
    " spans string, n_spans bigint, scores array<double>"
)


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key, counts of the base kinds, a digest of the base spans,
    all spans as ``kind:start:end`` joined by commas, their number and scores."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t.as_py()) for t in batch.column(1)]
            base = [[s for s in spans if s.kind in BASE_KINDS] for spans in found]
            counts = [
                pa.array([sum(s.kind == k for s in spans) for spans in base], pa.int64())
                for k in BASE_KINDS
            ]
            digest = [hashlib.sha256(",".join(map(str, s)).encode()).hexdigest() for s in base]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *counts,
                    pa.array(digest, pa.string()),
                    pa.array([",".join(map(str, s)) for s in found], pa.string()),
                    pa.array(map(len, found), pa.int64()),
                    pa.array([[s.score for s in spans] for spans in found], pa.list_(pa.float64())),
                ],
                names=[key, *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_spans", "scores"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(scan, f"{key} {kind}, {SCHEMA}")
