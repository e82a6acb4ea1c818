"""Personal data: patterns propose spans, checksums confirm, context adjusts.

Every kind has a pattern that proposes spans, leftmost and non-overlapping,
a validator that rejects some, and a starting confidence.  Words of the kind's
context list within ``WINDOW`` characters before or after a span raise its
confidence; words that deny it lower it.  The base kinds (email, ip, card,
phone) are reported whenever their validator accepts.  The added kinds (iban,
ssn, local phone numbers) are reported at ``THRESHOLD`` confidence or more:
an IBAN by its mod-97 checksum at the length of its country, the others only near a context word.

Whole texts are scanned in linear time: the email pattern is anchored at its
``@`` signs and the number patterns cannot restart inside a run of digits.

Defined cases: null text is the empty text, without spans; repeated rows give
repeated rows; other columns are not read; a number too long for its kind is
no span; an empty table gives an empty result.  Offsets are code points, end
exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, columns_of, record_batch, texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "local_phone", "ssn")
THRESHOLD = 0.6
WINDOW = 40
BOOST, DAMP = 0.35, 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?:\x20?[A-Z0-9]){1,30}")
_ALNUM = re.compile(r"[A-Za-z0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+)(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]")

#: Starting confidence and context words of each kind.
CONFIDENCE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "local_phone": 0.3, "ssn": 0.3}
CONTEXT = {
    "email": "email e-mail mail contact write", "ip": "ip address host server client login",
    "card": "card credit debit visa mastercard payment", "phone": "phone tel telephone mobile call fax",
    "iban": "iban bank account konto transfer", "local_phone": "phone tel telephone mobile call fax",
    "ssn": "ssn social security taxpayer",
}
DENIAL = {"ip": "version release section", "card": "order invoice serial tracking isbn", "phone": "serial version",
          "local_phone": "order invoice serial", "ssn": "order invoice serial part"}
#: Lengths of the IBAN registry, by country code.
IBAN_LENGTHS = {code: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for code in codes.split()}


def _words(text: str) -> re.Pattern:
    return re.compile(r"\b(?:" + "|".join(map(re.escape, text.split())) + r")\b", re.IGNORECASE)


_NEAR = {k: _words(v) for k, v in CONTEXT.items()}
_AGAINST = {k: _words(v) for k, v in DENIAL.items()}


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if place % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    if not 15 <= len(compact) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and dotted domain, found from the @ signs."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _iban_end(text: str, start: int) -> int | None:
    """End of the IBAN that starts here, of the token ends that its characters may have.

    A country of the registry decides the length.  Else, and if that length
    fails, the longest candidate counts; without a registered length the
    shorter ones are tried after it.
    """
    rest = _IBAN_REST.match(text, start + 4)
    lengths = {e: e - start - text.count(" ", start, e) for e in range(start + 5, rest.end() + 1)
               if text[e - 1] != " " and not _ALNUM.match(text, e)}
    ends = [e for e in sorted(lengths, reverse=True) if lengths[e] >= 15]
    fixed = IBAN_LENGTHS.get(text[start:start + 2])
    if fixed:
        ends = [e for e in ends if lengths[e] == fixed] + ends[:1]
    return next((e for e in ends if mod97(text[start:e])), None)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Starts are tried one by one, so a failed one hides no other; an accepted IBAN is not searched again."""
    m = _IBAN.search(text)
    while m:
        end = _iban_end(text, m.start())
        if end:
            yield m.start(), end
        m = _IBAN.search(text, end or m.end())


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _number(text: str, pattern: re.Pattern, least: int, most: int) -> Iterator[tuple[int, int, str]]:
    for m in pattern.finditer(text):
        if m.end() - m.start() >= least:
            digits = _NOT_DIGIT.sub("", m[0])
            if least <= len(digits) <= most:
                yield m.start(), m.end(), digits


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans that their validator accepts."""
    for start, end in _emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        if all(map(_byte, m[0].split("."))):
            yield "ip", m.start(), m.end()
    for start, end, digits in _number(text, _CARD, 13, 19):
        if luhn(digits):
            yield "card", start, end
    for start, end, _ in _number(text, _PHONE, 9, 15):
        yield "phone", start, end
    for start, end in _ibans(text):
        yield "iban", start, end
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", m.start(), m.end()
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end()


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start."""
    found = []
    base: list[tuple[int, int]] = []
    reach: list[int] = []  # of the base spans in order of their start, the largest end so far
    for kind, start, end in _proposals(text):
        around = text[max(0, start - WINDOW):start] + " \n " + text[end:end + WINDOW]
        score = CONFIDENCE[kind]
        if _NEAR[kind].search(around):
            score += BOOST
        if kind in _AGAINST and _AGAINST[kind].search(around):
            score -= DAMP
        score = min(1.0, max(0.0, score))
        if kind in BASE_KINDS:
            base.append((start, end))
        else:  # all base kinds have been seen
            if len(reach) < len(base):
                base.sort()
                reach = list(accumulate((e for _, e in base), max))
            before = bisect_left(base, (end,))
            if score < THRESHOLD or before and reach[before - 1] > start:
                continue
        found.append((kind, start, end, round(score, 2)))
    return found


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("spans", _SPANS)])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in columns_of(batches):
        spans = [[{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in find_spans(t)] for t in rows["text"]]
        yield record_batch(_SCHEMA, {"doc_id": rows["doc_id"], "spans": spans})


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (array of kind, start, end, score)."""
    bounded_batches(docs.sparkSession)
    return texts(docs, id_col, text_col).mapInArrow(
        _scan, "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>")


def span_digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text in which every span is replaced by its kind in brackets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
        for rows in columns_of(batches):
            out = []
            for text in rows["text"]:
                parts, at = [], 0
                for kind, start, end, _ in sorted(find_spans(text), key=lambda s: s[1]):
                    if start >= at:
                        parts += [text[at:start], f"[{kind}]"]
                    at = max(at, end)
                out.append("".join(parts) + text[at:])
            yield record_batch(schema, {"doc_id": rows["doc_id"], "text": out})

    bounded_batches(docs.sparkSession)
    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, text string")
