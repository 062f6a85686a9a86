"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Kinds, in order: email, ip, card, phone (the base kinds), then iban, card15 and ssn, which the
method adds.  Base spans that pass their check always stay; added kinds need a score of
``threshold``:

* iban: country, two check digits, 11 to 30 more characters, single spaces between them allowed;
  it ends at a word boundary, at the country's own length; confirmed by mod 97; with a country code
  that has no registered length only with an account word nearby;
* card15: 13 to 15 digits confirmed by Luhn; only with a card word nearby;
* ssn: ddd-dd-dddd outside the ranges never issued; only with an identity word nearby.

The score starts from the kind's own weight, gains for a confirming checksum and for a word of
the kind's context within ``CONTEXT`` characters, and loses for a word that speaks against it.
Without a word of their context, kinds of ``WORDED`` are dropped whatever their score.  An added span
that shares a character with a base one is dropped; added spans may share characters.

All scans are linear in the text: a run of characters that cannot start a match is consumed as a
whole (possessive quantifiers), and e-mail addresses are found from their ``@``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.llm.arrow_map import map_rows
from telemetry_spark.llm.common import quoted, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "card15", "ssn")
CONTEXT = 48

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that starts no address is consumed without a group
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
BOUNDARY = re.compile(r"(?<!\x20)\b")
VALUES = {ord("A") + i: str(10 + i) for i in range(26)}     # of letters in mod 97
# characters of an IBAN by country (ISO 13616 registry)
IBAN_LENGTH = {c: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in countries.split()}
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")

# weight of the bare pattern, and words that speak for a kind
WEIGHT = {"email": 0.9, "ip": 0.7, "card": 0.4, "phone": 0.6, "iban": 0.4, "card15": 0.1, "ssn": 0.3}
FOR = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|address|host|server)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b"),
    "card15": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social security|tax id)\b"),
}
AGAINST = re.compile(r"(?i)\b(?:version|build|isbn|serial|order no|sku)\b")
WORDED = ("card15",)    # a checksum alone proves nothing: IMEIs pass it, and one in ten of all numbers
CONFIRMED, NEARBY, OPPOSED = 0.5, 0.3, 0.2
THRESHOLD = 0.6


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    return sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int(turned.translate(VALUES)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """What follows an IBAN may look like more of it, so that every end at a word boundary is
    tried, the longest first; after a confirmed one the scan goes on behind it."""
    m = IBAN.search(text)
    while m:
        start, done = m.start(), m.start() + 1
        length = IBAN_LENGTH.get(text[start:start + 2])
        for end in range(m.end(), start + 14, -1):
            if not BOUNDARY.match(text, end):
                continue
            found = text[start:end].replace(" ", "")
            if len(found) >= 15 and length in (None, len(found)) and mod97(found):
                yield start, end
                done = end
                break
        m = IBAN.search(text, done)


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a checksum confirms it)."""
    for start, end in emails(text):
        yield "email", start, end, False
    for m in IP.finditer(text):
        if m.group(1) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            yield "ip", m.start(), m.end(), False
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card" if len(digits) >= 16 else "card15", m.start(), m.end(), True
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 15:
            yield "phone", m.start(), m.end(), False
    for start, end in ibans(text):
        yield "iban", start, end, True
    for m in SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end(), False


def _around(text: str, start: int, end: int) -> str:
    return text[max(0, start - CONTEXT):start] + " " + text[end:end + CONTEXT]


def scored(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    around = _around(text, start, end)
    score = WEIGHT[kind] + CONFIRMED * confirmed
    score += NEARBY * bool(FOR[kind].search(around)) - OPPOSED * bool(AGAINST.search(around))
    return min(1.0, max(0.0, round(score, 3)))


def find_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in order of kind, then start; ends are exclusive."""
    found = [(k, s, e, scored(text, k, s, e, c)) for k, s, e, c in proposals(text)
             if not _needs_word(text, k, s) or FOR[k].search(_around(text, s, e))]
    base = sorted((f[1], f[2]) for f in found if f[0] in BASE)
    starts, reach = [s for s, _ in base], list(accumulate((e for _, e in base), max))
    keep = [f for f in found if f[0] in BASE or f[3] >= threshold and _clear(starts, reach, f[1], f[2])]
    return sorted(keep, key=lambda f: (KINDS.index(f[0]), f[1]))


def _needs_word(text: str, kind: str, start: int) -> bool:
    return kind in WORDED or kind == "iban" and text[start:start + 2] not in IBAN_LENGTH


def _clear(starts: list[int], reach: list[int], start: int, end: int) -> bool:
    """An added span must not lie on a base one: of those that start before its end, the furthest
    ``reach`` decides."""
    before = bisect_left(starts, end)
    return not before or reach[before - 1] <= start


def redacted(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda f: (f[1], -f[2])):
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, spans) for every row: an array of (kind, start, end, score) in code points.

    A null or empty text has no spans; a text may be of any length, all scans are linear; a null id
    stays null; repeated rows stay repeated; other columns are not read; an empty table gives no rows.
    Spans of one kind never overlap, spans of two base kinds may."""
    kind = docs.select(quoted(id_col)).schema[0].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("spans", T.ArrayType(SPAN))])

    def rows(_, keys, texts):
        for key, text in zip(keys, texts):
            yield key, [dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(text or "", threshold)]

    return map_rows(docs.select(quoted(id_col), quoted(text_col).cast("string")), rows, schema)


def redact(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the spans in its text replaced by their kinds, other columns unchanged.

    A null text stays null, an empty one empty; texts may be of any length; of overlapping spans the
    one that starts first (of those the longest) gives the kind; repeated rows stay repeated; an
    empty table gives no rows."""
    at = docs.columns.index(text_col)

    def rows(_, *columns):
        for row in zip(*columns):
            text = row[at]
            yield (*row[:at], None if text is None else redacted(text, find_spans(text, threshold)), *row[at + 1:])

    fields = [T.StructField(f.name, T.StringType() if i == at else f.dataType) for i, f in enumerate(docs.schema)]
    return map_rows(docs, rows, T.StructType(fields))


def op3_personal_data(spark, sf_dir):
    found = personal_data(table(spark, sf_dir, "documents"))
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.transform("spans", lambda x: x["score"]).alias("scores"))
