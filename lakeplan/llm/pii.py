"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their score.

Base kinds are email, ip, card and phone: their patterns are matched from the left without overlap, a match that fails its
check is dropped, and what passes always stays. Further kinds are proposed by wider patterns and stay only with a score of at
least LEAST_SCORE: ``iban`` (confirmed by its mod-97 remainder), ``ssn`` (group ranges) and ``national`` (a phone number without
country code). A score starts from the kind's own, rises if a checksum confirmed the span, and moves up or down with the words
of ``HINTS`` within WINDOW characters of it.

All patterns take time linear in the text, also on runs of a million letters or digits: an address is found from its "@", and a
number is entered only where its digits begin.

Defined results: NULL counts as empty and has no spans; every row is looked at for itself, so repeated rows and ids give repeated
results; a NULL id stays NULL; offsets are code points, the end exclusive; extra columns pass through or are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "national")
KINDS = BASE_KINDS + ADDED_KINDS

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
NATIONAL = re.compile(r"(?<![0-9(+-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9-])")

# The score of a kind, what a checksum adds, what a word nearby adds or takes, and how near it must be.
OWN_SCORE = {"email": 0.85, "ip": 0.5, "card": 0.4, "phone": 0.6, "iban": 0.4, "ssn": 0.35, "national": 0.3}
CONFIRMED = {"card": 0.35, "iban": 0.45}
HINT = 0.25
WINDOW = 48
LEAST_SCORE = 0.5
HINTS = {
    "email": ("mail", "email", "e-mail", "contact", "write", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "login", "client"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "payment", "cvv", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "handy"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta", "transfer"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "national": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "handy"),
}
DOUBTS = ("version", "release", "isbn", "issn", "order", "invoice", "serial", "build", "part", "ticket")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")

Span = tuple[str, int, int, float]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each "@" to the left as far as an address reaches, then to the right."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        end = 0
        if start < at and (found := DOMAIN.match(text, at + 1)):
            end = found.end()
            yield start, end
        free = max(end, at + 1)
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The first four characters behind the others, letters as numbers from 10: the remainder must be 1."""
    plain = iban.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def digits_of(text: str, start: int, end: int) -> str:
    return "".join(c for c in text[start:end] if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", *span) for span in emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(text, *m.span())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(text, *m.span())) <= 15:
            found.append(("phone", *m.span()))
    return found


def further_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for m in IBAN.finditer(text):
        if mod97(m.group()):
            yield "iban", *m.span()
    for m in SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span()
    for m in NATIONAL.finditer(text):
        yield "national", *m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """Between 0 and 1; every base span and every IBAN has passed its check by now."""
    around = f"{text[max(0, start - WINDOW):start]} {text[end:end + WINDOW]}".lower()
    words = set(WORD.findall(around))
    value = OWN_SCORE[kind] + CONFIRMED.get(kind, 0.0)
    value += HINT * any(w in words for w in HINTS[kind]) - HINT * any(w in words for w in DOUBTS)
    return round(min(1.0, max(0.0, value)), 2)


def find(text: str | None) -> list[Span]:
    """(kind, start, end, score), by kind as listed, then start."""
    if not text:
        return []
    spans = [(kind, start, end, score(text, kind, start, end)) for kind, start, end in base_spans(text)]
    taken: list[list[int]] = []
    for start, end in sorted(s[1:3] for s in spans):
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(end, taken[-1][1])
        else:
            taken.append([start, end])
    last = 0
    for kind, start, end in sorted(further_spans(text), key=lambda s: (s[1], -s[2])):
        before = bisect_left(taken, [end])
        if start < last or (before and taken[before - 1][1] > start):
            continue
        value = score(text, kind, start, end)
        if value >= LEAST_SCORE:
            spans.append((kind, start, end, value))
            last = end
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
SPANS_TYPE = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def with_spans(docs: DataFrame, column: str, text: str = "text") -> DataFrame:
    """``docs`` with an array of its texts' spans; an earlier column of that name goes."""
    docs = docs.drop(column)

    def make():
        def run(texts):
            return {column: [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find(t)] for t in texts.to_pylist()]}
        return run

    return common.append_columns(docs, make, [text], {column: (SPANS, SPANS_TYPE)})


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in brackets; overlapping spans become one."""
    made = "_".join([*docs.columns, "clean"])

    def make():
        def run(texts):
            return {made: [clean(t) for t in texts.to_pylist()]}
        return run

    def clean(value):
        if value is None:
            return None
        parts, at = [], 0
        for kind, start, end, _ in sorted(find(value), key=lambda s: (s[1], -s[2])):
            if start >= at:
                parts += [value[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return "".join([*parts, value[at:]])

    added = common.append_columns(docs, make, [text], {made: (pa.string(), "string")})
    return added.select(*[F.col(f"`{made}`").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def of_kind(spans: str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def places(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) of each row."""
    found = with_spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "found").drop("text")
    base = of_kind("found", *BASE_KINDS)
    counts = [F.size(of_kind("found", k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    scores = F.concat_ws(",", F.transform("found", lambda s: F.format_number(s["score"], 2)))
    return found.select("doc_id", *counts, F.sha2(places(base), 256).alias("base_sha256"), places(F.col("found")).alias("spans"), scores.alias("scores"))
