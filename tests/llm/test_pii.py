"""Spans against plain patterns, checks and context."""

import hashlib
import random
import re
import time

from lakeplan.llm import pii
from tests.llm import cases

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = re.sub(r"[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(kind, m.start(), m.end()) for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(kind, m.group())]


PIECES = ["a", "1", "23", "@", ".", "-", "+", " ", "(", ")", "%", "é", "🙂", "a@b.co", "x.y@z-1.example.com", "10.0.0.1", "256.1.1.1", "1.2.3",
          "4111 1111 1111 1111", "5500-0000-0000-0004", "+1 (743) 555-3824", "+49 30 123456", "_", "0", "00", "\n", "@@", "..", "DE89 3704 0044 0532 0130 00"]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    for _ in range(6000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == brute(text), text
        kept = [s[:3] for s in pii.find(text) if s[0] in pii.BASE_KINDS]
        assert kept == brute(text)


def test_checks_and_context():
    assert [s[0] for s in pii.find("transfer to DE89 3704 0044 0532 0130 00 today")] == ["iban"]
    assert pii.find("DE89 3704 0044 0532 0130 01") == []
    assert pii.find("GB82WEST12345698765432")[0][:3] == ("iban", 0, 22)
    assert [s[0] for s in pii.find("her social security number 123-45-6789")] == ["ssn"]
    assert pii.find("order 123-45-6789") == [] == pii.find("123-45-6789") == pii.find("ssn 666-45-6789")
    assert [s[0] for s in pii.find("call me at (743) 555-3824")] == ["national"] and pii.find("part (743) 555-3824") == []
    near, far = pii.find("card 4111111111111111")[0][3], pii.find("order 4111111111111111")[0][3]
    assert near > pii.find("4111111111111111")[0][3] > far
    assert [s[0] for s in pii.find("phone +1 743-555-3824")] == ["phone"], "what a base span covers is not proposed again"


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1(" * 100_000, "1 " * 200_000, "AA00" * 100_000, "123-45-6789 " * 20_000):
        pii.find(text)
    assert time.perf_counter() - start < 30


def test_report_and_redaction(spark):
    extra = "mail me: jane.doe@example.com or +1 (743) 555-3824 🙂 card 4111 1111 1111 1111; 10.0.0.1"
    docs = cases.with_clashes(cases.awkward(spark))
    docs = docs.unionByName(docs.limit(1).selectExpr("99L AS doc_id", f"'{extra}' AS text", *[f"`{c}`" for c in docs.columns[2:]]))
    got = pii.report(docs).collect()
    assert len(got) == docs.count()
    texts = docs.select("doc_id", "text").collect()

    def row(doc_id, text):
        base, spans = brute(text), pii.find(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        counts = [sum(b[0] == k for b in base) for k in pii.BASE_KINDS]
        return (str(doc_id), *counts, hashlib.sha256(joined.encode()).hexdigest(), ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans),
                ",".join(f"{x:.2f}" for *_, x in spans))

    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(row(r.doc_id, r.text) for r in texts)
    clean = pii.redacted(docs)
    assert clean.columns == docs.columns
    assert clean.filter("doc_id = 99").first().text == "mail me: [EMAIL] or [PHONE] 🙂 card [CARD]; [IP]"
    assert clean.filter("text IS NULL").count() == docs.filter("text IS NULL").count()
    assert pii.report(cases.empty(spark)).collect() == [] == pii.redacted(cases.empty(spark)).collect()
    found = pii.with_spans(docs, "n").filter("doc_id = 99").first().n
    assert [s.kind for s in found] == ["email", "ip", "card", "phone"]
