"""Personal data: base spans against regular expressions, further spans by examples."""

import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import frame

from clientele.llm import queries
from clientele.llm.pii import _anchors, find_personal_data, personal_data

SMALL = "/root/testdata/sf0.001"
ANCHORS = _anchors()
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(sum(map(int, str(v))) for v in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple]:
    def digits(m):
        return re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
            if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


def spans(text, base):
    return [(f["kind"], f["start"], f["end"]) for f in personal_data(text, ANCHORS) if f["base"] == base]


CASES = ["a@b", "a@b.c", ".a.@-.-", "x@y.z@w.v", "é.j%x+1@ma-il.example.com.", "a@b..c", "@@a@b.c@", "1.2.3.4.5.6.7.8",
         "256.1.1.1 001.002.000255.4", "1.2.3", "999999999999999999999.1.1.1", "1.1.1.1.", "4111 1111-1111 1111",
         "4111  1111 1111 1111", "0000000000000", "+1 (017) 555-7713.", "+1", "+12", "+1 2", "+12 34567890. 3 x",
         "+1234567890123456", "++123 456 789", "+1-2-3-4-5-6-7-8-9-+1 2", "٣.٣.٣.٣", "１@２.３", "", "1", "12 ", "1-", "-1 2"]


@pytest.mark.parametrize("text", CASES)
def test_base_cases(text):
    assert spans(text, True) == base_spans(text)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="aZé0145.@+- ()_%:\n", max_size=60))
def test_base_spans_property(text):
    assert spans(text, True) == base_spans(text)


def test_random_numbers_match():
    rng = random.Random(3)
    text = "".join(rng.choice("0123456789" * 3 + ".-+ (") for _ in range(100_000))
    assert spans(text, True) == base_spans(text) and len(base_spans(text)) > 500


@pytest.mark.parametrize("text,kind,found", [
    ("write to john.d (at) mail [dot] example.org now", "email", "john.d (at) mail [dot] example.org"),
    ("mailto:jo%40example.com", "email", "jo%40example.com"),
    ("jo&#64;example.com", "email", "jo&#64;example.com"),
    ("host [2001:db8::8a2e:370:7334]:80", "ip", "2001:db8::8a2e:370:7334"),
    ("IBAN DE89 3704 0044 0532 0130 00.", "account", "DE89 3704 0044 0532 0130 00"),
    ("GB82WEST12345698765432", "account", "GB82WEST12345698765432"),
    ("Account no: AB-12345678", "account", "AB-12345678"),
    ("ssn: 078-05-1120", "account", "078-05-1120"),
    ("tel:030-1234-5678", "phone", "030-1234-5678"),
    ("ftp://user:pa55@example.com/x", "login", "user:pa55"),
])
def test_further_spans(text, kind, found):
    assert (kind, found) in [(f["kind"], f["found"]) for f in personal_data(text, ANCHORS) if not f["base"]]


@pytest.mark.parametrize("text", ["12:30:45 and 1:2", "::", "DE00 3704 0044 0532 0130 00", "account of the year 2020",
                                  "hotel:03012345678", "std::vector a::b", "http://example.com/a@b", "meet (at) noon"])
def test_no_further_span(text):
    assert spans(text, False) == []


def test_time_is_linear():
    for unit in ("a", "1", "1.", "1 ", "a@", "+1", "(at)a", "account:", "a:", "://a", "::1", "tel:(", "AB12 "):
        began = time.perf_counter()
        personal_data(unit * 100_000, ANCHORS)
        assert time.perf_counter() - began < 6, unit


def test_rows(spark, docs, rows):
    texts = [(i, t, "en", "s", 1) for i, t in enumerate([*CASES, None])] + [(None, "a@b.c", None, None, None)]
    found = find_personal_data(frame(spark, texts, clashing=True)).collect()
    text = {r[0]: r[1] or "" for r in texts}
    assert len(found) == len(texts)
    for r in found:
        assert [(f.kind, f.start, f.end) for f in r.findings if f.base] == base_spans(text[r.doc_id])
        assert all(f.found == text[r.doc_id][f.start:f.end] for f in r.findings)
    assert find_personal_data(docs).count() == len(rows)
    assert find_personal_data(frame(spark, [])).count() == 0


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = queries.op11_personal_data(spark, SMALL).collect()
    assert len(found) == len(docs)
    some = 0
    for r in found:
        want = base_spans(docs[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in KINDS]
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
        some += len(want)
    assert some > 0
