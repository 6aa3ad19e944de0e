import pytest

from textassay.functions.patterns import PII_PATTERNS
from textassay.operators import pii as P

CASES = {
    "write to a@b.co now": {"email"},
    "ODD@EXAMPLE.ORG": {"email"},
    "a @b.co": set(),
    "a@b.c": set(),
    "xſ@b.coK": {"email"},
    "3105551234": {"telefono", "cedula"},
    "310-555-1234": set(),
    "310 555 1234": {"telefono"},
    "310 555 1234": {"telefono"},
    "+57 6015551234": {"telefono", "cedula"},
    "6095551234": {"cedula"},
    "993105551234": {"telefono"},
    "256.1.1.1": set(),
    "1.2.3.4": {"ipv4"},
    "1.2.3.4.5": {"ipv4"},
    "v1.2.3.4": set(),
    "ñ1.2.3.4": set(),
    "ñ12345678": set(),
    "\U0001d49c12345678": set(),
    "\U0001f64212345678": {"cedula"},
    "12345678ñ": set(),
    "1.234.567": set(),
    "123.456.789": {"cedula"},
    "1234.567.890": {"cedula"},
    "02345678": set(),
    "12345678": {"cedula"},
    "12345678901": set(),
    "http://u:p@h/": {"credenciales_url"},
    "https://user:pa ss@h": set(),
    "https://user@h": set(),
    None: set(),
    "": set(),
}


def test_categories(texts):
    rows = P.pii_any(P.pii_flags(texts(*CASES))).collect()
    found = {r["text"]: {p.category for p in PII_PATTERNS if r[p.column]} for r in rows}
    assert found == CASES
    assert all(r["pii_any"] == bool(CASES[r["text"]]) for r in rows)


def test_report_and_expected_hits(texts):
    flagged = P.pii_any(P.pii_flags(texts("a@b.co", "c@d.org 1.2.3.4", "none", None)))
    report = {r["category"]: (r["docs"], r["pct"]) for r in P.pii_report(flagged).collect()}
    assert report == {
        "email": (2, 50.0), "telefono": (0, 0.0), "ipv4": (1, 25.0), "cedula": (0, 0.0), "credenciales_url": (0, 0.0), "any": (2, 50.0),
    }
    estimate = {r["category"]: (r["fp_rate"], r["expected_true"]) for r in P.pii_fp_estimate(flagged).collect()}
    assert estimate["email"] == (0.03, 1.94)
    assert estimate["ipv4"] == (0.42, 0.58)
    assert set(estimate) == {p.category for p in PII_PATTERNS}


def test_empty_corpus(texts):
    rows = P.pii_report(P.pii_any(P.pii_flags(texts("a").where("false")))).collect()
    assert {(r["docs"], r["pct"]) for r in rows} == {(0, 0.0)}


@pytest.mark.parametrize("text", ["a" * 300_000, "1." * 100_000, "@" * 100_000, "<" * 5_000, "3" * 100_000])
def test_long_odd_texts_end(texts, text):
    assert P.pii_flags(texts(text)).count() == 1
