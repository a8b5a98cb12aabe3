"""Expected-value tables of the scalar functions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docsift.functions import classify, dates, sniff, text, urls, vocab
from docsift.sources import seeds


def values(spark, inputs, make, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(inputs)], f"k int, v {kind}")
    return [r["out"] for r in df.select("k", make(F.col("v")).alias("out")).orderBy("k").collect()]


def check(spark, cases, make, kind="string"):
    assert dict(zip(map(repr, cases), values(spark, list(cases), make, kind))) == {repr(k): v for k, v in cases.items()}


def test_clean_text(spark):
    check(spark, {None: "", "  a ​ b\n\tc ": "a b c", "N/A": "", "--": "", "Not Applicable": "", "none of": "none of", "　x﻿": "x"}, text.clean_text)
    check(spark, {" a  b ": "a  b"}, lambda c: text.clean_text(c, collapse=False))


def test_numbers_and_flags(spark):
    check(spark, {"0.456": "0.46", "1.7": "1.00", "-1": "0.00", "x": "0.00", None: "0.00", "NaN": "0.00", "0.7": "0.70"}, text.format_confidence)
    check(spark, {"12": "12", " 007 ": "7", "1,234": "", "": "", None: "", "-5": "-5", "3.5": ""}, text.format_int)
    check(spark, {"y": "Y", "TRUE": "Y", "1": "Y", "no": "N", None: "N", "maybe": "N"}, text.format_bool_yn)


def test_multi_enum(spark):
    check(spark, {"PA|PA|WV": "PA|WV", " NJ | XX | NY ": "NJ|NY", "n/a": "", "National": "National"}, lambda c: text.normalise_multi_enum(c, vocab.STATE_OR_REGION))


def test_dates(spark):
    cases = {
        "2026-03-01": "2026-03-01", "2026-13-45": "", "03/01/2026": "2026-03-01", "3/1/26": "2026-03-01", "3/1/70": "1970-03-01", "03-01-2026": "2026-03-01", "1 March 2026": "2026-03-01",
        "1 Mar 2026": "2026-03-01", "March 1, 2026": "2026-03-01", "mar 1 2026": "2026-03-01", "Effective date: 03/01/2026.": "2026-03-01", "Last Updated January 2026": "2026-01-01", "01/2026": "2026-01-01",
        "2026-01": "2026-01-01", "20260301": "2026-03-01", "202611": "2026-01-01", "1-Mar-2026": "2026-03-01", "2026/3/1": "2026-03-01", "Feb 30, 2026": "", "Sept 5, 2026": "", "soon": "", None: "",
    }
    check(spark, cases, dates.normalise_iso_date)


def test_printed_dates(spark):
    out = values(spark, ["Effective Date: March 1, 2026. Last reviewed 02/03/2024", "revised 2/3/24 effective 2026-01-05", "none"], dates.extract_dates)
    assert [tuple(r) for r in out] == [("2026-03-01", "2024-02-03"), ("2026-01-05", "2024-02-03"), ("", "")]


def test_canonical_url(spark):
    same = ["https://Example.com/a/?b=2&a=1", "https://example.com:443/a?a=1&b=2#x", "HTTPS://example.com//a/index.html?utm_source=x&b=2&a=1", "https://user:p@example.com/a/?a=1&b=2&gclid=1"]
    assert len(set(values(spark, same, urls.normalise_url))) == 1
    check(spark, {"http://h.org": "http://h.org/", "http://h.org:8080/x/": "http://h.org:8080/x", "nohost": "nohost", "https://h.org/?tsv=1&_type=2": "https://h.org/", "//h.org/a": "https://h.org/a"}, urls.normalise_url)
    once = values(spark, same, urls.normalise_url)
    assert values(spark, once, urls.normalise_url) == once


def test_domains_and_titles(spark):
    check(spark, {"www.a.example.com": "example.com", "a.b.co.uk": "b.co.uk", "localhost": "localhost", "": "", None: ""}, urls.registrable_domain)
    check(spark, {"https://h/assets/medical-policy_CS123_2026-01.pdf": "Medical Policy CS123 2026 01", "https://h/a/PA-list.xlsx": "PA List", "https://h/ab": "", "https://h/x%20yz": "X Yz"}, urls.title_from_url)


def test_file_names(spark):
    check(spark, {"a b%2Fc.pdf": "a_b_c.pdf", "con.txt": "file_con.txt", "???": "document", None: "document", " x__y ": "x_y", "x" * 200: "x" * 90, "a+b": "a+b"}, urls.sanitize_filename)


def test_document_urls(spark):
    cases = {
        "https://h/a.pdf": True, "https://h/a.PDF?x=1": True, "https://h/a.css": False, "https://h/view?docId=3": True, "https://h/assets/policy/x": True, "https://h/assets/logo": False,
        "https://h/page.html": False, "https://h/a.docx": True, "https://h/getfile/drug": True, "https://h/a.png?download=1": False,
    }
    check(spark, cases, urls.looks_like_document_url)


def test_policy_numbers(spark):
    make = lambda c: classify.extract_policy_number(c, F.lit(""), F.lit(""))
    check(spark, {"Policy Number: AB-123.4": "AB-123.4", "see CS123.045 here": "CS123.045", "ref 2024-0031": "2024-0031", "policy: 2024": "", "nothing": "", None: "", "Guideline no. X9Y8": "X9Y8"}, make)


def test_types(spark):
    make = lambda c: classify.classify_document_type(F.lit("https://h/x"), c, F.lit("coverage determination"))
    got = {t: tuple(r) for t, r in zip(("Prior Authorization List", "PDL 2026", "My Policy", "Hello"), values(spark, ["Prior Authorization List", "PDL 2026", "My Policy", "Hello"], make))}
    assert got == {"Prior Authorization List": ("pa_list", 0.9), "PDL 2026": ("formulary", 0.65), "My Policy": ("medical_policy", 0.65), "Hello": ("coverage_guideline", 0.5)}
    classify.check_vocabularies()
    assert set(classify.document_types()) == set(vocab.DOCUMENT_TYPE)


def test_lines_and_states(spark):
    lob = lambda c: classify.infer_line_of_business(F.lit("https://h/x"), c, F.lit("medicare medicaid"), F.lit("Exchange"))
    check(spark, {"Medicare guide": "Medicare", "Medicaid and Medicare": "Multiple", "plain": "Exchange", "support": "Commercial"}, lob)
    state = lambda c: classify.infer_state_or_region(c, F.lit("Arkansas"), F.lit(""))
    check(spark, {"https://h/nj/x": "AR|KS|NJ", "https://h/x": "AR|KS"}, state)


def states_by_rule(title, url):
    """Name by name and code by code."""
    text, low = f"{title} {url}".lower(), url.lower()
    hits = [c for n, c in vocab.STATE_NAMES if n in text] + [c for c in sorted(vocab.USPS_CODES) if re.search(rf"/{c}/|/{c}-|[/_-]{c}\.|//{c}\.", low, re.I)]
    return "|".join(list(dict.fromkeys(hits))[:6]) or ("National" if "national" in text or "all states" in text else "PA")


def test_states_in_one_reading(spark):
    draw = random.Random(7)
    bits = [*"/-_. |", "//", *vocab.USPS_CODES, "nj", "oh", "pa", *(n for n, _ in vocab.STATE_NAMES), "West Virginia", "National", "all states", "x"]
    pairs = [("".join(draw.choices(bits, k=draw.randrange(4))), "".join(draw.choices(bits, k=draw.randrange(12)))) for _ in range(600)]
    pairs += [("", "https://nj.x/oh/pa-1/de/de-2_tx.ny./vt/nh/me.x"), ("Guam|x", "/nj/nj/"), ("", "//as./mp-/in_or.")]
    df = spark.createDataFrame([(k, t, u) for k, (t, u) in enumerate(pairs)], "k int, t string, u string")
    made = df.select("k", classify.infer_state_or_region(F.col("u"), F.col("t"), F.lit("PA|XX")).alias("s"))
    assert [r["s"] for r in made.orderBy("k").collect()] == [states_by_rule(t, u) for t, u in pairs]
    # one pattern for all codes, and no interpreted list of all names and codes
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 4 and "filter(array(" not in plan


def test_sniffing(spark):
    cases = {b"%PDF-1.7": "pdf", b"PK\x03\x04xx": "zip", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1": "ole", b"{\\rtf1": "doc", b"  <?xml version": "xml", b"x <HTML>": "html", b"plain": "", b"": "", None: ""}
    check(spark, cases, sniff.sniff_kind, "binary")
    make = lambda c: sniff.detect_file_type(F.encode(c, "UTF-8"), F.lit("text/html; charset=x"), F.lit("https://h/a.pdf"))
    check(spark, {"plain": "html", "%PDF-": "pdf", "PK\x03\x04": "other"}, make)
    assert values(spark, [b"caf\xe9", "café".encode()], sniff.decode_text, "binary") == ["café", "café"]
    declared = [(b"caf\xe9", "iso-8859-1", "café"), ("жук".encode("cp1251"), "windows-1251", "жук"), ("łódź".encode("iso8859-2"), "ISO-8859-2", "łódź"), (b"\xd2\xe9", "iso-8859-7", b"\xd2\xe9".decode("cp1252")), ("café".encode(), "gb18030", "café"), (b"\x93q\x94", "cp1252", "“q”"), (b"a", None, "a"), (None, "koi8-r", "")]
    df = spark.createDataFrame([(k, c, d) for k, (c, d, _) in enumerate(declared)], "k int, c binary, d string")
    assert [r["t"] for r in df.select("k", sniff.decode_text(df["c"], df["d"]).alias("t")).orderBy("k").collect()] == [t for *_, t in declared]


def test_walls_and_gates(spark):
    headers = F.create_map(F.lit("server"), F.lit("x"))
    wall = lambda c: sniff.challenge(F.lit(200), headers, F.encode(c, "UTF-8"))
    check(spark, {"<html>Just a moment": "just a moment", "<html>fine": "", "%PDF-captcha": "", "CAPTCHA": "captcha"}, wall)
    gate = lambda c: sniff.auth_gate(F.lit(200), F.encode(c, "UTF-8"), F.lit("https://h/login?x"))
    check(spark, {"Please sign in": "please sign in", "x": "redirected_to_login"}, gate)


def test_range():
    assert seeds.parse_range("1-3,8", 10) == [1, 2, 3, 8]
    assert seeds.parse_range("all", 3) == seeds.parse_range(None, 3) == seeds.parse_range("*", 3) == [1, 2, 3]
    for bad in ("0", "11", "3-1", "x", "1-11", ","):
        with pytest.raises(ValueError):
            seeds.parse_range(bad, 10)


def test_title_key(spark):
    check(spark, {"Medical Policy: Bariatric Surgery (Effective 03/01/2026)": "bariatric surgery", "Bariatric Surgery Medical Policy - Revised 2025": "bariatric surgery", "Policy": "", None: "", "Drug List Q1 2026 final": "drug list"}, text.title_key)
