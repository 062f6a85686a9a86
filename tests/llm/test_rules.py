"""Verdicts on deep branches, and spans that lie on one another."""

import random
import re

import pytest

from telemetry_spark.llm import pii, url_filter


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_branches_below_the_third_segment_are_judged_apart(spark):
    rules = (("block", "x.org/a/b/c/spam/"), ("allow", "x.org/a/b/c/good/"))
    urls = [f"http://x.org/a/b/c/spam/p{i}" for i in range(14)] + [f"http://x.org/a/b/c/good/p{i}" for i in range(10)]
    # rules decide by prefix, so what no rule fits lies on hosts of its own with the labelled ones
    deep = [("block", "y.org/1/2/3/4/5/spam/x"), ("allow", "y.org/1/2/3/4/5/good/x")]
    urls += [f"http://y.org/1/2/3/4/5/spam/x{i}" for i in range(14)] + [f"http://y.org/1/2/3/4/5/good/x{i}" for i in range(10)]
    asked = ["http://y.org/1/2/3/4/5/spam/q", "http://y.org/1/2/3/4/5/good/q"]
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages(spark, urls + asked), rules=(*rules, *deep)).collect()}
    verdicts = [got[i]["verdict"] for i in range(len(urls), len(urls) + 2)]
    assert verdicts == ["block", "allow"]
    assert got[len(urls)]["rule"] is None and got[len(urls)]["template"].count("/") == 7
    assert {got[i]["verdict"] for i in range(14)} == {"block"} and {got[i]["verdict"] for i in range(14, 24)} == {"allow"}


def test_very_deep_and_odd_paths(spark):
    long = "http://z.org" + "/s" * 3000
    urls = [long, long, "http://z.org", "http://z.org/", "http://z.org//", "http://z.org//a", None, "no url", "http://z.org/a//b/"]
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages(spark, urls)).collect()}
    assert len(got) == len(urls) and got[0]["template"] == "/s" * 3000 and got[6]["host"] == got[7]["host"] == ""
    assert [got[i]["template"] for i in (2, 3, 4, 5, 8)] == ["", "/", "//", "//a", "/a//b/"]
    wide = [f"http://w.org/k/{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'xyz'[i // 26]}/tail" for i in range(78)]
    assert {r["template"] for r in url_filter.judge_urls(pages(spark, wide)).collect()} == {"/k/*/tail"}


IBAN = "DE89370400440532013000"


@pytest.mark.parametrize("addresses", [1, 10, 40])
def test_no_added_span_lies_on_a_base_one(addresses):
    ips = "_".join(f"10.0.0.{i}" for i in range(addresses))
    text = f"iban {ips}%{IBAN}%x@mail.example.org and {IBAN} account"
    spans = pii.find_spans(text)
    base = [(s, e) for k, s, e, _ in spans if k in pii.BASE]
    added = [(s, e) for k, s, e, _ in spans if k not in pii.BASE]
    assert sum(k == "email" for k, *_ in spans) == 1 and len(added) == 1
    assert not any(s < e2 and s2 < e for s, e in added for s2, e2 in base)


def test_spans_of_random_texts_keep_clear():
    draw = random.Random(4)
    parts = [IBAN, "iban ", "card ", "10.1.2.3", "a@b.cd", "4111111111111111", "378282246310005", " ", "-", "+1 555 010 1234", "x", "%", "078-05-1120", "ssn "]
    for _ in range(400):
        spans = pii.find_spans("".join(draw.choices(parts, k=30)))
        base = [(s, e) for k, s, e, _ in spans if k in pii.BASE]
        assert not any(s < e2 and s2 < e for k, s, e, _ in spans if k not in pii.BASE for s2, e2 in base)


def test_ibans_of_unregistered_countries_need_a_word():
    def valid(country, body):
        turned = (body + country + "00").translate(pii.VALUES)
        return f"{country}{98 - int(turned) % 97:02}{body}"

    code = valid("QX", "AB12C9F00K77")
    assert pii.mod97(code) and not pii.find_spans(f"the part {code} is out of stock")
    assert [s[0] for s in pii.find_spans(f"bank account {code} is closed")] == ["iban"]
    assert [s[0] for s in pii.find_spans(f"the part {IBAN} is out of stock")] == ["iban"]
    draw = random.Random(1)
    codes = ["QX" + "".join(draw.choices("0123456789", k=2)) + "".join(draw.choices("ABCDEF0123456789", k=20)) for _ in range(2000)]
    assert not any(pii.find_spans(f"part {re.sub('(.{4})', r'\\1 ', c)} sold") for c in codes)
