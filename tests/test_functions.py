from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierlens.functions import text as T
from tierlens.functions import url as U


def ask(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(("raw", "want"), [("  HTTPS://Www.Nimo.Test/a?b ", "www.nimo.test"), ("nimo.test:8080/x", "nimo.test:8080"), ("nimo.test?q=1", "nimo.test"), (None, ""), ("", "")])
def test_normalize_domain(spark, raw, want):
    assert ask(spark, raw, U.normalize_domain) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("a/b/", "/a/b"), ("https://Nimo.test/a/?utm_source=x&b=2#top", "/a?b=2"), ("/a?gclid=1", "/a"), ("", "/"), (None, "/"), ("/?utm_campaign=z", "/"), ("/x?b=2&fbclid=q&&a=%20", "/x?b=2&a=%20")],
)
def test_normalize_path(spark, raw, want):
    assert ask(spark, raw, U.normalize_path) == want


@pytest.mark.parametrize(("raw", "want"), [("HTTP://WWW.Nimo.test/A/?utm_x=1#f", "http://www.nimo.test/A"), ("https://nimo.test", "https://nimo.test/"), ("/jobs/", "/jobs"), ("https://nimo.test/a;p?q=1", "https://nimo.test/a?q=1")])
def test_page_key(spark, raw, want):
    assert ask(spark, raw, U.page_key) == want


@pytest.mark.parametrize(("raw", "want"), [("https://user@WWW.Nimo.test:80/x", "nimo.test"), ("nimo.test/x", "nimo.test"), ("", ""), (None, "")])
def test_host(spark, raw, want):
    assert ask(spark, raw, U.host) == want


def test_hosts_below_others(spark):
    assert ask(spark, "a.lever.co", lambda c: U.under(c, ("lever.co",))) is True
    assert ask(spark, "clever.co", lambda c: U.under(c, ("lever.co",))) is False
    assert ask(spark, "x.y.nimo.test", U.registrable) == "nimo.test"
    assert ask(spark, "no%20host", U.is_plausible_host) is False and ask(spark, "nimo.test", U.is_plausible_host) is True


@pytest.mark.parametrize(("path", "want"), [("/jobs/x", "careers"), ("/open-roles", "careers"), ("/my-open-roles-x", "other"), ("/press", "news"), ("/trust", "security"), ("/legal", "procurement"), ("/team", "company"), ("/pricing", "other")])
def test_page_type(spark, path, want):
    assert ask(spark, path, U.page_type) == want


@pytest.mark.parametrize(("url", "want"), [("https://nimo.test/solutions/recruiters", ""), ("https://jobs.lever.co/nimo", "careers"), ("https://nimo.test/recruit/", "careers"), ("https://nimo.test/blog", "news"), ("https://nimo.test/x", "")])
def test_link_type(spark, url, want):
    assert ask(spark, url, lambda c: U.link_type(c, F.lit(None).cast("string"))) == want


@pytest.mark.parametrize(("href", "want"), [("/a", "https://n.test/a"), ("b", "https://n.test/x/b"), ("../b", "https://n.test/b"), ("//m.test/c", "https://m.test/c"), ("?q", "https://n.test/x/y?q"), ("http://[bad", None), ("https://o.test/", "https://o.test/")])
def test_join_url(spark, href, want):
    assert ask(spark, href, lambda c: U.join_url(F.lit("https://n.test/x/y"), c)) == want


def test_acquirer(spark):
    assert ask(spark, "https://big.test/careers", lambda c: U.acquirer(c, F.lit("small.test"))["slug"]) == "big"
    assert ask(spark, "https://jobs.lever.co/x", lambda c: U.acquirer(c, F.lit("small.test"))["acquired"]) is False


def test_hits_and_snippets(spark):
    assert ask(spark, "job jobs a-job job.", lambda c: T.hits(c, "job")) == 3
    assert ask(spark, "採用採用 x", lambda c: T.hits(c, "採用")) == 2
    text = "x" * 300 + " the AUDIT came " + "y" * 300
    got = ask(spark, text, lambda c: T.snippet(c, F.array(F.lit("none"), F.lit("audit"))))
    assert "AUDIT" in got and len(got) == 365
    assert ask(spark, None, lambda c: T.snippet(c, F.array(F.lit("a")))) == ""
    assert ask(spark, "a\x00b \n c", T.clean) == "a b c"


def test_page_diagnoses(spark):
    assert ask(spark, "<TITLE> Just a moment</title>", T.is_soft_block) is True and ask(spark, None, T.is_soft_block) is False
    assert ask(spark, "<script>x</script><p>a  b</p>", T.extracted_length) == 3
    shell = "<div id='root'></div>" + " " * 600
    assert ask(spark, shell, lambda c: T.is_js_shell(c, F.lit(""))) is True
    chrome = "Filters All departments Any locations No open jobs " + "z " * 150
    assert ask(spark, chrome, lambda c: T.is_chrome_shell(F.lit(""), c)) is True
    assert ask(spark, shell, lambda c: T.render_hint(c, F.lit(""), F.lit(None).cast("string"), F.lit("careers"))) == "js_shell"
    assert ask(spark, "same", lambda c: T.render_hint(F.lit(""), c, F.lit("same "), F.lit("other"))) == "stub"


@pytest.mark.parametrize(("text", "want"), [(None, "unknown"), ("my resume curriculum vitae", "personal_resume"), ("add to cart " + "x " * 100, "consumer_or_local"), ("tiny", "parked_or_thin"), ("our platform " * 20, "company_like")])
def test_hygiene(spark, text, want):
    assert ask(spark, text, T.hygiene) == want


@pytest.mark.parametrize(("raw", "want"), [("B2B SaaS", "b2b_saas"), ("not saas", "not_saas"), ("b2b_saas or not_saas", "unknown"), (None, "unknown"), ("It is B2B-SaaS!", "b2b_saas")])
def test_coerce_label(spark, raw, want):
    assert ask(spark, raw, lambda c: T.coerce_label(c, "b2b_saas", "not_saas")) == want
