from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlens.operators import evidence, hops


def one(spark, c):
    return spark.range(1).select(c).first()[0]


@pytest.mark.parametrize(
    ("url", "bad"),
    [("https://login.lever.co/x", True), ("https://jobs.lever.co/{{slug}}", True), ("https://n.icims.com/login", True), ("https://n.icims.com/jobs/1", False), ("https://www.workable.com", True), ("https://n.workable.com/", False), ("https://n.test/privacy-policy", True), ("https://apply.workable.com/oops", True), ("https://jobs.lever.co/n", False), (None, False)],
)
def test_utility_urls(spark, url, bad):
    assert one(spark, hops.is_utility_url(F.lit(url).cast("string"))) is bad


def test_extractions(spark):
    assert one(spark, hops.widget_board_url(F.lit("https://boards.eu.greenhouse.io/embed/job_board/js?for=n"))) == "https://job-boards.eu.greenhouse.io/embed/job_board?for=n"
    assert one(spark, hops.widget_board_url(F.lit("https://n.bamboohr.com/js/embed.js"))) == "https://n.bamboohr.com/careers" and one(spark, hops.widget_board_url(F.lit("https://n.test"))) is None
    assert [tuple(r) for r in one(spark, hops.board_tokens(F.lit('{"boardToken":"n1","lever_site": "n2","boardToken":"n1"}')))] == [("greenhouse", "n1"), ("lever", "n2")]
    assert one(spark, hops.careers_urls(F.lit("see https://n.test/careers/x and https://n.test/about"))) == ["https://n.test/careers/x"]
    assert one(spark, hops.social_job_tabs(F.lit("https://www.linkedin.com/company/n/jobs"))) == ["https://www.linkedin.com/company/n/jobs"]
    assert one(spark, hops.is_thin_splash(F.lit("<a x>"), F.lit(0))) is True and one(spark, hops.is_thin_splash(F.lit("<a x>"), F.lit(1))) is False


def test_expansion(spark):
    site = {"/careers": '<a href="/jobs">jobs</a><a href="/careers/culture">careers</a><a href="/careers">careers</a>', "/jobs": '<a href="/jobs/field-engineer">job</a><a href="/careers">careers</a>', "/jobs/field-engineer": '<a href="/jobs">jobs</a>'}
    html = spark.createDataFrame(list(site.items()), "path string, html string")

    def fetch(targets):
        return targets.join(html, "path").select("domain", F.concat(F.lit("https://n.test"), F.col("path")).alias("base_url"), "html")

    start = spark.createDataFrame([("n.test", "/careers", "https://n.test/careers")], "domain string, path string, url string")
    assert rows(hops.expand(start, fetch).select("path", "hop")) == [("/careers", 0), ("/jobs", 1), ("/jobs/field-engineer", 2)]


def test_first_by_final_url(spark):
    df = spark.createDataFrame([("d", "/a", "https://n.test/x/", True, 2), ("d", "/b", "https://n.test/x", True, 1), ("d", "/c", None, False, 3)], "domain string, path string, url string, ok boolean, pos int")
    assert rows(hops.first_by_final_url(df).select("path")) == [("/b",), ("/c",)]


def test_hiring_gate(spark):
    ask = lambda terms, text, trust: one(spark, evidence.credible_hiring(F.array(*map(F.lit, terms)), F.lit(text), F.lit(trust)))
    assert ask(["job openings"], "job openings", "company_site") is True
    assert ask(["job openings"], "Currently no job openings", "company_site") is False
    assert ask(["apply"], "apply", "linked_ats_candidate") is True and ask(["apply"], "apply", "company_site") is False
    assert ask(["apply"], "Department Office Apply", "company_site") is True
    near = lambda text: one(spark, evidence.near_job_context(F.lit(text), F.array(F.lit("okta"))))
    assert near("okta " + "x" * 600 + " job") is False and near("okta and the role") is True
