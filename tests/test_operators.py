from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlens.operators import boards, evidence, links, postings, select, store
from tierlens.plans import rubric as R
from tierlens.runtime import salted_join
from tierlens.sources import domains, transport


def test_rubric_scores(spark):
    r = R.Rubric.of({"name": "r", "positive_label": "yes", "negative_label": "no", "positive": ["good"], "negative": ["bad"]})
    df = spark.createDataFrame([(1, "good good bad"), (2, "good"), (3, None), (4, "bad bad bad"), (5, "good good good bad")], "id int, text string")
    got = {x.id: (x.label, x.confidence) for x in R.score(df, r).collect()}
    assert got == {1: ("ambiguous", 0.333), 2: ("ambiguous", 1.0), 3: ("ambiguous", 0.0), 4: ("no", 1.0), 5: ("ambiguous", 0.5)} | {5: ("ambiguous", 0.5)}
    v = {x.id: (x.label, x.method, x.reason) for x in R.verdicts(df, r, "id").collect()}
    assert v[3] == ("unreachable", "fetch_failed", "no content after cascade") and v[4][2] == "pos=0 neg=3"
    with pytest.raises(ValueError):
        R.Rubric.of({"name": "x"})
    with pytest.raises(ValueError):
        R.parse_quota("careers=-1")
    assert R.parse_quota("careers=2, news=1") == {"careers": 2, "news": 1}


def test_page_specs(spark):
    r = R.Rubric.of({"name": "r", "positive_label": "a", "negative_label": "b", "crawl_paths": [{"page_type": "careers", "paths": ["jobs/", "/about"], "evidence_terms": ["x"]}, {"paths": ["/jobs", "/press"], "evidence_terms": ["y"]}]})
    got = {x.path: (x.page_type, x.evidence_terms) for x in R.page_specs(spark, r).collect()}
    assert got == {"/jobs": ("careers", ["x", "y"]), "/about": ("careers", ["x"]), "/press": ("news", ["y"])}


def test_store(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "keep"), ("c", None, "null")], "k string, v int, t string")
    new = spark.createDataFrame([("a", 2, "y"), ("b", 5, "new"), ("d", None, None)], "k string, v int, t string")
    assert rows(store.upsert(old, new, ["k"], "v")) == [("a", 2, "y"), ("b", 5, "new"), ("c", None, "null"), ("d", None, None)]
    again = store.upsert(store.upsert(old, new, ["k"], "v"), new, ["k"], "v")
    assert rows(again) == rows(store.upsert(old, new, ["k"], "v"))
    assert rows(store.upsert(old.limit(0), new.limit(0), ["k"], "v")) == []
    p = spark.createDataFrame([("d", "/a/", 1, True, 1, "u"), ("d", "/a", 2, False, 2, None)], "domain string, path string, dpage_id long, linked_from_homepage boolean, fetched_at int, text string")
    assert rows(store.upsert_pages(p).select("path", "dpage_id", "linked_from_homepage")) == [("/a", 2, True)]
    g = store.replace_groups(old.withColumn("g", F.lit(1)), new.withColumn("g", F.lit(1)).where("k = 'd'"), ["g"], ["k"], "v")
    assert [r["k"] for r in g.collect()] == ["d"]


def sequential(items, cap, quota, order):
    """The selection rule step by step, quotas and then rounds that serve every type once: items are (type, priority, pos)."""
    types = list(order) + [t for t in dict.fromkeys(i[0] for i in sorted(items, key=lambda i: i[2])) if t not in order]
    queues = {t: sorted((i for i in items if i[0] == t), key=lambda i: (i[1], i[2])) for t in types}
    out = []
    for t in types:
        for _ in range(quota.get(t, 0)):
            if queues[t]:
                out.append(queues[t].pop(0))
    taken = {t: sum(o[0] == t for o in out) for t in types}
    while any(queues.values()):
        for t in sorted((t for t in types if queues[t]), key=lambda t: (taken[t], types.index(t))):
            out.append(queues[t].pop(0))
            taken[t] += 1
    return out[:cap]


def test_balanced_selection_against_the_sequential_rule(spark):
    rng, data, want = random.Random(3), [], {}
    for d in range(40):
        items = [(rng.choice(["careers", "news", "security", "other"]), rng.randint(0, 1), i) for i in range(rng.randint(0, 9))]
        data += [(f"d{d}", f"/p{i[2]}", None, i[0], i[1] == 0, i[2]) for i in items]
        want[f"d{d}"] = [f"/p{i[2]}" for i in sequential(items, 5, {"careers": 1}, ["security"])]
    df = spark.createDataFrame(data, "domain string, path string, url string, page_type string, linked_from_homepage boolean, pos int")
    got = {}
    for r in select.balanced(df, 5, {"careers": 1}, ["security"]).orderBy("domain", "rank").collect():
        got.setdefault(r.domain, []).append(r.path)
    assert got == {d: p for d, p in want.items() if p}
    assert select.balanced(df, 0).count() == 0 and select.balanced(df, None).count() == len(data)


def test_links(spark):
    html = '<a href="/jobs?utm_source=x">Jobs</a><a href="#x">no</a><a href="mailto:a@b.test">m</a><a href="https://x.com/n">x</a><a href="/jobs">again</a><a href="https://jobs.lever.co/nimo">Board</a><a href="http://[bad">bad job</a><a href="/careers.css">careers</a>'
    p = spark.createDataFrame([("nimo.test", "https://nimo.test/", html), ("void.test", "https://void.test/", None)], "domain string, base_url string, html string")
    assert rows(links.page_targets(p).select("path", "page_type")) == [("/jobs", "careers"), ("https://jobs.lever.co/nimo", "careers")]
    one = p.limit(1).select(links.sitemap_locations(F.lit("<loc> a </loc><LOC>b</LOC>")), links.robots_sitemaps(F.lit("x\nSitemap: https://n.test/s.xml")), links.outbound_domains(F.lit("see other.io, nimo.com and x.com"), F.lit("nimo.com"))).first()
    assert list(one) == [["a", "b"], ["https://n.test/s.xml"], ["other.io"]]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://boards.greenhouse.io/embed/job_board?for=nimo", ("greenhouse", "nimo")), ("https://job-boards.eu.greenhouse.io/nimo/jobs/1", ("greenhouse", "nimo")), ("jobs.lever.co/nimo/1", ("lever", "nimo")), ("https://api.lever.co/x", None),
        ("https://apply.workable.com/j/ABC", None), ("https://nimo.workable.com/", ("workable", "nimo")), ("https://ats.rippling.com/en-US/nimo/jobs", ("rippling", "nimo")),
        ("https://nimo.wd5.myworkdayjobs.com/en-US/Site/job/X/Y_1", ("workday", "nimo/Site")), ("https://careers-nimo.icims.com/jobs", ("icims", "nimo")), ("https://nimo.icims.com/jobs", None),
        ("https://workforcenow.adp.com/x.html?cid=12", ("adp", "12")), ("https://www.breezy.hr", None), ("https://nimo.test", None),
    ],
)
def test_boards(spark, url, want):
    got = spark.range(1).select(boards.board_of(F.lit(url))).first()[0]
    assert (tuple(got) if got else None) == want


def test_board_counts_and_guesses(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    got = one(boards.counts_from_json(F.lit("greenhouse"), F.lit('{"jobs":[{"title":"A"},{"title":""}],"meta":{"total":7}}')))
    assert tuple(got) == (7, ["A"], [])
    assert tuple(one(boards.counts_from_json(F.lit("greenhouse"), F.lit('{"jobs":[]}')))) == (0, [], [])
    assert one(boards.counts_from_json(F.lit("greenhouse"), F.lit("nothing"))) is None
    assert tuple(one(boards.counts_from_json(F.lit("ashby"), F.lit('{"jobs":[{"title":"A","isListed":false},{"title":"B"}]}')))) == (1, ["B"], [])
    assert one(boards.slug_guesses(F.lit("www.goshippo.com"))) == ["goshippo", "Goshippo", "shippo", "Shippo", "goshippoinc", "Goshippoinc"]
    assert one(boards.slug_guesses(F.lit("work.com")))[0] == "work" and one(boards.slug_guesses(F.lit(None).cast("string"))) == []
    assert one(boards.board_url(F.lit("rippling"), F.lit("n"))) == "https://ats.rippling.com/n/jobs"


def test_evidence(spark):
    homes = spark.createDataFrame([("n.test", "https://n.test", "our platform for customers " * 9)], "domain string, url string, text string")
    pages = spark.createDataFrame(
        [("n.test", "/careers", "https://n.test/careers", "careers", True, True, "Open roles: apply"), ("n.test", "/x", "https://o.test/x", "news", True, False, "we raised funding"), ("m.test", "/y", None, "news", False, False, None)],
        "domain string, path string, url string, page_type string, ok boolean, linked_from_homepage boolean, text string",
    )
    got = rows(evidence.evidence_rows(pages, homes).select("source_trust", "evidence_tier", "evidence_type", "evidence_status", "match_count"))
    assert got == [("company_site", "A", "hiring_activity", "trusted_source_candidate", 2), ("fetch_failed", "Rejected", "none", "fetch_failed", 0), ("untrusted_external", "C", "funding_or_growth", "untrusted_source_candidate", 2)]


def test_embedded_postings(spark):
    blob = '{"jobs":[{"id":1,"jobTitle":"Field Engineer","location":{"name":"Nimo"},"employmentType":"full"},{"id":1,"jobTitle":"Field Engineer","location":"x"},{"jobTitle":"Old","status":"closed","salary":"1"}],"team":[{"name":"Ann","firstName":"Ann","bio":"b","title":"CEO"}],"nav":[{"title":"Home","url":"/"}]}'
    html = f'<script id="__NEXT_DATA__" type="application/json">{blob}</script>'
    df = spark.createDataFrame([("n.test", "https://n.test/jobs", html), ("m.test", "https://m.test", "<script type='application/json'>{broken</script>"), ("z.test", None, None)], "domain string, url string, html string")
    assert [(r.title, r.location, r["count"]) for r in postings.embedded_postings(df).collect()] == [("Field Engineer", "Nimo", 1)]


def test_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_text("﻿https://Nimo.test/x\nnimo.test\n\nother.test\n", encoding="utf-8")
    assert [r.domain for r in domains.read_domains(spark, str(tmp_path / "a.txt")).orderBy("pos").collect()] == ["nimo.test", "other.test"]
    (tmp_path / "b.csv").write_text("name,website\nN,https://b.test\nM,a.test\n")
    assert [r.domain for r in domains.read_domains(spark, str(tmp_path / "b.csv"), limit=1).collect()] == ["b.test"]
    with pytest.raises(ValueError):
        domains.column_index(["a", "b"], "zz")

    def fetch(url):
        if "bad" in url:
            raise RuntimeError("no")
        return (200, "x" * 600) if url.startswith("http://www.") else (0, None)

    got = {r.domain: (r.ok, r.error) for r in transport.fetch_all(spark.createDataFrame([("ok.test",), ("bad.test",)], "domain string"), fetch).collect()}
    assert got == {"ok.test": (True, None), "bad.test": (False, "RuntimeError")}
    assert transport.backoff(9, jitter=lambda: 0) == 8.0


def test_salted_join(spark):
    big = spark.range(100).select(F.lit("hot").alias("k"), "id")
    small = spark.createDataFrame([("hot", 1), ("cold", 2), (None, 3)], "k string, v int")
    assert salted_join(big, small, ["k"], "id", "inner").count() == 100
    assert salted_join(big, small.where("k = 'cold'"), ["k"], "id", "left_anti").count() == 100
