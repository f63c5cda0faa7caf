"""More registered queries: boards and their JSON, embedded postings, selection, exports; with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fixed
from .functions import text as T
from .functions import url as U
from .operators import boards, evidence, export, links, postings, select, store
from .streaming.micro import windowed_counts

PLATFORMS = tuple(boards.SHAPES)
_BOARDS = tuple(fixed.BOARD_URLS)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _postings(spark, d):
    """Distinct (domain, id, title, location, department) of the stored postings."""
    p = _t(spark, d, "ssr_postings").where("posting_key is not null and title <> '' and domain is not null")
    return p.groupBy("domain", "posting_key").agg(F.max("title").alias("title"), F.max("location").alias("location"), F.max("department").alias("department"))


def _bodies(spark, d):
    """(domain, ats, body): the stored postings of a domain as the JSON of every platform."""
    # one aggregate for all platforms, by the id that is the first value of each shape; then each board of each platform goes its own way, for
    # parsing is far dearer than its bytes show, and a number of partitions that is named is not made smaller
    p = _postings(spark, d).groupBy("domain").agg(F.sort_array(F.collect_list(F.struct("posting_key", "title", "location", "department"))).alias("rows"))
    p = p.select("domain", "rows", F.explode(F.array(*[F.lit(x) for x in PLATFORMS])).alias("ats")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "domain", "ats")
    label = lambda r, name="name": F.struct(r["department"].alias(name))
    place = lambda r: F.struct(r["location"].alias("name")).alias("location")
    key = lambda r, name="id": r["posting_key"].alias(name)
    item = {
        "greenhouse": (lambda r: F.struct(key(r), r["title"], place(r), F.array(label(r)).alias("departments")), "jobs"),
        "lever": (lambda r: F.struct(key(r), r["title"].alias("text"), F.struct(r["location"], r["department"].alias("team")).alias("categories")), None),
        "ashby": (lambda r: F.struct(key(r), r["title"], r["location"], F.lit(True).alias("isListed"), r["department"].alias("departmentName")), "jobs"),
        "smartrecruiters": (lambda r: F.struct(key(r), r["title"].alias("name"), place(r), label(r, "label").alias("department")), "content"),
        "workable": (lambda r: F.struct(key(r, "shortcode"), r["title"], r["department"], r["location"]), "results"),
        "recruitee": (lambda r: F.struct(key(r), r["title"], r["department"], r["location"], F.lit("published").alias("status")), "offers"),
        "pinpoint": (lambda r: F.struct(key(r), F.struct(r["title"], r["department"], r["location"]).alias("attributes")), "data"),
        "rippling": (lambda r: F.struct(key(r, "uuid"), r["title"].alias("name"), label(r).alias("department")), "items"),
        "breezy": (lambda r: F.struct(key(r), r["department"], r["title"].alias("name"), place(r)), None),
        "workday": (lambda r: F.struct(key(r), r["title"]), "jobPostings"),
    }
    body = F.lit(None).cast("string")
    for ats, (shape, at) in item.items():
        rows = F.transform("rows", shape)
        body = F.when(F.col("ats") == ats, F.to_json(rows if at is None else F.struct(rows.alias(at)))).otherwise(body)
    return p.select("domain", body.alias("body"), "ats")


def platform_counts(spark, d):
    """Counts and departments read back from every platform's JSON."""
    c = boards.counts_from_json(F.col("ats"), F.col("body"))
    got = _bodies(spark, d).select("domain", "ats", c.alias("c"))
    return got.select("domain", "ats", F.col("c.count").alias("n"), F.size("c.titles").alias("n_titles"), F.array_join("c.departments", "|").alias("departments"))


def platform_postings(spark, d):
    """The postings harvested from every platform's JSON, in one form."""
    # the outer form: the plain one has the optimizer ask for boards with postings first, which harvests each twice
    h = boards.harvest(_bodies(spark, d)).select("domain", "ats", F.explode_outer("postings").alias("p")).where("p is not null")
    return h.select("domain", "ats", "p.posting_id", "p.title", "p.location", "p.department")


def harvest_envelopes(spark, d):
    """Bounded harvests: how many a board has, how many were taken, whether it was cut."""
    return boards.harvest(_bodies(spark, d), 2).select("domain", "ats", "count", "got", "truncated")


def first_boards(spark, d):
    """The first platform that answers with open roles; those before it answer empty, or with another shape."""
    order = {p: i for i, p in enumerate(PLATFORMS)}
    b = _bodies(spark, d).withColumn("pos", F.create_map(*[F.lit(x) for kv in order.items() for x in kv])[F.col("ats")])
    empty = F.when(F.col("pos") == 0, F.lit('{"jobs": []}')).when(F.col("pos") == 1, F.lit("<html>")).when((F.col("pos") == 2) & (F.length("domain") % 2 == 0), F.lit("[]")).otherwise(F.col("body"))
    b = b.withColumn("body", empty)
    c = boards.counts_from_json(F.col("ats"), F.col("body"))["count"]
    return boards.first_board(b.select("domain", "ats", "pos", c.alias("count")), ["domain"]).select("domain", "ats", "count")


def board_round_trip(spark, d):
    """Boards named by addresses that were built of platform and name."""
    doms = _t(spark, d, "domains").select(F.regexp_replace(U.normalize_domain(F.col("domain")), "[^a-z0-9]", "").alias("slug")).where("slug <> ''").distinct()
    made = doms.crossJoin(F.broadcast(spark.createDataFrame([(a,) for a in _BOARDS], "ats string"))).withColumn("url", boards.board_url(F.col("ats"), F.col("slug")))
    b = boards.board_of(F.col("url"))
    return made.select("slug", F.col("ats").alias("wanted"), b["ats"].alias("ats"), b["slug"].alias("found"))


def board_links(spark, d):
    """Hosts of built board addresses against the table of board hosts."""
    doms = _t(spark, d, "domains").select(F.regexp_replace(U.normalize_domain(F.col("domain")), "[^a-z0-9]", "").alias("slug")).where("slug <> ''").distinct()
    made = doms.crossJoin(F.broadcast(spark.createDataFrame([(a,) for a in _BOARDS], "ats string"))).withColumn("url", boards.board_url(F.col("ats"), F.col("slug")))
    hints = spark.createDataFrame([(h,) for h in fixed.BOARD_HOSTS], "hint string")
    return made.select("url", F.explode(U.host_suffixes(U.host(F.col("url")))).alias("hint")).distinct().join(F.broadcast(hints), "hint").groupBy("hint").agg(F.count(F.lit(1)).alias("n"))


def _embedded(spark, d):
    p = _postings(spark, d)
    item = F.struct(F.col("posting_key").alias("jobId"), "title", F.coalesce("location", F.lit("anywhere")).alias("location"), "department")
    team = F.lit(', {"name": "Ana Kalo", "role": "CTO", "location": "Bay", "email": "a@b.c"}, {"title": "Closed one", "location": "x", "jobId": "z", "status": "paused"}]')
    body = F.concat(F.regexp_replace(F.to_json(F.array_sort(F.collect_list(item))), r"\]$", ""), team)
    page = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"props": {"list": '), body, F.lit("}}</script></html>"))
    return p.groupBy("domain").agg(page.alias("html")).withColumn("url", F.concat(F.lit("https://"), F.col("domain"), F.lit("/careers")))


def embedded_postings(spark, d):
    """Postings out of JSON in pages; cards of persons and closed postings are none."""
    return postings.embedded_postings(_embedded(spark, d), limit=None).select("domain", "posting_id", "title", "location", "department", "count")


def posting_blocks(spark, d):
    """The block of text that stands for a page's mined postings."""
    p = _postings(spark, d).groupBy("domain").agg(F.array_sort(F.collect_list("title")).alias("titles"))
    return p.select("domain", postings.block(F.size("titles"), F.col("titles"), 3).alias("block"))


def rejudge(spark, d):
    """Domains that one rubric has no verdict for."""
    return select.to_judge(_t(spark, d, "pages"), _t(spark, d, "verdicts"), "hiring_signal").unionByName(select.to_judge(_t(spark, d, "pages"), _t(spark, d, "verdicts"), "no_such_rubric").withColumn("domain", F.concat("domain", F.lit("!"))))


def judge_input(spark, d):
    """Every listed domain with the length of the text it is judged by."""
    doms = _t(spark, d, "domains").select(U.normalize_domain(F.col("domain")).alias("domain")).where("domain <> ''").distinct()
    p = _t(spark, d, "pages").select("domain", "text", "page_id", "fetched_at")
    return select.scoring_input(doms, store.latest(p, ["domain"], "fetched_at", ["page_id"])).select("domain", F.length("text").alias("n"))


def careers_missing(spark, d):
    """Domains without a stored careers page that is ok."""
    return select.without_careers(_t(spark, d, "pages"), _t(spark, d, "discovered_pages"))


def late_candidates(spark, d):
    """Careers candidates that the home page links."""
    return select.candidates_only(_t(spark, d, "discovered_pages")).select("dpage_id", "domain").distinct()


def follow_ups(spark, d):
    """Three careers candidates of each domain without a careers page."""
    p = _t(spark, d, "discovered_pages").where("page_type = 'careers'")
    c = p.groupBy("domain", "path").agg(F.min("dpage_id").alias("pos")).withColumns({"page_type": F.lit("careers"), "url": F.lit(None).cast("string"), "linked_from_homepage": F.lit(True)})
    # one path of each kind only: the order is that of first appearance
    c = c.where(~F.lower("path").rlike("hub/careers|job|opening|position|vacanc|role"))
    return select.follow_up(select.without_careers(_t(spark, d, "pages"), _t(spark, d, "discovered_pages").where("dpage_id % 2 = 0")), c).select("domain", "path", "rank")


def careers_guesses(spark, d):
    """Every domain with its specs and the guess of a careers host."""
    specs = spark.createDataFrame([("/careers", "careers", 0), ("/about", "company", 1)], "path string, page_type string, pos int")
    return select.with_guesses(select.targets_of(_t(spark, d, "pages").select("domain").where("domain is not null").distinct(), specs)).select("domain", "path", "page_type", "pos")


def kept_evidence(spark, d):
    """Evidence of the allowed keys, and of all pages with a linked careers row."""
    p = _t(spark, d, "discovered_pages").where("path is not null").select("domain", "path", "page_type", F.coalesce("linked_from_homepage", F.lit(False)).alias("linked"), "dpage_id").distinct()
    e = p.withColumn("trusted_board", F.col("linked") & (F.col("page_type") == "careers"))
    allowed = p.where("page_type = 'news'").select("domain", "path").distinct()
    return export.allowed_rows(e, allowed).groupBy("page_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("domain", "path").alias("pages"))


def page_scan(spark, d):
    """The stored pages of each domain in the order of a scan."""
    p = _t(spark, d, "discovered_pages").select("domain", "page_type", "path").distinct()
    return export.scan(p, ["page_type", "path"])


def verdicts_in_order(spark, d):
    """Verdicts with the place of their domain in the list."""
    doms = _t(spark, d, "domains").select(U.normalize_domain(F.col("domain")).alias("domain"), "company_id").where("domain <> ''")
    doms = doms.groupBy("domain").agg(F.min("company_id").alias("pos"))
    v = _t(spark, d, "verdicts").select("domain", "rubric", "label").distinct()
    return export.in_input_order(doms, v)


def value_counts(spark, d):
    """Group counts of several columns of the verdicts in one pass."""
    return export.summary(_t(spark, d, "verdicts"), ["label", "method", "rubric"])


def distinct_postings(spark, d):
    """Distinct ids over the pages of a board, whatever page repeats them."""
    p = _t(spark, d, "ssr_postings").where("posting_key is not null")
    pages = p.groupBy("domain", "page_url").agg(F.collect_set("posting_key").alias("ids"))
    return pages.select("domain", F.explode("ids").alias("id")).groupBy("domain").agg(F.countDistinct("id").alias("n"))


def discovery_stats(spark, d):
    """What was found per kind of discovery."""
    p = _t(spark, d, "discovered_pages").select("dpage_id", "tier", "linked_from_homepage").distinct()
    kind = F.when(F.col("tier") == "candidate", "candidate").when(F.col("linked_from_homepage"), "linked").otherwise("configured")
    return p.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def window_totals(spark, d):
    """The streaming aggregate over a table: events by type and hour."""
    w = windowed_counts(_t(spark, d, "events"))
    return w.select("start", "event_type", "n", F.round("total", 4).alias("total"))


def html_lengths(spark, d):
    """Characters of text in HTML, scripts and styles left out."""
    p = _t(spark, d, "pages").where("text is not null").select("page_id", "text").distinct()
    html = F.concat(F.lit("<html><head><style>p {color: red}</style><script>var a = '<b>x</b>';</script></head><body><p class='x'>"), F.regexp_replace("text", "[<>]", " "), F.lit("</p><noscript>none</noscript></body></html>"))
    return p.select("page_id", T.extracted_length(html).alias("n"))


def html_anchors(spark, d):
    """Anchors of pages made of the stored addresses: absolute, relative, fragments and other schemes."""
    p = _t(spark, d, "discovered_pages").where("url like 'http%' and path like '/%' and not url rlike '[\"<> ]' and not path rlike '[\"<> ?#]'").select("dpage_id", "domain", "url", "path").distinct()
    html = F.concat(F.lit('<p><a href="'), F.col("url"), F.lit('">One <b>two</b></a> <a class=\'x\' href="'), F.col("path"), F.lit("\">rel</a><a href='#top'>top</a><a href=''>none</a></p>"))
    pages = p.select("dpage_id", F.concat(F.lit("https://"), "domain", F.lit("/start/page")).alias("base_url"), html.alias("html"))
    return links.anchors(pages).select("dpage_id", "pos", "href", "text")


def sitemap_urls(spark, d):
    """Addresses of sitemaps made of the stored pages, and the sitemaps that robots files name."""
    p = _t(spark, d, "discovered_pages").where("url like 'http%' and not url rlike '[<> ]'").select("domain", "url").distinct()
    xml = F.concat(F.lit("<urlset>"), F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("<url><LOC> "), "url", F.lit(" </LOC></url>")))), "\n"), F.lit("</urlset>"))
    robots = F.concat(F.lit("User-agent: *\nDisallow: /x\n  SITEMAP: https://"), F.col("domain"), F.lit("/a.xml\nSitemap: https://"), F.col("domain"), F.lit("/b.xml\nsitemap: https://"), F.col("domain"), F.lit("/a.xml"))
    g = p.groupBy("domain").agg(xml.alias("xml"))
    return g.select("domain", F.size(links.sitemap_locations(F.col("xml"))).alias("n"), F.array_join(links.robots_sitemaps(robots), "|").alias("sitemaps"))


def evidence_reasons(spark, d):
    """Tier, status and reason of every combination of hygiene, trust and evidence type."""
    make = lambda name, values: spark.createDataFrame([(v,) for v in values], f"{name} string")
    rows = make("hygiene", ("company_like", "unknown", "parked_or_thin")).crossJoin(F.broadcast(make("trust", ("company_site", "untrusted_external", "fetch_failed", "trusted_funding_outlet")))).crossJoin(F.broadcast(make("kind", ("none", "hiring_activity", "security_compliance"))))
    t = evidence.tier(F.col("hygiene"), F.col("trust"), F.col("kind"))
    return rows.withColumn("tier", t).withColumn("status", evidence.status(F.col("hygiene"), F.col("trust"), F.col("kind"), t)).withColumn("reason", evidence.reason(F.col("status")))


_ALL = (
    platform_counts, platform_postings, harvest_envelopes, first_boards, board_round_trip, board_links, embedded_postings, posting_blocks, rejudge, judge_input, careers_missing, late_candidates,
    follow_ups, careers_guesses, kept_evidence, page_scan, verdicts_in_order, value_counts, distinct_postings, discovery_stats, window_totals, html_lengths, html_anchors, sitemap_urls, evidence_reasons,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracles() -> dict[str, str]:
    from .queries import _LAST_PAGES, _host_sql, _norm_domain, _under

    dp = "discovered_pages"
    p = "p AS (SELECT domain, posting_key, max(title) AS title, max(location) AS location, max(department) AS department FROM ssr_postings WHERE posting_key IS NOT NULL AND title <> '' AND domain IS NOT NULL GROUP BY 1, 2)"
    ats = "a AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in PLATFORMS) + "]) AS ats)"
    doms = f"SELECT DISTINCT {_norm_domain('domain')} AS domain FROM domains WHERE {_norm_domain('domain')} <> ''"
    slugs = f"SELECT DISTINCT regexp_replace({_norm_domain('domain')}, '[^a-z0-9]', '', 'g') AS slug FROM domains"
    built = "SELECT unnest([" + ", ".join(f"'{x}'" for x in _BOARDS) + "]) AS wanted"
    hosts = " UNION ALL ".join(f"SELECT DISTINCT slug, '{u.partition('%s')[0]}' || slug || '{u.partition('%s')[2]}' AS url FROM ({slugs}) WHERE slug <> ''" for u in fixed.BOARD_URLS.values())
    hints = ", ".join(repr(x) for x in fixed.BOARD_HOSTS)
    return {
        "platform_counts": f"WITH {p}, {ats} SELECT domain, ats, CAST(count(*) AS INTEGER) AS n, CAST(count(*) AS INTEGER) AS n_titles, CASE WHEN ats = 'workday' THEN '' ELSE coalesce(string_agg(DISTINCT department, '|' ORDER BY department) FILTER (department <> ''), '') END AS departments FROM p CROSS JOIN a GROUP BY 1, 2",
        "platform_postings": f"WITH {p}, {ats} SELECT domain, ats, posting_key AS posting_id, title, CASE WHEN ats NOT IN ('rippling', 'workday') THEN nullif(location, '') END AS location, CASE WHEN ats <> 'workday' THEN (CASE WHEN ats = 'greenhouse' THEN department ELSE nullif(department, '') END) END AS department FROM p CROSS JOIN a",
        "harvest_envelopes": f"WITH {p}, {ats}, c AS (SELECT domain, count(*) AS n FROM p GROUP BY 1) SELECT domain, ats, CAST(n AS INTEGER) AS count, CAST(least(n, 2) AS INTEGER) AS got, n > 2 AS truncated FROM c CROSS JOIN a",
        "first_boards": f"WITH {p} SELECT domain, CASE WHEN length(domain) % 2 = 0 THEN '{PLATFORMS[3]}' ELSE '{PLATFORMS[2]}' END AS ats, CAST(count(*) AS INTEGER) AS count FROM p GROUP BY 1",
        "board_round_trip": f"SELECT slug, wanted, wanted AS ats, slug AS found FROM ({slugs}) CROSS JOIN ({built}) WHERE slug <> ''",
        "board_links": f"SELECT hint, count(*) AS n FROM (SELECT DISTINCT url, {_host_sql('url')} AS h FROM ({hosts})) JOIN (SELECT unnest([{hints}]) AS hint) ON h = hint OR ends_with(h, '.' || hint) GROUP BY 1",
        "embedded_postings": f"WITH {p} SELECT domain, posting_key AS posting_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title, nullif(trim(regexp_replace(coalesce(location, 'anywhere'), '\\s+', ' ', 'g')), '') AS location, nullif(trim(regexp_replace(department, '\\s+', ' ', 'g')), '') AS department, CAST(count(*) OVER (PARTITION BY domain) AS INTEGER) AS count FROM p",
        "posting_blocks": f"WITH {p}, t AS (SELECT domain, list(title ORDER BY title) AS l FROM p GROUP BY 1) SELECT domain, 'Structured job postings (' || len(l) || ' open roles):' || chr(10) || array_to_string(list_transform(l[1:3], lambda x : '- ' || x), chr(10)) || CASE WHEN len(l) > 3 THEN chr(10) || '(+' || (len(l) - 3) || ' more)' ELSE '' END AS block FROM t",
        "rejudge": "SELECT DISTINCT domain FROM pages WHERE domain NOT IN (SELECT domain FROM verdicts WHERE rubric = 'hiring_signal' AND method <> 'fetch_failed' AND domain IS NOT NULL) UNION ALL SELECT DISTINCT domain || '!' FROM pages",
        "judge_input": f"SELECT d.domain, CAST(length(coalesce(p.text, '')) AS INTEGER) AS n FROM ({doms}) d LEFT JOIN ({_LAST_PAGES}) p ON p.domain = d.domain",
        "careers_missing": f"SELECT DISTINCT domain FROM pages WHERE domain NOT IN (SELECT domain FROM {dp} WHERE domain IS NOT NULL AND ok AND (page_type = 'careers' OR {_under(_host_sql('coalesce(url, path)'), fixed.BOARD_HOSTS)}))",
        "late_candidates": f"SELECT DISTINCT dpage_id, domain FROM {dp} WHERE tier = 'candidate' AND page_type = 'careers' AND (coalesce(linked_from_homepage, false) OR {_under(_host_sql('coalesce(url, path)'), fixed.BOARD_HOSTS)})",
        "follow_ups": f"WITH u AS (SELECT DISTINCT domain FROM pages WHERE domain NOT IN (SELECT domain FROM {dp} WHERE dpage_id % 2 = 0 AND domain IS NOT NULL AND ok AND (page_type = 'careers' OR {_under(_host_sql('coalesce(url, path)'), fixed.BOARD_HOSTS)}))), c AS (SELECT domain, path, min(dpage_id) AS pos FROM {dp} WHERE page_type = 'careers' AND NOT regexp_matches(lower(path), 'hub/careers|job|opening|position|vacanc|role') GROUP BY 1, 2) SELECT domain, path, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY pos, path) AS r FROM c JOIN u USING (domain)) WHERE r <= 3",
        "careers_guesses": "WITH d AS (SELECT DISTINCT domain FROM pages WHERE domain IS NOT NULL) SELECT domain, path, page_type, pos FROM d CROSS JOIN (VALUES ('/careers', 'careers', 0), ('/about', 'company', 1)) s(path, page_type, pos) UNION ALL SELECT domain, 'https://careers.' || domain, 'careers', 1 FROM d",
        "kept_evidence": f"WITH e AS (SELECT DISTINCT domain, path, page_type, coalesce(linked_from_homepage, false) AS linked, dpage_id FROM {dp} WHERE path IS NOT NULL), k AS (SELECT DISTINCT domain, path FROM e WHERE page_type = 'news' OR (linked AND page_type = 'careers')) SELECT page_type, count(*) AS n, count(DISTINCT (domain, path)) AS pages FROM e JOIN k USING (domain, path) GROUP BY 1",
        "page_scan": f"SELECT *, CAST(row_number() OVER (PARTITION BY domain ORDER BY page_type NULLS FIRST, path NULLS FIRST) AS INTEGER) AS rank FROM (SELECT DISTINCT domain, page_type, path FROM {dp})",
        "verdicts_in_order": f"SELECT d.domain, d.pos, v.rubric, v.label FROM (SELECT {_norm_domain('domain')} AS domain, min(company_id) AS pos FROM domains WHERE {_norm_domain('domain')} <> '' GROUP BY 1) d LEFT JOIN (SELECT DISTINCT domain, rubric, label FROM verdicts) v ON v.domain = d.domain",
        "value_counts": "SELECT field, value, count(*) AS n FROM (SELECT unnest([{'field': 'label', 'value': coalesce(label, '')}, {'field': 'method', 'value': coalesce(method, '')}, {'field': 'rubric', 'value': coalesce(rubric, '')}], recursive := true) FROM verdicts) GROUP BY 1, 2",
        "distinct_postings": "SELECT domain, count(DISTINCT posting_key) AS n FROM ssr_postings WHERE posting_key IS NOT NULL GROUP BY 1",
        "discovery_stats": f"SELECT CASE WHEN tier = 'candidate' THEN 'candidate' WHEN linked_from_homepage THEN 'linked' ELSE 'configured' END AS kind, count(*) AS n FROM (SELECT DISTINCT dpage_id, tier, linked_from_homepage FROM {dp}) GROUP BY 1",
        "window_totals": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
        "html_lengths": "SELECT DISTINCT page_id, CAST(length(trim(regexp_replace(regexp_replace(text, '[<>]', ' ', 'g') || ' ', '\\s+', ' ', 'g'))) AS INTEGER) AS n FROM (SELECT DISTINCT page_id, text FROM pages WHERE text IS NOT NULL)",
        "html_anchors": f"""WITH p AS (SELECT DISTINCT dpage_id, domain, url, path FROM {dp} WHERE url LIKE 'http%' AND path LIKE '/%' AND NOT regexp_matches(url, '["<> ]') AND NOT regexp_matches(path, '["<> ?#]')) SELECT dpage_id, 0 AS pos, url AS href, 'One two' AS text FROM p UNION ALL SELECT dpage_id, 1, path, 'rel' FROM p""",
        "sitemap_urls": f"SELECT domain, CAST(count(DISTINCT url) AS INTEGER) AS n, 'https://' || domain || '/a.xml|https://' || domain || '/b.xml' AS sitemaps FROM {dp} WHERE url LIKE 'http%' AND NOT regexp_matches(url, '[<> ]') GROUP BY 1",
        "evidence_reasons": "SELECT *, CASE status WHEN 'fetch_failed' THEN 'page fetch failed' WHEN 'not_evidence' THEN 'no source-specific evidence terms matched' WHEN 'excluded_hygiene' THEN 'domain hygiene gate did not look company-like' WHEN 'review_needed' THEN 'homepage hygiene unknown; human or downstream validation required' ELSE 'candidate evidence; downstream validation required' END AS reason FROM (SELECT *, CASE WHEN kind = 'none' THEN CASE WHEN trust = 'fetch_failed' THEN 'fetch_failed' ELSE 'not_evidence' END WHEN tier = 'Rejected' THEN 'excluded_hygiene' WHEN hygiene = 'unknown' THEN 'review_needed' WHEN trust IN ('company_site', 'trusted_funding_outlet') THEN 'trusted_source_candidate' ELSE 'untrusted_source_candidate' END AS status FROM (SELECT *, CASE WHEN kind = 'none' OR trust = 'fetch_failed' OR hygiene = 'parked_or_thin' THEN 'Rejected' WHEN hygiene = 'unknown' THEN 'C' WHEN trust = 'company_site' THEN 'A' WHEN trust = 'trusted_funding_outlet' THEN 'B' ELSE 'C' END AS tier FROM (SELECT unnest(['company_like', 'unknown', 'parked_or_thin']) AS hygiene) CROSS JOIN (SELECT unnest(['company_site', 'untrusted_external', 'fetch_failed', 'trusted_funding_outlet']) AS trust) CROSS JOIN (SELECT unnest(['none', 'hiring_activity', 'security_compliance']) AS kind)))",
    }
