"""The registered queries of the core operators over the site tables, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fixed
from .functions import text as T
from .functions import url as U
from .operators import boards, evidence, select, store
from .plans.rubric import Rubric, score, term_table, verdicts

#: The rubrics of the queries; their terms occur in the tables.
SITE = Rubric.of({"name": "engineering_site", "positive_label": "engineering", "negative_label": "commerce", "positive": ["engineer", "security", "audit", "release", "documentation", "Sicherheit", "безопасность"], "negative": ["pricing", "orders", "customers", "store", "Preise", "цены"], "min_net_hits": 2, "confident_threshold": 0.5})
HIRING = Rubric.of({"name": "hiring_signal", "positive_label": "hiring", "negative_label": "quiet", "positive": ["careers", "role", "applicants", "specialist", "Karriere", "вакансии"], "negative": ["newsletter", "cookies"], "min_net_hits": 1})
TYPE_TERMS = {"careers": ("engineer", "applicants", "role"), "news": ("story", "opens"), "security": ("audit", "incidents"), "company": ("team", "founded"), "procurement": ("supplier", "supplies")}
SPECS = [("/careers", "careers", 0), ("/about", "company", 1), ("/press", "news", 2), ("/security", "security", 3), ("/pricing", "other", 4)]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def domain_list(spark, d):
    """Distinct normalised domains with the first company that lists each."""
    rows = _t(spark, d, "domains").select(U.normalize_domain(F.col("domain")).alias("domain"), "company_id").where("domain <> ''")
    return rows.groupBy("domain").agg(F.min("company_id").alias("first_company"), F.count(F.lit(1)).alias("n"))


def page_keys(spark, d):
    return _t(spark, d, "discovered_pages").select("dpage_id", U.page_key(F.col("url")).alias("page_key"), U.normalize_path(F.col("path")).alias("path_key")).distinct()


def tracking_stripped(spark, d):
    q = F.regexp_extract(F.col("url"), r"^[^?#]*\?([^#]*)", 1)
    return _t(spark, d, "discovered_pages").where(F.col("url").contains("?")).select("dpage_id", U.strip_tracking(q).alias("query")).distinct()


def hosts(spark, d):
    u = F.col("url")
    return _t(spark, d, "discovered_pages").select("dpage_id", U.host(u).alias("host"), U.registrable(u).alias("registrable"), U.is_plausible_host(U.host(u)).alias("plausible"), U.is_careers_host(U.host(u)).alias("careers_host")).distinct()


def board_hosts(spark, d):
    """Pages on a board's host: the host's suffixes meet the table of hosts by equality."""
    hints = spark.createDataFrame([(h,) for h in fixed.BOARD_HOSTS], "hint string")
    rows = _t(spark, d, "discovered_pages").where("url is not null").select("dpage_id", F.explode(U.host_suffixes(U.host(F.col("url")))).alias("hint")).distinct()
    return rows.join(F.broadcast(hints), "hint")


def acquired_sites(spark, d):
    a = U.acquirer(F.col("url"), F.col("domain"))
    return _t(spark, d, "discovered_pages").select("dpage_id", a.alias("a")).where("a.acquired").select("dpage_id", F.col("a.registrable").alias("registrable"), F.col("a.slug").alias("slug")).distinct()


def page_types(spark, d):
    rows = _t(spark, d, "discovered_pages").select("dpage_id", "page_type", U.page_type(F.col("path")).alias("by_path")).distinct()
    return rows.groupBy("page_type", "by_path").agg(F.count(F.lit(1)).alias("n"))


def link_types(spark, d):
    return _t(spark, d, "discovered_pages").where("url is not null").select("dpage_id", U.link_type(F.col("url"), F.lit(None).cast("string")).alias("link_type"), U.is_ignored_link(F.col("url")).alias("ignored")).distinct()


def page_summary(spark, d):
    p = _t(spark, d, "discovered_pages")
    return p.groupBy("page_type", "tier").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_ok"), F.count_if(F.length("text") > 0).alias("n_text"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars"), F.countDistinct("domain").alias("domains"))


def pages_latest(spark, d):
    p = _t(spark, d, "pages").select("domain", "page_id", "url", "status", "ok", "fetched_at")
    return store.latest(p, ["domain"], "fetched_at", ["page_id"])


def discovered_latest(spark, d):
    p = store.upsert_pages(_t(spark, d, "discovered_pages"))
    return p.select("domain", "path", "dpage_id", "status", "linked_from_homepage", F.length("text").alias("n_chars"))


def postings_latest(spark, d):
    p = _t(spark, d, "ssr_postings").where("posting_key is not null")
    last = store.latest(p, ["domain", "page_url", "posting_key"], "fetched_at", ["title", "location", "department", "published_at", "url"])
    return last.select("domain", "page_url", "posting_key", "title", "location")


def postings_replaced(spark, d):
    """Pages fetched in the later half replace all their postings."""
    p = _t(spark, d, "ssr_postings").where("posting_key is not null").select("domain", "page_url", "posting_key", "fetched_at", "title")
    cut = F.lit("2025-03-01").cast("timestamp")
    return store.replace_groups(p.where(F.col("fetched_at") < cut).distinct(), p.where(F.col("fetched_at") >= cut), ["domain", "page_url"], ["posting_key"], "fetched_at").groupBy("domain", "page_url").agg(F.countDistinct("posting_key").alias("n"), F.max("fetched_at").alias("last"))


def departments(spark, d):
    """Departments in one spelling, by domain."""
    p = _t(spark, d, "ssr_postings").withColumn("department", F.lower(F.trim(F.regexp_replace("department", r"\s+", " ")))).where("department <> ''")
    return p.groupBy("domain").agg(F.array_join(F.array_sort(F.collect_set("department")), "|").alias("departments"), F.countDistinct("posting_key").alias("postings"))


def candidates_merged(spark, d):
    p = _t(spark, d, "discovered_pages")
    stored = p.where("tier <> 'candidate'").withColumn("path", U.page_key(F.col("path"))).groupBy("domain", "path").agg(F.min("page_type").alias("page_type"), F.min("url").alias("url"), F.min("tier").alias("tier"), F.max("ok").alias("ok"), F.max("linked_from_homepage").alias("linked_from_homepage"))
    new = p.where("tier = 'candidate'").withColumn("path", U.page_key(F.col("path")))
    return store.add_candidates(stored, new).groupBy("tier", "ok", "linked_from_homepage").agg(F.count(F.lit(1)).alias("n"))


def _verdicts(spark, d):
    v = _t(spark, d, "verdicts").withColumn("_c", F.coalesce("confidence", F.lit(-1.0)))
    return store.latest(v, ["domain", "rubric"], "decided_at", ["_c", "label", "method"]).drop("_c")


def verdicts_latest(spark, d):
    return _verdicts(spark, d).select("domain", "rubric", "label", "method", "decided_at")


def verdicts_pending(spark, d):
    """Every domain with its verdict of each rubric, ``pending`` where there is none."""
    doms = _t(spark, d, "domains").select(U.normalize_domain(F.col("domain")).alias("domain")).where("domain <> ''").distinct()
    v = _verdicts(spark, d)
    rubrics = v.select("rubric").distinct()  # the handful of rubrics
    out = doms.crossJoin(F.broadcast(rubrics)).join(v, ["domain", "rubric"], "left")
    return out.select("domain", "rubric", F.coalesce("label", F.lit("pending")).alias("label"), F.coalesce("method", F.lit("none")).alias("method"))


def verdict_summary(spark, d):
    return _verdicts(spark, d).groupBy("rubric", "label", "method").agg(F.count(F.lit(1)).alias("n"))


def todo_fetch(spark, d):
    doms = _t(spark, d, "domains").select(U.normalize_domain(F.col("domain")).alias("domain")).where("domain <> ''").distinct()
    return doms.join(_t(spark, d, "pages").where("ok").select("domain").distinct(), "domain", "left_anti")


def todo_judge(spark, d):
    return select.to_judge(_t(spark, d, "pages"), _t(spark, d, "verdicts"), "hiring_signal")


def _homes(spark, d):
    p = _t(spark, d, "pages")
    return store.latest(p.select("domain", "url", "text", "page_id", "fetched_at"), ["domain"], "fetched_at", ["page_id"])


def rubric_verdicts(spark, d):
    return verdicts(_homes(spark, d), SITE)


def rubric_scores(spark, d):
    docs = _t(spark, d, "documents")
    return score(docs, SITE).select("doc_id", "label", "confidence", "pos_hits", "neg_hits")


def rubric_terms(spark, d):
    t = term_table(_t(spark, d, "documents"), SITE, "doc_id")
    return t.groupBy("side", "term").agg(F.sum("n").alias("hits"), F.count(F.lit(1)).alias("docs"))


def two_rubrics(spark, d):
    """One text against two rubrics."""
    both = score(score(_homes(spark, d), SITE).withColumnRenamed("label", "site_label").select("domain", "site_label", "text"), HIRING)
    return both.groupBy("site_label", F.col("label").alias("hiring_label")).agg(F.count(F.lit(1)).alias("n"))


def text_lengths(spark, d):
    p = _t(spark, d, "pages").select("page_id", "text").distinct()
    return p.select("page_id", T.extracted_length(F.col("text")).alias("n"), T.is_soft_block(F.col("text")).alias("blocked"))


def clean_text(spark, d):
    return _t(spark, d, "pages").select("page_id", F.length(T.clean(F.col("text"))).alias("n"), F.md5(T.clean(F.col("text"))).alias("digest")).distinct()


def _targets(spark, d):
    p = _t(spark, d, "discovered_pages")
    return p.select("domain", "path", F.col("url"), "page_type", "linked_from_homepage", F.col("dpage_id").alias("pos"))


def merged_targets(spark, d):
    return select.merge_targets(_targets(spark, d)).select("domain", "path", "linked_from_homepage", "page_type", "pos")


def spec_targets(spark, d):
    """Every domain with every wanted path, without those stored and ok."""
    specs = spark.createDataFrame(SPECS, "path string, page_type string, pos int")
    doms = _t(spark, d, "pages").select("domain").distinct()
    return select.to_fetch(select.targets_of(doms, specs), _t(spark, d, "discovered_pages")).select("domain", "path", "page_type")


def balanced_pages(spark, d):
    t = select.merge_targets(_targets(spark, d))
    return select.balanced(t, 6, {"careers": 2, "news": 1}, ["careers", "news", "security"]).select("domain", "path", "page_type", "rank")


def renders_capped(spark, d):
    last = store.upsert_pages(_t(spark, d, "discovered_pages"))
    return select.capped_renders(last).select("domain", "path", "rank")


def unresolved_domains(spark, d):
    return select.unresolved(_t(spark, d, "pages"), _t(spark, d, "discovered_pages"))


def page_rows(spark, d):
    specs = spark.createDataFrame(SPECS, "path string, page_type string, pos int")
    last = store.upsert_pages(_t(spark, d, "discovered_pages"))
    rows = evidence.page_rows(select.targets_of(_t(spark, d, "pages").select("domain").distinct(), specs), last, TYPE_TERMS)
    return rows.select("domain", "path", "page_type", "method", "match_count")


def snippets(spark, d):
    last = store.upsert_pages(_t(spark, d, "discovered_pages"))
    return last.where("text is not null").select("domain", "path", T.snippet(F.col("text"), F.array(F.lit("engineer"), F.lit("audit"), F.lit("karriere"))).alias("snippet"))


def site_hygiene(spark, d):
    return _homes(spark, d).select("domain", T.hygiene(F.col("text")).alias("hygiene"))


def evidence_rows(spark, d):
    last = store.upsert_pages(_t(spark, d, "discovered_pages"))
    e = evidence.evidence_rows(last, _homes(spark, d))
    return e.select("domain", "source_url", "source_trust", "domain_hygiene", "evidence_tier", "evidence_type", "evidence_status", "match_count", F.array_join("matched_terms", "|").alias("terms"))


def evidence_summary(spark, d):
    last = store.upsert_pages(_t(spark, d, "discovered_pages"))
    return evidence.evidence_rows(last, _homes(spark, d)).groupBy("evidence_type", "source_trust", "evidence_tier").agg(F.count(F.lit(1)).alias("n"))


def boards_found(spark, d):
    return evidence.boards_of(_t(spark, d, "discovered_pages"))


def slug_guesses(spark, d):
    doms = _t(spark, d, "domains").select(U.normalize_domain(F.col("domain")).alias("domain")).where("domain <> ''").distinct()
    return doms.select("domain", F.array_join(boards.slug_guesses(F.col("domain")), "|").alias("slugs"))


def board_counts(spark, d):
    """Counts and titles out of board JSON built from the stored postings."""
    p = _t(spark, d, "ssr_postings").select("domain", "posting_key", "title").distinct()
    body = p.groupBy("domain").agg(F.to_json(F.struct(F.collect_list(F.struct("title")).alias("jobs"))).alias("body"))
    c = boards.counts_from_json(F.lit("greenhouse"), F.col("body"))
    return body.select("domain", c["count"].alias("n"), F.size(c["titles"]).alias("n_titles"))


def event_windows(spark, d):
    e = _t(spark, d, "events")
    return e.groupBy(F.date_trunc("hour", "ts").alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


_ALL = (
    domain_list, page_keys, tracking_stripped, hosts, board_hosts, acquired_sites, page_types, link_types, page_summary, pages_latest, discovered_latest, postings_latest, postings_replaced,
    departments, candidates_merged, verdicts_latest, verdicts_pending, verdict_summary, todo_fetch, todo_judge, rubric_verdicts, rubric_scores, rubric_terms, two_rubrics, text_lengths, clean_text,
    merged_targets, spec_targets, balanced_pages, renders_capped, unresolved_domains, page_rows, snippets, site_hygiene, evidence_rows, evidence_summary, boards_found, slug_guesses, board_counts, event_windows,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


# ---------------------------------------------------------------- the same in SQL
def _norm_domain(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(trim(coalesce({c}, ''))), '^https?://', ''), '[/?].*$', ''))"


def _strip(q: str) -> str:
    return f"array_to_string(list_filter(string_split({q}, '&'), lambda s : s <> '' AND NOT regexp_matches(s, '(?i)^(?:{fixed.TRACKING_PARAM})(=|$)')), '&')"


def _with_query(base: str, q: str) -> str:
    b = f"CASE WHEN regexp_replace({base}, '/+$', '') = '' THEN '/' ELSE regexp_replace({base}, '/+$', '') END"
    return f"CASE WHEN {_strip(q)} = '' THEN {b} ELSE {b} || '?' || {_strip(q)} END"


def _path_sql(c: str) -> str:
    p = f"trim(coalesce({c}, ''))"
    p = f"(CASE WHEN regexp_matches({p}, '(?i)^https?://[^/]') THEN regexp_replace({p}, '(?i)^https?://[^/]+', '') ELSE {p} END)"
    p = f"regexp_replace(CASE WHEN starts_with({p}, '/') THEN {p} ELSE '/' || {p} END, '#(.|\\n)*$', '')"
    return _with_query(f"regexp_extract({p}, '^([^?]*)', 1)", f"regexp_extract({p}, '^[^?]*\\?((?:.|\\n)*)$', 1)")


def _key_sql(c: str) -> str:
    v, at = f"trim(coalesce({c}, ''))", "(?i)^(https?)://([^/?#]*)([^?#]*)(?:\\?([^#]*))?"
    g = lambda i: f"regexp_extract({v}, '{at}', {i})"
    q = _with_query(f"regexp_replace({g(3)}, ';[^/]*$', '')", g(4))
    return f"CASE WHEN regexp_matches({v}, '(?i)^https?://') THEN lower({g(1)}) || '://' || lower({g(2)}) || ({q}) ELSE {_path_sql(c)} END"


def _host_sql(c: str) -> str:
    return f"regexp_replace(lower(regexp_extract(coalesce({c}, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\\.', '')"


def _reg_sql(c: str) -> str:
    return f"CASE WHEN len(list_filter(string_split({_host_sql(c)}, '.'), lambda x : x <> '')) >= 2 THEN array_to_string(list_filter(string_split({_host_sql(c)}, '.'), lambda x : x <> '')[-2:], '.') ELSE {_host_sql(c)} END"


def _under(h: str, names: tuple[str, ...]) -> str:
    alternatives = "|".join(n.replace(".", "\\.") for n in names)
    return f"regexp_matches({h}, '(^|\\.)({alternatives})$')"


def _type_sql(p: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({p}, '{pattern}') THEN '{kind}'" for kind, pattern in fixed.PAGE_TYPES) + " ELSE 'other' END"


_CLEAN = "trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', ' ', 'g'), '\\s+', ' ', 'g'))"
_LAST_PAGES = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY fetched_at DESC NULLS LAST, page_id DESC NULLS LAST) AS rn FROM pages) WHERE rn = 1"
_LAST_DISCOVERED = f"""SELECT * REPLACE (linked AS linked_from_homepage, substr(text, 1, 250000) AS text) FROM (
  SELECT *, row_number() OVER (PARTITION BY domain, path ORDER BY fetched_at DESC NULLS LAST, dpage_id DESC NULLS LAST) AS rn,
         max(coalesce(linked_from_homepage, false)) OVER (PARTITION BY domain, path) AS linked
  FROM (SELECT * REPLACE ({_key_sql("path")} AS path) FROM discovered_pages)) WHERE rn = 1"""
_LAST_VERDICTS = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain, rubric ORDER BY decided_at DESC NULLS LAST, coalesce(confidence, -1) DESC, label DESC NULLS LAST, method DESC NULLS LAST) AS rn FROM verdicts) WHERE rn = 1"
# letters beyond ASCII are word characters to the engine; for SQL they are mapped to one
_WORDS = "regexp_replace(lower(coalesce(text, '')), '[^\\x00-\\x7F\\p{P}\\p{S}\\p{Z}\\p{C}\\p{M}]', '_', 'g')"


def _hits_sql(term: str) -> str:
    t = term.strip().lower()
    if not t.isascii():
        return f"((length(lower(coalesce(text, ''))) - length(replace(lower(coalesce(text, '')), '{t}', ''))) // {len(t)})"
    quoted = t.replace("-", "\\-").replace("'", "''")
    return f"len(regexp_extract_all(w, '\\b{quoted}\\b'))"


def _score_sql(source: str, key: str, r: Rubric, extra: str = "") -> str:
    p, n = " + ".join(map(_hits_sql, r.positive)), " + ".join(map(_hits_sql, r.negative))
    return f"""SELECT {key}, pos_hits, neg_hits, {extra} CASE WHEN sure AND pos_hits > neg_hits THEN '{r.positive_label}' WHEN sure THEN '{r.negative_label}' ELSE 'ambiguous' END AS label, round(raw, 3) AS confidence
FROM (SELECT *, pos_hits + neg_hits > 0 AND abs(pos_hits - neg_hits) >= {r.min_net_hits} AND raw >= {r.confident_threshold} AS sure FROM (
  SELECT *, CASE WHEN pos_hits + neg_hits > 0 THEN abs(pos_hits - neg_hits) / (pos_hits + neg_hits) ELSE 0 END AS raw FROM (
    SELECT *, CAST({p} AS INTEGER) AS pos_hits, CAST({n} AS INTEGER) AS neg_hits FROM (SELECT *, {_WORDS} AS w FROM ({source})))))"""


def oracles() -> dict[str, str]:
    dp = "discovered_pages"
    query = "regexp_extract(url, '^[^?#]*\\?([^#]*)', 1)"
    careers = _under(_host_sql("url"), fixed.BOARD_HOSTS)
    joined = "lower(coalesce(url, '') || ' ')"
    upath = "lower(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1))"
    link = f"CASE WHEN regexp_matches({joined}, '{fixed.LINK_NOISE}') THEN '' WHEN {careers} OR regexp_matches({upath}, '(^|/)(recruit|recruitment)(/|$)') OR regexp_matches({joined}, '{fixed.CAREER_PHRASES}') OR regexp_matches({joined}, '{fixed.CAREER_WORDS}') THEN 'careers' " + " ".join(f"WHEN regexp_matches({joined}, '{pattern}') THEN '{kind}'" for kind, pattern in fixed.LINK_TYPES) + " ELSE '' END"
    endings = "|".join(x.replace(".", "\\.") for x in fixed.ASSET_ENDINGS)
    ignored = f"NOT regexp_matches(url, '(?i)^https?://') OR {_under(_host_sql('url'), fixed.SOCIAL_HOSTS)} OR regexp_matches(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)), '({endings})$')"
    terms = " UNION ALL ".join(f"SELECT '{side}' AS side, '{t.lower()}' AS term, {_hits_sql(t)} AS n FROM d" for side, ts in (("positive", SITE.positive), ("negative", SITE.negative)) for t in ts)
    doms = f"SELECT DISTINCT {_norm_domain('domain')} AS domain FROM domains WHERE {_norm_domain('domain')} <> ''"
    specs = ", ".join(f"('{p}', '{t}')" for p, t, _ in SPECS)
    low = "lower(t)"
    votes = lambda ps: " + ".join(f"CAST(contains({low}, '{p}') AS INTEGER)" for p in ps)
    hygiene = f"""CASE WHEN t = '' THEN 'unknown' WHEN {votes(fixed.PERSONAL)} >= 2 AND {votes(fixed.BUSINESS)} < 3 THEN 'personal_resume'
 WHEN ({votes(fixed.CONSUMER)} > 0 OR (contains({low}, 'law firm') AND {votes(fixed.LEGAL_TECH)} = 0)) AND {votes(fixed.BUSINESS)} < 3 THEN 'consumer_or_local'
 WHEN length(t) < 120 OR {votes(fixed.PARKED)} > 0 THEN 'parked_or_thin' ELSE 'company_like' END"""
    want = "page_type = 'careers' AND coalesce((ok AND length(trim(coalesce(text, ''))) < 500) OR (NOT ok AND status IN (0, 403, 429)) OR render_hint IN ('js_shell', 'stub', 'shell_chrome') OR contains(url, '#'), false)"
    match = "CASE page_type " + " ".join(f"WHEN '{k}' THEN " + " + ".join(map(_hits_sql, v)) for k, v in TYPE_TERMS.items()) + " ELSE 0 END"
    snip = "".join(f"WHEN instr(lower(t), '{w}') > 0 THEN substr(t, greatest(0, instr(lower(t), '{w}') - 1 - 180) + 1, instr(lower(t), '{w}') - 1 + {len(w)} + 180 - greatest(0, instr(lower(t), '{w}') - 1 - 180)) " for w in ("engineer", "audit", "karriere"))
    strong = fixed.STRONG_CAREERS.replace("'", "''")
    return {
        "domain_list": f"SELECT {_norm_domain('domain')} AS domain, min(company_id) AS first_company, count(*) AS n FROM domains WHERE {_norm_domain('domain')} <> '' GROUP BY 1",
        "page_keys": f"SELECT DISTINCT dpage_id, {_key_sql('url')} AS page_key, {_path_sql('path')} AS path_key FROM {dp}",
        "tracking_stripped": f"SELECT DISTINCT dpage_id, {_strip(query)} AS query FROM {dp} WHERE contains(url, '?')",
        "hosts": f"SELECT DISTINCT dpage_id, {_host_sql('url')} AS host, {_reg_sql('url')} AS registrable, regexp_matches({_host_sql('url')}, '(?i)^[a-z0-9](?:[a-z0-9-]{{0,61}}[a-z0-9])?(?:\\.[a-z0-9](?:[a-z0-9-]{{0,61}}[a-z0-9])?)+$') AS plausible, regexp_matches({_host_sql('url')}, '{fixed.CAREERS_HOST}') AS careers_host FROM {dp}",
        "board_hosts": f"SELECT DISTINCT dpage_id, hint FROM (SELECT dpage_id, {_host_sql('url')} AS h FROM {dp}) JOIN (SELECT unnest([{', '.join(repr(x) for x in fixed.BOARD_HOSTS)}]) AS hint) ON h = hint OR ends_with(h, '.' || hint)",
        "acquired_sites": f"SELECT DISTINCT dpage_id, r AS registrable, string_split(r, '.')[1] AS slug FROM (SELECT dpage_id, {_reg_sql('url')} AS r, {_reg_sql('domain')} AS o, {_host_sql('url')} AS h FROM {dp}) WHERE r <> '' AND o <> '' AND r <> o AND NOT {_under('h', fixed.BOARD_HOSTS)}",
        "page_types": f"SELECT page_type, {_type_sql('p')} AS by_path, count(*) AS n FROM (SELECT DISTINCT dpage_id, page_type, lower({_path_sql('path')}) AS p FROM {dp}) GROUP BY 1, 2",
        "link_types": f"SELECT DISTINCT dpage_id, {link} AS link_type, {ignored} AS ignored FROM {dp} WHERE url IS NOT NULL",
        "page_summary": f"SELECT page_type, tier, count(*) AS n, CAST(coalesce(count_if(ok), 0) AS BIGINT) AS n_ok, CAST(coalesce(count_if(length(text) > 0), 0) AS BIGINT) AS n_text, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS chars, count(DISTINCT domain) AS domains FROM {dp} GROUP BY 1, 2",
        "pages_latest": f"SELECT domain, page_id, url, status, ok, fetched_at FROM ({_LAST_PAGES})",
        "discovered_latest": f"SELECT domain, path, dpage_id, status, linked_from_homepage, CAST(length(text) AS INTEGER) AS n_chars FROM ({_LAST_DISCOVERED})",
        "postings_latest": "SELECT domain, page_url, posting_key, title, location FROM (SELECT *, row_number() OVER (PARTITION BY domain, page_url, posting_key ORDER BY fetched_at DESC NULLS LAST, title DESC NULLS LAST, location DESC NULLS LAST, department DESC NULLS LAST, published_at DESC NULLS LAST, url DESC NULLS LAST) AS rn FROM ssr_postings WHERE posting_key IS NOT NULL) WHERE rn = 1",
        "postings_replaced": "WITH p AS (SELECT * FROM ssr_postings WHERE posting_key IS NOT NULL), n AS (SELECT * FROM p WHERE fetched_at >= TIMESTAMP '2025-03-01'), o AS (SELECT * FROM p WHERE fetched_at < TIMESTAMP '2025-03-01' AND NOT EXISTS (SELECT 1 FROM n WHERE n.domain = p.domain AND n.page_url = p.page_url)) SELECT domain, page_url, count(DISTINCT posting_key) AS n, max(fetched_at) AS last FROM (SELECT * FROM n UNION ALL SELECT * FROM o) GROUP BY 1, 2",
        "departments": "SELECT domain, string_agg(DISTINCT dep, '|' ORDER BY dep) AS departments, count(DISTINCT posting_key) AS postings FROM (SELECT *, lower(trim(regexp_replace(department, '\\s+', ' ', 'g'))) AS dep FROM ssr_postings) WHERE dep <> '' GROUP BY 1",
        "candidates_merged": f"WITH k AS (SELECT *, {_key_sql('path')} AS pk FROM {dp}), s AS (SELECT domain, pk, min(tier) AS tier, max(ok) AS ok, max(linked_from_homepage) AS l FROM k WHERE tier <> 'candidate' GROUP BY 1, 2), c AS (SELECT domain, pk, max(coalesce(linked_from_homepage, false)) AS l FROM k WHERE tier = 'candidate' GROUP BY 1, 2) SELECT coalesce(s.tier, 'candidate') AS tier, coalesce(ok, false) AS ok, coalesce(s.l, false) OR coalesce(c.l, false) AS linked_from_homepage, count(*) AS n FROM s FULL JOIN c ON s.domain = c.domain AND s.pk = c.pk GROUP BY 1, 2, 3",
        "verdicts_latest": f"SELECT domain, rubric, label, method, decided_at FROM ({_LAST_VERDICTS})",
        "verdicts_pending": f"WITH v AS ({_LAST_VERDICTS}), d AS ({doms}), r AS (SELECT DISTINCT rubric FROM v) SELECT d.domain, r.rubric, coalesce(v.label, 'pending') AS label, coalesce(v.method, 'none') AS method FROM d CROSS JOIN r LEFT JOIN v ON v.domain = d.domain AND v.rubric = r.rubric",
        "verdict_summary": f"SELECT rubric, label, method, count(*) AS n FROM ({_LAST_VERDICTS}) GROUP BY 1, 2, 3",
        "todo_fetch": f"SELECT domain FROM ({doms}) WHERE domain NOT IN (SELECT domain FROM pages WHERE ok AND domain IS NOT NULL)",
        "todo_judge": "SELECT DISTINCT domain FROM pages WHERE domain NOT IN (SELECT domain FROM verdicts WHERE rubric = 'hiring_signal' AND method <> 'fetch_failed' AND domain IS NOT NULL)",
        "rubric_verdicts": f"SELECT domain, '{SITE.name}' AS rubric, CASE WHEN e THEN 'unreachable' ELSE label END AS label, CASE WHEN e THEN 0.0 ELSE confidence END AS confidence, CASE WHEN e THEN 'fetch_failed' ELSE 'keyword' END AS method, CASE WHEN e THEN 'no content after cascade' ELSE 'pos=' || pos_hits || ' neg=' || neg_hits END AS reason FROM ({_score_sql(_LAST_PAGES, 'domain', SITE, "coalesce(text, '') = '' AS e,")})",
        "rubric_scores": f"SELECT doc_id, label, confidence, pos_hits, neg_hits FROM ({_score_sql('SELECT * FROM documents', 'doc_id', SITE)})",
        "rubric_terms": f"WITH d AS (SELECT *, {_WORDS} AS w FROM documents) SELECT side, term, CAST(sum(n) AS BIGINT) AS hits, count(*) AS docs FROM ({terms}) WHERE n > 0 GROUP BY 1, 2",
        "two_rubrics": f"WITH a AS ({_score_sql(_LAST_PAGES, 'domain', SITE)}), b AS ({_score_sql(_LAST_PAGES, 'domain', HIRING)}) SELECT a.label AS site_label, b.label AS hiring_label, count(*) AS n FROM a JOIN b ON a.domain IS NOT DISTINCT FROM b.domain GROUP BY 1, 2",
        "clean_text": f"SELECT DISTINCT page_id, CAST(length({_CLEAN}) AS INTEGER) AS n, md5({_CLEAN}) AS digest FROM pages",
        "merged_targets": f"WITH k AS (SELECT *, {_key_sql('path')} AS pk FROM {dp}) SELECT domain, pk AS path, max(coalesce(linked_from_homepage, false)) AS linked_from_homepage, coalesce(arg_min(page_type, dpage_id) FILTER (page_type <> 'other'), 'other') AS page_type, min(dpage_id) AS pos FROM k GROUP BY 1, 2",
        "spec_targets": f"SELECT domain, path, page_type FROM (SELECT DISTINCT domain FROM pages) CROSS JOIN (VALUES {specs}) s(path, page_type) WHERE NOT EXISTS (SELECT 1 FROM {dp} x WHERE x.ok AND x.domain = pages.domain AND x.path = s.path)".replace("(SELECT DISTINCT domain FROM pages)", "(SELECT DISTINCT domain FROM pages) pages"),
        "renders_capped": f"SELECT domain, path, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY path, fk) AS rank FROM (SELECT domain, {_key_sql('coalesce(url, path)')} AS fk, min(path) AS path FROM ({_LAST_DISCOVERED}) WHERE {want} GROUP BY 1, 2)) WHERE rank <= 4",
        "unresolved_domains": f"SELECT DISTINCT domain FROM pages WHERE domain NOT IN (SELECT domain FROM {dp} WHERE domain IS NOT NULL AND page_type = 'careers' AND ok AND (({careers} AND trim(coalesce(text, '')) <> '') OR regexp_matches({_WORDS.replace('lower(', '(')}, '{strong}')))",
        "page_rows": f"WITH s AS (SELECT domain, path, page_type FROM (SELECT DISTINCT domain FROM pages) CROSS JOIN (VALUES {specs}) v(path, page_type)), l AS (SELECT *, CAST({match} AS INTEGER) AS match_count FROM (SELECT *, {_WORDS} AS w FROM ({_LAST_DISCOVERED}))) SELECT coalesce(s.domain, l.domain) AS domain, coalesce(s.path, l.path) AS path, coalesce(l.page_type, s.page_type) AS page_type, CASE WHEN l.ok IS NULL THEN 'missing' WHEN l.ok THEN 'keyword' ELSE 'fetch_failed' END AS method, match_count FROM s FULL JOIN l ON s.domain = l.domain AND s.path = l.path",
        "snippets": f"SELECT domain, path, CASE {snip} ELSE substr(t, 1, 360) END AS snippet FROM (SELECT *, {_CLEAN} AS t FROM ({_LAST_DISCOVERED})) WHERE text IS NOT NULL",
        "site_hygiene": f"SELECT domain, {hygiene} AS hygiene FROM (SELECT domain, {_CLEAN} AS t FROM ({_LAST_PAGES}))",
        "board_counts": "SELECT domain, CAST(count(*) AS INTEGER) AS n, CAST(count(CASE WHEN title <> '' THEN 1 END) AS INTEGER) AS n_titles FROM (SELECT DISTINCT domain, posting_key, title FROM ssr_postings) GROUP BY 1",
        "event_windows": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    }
