"""Evidence rows: typed term hits of fetched pages with source trust, site hygiene, tier and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..functions import url as U
from .boards import board_of
from .hops import is_utility_url


def source_trust(domain: Column, homepage_url: Column, page_url: Column, ok: Column, linked: Column, path: Column, page_type: Column) -> Column:
    """Who controls the page: rules in order, the first that fits."""
    h = U.host(page_url)
    board = U.under(h, fixed.BOARD_HOSTS)
    official = (page_type == "careers") & (U.page_type(path) == "careers") & (~F.coalesce(path, F.lit("")).rlike("(?i)^https?://") | U.same_or_below(U.host(path), U.host(domain)))
    return (
        F.when(~F.coalesce(ok, F.lit(False)), F.lit("fetch_failed")).when(is_utility_url(page_url), F.lit("untrusted_external")).when(h == "", F.lit("unknown"))
        .when(U.same_or_below(h, U.host(domain)) | U.same_or_below(h, U.host(homepage_url)), F.lit("company_site"))
        .when(F.coalesce(linked, F.lit(False)) & (board | page_url.rlike("(?i)" + fixed.RECRUITMENT_WORDS)), F.lit("linked_ats_candidate"))
        .when(board & official, F.lit("linked_ats_candidate")).when(U.under(h, fixed.FUNDING_HOSTS), F.lit("trusted_funding_outlet")).otherwise(F.lit("untrusted_external"))
    )


#: Sites whose pages are no evidence for a company.
UNFIT = ("personal_resume", "consumer_or_local", "parked_or_thin")
# Terms of which an IT operations posting names one, and a page of a posting plugin.
OPERATIONS = (
    "mdm", "device management", "endpoint management", "systems administrator", "it administrator", "infrastructure engineer",
    "identity provider", "identity providers", "okta", "azure ad", "google workspace", "corporate it", "workplace technology",
)
PLUGIN_PAGE = r"(?ism)\bArchives:\s*Jobs\b.{0,160}\bPost Type Description\b|^#\s+[A-Z][A-Za-z0-9&/+',.() -]{3,90}\b.{0,700}\b(?:is looking for|is seeking|seeks)\b"


def has_board_link(text: Column) -> Column:
    """Does the text hold the address of a page on a board's host?"""
    return F.coalesce(text, F.lit("")).rlike(r"(?i)https?://(?:[a-z0-9-]+\.)*(?:" + "|".join(h.replace(".", r"\.") for h in fixed.BOARD_HOSTS) + ")/")


def excluded(hygiene: Column, trust: Column, kind: Column, text: Column | None = None) -> Column:
    """Does the site's hygiene forbid the evidence? Hiring is believed of linked boards, of local firms' own careers
    pages, and of thin sites whose careers page links a board.
    """
    board = F.lit(False) if text is None else has_board_link(text)
    spared = (kind == "hiring_activity") & (
        (trust == "linked_ats_candidate") | ((trust == "company_site") & ((hygiene == "consumer_or_local") | ((hygiene == "parked_or_thin") & board)))
    )
    return hygiene.isin(*UNFIT) & ~spared


def tier(hygiene: Column, trust: Column, kind: Column, text: Column | None = None) -> Column:
    return (
        F.when((kind == "none") | (trust == "fetch_failed") | excluded(hygiene, trust, kind, text), F.lit("Rejected")).when(hygiene == "unknown", F.lit("C"))
        .when(trust.isin("company_site", "linked_ats_candidate"), F.lit("A")).when(trust == "trusted_funding_outlet", F.lit("B")).otherwise(F.lit("C"))
    )


def status(hygiene: Column, trust: Column, kind: Column, tier_: Column) -> Column:
    return (
        F.when(kind == "none", F.when(trust == "fetch_failed", F.lit("fetch_failed")).otherwise(F.lit("not_evidence")))
        .when((tier_ == "Rejected"), F.lit("excluded_hygiene")).when(hygiene == "unknown", F.lit("review_needed"))
        .when(trust.isin("company_site", "linked_ats_candidate", "trusted_funding_outlet"), F.lit("trusted_source_candidate"))
        .when(trust == "untrusted_external", F.lit("untrusted_source_candidate")).otherwise(F.lit("candidate"))
    )


def reason(status_: Column) -> Column:
    """Why a row has its status, in words."""
    return (
        F.when(status_ == "fetch_failed", "page fetch failed").when(status_ == "not_evidence", "no source-specific evidence terms matched")
        .when(status_ == "excluded_hygiene", "domain hygiene gate did not look company-like")
        .when(status_ == "review_needed", "homepage hygiene unknown; human or downstream validation required")
        .otherwise("candidate evidence; downstream validation required")
    )


def typed_hits(page_type: Column, lowered: Column) -> Column:
    """array(struct(kind, found)): the evidence types that the page's type allows, with the terms found."""
    entries = []
    for kind, (types, terms) in fixed.EVIDENCE.items():
        entries.append(F.struct(F.lit(kind).alias("kind"), F.when(page_type.isin(*types), T.term_hits(lowered, terms)).alias("found")))
    return F.filter(F.array(*entries), lambda e: F.coalesce(F.size(e["found"]) > 0, F.lit(False)))


def credible_hiring(terms: Column, text: Column, trust: Column) -> Column:
    """Do the terms of a careers page make a listing, and not the notice that there is none?"""
    t = F.coalesce(text, F.lit(""))
    has = lambda ts: F.arrays_overlap(terms, F.array(*[F.lit(x) for x in ts]))
    apply_ = F.array_contains(terms, "apply")
    board = t.rlike(r"(?i)https://[^\s]*(?:" + "|".join(h.replace(".", r"\.") for h in fixed.BOARD_HOSTS) + ")/")
    linked = (trust == "linked_ats_candidate") & (apply_ | has(fixed.DETAIL_TERMS) | board)
    return ~(t.rlike(fixed.NO_ROLES) & ~t.rlike(fixed.ROLE_CARD)) & (has(fixed.LISTING_TERMS) | linked | ((trust == "company_site") & apply_ & t.rlike(fixed.SAME_SITE_ROLE)))


def near_job_context(lowered: Column, terms: Column, reach: int = 450) -> Column:
    """Does wording of a job stand within ``reach`` characters of a place of one of the terms, as whole words?"""
    context = r"\b(?:" + "|".join(fixed.JOB_CONTEXT) + r")\b"
    def near(t: Column) -> Column:
        place = F.concat(F.lit(rf"(?s)(?<=(\A.{{0,{reach - 1}}}|.{{{reach}}}))\b\Q"), t, F.lit(rf"\E\b(?=(.{{0,{reach}}}))"))
        around = F.zip_with(F.regexp_extract_all(lowered, place, F.lit(1)), F.regexp_extract_all(lowered, place, F.lit(2)), lambda a, z: F.concat(a, t, z))
        return F.exists(around, lambda x: x.rlike(context))

    return F.exists(terms, near)


def evidence_rows(pages: DataFrame, homes: DataFrame) -> DataFrame:
    """One row per page and evidence type found, or one of type ``none``; ``homes`` has (domain, url, text) once a domain."""
    h = homes.select("domain", F.col("url").alias("_home_url"), T.hygiene(F.col("text")).alias("domain_hygiene"))
    p = pages.join(h, "domain", "left").withColumn("domain_hygiene", F.coalesce("domain_hygiene", F.lit("unknown")))
    p = p.withColumn("source_url", F.coalesce("url", "path")).withColumn("source_host", U.host(F.coalesce("url", "path"))).withColumn("ok", F.coalesce("ok", F.lit(False)))
    p = p.withColumn("source_trust", source_trust(F.col("domain"), F.col("_home_url"), F.col("source_url"), F.col("ok"), F.col("linked_from_homepage"), F.col("path"), F.col("page_type")))
    p = p.withColumn("_low", F.lower(F.when(F.col("ok"), F.coalesce("text", F.lit(""))).otherwise(F.lit(""))))
    names = lambda e: F.transform(e["found"], lambda x: x["term"])
    credible = lambda e: F.when(e["kind"] == "hiring_activity", credible_hiring(names(e), F.col("text"), F.col("source_trust"))).when(e["kind"] == "it_ops_hiring", F.arrays_overlap(names(e), F.array(*[F.lit(t) for t in OPERATIONS])) & near_job_context(F.col("_low"), names(e))).otherwise(F.lit(True))
    p = p.withColumn("_hits", F.filter(typed_hits(F.col("page_type"), F.col("_low")), credible))
    # the page of a posting plugin is a listing where no term says so
    plugin = F.col("ok") & (F.col("page_type") == "careers") & F.coalesce(F.col("text").rlike(PLUGIN_PAGE), F.lit(False)) & ~F.exists("_hits", lambda e: e["kind"] == "hiring_activity")
    listing = F.array(F.struct(F.lit("hiring_activity").alias("kind"), F.array(F.struct(F.lit("job listings").alias("term"), F.lit(1).alias("n"))).alias("found")))
    p = p.withColumn("_hits", F.when(plugin, F.concat("_hits", listing)).otherwise(F.col("_hits"))).withColumn("_e", F.explode_outer("_hits"))
    p = p.withColumn("evidence_type", F.coalesce("_e.kind", F.lit("none"))).withColumn("match_count", F.coalesce(T.total(F.col("_e.found")), F.lit(0)))
    p = p.withColumn("matched_terms", F.coalesce(F.transform("_e.found", lambda x: x["term"]), F.array().cast("array<string>")))
    p = p.withColumn("evidence_tier", tier(F.col("domain_hygiene"), F.col("source_trust"), F.col("evidence_type"), F.col("text")))
    p = p.withColumn("evidence_status", status(F.col("domain_hygiene"), F.col("source_trust"), F.col("evidence_type"), F.col("evidence_tier")))
    snip = F.when(F.col("evidence_type") == "none", F.lit("")).otherwise(T.snippet(F.col("text"), F.col("matched_terms")))
    return p.select("domain", "source_url", "source_host", "page_type", "source_trust", "domain_hygiene", "evidence_tier", "evidence_type", "evidence_status", "match_count", "matched_terms", snip.alias("snippet"), reason(F.col("evidence_status")).alias("reason"))


def page_rows(specs: DataFrame, pages: DataFrame, rubric_terms: dict[str, tuple[str, ...]]) -> DataFrame:
    """Stored pages against the wanted ones: type, address, and hits of the type's terms; unlisted pages as well."""
    low = F.lower(F.coalesce("text", F.lit("")))
    found = F.array().cast("array<struct<term:string,n:int>>")
    for kind, terms in rubric_terms.items():
        found = F.when(F.col("page_type") == kind, T.term_hits(low, terms)).otherwise(found)
    stored = pages.withColumn("_f", found).withColumn("match_count", T.total(F.col("_f"))).withColumn("matched_terms", F.transform("_f", lambda x: x["term"]))
    stored = stored.select("domain", "path", "page_type", "url", "status", "ok", "match_count", "matched_terms", T.snippet(F.col("text"), F.col("matched_terms")).alias("snippet"), "linked_from_homepage")
    listed = specs.select("domain", "path", F.col("page_type").alias("_wanted"))
    joined = listed.join(stored, ["domain", "path"], "full_outer")
    method = F.when(F.col("ok").isNull(), F.lit("missing")).when(F.col("ok"), F.lit("keyword")).otherwise(F.lit("fetch_failed"))
    return joined.withColumn("page_type", F.coalesce("page_type", "_wanted")).withColumn("method", method).drop("_wanted")


def boards_of(pages: DataFrame) -> DataFrame:
    """(domain, ats, slug): boards named by the pages' addresses."""
    b = board_of(F.col("url"))
    return pages.select("domain", b.alias("b")).where(F.col("b").isNotNull()).select("domain", F.col("b.ats").alias("ats"), F.col("b.slug").alias("slug")).distinct()
