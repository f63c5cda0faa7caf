"""Links and boards in HTML, sitemaps and robots files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import url as U

_ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"


def anchors(pages: DataFrame, html: str = "html", base: str = "base_url") -> DataFrame:
    """``pages`` exploded to (pos, href, text, link): each anchor with its address made absolute; malformed ones are left out."""
    found = pages.withColumn("_h", F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_ANCHOR), F.lit(1))).withColumn("_t", F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_ANCHOR), F.lit(2)))
    keep = [c for c in pages.columns if c != html]
    rows = found.select(*keep, F.posexplode(F.arrays_zip("_h", "_t")).alias("pos", "a"))
    rows = rows.withColumn("href", F.trim("a._h")).withColumn("text", F.trim(F.regexp_replace(F.regexp_replace("a._t", "<[^>]+>", " "), r"\s+", " "))).drop("a")
    return rows.withColumn("link", U.join_url(F.col(base), F.col("href"))).where(F.col("link").isNotNull() & (F.col("href") != "") & ~F.col("href").startswith("#"))


def page_targets(pages: DataFrame, html: str = "html", base: str = "base_url", max_links: int | None = None) -> DataFrame:
    """(domain, path, url, page_type, pos): typed links of the site and of boards; first of each page key."""
    rows = anchors(pages, html, base)
    h, own = U.host(F.col("link")), U.host(F.col("domain"))
    allowed = U.same_or_below(h, own) | U.same_or_below(h, U.host(F.col(base))) | U.under(h, fixed.BOARD_HOSTS)
    typed = rows.withColumn("page_type", U.link_type(F.col("link"), F.col("text"))).where((F.col("page_type") != "") & ~U.is_ignored_link(F.col("link")))
    outside = (F.col("page_type") == "careers") & F.concat_ws(" ", "link", "text").rlike("(?i)" + fixed.RECRUITMENT_WORDS)
    root = (F.col("page_type") == "careers") & U.same_or_below(h, own) & (U.normalize_path(F.col("link")) == "/")
    kept = typed.where((allowed | outside) & ~root)
    same = U.host(F.col("link")) == U.host(F.col("domain"))
    keyed = kept.withColumn("path", F.when(same, U.normalize_path(F.col("link"))).otherwise(U.page_key(F.col("link"))))
    out = keyed.groupBy("domain", "path").agg(F.min_by(F.struct("link", "page_type"), "pos").alias("r"), F.min("pos").alias("pos"))
    out = out.select("domain", "path", F.col("r.link").alias("url"), F.col("r.page_type").alias("page_type"), "pos")
    if max_links is None:
        return out
    from .store import ranked

    return ranked(out, ["domain"], ["pos"]).where(F.col("rank") <= max_links).drop("rank")


def sitemap_locations(xml: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit(r"(?i)<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1)))


def robots_sitemaps(robots: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(robots, F.lit("")), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1)))


def outbound_domains(html: Column, domain: Column, limit: int = 6) -> Column:
    """Other domains that a page names, of the common endings, without social networks and boards."""
    named = F.regexp_extract_all(F.lower(F.coalesce(html, F.lit(""))), F.lit(r"\b([a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.(?:ai|io|com|co|net|org|app|dev|tech))\b"), F.lit(1))
    own = U.host(domain)
    kept = F.filter(F.array_distinct(named), lambda d: ~U.same_or_below(d, own) & ~U.same_or_below(own, d) & ~U.under(d, fixed.SOCIAL_HOSTS) & ~U.under(d, fixed.BOARD_HOSTS))
    return F.slice(kept, 1, limit)
