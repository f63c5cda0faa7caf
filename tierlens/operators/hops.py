"""Hops of the link graph: from careers pages to listings, from splash pages to the firm, a fixed number of times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import url as U
from ..runtime import checkpointed
from .links import page_targets


def is_utility_url(url: Column) -> Column:
    """An address on a board's host that is no board: sign-in, assets, policies, templates left unfilled."""
    u = F.coalesce(url, F.lit(""))
    h = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    out = u.rlike(r"[{}]") | F.lower(u).contains("poweredby")
    for host, where in fixed.UTILITY_URLS:
        rule = h.rlike(host) if host else F.lit(True)
        out = out | (rule & path.rlike(where) if where else rule)
    return out


def widget_board_url(url: Column) -> Column:
    """The board behind a widget's script; null where the address is none."""
    h = F.lower(F.regexp_extract(url, r"^https?://([^/?#:]*)", 1))
    path = F.regexp_replace(F.regexp_extract(url, r"^https?://[^/?#]*([^?#]*)", 1), "/+$", "")
    board = F.regexp_extract(url, r"[?&]for=([^&#]+)", 1)
    green = h.rlike(r"^(boards|job-boards)(\.eu)?\.greenhouse\.io$") & (path == "/embed/job_board/js") & (board != "")
    eu = F.when(h.contains(".eu."), F.lit("https://job-boards.eu.greenhouse.io")).otherwise(F.lit("https://job-boards.greenhouse.io"))
    return F.when(green, F.concat(eu, F.lit("/embed/job_board?for="), board)).when(h.endswith(".bamboohr.com") & (path == "/js/embed.js"), F.concat(F.lit("https://"), h, F.lit("/careers")))


def board_tokens(html: Column) -> Column:
    """array(struct(ats, slug)) of boards that embedded JSON names."""
    def named(ats: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(1)), lambda s: F.struct(F.lit(ats).alias("ats"), s.alias("slug")))

    found = [named(*x) for x in fixed.BOARD_TOKENS.items()]
    return F.array_distinct(F.concat(*found))


def careers_urls(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(fixed.CAREERS_URL), F.lit(0)))


def social_job_tabs(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(fixed.SOCIAL_JOBS), F.lit(0)))


def is_thin_splash(html: Column, n_careers: Column) -> Column:
    """No careers link found and hardly any link at all."""
    return (F.coalesce(n_careers, F.lit(0)) == 0) & (F.regexp_count(F.coalesce(html, F.lit("")), F.lit("(?i)<a ")) <= 5)


def second_hop(pages: DataFrame, html: str = "html", base: str = "base_url") -> DataFrame:
    """Targets of careers pages that are boards, listings or single postings; the page itself is left out."""
    t = page_targets(pages, html, base).where("page_type = 'careers'")
    path = F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    own = U.same_or_below(U.host(F.col("url")), U.host(F.col("domain")))
    detail = own & path.rlike(fixed.DETAIL_PATH) & ~path.rlike(fixed.NO_DETAIL_PATH)
    keep = (U.under(U.host(F.col("url")), fixed.BOARD_HOSTS) | path.rlike(fixed.LISTING_PATH) | detail) & ~is_utility_url(F.col("url"))
    selves = pages.select("domain", U.page_key(F.col(base)).alias("_key")).distinct()
    return t.where(keep).withColumn("_key", U.page_key(F.col("url"))).join(selves, ["domain", "_key"], "left_anti").drop("_key")


def expand(start: DataFrame, fetch: Callable[[DataFrame], DataFrame], hops: int = 3) -> DataFrame:
    """(domain, path, hop): targets reached in at most ``hops`` hops, each once, at the first hop that reaches it.

    ``fetch`` gives the pages of targets with ``html`` and ``base_url``. Each hop is written before the next begins.
    """
    seen = checkpointed(start.select("domain", "path", "url").dropDuplicates(["domain", "path"]).withColumn("hop", F.lit(0)))
    front = seen
    for n in range(1, hops + 1):
        found = second_hop(fetch(front)).select("domain", "path", "url").dropDuplicates(["domain", "path"])
        front = checkpointed(found.join(seen.select("domain", "path"), ["domain", "path"], "left_anti").withColumn("hop", F.lit(n)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def first_by_final_url(rows: DataFrame) -> DataFrame:
    """Of ok page rows that end at one address, the first by position; others stay."""
    final = F.when(F.col("ok"), U.page_key(F.col("url"))).otherwise(F.concat(F.lit("\0"), F.col("path")))
    rest = [c for c in rows.columns if c != "domain"]
    return rows.groupBy("domain", final.alias("_final")).agg(F.min_by(F.struct(*rest), "pos").alias("r")).select("domain", "r.*")
