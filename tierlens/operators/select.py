"""Choosing pages: merged targets, the balanced selection in closed form, per-domain caps, what is left to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import url as U
from ..plans.rubric import literal_map


def targets_of(domains: DataFrame, specs: DataFrame) -> DataFrame:
    """Every domain with every page spec; the specs are a rubric's few paths and are broadcast."""
    return domains.select("domain").crossJoin(F.broadcast(specs)).withColumn("linked_from_homepage", F.lit(False))


def merge_targets(targets: DataFrame) -> DataFrame:
    """One row per (domain, page key): linked if any is, first address, first type that is not ``other``, first place."""
    keyed = targets.withColumn("path", U.page_key(F.col("path")))
    named = F.when(F.col("page_type") != "other", F.col("page_type"))
    return keyed.groupBy("domain", "path").agg(
        F.max(F.coalesce("linked_from_homepage", F.lit(False))).alias("linked_from_homepage"), F.min_by("url", F.when(F.col("url").isNotNull(), F.col("pos"))).alias("url"),
        F.coalesce(F.min_by(named, F.when(named.isNotNull(), F.col("pos"))), F.lit("other")).alias("page_type"), F.min("pos").alias("pos"),
    )


def priority(path: Column, url: Column, linked: Column, domain: Column) -> Column:
    """Order inside a page type: linked, board hosts, careers hubs, job wording, bare guesses last."""
    target = F.lower(F.coalesce(url, path))
    h = U.host(F.when(target.rlike("^https?://"), target).otherwise(F.lit("")))
    guess = (h == F.concat(F.lit("careers."), domain)) & ~linked
    return F.struct(
        (~linked).cast("int").alias("a"), (~U.under(h, fixed.BOARD_HOSTS)).cast("int").alias("b"), (~F.lower(path).rlike("hub/careers")).cast("int").alias("c"),
        (~target.rlike("job|opening|position|vacanc|role")).cast("int").alias("d"), guess.cast("int").alias("e"),
    )


def balanced(targets: DataFrame, cap: int | None, quota: dict[str, int] | None = None, order: list[str] | None = None) -> DataFrame:
    """At most ``cap`` targets a domain: quotas in type order first, then round robin over the types.

    With r the rank inside (domain, type), n the type's size and q = min(quota, n): r <= q is served in the
    first phase at (type, r), the rest in round r - q at (r - q, r - 1, type). One window ranks inside the
    type, one over the domain by that key; nothing is iterated. ``cap`` <= 0 gives no rows, None all.
    """
    if cap is not None and cap <= 0:
        return targets.limit(0).withColumn("rank", F.lit(0))
    if cap is None and not quota and not order:
        return targets.withColumn("rank", F.row_number().over(Window.partitionBy("domain").orderBy("pos", "path")))
    by_type = Window.partitionBy("domain", "page_type")
    prior = priority(F.col("path"), F.col("url"), F.coalesce("linked_from_homepage", F.lit(False)), F.col("domain"))
    r = targets.withColumn("_first", F.min("pos").over(by_type)).withColumn("_n", F.count(F.lit(1)).over(by_type))
    r = r.withColumn("_r", F.row_number().over(by_type.orderBy(prior, "pos", "path")))
    listed = {t: i for i, t in enumerate(order or ())}
    r = r.withColumn("_ord", F.struct(literal_map(listed, F.col("page_type"), 1 << 20).alias("l"), F.col("_first").alias("f"), F.col("page_type").alias("t")))
    q = F.least(literal_map(quota or {}, F.col("page_type")), F.col("_n"))
    served, zero = F.col("_r") <= q, F.lit(0)
    key = [F.when(served, 0).otherwise(1), F.when(served, zero).otherwise(F.col("_r") - q), F.when(served, zero).otherwise(F.col("_r") - 1), F.col("_ord"), F.col("_r")]
    out = r.withColumn("rank", F.row_number().over(Window.partitionBy("domain").orderBy(*key))).drop("_first", "_n", "_r", "_ord")
    return out if cap is None else out.where(F.col("rank") <= cap)


def to_fetch(targets: DataFrame, stored: DataFrame) -> DataFrame:
    """Targets without a stored page that is ok."""
    return targets.join(stored.where("ok").select("domain", "path").distinct(), ["domain", "path"], "left_anti")


def capped_renders(pages: DataFrame, cap: int = 4) -> DataFrame:
    """Careers pages worth a second, rendered fetch: failed, thin or shell pages; one per final address, ``cap`` a domain."""
    thin = F.col("ok") & (F.length(F.trim(F.coalesce("text", F.lit("")))) < 500)
    failed = ~F.col("ok") & F.col("status").isin(0, 403, 429)
    want = (F.col("page_type") == "careers") & F.coalesce(thin | failed | F.col("render_hint").isin("js_shell", "stub", "shell_chrome") | F.col("url").contains("#"), F.lit(False))
    kept = pages.where(want).withColumn("final_key", U.page_key(F.coalesce("url", "path")))
    once = kept.groupBy("domain", "final_key").agg(F.min("path").alias("path"))
    return once.withColumn("rank", F.row_number().over(Window.partitionBy("domain").orderBy("path", "final_key"))).where(F.col("rank") <= cap)


def unresolved(domains: DataFrame, pages: DataFrame) -> DataFrame:
    """Domains without an ok board page with text and without an ok careers page that reads strong."""
    text = F.coalesce(F.col("text"), F.lit(""))
    good = (F.col("page_type") == "careers") & F.col("ok") & ((U.under(U.host(F.col("url")), fixed.BOARD_HOSTS) & (F.trim(text) != "")) | text.rlike(fixed.STRONG_CAREERS))
    return domains.select("domain").distinct().join(pages.where(good).select("domain").distinct(), "domain", "left_anti")


def with_guesses(targets: DataFrame) -> DataFrame:
    """The targets, and ``careers.<domain>`` for every domain that has a careers target; after all others in order."""
    guess = targets.where(F.col("page_type") == "careers").groupBy("domain").agg(F.max("pos").alias("pos"))
    url = F.concat(F.lit("https://careers."), F.col("domain"))
    return targets.unionByName(guess.select("domain", url.alias("path"), F.lit("careers").alias("page_type"), (F.col("pos") + 1).alias("pos"), F.lit(False).alias("linked_from_homepage")), allowMissingColumns=True)


def candidates_only(pages: DataFrame) -> DataFrame:
    """Stored careers candidates that the home page links or that lie on a board: those worth a late fetch."""
    linked = F.coalesce("linked_from_homepage", F.lit(False))
    board = U.under(U.host(F.coalesce("url", "path")), fixed.BOARD_HOSTS)
    return pages.where((F.col("tier") == "candidate") & (F.col("page_type") == "careers") & (linked | board))


def without_careers(domains: DataFrame, pages: DataFrame) -> DataFrame:
    """Domains without any stored careers page that is ok: the ones whose boards and indexes are looked up."""
    known = pages.where(F.col("ok") & ((F.col("page_type") == "careers") | U.under(U.host(F.coalesce("url", "path")), fixed.BOARD_HOSTS)))
    return domains.select("domain").distinct().join(known.select("domain").distinct(), "domain", "left_anti")


def follow_up(unresolved_: DataFrame, candidates: DataFrame, budget: int = 3) -> DataFrame:
    """At most ``budget`` careers candidates of each unresolved domain, by the order of the balanced selection."""
    wanted = candidates.where(F.col("page_type") == "careers").join(unresolved_.select("domain").distinct(), "domain", "left_semi")
    return balanced(wanted, budget, {"careers": budget}, ["careers"])


def scoring_input(domains: DataFrame, pages: DataFrame) -> DataFrame:
    """Every domain in its order with the text of its page, empty where there is none."""
    return domains.join(pages.select("domain", "text"), "domain", "left").withColumn("text", F.coalesce("text", F.lit("")))


def to_judge(domains: DataFrame, verdicts: DataFrame, rubric: str) -> DataFrame:
    """Domains without a verdict of this rubric, or with a failed fetch for one."""
    done = verdicts.where((F.col("rubric") == rubric) & (F.col("method") != "fetch_failed"))
    return domains.select("domain").distinct().join(done.select("domain").distinct(), "domain", "left_anti")
