"""Job boards: which board an address names, guesses of board names, counts from the boards' JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import url as U

_LOCALE = "(?i)^[a-z]{2}[-_][a-z]{2,3}$"


def _param(url: Column, name: str) -> Column:
    return F.trim(F.coalesce(F.try_url_decode(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)), F.lit("")))


def board_of(url: Column) -> Column:
    """struct(ats, slug) of a board's address; null where it is none."""
    full = F.when(url.contains("//"), url).otherwise(F.concat(F.lit("https://"), url))
    h = F.lower(F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    seg = F.filter(F.split(F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/"), lambda s: s != "")
    at = lambda i: F.coalesce(F.get(seg, F.lit(i)), F.lit(""))
    sub = lambda suffix: F.regexp_extract(h, rf"^(.+)\.{suffix.replace('.', chr(92) + '.')}$", 1)
    named = lambda ats, slug: F.struct(F.lit(ats).alias("ats"), slug.alias("slug"))
    plain = F.filter(seg, lambda s: ~s.isin("embed", "job_board", "jobs", "js"))
    site = F.get(F.filter(F.slice(seg, 1, F.when(F.array_position(F.transform(seg, F.lower), "job") > 0, F.array_position(F.transform(seg, F.lower), "job") - 1).when(F.array_position(F.transform(seg, F.lower), "jobs") > 0, F.array_position(F.transform(seg, F.lower), "jobs") - 1).otherwise(F.size(seg)).cast("int")), lambda s: ~s.rlike(_LOCALE)), F.lit(0))
    rules = [
        ("greenhouse", h.rlike(r"(^|\.)(boards|job-boards)(\.eu)?\.greenhouse\.io$"), F.when(_param(full, "for") != "", _param(full, "for")).otherwise(F.get(plain, F.lit(0)))),
        ("lever", h.isin("jobs.lever.co", "jobs.eu.lever.co"), at(0)),
        ("ashby", h == "jobs.ashbyhq.com", at(0)),
        ("smartrecruiters", h.isin("jobs.smartrecruiters.com", "careers.smartrecruiters.com"), at(0)),
        ("workable", h == "apply.workable.com", F.when(at(0) != "j", at(0))),
        ("workable", h.endswith(".workable.com") & (h != "apply.workable.com"), F.when(~sub("workable.com").isin("www", "jobs", "jobseekers", "careers", "help", "resources", "status", "apply", "developers"), sub("workable.com"))),
        ("recruitee", h.endswith(".recruitee.com"), F.when(sub("recruitee.com") != "www", sub("recruitee.com"))),
        ("pinpoint", h.endswith(".pinpointhq.com"), F.when(sub("pinpointhq.com") != "www", sub("pinpointhq.com"))),
        ("rippling", h == "ats.rippling.com", F.when(at(0).rlike(_LOCALE), F.when(F.size(seg) >= 3, at(1))).otherwise(at(0))),
        ("breezy", h.endswith(".breezy.hr"), F.when(~sub("breezy.hr").isin("www", "app"), sub("breezy.hr"))),
        ("ultipro", h.rlike(r"^recruiting2?\.ultipro\.com$") & (F.lower(at(1)) == "jobboard") & (F.size(seg) >= 3), F.concat(at(0), F.lit("/"), at(2))),
        ("workday", h.rlike(r"^[a-z0-9-]+\.wd\d+\.myworkdayjobs\.com$") & site.isNotNull(), F.concat(F.regexp_extract(h, r"^([a-z0-9-]+)\.", 1), F.lit("/"), site)),
        ("adp", h == "workforcenow.adp.com", _param(full, "cid")),
        ("adp_myjobs", h.isin("myjobs.adp.com", "recruiting.adp.com"), at(0)),
        ("icims", h.rlike(r"^careers-[a-z0-9-]+\.icims\.com$"), F.regexp_extract(h, r"^careers-([a-z0-9-]+)\.icims\.com$", 1)),
    ]
    out = F.lit(None).cast("struct<ats:string,slug:string>")
    for ats, when, slug in reversed(rules):
        out = F.when(F.coalesce(when & (slug != ""), F.lit(False)), named(ats, slug)).otherwise(out)
    return out


def board_url(ats: Column, slug: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in fixed.BOARD_URLS.items():
        a, _, z = pattern.partition("%s")
        out = F.when((ats == name) & (slug != ""), F.concat(F.lit(a), slug, F.lit(z))).otherwise(out)
    return out


def slug_guesses(domain: Column, limit: int = 6) -> Column:
    """Board names a domain suggests, likeliest first: its label, without a brand prefix, without hyphens, then with ``inc`` and ``1``."""
    labels = F.filter(F.split(U.host(F.trim(F.coalesce(domain, F.lit("")))), r"\."), lambda x: x != "")
    first = F.aggregate(labels, F.struct(F.lit(0).alias("skip"), F.lit(True).alias("on")), lambda a, x: F.struct(F.when(a["on"] & x.isin(*fixed.NON_APEX) & (F.size(labels) - a["skip"] > 2), a["skip"] + 1).otherwise(a["skip"]).alias("skip"), (a["on"] & x.isin(*fixed.NON_APEX) & (F.size(labels) - a["skip"] > 2)).alias("on")))
    label = F.coalesce(F.get(labels, first["skip"]), F.lit(""))
    short = [F.when(label.startswith(p) & (F.length(label) > len(p) + 2), F.substring(label, len(p) + 1, 1000)) for p in fixed.BRAND_PREFIXES]
    forms = F.array(label, *short, F.when(label.contains("-"), F.replace(label, F.lit("-"), F.lit(""))), F.concat(label, F.lit("inc")), F.concat(label, F.lit("1")))
    both = F.flatten(F.transform(forms, lambda s: F.array(s, F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1000)))))
    fit = F.filter(both, lambda s: F.coalesce(s.rlike("^[A-Za-z0-9][A-Za-z0-9-]*$"), F.lit(False)))
    return F.when(label == "", F.array().cast("array<string>")).otherwise(F.slice(F.array_distinct(fit), 1, limit))


# Where each platform's JSON has its list (the first that is there), its title, its own total, and its department.
SHAPES = {
    "greenhouse": (("$.jobs",), "title", "$.meta.total", "departments"), "lever": (("$", "$.postings"), "text", None, "categories"), "ashby": (("$.jobs",), "title", None, "departmentName"),
    "smartrecruiters": (("$.content",), "name", "$.totalFound", "department"), "workable": (("$.jobs", "$.results"), "title", None, "department"), "recruitee": (("$.offers",), "title", None, "department"),
    "pinpoint": (("$.data", "$"), "title", None, "department"), "rippling": (("$", "$.items", "$.jobs", "$.results"), "name", None, "department"), "breezy": (("$",), "name", None, "department"),
    "workday": (("$.jobPostings",), "title", "$.total", None),
}
_ITEM = "array<struct<id:string,uuid:string,shortcode:string,title:string,name:string,text:string,isListed:boolean,status:string,location:string,department:string,departmentName:string,departments:string,categories:string,attributes:struct<title:string,department:string,location:string>,absolute_url:string,hostedUrl:string,jobUrl:string,url:string,careers_url:string,updated_at:string,publishedAt:string,published_at:string,createdAt:string>>"


def _label(value: Column) -> Column:
    """The label of a department or place that is a string or an object."""
    parts = [F.get_json_object(value, f"$.{k}") for k in ("label", "name", "team", "city")]
    return F.when(value.startswith("{"), F.coalesce(*[F.when(p != "", p) for p in parts])).otherwise(F.when(value != "", value))


def _department(ats: str, x: Column) -> Column:
    if ats == "greenhouse":
        return F.get_json_object(x["departments"], "$[0].name")
    if ats == "lever":
        return F.coalesce(*[_label(F.get_json_object(x["categories"], f"$.{k}")) for k in ("team", "department")])
    if ats == "ashby":
        return F.coalesce(_label(x["departmentName"]), _label(x["department"]))
    if ats == "pinpoint":
        return F.coalesce(_label(x["attributes"]["department"]), _label(x["department"]))
    return F.lit(None).cast("string") if ats == "workday" else _label(x["department"])


def _titled(ats: str, x: Column) -> Column:
    if ats == "pinpoint":
        return F.coalesce(x["attributes"]["title"], x["title"])
    return F.coalesce(x["name"], x["title"]) if ats == "rippling" else x[SHAPES[ats][1]]


def _once(value: Column, make) -> Column:
    """``make(value)`` with the value computed one time: inside a lambda an expression is computed again for each element that names it."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def _items(ats: str, body: Column) -> Column:
    """The live items of a platform's JSON; null where the body has another shape."""
    lists = [F.from_json(_once(F.get_json_object(body, p), lambda j: F.when(j.startswith("["), j)), _ITEM) for p in SHAPES[ats][0]]
    items = F.coalesce(*lists)
    if ats == "ashby":
        return F.filter(items, lambda x: F.coalesce(x["isListed"], F.lit(True)))
    if ats == "recruitee":
        return F.filter(items, lambda x: F.coalesce(F.when(x["status"] != "", x["status"]), F.lit("published")) == "published")
    return items


def _by_platform(ats: Column, make, kind: str) -> Column:
    out = F.lit(None).cast(kind)
    for name in SHAPES:
        out = F.when(ats == name, make(name)).otherwise(out)
    return out


def _count(ats: str, body: Column, items: Column) -> Column:
    """A board's own total goes before the length of the page it sent."""
    total = SHAPES[ats][2]
    return F.size(items) if total is None else F.coalesce(F.get_json_object(body, total).try_cast("int"), F.size(items))


def counts_from_json(ats: Column, body: Column) -> Column:
    """struct(count, titles, departments) of a board's JSON; null where the body is no such JSON. A count of 0 is an answer, null none."""

    def told(name: str, items: Column) -> Column:
        filled = lambda c: F.filter(c, lambda t: t.isNotNull() & (t != ""))
        got = F.struct(_count(name, body, items).cast("int").alias("count"), filled(F.transform(items, lambda x: _titled(name, x))).alias("titles"), F.array_sort(F.array_distinct(filled(F.transform(items, lambda x: _department(name, x))))).alias("departments"))
        return F.when(items.isNotNull(), got)

    make = lambda name: _once(_items(name, body), lambda items: told(name, items))
    return _by_platform(ats, make, "struct<count:int,titles:array<string>,departments:array<string>>")


def _first_of_each(records: Column, key) -> Column:
    """The records whose key no earlier one has, in their order. The keys are sorted, so that a board of any length takes n log n steps."""
    keyed = F.sort_array(F.transform(records, lambda r, i: F.struct(key(r).alias("key"), i.alias("at"))))
    first = _once(keyed, lambda s: F.filter(s, lambda e, i: (i == 0) | (F.get(s, i - 1)["key"] != e["key"])))
    return F.transform(F.sort_array(F.transform(first, lambda e: e["at"])), lambda at: F.get(records, at))


POSTING = "struct<posting_id:string,title:string,location:string,department:string,url:string,published_at:string>"


def harvest(boards: DataFrame, limit: int | None = None) -> DataFrame:
    """(… , count, got, truncated, postings) of stored board JSON in (…, ats, body) rows; null where the body has another shape.

    ``postings`` are the records of the platform in one form, an id once; ``limit`` is the feature of a bounded
    harvest and None takes all. ``truncated`` says that the board has more than were taken for the limit.
    """

    def told(name: str, items: Column) -> Column:
        record = lambda x: F.struct(
            F.coalesce(x["id"], x["uuid"], x["shortcode"]).alias("posting_id"), _titled(name, x).alias("title"),
            F.coalesce(_label(x["location"]), F.get_json_object(x["categories"], "$.location"), x["attributes"]["location"]).alias("location"), _department(name, x).alias("department"),
            F.coalesce(x["absolute_url"], x["hostedUrl"], x["jobUrl"], x["careers_url"], x["url"]).alias("url"), F.coalesce(x["publishedAt"], x["published_at"], x["createdAt"], x["updated_at"]).alias("published_at"),
        )
        records = F.filter(F.transform(items, record), lambda r: r["title"].isNotNull() & (r["title"] != ""))
        once = _once(records, lambda rs: _first_of_each(rs, lambda r: F.coalesce(r["posting_id"], F.concat_ws("|", r["title"], r["location"]))))
        return F.when(items.isNotNull(), F.struct(_count(name, F.col("body"), items).cast("int").alias("count"), once.alias("postings")))

    make = lambda name: _once(_items(name, F.col("body")), lambda items: told(name, items))
    out = boards.withColumn("_h", _by_platform(F.col("ats"), make, f"struct<count:int,postings:array<{POSTING}>>"))
    taken = F.col("_h.postings") if limit is None else F.slice("_h.postings", 1, limit)
    out = out.withColumn("count", F.col("_h.count")).withColumn("postings", taken).withColumn("got", F.size(taken))
    cut = F.lit(False) if limit is None else (F.col("count") > F.col("got")) & (F.col("got") >= limit)
    return out.withColumn("truncated", cut & F.col("count").isNotNull()).drop("_h")


def first_board(answers: DataFrame, by: list[str], order: str = "pos", count: str = "count") -> DataFrame:
    """One answer of each group: the first with a count above 0, else the first that answered at all; failures give none."""
    rank = F.struct((F.col(count) <= 0).alias("empty"), F.col(order).alias("at"))
    kept = answers.where(F.col(count).isNotNull())
    rest = [c for c in answers.columns if c not in by]
    return kept.groupBy(*by).agg(F.min_by(F.struct(*rest), rank).alias("r")).select(*by, *[F.col(f"r.{c}").alias(c) for c in rest])
