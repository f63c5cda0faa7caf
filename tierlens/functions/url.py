"""URLs, hosts and page keys as column expressions. A null stays null unless a function says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def normalize_domain(raw: Column) -> Column:
    """Lower case, without scheme, path and query; ``www.`` and port stay. Null gives an empty string."""
    d = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    return F.trim(F.regexp_replace(F.regexp_replace(d, "^https?://", ""), r"[/?].*$", ""))


def strip_tracking(query: Column) -> Column:
    """The query without tracking parameters and empty segments; the rest keeps order and encoding."""
    kept = F.filter(F.split(query, "&"), lambda s: (s != "") & ~s.rlike(f"(?i)^(?:{fixed.TRACKING_PARAM})(=|$)"))
    return F.array_join(kept, "&")


def _with_query(base: Column, query: Column) -> Column:
    bare = F.regexp_replace(base, "/+$", "")
    bare = F.when(bare == "", F.lit("/")).otherwise(bare)
    kept = strip_tracking(query)
    return F.when(kept == "", bare).otherwise(F.concat(bare, F.lit("?"), kept))


def normalize_path(raw: Column) -> Column:
    """A path from the root without fragment, tracking parameters and closing slash. Null and blank give ``/``."""
    p = F.trim(F.coalesce(raw, F.lit("")))
    p = F.when(p.rlike("(?i)^https?://[^/]"), F.regexp_replace(p, "(?i)^https?://[^/]+", "")).otherwise(p)
    p = F.regexp_replace(F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p)), r"#[\s\S]*$", "")
    return _with_query(F.regexp_extract(p, r"^([^?]*)", 1), F.regexp_extract(p, r"^[^?]*\?([\s\S]*)$", 1))


def page_key(raw: Column) -> Column:
    """The key a page is stored under: a path, or an absolute URL with scheme and host in lower case."""
    v = F.trim(F.coalesce(raw, F.lit("")))
    at = r"(?i)^(https?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
    path = F.regexp_replace(F.regexp_extract(v, at, 3), r";[^/]*$", "")
    absolute = F.concat(F.lower(F.regexp_extract(v, at, 1)), F.lit("://"), F.lower(F.regexp_extract(v, at, 2)), _with_query(path, F.regexp_extract(v, at, 4)))
    return F.when(v.rlike("(?i)^https?://"), absolute).otherwise(normalize_path(v))


def host(value: Column) -> Column:
    """Host in lower case without ``www.``, port and user; empty where there is none."""
    h = F.lower(F.regexp_extract(F.coalesce(value, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(h, r"^www\.", "")


def is_plausible_host(h: Column) -> Column:
    label = "[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
    return F.coalesce(h.rlike(rf"(?i)^{label}(?:\.{label})+$"), F.lit(False))


def registrable(value: Column) -> Column:
    """The last two labels of the host."""
    labels = F.filter(F.split(host(value), r"\."), lambda x: x != "")
    return F.when(F.size(labels) >= 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host(value))


def host_suffixes(h: Column) -> Column:
    """The host and each of its parent domains, to meet a table of hosts by equality."""
    labels = F.split(h, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def under(h: Column, hosts: tuple[str, ...]) -> Column:
    """Is the host one of ``hosts`` or below one?"""
    return F.arrays_overlap(host_suffixes(h), F.array(*[F.lit(x) for x in hosts]))


def same_or_below(h: Column, parent: Column) -> Column:
    return F.coalesce((parent != "") & ((h == parent) | h.endswith(F.concat(F.lit("."), parent))), F.lit(False))


def is_careers_host(h: Column) -> Column:
    return F.coalesce(F.lower(h).rlike(fixed.CAREERS_HOST), F.lit(False))


def page_type(path: Column) -> Column:
    p = F.lower(normalize_path(path))
    out = F.lit("other")
    for kind, pattern in reversed(fixed.PAGE_TYPES):
        out = F.when(p.rlike(pattern), F.lit(kind)).otherwise(out)
    return out


def link_type(url: Column, text: Column) -> Column:
    """The type of page a link leads to, by its address and wording; empty where it leads to none."""
    joined = F.lower(F.concat_ws(" ", F.coalesce(url, F.lit("")), F.coalesce(text, F.lit(""))))
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1))
    out = F.lit("")
    for kind, pattern in reversed(fixed.LINK_TYPES):
        out = F.when(joined.rlike(pattern), F.lit(kind)).otherwise(out)
    careers = under(host(url), fixed.BOARD_HOSTS) | path.rlike("(^|/)(recruit|recruitment)(/|$)") | joined.rlike(fixed.CAREER_PHRASES) | joined.rlike(fixed.CAREER_WORDS)
    return F.when(joined.rlike(fixed.LINK_NOISE), F.lit("")).when(careers, F.lit("careers")).otherwise(out)


def is_ignored_link(url: Column) -> Column:
    """Not http, a social network, or an asset."""
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    ending = path.rlike("(" + "|".join(x.replace(".", r"\.") for x in fixed.ASSET_ENDINGS) + ")$")
    return ~F.coalesce(url.rlike("(?i)^https?://"), F.lit(False)) | under(host(url), fixed.SOCIAL_HOSTS) | ending


def join_url(base: Column, href: Column) -> Column:
    """The absolute URL of a reference; null where the reference is malformed."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.concat(root, F.regexp_extract(F.concat(F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("")), r"^(.*/)?[^/]*$", 1))
    folder = F.when(folder == root, F.concat(root, F.lit("/"))).otherwise(folder)
    relative = F.regexp_replace(F.regexp_replace(F.concat(folder, href), r"/(\./)+", "/"), r"(?<=[^:/])/[^/]+/\.\./", "/")
    return (
        F.when(href.rlike(r"[\[\]\s]"), F.lit(None).cast("string"))
        .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?") | href.startswith("#"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), href))
        .otherwise(relative)
    )


def acquirer(final_url: Column, domain: Column) -> Column:
    """struct(acquired, host, registrable, slug): does a page of the domain lie on another firm's domain?"""
    fr, dr = registrable(final_url), registrable(domain)
    gone = F.coalesce((fr != "") & (dr != "") & (fr != dr) & ~under(host(final_url), fixed.BOARD_HOSTS), F.lit(False))
    null = F.lit(None).cast("string")
    return F.struct(
        gone.alias("acquired"), F.when(gone, host(final_url)).otherwise(null).alias("host"), F.when(gone, fr).otherwise(null).alias("registrable"),
        F.when(gone, F.split(fr, r"\.")[0]).otherwise(null).alias("slug"),
    )
