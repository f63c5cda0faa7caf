"""Text measures, term counts and snippets as column expressions; everything stays in generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def clean(text: Column) -> Column:
    """Control characters to blanks, white space squeezed. Null gives an empty string."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, " "), r"\s+", " "))


def csv_safe(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, " ")


def hits(lowered: Column, term: str) -> Column:
    """How often a lower-cased text holds a term: whole words, or any place where the term isn't ASCII."""
    term = term.strip().lower()
    if not term.isascii():
        return ((F.length(lowered) - F.length(F.replace(lowered, F.lit(term), F.lit("")))) / len(term)).cast("int")
    return F.regexp_count(lowered, F.lit(rf"\b{re.escape(term)}\b"))


def term_hits(lowered: Column, terms: tuple[str, ...]) -> Column:
    """array(struct(term, n)) of the terms found, in their order."""
    kept = [t for t in dict.fromkeys(str(x).strip().lower() for x in terms) if t]
    if not kept:
        return F.array().cast("array<struct<term:string,n:int>>")
    return F.filter(F.array(*[F.struct(F.lit(t).alias("term"), hits(lowered, t).alias("n")) for t in kept]), lambda x: x["n"] > 0)


def total(found: Column) -> Column:
    return F.aggregate(found, F.lit(0), lambda a, x: a + x["n"])


def snippet(text: Column, terms: Column, window: int = 180) -> Column:
    """The surroundings of the first of the terms that the text holds; its beginning where it holds none."""
    t = clean(text)
    low = F.lower(t)
    found = F.filter(terms, lambda x: F.instr(low, x) > 0)
    first = F.get(found, F.lit(0))
    at = F.instr(low, first) - 1
    start = F.greatest(F.lit(0), at - window)
    around = F.substring(t, start + 1, at + F.length(first) + window - start)
    return F.when(first.isNull(), F.substring(t, 1, 2 * window)).otherwise(around)


def extracted_length(html: Column) -> Column:
    """Characters of text after scripts, styles and tags; 0 for null."""
    body = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|noscript)[^>]*>.*?</\1>", " ")
    return F.length(F.trim(F.regexp_replace(F.regexp_replace(body, r"(?s)<[^>]+>", " "), r"\s+", " ")))


def is_soft_block(html: Column, mitigated: Column | None = None) -> Column:
    """An anti-robot page behind a sound status: by header, title or the vendors' scripts."""
    low = F.lower(F.coalesce(html, F.lit("")))
    out = F.coalesce(html.rlike(fixed.CHALLENGE_TITLE), F.lit(False))
    for mark in fixed.CHALLENGE_MARKS:
        out = out | low.contains(mark)
    return out if mitigated is None else out | F.coalesce(F.lower(mitigated) == "challenge", F.lit(False))


def is_js_shell(html: Column, text: Column) -> Column:
    scripts = F.regexp_count(F.coalesce(html, F.lit("")), F.lit(r"(?i)<script\b")) >= 4
    return F.coalesce((F.length(html) >= fixed.MIN_HTML) & (F.length(F.trim(F.coalesce(text, F.lit("")))) < fixed.THIN_TEXT) & (scripts | html.rlike(fixed.SPA_ROOT)), F.lit(False))


def is_chrome_shell(html: Column, text: Column) -> Column:
    """A page of filter controls without a listing."""
    t = F.trim(F.coalesce(text, F.lit("")))
    words = F.size(F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(fixed.FILTER_WORDS), F.lit(0)), F.lower)))
    listed = F.coalesce(html, F.lit("")).rlike(fixed.DETAIL_ANCHOR) | F.regexp_replace(t, fixed.ZERO_STATE, " ").rlike(fixed.STRONG_CAREERS)
    return F.length(t).between(fixed.THIN_TEXT, fixed.SHELL_TEXT - 1) & (words >= 2) & ~listed


def render_hint(html: Column, text: Column, homepage_text: Column, page_type: Column) -> Column:
    t, home = F.trim(F.coalesce(text, F.lit(""))), F.trim(F.coalesce(homepage_text, F.lit("")))
    return (
        F.when((t != "") & (t == home), F.lit("stub")).when(is_js_shell(html, text), F.lit("js_shell"))
        .when((F.coalesce(page_type, F.lit("")) == "careers") & is_chrome_shell(html, text), F.lit("shell_chrome"))
    )


def votes(text: Column, phrases: tuple[str, ...]) -> Column:
    out = F.lit(0)
    for p in phrases:
        out = out + text.contains(p).cast("int")
    return out


def hygiene(homepage_text: Column) -> Column:
    """What kind of site a home page belongs to, by votes of its wording; null and blank give ``unknown``."""
    t = F.lower(clean(homepage_text))
    business = votes(t, fixed.BUSINESS)
    law = t.contains("law firm") & (votes(t, fixed.LEGAL_TECH) == 0)
    return (
        F.when(t == "", F.lit("unknown")).when((votes(t, fixed.PERSONAL) >= 2) & (business < 3), F.lit("personal_resume"))
        .when(((votes(t, fixed.CONSUMER) > 0) | law) & (business < 3), F.lit("consumer_or_local"))
        .when((F.length(t) < 120) | (votes(t, fixed.PARKED) > 0), F.lit("parked_or_thin")).otherwise(F.lit("company_like"))
    )


def norm_label(raw: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), "[^a-z0-9]", "")


def coerce_label(raw: Column, positive: str, negative: str) -> Column:
    """A free label snapped to one of the two, or ``unknown``; one that holds both names is unknown."""
    n, p, q = norm_label(raw), re.sub("[^a-z0-9]", "", positive.lower()), re.sub("[^a-z0-9]", "", negative.lower())
    has_p, has_q = (n.contains(p) if p else F.lit(False)), (n.contains(q) if q else F.lit(False))
    return (
        F.when(n == "", F.lit("unknown")).when(n == p, F.lit(positive)).when(n == q, F.lit(negative))
        .when(has_p & ~has_q, F.lit(positive)).when(has_q & ~has_p, F.lit(negative)).otherwise(F.lit("unknown"))
    )
