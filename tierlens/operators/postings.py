"""Job postings out of JSON that pages embed: blobs, lists of objects, the shape of a posting."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import map_arrow

# Bounds of the search in one page; None in a call switches a bound off.
MAX_BLOB, MAX_BLOBS, MAX_POSTINGS, MAX_NODES, MAX_DEPTH, MAX_TITLE = 8_000_000, 25, 300, 60_000, 14, 300
# Folded keys of titles (in order of preference), of persons, of ids and addresses, and closed states.
STRONG_TITLES = ("jobtitle", "positiontitle", "jobname", "roletitle", "position")
PLAIN_TITLES = ("title", "name", "text")
PERSON_KEYS = frozenset(("firstname", "lastname", "fullname", "avatar", "headshot", "bio", "linkedin", "linkedinurl", "twitter", "email"))
CLOSED = frozenset(("closed", "archived", "draft", "inactive", "expired", "unpublished", "filled", "paused", "deleted"))
ID_KEYS = ("id", "jobid", "postingid", "requisitionid", "reqid", "shortcode", "slug")
URL_KEYS = ("absoluteurl", "hostedurl", "applyurl", "applicationurl", "url", "href")
# What a folded key says about its object; parts of keys, and whole keys.
_FAMILIES = (
    ("location", r"location|remote|^(?:city|cities|country|countries|office|offices|workplace|workplacetype)$"),
    ("employment", r"contract|employment|commitment|schedule|^(?:jobtype|jobtypes|workmode)$"),
    ("apply", r"apply|hostedurl|absoluteurl|applicationurl|applicationform"),
    ("ident", r"requisition|^(?:jobid|reqid|postingid|shortcode|jobcode|jobref)$"),
    ("org", r"department|team|^(?:category|categories|division|function|discipline|typesofwork)$"),
    ("date", r"published|posted"),
    ("desc", r"description|^(?:requirements|responsibilities|qualifications)$"),
)
FAMILIES = tuple((name, re.compile(pattern)) for name, pattern in _FAMILIES)
STRONG_FAMILIES = frozenset(("location", "employment", "apply", "ident"))
_BLOB = re.compile(r"<script[^>]*(?:id=[\"']__NEXT_DATA__[\"']|type=[\"']application/(?:ld\+)?json[\"'])[^>]*>(.*?)</script>", re.S | re.I)
_ASSIGNED = re.compile(r"window\.__(?:remixContext|NUXT|INITIAL_STATE|APOLLO_STATE)__?\s*=\s*(?=[{\[])")


def blobs(html: str) -> Iterator[object]:
    """Each JSON value that the page embeds, once."""
    seen: set[str] = set()
    raw = [m.group(1) for m in _BLOB.finditer(html)]
    for m in _ASSIGNED.finditer(html):
        try:
            value, _ = json.JSONDecoder().raw_decode(html[m.end() : m.end() + MAX_BLOB])
            raw.append(json.dumps(value))
        except ValueError:
            continue
    for payload in raw[:MAX_BLOBS]:
        mark = hashlib.sha1(payload.encode()).hexdigest()
        if mark in seen or len(payload) > MAX_BLOB:
            continue
        seen.add(mark)
        try:
            yield json.loads(payload)
        except ValueError:
            continue


def object_lists(root: object) -> Iterator[list[dict]]:
    """Every list of objects in a JSON value, to a bounded depth and number of nodes."""
    stack, nodes = [(root, 0)], 0
    while stack and nodes < MAX_NODES:
        node, depth = stack.pop()
        nodes += 1
        if depth > MAX_DEPTH:
            continue
        if isinstance(node, list):
            if found := [x for x in node if isinstance(x, dict)]:
                yield found
            stack += [(x, depth + 1) for x in reversed(node)]
        elif isinstance(node, dict):
            stack += [(x, depth + 1) for x in reversed(list(node.values()))]


def plain(value: object, depth: int = 0) -> str | None:
    """The text of a value: strings without tags, the label of an object, lists joined."""
    if depth > 4 or value is None or isinstance(value, bool):
        return None
    if isinstance(value, str):
        return " ".join(re.sub(r"<[^>]+>", " ", value).split()) or None
    if isinstance(value, (int, float)):
        return str(value)
    if isinstance(value, dict):
        return next((t for k in ("title", "name", "label", "text", "value", "city", "description") if (t := plain(value.get(k), depth + 1))), None)
    return ", ".join(t for x in value if (t := plain(x, depth + 1))) or None


def family(key: str) -> str | None:
    """What a folded key is about; the first family that fits."""
    return next((name for name, pattern in FAMILIES if pattern.search(key)), None)


def _title(value: object) -> str | None:
    """A title without tags; None for what is none: too short or long, an address, a mail address."""
    t = " ".join(re.sub(r"<[^>]+>", " ", value).split()) if isinstance(value, str) else ""
    unfit = not 2 < len(t) <= MAX_TITLE or re.match(r"(?i)https?://", t) or ("@" in t and " " not in t)
    return None if unfit else t


def posting(item: dict) -> dict | None:
    """The posting an object describes; None where its shape is another's (navigation, articles, persons, events).

    A title key of job wording needs one strong family of keys or two of any kind; a plain title key needs a
    strong one and two in all.
    """
    by_key = {re.sub(r"[^a-z0-9]", "", str(k).lower()): v for k, v in item.items()}
    state = item.get("status") or item.get("state")
    if not item or len(item) > 80 or PERSON_KEYS & by_key.keys() or item.get("isEvent") is True or (isinstance(state, str) and state.strip().lower() in CLOSED):
        return None
    titled = next(((k, t) for k in (*STRONG_TITLES, *PLAIN_TITLES) if (t := _title(by_key.get(k)))), None)
    if titled is None:
        return None
    of = {k: f for k in by_key if (f := family(k))}
    families = set(of.values())
    strong = families & STRONG_FAMILIES
    enough = (strong or len(families) >= 2) if titled[0] in STRONG_TITLES else (strong and len(families) >= 2)
    if not enough:
        return None
    first = lambda keys: next((t for k in keys if (t := plain(by_key[k]))), None)
    about = lambda name: [k for k, f in of.items() if f == name]
    places = about("location")
    ident = next((str(by_key[k]).strip() for k in ID_KEYS if isinstance(by_key.get(k), (str, int)) and str(by_key[k]).strip()), None)
    link = next((by_key[k].strip() for k in URL_KEYS if isinstance(by_key.get(k), str) and by_key[k].strip()), None)
    return {
        "posting_id": ident, "title": titled[1], "location": first([k for k in places if "remote" not in k]) or first(places), "department": first(about("org")),
        "description_text": first(about("desc")), "published_at": first(about("date")), "url": link,
    }


def page_postings(page_url: str, html: str) -> list[dict]:
    """The postings of a page, one per id or else (title, location), with absolute or made-up addresses."""
    out: dict[object, dict] = {}
    for blob in blobs(html or ""):
        for items in object_lists(blob):
            for item in items:
                if p := posting(item):
                    key = p["posting_id"] or (p["title"].lower(), (p["location"] or "").lower())
                    if key not in out:
                        made = f"{page_url}#ssr:{hashlib.sha1(repr(key).encode()).hexdigest()[:12]}"
                        try:
                            p["url"] = urljoin(page_url, p["url"]) if p["url"] else made
                        except ValueError:
                            p["url"] = made
                        out[key] = p
    return list(out.values())


_FIELDS = ("posting_id", "title", "location", "department", "description_text", "published_at", "url")


def embedded_postings(pages: DataFrame, html: str = "html", url: str = "url", limit: int | None = MAX_POSTINGS) -> DataFrame:
    """(domain, page_url, count, pos and the posting's fields) of pages with embedded JSON.

    ``count`` is the true number where a page has more than ``limit``. Null and broken pages give no row.
    """

    def run(batches):
        import pyarrow as pa

        names = ("domain", "page_url", "count", "pos", *_FIELDS)
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), *[pa.string()] * len(_FIELDS))
        for b in batches:
            rows = []
            for domain, page_url, body in zip(*(c.to_pylist() for c in b.columns)):
                found = page_postings(page_url or "", body)
                rows += [(domain, page_url, len(found), i, *(p[f] for f in _FIELDS)) for i, p in enumerate(found[:limit])]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=list(names))

    # pages without a script of JSON never reach Python
    likely = pages.where(F.col(html).contains("<script") & F.col(html).rlike(r"(?i)__NEXT_DATA__|application/(ld\+)?json|window\.__"))
    return map_arrow(likely.select("domain", F.col(url).alias("page_url"), html), run, "domain string, page_url string, count int, pos int, " + ", ".join(f"{f} string" for f in _FIELDS))


def postings_block(title_count: int, titles: list[str], most: int = 60) -> str:
    """The block that stands for mined postings in a page's text."""
    rest = f"\n(+{title_count - most} more)" if title_count > most else ""
    return f"Structured job postings ({title_count} open roles):\n" + "\n".join(f"- {t}" for t in titles[:most]) + rest


def block(count: Column, titles: Column, most: int = 60) -> Column:
    """The same block as a column expression."""
    rest = F.when(count > most, F.concat(F.lit("\n(+"), (count - most).cast("string"), F.lit(" more)"))).otherwise(F.lit(""))
    lines = F.array_join(F.transform(F.slice(titles, 1, most), lambda t: F.concat(F.lit("- "), t)), "\n")
    return F.concat(F.lit("Structured job postings ("), count.cast("string"), F.lit(" open roles):\n"), lines, rest)
