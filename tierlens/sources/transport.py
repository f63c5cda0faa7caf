"""Fetching behind an interface. Offline, a snapshot of stored pages answers; a live client is the user's to give."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import map_arrow

Fetch = Callable[[str], tuple[int, str | None]]


def candidates(domain: str) -> list[str]:
    """Addresses to try: https, http, then with www., unless the domain has it."""
    out = [f"https://{domain}", f"http://{domain}"]
    return out if domain.startswith("www.") else [*out, f"https://www.{domain}", f"http://www.{domain}"]


def backoff(attempt: int, base: float = 0.5, cap: float = 8.0, jitter: Callable[[], float] = random.random) -> float:
    return min(cap, base * 2**attempt) + 0.5 * jitter()


def from_snapshot(domains: DataFrame, pages: DataFrame) -> DataFrame:
    """Domains with the stored fetch: status 0 and ok false where none is stored."""
    kept = pages.select("domain", "url", "status", "ok", "text")
    out = domains.join(kept, "domain", "left")
    return out.withColumn("status", F.coalesce("status", F.lit(0))).withColumn("ok", F.coalesce("ok", F.lit(False)))


def fetch_all(domains: DataFrame, fetch: Fetch, min_html: int = 500) -> DataFrame:
    """(domain, url, status, html, ok, error) by ``fetch``; an exception costs its row, never the batch.

    The www addresses are tried only while nothing has answered. The rows are spread by domain, so that
    one task meets one host's addresses.
    """

    def one(domain: str) -> tuple:
        status, url, html, error = 0, None, None, None
        for address in candidates(domain):
            if status and "://www." in address:
                break
            try:
                got, body = fetch(address)
            except Exception as e:  # one bad answer must not end the batch
                error = type(e).__name__
                continue
            if got:
                status, url, html = got, address, body
                if got == 200 and len(body or "") >= min_html:
                    return domain, url, status, html, True, None
        return domain, url, status, html, False, error

    def run(batches) -> Iterator:
        import pyarrow as pa

        kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.string())
        for b in batches:
            rows = [one(d) for d in b.column(0).to_pylist() if d]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=["domain", "url", "status", "html", "ok", "error"])

    return map_arrow(domains.select("domain").repartition("domain"), run, "domain string, url string, status int, html string, ok boolean, error string")
