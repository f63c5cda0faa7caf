"""HTML to text with block structure; for the faithful reading of pages, where regular expressions fall short."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import map_arrow
from . import fixed

_SKIPPED = frozenset(("script", "style", "noscript", "template"))
_BLOCKS = frozenset(("p", "div", "br", "li", "ul", "ol", "tr", "table", "section", "article", "header", "footer", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "hr"))


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skipped = 0

    def handle_starttag(self, tag, attrs):
        self.skipped += tag in _SKIPPED
        if tag in _BLOCKS:
            self.out.append("\n- " if tag == "li" else "\n")

    def handle_endtag(self, tag):
        if tag in _SKIPPED and self.skipped:
            self.skipped -= 1
        if tag in _BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skipped:
            self.out.append(data)


def html_text(html: str | None) -> str:
    """The text of a page by blocks, blanks squeezed; empty for null."""
    if not html:
        return ""
    r = _Reader()
    try:
        r.feed(html)
        r.close()
    except Exception:  # broken markup gives what was read until then
        pass
    lines = (" ".join(x.split()) for x in "".join(r.out).split("\n"))
    return "\n".join(x for x in lines if x and x != "-")


def with_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the text of its HTML, and the board addresses it embeds in a block at the end."""
    keep = [c for c in pages.columns if c not in (html, out)]
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = pa.array([html_text(h) for h in b.column(b.num_columns - 2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], texts, b.column(b.num_columns - 1)], names=[*keep, "_text", "_boards"])

    hosts = "|".join(h.replace(".", r"\.") for h in fixed.BOARD_HOSTS)
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(F.replace(html, F.lit("\\/"), F.lit("/")), F.lit("")), F.lit(rf"(?i)https://(?:[A-Za-z0-9-]+\.)*(?:{hosts})/[^\s\"'<>\\)]+"), F.lit(0))))
    given = pages.select(*keep, F.col(html), F.array_join(found, "\n").alias("_boards"))
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "_text string, _boards string"])
    block = F.when(F.col("_boards") == "", F.col("_text")).otherwise(F.concat(F.col("_text"), F.lit("\n\nEmbedded ATS job links:\n"), F.col("_boards")))
    return map_arrow(given, run, schema).select(*keep, block.alias(out))
