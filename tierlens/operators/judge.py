"""Deciding what the keyword score leaves open: a judge behind an interface, and the text it is shown.

The default judge answers ``unknown``; a live one is the user's to give. Every failure is a decided
``unknown`` with a reason, so that one bad answer never ends a batch.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.rubric import Rubric
from ..runtime import map_arrow

#: A judge takes the shown text and gives what it says, free text around a JSON object allowed.
Judge = Callable[[str], str]
REASON_CHARS = 120


def silent(_: str) -> str:
    return '{"label": "unknown", "confidence": 0, "reason": "no judge"}'


def shown_text(text: str, terms: tuple[str, ...], most: int = 6000, head: int = 800, window: int = 450, per_term: int = 8, markers: tuple[str, ...] = ("Structured job postings",), block: int = 3000) -> str:
    """The beginning of a long text and the surroundings of its terms and marked blocks, merged and cut to ``most``.

    A text that fits is shown whole; one without a term or block is cut at its end.
    """
    if len(text) <= most:
        return text
    low, spans = text.lower(), [(0, head)]
    spans += [(at, at + block) for m in markers if (at := text.find(m)) >= 0]
    for term in filter(None, (t.strip().lower() for t in terms)):
        for n, m in enumerate(re.finditer(re.escape(term), low)):
            if n == per_term:
                break
            spans.append((max(0, m.start() - window), m.end() + window))
    if len(spans) == 1:
        return text[:most]
    merged: list[list[int]] = []
    for a, z in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], z)
        else:
            merged.append([a, z])
    out, left = [], most
    for a, z in merged:
        piece = text[a:z][:left]
        if piece:
            out.append(piece)
            left -= len(piece)
    return "\n…\n".join(out)


def answer(said: str) -> tuple[str | None, float, str]:
    """(label, confidence, reason) of what a judge said; no label where it has no JSON object."""
    m = re.search(r"\{.*\}", said or "", re.S)
    try:
        d = json.loads(m.group()) if m else None
    except ValueError:
        d = None
    if not isinstance(d, dict):
        return None, 0.0, "unparseable"
    if isinstance(d.get("result"), str) and "label" not in d:
        return answer(d["result"])
    try:
        confidence = min(1.0, max(0.0, float(d.get("confidence") or 0)))
    except (TypeError, ValueError):
        confidence = 0.0
    return str(d.get("label") or ""), confidence, str(d.get("reason") or "")[:REASON_CHARS]


def judged(df: DataFrame, rubric: Rubric, judge: Judge = silent, key: str = "domain", text: str = "text") -> DataFrame:
    """(key, label, confidence, method, reason) of rows the keyword score left open; null texts are judged as empty ones."""
    terms = (*rubric.positive, *rubric.negative)

    def run(batches):
        import pyarrow as pa

        kinds = (pa.string(), pa.string(), pa.float64(), pa.string())
        for b in batches:
            rows = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    label, confidence, reason = answer(judge(shown_text(t or "", terms)))
                except Exception as e:  # a failed call is a decided row
                    label, confidence, reason = None, 0.0, type(e).__name__
                rows.append((k, label, confidence, reason))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names=["k", "said", "confidence", "reason"])

    raw = map_arrow(df.select(F.col(key).cast("string").alias("k"), text), run, "k string, said string, confidence double, reason string")
    return raw.select(F.col("k").alias(key), T.coerce_label(F.col("said"), rubric.positive_label, rubric.negative_label).alias("label"), "confidence", F.lit("llm").alias("method"), "reason")


def decide(df: DataFrame, rubric: Rubric, judge: Judge = silent, key: str = "domain", text: str = "text") -> DataFrame:
    """Keyword verdicts where they are sure, the judge's elsewhere."""
    from ..plans.rubric import verdicts

    v = verdicts(df, rubric, key, text)
    open_ = df.join(v.where("label = 'ambiguous'").select(key), key, "left_semi")
    asked = judged(open_, rubric, judge, key, text).withColumn("rubric", F.lit(rubric.name))
    return v.where("label <> 'ambiguous'").unionByName(asked.select(*v.columns))
