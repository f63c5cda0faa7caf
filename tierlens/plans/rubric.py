"""Rubrics: declarative classifiers that compile to one projection over the text column."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import url as U


@dataclass(frozen=True)
class Rubric:
    name: str
    positive_label: str
    negative_label: str
    positive: tuple[str, ...] = ()
    negative: tuple[str, ...] = ()
    description: str = ""
    confident_threshold: float = 0.6
    min_net_hits: int = 2
    crawl_paths: tuple[dict, ...] = ()
    page_evidence_terms: dict[str, tuple[str, ...]] = field(default_factory=dict)
    judge_instructions: str = ""

    @staticmethod
    def of(d: dict) -> Rubric:
        """Of a mapping; a missing name or label is an error."""
        for key in ("name", "positive_label", "negative_label"):
            if not d.get(key):
                raise ValueError(f"rubric lacks {key}")
        terms = {k: tuple(v or ()) for k, v in (d.get("page_evidence_terms") or {}).items()}
        return Rubric(
            d["name"], d["positive_label"], d["negative_label"], tuple(map(str, d.get("positive") or ())), tuple(map(str, d.get("negative") or ())), d.get("description") or "",
            float(d.get("confident_threshold", 0.6)), int(d.get("min_net_hits", 2)), tuple(d.get("crawl_paths") or ()), terms, d.get("judge_instructions") or "",
        )

    @staticmethod
    def load(path: str) -> Rubric:
        import yaml

        return Rubric.of(yaml.safe_load(Path(path).read_text(encoding="utf-8-sig")))


def score(df: DataFrame, rubric: Rubric, text: str = "text") -> DataFrame:
    """``df`` with label, confidence, pos_hits, neg_hits, pos_terms and neg_terms.

    No hit at all, fewer than ``min_net_hits`` net hits, or a confidence under the threshold give
    ``ambiguous``. A null text has no hits. The text is lower-cased once, in a projection of its own.
    """
    low = df.withColumn("_low", F.lower(F.coalesce(F.col(text), F.lit(""))))
    found = low.withColumn("_p", T.term_hits(F.col("_low"), rubric.positive)).withColumn("_n", T.term_hits(F.col("_low"), rubric.negative))
    counted = found.withColumn("pos_hits", T.total(F.col("_p"))).withColumn("neg_hits", T.total(F.col("_n")))
    net, both = F.col("pos_hits") - F.col("neg_hits"), F.col("pos_hits") + F.col("neg_hits")
    raw = F.when(both > 0, F.abs(net) / both).otherwise(F.lit(0.0))
    sure = (both > 0) & (F.abs(net) >= rubric.min_net_hits) & (raw >= rubric.confident_threshold)
    return (
        counted.withColumn("label", F.when(sure & (net > 0), F.lit(rubric.positive_label)).when(sure, F.lit(rubric.negative_label)).otherwise(F.lit("ambiguous")))
        .withColumn("confidence", F.round(raw, 3)).withColumn("pos_terms", F.transform("_p", lambda x: x["term"])).withColumn("neg_terms", F.transform("_n", lambda x: x["term"]))
        .drop("_low", "_p", "_n")
    )


def verdicts(df: DataFrame, rubric: Rubric, key: str = "domain", text: str = "text") -> DataFrame:
    """(key, rubric, label, confidence, method, reason): ``unreachable`` for an empty text, else the keyword score."""
    scored = score(df, rubric, text)
    empty = F.coalesce(F.col(text), F.lit("")) == ""
    return scored.select(
        key, F.lit(rubric.name).alias("rubric"), F.when(empty, F.lit("unreachable")).otherwise(F.col("label")).alias("label"), F.when(empty, F.lit(0.0)).otherwise(F.col("confidence")).alias("confidence"),
        F.when(empty, F.lit("fetch_failed")).otherwise(F.lit("keyword")).alias("method"),
        F.when(empty, F.lit("no content after cascade")).otherwise(F.format_string("pos=%d neg=%d", "pos_hits", "neg_hits")).alias("reason"),
    )


def term_table(df: DataFrame, rubric: Rubric, key: str, text: str = "text") -> DataFrame:
    """(key, side, term, n): the hits of each term."""
    low = df.select(key, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_low"))
    sides = F.array(F.struct(F.lit("positive").alias("side"), T.term_hits(F.col("_low"), rubric.positive).alias("f")), F.struct(F.lit("negative").alias("side"), T.term_hits(F.col("_low"), rubric.negative).alias("f")))
    return low.select(key, F.explode(sides).alias("s")).select(key, F.col("s.side").alias("side"), F.explode("s.f").alias("t")).select(key, "side", F.col("t.term").alias("term"), F.col("t.n").alias("n"))


def page_specs(spark: SparkSession, rubric: Rubric, limit: int | None = None) -> DataFrame:
    """(path, page_type, evidence_terms, pos): the rubric's paths, normalised, first occurrence kept, terms merged."""
    rows, at = [], 0
    for group in rubric.crawl_paths:
        for path in group.get("paths") or ():
            rows.append((at, str(path), group.get("page_type"), [str(t) for t in group.get("evidence_terms") or ()]))
            at += 1
    df = spark.createDataFrame(rows, "pos int, raw string, given string, terms array<string>").withColumn("path", U.normalize_path(F.col("raw")))
    merged = df.groupBy("path").agg(F.min("pos").alias("pos"), F.min_by("given", "pos").alias("given"), F.array_sort(F.collect_list(F.struct("pos", "terms"))).alias("t"))
    out = merged.select("path", F.coalesce("given", U.page_type(F.col("path"))).alias("page_type"), F.array_distinct(F.flatten(F.transform("t", lambda x: x["terms"]))).alias("evidence_terms"), "pos")
    return out if limit is None else out.orderBy("pos").limit(limit)


def parse_quota(raw: str) -> dict[str, int]:
    """``careers=2,news=1`` as a mapping; malformed or negative entries are an error."""
    out = {}
    for entry in filter(None, (x.strip() for x in (raw or "").split(","))):
        name, eq, number = entry.partition("=")
        if not eq or not name.strip() or not number.strip().isdigit():
            raise ValueError(f"bad quota entry: {entry!r}")
        out[name.strip().lower()] = int(number)
    return out


def literal_map(quota: dict[str, int], key: Column, default: int = 0) -> Column:
    out = F.lit(default)
    for name, n in quota.items():
        out = F.when(key == name, F.lit(n)).otherwise(out)
    return out
