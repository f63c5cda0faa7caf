"""Ordered CSV and JSON lines of verdicts, page rows and evidence rows."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ty

from ..functions import text as T
from .store import ranked


def flat(df: DataFrame) -> DataFrame:
    """For CSV: control characters of strings become blanks, arrays and structs JSON, booleans 0 and 1."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, ty.StringType):
            c = T.csv_safe(c)
        elif isinstance(f.dataType, (ty.ArrayType, ty.StructType, ty.MapType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, ty.BooleanType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def write_pair(df: DataFrame, path: str, order: list[str]) -> tuple[str, str]:
    """``path`` as CSV and beside it JSON lines, both in ``order``; a range partitioning sorts, no single task does."""
    p = PurePosixPath(path)
    lines = str(p.with_suffix(".jsonl"))
    ordered = df.orderBy(*order)
    flat(ordered).write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').csv(path)
    ordered.write.mode("overwrite").json(lines)
    return path, lines


def beside(path: str, what: str) -> str:
    """``out.csv`` and ``pages`` give ``out_pages.csv``."""
    p = PurePosixPath(path)
    return str(p.with_name(f"{p.stem}_{what}{p.suffix}"))


def summary(df: DataFrame, by: list[str]) -> DataFrame:
    """(field, value, n): group counts of several columns, of one expanded pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in by]))
    return df.select(pairs.alias("p")).groupBy("p.field", "p.value").agg(F.count(F.lit(1)).alias("n"))


def allowed_rows(evidence: DataFrame, allowed: DataFrame, key: str = "path", escape: str = "trusted_board") -> DataFrame:
    """Evidence of the allowed (domain, key) pairs, and of any page that holds a row with ``escape``, such as a linked board's hiring."""
    flags = evidence.where(F.col(escape)).select("domain", key)
    kept = allowed.select("domain", key).unionByName(flags).distinct()
    return evidence.join(kept, ["domain", key], "left_semi")


def in_input_order(domains: DataFrame, rows: DataFrame, pos: str = "pos") -> DataFrame:
    """Rows with the place of their domain in the input list; sort by it when writing."""
    return domains.select("domain", pos).join(rows, "domain", "left")


def scan(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rank`` of each row inside its domain in the order of a scan."""
    return ranked(rows, ["domain"], by)
