"""Keyed snapshots without MERGE: a new state is the latest row of old and new by key, written to a new folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import url as U


def latest(df: DataFrame, keys: list[str], version: str, ties: list[str] | None = None) -> DataFrame:
    """The last row of each key by ``version``, then by ``ties``; null versions come first.

    An aggregate, not a window: each task combines its rows before the exchange, so a hot key costs one row a task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(version).isNotNull().alias("_set"), F.col(version).alias("_v"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(ties or ())])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return picked.select(*[F.col(k) if k in keys else F.col(f"_r.{k}").alias(k) for k in df.columns])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Old and new rows, the later of each key kept; a new row wins a tie. Columns one side lacks become null."""
    both = old.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)), allowMissingColumns=True)
    return latest(both, keys, version, ["_gen"]).drop("_gen")


def upsert_pages(pages: DataFrame, version: str = "fetched_at", cap: int | None = None, ties: tuple[str, ...] = ("dpage_id",)) -> DataFrame:
    """Discovered pages by (domain, page key): the latest fetch, with ``linked_from_homepage`` true once it ever was.

    ``cap`` cuts every text to so many characters, as the reference's store does; without it texts stay whole.
    """
    keyed = pages.withColumn("path", U.page_key(F.col("path")))
    last = latest(keyed, ["domain", "path"], version, [t for t in ties if t in pages.columns])
    linked = keyed.groupBy("domain", "path").agg(F.max(F.coalesce("linked_from_homepage", F.lit(False))).alias("_linked"))
    out = last.join(linked, ["domain", "path"]).withColumn("linked_from_homepage", F.col("_linked")).drop("_linked")
    return out if cap is None else out.withColumn("text", F.substring("text", 1, cap))


def replace_groups(old: DataFrame, new: DataFrame, group: list[str], key: list[str], version: str) -> DataFrame:
    """All rows of the groups that ``new`` touches are replaced by its rows, the last of each key kept."""
    kept = old.join(new.select(*group).distinct(), group, "left_anti")
    return kept.unionByName(latest(new, [*group, *key], version), allowMissingColumns=True)


def add_candidates(stored: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates never overwrite a stored page; all they add to one is the link flag."""
    c = candidates.groupBy("domain", "path").agg(F.max(F.coalesce("linked_from_homepage", F.lit(False))).alias("_linked"), F.min("page_type").alias("_type"), F.min("url").alias("_url"))
    joined = stored.join(c, ["domain", "path"], "full_outer")
    known = F.col("tier").isNotNull()
    return joined.select(
        "domain", "path", F.when(known, F.col("page_type")).otherwise(F.col("_type")).alias("page_type"), F.when(known, F.col("url")).otherwise(F.col("_url")).alias("url"),
        F.when(known, F.col("tier")).otherwise(F.lit("candidate")).alias("tier"), F.coalesce("ok", F.lit(False)).alias("ok"),
        (F.coalesce("linked_from_homepage", F.lit(False)) | F.coalesce("_linked", F.lit(False))).alias("linked_from_homepage"),
    )


def first_seen(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The first row of each key by position."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), pos).alias("_r")).select(*[F.col(k) if k in keys else F.col(f"_r.{k}").alias(k) for k in df.columns])


def ranked(df: DataFrame, part: list[str], order: list, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
