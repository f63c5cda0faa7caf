"""The registered queries of the corpus operators; ``oracles()`` has the SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boilerplate, charforms, encoding, language, leakage, lines, packing, residue


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return lines.repeated_line_positions(table(spark, folder, "discovered_pages"), "dpage_id", "domain")


def p1_clean(spark: SparkSession, folder: str) -> DataFrame:
    return lines.without_repeated_lines(table(spark, folder, "discovered_pages"), "dpage_id", "domain")


def p1_tested(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines of at least MIN_DOCS documents each contrast tests and accepts at the false-discovery rate."""
    scored = lines.scored_lines(table(spark, folder, "discovered_pages"), "dpage_id", "domain")
    each = F.array(F.struct(F.lit("excess").alias("contrast"), F.col("accepted").alias("a")), F.struct(F.lit("outside").alias("contrast"), F.col("site_specific").alias("a")))
    return scored.select(F.explode(each).alias("e")).groupBy("e.contrast").agg(F.count(F.lit(1)).alias("tested"), F.count_if(F.col("e.a")).alias("accepted"))


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return residue.site_rows(table(spark, folder, "pages"), table(spark, folder, "discovered_pages"))


def _site(spark: SparkSession, folder: str, roles: bool = False) -> residue.Site:
    return residue.Site(_rows(spark, folder), roles=roles)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rows(spark, folder)
    return language.mislabelled_rows(rows, language.fit(rows))


def p2_languages(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rows(spark, folder)
    return language.row_languages(rows, language.fit(rows))


def p2_passages(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rows(spark, folder)
    return language.language_passages(rows, language.fit(rows))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _site(spark, folder).residue.select("src", "row_id")


def p3_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return _site(spark, folder).residue


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.main_lines(_site(spark, folder, roles=True))


def p4_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.main_bodies(_site(spark, folder, roles=True))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_restored(spark, folder).select("src", "row_id")


def p5_restored(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.damaged_rows(_site(spark, folder))


def p6_pack(spark: SparkSession, folder: str) -> DataFrame:
    docs, limits = table(spark, folder, "documents"), table(spark, folder, "pack_limits")
    packed = packing.pack(packing.token_counts(docs, "doc_id", "source"), limits)
    return packed.withColumnRenamed("item", "doc_id")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaked_items(table(spark, folder, "documents"), table(spark, folder, "eval_items")).select("doc_id", "item_id")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return charforms.look_alike_pairs(table(spark, folder, "documents"))


def p8_classes(spark: SparkSession, folder: str) -> DataFrame:
    return charforms.look_alike_classes(table(spark, folder, "documents"))


def p8_forms(spark: SparkSession, folder: str) -> DataFrame:
    return charforms.consistent_forms(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_clean, p1_tested, p2_found, p2_languages, p2_passages, p3_found, p3_reasons, p4_found, p4_bodies, p5_found, p5_restored, p6_pack, p7_found, p8_found, p8_classes, p8_forms)}


_P1 = r"""
WITH l AS (
  SELECT dpage_id, domain, CAST(i - 1 AS INTEGER) AS line_no,
         regexp_replace(lower(string_split(text, chr(10))[i]), '[^\p{L}]+', '', 'g') AS k
  FROM (SELECT dpage_id, domain, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM discovered_pages
        WHERE text IS NOT NULL AND domain IS NOT NULL AND dpage_id IS NOT NULL)),
r AS (SELECT domain, k FROM l WHERE k <> '' GROUP BY domain, k HAVING count(DISTINCT dpage_id) >= 6)
"""


def oracles() -> dict[str, str]:
    return {
        "p1_found": _P1 + "SELECT DISTINCT dpage_id, line_no FROM l JOIN r USING (domain, k)",
        "p1_clean": _P1 + """, g AS (SELECT DISTINCT dpage_id, line_no FROM l JOIN r USING (domain, k)),
d AS (SELECT DISTINCT dpage_id, text FROM discovered_pages WHERE dpage_id IS NOT NULL),
a AS (SELECT dpage_id, CAST(i - 1 AS INTEGER) AS line_no, string_split(text, chr(10))[i] AS line
      FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d WHERE text IS NOT NULL)),
k AS (SELECT dpage_id, string_agg(line, chr(10) ORDER BY line_no) AS kept FROM a ANTI JOIN g USING (dpage_id, line_no) GROUP BY 1),
n AS (SELECT dpage_id, count(*) AS n_removed FROM g GROUP BY 1)
SELECT d.dpage_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept, '') END AS text, coalesce(n_removed, 0) AS n_removed
FROM d LEFT JOIN k USING (dpage_id) LEFT JOIN n USING (dpage_id)""",
    }
