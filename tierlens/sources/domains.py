"""Lists of domains: text files of one a line, and CSV with or without a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import url as U
from ..operators.store import first_seen

# Header names that hold the domain, in the order they are looked for.
DOMAIN_COLUMNS = ("domain", "website", "url", "company_domain")


def column_index(header: list[str], wanted: str | None = None) -> int:
    """The position of the domain column: by name or number, by the usual names, else the first."""
    names = [h.strip().lstrip("﻿").lower() for h in header]
    if wanted is not None:
        if wanted.strip().lower() in names:
            return names.index(wanted.strip().lower())
        if wanted.strip().isdigit() and int(wanted) < len(names):
            return int(wanted)
        raise ValueError(f"no column {wanted!r}")
    return next((names.index(n) for n in DOMAIN_COLUMNS if n in names), 0)


def distinct_domains(df: DataFrame, raw: str, pos: str, limit: int | None = None) -> DataFrame:
    """(domain, pos): normalised, first occurrence kept; blanks are left out, the limit holds after that."""
    keyed = df.select(U.normalize_domain(F.col(raw)).alias("domain"), F.col(pos).alias("pos")).where("domain <> ''")
    out = first_seen(keyed, ["domain"], "pos")
    return out if limit is None else out.orderBy("pos").limit(limit)


def read_domains(spark: SparkSession, path: str, limit: int | None = None, column: str | None = None) -> DataFrame:
    """(domain, pos) of a file; it is read as CSV where a column is named or the first line has a comma."""
    lines = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id())
    first = lines.orderBy("pos").limit(1).collect()
    head = first[0]["value"] if first else ""
    if column is None and "," not in head:
        return distinct_domains(lines.withColumn("value", F.regexp_replace("value", "^﻿", "")), "value", "pos", limit)
    header = head.split(",")
    at = column_index(header, column)
    named = any(h.strip().lstrip("﻿").lower() in DOMAIN_COLUMNS or h.strip().lower() == (column or "").lower() for h in header)
    cells = F.from_csv(F.col("value"), F.lit(", ".join(f"c{i} string" for i in range(len(header)))))
    rows = lines.select(cells.getField(f"c{at}").alias("raw"), "pos")
    return distinct_domains(rows.where(F.col("pos") > first[0]["pos"]) if named else rows, "raw", "pos", limit)
