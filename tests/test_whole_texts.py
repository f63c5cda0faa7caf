"""The keyed store keeps texts whole; a cap is an option."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierlens.operators import store


def test_texts_stay_whole(spark):
    p = spark.createDataFrame([("a.test", "/a", 1, "x" * 300_000, True)], "domain string, path string, dpage_id long, text string, linked_from_homepage boolean").withColumn("fetched_at", F.current_timestamp())
    assert store.upsert_pages(p).select(F.length("text")).first()[0] == 300_000
    assert store.upsert_pages(p, cap=250_000).select(F.length("text")).first()[0] == 250_000
