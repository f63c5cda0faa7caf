"""Every place of a term counts for the wording of a job around it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierlens.operators import evidence


def test_every_place_of_a_term(spark):
    gap = " x" * 400
    texts = [
        f"okta{gap} we run okta. responsibilities: all of it", f"oktafon is our job{gap} okta", f"okta{gap}{gap} okta", f"okta{'.' * 445}job", f"okta{'.' * 448}job",
        f"job{'.' * 447}okta", f"job{'.' * 448}okta", "okta\njob", "okta job", "okta", "", f"a role{gap} okta, okta,\nokta{gap} at lever: okta",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", evidence.near_job_context(F.col("t"), F.array(F.lit("okta"))).alias("near")).orderBy("i").collect()
    assert [r.near for r in got] == [True, False, False, True, False, True, False, True, True, False, False, True]
