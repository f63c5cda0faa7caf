"""Board JSON, the shape of postings, evidence rules, joins that split hot keys."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlens import runtime, site_queries
from tierlens.operators import boards, evidence, postings


@pytest.mark.parametrize("item, title", [
    ({"jobName": "Weaver", "location": "Bay", "jobId": 4}, "Weaver"), ({"title": "Weaver", "location": "Bay", "requisitionId": "r"}, "Weaver"), ({"jobTitle": "Weaver", "team": "A", "published": "x"}, "Weaver"),
    ({"name": "Ana", "role": "CTO", "location": "Bay"}, None), ({"title": "Weaver", "location": "Bay", "email": "a@b.c"}, None), ({"title": "Weaver", "location": "Bay", "jobId": 1, "status": "Paused"}, None),
    ({"title": "Weaver", "location": "Bay", "jobId": 1, "state": "deleted"}, None), ({"title": "News of May", "url": "/n"}, None), ({"title": "https://x.test", "location": "a", "jobId": 1}, None),
    ({"title": "a@b.test", "location": "a", "jobId": 1}, None), ({"title": "Meet-up", "location": "Bay", "date": "x", "isEvent": True, "jobId": 1}, None), ({}, None), ({"jobTitle": "Weaver"}, None),
])
def test_posting_gate(item, title):
    got = postings.posting(item)
    assert (got and got["title"]) == title


def test_blobs_with_one_beginning_are_two():
    script = '<script type="application/json">%s</script>'
    long = '{"a": "' + "x" * 5000 + '", "n": %d}'
    assert len(list(postings.blobs(script % (long % 1) + script % (long % 2) + script % (long % 1)))) == 2


def test_board_json(spark):
    data = [
        (1, "greenhouse", '{"jobs": [{"title": "A", "departments": [{"name": "D"}]}], "meta": {"total": 9}}'), (2, "lever", '[{"text": "A", "categories": {"team": "T"}}]'), (3, "lever", '{"postings": [{"text": "A"}]}'),
        (4, "ashby", '{"jobs": [{"title": "A", "isListed": false}, {"title": "B", "departmentName": "D"}]}'), (5, "recruitee", '{"offers": [{"title": "A", "status": "draft"}, {"title": "B"}]}'),
        (6, "pinpoint", '{"data": [{"attributes": {"title": "A", "department": {"name": "D"}}}]}'), (7, "rippling", '{"results": [{"title": "A", "department": {"label": "D"}}]}'), (8, "workable", '{"jobs": []}'),
        (9, "workday", '{"total": 40, "jobPostings": [{"title": "A"}]}'), (10, "workable", "<html>"), (11, "breezy", None), (12, "unknown", "[]"),
    ]
    df = spark.createDataFrame(data, "i int, ats string, body string")
    c = boards.counts_from_json(F.col("ats"), F.col("body"))
    got = {r.i: (r.c and (r.c["count"], list(r.c["titles"]), list(r.c["departments"]))) for r in df.select("i", c.alias("c")).collect()}
    assert got == {
        1: (9, ["A"], ["D"]), 2: (1, ["A"], ["T"]), 3: (1, ["A"], []), 4: (1, ["B"], ["D"]), 5: (1, ["B"], []), 6: (1, ["A"], ["D"]), 7: (1, ["A"], ["D"]), 8: (0, [], []), 9: (40, ["A"], []), 10: None, 11: None, 12: None,
    }
    h = {r.i: (r["count"], r.got, r.truncated) for r in boards.harvest(df, 1).collect()}
    assert h[1] == (9, 1, True) and h[8] == (0, 0, False) and h[10] == (None, -1, False) or h[10][0] is None


def test_first_board(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 1, None), ("a", 2, 5), ("b", 0, None), ("b", 1, 0), ("c", 0, None)], "d string, pos int, count int")
    assert rows(boards.first_board(df, ["d"]).select("d", "pos", "count")) == [("a", 2, 5), ("b", 1, 0)]


def test_evidence_of_thin_sites(spark):
    df = spark.createDataFrame([("https://boards.greenhouse.io/acme/jobs/1",), ("no link",), (None,)], "t string")
    t = evidence.tier(F.lit("parked_or_thin"), F.lit("company_site"), F.lit("hiring_activity"), F.col("t"))
    assert [r[0] for r in df.select(t).collect()] == ["A", "Rejected", "Rejected"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_that_split_keys(spark, how):
    """Hot keys, null keys, keys of one side only: all the joins give what a plain one gives."""
    big = spark.createDataFrame([(None if i % 50 == 0 else 1 if i % 3 == 0 else i % 20, i) for i in range(600)], "k int, i int")
    small = spark.createDataFrame([(k, 200 if k == 1 else 10) for k in (1, 2, 3, 50)], "k int, n int")
    want = rows(big.join(small, "k", how))
    assert rows(runtime.weighted_join(big, small, ["k"], "n", "i", how).select(*big.join(small, "k", how).columns)) == want
    for limit in (0, 100):
        assert rows(runtime.lookup_join(big, small, ["k"], "i", how, limit).select(*big.join(small, "k", how).columns)) == want
    assert rows(runtime.weighted_join(big, small.limit(0), ["k"], "n", "i", "left_anti")) == rows(big)


def test_large_lookups_do_not_go_through_the_driver(spark):
    """A table whose broadcast would take tens of MB of the driver is joined by shuffle, with the same rows."""
    small, big = runtime.stored(spark.range(150_000).withColumn("v", F.col("id") * 2)), spark.range(10, 200_000, 20_000)
    got = runtime.lookup_join(big, small, ["id"], "id", "inner")
    assert "ResolvedHint" not in (plan := got._jdf.queryExecution().analyzed().toString()) and "broadcast" not in plan
    assert rows(got) == rows(big.where("id < 150000").withColumn("v", F.col("id") * 2))


def test_stored_tables_are_discarded(spark):
    df = runtime.stored(spark.range(5).toDF("n"))
    assert df.count() == 5 and runtime.discard_stored() >= 1


def test_a_large_board_is_harvested_in_step_with_its_postings(spark):
    """The first posting of each id, in the order sent; a parse of the whole body for each posting took minutes for this board."""
    items = [{"id": f"j{i % 1500}", "title": f"T{i}"} for i in range(3000)]
    df = spark.createDataFrame([("greenhouse", json.dumps({"jobs": items})), ("ashby", json.dumps({"jobs": items[::-1]}))], "ats string, body string")
    began = time.time()
    got = {r.ats: (r["count"], [(p.posting_id, p.title) for p in r.postings]) for r in boards.harvest(df).collect()}
    assert time.time() - began < 40
    want = [(f"j{i}", f"T{i}") for i in range(1500)]
    assert got == {"greenhouse": (3000, want), "ashby": (3000, [(f"j{i - 1500}", f"T{i}") for i in range(2999, 1499, -1)])}


def test_stored_postings_are_read_once_for_all_platforms(spark):
    plan = site_queries.harvest_envelopes(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan and "RepartitionByExpression" in plan


def test_postings_are_harvested_once(spark):
    """No filter below the explosion repeats the parsing."""
    plan = site_queries.platform_postings(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    assert not [x for x in plan.toString().split("\n") if x.strip(" :+-").startswith("Filter") and "json" in x]


def test_the_driver_gives_back_native_memory(spark, monkeypatch):
    """This box's JVM has the command, and every stored table asks for it."""
    assert runtime.release_native_memory(spark)
    asked = []
    monkeypatch.setattr(runtime, "release_native_memory", asked.append)
    assert runtime.stored(spark.range(3)).count() == 3 and asked == [spark]
