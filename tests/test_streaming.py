from __future__ import annotations

from tierlens.streaming import micro


def test_chunks_resume(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "store", "ck"))
    spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, v int, t string").coalesce(1).write.parquet(src)
    read = lambda: spark.readStream.schema("k string, v int, t string").option("maxFilesPerTrigger", 1).parquet(src)
    micro.run_available(read(), out, ck, ["k"], "v")
    spark.createDataFrame([("a", 2, "z")], "k string, v int, t string").coalesce(1).write.mode("append").parquet(src)
    micro.run_available(read(), out, ck, ["k"], "v")
    micro.run_available(read(), out, ck, ["k"], "v")
    assert sorted(map(tuple, micro.read_store(spark, out).collect())) == [("a", 2, "z"), ("b", 1, "y")]
    assert micro.read_store(spark, str(tmp_path / "none")) is None


def test_another_stream_into_the_same_store(spark, tmp_path):
    """A new checkpoint folder starts at batch 0 again; its batches are no repetitions of another stream's."""
    out = str(tmp_path / "store")
    for i, row in enumerate((("a", 1, "x"), ("b", 1, "y"), ("c", 1, "z"))):
        src = str(tmp_path / f"in{i}")
        spark.createDataFrame([row], "k string, v int, t string").coalesce(1).write.parquet(src)
        micro.run_available(spark.readStream.schema("k string, v int, t string").parquet(src), out, str(tmp_path / f"ck{i}"), ["k"], "v")
    assert sorted(r.k for r in micro.read_store(spark, out).collect()) == ["a", "b", "c"]
    assert len(micro._versions(spark, out)) == 2


def test_windows(spark):
    e = spark.sql("select timestamp'2025-01-01 00:10:00' ts, 'a' event_type, 1.0D value union all select timestamp'2025-01-01 00:50:00', 'a', 2.0D")
    assert [(r.n, r.total) for r in micro.windowed_counts(e).collect()] == [(2, 3.0)]
