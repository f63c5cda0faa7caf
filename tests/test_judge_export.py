from __future__ import annotations

from tests.conftest import rows
from tierlens.functions import html
from tierlens.operators import export, judge
from tierlens.plans.rubric import Rubric

R = Rubric.of({"name": "r", "positive_label": "b2b_saas", "negative_label": "not_saas", "positive": ["platform"], "negative": ["shop"]})


def test_shown_text():
    assert judge.shown_text("short", ()) == "short"
    long = "head " + "x" * 9000 + " platform " + "y" * 9000
    got = judge.shown_text(long, ("platform",))
    assert "platform" in got and got.startswith("head") and len(got) < 6100 and "…" in got
    assert judge.shown_text("z" * 9000, ("none",)) == "z" * 6000


def test_answers():
    assert judge.answer('x {"label": "B2B SaaS", "confidence": 7, "reason": "r"} y') == ("B2B SaaS", 1.0, "r")
    assert judge.answer('{"result": "{\\"label\\": \\"a\\", \\"confidence\\": \\"bad\\"}"}') == ("a", 0.0, "")
    assert judge.answer("nothing")[0] is None and judge.answer("{broken}")[2] == "unparseable" and judge.answer(None)[0] is None


def test_decide(spark):
    df = spark.createDataFrame([("a", "platform platform platform"), ("b", "platform shop"), ("c", None), ("d", "boom here")], "domain string, text string")

    def ask(text):
        if "boom" in text:
            raise RuntimeError
        return '{"label": "B2B SaaS!", "confidence": 0.7, "reason": "looks so"}'

    got = {r.domain: (r.label, r.method) for r in judge.decide(df, R, ask).collect()}
    assert got == {"a": ("b2b_saas", "keyword"), "b": ("b2b_saas", "llm"), "c": ("unreachable", "fetch_failed"), "d": ("unknown", "llm")}
    assert {r.label for r in judge.judged(df, R).collect()} == {"unknown"}


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(2, "b\x00c", ["x"], True), (1, "a", [], None)], "pos int, t string, terms array<string>, ok boolean")
    csv, lines = export.write_pair(df, str(tmp_path / "out.csv"), ["pos"])
    assert rows(spark.read.option("header", True).csv(csv).select("pos", "t", "ok")) == [("1", "a", None), ("2", "b c", "1")]
    assert spark.read.json(lines).count() == 2 and export.beside("x/out.csv", "pages") == "x/out_pages.csv"
    assert rows(export.summary(df, ["ok"])) == [("ok", "", 1), ("ok", "true", 1)]


def test_html(spark):
    assert html.html_text("<h1>A &amp; B</h1><script>no</script><ul><li>x<li>y</ul><p>c  d") == "A & B\n- x\n- y\nc d" and html.html_text(None) == ""
    df = spark.createDataFrame([(1, '<p>x</p><script>"https:\\/\\/jobs.lever.co\\/nimo"</script>'), (2, None)], "id int, html string")
    assert {r.id: r.text for r in html.with_text(df).collect()} == {1: "x\n\nEmbedded ATS job links:\nhttps://jobs.lever.co/nimo", 2: ""}
