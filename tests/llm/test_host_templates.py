"""An error text that only one host has, on several of its pages, stands in place of their content."""

from __future__ import annotations

from tierlens.llm import residue


def test_template_of_one_host(spark):
    word = lambda n: "".join(chr(97 + int(d)) for d in str(n))
    menu, data = "Home | About us | Contact", []
    for h in range(3):
        for p in range(20):
            body = f"# Letter {word(p)}\nThe gardener {word(p)} of house {word(h)} sent {word(p * 7)} seeds to the village before winter."
            if h == 0 and p < 6:
                body = "The lantern of this page has gone out and cannot be lit."
            elif p < 8:
                body = ""
            data.append(("pages", len(data), f"s{h}.test", f"/p{p}", f"{menu}\n{body}\nPrivacy policy · Terms of use"))
    df = spark.createDataFrame(data, "src string, row_id long, host string, path string, text string")
    got = residue.Site(df).residue.orderBy("row_id").collect()
    assert [(r.row_id, r.reason) for r in got] == [(i, "in_place") for i in range(6)]
