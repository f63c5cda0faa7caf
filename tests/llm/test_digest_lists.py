"""Lists of hashes come out of a batch, and lines into clauses and sentences, as value by value and place by place."""

from __future__ import annotations

import re

import pyarrow as pa

from tierlens.llm import page


def test_lists_of_a_slice():
    rows = [[1, -(1 << 63)], [], [(1 << 63) - 1, 0, 7], [5], []]
    column = page.list_array(pa, rows, pa.int64())
    assert page.int_lists(column) == rows and page.int_lists(column.slice(1, 3)) == rows[1:4] and page.int_lists(column.slice(2, 0)) == []


def test_sentences_as_by_looking_behind():
    behind = re.compile(r"(?<=[.!?…])[»”“\"’)]*\s+")
    lines = ["One. Two! Three? ", "He said: “No.” Then… he left...  Twice", "no end", "", " . ", "a.b. c", "Wait?!” ) no", "x — y. z: w | v", "end.\u00a0Next", "..”” ”  . a"]
    for line in lines:
        assert page.units_of(line) == [u for c in page._CLAUSE.split(line) for u in behind.split(c) if u]
