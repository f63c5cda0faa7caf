"""The words the speller knows are counted over all rows."""

from __future__ import annotations

import pickle
from collections import Counter

from tierlens.llm import encoding


def test_words_of_few_rows_among_many_are_known(spark):
    """Each word is in three of 30,000 rows; a sample of some thousand would miss nearly all of them."""
    words = [f"żó{chr(97 + i % 20)}ć{chr(97 + i // 20)}ny" for i in range(60)]
    texts = [(i, f"row {i} {words[i // 3]}, next" if i < 180 else f"plain row {i}") for i in range(30_000)]
    df = spark.createDataFrame([("pages", i, t) for i, t in texts] + [("pages", -1, None), ("pages", -2, "")], "src string, row_id long, text string")
    assert encoding.speller_of(df).words == frozenset(words)
    assert encoding.speller_of(df.where("row_id % 3 > 0")).words == frozenset()


def test_words_are_counted_as_by_hand(monkeypatch):
    """Rows that begin and end inside a word, signs, digits, ligatures, capitals; chunks of a few bytes; slices."""
    import pyarrow as pa

    texts = ["é", "à la façon", "", "été_été1été", "naïve", "“naïve”—Ünïcode", "ascii", None, "привет ПРИВЕТ мир", "x" * 50, "١٢٣ œuf", "été" * 9, "ﬁn ÆON\u00a0œuf", "é"]
    want = Counter(w for t in texts[1:] if t for w in {w.lower() for w in encoding._WORDS_OF.findall(t) if not w.isascii()})
    for chunk in (1, 7, 1 << 22):
        monkeypatch.setattr(encoding, "_CHUNK", chunk)
        got: Counter = Counter()
        for b in encoding._word_counts(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]).slice(1)])):
            got.update(dict(zip(*(c.to_pylist() for c in b.columns))))
        assert got == want


def test_garbled_words_are_those_some_pair_makes():
    """Told word by word, without a table of all garbled words: the same words as such a table has."""
    words = frozenset(("dzięki", "żółty", "привет", "straße", "niño"))
    told = encoding.Speller(words)
    table = set()
    for wrote, read in encoding.SWAPS:
        back = {ord(now): chr(was) for was, now in encoding._swap_tables()[wrote, read].items()}
        same = frozenset(encoding._byte_table(wrote)) & frozenset(encoding._byte_table(read))
        for w in words:
            for form in {w, w.capitalize(), w.upper()} if (wrote in encoding._CYRILLIC_PAGES) == bool(encoding._CYRILLIC.search(w)) else ():
                if all(ord(c) in back or c in same for c in form) and (g := form.translate(back)) != form and g.lower() not in words:
                    table.add(g)
    assert len(table) > 100 and all(map(told.garbled, table))
    sound = ("dzięki", "Żółty", "ПРИВЕТ", "señor", "ascii", "größe")
    assert [w for w in sound if told.garbled(w)] == [w for w in sound if w in table] == []


def test_the_driver_never_has_the_words(spark):
    """What the tasks get is as small for 20,000 words as for none; blocks of a few places hold them all."""
    words = {f"é{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}": i for i in range(17_576)}
    df = spark.createDataFrame([("pages", i, " ".join(words)) for i in range(3)], "src string, row_id long, text string")
    told = encoding.speller_of(df)
    assert len(pickle.dumps(told)) < 1_000
    again = pickle.loads(pickle.dumps(told))
    assert len(again.words) == len(words) and all(w in again.words for w in words) and not any(w in again.words for w in ("éabcd", "abc", "", "żaba"))


def test_blocks_hold_every_word(spark, monkeypatch):
    monkeypatch.setattr(encoding.WordTable, "places", 1 << 10)
    words = [f"ö{i}" for i in range(5_000)]
    df = spark.createDataFrame([(w, encoding._word_hash(w) - (1 << 64) * (encoding._word_hash(w) >> 63)) for w in words], "word string, h long")
    table = encoding.WordTable.of(df)
    assert table.mask + 1 > table.places and table == frozenset(words) and not any(f"ä{i}" in table for i in range(500))


def test_commoner_words_are_found_as_word_by_word():
    """Against every pair applied to every word."""
    sound = ("dzięki", "żółty", "привет", "мир", "straße", "niño", "ünïcode", "été", "œuf", "𝒳é")
    seen = {w: 50 + i for i, w in enumerate(sound)}
    for table in encoding._swap_tables().values():
        back = {ord(now): chr(was) for was, now in table.items()}
        for n, w in enumerate(sound):
            seen.setdefault(w.translate(back).lower(), (3, 25, 26, 60)[n % 4])
    want = {
        w for w, n in seen.items()
        if any((x := w.translate(t)) != w and seen.get(x, 0) > 2 * n and all(c < "\x80" or ord(c) in t or c in encoding.repertoire() for c in w) for t in encoding._swap_tables().values())
    }
    assert encoding._garbled_commoner(seen) == want and 20 < len(want) < len(seen)
    skeleton = lambda w: "".join(c if c < "\x80" else "?" for c in w)
    assert all(skeleton(w.translate(t)) == skeleton(w) for w in seen for t in encoding._swap_tables().values())
