"""Small fixtures for the corpus operators: defined results for nulls, blanks, ties, repeats, empty tables and odd texts."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlens.llm import boilerplate, charforms, encoding, language, leakage, lines, packing, page, residue


# ---------------------------------------------------------------- 1: repeated lines
def _line_table(spark, data):
    return spark.createDataFrame(data, "dpage_id long, domain string, text string, extra string")


def test_repeated_lines(spark):
    data = [(i, "a.test", f"Notice: all rights!\nown words number {chr(97 + i)}\n\n123", None) for i in range(8)]
    data += [(100 + i, f"b{i}.test", f"Notice: all rights!\nelse {chr(97 + i)}", "x") for i in range(5)]
    data += [data[0], (None, "a.test", "Notice: all rights", None), (50, None, "Notice: all rights", None), (51, "a.test", None, None), (52, "a.test", "", None)]
    df = _line_table(spark, data).withColumn("_key", F.lit(1)).withColumn("line_no", F.lit(9))
    assert rows(lines.repeated_line_positions(df, "dpage_id", "domain")) == sorted(((i, 0) for i in range(8)), key=repr)
    clean = {r.dpage_id: (r.text, r.n_removed) for r in lines.without_repeated_lines(df, "dpage_id", "domain").collect()}
    assert clean[0] == ("own words number a\n\n123", 1) and clean[100][1] == 0 and clean[50] == ("Notice: all rights", 0) and clean[51] == (None, 0) and clean[52] == ("", 0)
    assert lines.repeated_line_positions(df.limit(0), "dpage_id", "domain").count() == 0


def test_false_discovery_cut():
    assert lines.benjamini_hochberg([(400, 5), (0, 1000)], 0.01) == 100.0
    assert lines.benjamini_hochberg([(0, 10)], 0.01) == float("inf") == lines.benjamini_hochberg([], 0.01)


def test_whole_source_repeats(spark):
    df = _line_table(spark, [(i, "only.test", "same line here", None) for i in range(9)])
    assert lines.repeated_line_positions(df, "dpage_id", "domain").count() == 9


# ---------------------------------------------------------------- 8: look-alikes
def test_skeletons():
    same = ["Price fi list", "Рrice ﬁ list", "Ｐrice fi list", "Price fi​ list", "Price fi list"]
    assert len({charforms.skeleton(s) for s in same}) == 1
    assert charforms.skeleton("é") == charforms.skeleton("é") != charforms.skeleton("e")
    assert charforms.skeleton("a\nb") != charforms.skeleton("a b") and charforms.skeleton("A") != charforms.skeleton("a")
    family = "\U0001f469‍\U0001f4bb"
    assert "‍" in charforms.skeleton(family)
    assert charforms.consistent_form("Рrice Привeт Тор") == "Price Привет Тор"


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_skeleton_settles(s):
    once = charforms.skeleton(s)
    assert charforms.skeleton(once) == once


def test_pairs_against_brute_force(spark):
    rng, texts = random.Random(1), []
    base = ["one text here", "zwei Sätze", "три слова о", ""]
    for i in range(60):
        t = rng.choice(base)
        if rng.random() < 0.5:
            t = t.replace("o", "о").replace(" ", " ") if rng.random() < 0.5 else t.replace("e", "ｅ")
        texts.append((i, t if rng.random() < 0.95 else None))
    df = spark.createDataFrame([*texts, texts[0], (None, "one text here")], "doc_id long, text string").withColumn("th", F.lit(1))
    want = sorted(((a, b) for a, x in texts for b, y in texts if a < b and x and y and x != y and charforms.skeleton(x) == charforms.skeleton(y)), key=repr)
    assert rows(charforms.look_alike_pairs(df)) == want and want
    assert charforms.look_alike_pairs(df.limit(0)).count() == 0
    forms = {r.doc_id: r for r in charforms.consistent_forms(df.where("doc_id is not null")).collect()}
    assert forms[next(i for i, t in texts if t is None)].form is None


# ---------------------------------------------------------------- 7: leaked items
@given(st.lists(st.lists(st.sampled_from("abcde"), min_size=2, max_size=5), min_size=1, max_size=6), st.lists(st.sampled_from("abcdefg"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_search_finds_every_occurrence(patterns, text):
    uniq = list({tuple(p) for p in patterns})
    e = leakage.WuManber(uniq)
    got = sorted(e.search([e.vocabulary.get(w, 0) for w in text]))
    want = sorted((i, k) for i, p in enumerate(uniq) for k in range(len(text) - len(p) + 1) if tuple(text[k : k + len(p)]) == p)
    assert got == want


def test_leaks(spark):
    passage = "At dawn Orpica drove from Labera to Banapa with samples for Fa. The board in Elriwen voted 73 to 92 against hiring Reva again."
    items = spark.createDataFrame([(1, f"Read this.\n\n{passage}\n\nWho drove?"), (2, f"Read this.\n\n{passage}\n\nWhere?"), (3, None), (None, passage), (4, "Read this.\n\nNothing of it. None at all here.\n\nQ?")], "item_id long, text string")
    near = passage.replace("samples", "goods").upper().replace(" ", "\n").replace("A", "А")
    docs = [(10, "x " + near + " y"), (11, passage.split(". ")[0]), (12, None), (13, ""), (14, passage.replace("dawn", "noon").replace("samples", "goods").replace("Labera", "Q")), (15, "Read this. Who drove? Nothing"), (10, "x " + near + " y")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(5))
    assert rows(leakage.leaked_items(df, items).select("doc_id", "item_id")) == [(10, 1), (10, 2)]
    assert rows(leakage.leaked_items(df, items, block_chars=1).select("doc_id", "item_id")) == [(10, 1), (10, 2)]
    assert leakage.leaked_items(df.limit(0), items).count() == 0 and leakage.leaked_items(df, items.limit(0)).count() == 0


# ---------------------------------------------------------------- 6: packing
def test_best_fit():
    place = packing.best_fit([5, 5, 3, 7, 2], 10)
    use = defaultdict(int)
    for size, c in zip([5, 5, 3, 7, 2], place):
        use[c] += size
    assert max(use.values()) <= 10 and len(use) == 3


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW_TOKENS", 400)
    monkeypatch.setattr(packing, "WINDOW_CONTAINERS", 4)
    rng = random.Random(2)
    items = [(i, "hot" if i % 3 else f"q{i % 5}", rng.randint(1, 60)) for i in range(300)] + [(900, "hot", 250), (901, "q1", 0)]
    sizes = spark.createDataFrame(items, "item long, queue string, n_tokens long")
    limits = spark.createDataFrame([("s", 100), ("s", 100), ("none", 0)], "container_kind string, capacity_tokens long")
    got = packing.pack(sizes, limits).collect()
    use, parts = defaultdict(int), defaultdict(list)
    for r in got:
        use[r.container_id] += r.n_tokens
        parts[r.item].append((r.part, r.first_token, r.n_tokens))
    assert max(use.values()) <= 100 and {r.container_kind for r in got} == {"s"}
    assert {i: sum(p[2] for p in parts[i]) for i in parts} == {i: n for i, _, n in items if n}
    assert all(len(p) == 1 for i, p in parts.items() if i != 900) and sorted(parts[900]) == [(0, 0, 100), (1, 100, 100), (2, 200, 50)]
    assert sum(use.values()) / (100 * len(use)) > 0.85
    # in every window but the last a queue has its quantum, give or take its longest part
    queue, shares = {i: q for i, q, _ in items}, defaultdict(lambda: defaultdict(int))
    for r in got:
        shares[int(r.container_id.split("-")[0])][queue[r.item]] += r.n_tokens
    total, tokens = sum(n for *_, n in items), defaultdict(int)
    for _, q, n in items:
        tokens[q] += n
    assert len(shares) >= total // 400
    for w in range(total // 400):
        assert all(abs(shares[w][q] - 400 * tokens[q] / total) <= (100 if q == "hot" else 60) for q in tokens)
    # queues of one item each are spread over the windows
    single = spark.createDataFrame([(i, f"only{i}", 50) for i in range(200)], "item long, queue string, n_tokens long")
    windows = defaultdict(int)
    for r in packing.pack(single, limits).collect():
        windows[r.container_id.split("-")[0]] += r.n_tokens
    assert len(windows) >= 20 and max(windows.values()) < 1000
    assert packing.pack(sizes.limit(0), limits).count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "a", "hello world"), (1, "a", "hello world"), (2, None, "x"), (3, "b", None), (4, "b", " \n ")], "doc_id long, source string, text string")
    got = {r.item: (r.queue, r.n_tokens) for r in packing.token_counts(df, "doc_id", "source").collect()}
    assert set(got) == {1, 2} and got[2] == ("", 1)


# ---------------------------------------------------------------- 5: encodings
SOUND = ["Les régulateurs sont déjà livrés à l’équipe — c’est vrai.", "Für größere Höfe liefert Närø seit 2016 Geräte.", "Każda dostawa jest sprawdzana, zanim ją wyśle. Część.", "Каждую поставку проверяют в городе Милта, прежде чем отправить.", "Não há alterações na Informação.", "¿Qué pasó con el año?", "plain text", "", "ONLY CAPS ÀÉ Ñ"]


@pytest.mark.parametrize("text", SOUND)
def test_sound_text_stays(text):
    assert encoding.repair(text) == (False, text, False)


@pytest.mark.parametrize("text", SOUND[:6])
@pytest.mark.parametrize("wrong", ["cp1252", "cp1250", "cp1251", "mac_roman", "cp850"])
@pytest.mark.parametrize("times", [1, 2])
def test_round_trip(text, wrong, times):
    bad = text
    for _ in range(times):
        bad = encoding.read_as(bad.encode(), wrong)
    damaged, fixed, complete = encoding.repair(bad)
    assert damaged
    if wrong in ("cp1252", "cp1250", "cp850") and times == 1:
        assert fixed == text and complete


def test_mixed_and_lost_text():
    assert encoding.repair("Sound é line\nbad Ã© line") == (True, "Sound é line\nbad é line", True)
    assert encoding.repair("lost � sign")[::2] == (True, False)
    assert not encoding.repair("An export showed Ã© where é belonged, they wrote.")[0]
    assert encoding.repair("Wiosn¹ nasz zespó³ zast¹pi³ dawny dzia³ zamówieñ.")[1] == "Wiosną nasz zespół zastąpił dawny dział zamówień."


NEVER_DAMAGED = (
    "Temperatur 5°C ± 2", "100 % – ok™ ®", "§5 Abs. 2 StGB, 30µg/m³ Luft", "Île-de-France McÉwan", "The Å, ÄÖÜ and ØÆÅ letters", "x→y", "½ of α", "Türkçe ığdır şöyle", "ăâîșț în română", "Việt Nam đẹp",
    "Україна їжак ґанок є", "äöüß éèêë", "Dvořák and Gdańsk, São Paulo, Ærø", "Straße 5¾ ½l 3½", "日本語 テキスト", "αβγ δεζ Ωmega", "r² = 0,9 · m² km³", "¿Qué? ¡Sí! «hola» »hallo«", "Home » About › Us", "l·lada paral·lel",
    "Nº 5, 2ª planta, 1º", "€5 £6 ¥7 5€", "DeÁngelis O’Érico L’Été d’Ålesund", "a≤b≥c √2 ∑x ∞", "naïve café – “quoted” ‘single’", "Müller & Søn, Škoda, Łódź",
)


@pytest.mark.parametrize("text", NEVER_DAMAGED)
def test_signs_and_other_languages_are_sound(text):
    assert encoding.repair(text) == (False, text, False) == encoding.repair(text, _speller())


@given(st.text(alphabet=st.one_of(st.characters(min_codepoint=0x370, max_codepoint=0x3FF), st.characters(min_codepoint=0x590, max_codepoint=0x6FF), st.characters(min_codepoint=0x3040, max_codepoint=0x30FF), st.sampled_from(" .,°§™±µ²³→")), max_size=40))
@settings(max_examples=200, deadline=None)
def test_other_scripts_are_never_damage(text):
    assert encoding.repair(text, _speller())[1] == text


def _speller():
    return encoding.Speller.of([*SOUND, *(s.upper() for s in SOUND)] * 3)


@pytest.mark.parametrize("wrote, read", encoding.SWAPS)
def test_pairs_of_one_byte_encodings(wrote, read):
    """Whatever is called complete is right; a whole line in words of the corpus is found and restored."""
    for text in SOUND[:5]:
        try:
            bad = encoding.read_as(text.encode(wrote), read)
        except UnicodeEncodeError:
            continue
        damaged, fixed, complete = encoding.repair(bad, _speller())
        assert not complete or fixed == text or not damaged, (bad, fixed)


def test_only_matched_spans_change():
    text = "Sound é, 5°C ± 2, McÉwan\n§ 5 Ã© → x\nİstanbul ığdır"
    assert encoding.repair(text) == (True, text.replace("Ã©", "é"), True)
    polish = "Wiosn¹ nasz zespó³ zast¹pi³ Müller"
    assert encoding.repair(polish)[1] == "Wiosną nasz zespół zastąpił Müller"


def test_damaged_rows(spark):
    df = spark.createDataFrame([("pages", 1, "h", "/", "dÃ©jÃ\xa0"), ("pages", 1, "h", "/", "dÃ©jÃ\xa0"), ("pages", 2, "h", "/", None), ("pages", 3, "h", "/", ""), ("pages", 4, None, None, "été")], "src string, row_id long, host string, path string, text string")
    assert rows(encoding.damaged_rows(residue.Site(df))) == [("pages", 1, "déjà", True)]
    assert encoding.damaged_rows(residue.Site(df.limit(0))).count() == 0


# ---------------------------------------------------------------- 3 and 4: pages
WORDS = "harbour winter garden letter copper village engine morning silver bridge market forest window paper summer".split()


def _site(spark):
    rng, data, n = random.Random(5), [], 0
    name = lambda: "".join(rng.choice(["Ka", "Lo", "Mi", "Ru", "Te", "Vo"]) for _ in range(3)).capitalize()
    for h in range(12):
        for p in range(6):
            n += 1
            prose = "\n".join(f"{name()} {name()} sent the {rng.choice(WORDS)} of {rng.choice(WORDS)} to {name()} before the {rng.choice(WORDS)} of {rng.choice(WORDS)} came to town." for _ in range(3))
            text = f"Home | About us | Contact\n# The {rng.choice(WORDS)} of {name()}\n{prose}\nRelated articles\n- How {name()} met {name()}\nPrivacy policy · Terms of use\n© 2020 Site{h}. All rights reserved."
            if p == 5:
                text = "Home | About us | Contact\nAccess denied. You may not open this document.\nPrivacy policy · Terms of use"
            if n % 13 == 0:
                text = text.replace(" sent the ", " sent the {{thing}} ", 1)
            if n % 17 == 0:
                text += "\nLorem ipsum dolor sit amet, consectetur adipiscing elit sed do eiusmod tempor."
            data.append(("pages", n, f"s{h}.test", f"/p{p}", text, "en"))
    data += [data[0], ("pages", 900, None, None, "x", None), ("pages", 901, "q.test", "/", "\n \n", None)]
    return spark.createDataFrame(data, "src string, row_id long, host string, path string, text string, declared_lang string")


def _found(df, reason="slot"):
    return [r.row_id for r in residue.Site(df).residue.where(F.col("reason") == reason).collect()]


def test_residue_and_bodies(spark):
    df = _site(spark)
    site = residue.Site(df)
    got = {r.row_id: r.reason for r in site.residue.collect()}
    text = {r.row_id: r.text for r in df.collect()}
    assert {i for i, t in text.items() if "Access denied" in t and "{{" not in t and "Lorem" not in t} == {i for i, r in got.items() if r == "in_place"}
    assert {i for i, t in text.items() if "{{thing}}" in t} == {i for i, r in got.items() if r == "slot"}
    assert {i for i, t in text.items() if "Lorem" in t and "{{" not in t} == {i for i, r in got.items() if r == "filler"}
    for limit in (400_000, 0):  # winning forms as sets, or joined to the rows
        main = defaultdict(set)
        for r in boilerplate.main_lines(site, limit).collect():
            main[r.row_id].add(r.line_no)
        sound = [i for i in text if i < 900 and i not in got]
        assert sound and all(main[i] == {1, 2, 3, 4} for i in sound)
    bodies = {r.row_id: r.text for r in boilerplate.main_bodies(site).collect()}
    assert bodies[next(iter(got))] == "" and bodies[sound[0]].startswith("# The") and len(bodies) == len(set(text) - {900}) + (900 in bodies)


def test_hosts_keep_their_own_forms(spark):
    """A host of most of the pages decides for itself only, and two hosts may use one form differently."""
    rng, data, hot = random.Random(7), [], 150
    name = lambda: "".join(rng.choice(["ka", "lo", "mi", "ru", "te", "vo"]) for _ in range(5)).capitalize()
    for h in range(8):
        same = name()
        for p in range(hot if h == 0 else 6):
            prose = [f"{name()} sent the {rng.choice(WORDS)} of {rng.choice(WORDS)} to {name()} before the {rng.choice(WORDS)} of {rng.choice(WORDS)} came to town." for _ in range(2)]
            kept, varied = (f"Partner of the house {name()}", f"Questions go to {same}") if h == 0 else (f"Partner of the house {same}", f"Questions go to {name()}")
            data.append(("pages", len(data), f"s{h}.test", f"/p{p}", f"Home | About us | Contact\n# The {rng.choice(WORDS)} of {name()}\n{prose[0]}\n{kept}\n{prose[1]}\n{varied}\nPrivacy policy · Terms of use", "en"))
    df = spark.createDataFrame(data, "src string, row_id long, host string, path string, text string, declared_lang string")
    site = residue.Site(df)
    for limit in (400_000, 0):
        main = defaultdict(set)
        for r in boilerplate.main_lines(site, limit).collect():
            main[r.row_id].add(r.line_no)
        assert all(main[i] == ({1, 2, 3, 4} if i < hot else {1, 2, 4, 5}) for i in range(len(data)))


def test_joins_beyond_every_bound(spark, monkeypatch):
    """With no table small enough to broadcast the joins are salted, and the results are the same."""
    df = _site(spark)
    site = residue.Site(df)
    want = rows(site.residue), rows(boilerplate.main_lines(site))
    from tierlens import runtime

    monkeypatch.setattr(runtime.lookup_join, "__defaults__", (0,))
    monkeypatch.setattr(page, "BROADCAST_ROWS", 0)
    other = residue.Site(df, site.digest)
    assert (rows(other.residue), rows(boilerplate.main_lines(other, 0))) == want


def test_empty_site(spark):
    site = residue.Site(_site(spark).limit(0))
    assert site.residue.count() == boilerplate.main_lines(site).count() == boilerplate.main_bodies(site).count() == 0


def _pages(spark, texts):
    """One page each, on hosts and paths of their own where none is given."""
    data = [("pages", i, t[0] if isinstance(t, tuple) else f"h{i}.test", f"/{i}", t[-1] if isinstance(t, tuple) else t) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "src string, row_id long, host string, path string, text string")


@pytest.mark.parametrize("line", [
    "Hello {{first_name}}, welcome back to our shop.", "Dear [Customer Name], thank you for your order of today.", "Sold by Shop Ltd, {{city}}", "Hello %s, your parcel is on its way to you.", "Hello :name, your parcel is on its way.",
    "Hello @Model.Name, your parcel is on its way.", "Hello <?php echo $n ?>, your parcel is on its way.", "Hello FIRSTNAME, your parcel is on its way.", "Dear , your parcel is on its way.",
])
def test_template_never_filled(spark, line):
    """All pages of a template keep the variable: all are found, on one host or on many."""
    texts = [("one.test", line) for _ in range(12)] + [line.replace("parcel", "letter") for _ in range(12)] + ["The weather of the week was fine and the harvest went well."] * 3
    assert set(_found(_pages(spark, texts))) == set(range(24))


def test_filled_records_give_the_slot_away(spark):
    """A place that other pages fill with names is a slot, whatever the page left in it."""
    name = lambda i: "Ka" + "".join(chr(97 + int(d)) for d in str(i))
    texts = [f"The audit of {name(i)} was closed in {name(i * 7)} before the winter came." for i in range(12)]
    left = ["undefined", "[object Object]", "{0}", "TODO", "$FIRSTNAME$", "[TBD]"]
    texts += [f"The audit of {x} was closed in {name(i)} before the winter came." for i, x in enumerate(left)]
    texts += ["Dear Kalo, your order is ready.", "Dear Mira, your order is ready.", "Dear , your order is ready."]
    assert set(_found(_pages(spark, texts))) == {*range(12, 18), 20}


def test_wording_about_marks_is_sound(spark):
    """Where the rest of the unit changes and the mark stays, the text speaks of it; so it does between quotation marks and in code."""
    name = lambda i: "Lo" + "".join(chr(97 + int(d)) for d in str(i))
    texts = [f"In the editor of {name(i)}, a tag such as {{{{first_name}}}} is swapped for the name of the reader." for i in range(9)]
    texts += ['The guide writes "{{city}}" where a town belongs.', "Type `%s` to print a string of the program.", "Your privacy choices are yours. [Settings] [I agree]"] + ["USE ALL YOU LIKE. [SETTINGS] [I AGREE]"] * 4
    assert _found(_pages(spark, texts)) == []
    assert set(_found(_pages(spark, [*texts, "Good morning to {{first_name}} from us all."]))) == {len(texts)}


def test_a_row_delivered_twice_counts_once(spark):
    """Three deliveries of one page are no three pages."""
    df = _pages(spark, ["Read the [company note] here and then go on to the next page."])
    assert _found(df.union(df).union(df)) == []


def test_long_error_pages(spark):
    """Error texts of any length and number of lines stand in place of content."""
    error = "The server could not answer this call because the upstream closed its door. Wait a while and load the page again, or write to the people who run it and tell them what you did, when you did it, and which way you came here, so that they can look for the cause of it."
    body = lambda i: f"# Letter {chr(97 + i)}\nThe gardener of house {chr(97 + i)} sent {'x' * (i + 2)} seeds to the village before winter came."
    texts = [(f"h{h}.test", body(h * 4 + p)) for h in range(4) for p in range(4)] + [(f"h{h}.test", "\n".join([error] * 3)) for h in range(4)]
    assert set(_found(_pages(spark, texts), "in_place")) == set(range(16, 20))


def test_forms():
    form = lambda s: page.form_and_letters(s)[0]
    assert form("Find us in Nefen, 12") == form("Find us in Katu Bay 9")
    assert form("HOME") == "=home" and page.parts_of("» a | b ›") == ["a", "b"] and page.parts_of(" - ") == []


# ---------------------------------------------------------------- 2: languages
SENTENCES = {
    "en": "The people of the town were waiting for the train when it began to rain and they went home.", "de": "Die Leute in der Stadt warteten auf den Zug, als es zu regnen begann und sie nach Hause gingen.",
    "fr": "Les gens de la ville attendaient le train quand il a commencé à pleuvoir et ils sont rentrés.", "es": "La gente de la ciudad esperaba el tren cuando empezó a llover y todos se fueron a su casa.",
    "pt": "As pessoas da cidade esperavam o comboio quando começou a chover e não foram para casa a pé.", "pl": "Ludzie w mieście czekali na pociąg, kiedy zaczęło padać, i wszyscy poszli pieszo do domu.",
    "ru": "Люди в городе ждали поезд, когда начался дождь, и все они пошли пешком домой по дороге.",
}


def _samples(seed):
    rng, out = random.Random(seed), []
    for lang, s in SENTENCES.items():
        w = s.split()
        for _ in range(40):
            out.append((lang, " ".join(rng.sample(w, 12)) + "."))
    return out


def test_held_out_accuracy():
    m = language.train(_samples(1))
    test = _samples(2)
    best, margin = m.decide([language.evidence_words(s) for _, s in test])
    assert sum(language.LANGUAGES[b] == lang for b, (lang, _) in zip(best, test)) / len(test) > 0.97
    noisy = [("de" if i % 10 == 0 else lang, s) for i, (lang, s) in enumerate(_samples(1))]
    best, _ = language.train(noisy).decide([language.evidence_words(s) for _, s in test])
    assert sum(language.LANGUAGES[b] == lang for b, (lang, _) in zip(best, test)) / len(test) > 0.9


def test_passages_and_rows(spark):
    m = language.train(_samples(1))
    text = f"{SENTENCES['en']} {SENTENCES['en']}\n{SENTENCES['de']} {SENTENCES['de']}"
    got = language.passages([text, "", "12 34"], m)
    assert [(p[0], p[1], p[2]) for p in got[0]] == [(0, 0, "en"), (1, 1, "de")] and got[1] == [] and got[2] == []
    df = spark.createDataFrame([("pages", 1, text, "en-GB"), ("pages", 1, text, "en-GB"), ("pages", 2, text, None), ("pages", 3, "short", "en")], "src string, row_id long, text string, declared_lang string")
    assert rows(language.mislabelled_rows(df.withColumn("host", F.lit("h")).withColumn("path", F.lit("/")), m)) == [("pages", 1, "de"), ("pages", 2, "de"), ("pages", 2, "en")]
    assert {(r.row_id, r.lang) for r in language.row_languages(df, m).where("row_id < 3").collect()} <= {(1, "en"), (1, "de"), (2, "en"), (2, "de")}
    label = lambda x: spark.createDataFrame([(x,)], "v string").select(language.named_language(F.col("v"))).first()[0]
    assert [label(x) for x in ("DE", "deu", "de_AT", "und", " ", None, "unknown", "nl-BE")] == ["de", "de", "de", None, None, None, None, "nl"]


def test_tested_lines_and_rates(spark):
    """A line that every source repeats alike is no excess against the outside, though it is repeated within."""
    word = lambda n: "".join(chr(97 + int(d)) for d in str(n))
    data = [(s * 100 + i, f"s{s}.test", f"everywhere alike\nonly of s {word(s)}\nown {word(s * 100 + i)}", None) for s in range(6) for i in range(10)]
    got = lines.scored_lines(_line_table(spark, data), "dpage_id", "domain").collect()
    assert len(got) == 12 and all(r.accepted and r.q <= 0.01 for r in got)
    assert sum(r.site_specific for r in got) == 6 and all(r.q_line == 1.0 for r in got if not r.site_specific)
    assert lines.scored_lines(_line_table(spark, []), "dpage_id", "domain").count() == 0
    assert lines.adjusted([(400, 5), (0, 1000)]) == [(0, 1.0), (400, pytest.approx(0.0, abs=1e-9))]


def test_look_alike_table():
    for a, b in (("‑", "-"), ("𝐚", "a"), ("ⅼ", "l"), ("ɑ", "a"), ("օ", "o"), ("Ꭺ", "A")):
        assert charforms.skeleton(a) == charforms.skeleton(b)
    assert len({charforms.skeleton(x) for x in ("ı", "i", "1", "l")}) == 4


def test_classes(spark):
    df = spark.createDataFrame([(1, "one"), (2, "оne"), (3, "one"), (4, "two"), (5, None), (6, " "), (None, "one")], "doc_id long, text string")
    got = {r.doc_id: (r.class_key, r.spellings, r.documents) for r in charforms.look_alike_classes(df).collect()}
    assert set(got) == {1, 2, 3, 4} and got[1] == got[2] == got[3] and got[1][1:] == (2, 3) and got[4][1:] == (1, 1)


def test_mixture_weights(spark, monkeypatch):
    """A queue that runs out leaves its share to the others, and one without a weight comes last: no window is thin."""
    monkeypatch.setattr(packing, "WINDOW_TOKENS", 1000)
    monkeypatch.setattr(packing, "WINDOW_CONTAINERS", 4)
    rng = random.Random(4)
    items = [(i, "abc"[i % 3], rng.randint(5, 60)) for i in range(900)]
    sizes = spark.createDataFrame(items, "item long, queue string, n_tokens long")
    limits = spark.createDataFrame([("s", 200)], "container_kind string, capacity_tokens long")
    weights = spark.createDataFrame([("a", 10.0), ("b", 1.0)], "queue string, weight double")
    got = packing.pack(sizes, limits, weights=weights).collect()
    queue, size = {i: q for i, q, _ in items}, defaultdict(lambda: defaultdict(int))
    use = defaultdict(int)
    for r in got:
        size[int(r.container_id.split("-")[0])][queue[r.item]] += r.n_tokens
        use[r.container_id] += r.n_tokens
    total = sum(n for *_, n in items)
    assert sum(use.values()) == total and sum(use.values()) / (200 * len(use)) > 0.9
    assert all(900 <= sum(size[w].values()) <= 1100 for w in range(max(size) - 1))
    assert abs(size[0]["a"] / sum(size[0].values()) - 10 / 11) < 0.1 and size[0]["c"] == 0 and size[max(size)]["c"] > 0


def test_short_sentences_do_not_slow_the_search(spark):
    items = [(1, "Do it.\n\nYes. At dawn Orpica drove from Labera to Banapa with samples. The board voted against hiring Reva again.\n\nQ?")]
    index = leakage.SentenceIndex(items)
    assert index.engine.m >= leakage.SHORT and len(index.searches) == 2
    assert index.found("yes! at dawn orpica drove from labera to banapa with samples") == {1: 2}
