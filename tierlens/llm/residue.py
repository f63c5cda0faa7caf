"""Template residue and error-page text (problem 3).

Slots are induced by aligning records of the same template. A unit (a part of a line, or a sentence) in which
something has the shape of a variable is aligned with all units that read the same but for a name in that
place: where other pages have names, the place is a slot and this page left it unfilled. Where no page ever
filled it, the units that keep the same mark are aligned with each other: if their other slots are filled with
changing names, the mark is wording (a text that speaks of placeholders); if nothing in them changes, the
template was never filled. The shapes below only propose places; spellings without brackets or signs (a word, a
blank) need a filled record to be believed.

Whole-page templates are induced from pages without content of their own: wording that recurs on such pages, on
several hosts or over one host, and hardly ever beside content stands in the place of content (errors, access
checks, demands for scripts, sample text).
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import lookup_join, stored
from . import page
from .page import PROSE, Lines, h64, parts_of

#: Pages that fill a unit's place with names, for it to be a slot.
FILLED_PAGES = 2
#: A mark whose unit has so many different fillings in its other slots is wording.
WORDING_FILLINGS = 3
#: A weak mark whose unit never changes is a slot from so many pages on.
CONSTANT_PAGES = 3
#: Wording in place of content: hosts it must recur on, and share of its pages that have no content.
PLACE_HOSTS, PLACE_SHARE = 2, 0.8

WORD, WEAK, STRONG = range(3)
#: Added to the kind of a mark whose unit has no words but names beside it, or that names a field.
ALONE, FIELD = 4, 8

# Words that names of variables are made of.
FIELDS = "name first last full user customer client company firm city town street address date year title subject email mail phone product item price order number link url text insert your enter add here vorname nachname nom prenom nombre apellido nome imie nazwisko"
_FIELD = re.compile(rf"(?<![a-z])(?:{'|'.join(FIELDS.split())})(?![a-z])|[a-z]name\b", re.I)
_FIELD_CAPS = "|".join(w.upper() for w in FIELDS.split())
# By shape alone: between brackets of code, between like signs, or behind a sign that opens a variable.
_STRONG = (
    r"[$#%]?\{+[^{}\n]{1,80}\}+", r"<[%?][^\n]{0,80}?[%?]>", r"\*?\|[A-Za-z][\w:.]{1,40}\|\*?",
    r"(?<![\w$%@#])([$%@#]{1,2})[A-Za-z][\w.:-]{1,40}\1(?!\w)", r"(?<!\w)__[A-Za-z]\w{1,40}__(?!\w)",
    r"(?<![\w%])%(?:\(\w+\))?[sdif](?!\w)", r"(?<!\w)@[A-Z]\w*(?:\.\w+)+", r"(?<![\w$])\$[a-z_]\w+(?!\w)", r"\bX{4,}\b",
)
_WEAK = (
    r"\[+[^\W\d_][^\[\]\n]{1,60}\]+", r"<[^\W\d_][^<>\n/@]{2,60}>", r"(?<!\S):[a-z][a-z_]{1,30}(?!\w)", r"(?<![\w/@.-])[a-z]{2,20}_[a-z_]{2,30}(?![\w/@.-])",
    rf"(?<!\w)(?:{_FIELD_CAPS})[_-]?(?:{_FIELD_CAPS})(?!\w)", r"(?<=\w) (?=,(?:\s|$))",
)
# What programs print for a value they do not have, and what authors leave for one to come.
_WORDS = (r"\bundefined\b", r"\bNaN\b", r"\b(?:TODO|FIXME|TBD)\b")
_MARK = re.compile("|".join((*(f"(?P<s{i}>{p})".replace(r"\1", f"(?P=sign{i})").replace("([$%@#]{1,2})", f"(?P<sign{i}>[$%@#]{{1,2}})") for i, p in enumerate(_STRONG)), f"(?P<weak>{'|'.join(_WEAK)})", f"(?P<word>{'|'.join(_WORDS)})")))
#: What every mark has one of.
_SIGNS = ("{", "[", "<", "$", "%", "_", " ,", "@@", " @", "\n@", "|*", "##", " :a", "undefined", "NaN", "XXXX", "TODO", "FIXME", "TBD", *(f" :{c}" for c in "bcdefghijklmnopqrstuvwxyz"), *(f"{a}{sep}{b}".upper() for a in FIELDS.split() for b in FIELDS.split() for sep in ("", "_", "-")))
_QUOTES = frozenset("\"'“”„‘’«»‹›`")
#: Stands in a mark's place: written large it is a name, written small a word of the unit.
_NAME, _PLAIN = "Qzqz", "qzqz"


@functools.cache
def _signs():
    import ahocorasick

    a = ahocorasick.Automaton()
    for sign in _SIGNS:
        a.add_word(sign, 1)
    a.make_automaton()
    return a


def _maybe(s: str) -> bool:
    """May there be a mark in it?"""
    return next(_signs().iter(s), None) is not None or s[:1] in ("@", ":")


def _found(line: str):
    """(start, end, kind) of the marks in a line; those between quotation marks and in code are examples."""
    out = []
    for m in _MARK.finditer(line):
        a, z = m.span()
        if a and z < len(line) and line[a - 1] in _QUOTES and line[z] in _QUOTES or line.count("`", 0, a) % 2:
            continue
        if m.lastgroup == "word":
            kind = WORD
        elif m["weak"] is not None:
            blank = not m.group().strip()
            field = len(line[:a].split()) <= 2 if blank else bool(_FIELD.search(m.group()))
            kind = WEAK | FIELD * field
        else:
            kind = STRONG
        out.append((a, z, kind))
    return out


def marks_of(text: str, known: Lines) -> tuple[list, list, list, list, list]:
    """The marks of a text: hash, kind, unit with the mark, unit's letters, and form of the unit with a name in its place."""
    out: tuple[list, ...] = ([], [], [], [], [])
    if not _maybe(text):
        return out
    for raw in text.split("\n"):
        if not _maybe(raw) or not (spans := _found(raw)):
            continue
        pieces, at = [], 0
        for a, z, _ in spans:
            pieces += (raw[at:a], " " if raw[a:z] == " " else "", _NAME)
            at = z
        named = "".join((*pieces, raw[at:])).strip()
        units = page.units_of(named) if known.of(raw).flags & PROSE else parts_of(named)
        left = iter(spans)
        for u in units:
            if not (n := u.count(_NAME)):
                continue
            plain = u.replace(_NAME, _PLAIN)
            form, key = page.form_and_letters(plain)
            own = [s for _, s in zip(range(n), left)]
            inside = [raw[a:z].casefold() for a, z, _ in own]
            rest = u.replace(_NAME, " ")
            alone = ALONE * (page.form_and_letters(rest)[0][:1] in ("", "="))
            for (*_, kind), mark in zip(own, inside):
                if kind == WORD and rest.isupper():  # a word written large among others
                    continue
                out[0].append(h64(mark))
                out[1].append(kind | alone)
                out[2].append(h64(f"{form}|{'|'.join(inside)}"))
                out[3].append(h64(key))
                out[4].append(known.part(u)[0])
    return out


def unfilled_rows(digest: DataFrame, won: page.Winners) -> DataFrame:
    """(src, row_id) of the rows with a slot that kept its variable, a default or a blank."""
    marks = stored(
        digest.where(F.size("mark") > 0).select("src", "row_id", "host", "path", F.explode(F.arrays_zip("mark", "mark_kind", "mark_in", "mark_with", "mark_as")).alias("m"))
        .select("src", "row_id", "host", "path", "m.mark", F.col("m.mark_kind").bitwiseAND(3).alias("kind"), (F.col("m.mark_kind").bitwiseAND(ALONE) > 0).alias("alone"), (F.col("m.mark_kind").bitwiseAND(FIELD) > 0).alias("field"), "m.mark_in", "m.mark_with", F.col("m.mark_as").alias("form"))
    )
    wanted = stored(marks.select("form").where("form <> 0").distinct())
    units = lookup_join(digest.select("host", "path", F.explode("unit_form").alias("form")), wanted, ["form"], "path", "left_semi").distinct()
    parts = lookup_join(won.votes, wanted, ["form"], "host", "left_semi").select("form", (F.col("pages") / page.ONE_PAGE).alias("pages"))
    filled = units.groupBy("form").agg(F.count(F.lit(1)).alias("pages")).unionByName(parts).groupBy("form").agg(F.sum("pages").alias("filled"))
    aligned = filled.where(F.col("filled") >= FILLED_PAGES).select("form", F.lit(True).alias("aligned"))
    kept = marks.groupBy("mark_in").agg(F.countDistinct("mark_with").alias("fillings"), F.countDistinct("host", "path").alias("pages"))
    told = stored(marks.join(aligned, "form", "left").join(kept, "mark_in").withColumn("aligned", F.coalesce("aligned", F.lit(False))))
    slots = told.where("aligned").select("mark").distinct().withColumn("slot", F.lit(True))
    told = told.join(slots, "mark", "left").withColumn("slot", F.coalesce("slot", F.lit(False)))
    constant = F.col("fillings") < WORDING_FILLINGS
    weak = F.col("slot") | (F.col("field") & (F.col("pages") >= CONSTANT_PAGES))
    # where a unit has names alone, nothing in it can speak of the mark
    among_names = F.col("alone") & (F.col("slot") | (F.col("kind") == STRONG))
    among_words = ~F.col("alone") & constant & ((F.col("kind") == STRONG) | ((F.col("kind") == WEAK) & weak))
    unfilled = F.col("aligned") | among_names | among_words
    return told.where(unfilled).select("src", "row_id").distinct()


def _keys(digest: DataFrame, *columns: str, units: bool = False) -> DataFrame:
    """The letters of every part of a row, and of its units as well, each once."""
    every = F.concat("key", F.flatten("unit"), F.flatten("clause"), "said") if units else F.col("key")
    return digest.select(*columns, F.explode(F.array_distinct(every)).alias("key")).where("key <> 0")


def placed_rows(digest: DataFrame, won: page.Winners, place_hosts: int = PLACE_HOSTS) -> DataFrame:
    """(src, row_id) of the rows in which wording that stands in place of content is all there is beside furniture."""
    lines = digest.select("src", "row_id", "host", F.posexplode(F.arrays_zip("prose", "unit", "clause")).alias("no", "p"))
    lines = lines.select("src", "row_id", "host", "no", F.col("p.prose").alias("forms"), F.col("p.unit").alias("unit"), F.col("p.clause").alias("clause"), F.xxhash64("row_id", "no").alias("_at"))
    # nearly all lines of prose are one part; of the others half of the parts decide
    one = won.meet(lines.where(F.size("forms") == 1).withColumn("form", F.col("forms")[0])).where(~F.col("furniture"))
    several = lines.where(F.size("forms") > 1).withColumn("n", F.size("forms")).withColumn("form", F.explode("forms"))
    several = won.meet(several).groupBy("src", "row_id", "no").agg(F.count_if("furniture").alias("hits"), F.first("n").alias("n"), F.first("unit").alias("unit"), F.first("clause").alias("clause"))
    several = several.where((F.col("hits") == 0) | (2 * F.col("hits") < F.col("n")))
    columns = ("src", "row_id", "no", "unit", "clause")
    own = stored(one.select(*columns).unionByName(several.select(*columns)))
    # pages without content, and the wordings on them
    bare = stored(digest.select("src", "row_id").distinct().join(own.select("src", "row_id").distinct(), ["src", "row_id"], "left_anti"))
    without = lookup_join(digest, bare, ["src", "row_id"], "row_id", "left_semi")
    seen = _keys(without, "host", "path").unionByName(without.select("host", "path", F.lit(0).cast("bigint").alias("key"))).distinct()
    seen = stored(seen.groupBy("key", "host").agg(F.count(F.lit(1)).alias("n")))
    # a template of one host: on several paths of a host most of whose pages have content
    sizes = digest.select("host", "path").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("size"))
    mixed = seen.where("key = 0").join(sizes, "host").where(2 * F.col("n") < F.col("size")).select("host", F.lit(True).alias("mixed"))
    wide = seen.where("key <> 0").groupBy("key").agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("bare"), F.min("host").alias("host"))
    wide = wide.where((F.col("hosts") >= place_hosts) | (F.col("bare") >= page.MIN_PAGES)).join(mixed, "host", "left")
    often = stored(wide.where((F.col("hosts") >= place_hosts) | F.col("mixed")).select("key", "bare"))
    pages = lookup_join(won.filled, often.select("key"), ["key"], "host", "left_semi").groupBy("key").agg((F.sum("pages") / page.ONE_PAGE).alias("pages"))
    placed = stored(often.join(pages, "key").where(F.col("bare") >= PLACE_SHARE * F.col("pages")).select("key"))
    # prose made up of such wording alone, sentence by sentence or clause by clause, is no content either; it begins with it
    begins = own.withColumns({"a": F.get("unit", F.lit(0)), "b": F.get("clause", F.lit(0))})
    for c in ("a", "b"):
        begins = lookup_join(begins, placed.select(F.col("key").alias(c), F.lit(True).alias(f"placed_{c}")), [c], "row_id", "left")
    maybe = F.col("placed_a").isNotNull() | F.col("placed_b").isNotNull()
    told = begins.where(maybe).select("src", "row_id", "no", F.explode(F.concat(F.transform("unit", lambda k: F.struct(k.alias("key"), F.lit(1).alias("by"))), F.transform("clause", lambda k: F.struct(k.alias("key"), F.lit(2).alias("by"))))).alias("k"))
    other = lookup_join(told.select("src", "row_id", "no", "k.key", "k.by"), placed, ["key"], "row_id", "left_anti")
    other = other.groupBy("src", "row_id", "no").agg(F.countDistinct("by").alias("n")).where("n = 2").select("src", "row_id")
    content = begins.where(~maybe).select("src", "row_id").unionByName(other).distinct()
    without = bare.unionByName(own.select("src", "row_id").distinct().join(content, ["src", "row_id"], "left_anti"))
    rest = lookup_join(digest, stored(without), ["src", "row_id"], "row_id", "left_semi")
    return lookup_join(_keys(rest, "src", "row_id", units=True), placed, ["key"], "row_id", "left_semi").select("src", "row_id").distinct()


def residue_rows(digest: DataFrame, won: page.Winners) -> DataFrame:
    """(src, row_id, reason), stored: ``slot``, ``filler`` or ``in_place``, the first that holds; a row delivered twice comes once."""
    why = lambda df, n, name: df.select("src", "row_id", F.struct(F.lit(n).alias("n"), F.lit(name).alias("reason")).alias("w"))
    rows = why(unfilled_rows(digest, won), 0, "slot").unionByName(why(digest.where("filler"), 1, "filler")).unionByName(why(placed_rows(digest, won), 2, "in_place"))
    return stored(rows.groupBy("src", "row_id").agg(F.min("w").alias("w")).select("src", "row_id", "w.reason"))


class Site:
    """All that is found out about the pages of a crawl, each step when it is first asked for.

    ``roles`` says whether the main bodies will be asked for.
    """

    def __init__(self, rows: DataFrame, digest: DataFrame | None = None, roles: bool = True):
        self.rows, self.roles = rows, roles
        self._digest, self._won, self._residue = digest, None, None

    @property
    def digest(self) -> DataFrame:
        if self._digest is None:
            self._digest = page.digests(self.rows, self.roles)
        return self._digest

    @property
    def won(self) -> page.Winners:
        if self._won is None:
            self._won = page.winners(self.digest)
        return self._won

    @property
    def residue(self) -> DataFrame:
        """(src, row_id, reason) of the rows left out."""
        if self._residue is None:
            self._residue = residue_rows(self.digest, self.won)
        return self._residue

    def sound(self, df: DataFrame) -> DataFrame:
        """The rows of a (src, row_id, …) table that are not left out."""
        return lookup_join(df, self.residue.select("src", "row_id"), ["src", "row_id"], "row_id", "left_anti")


def site_rows(pages: DataFrame, discovered: DataFrame) -> DataFrame:
    """(src, row_id, host, path, text, declared_lang) of both tables; null and empty texts and null ids are left out."""
    a = pages.select(F.lit("pages").alias("src"), F.col("page_id").alias("row_id"), F.col("domain").alias("host"), F.lit("/").alias("path"), "text", "declared_lang")
    b = discovered.select(F.lit("discovered_pages").alias("src"), F.col("dpage_id").alias("row_id"), F.col("domain").alias("host"), "path", "text", "declared_lang")
    return a.unionByName(b).where(F.col("row_id").isNotNull() & (F.length("text") > 0))
