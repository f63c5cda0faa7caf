"""The lines of a page as containers, and what votes over all pages tell about them.

The text of a page has no tags. In the place of a tag-class path a line has a generalised form: what stands
between its separators, with names and numbers reduced to slots. Hosts vote on every form: where its slots
keep their filling from page to page of a host it is furniture of that host; where they change with every
page it is content there. Forms that most hosts keep, and forms whose few fillings all hosts share, are
furniture where a host has too few pages of its own to tell. The votes are plain aggregates over all pages.

One pass reads the texts (``digests``). Its table has, for every row, hashes of forms and letters line by line,
and all later steps work on these hashes: votes, the winners a row meets, and the roles of its lines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..runtime import BROADCAST_ROWS, lookup_join, map_arrow, stored, weighted_join

#: A line shorter than this is no prose.
PROSE_CHARS = 40
#: A form must be seen on so many pages before its hosts' votes count.
MIN_PAGES = 4
#: A host keeps a form where its fillings are at most so large a share of its pages.
KEPT_SHARE = 0.72
#: All hosts share a form's fillings where these are at most so large a share of the hosts.
SHARED_SHARE = 0.3

_WORD = re.compile(r"\w+")
# a made-up code or an address: a leading slash, a mail address, five consonants in a row
_ADDRESS = re.compile(r"(?<!\S)/\S+|\S+@\S+")
_CODE = re.compile(r"[a-z0-9]*[bcdfghjklmnpqrstvwxz]{5,}[a-z0-9]*")
# The syllables that filler in the manner of "lorem ipsum" is made of.
SYLLABLES = "lo rem ip ips sum do lor sit a am met con sec te tet tur ad pi pis sci sc cing el eli it lit se sed ei us eius mod tem por in ci cid di dunt ut la lab bo re et unt du id tam ti um mag na ali qua men ven quis nos trud ex er ul lam co ris ni si ea com mo quat ir ure vo lup ta ve es cil fu gi at nul pa ri"
_FILLER_WORD = re.compile(f"(?:{'|'.join(sorted(set(SYLLABLES.split()), key=lambda x: -len(x)))})+$")
_LETTERS = re.compile(r"[^\W\d_]+")
FILLER_WORDS, FILLER_SHARE = 5, 0.8
_DECOR_FRONT, _DECOR_BACK = " *•-–—>»›#·|\t\r", " ›»|·\t\r"
_PARTS = re.compile(r"\s+[|»·›]\s+|\s+[/>]\s+|\s{2,}|\t")
BULLET = re.compile(r"^\s*(?:[*•\-–>]|\d+[.)])\s+")
_BYLINE = re.compile(r"(?:,\s*(?:19|20)\d\d|[|·]\s*\d+\s+\S+(?:\s+\S+){0,3})\s*$")
#: Where a line of prose is divided into clauses, and these into sentences; a unit is a sentence of a clause.
_CLAUSE = re.compile(r"\s+[-–—|]\s+|:\s+")
_SENTENCE = re.compile(r"([.!?…])[»”“\"’)]*\s+")
_MAYBE_UNITS = re.compile(r"[.!?…:–—|»”“\"’)-]\s")
#: A unit with fewer letters than this says nothing by itself.
UNIT_LETTERS = 12
#: A longer part is furniture only where its very letters recur; its form is made of its units' letters.
_LONG = 140

# what a line is, by itself; the number of its parts stands above these bits
PROSE, FILLER, BANNER, CAPS, HEADED, THREE, BULLETED, ENTRY, BYLINE, OPENS, QUOTED = (1 << i for i in range(11))
_PARTS_AT = 12


def bare(line: str) -> str:
    """The line without bullets, arrows and the like at its ends."""
    return line.strip().lstrip(_DECOR_FRONT).rstrip(_DECOR_BACK)


def parts_of(line: str) -> list[str]:
    s = bare(line)
    if not ("  " in s or "|" in s or "»" in s or "·" in s or "›" in s or "\t" in s or " / " in s or " > " in s):
        return [s] if s else []
    return [p for p in _PARTS.split(s) if p]


def _clauses_of(line: str) -> list[str]:
    if ":" in line or "-" in line or "–" in line or "—" in line or "|" in line:
        return _CLAUSE.split(line)
    return [line]


def _sentences_of(clause: str) -> list[str]:
    """A sentence keeps the sign it ends with; searched by that sign, for one that is looked for behind every place costs more."""
    cut = _SENTENCE.split(clause)
    if len(cut) == 1:
        return cut if clause else []
    out = list(map(str.__add__, cut[:-1:2], cut[1::2]))
    if cut[-1]:
        out.append(cut[-1])
    return out


def units_of(line: str) -> list[str]:
    """The sentences of a line's clauses."""
    return [u for c in _clauses_of(line) for u in _sentences_of(c)]


class _Remembered(dict):
    """What a word becomes, found once; emptied when it grows past its bound."""

    bound = 400_000

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> str:
        if len(self) >= self.bound:
            self.clear()
        got = self[word] = self.make(word)
        return got


_slots = _Remembered(lambda w: "0" if not w.isalpha() else "N" if w[0].isupper() else "0" if _CODE.fullmatch(w) else w)


def form_and_letters(part: str) -> tuple[str, str]:
    """The generalised form of a part (names N, numbers and codes 0, each once in a row) and its lower-case letters.

    A part without small letters, or of names and numbers alone, has its letters for a form.
    """
    if "@" in part or "/" in part:
        part = _ADDRESS.sub("0", part)
    words = _WORD.findall(part)
    slots = list(map(_slots.__getitem__, words))
    key = "".join(words if "0" not in slots else [w for w, x in zip(words, slots) if x != "0"]).lower()
    if part.isupper():
        return (key and "=" + key), key
    form = f" {' '.join(slots)} "
    while " N N " in form:
        form = form.replace(" N N ", " N ")
    while " 0 0 " in form:
        form = form.replace(" 0 0 ", " 0 ")
    return (form[1:-1] if form.strip(" N0") else (key and "=" + key)), key


def _closed(s: str) -> bool:
    """Does the string end a sentence?"""
    return s.rstrip("»”“\"’)")[-1:] in {".", "!", "?", "…"}


def is_prose(line: str) -> bool:
    """A sentence or more: long enough and closed like one."""
    s = line.rstrip(" ›»\r\t")
    return len(s) >= PROSE_CHARS and _closed(s) and s.count(" ") >= 5


def is_filler(line: str) -> bool:
    """A passage in invented Latin: nearly all of its words are made of the syllables of filler text."""
    first = line.split(None, 5)[1:5]
    if len(first) < 4 or not first[0].islower() or not all(_FILLER_WORD.match(w.lower().rstrip(".,")) for w in first[::2]):
        return False
    words = _LETTERS.findall(line.lower())
    return len(words) >= FILLER_WORDS and sum(bool(_FILLER_WORD.match(w)) for w in words) >= FILLER_SHARE * len(words)


def h64(s: str) -> int:
    return xxh3_64_intdigest(s) - 0x8000000000000000


def _is_entry(line: str) -> bool:
    """Fields of one record: three short parts between like separators."""
    s = bare(line)
    return any(s.count(sep) == 2 and max(map(len, s.split(sep))) <= 45 for sep in (" — ", " – ", " | ", ", ", " · ", " / "))


class Line:
    """What one line is, whatever stands around it.

    ``forms`` and ``keys`` have the hashes of each part's form and letters (0 where there is none), ``flags`` the
    bits above with the number of parts, ``heads`` the forms of what stands before a separator; ``units``, ``clauses`` and
    ``unit_forms`` are those of a line of prose, ``said`` the letters of the units of any other.
    """

    __slots__ = ("forms", "keys", "flags", "heads", "units", "clauses", "unit_forms", "said")

    def __init__(self, raw: str, known: Lines):
        line = raw.strip()
        parts = parts_of(line)
        self.heads = self.units = self.clauses = self.unit_forms = self.said = ()
        if not parts:
            self.forms = self.keys = ()
            self.flags = 0
            return
        n, part = len(parts), known.part
        flags = n << _PARTS_AT if n < 1 << 16 else 1 << 16 + _PARTS_AT
        words = line.count(" ") + 1
        prose = len(line) >= PROSE_CHARS and is_prose(line)
        if prose and n == 1 and is_filler(line):  # never furniture, however often it recurs
            self.forms = self.keys = (0,) * n
            flags |= FILLER
        elif prose:
            clauses = [list(map(part, _sentences_of(c))) for c in _clauses_of(line) if c]
            units = [u for c in clauses for u in c]
            self.units = tuple([k for _, k, letters in units if len(letters) >= UNIT_LETTERS])
            self.clauses = tuple([c[0][1] if len(c) == 1 else h64(key) for c in clauses if len(key := "".join([x for _, _, x in c])) >= UNIT_LETTERS])
            self.unit_forms = tuple([f for f, _, _ in units if f])
            flags |= PROSE
        if n == 1 and not flags & FILLER:
            p = parts[0]
            if len(p) > _LONG:
                form = key = h64("".join([x for _, _, x in units]) if prose else part(p)[2])
            else:
                form, key, _ = part(p)
            self.forms, self.keys = (form,), (key,)
        elif n > 1:
            both = [part(p) for p in parts]
            self.forms, self.keys = tuple([f for f, _, _ in both]), tuple([k for _, k, _ in both])
        first, end = line[0], line[-1]
        if not known.roles:
            if not prose and _MAYBE_UNITS.search(line) and len(said := units_of(line)) > 1:
                self.said = tuple([k for _, k, letters in map(part, said) if len(letters) >= UNIT_LETTERS])
            if first == "+" and line.startswith("+++") or end == "+" and line.endswith("+++"):
                flags |= BANNER
            self.flags = flags
            return
        if first == "+" and line.startswith("+++") or end == "+" and line.endswith("+++"):
            flags |= BANNER
        if words >= 3:
            flags |= THREE
        if first == "#" and line[:2] == "# ":
            flags |= HEADED
        elif first == ">":
            flags |= QUOTED
        if not flags & (PROSE | FILLER):
            if n == 1 and words > 1 and line.isupper():
                flags |= CAPS
            if (first in "*•-–>" or first.isdigit()) and BULLET.match(line):
                flags |= BULLETED
            elif n == 1 and not _closed(line):
                flags |= OPENS
            if ("," in line or "|" in line or "—" in line or "–" in line or "·" in line or "/" in line) and _is_entry(line):
                flags |= ENTRY
            if (end.isdigit() or "|" in line or "·" in line) and _BYLINE.search(line):
                flags |= BYLINE
            if _MAYBE_UNITS.search(line):
                if len(said := units_of(line)) > 1:
                    self.said = tuple([k for _, k, letters in map(part, said) if len(letters) >= UNIT_LETTERS])
                self.heads = tuple([f for sep in (" - ", ": ", " – ") if sep in raw and (f := part(bare(raw.partition(sep)[0]))[0])])
        self.flags = flags


class Lines:
    """What was found out about lines and parts, remembered for those that recur, as far as the bound goes."""

    bound, long_bound = 200_000, 20_000

    def __init__(self, roles: bool = True):
        self.roles = roles
        self._lines: dict[str, Line] = {}
        self._long: dict[str, Line] = {}
        self._parts: dict[str, tuple[int, int, str]] = {}

    def part(self, s: str) -> tuple[int, int, str]:
        """(hash of the form, hash of the letters, letters) of a part or unit."""
        got = self._parts.get(s)
        if got is None:
            form, key = form_and_letters(s)
            got = (h64(form) if form else 0, h64(key) if key else 0, key)
            if len(s) <= _LONG:
                if len(self._parts) >= self.bound:
                    self._parts.clear()
                self._parts[s] = got
        return got

    def of(self, raw: str) -> Line:
        kept, bound = (self._lines, self.bound) if len(raw) <= _LONG else (self._long, self.long_bound)
        got = kept.get(raw)
        if got is None:
            if len(kept) >= bound:
                kept.clear()
            got = kept[raw] = Line(raw, self)
        return got


def host_key() -> Column:
    """The hash by which the votes know a row's host."""
    return F.xxhash64(F.coalesce("host", F.lit("")))


#: Columns of the digest: the row, its lines one after another, its lines of prose, its marks, and what became of it.
DIGEST = (
    "src string, row_id bigint, host bigint, path bigint, line array<int>, form array<bigint>, key array<bigint>, head array<bigint>, heads array<int>, "
    "prose array<array<bigint>>, unit array<array<bigint>>, clause array<array<bigint>>, unit_form array<bigint>, said array<bigint>, filler boolean, "
    "mark array<bigint>, mark_kind array<int>, mark_in array<bigint>, mark_with array<bigint>, mark_as array<bigint>, damaged boolean, complete boolean, restored string"
)


def digest_of(text: str, known: Lines, garbled: tuple[bool, str, bool]) -> tuple:
    """The digest's columns from ``line`` on, of a restored text."""
    from .residue import marks_of

    flags, forms, keys, heads, counts, prose, units, clauses, unit_forms, said = [], [], [], [], [], [], [], [], set(), []
    filler, of = False, known.of
    for raw in text.split("\n"):
        x = of(raw)
        f = x.flags
        flags.append(f)
        if not f:
            continue
        forms += x.forms
        keys += x.keys
        if x.heads:
            heads += x.heads
            counts += (len(flags) - 1,) * len(x.heads)
        said += x.said
        if f & FILLER:
            filler = True
        elif f & PROSE:
            unit_forms.update(x.unit_forms)
            if not f & BANNER:
                prose.append(x.forms)
                units.append(x.units)
                clauses.append(x.clauses)
    marks = marks_of(text, known)
    damaged, restored, complete = garbled
    return (flags, forms, keys, heads, counts, prose, units, clauses, list(unit_forms), said, filler, *marks, damaged, complete, restored if damaged else None)


def list_array(pa, rows: list, kind):
    """A list array of integer lists, built flat."""
    import itertools

    import numpy as np

    ends = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    flat = np.fromiter(itertools.chain.from_iterable(rows), kind.to_pandas_dtype(), int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def int_lists(column) -> list[list[int]]:
    """The lists of an array of integer lists without nulls; taken value by value they cost ten times as much."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).tolist(), column.offsets.to_numpy().tolist()
    return [flat[a - ends[0] : z - ends[0]] for a, z in zip(ends, ends[1:])]


def to_batch(rows: list[tuple], extra: tuple[tuple[str, object], ...] = ()):
    """A record batch of digest rows, with further columns of the given types behind."""
    import pyarrow as pa

    i64, i32 = pa.int64(), pa.int32()
    names = [c.split()[0] for c in DIGEST.split(", ")]
    cols = list(zip(*rows)) if rows else [()] * (len(names) + len(extra))
    lists = {"line": i32, "form": i64, "key": i64, "head": i64, "heads": i32, "unit_form": i64, "said": i64, "mark": i64, "mark_kind": i32, "mark_in": i64, "mark_with": i64, "mark_as": i64}
    out = []
    for name, col in zip(names, cols):
        if name in lists:
            out.append(list_array(pa, col, lists[name]))
        elif name in ("prose", "unit", "clause"):
            inner = list_array(pa, [x for r in col for x in r], i64)
            ends = [0]
            for r in col:
                ends.append(ends[-1] + len(r))
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner))
        else:
            out.append(pa.array(col, {"row_id": i64, "host": i64, "path": i64}.get(name, pa.bool_() if name in ("filler", "damaged", "complete") else pa.string())))
    return pa.RecordBatch.from_arrays(out + [pa.array(c, k) for c, (_, k) in zip(cols[len(names) :], extra)], names=[*names, *(n for n, _ in extra)])


def few_collections() -> None:
    """The passes make many small objects and no cycles of them: looking for cycles seldom saves a tenth of the time."""
    import gc

    gc.set_threshold(200_000, 50, 50)


def keyed(rows: DataFrame, *more) -> DataFrame:
    """The (src, row_id, host, path, text) of the rows that take part, hosts and paths as hashes."""
    given = rows.where(F.col("row_id").isNotNull() & (F.length("text") > 0))
    return given.select("src", "row_id", host_key().alias("host"), F.xxhash64(F.coalesce("path", F.lit(""))).alias("path"), "text", *more)


def digests(rows: DataFrame, roles: bool = True) -> DataFrame:
    """The digest of every row, stored: the one pass over the texts. Without ``roles`` it lacks what only ``roles_of`` needs."""
    from .encoding import speller_of

    shared = rows.sparkSession.sparkContext.broadcast(speller_of(rows))

    def run(batches):
        from .encoding import repair

        few_collections()
        known, speller = Lines(roles), shared.value
        for b in batches:
            out = []
            for src, row, host, path, text in zip(*(c.to_pylist() for c in b.columns)):
                got = repair(text, speller)
                out.append((src, row, host, path, *digest_of(got[1], known, got)))
            yield to_batch(out)

    return stored(map_arrow(keyed(rows), run, DIGEST))


#: The weight of a page; each of its k fetches has 1/k of it. Divisible by all small k.
ONE_PAGE = 2520


def fillings(digest: DataFrame) -> DataFrame:
    """(form, key, host, pages): on how many pages of a host a form has a filling, in parts of a page (``ONE_PAGE``).

    A page fetched again counts once: its fetches share its weight. So the lines are counted in one aggregate that
    combines before the exchange, and nothing is made distinct first.
    """
    fetched = digest.groupBy("host", "path").agg(F.count(F.lit(1)).alias("fetches"))
    again = stored(fetched.where("fetches > 1"))
    weighed = lookup_join(digest.select("host", "path", "form", "key"), again, ["host", "path"], F.monotonically_increasing_id(), "left")
    weight = F.floor(F.lit(ONE_PAGE) / F.coalesce("fetches", F.lit(1)))
    seen = weighed.select("host", weight.alias("w"), F.explode(F.array_distinct(F.arrays_zip("form", "key"))).alias("p")).select("host", "w", "p.form", "p.key").where("key <> 0")
    return stored(seen.groupBy("form", "key", "host").agg(F.sum("w").alias("pages")))


def host_votes(filled: DataFrame) -> DataFrame:
    """(form, host, pages, fillings) of every host that has the form."""
    return filled.groupBy("form", "host").agg(F.sum("pages").alias("pages"), F.count(F.lit(1)).cast("int").alias("fillings"))


def _kept() -> Column:
    return F.col("fillings") * ONE_PAGE <= KEPT_SHARE * F.col("pages")


class Winners:
    """The furniture forms: ``own`` (host, form, pages, plus) where a host decides by itself, ``shared`` (form) for the
    others; and what they were won from, ``filled`` (form, key, host, pages) and ``votes`` (form, host, pages, fillings).
    """

    def __init__(self, own: DataFrame, shared: DataFrame, filled: DataFrame, votes: DataFrame):
        self.own, self.shared, self.filled, self.votes = own, shared, filled, votes

    def sets(self, limit: int = BROADCAST_ROWS):
        """(shared forms, host -> (furniture here, content here)) where there are at most ``limit`` of them, else None."""
        if self.own.limit(limit + 1).count() + self.shared.limit(limit + 1).count() > limit:
            return None
        own: dict[int, tuple[set, set]] = {}
        for host, form, plus in zip(*(c.to_pylist() for c in self.own.select("host", "form", "plus").toArrow().columns)):
            own.setdefault(host, (set(), set()))[not plus].add(form)
        return frozenset(self.shared.select("form").toArrow().column(0).to_pylist()), own

    def meet(self, forms: DataFrame) -> DataFrame:
        """Adds ``furniture`` to (host, form, …, _at) rows: the host's own decision, else that of all hosts."""
        hit = weighted_join(forms, self.own, ["host", "form"], "pages", "_at", "left") if self.own.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS else forms.join(F.broadcast(self.own), ["host", "form"], "left")
        hit = lookup_join(hit.drop("pages"), self.shared.withColumn("_all", F.lit(True)), ["form"], "_at", "left")
        return hit.withColumn("furniture", F.coalesce("plus", "_all", F.lit(False))).drop("plus", "_all")


def winners(digest: DataFrame, min_pages: int = MIN_PAGES) -> Winners:
    """The votes of all hosts on all forms.

    A host with ``min_pages`` pages of a form decides on it alone. For the others a form is furniture if more than
    half of the hosts with two pages of it keep it, or if its fillings are few for its hosts: a host's one vote is
    divided evenly over its fillings, and the share of a filling that k hosts have counts 1/k, so that a host
    adds 1 at most. Every host has one vote, whatever its pages.
    """
    filled = fillings(digest)
    votes = stored(host_votes(filled))
    told = F.col("pages") >= 2 * ONE_PAGE
    forms = votes.groupBy("form").agg(
        F.sum("pages").alias("pages"), F.count(F.lit(1)).alias("hosts"), F.count_if(told).alias("told"), F.count_if(told & _kept()).alias("kept")
    ).where(F.col("hosts") >= 2)
    several = stored(forms)
    shares = filled.join(several.select("form"), "form", "left_semi").join(votes.select("form", "host", "fillings"), ["form", "host"])
    keys = shares.groupBy("form", "key").agg((F.sum(1 / F.col("fillings")) / F.count(F.lit(1))).alias("share"))
    spread = keys.groupBy("form").agg(F.round(F.sum("share"), 6).alias("spread"))
    by_hosts = (F.col("pages") >= min_pages * ONE_PAGE) & (2 * F.col("kept") > F.col("told"))
    by_all = F.col("spread") <= F.greatest(F.lit(1.1), SHARED_SHARE * F.col("hosts"))
    shared = stored(several.join(spread, "form").select("form", by_hosts.alias("by_hosts"), by_all.alias("by_all")).where("by_hosts or by_all").select("form", "by_all"))
    own = votes.where(F.col("pages") >= min_pages * ONE_PAGE).select("host", "form", "pages", _kept().alias("plus")).join(shared, "form", "left")
    own = own.where(F.when(F.col("plus"), F.col("by_all").isNull()).otherwise(~F.col("by_all"))).select("host", "form", "pages", "plus")
    return Winners(stored(own), shared.select("form"), filled, votes)


class HostForms:
    """The furniture forms of one host: the shared ones with the host's own differences."""

    __slots__ = ("shared", "plus", "minus")

    def __init__(self, shared: frozenset, plus, minus):
        self.shared, self.plus, self.minus = shared, plus, minus

    def __contains__(self, form: int) -> bool:
        return form in self.plus or (form in self.shared and form not in self.minus)


def is_furniture(forms, chrome) -> bool:
    if len(forms) == 1:
        return forms[0] in chrome
    hits = 0
    for form in forms:
        hits += form in chrome
    return bool(hits) and 2 * hits >= len(forms)


#: Roles of lines; those from TITLE on make up the main body.
BLANK, FURNITURE, BANNERED, FILLED, MENU, LINK, BY, TITLE, TEXT, ITEM, OTHER = range(11)


def roles_of(lines: list[int], forms: list[int], keys: list[int], head: list[int], heads: list[int], chrome) -> list[int]:
    """The role of each line of a page by its digest; ``chrome`` knows the furniture forms of the page's host."""
    roles, ends, last = [0] * len(lines), set(), {}
    open_, at, first_prose = [], 0, len(lines)
    for i, f in enumerate(lines):
        n = f >> _PARTS_AT
        if not n:
            continue
        parts = forms[at : at + n]
        at += n
        if is_furniture(parts, chrome):
            roles[i] = FURNITURE
            if n > 1 and not f & PROSE:
                ends.add(keys[at - 1])
        elif f & BANNER:
            roles[i] = BANNERED
        elif f & FILLER:
            roles[i] = FILLED
        elif f & PROSE:
            roles[i] = TEXT
            if first_prose > i:
                first_prose = i
        elif f & CAPS:
            roles[i] = FURNITURE
        else:
            open_.append(i)
            last[i] = keys[at - 1]
    if not open_:
        return roles
    # the title: a marked line, the end of the trail, or the first line of three words above the prose
    title = next((i for i in open_ if lines[i] & HEADED), -1)
    if title < 0 and ends:
        title = next((i for i in open_ if last[i] in ends), -1)
    if title < 0:
        title = next((i for i in open_ if i < first_prose and lines[i] & THREE and not lines[i] & BULLETED), -1)
    if title >= 0:
        roles[title] = TITLE
    if len(open_) > (title >= 0):
        _rest(lines, roles, set(open_), title, dict.fromkeys(i for i, f in zip(heads, head) if f in chrome) if heads else {})
    return roles


def _rest(lines: list[int], roles: list[int], open_: set[int], title: int, headed: dict) -> None:
    opener, since_title, before = 0, 0, BLANK
    for i, f in enumerate(lines):
        role = roles[i]
        if not f >> _PARTS_AT:
            continue
        since_title += i > title >= 0
        if i not in open_ or role == TITLE:
            # a short label of the site opens a list of links to other pages
            opener = f if role == FURNITURE and i > title else 0
            before = role
            continue
        if i < title or (title < 0 and not f & BULLETED and not f & THREE):
            role = MENU
        elif opener & OPENS and not f & ENTRY:
            role = LINK
        elif since_title <= 1 and f & BYLINE:
            role = BY
        elif i in headed:
            role = LINK
        elif f & BULLETED and not f & ENTRY and (before in (FURNITURE, LINK) or f & QUOTED):
            role = LINK
        else:
            role = ITEM if f & (ENTRY | BULLETED) else OTHER
        roles[i] = before = role
