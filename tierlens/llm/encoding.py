"""Text that was decoded with the wrong character encoding (problem 5).

Sequences are computed beforehand for all pairs of encodings and matched by multi-pattern automata; only what
matches is replaced.

* UTF-8 read as a one-byte encoding, once or twice over: the sequence of every character of the repertoire.
* One one-byte encoding read as another: a character turns into another single one, so the sequences are whole
  words. The words are those of all rows of the corpus (``speller_of``); a word is garbled if some pair makes one of them of it.

Beside the sequences, only what no writing system does counts as damage: control characters, signs inside
words, capitals inside small letters, letters of two scripts that nobody confuses, case turned over. A damaged
page tells the pair of encodings that explains most of its damaged words; these words are replaced where the pair
makes sound ones of them, words without a trace stay as they are unless they are known to be garbled. Degree,
section, trade-mark and similar signs, other languages' letters and other scripts are never damage.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Set

from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..runtime import map_arrow, shipped_file, stored

#: In how many rows a word must be for the speller to know it.
SPELLER_MIN = 3

# The letters beyond ASCII of the languages the repertoire covers, and their signs.
LETTERS = "áàâãäåæçéèêëíìîïñóòôõöøœßúùûüýÿ" + "ąćęłńóśźż" + "čďěňřšťůž" + "абвгдежзийклмнопрстуфхцчшщъыьэюяё"
SIGNS = "–—’‘“”„«»…·•›‹©¿¡№" + chr(0xA0)
ONE_BYTE = ("cp1252", "cp1250", "cp1251", "mac_roman", "cp850", "cp437", "iso8859-2", "koi8-r", "cp866", "iso8859-5", "mac_cyrillic")
#: (bytes were written in, bytes were read in) among one-byte encodings, most common first.
WROTE = ("cp1252", "cp1250", "cp1251", "koi8-r", "iso8859-2", "mac_roman", "cp850", "cp866", "iso8859-5", "mac_cyrillic", "cp437")
SWAPS = tuple((a, b) for a in WROTE for b in ONE_BYTE if a != b)
_CYRILLIC_PAGES = frozenset(("cp1251", "koi8-r", "cp866", "iso8859-5", "mac_cyrillic"))


@functools.cache
def repertoire() -> frozenset[str]:
    return frozenset(LETTERS + LETTERS.replace("ß", "").upper() + SIGNS)


def read_as(data: bytes, encoding: str) -> str:
    """Bytes read the way lenient software does: undefined ones become the control character of their number."""
    return "".join(_byte_table(encoding)[b] for b in data)


@functools.cache
def _byte_table(encoding: str) -> tuple[str, ...]:
    return tuple(bytes([b]).decode(encoding, "ignore") or chr(b) for b in range(256))


@functools.cache
def garbled_sequences() -> dict[str, tuple[str, tuple[str, ...], bool]]:
    """Sequence to (original, encodings it was read in, strong?). A weak one could stand in sound text."""
    out: dict[str, tuple[str, tuple[str, ...], bool]] = {}
    for wrong in (*ONE_BYTE, "latin-1"):
        for ch in sorted(repertoire()):
            seq = ch
            for times in range(2):
                seq = read_as(seq.encode("utf-8"), wrong)
                old = out.get(seq)
                names = (*(old[1] if old else ()), wrong * (times + 1))
                if old and old[0] != ch:
                    names = old[1]
                    ch_out = old[0]
                else:
                    ch_out = ch
                strong = any(c not in repertoire() and not (c.isalpha() and c < "Ѐ") for c in seq) or len(seq) > 2 or seq[0] in "ĂĹ" or (seq[0] in "ÃÂâÄÅ" and unicodedata.category(seq[1]) not in ("Lu", "Ll"))
                out[seq] = (ch_out, names, strong)
    return out


@functools.cache
def _sequences():
    import ahocorasick

    a = ahocorasick.Automaton()
    for seq, (ch, names, strong) in garbled_sequences().items():
        a.add_word(seq, (seq, ch, names, strong))
    a.make_automaton()
    return a


@functools.cache
def _swap_tables() -> dict[tuple[str, str], dict[int, str]]:
    """Per pair of one-byte encodings: what was read to what was written."""
    out = {}
    for wrote, read in SWAPS:
        pairs = ((_byte_table(read)[b], _byte_table(wrote)[b]) for b in range(128, 256))
        out[wrote, read] = {ord(was): now for was, now in pairs if was != now}
    return out


def _chars(kind) -> str:
    """The characters beyond ASCII of all one-byte tables that are of a kind, for a character class."""
    return "".join(sorted({re.escape(c) for e in ONE_BYTE for c in _byte_table(e)[128:] if kind(c)}))


def _is_sign(c: str) -> bool:
    return unicodedata.category(c)[0] in "PS" or unicodedata.category(c) == "No"


_QUOTES = "\"'“”„‘’«»‹›`"
# Signs that may stand between two letters of sound text, and beginnings a capital may follow.
JOINERS = "’‘‚ʼ‐‑–—·•°&→←↔×™®©…»«›‹“”„/²³µ±§¢€£¥÷№ªº¿¡"
PREFIXES = "Mc Mac Fitz De Di Da Du Des Del La Le Las Los Lo Van Von Ver Vander St San O D L i e"
_ALL = re.escape("".join(sorted(c for c in map(chr, range(0xC0, 0x530)) if c.isalpha())))
_LETTER = f"A-Za-z{_ALL}"
_LATIN_UP = "".join(c for c in map(chr, range(0xC0, 0x180)) if c.isupper())
_LATIN_LOW = "".join(c for c in map(chr, range(0xC0, 0x180)) if c.islower())
_LATIN_ODD = "".join(c for c in map(chr, range(0xC0, 0x180)) if c.isalpha())
_LOWER, _UPPER = "а-яё", "А-ЯЁ"
# Letters of Cyrillic that no Latin letter looks like.
_PURE_CYRILLIC = "бвгджзийклмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯ"
_INSIDE = _chars(lambda c: (_is_sign(c) or c in "ˆˇ") and c not in JOINERS)
_TURNED = rf"(?<!\w)[{_LOWER}][{_UPPER}]{{2,}}(?!\w)|(?<!\w)[{_LOWER}][{_UPPER}]{{3,}}|(?<=[{_LOWER}])[{_UPPER}](?=[{_LOWER}])"
#: Damage that needs no explanation.
_LOST = re.compile(f"[{chr(0xFFFD)}\x80-\x9f]")
_TRACE = re.compile(
    "|".join(
        (
            f"[{chr(0xFFFD)}\x80-\x9f]",
            f"(?<=[{_LETTER}]{{2}})[{_INSIDE}](?=[{_LETTER}])|(?<=[{_LETTER}])[{_INSIDE}](?=[{_LETTER}]{{2}})",  # a sign inside a word
            f"(?<=[{_LETTER}])[¿¡²³¹µ±§¢€£¥÷№ªº×©»«›‹“„](?=[a-z{_LATIN_LOW}])|(?<=[{_LETTER}]{{2}})°(?=[a-z]{{2}})",  # one that may join words, before a small letter
            f"(?<=[{_LETTER}])[¾½¼¡¿ˆ¨´¸¬¦¤¯˙˛˝](?!\\w)",  # one that ends no word
            f"(?<![\\w’'])[³¹²¾½¼¬¸´¨¤¯](?=[{_LETTER}]{{2}})",  # or begins none
            f"(?<=[a-z])[{_LATIN_UP}](?=[a-z]|(?![\\w’'-]))",  # a capital inside or behind small letters
            _TURNED,  # Cyrillic with its case turned over
            f"(?<=[A-Za-z{_LATIN_ODD}])[{_PURE_CYRILLIC}]|[{_PURE_CYRILLIC}](?=[a-z{_LATIN_ODD}])",  # two scripts in a word
            r"®(?= (?:19|20)\d\d)",
            r"(?:^|(?<=\w\w\w ))[ª∑¬¶∂√╗╖](?= \w\w\w)|(?<=\w\w\w )[ª∑¬¶∂√╗╖](?=\s*$)",  # a sign that stands for a separator
        )
    ),
    re.M,
)
_TURNED_CASE = re.compile(_TURNED)
_MIXED = re.compile(f"[A-Za-z{_LATIN_ODD}][{_LOWER}{_UPPER}]|[{_LOWER}{_UPPER}][a-z{_LATIN_ODD}]|[ВГ][©·«»¬®°]")
#: Letters beyond ASCII in a row, that may have been Cyrillic.
_RUN = re.compile(f"(?<![A-Za-z])[^\x00-\x7f\\s{_LOWER}{_UPPER}–—’‘“”„«»…·•›‹©]{{3,}}(?![A-Za-z])")
_TOKEN = re.compile(r"\S*[^\x00-\x7f]\S*")
_EDGES = ".,;:!?()[]{}\"'“”„«»…*#|/>\\<-–—"
_ONE_SIGN = re.compile(r"[^\x00-\x7f]")
_CYRILLIC = re.compile(f"[{_LOWER}{_UPPER}]")
_VOWEL = re.compile("[аеёиоуыэюяАЕЁИОУЫЭЮЯ]")
_CYRILLIC_WORD = re.compile(rf"[{_UPPER}]?[{_LOWER}]+(?:-[{_UPPER}]?[{_LOWER}]+)*|[{_UPPER}]{{2,}}")
#: Characters that need no closer look: ASCII, and the repertoire without capitals.
_PLAIN = frozenset(map(chr, range(128))) | frozenset(c for c in repertoire() if not (c.isupper() and c < "Ѐ"))
_CAPITALS = frozenset(_LATIN_UP)
_CAPITAL_INSIDE = re.compile(f"[a-z][{_LATIN_UP}]")
_THREE = re.compile(r"[^\x00-\x7f\u0400-\u04ff]{3}")
_CYRILLIC_LETTERS = frozenset("абвгдежзийклмнопрстуфхцчшщъыьэюяАБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ")
#: Letters that western text read as a Central European encoding gets.
_EAST = frozenset("ąćęłńśźżčďěňřšťůž")
#: What the sequences of UTF-8 begin with, among capitals.
_LEADS = frozenset("ÃÂĂÄÅĹÐÑ")
_LEAD_PAIR = re.compile(f"[{''.join(sorted(_LEADS))}][^\x00-\x7f]")
# Accented letters of the languages by how common they are, for ties between encodings.
_COMMON = "éóíáüäöąęłàçãèśżêńñćâôúåøßõìòîïûùœæëź"
#: Runs that were Cyrillic, if they are shorter than LONG_RUN, count from so many on a page.
LONG_RUN, MANY_RUNS = 5, 3


def _is_prefix(line: str, at: int) -> bool:
    """Does a capital at this place follow a beginning such as Mc or De?"""
    return re.search(rf"(?<!\w)(?:{'|'.join(PREFIXES.split())})$", line[max(0, at - 8) : at]) is not None


def _traces(line: str) -> list[tuple[int, int]]:
    """The places of a line that no sound text has."""
    out = []
    for m in _TRACE.finditer(line):
        c = m.group()
        if _example(line, m.start(), m.end(), "x") or (c in _LATIN_UP and _is_prefix(line, m.start())):
            continue
        out.append(m.span())
    return out


def _cyrillic_reading(run: str) -> bool:
    """Does some pair make a Cyrillic word of it, with vowels and with its capitals where they belong?"""
    for (wrote, _), table in _swap_tables().items():
        if wrote in _CYRILLIC_PAGES and all(ord(c) in table for c in run):
            w = run.translate(table)
            if _CYRILLIC_WORD.fullmatch(w) and 0 < len(_VOWEL.findall(w)) < len(w):
                return True
    return False


def _example(line: str, a: int, z: int, ch: str) -> bool:
    """A sequence shown as an example: between quotation marks, or alone with the sound letter alone beside it."""
    before, after = line[a - 1 : a], line[z : z + 1]
    if before and after and before in _QUOTES and after in _QUOTES:
        return ch.isalpha()
    return ch.isalpha() and before.isspace() and after.isspace() and f" {ch} " in line[:a] + line[z:]


@functools.cache
def _unswaps() -> tuple[tuple[frozenset[str], tuple], ...]:
    """By encoding bytes were read in: its characters, and for every one they were written in whether it is
    Cyrillic, its characters, what was read to what was written, and back."""
    out = []
    for read in ONE_BYTE:
        ways = []
        for wrote in (w for w, r in SWAPS if r == read):
            there = _swap_tables()[wrote, read]
            ways.append((wrote in _CYRILLIC_PAGES, frozenset(_byte_table(wrote)), there, {ord(now): chr(was) for was, now in there.items()}))
        out.append((frozenset(_byte_table(read)), tuple(ways)))
    return tuple(out)


_WORDS_OF = re.compile(r"[^\W\d_]+")
_RUNS = re.compile(r"[^\W_]+")


def _words_of(text: str) -> set[str]:
    return {w.lower() for w in _WORDS_OF.findall(text) if not w.isascii()}


def _garbled_commoner(seen: dict[str, int]) -> set[str]:
    """The words of which some pair makes one that more than twice as many rows have."""
    import numpy as np

    lengths: dict[int, list[str]] = {}
    for w in seen:
        lengths.setdefault(len(w), []).append(w)
    out = set()
    for size, words in lengths.items():
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, size)
        alphabet, at = np.unique(codes, return_inverse=True)
        at, many = at.reshape(codes.shape), np.array([seen[w] for w in words])
        factors = np.random.default_rng(size).integers(0, 1 << 63, size, np.uint64)
        keys = (codes.astype(np.uint64) * factors).sum(1)
        ordered, maybe = np.sort(keys), 2 * many < many.max()
        for table in _swap_tables().values():
            now = np.array([ord(table[c]) if c in table else c for c in alphabet.tolist()], np.uint64)
            if (now == alphabet).all():
                continue
            sound = np.array([c < 0x80 or c in table or chr(c) in repertoire() for c in alphabet.tolist()])
            rows = np.flatnonzero(maybe & sound[at].all(1) & (now != alphabet)[at].any(1))
            if len(rows):
                forms = (now[at[rows]] * factors).sum(1)
                # sums only propose
                for r in rows[ordered[np.minimum(np.searchsorted(ordered, forms), len(ordered) - 1)] == forms].tolist():
                    if seen.get(words[r].translate(table), 0) > 2 * many[r]:
                        out.add(words[r])
    return out


def _sound_words(seen: dict[str, int]) -> list[str]:
    """The words without a trace of damage that are no commoner word garbled."""
    garbled = _garbled_commoner(seen)
    return [w for w in seen if w not in garbled and not _traces(w)]


class WordTable(Set):
    """A set of words that no process holds in its memory: their hashes stand in blocks of open addressing, in a file
    that every executor gets once and its workers map. ``table`` (word, h) has the words, for the driver alone.
    """

    #: Places of a block, at least twice its words.
    places = 1 << 17

    def __init__(self, name: str, mask: int, places: int, size: int, table: DataFrame | None = None):
        self.name, self.mask, self.places, self.size, self.table = name, mask, places, size, table
        self._at = None

    def __reduce__(self):
        return WordTable, (self.name, self.mask, self.places, self.size)

    @classmethod
    def of(cls, table: DataFrame) -> WordTable:
        """Of a stored (word, h). The tasks make the blocks; the driver has one partition of them at a time, and writes it to the file."""
        size = table.count()
        places = min(cls.places, 1 << max(10, (2 * size).bit_length()))
        blocks = 1 << max(0, -(-2 * size // places) - 1).bit_length()

        def run(batches):
            import numpy as np
            import pyarrow as pa

            given: dict[int, list[int]] = {}
            for b in batches:
                for block, h in zip(*(c.to_pylist() for c in b.columns)):
                    given.setdefault(block, []).append(h % (1 << 64))
            for block, hashes in given.items():
                if len(hashes) >= places:  # twice as many as a block has by chance
                    raise ValueError(f"{len(hashes)} words in a block of {places} places")
                own = [0] * places
                for h in hashes:
                    k = h % places
                    while own[k]:
                        k = (k + 1) % places
                    own[k] = h
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.array(own, np.uint64).tobytes()])], names=["block", "own"])

        block = F.shiftrightunsigned("h", places.bit_length() - 1).bitwiseAND(F.lit(blocks - 1)).cast("bigint").alias("block")
        made = map_arrow(table.select(block, "h").repartition("block"), run, "block bigint, own binary")

        def write(file):
            file.truncate(8 * blocks * places)
            for block, own in made.toLocalIterator():
                file.seek(8 * block * places)
                file.write(own)

        return cls(shipped_file(table.sparkSession, write), blocks * places - 1, places, size, table)

    def _mapped(self):
        import mmap

        with open(SparkFiles.get(self.name), "rb") as f:
            self._at = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)).cast("Q")
        return self._at

    def __contains__(self, word: str) -> bool:
        at, h = self._at or self._mapped(), _word_hash(word)
        k = h & self.mask
        while got := at[k]:
            if got == h:
                return True
            k = k & -self.places | (k + 1) & (self.places - 1)
        return False

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[str]:
        return (r.word for r in self.table.toLocalIterator())


def _word_hash(word: str) -> int:
    return xxh3_64_intdigest(word) or 1  # 0 is an empty place


class Speller:
    """Words with letters beyond ASCII, and whether a word is one of them garbled by a pair of one-byte encodings."""

    bound = 200_000

    def __init__(self, words: Set[str] = frozenset()):
        self.words = words
        self._told: dict[str, bool] = {}
        self._hidden: dict[str, tuple[str, ...]] = {}

    def __getstate__(self):
        return {"words": self.words}

    def __setstate__(self, state):
        self.__init__(state["words"])

    @classmethod
    def of(cls, texts: list[str], least: int = SPELLER_MIN) -> Speller:
        """The words of ``least`` of the texts."""
        seen: Counter[str] = Counter()
        for t in texts:
            seen.update(_words_of(t))
        return cls.counted({w: n for w, n in seen.items() if n >= least})

    @classmethod
    def counted(cls, seen: dict[str, int]) -> Speller:
        """The words of a table of numbers of rows; those that are a commoner word garbled are left out."""
        return cls(frozenset(_sound_words(seen)))

    def garbled(self, word: str) -> bool:
        """Does some pair garble a known word to this one?"""
        got = self._told.get(word)
        if got is None:
            if len(self._told) >= self.bound:
                self._told.clear()
            got = self._told[word] = not word.isascii() and word.lower() not in self.words and self._explained(word)
        return got

    def _explained(self, word: str) -> bool:
        for known, ways in _unswaps():
            if not known.issuperset(word):
                continue
            for cyrillic, wrote, there, back in ways:
                form = word.translate(there)
                if form == word or cyrillic != bool(_CYRILLIC.search(w := form.lower())) or w not in self.words:
                    continue
                if form in (w, w.capitalize(), w.upper()) and wrote.issuperset(form) and form.translate(back) == word:
                    return True
        return False

    def _suspects(self, token: str) -> tuple[str, ...]:
        """The garbled words of a token that no trace gives away."""
        got = self._hidden.get(token)
        if got is None:
            if len(self._hidden) >= self.bound:
                self._hidden.clear()
            got = self._hidden[token] = tuple(g for g in _RUNS.findall(token) if len(g) > 2 and g.isalpha() and self.garbled(g) and not _TRACE.search(g))
        return got

    def known_garbled(self, text: str) -> bool:
        """Is there a garbled word all of letters, such as no trace gives away?"""
        if not self.words:
            return False
        for token in {t for t in text.split() if not t.isascii()}:
            for g in self._suspects(token):
                for m in re.finditer(rf"(?<![^\W_]){g}(?![^\W_])", text):
                    if not _example(text, m.start(), m.end(), "x"):
                        return True
        return False


_NO_SPELLER = Speller()


def _strong(text: str, a: int, z: int, seq: str, strong: bool) -> bool:
    """May a sequence be taken for damage by itself, where it stands?"""
    before, after = text[a - 1 : a] if a else "", text[z : z + 1]
    if strong:  # but for a word written large
        return not (seq[0] in "ĂĹ" and seq.isupper() and (before.isupper() or after.isupper()))
    if seq[0] < "Ѐ":
        return False
    # a Cyrillic letter with a sign, or two of them at a Latin one
    latin = any(c.isalpha() and c < "Ѐ" for c in (before, after) if c)
    return latin or (not all(c.isalpha() for c in seq) and not _CYRILLIC.match(before))


def _replace_spans(text: str) -> tuple[str, bool, bool]:
    """(text, damaged?, all replaced?): weak sequences go where the page has strong ones of the same encoding."""
    hits = [(end - len(v[0]) + 1, end + 1, v) for end, v in _sequences().iter_long(text)]
    told = [_strong(text, a, z, v[0], v[3]) for a, z, v in hits]
    if not any(told):
        return text, False, True
    known, out, at, damaged, left = None, [], 0, False, False
    for (a, z, (_, ch, names, _)), strong in zip(hits, told):
        start, end = text.rfind("\n", 0, a) + 1, text.find("\n", z)
        end = len(text) if end < 0 else end
        if _example(text[start:end], a - start, z - start, ch):
            continue
        if not strong:
            if known is None:
                known = {n for (x, y, v), s in zip(hits, told) if s and not _example(text, x, y, v[1]) for n in v[2]}
            if not known.intersection(names):
                left = True
                continue
        damaged = True
        out += (text[at:a], ch)
        at = z
    return "".join((*out, text[at:])), damaged, not left


def _core(token: str) -> str:
    return token.strip(_EDGES)


class _Page:
    """The damaged words of a page and the pair of encodings that explains most of them."""

    def __init__(self, text: str, speller: Speller):
        self.lines, self.speller = text.split("\n"), speller
        self.bad: dict[int, list[tuple[int, int, bool]]] = {}  # line: (start, end, damaged?) of its tokens beyond ASCII
        self.lost = self.open = False
        runs = []
        for i, line in enumerate(self.lines):
            if line.isascii():
                continue
            traces = _traces(line)
            tokens = []
            for m in _TOKEN.finditer(line):
                a, z = m.span()
                word = _core(m.group())
                hit = any(a <= x < z for x, _ in traces) or (len(word) > 2 and speller.garbled(word) and not _example(line, a, z, "x"))
                if not hit and (r := _RUN.search(word)) and _cyrillic_reading(r.group()) and not word.lower() in speller.words:
                    runs.append((i, len(tokens), len(r.group())))
                tokens.append((a, z, hit))
            if tokens:
                self.bad[i] = tokens
            self.lost = self.lost or any(_LOST.match(line, x) and line[x] == chr(0xFFFD) for x, _ in traces)
        if len(runs) >= MANY_RUNS or any(n >= LONG_RUN for *_, n in runs):
            for i, k, _ in runs:
                a, z, _ = self.bad[i][k]
                self.bad[i][k] = (a, z, True)
        self.damaged = any(hit for ts in self.bad.values() for *_, hit in ts)

    def _words(self):
        for i, tokens in self.bad.items():
            for a, z, hit in tokens:
                if hit:
                    yield self.lines[i][a:z]

    def _clean(self, word: str) -> bool:
        """Could this be a sound word?"""
        return not _TRACE.search(word) and not _MIXED.search(word) and all(c < "\x80" or c in repertoire() for c in word)

    def _known(self, word: str) -> bool:
        return _core(word).lower() in self.speller.words

    def _rank(self) -> list[tuple[str, str]]:
        words = Counter(w for w in self._words() if chr(0xFFFD) not in w)
        foreign = {c for w in words for c in w if c > "\x7f" and c not in repertoire()}
        codes = {ord(c) for w in words for c in w if c > "\x7f"}
        strange = {ord(c) for c in foreign}
        scores = []
        for n, (pair, table) in enumerate(_swap_tables().items()):
            # a pair that explains less than half of the foreign characters, or changes none, explains no page
            if 2 * len(strange - table.keys()) > len(strange) or codes.isdisjoint(table):
                continue
            good = known = cost = 0
            for w, times in words.items():
                fixed = w.translate(table)
                if fixed != w and self._clean(fixed):
                    good += times
                    known += times * self._known(fixed)
                    cost += sum(_COMMON.find(c) % 60 / 60 if c.islower() and c < "Ѐ" else 0.2 for c, was in zip(fixed, w) if c != was)
            if good:
                scores.append((-known, -good, sum(ord(c) not in table for c in foreign), cost, n, pair))
        scores.sort()
        best = scores[0] if scores else None
        # another pair that explains as much and reads differently leaves the matter open
        self.open = any(s[:2] == best[:2] and any(w.translate(_swap_tables()[s[-1]]) != w.translate(_swap_tables()[best[-1]]) for w in words) for s in scores[1:])
        return [s[-1] for s in scores[:3]]

    def repair(self) -> bool:
        """Replaces what the best pairs make sound; tells whether all damage is gone."""
        ranked = self._rank()
        left = self.lost or self.open
        page_table = _swap_tables()[ranked[0]] if ranked else None
        for i, tokens in self.bad.items():
            line = self.lines[i]
            hits = [line[a:z] for a, z, hit in tokens if hit]
            table = None if hits else page_table
            for pair in ranked if hits else ():
                t = _swap_tables()[pair]
                if sum(self._clean(x := w.translate(t)) and x != w for w in hits) * 2 > len(hits):
                    table = t
                    break
            if table is None:
                left = left or bool(hits)
                continue
            # do some words of the line stand only as they are?
            mixed = any(not hit and (w := line[a:z]) != (x := w.translate(table)) and self._known(w) and not self._known(x) for a, z, hit in tokens)
            out, at = [], 0
            for a, z, hit in tokens:
                w = line[a:z]
                fixed, core = w.translate(table), _core(w)
                if fixed == w:
                    left = left or hit
                    continue
                # without a trace: unknown as it is in a line whose other words were garbled alike, elsewhere known when repaired
                unknown = core.lower() not in self.speller.words or (bool(hits) and not mixed and self._known(fixed))
                weak = unknown and (bool(hits) or self._known(fixed)) or (len(w) == 1 and fixed in SIGNS and w not in SIGNS)
                if (hit or weak) and self._clean(fixed):
                    out += (line[at:a], fixed)
                    at = z
                else:
                    left = left or hit or (unknown and bool(hits or any(c > "\x7f" and c not in repertoire() for c in w)))
            self.lines[i] = "".join((*out, line[at:]))
            left = left or _MIXED.search(self.lines[i]) is not None
        return not left


def _may_be_damaged(text: str, odd: set[str], letters: set[str], speller: Speller) -> bool:
    """A quick look for what traces, runs and garbled words have; most sound texts fail it."""
    if not odd <= _CAPITALS:
        return True
    if odd and (_CAPITAL_INSIDE.search(text) or _THREE.search(text)):
        return True
    if not letters.isdisjoint(_CYRILLIC_LETTERS) and (_TURNED_CASE.search(text) or _MIXED.search(text)):
        return True
    return not letters.isdisjoint(_EAST) and speller.known_garbled(text)


def repair(text: str, speller: Speller = _NO_SPELLER) -> tuple[bool, str, bool]:
    """(damaged, text as far as it can be restored, wholly restored). Sound text comes back as it is."""
    if text.isascii():
        return False, text, False
    letters = set(text)
    odd = letters.difference(_PLAIN)
    if not _may_be_damaged(text, odd, letters, speller):
        if odd.isdisjoint(_LEADS) or not _LEAD_PAIR.search(text):
            return False, text, False
        text, spans, whole = _replace_spans(text)
        return spans, text, spans and whole
    text, spans, whole = _replace_spans(text)
    if not (_TRACE.search(text) or _RUN.search(text) or speller.known_garbled(text)):
        return spans, text, spans and whole
    page = _Page(text, speller)
    if not page.damaged:
        return spans, text, spans and whole
    complete = page.repair()
    # spans of a page that was read wrong as a whole may have matched by chance
    return True, "\n".join(page.lines), complete and whole and not spans


#: Bytes of text looked at together.
_CHUNK = 1 << 22


def _word_counts(batches):
    """(word, n): in how many rows each word with letters beyond ASCII is. Texts stay bytes; only such words are decoded."""
    import numpy as np
    import pyarrow as pa

    ends_word = np.array([c < 128 and not chr(c).isalpha() for c in range(256)])
    seen: Counter[str] = Counter()
    words_of: dict[bytes, tuple[str, ...]] = {}

    def given():
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        seen.clear()
        return out

    def tokens(texts):
        """(row, token) of every stretch between ASCII signs that has a character beyond ASCII."""
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        lo = 0
        while lo < len(texts):  # rows of a few MB together, so that a batch of long texts takes no more memory
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + _CHUNK, "right")) - 1)
            ends = at[lo : hi + 1] - at[lo]
            data = np.frombuffer(raw, np.uint8, int(ends[-1]), int(at[lo])) if ends[-1] else np.zeros(0, np.uint8)
            beyond = np.flatnonzero(data >= 128)
            if len(beyond):
                stops = np.concatenate(([-1], np.flatnonzero(ends_word[data]), [len(data)]))
                row, after = np.searchsorted(ends, beyond, "right") - 1, np.searchsorted(stops, beyond)
                start, end = np.maximum(stops[after - 1] + 1, ends[row]), np.minimum(stops[after], ends[row + 1])
                first, view = np.flatnonzero(np.diff(start, prepend=-1)), memoryview(data)
                for a, z, r in zip(start[first].tolist(), end[first].tolist(), row[first].tolist()):
                    yield lo + r, bytes(view[a:z])
            lo = hi

    for b in batches:
        last, own = -1, set()
        for row, token in tokens(b.column(0).cast(pa.large_string())):
            if row != last:
                seen.update(own)
                last, own = row, set()
            words = words_of.get(token)
            if words is None:
                if len(words_of) >= Speller.bound:
                    words_of.clear()
                words = words_of[token] = tuple(_words_of(token.decode()))
            own.update(words)
        seen.update(own)
        if len(seen) >= Speller.bound:
            yield given()
    if seen:
        yield given()


def _sound_rows(batches):
    """(word, h) of the sound words among the (word, n) of a task."""
    import pyarrow as pa

    seen: dict[str, int] = {}
    for b in batches:
        seen.update(zip(*(c.to_pylist() for c in b.columns)))
    words = _sound_words(seen)
    for a in range(0, len(words), 10_000):
        part = words[a : a + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([(_word_hash(w) + (1 << 63)) % (1 << 64) - (1 << 63) for w in part], pa.int64())], names=["word", "h"])


def speller_of(rows: DataFrame, least: int = SPELLER_MIN) -> Speller:
    """The speller of all rows: the words that ``least`` of them have. Counted and chosen by the tasks; the driver never has them."""
    counted = map_arrow(rows.where(F.length("text") > 0).select("text"), _word_counts, "word string, n bigint")
    common = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    # a word and what any pair makes of it have the same ASCII letters in the same places: they meet in one task
    together = common.repartition(F.regexp_replace("word", r"[^\x00-\x7f]", "?"))
    return Speller(WordTable.of(stored(map_arrow(together, _sound_rows, "word string, h bigint"))))


def damaged_rows(site) -> DataFrame:
    """(src, row_id, restored, complete) of the damaged rows of a ``residue.Site`` without template residue.

    Null and empty texts are sound; a row delivered twice comes out once.
    """
    return site.sound(site.digest.where("damaged").select("src", "row_id", "restored", "complete")).dropDuplicates(["src", "row_id"])
