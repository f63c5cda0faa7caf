"""One form for text that looks the same (problem 8).

The skeleton follows the confusables procedure: decompose, replace every character by its prototype,
decompose again. The prototypes of widths, blanks, joined forms and invisible signs come from the
character database by rule; only the look-alike letters of Cyrillic and Greek are listed.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import map_arrow, stored, weighted_join

# Letters of Cyrillic and Greek that look like a Latin one, and the Latin letter.
LOOKALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "ӏ": "l", "ү": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Ԍ": "G", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "У": "Y", "Ү": "Y", "Ԛ": "Q", "Ӏ": "I",
    "α": "a", "ϲ": "c", "ι": "i", "ϳ": "j", "ο": "o", "ρ": "p", "ν": "v", "υ": "u", "γ": "y", "ϱ": "p",
    "Α": "A", "Β": "B", "Ϲ": "C", "Ε": "E", "Η": "H", "Ι": "I", "Ϳ": "J", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ζ": "Z",
}
# The same of Armenian, Cherokee and phonetic letters, and hyphens.
LOOKALIKES |= {
    "օ": "o", "ս": "u", "ո": "n", "ց": "g", "հ": "h", "զ": "q", "ɑ": "a", "ɡ": "g", "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "‐": "-", "‑": "-",
}
# signs without ink that are no format characters by category: combining grapheme joiner, fillers, variation selectors
_INVISIBLE_EXTRA = "".join(map(chr, [0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x180F), 0x3164, *range(0xFE00, 0xFE10), 0xFFA0]))
_ZWJ, _KEEP = chr(0x200D), chr(0xE000)
_PICTO = f"{chr(0x2600)}-{chr(0x27BF)}{chr(0xFE0F)}{chr(0x1F000)}-{chr(0x1FAFF)}"
# joiners between pictographs change the picture, so they stay
_JOINED_PICTO = re.compile(f"(?<=[{_PICTO}]){_ZWJ}(?=[{_PICTO}])")


def _prototype(ch: str) -> str | None:
    """The prototype by rule, or None where the character is its own."""
    if unicodedata.category(ch) == "Zs":
        return " "
    if ch in _INVISIBLE_EXTRA or unicodedata.category(ch) == "Cf":
        return ""
    d = unicodedata.decomposition(ch)
    tag, _, rest = d.partition(" ")
    if tag in ("<wide>", "<narrow>", "<font>") or (tag == "<compat>" and 0x2160 <= ord(ch) <= 0x217F) or (tag == "<compat>" and (0xFB00 <= ord(ch) <= 0xFB4F or ch in "ĲĳǄǅǆǇǈǉǊǋǌŉ")):
        return "".join(chr(int(x, 16)) for x in rest.split())
    return None


@functools.cache
def prototypes() -> dict[int, str]:
    """Code point to prototype, for every assigned character that has one."""
    out = {cp: p for cp in range(0x80, sys.maxunicode + 1) if not 0xD800 <= cp < 0xE000 and (p := _prototype(chr(cp))) is not None}
    out |= {ord(a): b for a, b in LOOKALIKES.items()}
    # prototypes that have one themselves
    for cp, p in list(out.items()):
        if len(p) == 1 and ord(p) in out:
            out[cp] = out[ord(p)]
    return out


@functools.cache
def _rare() -> re.Pattern:
    """Finds the characters that need the table, without those of plain accented text."""
    cps = sorted(prototypes())
    spans, start = [], None
    for a, b in zip(cps, [*cps[1:], -1]):
        start = a if start is None else start
        if b != a + 1:
            spans.append(f"{re.escape(chr(start))}-{re.escape(chr(a))}")
            start = None
    return re.compile("[" + "".join(spans) + "]")


def skeleton(text: str) -> str:
    """Decompose, replace by prototypes, decompose again. Equal skeletons look the same; line breaks, case, accents, digits and punctuation stay."""
    if text.isascii():
        return text
    if _ZWJ in text:
        text = _JOINED_PICTO.sub(_KEEP, text)
    text = unicodedata.normalize("NFD", text)
    if _rare().search(text):
        text = unicodedata.normalize("NFD", text.translate(prototypes()))
    return text.replace(_KEEP, _ZWJ)


_WORD = re.compile(rf"[^\W\d_]+(?:[{chr(0x300)}-{chr(0x36F)}]+[^\W\d_]*)*")
_BACK = {b: a for a, b in reversed(list(LOOKALIKES.items())) if "Ѐ" <= a <= "ԯ"}


@functools.cache
def _plain_prototypes() -> dict[int, str]:
    return {cp: p for cp, p in prototypes().items() if chr(cp) not in LOOKALIKES}


def _one_script(m: re.Match) -> str:
    w = m.group()
    if w.isascii():
        return w
    other = [c for c in w if c in LOOKALIKES]
    latin = sum("a" <= c.lower() <= "z" or "À" <= c <= "ɏ" for c in w)
    if not other or not latin:
        return w
    foreign = sum("Ͱ" <= c <= "ԯ" for c in w)
    if foreign == len(other) or latin >= foreign:
        return w.translate({ord(c): LOOKALIKES[c] for c in other})
    return "".join(_BACK.get(c, c) for c in w)


def consistent_form(text: str) -> str:
    """A readable form of the text: composed, one width and kind of blank, no invisible signs, each word in one script."""
    if text.isascii():
        return text
    if _ZWJ in text:
        text = _JOINED_PICTO.sub(_KEEP, text)
    text = unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).translate(_plain_prototypes()))
    return _WORD.sub(_one_script, text).replace(_KEEP, _ZWJ)


_UPPER = {cp: p for cp, p in ((ord(a), b) for a, b in LOOKALIKES.items()) if chr(cp).upper() == chr(cp)}
_LOWER_ONLY = {ord(a): b for a, b in LOOKALIKES.items() if a.lower() == a and LOOKALIKES.get(a.upper(), "").lower() != b}


def match_key(word: str) -> str:
    """A word without case, punctuation and look-alike differences; empty where nothing of it is left."""
    if word.isascii():
        return re.sub(r"[^0-9A-Z]+", "", word.upper())
    w = unicodedata.normalize("NFC", unicodedata.normalize("NFC", word).translate(_plain_prototypes()))
    if any("a" <= c.lower() <= "z" for c in w):
        w = w.translate(_LOWER_ONLY)
    return "".join(c for c in unicodedata.normalize("NFC", w.upper().translate(_UPPER)) if c.isalnum())


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _skeleton_hashes(batches):
    import pyarrow as pa

    for b in batches:
        texts = b.column(1).to_pylist()
        skeletons = [None if t is None else skeleton(t) for t in texts]
        full = [s is not None and bool(s.strip()) for s in skeletons]
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array([_hash(s) if f else None for s, f in zip(skeletons, full)], pa.int64()),
                pa.array([_hash("\0" + s) if f else None for s, f in zip(skeletons, full)], pa.int64()),
                pa.array([_hash(t) if f else None for t, f in zip(texts, full)], pa.int64()),
            ],
            names=["doc", "sk1", "sk2", "th"],
        ).filter(pa.array(full, pa.bool_()))


def skeleton_hashes(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, sk1, sk2, th): 128 bits of each skeleton and 64 of each text; null and blank texts give no row."""
    return map_arrow(df.select(F.col(doc).cast("long").alias("doc"), text), _skeleton_hashes, "doc bigint, sk1 bigint, sk2 bigint, th bigint")


def look_alike_pairs(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: documents that look the same and differ in their characters.

    Skeleton groups with one spelling only are dropped by an aggregate before anything is joined. Pairs are
    made between the spellings (classes of equal characters) and then spread to their documents, so that a
    hot group of exact copies is never paired with itself. Null ids and null or blank texts take no part;
    an id given twice with one text counts once.
    """
    h = stored(skeleton_hashes(df, doc, text).where(F.col("doc").isNotNull()).distinct())
    mixed = h.groupBy("sk1", "sk2").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).where("lo <> hi").select("sk1", "sk2")
    own = h.join(mixed, ["sk1", "sk2"], "left_semi")
    spelled = own.select("sk1", "sk2", "th").distinct()
    a, b = spelled.withColumnRenamed("th", "th_a"), spelled.withColumnRenamed("th", "th_b")
    classes = a.join(b, ["sk1", "sk2"]).where("th_a < th_b")
    left = own.select("sk1", "sk2", F.col("th").alias("th_a"), F.col("doc").alias("x"))
    right = own.select("sk1", "sk2", F.col("th").alias("th_b"), F.col("doc").alias("y"))
    pairs = classes.join(left, ["sk1", "sk2", "th_a"]).join(right, ["sk1", "sk2", "th_b"]).where("x <> y")
    return pairs.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b")).distinct()


def look_alike_classes(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_key, spellings, documents): each document once with the class of texts that look like it.

    ``class_key`` is the 128-bit hash of the skeleton; a class has as many spellings as there are texts in it that
    differ in their characters. Two documents look the same if their classes are equal, so that a hot class needs
    no pairs. Null ids and null or blank texts take no part.
    """
    h = stored(skeleton_hashes(df, doc, text).where(F.col("doc").isNotNull()).distinct())
    spelled = h.groupBy("sk1", "sk2", "th").agg(F.count(F.lit(1)).alias("n"))
    classes = stored(spelled.groupBy("sk1", "sk2").agg(F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("documents")))
    key = F.concat(F.hex("sk1"), F.lit("-"), F.hex("sk2"))
    return weighted_join(h, classes, ["sk1", "sk2"], "documents", "doc", "inner").select(F.col("doc").alias("doc_id"), key.alias("class_key"), "spellings", "documents")


def _forms(batches):
    import pyarrow as pa

    for b in batches:
        texts = b.column(1).to_pylist()
        forms = [None if t is None else consistent_form(t) for t in texts]
        keys = [None if t is None else f"{_hash(skeleton(t)) + (1 << 63):016x}" for t in texts]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(forms, pa.string()), pa.array(keys, pa.string()), pa.array([f is not None and f != t for f, t in zip(forms, texts)], pa.bool_())], names=["doc_id", "form", "skeleton_key", "changed"])


def consistent_forms(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, form, skeleton_key, changed) for every row; a null text has null form and key, a blank one is kept."""
    return map_arrow(df.select(F.col(doc).cast("long").alias("doc_id"), text), _forms, "doc_id bigint, form string, skeleton_key string, changed boolean")
