"""Evaluation texts that leaked into a corpus (problem 7).

Wu-Manber search over words: the pieces of the test sentences are the patterns, words (without case,
punctuation and look-alike differences) the alphabet, two words a block. The shift table skips positions
where no pattern can end, the bucket of the suffix block selects the patterns, and direct comparison
confirms them. A sentence of n words in which at most one in eight may be replaced is cut into n // 8 + 1
pieces: one of them is left whole in every admissible occurrence, so no occurrence is missed. A confirmed
piece is widened to its sentence, which is compared word by word.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import map_arrow
from .charforms import match_key

#: One word in so many may be replaced.
REPLACED = 8
MIN_SENTENCES = 2
#: Pieces of fewer words than this have a search of their own.
SHORT = 3
#: Characters of test texts held by one search; larger test sets are searched in blocks of this size.
BLOCK_CHARS = 4_000_000

_SENTENCE_END = re.compile(r"(?<=[.!?…])[»”“\")]*\s+")


def words(text: str) -> list[str]:
    return [k for w in text.split() if (k := match_key(w))]


def passage_of(text: str) -> str:
    """The passage of an item: what stands between the instruction and the question, or all of a text of fewer blocks."""
    blocks = [b for b in re.split(r"\n\s*\n", text.strip()) if b.strip()]
    return "\n\n".join(blocks[1:-1]) if len(blocks) >= 3 else text


class _Codes(dict):
    """Codes of the written forms met so far, -1 for one that is no word; emptied when it grows past its bound."""

    bound = 500_000

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, form: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        key = match_key(form)
        code = self[form] = self.vocabulary.get(key, 0) if key else -1
        return code


class WuManber:
    """Multi-pattern search over word sequences. ``patterns`` are tuples of words; ``vocabulary`` may be shared by several searches."""

    def __init__(self, patterns: list[tuple[str, ...]], vocabulary: dict[str, int] | None = None):
        self.patterns = patterns
        self.m = m = min(map(len, patterns), default=1)
        self.b = b = min(2, m)
        self.vocabulary: dict[str, int] = {} if vocabulary is None else vocabulary
        coded = [tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in p) for p in patterns]
        self.default = m - b + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
        self.base = len(self.vocabulary) + 1
        self.codes = _Codes(self.vocabulary)
        for i, p in enumerate(coded):
            for end in range(b, m + 1):
                block = self._block(p, end)
                self.shift[block] = min(self.shift.get(block, self.default), m - end)
            self.buckets[self._block(p, m)].append((i, p))

    def _block(self, p: tuple[int, ...] | list[int], end: int) -> int:
        return p[end - 1] if self.b == 1 else p[end - 2] * self.base + p[end - 1]

    def encode(self, text: str) -> list[int]:
        """Codes of the words of a text: 0 for one that no pattern has; what is no word is left out."""
        return [c for c in map(self.codes.__getitem__, text.split()) if c >= 0]

    def search(self, codes: list[int]) -> Iterator[tuple[int, int]]:
        """(pattern, position of its first word) of every occurrence."""
        n, m, base, single = len(codes), self.m, self.base, self.b == 1
        shift, default, end = self.shift.get, self.default, m
        while end <= n:
            last = codes[end - 1]
            if not last:  # no pattern has this word: none ends within reach of it
                end += m if single else default
                continue
            block = last if single else codes[end - 2] * base + last
            step = shift(block, default)
            if step:
                end += step
                continue
            start = end - m
            for i, p in self.buckets.get(block, ()):
                if codes[start] == p[0] and tuple(codes[start : start + len(p)]) == p:
                    yield i, start
            end += 1


class SentenceIndex:
    """The test sentences of (item id, text) rows and the automaton of their pieces."""

    def __init__(self, items: list[tuple[int, str]]):
        known: dict[tuple[str, ...], int] = {}
        self.items_of: list[dict[int, None]] = []
        for item, text in items:
            for s in _SENTENCE_END.split(passage_of(text or "")):
                if w := tuple(words(s)):
                    k = known.setdefault(w, len(known))
                    if k == len(self.items_of):
                        self.items_of.append({})
                    self.items_of[k][item] = None
        self.sentences = list(known)
        pieces: dict[tuple[str, ...], list[tuple[int, int]]] = defaultdict(list)
        for k, w in enumerate(self.sentences):
            parts = len(w) // REPLACED + 1
            cuts = [len(w) * i // parts for i in range(parts + 1)]
            for a, z in zip(cuts, cuts[1:]):
                pieces[w[a:z]].append((k, a))
        vocabulary: dict[str, int] = {}
        for piece in pieces:
            for w in piece:
                vocabulary.setdefault(w, len(vocabulary) + 1)
        # short pieces are searched by themselves, so that they do not shorten the shifts of the others
        short, long = [p for p in pieces if len(p) < SHORT], [p for p in pieces if len(p) >= SHORT]
        self.engine = WuManber(long, vocabulary)
        self.searches = [(WuManber(ps, vocabulary), [pieces[p] for p in ps]) for ps in (long, short) if ps]
        self.coded = [[self.engine.vocabulary[x] for x in w] for w in self.sentences]

    def found(self, text: str) -> dict[int, int]:
        """Item id to the number of its sentences that the text holds."""
        codes = self.engine.encode(text)
        seen: set[int] = set()
        for engine, places in self.searches:
            for i, start in engine.search(codes):
                for k, offset in places[i]:
                    if k in seen:
                        continue
                    w, at = self.coded[k], start - offset
                    if at >= 0 and at + len(w) <= len(codes) and sum(x != y for x, y in zip(w, codes[at : at + len(w)])) <= len(w) // REPLACED:
                        seen.add(k)
        counts: dict[int, int] = defaultdict(int)
        for k in seen:
            for item in self.items_of[k]:
                counts[item] += 1
        return counts


def _blocks(items: DataFrame, item: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for r in items.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).cast("long"), text).toLocalIterator():
        block.append((r[0], r[1]))
        size += len(r[1])
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaked_items(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", min_sentences: int = MIN_SENTENCES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, n_sentences): documents that hold at least ``min_sentences`` sentences of an item's passage.

    The items are read in blocks of bounded size; each block is searched for in all documents, so that a test
    set of any size is searched whole. Null ids and null texts on either side take no part; a document given
    twice counts once; an empty table on either side gives no rows. Items with one passage each give a case.
    """
    schema = "doc_id bigint, item_id bigint, n_sentences int"
    pairs = docs.where(F.col(doc).isNotNull() & (F.length(text) > 0)).select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"))
    out = None
    for block in _blocks(items, item, item_text, block_chars):
        # built once; its size goes with the block's characters, which are bounded
        shared = docs.sparkSession.sparkContext.broadcast(SentenceIndex(block))

        def search(batches, shared=shared):
            import pyarrow as pa

            index = shared.value
            for b in batches:
                rows = [(d, i, n) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for i, n in index.found(t).items() if n >= min_sentences]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.int32()))], names=["doc_id", "item_id", "n_sentences"])

        part = map_arrow(pairs, search, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return out.groupBy("doc_id", "item_id").agg(F.max("n_sentences").alias("n_sentences"))
