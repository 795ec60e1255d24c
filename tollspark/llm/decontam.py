"""Benchmark decontamination with a generalised suffix automaton.

All test items go into one automaton over their words (lower-cased in A-Z, split at everything in ASCII that is no
letter or digit), which knows every substring of every item and its longest proper suffix in another class. The words
of a document are streamed through it: the state is the longest item substring that ends at the current word. A match
of `window` words or more makes the last `window` words a hit and names the items that have them; an item of fewer words
is hit where it occurs whole. Runs of words without a known word for long enough are skipped, as nothing can match.

The automaton has at most two states per item word and is broadcast. `max_words` bounds the words of one automaton;
a larger benchmark is cut by a hash of its items into several automata, which pass over the documents one after
another, so the result stays whole and a task holds one automaton.

Null texts and ids: a null text has no words; an item without id hits but is not named; documents without id are rows
like any other. Repeated items count once in the names, repeated documents are judged each for itself. An empty
benchmark leaves every document clean.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollspark.llm.common import batches_with, column, staged, widened

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Byte by byte: letters in lower case, digits and all of non-ASCII as they are, the rest a space.
_FLAT = bytes(b + 32 if 65 <= b <= 90 else b if _WORD.match(bytes([b])) else 32 for b in range(256))


def words_of(text: str | bytes | None) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return data.translate(_FLAT).split()


class Automaton:
    """Generalised suffix automaton of items (id, text) with the windows that count as hits."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.window = window
        self.word: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.shortest = window
        coded = []
        for name, text in items:
            line = [self.word.setdefault(word, len(self.word)) for word in words_of(text)]
            if line:
                coded.append((name, line))
                self.shortest = min(self.shortest, len(line))
                last = 0
                for word in line:
                    last = self._extend(last, word)
        # The class of the last `window` words, for every state that is at least as long.
        self.anchor = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            if self.length[state] >= window:
                above = self.link[state]
                self.anchor[state] = self.anchor[above] if self.length[above] >= window else state
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for name, line in coded:
            named = set() if name is None else {name}
            state = 0
            for at, word in enumerate(line):
                state = self.next[state][word]
                if at + 1 >= window:
                    self.items.setdefault(self.anchor[state], set()).update(named)
            if len(line) < window:
                self.short.setdefault(state, {}).setdefault(len(line), set()).update(named)
        # The nearest state on the way to the root, itself included, at which a short item ends.
        self.marked = [-1] * len(self.link)
        if self.short:
            for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                self.marked[state] = state if state in self.short else self.marked[self.link[state]]

    def _add(self, length: int, link: int, out: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(out)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of `target` for the strings that `state` reaches by `word`."""
        copy = self._add(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:  # another item has this already
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        fresh = self._add(self.length[last] + 1, 0, {})
        state = last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = fresh
            state = self.link[state]
        if state != -1:
            target = self.next[state][word]
            exact = self.length[target] == self.length[state] + 1
            self.link[fresh] = target if exact else self._split(state, word, target)
        return fresh

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Spans [begin, end) of hit words in order, not touching each other, and the names of the items hit."""
        spans: list[list[int]] = []
        found: set[str] = set()
        if len(words) < self.shortest or not self.word:
            return spans, found
        codes = np.fromiter(map(self.word.get, words, repeat(-1)), dtype=np.int32, count=len(words))
        known = np.flatnonzero(np.diff(np.r_[False, codes >= 0, False]))
        begins, ends = known[::2], known[1::2]
        long_enough = ends - begins >= self.shortest
        step, link, length, window = self.next, self.link, self.length, self.window
        for begin, end in zip(begins[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
            state = size = 0
            for at, word in enumerate(codes[begin:end].tolist(), begin):
                while state and word not in step[state]:
                    state = link[state]
                    size = length[state]
                following = step[state].get(word)
                if following is None:
                    size = 0
                    continue
                state, size = following, size + 1
                hit = 0
                if size >= window:
                    # The state may be longer than the match; its class of `window` words is the same.
                    found |= self.items[self.anchor[state]]
                    hit = window
                mark = self.marked[state]
                while mark > 0:
                    for span, names in self.short[mark].items():
                        if span <= size:
                            found |= names
                            hit = max(hit, span)
                    mark = self.marked[link[mark]]
                if hit:
                    first = at - hit + 1
                    while spans and first <= spans[-1][1]:
                        first = min(first, spans.pop()[0])
                    spans.append([first, at + 1])
        return spans, found


def automata(items: DataFrame, window: int, max_words: int) -> Iterator[tuple[Automaton, bool]]:
    """One automaton, or several, built one after another, if the items (item_id, text) have more than `max_words`
    words; each with whether it is the last."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = F.length(F.regexp_replace("text", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "w"))  # no fewer than its words
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / max_words))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for i in range(parts):
        rows = items.where(part == i).collect()
        yield Automaton(sorted(((row.item_id, row.text) for row in rows), key=lambda item: (item[0] or "", item[1])),
                        window), i + 1 == parts


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def cut(text: str | bytes | None, spans: list[list[int]], min_words: int) -> str | None:
    """The text without the spans of `min_words` words and more, from their first to their last character."""
    if text is None:
        return None
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    spans = [span for span in spans if span[1] - span[0] >= min_words]
    if spans:
        places = [found.span() for found in _WORD.finditer(data)]
        parts, at = [], 0
        for begin, end in spans:
            parts.append(data[at:places[begin][0]])
            at = places[end - 1][1]
        parts.append(data[at:])
        data = b"".join(parts)
    return data.decode("utf-8", "surrogatepass")


_FOUND = "n_words long, spans array<array<int>>, items array<string>"


def _scanned(documents: DataFrame, items: DataFrame, keep: list[str], window: int, max_words: int,
             min_words: int | None = None) -> DataFrame:
    """Columns by place (c0, c1, ... for `keep`, so that no name of the input can clash), n_words, spans and items; and
    the text without its spans of `min_words` words, if given, cut in the same pass, so that a text is handed over once."""
    spark = documents.sparkSession
    places = [f"c{i}" for i in range(len(keep))]
    rows = documents.select(*[F.col(name).alias(f"c{i}") for i, name in enumerate(keep)],
                            F.col("text").cast("binary").alias("body"))
    rows = rows.select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<int>>").alias("spans"),
                       F.array().cast("array<string>").alias("items"))
    for automaton, last in automata(items, window, max_words):
        held = spark.sparkContext.broadcast(automaton)

        def scan(batches: Iterator[pa.RecordBatch], held=held, last=last) -> Iterator[pa.RecordBatch]:
            def make(batch: pa.RecordBatch) -> dict:
                sizes, spans, items, texts = [], [], [], []
                for body, old_spans, old_items in zip(column(batch, "body"), column(batch, "spans"),
                                                      column(batch, "items"), strict=True):
                    words = words_of(body)
                    new_spans, new_items = held.value.match(words)
                    sizes.append(len(words))
                    spans.append(_merged(old_spans + new_spans))
                    items.append(sorted(new_items.union(old_items)))
                    if last and min_words is not None:
                        texts.append(cut(body, spans[-1], min_words))
                made = {"n_words": pa.array(sizes, pa.int64()), "spans": pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                        "items": pa.array(items, pa.list_(pa.string()))}
                return made | ({"text": pa.array(texts, pa.string())} if last and min_words is not None else {})
            return batches_with(batches, places if last else [*places, "body"], make)

        added = _FOUND + (", text string" if last and min_words is not None else "")
        rows = rows.mapInArrow(scan, widened(rows, places if last else [*places, "body"], added))
        if not last:
            rows = staged(rows, "decontam")
            held.destroy()  # what was found is written: the next automaton takes its place
    return rows


def find(documents: DataFrame, items: DataFrame, keep: list[str], window: int = 10,
         max_words: int = 300_000) -> DataFrame:
    """The columns `keep` of every document (text read as column `text`) with `n_words`, `spans` of hit words and the
    `items` hit, sorted."""
    return _scanned(documents, items, keep, window, max_words).toDF(*keep, "n_words", "spans", "items")


def clean(documents: DataFrame, items: DataFrame, window: int = 10, min_words: int = 1, coverage: float = 0.5,
          max_words: int = 300_000) -> DataFrame:
    """`documents` without the hit spans of at least `min_words` words, and without the documents of whose words more
    than the share `coverage` is hit. Per row: `row`, a struct of the document's columns other than text, its new
    `text`, and `changed`, whether something was cut out."""
    others = [F.col("`" + name.replace("`", "``") + "`") for name in documents.columns if name != "text"]
    rows = documents.select(F.struct(*others).alias("row"), "text")
    found = _scanned(rows, items, ["row"], window, max_words, min_words)
    hit = F.aggregate("spans", F.lit(0), lambda total, span: total + span[1] - span[0])
    return found.where(hit <= coverage * F.col("n_words")).select(
        F.col("c0").alias("row"), "text",
        F.exists("spans", lambda span: span[1] - span[0] >= min_words).alias("changed"))
