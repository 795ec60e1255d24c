"""Alignment of two tokenizers' tokens on the same bytes.

Both token lists of a text cover the bytes of a space and the text. Arrays by offset lead from where a token ends to its
index; the offsets in both are where tokens of the two sides end together, and, in order, cut the lists into
groups. Within a group each pair of tokens whose byte ranges overlap is a link. A group's text is its ids, `a1,a2|b1`.

`align` is one narrow pass. `link_counts` counts every pair of ids over the whole corpus. `scored` looks the counts up:
those of the `head` most frequent pairs are broadcast as sorted arrays (their number is the bound), all other pairs of
all documents meet their counts in a join, and are added up per row before rows meet again.

Null and empty texts, and texts whose tokens don't spell the space and the text, have no tokens: zeros and an empty group
text. Repeated rows count as often as they occur. An empty table gives an empty result. Ids and null ids aren't used;
other columns can't clash, as only those of `keep` are returned. Tokenizer files are read where the tasks run.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tollspark.llm.common import batches_with, column, staged, widened

_FOLD = 1 << 20  # pairs folded at a time


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, then 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Texts of these characters alone, without long runs of white space, mean the same to both libraries' patterns, whatever
#: their Unicode version: Latin letters, digits and signs, common punctuation and the euro.
_PLAIN = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]|\\s{1000}")
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """A byte-level BPE from a `tokenizers` file; strings of special tokens inside texts are plain text.

    Where the file's merges make the ids in order, as in vocabularies of ranks, texts of plain characters go through the
    same merges in `tiktoken`, which is several times as fast; all other texts go through `tokenizers`.
    """

    def __init__(self, path: str):
        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = True
        symbols, size = byte_symbols(), self._model.get_vocab_size()
        entries = [self._model.id_to_token(i) or "" for i in range(size)]
        self.pieces = [bytes(symbols[c] for c in e) if all(c in symbols for c in e) else e.encode() for e in entries]
        self._ranked = self._by_rank(json.loads(self._model.to_str()), entries)

    def _by_rank(self, file: dict, entries: list[str]) -> tiktoken.Encoding | None:
        model, before = file["model"], file["pre_tokenizer"] or {}
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        usual = model["type"] == "BPE" and not file["normalizer"] and not model["ignore_merges"] and not model["dropout"] \
            and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if not usual or entries[256:256 + len(merges)] != merges or {len(e) for e in entries[:256]} != {1}:
            return None
        ranks = {piece: i for i, piece in enumerate(self.pieces[:256 + len(merges)])}
        return tiktoken.Encoding("ranked", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        text = " " + text
        if self._ranked and not _PLAIN.search(text):
            return self._ranked.encode_ordinary(text)
        return self._model.encode(text, add_special_tokens=False).ids


class Pieces:
    """A sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self._bytes(self._model.id_to_piece(i)) for i in range(self._model.get_piece_size())]

    @staticmethod
    def _bytes(piece: str) -> bytes:
        single = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece)
        return bytes([int(single[1], 16)]) if single else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> list[int]:
        return self._model.encode(text, num_threads=1)


@dataclass(frozen=True)
class Tokenizers:
    """The two files; a task's process loads them once."""

    byte_level: str = "/opt/tokenizers/byte_bpe_50k.json"
    pieces: str = "/opt/tokenizers/piece_bpe_32k.model"

    def load(self) -> Aligner:
        return _loaded(self)


@lru_cache(maxsize=2)
def _loaded(files: Tokenizers) -> Aligner:
    return Aligner(ByteLevel(files.byte_level), Pieces(files.pieces))


class Aligner:
    def __init__(self, a, b):
        self.a, self.b = a, b
        self._bytes_a, self._bytes_b = a.pieces, b.pieces
        self._length_a, self._length_b = (np.array([len(p) for p in side.pieces], dtype=np.int64) for side in (a, b))
        #: Every id as text with what may follow it: `,` or `|` after an id of a, `,` or `;` after one of b.
        self._text = np.array([f"{i}{mark}".encode() for side, marks in ((a, ",|"), (b, ",;")) for mark in marks
                               for i in range(len(side.pieces))])
        #: The number of a pair is id of a * base + id of b.
        self.base = len(b.pieces)

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Both id lists, empty unless both spell the space and the text."""
        if not text:
            return [], []
        spelled, a, b = (" " + text).encode(), self.a.encode(text), self.b.encode(text)
        if b"".join(map(self._bytes_a.__getitem__, a)) != spelled or b"".join(map(self._bytes_b.__getitem__, b)) != spelled:
            return [], []
        return a, b

    def groups(self, a: list[int], b: list[int]) -> tuple[list[str], np.ndarray]:
        """Texts of the groups, in order, and the numbers of all linked pairs, in any order."""
        if not a:
            return [], np.empty(0, np.int64)
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self._length_a[a]), np.cumsum(self._length_b[b])
        index_a, index_b = np.zeros(ends_a[-1] + 1, np.int32), np.zeros(ends_b[-1] + 1, np.int32)
        index_a[ends_a], index_b[ends_b] = np.arange(1, len(a) + 1), np.arange(1, len(b) + 1)
        ends = np.flatnonzero(index_a | index_b)
        index_a, index_b = index_a[ends], index_b[ends]
        is_a, is_b = index_a > 0, index_b > 0
        both = is_a & is_b
        # Two tokens overlap in one stretch of bytes without an end inside, so each stretch up to the next end is a link.
        links = a[np.cumsum(is_a) - is_a] * self.base + b[np.cumsum(is_b) - is_b]
        # In the text an id of a has the ids of b in earlier groups before it, and an id of b the ids of a up to its own
        # group's.
        last_a, last_b, cuts_a, cuts_b = both[is_a], both[is_b], index_a[both], index_b[both]
        place_a = np.arange(len(a)) + np.append(0, cuts_b)[np.cumsum(last_a) - last_a]
        place_b = np.arange(len(b)) + cuts_a[np.cumsum(last_b) - last_b]
        order, size = np.empty(len(a) + len(b), np.int64), len(self._length_a)
        order[place_a], order[place_b] = a + size * last_a, b + 2 * size + self.base * last_b
        text = self._text[order].tobytes().translate(None, b"\0")
        return text[:-1].decode().split(";"), links


def align(documents: DataFrame, keep: list[str], files: Tokenizers = Tokenizers()) -> DataFrame:
    """The columns `keep` of every row of `documents` (text) with n_a, n_b, n_groups, n_links, the text `groups`, and its
    distinct linked pairs: their numbers `pairs` and how often each occurs, `times`."""
    added = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"

    def make(batch: pa.RecordBatch) -> dict:
        aligner, counts, texts, pairs, times = files.load(), [], [], [], []
        for text in column(batch, "_text"):
            a, b = aligner.tokens(text)
            groups, links = aligner.groups(a, b)
            counts.append((len(a), len(b), len(groups), len(links)))
            texts.append(";".join(groups))
            numbers, often = np.unique(links, return_counts=True)
            pairs.append(numbers)
            times.append(often.astype(np.int32))
        sizes = np.array(counts, dtype=np.int64).reshape(-1, 4)
        ends = pa.array(np.cumsum([0] + [len(p) for p in pairs]), pa.int32())
        return {name: pa.array(sizes[:, i]) for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))} | {
            "groups": pa.array(texts, pa.string()),
            "pairs": pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int64), *pairs])),
            "times": pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *times]))}

    return documents.select(*keep, F.col("text").alias("_text")).mapInArrow(
        lambda batches: batches_with(batches, keep, make, 128), widened(documents, keep, added))


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and times of all pairs of a batch of (pairs, times)."""
    pairs, times = (batch.column(batch.schema.get_field_index(name)) for name in ("pairs", "times"))
    rows = np.repeat(np.arange(batch.num_rows), np.diff(pairs.offsets.to_numpy()))
    return rows, pairs.flatten().to_numpy(), times.flatten().to_numpy()


def link_counts(aligned: DataFrame, files: Tokenizers = Tokenizers()) -> DataFrame:
    """Every pair of the corpus: `pair`, `n`, how many links hold it, and `best`, whether no pair of its second id has
    more. Tasks fold their own pairs before the shuffle."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, often, size = [], [], 0

        def folded() -> pa.RecordBatch:
            distinct, place = np.unique(np.concatenate(numbers), return_inverse=True)
            sums = np.bincount(place, np.concatenate(often), len(distinct)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(sums)], names=["pair", "n"])

        for batch in batches:
            _, pairs, times = _flat(batch)
            numbers.append(pairs)
            often.append(times)
            size += len(pairs)
            if size >= _FOLD:
                part = folded()
                numbers, often, size = [part.column(0).to_numpy()], [part.column(1).to_numpy()], part.num_rows
                if size > _FOLD // 2:  # hardly anything repeats: hand over
                    yield part
                    numbers, often, size = [], [], 0
        if numbers:
            yield folded()

    base = files.load().base
    counts = staged(aligned.select("pairs", "times").mapInArrow(fold, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")), "links")
    # A row per id of the second vocabulary.
    most = counts.groupBy(F.pmod("pair", F.lit(base)).alias("b")).agg(F.max("n").alias("most"))
    return counts.join(most, F.pmod("pair", F.lit(base)) == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _least(counts: DataFrame, head: int) -> int:
    """The smallest count of the head: at most `head` pairs have it or more. Counts are grouped by eighths of powers of
    two, a few hundred rows."""
    eighth = F.floor(F.log2("n") * 8).alias("eighth")
    bins = counts.groupBy(eighth).agg(F.count("*").alias("pairs"), F.min("n").alias("least"), F.max("n").alias("most"))
    least, room = None, head
    for row in sorted(bins.collect(), key=lambda row: -row["eighth"]):
        room -= row["pairs"]
        if room < 0:
            return row["most"] + 1 if least is None else least
        least = row["least"]
    return least or 1


def scored(aligned: DataFrame, counts: DataFrame, keep: list[str], row: str, head: int = 1 << 20) -> DataFrame:
    """The columns `keep` of every row with n_best, its links to a pair that is best, and count_sum, the sum of the counts
    of its links. `row` is a column that names a row. `aligned` and `counts` should be written tables, as both are read
    more than once."""
    least = _least(counts, head)
    table = counts.where(F.col("n") >= least).toArrow().sort_by("pair")
    held = aligned.sparkSession.sparkContext.broadcast(tuple(
        table.column(name).to_numpy() for name in ("pair", "n", "best")))
    added = {"n_best": "long", "count_sum": "long"}

    def find(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the head, and whether the pair is there."""
        own = held.value[0]
        if not len(own):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        place = np.minimum(np.searchsorted(own, pairs), len(own) - 1)
        return place, own[place] == pairs

    def from_head(batch: pa.RecordBatch) -> dict:
        rows, pairs, times = _flat(batch)
        place, there = find(pairs)
        rows, place, times = rows[there], place[there], times[there].astype(np.int64)
        _, n, best = held.value
        sums, bests = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        if len(rows):  # pairs of a row stand together
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            sums[rows[first]] = np.add.reduceat(n[place] * times, first)
            bests[rows[first]] = np.add.reduceat(best[place] * times, first)
        return {"n_best": pa.array(bests), "count_sum": pa.array(sums)}

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pairs, times = _flat(batch)
            left = ~find(pairs)[1]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[left])), pa.array(pairs[left]),
                                              pa.array(times[left])], names=["_row", "_pair", "_times"])

    names = list(dict.fromkeys([row, *keep]))
    found = aligned.select(*names, "pairs", "times").mapInArrow(
        lambda batches: batches_with(batches, names, from_head),
        widened(aligned, names, ", ".join(f"{name} {kind}" for name, kind in added.items())))
    seldom = counts.where(F.col("n") < least)
    if seldom.isEmpty():
        return found.select(*keep, *added)
    # No pair here has more than `least` links, so no key of this join is hot.
    left = aligned.select(F.col(row).alias("_row"), "pairs", "times").mapInArrow(rest, "_row long, _pair long, _times int")
    more = left.join(seldom, F.col("_pair") == F.col("pair")).groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("_times")).otherwise(0)).alias("_best"),
        F.sum(F.col("n") * F.col("_times")).alias("_sum"))
    return found.join(more, F.col(row) == F.col("_row"), "left").select(
        *keep, (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"))
