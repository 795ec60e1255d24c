"""SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint has 64 bits, each the majority of that bit over the XXH64 values of its word shingles (repeats
count). Documents of one fingerprint are folded first, so a group of copies is one row from then on. The fingerprint
is cut into blocks; two fingerprints that differ in at most `distance` bits agree on some choice of `blocks - distance`
blocks, and every such choice is a key. Rows of a key meet in one sorted run, are compared by Hamming distance, and
leave links that connect what is linked; links inside what is connected already are not written, so a group of near
copies costs a number of rows in proportion to its members and no pair of the group is lost to connectivity. A key of
very many fingerprints is cut once more by the same rule: its close pairs agree on `blocks - distance` blocks of the
bits that the key leaves open. With 6 blocks and distance 3 that leaves 18 open bits at most, so a run never has more
than 2^18 fingerprints, whatever the documents are. Components follow by large-star / small-star rounds over the links,
staged in the shared folder.

Nulls count as empty texts; texts without words have fingerprint zero and link like any other. Repeated rows are rows
of their own and land in one component. An id is taken to name one text: if it comes with several, the id may tie their
components. A row without doc_id gets a fingerprint and no component, and links nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollspark.llm.common import batches_with, column, staged, widened

_SEED = 42
_RUN = 64  # runs of a key up to this length are compared pair by pair; longer ones by balls


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every run of `words` words, lower-cased in A-Z and joined by a space; of the whole text if it is
    shorter; none without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    line, span = b" ".join(tokens), min(words, len(tokens))
    size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(size + 1) - 1
    begins = ends - size
    digest = xxhash.xxh64_intdigest
    pairs = zip(begins[:len(tokens) - span + 1].tolist(), ends[span - 1:].tolist(), strict=True)
    return np.array([digest(line[a:b], _SEED) for a, b in pairs], dtype=np.uint64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """Bit b is set if more than half of the shingle hashes have it."""
    hashes = shingle_hashes(text, words)
    counts = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(hashes), 65536):
        part = hashes[begin:begin + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, keep: list[str], words: int = 3) -> DataFrame:
    """The columns `keep` of every row with its `fingerprint` (long, the 64 bits as they are)."""
    def make(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(text, words) for text in column(batch, "_text")], dtype=np.uint64)
        return {"fingerprint": pa.array(found.astype(np.int64))}

    return documents.select(*keep, F.col("text").alias("_text")).mapInArrow(
        lambda batches: batches_with(batches, keep, make), widened(documents, keep, "fingerprint long"))


def _block_masks(blocks: int, distance: int, places: list[int] | None = None) -> list[int]:
    """A mask for every choice of `blocks - distance` blocks, of nearly equal width, of the bits at `places` (all 64)."""
    places = list(range(64)) if places is None else places
    edges = [round(i * len(places) / blocks) for i in range(blocks + 1)]
    single = [sum(1 << at for at in places[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(single, blocks - distance)]


def _finer_masks(mask: int, blocks: int, distance: int) -> list[int]:
    """`mask` together with every choice of blocks of the bits that it leaves open."""
    return [mask | more for more in _block_masks(blocks, distance, [at for at in range(64) if not mask >> at & 1])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _longs(masks: list[int]) -> Column:
    return F.array(*[F.lit(_signed(mask)).cast("long") for mask in masks])


def block_keys(bits: Column, masks: Column) -> Column:
    """Array of (choice, masked bits), one per mask of an array of masks."""
    return F.transform(masks, lambda mask, i: F.struct(i.alias("choice"), bits.bitwiseAND(mask).alias("key")))


def _hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b))


def run_links(bits: np.ndarray, nodes: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect just what Hamming distances up to `distance` connect among the fingerprints of one long run.

    Fingerprints are dealt to balls: each to the first centre within `distance`, or it becomes a centre. A ball is
    connected through its centre. Two balls are compared, member by member, only if their centres are near enough for
    any link and they are not connected yet, and the comparison stops at the first link.
    """
    links, centres, balls, left = [], [], [], np.arange(len(bits))
    while len(left):
        near = _hamming(bits[left], bits[left[0]]) <= distance
        ball = left[near]
        links += [(int(nodes[ball[0]]), int(node)) for node in nodes[ball[1:]]]
        centres.append(left[0])
        balls.append(ball)
        left = left[~near]
    parent = list(range(len(balls)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    middle = bits[np.array(centres)]
    for i in range(len(balls)):
        others = np.nonzero(_hamming(middle[i + 1:], middle[i]) <= 3 * distance)[0] + i + 1
        for j in others.tolist():
            if root(i) == root(j):
                continue
            small, large = sorted((balls[i], balls[j]), key=len)
            for member in small.tolist():
                hit = np.nonzero(_hamming(bits[large], bits[member]) <= distance)[0]
                if len(hit):
                    links.append((int(nodes[member]), int(nodes[large[hit[0]]])))
                    parent[root(j)] = root(i)
                    break
    return links


def _links_of(choice: np.ndarray, key: np.ndarray, bits: np.ndarray, nodes: np.ndarray, distance: int) -> list[tuple]:
    """Links of whole runs of (choice, key), which lie next to each other."""
    fresh = np.r_[True, (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])]
    begins = np.nonzero(fresh)[0]
    sizes = np.diff(np.r_[begins, len(key)])
    found: list[tuple[int, int]] = []
    short = np.repeat(sizes <= _RUN, sizes)
    run = np.cumsum(fresh)
    for shift in range(1, int(min(_RUN, sizes.max())) if len(sizes) else 0):
        near = short[shift:] & (run[shift:] == run[:-shift])
        near &= _hamming(bits[shift:], bits[:-shift]) <= distance
        at = np.nonzero(near)[0]
        found += zip(nodes[at].tolist(), nodes[at + shift].tolist(), strict=True)
    for begin, size in zip(begins[sizes > _RUN].tolist(), sizes[sizes > _RUN].tolist(), strict=True):
        found += run_links(bits[begin:begin + size], nodes[begin:begin + size], distance)
    return found


def _linked(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links of a partition sorted by key. The last run of a batch waits for the next batch."""
    def arrays(batch):
        return [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]

    def emit(parts):
        links = _links_of(parts[0], parts[1], parts[2].view(np.uint64), parts[3], distance)
        a = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a.min(axis=1)), pa.array(a.max(axis=1))], names=["a", "b"])

    waiting: list[list[np.ndarray]] = []  # whole batches that end in the run still open
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = arrays(batch)
        last = (parts[0] != parts[0][-1]) | (parts[1] != parts[1][-1])
        begin = int(np.nonzero(last)[0][-1]) + 1 if last.any() else 0
        same = begin == 0 and waiting and waiting[-1][0][-1] == parts[0][0] and waiting[-1][1][-1] == parts[1][0]
        if same:
            waiting.append(parts)
            continue
        done = [np.concatenate(x) for x in zip(*waiting, [p[:begin] for p in parts], strict=True)]
        if len(done[0]):
            yield emit(done)
        waiting = [[p[begin:] for p in parts]]
    if waiting:
        yield emit([np.concatenate(x) for x in zip(*waiting, strict=True)])


def _in_runs(keyed: DataFrame, distance: int) -> DataFrame:
    """Links of rows (choice, key, fingerprint, node), found run by run."""
    rows = keyed.select("choice", "key", "fingerprint", "node").repartition("choice", "key") \
        .sortWithinPartitions("choice", "key")
    return rows.mapInArrow(lambda batches: _linked(batches, distance), "a long, b long")


def links(nodes: DataFrame, distance: int = 3, blocks: int = 6, hot_rows: int = 20_000) -> DataFrame:
    """Links (a, b), a < b, between the nodes (node long, fingerprint long, distinct) that connect what Hamming
    distances up to `distance` connect. Keys of more than `hot_rows` nodes are cut into finer ones."""
    masks = _block_masks(blocks, distance)
    keyed = nodes.select(F.explode(block_keys(F.col("fingerprint"), _longs(masks))).alias("k"), "fingerprint", "node") \
        .select("k.choice", "k.key", "fingerprint", "node")
    hot = staged(keyed.groupBy("choice", "key").agg(F.count("*").alias("rows")).where(F.col("rows") > hot_rows)
                 .select("choice", "key"), "simhash-hot")
    if hot.isEmpty():
        found = _in_runs(keyed, distance)
    else:
        finer = F.array(*[_longs(_finer_masks(mask, blocks, distance)) for mask in masks])
        cut = keyed.join(hot, ["choice", "key"], "left_semi").select(
            "choice", "fingerprint", "node",
            F.explode(block_keys(F.col("fingerprint"), F.get(finer, F.col("choice")))).alias("k"))
        width = len(masks)  # every mask has as many finer ones
        cut = cut.select((F.col("choice") * width + F.col("k.choice")).alias("choice"), "k.key", "fingerprint", "node")
        found = _in_runs(keyed.join(hot, ["choice", "key"], "left_anti"), distance).union(_in_runs(cut, distance))
    return found.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b): the smallest node reachable, by large-star and small-star
    rounds. Every round is one aggregate and one join per star, staged, so lineage and lost executors cost one round."""
    edges = staged(edges, label)
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")) \
            .select(F.col("least").alias("a"), "b").where(F.col("a") != F.col("b")).distinct()
        # Now every b points at smaller ones only; small-star hangs them all under the smallest of them.
        under = large.groupBy("b").agg(F.min("a").alias("least"))
        small = large.join(under, "b")
        hung = small.select(F.col("least").alias("x"), F.col("a").alias("y")).where(F.col("x") != F.col("y")) \
            .union(under.select(F.col("least").alias("x"), F.col("b").alias("y"))).distinct().toDF("a", "b")
        edges = staged(hung, label)
        # One row (sums modulo 2^64) tells whether the links have changed.
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")) \
        .union(edges.select("a", "a").distinct())


def grouped(documents: DataFrame, words: int = 3, distance: int = 3, blocks: int = 6) -> DataFrame:
    """Per row of `documents` (doc_id an integer): doc_id, fingerprint (long) and component_id."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = staged(fingerprints(rows, ["doc_id"], words), "simhash")
    # A fingerprint is known by the smallest id that has it; from here on it is one row.
    nodes = staged(prints.where(F.col("doc_id").isNotNull()).groupBy("fingerprint").agg(F.min("doc_id").alias("node")),
                   "simhash-nodes")
    found = components(links(nodes, distance, blocks))
    named = nodes.join(found, "node", "left").select("fingerprint", F.coalesce("component", "node").alias("least"))
    # Many copies share a fingerprint: their side of this join is the one that adaptive execution splits.
    return prints.join(named, "fingerprint", "left").select(
        "doc_id", "fingerprint", F.when(F.col("doc_id").isNotNull(), F.col("least")).alias("component_id"))
