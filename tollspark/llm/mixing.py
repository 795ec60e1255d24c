"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to. A flow network sends the words of a
pattern to the quotas of its sources: the first pass over a pattern costs nothing and every further pass more, so words
are repeated only where fresh ones are missing, and little of each pattern rather than much of one. The solved flow
says how many words of each pattern the mix takes: some whole passes and a rest, which goes to the documents in the
order of a seeded hash until it is used up, the last of them in part.

Only the patterns with their sizes reach the driver; their number is bounded by `max_patterns`, beyond which `mix`
raises. The documents are never collected: a histogram of 4096 hash buckets per pattern finds the bucket in which the
rest ends, and only the documents of that bucket are sorted.

A null text has size 0. A null source is a source of its own; a document without any source is not taken. Repeated rows
are documents of their own. Without documents the result is empty.
"""

from __future__ import annotations

import json
import math
from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tollspark.llm.common import SPACED_WORD, staged

Source = str | None


def size_of(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def ordered(sources: list[Source]) -> list[Source]:
    """By code point, null last."""
    return sorted(sources, key=lambda source: (source is None, source or ""))


def cycled_weights(sources: list[Source]) -> dict[Source, int]:
    return {source: i % 3 + 1 for i, source in enumerate(ordered(sources))}


def targets(sizes: dict[Source, int], weights: dict[Source, int], total: int, repeats: int) -> dict[Source, float]:
    """Shares of `total` by weight, none above `repeats` times its source; what is cut off is shared again."""
    fixed: dict[Source, float] = {}
    while True:
        free = [source for source in sizes if source not in fixed]
        rest, weight = total - sum(fixed.values()), sum(weights[source] for source in free)
        share = {source: weights[source] * rest / weight if weight else 0.0 for source in free}
        above = [source for source in free if share[source] > repeats * sizes[source]]
        if not above:
            return fixed | share
        fixed |= {source: repeats * sizes[source] for source in above}


class _Network:
    """Arcs in pairs, each beside the one that takes its flow back."""

    def __init__(self, arcs: list[tuple[int, int, int, int]]):
        self.to, self.room, self.price, self.out = [], [], [], {}
        for a, b, capacity, cost in arcs:
            for x, y, c, p in ((a, b, capacity, cost), (b, a, 0, -cost)):
                self.out.setdefault(x, []).append(len(self.to))
                self.to.append(y)
                self.room.append(c)
                self.price.append(p)

    def distances(self, start: int) -> dict[int, int]:
        """Cost of the cheapest way to every node that can still be reached."""
        best, queue, queued = {start: 0}, deque([start]), {start}
        while queue:
            node = queue.popleft()
            queued.discard(node)
            for arc in self.out.get(node, ()):
                other, reach = self.to[arc], best[node] + self.price[arc]
                if self.room[arc] and reach < best.get(other, math.inf):
                    best[other] = reach
                    if other not in queued:
                        queue.append(other)
                        queued.add(other)
        return best

    def levels(self, start: int, cheapest: dict[int, int]) -> dict[int, int]:
        """Number of arcs to every node on ways of least cost."""
        level, queue = {start: 0}, deque([start])
        while queue:
            node = queue.popleft()
            for arc in self.out.get(node, ()):
                other = self.to[arc]
                if self.room[arc] and other not in level and cheapest[other] == cheapest[node] + self.price[arc]:
                    level[other] = level[node] + 1
                    queue.append(other)
        return level

    def block(self, start: int, end: int, cheapest: dict[int, int], level: dict[int, int]) -> None:
        """Fill the ways of least cost and fewest arcs, one after the other, until each has a full arc."""
        tried, path, node = dict.fromkeys(level, 0), [], start
        while True:
            if node == end:
                pushed = min(self.room[arc] for arc in path)
                for arc in path:
                    self.room[arc] -= pushed
                    self.room[arc ^ 1] += pushed
                full = next(i for i, arc in enumerate(path) if not self.room[arc])
                node = self.to[path[full] ^ 1]
                del path[full:]
            arcs = self.out[node]
            while tried[node] < len(arcs):
                arc = arcs[tried[node]]
                other = self.to[arc]
                if self.room[arc] and level.get(other) == level[node] + 1 \
                        and cheapest[other] == cheapest[node] + self.price[arc]:
                    path.append(arc)
                    node = other
                    break
                tried[node] += 1
            else:
                if not path:
                    return
                node = self.to[path.pop() ^ 1]
                tried[node] += 1


def min_cost_flow(arcs: list[tuple[int, int, int, int]], start: int, end: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost) of a largest flow of least cost.

    All ways of one cost are filled together before the next cost, so the number of phases is the number of different
    costs, which the repetition costs keep small however many patterns there are.
    """
    network = _Network(arcs)
    while end in (cheapest := network.distances(start)):
        while end in (level := network.levels(start, cheapest)):
            network.block(start, end, cheapest, level)
    return [network.room[2 * i + 1] for i in range(len(arcs))]


def route(patterns: dict[tuple[Source, ...], int], quotas: dict[Source, int], repeats: int) -> dict[tuple, int]:
    """Words to take of every pattern (its words by pattern), at most `repeats` passes, to fill the quotas."""
    names, sources = list(patterns), list(quotas)
    node = {name: i + 2 for i, name in enumerate(names)} | {("quota", s): len(names) + 2 + i
                                                            for i, s in enumerate(sources)}
    arcs, owner = [], []
    for name in names:
        for again in range(repeats):
            arcs.append((0, node[name], patterns[name], again * again))
            owner.append(name)
    for name in names:
        arcs += [(node[name], node["quota", source], repeats * patterns[name], 0) for source in name]
    arcs += [(node["quota", source], 1, quotas[source], 0) for source in sources]
    taken = dict.fromkeys(names, 0)
    for name, flow in zip(owner, min_cost_flow(arcs, 0, 1), strict=False):
        taken[name] += flow
    return taken


def mix(documents: DataFrame, membership: Column, keep: list[str], repeats: int = 3, seed: str = "mix",
        weights: Callable[[list[Source]], dict[Source, int]] = cycled_weights,
        max_patterns: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Two tables: per document `keep`, `pattern`, `size` and `taken` (words the mix takes, repeats counted); and per
    source `source`, `source_size` and `target`. `membership` is an array of sources; a source may be null."""
    spark = documents.sparkSession
    order = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = documents.select(*[F.col(name).alias(f"c{i}") for i, name in enumerate(keep)],
                            F.coalesce(F.to_json(F.array_sort(F.array_distinct(membership))), F.lit("[]")).alias("pattern"),
                            size_of(F.col("text")).alias("size"), order.alias("h"))
    rows = staged(rows.withColumn("bucket", F.substring("h", 1, 3)), "mix")
    found = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(max_patterns + 1).collect()
    found.sort(key=lambda row: row.pattern)  # of several flows of least cost, reruns choose the same
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; group rare sources first")
    sizes = {tuple(json.loads(row.pattern)): row.size for row in found}
    text = {tuple(json.loads(row.pattern)): row.pattern for row in found}
    sources = ordered(list({source for pattern in sizes for source in pattern}))
    by_source = {s: sum(size for pattern, size in sizes.items() if s in pattern) for s in sources}
    total = sum(size for pattern, size in sizes.items() if pattern)
    wanted = targets(by_source, weights(sources), total, repeats)
    taken = route({p: size for p, size in sizes.items() if p}, {s: int(wanted[s] + 0.5) for s in sources}, repeats)
    cuts = [(text[p], taken.get(p, 0) // size if size else 0, taken.get(p, 0) % size if size else 0)
            for p, size in sizes.items()]
    cuts = F.broadcast(spark.createDataFrame(cuts, "pattern string, passes long, rest long"))
    per_source = spark.createDataFrame([(s, by_source[s], float(wanted[s])) for s in sources],
                                       "source string, source_size long, target double")
    # Words of the buckets before each bucket: 4096 rows of a pattern at most.
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("words")) \
        .withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    ends = buckets.join(cuts, "pattern").where("before < rest and before + words >= rest") \
        .select("pattern", F.col("bucket").alias("last"), "before")
    ends = F.broadcast(spark.createDataFrame(ends.collect(), ends.schema))  # a row per pattern at most
    placed = rows.join(cuts, "pattern").join(ends, "pattern", "left")
    whole = placed.where("last is null or bucket != last").withColumn(
        "part", F.when(F.col("bucket") < F.col("last"), F.col("size")).otherwise(0))
    within = Window.partitionBy("pattern").orderBy("h", "size", *[f"c{i}" for i in range(len(keep))]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(within), F.lit(0))
    split = placed.where("bucket = last").withColumn("part", F.least(F.greatest(left, F.lit(0)), F.col("size")))
    chosen = whole.unionByName(split).select(
        *[f"c{i}" for i in range(len(keep))], "pattern", "size",
        (F.col("passes") * F.col("size") + F.col("part")).cast("long").alias("taken"))
    return chosen.toDF(*keep, "pattern", "size", "taken"), per_source
