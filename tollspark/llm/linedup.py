"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line is its words (runs without ASCII white space); the unit of an edit is a word. A line is removed if an earlier
one, in the order of (doc_id, position), has the same words or, from `min_words` words on, lies within one inserted,
deleted or replaced word of it. Whether the earlier line is itself removed doesn't matter, so the result depends on no
order of work.

1. Equal lines are folded to their first place, which leaves one row per distinct line however often it occurs.
2. Two distinct lines within one edit agree on their first half or on their last half. Only lines that share a half
   with another line go on, and only with the gaps in the other half.
3. They emit the hashed variants of their deletion neighbourhood: for every gap, the words before it and the words
   after it, once with the word at the gap left out and once with nothing left out. Lines that share a variant are all
   within one edit of each other (a replaced word if both left one out, an inserted one otherwise), so the first line of
   a variant stands for all earlier ones: each line joins one row per variant, and a variant that very many lines
   share makes no pairs among them.
4. The pairs (line, first line) are verified on their words, and the removed lines go from their documents.

Blank lines are never removed. Null texts have no lines and stay null. An id is taken to name one text; repeated rows
keep the same lines. Rows without doc_id are passed through and stand in nobody's way. A document whose lines all go
keeps an empty text. Only `doc_id` and `text` are read; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollspark.llm.common import SPACES, bounded, staged

#: Rows up to which a written side is broadcast (a row has under 100 bytes); beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
_PLACES = 1 << 31
_BLANKS = " \t\n\x0b\f\r"


def _normal(line: Column) -> Column:
    """Words of a line with one space between them; an empty string for a blank line. Most lines are that already, which a
    search for the bytes finds out; a pattern runs over the others only."""
    line = F.btrim(line, F.lit(_BLANKS))
    odd = F.contains(line, F.lit("  "))
    for blank in _BLANKS[1:]:
        odd = odd | F.contains(line, F.lit(blank))
    return F.when(odd, F.regexp_replace(line, SPACES, " ")).otherwise(line)


def _place(doc_id: Column, position: Column) -> Column:
    """(doc_id, position) as one number in the same order, which a hash aggregate can take the minimum of."""
    return doc_id.cast("decimal(19,0)") * F.lit(_PLACES).cast("decimal(10,0)") + position.cast("decimal(10,0)")


def _home(place: Column) -> Column:
    return F.floor(place / F.lit(_PLACES).cast("decimal(10,0)")).cast("long")


def _lines(documents: DataFrame) -> DataFrame:
    """(place, line) of every line that isn't blank, with one space between its words."""
    rows = documents.where(F.col("doc_id").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.where(F.btrim("line", F.lit(_BLANKS)) != "") \
        .select(_place(F.col("doc_id"), F.col("pos")).alias("place"), _normal(F.col("line")).alias("line"))


def _halves(line: Column, n: Column) -> list[Column]:
    """Hashes of the first m and the last m words, for m = floor(n/2) and m = floor((n-1)/2).

    Two lines of n and n or n+1 words within one edit share one of them with m = floor(n/2): if the edit is at word m
    or later the first m agree, otherwise the last m, as n - m >= m.
    """
    found = []
    for m in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        found += [F.xxhash64(F.lit("first"), m, F.call_function("substring_index", line, F.lit(" "), m)),
                  F.xxhash64(F.lit("last"), m, F.call_function("substring_index", line, F.lit(" "), -m))]
    return found


def distinct_lines(documents: DataFrame) -> DataFrame:
    """One row per distinct line: h1, h2, place (the first), n (its words) and the hashes of its halves."""
    line = F.col("line")
    lines = _lines(documents).select(
        "place", "line", (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1).alias("n"),
        F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))
    # For odd n the second two are the first two again, and are left out.
    halves = [(half if i < 2 else F.when(F.col("n") % 2 == 0, half)).alias(f"k{i}")
              for i, half in enumerate(_halves(line, F.col("n")))]
    return lines.select("h1", "h2", "place", "n", *halves).groupBy("h1", "h2").agg(
        F.min("place").alias("place"), *[F.min(name).alias(name) for name in ("n", "k0", "k1", "k2", "k3")])


def _join_checked(left: DataFrame, written: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    return left.join(F.broadcast(written) if bounded(written, BROADCAST_ROWS) else written, on, how)


def _candidates(documents: DataFrame, distinct: DataFrame, min_words: int) -> DataFrame:
    """Lines that share a half with another distinct line: place, n, words and the gaps (low..high) that remain."""
    long_lines = distinct.where(F.col("n") >= min_words)
    # k0 and k1 are the halves for floor(n/2), k2 and k3 those for floor((n-1)/2), null for odd n.
    even = F.col("n") % 2 == 0
    halves = F.array(F.struct(F.col("k0").alias("key"), F.lit(True).alias("front")),
                     F.struct(F.col("k1").alias("key"), F.lit(False).alias("front")))
    more = F.array(F.struct(F.col("k2").alias("key"), F.lit(True).alias("front")),
                   F.struct(F.col("k3").alias("key"), F.lit(False).alias("front")))
    keyed = long_lines.select("place", "n", F.explode(F.when(even, F.concat(halves, more)).otherwise(halves)).alias("k"))
    keyed = keyed.select("place", "n", "k.key", "k.front")
    shared = staged(keyed.groupBy("key").agg(F.count("*").alias("lines")).where("lines > 1").select("key"), "halves")
    # The shorter half fixes the gaps: after a common front they lie at floor((n-1)/2) or later, before a common end at
    # n - floor((n-1)/2) or earlier.
    m = F.floor((F.col("n") - 1) / 2).cast("int")
    gaps = _join_checked(keyed, shared, ["key"]).groupBy("place", "n").agg(
        F.min(F.when(F.col("front"), m).otherwise(0)).alias("low"),
        F.max(F.when(F.col("front"), F.col("n")).otherwise(F.col("n") - m)).alias("high"))
    gaps = staged(gaps.withColumn("doc_id", _home(F.col("place"))), "gaps")
    # The words come from the documents again, which is less to move than all lines with their words.
    homes = staged(gaps.select("doc_id").distinct(), "homes")
    few = _join_checked(documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text"), homes, ["doc_id"])
    found = _join_checked(_lines(few), gaps.drop("doc_id"), ["place"]).dropDuplicates(["place"])
    return staged(found.select("place", F.split("line", " ").alias("words"), "n", "low", "high"), "candidates")


def _hashed(candidates: DataFrame) -> DataFrame:
    """Running hashes of the words from the front and from the back, written once since variants are made twice."""
    def running(words: Column) -> Column:
        return F.aggregate(words, F.array(F.lit(0).cast("long")),
                           lambda seen, word: F.concat(seen, F.array(F.xxhash64(F.element_at(seen, -1), word))))

    return staged(candidates.select("place", "n", "low", "high", running(F.col("words")).alias("front"),
                                    F.reverse(running(F.reverse("words"))).alias("back")), "hashed")


def variants(hashed: DataFrame) -> DataFrame:
    """(place, before, after) for every hashed variant: running hashes of the words before and after a gap, with the
    word at the gap left out or not. Lines of different lengths meet where the words around the gap are the same."""
    n = F.col("n")
    gaps = hashed.select("place", "n", "front", "back", F.explode(F.sequence("low", "high")).alias("gap"))
    both = gaps.select("place", F.element_at("front", F.col("gap") + 1).alias("before"), F.explode(F.array(
        F.element_at("back", F.col("gap") + 1),
        F.when(F.col("gap") < n, F.element_at("back", F.least(F.col("gap") + 2, n + 1))))).alias("after"))
    return both.where(F.col("after").isNotNull())


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether the word arrays differ by at most one inserted, deleted or replaced word: what is common at the front
    and at the end covers all words of the longer but one."""
    def common(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(differs == 0, F.least(F.size(x), F.size(y))).otherwise(differs - 1)
    return common(a, b) + common(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def near_lines(candidates: DataFrame) -> DataFrame:
    """Places of the candidates that have an earlier line within one edit."""
    every = variants(_hashed(candidates))
    first = staged(every.groupBy("before", "after").agg(F.min("place").alias("first"), F.max("place").alias("last"))
                   .where("first < last").drop("last"), "variants")
    pairs = _join_checked(every, first, ["before", "after"]).where("first < place").select("place", "first").distinct()
    words = candidates.select("place", "words")
    return pairs.join(words, "place") \
        .join(words.select(F.col("place").alias("first"), F.col("words").alias("first_words")), "first") \
        .where(within_one_edit(F.col("words"), F.col("first_words"))).select("place").distinct()


def dedup_lines(documents: DataFrame, min_words: int = 8) -> DataFrame:
    """Per row of `documents`: `row` (the row as it was, a struct, so that no name of its columns can clash), `text`
    without the removed lines, `lines` and `kept`, the numbers of lines."""
    distinct = staged(distinct_lines(documents), "lines")
    near = staged(near_lines(_candidates(documents, distinct, min_words)), "near-lines")
    left = _join_checked(distinct.select("place"), near, ["place"], "left_anti")
    left = left.withColumn("home", _home(F.col("place")))
    position = (F.col("place") - _place(F.col("home"), F.lit(0))).cast("int")
    kept = left.select("home", position.alias("position")).groupBy("home") \
        .agg(F.collect_list("position").alias("places"))  # at most the lines of one document
    rows = documents.select(F.struct("*").alias("row"))
    rows = rows.join(kept, F.col("row.doc_id").cast("long") == F.col("home"), "left")
    lines = F.split("row.text", "\n")
    blank = F.filter(F.transform(lines, lambda line, i: F.when(F.btrim(line, F.lit(_BLANKS)) == "", i)),
                     lambda i: i.isNotNull())
    places = F.array_sort(F.concat(F.coalesce("places", F.array().cast("array<int>")), blank))
    places = F.when(F.col("row.doc_id").isNull(), F.transform(lines, lambda line, i: i)).otherwise(places)
    rows = rows.select("row", lines.alias("split"), places.alias("places"))
    # `get` gives null out of bounds, which only an id with several texts can meet.
    return rows.select("row", F.when(F.col("split").isNotNull(), F.array_join(
        F.transform("places", lambda i: F.get("split", i)), "\n")).alias("text"),
        F.coalesce(F.size("split"), F.lit(0)).cast("long").alias("lines"),
        F.when(F.col("split").isNotNull(), F.size("places")).otherwise(0).cast("long").alias("kept"))
