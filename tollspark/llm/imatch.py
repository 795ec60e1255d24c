"""Document fingerprints by I-Match, in DataFrame operations only.

Terms are runs of letters and digits, lower-cased. The lexicon has the terms whose inverse document frequency,
ln(documents / documents with the term), lies within a band; a common bound on the frequent side drops function words,
the bound on the rare side drops names and noise and bounds the lexicon: terms that a share `rarest` of the documents
have at least are at most (mean distinct terms of a document / rarest) in number, however large the corpus. That number
is checked before the lexicon is broadcast; beyond `BROADCAST_TERMS` the join shuffles.

A document's distinct terms in the lexicon are sorted (by their 64-bit hash, the canonical order) and every randomised
subset of the lexicon hashes those that belong to it. Subsets come in levels: at level b a term belongs to one of
2^b subsets by bits of its hash. All are used at the level of 64 subsets, so that every term has a part in every
fingerprint, and 32, spread evenly, at the finer levels; coarse levels tell copies from near copies and fine
ones tell how much two documents share, whatever their length. The fingerprint writes one hash per subset, or `-` for a
subset without terms; likeness is the share of equal hashes among the subsets that either document fills.

Texts with fewer than `_FEW` terms in the band (all terms rare, or all in very many documents, as those of a large group
of copies) have the same levels of hashes over all their terms behind those of the band, and two such texts are compared
by them.

Null and empty texts have no terms; two documents without any terms have equal fingerprints and likeness 1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tollspark.llm.common import bounded, staged

BROADCAST_TERMS = 2_000_000
#: (bits of the level, subsets used)
LEVELS = ((4, 16), (6, 64), (8, 32), (10, 32), (12, 32))
#: The coarsest level is written for documents of up to so many terms; for longer ones all its subsets differ anyway.
_SHORT = 64
_EMPTY = "-"
_FEW = 8


def terms_of(text: Column) -> Column:
    """Distinct terms; the empty string may be among them."""
    return F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"))


def hashed_terms(rows: DataFrame, keys: list[str], outer: bool) -> DataFrame:
    """(keys, term) with a row per distinct term of `text`; a term is known by its 64-bit hash. With `outer`, rows
    without terms have one null."""
    explode = F.explode_outer if outer else F.explode
    words = rows.select(*keys, explode(terms_of(F.col("text"))).alias("word"))
    return words.select(*keys, F.when(F.col("word") != "", F.xxhash64("word")).alias("term"))


def lexicon(texts: DataFrame, rarest: float, commonest: float) -> DataFrame:
    """(term) of the terms whose share of the documents of `texts` (text) lies within [rarest, commonest]."""
    total = texts.count()
    counted = hashed_terms(texts, [], outer=False).where("term is not null") \
        .groupBy("term").agg(F.count("*").alias("documents"))
    idf = F.log(F.lit(float(max(total, 1))) / F.col("documents"))
    return staged(counted.where(idf.between(-math.log(commonest), -math.log(rarest))).select("term"), "lexicon")


def _number(h: Column, bits: int) -> Column:
    """The highest bits of a hash number its subset."""
    return F.shiftrightunsigned(h, 64 - bits).cast("int")


def _numbers(hashes: Column, bits: int) -> Column:
    return F.transform(hashes, lambda h: _number(h, bits))


def _of_level(hashes: Column, bits: int, used: int) -> Column:
    """Hashes of the subsets used, which are spread evenly over all numbers."""
    return F.filter(hashes, lambda h: _number(h, bits) % (2 ** bits // used) == 0)


def _subsets(hashes: Column, numbers: Column, back: Column, bits: int, used: int) -> Column:
    """One hash per subset of a level. In the sorted hashes those of a subset lie side by side, so a subset is a slice
    from the first to the last place of its number; `back` has the numbers from the end."""
    def hashed(subset: Column) -> Column:
        first = F.array_position(numbers, subset).cast("int")
        last = F.size(numbers) + 1 - F.array_position(back, subset).cast("int")
        part = F.xxhash64(F.slice(hashes, first, last - first + 1))
        return F.when(first > 0, F.substring(F.hex(part), -6, 6)).otherwise(_EMPTY)
    return F.transform(F.sequence(F.lit(0), F.lit(2 ** bits - 1), F.lit(2 ** bits // used)), hashed)


def likeness(a: Column, b: Column) -> Column:
    """The largest share, over the levels, of equal hashes among the subsets that either fingerprint fills; levels with
    fewer than `_FEW` filled ones say little and count as if they had that many. Where both fingerprints have the hashes
    of all terms too, those are compared instead. 1 for equal fingerprints."""
    left, right = F.split(a, " "), F.split(b, " ")

    def largest(begin: int) -> Column:
        shares = []
        for _, used in LEVELS:
            pairs = F.arrays_zip(F.slice(left, begin, used).alias("a"), F.slice(right, begin, used).alias("b"))
            filled = F.size(F.filter(pairs, lambda p: (p.a != _EMPTY) | (p.b != _EMPTY)))
            equal = F.size(F.filter(pairs, lambda p: (p.a != _EMPTY) & (p.a == p.b)))
            shares.append(equal / F.greatest(filled, F.lit(_FEW)))
            begin += used
        return F.greatest(*shares)

    band = sum(used for _, used in LEVELS)
    both = F.least(F.size(left), F.size(right)) > band
    return F.when(a == b, F.lit(1.0)).when(both, largest(band + 1)).otherwise(largest(1))


def fingerprints(rows: DataFrame, keys: list[str], terms: DataFrame) -> DataFrame:
    """(keys, fingerprint) for every row of `rows` (keys, text). The terms are exploded, met with the written lexicon
    and gathered again by the keys, on which `rows` should be dealt already: then no text moves."""
    known = terms.withColumn("in_band", F.col("term"))
    if bounded(terms, BROADCAST_TERMS):
        known = F.broadcast(known)
    met = hashed_terms(rows, keys, outer=True).join(known, "term", "left")
    # Nulls are left out by collect_list, so a document without terms in the band has an empty array.
    sets = met.groupBy(*keys).agg(F.sort_array(F.collect_list("in_band")).alias("band"),
                                  F.collect_list(F.when(F.col("in_band").isNull(), F.col("term"))).alias("outside"))
    few = (F.size("band") < _FEW) & (F.size("band") + F.size("outside") > 0)
    sets = sets.select(*keys, "band", F.when(few, F.sort_array(F.concat("band", "outside"))).alias("all"))
    sets = _levels(sets, keys + ["all"], "band").withColumnRenamed("written", "of_band")
    every = _levels(sets, keys + ["of_band"], "all")
    # concat_ws leaves out the null of documents that have enough terms in the band.
    return every.select(*keys, F.concat_ws(" ", "of_band", "written").alias("fingerprint"))


def _levels(sets: DataFrame, keep: list[str], hashes: str) -> DataFrame:
    """The columns `keep` and `written`, the hashes of all subsets of the sorted array `hashes`; null for a null."""
    # The subsets used at a level have part of the terms of those used at the level before.
    for i, level in enumerate(LEVELS):
        sets = sets.withColumn(f"level{i}", _of_level(F.col(f"level{i - 1}" if i > 1 else hashes), *level))
    sets = sets.withColumn("level0", F.when(F.size(hashes) <= _SHORT, F.col("level0"))
                           .otherwise(F.array().cast("array<long>")))
    sets = sets.select("*", *[_numbers(F.col(f"level{i}"), bits).alias(f"number{i}")
                              for i, (bits, _) in enumerate(LEVELS)])
    sets = sets.select("*", *[F.reverse(f"number{i}").alias(f"back{i}") for i in range(len(LEVELS))])
    written = [_subsets(F.col(f"level{i}"), F.col(f"number{i}"), F.col(f"back{i}"), *level)
               for i, level in enumerate(LEVELS)]
    return sets.select(*keep, F.when(F.col(hashes).isNotNull(), F.array_join(F.concat(*written), " ")).alias("written"))


def neighbours(documents: DataFrame, per_partition: int = 4) -> DataFrame:
    """(block, at, doc_id, text, other) of every document: `other` is the text of the next document in descending order
    of doc_id (nulls last), of the first one after the last.

    The order is cut into blocks at quantiles of doc_id, and each block also gets the row that follows its last, so
    every block is put in order by itself.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", "text")
    blocks = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)], 10 * blocks)).first()[0]
    cuts = sorted(set(cuts or []))
    # Blocks count from 0 at the smallest ids; null ids stand below all.
    block = F.size(F.filter(F.expr(f"array({', '.join(f'{cut}L' for cut in cuts)})"), lambda cut: cut <= F.col("doc_id"))) \
        if cuts else F.lit(0)
    rows = rows.withColumn("block", F.when(F.col("doc_id").isNull(), 0).otherwise(block))
    firsts = rows.groupBy("block").agg(F.max("doc_id").alias("first")).collect()  # one row per block
    filled = sorted(row.block for row in firsts)
    first = {row.block: row.first for row in firsts}
    # The row after the last of a block is the first of the filled block below; the lowest is followed by the highest.
    follows = [(block, first[filled[i - 1]]) for i, block in enumerate(filled)]
    halo = spark.createDataFrame(follows, "to_block int, first long")
    extra = rows.join(F.broadcast(halo), F.col("doc_id").eqNullSafe(F.col("first"))) \
        .select("doc_id", "text", F.col("to_block").alias("block"))
    both = rows.withColumn("halo", F.lit(0)).unionByName(extra.withColumn("halo", F.lit(1)))
    order = Window.partitionBy("block").orderBy("halo", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    return both.select("block", "doc_id", "text", "halo", F.row_number().over(order).alias("at"),
                       F.lead("text").over(order).alias("other"))


def compared(documents: DataFrame, rarest: float = 0.0005, commonest: float = 0.2) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, the fingerprints of its text and of its edited text, and their
    likenesses: near_edited, and near_next with the next document. In the edited text the last floor(n/2) code points
    are replaced by the first as many of the next document."""
    terms = lexicon(documents.select("text"), rarest, commonest)
    rows = neighbours(documents)
    text, other = F.coalesce("text", F.lit("")), F.coalesce("other", F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    edited = F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(other, F.lit(1), half))
    rows = rows.select("block", "at", "halo", "doc_id", text.alias("text"), edited.alias("edited"))
    about = rows.select("block", "at", "halo", "doc_id", F.char_length("text").cast("long").alias("n_chars"),
                        F.sha2("edited", 256).alias("edited_sha256"), F.explode(F.array(
                            F.struct(F.lit(0).alias("which"), F.col("text")),
                            F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("v"))
    keys = ["block", "at", "halo", "doc_id", "n_chars", "edited_sha256", "which"]
    prints = fingerprints(about.select(*keys[:-1], "v.which", "v.text").where("halo = 0 or which = 0"), keys, terms)
    both = prints.groupBy(*keys[:-1]).agg(
        F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    following = F.lead("fingerprint").over(Window.partitionBy("block").orderBy("at"))
    both = both.withColumn("next", following).where("halo = 0")
    return both.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next")).alias("near_next"))
