"""Cross-tokenizer alignment against a brute-force count over every pair of tokens."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tollspark.llm import alignment, queries

ODD = ["", None, "a", " ", "  two  spaces\n\n\tand tabs ", "<|endoftext|> is <s> text </s>", "naïve Straße 東京 🙂🙂", "▁low", "<0x41>",
       "x" * 500, "don't re-tokenize; 12345 678", "\x00\x01", "é ﬁ ½", "word " * 400]


def brute(texts):
    """Rows of the contract from byte ranges: overlapping ranges by comparison of all tokens within a group."""
    aligner, rows, total = alignment.Tokenizers().load(), [], Counter()
    for text in texts:
        a, b = aligner.tokens(text)
        ranges = []
        for ids, pieces in ((a, aligner.a.pieces), (b, aligner.b.pieces)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(pieces[i]), i))
                at += len(pieces[i])
            ranges.append(own)
        common = sorted({end for _, end, _ in ranges[0]} & {end for _, end, _ in ranges[1]})
        groups, links, begin = [], [], 0
        for end in common:
            one, two = ([r for r in own if begin <= r[0] and r[1] <= end] for own in ranges)
            groups.append(",".join(str(r[2]) for r in one) + "|" + ",".join(str(r[2]) for r in two))
            links += [(x[2], y[2]) for x in one for y in two if x[0] < y[1] and y[0] < x[1]]
            begin = end
        total.update(links)
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = Counter()
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    return [(n_a, n_b, n_groups, len(links), sum(total[link] == most[link[1]] for link in links), sum(total[link] for link in links),
             digest) for n_a, n_b, n_groups, links, digest in rows]


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_against_brute_force(spark, tmp_path, sf_dir):
    texts = ODD + [row.text for row in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    documents = spark.createDataFrame(list(enumerate(texts)) + [(2, texts[2]), (None, texts[4])], "doc_id long, text string")
    documents.withColumn("row", F.lit("clash")).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_alignment(spark, str(tmp_path)).collect()
    wanted = sorted(zip([*range(len(texts)), 2, -1], brute([*texts, texts[2], texts[4]]), strict=True))
    assert sorted((-1 if row.doc_id is None else row.doc_id, tuple(row[name] for name in FIELDS)) for row in got) == wanted


@pytest.mark.parametrize("head", [0, 5, 60])
def test_pairs_beyond_the_head_are_joined(spark, head):
    texts = ["the cat sat on the mat", "the tokenizer's mat, mat and mat", "unbelievably split wordpieces", "", "the the the"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    aligned = alignment.align(documents, ["doc_id"]).withColumn("row", F.col("doc_id") * 7).cache()
    got = alignment.scored(aligned, alignment.link_counts(aligned), ["doc_id"], "row", head=head).collect()
    assert [(row.n_best, row.count_sum) for row in sorted(got)] == [row[4:6] for row in brute(texts)]
    nothing = alignment.align(documents.limit(0), ["doc_id"]).withColumn("row", F.col("doc_id"))
    assert alignment.scored(nothing, alignment.link_counts(nothing), ["doc_id"], "row").count() == 0


def test_groups_spell_the_text(spark):
    aligner = alignment.Tokenizers().load()
    for text in filter(None, ODD):
        a, b = aligner.tokens(text)
        groups, links = aligner.groups(a, b)
        if a:
            assert b"".join(aligner.a.pieces[i] for i in a) == (" " + text).encode()
            assert [int(i) for g in groups for i in g.split("|")[0].split(",")] == a and len(links) == len(a) + len(b) - len(groups)
    assert aligner.tokens("▁low") == ([], []) and aligner.tokens("x" * 500)[0]
    assert aligner.tokens("<|endoftext|>")[0] and 50256 not in aligner.tokens("<|endoftext|>")[0]


def test_groups_are_cut_without_a_step_per_token():
    """As many Python calls for a long text as for a short one, whatever the groups; it was one per group with several ids."""
    import sys

    aligner, calls = alignment.Tokenizers().load(), []
    for text in ("unbelievably split wordpieces", "unbelievably split wordpieces, tokenizer's mat 12345 " * 50):
        a, b = aligner.tokens(text)
        lines = 0

        def trace(frame, event, arg):
            nonlocal lines
            lines += event == "line" and frame.f_code is alignment.Aligner.groups.__code__
            return trace

        before = sys.gettrace()
        sys.settrace(trace)
        try:
            groups, _ = aligner.groups(a, b)
        finally:
            sys.settrace(before)
        assert any("," in group for group in groups)
        calls.append(lines)
    assert calls[0] == calls[1]
