"""The operators on small tables: nulls, empty texts, ties and repeats, empty tables, clashing columns, brute force."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import difference, oracle_connection
from tollspark.llm import chat, decontam, html_crf, imatch, langid, linedup, mixing, quality, queries, simhash, toxicity
from tollspark.llm.oracles import llm_oracles

EN = "the thing and this other with that from there when they have been going through the winter woods "
DE = "und der die nicht eine schöne große straße wird durch den winterlichen wald gehen müssen wir heute "


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def texts_of(rows):
    return {row[0]: row[1:] for row in rows}


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_queries_match_their_sql(spark, sf_dir, name):
    got = queries.llm_queries()[name](spark, sf_dir)
    assert difference(got, oracle_connection(sf_dir), llm_oracles()[name]) is None


def test_html_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    model = html_crf.fit(pages)
    para = "A long sentence of the story, which goes on and on. It has more to say, of course, and says it."
    tricky = (f"<body><header class=site-header><p>My site</p></header><div class=cookie-notice>{para}</div><div id=content>"
              f"<h1>Title here</h1><p>{para}</p><div class=advert>{para}</div><p>{para} More.</p></div>"
              f"<div class=comments><p>{para}</p></div><aside><ul><li><a href=x>Other page</a></ul></aside>"
              f"<form><label>Name</label></form><footer>&copy; us</footer>")
    rows = [(1, tricky, "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (4, "<p>a", None)]
    found = html_crf.extract(frame(spark, rows, "page_id long, html string, text string"), model, ["page_id"]).collect()
    assert len(found) == 5 and texts_of(found)[1][0] == f"Title here {para} {para} More."
    assert texts_of(found)[2] == texts_of(found)[3] == ("",)
    assert html_crf.extract(pages.limit(0), html_crf.fit(pages.limit(0)), ["page_id"]).count() == 0


def test_language(spark):
    rows = [(i, (EN if i % 2 else DE) * (1 + i % 5), "en" if i % 2 else "de") for i in range(40)]
    training = frame(spark, rows, "doc_id long, text string, lang string")
    model = langid.fit(training.union(frame(spark, [(99, None, "en"), (98, "x", None)], training.schema)))
    new = [(1, "they have been there this winter"), (2, "wir müssen eine straße gehen"), (3, None), (4, ""), (5, "12 .,"),
           (5, "12 .,"), (6, "the woods " * 200_000)]
    found = langid.predict(frame(spark, new).withColumn("score", F.lit("x")), model, ["doc_id"]).collect()
    assert [row.lang_pred for row in sorted(found)] == ["en", "de", "und", "und", "und", "und", "en"]
    assert all(0 <= row.score <= 1 for row in found)
    nothing = langid.fit(training.limit(0))
    assert langid.predict(frame(spark, new[:1]), nothing, ["doc_id"]).first().lang_pred == "und"


def test_mix_with_overlapping_sources(spark):
    rows = [(i, "w " * (1 + i % 7), ["a"] if i % 3 else ["a", "b"]) for i in range(300)]
    rows += [(900, None, ["b"]), (901, "w w", None), (902, "", ["a"]), (903, "w w w", [None]), (903, "w w w", [None])]
    docs = frame(spark, rows, "doc_id long, text string, of array<string>").withColumn("size", F.lit("clash"))
    chosen, sources = mixing.mix(docs, F.col("of"), ["doc_id"])
    found, about = chosen.collect(), {row.source: row for row in sources.collect()}
    assert len(found) == 305 and all(0 <= row.taken <= 3 * row.size for row in found)
    assert sum(row.taken for row in found) == sum(int(row.target + 0.5) for row in about.values())
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, found))
    empty, _ = mixing.mix(docs.limit(0), F.col("of"), ["doc_id"])
    assert empty.count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, F.col("of"), ["doc_id"], max_patterns=2)


@pytest.mark.parametrize("max_words", [300_000, 12])
def test_decontamination(spark, max_words):
    items = [("1", "a b c d e f g h i j k l"), ("2", "short one"), (None, "unnamed thing here"), ("3", None), ("1", "a b")]
    items = spark.createDataFrame(items, "item_id string, text string")
    rows = [(1, "x A b, c d e f g h i J y"), (2, "a short One."), (3, None), (4, ""), (5, "clean text"), (5, "clean text"),
            (None, "unnamed THING here, so")]
    docs = frame(spark, rows).withColumn("items", F.lit(7))
    found = texts_of(decontam.find(docs, items, ["doc_id"], max_words=max_words).collect())
    assert found[1] == (12, [[1, 11]], ["1"]) and found[2] == (3, [[1, 3]], ["2"]) and found[3] == found[4] == (0, [], [])
    assert found[5] == (2, [], []) and found[None] == (4, [[0, 3]], [])
    kept = decontam.clean(docs.where("doc_id is null or doc_id != 1"), items, max_words=max_words).collect()
    assert sorted((row.row.doc_id or 0, row.text or "") for row in kept) == [
        (3, ""), (4, ""), (5, "clean text"), (5, "clean text")]
    long = frame(spark, [(1, "x A b, c d e f g h i J y" + " z" * 20), (2, "clean")]).withColumn("a.b", F.lit(7))
    kept = {row.row.doc_id: row for row in decontam.clean(long, items, max_words=max_words).collect()}
    assert kept[1].text == "x  y" + " z" * 20 and kept[1].changed and not kept[2].changed
    assert kept[2].text == "clean" and kept[2].row["a.b"] == 7
    assert decontam.find(docs, items.limit(0), ["doc_id"]).where("size(spans) > 0").count() == 0
    assert decontam.find(docs.limit(0), items, ["doc_id"]).count() == 0


def test_imatch(spark):
    pick = random.Random(1)
    rows = [(i, " ".join(f"w{pick.randrange(3000)}" for _ in range(pick.randrange(1, 300)))) for i in range(60)]
    rows += [(100, rows[7][1]), (101, None), (102, ""), (102, ""), (None, "lost words")]
    found = imatch.compared(frame(spark, rows).withColumn("at", F.lit("x"))).collect()
    assert len(found) == len(rows)
    by_id = {row.doc_id: row for row in found}
    assert by_id[100].fingerprint == by_id[7].fingerprint and by_id[101].fingerprint == by_id[102].fingerprint
    ordered = sorted((r for r in rows if r[0] is not None), key=lambda r: (-r[0], r[1] or "")) + [rows[-1]]
    import hashlib
    for (doc_id, text), (_, other) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text or "") // 2
        edited = (text or "")[:len(text or "") - half] + (other or "")[:half]
        hashes = {row.edited_sha256 for row in found if row.doc_id == doc_id}
        assert hashlib.sha256(edited.encode()).hexdigest() in hashes
    long = [row for row in found if row.n_chars > 300]
    assert sum(row.near_edited > row.near_next for row in long) > 0.9 * len(long)
    assert all(0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1 for row in found)
    single = imatch.compared(frame(spark, [(1, "only one here")])).first()
    assert single.near_next == 1.0
    assert imatch.compared(frame(spark, [])).count() == 0


def test_imatch_of_texts_without_terms_in_the_band(spark):
    # Each of two groups of copies has 30 % of the documents, so no term of theirs is in the band.
    groups = ["alpha beta gamma delta epsilon", "one two three four five six"]
    rows = [(i, groups[i % 2] if i < 60 else f"w{i} v{i} u{i // 2}" if i < 98 else None if i == 98 else " .. ")
            for i in range(100)]
    found = {r.doc_id: r for r in imatch.compared(frame(spark, rows), commonest=0.2).collect()}
    assert found[0].fingerprint == found[2].fingerprint != found[1].fingerprint == found[3].fingerprint
    assert found[1].near_next == 0.0  # the next document is of the other group
    assert set(found[98].fingerprint.split(" ")) == {"-"} and found[98].fingerprint == found[99].fingerprint
    assert found[99].near_next == 1.0 and found[98].fingerprint not in {found[0].fingerprint, found[1].fingerprint}
    # Nor have texts whose terms are all too rare, nor those with terms of both kinds.
    rare = {r.doc_id: r for r in imatch.compared(frame(spark, rows), rarest=0.05).collect()}
    assert len({rare[i].fingerprint for i in range(60, 98)}) == 38 and rare[61].near_next < 0.5


def test_every_term_of_the_band_enters_a_long_fingerprint(spark):
    words = frame(spark, [(i, f"w{i}") for i in range(400)]).select("text", (F.xxhash64("text") < 0).alias("high"))
    low, high = ([r.text for r in words.where(F.col("high") == side).collect()] for side in (False, True))
    rows = [(1, " ".join(low[:90] + high[:40])), (2, " ".join(low[:90] + high[40:80]))]
    found = {r.doc_id: r for r in imatch.compared(frame(spark, rows), commonest=1.0).collect()}
    assert found[1].fingerprint != found[2].fingerprint and found[2].near_next < 1.0


def test_chat(spark):
    rows = [("c", 0, "ann", "hi <|im_end|>"), ("c", 1, "bob", None), ("c", 70, "ann", "bye"), ("c", 70, "ann", "bye"),
            ("d", 0, "system", "be kind"), (None, None, None, "lost")]
    schema = "conv_id string, turn int, role string, text string"
    found = {tuple(r)[:3]: r for r in chat.rotate(frame(spark, rows, schema).withColumn("part", F.lit(1))).collect()}
    assert set(found) == {("c", "ann", 0), ("c", "ann", 1), ("c", "bob", 0), ("c", "bob", 1), (None, "unknown", -1)}
    row = found["c", "ann", 0]
    assert row.text == ("<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n")
    assert [row.text[s.begin:s.end] for s in row.spans] == ["hi < |im_end|>"]
    assert found["c", "bob", 1].spans == [] and found["c", "ann", 1].n_turns == 1
    assert chat.rotate(frame(spark, [], schema)).count() == 0


def naive_lines(rows, min_words=8):
    """Kept (doc_id, position) by comparing all lines."""
    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < min_words or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1:] == short for i in range(len(long)))

    seen, out = [], {}
    for doc_id, text in sorted({r for r in rows if r[0] is not None and r[1] is not None}):
        lines, kept = text.split("\n"), []
        for line in lines:
            words = line.split()
            if not words:
                kept.append(line)
                continue
            if not any(near(words, other) for other in seen):
                kept.append(line)
            seen.append(words)
        out[doc_id] = "\n".join(kept)
    return out


def test_line_dedup_against_all_pairs(spark):
    pick = random.Random(9)
    base = [[pick.choice("abcdefg") for _ in range(pick.randrange(1, 14))] for _ in range(25)]

    def line():
        words = list(pick.choice(base))
        for _ in range(pick.randrange(3)):
            at = pick.randrange(len(words) + 1)
            words[at:at + pick.randrange(2)] = [pick.choice("abcdefgxyz")] * pick.randrange(2)
        return pick.choice([" ", "  "]).join(words)

    rows = [(i, "\n".join(line() for _ in range(pick.randrange(1, 6)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, rows[0][1]), (503, rows[0][1]), (-4, rows[1][1])]
    docs = frame(spark, rows + [(None, "a\na")]).withColumn("place", F.lit("x")).withColumn("lines", F.lit("y"))
    found = linedup.dedup_lines(docs).select("row.doc_id", "text", "lines", "kept").collect()
    expected = naive_lines(rows)
    assert len(found) == len(rows) + 1
    for row in found:
        assert row.text == ("a\na" if row.doc_id is None else expected.get(row.doc_id))
    assert linedup.dedup_lines(docs.limit(0)).count() == 0


def test_simhash_components_against_all_pairs(spark):
    pick = random.Random(2)
    base = [[f"w{pick.randrange(400)}" for _ in range(120)] for _ in range(8)]
    rows = [(-1, ""), (200, None), (201, "!"), (202, "!"), (202, "!"), (None, "lost")]
    for i in range(150):
        words = list(pick.choice(base))
        for _ in range(pick.randrange(3)):
            words[pick.randrange(120)] = "new"
        rows.append((i, " ".join(words)))
    found = simhash.grouped(frame(spark, rows).withColumn("node", F.lit("x"))).collect()
    prints = {(doc_id, simhash.fingerprint(text)) for doc_id, text in rows if doc_id is not None}
    label = {doc_id: doc_id for doc_id, _ in prints}
    for _ in range(20):
        for a, x in prints:
            for b, y in prints:
                if (x ^ y).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    assert len(found) == len(rows)
    for row in found:
        assert row.component_id == (None if row.doc_id is None else label[row.doc_id])
    assert simhash.grouped(frame(spark, [])).count() == 0


def test_simhash_hot_keys_are_cut_without_loss(spark):
    """Fingerprints that nearly all agree on the low blocks, so that most keys count as hot."""
    pick = random.Random(9)
    bits = {(pick.getrandbits(16) << 48) ^ sum({1 << pick.randrange(48) for _ in range(pick.randrange(3))}) for _ in range(300)}
    bits |= {b ^ 1 << pick.randrange(64) for b in list(bits)[:120]}
    bits = sorted(bits)
    nodes = spark.createDataFrame([(i, b - (b >> 63 << 64)) for i, b in enumerate(bits)], "node long, fingerprint long")
    label = list(range(len(bits)))
    pairs = [(i, j) for i in range(len(bits)) for j in range(i) if (bits[i] ^ bits[j]).bit_count() <= 3]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    for hot_rows in (1, 20, 10_000):
        found = dict(map(tuple, simhash.components(simhash.links(nodes, hot_rows=hot_rows)).collect()))
        assert [found.get(i, i) for i in range(len(bits))] == label


def test_components_that_do_not_settle_are_an_error(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    with pytest.raises(RuntimeError):
        simhash.components(edges, max_rounds=1)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    found = dict(map(tuple, simhash.components(edges).collect()))
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def labelled(spark, sf_dir, column):
    documents = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/labels.parquet")
    return documents, labels.select("doc_id", F.col(column).alias("label"))


@pytest.mark.parametrize(("operator", "column", "least"), [(quality, "quality", 0.9), (toxicity, "toxic", 0.95)])
def test_classifiers(spark, sf_dir, operator, column, least):
    documents, labels = labelled(spark, sf_dir, column)
    held_out = F.col("doc_id") % 3 == 0
    noise = spark.createDataFrame([(None, 1), (-5, 1)], "doc_id long, label int").union(labels.limit(0))
    model = operator.fit(documents, labels.where(~held_out).union(noise))
    found = operator.score(documents.withColumn("score", F.lit("x")), model, ["doc_id"])
    joined = found.join(labels.where(held_out), "doc_id").select(((F.col("score") >= 0.5).cast("int") == F.col("label"))
                                                                 .cast("double").alias("right"))
    assert joined.agg(F.avg("right")).first()[0] >= least
    odd = frame(spark, [(1, None), (2, ""), (2, ""), (3, "word " * 200_000)])
    scores = operator.score(odd, model, ["doc_id"]).collect()
    assert len(scores) == 4 and all(0 <= row.score <= 1 for row in scores)
    nothing = operator.fit(documents, labels.limit(0))
    assert operator.score(odd, nothing, ["doc_id"]).count() == 4
    assert operator.score(documents.limit(0), model, ["doc_id"]).count() == 0


def test_toxicity_by_rare_terms(spark):
    """Terms of a few toxic examples only, and few labels."""
    pick = random.Random(3)
    common = [f"{a}{b}" for a in ("ba", "be", "bi", "bo", "bu") for b in ("ka", "ke", "ki", "ko", "ku", "kal", "kel")]
    rows = [(i, " ".join(pick.choices(common, k=30)) + (" vile" if i % 2 and i < 190 else " zork" if i % 2 else ""))
            for i in range(200)] + [(1000, "zork"), (1001, "vile"), (1002, "unseen")]
    labels = frame(spark, [(i, i % 2) for i in range(200)], "doc_id long, label int")
    documents = frame(spark, rows)
    model = toxicity.fit(documents, labels)
    found = {r.doc_id: r for r in toxicity.score(documents, model, ["doc_id"]).collect()}
    assert set(found[1000].evidence) == {191, 193, 195, 197, 199} and found[1000].score > 0.7
    assert len(found[1001].evidence) == 15 and found[1002].evidence == []
    assert set(model.vocabulary.terms) == {term for _, text in rows[:200] for term in toxicity.terms_of(text)}
    few = toxicity.fit(documents, labels.where("doc_id < 10"))
    some = {r.doc_id: r for r in toxicity.score(documents, few, ["doc_id"]).collect()}
    assert len(some[1].evidence) == 10 and some[1001].score > 0.5


def test_queries_return_their_contracts(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    types = {"op2_language": "bigint boolean string double", "op5_imatch": "bigint bigint string string string double double",
             "op8_simhash": "bigint string bigint", "op9_toxicity": "bigint boolean double int array<bigint>",
             "op10_quality": "bigint boolean double int"}
    for name, kinds in types.items():
        found = queries.llm_queries()[name](spark, sf_dir)
        assert " ".join(kind for _, kind in found.dtypes) == kinds and found.count() == n
    prints = queries.op8_simhash(spark, sf_dir)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for row in prints.join(documents, "doc_id").limit(50).collect():
        assert row.fingerprint == f"{simhash.fingerprint(row.text):016x}"


def test_pipeline_stage_by_stage(spark, sf_dir):
    """Every stage against brute force over its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {row.doc_id: row for row in docs.collect()}
        after = stage(spark, docs, sf_dir)
        kept = {row.doc_id: row for row in after.collect()}
        assert set(kept) <= set(before) and kept
        if name != "mix":
            assert after.columns == columns
            assert all(row.n_chars == len(row.text) for row in kept.values())
        if name == "quality":
            labels = {row.doc_id: row.quality for row in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            right = [(doc_id in kept) == bool(labels[doc_id]) for doc_id in before if doc_id in labels]
            assert sum(right) >= 0.85 * len(right)
        elif name == "line_dedup":
            expected = naive_lines([(row.doc_id, row.text) for row in before.values()])
            assert {d: r.text for d, r in kept.items()} == {d: t for d, t in expected.items() if t.strip()}
        elif name == "near_dedup":
            prints = {d: simhash.fingerprint(r.text) for d, r in before.items()}
            label = {d: d for d in prints}
            for _ in range(5):
                for a, x in prints.items():
                    for b, y in prints.items():
                        if (x ^ y).bit_count() <= 3:
                            label[a] = label[b] = min(label[a], label[b])
            assert set(kept) == set(label.values())
        elif name == "decontaminate":
            items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
            automaton = decontam.Automaton([(str(i.item_id), i.text) for i in items], 10)
            for doc_id, row in before.items():
                words = decontam.words_of(row.text)
                spans, _ = automaton.match(words)
                hit = sum(b - a for a, b in spans)
                assert (doc_id in kept) == (hit <= 0.5 * len(words))
                if doc_id in kept:
                    assert kept[doc_id].text == decontam.cut(row.text, spans, 1)
        else:
            assert all(0 < row.mix_taken <= 3 * row.mix_size for row in kept.values())
        docs = after
    assert corpus_pipeline.run(spark, sf_dir).count() == len(kept)
