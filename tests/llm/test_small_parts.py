"""Small parts of the operators, against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollspark.llm import decontam, html_crf, linedup, mixing, quality, simhash, toxicity


def naive_hits(words, items, window):
    """Hit word places and item names by comparing every window."""
    hit, names = set(), set()
    for name, text in items:
        line = decontam.words_of(text)
        k = min(window, len(line))
        for i in range(len(line) - k + 1 if line else 0):
            for j in range(len(words) - k + 1):
                if words[j:j + k] == line[i:i + k]:
                    hit.update(range(j, j + k))
                    names.add(name)
    return hit, names


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=0, max_size=9), max_size=5), st.text("abcd", max_size=30), st.integers(1, 5))
def test_automaton_finds_what_all_windows_find(items, text, window):
    items = [(str(i), " ".join(item)) for i, item in enumerate(items)]
    automaton = decontam.Automaton(items, window)
    words = decontam.words_of(" ".join(text))
    spans, names = automaton.match(words)
    assert ({i for a, b in spans for i in range(a, b)}, names) == naive_hits(words, items, window)
    assert all(a[1] < b[0] for a, b in itertools.pairwise(spans))


def test_cut_keeps_the_rest_of_the_text():
    assert decontam.cut("Wir: Äpfel, und (Birnen) essen.", [[1, 4]], 1) == "Wir: ) essen."
    assert decontam.cut(None, [[0, 1]], 1) is None
    assert decontam.cut("a b c", [[0, 1]], 2) == "a b c"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=3), st.lists(st.integers(0, 8), min_size=2, max_size=2))
def test_flow_fills_quotas_at_least_cost(sizes, quotas):
    patterns = dict(zip([("a",), ("b",), ("a", "b")], sizes, strict=False))
    limits = dict(zip("ab", quotas, strict=True))
    taken = mixing.route(patterns, limits, 3)

    def cost(name, words):
        size = patterns[name]
        return sum(max(0, min(size, words - again * size)) * again * again for again in range(3))

    def feasible(take):
        only_a, only_b, both = (take.get(p, 0) for p in [("a",), ("b",), ("a", "b")])
        return only_a <= limits["a"] and only_b <= limits["b"] and only_a + only_b + both <= sum(quotas)

    options = [dict(zip(patterns, t, strict=True)) for t in itertools.product(*[range(3 * s + 1) for s in sizes])]
    options = [take for take in options if feasible(take)]
    most = max(sum(take.values()) for take in options)
    least = min(sum(cost(p, w) for p, w in take.items()) for take in options if sum(take.values()) == most)
    assert feasible(taken) and sum(taken.values()) == most
    assert sum(cost(p, w) for p, w in taken.items()) == least


def test_flow_over_very_many_patterns():
    """Twice the words of 2509 patterns of one size are wanted: quotas fill, no pattern takes a third pass."""
    sources = [f"s{i}" for i in range(12)]
    names = [p for n in (1, 2, 3, 4, 5, 6) for p in itertools.combinations(sources, n)][:3000]
    patterns = dict.fromkeys(names, 7)
    quota = 2 * 7 * len(names) // 12
    taken = mixing.route(patterns, dict.fromkeys(sources, quota), 3)
    assert sum(taken.values()) == 12 * quota and max(taken.values()) <= 14
    assert taken == mixing.route(patterns, dict.fromkeys(sources, quota), 3)


def test_targets_stop_at_the_limit_and_share_the_rest():
    found = mixing.targets({"a": 10, "b": 1000, None: 1000}, {"a": 1, "b": 2, None: 3}, 2010, 3)
    assert found["a"] == 30 and found["b"] == pytest.approx(1980 * 2 / 5) and found[None] == pytest.approx(1980 * 3 / 5)
    assert mixing.targets({"a": 0}, {"a": 1}, 0, 3) == {"a": 0}


@pytest.mark.parametrize("text", [None, "", "one", "One two", "a b  a\tb\na b a b", "Ä ö é " * 50])
def test_fingerprint_is_the_majority_of_the_bits(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(gram, 42) for gram in grams]
    expected = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert simhash.fingerprint(text) == expected


def test_long_runs_connect_what_pairs_connect():
    pick = random.Random(3)
    base = [pick.getrandbits(64) for _ in range(4)]
    bits = {b ^ sum({1 << pick.randrange(64) for _ in range(pick.randrange(6))}) for b in base for _ in range(120)}
    bits = np.array(sorted(bits), dtype=np.uint64)
    nodes = np.arange(len(bits))

    def classes(links):
        label = list(range(len(bits)))
        for _ in range(len(bits)):
            changed = False
            for a, b in links:
                low = min(label[a], label[b])
                changed |= label[a] != low or label[b] != low
                label[a] = label[b] = low
            if not changed:
                return label

    pairs = [(i, j) for i in range(len(bits)) for j in range(i) if int(bits[i] ^ bits[j]).bit_count() <= 3]
    links = simhash.run_links(bits, nodes, 3)
    assert classes(links) == classes(pairs) and len(links) < len(bits)


def test_every_close_pair_shares_a_choice_of_blocks():
    pick, masks = random.Random(5), simhash._block_masks(6, 3)
    assert len(masks) == 20
    for _ in range(300):
        a = pick.getrandbits(64)
        b = a ^ sum(1 << i for i in pick.sample(range(64), 3))
        assert any(a & mask == b & mask for mask in masks)
        shared = next(mask for mask in masks if a & mask == b & mask)
        finer = simhash._finer_masks(shared, 6, 3)
        assert len(finer) == 20 and any(a & mask == b & mask for mask in finer)
        assert all(mask & shared == shared and mask.bit_count() >= 46 for mask in finer)


def test_block_max_search_is_exact():
    pick = np.random.default_rng(2)
    vectors = []
    for _ in range(700):
        ids = np.unique(pick.integers(0, 60, pick.integers(1, 9)))
        weights = pick.random(len(ids)) + 0.01
        vectors.append((ids, weights / np.sqrt((weights ** 2).sum())))
    index = toxicity.BlockMaxIndex(vectors, 60, block=16)
    full = np.zeros((700, 60))
    for i, (ids, weights) in enumerate(vectors):
        full[i, ids] = weights
    for i in range(0, 700, 35):
        cosines = full @ full[i]
        cosines[i] = 0
        best = np.lexsort((np.arange(700), -np.round(cosines, 12)))[:15]
        best = best[cosines[best] > 0]
        found, scores = index.nearest(*vectors[i], 15, without=i)
        assert found.tolist() == best.tolist() and np.allclose(scores, cosines[best])


def test_monotone_curve_rises():
    x, y = np.array([0.1, 0.2, 0.3, 0.9]), np.array([0, 1, 0, 1.0])
    knots, values = toxicity._monotone(x, y, np.ones(4))
    assert (np.diff(knots) > 0).all() and (np.diff(values) > 0).all() and 0 < values[0] < values[-1] < 1


def test_marginals_and_viterbi_match_enumeration():
    pick = np.random.default_rng(4)
    unary, step = pick.normal(size=(1, 4, 2)), pick.normal(size=(2, 2))
    weight = {path: np.exp(sum(unary[0, t, l] for t, l in enumerate(path)) + sum(step[a, b] for a, b in
              itertools.pairwise(path))) for path in itertools.product((0, 1), repeat=4)}
    total = sum(weight.values())
    labels, steps = html_crf._marginals(unary, step, np.ones((1, 4), bool))
    for t in range(4):
        assert labels[0, t, 1] == pytest.approx(sum(w for p, w in weight.items() if p[t]) / total)
    assert steps[0, 1] == pytest.approx(sum(w * sum(s == (0, 1) for s in itertools.pairwise(p)) for p, w in weight.items()) / total)
    crf = html_crf.Crf({str(t): t for t in range(4)}, unary[0], step)
    assert tuple(crf.decode([[str(t)] for t in range(4)])) == max(weight, key=weight.get)


def test_blocks_are_cut_at_block_tags():
    page = ("<!DOCTYPE html><title>t</title><script>var a='</p><p>x';</script><p>One <b>t</b>wo<br>three &amp; four"
            "<p> five\n six<!-- <p>no -->&eacute;<ul><li><a href='x>y'>seven</a><li>eight</ul><style>p{}</style>nine <")
    blocks = html_crf.blocks_of(page)
    assert [b.text for b in blocks] == ["One two three & four", "five sixé", "seven", "eight", "nine <"]
    assert blocks[2].linked == 5 and not blocks[3].linked
    assert html_crf.blocks_of(None) == html_crf.blocks_of("") == html_crf.blocks_of("<p") == []


def test_difference_counts_the_whole_text():
    class Size:
        def __init__(self, of):
            self.of = of

        def compress(self, data):
            return b"x" * self.of(data)

    good, bad = Size(lambda d: 1), Size(lambda d: 1 + d.count(b"a"))
    assert quality.difference("ab" * 5000, good, bad, 64) == 0.5
    assert quality.difference(None, good, bad, 64) == quality.difference("", good, bad, 64) == 0


def test_block_maxima_bound_and_prune():
    """Blocks hold alike examples, no bound is below a cosine of its block, and most postings of other blocks stay unread."""
    draw = np.random.default_rng(11)
    vectors = []
    for i in range(400):
        ids = np.sort(draw.choice(40, 12, replace=False)) + 40 * (i % 5)
        weights = draw.random(12) + 0.1
        vectors.append((ids, weights / np.linalg.norm(weights)))
    index = toxicity.BlockMaxIndex(vectors, 200, block=8)
    assert index.blocks >= 50 and sum(index.size) == 400 and index.size.max() <= 8
    full = np.zeros((400, 200))
    for i, (ids, weights) in enumerate(vectors):
        full[i, ids] = weights
    of = np.zeros(400, int)
    of[index.example] = np.repeat(index.block, np.diff(index.begin))
    ids, weights = vectors[7]
    bounds = weights @ index.largest[ids].astype(float)
    assert (bounds[of] >= full @ full[7] - 1e-12).all()
    assert (bounds > 0).mean() < 0.6  # a fifth of the examples share terms with it
    for k in (1, 5, 399, 400, 900):
        best = np.lexsort((np.arange(400), -np.round(full @ full[7], 12)))[:k]
        found, _ = index.nearest(ids, weights, k)
        assert found.tolist() == [i for i in best if full[i] @ full[7] > 0]


def test_words_of_latin_texts_are_cut_as_bytes():
    """The same words and terms from bytes as from the pattern, and no pattern run over a text that Latin-1 can hold."""
    texts = ["Na\u00efve Stra\u00dfe caf\u00e9s x\u00b2 a1b2_c \u00b5m \u00aa\x85x\xa0y\u00ff don't", "", None, "\u0141\u00d3D\u0179 \u201cquoted\u201d abcdef \u6771\u4eac", "\u0130x \u017ftra"]
    words = [word if isinstance(word, str) else word.decode("latin-1") for text in texts for word in toxicity._words(text)]
    assert words == [word for text in texts for word in toxicity._WORD.findall((text or "").lower())]
    assert {type(word) for word in toxicity._words(texts[0])} == {bytes}
    wanted = [toxicity.terms_of(text) for text in texts]
    vocabulary = toxicity.Vocabulary(sorted(set().union(*wanted)))
    for text, terms in zip(texts, wanted, strict=True):
        ids, times = vocabulary.count(text)
        assert {vocabulary.terms[i]: n for i, n in zip(ids.tolist(), times.tolist(), strict=True)} == dict(terms)


def test_search_learns_where_bounds_rule_nothing_out(monkeypatch):
    """Where bounds lie far above all cosines, postings are soon read once a text, not in part first and then whole."""
    draw, vectors = np.random.default_rng(5), []
    for _ in range(512):
        ids = np.sort(draw.choice(400, 40, replace=False))
        vectors.append((ids, np.full(40, 40 ** -0.5)))
    index, reads = toxicity.BlockMaxIndex(vectors, 400, block=64), []
    for name in ("_some", "_whole"):
        real = getattr(index, name)
        monkeypatch.setattr(index, name, lambda *own, real=real, name=name: (reads.append(name), real(*own))[1])
    full = np.zeros((512, 400))
    for i, (ids, weights) in enumerate(vectors):
        full[i, ids] = weights
    for i in range(200):
        found, cosines = index.nearest(*vectors[i], 20)
        best = np.lexsort((np.arange(512), -np.round(full @ full[i], 12)))[:20]
        assert found.tolist() == best.tolist() and np.allclose(cosines, (full @ full[i])[best])
    assert reads.count("_whole") == 200 and reads.count("_some") < 50


def test_lines_are_hashed_without_cutting_them_into_words(spark):
    """White space is folded by a pattern in odd lines only, and no line is split into words before the fold of equal ones;
    the plan split every line twice. Halves are those of the words."""
    lines = ["a b c d e f g h", " a\tb  c\x0bd e f\r", "a\x1cb\u00a0c d", "one", "a b c d e f g", "\t\x0c ", "x  "]
    documents = spark.createDataFrame([(3, "\n".join(lines)), (4, "a b c d e f\n a b  c"), (None, "z"), (5, None)], "doc_id long, text string")
    distinct = linedup.distinct_lines(documents)
    assert distinct._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1  # the text, at its line ends
    found = {row.line: row.place for row in linedup._lines(documents).collect()}
    wanted = [(i, j, " ".join(w for w in re.split(linedup.SPACES, line) if w)) for i, text in ((3, "\n".join(lines)), (4, "a b c d e f\n a b  c"))
              for j, line in enumerate(text.split("\n"))]
    assert set(found) == {line for _, _, line in wanted if line}
    rows = {row.place: row for row in distinct.collect()}
    first = {}
    for i, j, line in wanted:
        if line:
            first.setdefault(line, (i << 31) + j)
    assert set(map(int, rows)) == set(first.values())
    for line, place in first.items():
        words, row = line.split(" "), rows[place]
        m, less = len(words) // 2, (len(words) - 1) // 2
        halves = [("first", m, " ".join(words[:m])), ("last", m, " ".join(words[len(words) - m:])),
                  ("first", less, " ".join(words[:less])), ("last", less, " ".join(words[len(words) - less:]))]
        hashes = spark.createDataFrame(halves, "side string, m int, half string").select(F.xxhash64("side", "m", "half")).collect()
        assert row.n == len(words) and (row.k0, row.k1) == (hashes[0][0], hashes[1][0])
        assert (row.k2, row.k3) == ((hashes[2][0], hashes[3][0]) if len(words) % 2 == 0 else (None, None))


def test_search_gathers_into_arrays_that_stay():
    """Arrays of an earlier, longer search leave nothing behind, aren't made anew, and aren't sent to tasks."""
    draw, vectors = np.random.default_rng(8), []
    for n in draw.integers(1, 40, 300):
        weights = draw.random(n) + 0.1
        vectors.append((np.sort(draw.choice(80, n, replace=False)), weights / np.linalg.norm(weights)))
    index = toxicity.BlockMaxIndex(vectors, 80)
    every = np.arange(80), np.full(80, 80 ** -0.5)
    index.nearest(*every, 7)
    kept = index._scratch
    for ids, weights in vectors[:40]:
        found, cosines = index.nearest(ids, weights, 7)
        fresh, same = toxicity.BlockMaxIndex(vectors, 80).nearest(ids, weights, 7)
        assert found.tolist() == fresh.tolist() and cosines.tolist() == same.tolist()
    assert index._scratch is kept and len(kept[0]) >= len(index.weight)
    assert not {"_scratch", "largest"} & index.__getstate__().keys()
