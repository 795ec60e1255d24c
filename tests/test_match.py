import random

import pytest
from pyspark.sql import functions as F

from tollspark.functions import text
from tollspark.operators import match, summary

ETC = "trade_id string, gantry_id string, plate string, t bigint"
VIU = "pic_id string, gantry_id string, plate string, p bigint"
KEYS = dict(on=["gantry_id", "plate"], lt="t", rt="p")


def brute(etc, viu, f):
    out = []
    for e in etc:
        hits = sorted((v[3], v[0]) for v in viu if None not in (e[3], v[3], e[1], e[2]) and v[1] == e[1] and v[2] == e[2]
                      and abs(v[3] - e[3]) <= f)
        out.append((*e, [h[1] for h in hits], int(bool(hits)), 99 if hits else 66))
    return sorted(out, key=repr)


def sample(seed, n=300, span=400, plates=3):
    rnd = random.Random(seed)

    def key():
        return f"G{rnd.randrange(2)}", f"P{rnd.randrange(plates)}"

    etc = [(f"E{i}", *key(), rnd.choice([None, *[rnd.randrange(-span, span)] * 9])) for i in range(n)]
    viu = [(f"V{i}", *key(), rnd.choice([None, *[rnd.randrange(-span, span)] * 9])) for i in range(n)]
    etc += etc[:7] * 3  # identical copies stay separate rows
    viu += viu[:5] * 2
    return etc, viu


@pytest.mark.parametrize("seed, tolerance, bucket", [(1, 20, 5), (2, 7, 3), (3, 0, 1), (4, 33, 1000)])
def test_match_equals_brute_force(spark, rows, seed, tolerance, bucket):
    etc, viu = sample(seed)
    left, right = spark.createDataFrame(etc, ETC), spark.createDataFrame(viu, VIU)
    want = brute(etc, viu, tolerance)
    assert rows(match.interval_match(left, right, **KEYS, tolerance=tolerance, collect="pic_id")) == want
    for hot in (1_000_000, 4):
        got = match.bucketed_interval_match(left, right, **KEYS, tolerance=tolerance, collect="pic_id", bucket=bucket, hot_rows=hot)
        assert rows(got) == want
    pairs = match.interval_pairs(left, right, **KEYS, tolerance=tolerance)
    assert pairs.where("pic_id is not null").count() == sum(len(w[4]) for w in want)
    assert pairs.where("pic_id is null").count() == sum(1 for w in want if not w[4])
    assert match.matched(left, right, **KEYS, tolerance=tolerance).count() == sum(w[5] for w in want)
    assert match.unmatched(left, right, **KEYS, tolerance=tolerance).count() == sum(1 - w[5] for w in want)


def test_hot_group_is_cut_and_complete(spark):
    """A third of all rows on one key at one moment."""
    etc = [(f"E{i}", "G0" if i % 3 == 0 else f"G{i}", "P", 100) for i in range(600)]
    viu = [(f"V{i}", "G0" if i % 3 == 0 else f"G{i}", "P", 105) for i in range(60)]
    got = match.bucketed_interval_match(spark.createDataFrame(etc, ETC), spark.createDataFrame(viu, VIU), **KEYS,
                                        tolerance=5, collect="pic_id", bucket=10, hot_rows=10)
    hot = got.where("gantry_id = 'G0'").select("trade_id", F.size("matches")).collect()
    assert len(hot) == 200 and all(r[1] == 20 for r in hot) and got.count() == 600


def test_bounds_ties_and_order(spark, rows):
    left = spark.createDataFrame([("E", "G", "P", 100)], ETC)
    right = spark.createDataFrame([("c", "G", "P", 120), ("b", "G", "P", 90), ("a", "G", "P", 90), ("d", "G", "P", 80),
                                   ("x", "G", "P", 121), ("y", "G", "P", 79), ("z", "G", "Q", 100)], VIU)
    found = match.interval_match(left, right, **KEYS, tolerance=20, collect="pic_id")
    assert found.first().matches == ["d", "a", "b", "c"]
    shown = match.match_rows(found, "2024-01-01 00:00:00").first()
    assert (shown.pic_ids, shown.plate, shown.pic_plate, shown.sign, shown.degree) == ("/d/a/b/c", "P", "P", 1, 99)


def test_null_keys(spark):
    left, right = spark.createDataFrame([("E", "G", None, 1)], ETC), spark.createDataFrame([("V", "G", None, 1)], VIU)
    assert match.interval_match(left, right, **KEYS, tolerance=1, collect="pic_id").first().sign == 0
    assert match.interval_match(left, right, **KEYS, tolerance=1, collect="pic_id", null_safe=True).first().sign == 1


@pytest.mark.parametrize("seed, distance", [(1, 1), (2, 2), (3, 0)])
def test_fuzzy_equals_brute_force(spark, rows, seed, distance):
    rnd = random.Random(seed)

    def plate():
        return rnd.choice([None, "", text.NO_PLATE, *["".join(rnd.choice("AB冀") for _ in range(rnd.randrange(1, 7))) for _ in range(12)]])

    etc = [(f"E{i}", f"G{rnd.randrange(2)}", plate(), rnd.randrange(60)) for i in range(80)]
    viu = [(f"V{i}", f"G{rnd.randrange(2)}", plate(), rnd.randrange(60)) for i in range(80)]
    etc, viu = etc + etc[:3], viu + viu[:3]

    def edits(a, b):
        if a == text.NO_PLATE:
            return 9
        a, b = a or "", b or ""
        line = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            line, last = [i], line
            for j, y in enumerate(b, 1):
                line.append(min(last[j] + 1, line[-1] + 1, last[j - 1] + (x != y)))
        return line[-1]

    want = []
    for e in etc:
        hits = sorted((v[3], v[0]) for v in viu if v[1] == e[1] and abs(v[3] - e[3]) <= 10 and edits(e[2], v[2]) <= distance)
        want.append((e[0], [h[1] for h in hits]))
    got = match.fuzzy_interval_match(spark.createDataFrame(etc, ETC),
                                     spark.createDataFrame(viu, VIU).withColumnRenamed("plate", "seen"), ["gantry_id"],
                                     "t", "p", 10, "pic_id", "plate", "seen", distance)
    assert rows(got.select("trade_id", "matches")) == sorted(want, key=repr)


def test_summary_invariant(spark):
    etc, viu = sample(9)
    found = match.interval_match(spark.createDataFrame(etc, ETC), spark.createDataFrame(viu, VIU), **KEYS, tolerance=9, collect="pic_id")
    result = match.match_rows(found, "now")
    total = summary.match_summary(result).first()
    assert total.total == len(etc) == total.matched + total.unmatched
    assert total.distinct_total == result.distinct().count() == total.distinct_matched + total.distinct_unmatched
    good, bad = match.split_matches(result)
    assert (good.count(), bad.count()) == (total.matched, total.unmatched)


def test_match_plan(spark):
    left, right = spark.createDataFrame([("E", "G", "P", 1)], ETC), spark.createDataFrame([("V", "G", "P", 1)], VIU)
    plan = match.interval_match(left, right, **KEYS, tolerance=5, collect="pic_id")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "PythonUDF" not in plan


def test_unread_plates_match_nothing_when_told(spark):
    left = spark.createDataFrame([("E1", "g", "none", 10), ("E2", "g", "P", 10)], ETC)
    right = spark.createDataFrame([("V1", "g", "none", 10), ("V2", "g", "P", 10)], VIU)
    found = match.interval_match(left, right, **KEYS, tolerance=1, collect="pic_id", plate="plate", default_plate="none")
    assert {row.trade_id: (row.matches, row.sign) for row in found.collect()} == {"E1": ([], 0), "E2": (["V2"], 1)}


def test_hot_slices_are_a_table_like_any_other(spark):
    etc = spark.createDataFrame([(f"E{i}", "g", "P", 10) for i in range(30)], ETC)
    viu = spark.createDataFrame([(f"V{i}", "g", "P", 10 + i % 3) for i in range(40)], VIU)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    found = match.bucketed_interval_match(etc, viu, **KEYS, tolerance=5, collect="pic_id", bucket=10, hot_rows=3)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before  # no job while the plan is built
    assert "ResolvedHint" not in found._jdf.queryExecution().analyzed().toString()
    assert {len(row.matches) for row in found.collect()} == {40}


def test_repeated_pictures_are_joined_once(spark):
    etc = spark.createDataFrame([(f"T{i}", "G", "P", 100 + i) for i in range(3)], ETC)
    viu = spark.createDataFrame([("V1", "G", "P", 101)] * 5000 + [("V2", "G", "P", 102), ("V0", "G", "P", 999)], VIU)
    want = [("V1",) * 5000 + ("V2",)] * 3
    plain_ = match.interval_match(etc, viu, **KEYS, tolerance=5, collect="pic_id", repeated_right=True)
    cut = match.bucketed_interval_match(etc, viu, **KEYS, tolerance=5, collect="pic_id", bucket=10, hot_rows=2)
    for found in (plain_, cut):
        assert [tuple(r.matches) for r in found.orderBy("trade_id").collect()] == want
    plan = plain_._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join"):]
    assert "_times" in join and "Aggregate" in join  # the pictures are counted below the join
