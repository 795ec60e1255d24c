import pytest
from datetime import date, datetime
from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tollspark.functions import measures, rowkey, text, times


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()[0]


def test_times(spark):
    at = datetime(2020, 5, 13, 23, 0, 14)
    assert one(spark, times.parse_iso("x"), "2020-05-13T23:00:14") == at
    assert one(spark, times.parse_iso("x"), "2020-05-13 23:00:14") == at
    assert one(spark, times.parse_iso("x"), "yesterday") is None
    assert one(spark, times.event_time_from_id("x"), "G0070360130060101003020200709003518") == datetime(2020, 7, 9, 0, 35, 18)
    assert one(spark, times.event_time_from_id("x"), "short") is None
    assert one(spark, times.event_time_from_version("x"), "202007120709") == datetime(2020, 7, 12, 7, 9)
    assert one(spark, times.event_time_from_raw("x", "enTime"), '{"a":1,"enTime":"2020-05-13T23:00:14"}') == at
    assert one(spark, times.event_time_from_raw("x", "exTime"), '{"enTime":"2020-05-13T23:00:14"}') is None
    assert one(spark, times.parse_zoned("x"), "2020-07-19 08:00:00") == datetime(2020, 7, 19, 0, 0)
    assert one(spark, times.parse_zoned("x"), "19.7.2020") is None
    assert one(spark, times.fmt_ts(times.parse_iso("x")), "2020-05-13T23:00:14") == "2020-05-13 23:00:14"
    assert one(spark, times.epoch_ms(times.parse_iso("x")), "1970-01-01T00:00:01") == 1000


def test_day_window_edges(spark):
    frame = spark.createDataFrame([("2024-01-01T15:59:59",), ("2024-01-01T16:00:00",)], "x string")
    starts = frame.select(times.day_window(times.parse_iso("x")).start.alias("s")).collect()
    assert [r.s for r in starts] == [datetime(2023, 12, 31, 16), datetime(2024, 1, 1, 16)]


def test_local_day_follows_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        frame = spark.sql("select timestamp'2024-01-02 00:00:00' as t")
        assert frame.select(F.to_date(times.day_window("t").start)).first()[0] == date(2024, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_period_label(spark):
    assert one(spark, times.period_label(times.period_start("x")), datetime(2024, 1, 1, 9, 57), "timestamp") == \
        "2024-01-01 09:50:00,2024-01-01 10:00:00"
    assert one(spark, times.period_label(times.period_start("x"), legacy=True), datetime(2024, 1, 1, 9, 57), "timestamp") == \
        "2024-01-01 09:50:00,2024-01-01 09:60:00"
    assert one(spark, times.period_label(times.period_start("x"), legacy=True), datetime(2024, 1, 1, 9, 0), "timestamp") == \
        "2024-01-01 09:00:00,2024-01-01 09:10:00"


def test_lateness_class(spark):
    frame = spark.sql("select timestamp'2024-01-01 00:00:00' e, timestamp'2024-01-01 00:15:00' r")
    got = frame.select(times.lateness_class("e", "r", 900), times.lateness_class("e", "r", 900, inclusive=False),
                       times.lateness_class("e", F.lit(None).cast("timestamp"), 900)).first()
    assert tuple(got) == ("timely", "delayed", None)


def test_special_types(spark):
    cases = {None: True, "": True, "155": False, "184|3": False, "3|0170": False, "154|185": True, "1155": True,
             "155x": True, "1|2|160": False}
    frame = spark.createDataFrame([(k,) for k in cases], "x string").select("x", text.not_special("x").alias("y"))
    assert {r.x: r.y for r in frame.collect()} == cases


def test_status_rules(spark):
    frame = spark.createDataFrame([("11",), ("10",), ("2",), ("00",), ("0",), (None,)], "x string")
    got = frame.select(text.status_ok_no_zero("x"), text.status_ok_zero_code("x"), text.installed("x")).collect()
    assert [tuple(r) for r in got] == [(True, False, True), (False, False, True), (False, False, False),
                                       (False, True, True), (False, True, True), (None, None, None)]


def test_drop_sentinel(spark, rows):
    frame = spark.createDataFrame([("G1",), ("无数据",), (None,)], "g string")
    assert rows(text.drop_sentinel(frame, "g")) == [("G1",)]


def test_edit_distance(spark):
    pairs = [("冀A79DT9_0", "冀A79DT9_3", 1), ("默A00000_9", "默A00000_9", 9), ("", "abc", 3), (None, "ab", 2), ("kitten", "sitting", 3)]
    frame = spark.createDataFrame(pairs, "a string, b string, d int")
    assert all(r[0] == r[1] for r in frame.select("d", text.edit_distance("a", "b")).collect())
    limited = [r[0] for r in frame.select(text.edit_distance("a", "b", limit=2)).collect()]
    assert limited == [1, -1, -1, 2, -1]


def test_regex_extractors(spark):
    beat = '{"R":[{"gantryId":"G1","RSUStatus":"21"},{"gantryId":"G2","RSUStatus":"11"}],"C":[{"statusCode":""}]}'
    assert one(spark, text.find_all("x", "RSUStatus"), beat) == ["21", "11"]
    assert one(spark, text.find_first("x", "gantryId"), beat) == "G1"
    assert one(spark, text.find_first("x", "statusCode"), beat) == ""
    assert one(spark, text.find_first("x", "absent"), beat) is None
    assert one(spark, text.find_count("x", r'"gantryId":"\w*"'), beat) == 2
    assert one(spark, text.find_count_equal("x", "RSUStatus", "21"), beat) == 1


def test_null_access(spark):
    frame = spark.sql("select cast(null as string) s, cast(null as bigint) n")
    assert tuple(frame.select(text.or_blank("s"), text.or_zero("n")).first()) == ("", 0)


def test_pack_and_rates(spark):
    frame = spark.sql("select array(1, 0, 3) a, 1 p, 16 q, 0 z")
    got = frame.select(measures.pack(F.col("a"), True), measures.pack(F.col("a"), False),
                       measures.rate(F.col("p"), F.col("q")), measures.rate(F.col("p"), F.col("z"))).first()
    assert tuple(got) == ("|1|0|3|", "1|0|3", Decimal("0.063"), None)


def test_totals_are_packed_alike_whether_zero_or_not(spark):
    frame = spark.sql("select 0L z, 12L n, -5000L m")
    def packed(*args):
        return frame.selectExpr(measures.pack_totals(*args)).first()[0]
    assert (packed(["z", "z"], False, True), packed(["z", "z"], False, False)) == ("|0|0|", "0|0")
    assert (packed(["z", "n"], False, True), packed(["n"], False, False)) == ("|0|12|", "12")
    assert (packed(["z", "z"], True, True), packed(["z", "m"], True, True)) == ("|0.0000|0.0000|", "|0.0000|-0.5000|")
    total = frame.selectExpr(f"{measures.amount('z')} as z", f"{measures.amount('m')} as m")
    assert dict(total.dtypes) == {"z": "decimal(20,4)", "m": "decimal(20,4)"}
    assert tuple(total.first()) == (Decimal(0), Decimal("-0.5"))


def test_wide_decimal_needs_no_trial(spark):
    frame = spark.sql("select * from values (1234567.25BD), (cast(null as decimal(12,4))), (-3.5BD) as t(fee)")
    tried, exact = (frame.select(measures.cents("fee", True, sure).alias("c")) for sure in (False, True))
    assert [r.c for r in exact.collect()] == [r.c for r in tried.collect()] == [12345672500, 0, -35000]


def test_money(spark):
    frame = spark.createDataFrame([("1.25",), (None,), ("12345678",), ("x",)], "fee string")
    got = [r[0] for r in frame.select(measures.money("fee")).collect()]
    assert got == [Decimal("1.2500"), Decimal(0), Decimal(0), Decimal(0)]
    assert frame.agg(F.sum(measures.cents("fee")).alias("t")).selectExpr(measures.amount("t"), measures.amount_text("t")).first()[0] == Decimal("1.2500")


def test_wide_money(spark):
    frame = spark.createDataFrame([("1.25",), (None,), ("12345678",), ("x",)], "fee string")
    total = frame.agg(F.sum(measures.cents("fee", wide=True)).alias("t")).selectExpr(measures.amount("t")).first()[0]
    assert total == Decimal("12345679.2500")
    with pytest.raises(Exception, match="(?i)overflow|out of range|cannot be represented"):
        spark.createDataFrame([("1e15",)], "fee string").agg(F.sum(measures.cents("fee", wide=True))).collect()


def java_hash(key: str) -> int:
    word = 0
    units = key.encode("utf-16-be")
    for i in range(0, len(units), 2):
        word = (word * 31 + int.from_bytes(units[i:i + 2], "big")) & 0xFFFFFFFF
    return word - 2 ** 32 if word >= 2 ** 31 else word


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=40), min_size=1, max_size=40))
def test_java_hash(spark, keys):
    frame = spark.createDataFrame([(k, java_hash(k)) for k in keys], "k string, h bigint")
    assert frame.where(rowkey.java_hash("k") != F.col("h")).count() == 0


def test_row_key(spark):
    for buckets, width in ((5, 2), (10, 2), (100, 2), (1000, 3), (64, 2), (5000, 4)):
        key = "G0004130010021100102020051323100002"
        want = str(abs(java_hash(key)) % buckets).rjust(width, "0") + key + "s"
        assert one(spark, rowkey.row_key("x", buckets, "s"), key) == want
    assert one(spark, rowkey.row_key("x", 1), "abc") == "abc"
    assert one(spark, rowkey.row_key("x", 100), "") is None


def test_members_are_found_by_their_whole_name(spark):
    beat = '{"xgantryId":"no","gantryId" : "G-1.a"}'
    assert one(spark, text.find_first("x", "gantryId"), beat) == "G-1.a"
    assert one(spark, text.find_all("x", "gantryId"), beat) == ["G-1.a"]
