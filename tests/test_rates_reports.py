from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tollspark.operators import rates, reports, summary

T0 = datetime(2024, 1, 1, 12)


def gantry(spark, *rows):
    return spark.createDataFrame(rows, "gantry_id string, event_time timestamp, receive_time timestamp, media_type int, "
                                       "trade_result int, special_type string")


def late(seconds, gantry_id="G1", special=None, media=1, result=0):
    return gantry_id, T0, None if seconds is None else datetime.fromtimestamp(T0.timestamp() + seconds), media, result, special


def test_timeliness_threshold_and_nulls(spark):
    frame = gantry(spark, late(899), late(900), late(901), late(None))
    lax = rates.lane_timeliness(frame, ["gantry_id"], 900).first()
    assert (lax.timely_sum, lax.delay_sum, lax.total_sum, lax.timely_rate) == (2, 1, 4, Decimal("0.500"))
    strict = rates.timeliness(frame, ["gantry_id"], 900, inclusive=False).first()
    assert (strict.timely_sum, strict.delay_sum) == (1, 2)


def test_null_gantry_is_grouped_but_not_counted(spark):
    dim = spark.createDataFrame([("G1", "R1", "T1")], "mjid string, roadid string, tollstation string")
    out = {r.gantry_id: r for r in rates.gantry_timeliness(gantry(spark, late(1), late(1, None)), dim).collect()}
    assert (out["G1"].total_sum, out["G1"].roadid) == (1, "R1")
    assert (out[None].timely_sum, out[None].total_sum, out[None].timely_rate, out[None].roadid) == (1, 0, None, None)


def test_repeated_dimension_keys_do_not_multiply(spark):
    dim = spark.createDataFrame([("G1", "R2", "T2"), ("G1", "R1", "T1")], "mjid string, roadid string, tollstation string")
    row, = rates.gantry_timeliness(gantry(spark, late(1)), dim).collect()
    assert (row.total_sum, row.roadid, row.tollstation) == (1, "R1", "T1")


def test_deal_success(spark):
    frame = gantry(spark, late(1), late(1, result=1), late(1, special="155"), late(1, media=2, special="3|4"), late(1, media=9))
    row = rates.deal_success(frame, ["gantry_id"]).first()
    assert (row.success_obu_count, row.fail_obu_count, row.all_obu_count) == (1, 1, 2)
    assert (row.all_cpc_count, row.cpc_success_rate, row.cpc_fail_rate) == (1, Decimal("1.000"), Decimal("0.000"))
    assert row.all_count == 4
    none = rates.deal_success(gantry(spark, late(1, special="160")), ["gantry_id"]).first()
    assert (none.all_obu_count, none.obu_success_rate) == (0, None)


def beats(spark, *rows):
    return spark.createDataFrame([(*r, T0) for r in rows], "lane_id string, rsu_status string, vplr_status string, event_time timestamp")


def test_device_rates(spark):
    frame = beats(spark, ("L1", "11", "0"), ("L1", "10", "00"), ("L1", "2", "099"), ("L2", "2", "2"), ("L3", None, "0"))
    out = {r.lane_id: r for r in rates.device_rate_daily(frame, ["lane_id"], {"rsu_status": "no_zero", "vplr_status": "zero_code"}).collect()}
    assert (out["L1"].rsu_status_rate, out["L1"].vplr_status_rate) == (Decimal("0.500"), Decimal("0.667"))
    assert (out["L2"].rsu_status_rate, out["L2"].vplr_status_rate) == (None, None)
    assert (out["L3"].rsu_status_rate, out["L3"].vplr_status_rate) == (None, Decimal("1.000"))
    strict = rates.device_rate_daily(frame, ["lane_id"], {"rsu_status": "no_zero", "vplr_status": "zero_code"}, drop_null_status=True)
    assert {r.lane_id for r in strict.collect()} == {"L1", "L2"}
    assert [r.lane_id for r in rates.healthy_devices(frame, ["lane_id"], {"vplr_status": "no_zero"}).collect()] == []


def test_healthy_uses_the_unrounded_rate(spark):
    frame = beats(spark, *[("L1", "1", "1")] * 1599, *[("L1", "0", "1")] * 400)
    out = rates.healthy_devices(frame, ["lane_id"], {"rsu_status": "no_zero"}, threshold=0.8)
    assert out.count() == 0  # 1599/1999 rounds to 0.800 but is below


def exit_frame(spark, *rows):
    return spark.createDataFrame(rows, "station_id string, station_name string, event_time timestamp, media_type int, vehicle_type int, "
                                       "vehicle_class int, sign_status int, fee string, discount_fee string, multi_province int, "
                                       "pay_type int, actual_fee_class int")


def row(media=1, kind=1, cls=0, sign=1, fee="10", discount="1", province=0, pay=1, way=2):
    return "S", "North", T0, media, kind, cls, sign, fee, discount, province, pay, way


def test_exit_report_columns_and_values(spark):
    frame = exit_frame(spark, row(), row(2, 11, 8, 2, "2.5"), row(3, 99, 99, 1, None), row(4, fee="12345678"), row(9, pay=None), row(None))
    report = reports.exit_station_daily(frame, F.lit("2024-01-02"), F.to_date("event_time"))
    assert len(report.columns) == 34
    got = report.first()
    assert got.etcTypeCount == "|1|" + "0|" * 15 and got.cpcTypeCount == "|0|0|0|0|1|" + "0|" * 11
    assert (got.cpcFailCount, got.cpcFailFee, got.paperSuccessCount, got.pagerIssueSuccessSumFee) == (1, Decimal("2.5000"), 1, Decimal(0))
    assert (got.m1PassNum, got.noMediaTypeTotalNum, got.totalVeCnt, got.totalTransFee) == (1, 1, 6, Decimal("32.5000"))
    assert got.payTypeTotalNum == "|5|0|0|0|0|0|0|"
    assert got.actualWayTotalFee == "|0.0000|32.5000|0.0000|0.0000|0.0000|0.0000|0.0000|"
    legacy = reports.exit_station_daily(frame, F.lit("d"), F.to_date("event_time"), legacy=True).first()
    assert legacy.actualWayTotalFee == "|22.5000|0.0000|0.0000|0.0000|0.0000|0.0000|0.0000|"
    arrays = reports.exit_station_daily(frame, F.lit("d"), F.to_date("event_time"), packed=False).first()
    assert arrays.payTypeTotalNum == [5, 0, 0, 0, 0, 0, 0] and arrays.actualWayTotalFee[1] == Decimal("32.5000")


def test_period_reports(spark):
    frame = exit_frame(spark, row(), row(2))
    out = reports.exit_station_period(frame)
    assert len(out.columns) == 33 and out.first().statisticDay == "2024-01-01 12:00:00,2024-01-01 12:10:00"
    assert out.first().payTypeTotalNum == "2|0|0|0|0|0|0"
    entrance = reports.entrance_station_period(frame.drop("station_name"), "10 seconds")
    assert len(entrance.columns) == 12
    assert tuple(entrance.first())[:3] == ("S", "S", "2024-01-01 12:00:00,2024-01-01 12:00:10")


def test_report_combines_before_its_only_exchange(spark):
    """A station with a third of all rows, and more, reaches the exchange as one row per task."""
    frame = spark.range(4000, numPartitions=4).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('S', id % 50) end as station_id", "'n' as station_name", "1 as media_type", "1 as vehicle_type",
        "0 as vehicle_class", "1 as sign_status", "cast(2500000.5 as decimal(12,4)) as fee", "cast(1 as decimal(10,4)) as discount_fee", "0 as multi_province",
        "1 as pay_type", "1 as actual_fee_class", "timestamp'2024-01-01' as event_time")
    report = reports.exit_station_daily(frame, F.lit("d"), F.to_date("event_time"), wide=True)
    body = report._jdf.queryExecution().executedPlan().toString()
    assert body.count("Exchange") == 1 and "partial_sum" in body[body.index("Exchange"):]
    hot = {r.extollstationid: r for r in report.collect()}["hot"]
    assert (hot.totalVeCnt, str(hot.totalTransFee)) == (1334, "3335000667.0000")


def test_report_cells_shrink_a_busy_station(spark):
    frame = exit_frame(spark, *[row()] * 500, *[row(2)] * 500)
    plan = reports.exit_station_daily(frame, F.lit("d"), F.to_date("event_time"), cells=True)._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rindex("Exchange hashpartitioning")
    assert "partial_sum" in plan[first_exchange:]
    assert "PythonUDF" not in plan


def test_report_counts_rows_and_sums_only_amounts(spark):
    """A row that is no cell is counted: 82 sums of ones, each asked for NULL on every row, were a third of the time."""
    frame = exit_frame(spark, row(), row(None, None, None, None, "-2.5", None, None, None, None), row(2, 99, 99, 7, "-0.5", "0", 5, 9, 9),
                       row(2, 26, 28, 2, "3", "0", 1, 7, 11))
    plan = reports.exit_station_daily(frame, F.lit("d"), F.to_date("event_time"), wide=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text and text.count("partial_sum(") <= 24
    got = plan.first()
    assert (got.totalVeCnt, got.totalTransFee, got.etcCnt, got.singleProTransTotalNum, got.mutilProTransTotalNum) == (4, Decimal("10"), 1, 1, 1)
    assert got.cpcTypeCount == "|" + "0|" * 15 + "1|" and got.cpcClassCount == "|" + "0|" * 11 + "1|"
    assert (got.cpcFailCount, got.cpcFailFee, got.cpcSuccessCount, got.cpcSuccessFee) == (1, Decimal(3), 0, Decimal(0))
    assert got.actualWayTotalNum == "|0|1|0|0|0|0|1|" and got.payTypeTotalFee == "|10.0000|0.0000|0.0000|0.0000|0.0000|0.0000|3.0000|"
    cells = reports.exit_station_daily(frame, F.lit("d"), F.to_date("event_time"), wide=True, cells=True).first()
    assert cells == got


def test_large_amounts_are_counted_in_one_pass(spark):
    """The rows of exit_station_wide: amounts a thousandfold, no discounts, missing prices."""
    from tollspark.plans import views

    lines = spark.sql("""select * from values (97L, 8L, 7L, 1, 1.0D, 12345.5D, 0.1D, 0.0D, 'A', 'O', timestamp'2024-01-05'),
      (12L, 9L, 7L, 2, 1.0D, 10.25D, 0.1D, 0.0D, 'R', 'F', timestamp'2024-01-05'), (13L, 9L, 7L, 2, 50.0D, null, 0.1D, 0.0D, 'R', 'F', timestamp'2024-01-05')
      as t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)""")
    report = reports.exit_station_daily(views.over("v_exit_large", lines), F.lit("d"), F.col("event_day").cast("string"), wide=True)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan and plan.count("partial_sum(") <= 24
    got = report.first()
    assert (got.totalVeCnt, got.totalTransFee, got.totalDiscountFee) == (3, Decimal("12345510.25"), Decimal(0))
    assert (got.etcTotalTransFee, got.cpcFailFee, got.noMediaTypeTotalNum) == (Decimal("12345500"), Decimal("10.25"), 1)
    assert got.payTypeTotalNum == "|2|0|0|0|0|0|0|" and got.payTypeTotalFee.startswith("|10.2500|0.0000|")


def test_sliding_count_equals_spark_window(spark, rows):
    frame = spark.range(500).selectExpr("id % 3 as k", "timestamp_seconds(id * 37 - 4000) as event_time")
    for length, slide in (("25 minutes", "10 minutes"), ("10 minutes", "10 minutes"), ("7 minutes", "3 minutes"), ("1 hour", "20 minutes")):
        want = frame.groupBy(F.window("event_time", length, slide).alias("w"), "k").count().select("k", "w.start", "w.end", "count")
        assert rows(summary.sliding_count(frame, ["k"], length, slide)) == rows(want)


def test_token_count(spark):
    frame = spark.createDataFrame([("a b  a  ",), ("",), ("   ",), (" x",), (None,)], "t string")
    assert {r.value: r.n for r in summary.token_count(frame, "t").collect()} == {"a": 2, "b": 1, "": 3, "x": 1}
    dotted = spark.createDataFrame([("a.b.a..",), ("\\d",)], "t string")
    assert {r.value: r.n for r in summary.token_count(dotted, "t", ".").collect()} == {"a": 2, "b": 1, "\\d": 1}
    assert {r.value for r in summary.token_count(dotted, "t", "exVlp").collect()} == {"a.b.a..", "\\d"}


def test_latest_and_distinct(spark, rows):
    frame = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (None, 1, "z")], "k int, t int, v string")
    assert rows(summary.latest_by_key(frame, ["k"], ["t"])) == [(1, 7, "c"), (None, 1, "z")]
    assert summary.distinct_lanes(frame, ["k", "t"]).first().lanes == 3


def test_issue_flow_and_rate_sum(spark):
    frame = spark.createDataFrame([("P", 2, 82), ("P", 1, 9), ("P", 3, 65), ("P", 2, 9)], "pos_id string, card_type int, oper_type int")
    got = reports.issue_flow_daily(frame, F.lit("c"), F.lit("e")).first()
    assert tuple(got) == ("P", "c", "e", 1, 1, 1)
    sums = rates.rate_sum_by_station(spark.sql("select 's' station_id, cast(0.5 as decimal(10,3)) rsu_status_rate"))
    assert sums.first().rate_sum == Decimal("0.500")


def test_daily_report_has_one_exchange(spark, sf_dir):
    from tollspark.plans.queries import all_queries

    plan = all_queries()["exit_station_daily"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_days_of_the_wide_report_make_a_small_key(spark, tmp_path):
    """A constant collection day is no key, and the event day is a date until the report is done."""
    from tollspark.plans.queries import COLLECT_DAY, all_queries

    spark.sql("""select * from values (97L, 8L, 7L, 1, 1.0D, 12345.5D, 0.1D, 0.0D, 'A', 'O', timestamp_ntz'2024-01-05'),
      (12L, 9L, 7L, 2, 1.0D, 10.25D, 0.1D, 0.0D, 'R', 'F', timestamp_ntz'2024-01-05'), (13L, 9L, 7L, 2, 50.0D, null, 0.1D, 0.0D, 'R', 'F', null),
      (14L, 9L, 7L, 2, 50.0D, 1.5D, 0.1D, 0.0D, 'R', 'F', null), (15L, 9L, null, 2, 50.0D, 1.5D, 0.1D, 0.0D, 'R', 'F', timestamp_ntz'2024-01-06')
      as t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)
      """).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("exit_station_wide", "exit_station_daily"):
        report = all_queries()[name](spark, str(tmp_path))
        plan = report._jdf.queryExecution().executedPlan().toString()
        dealt = plan[plan.index("hashpartitioning("):].split(")")[0]
        assert dealt.count("#") == 3 and COLLECT_DAY not in dealt and "event_day" in dealt
        assert [report.schema[day].dataType.simpleString() for day in ("collectDay", "eventDay")] == ["string", "string"]
        got = {(r.extollstationid, r.collectDay, r.eventDay): r.totalVeCnt for r in report.collect()}
        assert got == {("S7", COLLECT_DAY, "2024-01-05"): 2, ("S7", COLLECT_DAY, None): 2, (None, COLLECT_DAY, "2024-01-06"): 1}
