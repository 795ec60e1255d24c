"""Jobs from files to tables."""

import json
import os

from tollspark.plans import jobs
from tollspark.sinks.tables import Upsert
from tollspark.sources import tables as sources
from tollspark.streaming import runs

PARTS = "year string, month string, day string, hour string"


def stream(spark, tmp_path, topic, *values):
    rows = [(topic, v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))) for v in values]
    spark.createDataFrame([*rows, ("other", "{}")], "topic string, value string").write.parquet(str(tmp_path / "in"))
    return sources.stream_table(spark, str(tmp_path / "in"), "topic string, value string")


def finish(queries):
    runs.await_all(queries.values())


def test_match_job(spark, tmp_path):
    charges = spark.createDataFrame(
        [("T1", "P", "G", "2020-05-13T23:00:00", "2020", "05", "13", "23"), ("T2", "Q", "G", "2020-05-13T22:00:00", "2020", "05", "13", "22"),
         ("T3", "P", "G", "2020-05-14T00:00:00", "2020", "05", "14", "00")],
        f"trade_id string, plate string, gantry_id string, trans_time string, {PARTS}")
    pictures = spark.createDataFrame([("V1", "P", "G", "2020-05-13T23:02:00", "2020", "05", "13", "23")],
                                     f"pic_id string, plate string, gantry_id string, pic_time string, {PARTS}")
    out = str(tmp_path / "out")
    total = jobs.match_job(charges, pictures, out, "now", 120, "2020", "05", "13").first()
    assert (total.total, total.matched, total.unmatched) == (2, 1, 1)
    assert [r.pic_ids for r in spark.read.parquet(f"{out}/success").collect()] == ["/V1"]
    assert spark.read.parquet(f"{out}/failure").count() == 1
    assert spark.read.parquet(f"{out}/by_row_key").columns == ["rowkey", "pic_ids", "run_time"]
    hour = jobs.match_job(charges, pictures, out, "now", 120, "2020", "05", "13", "22", granularity="hour").first()
    assert (hour.total, hour.matched) == (1, 0)


def test_daily_jobs(spark, tmp_path):
    exits = spark.createDataFrame(
        [("S", "North", "2020-05-12T23:59:59", 1, 1, 0, 1, "5", None, 0, 1, 1, "2020", "05", "13", "00")],
        "station_id string, station_name string, ex_time string, media_type int, vehicle_type int, vehicle_class int, sign_status int, "
        f"fee string, discount_fee string, multi_province int, pay_type int, actual_fee_class int, {PARTS}")
    jobs.exit_daily_job(exits, str(tmp_path / "exit"), "2020", "05", "13")
    assert os.path.isdir(tmp_path / "exit" / "collectDay=2020-05-13" / "eventDay=2020-05-12")
    issues = spark.createDataFrame([("P", "2020-05-12", 2, 82, "2020", "05", "13", "00")],
                                   f"pos_id string, oper_time string, card_type int, oper_type int, {PARTS}")
    jobs.issue_daily_job(issues, str(tmp_path / "issue"), "2020", "05", "13")
    assert spark.read.parquet(str(tmp_path / "issue")).first().chargeCardNum == 1


def test_gantry_job(spark, tmp_path):
    charge = {"tradeId": "T", "gantryId": "G1", "stationDBTime": "2020-07-12T08:00:00", "receiveTime": "2020-07-12 08:01:00.000",
              "mediaType": "1", "tradeResult": 0, "specialType": ""}
    dim = spark.createDataFrame([("G1", "R1", "T1")], "mjid string, roadid string, tollstation string")
    out = str(tmp_path / "out")
    finish(jobs.gantry_job(stream(spark, tmp_path, "g", charge, charge | {"receiveTime": "2020-07-12 09:00:00.000"}, "{broken"), dim, "g", out, trigger=None))
    row = Upsert(f"{out}/timeliness", ["gantry_id", "window_start"]).read(spark).first()
    assert (row.timely_sum, row.delay_sum, row.total_sum, row.roadid) == (1, 1, 2, "R1")
    assert Upsert(f"{out}/deal_success", ["gantry_id", "window_start"]).read(spark).first().success_obu_count == 2
    assert [r.value for r in spark.read.parquet(f"{out}/rejects").collect()] == ["{broken"]


def test_gantry_heartbeat_job(spark, tmp_path):
    beat = {"chargeUnitId": "S1", "heatVersion": "202007120709", "receiveTime": "2020-07-12 07:11:49.199",
            "RSUHeartbeatList": [{"gantryId": "G1", "RSUStatus": "21"}], "cameraHeartbeatList": [{"gantryId": "G1", "statusCode": "0"}]}
    dim = spark.createDataFrame([("G1", "R1", "T1")], "mjid string, roadid string, tollstation string")
    out = str(tmp_path / "out")
    finish(jobs.gantry_heartbeat_job(stream(spark, tmp_path, "h", beat, {"chargeUnitId": "S2", "heatVersion": "202007120709"}), dim, "h", out, trigger=None))
    hourly = {r.gantry_id: r.heartbeat_count for r in Upsert(f"{out}/hourly", ["gantry_id", "window_start"]).read(spark).collect()}
    assert hourly == {"G1": 1, "无数据": 1}
    daily = Upsert(f"{out}/daily", ["gantry_id", "window_start"]).read(spark).collect()
    assert [(r.gantry_id, str(r.rsu_status_rate), str(r.vplr_status_rate)) for r in daily] == [("G1", "1.000", "1.000")]


def test_lane_and_station_jobs(spark, tmp_path):
    exit_ = {"exTollStationId": "S", "exTollStationName": "North", "enTollLaneId": "L", "bl_SubCenter": "C", "exTime": "2020-05-13T23:00:14",
             "receiveTime": "2020-05-13 23:15:14.000", "mediaType": 1, "exVehicleType": "1", "signStatus": 1, "fee": 5}
    messages = stream(spark, tmp_path, "x", exit_, exit_ | {"exVehicleType": "2"})
    finish(jobs.lane_job(messages, "x", str(tmp_path / "lane"), trigger=None))
    row = spark.read.parquet(str(tmp_path / "lane" / "timeliness")).first()
    assert (row.entrance_lane_id, row.timely_sum, row.total_sum) == ("L", 2, 2)
    finish(jobs.station_job(messages, "x", str(tmp_path / "station"), trigger=None))
    row = spark.read.parquet(str(tmp_path / "station" / "stations")).first()
    assert (row.statisticDay, row.etcTypeCount[:5], str(row.totalTransFee)) == ("2020-05-13 23:00:00,2020-05-13 23:10:00", "1|1|0", "10.0000")
