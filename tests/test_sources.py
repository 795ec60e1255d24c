import json

import pytest
from pyspark.sql import functions as F, types as T

from tollspark.functions import times
from tollspark.sources import decode as decoding, records, tables

EXIT = {"id": "X1", "exTollStationId": "S1", "exTollStationName": "North", "exTollLaneId": "L1", "enTollLaneId": "L0",
        "bl_SubCenter": "C", "exTime": "2020-05-13T23:00:14", "receiveTime": "2020-05-13 23:01:14.250", "mediaType": 1,
        "exVehicleType": "11", "exVehicleClass": 0, "signStatus": 1, "fee": 12.5, "discountFee": "0.63",
        "multiProvince": 0, "payType": 4, "actualFeeClass": 11, "specialType": "155|3",
        "splitProvince": [{"a": 1}], "unread": "x"}
BEAT = {"receiveTime": "2020-07-12 07:11:49.199", "chargeUnitId": "S008136042000720", "heatVersion": "202007120709",
        "RSUHeartbeatList": [{"gantryId": "G1", "RSUStatus": "21", "controlId": "1"}, {"gantryId": "G1", "RSUStatus": "11"}],
        "cameraHeartbeatList": [{"gantryId": "G1", "statusCode": "099"}, {"gantryId": "G1", "statusCode": "0"}]}


def messages(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) or v is None else json.dumps(v, separators=(",", ":")),) for v in values], "value string")


def test_decode_exit(spark):
    row = decoding.decode(messages(spark, EXIT), records.EXIT).first()
    assert (row.media_type, row.vehicle_type, str(row.fee), str(row.discount_fee)) == (1, 11, "12.5000", "0.6300")
    assert row.split_province == '[{"a":1}]' and row.valid
    assert (row.receive_time - row.event_time).total_seconds() == 60.25


def test_codes_that_are_no_numbers_become_null(spark):
    row = decoding.decode(messages(spark, EXIT | {"mediaType": "a", "fee": "12345678"}), records.EXIT).first()
    assert row.media_type is None and row.fee is None and row.valid


def test_rejects(spark):
    values = [EXIT, "{broken", EXIT | {"exTime": "never"}, None, {k: v for k, v in EXIT.items() if k != "exTime"}, "[]"]
    good, bad = decoding.split_valid(decoding.decode(messages(spark, *values), records.EXIT, keep_raw=True))
    assert good.count() == 1 and bad.count() == 5
    assert "{broken" in [r.value for r in bad.select("value").collect()]


@pytest.mark.parametrize("record", records.RECORDS, ids=lambda r: r.name)
def test_records_decode_to_their_columns(spark, record):
    out = decoding.decode(messages(spark, "{}"), record)
    assert {c for _, c, _ in record.fields} <= set(out.columns)
    assert {"event_time", "receive_time", "valid"} <= set(out.columns)


def test_gantry_heartbeat(spark):
    beats = decoding.decode(messages(spark, BEAT), records.GANTRY_HEARTBEAT, keep_raw=True)
    row = beats.first()
    assert (row.gantry_id, row.rsu_status, row.vplr_status) == ("G1", "21", "099")
    assert str(row.event_time) == "2020-07-12 07:09:00"
    devices = [(r.kind, r.status) for r in records.device_rows(beats).collect()]
    assert devices == [("rsu", "21"), ("rsu", "11"), ("camera", "099"), ("camera", "0")]


def test_lane_heartbeat(spark):
    row = decoding.decode(messages(spark, {"id": "G0070360130060101003020200709003518", "rsuStatus": "11"}), records.LANE_HEARTBEAT).first()
    assert str(row.event_time) == "2020-07-09 00:35:18" and row.rsu_status == "11"


def test_decode_with_schema_json(spark, rows):
    schema = '{"type":"struct","fields":[{"name":"eventTime","type":"string","nullable":true,"metadata":{}},' \
             '{"name":"userID","type":"string","nullable":true,"metadata":{}}]}'
    frame = messages(spark, {"eventTime": "t", "userID": 7}, {"eventTime": "t"}, "{broken")
    assert rows(decoding.decode_with_schema_json(frame, schema)) == [("t", "7")]
    assert decoding.decode_with_schema_json(frame, schema, required=[]).count() == 3


def test_decode_with_schema_json_parses_once(spark):
    schema = T.StructType().add("eventTime", "string").add("userID", "string").json()
    flat = decoding.decode_with_schema_json(messages(spark, {"eventTime": "2024-01-01", "userID": 7}), schema)
    plan = flat.where("userID <> eventTime").select("userID")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_kafka_options():
    assert tables.kafka_options("h:9092", ["a", "b"], "earliest", 10) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "10"}
    assert "maxOffsetsPerTrigger" not in tables.kafka_options("h:9092", "a")


def test_kafka_text_and_split(spark, rows):
    frame = spark.createDataFrame([("a", 0, 5, bytearray(b"x")), ("b", 1, 6, bytearray(b"y"))], "topic string, partition int, offset bigint, value binary")
    assert rows(tables.split_by_topic(tables.kafka_text(frame), "b")) == [("b", 1, 6, "y")]


def test_scan_partition_prunes(spark, tmp_path):
    frame = spark.createDataFrame([(1, "2020", "05", "13", "22"), (2, "2020", "05", "13", "23"), (3, "2020", "05", "14", "23")],
                                  "n int, year string, month string, day string, hour string")
    frame.write.partitionBy("year", "month", "day", "hour").parquet(str(tmp_path / "ods"))
    ods = spark.read.schema(frame.schema).parquet(str(tmp_path / "ods"))
    day = tables.scan_partition(spark, ods, "2020", "05", "13")
    assert {r.n for r in day.collect()} == {1, 2}
    hour = tables.scan_partition(spark, ods, "2020", "05", "13", "23", granularity="hour")
    assert {r.n for r in hour.collect()} == {2}
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_plate_log_and_views(spark, tmp_path):
    (tmp_path / "log").write_text("G0004130010021100102020051323100002,冀A79DT9_0,2020-05-13T23:03:14", encoding="utf-8")
    row = tables.read_plate_log(spark, str(tmp_path / "log")).first()
    assert (row.plate, row.gantry_id, str(row.time)) == ("冀A79DT9_0", "G000413001002110010", "2020-05-13 23:03:14")
    charges = spark.createDataFrame([("T", "P", "G", "2020-05-13T23:03:14")], "trade_id string, plate string, gantry_id string, trans_time string")
    assert tables.etc_view(charges).select(times.fmt_ts("trans_time"), "trans_unix").first()[1] == 1589410994
    pictures = charges.toDF("pic_id", "plate", "gantry_id", "pic_time")
    assert tables.viu_view(pictures).first().pic_unix == 1589410994


def test_read_dim(spark, tmp_path):
    frame = spark.createDataFrame([tuple("abcdefghi")], ", ".join(f"{c} string" for c in records.DIMENSION_COLUMNS))
    frame.selectExpr("*", "'x' as more").write.parquet(str(tmp_path / "dim"))
    assert tables.read_dim(spark, str(tmp_path / "dim")).columns == list(records.DIMENSION_COLUMNS)


def test_hour_decides_the_granularity(spark):
    ods = spark.createDataFrame([("2020", "05", "13", "22"), ("2020", "05", "13", "23")],
                                "year string, month string, day string, hour string")
    assert tables.scan_partition(spark, ods, "2020", "05", "13", "23").count() == 1
    assert tables.scan_partition(spark, ods, "2020", "05", "13").count() == 2
    for hour, granularity in (("23", "day"), (None, "hour")):
        with pytest.raises(ValueError):
            tables.scan_partition(spark, ods, "2020", "05", "13", hour, granularity)


def test_wide_records_read_every_field_once(spark):
    from tollspark.sources import wide

    for record in wide.ALL.values():
        names = [column for _, column, _ in record.fields()]
        assert len(set(names)) == len(names) and set(record.wires.split()) | {w for w, _, _ in record.base.fields} == {
            wire for wire, _, _ in record.fields()}
    assert len(wide.EXIT.fields()) >= 173 and len(wide.GANTRY.fields()) >= 166
    texts = ['{"id":"T1","exTime":"2020-05-13T23:00:14","fee":"12.5","exVehicleType":"x","TAC":"no","tac":7,"gantryPassInfo":[1,{"a":"b"}]}',
             '{"id":"T2","exTime":"2020-05-13T23:00:14","id":"again"}', '{"id":', "null", "[1]", None, '{"exTime":"soon"}', '{"exTime":"2020-05-13T23:00:14"}']
    messages = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    rows = {row.n: row for row in wide.decode(messages, wide.EXIT, keep_raw=True).collect()}
    assert [i for i in rows if rows[i].valid] == [0, 7] and rows[0].value is None and rows[2].value == texts[2]
    assert (rows[0].id, str(rows[0].fee), rows[0].vehicle_type, rows[0].tac, rows[0].gantry_pass_info) == (
        "T1", "12.5000", None, "7", '[1,{"a":"b"}]')
    spark.conf.set("spark.sql.debug.maxToStringFields", 5000)
    plan = wide.decode(messages, wide.EXIT)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.lower().replace("_", "").count("parsejson(") == 1


def test_devices_come_from_the_same_parse(spark):
    from tollspark.sources import wide

    text = ('{"chargeUnitId":"S1","heatVersion":"202007120709","RSUHeartbeatList":[{"gantryId":"G1","RSUStatus":"11"},{"gantryId":"G2"}],'
            '"cameraHeartbeatList":[{"gantryId":"G1","statusCode":"0"}],"otherHeartbeatList":[{"x":1}]}')
    bare = '{"chargeUnitId":"S2","heatVersion":"202007120709","cameraHeartbeatList":[{"gantryId":"G3","statusCode":"099"}]}'
    beats = wide.decode(spark.createDataFrame([(text,), (bare,)], "value string"), wide.GANTRY_HEARTBEAT)
    assert [(r.gantry_id, r.rsu_status, r.vplr_status) for r in beats.orderBy("charge_unit_id").collect()] == [
        ("G1", "11", "0"), ("G3", None, "099")]
    found = sorted((r.charge_unit_id, r.kind, r.gantry_id, r.status or "") for r in wide.devices(beats).collect())
    assert found == [("S1", "camera", "G1", "0"), ("S1", "rsu", "G1", "11"), ("S1", "rsu", "G2", ""), ("S2", "camera", "G3", "099")]


def test_wide_decode_copies_a_row_once_and_by_all_slots(spark, tmp_path):
    from tollspark.plans import queries
    from tollspark.sources import wide

    messages = spark.createDataFrame([('{"id":"T1","exTime":"2020-05-13T23:00:14"}',)], "value string")
    plan = wide.decode(messages, wide.EXIT)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1
    # One file with one block of rows is one partition, however wide the rows become.
    spark.sql("select id as event_id, timestamp_seconds(1704067200 + id) as ts, id % 9 as user_id, 'view' as event_type, "
              "1.5D as value, '{\"k\": 3}' as props from range(500)").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    found = queries.all_queries()["decode_exit"](spark, str(tmp_path))
    slots = spark.sparkContext.defaultParallelism
    used = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(used) > slots and sum(r["count"] for r in used) == 500
