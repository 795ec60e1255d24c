"""Toll records: the wire fields the jobs read, the column each becomes, and where its times come from.

Only the fields some job uses are listed: a JSON decoder costs what its schema asks for. Any other field stays
reachable through the raw text that `decode` can keep.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from tollspark.functions import text, times
from tollspark.functions.measures import MONEY


@dataclass(frozen=True)
class Record:
    """`fields` holds (wire name, column, type); wire names are case-sensitive."""

    name: str
    fields: tuple[tuple[str, str, str], ...]
    event_time: Callable[[Column], Column]
    receive_time: str = "receiveTime"
    from_raw: Callable[[Column], dict[str, Column]] | None = None

    def wire_names(self) -> list[str]:
        return [wire for wire, _, _ in self.fields]

    def wire_schema(self) -> T.StructType:
        """All-string schema: numbers, quoted numbers and nested arrays all decode to their text."""
        return T.StructType([T.StructField(name, T.StringType()) for name in self.wire_names()])


def _iso(field: str) -> Callable[[Column], Column]:
    return lambda record: times.parse_iso(record.getField(field))


# Wire names of the records.
EXIT = Record(
    "exit transaction",
    (
        ("id", "id", "string"),
        ("exTollStationId", "station_id", "string"),
        ("exTollStationName", "station_name", "string"),
        ("exTollLaneId", "exit_lane_id", "string"),
        ("enTollLaneId", "entrance_lane_id", "string"),
        ("bl_SubCenter", "sub_center", "string"),
        ("exTime", "ex_time", "string"),
        ("receiveTime", "receive_text", "string"),
        ("mediaType", "media_type", "int"),
        ("exVehicleType", "vehicle_type", "int"),
        ("exVehicleClass", "vehicle_class", "int"),
        ("signStatus", "sign_status", "int"),
        ("fee", "fee", MONEY),
        ("discountFee", "discount_fee", MONEY),
        ("multiProvince", "multi_province", "int"),
        ("payType", "pay_type", "int"),
        ("actualFeeClass", "actual_fee_class", "int"),
        ("specialType", "special_type", "string"),
        ("splitProvince", "split_province", "string"),
    ),
    _iso("exTime"),
)
ENTRANCE = Record(
    "entrance transaction",
    (
        ("id", "id", "string"),
        ("enTollStationId", "station_id", "string"),
        ("enTollLaneId", "entrance_lane_id", "string"),
        ("bl_SubCenter", "sub_center", "string"),
        ("enTime", "en_time", "string"),
        ("receiveTime", "receive_text", "string"),
        ("mediaType", "media_type", "int"),
        ("vehicleType", "vehicle_type", "int"),
        ("vehicleClass", "vehicle_class", "int"),
        ("signStatus", "sign_status", "int"),
    ),
    _iso("enTime"),
)
GANTRY = Record(
    "gantry charge",
    (
        ("tradeId", "trade_id", "string"),
        ("gantryId", "gantry_id", "string"),
        ("vehiclePlate", "plate", "string"),
        ("transTime", "trans_time", "string"),
        ("stationDBTime", "station_db_time", "string"),
        ("receiveTime", "receive_text", "string"),
        ("mediaType", "media_type", "int"),
        ("tradeResult", "trade_result", "int"),
        ("specialType", "special_type", "string"),
    ),
    _iso("stationDBTime"),
)
PICTURE = Record(
    "gantry picture",
    (
        ("picId", "pic_id", "string"),
        ("gantryId", "gantry_id", "string"),
        ("vehiclePlate", "plate", "string"),
        ("picTime", "pic_time", "string"),
        ("receiveTime", "receive_text", "string"),
    ),
    _iso("picTime"),
)
LANE_HEARTBEAT = Record(
    "lane heartbeat",
    (
        ("id", "id", "string"),
        ("tollStationId", "station_id", "string"),
        ("tollLaneId", "lane_id", "string"),
        ("rsuStatus", "rsu_status", "string"),
        ("VPLRStatus", "vplr_status", "string"),
        ("laneControllerStatus", "lane_controller_status", "string"),
        ("receiveTime", "receive_text", "string"),
    ),
    lambda record: times.event_time_from_id(record.getField("id")),
)
# The gantry and its device states are the first ones named anywhere in the message.
GANTRY_HEARTBEAT = Record(
    "gantry heartbeat",
    (
        ("chargeUnitId", "charge_unit_id", "string"),
        ("heatVersion", "heartbeat_version", "string"),
        ("receiveTime", "receive_text", "string"),
    ),
    lambda record: times.event_time_from_version(record.getField("heatVersion")),
    from_raw=lambda raw: {
        "gantry_id": text.find_first(raw, "gantryId"),
        "rsu_status": text.find_first(raw, "RSUStatus"),
        "vplr_status": text.find_first(raw, "statusCode"),
    },
)
RECORDS = (EXIT, ENTRANCE, GANTRY, PICTURE, LANE_HEARTBEAT, GANTRY_HEARTBEAT)

# Gantry dimension, all text; `mjid` is the gantry id.
DIMENSION_COLUMNS = ("stationid", "stationname", "mjtype", "mjid", "mjname", "tollstation", "tollstationhex",
                     "roadid", "roadname")
PLATE_LOG_SCHEMA = "id string, plate string, time string"


def device_rows(heartbeats, raw: str = "value"):
    """One row per device of a gantry heartbeat instead of the first device standing for all.

    `kind` is `rsu` or `camera`; each device carries its own gantry and status.
    """
    devices = {"rsu": ("RSUHeartbeatList", "RSUStatus"), "camera": ("cameraHeartbeatList", "statusCode")}
    schema = ", ".join(f"{arr}: array<struct<gantryId: string, {status}: string>>" for arr, status in devices.values())
    parsed = F.explode(F.array(F.from_json(F.col(raw), f"struct<{schema}>"))).alias("_lists")

    def described(kind: str, status: str):
        return lambda device: F.struct(F.lit(kind).alias("kind"), device.getField("gantryId").alias("gantry_id"),
                                       device.getField(status).alias("status"))

    entries = [F.coalesce(F.transform(F.col("_lists").getField(arr), described(kind, status)), F.array())
               for kind, (arr, status) in devices.items()]
    keep = [F.col(c) for c in heartbeats.columns if c not in ("gantry_id", "rsu_status", "vplr_status", raw)]
    exploded = heartbeats.select(*keep, parsed).select(*keep, F.explode(F.concat(*entries)).alias("device"))
    return exploded.select(*[c for c in exploded.columns if c != "device"], "device.*")
