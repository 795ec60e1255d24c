"""Full-width records: every field of a message, parsed once as VARIANT and read out in one step.

A wide record extends one of `records`: the fields that the jobs use keep their columns and types, all others become text
columns whose names are the wire names in snake case. Nested arrays without a type of their own stay JSON text; device lists
are arrays of structs from the same parse.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tollspark.functions import times
from tollspark.sources import records
from tollspark.sources.records import Record


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


@dataclass(frozen=True)
class WideRecord:
    """`wires` lists all fields of a message, and may name those of `base` or not. `lists` maps fields to array types."""

    base: Record
    wires: str
    lists: dict[str, str] = field(default_factory=dict)
    #: Columns from the decoded struct that no single field holds.
    derived: dict[str, str] = field(default_factory=dict)

    def fields(self) -> list[tuple[str, str, str]]:
        """(wire name, column, type) of every field, those of the base record first."""
        known = {wire for wire, _, _ in self.base.fields}
        rest = [w for w in self.wires.split() if w not in known]
        return [*self.base.fields, *[(w, snake(w), self.lists.get(w, "string")) for w in rest]]

    def schema(self) -> str:
        return ", ".join(f"`{wire}`: {kind}" for wire, _, kind in self.fields())


# The fields of the records, in the order of their messages.
_EXIT = """
    auth id modifyFlag sourceID transPayType tollProvinceId opentype transCode lDate shift batchNum loginTime
    triggerTime operId operName monitor monitorName monitorTime laneAppVer enWeight enAxleCount enTollStation
    enTollStationName enTollLane enTollStationHex enTollLaneHex enTollStationId enTollLaneId enTime
    entryOperatorID laneType exTollStation exTollStationName exTollLane exTollStationHex exTollLaneHex
    exTollStationId exTollLaneId exTime bl_SubCenter bl_Center mediaType mediaNo obuSign obuIssueFlag obuId
    supplierId cardCnt vCount inductCnt enVlp enVlpc exVlp exVlpc identifyVlp identifyVlpc enVehicleType
    exVehicleType enVehicleClass exVehicleClass exWeight axisInfo limitWeight overWeightRate axleCount
    electricalPercentage tac transFee transType terminalTransNo terminalNo serviceType algorithmIdentifier
    tollDistance realDistance vSpeed overTime freeType freeMode freeInfo balanceBefore balanceAfter fee
    discountFee payFee obuPayFee obuDiscountFee feeMileage collectFee rebateMoney cardCostFee unpayFee unpayFlag
    unpayCardCost ticketFee unifiedFee enTollMoney enFreeMoney enLastMoney returnMoneySn payCardType payCardNet
    payCardId payCardTranSn payType payOrderNum payCode payRebate identification invoiceType invoiceCode
    invoiceId invoiceCnt signStatus description specialType laneSpInfo spInfo vehicleSignId multiProvince
    cardVersion OBUVersion keyNum keyPressInfo paraVer provinceGroup gantryIdGroup tollIntervalsCount
    tollIntervalsGroup transTimeGroup chargefeeGroup chargeDiscountGroup rateModeVersionGroup
    rateParaVersionGroup tollfeeGroup passId verifyCode consumeTime sectionGroup roadType gantryPassCount
    gantryPassInfo feeProvInfo splitProvince vehicleSign shortFee shortFeeMileage feeRate actualFeeClass
    obuTotalAmount obuTotaldisCountAmount OBUtotalCount noCardCount ETCtotalAmount chargeMode provFee
    provTransCount discountType provinceDiscountFee originFee provinceCount provinceTransGroup feeBoardPlay
    spcRateVersion checkSign enVehicleId exVehicleId identifyVehicleId receiveTime year month day hour
"""
_ENTRANCE = """
    id transCode bl_SubCenter bl_Center lDate shift batchNum loginTime triggerTime operId operName monitor
    monitorName monitorTime laneAppVer laneType enTollStation enTollLane enTollStationHex enTollLaneHex
    enTollStationId enTollLaneId enTime mediaType obuSign obuIssueFlag obuId supplierId vCount balanceBefore
    transFee cardType cardNet cardId cardBox cardCount cardSn cardCnt inductCnt vlp vlpc identifyVlp
    identifyVlpc vehicleType vehicleClass TAC transType terminalNo enWeight axisInfo limitWeight overWeightRate
    enAxleCount electricalPercentage terminalTransNo signStatus description paraVer cardVersion OBUVersion
    keyNum keyPressInfo specialType laneSpInfo spInfo vehicleSignId passId vehicleSign vehicleId
    identifyVehicleId direction operationMedia chargeMode receiveTime
"""
_GANTRY = """
    OBUTradeResult OBUFeeSumAfter balanceBefore feeCalcSpecials feeVehicleType OBUInfoTypeRead OBULastGantryTime
    gantryHex OBUVehiclePlate OBUpayFeeSumBefore matchStatus payFee cleanDataFlag balanceAfter feeProvBeginHex
    laneNum provinceNumBefore vehicleType vlpc consumeTime enTollStationHex provMinFee stationDBTime
    OBUInfoTypeWrite stationValidTime transTime CPUVehicleType axleCount dealStatus stationDealTime updateResult
    cardfeeSumBefore CPUVlp PCRSUVersion keyVersion enTollStationName gantryPassCount pathFitFlag feeInfo2
    lastGantryFeePass CPUEndDate OBUProvfeeSumBefore gantryPassCountBefore antennaID enAxleCount feeInfo1
    OBUProvTradeSuccNumBefore CPUVlpc CPUStartDate OBUTotalTradeSuccNumAfter vehiclePicId noCardTimesAfter
    rateCompute lastGantryTime noCardTimesBefore tradeType CPCFeeTradeResult cardfeeSumAfter OBULastGantryHex
    tradeResult verifyCode OBUState vehiclePlate provMinFeeCalcMode CPUCardId OBUFeeSumBefore rateVersion
    modifyFlag OBUPassState provinceNumAfter OBUVehicleType tollIntervalId vehicleLength vehicleWidth TAC
    feeCalcSpecial payFeeGroup obuSign lastGantryHex enWeight vlp identifyVehicleId serviceType discountFee auth
    fee OBUMileageBefore feeSpare3 fitProvFlag feeSpare1 feeSpare2 OBUdiscountFeeSumAfter lastGantryHexFee
    gantryOrderNum OBUEndDate OBUElectrical validStatus OBUMAC OBUpayFeeSumAfter OBUMileageAfter enTime
    feeSumLocalBefore computerOrder lastGantryHexPass feeGroup feeCalcResult originFee vehicleSign rateFitCount
    OBUVlp terminalNo stationMatchTime passId hourBatchNo OBUVlpc gantryType mediaType tollParaVer
    lastGantryMilePass enTollLaneId tollIntervalSign passState transType originalFlag CPUNetID discountFeeGroup
    CPUVersion terminalTransNo gantryId isFixData CPUIssueID feeMileage OBUStartDate OBUSN vehicleSeat
    CPUVehiclePlate feeSumLocalAfterEF04 holidayState vehicleUserType provinceDiscountFee OBUVersion
    OBUProvTradeSuccNumAfter OBUTotalTradeSuccNumBefore OBUdiscountFeeSumBefore vehicleClass discountType
    algorithmIdentifier feeSumLocalAfter transFee interruptSignal payFeeProvSumLocal enLaneType transNo
    OBUProvPayFeeSumAfter CPUCardType OBUProvfeeSumAfter feeProvEF04 OBUIssueID readCiphertextVerify chargeMode
    tollModeVer totalWeight OBUProvPayFeeSumBefore vehicleHight tradeId specialType receiveTime
"""
_PICTURE = """
    picId gantryId gantryHex picTime gantryOrderNum driveDir cameraNum hourBatchNo shootPosition laneNum
    vehiclePlate vehicleSpeed identifyType vehicleModel vehicleColor imageSize licenseImageSize binImageSize
    reliability vehFeatureCode faceFeatureCode verifyCode tradeId matchStatus validStatus dealStatus
    relatedPicId allRelatedPicId stationDBTime stationDealTime stationValidTime stationMatchTime receiveTime
"""
_LANE_HEARTBEAT = """
    auth id tollStationId tollLaneId tollStation tollLane laneType laneSign heartBeatTime vehicleGreyListVersion
    vehicleGreyListRecTime vehicleBlackListVersion vehicleBlackListRecTime obuBlackListVersion
    obuBlackListRecTime cpuBlackListVersion cpuBlackListRecTime cpcGreyListVersion cpcGreyListRecTime
    spcRateVersion notenableSpcRateVersion notenableSpcRateRecTime laneStatus rsuStatus laneControllerStatus
    serverStatus cardReaderStatus railerStatus payEquipmentStatus VPLRStatus vehDetectorStatus
    axleDetectorStatus lightDetectorStatus HDVideoStatus feeBoardStatus hintsBoardStatus tradfficLight1Status
    infoBoardStatus entryOverloadStatus laneControllerManuID sysVer opsCode opsVer RSUManuID RSUHardwareVersion
    RSUSoftwareVersion cardReaderManuID cardReaderVersion chargeMode VPLRManuID receiveTime year month day hour
"""
_GANTRY_HEARTBEAT = """
    receiveTime chargeUnitId vehicleDetectorHeartbeatList RSUHeartbeatList gantryHeartbeatList cleanDataFlag
    cameraHeartbeatList chargeUnitHeartbeatList heatVersion otherHeartbeatList
"""

EXIT = WideRecord(records.EXIT, _EXIT)
ENTRANCE = WideRecord(records.ENTRANCE, _ENTRANCE)
GANTRY = WideRecord(records.GANTRY, _GANTRY)
PICTURE = WideRecord(records.PICTURE, _PICTURE)
LANE_HEARTBEAT = WideRecord(records.LANE_HEARTBEAT, _LANE_HEARTBEAT)
# A gantry heartbeat names its gantry and states only in its lists; the first of each stands for all.
GANTRY_HEARTBEAT = WideRecord(
    records.GANTRY_HEARTBEAT, _GANTRY_HEARTBEAT,
    lists={"RSUHeartbeatList": "array<struct<gantryId: string, RSUStatus: string>>",
           "cameraHeartbeatList": "array<struct<gantryId: string, statusCode: string>>"},
    derived={"gantry_id": "coalesce(get(_read.record.`RSUHeartbeatList`, 0).gantryId, get(_read.record.`cameraHeartbeatList`, 0).gantryId)",
             "rsu_status": "get(_read.record.`RSUHeartbeatList`, 0).RSUStatus",
             "vplr_status": "get(_read.record.`cameraHeartbeatList`, 0).statusCode"})
ALL = {"exit": EXIT, "entrance": ENTRANCE, "gantry": GANTRY, "picture": PICTURE, "lane_heartbeat": LANE_HEARTBEAT,
       "gantry_heartbeat": GANTRY_HEARTBEAT}


def decode(messages: DataFrame, record: WideRecord, value: str = "value", keep_raw: bool = False) -> DataFrame:
    """All fields of one message per row, with `event_time`, `receive_time` and `valid`: the text was a JSON object without
    repeated fields and its event time could be read. A field whose value doesn't fit its type is null. `keep_raw` keeps
    the text of rows that are not valid, and no other."""
    body = F.try_variant_get(F.try_parse_json(value), "$", f"struct<{record.schema()}>")
    # Generated, as in the narrow decoder: what reads the columns later can't make the parse run again. The times, too, are
    # read once, however many columns depend on `valid`, and in the same step, as a wide row is not cheap to copy.
    staged = messages.select("*", F.explode(F.transform(F.array(body), lambda found: F.struct(
        found.alias("record"), record.base.event_time(found).alias("event_time"),
        times.parse_iso(found.getField(record.base.receive_time)).alias("receive_time")))).alias("_read"))
    read: Column = F.col("_read.record")
    columns = [read.getField(wire).alias(name) for wire, name, _ in record.fields()]
    columns += [F.expr(sql).alias(name) for name, sql in record.derived.items()]
    valid = read.isNotNull() & F.col("_read.event_time").isNotNull()
    carried = [F.col(c) for c in messages.columns if c != value]
    raw = [F.when(~valid, F.col(value)).alias(value)] if keep_raw else []
    return staged.select(*carried, *raw, *columns, "_read.event_time", "_read.receive_time", valid.alias("valid"))


def devices(decoded: DataFrame) -> DataFrame:
    """One row per device of a decoded gantry heartbeat, from the lists of the same parse: `kind` (rsu or camera), and the
    device's own gantry and status."""
    def entries(kind: str, column: str, status: str) -> Column:
        return F.coalesce(F.transform(column, lambda device: F.struct(
            F.lit(kind).alias("kind"), device.getField("gantryId").alias("gantry_id"),
            device.getField(status).alias("status"))), F.array())

    lists = {snake("RSUHeartbeatList"): ("rsu", "RSUStatus"), snake("cameraHeartbeatList"): ("camera", "statusCode")}
    drop = (*lists, *GANTRY_HEARTBEAT.derived)
    kept = [c for c in decoded.columns if c not in drop]
    both = F.concat(*[entries(kind, column, status) for column, (kind, status) in lists.items()])
    return decoded.select(*kept, F.inline(both))
