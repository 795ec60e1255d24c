"""Station reports: very wide conditional aggregates by media, vehicle, payment and fee class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tollspark.functions import times
from tollspark.functions.measures import amount, cents, code_matrix, count_where, pack_totals, sum_where

# Codes of the toll records.
ETC, CPC, PAPER, M1, NO_MEDIA = 1, 2, 3, 4, 9
SIGN_OK, SIGN_FAIL = 1, 2
VEHICLE_TYPES = (1, 2, 3, 4, 11, 12, 13, 14, 15, 16, 21, 22, 23, 24, 25, 26)
VEHICLE_CLASSES = (0, 8, 10, 14, 21, 22, 23, 24, 25, 26, 27, 28)
PAY_TYPES = (1, 2, 3, 4, 5, 6, 7)
FEE_CLASSES = (1, 2, 3, 4, 5, 6, 11)
CHARGE_CARD, STORED_VALUE_CARD, OBU = (2, 82), (1, 9), (3, 65)  # (card type, operation type)

OTHER = -1  # stands for a missing or unlisted code, so that a hundred conditions needn't ask for NULL

CODES = {
    "media_type": (ETC, CPC, PAPER, M1, NO_MEDIA),
    "vehicle_type": VEHICLE_TYPES,
    "vehicle_class": VEHICLE_CLASSES,
    "sign_status": (SIGN_OK, SIGN_FAIL),
    "multi_province": (0, 1),
    "pay_type": PAY_TYPES,
    "actual_fee_class": FEE_CLASSES,
}
ENTRANCE_CODES = ("media_type", "vehicle_type", "vehicle_class", "sign_status")


# Measures are SQL text: a report has over a hundred, and one parsed text each is far cheaper to set up than a tree of
# column calls. A list of texts is a code matrix.
Measures = dict[str, str | list[str]]


def _weight(df: DataFrame, cells: bool = False) -> str:
    """What a row weighs in counts: cells weigh the rows they stand for, plain rows are counted. Streams keep the sums
    of their stored state."""
    return "_n" if cells or df.isStreaming else "1"


def _total(n: str) -> str:
    return "count(1)" if n == "1" else f"sum({n})"


def _vehicle_measures(n: str) -> Measures:
    measures: Measures = {}
    for label, media in (("etc", ETC), ("cpc", CPC)):
        here = f"media_type = {media}"
        measures[f"{label}TypeCount"] = code_matrix(n, "vehicle_type", VEHICLE_TYPES, here)
        measures[f"{label}ClassCount"] = code_matrix(n, "vehicle_class", VEHICLE_CLASSES, here)
        if media == ETC:
            measures["etcSuccessCount"] = sum_where(n, f"{here} and sign_status = {SIGN_OK}")
            measures["etcFailCount"] = sum_where(n, f"{here} and sign_status = {SIGN_FAIL}")
    return measures


def _exit_measures(n: str, legacy: bool = False) -> Measures:
    """All exit-station measures over rows or cells that weigh `n`, amounts still in ten-thousandths.

    `legacy` sums the fee classes by payment type, as the reports of old did.
    """
    measures = _vehicle_measures(n)
    fees = {("cpc", "Success"): "cpcSuccessFee", ("cpc", "Fail"): "cpcFailFee",
            ("paper", "Success"): "pagerIssueSuccessSumFee", ("paper", "Fail"): "paperFailFee"}
    for label, media in (("cpc", CPC), ("paper", PAPER)):
        for outcome, sign in (("Success", SIGN_OK), ("Fail", SIGN_FAIL)):
            here = f"media_type = {media} and sign_status = {sign}"
            measures[f"{label}{outcome}Count"] = sum_where(n, here)
            measures[fees[label, outcome]] = sum_where("_fee", here)
    measures |= {
        "totalVeCnt": _total(n),
        "totalTransFee": "sum(_fee)",
        "totalDiscountFee": "sum(_discount)",
        "etcCnt": sum_where(n, f"media_type = {ETC}"),
        "etcTotalTransFee": sum_where("_fee", f"media_type = {ETC}"),
        "etcTotalDiscountFee": sum_where("_discount", f"media_type = {ETC}"),
        "noMediaTypeTotalNum": sum_where(n, f"media_type = {NO_MEDIA}"),
        "m1PassNum": sum_where(n, f"media_type = {M1}"),
    }
    for label, several in (("singlePro", 0), ("mutilPro", 1)):
        measures[f"{label}TransTotalNum"] = sum_where(n, f"multi_province = {several}")
        measures[f"{label}TransTotalFee"] = sum_where("_fee", f"multi_province = {several}")
    return measures | {
        "payTypeTotalNum": code_matrix(n, "pay_type", PAY_TYPES),
        "payTypeTotalFee": code_matrix("_fee", "pay_type", PAY_TYPES),
        "actualWayTotalNum": code_matrix(n, "actual_fee_class", FEE_CLASSES),
        "actualWayTotalFee": code_matrix("_fee", "pay_type" if legacy else "actual_fee_class", FEE_CLASSES),
    }


def _entrance_measures(n: str) -> Measures:
    return _vehicle_measures(n) | {
        "cpcCount": sum_where(n, f"media_type = {CPC}"),
        "paperCount": sum_where(n, f"media_type = {PAPER}"),
        "allCarCount": _total(n),
    }


def _report(df: DataFrame, keys: dict[str, Column], codes: tuple[str, ...],
            measures: Measures, amounts: dict[str, str], cells: bool = False,
            wide: bool = False) -> DataFrame:
    """Wide aggregate behind one exchange: each task works out the hundred measures of the keys it has seen, and only these
    partial sums are dealt by key, so that a station with a third of all rows sends one row per task. Rows of a key that
    lie together, as in a table written by day, shrink the most.

    With `cells` rows are first counted per cell, a cell being the key with one combination of the listed codes, and the
    measures come from the cells. A stream takes the measures from its rows in one step.

    Tables are grouped by the key expressions themselves, so that Spark drops a constant, as a single collection day, from
    the key.
    """
    sums = ["_n", *amounts]
    named = [expr.alias(name) for name, expr in keys.items()]
    values = {c: F.coalesce(F.when(F.col(c).isin(*CODES[c]), F.col(c)).cast("int"), F.lit(OTHER)) for c in codes}
    values["_n"] = F.lit(1).cast("bigint")
    values |= {name: cents(column, wide, isinstance(df.schema[column].dataType, T.DecimalType))
               for name, column in amounts.items()}
    if df.isStreaming:
        rows, by = df.select(*named, *[value.alias(name) for name, value in values.items()]), list(keys)
    else:
        rows, by = df.withColumns(values), named
    if cells and not df.isStreaming:
        rows, by = rows.groupBy(*by, *codes).agg(*[F.sum(c).alias(c) for c in sums]), list(keys)
    flat: dict[str, str] = {}
    for name, measure in measures.items():
        flat |= {_cell(name, i): sql for i, sql in enumerate(measure)} if isinstance(measure, list) else {name: measure}
    return rows.groupBy(*by).agg(*[F.expr(f"{sql} as {name}") for name, sql in flat.items()])


def _cell(name: str, index: int) -> str:
    return f"_{name}_{index}"


def _finished(report: DataFrame, labels: list[Column], measures: Measures, packed: bool, outer: bool) -> DataFrame:
    """Amounts to decimal(20,4) and matrices, until here one column per cell, to text or arrays."""
    columns = []
    for name, measure in measures.items():
        is_amount = name.endswith("Fee")
        if isinstance(measure, list):
            cells = [_cell(name, i) for i in range(len(measure))]
            if packed:
                sql = pack_totals(cells, is_amount, outer)
            else:
                sql = f"array({', '.join(amount(c) if is_amount else c for c in cells)})"
        else:
            sql = amount(name) if is_amount else name
        columns.append(F.expr(f"{sql} as {name}"))
    return report.select(*labels, *columns)


_AMOUNTS = {"_fee": "fee", "_discount": "discount_fee"}


def exit_station_daily(df: DataFrame, collect_day: Column, event_day: Column, packed: bool = True,
                       legacy: bool = False, cells: bool = False, wide: bool = False) -> DataFrame:
    """Exit-station report per station, collection day and event day: 34 columns, matrices as `|1|2|` text. The days keep
    their type; an event day as a date makes a smaller key than as text.

    `packed=False` keeps the matrices as arrays. Without `wide` amounts of a million and more count as zero, as they did in
    the reports of old; the jobs sum them.
    """
    keys = {"extollstationid": F.col("station_id"), "exTollStationName": F.col("station_name"),
            "collectDay": collect_day, "eventDay": event_day}
    measures = _exit_measures(_weight(df, cells), legacy)
    report = _report(df, keys, tuple(CODES), measures, _AMOUNTS, cells, wide)
    return _finished(report, [F.col(k) for k in keys], measures, packed, outer=True)


def _period_labels(station: list[str], legacy_label: bool) -> list[Column]:
    start, end = F.col("window").getField("start"), F.col("window").getField("end")
    label = times.period_label(start, legacy=True) if legacy_label else \
        F.concat(times.fmt_ts(start), F.lit(","), times.fmt_ts(end))
    return [*[F.col(c) for c in station], label.alias("statisticDay")]


def exit_station_period(df: DataFrame, length: str = "10 minutes", event: str = "event_time", packed: bool = True,
                        legacy_label: bool = False, legacy: bool = False, wide: bool = False) -> DataFrame:
    """Exit-station report per station and event-time period: 33 columns, matrices as `1|2` text. Table or stream."""
    keys = {"extollstationid": F.col("station_id"), "exTollStationName": F.col("station_name"),
            "window": times.tumbling(event, length)}
    measures = _exit_measures(_weight(df), legacy)
    report = _report(df, keys, tuple(CODES), measures, _AMOUNTS, wide=wide)
    return _finished(report, _period_labels(list(keys)[:2], legacy_label), measures, packed, outer=False)


def entrance_station_period(df: DataFrame, length: str = "10 minutes", event: str = "event_time",
                            packed: bool = True, legacy_label: bool = False) -> DataFrame:
    """Entrance-station report per station and event-time period: 12 columns. Table or stream.

    The record carries no station name; where the input has none, the column repeats the id.
    """
    name = "station_name" if "station_name" in df.columns else "station_id"
    keys = {"enTollStationId": F.col("station_id"), "enTollStationName": F.col(name),
            "window": times.tumbling(event, length)}
    measures = _entrance_measures(_weight(df))
    report = _report(df, keys, ENTRANCE_CODES, measures, {})
    return _finished(report, _period_labels(list(keys)[:2], legacy_label), measures, packed, outer=False)


def issue_flow_daily(df: DataFrame, collect_day: Column, event_day: Column) -> DataFrame:
    """Charge cards, stored-value cards and OBUs issued per point of sale, collection day and event day."""
    rows = df.select("pos_id", collect_day.alias("collectDay"), event_day.alias("eventDay"), "card_type", "oper_type")

    def issued(kind: tuple[int, int]) -> Column:
        return count_where((F.col("card_type") == kind[0]) & (F.col("oper_type") == kind[1]))

    return rows.groupBy("pos_id", "collectDay", "eventDay").agg(
        issued(CHARGE_CARD).alias("chargeCardNum"),
        issued(STORED_VALUE_CARD).alias("storeCardNum"),
        issued(OBU).alias("obuNum"),
    )


def collect_day_of(year: str = "year", month: str = "month", day: str = "day") -> Column:
    """Collection day from the partition columns."""
    return F.concat_ws("-", year, month, day)
