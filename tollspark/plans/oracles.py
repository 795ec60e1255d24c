"""Oracle SQL: what each registered query must return, stated independently for another engine.

Times come out as text and decimals as doubles, as in the queries.
"""

from __future__ import annotations

from tollspark.plans import messages, views
from tollspark.plans.queries import COLLECT_DAY, RUN_TIME, STAGES, TOLERANCE
from tollspark.sources import wide

_TS = "'%Y-%m-%d %H:%M:%S'"
_DAY = "time_bucket(interval '24 hours', event_ts, interval '16 hours')"
_HOUR = "date_trunc('hour', event_ts)"


def _rate(part: str, whole: str) -> str:
    quotient = f"cast({part} as double) / nullif({whole}, 0)"
    return f"cast(cast(round(cast({quotient} as decimal(18,10)), 3) as decimal(10,3)) as double)"


def _count(condition: str) -> str:
    return f"cast(count(*) filter (where {condition}) as bigint)"


def _window(expr: str, length: str) -> str:
    return (f"strftime({expr}, {_TS}) as window_start, strftime({expr} + interval '{length}', {_TS}) as window_end")


def _labels(expr: str, hour: bool = False, run_time: bool = True) -> str:
    parts = [f"strftime({expr}, '%Y-%m-%d') as statis_day"]
    if hour:
        parts.append(f"cast(hour({expr}) as int) as statis_hour")
    if run_time:
        parts.append(f"'{RUN_TIME}' as update_time")
    return ", ".join(parts)


# --- rates ---------------------------------------------------------------------------------------------------------

def _timeliness(keys: str, threshold: int, inclusive: bool, enriched: bool) -> str:
    timely, late = ("<=", ">") if inclusive else ("<", ">=")
    fact = f"""
select {keys}, {_DAY} as w, {_count(f'delay_s {timely} {threshold}')} as timely_sum,
  {_count(f'delay_s {late} {threshold}')} as delay_sum, count(*) as total_sum
from v_gantry group by {keys}, w"""
    extra = ", roadid, tollstation" if enriched else ""
    join = "left join v_dim on mjid = gantry_id" if enriched else ""
    return f"""{views.ctes('v_gantry', 'v_dim')}, fact as ({fact})
select {keys}, {_window('w', '24 hours')}, timely_sum, delay_sum, total_sum,
  {_rate('timely_sum', 'total_sum')} as timely_rate, {_rate('delay_sum', 'total_sum')} as delay_rate,
  {_labels('w')}{extra}
from fact {join}"""


def _deal_success() -> str:
    special = ("coalesce(len(list_filter(string_split(special_type, '|'), "
               "lambda x: try_cast(x as int) between 155 and 184)), 0) = 0")
    counts, rates = [], []
    for label, media in (("obu", 1), ("cpc", 2)):
        for outcome, result in (("success", 0), ("fail", 1)):
            counts.append(f"{_count(f'plain and media_type = {media} and trade_result = {result}')} "
                          f"as {outcome}_{label}_count")
            rates.append(f"{_rate(f'{outcome}_{label}_count', f'all_{label}_count')} as {label}_{outcome}_rate")
        counts.append(f"{_count(f'plain and media_type = {media}')} as all_{label}_count")
    names = ", ".join(c.rsplit(" as ", 1)[1] for c in counts)
    return f"""{views.ctes('v_gantry', 'v_dim')},
flagged as (select *, {special} as plain from v_gantry),
fact as (select gantry_id, {_DAY} as w, {', '.join(counts)}, {_count('plain')} as all_count
  from flagged group by gantry_id, w)
select gantry_id, {_window('w', '24 hours')}, {names}, {', '.join(rates)}, all_count, {_labels('w')},
  roadid, tollstation
from fact left join v_dim on mjid = gantry_id"""


_NO_ZERO = "instr({c}, '0') = 0 and {c} <> '2'"
_ZERO_CODE = "{c} in ('0', '00')"


def _device(keys: str, rules: dict[str, str], *, center: str = "", enriched: bool = False, run_time: bool = True,
            source: str = "v_heartbeat") -> str:
    rates = [f"""{_rate(_count(rule.format(c=c)), _count(f"{c} <> '2'"))} as {c}_rate""" for c, rule in rules.items()]
    shown = ", ".join(f"{c}_rate" for c in rules)
    extra = ", roadid, tollstation" if enriched else ""
    join = "left join v_dim on mjid = gantry_id" if enriched else ""
    return f"""{views.ctes('v_heartbeat', 'v_dim')},
fact as (select {keys}, {_DAY} as w, {', '.join(rates)} from {source} group by all)
select {keys.split(' as ')[-1] if ' as ' in keys and ',' not in keys else ', '.join(k.split(' as ')[-1].strip() for k in keys.split(', '))},
  {center}{_window('w', '24 hours')}, {shown}, {_labels('w', run_time=run_time)}{extra}
from fact {join}"""


def _hourly(keys: str, *, center: str = "", enriched: bool = False) -> str:
    extra = ", roadid, tollstation" if enriched else ""
    join = "left join v_dim on mjid = gantry_id" if enriched else ""
    return f"""{views.ctes('v_heartbeat', 'v_dim')},
fact as (select {keys}, {_HOUR} as w, count(*) as heartbeat_count from v_heartbeat group by all)
select {keys}, {center}{_window('w', '1 hour')}, heartbeat_count, {_labels('w', hour=True)}{extra}
from fact {join}"""


_CENTER = "substr(station_id, 1, 11) as sub_center, "
_LANE_RULES = {"rsu_status": _NO_ZERO, "vplr_status": _NO_ZERO, "lane_controller_status": _NO_ZERO}


def _healthy(*devices: str) -> str:
    rates = [f"""cast({_count(_NO_ZERO.format(c=c))} as double) / nullif({_count(f"{c} <> '2'")}, 0) as {c}_rate"""
             for c in devices]
    return f"""{views.ctes('v_heartbeat')},
fact as (select lane_id, station_id, {_DAY} as w, {', '.join(rates)} from v_heartbeat group by all)
select lane_id, station_id, {_window('w', '24 hours')}, {', '.join(f'{c}_rate' for c in devices)},
  {_labels('w', run_time=False)}
from fact where {' and '.join(f'{c}_rate >= 0.8' for c in devices)}"""


#: Of three slices of time the second comes last: its rows are late whose day had ended a day before the newest event.
_LATE = f"""{views.ctes('ev')},
span as (select min(unix_s) as first, max(unix_s) as last, epoch_ms(max(event_ts)) - 86400000 as reached from ev),
placed as (select {_DAY} + interval '24 hours' as day_end, (unix_s - first) * 3 // (last - first + 1) as part, reached from ev, span)
select part = 1 and epoch_ms(day_end) <= reached as late, strftime(day_end, {_TS}) as day_end, count(*) as n
from placed group by all"""


# --- match ---------------------------------------------------------------------------------------------------------

def _java_word(x: str) -> str:
    return (f"list_reduce(list_prepend(0::bigint, list_transform(range(1, length({x}) + 1), "
            f"lambda i: unicode(substr({x}, i, 1))::bigint)), lambda h, c: (h * 31 + c) & 4294967295)")


def _row_key(x: str, buckets: int, width: int, suffix: str = "") -> str:
    word = _java_word(x)
    signed = f"(case when {word} >= 2147483648 then {word} - 4294967296 else {word} end)"
    return f"lpad(cast(abs({signed}) % {buckets} as varchar), {width}, '0') || {x} || '{suffix}'"


_NEAR = f"v.gantry_id = e.gantry_id and v.pic_unix between e.trans_unix - {TOLERANCE} and e.trans_unix + {TOLERANCE}"
_SAME = f"v.plate = e.plate and {_NEAR}"


def _match_rows(pictures: str = "v_viu") -> str:
    return f"""{views.ctes('v_etc', 'v_viu')},
hits as (select e.trade_id, e.plate, string_agg('/' || v.pic_id, '' order by v.pic_unix, v.pic_id) as pics
  from v_etc e left join {pictures} v on {_SAME} group by e.trade_id, e.plate, e.gantry_id, e.trans_unix),
rows_ as (select {_row_key('trade_id', 100, 2)} as rowkey, coalesce(pics, '') as pic_ids, '{RUN_TIME}' as run_time,
  plate, case when pics is null then '' else plate end as pic_plate, trade_id,
  case when pics is null then 0 else 1 end as sign, case when pics is null then 66 else 99 end as degree from hits)
"""


def _fuzzy() -> str:
    return f"""{views.ctes('v_etc', 'v_viu')}
select e.trade_id, e.gantry_id, e.plate, e.trans_unix,
  coalesce(string_agg(v.pic_id, '/' order by v.pic_unix, v.pic_id), '') as pic_ids,
  coalesce(string_agg(v.plate, '/' order by v.pic_unix, v.pic_id), '') as pic_plates,
  case when count(v.pic_id) = 0 then 0 else 1 end as sign, case when count(v.pic_id) = 0 then 66 else 99 end as degree
from v_etc e left join v_viu v on levenshtein(e.plate, v.plate) <= 1 and {_NEAR}
group by e.trade_id, e.gantry_id, e.plate, e.trans_unix"""


# --- reports -------------------------------------------------------------------------------------------------------

# Codes of the toll records.
_TYPES = [*range(1, 5), *range(11, 17), *range(21, 27)]
_CLASSES = [0, 8, 10, 14, *range(21, 29)]
_PAYS = list(range(1, 8))
_WAYS = [1, 2, 3, 4, 5, 6, 11]


def _fee(condition: str, column: str = "fee") -> str:
    return f"sum(case when {condition} then coalesce({column}, 0) else 0 end)"


def _vector(name: str, cells: list[str], outer: bool) -> str:
    texts = " || '|' || ".join(f"cast({c} as varchar)" for c in cells)
    return (f"'|' || {texts} || '|'" if outer else texts) + f" as {name}"


def _vehicle_columns(outer: bool) -> tuple[list[str], list[str]]:
    pair = {}
    for label, media in (("etc", 1), ("cpc", 2)):
        pair[label] = [
            _vector(f"{label}TypeCount", [_count(f"media_type = {media} and vehicle_type = {v}") for v in _TYPES], outer),
            _vector(f"{label}ClassCount", [_count(f"media_type = {media} and vehicle_class = {v}") for v in _CLASSES],
                    outer)]
    signs = [f"{_count(f'media_type = 1 and sign_status = {s}')} as etc{n}Count" for s, n in ((1, "Success"), (2, "Fail"))]
    return pair["etc"] + signs, pair["cpc"]


def _money(expr: str, name: str) -> str:
    return f"cast(cast({expr} as decimal(20,4)) as double) as {name}"


def _exit_columns(outer: bool) -> str:
    etc, cpc = _vehicle_columns(outer)
    dec = "cast({} as decimal(20,4))"
    columns = [*etc, *cpc]
    for label, media, fees in (("cpc", 2, ("cpcSuccessFee", "cpcFailFee")),
                               ("paper", 3, ("pagerIssueSuccessSumFee", "paperFailFee"))):
        for sign, word, fee in ((1, "Success", fees[0]), (2, "Fail", fees[1])):
            here = f"media_type = {media} and sign_status = {sign}"
            columns += [f"{_count(here)} as {label}{word}Count", _money(_fee(here), fee)]
    columns += [
        "count(*) as totalVeCnt", _money(_fee("true"), "totalTransFee"),
        _money(_fee("true", "discount_fee"), "totalDiscountFee"), f"{_count('media_type = 1')} as etcCnt",
        _money(_fee("media_type = 1"), "etcTotalTransFee"),
        _money(_fee("media_type = 1", "discount_fee"), "etcTotalDiscountFee"),
        f"{_count('media_type = 9')} as noMediaTypeTotalNum", f"{_count('media_type = 4')} as m1PassNum"]
    for label, value in (("single", 0), ("mutil", 1)):
        columns += [f"{_count(f'multi_province = {value}')} as {label}ProTransTotalNum",
                    _money(_fee(f"multi_province = {value}"), f"{label}ProTransTotalFee")]
    for name, column, codes in (("payType", "pay_type", _PAYS), ("actualWay", "actual_fee_class", _WAYS)):
        columns += [_vector(f"{name}TotalNum", [_count(f"{column} = {v}") for v in codes], outer),
                    _vector(f"{name}TotalFee", [dec.format(_fee(f"{column} = {v}")) for v in codes], outer)]
    return ",\n  ".join(columns)


def _entrance_columns() -> str:
    etc, cpc = _vehicle_columns(False)
    return ",\n  ".join([*etc, *cpc, f"{_count('media_type = 2')} as cpcCount", f"{_count('media_type = 3')} as paperCount",
                         "count(*) as allCarCount"])


_START10 = "time_bucket(interval '10 minutes', event_ts)"
_LEGACY = (f"strftime({{w}}, '%Y-%m-%d %H:%M:00') || ',' || strftime({{w}}, '%Y-%m-%d %H:') || "
           f"cast(minute({{w}}) + 10 as varchar) || ':00'")


def _label(w: str, length: str) -> str:
    return f"strftime({w}, {_TS}) || ',' || strftime({w} + interval '{length}', {_TS})"


def _exit_daily(view: str = "v_exit") -> str:
    return f"""{views.ctes(view)}
select station_id as extollstationid, station_name as exTollStationName, '{COLLECT_DAY}' as collectDay,
  strftime(event_day, '%Y-%m-%d') as eventDay, {_exit_columns(True)}
from {view} group by station_id, station_name, event_day"""


def _exit_period(length: str = "10 minutes") -> str:
    label = _LEGACY.format(w="w") if length == "10 minutes" else _label("w", length)
    return f"""{views.ctes('v_exit_evt')},
rows_ as (select *, time_bucket(interval '{length}', event_ts) as w from v_exit_evt)
select station_id as extollstationid, station_name as exTollStationName, {label} as statisticDay,
  {_exit_columns(False)}
from rows_ group by station_id, station_name, w"""


def _entrance_period(length: str) -> str:
    return f"""{views.ctes('v_exit_evt')},
rows_ as (select *, time_bucket(interval '{length}', event_ts) as w from v_exit_evt)
select station_id as enTollStationId, station_name as enTollStationName, {_label('w', length)} as statisticDay,
  {_entrance_columns()}
from rows_ group by station_id, station_name, w"""


_ISSUES = f"""{views.ctes('v_issue')}
select pos_id, '{COLLECT_DAY}' as collectDay, strftime(event_day, '%Y-%m-%d') as eventDay,
  {_count('card_type = 2 and oper_type = 82')} as chargeCardNum,
  {_count('card_type = 1 and oper_type = 9')} as storeCardNum, {_count('card_type = 3 and oper_type = 65')} as obuNum
from v_issue group by pos_id, event_day"""


# --- counts and the rest -------------------------------------------------------------------------------------------

_COUNT_BY = f"""{views.ctes('v_exit_evt')}, rows_ as (select *, time_bucket(interval '1 day', event_ts) as w from v_exit_evt)
select station_id, station_name, {_window('w', '1 day')}, count(*) as n
from rows_ group by station_id, station_name, w"""

_SLIDING = f"""{views.ctes('ev')},
copies as (select event_type, unix_s, (unix_s // 600) * 600 - i * 600 as s from ev, range(0, 3) r(i))
select event_type, strftime(make_timestamp(s * 1000000), {_TS}) as window_start,
  strftime(make_timestamp((s + 1500) * 1000000), {_TS}) as window_end, count(*) as n
from copies where s > unix_s - 1500 group by event_type, s"""

_TOKENS = """
with pieces as (select unnest(case when rtrim(text, ' ') = '' and text <> '' then []::varchar[]
  else string_split(rtrim(text, ' '), ' ') end) as value from documents)
select value, count(*) as n from pieces group by value"""

_LATEST = f"""{views.ctes('ev')},
ranked as (select *, row_number() over (partition by user_id order by event_ts desc, event_id desc) as r from ev)
select user_id, strftime(event_ts, {_TS}) as event_ts, event_id, event_type, value from ranked where r = 1"""

_DECODED = f"""{views.ctes('v_gantry')}
select trade_id, gantry_id, strftime(date_trunc('second', event_ts), {_TS}) as event_time,
  strftime(make_timestamp(receive_unix * 1000000), {_TS}) as receive_time, media_type,
  cast(trade_result as int) as trade_result, special_type
from v_gantry"""

_JSON_LENGTH = ("length(concat('{\"tradeId\":\"', trade_id, '\",\"gantryId\":\"', gantry_id, "
                "'\",\"stationDBTime\":\"x-00-00T00:00:00\",\"receiveTime\":\"0000-00-00 00:00:00.000\",\"mediaType\":3,"
                "\"tradeResult\":0', case when special_type is null then '' else ',\"specialType\":\"' || special_type || '\"' end, '}'))")

_REJECTS = f"""{views.ctes('v_gantry')}
select media_type as kind, count(*) as n, cast(max(case when media_type = 9 then 20 else {_JSON_LENGTH} end) as int) as longest
from v_gantry where media_type in (3, 9) group by media_type"""

_PAGE_VIEWS = f"""select event_type as "eventType", cast(user_id as varchar) as "userID", count(*) as n,
  max(strftime(ts, {_TS})) as last_time
from events where event_type <> 'error' group by event_type, user_id"""

_PV = """select strftime(ts - interval '8 hours', '%Y-%m-%d %H:%M') as minute, cast(user_id as varchar) as "userID",
  count(*) as pv
from events where event_type <> 'error' group by 1, 2"""

_HEARTBEAT_REGEX = f"""{views.ctes('v_heartbeat')}
select hb_id, gantry_id, rsu_status || ',' || vplr_status as rsu_all, cast(3 as int) as gantries,
  cast((rsu_status = '21')::int + (vplr_status = '21')::int as int) as rsu_21
from v_heartbeat"""

_HEARTBEAT_DEVICES = f"""{views.ctes('v_heartbeat')},
devices as (
  select charge_unit_id, 'rsu' as kind, rsu_status as status from v_heartbeat
  union all select charge_unit_id, 'rsu', vplr_status from v_heartbeat
  union all select charge_unit_id, 'camera', vplr_status from v_heartbeat)
select charge_unit_id, kind, status, count(*) as n from devices group by all"""

_UPSERT = f"""select user_id, n, last_event, kind from (
  select user_id, count(*) as n, max(event_id) as last_event, event_type as kind,
    row_number() over (partition by user_id order by list_position({list(STAGES)}, event_type) desc) as r
  from events group by user_id, event_type) where r = 1"""

_STREAM_PAIRS = f"""{views.ctes('v_etc', 'v_viu')}
select e.trade_id, e.gantry_id, e.plate, e.trans_unix, v.pic_id, v.pic_unix from v_etc e left join v_viu v on {_SAME}"""

_LEFT = """from v_etc e left join v_viu v
  on v.plate = e.plate and v.pic_unix between e.trans_unix - 14400 and e.trans_unix + 14400"""
_STREAM_LEFT = f"{views.ctes('v_etc', 'v_viu')} select e.trade_id, e.plate, v.pic_id {_LEFT}"
_STREAM_LEFT_COUNT = f"""{views.ctes('v_etc', 'v_viu')}
select strftime(date_trunc('day', make_timestamp(e.trans_unix * 1000000)), {_TS}) as window_start, count(*) as n {_LEFT}
group by 1"""

_SIDES = f"""{views.ctes('v_etc', 'v_viu')}
select id, plate, gantry_id, strftime(make_timestamp(unix * 1000000), {_TS}) as at, unix from (
  select trade_id as id, plate, gantry_id, trans_unix as unix from v_etc
  union all select pic_id, plate, gantry_id, pic_unix from v_viu)"""

_ISSUES_COLLECTED = f"""{views.ctes('v_issue')}
select pos_id, strftime(event_day + interval '1 day', '%Y-%m-%d') as collectDay, strftime(event_day, '%Y-%m-%d') as eventDay,
  {_count('card_type = 2 and oper_type = 82')} as chargeCardNum,
  {_count('card_type = 1 and oper_type = 9')} as storeCardNum, {_count('card_type = 3 and oper_type = 65')} as obuNum
from v_issue group by pos_id, event_day"""

_BLANKS = f"""{views.ctes('v_gantry')}
select trade_id, coalesce(special_type, '') as special, case when media_type = 2 then delay_s else 0 end as cpc_delay
from v_gantry"""

_LINES = """with pieces as (select unnest([event_type, cast(user_id as varchar)]) as value from events)
select value, count(*) as n from pieces group by value"""


def all_oracles() -> dict[str, str]:
    pairs = views.ctes("v_etc", "v_viu")
    rows = _match_rows()
    shown = "rowkey, pic_ids, plate, pic_plate"
    gantry_rules = {"rsu_status": _NO_ZERO, "vplr_status": _ZERO_CODE}
    oracles = {
        "gantry_timeliness_daily": _timeliness("gantry_id", 900, False, True),
        "picture_timeliness_daily": _timeliness("gantry_id", 600, False, True),
        "exit_lane_timeliness": _timeliness("lane_id, station_id, sub_center", 900, True, False),
        "entrance_lane_timeliness": _timeliness("lane_id, gantry_id, sub_center", 900, True, False),
        "lateness_classes": f"""{views.ctes('v_gantry')}
select case when delay_s <= 900 then 'timely' else 'delayed' end as lateness, count(*) as n from v_gantry group by 1""",
        "deal_success_rate": _deal_success(),
        "lane_heartbeat_hourly": _hourly("lane_id, station_id", center=_CENTER),
        "gantry_heartbeat_hourly": _hourly("gantry_id", enriched=True),
        "lane_device_rate_daily": _device("lane_id, station_id", _LANE_RULES, center=_CENTER),
        "gantry_device_rate_daily": _device("gantry_id", gantry_rules, enriched=True),
        "heartbeat_hourly_rep": f"""{views.ctes('v_heartbeat')},
fact as (select gantry_id, {_HOUR} as w, substr(min(charge_unit_id), 1, 11) as sub_center, count(*) as heartbeat_count
  from v_heartbeat group by gantry_id, w)
select gantry_id, sub_center, {_window('w', '1 hour')}, heartbeat_count, {_labels('w', hour=True, run_time=False)}
from fact""",
        "device_rate_subcenter": f"""{views.ctes('v_heartbeat')},
rows_ as (select *, substr(charge_unit_id, 1, 11) as sub_center, {_DAY} as w from v_heartbeat)
select gantry_id, sub_center, {_window('w', '24 hours')},
  {_rate(_count(_NO_ZERO.format(c='rsu_status')), _count("rsu_status <> '2'"))} as rsu_status_rate,
  {_rate(_count(_NO_ZERO.format(c='vplr_status')), _count("vplr_status <> '2'"))} as vplr_status_rate,
  {_labels('w', run_time=False)}
from rows_ group by gantry_id, sub_center, w""",
        "healthy_devices": _healthy("rsu_status", "lane_controller_status"),
        "healthy_on_three_rates": _healthy("rsu_status", "vplr_status", "lane_controller_status"),
        "stream_rate_sum": f"""{views.ctes('v_heartbeat')},
fact as (select lane_id, station_id, {_DAY} as w,
  cast({_rate(_count(_NO_ZERO.format(c='rsu_status')), _count("rsu_status <> '2'"))} as decimal(10,3)) as r
  from v_heartbeat group by all)
select station_id, strftime(w, {_TS}) as window_start, cast(sum(r) as double) as rate_sum, count(*) as devices
from fact group by station_id, w""",
        "stream_late_rows": _LATE,
        "overwrite_table": f"""with issues as ({_ISSUES}), {views.ctes('ev')[5:]}
select * from issues where eventDay <> '2024-01-01' and eventDay in (
  select strftime(event_ts, '%Y-%m-%d') from ev where event_type = 'purchase' and k % 10 = 3)""",
        "rate_sum_by_station": f"""{views.ctes('v_heartbeat')},
fact as (select lane_id, station_id, {_DAY} as w,
  cast({_rate(_count(_NO_ZERO.format(c='rsu_status')), _count("rsu_status <> '2'"))} as decimal(10,3)) as r
  from v_heartbeat group by all)
select station_id, cast(sum(r) as double) as rate_sum from fact group by station_id""",
        "interval_match": f"{rows} select * from rows_",
        "interval_match_bucketed": f"{rows} select * from rows_",
        "interval_match_hot": f"{rows} select * from rows_",
        "interval_match_repeated": f"""{_match_rows('(select * from v_viu union all select * from v_viu where pic_unix % 5 = 0)')}
select way, rows_.* from rows_, (values ('plain'), ('grid')) ways(way)""",
        "interval_pairs": f"""{pairs} select e.*, v.pic_id, v.pic_unix from v_etc e left join v_viu v on {_SAME}""",
        "matched": f"{pairs} select * from v_etc e where exists (select 1 from v_viu v where {_SAME})",
        "unmatched": f"{pairs} select * from v_etc e where not exists (select 1 from v_viu v where {_SAME})",
        "fuzzy_interval_match": _fuzzy(),
        "match_summary": f"""{rows} select count(*) as total, {_count('sign = 1')} as matched,
  {_count('sign = 0')} as unmatched, count(distinct rows_) as distinct_total,
  count(distinct case when sign = 1 then rows_ end) as distinct_matched,
  count(distinct case when sign = 0 then rows_ end) as distinct_unmatched from rows_""",
        "match_success_failure": f"""{rows}
select case when sign = 1 then 'success' else 'failure' end as outcome, {shown} from rows_""",
        "row_keys": f"""{views.ctes('v_etc')} select trade_id, {_row_key('trade_id', 100, 2)} as rowkey,
  {_row_key('plate', 1000, 3, 'x')} as plate_key from v_etc""",
        "row_key_table": f"{rows} select rowkey, pic_ids, run_time from rows_ where sign = 1",
        "exit_station_daily": _exit_daily(),
        "exit_station_10min": _exit_period(),
        "entrance_station_10min": _entrance_period("10 minutes"),
        "entrance_station_10s": _entrance_period("10 seconds"),
        "issue_flow_daily": _ISSUES,
        "overwrite_partitions": _ISSUES,
        "count_by_window": _COUNT_BY,
        "sliding_count": _SLIDING,
        "token_count": _TOKENS,
        "distinct_lanes": f"""{views.ctes('v_heartbeat')}
select count(*) as lanes from (select distinct station_id, lane_id, rsu_status from v_heartbeat)""",
        "count_variants": f"""{views.ctes('v_gantry')} select gantry_id, count(*) as n_one, count(*) as n_rows,
  count(special_type) as n_special from v_gantry group by gantry_id""",
        "latest_by_key": _LATEST,
        "decode_events": _DECODED,
        "reject_events": _REJECTS,
        "decode_schema_json": _PAGE_VIEWS,
        "event_time_id": f"select event_id, strftime(ts, {_TS}) as event_time from events",
        "event_time_version": "select event_id, strftime(ts, '%Y-%m-%d %H:%M:00') as event_time from events",
        "event_time_raw": f"select event_id, strftime(ts, {_TS}) as event_time from events",
        "heartbeat_regex": _HEARTBEAT_REGEX,
        "heartbeat_devices": _HEARTBEAT_DEVICES,
        "time_zone_parse": "select event_id, cast(floor(epoch(ts)) as bigint) - 28800 as unix_s from events",
        "period_label": f"""{views.ctes('ev')}, rows_ as (select {_START10} as w from ev)
select {_label('w', '10 minutes')} as label, {_LEGACY.format(w='w')} as legacy_label, count(*) as n
from rows_ group by w""",
        "scan_partition_day": """select strftime(ts, '%H') as hour, event_type, count(*) as n from events
where strftime(ts, '%Y-%m-%d') = '2024-01-15' group by 1, 2""",
        "plate_log": f"""{views.ctes('v_etc')}
select lpad(trade_id, 19, 'G') as id, plate, strftime(make_timestamp(trans_unix * 1000000), {_TS}) as time,
  substr(lpad(trade_id, 19, 'G'), 1, 19) as gantry_id from v_etc""",
        "append_json": "select event_id, user_id, event_type, value from events",
        "kafka_values": """select cast(user_id as varchar) as key,
  concat('{"event_id":', event_id, ',"user_id":', user_id, ',"event_type":"', event_type, '"}') as value from events""",
        "offset_ledger": f"""select 'toll' as group_id, event_type as topic, cast(user_id % 8 as int) as "partition",
  max(event_id) + 1 as until_offset, '{RUN_TIME}' as submit_time,
  cast(epoch(timestamp '{RUN_TIME}') as bigint) as submit_unix from events group by event_type, user_id % 8""",
        "upsert_latest": _UPSERT,
        "stream_passthrough": "select event_id, event_type, props from events",
        "stream_interval_match": _STREAM_PAIRS,
        "stream_left_join": _STREAM_LEFT,
        "stream_left_join_count": _STREAM_LEFT_COUNT,
        "match_sides": _SIDES,
        "issue_flow_collected": _ISSUES_COLLECTED,
        "blank_or_zero": _BLANKS,
        "epoch_times": "select event_id, epoch_us(ts) // 1000 as ms, cast(floor(epoch(ts)) as bigint) as s from events",
        "line_stream": _LINES,
        "dimension_scan": f"""{views.ctes('v_dim')}
select mjid, roadid, tollstation, cast(null as varchar) as stationname from v_dim""",
        "exit_station_10s": _exit_period("10 seconds"),
        "exit_station_wide": _exit_daily("v_exit_large"),
        "scan_partition_hour": """select strftime(ts, '%H') as hour, event_type, count(*) as n from events
where strftime(ts, '%Y-%m-%d %H') = '2024-01-15 07' group by 1, 2""",
        "running_count": "select event_type, count(*) as n from events group by event_type",
        "pv_per_minute": _PV,
        "pv_per_minute_windowed": _PV,
        **{f"decode_{name}": messages.decoded_sql(name) for name in wide.ALL},
    }
    same = {
        "stream_gantry_timeliness": "gantry_timeliness_daily", "stream_picture_timeliness": "picture_timeliness_daily",
        "stream_exit_lane_timeliness": "exit_lane_timeliness",
        "stream_entrance_lane_timeliness": "entrance_lane_timeliness", "stream_deal_success": "deal_success_rate",
        "stream_lane_heartbeat_hourly": "lane_heartbeat_hourly",
        "stream_gantry_heartbeat_hourly": "gantry_heartbeat_hourly",
        "stream_lane_device_rate": "lane_device_rate_daily", "stream_gantry_device_rate": "gantry_device_rate_daily",
        "stream_exit_station_10min": "exit_station_10min", "stream_entrance_station_10min": "entrance_station_10min",
        "stream_healthy_devices": "healthy_on_three_rates", "stream_count_by_window": "count_by_window", "stream_token_count": "token_count",
    }
    joined = {"stream_gantry_staged": f"""select t.*, d.* exclude (gantry_id, window_start, window_end, statis_day, update_time,
  roadid, tollstation) from ({oracles['gantry_timeliness_daily']}) t join ({oracles['deal_success_rate']}) d
  using (gantry_id, window_start)"""}
    return oracles | joined | {stream: oracles[batch] for stream, batch in same.items()}
