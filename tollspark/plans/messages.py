"""Full-width messages made from the events, and what each must decode to.

Every field has a rule by its place i among the fields of its record: text, a number or a nested array in turn, left out for
every seventh event; typed fields come as numbers for even events and quoted for odd ones, and are unreadable for every
thirteenth. Every 97th message is cut off and every 89th has an unreadable time, so both must be rejected. The rules are SQL
that both engines read: Spark builds the messages from it, the oracle states the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollspark.plans import views
from tollspark.sources import wide

_CUT, _SPOILED = "event_id % 97 = 0", "event_id % 89 = 0"
#: Fields that carry a time, per record: wire name and format; `id` and `heatVersion` hold theirs as digits.
_TIMES = {"exit": ("exTime", "iso"), "entrance": ("enTime", "iso"), "gantry": ("stationDBTime", "iso"),
          "picture": ("picTime", "iso"), "lane_heartbeat": ("id", "id"), "gantry_heartbeat": ("heatVersion", "version")}


def _time_text(kind: str, spark: bool) -> str:
    fmt = {"iso": ("yyyy-MM-dd\\'T\\'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"), "id": ("yyyyMMddHHmmss", "%Y%m%d%H%M%S"),
           "version": ("yyyyMMddHHmm", "%Y%m%d%H%M")}[kind]
    text = f"date_format(event_ts, '{fmt[0]}')" if spark else f"strftime(event_ts, '{fmt[1]}')"
    if kind == "id":
        text = f"concat('G00703601300601010030', {text}, cast(user_id as string))"
    # The spoiled character is where the time begins.
    at = 22 if kind == "id" else 1
    return (f"case when {_SPOILED} then concat(substring({text}, 1, {at - 1}), 'x', substring({text}, {at + 1}, 40)) "
            f"else {text} end")


def _received(spark: bool) -> str:
    return "date_format(received, 'yyyy-MM-dd HH:mm:ss')" if spark else "strftime(received, '%Y-%m-%d %H:%M:%S')"


def _kind(name: str, wire: str, kind: str, i: int) -> str:
    if wire == _TIMES[name][0]:
        return "time"
    if wire == "receiveTime":
        return "received"
    if kind.startswith("array"):
        return kind.split(",")[1].split(":")[0].strip()  # the device's field of its state
    return ("text", "number", "list")[i % 3] if kind == "string" else "int" if kind == "int" else "amount"


def _specs(name: str) -> list[tuple[str, str, int]]:
    return [(wire, _kind(name, wire, kind, i), i) for i, (wire, _, kind) in enumerate(wide.ALL[name].fields(), 1)]


# The rules, over {i}, the place of the field, and {wire}, its name as an SQL expression.
_NUMBER = "cast(event_id * {i} % 1000 as string)"
_CENTS = f"concat({_NUMBER}, '.', lpad(cast((event_id + {{i}}) % 100 as string), 2, '0'))"
_MISSING, _UNREADABLE = "(event_id + {i}) % 7 = 0", "(event_id + {i}) % 13 = 0"
_QUOTE = "case when event_id % 2 = 1 then '\"' else '' end"
_GANTRY = "concat('G', cast(user_id as string))"


def _written(kind: str, name: str, spark: bool) -> str:
    """The value of a field as it stands in the message."""
    quoted = lambda text: f"""concat('"', {text}, '"')"""
    if kind == "time":
        return quoted(_time_text(_TIMES[name][1], spark))
    if kind == "received":
        return quoted(_received(spark))
    if kind in ("int", "amount"):
        text = _NUMBER if kind == "int" else _CENTS
        return f"case when {_UNREADABLE} then '\"n/a\"' else concat({_QUOTE}, {text}, {_QUOTE}) end"
    if kind in ("text", "number", "list"):
        return {"text": quoted(f"concat('t', {_NUMBER})"), "number": _NUMBER, "list": f"concat('[', {_NUMBER}, ',\"z\"]')"}[kind]
    return f"""concat('[{{{{"gantryId":"', {_GANTRY}, '","{kind}":"', {_NUMBER}, '"}}}},{{{{"gantryId":"G0"}}}}]')"""


def _value(kind: str, name: str) -> str:
    """The value of a field's column, in the oracle."""
    if kind == "time":
        return _time_text(_TIMES[name][1], False)
    if kind == "received":
        return _received(False)
    if kind in ("int", "amount"):
        text, to = (_NUMBER, "int") if kind == "int" else (_CENTS, "double")
        return f"case when not ({_MISSING} or {_UNREADABLE}) then cast({text} as {to}) end"
    shown = {"text": f"concat('t', {_NUMBER})", "number": _NUMBER, "list": f"concat('[', {_NUMBER}, ',\"z\"]')"}
    return f"case when not {_MISSING} then {shown.get(kind, f'concat({_GANTRY}, {chr(39)}={chr(39)}, {_NUMBER}, {chr(39)};G0={chr(39)})')} end"


def _whole(name: str, pieces: str) -> str:
    whole = f"concat('{{', {pieces}, '}}')"
    return f"case when {_CUT} then substring({whole}, 1, 25) else {whole} end"


def _piece(kind: str, name: str, spark: bool) -> str:
    text = f"""concat('"', {{wire}}, '":', {_written(kind, name, spark)})"""
    return text if kind in ("time", "received") else f"case when not {_MISSING} then {text} end"


_EVENTS = {True: "select *, timestamp_seconds(unix_s + delay_s) as received from {src}",
           False: "select *, event_ts + to_seconds(delay_s) as received from ev"}


def messages(events: DataFrame, name: str) -> DataFrame:
    """(event_id, event_ts, value) of every event of a table or stream, as messages of the record `name`. One lambda over
    the list of fields, as a hundred and more written-out fields would be too much for compiled code."""
    spark: SparkSession = events.sparkSession
    timed = spark.sql(_EVENTS[True], src=spark.sql(views.EV_SPARK, src=events))
    specs = _specs(name)
    kinds = sorted({kind for _, kind, _ in specs})
    choice = " ".join(f"when '{kind}' then {_piece(kind, name, True).format(i='f.i', wire='f.wire')}" for kind in kinds)
    listed = ", ".join(f"named_struct('wire', '{wire}', 'kind', '{kind}', 'i', {i})" for wire, kind, i in specs)
    pieces = f"array_join(transform(array({listed}), f -> case f.kind {choice} end), ',')"
    return timed.selectExpr("event_id", "event_ts", f"{_whole(name, pieces)} as value")


def decoded_sql(name: str) -> str:
    """Oracle: the columns of every message, null where it has to be rejected, and the length of what is rejected."""
    good = f"not ({_CUT} or {_SPOILED})"
    columns = [f"case when {good} then {_value(kind, name).format(i=i)} end as {column}"
               for (_, kind, i), (_, column, _) in zip(_specs(name), wide.ALL[name].fields(), strict=True)]
    at = "date_trunc('minute', event_ts)" if _TIMES[name][1] == "version" else "date_trunc('second', event_ts)"
    for column, sql in {"event_time": f"strftime({at}, '%Y-%m-%d %H:%M:%S')", "receive_time": _received(False)}.items():
        columns.append(f"case when {good} then {sql} end as {column}")
    pieces = ", ".join(_piece(kind, name, False).format(i=i, wire=f"'{wire}'") for wire, kind, i in _specs(name))
    message = _whole(name, f"concat_ws(',', {pieces})")
    return (f"{views.ctes('ev')}, timed as ({_EVENTS[False]}) select event_id, {', '.join(columns)}, "
            f"cast(case when not {good} then length({message}) end as int) as rejected_chars from timed")
