"""JSON text to typed columns, with undecodable records routed aside instead of dropped."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tollspark.functions import times
from tollspark.sources.records import Record

_BAD = "_bad_text"


def decode(messages: DataFrame, record: Record, value: str = "value", keep_raw: bool = False) -> DataFrame:
    """Decode one flat record per message.

    Adds `event_time`, `receive_time` and `valid` (the text was JSON and its event time could be read).
    """
    schema = T.StructType([*record.wire_schema().fields, T.StructField(_BAD, T.StringType())])
    parsed = F.from_json(F.col(value), schema, {"columnNameOfCorruptRecord": _BAD})
    # Generated rather than projected: a filter on the decoded columns then cannot be moved below and parse again.
    staged = messages.select("*", F.explode(F.array(parsed)).alias("_record"))
    body = F.col("_record")
    columns: list[Column] = [
        (body.getField(wire) if kind == "string" else body.getField(wire).try_cast(kind)).alias(name)
        for wire, name, kind in record.fields
    ]
    if record.from_raw is not None:
        columns += [expr.alias(name) for name, expr in record.from_raw(F.col(value)).items()]
    event_time = record.event_time(body)
    columns += [
        event_time.alias("event_time"),
        times.parse_iso(body.getField(record.receive_time)).alias("receive_time"),
        (F.col(value).isNotNull() & body.getField(_BAD).isNull() & event_time.isNotNull()).alias("valid"),
    ]
    carried = [F.col(c) for c in messages.columns if c != value or keep_raw]
    return staged.select(*carried, *columns)


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects). Decode with `keep_raw=True` to have the offending text in the rejects."""
    return decoded.where("valid").drop("valid"), decoded.where("not valid").drop("valid")


def decode_with_schema_json(messages: DataFrame, schema_json: str, value: str = "value",
                            required: list[str] | None = None) -> DataFrame:
    """Decode with a schema given as Spark's JSON schema text, flatten it and drop rows lacking a required field."""
    schema = T.StructType.fromJson(json.loads(schema_json))
    # Generated, so that neither a filter nor the choice of fields makes parsing start again.
    flat = messages.select(F.explode(F.array(F.from_json(F.col(value), schema))).alias("_record")).select("_record.*")
    needed = schema.fieldNames() if required is None else required
    return flat.dropna(subset=needed) if needed else flat
