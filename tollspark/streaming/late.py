"""Late rows kept: what a windowed aggregate would drop behind the watermark goes to a table of its own.

A stateful aggregate drops a row silently once the row's window has closed, that is when the watermark of the batch has reached
the window's end. `mark_late` sees the same watermark, marks those rows and passes all of them on. It keeps no state: rows
are dealt by a hash only because the watermark is known to keyed operators alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LATE = "late"


def mark_late(df: DataFrame, event: str, closes: str, delay: str = "1 day", parts: int = 64) -> DataFrame:
    """All rows of a stream with `late`: whether the time `closes`, the end of the row's window, is not beyond the
    watermark that `event` and `delay` give. Rows without an event time are late. `parts` bounds how many groups a batch has."""
    out = T.StructType([*df.schema.fields, T.StructField(LATE, T.BooleanType())])
    names = df.columns
    dealt = df.withWatermark(event, delay).withColumn("_part", F.pmod(F.xxhash64(*names), F.lit(parts)))

    def mark(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        reached = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        for frame in frames:
            known = frame[names].copy()
            closing = pd.to_datetime(known[closes])
            if closing.dt.tz is not None:
                closing = closing.dt.tz_convert("UTC").dt.tz_localize(None)
            known[LATE] = (closing.isna() | known[event].isna() | (closing <= reached)).astype(bool)
            yield known

    marked = dealt.groupBy("_part").applyInPandasWithState(
        mark, out, T.StructType([T.StructField("none", T.BooleanType())]), "append", GroupStateTimeout.NoTimeout)
    # The operator hands on Arrow rows, which a sort (as of a partitioned sink) can't take; a projection makes them plain.
    return marked.withColumn(LATE, F.coalesce(LATE, F.lit(True)))
