"""Latest copy of each event as stream state: what a micro-batch replaces is known without scanning the stored table.

The state of an event id is the time, tie-break and day of the newest copy seen.  A copy passes if it is newer
(event time, then the payload's hash; no time is oldest), together with the day that the copy before it was stored
under.  A timer removes the state of an id ``keep`` after its last copy arrived; a copy that comes later than that
passes as a new event, and the writer then finds an older one on the same day only.  The timer's clock is the time of the
micro-batches, so no event is ever too late for it, and a run over all available files ends.

Copies of an id within a micro-batch are compared in one call; an id's state is three fields, whatever the payload.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.functions.time import micros_since_epoch

#: what stands for no time or no day in the state: below all others
NO_TIME, NO_DAY = -(1 << 63), -(1 << 31)
STATE = "us long, tie string, day int"


def _newest(keep_ms: int):
    def step(key: tuple, pdfs: Iterator, state) -> Iterator:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else None
        best, row = (held[0], held[1]) if held else None, None
        for pdf in pdfs:
            for i, found in enumerate(zip(pdf["_us"].tolist(), pdf["_tie"].tolist())):
                if best is None or found > best:
                    best, row = found, pdf.iloc[[i]]
                now = int(pdf["_ms"].iloc[i])
        if row is not None:
            state.update((int(best[0]), best[1], int(row["_day"].iloc[0])))
            yield row.assign(_had=held is not None, _was=held[2] if held else NO_DAY)
        state.setTimeoutTimestamp(now + keep_ms)
    return step


def latest_copies(events: DataFrame, keep: dt.timedelta, key: str = "event_id", ts: str = "event_timestamp",
                  tie: str = "_tie") -> DataFrame:
    """The rows of the stream ``events`` that are newer than all before them of their ``key``, with ``replaces``
    (whether there was one) and ``replaced_day`` (its day; NULL: it had no time)."""
    rows = events.withColumn("_tie", F.coalesce(F.col(tie), F.lit(""))).withColumn(
        "_us", F.coalesce(micros_since_epoch(F.col(ts)), F.lit(NO_TIME))).withColumn(
        "_day", F.coalesce(F.unix_date(F.to_date(ts)), F.lit(NO_DAY))).withColumn(
        "_now", F.current_timestamp()).withColumn("_ms", F.unix_millis("_now")).withWatermark("_now", "0 seconds")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _had boolean, _was int"
    newest = rows.groupBy(key).applyInPandasWithState(
        _newest(int(keep.total_seconds() * 1000)), schema, STATE, "update", "EventTimeTimeout")
    day = F.when(F.col("_was") != NO_DAY, F.date_from_unix_date("_was"))
    return newest.select(*events.columns, F.col("_had").alias("replaces"), day.alias("replaced_day"))
