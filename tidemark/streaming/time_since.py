"""Days since the last reference event, on a stream of events (an extension of the batch operator)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_OUT = "id long, event_id long, ts timestamp, ref_event int, timeline long, days_since_ref long"
_DAY = 86_400_000_000
_NEVER = -(1 << 62)


def time_since_stream(events: DataFrame, id: str, date: str, event: str, condition: Column, late: str = "1 hour", idle_days: int | None = None) -> DataFrame:
    """id, event_id, ts, ref_event, timeline and whole days since the id's last reference event (-1 before the first).

    The state of an id is its last reference time and how many it has had, two numbers.  With idle_days it goes
    after so many days of event time without an event, and an id that comes back then starts anew; without, it is
    kept, and timelines go on for good.  Events of one batch are taken in order
    of time; one that comes in a later batch than a newer one sees the state as
    it then is, with the days rounded down below zero.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, n = state.get if state.exists else (_NEVER, 0)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"], kind="stable")
        now = rows["ts"].to_numpy("datetime64[us]").astype(np.int64)
        ref = rows["ref_event"].to_numpy() == 1
        seen = np.maximum.accumulate(np.maximum(np.where(ref, now, _NEVER), last))
        count = n + np.cumsum(ref)
        state.update((int(seen[-1]), int(count[-1])))
        if idle_days is not None:
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), int(now.max()) // 1000) + idle_days * 86_400_000)
        days = np.where(seen > _NEVER, (now - seen) // _DAY, -1)
        yield pd.DataFrame({"id": key[0], "event_id": rows["event_id"].to_numpy(), "ts": rows["ts"].to_numpy(), "ref_event": rows["ref_event"].to_numpy(), "timeline": count, "days_since_ref": days})

    own = events.select(F.col(id).cast("long").alias("id"), F.col(event).cast("long").alias("event_id"), F.col(date).cast("timestamp").alias("ts"), F.coalesce(condition.cast("int"), F.lit(0)).alias("ref_event"))
    timeout = GroupStateTimeout.NoTimeout if idle_days is None else GroupStateTimeout.EventTimeTimeout
    return own.withWatermark("ts", late).groupBy("id").applyInPandasWithState(step, _OUT, "last long, n long", "append", timeout)
