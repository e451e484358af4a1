"""Stateful processors of the streaming jobs. They are sent to Python workers by value, so this module uses nothing of the library."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType


def _micros(times: pd.Series) -> list[int]:
    return times.astype("datetime64[us]").astype("int64").tolist()


class CrashFold(StatefulProcessor):
    """The crash fold in event time. Events wait until the watermark has passed them, and are then folded in their order.

    Events of a task that come together wait as one value, and a task asks for a timer once in a batch. Rows without an event don't wait.
    """

    def __init__(self, most: int):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.fold = handle.getValueState("fold", StructType([StructField("attempts", LongType()), StructField("resolved", BooleanType())]))
        self.waiting = handle.getListState("waiting", StructType([StructField("events", StringType())]))  # JSON: [ts, event_id, event] of each

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            events = [e for e in zip(_micros(pdf["ts"]), pdf["event_id"].tolist(), pdf["event"].tolist()) if e[2] is not None]
            if events:
                self.waiting.appendValue((json.dumps(events),))
                first = min([e[0] for e in events] + ([] if first is None else [first]))
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(tuple(e) for w in self.waiting.get() for e in json.loads(w[0]))
        ready, later = [w for w in waiting if w[0] <= passed], [w for w in waiting if w[0] > passed]
        if not ready:
            return
        attempts, resolved = self.fold.get() or (0, False)
        ids, events, counts, statuses = [], [], [], []
        for _, event_id, event in ready:
            if event == "process_crash":
                attempts = 1 if resolved else attempts + 1
                status = "quarantined" if attempts >= self.most else "retrying"
            else:
                status = "resolved" if event == "resolved" else "quarantined"
            resolved = event == "resolved"
            ids.append(int(event_id))
            events.append(event)
            counts.append(attempts)
            statuses.append(status)
        self.fold.update((int(attempts), bool(resolved)))
        if later:
            self.waiting.put([(json.dumps(later),)])
            self.handle.registerTimer(later[0][0] // 1000 + 1)
        else:
            self.waiting.clear()
        yield pd.DataFrame({"task": int(key[0]), "event_id": ids, "event": events, "attempts": counts, "status": statuses})

    def close(self) -> None:
        pass
