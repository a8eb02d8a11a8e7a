"""Leases of claims as the state of a stream: a lease that nobody renews runs out by itself.

An optional extra: claims are otherwise folded from their log (operators/claims.py).  Needs
the RocksDB state store, see configure().
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "claim string, state string, at timestamp"
#: Kinds of events that end a lease, and what it is then.
ENDS = {"release": "released", "finish": "finished"}


def configure(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Lease(StatefulProcessor):
    """Of a claim: when its lease ends, with a timer for then.

    Events in order of time: a claim opens the lease, a renewal moves its end forward but never
    back, release and finish close it.  What comes after the end changes nothing.  Times are
    milliseconds of the event time; the timer fires once the watermark has passed the end.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.end = handle.getValueState("end", "end long")

    def _millis(self, t) -> int:
        t = pd.Timestamp(t)
        return int((t.tz_localize("UTC") if t.tzinfo is None else t).timestamp() * 1000)

    def _until(self, end: int) -> None:
        if self.end.exists():
            self.handle.deleteTimer(self.end.get()[0])
        self.end.update((end,))
        self.handle.registerTimer(end)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out = []
        for _, r in pd.concat(list(rows)).sort_values("at", kind="stable").iterrows():
            now, open_until = self._millis(r["at"]), self.end.get()[0] if self.end.exists() else None
            if r["kind"] == "claim" and open_until is None:
                self._until(self._millis(r["expires_at"]))
                out.append((key[0], "active", r["at"]))
            elif open_until is None or now >= open_until:
                continue
            elif r["kind"] == "renew":
                self._until(max(open_until, self._millis(r["expires_at"])))
            elif r["kind"] in ENDS:
                self.handle.deleteTimer(open_until)
                self.end.clear()
                out.append((key[0], ENDS[r["kind"]], r["at"]))
        yield pd.DataFrame(out, columns=["claim", "state", "at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        self.end.clear()
        yield pd.DataFrame([(key[0], "expired", pd.Timestamp(end, unit="ms"))], columns=["claim", "state", "at"])

    def close(self) -> None:
        pass


def lease_states(events: DataFrame, late: str = "1 minute") -> DataFrame:
    """(claim, state, at) of a stream of events (claim, kind, at, expires_at): active, released, finished, or expired once the watermark has passed a lease's end."""
    stream = events.select("claim", "kind", "at", "expires_at").withWatermark("at", late)
    return stream.groupBy("claim").transformWithStateInPandas(statefulProcessor=Lease(), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
