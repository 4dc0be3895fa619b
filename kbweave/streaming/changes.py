"""Change detection as a stateful stream: each URL carries its version chain, and a timer marks it deleted when later runs lack it.

The state of a URL is its last version, effective hash, status and the place (run, order) of the last row that was taken. Rows of a micro-batch are taken in that order; a row at or before the last place is a replay and gives nothing, so
that a source that repeats files after a restart does no harm. Within a URL runs must arrive in order. A timer at the event time of the last sighting plus `keep` fires when the watermark passes it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kbweave.sources.storage import struct

#: Rows of the stream: a fetched page of a run.
PAGE = struct("normalized_url string, run long, ord long, seen_at timestamp, success boolean, content_hash string")
CHANGE = struct("normalized_url string, run long, ord long, version_no long, change_status string, index_status string, effective_hash string, previous_content_hash string")
STATE = struct("version_no long, effective_hash string, change_status string, run long, ord long, seen_ms long")
#: The state store that timers and several columns of state need.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def step(state: tuple | None, run: int, order: int, seen_ms: int, success: bool, content_hash: str | None) -> tuple[tuple, tuple | None]:
    """(new state, change or None) of one page row; the rules of classify_changes."""
    version, before, _, last_run, last_order, last_ms = state or (0, None, None, None, None, 0)
    if last_run is not None and (run, order) <= (last_run, last_order):
        return state, None
    effective = content_hash if success or before is None else before
    if before is None:
        status = "NEW"
    elif not success or content_hash == before:
        status = "UNCHANGED"
    else:
        status = "UPDATED"
    index = "PENDING" if success and status in ("NEW", "UPDATED") else "SKIPPED"
    return (version + 1, effective, status, run, order, max(seen_ms, last_ms)), (run, order, version + 1, status, index, effective, before)


class Changes(StatefulProcessor):
    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("chain", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N803
        state = tuple(self.state.get()) if self.state.exists() else None
        given = pd.concat(rows).sort_values(["run", "ord"], kind="stable")
        made = []
        for run, order, seen, success, digest in zip(given["run"], given["ord"], given["seen_at"], given["success"], given["content_hash"], strict=True):
            state, change = step(state, int(run), int(order), int(pd.Timestamp(seen).timestamp() * 1000), bool(success), digest)
            if change:
                made.append((key[0], *change))
        if made:
            self.state.update(state)
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
            self.handle.registerTimer(state[5] + self.keep_ms)
            yield pd.DataFrame(made, columns=CHANGE.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N803
        version, effective, status, run, order, seen_ms = self.state.get()
        # a page seen again has a later timer
        if status != "DELETED" and expiredTimerInfo.getExpiryTimeInMs() >= seen_ms + self.keep_ms:
            self.state.update((version + 1, effective, "DELETED", run, order, seen_ms))
            yield pd.DataFrame([(key[0], run, None, version + 1, "DELETED", "SKIPPED", effective, effective)], columns=CHANGE.names)

    def close(self) -> None:
        pass


def stream_changes(pages: DataFrame, keep: str = "36 hours", late: str = "0 seconds") -> DataFrame:
    """CHANGE rows of a stream of PAGE rows. A URL that no run has brought for `keep` of event time is DELETED; its row carries the run that saw it last and no order."""
    if pages.isStreaming:
        pages.sparkSession.conf.set(*PROVIDER)
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    timed = pages.select(*PAGE.names).where("normalized_url <> ''").withWatermark("seen_at", late)
    return timed.groupBy("normalized_url").transformWithStateInPandas(Changes(keep_ms), CHANGE, "Append", "EventTime")


def deleted_of(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("change_status") == "DELETED")
