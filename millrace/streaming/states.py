"""The life of pages as a stream with state: what `queue.page_transition` says of one capture, over all that arrive.

Each page's state (status, retries, attempts, claim) lives in the stream's state store, on disk where the session asks for
RocksDB, and in its checkpoint, so a stream that is stopped goes on where it was. Captures and claims of a page are
folded in order of event time within a batch. A claim sets a timer; if no capture has come when the watermark passes it,
the page is waiting again, as `queue.recover_stale` does for tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.queue import MAX_RETRIES
from millrace.schema import struct

#: Needs a store that keeps columns of several kinds and timers.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
STATE = struct(status=T.StringType(), retry_count=T.IntegerType(), attempts=T.LongType(), claimed_at=T.TimestampType())
RESULT = struct(url=T.StringType(), event_id=T.LongType(), status=T.StringType(), retry_count=T.IntegerType(), attempts=T.LongType(), at=T.TimestampType())
#: Statuses that end the retries of a page, by class of its capture; the rest are tried again.
SETTLED = {"valid": "saved", "valid_empty": "valid_empty", "unavailable": "unavailable", "restriction_like": "blocked", "timeout": "timeout"}
CLAIM = "claim"


def after(kind: str, retries: int, max_retries: int = MAX_RETRIES) -> tuple[str, int]:
    """(status, retry_count) of a page after a capture of a class; `queue.page_transition` for one row."""
    if kind in SETTLED:
        return SETTLED[kind], 0 if kind in ("valid", "valid_empty") else retries
    return ("retry_pending", retries + 1) if retries < max_retries else ("review", retries)


class PageStates(StatefulProcessor):
    """Rows url, event_id, kind, at (kind: a capture's class, or claim) -> the page's state after each of them."""

    def __init__(self, stale_minutes: int, max_retries: int = MAX_RETRIES):
        self.stale, self.max_retries = pd.Timedelta(minutes=stale_minutes), max_retries

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.page = handle, handle.getValueState("page", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        status, retries, attempts, claimed = self.page.get() if self.page.exists() else ("pending", 0, 0, None)
        out = []
        for r in pd.concat(list(rows)).sort_values(["at", "event_id"]).itertuples():
            if r.kind == CLAIM:
                status, claimed = "opening", r.at
            else:
                status, retries = after(r.kind, retries, self.max_retries)
                attempts, claimed = attempts + 1, None
            out.append((key[0], r.event_id, status, retries, attempts, r.at))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if claimed is not None:
            self.handle.registerTimer(int((claimed + self.stale).timestamp() * 1000))
        self.page.update((status, retries, attempts, claimed))
        yield pd.DataFrame(out, columns=RESULT.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        status, retries, attempts, claimed = self.page.get()
        if status == "opening":
            self.page.update(("pending", retries, attempts, None))
            yield pd.DataFrame([(key[0], None, "pending", retries, attempts, pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms"))], columns=RESULT.names).astype({"event_id": "Int64"})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        r = initialState.iloc[0]
        self.page.update((r.status, int(r.retry_count), 0, None))

    def close(self) -> None:
        pass


def page_states(captures: DataFrame, pages: DataFrame | None = None, stale_minutes: int = 10, late: str = "1 hour") -> DataFrame:
    """A stream of captures (url, event_id, kind, at) -> each page's state after each capture and after each stale claim.

    pages: url, status, retry_count of pages that are known when the stream begins.
    """
    keyed = captures.select("url", "event_id", "kind", "at").withWatermark("at", late).groupBy("url")
    known = None if pages is None else pages.select("url", "status", "retry_count").groupBy("url")
    return keyed.transformWithStateInPandas(PageStates(stale_minutes), RESULT, "Append", "EventTime", known)
