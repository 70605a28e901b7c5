"""How work goes on, as Spark itself counts it: rows of batches by observation, rates of streams by a listener.

Events are dictionaries: command, event (start, batch, done or failed), rows, seconds, and, where a total is known, rate a second
and seconds left. They go to a function, so they can be shown, logged or kept in a table once the command ends.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

Event = dict[str, Any]


def pace(rows: int, seconds: float, total: int | None = None) -> Event:
    """Rate a second, and the seconds that the rest of a known total takes at it."""
    rate = rows / seconds if seconds > 0 else 0.0
    return {"rate": rate, "seconds_left": None if total is None or rate == 0 else max(0, total - rows) / rate}


class Counted:
    """Frames whose rows are counted as they are written or collected, without another pass."""

    def __init__(self, command: str, tell: Callable[[Event], None], clock: Callable[[], float] = time.monotonic):
        self.command, self.tell, self.clock, self.seen = command, tell, clock, {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        self.seen[name] = Observation(f"{self.command}-{name}")
        return df.observe(self.seen[name], F.count(F.lit(1)).alias("rows"))

    def rows(self) -> dict[str, int]:
        """Rows of every watched frame that was used; waits for the count of the job that used it."""
        return {name: seen.get["rows"] for name, seen in self.seen.items()}


@contextmanager
def counted(command: str, tell: Callable[[Event], None], clock: Callable[[], float] = time.monotonic) -> Iterator[Counted]:
    """A start event, and a done event with the rows of watched frames, or failed with the error's name.

    All frames that are watched inside must be written or collected inside.
    """
    work, began = Counted(command, tell, clock), clock()
    tell({"command": command, "event": "start"})
    try:
        yield work
    except BaseException as x:
        tell({"command": command, "event": "failed", "error": type(x).__name__, "seconds": clock() - began})
        raise
    seconds = clock() - began
    for name, n in work.rows().items():
        tell({"command": command, "event": "batch", "name": name, "rows": n, "seconds": seconds, **pace(n, seconds)})
    tell({"command": command, "event": "done", "rows": sum(work.rows().values()), "seconds": seconds})


class StreamProgress(StreamingQueryListener):
    """Events of the streams of a session: start, a batch event for each batch that had rows, done or failed.

    total: the rows that a run is expected to read, by name of query. Progress comes a moment after its batch.
    """

    def __init__(self, tell: Callable[[Event], None], total: dict[str, int] | None = None):
        self.tell, self.total, self.done, self.names = tell, total or {}, {}, {}

    def onQueryStarted(self, event) -> None:
        run = str(event.runId)
        self.names[run], self.done[run] = event.name or run, (0, 0.0)
        self.tell({"command": self.names[run], "event": "start"})

    def onQueryProgress(self, event) -> None:
        p, run = event.progress, str(event.progress.runId)
        if not p.numInputRows:
            return
        rows, seconds = self.done.get(run, (0, 0.0))
        rows, seconds = rows + p.numInputRows, seconds + p.batchDuration / 1000
        self.done[run] = rows, seconds
        name = self.names.get(run, run)
        self.tell({"command": name, "event": "batch", "batch": p.batchId, "rows": p.numInputRows, "seconds": p.batchDuration / 1000, **pace(rows, seconds, self.total.get(name))})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        rows, seconds = self.done.pop(run, (0, 0.0))
        out = {"command": self.names.pop(run, run), "event": "failed" if event.exception else "done", "rows": rows, "seconds": seconds}
        self.tell(out | ({"error": event.exception.splitlines()[0]} if event.exception else {}))


@contextmanager
def watching(spark: SparkSession, tell: Callable[[Event], None], total: dict[str, int] | None = None) -> Iterator[StreamProgress]:
    """Events of all streams that run inside; leaves once the listener has heard of their end."""
    listener = StreamProgress(tell, total)
    spark.streams.addListener(listener)
    try:
        yield listener
        until = time.monotonic() + 10
        while listener.names and time.monotonic() < until:
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(listener)
