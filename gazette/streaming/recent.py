"""Incremental suppression of recent repeats, as entries arrive."""

from __future__ import annotations

import pickle
import tempfile
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Calendar days are counted at this offset.
OFFSET_HOURS = 9
#: A column of the processor's own.
DAY = "calendar_day_"
DAY_MS = 24 * 3_600_000
#: Bytes of one key's rows of a micro-batch that are held in memory; beyond, they wait in a file of the task's own.
HELD = 32 << 20
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def calendar_day(at):
    """Whole days since the epoch at +09:00, whatever the session's zone."""
    return F.floor((F.unix_micros(at) + OFFSET_HOURS * 3_600_000_000) / 86_400_000_000).cast("int")


def _closes(day: int, days: int) -> int:
    """Milliseconds since the epoch at which the last day that looks back on `day` is over."""
    return (day + days + 1) * DAY_MS - OFFSET_HOURS * 3_600_000


class RecentRepeats(StatefulProcessor):
    """State of a key: the calendar days on which a row of it survived, each until a timer says that no row can look back on it any more."""

    def __init__(self, days: int) -> None:
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.survived = handle.getMapState("survived", "day int", "n long")

    def _mark(self, day: int, n: int) -> None:
        before = self.survived.getValue((day,)) if self.survived.containsKey((day,)) else None
        self.survived.updateValue((day,), ((before[0] if before else 0) + n,))
        if before is None:
            self.handle.registerTimer(_closes(day, self.days))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a key's rows come in several chunks where an Arrow batch ends, with days in any order, so its days are judged once all are known
        with tempfile.SpooledTemporaryFile(max_size=HELD) as held:
            days: Counter[int] = Counter()
            chunks = 0
            for chunk in rows:
                days.update(chunk[DAY].value_counts().to_dict())
                pickle.dump(chunk, held)
                chunks += 1
            kept = []
            for day in sorted(days):
                if not any(self.survived.containsKey((int(day) - back,)) for back in range(1, self.days + 1)):
                    self._mark(int(day), int(days[day]))
                    kept.append(day)
            held.seek(0)
            for _ in range(chunks):
                chunk = pickle.load(held)
                left = chunk[chunk[DAY].isin(kept)]
                if len(left):
                    yield left.drop(columns=DAY)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        day = (expiredTimerInfo.getExpiryTimeInMs() + OFFSET_HOURS * 3_600_000) // DAY_MS - self.days - 1
        if self.survived.containsKey((day,)):
            self.survived.removeKey((day,))
        yield from ()

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for day in initialState[DAY].unique():
            self._mark(int(day), 0)


def without_recent(entries: DataFrame, key: str = "cluster_key", at: str = "published_at", days: int = 3, delay: str = "2 days", history: DataFrame | None = None) -> DataFrame:
    """The entries of a stream whose key has no surviving row on one of the `days` calendar days before their own.

    Today doesn't count, so rows of one day all stay or all go. A row is judged by what has
    survived when it arrives; of one key's rows in a micro-batch, earlier days go first. Rows older
    than the watermark (`delay` behind the newest time) are dropped by Spark. history(key, date)
    holds the days before the stream began. Rows without key or time have no past: they pass
    without state. A key's state is at most days + delay + 1 numbers, however many rows it has.
    """
    spark: SparkSession = entries.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    blank = (F.coalesce(F.col(key).cast("string"), F.lit("")) == "") | F.col(at).isNull()
    known = entries.where(~blank).withWatermark(at, delay).withColumn(DAY, calendar_day(F.col(at)))
    start = None
    if history is not None:
        dated = history.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").select(F.col(key), F.unix_date(F.col("date").cast("date")).alias(DAY))
        start = dated.distinct().groupBy(key)
    judged = known.groupBy(key).transformWithStateInPandas(RecentRepeats(days), entries.schema, "Append", "EventTime", initialState=start)
    return judged.unionByName(entries.where(blank))


def first_within(entries: DataFrame, key: str = "cluster_key", at: str = "published_at", delay: str = "3 days") -> DataFrame:
    """Of rows with one key, the first to arrive within the watermark's delay: an event-time span that includes today, without Python workers."""
    return entries.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])
