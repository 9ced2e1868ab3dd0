"""Resumable work: state tables in batch, the same rules in Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..functions.urls import signature
from ..operators.dedupe import pending

#: The state store that state with timers needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def job_signature(seeds: DataFrame, column: str, length: int = 12, ordered: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """The signature of a job's seed list (pos and `column`), one row, or one for each job of `by`.

    A job's list is small by nature: it becomes one array.
    """
    every = F.transform(F.sort_array(F.collect_list(F.struct("pos", F.col(column).alias("v")))), lambda x: x["v"])
    return seeds.groupBy(*by).agg(signature(every, length, "\n" if ordered else "|", ordered).alias("job"))


def fresh_state(state: DataFrame, now: Column, hours: float, stamp: str = "ts") -> DataFrame:
    """State that is not older than `hours`; older work starts again."""
    return state.where(F.col(stamp) >= now - F.make_interval(hours=F.lit(int(hours)), secs=F.lit((hours % 1) * 3600)))


def latest_status(log: DataFrame) -> DataFrame:
    """(url, status, attempts, last_error) of a work log (url, run, status, error); a success clears earlier failures."""
    last = log.groupBy("url").agg(
        F.max_by("status", "run").alias("status"),
        F.count("*").alias("attempts"),
        F.max_by("error", "run").alias("_e"),
    )
    return last.select("url", "status", "attempts", F.when(F.col("status") != "done", F.col("_e")).alias("last_error"))


def resume(wanted: DataFrame, log: DataFrame, retry_failed: bool = False) -> DataFrame:
    """What is still to do: neither done nor, without the flag, failed."""
    now = latest_status(log)
    return pending(wanted, now.where("status = 'done'"), now.where("status = 'failed'"), "url", retry_failed)


def run_incremental(source: DataFrame, checkpoint: str, publish: Callable[[DataFrame, int], None], snapshot: str | None = None) -> None:
    """Work through new files of a streaming source once; each micro-batch is published and its snapshot overwritten.

    The checkpoint remembers finished files, so the same call continues where
    the last one ended.
    """

    def each(batch: DataFrame, number: int) -> None:
        publish(batch, number)
        if snapshot:
            batch.write.mode("overwrite").parquet(f"{snapshot}/batch={number}")

    source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_status(path: str) -> Callable[[DataFrame, int], None]:
    """A publisher of a batch's statuses under its stream and number; readers take `latest_status`.

    A batch that is worked off again, after a failure before its commit, replaces
    what it wrote before, so no attempt counts twice.  The stream's name is the one
    that its checkpoint keeps; a stream with a new checkpoint publishes beside it.
    """

    def publish(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("upsert_status publishes the batches of a stream")
        batch.write.mode("overwrite").parquet(f"{path}/stream={stream}/run={number}")

    return publish


def streak_stream(log: DataFrame, host: str = "host", order: str = "ts", failed: str = "failed", every: int = 6, abort: int = 18) -> DataFrame:
    """Alerts (host, ts, streak, alert) of a streaming fetch log: each `every`-th failure in a row, and all from `abort` on.

    The state of a host is one number.  A micro-batch's rows of one host are ordered
    at once; the source's maxFilesPerTrigger or maxBytesPerTrigger bounds them.
    """

    def step(key, batches, state: GroupState):
        streak = state.get[0] if state.exists else 0
        out = []
        for row in pd.concat(list(batches)).sort_values(order).itertuples():
            streak = streak + 1 if getattr(row, failed) else 0
            if streak >= abort or streak and streak % every == 0:
                out.append((key[0], getattr(row, order), streak, "abort" if streak >= abort else "pause"))
        state.update((streak,))
        yield pd.DataFrame(out, columns=["host", "ts", "streak", "alert"])

    kinds = dict(log.dtypes)
    return log.groupBy(host).applyInPandasWithState(step, f"host {kinds[host]}, ts {kinds[order]}, streak int, alert string", "streak int", "append", GroupStateTimeout.NoTimeout)


class _Streaks(StatefulProcessor):
    """Failures in a row of one host, counted once the watermark has passed them."""

    def __init__(self, every: int, abort: int, idle_ms: int):
        self.every, self.abort, self.idle_ms = every, abort, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.streak = handle.getValueState("streak", "n int, at bigint")
        self.waiting = handle.getListState("waiting", "at bigint, tie bigint, failed boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        # one call for all rows: each call of the state is a message to Spark and back
        new = [(row["at"], row["tie"], bool(row["failed"])) for row in rows]
        if new:
            self.waiting.appendList(new)
            self.handle.registerTimer(_due(min(new)[0]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        held = sorted(self.waiting.get())
        ripe, later = [r for r in held if _due(r[0]) <= now], [r for r in held if _due(r[0]) > now]
        n, last = self.streak.get() or (0, None)
        out = []
        for at, tie, failed in ripe:
            if last is not None and at - last > self.idle_ms * 1000:
                n = 0
            n, last = n + 1 if failed else 0, at
            if n >= self.abort or n and n % self.every == 0:
                out.append(Row(host=key[0], at=at, tie=tie, streak=n, alert="abort" if n >= self.abort else "pause"))
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(_due(later[0][0]))
        else:
            self.waiting.clear()
        if last is None or (not later and now >= _due(last) + self.idle_ms):
            self.streak.clear()
        else:
            self.streak.update((n, last))
            self.handle.registerTimer(_due(last) + self.idle_ms)
        return iter(out)

    def close(self) -> None:
        pass


def _due(micros: int) -> int:
    """The first millisecond of the watermark at which nothing of that time can still come."""
    return micros // 1000 + 1


def ordered_streak_stream(log: DataFrame, host: str = "host", order: str = "ts", tie: str = "id", failed: str = "failed", late: str = "10 minutes", idle: timedelta = timedelta(days=1), every: int = 6, abort: int = 18) -> DataFrame:
    """Alerts (host, ts, id, streak, alert) of a streaming fetch log in the order of its time, however it arrives.

    A host's rows wait in its state until the watermark (`late` behind the latest
    time) has passed them, are counted in the order of (time, tie), and leave it; so
    a host holds no more than its rows of that span.  Later rows are dropped.  A host
    without rows for longer than `idle` loses its state: its next failure is its
    first.  A null host is one of its own; a row without time or tie raises.  The
    times are timestamps, the ties longs.  Needs the RocksDB state store, as
    `ROCKSDB` names it.
    """
    store = log.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass")
    if store != ROCKSDB:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {ROCKSDB}")
    rows = log.select(F.col(host).cast("string").alias("host"), F.col(order).cast("timestamp").alias("ts"), F.unix_micros(F.col(order).cast("timestamp")).alias("at"), F.col(tie).cast("bigint").alias("tie"), F.col(failed).alias("failed"))
    step = _Streaks(every, abort, int(idle.total_seconds() * 1000))
    found = rows.withWatermark("ts", late).groupBy("host").transformWithState(step, "host string, at bigint, tie bigint, streak int, alert string", "append", "EventTime")
    return found.select("host", F.timestamp_micros("at").alias("ts"), F.col("tie").alias("id"), "streak", "alert")
