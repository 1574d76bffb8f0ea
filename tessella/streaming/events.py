"""Event reducers: slots with begin and finish, windows, and retention; batch and streaming forms."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

BEGIN, FINISH, ERROR = "BEGIN", "FINISH", "ERROR"
#: The time of a closing event (2200-01-01; pandas holds times to 2262), and one that all delays leave the watermark past.
CLOSING_MS = 7_258_118_400_000
BEYOND_MS = CLOSING_MS - 3650 * 86_400_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def slot_elapsed(events: DataFrame, ttl: float | None = None) -> DataFrame:
    """slot_key, item_type, type, time, elapsed of FINISH and ERROR events.

    An end counts from the slot's event before it, whichever that is (0 without
    one), and under the item type of the slot's last BEGIN; without a BEGIN under
    that of its first end. A slot that has ended and stays idle for more than ``ttl``
    seconds is forgotten: its next event is a first one. Events: slot_key, item_type,
    type, time (double), seq (order of equal times); other types take no part.
    """
    used = events.where(F.col("type").isin(BEGIN, FINISH, ERROR))
    if ttl is None:
        life = F.lit(0)
    else:
        whole = Window.partitionBy("slot_key").orderBy("time", "seq")
        forgotten = (F.lag("type").over(whole) != BEGIN) & (F.col("time") - F.lag("time").over(whole) > ttl)
        used = used.withColumn("_new", F.coalesce(forgotten.cast("int"), F.lit(0)))
        life = F.sum("_new").over(whole.rowsBetween(Window.unboundedPreceding, 0))
    slot = Window.partitionBy("slot_key", "_life").orderBy("time", "seq")
    before = slot.rowsBetween(Window.unboundedPreceding, -1)
    begun = F.last(F.when(F.col("type") == BEGIN, F.struct("item_type")), ignorenulls=True).over(before)["item_type"]
    has_begun = F.coalesce(F.max(F.col("type") == BEGIN).over(before), F.lit(False))
    first = F.first("item_type").over(slot.rowsBetween(Window.unboundedPreceding, 0))
    out = used.withColumn("_life", life).withColumns({"elapsed": F.coalesce(F.col("time") - F.lag("time").over(slot), F.lit(0.0)), "_kind": F.when(has_begun, begun).otherwise(first)})
    return out.where(F.col("type").isin(FINISH, ERROR)).select("slot_key", F.col("_kind").alias("item_type"), "type", "time", "elapsed")


def type_totals(elapsed: DataFrame) -> DataFrame:
    return elapsed.groupBy("item_type").agg(F.count("*").alias("n"), F.round(F.sum("elapsed"), 3).alias("elapsed"))


class Slots(StatefulProcessor):
    """The state of a bucket of slots: events that wait for the watermark, each slot's last event, and what it did per item type.

    Events are taken in the order of their times once the watermark has passed them,
    so batches and the order in them do not matter. Event-time timers do the rest: a
    slot that has ended is forgotten ``ttl`` seconds later, when its totals leave as
    rows and its state goes. Whatever is left leaves when the closing event has moved
    the watermark past all times.

    A call to the state is a round trip to the JVM, so state is kept as columns (lists)
    of the whole bucket: calls grow with buckets and parts of batches, not with events or slots.
    """

    def __init__(self, ttl: float) -> None:
        self.ttl = ttl

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "slot array<string>, time array<double>, seq array<long>, type array<string>, kind array<string>")
        self.last = handle.getValueState("last", "slot array<string>, time array<double>, ended array<boolean>, begun array<boolean>, kind array<string>")
        self.totals = handle.getValueState("totals", "slot array<string>, kind array<string>, n array<long>, elapsed array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for part in rows:
            part = part[part["type"].isin((BEGIN, FINISH, ERROR))]
            if len(part):
                self.waiting.appendValue(tuple(part[c].tolist() for c in ("slot_key", "time", "seq", "type", "item_type")))
                first = part["time"].min() if first is None else min(first, part["time"].min())
        if first is not None:
            self.handle.registerTimer(max(int(first * 1000) + 1, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        ready, rest = [], []
        if self.waiting.exists():
            for part in self.waiting.get():
                for e in zip(*part, strict=True):
                    (ready if e[1] * 1000 <= mark else rest).append(e)
        ready.sort()
        last, totals, out = {}, {}, []
        if self.last.exists():
            last = {slot: state for slot, *state in zip(*self.last.get(), strict=True)}
        if self.totals.exists():
            for slot, kind, n, spent in zip(*self.totals.get(), strict=True):
                totals.setdefault(slot, {})[kind] = n, spent

        def leave(slot: str, why: str) -> None:
            out.extend((slot, k, n, spent, why) for k, (n, spent) in totals.pop(slot, {}).items())

        for slot, at, _, type_, kind in ready:
            state = last.get(slot)
            if state is not None and state[1] and at - state[0] > self.ttl:
                leave(slot, "evicted")
                state = None
            if type_ == BEGIN:
                last[slot] = (at, False, True, kind)
                continue
            own = kind if state is None else state[3]
            done = totals.setdefault(slot, {})
            n, spent = done.get(own, (0, 0.0))
            done[own] = n + 1, spent + (at - state[0] if state is not None else 0.0)
            last[slot] = (at, True, state is not None and state[2], own)
        over = mark >= BEYOND_MS
        gone = [slot for slot, state in last.items() if over or (state[1] and mark > (state[0] + self.ttl) * 1000)]
        for slot in gone:
            leave(slot, "closed" if over else "evicted")
            del last[slot]
        if ready:
            self._keep(self.waiting, rest)
        if ready or gone:
            self._keep(self.last, [(slot, *state) for slot, state in last.items()])
            self._keep(self.totals, [(slot, k, n, spent) for slot, done in totals.items() for k, (n, spent) in done.items()])
        due = [int((at + self.ttl) * 1000) + 1 if ended else BEYOND_MS for at, ended, *_ in last.values()]
        if rest:
            due.append(int(min(e[1] for e in rest) * 1000) + 1)
        if due:
            self.handle.registerTimer(max(min(due), mark + 1))
        if out:
            yield pd.DataFrame(out, columns=["slot_key", "item_type", "n", "elapsed", "why"])

    def _keep(self, state, rows: list[tuple]) -> None:
        """``rows`` as columns, in place of what the state holds."""
        if not rows:
            state.clear()
            return
        columns = tuple(list(c) for c in zip(*rows, strict=True))
        state.put([columns]) if state is self.waiting else state.update(columns)

    def close(self) -> None:
        pass


def slot_stream(events: DataFrame, ttl: float = 2.0, buckets: int = 512) -> DataFrame:
    """The reducer as a stream: slot_key, item_type, n, elapsed, why (evicted, closed).

    ``events`` has slot_key (string), item_type (string), type, time, seq and ts with a
    watermark; see :func:`closed`. A slot's rows leave once, when it is forgotten or the
    stream is closed, so sums over them are those of :func:`slot_elapsed` with the same
    ``ttl``. Needs the RocksDB state store.

    Slots are dealt to ``buckets`` by their hash; a bucket's waiting events and slots are
    in a task's memory at once and written again when some are due. The number is part
    of the state: it cannot change between runs of a stream.
    """
    out = "slot_key string, item_type string, n long, elapsed double, why string"
    # Other types and the closing event count for the watermark only. A condition without the event time would go
    # below the watermark, and with one that forgets the closing event the stream would not end.
    used = events.where(F.col("type").isin(BEGIN, FINISH, ERROR) | (F.col("ts") >= F.timestamp_millis(F.lit(CLOSING_MS))))
    slot = F.coalesce("slot_key", F.lit(""))
    dealt = used.select(F.pmod(F.hash(slot), F.lit(buckets)).alias("bucket"), slot.alias("slot_key"), "item_type", "type", "time", "seq", "ts")
    return dealt.groupBy("bucket").transformWithStateInPandas(Slots(ttl), out, "append", "eventTime")


def closed(stream: DataFrame, time: str, delay: str, folder: str) -> tuple[DataFrame, Callable[[], None]]:
    """A stream with a watermark and room for a closing event, and a function that sends that event.

    The event is a row of nulls at a time beyond all, which lets every window and timer
    end. It has to come after all others: :func:`run_available` drains, sends it and
    drains again.
    """
    spark, path = stream.sparkSession, f"{folder}/closing"
    row = [(F.timestamp_millis(F.lit(CLOSING_MS)) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
    spark.range(0).select(*row).write.mode("append").parquet(path)
    with_room = stream.unionByName(spark.readStream.schema(stream.schema).parquet(path)).withWatermark(time, delay)
    return with_room, lambda: spark.range(1).select(*row).write.mode("append").parquet(path)


def tumbling(events: DataFrame, time: str, length: str, *keys: str) -> DataFrame:
    """Counts and sums by window and keys; works on streams (event time as TIMESTAMP) and tables."""
    window = F.window(F.col(time), length)
    return events.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, gap: str, key: str) -> DataFrame:
    window = F.session_window(F.col(time), gap)
    return events.groupBy(window.alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), "n")


def run_available(stream: DataFrame, name: str, folder: str, close: Callable[[], None] | None = None) -> DataFrame:
    """Drain a stream in append mode into a table under ``folder``/``name`` and return it; the stream's state goes beside it.

    Windows and slots leave their state as the watermark passes them; with ``close``
    the stream is drained, closed and drained again.
    """
    path = f"{folder}/{name}/table"

    def save(batch: DataFrame, number: int) -> None:
        # A batch that runs again writes its own folder again.
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    def drain() -> None:
        writer = stream.writeStream.foreachBatch(save).outputMode("append").option("checkpointLocation", f"{folder}/{name}/state")
        writer.trigger(availableNow=True).start().awaitTermination()

    drain()
    if close is not None:
        close()
        drain()
    return stream.sparkSession.read.schema(stream.schema).option("basePath", path).option("recursiveFileLookup", "true").parquet(path)


def stream_folder(spark) -> str:
    """Where streams keep their state: the cluster's shared folder; a local session may lack one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tessella-stream-")


def retained(entries: DataFrame, time: str, key: str, n: int) -> DataFrame:
    """The n newest entries."""
    return entries.orderBy(F.col(time).desc(), key).limit(n)
