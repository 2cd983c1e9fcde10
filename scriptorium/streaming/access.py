"""Streams over append-only logs: daily counts, throttles, once-per-period events, decisions with take-backs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_of(spark: SparkSession, path: str, schema: str, at: str = "ts", late: str = "1 hour", files_per_trigger: int = 100) -> DataFrame:
    """A Parquet folder as a stream with event time and watermark; a time without zone is read as UTC of the session."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)


def daily_counts(events: DataFrame, at: str = "ts", kind: str = "event_type") -> DataFrame:
    """(inizio, kind, n) per day, emitted once the watermark has passed it."""
    return events.groupBy(F.window(at, "1 day").alias("_w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("_w.start").alias("inizio"), kind, "n")


def sessions(events: DataFrame, key: str, at: str = "ts", gap: str = "30 minutes") -> DataFrame:
    """(key, inizio, fine, n) of runs of events closer than `gap`."""
    return events.groupBy(key, F.session_window(at, gap).alias("_w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("_w.start").alias("inizio"), F.col("_w.end").alias("fine"), "n")


def throttled(events: DataFrame, key: str, at: str, kind: str, bad: str, good: str, seconds: int = 600, limit: int = 8) -> DataFrame:
    """(key, at, recenti, bloccato) of each event `bad`: how many fell into the last `seconds`; `good` clears the key.

    State per key is the times in the window, dropped after `seconds` without events.
    """
    kind_of = dict(events.dtypes)[key]

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values(at)
        out = []
        for t, k in zip(rows[at], rows[kind]):
            s = t.timestamp()
            if k == good:
                times = []
            elif k == bad:
                times = [x for x in times if x > s - seconds] + [s]
                out.append((name[0], t, len(times), len(times) >= limit))
        state.update((times,))
        state.setTimeoutTimestamp(max(int(rows[at].max().timestamp() * 1000) + seconds * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=[key, at, "recenti", "bloccato"])

    return events.groupBy(key).applyInPandasWithState(step, f"{key} {kind_of}, {at} timestamp, recenti int, bloccato boolean", "times array<double>", "append", GroupStateTimeout.EventTimeTimeout)


def once_per(events: DataFrame, key: str, at: str, seconds: int) -> DataFrame:
    """Events at least `seconds` after the last accepted one of their key; a key's state is one number and idles out."""
    kind_of = dict(events.dtypes)[key]

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        keep = []
        for t in sorted(x for b in batches for x in b[at]):
            s = t.timestamp()
            if last is None or s - last >= seconds:
                last = s
                keep.append(t)
        state.update((last,))
        state.setTimeoutTimestamp(max(int((last + seconds) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [name[0]] * len(keep), at: keep})

    return events.groupBy(key).applyInPandasWithState(step, f"{key} {kind_of}, {at} timestamp", "last double", "append", GroupStateTimeout.EventTimeTimeout)


def decisions(log: DataFrame, book: str = "libro_id") -> DataFrame:
    """(libro_id, id, classe) after each record of an ordered log, by a stack of decisions per book; classe is null where a title has none left.

    For records in order within a trigger; logs with late records are merged in batches by the bucketed table instead.
    """
    kind_of = dict(log.dtypes)[book]

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ids, classes = (list(x) for x in state.get) if state.exists else ([], [])
        rows = pd.concat(list(batches)).sort_values(["istante", "prog"])
        out: dict[int, str | None] = {}
        for i, c, back in zip(rows["id"], rows["classe"], rows["annulla"]):
            if back is True or back == True:  # noqa: E712 - a nullable flag of pandas
                if ids:
                    gone = int(ids.pop())
                    classes.pop()
                    out[gone] = next((k for j, k in zip(ids[::-1], classes[::-1]) if int(j) == gone), None)
            elif i == i and i is not None:
                ids.append(int(i))
                classes.append(c)
                out[int(i)] = c
        state.update((ids, classes))
        yield pd.DataFrame({book: [name[0]] * len(out), "id": list(out), "classe": list(out.values())})

    return log.groupBy(book).applyInPandasWithState(step, f"{book} {kind_of}, id int, classe string", "ids array<int>, classi array<string>", "update", GroupStateTimeout.NoTimeout)


def drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there and give the rows of its memory table (tests and small reports)."""
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()
    return stream.sparkSession.table(name)
