"""Streaming twins of the telemetry reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from slotwise.operators.scale import neighbour, running
from slotwise.streaming.tables import MergedTable, each_batch, finish

PAUSE_SCHEMA = "run bigint, first_seq bigint, paused_us bigint, open_since_us bigint, closed boolean"
GAP_SCHEMA = "session_id string, kind string, low bigint, high bigint, samples bigint, missing bigint"
PROGRESS_SCHEMA = "run bigint, accepted bigint, session_accepted bigint, session_attempts bigint, session_start_us bigint, session_end_us bigint"
PROGRESS_RULES = {"accepted": F.sum, "session_accepted": F.sum, "session_attempts": F.sum, "session_start_us": F.min, "session_end_us": F.max}


def stream_resource_rollup(metrics: DataFrame, watermark: str, window: str) -> DataFrame:
    """Peaks, latest reading and counts per window, session and run state.

    metrics[session_id, sequence, ingested_at, run_state, cpu_percent, rss_bytes].
    """
    order = F.struct("ingested_at", "sequence")
    return (
        metrics.withWatermark("ingested_at", watermark)
        .groupBy(F.window("ingested_at", window).alias("window"), "session_id", "run_state")
        .agg(
            F.max("cpu_percent").alias("peak_cpu_percent"), F.max("rss_bytes").alias("peak_rss_bytes"),
            F.max_by("cpu_percent", order).alias("latest_cpu_percent"), F.count(F.lit(1)).alias("samples"),
        )
    )


class Gaps(StatefulProcessor):
    """Received sequence numbers of a session as merged intervals.

    Settled: the first number, the end of the part that can no longer change, and how many of it came. Waiting: intervals
    behind it whose gap may still be filled. When the watermark passes the first reading behind a gap, the gap comes out
    as final and the interval joins the settled part, so the state is as long as the allowed delay, not as the session.
    A number that is already in an interval is a repetition; one in the settled part is a repetition or too late.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("gaps", "first long, upto long, received long, " + ", ".join(f"{c} array<long>" for c in ("low", "high", "ms")))

    def _load(self) -> tuple[int | None, int | None, int, list[tuple[int, int, int]]]:
        """Settled part and waiting intervals. They are one value, as each access to a state is a call to another process."""
        held = self.state.get()
        return (*held[:3], list(zip(*held[3:], strict=True))) if held else (None, None, 0, [])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first, upto, received, spans = self._load()
        for frame in rows:
            fresh = [(int(n), int(n), int(ms)) for n, ms in zip(frame["sequence"], frame["ms"], strict=True) if upto is None or n > upto]
            spans = merge_spans(spans + fresh)
        yield pd.DataFrame(self._settle(key[0], first, upto, received, spans, timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """The watermark has passed the first waiting interval of a session that had no new reading."""
        first, upto, received, spans = self._load()
        if spans:
            yield pd.DataFrame(self._settle(key[0], first, upto, received, spans, timerValues.getCurrentWatermarkInMs()))

    def _settle(self, session: str, first: int | None, upto: int | None, received: int, spans: list[tuple[int, int, int]], watermark: int) -> list[dict]:
        out = []
        final = next((i for i, span in enumerate(spans) if span[2] > watermark), len(spans))
        for low, high, _ in spans[:final]:
            if upto is None:
                first = low
            elif low > upto + 1:
                out.append({"kind": "gap", "low": upto + 1, "high": low - 1, "samples": 0, "missing": low - 1 - upto})
            upto, received = high, received + high - low + 1
        spans = spans[final:]
        self.state.update((first, upto, received, *([span[c] for span in spans] for c in range(3))))
        if spans:
            self.handle.registerTimer(spans[0][2])
        samples = received + sum(high - low + 1 for low, high, _ in spans)
        start, end = first if first is not None else spans[0][0], spans[-1][1] if spans else upto
        out.append({"kind": "total", "low": start, "high": end, "samples": samples, "missing": end - start + 1 - samples})
        return [{"session_id": session} | row for row in out]

    def close(self) -> None:
        pass


def merge_spans(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Intervals (low, high, time of the first) without overlaps or touching neighbours."""
    out: list[tuple[int, int, int]] = []
    for low, high, ms in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high), out[-1][2])
        else:
            out.append((low, high, ms))
    return out


def stream_gaps(metrics: DataFrame, gaps: MergedTable, totals: MergedTable, checkpoint: str, watermark: str) -> None:
    """Final gaps in the sequence numbers of every session, and how many readings it has had and misses.

    metrics[session_id, sequence, ingested_at]; readings without a session or number are not counted. A session is one key:
    its readings of a micro-batch pass through one task in chunks and are merged chunk by chunk.
    """
    timed = metrics.withWatermark("ingested_at", watermark)
    readings = timed.where("session_id is not null and sequence is not null").select("session_id", "sequence", "ingested_at", F.unix_millis("ingested_at").alias("ms"))
    found = readings.groupBy("session_id").transformWithStateInPandas(Gaps(), GAP_SCHEMA, "append", "eventTime")

    def step(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        gaps.add(rows.where("kind = 'gap'").select("session_id", "low", "high"), batch)
        totals.add(rows.where("kind = 'total'").select("session_id", "samples", "missing"), batch)
        rows.unpersist()

    finish(found.writeStream.outputMode("append").foreachBatch(step), checkpoint, metrics.sparkSession)


class Pauses(StatefulProcessor):
    """Paused time of a run from its state changes, in the order of their numbers.

    The state is the last change that can no longer be preceded and the paused time up to it; changes behind the
    watermark's delay wait beside it. Repeated numbers count once; a change older than the settled one is too late. With
    ``silence_ms`` a timer closes a run that has been silent for so long; what comes later is a new part of the run.
    """

    def __init__(self, silence_ms: int | None):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "pauses", "first_seq long, seq long, us long, state string, paused_us long, waiting_seq array<long>, waiting_us array<long>, waiting_state array<string>"
        )

    def _load(self) -> tuple[tuple | None, dict[int, tuple[int, str]]]:
        """Settled change and waiting ones. They are one value, as each access to a state is a call to another process."""
        value = self.state.get()
        if value is None:
            return None, {}
        waiting = {seq: (us, state) for seq, us, state in zip(*value[5:], strict=True)}
        return (tuple(value[:5]) if value[0] is not None else None), waiting

    def _keep(self, held: tuple | None, waiting: list[tuple[int, tuple[int, str]]]) -> None:
        self.state.update((*(held or (None,) * 5), [seq for seq, _ in waiting], [us for _, (us, _) in waiting], [state for _, (_, state) in waiting]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held, changes = self._load()
        for frame in rows:
            for seq, us, state in zip(frame["seq"], frame["us"], frame["state"], strict=True):
                if held is None or seq > held[1]:
                    changes.setdefault(int(seq), (int(us), state))
        ordered = sorted(changes.items())
        watermark = timerValues.getCurrentWatermarkInMs()
        final = next((i for i, (_, (us, _)) in enumerate(ordered) if us // 1000 > watermark), len(ordered))
        for change in ordered[:final]:
            held = self._after(held, change)
        self._keep(held, ordered[final:])
        for change in ordered[final:]:
            held = self._after(held, change)
        if held is None:
            return
        if self.silence_ms is not None:
            self.handle.registerTimer(held[2] // 1000 + self.silence_ms)
        yield self._row(key[0], held, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        held, waiting = self._load()
        for change in sorted(waiting.items()):
            held = self._after(held, change)
        if held is not None and held[2] // 1000 + self.silence_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
            yield self._row(key[0], held, True)

    @staticmethod
    def _after(held: tuple | None, change: tuple[int, tuple[int, str]]) -> tuple:
        seq, (us, state) = change
        if held is None:
            return seq, seq, us, state, 0
        return held[0], seq, us, state, held[4] + (us - held[2] if held[3] == "paused" else 0)

    @staticmethod
    def _row(run: int, held: tuple, closed: bool) -> pd.DataFrame:
        since = held[2] if held[3] == "paused" else None
        row = {"run": [run], "first_seq": [held[0]], "paused_us": [held[4]], "open_since_us": pd.array([since], "Int64"), "closed": [closed]}
        return pd.DataFrame(row)

    def close(self) -> None:
        pass


def stream_pause_state(events: DataFrame, table: MergedTable, checkpoint: str, watermark: str, silence_ms: int | None = None) -> None:
    """Paused time per run from a stream of state changes [run, seq, us, state], one row a run (or part of a run) in ``table``.

    State changes of a run are few (someone pauses and resumes it), so one key's changes fit into one task.
    """
    timed = events.withColumn("at", F.timestamp_micros("us")).withWatermark("at", watermark)
    found = timed.groupBy("run").transformWithStateInPandas(Pauses(silence_ms), PAUSE_SCHEMA, "update", "eventTime")
    finish(found.writeStream.outputMode("update").foreachBatch(table.add), checkpoint, events.sparkSession)


def paused_totals(table: DataFrame) -> DataFrame:
    """Paused time of each run and the start of a pause that is still open."""
    last = F.max_by(F.struct("open_since_us"), "first_seq")
    return table.groupBy("run").agg(F.sum("paused_us").alias("paused_us"), last.alias("l")).select("run", "paused_us", "l.open_since_us")


def batch_progress(events: DataFrame) -> DataFrame:
    """Totals per run of some events; replayed ones count as baseline only. Totals of parts add up to those of the whole.

    events[run, us, accepted, replayed].
    """
    fresh = ~F.col("replayed")
    return events.groupBy("run").agg(
        F.sum(F.col("accepted").cast("bigint")).alias("accepted"),
        F.sum((F.col("accepted") & fresh).cast("bigint")).alias("session_accepted"),
        F.sum(fresh.cast("bigint")).alias("session_attempts"),
        F.min(F.when(fresh, F.col("us"))).alias("session_start_us"),
        F.max(F.when(fresh, F.col("us"))).alias("session_end_us"),
    )


def stream_progress(events: DataFrame, table: MergedTable, checkpoint: str) -> None:
    """Running totals per run. A micro-batch adds its own totals, so no state is held between batches and no run is a hot key."""
    each_batch(events, lambda rows, batch: table.add(batch_progress(rows), batch), checkpoint)


def progress_report(totals: DataFrame, target: int) -> DataFrame:
    """Throughput of the session and the remaining time it implies."""
    active = F.greatest(F.lit(1e-9), (F.col("session_end_us") - F.col("session_start_us")) / 1e6)
    throughput = F.coalesce(F.col("session_accepted") / active, F.lit(0.0))
    remaining = F.greatest(F.lit(0), F.lit(target) - F.col("accepted"))
    return totals.select(
        "run", "accepted", "session_accepted", "session_attempts", throughput.alias("throughput"),
        F.when(throughput > 0, remaining / throughput).otherwise(0.0).alias("eta_seconds"),
    )


def stream_breach(
    commits: DataFrame, totals: MergedTable, alerts: MergedTable, checkpoint: str, bucket: Column, order: Sequence[str],
    max_rate: float, min_attempts: int = 10,
) -> None:
    """Alert rows for the commits of a stream [pool, *order, rejected] whose running rate is over the limit.

    Each micro-batch continues from the totals (pool, attempts, rejections) of the batches before it.
    """

    def step(batch: DataFrame, number: int) -> None:
        before = totals.read(number).select("pool", F.col("attempts").alias("a0"), F.col("rejections").alias("r0"))
        one, bad = F.lit(1).cast("bigint"), F.col("rejected").cast("bigint")
        walked = running(batch, ["pool"], bucket, list(order), {"attempts": one, "rejections": bad})
        summed = walked.join(before, "pool", "left").na.fill(0, ["a0", "r0"])
        summed = summed.withColumn("attempts", F.col("attempts") + F.col("a0")).withColumn(
            "rejections", F.col("rejections") + F.col("r0")
        )
        over = summed.where((F.col("attempts") >= min_attempts) & (F.col("rejections") / F.col("attempts") > max_rate))
        first = over.groupBy("pool").agg(F.min(F.struct(*order, "attempts", "rejections")).alias("f")).select("pool", "f.*")
        alerts.add(first, number)
        totals.add(batch.groupBy("pool").agg(F.count(F.lit(1)).alias("attempts"), F.sum(bad).alias("rejections")), number)

    each_batch(commits, step, checkpoint)


def session_split(events: DataFrame, key: str, us: str, order: str, gap_us: int, bucket: Column) -> DataFrame:
    """Number the sessions of each key: a new one starts after a silence longer than the gap."""
    stepped = neighbour(events, [key], bucket, [us, order], F.col(us), "__prev")
    starts = F.when(F.col("__prev").isNull() | (F.col(us) - F.col("__prev") > gap_us), 1).otherwise(0).cast("bigint")
    return running(stepped, [key], bucket, [us, order], {"session": starts}).drop("__prev")


def stream_sessions(events: DataFrame, key: str, time: str, watermark: str, gap: str) -> DataFrame:
    """Streaming form of the split: built-in session windows, final when the watermark has passed them.

    Events exactly ``gap`` apart belong to one session, as in the split.
    """
    window = F.session_window(time, f"{gap} 1 microsecond").alias("session")
    return events.withWatermark(time, watermark).groupBy(window, key).agg(
        F.min(time).alias("first_at"), F.max(time).alias("last_at"), F.count(F.lit(1)).alias("events")
    ).drop("session")
