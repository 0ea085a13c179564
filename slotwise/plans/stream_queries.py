"""Streams over the events table, run to the end of the available data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query
from slotwise.session import scratch_path
from slotwise.streaming import monitor as M
from slotwise.streaming import tables as S


def event_stream(t: Tables) -> DataFrame:
    """The events file as a stream."""
    return t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)


def merged(t: Tables, name: str, schema: str, merge) -> S.MergedTable:
    return S.MergedTable(t.spark, scratch_path(t.spark, name), schema, merge)


def metric_stream(t: Tables) -> DataFrame:
    return event_stream(t).select(
        F.col("user_id").cast("string").alias("session_id"), F.col("event_id").alias("sequence"),
        F.col("ts").cast("timestamp").alias("ingested_at"), F.col("event_type").alias("run_state"),
        F.col("value").alias("cpu_percent"), (F.get_json_object("props", "$.k").cast("bigint") * 1048576).alias("rss_bytes"),
    )


@query(
    "stream_resource_rollup",
    with_sql(
        """select epoch_us(ingested_at) // 3600000000 as hour, session_id, run_state, max(cpu_percent) as peak_cpu_percent, max(rss_bytes) as peak_rss_bytes,
             max_by(cpu_percent, sequence) as latest_cpu_percent, count(*) as samples from v_metrics group by 1, 2, 3""",
        B.SQL_METRICS,
    ),
)
def _(t: Tables) -> DataFrame:
    rollup = M.stream_resource_rollup(metric_stream(t), "1 hour", "1 hour")
    flat = rollup.select(
        (F.unix_seconds("window.start") / 3600).cast("bigint").alias("hour"), "session_id", "run_state", "peak_cpu_percent",
        "peak_rss_bytes", "latest_cpu_percent", "samples",
    )
    schema = "hour bigint, session_id string, run_state string, peak_cpu_percent double, peak_rss_bytes bigint, latest_cpu_percent double, samples bigint"
    table = merged(t, "rollup", schema, S.newest(["hour", "session_id", "run_state"]))
    S.update_to_table(flat, table, scratch_path(t.spark, "rollup-state"))
    return table.read().drop(S.BATCH)


@query(
    "stream_dedupe_gaps",
    with_sql(
        "select session_id, count(*) as samples, max(sequence) - min(sequence) + 1 - count(*) as missing from v_metrics group by session_id",
        B.SQL_METRICS,
    ),
)
def _(t: Tables) -> DataFrame:
    """Every third reading is delivered twice."""
    twice = F.explode(F.when(F.col("sequence") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    delivered = metric_stream(t).withColumn("delivery", twice).drop("delivery")
    gaps = merged(t, "gaps", "session_id string, low bigint, high bigint", lambda rows: rows)
    totals = merged(t, "gap-totals", "session_id string, samples bigint, missing bigint", S.newest(["session_id"]))
    M.stream_gaps(delivered, gaps, totals, scratch_path(t.spark, "gaps-state"), "1 hour")
    return totals.read().drop(S.BATCH)


@query(
    "stream_pause_state",
    with_sql(
        """select run, cast(coalesce(sum(case when state = 'paused' then nxt - us end), 0) as bigint) as paused_us,
             max(case when nxt is null and state = 'paused' then us end) as open_since_us
           from (select *, lead(us) over (partition by run order by seq) as nxt from v_control) group by run""",
        B.SQL_CONTROL,
    ),
)
def _(t: Tables) -> DataFrame:
    state = F.when(F.col("event_type") == "error", "paused").otherwise("running")
    events = event_stream(t).where(F.col("event_type").isin("error", "signup", "purchase")).select(
        F.col("user_id").alias("run"), F.col("event_id").alias("seq"), B.epoch_micros("ts").alias("us"), state.alias("state")
    )
    table = merged(t, "pauses", M.PAUSE_SCHEMA, S.newest(["run", "first_seq"]))
    M.stream_pause_state(events, table, scratch_path(t.spark, "pauses-state"), "1 hour")
    return M.paused_totals(table.read())


@query(
    "stream_progress",
    """select run, accepted, session_accepted, session_attempts, round(session_accepted / active, 9) as throughput,
         round(case when session_accepted > 0 then greatest(0, 60 - accepted) / (session_accepted / active) else 0 end, 3) as eta_seconds
       from (select user_id as run, count(*) filter (event_type in ('view', 'click')) as accepted,
           count(*) filter (event_type in ('view', 'click') and ts >= timestamp '2024-01-10') as session_accepted, count(*) filter (ts >= timestamp '2024-01-10') as session_attempts,
           greatest(1e-9::double, (max(epoch_us(ts)) filter (ts >= timestamp '2024-01-10') - min(epoch_us(ts)) filter (ts >= timestamp '2024-01-10')) / 1e6::double) as active from events group by 1)""",
)
def _(t: Tables) -> DataFrame:
    events = event_stream(t).select(
        F.col("user_id").alias("run"), B.epoch_micros("ts").alias("us"), F.col("event_type").isin("view", "click").alias("accepted"),
        (F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")).alias("replayed"),
    )
    table = merged(t, "progress", M.PROGRESS_SCHEMA, S.combined(["run"], M.PROGRESS_RULES))
    M.stream_progress(events, table, scratch_path(t.spark, "progress-state"))
    totals = table.read()
    out = M.progress_report(totals, 60)
    return out.withColumn("throughput", F.round("throughput", 9)).withColumn("eta_seconds", F.round("eta_seconds", 3))


@query(
    "stream_breach",
    """select pool, min(event_id) as event_id from (select *, sum(bad) over w as r, count(*) over w as a from (
         select cast(user_id % 4 as integer) as pool, event_id, case when event_type = 'error' then 1 else 0 end as bad from events) window w as (partition by pool order by event_id rows unbounded preceding))
       where a >= 10 and r / a > 0.25 group by pool""",
)
def _(t: Tables) -> DataFrame:
    """The commits arrive in three deliveries; the stream goes on where it stopped after each."""
    commits = t.events.select(
        (F.col("user_id") % 4).cast("int").alias("pool"), "event_id", (F.col("event_type") == "error").alias("rejected"), "ts"
    )
    source, state = scratch_path(t.spark, "commits"), scratch_path(t.spark, "breach-state")
    totals = merged(t, "totals", "pool int, attempts bigint, rejections bigint", S.combined(["pool"], {"attempts": F.sum, "rejections": F.sum}))
    alerts = merged(t, "alerts", "pool int, event_id bigint", S.combined(["pool"], {"event_id": F.min}))
    days = [("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-12"), ("2024-01-12", "2100-01-01")]
    for start, end in days:
        part = commits.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))
        part.drop("ts").write.mode("append").parquet(source)
        stream = t.spark.readStream.schema("pool int, event_id bigint, rejected boolean").parquet(source)
        M.stream_breach(stream, totals, alerts, state, F.floor(F.col("event_id") / 1000), ["event_id"], 0.25)
    return alerts.read().select("pool", "event_id")


@query(
    "session_split",
    """select user_id, event_id, cast(sum(new) over (partition by user_id order by us, event_id) as bigint) as session
       from (select *, case when us - lag(us) over (partition by user_id order by us, event_id) <= 14400000000 then 0 else 1 end as new from (select user_id, event_id, epoch_us(ts) as us from events))""",
)
def _(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", B.epoch_micros("ts").alias("us"))
    out = M.session_split(rows, "user_id", "us", "event_id", 4 * 3600 * 1000000, F.floor(F.col("us") / (24 * 3600 * 1000000)))
    return out.select("user_id", "event_id", "session")


@query(
    "stream_sessions",
    """select user_id, min(us) as first_us, max(us) as last_us, count(*) as events from (
         select *, sum(new) over (partition by user_id order by us, event_id) as session
         from (select *, case when us - lag(us) over (partition by user_id order by us, event_id) <= 14400000000 then 0 else 1 end as new from (select user_id, event_id, epoch_us(ts) as us from events)))
       group by user_id, session""",
)
def _(t: Tables) -> DataFrame:
    """The events arrive, then an end marker from far ahead, which lets the watermark pass the last sessions."""
    source, state, path = (scratch_path(t.spark, name) for name in ("visits", "visits-state", "visits-out"))
    rows = t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    marker = t.spark.createDataFrame([(None, "2200-01-01 00:00:00")], "user_id bigint, ts string").select("user_id", F.to_timestamp("ts").alias("ts"))
    for delivery in (rows, marker):
        delivery.write.mode("append").parquet(source)
        stream = t.spark.readStream.schema(rows.schema).parquet(source)
        S.append_to_table(M.stream_sessions(stream, "user_id", "ts", "1 hour", "4 hours"), path, state)
    done = t.spark.read.parquet(path).where("user_id is not null")
    return done.select("user_id", B.epoch_micros("first_at").alias("first_us"), B.epoch_micros("last_at").alias("last_us"), "events")
