"""Reports on finished and running pools: timings, rates, mixes and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions import geometry as G
from slotwise.operators.scale import exact_quantiles, neighbour, running

# Name of the reason counted as background rejection, counters of a resource record.
BACKGROUND_REASON = "BackgroundSynthesisError"
NODE_STAGE_PREFIX = "background.node."
SAMPLE_FAILED_CODE = "RESOURCE_SAMPLE_FAILED"
RESOURCE_COUNTERS = ("process_count", "cpu_percent", "rss_bytes", "read_bytes", "write_bytes")
RATE_DIMENSIONS = ("asset", "class", "scale_band", "rotation_band", "object_count", "region")


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def stage_explode(samples: DataFrame, rejections: DataFrame) -> DataFrame:
    """One row per recorded stage time of samples, their background nodes and rejections."""
    stages = samples.select(F.explode("stage_timings_ns").alias("stage", "ns"), "in_session")
    nodes = samples.select(F.explode("node_timings_ns").alias("node", "ns"), "in_session").select(
        F.concat(F.lit(NODE_STAGE_PREFIX), "node").alias("stage"), "ns", "in_session"
    )
    rejected = rejections.select(F.explode("stage_timings_ns").alias("stage", "ns"), "in_session")
    return stages.unionByName(nodes).unionByName(rejected)


def stage_summary(timings: DataFrame, by: tuple[str, ...] = ("stage",), value: str = "ns") -> DataFrame:
    """Count, total, truncated mean and median, nearest-rank percentiles per stage."""
    exact = exact_quantiles(
        timings, by, value,
        {"median_ns": (0.5, "whole"), "p90_ns": (0.90, "nearest"), "p95_ns": (0.95, "nearest"), "p99_ns": (0.99, "nearest")},
        keep_stats=True,
    )
    return exact.select(
        *by,
        "count",
        F.col("total").alias("total_ns"),
        F.expr("total div count").alias("mean_ns"),
        "median_ns", "p90_ns", "p95_ns", "p99_ns",
    )


def rejection_costs(rejections: DataFrame) -> DataFrame:
    """Rejections per reason and all stage time they used up."""
    spent = F.aggregate(F.map_values("stage_timings_ns"), F.lit(0).cast("bigint"), lambda s, v: s + v)
    return rejections.groupBy(F.coalesce("reason", F.lit("unknown")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(spent).alias("cost_ns")
    )


def mix_configured_observed(
    records: DataFrame, key: str, weights: DataFrame, empty_configured: float | None, denominator: Column | None = None
) -> DataFrame:
    """Configured and observed share per key over the union of both key sets.

    ``denominator`` defaults to the number of records. ``empty_configured`` is reported
    when no weight is configured at all.
    """
    observed = records.groupBy(F.coalesce(F.col(key), F.lit("unknown")).alias(key)).agg(F.count(F.lit(1)).alias("n"))
    total = denominator if denominator is not None else observed.agg(F.sum("n")).scalar()
    configured = weights.agg(F.sum("weight")).scalar()
    joined = observed.join(weights.select(key, "weight"), key, "full_outer")
    n = F.coalesce(F.col("n"), F.lit(0))
    return joined.select(
        key,
        F.when(configured > 0, F.coalesce("weight", F.lit(0.0)) / configured)
        .otherwise(F.lit(empty_configured).cast("double")).alias("configured_fraction"),
        share(n, total).alias("observed_fraction"),
        n.cast("bigint").alias("observed_count"),
    )


def class_group_counts(samples: DataFrame) -> DataFrame:
    """Annotations per class and per group, and samples without annotations."""
    items = samples.select(F.explode_outer("annotations").alias("a"))
    rows = items.select(
        F.explode(
            F.when(
                F.col("a").isNull(),
                F.array(F.struct(F.lit("negative").alias("kind"), F.lit("").alias("value"))),
            ).otherwise(
                F.array(
                    F.struct(F.lit("class").alias("kind"), F.col("a.class_name").alias("value")),
                    F.struct(F.lit("group").alias("kind"), F.coalesce("a.source_group", F.lit("unknown")).alias("value")),
                )
            )
        ).alias("r")
    )
    return rows.groupBy("r.kind", "r.value").agg(F.count(F.lit(1)).alias("n"))


def qa_metric_summary(samples: DataFrame) -> DataFrame:
    """Mean, minimum and maximum of each numeric metric and how often each warning was raised."""
    metrics = samples.select(F.explode("qa").alias("name", "value")).groupBy("name").agg(
        F.avg("value").alias("mean"), F.min("value").alias("minimum"), F.max("value").alias("maximum"),
        F.count("value").alias("n"),
    )
    warnings = samples.select(F.explode("warnings").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return metrics.select(F.lit("metric").alias("kind"), "*").unionByName(
        warnings.select(F.lit("warning").alias("kind"), "*"), allowMissingColumns=True
    )


def run_summary(samples: DataFrame, rejections: DataFrame, baseline: DataFrame) -> DataFrame:
    """Totals, rates and session deltas per pool.

    samples[pool, attempted_instances, rejected_instances, negative, mask_bytes],
    rejections[pool, reason], baseline[pool, baseline_accepted, baseline_attempts].
    """
    accepted = samples.groupBy("pool").agg(
        F.count(F.lit(1)).alias("accepted"),
        F.sum("attempted_instances").alias("object_attempts"),
        F.sum("rejected_instances").alias("object_rejections"),
        F.sum(F.col("negative").cast("bigint")).alias("negative_count"),
        F.sum("mask_bytes").alias("mask_bytes"),
    )
    rejected = rejections.groupBy("pool").agg(
        F.count(F.lit(1)).alias("rejected"),
        F.sum((F.col("reason") == BACKGROUND_REASON).cast("bigint")).alias("background_rejected"),
    )
    counts = [n for f in (accepted, rejected) for n in f.columns if n != "pool"]
    joined = accepted.join(rejected, "pool", "full_outer").join(baseline, "pool", "left").na.fill(
        0, [*counts, "baseline_accepted", "baseline_attempts"]
    )
    attempts = F.col("accepted") + F.col("rejected")
    return joined.select(
        "pool",
        "accepted",
        attempts.alias("candidate_attempts"),
        F.greatest(F.lit(0), F.col("accepted") - F.col("baseline_accepted")).alias("session_accepted"),
        F.greatest(F.lit(0), attempts - F.col("baseline_attempts")).alias("session_attempts"),
        share(F.col("rejected"), attempts).alias("candidate_rejection_rate"),
        share(F.col("background_rejected"), attempts).alias("background_rejection_rate"),
        "object_attempts",
        "object_rejections",
        share(F.col("object_rejections"), F.col("object_attempts")).alias("object_rejection_rate"),
        "negative_count",
        "mask_bytes",
        share(F.col("mask_bytes"), F.col("accepted")).alias("mean_mask_bytes"),
    )


def conditional_rates(attempts: DataFrame) -> DataFrame:
    """Object rejection rate per asset, class, scale band, rotation band, object count and region.

    ``attempts`` holds accepted and rejected objects alike with a ``rejected`` flag; all
    six groupings come from one pass.
    """
    named = attempts.select(
        F.coalesce("source_asset", F.lit("unknown")).alias("asset"),
        F.coalesce("class_name", F.lit("unknown")).alias("class"),
        G.scale_step(F.coalesce("scale", F.lit(0.0))).alias("scale_band"),
        G.rotation_step(F.coalesce("rotation", F.lit(0.0))).alias("rotation_band"),
        F.coalesce("requested_objects", F.lit(0)).alias("object_count"),
        F.coalesce("region", F.lit("unknown")).alias("region"),
        F.col("rejected").cast("bigint").alias("rejected"),
    )
    grouped = named.groupingSets([[d] for d in RATE_DIMENSIONS], *RATE_DIMENSIONS).agg(
        F.sum("rejected").alias("rejections"),
        F.count(F.lit(1)).alias("attempts"),
        *[F.grouping(d).alias(f"g_{d}") for d in RATE_DIMENSIONS],
    )
    dimension = F.coalesce(*[F.when(F.col(f"g_{d}") == 0, F.lit(d)) for d in RATE_DIMENSIONS])
    # Bands are numbers while grouping; their text is written once per group.
    texts = {
        "scale_band": G.scale_band_text(F.col("scale_band")),
        "rotation_band": G.rotation_band_text(F.col("rotation_band")),
        "object_count": F.col("object_count").cast("string"),
    }
    value = F.coalesce(*[F.when(F.col(f"g_{d}") == 0, texts.get(d, F.col(d))) for d in RATE_DIMENSIONS])
    return grouped.select(
        dimension.alias("dimension"),
        value.alias("value"),
        "rejections",
        "attempts",
        F.try_divide("rejections", "attempts").alias("rate"),
    )


def event_rates(attempts: DataFrame) -> DataFrame:
    """Rejections per stage and per reason over all object attempts."""
    total = attempts.agg(F.count(F.lit(1))).scalar()
    rejected = attempts.where("rejected")
    grouped = rejected.groupingSets([["stage"], ["reason"]], "stage", "reason").agg(
        F.count(F.lit(1)).alias("rejections"), F.grouping("stage").alias("g")
    )
    return grouped.select(
        F.when(F.col("g") == 0, "stage").otherwise("reason").alias("dimension"),
        F.coalesce("stage", "reason").alias("value"),
        "rejections",
        total.alias("object_attempts"),
        share(F.col("rejections"), total).alias("rate"),
    )


def resource_rollup(metrics: DataFrame, by: tuple[str, ...], counters: tuple[str, ...]) -> DataFrame:
    """Peak and latest reading per counter, sample, drop and error counts, sessions.

    Warning records (``dropped_samples`` or ``code`` set) count drops and errors only.
    """
    is_sample = F.col("code").isNull()
    order = F.struct("ingested_at", "sequence")
    sessions = [] if "session_id" in by else [F.countDistinct("session_id").alias("sessions")]
    return metrics.groupBy(*by).agg(
        *sessions,
        *[F.max(F.when(is_sample, F.col(c))).alias(f"peak_{c}") for c in counters],
        *[F.max_by(F.when(is_sample, F.col(c)), F.when(is_sample, order)).alias(f"latest_{c}") for c in counters],
        F.sum(is_sample.cast("bigint")).alias("samples"),
        F.sum(F.coalesce("dropped_samples", F.lit(0))).cast("bigint").alias("dropped_samples"),
        F.sum((F.col("code").eqNullSafe(SAMPLE_FAILED_CODE)).cast("bigint")).alias("sample_errors"),
    )


def process_group_sum(groups: list[str], counters: tuple[str, ...] = RESOURCE_COUNTERS) -> Column:
    """Sum of the process groups' counters as one struct."""
    return F.struct(
        *[sum((F.coalesce(F.col(f"{g}.{c}"), F.lit(0)) for g in groups[1:]), F.coalesce(F.col(f"{groups[0]}.{c}"), F.lit(0))).alias(c)
          for c in counters]
    )


def paused_time(events: DataFrame, run_end: DataFrame, bucket: Column) -> DataFrame:
    """Microseconds each run spent paused; an open pause lasts until the run's end.

    events[run, seq, us, state] is the control log, run_end[run, end_us]. ``bucket``
    must follow ``seq``.
    """
    stepped = neighbour(events, ["run"], bucket, ["seq"], F.col("us"), "next_us", following=True)
    ends = stepped.where("state = 'paused'").join(run_end.select("run", "end_us"), "run")
    return ends.groupBy("run").agg(
        F.sum(F.greatest(F.lit(0), F.coalesce("next_us", "end_us") - F.col("us"))).alias("paused_us")
    )


def active_time_eta(events: DataFrame, progress: DataFrame, bucket: Column) -> DataFrame:
    """Wall, paused and active time, throughput and remaining time per run.

    progress[run, start_us, end_us, accepted, baseline_accepted, target].
    """
    paused = paused_time(events, progress, bucket)
    wall = (F.col("end_us") - F.col("start_us")) / 1e6
    active = F.greatest(F.lit(1e-9), wall - F.col("paused_us") / 1e6)
    throughput = F.greatest(F.lit(0), F.col("accepted") - F.col("baseline_accepted")) / active
    remaining = F.greatest(F.lit(0), F.col("target") - F.col("accepted"))
    return progress.join(paused, "run", "left").na.fill(0, ["paused_us"]).select(
        "run",
        wall.alias("wall_seconds"),
        (F.col("paused_us") / 1e6).alias("paused_seconds"),
        active.alias("active_seconds"),
        throughput.alias("throughput"),
        F.when(throughput > 0, remaining / throughput).otherwise(0.0).alias("eta_seconds"),
    )


def bottleneck(timings: DataFrame, stage: str = "stage", value: str = "ns") -> DataFrame:
    """The stage with the largest mean, its upper median and nearest-rank p95."""
    stats = exact_quantiles(
        timings, [stage], value, {"p50_ns": (0.5, "upper"), "p95_ns": (0.95, "nearest")}, keep_stats=True
    )
    return stats.orderBy(F.desc(F.col("total") / F.col("count")), stage).limit(1).select(stage, "p50_ns", "p95_ns")


def top_counts(records: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent values; equal counts go by name."""
    return records.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(k)


def fidelity_summary(samples: DataFrame) -> DataFrame:
    """Projected instances, worst overlap and area error, instances with warnings."""
    rows = samples.select(F.explode("segmentation").alias("s"))
    return rows.agg(
        F.count(F.lit(1)).alias("instances"),
        F.min("s.iou").alias("minimum_iou"),
        F.max("s.area_error").alias("maximum_area_error"),
        F.coalesce(F.sum((F.size("s.warnings") > 0).cast("bigint")), F.lit(0)).alias("warning_instances"),
    )


def budget_breach(
    commits: DataFrame,
    bucket: Column,
    order: list[str],
    max_rate: float,
    min_attempts: int = 10,
    max_seconds: float | None = None,
) -> DataFrame:
    """First commit per pool at which the running rejection rate or active time is over its limit.

    commits[pool, *order, rejected, micros]; ``bucket`` must follow ``order``.
    """
    totals = running(
        commits, ["pool"], bucket, order,
        {"attempts": F.lit(1).cast("bigint"), "rejections": F.col("rejected").cast("bigint"), "spent": F.col("micros")},
    )
    over_rate = (F.col("attempts") >= min_attempts) & (F.col("rejections") / F.col("attempts") > max_rate)
    code = F.when(over_rate, "rejection_rate")
    if max_seconds is not None:
        code = F.when(F.col("spent") / 1e6 > max_seconds, "wall_time").otherwise(code)
    first = F.min(F.struct(*order, "attempts", "rejections", F.col("code")))
    return (
        totals.withColumn("code", code).where("code is not null").groupBy("pool").agg(first.alias("f")).select("pool", "f.*")
    )


def benchmark_summary(records: DataFrame, warmup: int) -> DataFrame:
    """Truncated mean and linear p95 per stage without the warm-up rows."""
    stats = exact_quantiles(
        records.where(F.col("index") >= warmup), ["stage"], "ns", {"p95_ns": (0.95, "whole")}, keep_stats=True
    )
    return stats.select("stage", F.expr("total div count").alias("mean_ns"), "p95_ns")
