"""Runtime, disk and risk estimates for many planned runs at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.operators.scale import exact_quantiles, join_null_safe

# Planning priors in seconds per candidate at the reference image size, the
# uncertainty bands per confidence, and the disk budget factors.
REFERENCE_MEGAPIXELS = 1.6384
PRIORS = {
    "builtin:appearance/no-appearance": ("medium", {"landing": 0.787, "manometro": 0.231}),
    "builtin:appearance/current-fast": ("medium", {"landing": 1.006, "manometro": 0.340}),
    "builtin:appearance/realistic-heavy": ("medium", {"landing": 2.064, "manometro": 0.844}),
    "builtin:appearance/random-fog-heavy": ("medium", {"landing": 2.861, "manometro": 2.415}),
    "builtin:appearance/legacy-heavy-compatible": ("low", {"landing": 3.704, "manometro": 1.627}),
    "builtin:appearance/all-effects-stress": ("low", {"landing": 6.0, "manometro": 4.0}),
}
BANDS = {
    "high": (0.85, 1.25),
    "medium": (0.70, 1.55),
    "local-observation": (0.75, 1.45),
    "local-production": (0.85, 1.20),
    "local-production-low-sample": (0.60, 1.75),
    "local-production-cross-worker": (0.50, 2.00),
    "local-probe": (0.75, 1.50),
    "low": (0.50, 2.50),
}
PARALLEL_EFFICIENCY = 0.82
PNG_FACTOR, OTHER_FACTOR = 1.1, 0.6
MASK_BYTES_PER_PIXEL = 0.25
METADATA_BYTES, RESERVE_BYTES = 64 * 1024, 64 * 1024 * 1024
LOW_SAMPLE_ROWS = 3
OUT_OF_RANGE_RATIO = 4


def cost_fingerprint(jobs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Hash of the settings that decide the cost; count and seed are simply not listed."""
    return jobs.withColumn("fingerprint", F.sha2(F.to_json(F.struct(*sorted(columns))), 256))


def match_observations(jobs: DataFrame, observations: DataFrame) -> DataFrame:
    """Statistics of the observations that fit each job.

    jobs[job, fingerprint, environment, workers, ...], observations[fingerprint,
    environment, workers, kind, seconds]. Only rows of the job's environment count. Rows with
    the job's worker count are used if there are any, otherwise all rows of the fingerprint.
    Observations are summarised per fingerprint, environment and worker count, and without
    the latter, before they meet the jobs: one row per job.
    """
    keys = ["fingerprint", "environment"]
    scoped = observations.select(
        *keys, "kind", "seconds", F.explode(F.array(F.col("workers"), F.lit(None).cast("int"))).alias("scope")
    )
    counts = scoped.groupBy(*keys, "scope").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum((F.col("kind") == "production").cast("bigint")).alias("production"),
        F.sum((F.col("kind") == "probe").cast("bigint")).alias("probes"),
        F.avg(F.when(F.col("kind") == "probe", F.col("seconds"))).alias("probe_mean"),
        F.min(F.when(F.col("kind") == "production", F.col("seconds"))).alias("production_min"),
        F.max(F.when(F.col("kind") == "production", F.col("seconds"))).alias("production_max"),
    )
    medians = exact_quantiles(
        scoped.where("kind = 'production'"), [*keys, "scope"], "seconds", {"production_median": (0.5, "linear")}
    )
    stats = join_null_safe(counts, medians, [*keys, "scope"], "left")
    values = [c for c in stats.columns if c not in (*keys, "scope")]
    exact = stats.where("scope is not null").select(
        *keys, F.col("scope").alias("workers"), F.struct(*values).alias("__exact")
    )
    cross = stats.where("scope is null").select(*keys, F.struct(*values).alias("__cross"))
    joined = jobs.join(exact, [*keys, "workers"], "left").join(cross, keys, "left")
    tier = F.when(F.col("__exact").isNotNull(), "exact").when(F.col("__cross").isNotNull(), "cross-worker").otherwise("none")
    chosen = F.coalesce("__exact", "__cross")
    return joined.withColumn("tier", tier).withColumn("__s", chosen).select(
        *jobs.columns, "tier", *[F.col(f"__s.{v}").alias(v) for v in values]
    ).na.fill(0, ["rows", "production", "probes"])


def prior(profile: Column, family: Column) -> tuple[Column, Column]:
    """Planning prior (confidence, seconds) of a known profile."""
    confidence, seconds = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, (level, values) in PRIORS.items():
        confidence = F.when(profile == name, level).otherwise(confidence)
        for fam, value in values.items():
            seconds = F.when((profile == name) & (family == fam), value).otherwise(seconds)
    return confidence, seconds


def runtime_estimate(matched: DataFrame, digits: tuple[int, int] = (3, 6)) -> DataFrame:
    """Expected run time with bounds: production median, probe mean, prior, then image size.

    matched = match_observations(jobs) with jobs[profile, family, width, height,
    num_images, workers].
    """
    megapixels = F.col("width") * F.col("height") / 1e6
    level, seconds = prior(F.col("profile"), F.col("family"))
    scaled = seconds * F.greatest(F.lit(0.1), megapixels / REFERENCE_MEGAPIXELS)
    per = (
        F.when(F.col("production") > 0, F.col("production_median"))
        .when(F.col("probes") > 0, F.col("probe_mean"))
        .when(level.isNotNull(), scaled)
        .otherwise(F.greatest(F.lit(0.25), megapixels))
    )
    confidence = (
        F.when((F.col("production") > 0) & (F.col("tier") == "cross-worker"), "local-production-cross-worker")
        .when(F.col("production") >= LOW_SAMPLE_ROWS, "local-production")
        .when(F.col("production") > 0, "local-production-low-sample")
        .when(F.col("probes") > 0, "local-probe")
        .otherwise(F.coalesce(level, F.lit("low")))
    )
    effective = F.greatest(F.lit(1.0), F.col("workers") * F.when(F.col("workers") > 1, PARALLEL_EFFICIENCY).otherwise(1.0))
    rows = matched.withColumn("seconds_per_candidate", per).withColumn("confidence", confidence)
    rows = rows.withColumn("__expected", F.col("seconds_per_candidate") * F.col("num_images") / effective)
    low, high = F.lit(BANDS["low"][0]), F.lit(BANDS["low"][1])
    for name, (a, b) in BANDS.items():
        low = F.when(F.col("confidence") == name, a).otherwise(low)
        high = F.when(F.col("confidence") == name, b).otherwise(high)
    count = F.when(F.col("production") > 0, F.col("production")).otherwise(F.col("probes"))
    return rows.select(
        "job",
        F.round(F.col("__expected") * low, digits[0]).alias("lower_seconds"),
        F.round("__expected", digits[0]).alias("expected_seconds"),
        F.round(F.col("__expected") * high, digits[0]).alias("upper_seconds"),
        "confidence",
        F.round("seconds_per_candidate", digits[1]).alias("seconds_per_candidate"),
        count.alias("observation_count"),
    )


def observation_warnings(matched: DataFrame) -> DataFrame:
    """Other worker counts, too few or widely scattered production rows."""
    ratio = F.col("production_max") / F.greatest(F.col("production_min"), F.lit(1e-9))
    codes = F.array_compact(
        F.array(
            F.when(F.col("tier") == "cross-worker", F.lit("LOCAL_OBSERVATION_CROSS_WORKER")),
            F.when((F.col("production") > 0) & (F.col("production") < LOW_SAMPLE_ROWS), F.lit("LOCAL_OBSERVATION_LOW_SAMPLE")),
            F.when((F.col("production") >= 2) & (ratio > OUT_OF_RANGE_RATIO), F.lit("LOCAL_OBSERVATION_OUT_OF_RANGE")),
        )
    )
    return matched.select("job", F.explode(codes).alias("code"))


def disk_estimate(jobs: DataFrame) -> DataFrame:
    """Bytes of images, masks and metadata, and whether they fit the free space."""
    pixels = (F.col("width") * F.col("height")).cast("bigint")
    factor = F.when(F.col("image_format") == "png", PNG_FACTOR).otherwise(OTHER_FACTOR)
    rows = jobs.select(
        "job", "free_bytes",
        (pixels * 3 * F.col("num_images") * factor).cast("bigint").alias("image_bytes"),
        (pixels * F.col("max_instances") * F.lit(MASK_BYTES_PER_PIXEL) * F.col("num_images")).cast("bigint").alias("mask_bytes"),
        (F.col("num_images") * METADATA_BYTES).alias("metadata_bytes"),
    )
    total = F.col("image_bytes") + F.col("mask_bytes") + F.col("metadata_bytes")
    return rows.select(
        "job", "image_bytes", "mask_bytes", "metadata_bytes", total.alias("output_bytes"),
        (F.col("free_bytes") >= total + RESERVE_BYTES).alias("sufficient"),
    )


def binding_hash(*columns: str) -> Column:
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def receipt_check(jobs: DataFrame, receipts: DataFrame) -> DataFrame:
    """Jobs that need a confirmed receipt and lack a matching one.

    jobs[job, risk, warning_codes, binding_hash], receipts[job, binding_hash,
    acknowledged_codes].
    """
    need = jobs.where((F.col("risk") == "confirmation") & (F.size("warning_codes") > 0))
    given = receipts.select("job", F.col("binding_hash").alias("receipt_hash"), "acknowledged_codes")
    joined = need.join(given, "job", "left")
    code = F.when(F.col("receipt_hash").isNull(), "RECEIPT_MISSING").when(
        (F.col("receipt_hash") != F.col("binding_hash")) | (F.col("acknowledged_codes") != F.col("warning_codes")),
        "RECEIPT_MISMATCH",
    )
    return joined.withColumn("code", code).where("code is not null").select("job", "code")


def derive_observation(summaries: DataFrame) -> DataFrame:
    """Production observations of finished runs; runs without time or attempts are skipped."""
    usable = summaries.where(
        F.col("status").isin("complete", "interrupted") & (F.col("active_seconds") > 0) & (F.col("attempts") > 0)
    )
    return usable.select(
        "run", F.lit("production").alias("kind"), "workers", "active_seconds", "attempts", "accepted",
        (F.col("accepted") / F.col("active_seconds")).alias("throughput"),
        (F.col("active_seconds") * F.col("workers") / F.col("attempts")).alias("seconds_per_candidate"),
    )
