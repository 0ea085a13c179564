"""Coverage arrays: visibility, integrity and statistics of masks and small images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions import arrays as A
from slotwise.operators.scale import exact_quantiles, join_null_safe

FLAT_RANGE = 1e-8
MIN_STD = 1e-5


def visible_coverage(masks: DataFrame, sample: str, order: str, full: str) -> DataFrame:
    """Adds ``visible``: each mask times the transparency of every later mask of its sample.

    The objects of one sample are few by contract, so their arrays meet in one row.
    """
    kept = [c for c in masks.columns if c not in (sample, order, full)]
    listed = masks.groupBy(sample).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(full).alias("f"), *kept))).alias("items")
    )

    def visible(item: Column) -> Column:
        later = F.filter("items", lambda x: x["o"] > item["o"])
        own = F.transform(item["f"], lambda v: v / 255.0)
        seen = F.aggregate(later, own, lambda acc, x: F.zip_with(acc, x["f"], lambda p, q: p * (1.0 - q / 255.0)))
        return F.transform(
            seen, lambda v: F.rint(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)) * 255.0).cast("int")
        )

    rows = listed.select(sample, "items", F.explode("items").alias("i"))
    return rows.select(
        sample, F.col("i.o").alias(order), F.col("i.f").alias(full), *[F.col(f"i.{c}").alias(c) for c in kept],
        visible(F.col("i")).alias("visible"),
    )


def mask_semantics_check(
    masks: DataFrame, ident: Sequence[str], width: int, threshold: int, stored_box: str = "stored_box"
) -> DataFrame:
    """Findings on instance masks: more visible than full, empty, or a box that differs from the stored one."""
    box = A.coverage_bbox(F.col("visible"), F.lit(width), threshold)
    exceeds = F.exists(F.arrays_zip(F.col("visible").alias("v"), F.col("full").alias("f")), lambda p: p["v"] > p["f"])
    checked = masks.withColumn("__box", box)
    codes = F.array_compact(
        F.array(
            F.when(exceeds, F.lit("MASK_SEMANTICS_INVALID")),
            F.when(F.col("__box").isNull(), F.lit("MASK_EMPTY")),
            F.when(F.col("__box").isNotNull() & ~F.col("__box").eqNullSafe(F.col(stored_box)), F.lit("MASK_BBOX_MISMATCH")),
        )
    )
    return checked.select(*ident, F.explode(codes).alias("code"))


def mask_dedupe(masks: DataFrame, full: str = "full", visible: str = "visible") -> DataFrame:
    """Digest of both arrays; an identical visible array is stored as a reference to the full one."""
    same = A.array_digest(F.col(full)) == A.array_digest(F.col(visible))
    return masks.withColumn("full_sha256", A.array_digest(F.col(full))).withColumn(
        "visible_same_as", F.when(same, F.lit("full"))
    ).withColumn("visible_sha256", F.when(~same, A.array_digest(F.col(visible))))


def blob_integrity(blobs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Archive findings: hash, size, missing, duplicate or unlisted entries, crop outside the image.

    blobs[key, content]; manifest[key, sha256, byte_count, x, y, w, h, width, height].
    """
    actual = blobs.select(
        "key", F.sha2("content", 256).alias("actual_sha256"), F.octet_length("content").alias("actual_bytes")
    )
    joined = manifest.join(actual, "key", "left")
    repeated = manifest.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    outside = (
        (F.col("x") < 0) | (F.col("y") < 0)
        | (F.col("x") + F.col("w") > F.col("width")) | (F.col("y") + F.col("h") > F.col("height"))
    )
    present = F.col("actual_sha256").isNotNull()
    codes = F.array_compact(
        F.array(
            F.when(~present, F.lit("BLOB_MISSING")),
            F.when(present & (F.col("actual_sha256") != F.col("sha256")), F.lit("BLOB_HASH_MISMATCH")),
            F.when(present & (F.col("actual_bytes") != F.col("byte_count")), F.lit("BLOB_SIZE_MISMATCH")),
            F.when(outside, F.lit("CROP_OUTSIDE_IMAGE")),
        )
    )
    return (
        joined.select("key", F.explode(codes).alias("code"))
        .unionByName(repeated.select("key", F.lit("DUPLICATE_KEY").alias("code")))
        .unionByName(actual.join(manifest.select("key"), "key", "left_anti").select("key", F.lit("BLOB_NOT_LISTED").alias("code")))
    )


def robust_normalize(
    values: DataFrame,
    group: str,
    value: str,
    lo_pct: float,
    hi_pct: float,
    flat_value: float = 0.5,
    invert: bool = False,
    gamma: float = 1.0,
    curve: str = "linear",
    threshold: float | None = None,
) -> DataFrame:
    """Scale each group between two exact percentiles to [0, 1], then shape the result."""
    if curve not in ("linear", "smoothstep"):
        raise ValueError(f"unsupported curve {curve}")
    bounds = exact_quantiles(
        values, [group], value, {"__low": (lo_pct / 100.0, "linear"), "__high": (hi_pct / 100.0, "linear")}
    )
    joined = join_null_safe(values, bounds, [group])
    spread = F.col("__high") - F.col("__low")
    x = F.when(spread < FLAT_RANGE, F.lit(flat_value)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col(value) - F.col("__low")) / F.greatest(spread, F.lit(FLAT_RANGE))))
    )
    if invert:
        x = 1.0 - x
    if gamma != 1.0:
        x = F.pow(x, F.lit(gamma))
    out = joined.withColumn("normalized", x)
    n = F.col("normalized")
    if curve == "smoothstep":
        out = out.withColumn("normalized", n * n * (3.0 - 2.0 * n))
    if threshold is not None:
        out = out.withColumn("normalized", (n >= threshold).cast("double"))
    return out.drop("__low", "__high")


def moment_transfer(
    source: DataFrame, palette: DataFrame, group: str, palette_group: str, value: str, strength: float
) -> DataFrame:
    """Give each source group the mean and spread of its palette group, blended by strength."""

    def moments(frame: DataFrame, key: str, prefix: str) -> DataFrame:
        return frame.groupBy(F.col(key).alias(palette_group if prefix == "p" else group)).agg(
            F.avg(value).alias(f"__{prefix}_mean"),
            F.greatest(F.stddev_pop(value), F.lit(MIN_STD)).alias(f"__{prefix}_std"),
        )

    joined = source.join(moments(source, group, "s"), group).join(moments(palette, group, "p"), palette_group)
    moved = (F.col(value) - F.col("__s_mean")) * (F.col("__p_std") / F.col("__s_std")) + F.col("__p_mean")
    mixed = F.col(value) * (1.0 - strength) + moved * strength
    return joined.withColumn("transferred", mixed).drop("__s_mean", "__s_std", "__p_mean", "__p_std")
