"""Differences between two runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number_delta(left: Column, right: Column) -> list[Column]:
    """left, right, right - left and right / left; the ratio is NULL when left is 0 or missing."""
    left, right = left.cast("double"), right.cast("double")
    return [
        left.alias("left"), right.alias("right"), (right - left).alias("delta"),
        F.when(left != 0, right / left).alias("ratio"),
    ]


def outer(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    a = left.select(*keys, F.col(value).alias("l"))
    b = right.select(*keys, F.col(value).alias("r"))
    return a.join(b, list(keys), "full_outer")


def count_changes(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Change per key over the union of keys; an absent count is 0."""
    joined = outer(left, right, keys, value)
    zero = F.lit(0)
    return joined.select(*keys, *number_delta(F.coalesce("l", zero), F.coalesce("r", zero)))


def timing_regressions(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str = "p95_ns") -> DataFrame:
    """Change of a percentile per stage; a stage that one run lacks stays NULL."""
    return outer(left, right, keys, value).select(*keys, *number_delta(F.col("l"), F.col("r")))


def identity_changes(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Identity fields that differ between two manifests of the same key."""

    def long(frame: DataFrame, out: str) -> DataFrame:
        items = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(out)) for f in fields])
        return frame.select(key, F.explode(items).alias("i")).select(key, "i.*")

    joined = long(left, "left").join(long(right, "right"), [key, "field"])
    return joined.where(~F.col("left").eqNullSafe(F.col("right")))


def key_diff(pairs: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """Top-level keys of two JSON documents whose values differ or that only one side has."""

    def entries(column: str, out: str) -> DataFrame:
        parsed = pairs.select(F.col(key), F.parse_json(column).alias("v"))
        exploded = parsed.lateralJoin(pairs.sparkSession.tvf.variant_explode(F.col("v").outer()))
        return exploded.select(key, F.col("key").alias("field"), F.to_json("value").alias(out))

    joined = entries(left, "left").join(entries(right, "right"), [key, "field"], "full_outer")
    return joined.where(~F.col("left").eqNullSafe(F.col("right")))
