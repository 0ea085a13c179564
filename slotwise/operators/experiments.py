"""Paired experiments: treatment order, invariants, costs and deltas per fixture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.operators.scale import exact_quantiles
from slotwise.session import written

MIN_FIXTURES = 20
STAGES = ("background", "foreground", "final")


def balanced_order(fixtures: DataFrame, fixture: str, treatments: Sequence[str]) -> DataFrame:
    """Place of every treatment per fixture: rotated by fixture, reversed in every second block."""
    n = len(treatments)
    listed = F.posexplode(F.array(*[F.lit(t) for t in treatments])).alias("__p", "treatment")
    rows = fixtures.select(fixture, listed)
    place = F.pmod(F.col("__p") - F.col(fixture) % n, F.lit(n))
    odd = F.floor(F.col(fixture) / n) % 2 == 1
    return rows.select(fixture, "treatment", F.when(odd, n - 1 - place).otherwise(place).cast("int").alias("order_index"))


def signature(*columns: Column) -> Column:
    """Digest of rounded values, stable across machines."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def paired_invariants(rows: DataFrame, fixture: str, signatures: Sequence[str]) -> DataFrame:
    """Signatures that differ between the treatments of one fixture."""
    same = rows.groupBy(fixture).agg(
        *[(F.min(s) != F.max(s)).alias(s) for s in signatures]
    )
    broken = F.array_compact(F.array(*[F.when(F.col(s), F.lit(s)) for s in signatures]))
    return same.select(fixture, F.explode(broken).alias("signature"))


def modeled_cost(rows: DataFrame) -> DataFrame:
    """Adds the production cost of a measurement: synthesis, render, encoding and writing."""
    return rows.withColumn("modeled_ns", F.col("synthesis_ns") + F.col("render_ns") + F.col("encode_ns") + F.col("write_ns"))


def treatment_summary(rows: DataFrame, warmups: int) -> DataFrame:
    """Calls, totals, truncated means and linear p95 per treatment, warm-up fixtures left out."""
    columns = ["treatment", "render_ns", "modeled_ns", "object_count", "megapixels"]
    measured = written(modeled_cost(rows.where(F.col("fixture") >= warmups)).select(*columns), "measured")
    costs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("ns")) for c in ("render_ns", "modeled_ns")])
    stats = exact_quantiles(
        measured.select("treatment", F.inline(costs)), ["treatment", "metric"], "ns", {"p": (0.95, "whole")}, keep_stats=True
    )
    of = lambda metric, c: F.max(F.when(F.col("metric") == metric, F.col(c)))
    wide = stats.groupBy("treatment").agg(
        *[of(m, c).alias(f"{m}_{c}") for m in ("render_ns", "modeled_ns") for c in ("count", "total", "p")]
    )
    sizes = measured.groupBy("treatment").agg(
        F.sum("object_count").alias("objects"), F.sum(F.round(F.col("megapixels") * 1e6).cast("bigint")).alias("pixels")
    )
    return wide.join(sizes, "treatment").select(
        "treatment",
        F.col("render_ns_count").alias("calls"),
        F.col("render_ns_total").alias("render_total_ns"),
        F.expr("render_ns_total div render_ns_count").alias("render_mean_ns"),
        F.col("render_ns_p").alias("render_p95_ns"),
        F.expr("modeled_ns_total div modeled_ns_count").alias("modeled_mean_ns"),
        F.col("modeled_ns_p").alias("modeled_p95_ns"),
        F.expr("render_ns_total div greatest(1, objects)").alias("per_object_mean_ns"),
        (F.col("render_ns_total") / F.greatest(F.lit(1e-9), F.col("pixels") / 1e6)).cast("bigint").alias("per_megapixel_mean_ns"),
    )


def effect_summary(rows: DataFrame) -> DataFrame:
    """Cost of each applied effect per treatment."""
    effects = rows.select("treatment", F.explode("effects").alias("e")).where("e.applied").select(
        "treatment", F.col("e.id").alias("effect"), F.col("e.duration_ns").alias("duration_ns")
    )
    stats = exact_quantiles(effects, ["treatment", "effect"], "duration_ns", {"p": (0.95, "whole")}, keep_stats=True)
    return stats.select(
        "treatment", "effect", F.col("count").alias("calls"), F.col("total").alias("total_ns"),
        F.expr("total div count").alias("mean_ns"), F.col("p").alias("p95_ns"),
    )


def paired_delta(rows: DataFrame, baseline: Column, value: str = "render_ns") -> DataFrame:
    """Difference to the baseline of the same fixture; fixtures without one drop out."""
    base = rows.where(baseline).select("fixture", F.col(value).alias("__base"))
    deltas = rows.where(~baseline).join(base, "fixture").withColumn("delta", F.col(value) - F.col("__base"))
    stats = exact_quantiles(deltas, ["treatment"], "delta", {"p": (0.95, "whole")}, keep_stats=True)
    return stats.select(
        "treatment", F.col("count").alias("pairs"), F.expr("total div count").alias("mean_delta_ns"),
        F.col("p").alias("p95_delta_ns"),
    )


def slow_samples(rows: DataFrame, metrics: Sequence[str], k: int = 10) -> DataFrame:
    """The k most expensive rows by each metric with their applied effects.

    Each metric is a sort with limit: every task keeps only its own k rows.
    """
    active = F.transform(F.filter("effects", lambda e: e["applied"]), lambda e: e["id"])
    parts = [
        rows.select(
            F.lit(m).alias("metric"), "fixture", "treatment", F.col(m).alias("value_ns"), "recipe_id", "object_count",
            active.alias("active_effects"),
        ).orderBy(F.desc("value_ns"), "fixture", "treatment").limit(k)
        for m in metrics
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def study_findings(rows: DataFrame, treatments: DataFrame, declared: DataFrame) -> DataFrame:
    """Few fixtures, treatments that are missing, undeclared or declared twice, counts that disagree.

    treatments[treatment] lists the declared ids, declared[treatment, calls] the reported counts.
    """
    seen = rows.groupBy("treatment").agg(F.count(F.lit(1)).alias("n"))
    fixtures = rows.agg(F.countDistinct("fixture").alias("n"))
    few = fixtures.where(F.col("n") < MIN_FIXTURES).select(F.lit("LOW_SAMPLE_COUNT").alias("code"), F.col("n").cast("string").alias("key"))
    names = treatments.groupBy("treatment").agg(F.count(F.lit(1)).alias("n"))

    def listed(frame: DataFrame, code: str) -> DataFrame:
        return frame.select(F.lit(code).alias("code"), F.col("treatment").cast("string").alias("key"))

    return (
        few.unionByName(listed(names.join(seen, "treatment", "left_anti"), "TREATMENT_MISSING"))
        .unionByName(listed(seen.join(names, "treatment", "left_anti"), "TREATMENT_UNDECLARED"))
        .unionByName(listed(names.where("n > 1"), "TREATMENT_DUPLICATE"))
        .unionByName(listed(declared.join(seen, "treatment", "left").where("calls <> coalesce(n, 0)"), "SAMPLE_COUNT_MISMATCH"))
    )


def treatment_matrix(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Effect stacks of every treatment as rows.

    Both inputs hold [stage, pos, id, probability]. Extra effects follow the base stack
    of their stage; the forced treatment applies every extra effect.
    """
    columns = ["treatment", "stage", "layer", "pos", "id", "probability"]

    def stack(frame: DataFrame, treatment: Column, layer: int) -> DataFrame:
        return frame.withColumn("treatment", treatment).withColumn("layer", F.lit(layer)).select(*columns)

    with_base = ["current", "combined", *[f"{s}-only" for s in STAGES]]
    bases = stack(base, F.explode(F.array(*[F.lit(n) for n in with_base])), 0)
    only = F.concat(F.col("stage"), F.lit("-only"))
    extras = stack(extra, F.explode(F.array(F.lit("combined"), only)), 1)
    forced = stack(extra.withColumn("probability", F.lit(1.0)), F.lit("forced"), 0)
    return bases.unionByName(extras).unionByName(forced)
