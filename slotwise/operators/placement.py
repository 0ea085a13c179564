"""Placing objects without overlap and diagnosing those that did not fit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions import geometry as G

BOX_TYPE = "struct<x1:bigint,y1:bigint,x2:bigint,y2:bigint>"


def greedy_placement(tries: DataFrame, box_type: str = BOX_TYPE) -> DataFrame:
    """In object order, each object takes its first try that overlaps no accepted box.

    tries[slot, object, try, x1, y1, x2, y2]. Objects and tries per slot are bounded by
    the sampling profile, so a slot is folded inside one row. Returns one row per object:
    the accepted try or NULL, the blockers met, and the failed box with fewest blockers.
    """
    box = F.struct("x1", "y1", "x2", "y2").cast(box_type)
    listed = tries.groupBy("slot").agg(
        F.sort_array(F.collect_list(F.struct(F.col("object"), F.col("try"), box.alias("box")))).alias("tries")
    )
    outcome_type = f"struct<object:int,try:int,blockers:int,accepted:boolean,box:{box_type}>"
    start = F.struct(
        F.array().cast(f"array<{box_type}>").alias("occupied"),
        F.lit(None).cast("int").alias("placed"),
        F.array().cast(f"array<{outcome_type}>").alias("outcomes"),
    )

    def step(state: Column, t: Column) -> Column:
        done = F.coalesce(state["placed"] == t["object"], F.lit(False))
        blockers = F.size(F.filter(state["occupied"], lambda o: G.intersects(t["box"], o)))
        accepted = blockers == 0
        outcome = F.struct(
            t["object"].cast("int").alias("object"), t["try"].cast("int").alias("try"), blockers.alias("blockers"),
            accepted.alias("accepted"), t["box"].alias("box"),
        ).cast(outcome_type)
        return F.when(done, state).otherwise(
            F.struct(
                F.when(accepted, F.array_append(state["occupied"], t["box"])).otherwise(state["occupied"]).alias("occupied"),
                F.when(accepted, t["object"].cast("int")).otherwise(state["placed"]).alias("placed"),
                F.array_append(state["outcomes"], outcome).alias("outcomes"),
            )
        )

    folded = listed.select("slot", F.aggregate("tries", start, step)["outcomes"].alias("outcomes"))
    rows = folded.select("slot", F.explode("outcomes").alias("o")).select("slot", "o.*")
    failed = F.when(~F.col("accepted"), F.struct("blockers", "try", "box"))
    return rows.groupBy("slot", "object").agg(
        F.max(F.when(F.col("accepted"), F.col("try"))).alias("accepted_try"),
        F.sum("blockers").alias("blocking_count"),
        F.count(F.lit(1)).cast("int").alias("placement_attempts"),
        F.min(failed).alias("best_failed"),
    )


def placement_rejections(placed: DataFrame) -> DataFrame:
    """Objects whose tries ran out."""
    return placed.where("accepted_try is null").select(
        "slot", "object", "placement_attempts", "blocking_count", "best_failed",
        F.lit("planner.placement").alias("stage"), F.lit("placement_attempts_exhausted").alias("reason"),
    )


def overlap_pairs(boxes: DataFrame, slot: str, ident: Sequence[str], cell: int = 128) -> DataFrame:
    """Blockers of every box within its slot: the other boxes that it meets.

    Slots are cut into grid cells and boxes meet cell by cell; each meeting pair is counted
    only in the cell that holds the lower corner of its intersection, so the count stays
    exact and the work follows the real overlaps. A box without area meets nothing. Boxes
    that are already dealt by slot are not shuffled again.
    """
    ident = list(ident)
    solid = F.coalesce((F.col("x1") < F.col("x2")) & (F.col("y1") < F.col("y2")), F.lit(False))

    def cells(low: str, high: str) -> Column:
        listed = F.sequence(F.floor(F.col(low) / cell), F.floor((F.col(high) - 1e-9) / cell))
        return F.explode(F.when(solid, listed).otherwise(F.array(F.lit(None).cast("bigint"))))

    def blocks(a: Column, b: Column) -> Column:
        same = F.lit(True)
        for c in ident:
            same = same & a[c].eqNullSafe(b[c])
        return (
            G.intersects(a, b) & ~same
            & (F.floor(F.greatest(a["x1"], b["x1"]) / cell) == F.col("__cx"))
            & (F.floor(F.greatest(a["y1"], b["y1"]) / cell) == F.col("__cy"))
        )

    tiled = boxes.select(slot, *ident, "x1", "y1", "x2", "y2").withColumn("__cx", cells("x1", "x2")).withColumn("__cy", cells("y1", "y2"))
    box = F.struct(*ident, "x1", "y1", "x2", "y2")
    tiles = tiled.groupBy(slot, "__cx", "__cy").agg(F.collect_list(box).alias("__boxes"))
    # Boxes without area share the cell without a number.
    met = lambda a: F.when(F.col("__cx").isNull(), 0).otherwise(F.size(F.filter("__boxes", lambda b: blocks(a, b))))
    counted = F.transform("__boxes", lambda a: F.struct(*[a[c].alias(c) for c in ident], met(a).cast("bigint").alias("n")))
    return tiles.select(slot, F.explode(counted).alias("__b")).select(slot, "__b.*").groupBy(slot, *ident).agg(F.sum("n").alias("blockers"))


def spatial_histogram(points: DataFrame, x: Column, y: Column, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Row-major cell counts of normalised points, empty cells included."""
    by = list(by)
    counts = points.select(*by, G.histogram_bin(x, y, bins).alias("bin")).groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    listed = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    cells = F.explode(F.sequence(F.lit(0), F.lit(bins * bins - 1)))
    return listed.select(*by, "m", cells.alias("bin")).select(
        *by, "bin", F.coalesce(F.col("m")[F.col("bin")], F.lit(0)).cast("bigint").alias("n")
    )


def histogram_sum(records: DataFrame, counts: str, bins: int = 8) -> DataFrame:
    """Element-wise sum of the histograms of one size; other sizes are left out."""
    fitting = records.where(F.size(counts) == bins * bins)
    return fitting.select(F.posexplode(counts).alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n"))


def placement_normalize(samples: DataFrame, width: str, height: str) -> DataFrame:
    """Object rejections with projected box, sides and region filled from the best failed box.

    samples[sample_id, matrix, width, height, rejected array<struct<..., best_failed,
    projected, sides, region>>].
    """
    rows = samples.select("sample_id", "matrix", width, height, F.explode("rejected").alias("r"))
    fill = F.col("r.best_failed").isNotNull() & F.col("r.projected").isNull()
    p = G.project_bbox(F.col("matrix"), F.col("r.best_failed"))
    p = G.box(*[F.round(p[k], 3) for k in ("x1", "y1", "x2", "y2")])
    rows = rows.withColumn("__p", F.when(fill, p))
    q = F.col("__p")
    return rows.select(
        "sample_id",
        F.col("r.object").alias("object"),
        F.when(fill, q).otherwise(F.col("r.projected")).alias("projected"),
        F.when(fill, G.clipped_sides(q, F.col(width), F.col(height))).otherwise(F.col("r.sides")).alias("sides"),
        F.when(fill, G.spatial_region((q["x1"] + q["x2"]) / 2.0, (q["y1"] + q["y2"]) / 2.0, F.col(width), F.col(height)))
        .otherwise(F.col("r.region")).alias("region"),
    )
