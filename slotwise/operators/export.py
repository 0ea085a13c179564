"""From accepted samples to label files: class ids, names, lines and the export gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions import geometry as G
from slotwise.operators.scale import global_position, key_ranges, ranked


def merge_class_catalog(runs: DataFrame) -> DataFrame:
    """Union of the pools' class lists in first-seen order with new ids.

    runs[pool_index, classes]. Only the distinct class names are numbered together.
    """
    seen = runs.select("pool_index", F.posexplode("classes").alias("pos", "class_name"))
    first = seen.groupBy("class_name").agg(F.min(F.struct("pool_index", "pos")).alias("at"))
    return first.select("class_name", (F.row_number().over(Window.orderBy("at")) - 1).alias("class_id"))


def allocate_filenames(samples: DataFrame, preserve: bool) -> DataFrame:
    """File name of every exported sample.

    samples[key, pool_index, name]. Without ``preserve`` names count up in key order over
    all pools. With it the first sample of a name keeps it; repeats carry their pool and,
    from the second repeat in a pool on, a number.
    """
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    extension = F.regexp_extract("name", r"(\.[^.]*)$", 1)
    if not preserve:
        numbered = global_position(samples, ["key"], out="position")
        return numbered.withColumn("filename", F.concat(F.format_string("image_%08d", "position"), extension)).drop("position")
    bucket = F.col("__range")
    placed = ranked(key_ranges(samples, ["key"]), ["name"], bucket, ["key"], "__nth")
    repeats = ranked(placed.where("__nth > 1"), ["name", "pool_index"], bucket, ["key"], "__repeat")
    again = F.when(F.col("__repeat") > 1, F.concat(F.lit("_"), F.col("__repeat").cast("string"))).otherwise("")
    renamed = repeats.withColumn(
        "filename", F.concat(stem, F.lit("_pool"), F.col("pool_index").cast("string"), again, extension)
    ).drop("__nth", "__repeat")
    kept = placed.where("__nth = 1").withColumn("filename", F.col("name")).drop("__nth")
    return kept.unionByName(renamed).drop("__range")


def six_decimals(value: Column) -> Column:
    return F.format_string("%.6f", value)


def label_lines(samples: DataFrame, annotations: DataFrame, classes: DataFrame, width: int, height: int) -> DataFrame:
    """Detection label text per sample: one line per object in order, empty for negatives.

    annotations[sample, pos, class_name, x1, y1, x2, y2]; objects per sample are few.
    """
    n = G.normalized_bbox(G.box(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")), width, height)
    line = F.concat_ws(" ", F.col("class_id").cast("string"), *[six_decimals(n[c]) for c in ("cx", "cy", "w", "h")])
    lines = annotations.join(classes, "class_name").select("sample", F.struct("pos", line.alias("line")).alias("l"))
    text = lines.groupBy("sample").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("l")), lambda s: s["line"]), "\n").alias("text")
    )
    joined = samples.join(text, "sample", "left")
    return joined.withColumn("text", F.when(F.col("text").isNull(), "").otherwise(F.concat("text", F.lit("\n"))))


def polygon_line(class_id: Column, points: Column, width, height) -> Column:
    """Segmentation line: class and the polygon in fractions of the frame, limited to [0, 1]."""

    def part(value: Column, size) -> Column:
        return six_decimals(F.least(F.lit(1.0), F.greatest(F.lit(0.0), value / size)))

    pairs = F.transform(points, lambda p: F.concat_ws(" ", part(p["x"], F.lit(float(width))), part(p["y"], F.lit(float(height)))))
    return F.concat_ws(" ", class_id.cast("string"), F.array_join(pairs, " "))


def polygon_lines(rows: DataFrame, width: int, height: int) -> DataFrame:
    """Adds ``line`` to rows[class_id, points array<struct<x,y>>]."""
    return rows.withColumn("line", polygon_line(F.col("class_id"), F.col("points"), width, height))


def effective_semantics(requested: str, runs: DataFrame) -> DataFrame:
    """Mask semantics per run: the requested one, or the run's own default for ``family``."""
    if requested not in ("visible", "full", "family"):
        raise ValueError(f"unsupported mask semantics {requested}")
    own = F.coalesce("default_mask_semantics", F.lit("visible"))
    return runs.withColumn("semantics", own if requested == "family" else F.lit(requested))


def semantics_report(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The single semantics of an export, or ``mixed``."""
    return rows.groupBy(*by).agg(
        F.when(F.min("semantics") == F.max("semantics"), F.min("semantics")).otherwise("mixed").alias("mask_semantics")
    )


def export_gate(findings: DataFrame, runs: DataFrame, task: str) -> DataFrame:
    """Pools that must not be exported, with the reason."""
    failed = findings.groupBy("pool").agg(F.array_join(F.array_sort(F.collect_set("code")), ", ").alias("reason"))
    failed = failed.join(runs.select("pool"), "pool", "left_semi")
    if task == "detection":
        return failed
    if task != "segmentation":
        raise ValueError(f"unsupported task {task}")
    old = runs.where(F.coalesce("schema_version", F.lit(1)) != 2).join(failed, "pool", "left_anti")
    return failed.unionByName(old.select("pool", F.lit("SCHEMA_WITHOUT_MASKS").alias("reason")))
