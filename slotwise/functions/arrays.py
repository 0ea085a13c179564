"""Expressions over numeric array columns: coverage masks and small images."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v.cast("double"))


def array_mean(values: Column) -> Column:
    return array_sum(values) / F.size(values)


def array_std(values: Column) -> Column:
    """Population standard deviation around the exact mean."""
    mean = array_mean(values)
    return F.sqrt(
        F.aggregate(
            F.transform(values, lambda v: (v.cast("double") - mean) * (v.cast("double") - mean)),
            F.lit(0.0),
            lambda s, v: s + v,
        )
        / F.size(values)
    )


def average_hash_bits(values: Column) -> Column:
    """64 characters, one per value: 1 when the value reaches the mean."""
    mean = array_mean(values)
    return F.array_join(
        F.transform(values, lambda v: F.when(v.cast("double") >= mean, F.lit("1")).otherwise(F.lit("0"))), ""
    )


def average_hash64(values: Column) -> Column:
    """16 hex digits; the first value is the most significant bit."""
    return F.lower(F.lpad(F.conv(average_hash_bits(values), 2, 16), 16, "0"))


def hash_as_long(hex16: Column) -> Column:
    """The 64 bits as a signed long, for bit operations."""
    return F.conv(hex16, 16, -10).cast("bigint")


def hamming_similarity(left: Column, right: Column) -> Column:
    """1 - differing bits / 64 of two signed 64-bit hashes."""
    return 1.0 - F.bit_count(left.bitwiseXOR(right)) / 64.0


def weighted_blend(a: Column, b: Column, w: Column) -> Column:
    """a*w + b*(1-w) element by element, limited to [0, 1]."""
    mixed = F.zip_with(F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), w,
                       lambda p, k: p["x"] * k + p["y"] * (1.0 - k))
    return F.transform(mixed, lambda v: F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))


def mask_counts(left: Column, right: Column, threshold: int) -> Column:
    """Pixel counts of both binary masks, their intersection and union."""
    pairs = F.zip_with(left, right, lambda a, b: F.struct((a > threshold).alias("a"), (b > threshold).alias("b")))

    def count(test) -> Column:
        return F.size(F.filter(pairs, test))

    return F.struct(
        count(lambda p: p["a"]).alias("left"),
        count(lambda p: p["b"]).alias("right"),
        count(lambda p: p["a"] & p["b"]).alias("both"),
        count(lambda p: p["a"] | p["b"]).alias("either"),
    )


def mask_iou(left: Column, right: Column, threshold: int = 0) -> Column:
    """Intersection over union (empty union counts as 1) and relative area error."""
    c = mask_counts(left, right, threshold)
    return F.struct(
        F.when(c["either"] == 0, 1.0).otherwise(c["both"] / F.greatest(c["either"], F.lit(1))).alias("iou"),
        (F.abs(c["right"] - c["left"]) / F.greatest(F.lit(1), c["left"])).alias("area_error"),
    )


def coverage_bbox(values: Column, width: Column, threshold) -> Column:
    """Box of the values above the threshold in a row-major array; maxima exclusive.

    One fold over the array; NULL when no value is above the threshold.
    """
    kind = "struct<x1:int,y1:int,x2:int,y2:int>"
    none = F.lit(None).cast("int")
    start = F.struct(none.alias("x1"), none.alias("y1"), none.alias("x2"), none.alias("y2")).cast(kind)
    cells = F.transform(
        values,
        lambda v, i: F.struct(
            (v > threshold).alias("hit"), (i % width).cast("int").alias("x"), F.floor(i / width).cast("int").alias("y")
        ),
    )

    def grow(b: Column, c: Column) -> Column:
        wider = F.struct(
            F.least(b["x1"], c["x"]).alias("x1"), F.least(b["y1"], c["y"]).alias("y1"),
            F.greatest(b["x2"], c["x"] + 1).alias("x2"), F.greatest(b["y2"], c["y"] + 1).alias("y2"),
        )
        return F.when(c["hit"], wider.cast(kind)).otherwise(b)

    return F.aggregate(cells, start, grow, lambda b: F.when(b["x1"].isNotNull(), b))


def coverage_facts(visible: Column, full: Column, width: Column, threshold: Column) -> Column:
    """``exceeds``: some visible value is above its full one; ``box``: ``coverage_bbox`` of the visible values.

    Whole batches at once: a fold of lambdas looks at every value by itself. Missing values exceed nothing.
    """
    kind = pa.struct([("exceeds", pa.bool_()), ("box", pa.struct([(c, pa.int32()) for c in ("x1", "y1", "x2", "y2")]))])

    def values(lists, missing: float):
        """Values as doubles, lengths and first places of the lists."""
        length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        out = pc.fill_null(pc.cast(flat, pa.float64(), safe=False), 0.0).to_numpy(zero_copy_only=False).copy()
        out[np.isnan(out)] = np.inf
        out[flat.is_null().to_numpy(zero_copy_only=False)] = missing
        return out, length, np.cumsum(length) - length

    @F.arrow_udf("struct<exceeds:boolean,box:struct<x1:int,y1:int,x2:int,y2:int>>")
    def facts(visible: pa.Array, full: pa.Array, width: pa.Array, threshold: pa.Array) -> pa.Array:
        v, v_length, v_first = values(visible, -np.inf)
        f, f_length, f_first = values(full, np.inf)
        n = len(v_length)
        row = np.repeat(np.arange(n), v_length)
        place = np.arange(len(v)) - v_first[row]
        both = np.flatnonzero(place < f_length[row])
        above = both[v[both] > f[f_first[row[both]] + place[both]]]
        exceeds = np.zeros(n, bool)
        exceeds[row[above]] = True
        limit = pc.fill_null(pc.cast(threshold, pa.float64()), np.inf).to_numpy(zero_copy_only=False)
        wide = pc.fill_null(pc.cast(width, pa.int64()), 0).to_numpy(zero_copy_only=False)
        hit = np.flatnonzero((v > limit[row]) & (wide[row] > 0))
        own, x, y = row[hit], place[hit] % wide[row[hit]], place[hit] // wide[row[hit]]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        box, some = np.zeros((4, n), np.int32), np.zeros(n, bool)
        if len(first):
            some[own[first]] = True
            for c, (least, at) in enumerate(((np.minimum, x), (np.minimum, y), (np.maximum, x + 1), (np.maximum, y + 1))):
                box[c, own[first]] = least.reduceat(at, first)
        boxes = pa.StructArray.from_arrays([pa.array(c) for c in box], fields=list(kind.field("box").type), mask=pa.array(~some))
        return pa.StructArray.from_arrays([pa.array(exceeds), boxes], fields=list(kind))

    return facts(visible, full, width, threshold)


def array_digest(values: Column) -> Column:
    """SHA-256 of the values written as comma separated text."""
    return F.sha2(F.array_join(F.transform(values, lambda v: v.cast("string")), ","), 256)


def array_fingerprint(values: Column, max_inline: int = 32) -> Column:
    """Long arrays are replaced by length, minimum, maximum, mean and digest."""
    long = F.size(values) > max_inline
    return F.struct(
        F.when(long, F.lit("fingerprint")).otherwise(F.lit("inline")).alias("kind"),
        F.size(values).alias("length"),
        F.when(long, F.array_min(values).cast("double")).alias("minimum"),
        F.when(long, F.array_max(values).cast("double")).alias("maximum"),
        F.when(long, array_mean(values)).alias("mean"),
        F.when(long, array_digest(values)).alias("sha256"),
        F.when(~long, values).alias("values"),
    )


def array_qa_gate(
    values: Column,
    side: int = 8,
    tileable: bool = False,
    min_std: float = 0.003,
    warn_std: float = 0.025,
    max_clipping: float = 0.98,
    warn_clipping: float = 0.20,
    max_seam: float = 0.12,
) -> Column:
    """Quality metrics of a square array in [0, 1], the reject reason and the warnings."""
    finite = ~F.exists(values, lambda v: F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    clipped = F.size(F.filter(values, lambda v: (v <= 1e-5) | (v >= 1.0 - 1e-5))) / F.size(values)
    std = array_std(values)
    index = F.sequence(F.lit(0), F.lit(side - 1))
    horizontal = F.aggregate(
        F.transform(index, lambda i: F.abs(values[i * side] - values[i * side + side - 1]).cast("double")),
        F.lit(0.0), lambda s, v: s + v) / side
    vertical = F.aggregate(
        F.transform(index, lambda i: F.abs(values[i] - values[i + side * (side - 1)]).cast("double")),
        F.lit(0.0), lambda s, v: s + v) / side
    seam = (horizontal + vertical) / 2.0
    reject = (
        F.when(~finite, F.lit("non_finite"))
        .when(std < min_std, F.lit("near_constant"))
        .when(clipped > max_clipping, F.lit("severely_clipped"))
    )
    if tileable:
        reject = reject.when(seam > max_seam, F.lit("edge_seam"))
    warnings = F.array_compact(
        F.array(
            F.when(std < warn_std, F.lit("low_luminance_spread")),
            F.when(clipped > warn_clipping, F.lit("elevated_clipping")),
            F.when(seam > max_seam, F.lit("high_edge_seam")),
        )
    )
    return F.struct(
        finite.alias("finite"), std.alias("std"), clipped.alias("clipping"), seam.alias("seam"),
        reject.alias("reject"), warnings.alias("warnings"),
    )
