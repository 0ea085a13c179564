"""Box, matrix and region operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions import geometry as G
from slotwise.operators import placement as P
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query


def matrix(row: str = "a") -> Column:
    """A mild perspective derived from the row."""
    d, x = F.col("discount"), F.col("tax")
    values = [d + 1.0, x, F.col("quantity"), x * -1.0, d * 0.5 + 1.0, F.lit(7.0), x / 1000, d / 1000, F.lit(1.0)]
    return F.array(*values)


SQL_MATRIX = "[discount + 1.0::double, tax, quantity, tax * -1.0::double, discount * 0.5::double + 1.0::double, 7.0::double, tax / 1000, discount / 1000, 1.0::double]"


def _px(x: str, y: str) -> str:
    return f"((m[1] * {x} + m[2] * {y} + m[3]) / (m[7] * {x} + m[8] * {y} + m[9]))"


def _py(x: str, y: str) -> str:
    return f"((m[4] * {x} + m[5] * {y} + m[6]) / (m[7] * {x} + m[8] * {y} + m[9]))"


_CORNERS = [("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2")]
_XS = ", ".join(_px(x, y) for x, y in _CORNERS)
_YS = ", ".join(_py(x, y) for x, y in _CORNERS)
SQL_PROJECTED = (
    B.SQL_ANNOTATIONS
    + f""",
v_projected as (select *, least({_XS}) as px1, least({_YS}) as py1, greatest({_XS}) as px2, greatest({_YS}) as py2
  from (select *, {SQL_MATRIX} as m from v_annotations))"""
)


@query(
    "project_bbox",
    with_sql(
        "select sample_id, instance_pos, round(px1, 6) as x1, round(py1, 6) as y1, round(px2, 6) as x2, round(py2, 6) as y2 from v_projected",
        SQL_PROJECTED,
    ),
)
def _(t: Tables) -> DataFrame:
    a = B.annotations(t)
    p = G.project_bbox(matrix(), B.box_of(a))
    return a.select("sample_id", "instance_pos", *[F.round(p[c], 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query(
    "compose_matrix",
    with_sql(
        "select sample_id, instance_pos, "
        + ", ".join(
            f"round({' + '.join(f'a[{3 * r + k + 1}] * b[{3 * k + c + 1}]' for k in range(3))}, 10) as m{3 * r + c}"
            for r in range(3)
            for c in range(3)
        )
        + """ from (select *, [1280 / cw, 0, -cx * (1280 / cw), 0, 960 / ch, -cy * (960 / ch), 0, 0, 1]::double[] as a, m as b
              from (select *, 1000.0::double + quantity as cw, 800.0::double + quantity as ch, x1 / 10.0::double as cx, y1 / 10.0::double as cy from v_projected))""",
        SQL_PROJECTED,
    ),
)
def _(t: Tables) -> DataFrame:
    crop = G.crop_matrix(
        F.col("x1") / 10.0, F.col("y1") / 10.0, F.col("quantity") + 1000.0, F.col("quantity") + 800.0, F.lit(1280), F.lit(960)
    )
    rows = B.annotations(t).select("sample_id", "instance_pos", crop.alias("a"), matrix().alias("b"))
    rows = rows.select("sample_id", "instance_pos", G.compose_matrix(F.col("a"), F.col("b")).alias("m"))
    return rows.select("sample_id", "instance_pos", *[F.round(F.col("m")[i], 10).alias(f"m{i}") for i in range(9)])


@query(
    "quad_gate",
    with_sql(
        """select sample_id, instance_pos, convex and frac >= 0.6 as ok, round(frac, 9) as area_fraction,
             case when not convex then 'not_convex' when frac < 0.6 then 'area_below_minimum' end as reason
           from (select *, (least(t1, t2, t3, t4) >= 0 or greatest(t1, t2, t3, t4) <= 0) as convex,
               abs(ax * by_ - bx * ay + bx * cy - cx * by_ + cx * dy - dx * cy + dx * ay - ax * dy) * 0.5 / 1000000 as frac
             from (select *, (bx - ax) * (cy - by_) - (by_ - ay) * (cx - bx) as t1, (cx - bx) * (dy - cy) - (cy - by_) * (dx - cx) as t2,
                 (dx - cx) * (ay - dy) - (dy - cy) * (ax - dx) as t3, (ax - dx) * (by_ - ay) - (ay - dy) * (bx - ax) as t4
               from (select sample_id, instance_pos, x1 * 0.9::double as ax, y1 * 0.3::double as ay, 1000.0::double - y1 * 0.2::double as bx, x1 * 0.2::double as by_,
                   1000.0::double - x1 * 0.1::double as cx, 1000.0::double - y1 * 0.1::double as cy, 0.0::double + tax * 1000 as dx, 1000.0::double - discount * 1000 as dy from v_annotations)))""",
        B.SQL_ANNOTATIONS,
    ),
)
def _(t: Tables) -> DataFrame:
    x, y = F.col("x1"), F.col("y1")
    quad = [
        (x * 0.9, y * 0.3),
        (1000.0 - y * 0.2, x * 0.2),
        (1000.0 - x * 0.1, 1000.0 - y * 0.1),
        (F.lit(0.0) + F.col("tax") * 1000, 1000.0 - F.col("discount") * 1000),
    ]
    rows = B.annotations(t).select("sample_id", "instance_pos", G.quad_gate(quad, F.lit(1000000), 0.6).alias("g"))
    return rows.select("sample_id", "instance_pos", "g.ok", F.round("g.area_fraction", 9).alias("area_fraction"), "g.reason")


@query(
    "bbox_ops",
    with_sql(
        """select sample_id, instance_pos, (x2 > 200 and 600 > x1 and y2 > 300 and 700 > y1) as meets,
             case when least(1000, x2) > least(1000, x1) and least(1000, y2) > least(1000, y1) then
               concat_ws(',', greatest(0, least(1000, x1)), greatest(0, least(1000, y1)), greatest(0, least(1000, x2)), greatest(0, least(1000, y2))) end as clipped,
             concat_ws(',', x1 - 5, y1 - 5, x2 + 5, y2 + 5) as expanded from v_annotations""",
        B.SQL_ANNOTATIONS,
    ),
)
def _(t: Tables) -> DataFrame:
    def text(b: Column) -> Column:
        joined = F.concat_ws(",", *[b[k].cast("string") for k in ("x1", "y1", "x2", "y2")])
        return F.when(b.isNotNull(), joined)

    a = B.annotations(t)
    b = B.box_of(a)
    window = G.box(200, 300, 600, 700)
    return a.select(
        "sample_id", "instance_pos", G.intersects(b, window).alias("meets"),
        text(G.clip(b, 1000, 1000)).alias("clipped"), text(G.expand(b, 5)).alias("expanded"),
    )


@query(
    "overlap_pairs",
    with_sql(
        """select a.sample_id, a.instance_pos, count(b.instance_pos) as blockers from v_annotations a
           left join v_annotations b on a.sample_id = b.sample_id and a.instance_pos <> b.instance_pos
             and a.x2 > b.x1 and b.x2 > a.x1 and a.y2 > b.y1 and b.y2 > a.y1 group by 1, 2""",
        B.SQL_ANNOTATIONS,
    ),
)
def _(t: Tables) -> DataFrame:
    return P.overlap_pairs(B.annotations(t), "sample_id", ["instance_pos"])


@query(
    "normalized_bbox",
    with_sql(
        """select sample_id, instance_pos, round((x1 + x2) / 2.0 / 1000, 9) as cx, round((y1 + y2) / 2.0 / 1000, 9) as cy,
             round((x2 - x1) / 1000.0, 9) as w, round((y2 - y1) / 1000.0, 9) as h from v_annotations""",
        B.SQL_ANNOTATIONS,
    ).replace("2.0", "2.0::double").replace("1000.0", "1000.0::double"),
)
def _(t: Tables) -> DataFrame:
    a = B.annotations(t)
    n = G.normalized_bbox(B.box_of(a), 1000, 1000)
    return a.select("sample_id", "instance_pos", *[F.round(n[c], 9).alias(c) for c in ("cx", "cy", "w", "h")])


@query(
    "visible_fraction_gate",
    with_sql(
        """select sample_id, instance_pos, round(vis, 9) as visibility,
             case when quantity = 50 then 'empty_alpha' when outside then 'outside_frame' when vis < 0.5 then 'visible_bbox_fraction' end as reason
           from (select *, case when outside then 0 else least(1.0::double, (least(900, px2) - greatest(0, px1)) * (least(900, py2) - greatest(0, py1)) / greatest(1e-9::double, (px2 - px1) * (py2 - py1))) end as vis
             from (select *, not (least(900, px2) > greatest(0, least(900, px1)) and least(900, py2) > greatest(0, least(900, py1))) as outside from v_projected))""",
        SQL_PROJECTED,
    ),
)
def _(t: Tables) -> DataFrame:
    a = B.annotations(t)
    rows = a.select("sample_id", "instance_pos", "quantity", G.project_bbox(matrix(), B.box_of(a)).alias("full"))
    gate = G.visible_fraction_gate(F.col("full"), G.clip(F.col("full"), 900.0, 900.0), 0.5, F.col("quantity") < 50)
    rows = rows.select("sample_id", "instance_pos", gate.alias("g"))
    return rows.select("sample_id", "instance_pos", F.round("g.visibility", 9).alias("visibility"), "g.reason")


@query(
    "spatial_region",
    with_sql(
        f"select sample_id, instance_pos, {B.sql_region('px1', 'py2', '900.0')} as region from v_projected", SQL_PROJECTED
    ),
)
def _(t: Tables) -> DataFrame:
    a = B.annotations(t)
    p = G.project_bbox(matrix(), B.box_of(a))
    return a.select("sample_id", "instance_pos", G.spatial_region(p["x1"], p["y2"], 900, 900).alias("region"))


_SIDES = """array_to_string(list_filter([case when {x1} < 0 then 'left' end, case when {y1} < 0 then 'top' end,
  case when {x2} > {w} then 'right' end, case when {y2} > {w} then 'bottom' end], lambda s: s is not null), ',')"""


@query(
    "clipped_sides",
    with_sql(
        f"select sample_id, instance_pos, {_SIDES.format(x1='(x1 - 100)', y1='(y1 - 50)', x2='x2', y2='y2', w=1000)} as sides from v_annotations",
        B.SQL_ANNOTATIONS,
    ),
)
def _(t: Tables) -> DataFrame:
    b = G.box(F.col("x1") - 100, F.col("y1") - 50, F.col("x2"), F.col("y2"))
    return B.annotations(t).select(
        "sample_id", "instance_pos", F.array_join(G.clipped_sides(b, 1000, 1000), ",").alias("sides")
    )


@query(
    "spatial_histogram",
    with_sql(
        """select g.class_name, cast(b as integer) as bin, count(x.class_name) as n
           from (select distinct class_name from v_annotations) g cross join unnest(range(64)) as r(b)
           left join (select class_name, least(7, greatest(0, cast(floor(y2 / 1000.0::double * 8) as integer))) * 8 + least(7, greatest(0, cast(floor(x2 / 1000.0::double * 8) as integer))) as c from v_annotations) x
             on x.class_name = g.class_name and x.c = b group by 1, 2""",
        B.SQL_ANNOTATIONS,
    ),
)
def _(t: Tables) -> DataFrame:
    a = B.annotations(t, positions=False)
    return P.spatial_histogram(a, F.col("x2") / 1000.0, F.col("y2") / 1000.0, 8, ["class_name"])


@query(
    "histogram_sum",
    with_sql(
        """select cast(b as integer) as bin, cast(sum(n) as bigint) as n from (
             select unnest(range(64)) as b, unnest("full") as n from v_masks where vec_id % 5 <> 0) group by 1""",
        B.SQL_MASKS,
    ),
)
def _(t: Tables) -> DataFrame:
    """Arrays cut to 49 cells stand for histograms of another size."""
    counts = F.when(F.col("vec_id") % 5 == 0, F.slice("full", 1, 49)).otherwise(F.col("full"))
    summed = P.histogram_sum(B.masks(t).select(counts.alias("counts")), "counts")
    return summed.select("bin", F.col("n").cast("bigint").alias("n"))


@query(
    "scale_rotation_bands",
    with_sql(
        """select scale_band, rotation_band, count(*) as n from (select
             printf('%.2f-%.2f', greatest(0, floor(scale * 10)) / 10, greatest(0, floor(scale * 10)) / 10 + 0.1) as scale_band,
             (cast(floor((abs(rotation) % 180) / 15) as bigint) * 15) || '-' || (cast(floor((abs(rotation) % 180) / 15) as bigint) * 15 + 15) as rotation_band
           from v_annotations) group by all""",
        B.SQL_ANNOTATIONS,
    ),
)
def _(t: Tables) -> DataFrame:
    a = B.annotations(t, positions=False)
    return a.groupBy(
        G.scale_band(F.col("scale")).alias("scale_band"), G.rotation_band(F.col("rotation")).alias("rotation_band")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "placement_normalize",
    with_sql(
        f"""select sample_id, instance_pos as object,
             case when filled then round(px1, 3) else x1 end as x1, case when filled then round(py2, 3) else y2 end as y2,
             case when filled then {_SIDES.format(x1='round(px1, 3)', y1='round(py1, 3)', x2='round(px2, 3)', y2='round(py2, 3)', w=1000)} else 'given' end as sides,
             case when filled then {B.sql_region('((round(px1, 3) + round(px2, 3)) / 2)', '((round(py1, 3) + round(py2, 3)) / 2)')} else 'given' end as region
           from (select *, sample_id % 4 <> 0 as filled from v_projected where quantity > 35)""",
        SQL_PROJECTED,
    ),
)
def _(t: Tables) -> DataFrame:
    a = B.annotations(t).where("quantity > 35")
    given = F.col("sample_id") % 4 == 0
    b = G.box(*[F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")])
    item = F.struct(
        F.col("instance_pos").alias("object"), b.alias("best_failed"), F.when(given, b).alias("projected"),
        F.when(given, F.array(F.lit("given"))).alias("sides"), F.when(given, F.lit("given")).alias("region"),
    )
    rows = a.select(
        "sample_id", matrix().alias("matrix"), F.lit(1000).alias("width"), F.lit(1000).alias("height"),
        F.array(item).alias("rejected"),
    )
    out = P.placement_normalize(rows, "width", "height")
    return out.select(
        "sample_id", "object", F.col("projected.x1").alias("x1"), F.col("projected.y2").alias("y2"),
        F.array_join("sides", ",").alias("sides"), "region",
    )
