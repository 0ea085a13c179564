"""Mask and array operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions import arrays as A
from slotwise.operators import coverage as O
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query


def visible_masks(t: Tables) -> DataFrame:
    return O.visible_coverage(B.masks(t), "sample", "order", "full")


@query(
    "visible_coverage",
    with_sql("select vec_id, array_to_string(visible, ',') as visible from v_visible", B.SQL_MASKS),
)
def _(t: Tables) -> DataFrame:
    return visible_masks(t).select(
        "vec_id", F.array_join(F.transform("visible", lambda v: v.cast("string")), ",").alias("visible")
    )


SQL_BOXES = (
    B.SQL_MASKS
    + """,
v_boxes as (
  select vec_id, min(px % 8) filter (vis > 8) as x1, min(px // 8) filter (vis > 8) as y1,
    max(px % 8) filter (vis > 8) + 1 as x2, max(px // 8) filter (vis > 8) + 1 as y2,
    max(px % 8) filter (f > 8) + 1 as fx2 from v_visible_px group by vec_id)"""
)


@query(
    "coverage_bbox",
    with_sql(
        "select vec_id, cast(x1 as integer) as x1, cast(y1 as integer) as y1, cast(x2 as integer) as x2, cast(y2 as integer) as y2 from v_boxes",
        SQL_BOXES,
    ),
)
def _(t: Tables) -> DataFrame:
    rows = visible_masks(t).select("vec_id", A.coverage_bbox(F.col("visible"), F.lit(8), 8).alias("b"))
    return rows.select("vec_id", "b.*")


@query(
    "mask_iou",
    with_sql(
        """select vec_id, round(case when e = 0 then 1 else b::double / e end, 9) as iou, round(abs(v - f) / greatest(1, f)::double, 9) as area_error
           from (select vec_id, count(*) filter (f > 20) as f, count(*) filter (vis > 20) as v, count(*) filter (f > 20 and vis > 20) as b,
               count(*) filter (f > 20 or vis > 20) as e from v_visible_px group by vec_id)""",
        B.SQL_MASKS,
    ),
)
def _(t: Tables) -> DataFrame:
    rows = visible_masks(t).select("vec_id", A.mask_iou(F.col("full"), F.col("visible"), 20).alias("m"))
    return rows.select("vec_id", F.round("m.iou", 9).alias("iou"), F.round("m.area_error", 9).alias("area_error"))


@query(
    "mask_semantics_check",
    with_sql(
        """select vec_id, 'MASK_SEMANTICS_INVALID' as code from v_visible_px where vis + case when vec_id % 9 = 0 then 40 else 0 end > f group by vec_id
           union all select vec_id, 'MASK_EMPTY' from v_visible_px group by vec_id having max(vis + case when vec_id % 9 = 0 then 40 else 0 end) <= 120
           union all select vec_id, 'MASK_BBOX_MISMATCH' from (
             select vec_id, min(px % 8) filter (v > 120) as x1, min(px // 8) filter (v > 120) as y1, max(px % 8) filter (v > 120) + 1 as x2, max(px // 8) filter (v > 120) + 1 as y2,
               min(px % 8) filter (f > 120) as a1, min(px // 8) filter (f > 120) as b1, max(px % 8) filter (f > 120) + 1 as a2, max(px // 8) filter (f > 120) + 1 as b2
             from (select *, vis + case when vec_id % 9 = 0 then 40 else 0 end as v from v_visible_px) group by vec_id)
           where x1 is not null and (x1, y1, x2, y2) is distinct from (a1, b1, a2, b2)""",
        B.SQL_MASKS,
    ),
)
def _(t: Tables) -> DataFrame:
    """The stored box is that of the full mask; every ninth visible mask is spoiled by 40."""
    spoil = F.when(F.col("vec_id") % 9 == 0, 40).otherwise(0)
    rows = visible_masks(t).withColumn("visible", F.transform("visible", lambda v: v + spoil)).withColumn(
        "stored_box", A.coverage_bbox(F.col("full"), F.lit(8), 120)
    )
    return O.mask_semantics_check(rows, ["vec_id"], 8, 120)


@query(
    "mask_dedupe",
    with_sql(
        """select vec_id, sha256(array_to_string("full", ',')) as full_sha256, case when "full" = visible then 'full' end as visible_same_as,
             case when "full" <> visible then sha256(array_to_string(visible, ',')) end as visible_sha256 from v_visible""",
        B.SQL_MASKS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.mask_dedupe(visible_masks(t)).select("vec_id", "full_sha256", "visible_same_as", "visible_sha256")


@query(
    "blob_integrity",
    """with m as (select doc_id as key, case when doc_id % 17 = 0 then sha256(text || '!') else sha256(text) end as sha,
         strlen(text) + case when doc_id % 19 = 0 then 1 else 0 end as bytes, cast(doc_id % 13 as integer) - 1 as x, cast(n_chars % 120 as integer) as w
       from documents where doc_id % 23 <> 0 union all select doc_id + 100000000, 'none', 1, 0, 1 from documents where doc_id % 29 = 0
       union all select doc_id, sha256(text), strlen(text), 0, 1 from documents where doc_id % 31 = 0 and doc_id % 23 <> 0),
    j as (select m.*, d.text, d.doc_id as found from m left join documents d on d.doc_id = m.key)
    select key, 'BLOB_MISSING' as code from j where found is null
    union all select key, 'BLOB_HASH_MISMATCH' from j where found is not null and sha256(text) <> sha
    union all select key, 'BLOB_SIZE_MISMATCH' from j where found is not null and strlen(text) <> bytes
    union all select key, 'CROP_OUTSIDE_IMAGE' from j where x < 0 or x + w > 110
    union all select key, 'DUPLICATE_KEY' from m group by key having count(*) > 1
    union all select doc_id, 'BLOB_NOT_LISTED' from documents where doc_id not in (select key from m)""",
)
def _(t: Tables) -> DataFrame:
    d, i = t.documents, F.col("doc_id")
    size = F.octet_length("text")

    def entry(rows: DataFrame, key, sha, count, x, w) -> DataFrame:
        return rows.select(
            key.alias("key"), sha.alias("sha256"), count.cast("int").alias("byte_count"), x.cast("int").alias("x"),
            F.lit(0).alias("y"), w.cast("int").alias("w"), F.lit(1).alias("h"), F.lit(110).alias("width"), F.lit(110).alias("height"),
        )

    sha = F.when(i % 17 == 0, F.sha2(F.concat("text", F.lit("!")), 256)).otherwise(F.sha2("text", 256))
    manifest = entry(
        d.where("doc_id % 23 <> 0"), i, sha, size + F.when(i % 19 == 0, 1).otherwise(0), i % 13 - 1, F.col("n_chars") % 120
    )
    manifest = manifest.unionByName(
        entry(d.where("doc_id % 29 = 0"), i + 100000000, F.lit("none"), F.lit(1), F.lit(0), F.lit(1))
    ).unionByName(
        entry(d.where("doc_id % 31 = 0 and doc_id % 23 <> 0"), i, F.sha2("text", 256), size, F.lit(0), F.lit(1))
    )
    return O.blob_integrity(d.select(i.alias("key"), F.col("text").alias("content")), manifest)


@query(
    "array_fingerprint",
    with_sql(
        """select vec_id, kind, length, round(case when kind = 'fingerprint' then list_min(v) end, 12) as minimum, round(case when kind = 'fingerprint' then list_max(v) end, 12) as maximum,
             round(case when kind = 'fingerprint' then list_reduce(v, lambda p, q: p + q) / length end, 9) as mean
           from (select *, case when len(v) > 32 then 'fingerprint' else 'inline' end as kind, cast(len(v) as integer) as length
                 from (select vec_id, case when vec_id % 3 = 0 then v[1:32] else v end as v from v_vectors))""",
        B.SQL_VECTORS,
    ),
)
def _(t: Tables) -> DataFrame:
    values = F.when(F.col("vec_id") % 3 == 0, F.slice("v", 1, 32)).otherwise(F.col("v"))
    rows = B.vectors(t).select("vec_id", A.array_fingerprint(values).alias("f"))
    return rows.select(
        "vec_id", "f.kind", "f.length", F.round("f.minimum", 12).alias("minimum"), F.round("f.maximum", 12).alias("maximum"),
        F.round("f.mean", 9).alias("mean"),
    )


_QA_SQL = """select vec_id, round(std, 6) as std, round(clipping, 9) as clipping, round(seam, 6) as seam,
      case when std < 0.115 then 'near_constant' when clipping > 0.6 then 'severely_clipped' when seam > 0.08 then 'edge_seam' end as reject,
      array_to_string(list_filter([case when std < 0.12 then 'low_luminance_spread' end, case when clipping > 0.55 then 'elevated_clipping' end,
        case when seam > 0.08 then 'high_edge_seam' end], lambda s: s is not null), ',') as warnings
    from (select vec_id, sqrt(list_sum(list_transform(w, lambda x: (x - m) * (x - m))) / 64) as std, len(list_filter(w, lambda x: x <= 1e-5 or x >= 1.0::double - 1e-5)) / 64.0::double as clipping,
        (list_sum(list_transform(range(8), lambda i: abs(w[i * 8 + 1] - w[i * 8 + 8]))) / 8 + list_sum(list_transform(range(8), lambda i: abs(w[i + 1] - w[i + 57]))) / 8) / 2 as seam
      from (select *, list_sum(w) / 64 as m from (select vec_id, list_transform(v, lambda x: greatest(0.0::double, x * 2)) as w from v_vectors)))"""


@query("array_qa_gate", with_sql(_QA_SQL, B.SQL_VECTORS))
def _(t: Tables) -> DataFrame:
    """Thresholds are parameters here: the vectors are livelier than photographs."""
    scaled = F.transform("v", lambda x: F.greatest(F.lit(0.0), x * 2))
    gate = A.array_qa_gate(
        F.col("w"), tileable=True, min_std=0.115, warn_std=0.12, max_clipping=0.6, warn_clipping=0.55, max_seam=0.08
    )
    rows = B.vectors(t).select("vec_id", scaled.alias("w")).select("vec_id", gate.alias("g"))
    return rows.select(
        "vec_id", F.round("g.std", 6).alias("std"), F.round("g.clipping", 9).alias("clipping"), F.round("g.seam", 6).alias("seam"),
        "g.reject", F.array_join("g.warnings", ",").alias("warnings"),
    )


@query(
    "robust_normalize",
    """with q as (select event_type, quantile_cont(value, 0.05) as lo, quantile_cont(value, 0.95) as hi from events group by 1),
    x as (select event_id, pow(1 - least(1.0::double, greatest(0.0::double, (value - lo) / (hi - lo))), 1.5::double) as n from events join q using (event_type))
    select event_id, round(n * n * (3 - 2 * n), 7) as normalized from x""",
)
def _(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "value")
    out = O.robust_normalize(rows, "event_type", "value", 5, 95, invert=True, gamma=1.5, curve="smoothstep")
    return out.select("event_id", F.round("normalized", 7).alias("normalized"))


@query(
    "moment_transfer",
    with_sql(
        """select vec_id, cast(pos as integer) as pos, round(x * 0.4::double + ((x - s.m) * (p.d / s.d) + p.m) * 0.6::double, 7) as transferred
           from px join st s on s.label = px.label join st p on p.label = (px.label + 1) % (select max(label) + 1 from px)""",
        B.SQL_VECTORS,
        "px as (select vec_id, label, unnest(range(64)) as pos, unnest(v) as x from v_vectors)",
        "st as (select label, avg(x) as m, greatest(stddev_pop(x), 1e-5::double) as d from px group by label)",
    ),
)
def _(t: Tables) -> DataFrame:
    px = B.vectors(t).select("vec_id", "label", F.posexplode("v").alias("pos", "x"))
    labels = t.embeddings.agg(F.max("label") + 1).scalar()
    out = O.moment_transfer(
        px.withColumn("palette", (F.col("label") + 1) % labels), px, "label", "palette", "x", 0.6
    )
    return out.select("vec_id", "pos", F.round("transferred", 7).alias("transferred"))


@query(
    "weighted_blend",
    """select a.vec_id, cast(pos as integer) as pos, round(least(1.0::double, greatest(0.0::double, x * (pos / 63.0::double) + y * (1 - pos / 63.0::double))), 9) as mixed
       from (select vec_id, unnest(range(64)) as pos, unnest(list_transform(embedding, lambda e: e::double)) as x from embeddings) a
       join (select vec_id, unnest(range(64)) as pos, unnest(list_transform(embedding, lambda e: e::double)) as y from embeddings) b using (pos)
       where b.vec_id = (a.vec_id * 7 + 3) % (select count(*) from embeddings)""",
)
def _(t: Tables) -> DataFrame:
    v = B.vectors(t).select("vec_id", "v")
    total = t.embeddings.agg(F.count(F.lit(1))).scalar()
    pairs = v.withColumn("other", (F.col("vec_id") * 7 + 3) % total).join(
        v.select(F.col("vec_id").alias("other"), F.col("v").alias("w")), "other"
    )
    weight = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i / 63.0)
    mixed = A.weighted_blend(F.col("v"), F.col("w"), weight)
    rows = pairs.select("vec_id", F.posexplode(mixed).alias("pos", "mixed"))
    return rows.select("vec_id", "pos", F.round("mixed", 9).alias("mixed"))
