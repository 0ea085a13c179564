"""Seeded sampling over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions import hashing as H
from slotwise.operators import placement as P
from slotwise.operators import sampling as O
from slotwise.operators import scale
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query

SEED = 42


def sql_u(*parts: str) -> str:
    text = " || ':' || ".join(parts)
    return f"(('0x' || substr(sha256({text}), 1, 16))::ubigint::double / 18446744073709551616.0::double)"


def plans(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("slot"), (F.col("o_custkey") % 3).alias("attempt"))


SQL_PLANS = "v_plans as (select o_orderkey as slot, o_custkey % 3 as attempt from orders)"


def u(stream: str) -> Column:
    return H.hash_uniform(F.lit(SEED), F.col("slot"), F.col("attempt"), F.lit(stream))


def sql_draw(stream: str) -> str:
    return sql_u(f"'{SEED}'", "slot", "attempt", f"'{stream}'")


@query(
    "derive_seed",
    with_sql(
        """select slot, attempt, cast(('0x' || substr(sha256('42:' || slot || ':' || attempt || ':geometry'), 1, 16))::ubigint as varchar) as seed,
             ('0x' || substr(sha256('42:' || slot || ':blur'), 1, 8))::bigint as effect_seed from v_plans""",
        SQL_PLANS,
    ),
)
def _(t: Tables) -> DataFrame:
    return plans(t).select(
        "slot", "attempt",
        H.derive_seed(F.lit(SEED), F.col("slot"), F.col("attempt"), F.lit("geometry")).cast("string").alias("seed"),
        H.derive_seed(F.lit(SEED), F.col("slot"), F.lit("blur"), nbytes=4).cast("bigint").alias("effect_seed"),
    )


@query("hash_uniform", with_sql(f"select slot, attempt, round({sql_draw('negative')}, 12) as u from v_plans", SQL_PLANS))
def _(t: Tables) -> DataFrame:
    return plans(t).select("slot", "attempt", F.round(u("negative"), 12).alias("u"))


def group_weights(t: Tables) -> DataFrame:
    """Weights of the brands 1 to 20; the others are not named, Brand#5, 10, 15 and 20 weigh 0."""
    key = F.col("n_nationkey")
    return t.nation.where((key >= 1) & (key <= 20)).select(
        F.concat(F.lit("Brand#"), key.cast("string")).alias("group"), (key % 5).cast("double").alias("weight")
    )


def asset_weights(t: Tables) -> DataFrame:
    return B.assets(t).where("size % 10 = 0").select("logical_path").distinct().withColumn("weight", F.lit(2.5))


def sql_intervals(missing: str) -> str:
    return f"""gw as (select 'Brand#' || n_nationkey as grp, (n_nationkey % 5)::double as w from nation where n_nationkey between 1 and 20),
      aw as (select distinct logical_path from v_assets where size % 10 = 0),
      un as (select a.*, cast(round(coalesce(gw.w, {missing}) * case when aw.logical_path is not null then 2.5::double else 1.0::double end * 1000000) as bigint) as units
        from v_assets a left join gw on gw.grp = a."group" left join aw on aw.logical_path = a.logical_path),
      iv as (select *, cast(sum(units) over (order by sha256(logical_path), asset_id) as bigint) as hi, cast(sum(units) over () as bigint) as span from un)"""


def sql_pick(stream: str) -> str:
    return f"""select p.slot, p.attempt, iv.asset_id, iv."group" from
      (select *, cast(least(floor({sql_draw(stream)} * (select max(span) from iv)), (select max(span) from iv) - 1) as bigint) as x from v_plans) p
      join iv on p.x >= iv.hi - iv.units and p.x < iv.hi"""


def pick(t: Tables, missing: float, stream: str) -> DataFrame:
    weighted = O.with_weights(B.assets(t), group_weights(t), asset_weights(t), missing)
    intervals = O.weighted_intervals(
        weighted.select("asset_id", "group", "content_hash", "units"), [], "content_hash", ["asset_id"]
    )
    return O.weighted_pick(plans(t), intervals, u(stream)).select("slot", "attempt", "asset_id", "group")


@query("weighted_pick", with_sql(sql_pick("foreground-assets"), B.SQL_ASSETS, SQL_PLANS, sql_intervals("0.0::double")))
def _(t: Tables) -> DataFrame:
    """Groups that are not named get weight 0, as the foreground and grouped background rules say."""
    return pick(t, 0.0, "foreground-assets")


@query(
    "weighted_pick_default",
    with_sql(sql_pick("background-assets"), B.SQL_ASSETS, SQL_PLANS, sql_intervals("1.0::double")),
)
def _(t: Tables) -> DataFrame:
    """Groups that are not named keep weight 1."""
    return pick(t, 1.0, "background-assets")


@query(
    "recipe_pick",
    with_sql(
        f"""select p.slot, p.attempt, iv.recipe from
          (select *, cast(least(floor({sql_draw('background-recipe')} * (select max(span) from iv)), (select max(span) from iv) - 1) as bigint) as x from v_plans) p
          join iv on p.x >= iv.hi - iv.units and p.x < iv.hi""",
        SQL_PLANS,
        """iv as (select n_name as recipe, n_regionkey * 1000000 as units, cast(sum(n_regionkey * 1000000) over (order by sha256(n_name)) as bigint) as hi,
             cast(sum(n_regionkey * 1000000) over () as bigint) as span from nation)""",
    ),
)
def _(t: Tables) -> DataFrame:
    recipes = t.nation.select(
        F.col("n_name").alias("recipe"), F.sha2("n_name", 256).alias("digest"),
        (F.col("n_regionkey").cast("bigint") * O.WEIGHT_UNITS).alias("units"),
    )
    intervals = O.weighted_intervals(recipes, [], "digest", ["recipe"])
    return O.weighted_pick(plans(t), intervals, u("background-recipe")).select("slot", "attempt", "recipe")


ROLES = (
    O.Role("base"),
    O.Role("detail", same_group_as="base", distinct_from=("base",)),
    O.Role("accent", group="Brand#3", distinct_from=("base", "detail")),
)
ALLOWED_PAIRS = tuple(("Brand#3", f"Brand#{i}") for i in range(10))


def role_assets(t: Tables) -> DataFrame:
    approved = F.when(F.col("size") % 4 == 0, F.array(F.lit("base"), F.lit("accent"))).when(
        F.col("size") % 4 == 1, F.array(F.lit("detail"))
    ).otherwise(F.array().cast("array<string>"))
    return B.assets(t).select(
        "asset_id", "group", "content_hash", approved.alias("approved_roles"),
        ((F.col("size") % 3) * O.WEIGHT_UNITS).cast("bigint").alias("units"),
    )


def _sql_role(name: str, source: str, test: str, gone: str) -> str:
    """Candidates of one role listed per plan, without the hashes picked before unless nothing else is left."""
    u = sql_u("'42'", "slot", "'role'", f"'{name}'")
    return f"""
{name}_c as (select s.slot, r.asset_id, r.grp, r.content_hash, r.units, {gone} as gone from {source} s join ra r on {test}),
{name}_s as (select slot, count(*) as n, count(*) filter (not gone) as n_left, cast(coalesce(sum(units) filter (not gone), 0) as bigint) as t_left, cast(sum(units) as bigint) as t_all from {name}_c group by slot),
{name}_o as (select s.slot, n, n_left = 0 as reuse, case when n_left = 0 then t_all else t_left end as room from {source} s left join {name}_s using (slot)),
{name}_x as (select c.*, cast(least(floor({u} * room), room - 1) as bigint) as x, sum(units) over (partition by slot order by content_hash, asset_id) as hi
  from {name}_c c join {name}_o o using (slot) where room > 0 and (reuse or not gone)),
{name}_p as (select slot, asset_id, grp, content_hash from {name}_x where x >= hi - units and x < hi)"""


SQL_ROLES = (
    B.SQL_ASSETS
    + ","
    + SQL_PLANS
    + """,
ra as (select asset_id, "group" as grp, content_hash, (size % 3) * 1000000 as units, size % 4 <> 1 as base_ok, size % 4 <> 0 as detail_ok from v_assets),
iv as (select *, sum(units) over (order by content_hash, asset_id) as hi, sum(units) over () as span from ra where base_ok),
base_p as (select p.slot, iv.asset_id, iv.grp, iv.content_hash from (select slot, cast(least(floor("""
    + sql_u("'42'", "slot", "'role'", "'base'")
    + """ * (select max(span) from iv)), (select max(span) from iv) - 1) as bigint) as x from v_plans) p join iv on p.x >= iv.hi - iv.units and p.x < iv.hi),"""
    + _sql_role("detail", "base_p", "r.grp = s.grp and r.detail_ok", "r.content_hash = s.content_hash")
    + """,
both_p as (select b.slot, b.grp, b.content_hash as h1, d.content_hash as h2 from base_p b left join detail_p d using (slot)),
open_p as (select * from both_p where grp in ("""
    + ", ".join(f"'Brand#{i}'" for i in range(10))
    + ")),"
    + _sql_role("accent", "open_p", "r.grp = 'Brand#3' and r.base_ok", "(r.content_hash = s.h1 or r.content_hash is not distinct from s.h2)")
)


@query(
    "constrained_pick",
    with_sql(
        """select slot, 'base' as role, asset_id, grp as "group", false as reused, 'ok' as outcome from base_p
           union all select o.slot, 'detail', p.asset_id, p.grp, coalesce(p.content_hash = b.content_hash, false),
             case when n is null then 'no_candidates' when room <= 0 then 'zero_weight' else 'ok' end
             from detail_o o join base_p b using (slot) left join detail_p p on p.slot = o.slot
           union all select b.slot, 'accent', p.asset_id, p.grp, coalesce(p.content_hash = b.h1 or p.content_hash = b.h2, false),
             case when b.grp not in ('Brand#0', 'Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5', 'Brand#6', 'Brand#7', 'Brand#8', 'Brand#9') then 'cross_group_not_allowed'
               when n is null then 'no_candidates' when room <= 0 then 'zero_weight' else 'ok' end
             from both_p b left join accent_o o on o.slot = b.slot left join accent_p p on p.slot = b.slot""",
        SQL_ROLES,
    ),
)
def _(t: Tables) -> DataFrame:
    picks = O.constrained_pick(plans(t).select("slot"), "slot", role_assets(t), ROLES, ALLOWED_PAIRS, SEED)
    return picks.select("slot", "role", "asset_id", "group", "reused", "outcome")


@query("negative_draw", with_sql(f"select slot, attempt, {sql_draw('negative')} < 0.15 as negative from v_plans", SQL_PLANS))
def _(t: Tables) -> DataFrame:
    return O.negative_draw(plans(t), u("negative"), 0.15)


DRAWS = O.DrawSpec(seed=SEED, out_w=1280, out_h=960, rotation_probability=0.7)


def _g(stream: str) -> str:
    return sql_draw(f"geometry:{stream}")


@query(
    "uniform_draws",
    with_sql(
        f"""select slot, attempt, round(crop_scale, 9) as crop_scale, round(camera_w, 6) as camera_w, round(camera_h, 6) as camera_h,
             round(least(greatest((1600 - camera_w) / 2 + (-0.1::double + {_g('jitter-x')} * 0.2::double) * camera_w, 1), 1600 - camera_w - 1), 6) as camera_x,
             round(least(greatest((1200 - camera_h) / 2 + (-0.1::double + {_g('jitter-y')} * 0.2::double) * camera_h, 1), 1200 - camera_h - 1), 6) as camera_y,
             cast(1 + floor({_g('count')} * 10) as bigint) as objects, round(0.1::double + {_g('size')} * 0.3::double, 9) as size,
             case when {_g('rotate')} <= 0.7 then round(-180 + {_g('angle')} * 360.0::double, 6) else 0 end as rotation
           from (select *, least(1440.0::double, 1280 * crop_scale) as camera_w, least(1080.0::double, 960 * crop_scale) as camera_h
                 from (select *, 0.8::double + {_g('crop')} * 0.2::double as crop_scale from v_plans))""",
        SQL_PLANS,
    ),
)
def _(t: Tables) -> DataFrame:
    out = O.uniform_draws(plans(t), DRAWS)
    digits = {"crop_scale": 9, "camera_w": 6, "camera_h": 6, "camera_x": 6, "camera_y": 6, "size": 9, "rotation": 6}
    for name, d in digits.items():
        out = out.withColumn(name, F.round(name, d))
    return out


@query(
    "plan_grid",
    with_sql(
        """select job, slot, a as attempt, count(*) as tries from v_jobs, unnest(range(num_images)) as s(slot),
             unnest(range(2)) as x(a), unnest(range(3)) as y(o), unnest(range(4)) as z(r) group by all""",
        B.SQL_JOBS,
    ),
)
def _(t: Tables) -> DataFrame:
    slots = scale.numbered_rows(B.jobs(t).select("job", "num_images"), "num_images", "slot", 2 * 3 * 4)
    grid = O.plan_grid(slots, 2, 3, 4)
    # Images and chunk belong to the job and the slot; with them the tries of a slot are where they were listed.
    counted = grid.groupBy("job", "num_images", scale.CHUNK, "slot", "attempt").agg(F.count(F.lit(1)).alias("tries"))
    return counted.select("job", "slot", F.col("attempt").cast("bigint").alias("attempt"), "tries")


def placement_tries(t: Tables) -> DataFrame:
    """Each order is a slot; its lines are the tries of its objects, three tries each."""
    pos = F.col("instance_pos") - 1
    return B.annotations(t).select(
        F.col("sample_id").alias("slot"), F.floor(pos / 3).cast("int").alias("object"), (pos % 3).cast("int").alias("try"),
        F.col("x1"), F.col("y1"), (F.col("x1") + (F.col("x2") - F.col("x1")) * 3).alias("x2"),
        (F.col("y1") + (F.col("y2") - F.col("y1")) * 3).alias("y2"),
    )


SQL_TRIES = (
    B.SQL_ANNOTATIONS
    + """,
v_tries as (
  select sample_id as slot, (instance_pos - 1) // 3 as object, (instance_pos - 1) % 3 as try, instance_pos as i,
    x1, y1, x1 + (x2 - x1) * 3 as x2, y1 + (y2 - y1) * 3 as y2 from v_annotations)"""
)


@query(
    "greedy_placement",
    with_sql(
        """select slot, object, max(case when kind = 1 then try end) as accepted_try, cast(sum(blockers) as bigint) as blocking_count,
             cast(count(*) as integer) as placement_attempts,
             min(blockers * 1000 + try) filter (kind = 2) // 1000 as best_blockers
           from r where kind > 0 group by slot, object""",
        SQL_TRIES,
        """r as (
          select slot, 0 as i, -1 as object, -1 as try, 0 as blockers, 0 as kind, -1 as placed,
            cast([] as struct(x1 bigint, y1 bigint, x2 bigint, y2 bigint)[]) as occ from (select distinct slot from v_tries)
          union all
          select slot, i, object, try, blockers, case when done then 0 when blockers = 0 then 1 else 2 end,
            case when not done and blockers = 0 then object else placed end,
            case when not done and blockers = 0 then list_append(occ, {'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}) else occ end
          from (select t.*, r.occ, r.placed, r.placed = t.object as done,
                  len(list_filter(r.occ, lambda o: o.x2 > t.x1 and t.x2 > o.x1 and o.y2 > t.y1 and t.y2 > o.y1)) as blockers
                from r join v_tries t on t.slot = r.slot and t.i = r.i + 1))""",
        recursive=True,
    ),
)
def _(t: Tables) -> DataFrame:
    placed = P.greedy_placement(placement_tries(t))
    return placed.select(
        "slot", "object", "accepted_try", "blocking_count", "placement_attempts",
        F.col("best_failed.blockers").alias("best_blockers"),
    )


@query(
    "first_accepted",
    with_sql(
        """select slot, attempt, 'winner' as kind from (select slot, min(attempt) as attempt from v_slots where ok and attempt < 8 group by slot)
           union all select s.slot, s.attempt, 'rejection' from v_slots s left join (select slot, min(attempt) as w from v_slots where ok and attempt < 8 group by slot) w on w.slot = s.slot
             where s.attempt < 8 and (w is null or s.attempt < w)
           union all select distinct slot, null::bigint, 'exhausted' from v_slots where slot not in (select slot from v_slots where ok and attempt < 8)""",
        B.SQL_SLOTS,
    ),
)
def _(t: Tables) -> DataFrame:
    winners, rejections, exhausted = O.first_accepted(B.slots(t), 0, 8)
    return (
        winners.withColumn("kind", F.lit("winner"))
        .unionByName(rejections.withColumn("kind", F.lit("rejection")))
        .unionByName(exhausted.withColumn("kind", F.lit("exhausted")), allowMissingColumns=True)
    )


@query(
    "first_accepted_waves",
    with_sql(
        """select slot, attempt, 'winner' as kind from (select slot, min(attempt) as attempt from v_slots where ok and attempt < 8 group by slot)
           union all select s.slot, s.attempt, 'rejection' from v_slots s left join (select slot, min(attempt) as w from v_slots where ok and attempt < 8 group by slot) w on w.slot = s.slot
             where s.attempt < 8 and (w is null or s.attempt < w)
           union all select distinct slot, null::bigint, 'exhausted' from v_slots where slot not in (select slot from v_slots where ok and attempt < 8)""",
        B.SQL_SLOTS,
    ),
)
def _(t: Tables) -> DataFrame:
    """Attempts are looked up only while their slot is open."""
    known = B.slots(t)
    plan = lambda asked: asked.join(known, ["slot", "attempt"])
    winners, rejections, exhausted, _ = O.first_accepted_waves(known.select("slot"), plan, 0, 8)
    return (
        winners.withColumn("kind", F.lit("winner"))
        .unionByName(rejections.withColumn("kind", F.lit("rejection")))
        .unionByName(exhausted.withColumn("kind", F.lit("exhausted")), allowMissingColumns=True)
        .withColumn("attempt", F.col("attempt").cast("bigint"))
    )


EFFECTS = (
    O.Effect("background", "GaussNoise", 0.3),
    O.Effect("background", "RandomGamma", 0.5),
    O.Effect("foreground", "MotionBlur", 0.2, "blur"),
    O.Effect("final", "AtmosphericFog", 1.0),
)


@query(
    "effect_activation",
    with_sql(
        f"""select slot, stage, id, ('0x' || substr(sha256(s || ':' || stage || ':' || id), 1, 8))::bigint as seed,
              {sql_u('s', 'stage', 'id', "'activation'")} <= probability as applied
           from (select slot, cast(('0x' || substr(sha256('42:' || slot || ':' || attempt || ':appearance'), 1, 16))::ubigint as varchar) as s from v_plans),
             (values ('background', '00-GaussNoise', 0.3::double), ('background', '01-RandomGamma', 0.5::double), ('foreground', 'blur', 0.2::double), ('final', '00-AtmosphericFog', 1.0::double)) e(stage, id, probability)""",
        SQL_PLANS,
    ),
)
def _(t: Tables) -> DataFrame:
    seed = H.derive_seed(F.lit(SEED), F.col("slot"), F.col("attempt"), F.lit("appearance"))
    return O.effect_activation(plans(t), seed, EFFECTS).drop("attempt")


@query(
    "variant_expand",
    with_sql(
        """select job, variant, workers, case when variant = 'large' then 2.0 when variant = 'tiny' then 0.5 else scale end as scale,
             fingerprint || '-' || variant as label,
             sha256(sha256(fingerprint) || ':' || variant || ':{"scale":' || case variant when 'large' then '2.0' when 'tiny' then '0.5' else case when scale = 1 then '1.0' else '1.5' end end || '}') as contract
           from (select *, case when workers % 2 = 0 then 1.0::double else 1.5::double end as scale from v_jobs), (values ('base'), ('large'), ('tiny')) v(variant)""",
        B.SQL_JOBS,
    ),
)
def _(t: Tables) -> DataFrame:
    rows = B.jobs(t).select(
        "job", "workers", F.when(F.col("workers") % 2 == 0, 1.0).otherwise(1.5).alias("scale"),
        F.col("fingerprint").alias("label"), F.sha2("fingerprint", 256).alias("contract"),
    )
    return O.variant_expand(rows, "label", "contract", {"base": {}, "large": {"scale": 2.0}, "tiny": {"scale": 0.5}})


@query(
    "sample_identity",
    """select o_orderkey as slot, printf('pool_%06d_', o_orderkey) || substr(sha256('run-' || (o_custkey % 2) || ':' || o_orderkey), 1, 8) as sample_id,
         printf('pool_%06d_', o_orderkey) || substr(sha256('run-' || (o_custkey % 2) || ':' || o_orderkey), 1, 8) ||
           case when o_custkey % 3 = 0 then '.jpg' else '.png' end as file_name from orders""",
)
def _(t: Tables) -> DataFrame:
    run = F.concat(F.lit("run-"), (F.col("o_custkey") % 2).cast("string"))
    sample_id = H.sample_identity("pool", run, F.col("o_orderkey"))
    fmt = F.when(F.col("o_custkey") % 3 == 0, "jpeg").otherwise("png")
    return t.orders.select(
        F.col("o_orderkey").alias("slot"), sample_id.alias("sample_id"), H.image_file_name(sample_id, fmt).alias("file_name")
    )


@query("qa_pick", "select o_orderkey as slot, o_custkey as job from orders order by slot limit 25")
def _(t: Tables) -> DataFrame:
    return O.qa_pick(t.orders.select(F.col("o_orderkey").alias("slot"), F.col("o_custkey").alias("job")), 25)
