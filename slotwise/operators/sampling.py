"""Seeded plan generation: draws, weighted picks, retries and activations.

Every draw hashes its own address (seed, slot, attempt, stream), so adding a slot, an
effect or a partition never changes another draw. Weights are counted in integer
millionths, which makes cumulative sums exact in any order of addition.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.hashing import derive_seed, hash_uniform
from slotwise.operators.scale import hash_prefix_bucket, interval_lookup, join_null_safe, running
from slotwise.session import settle

WEIGHT_UNITS = 1_000_000


def plan_grid(slots: DataFrame, attempts: int, objects: int, tries: int) -> DataFrame:
    """slots x attempts x objects x placement tries, expanded row by row."""
    grid = slots
    for name, count in (("attempt", attempts), ("object", objects), ("try", tries)):
        grid = grid.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    return grid


def negative_draw(plans: DataFrame, u: Column, fraction: float) -> DataFrame:
    """Mark intentional negatives; the comparison is strict."""
    return plans.withColumn("negative", u < fraction)


def uniform_between(u: Column, low, high) -> Column:
    return low + u * (high - low)


def integer_between(u: Column, low: int, high: int) -> Column:
    """Integer in [low, high], both ends included."""
    return (F.lit(low) + F.floor(u * (high - low + 1))).cast("bigint")


@dataclass(frozen=True)
class DrawSpec:
    """Ranges of the geometry draws of one profile."""

    seed: int
    out_w: int
    out_h: int
    canvas_scale: float = 1.25
    crop_scale: tuple[float, float] = (0.8, 1.0)
    jitter_x: tuple[float, float] = (-0.1, 0.1)
    jitter_y: tuple[float, float] = (-0.1, 0.1)
    objects: tuple[int, int] = (1, 10)
    size: tuple[float, float] = (0.1, 0.4)
    rotation: tuple[float, float] = (-180.0, 180.0)
    rotation_probability: float = 1.0


def uniform_draws(plans: DataFrame, spec: DrawSpec, slot: str = "slot", attempt: str = "attempt") -> DataFrame:
    """Camera window, object count, size and rotation of each plan."""

    def u(stream: str) -> Column:
        return hash_uniform(F.lit(spec.seed), F.col(slot), F.col(attempt), F.lit(f"geometry:{stream}"))

    scene_w = float(max(spec.out_w + 2, -int(-spec.out_w * spec.canvas_scale // 1)))
    scene_h = float(max(spec.out_h + 2, -int(-spec.out_h * spec.canvas_scale // 1)))
    frame = plans.withColumn("crop_scale", uniform_between(u("crop"), *spec.crop_scale))
    frame = frame.withColumn("camera_w", F.least(F.lit(scene_w * 0.9), spec.out_w * F.col("crop_scale")))
    frame = frame.withColumn("camera_h", F.least(F.lit(scene_h * 0.9), spec.out_h * F.col("crop_scale")))
    jx = uniform_between(u("jitter-x"), *spec.jitter_x) * F.col("camera_w")
    jy = uniform_between(u("jitter-y"), *spec.jitter_y) * F.col("camera_h")

    def window(size: float, camera: str, shift: Column) -> Column:
        start = (F.lit(size) - F.col(camera)) / 2.0 + shift
        return F.least(F.greatest(start, F.lit(1.0)), F.lit(size) - F.col(camera) - 1.0)

    rotated = u("rotate") <= spec.rotation_probability
    return (
        frame.withColumn("camera_x", window(scene_w, "camera_w", jx))
        .withColumn("camera_y", window(scene_h, "camera_h", jy))
        .withColumn("objects", integer_between(u("count"), *spec.objects))
        .withColumn("size", uniform_between(u("size"), *spec.size))
        .withColumn("rotation", F.when(rotated, uniform_between(u("angle"), *spec.rotation)).otherwise(0.0))
    )


def with_weights(
    assets: DataFrame,
    group_weights: DataFrame | None,
    asset_weights: DataFrame | None,
    missing_group_weight: float = 0.0,
) -> DataFrame:
    """Attach integer weight units: group weight times asset weight.

    Without group weights every group counts 1; with them a group that is not named
    gets ``missing_group_weight``. Assets default to 1.
    """
    frame = assets
    group = F.lit(1.0)
    if group_weights is not None:
        frame = frame.join(group_weights.select("group", F.col("weight").alias("__gw")), "group", "left")
        group = F.coalesce("__gw", F.lit(missing_group_weight))
    single = F.lit(1.0)
    if asset_weights is not None:
        frame = frame.join(asset_weights.select("logical_path", F.col("weight").alias("__aw")), "logical_path", "left")
        single = F.coalesce("__aw", F.lit(1.0))
    units = F.round(group * single * WEIGHT_UNITS).cast("bigint")
    return frame.withColumn("units", units).drop("__gw", "__aw")


@dataclass(frozen=True)
class Intervals:
    """Assets laid end to end per key: rows with [lo, hi), and span and count of every key."""

    rows: DataFrame
    totals: DataFrame
    keys: tuple[str, ...]

    def sized(self, frame: DataFrame, how: str = "inner") -> DataFrame:
        """Attach ``span`` and ``bins`` of the frame's key; one scalar when there is no key."""
        if self.keys:
            return join_null_safe(frame, self.totals, list(self.keys), how)
        total = self.totals.select(F.struct("span", "bins")).scalar()
        return frame.withColumn("__t", total).select("*", "__t.span", "__t.bins").drop("__t")


def weighted_intervals(assets: DataFrame, keys: Sequence[str], digest: str, order: Sequence[str]) -> Intervals:
    """Lay the assets of each key end to end in weight units.

    ``digest`` is a hex hash column that leads the order; its prefix cuts large keys.
    """
    keys = list(keys)
    laid = running(assets, keys, hash_prefix_bucket(F.col(digest)), [digest, *order], {"hi": F.col("units")})
    laid = laid.withColumn("hi", F.col("hi").cast("bigint")).withColumn("lo", F.col("hi") - F.col("units"))
    totals = assets.groupBy(*keys).agg(
        F.sum("units").cast("bigint").alias("span"), F.count(F.lit(1)).alias("bins")
    )
    return Intervals(laid, totals, tuple(keys))


def weighted_pick(plans: DataFrame, intervals: Intervals, u: Column) -> DataFrame:
    """One asset per plan, by weight."""
    placed = intervals.sized(plans).where("span > 0")
    placed = placed.withColumn("__point", F.least(F.floor(u * F.col("span")), F.col("span") - 1))
    rows = intervals.sized(intervals.rows)
    found = interval_lookup(placed, rows, intervals.keys, "__point", "lo", "hi", "span", "bins")
    return found.drop("__point", "lo", "hi", "span", "bins", "units")


@dataclass(frozen=True)
class Role:
    """One asset role of a recipe."""

    name: str
    group: str | None = None
    same_group_as: str | None = None
    distinct_from: tuple[str, ...] = field(default_factory=tuple)


def constrained_pick(
    plans: DataFrame,
    plan: str,
    assets: DataFrame,
    roles: Sequence[Role],
    allowed_pairs: Sequence[tuple[str, str]],
    seed: int,
) -> DataFrame:
    """One asset per role and plan under group, approval and distinctness rules.

    assets[asset_id, group, content_hash, approved_roles, units]. The copies of one
    content hash lie side by side in the cumulative order, so leaving out an earlier
    pick removes one interval: the draw is made on the shortened range and shifted past
    the gaps. When nothing distinct is left the full range is used and the pick is
    marked as reused. Outcomes other than ``ok`` name the rule that failed.
    """
    pairs = [*allowed_pairs, *[(b, a) for a, b in allowed_pairs]]
    state = plans.select(plan).withColumn("anchor", F.lit(None).cast("string"))
    picked: list[str] = []
    for role in roles:
        if role.same_group_as:
            wanted = F.col(f"{role.same_group_as}_group")
        elif role.group is not None:
            wanted = F.lit(role.group)
        else:
            wanted = F.col("anchor")
        approved = assets.where((F.size("approved_roles") == 0) | F.array_contains("approved_roles", role.name))
        columns = ["asset_id", "group", "content_hash", "units"]
        named = role.group is not None and not role.same_group_as
        if named:
            scoped, keys = approved.where(F.col("group") == role.group).select(*columns), []
        elif not picked:
            scoped, keys = approved.select(*columns), []
        else:
            scoped, keys = approved.select(*columns, F.col("group").alias("scope")), ["scope"]
        intervals = weighted_intervals(scoped, keys, "content_hash", ["asset_id"])
        hashes = intervals.rows.groupBy(*keys, "content_hash").agg(
            F.min("lo").alias("h_lo"), F.max("hi").alias("h_hi"), F.count(F.lit(1)).alias("h_n")
        )
        current = state.withColumn("scope", wanted)
        crossing = F.col("anchor").isNotNull() & F.col("scope").isNotNull() & (F.col("scope") != F.col("anchor"))
        permitted = F.lit(False)
        for a, b in pairs:
            permitted = permitted | ((F.col("anchor") == a) & (F.col("scope") == b))
        blocked = crossing & ~permitted
        current = intervals.sized(current, "left")
        gaps = []
        for earlier in role.distinct_from:
            renamed = hashes.select(
                *keys, F.col("content_hash").alias(f"{earlier}_hash"),
                F.struct("h_lo", "h_hi", "h_n").alias(f"__gap_{earlier}"),
            )
            current = join_null_safe(current, renamed, [*keys, f"{earlier}_hash"], "left")
            gaps.append(f"__gap_{earlier}")
        gap_list = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.col(g) for g in gaps])))) if gaps else F.array().cast(
            "array<struct<h_lo:bigint,h_hi:bigint,h_n:bigint>>"
        )
        current = current.withColumn("__gaps", gap_list).drop(*gaps)
        zero = F.lit(0).cast("bigint")
        gone_units = F.aggregate("__gaps", zero, lambda s, g: s + g["h_hi"] - g["h_lo"])
        gone_count = F.aggregate("__gaps", zero, lambda s, g: s + g["h_n"])
        current = current.withColumn("__reuse", (F.col("bins") - gone_count) <= 0)
        room = F.when(F.col("__reuse"), F.col("span")).otherwise(F.col("span") - gone_units)
        current = current.withColumn("__room", room)
        u = hash_uniform(F.lit(seed), F.col(plan), F.lit("role"), F.lit(role.name))
        start = F.least(F.floor(u * F.col("__room")), F.col("__room") - 1)
        point = F.when(F.col("__reuse"), start).otherwise(
            F.aggregate("__gaps", start, lambda x, g: F.when(x >= g["h_lo"], x + g["h_hi"] - g["h_lo"]).otherwise(x))
        )
        current = current.withColumn(
            f"{role.name}_outcome",
            F.when(blocked, "cross_group_not_allowed")
            .when(F.coalesce("bins", F.lit(0)) == 0, "no_candidates")
            .when(F.col("__room") <= 0, "zero_weight")
            .otherwise("ok"),
        ).withColumn("__point", point)
        # A failed rule leaves no point to look up; the left join keeps such plans.
        current = current.withColumn("__point", F.when(F.col(f"{role.name}_outcome") == "ok", F.col("__point")))
        choices = intervals.sized(intervals.rows).select(
            *keys, "lo", "hi", "span", "bins", F.col("asset_id").alias(f"{role.name}_asset"),
            F.col("group").alias(f"{role.name}_group"), F.col("content_hash").alias(f"{role.name}_hash"),
        )
        state = interval_lookup(current, choices, keys, "__point", "lo", "hi", "span", "bins", "left").drop("lo", "hi")
        earlier_hashes = [F.col(f"{p}_hash") for p in picked]
        reused = F.lit(False)
        for h in earlier_hashes:
            reused = reused | F.coalesce(h == F.col(f"{role.name}_hash"), F.lit(False))
        state = state.withColumn(f"{role.name}_reused", reused).withColumn(
            "anchor", F.coalesce("anchor", f"{role.name}_group")
        )
        state = state.drop("scope", "span", "bins", "__gaps", "__reuse", "__room", "__point")
        picked.append(role.name)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("role"), F.col(f"{r.name}_asset").alias("asset_id"),
                    F.col(f"{r.name}_group").alias("group"), F.col(f"{r.name}_hash").alias("content_hash"),
                    F.col(f"{r.name}_reused").alias("reused"), F.col(f"{r.name}_outcome").alias("outcome"),
                )
                for r in roles
            ]
        )
    )
    return state.select(plan, rows.alias("p")).select(plan, "p.*")


def first_accepted(attempts: DataFrame, start: int, max_attempts: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """First passing attempt per slot, the failures before it, and slots without any.

    attempts[slot, attempt, ok]; only attempts in [start, start + max_attempts) count.
    """
    tried = attempts.where((F.col("attempt") >= start) & (F.col("attempt") < start + max_attempts))
    best = tried.groupBy("slot").agg(F.min(F.when(F.col("ok"), F.col("attempt"))).alias("winner"))
    winners = best.where("winner is not null").select("slot", F.col("winner").alias("attempt"))
    rejections = (
        tried.join(best, "slot")
        .where(F.col("winner").isNull() | (F.col("attempt") < F.col("winner")))
        .select("slot", "attempt")
    )
    exhausted = attempts.select("slot").distinct().join(winners, "slot", "left_anti")
    return winners, rejections, exhausted


def first_accepted_waves(
    slots: DataFrame, plan: Callable[[DataFrame], DataFrame], start: int, max_attempts: int, wave: int = 1
) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The same in waves: attempts are planned only for slots that are still open.

    ``plan`` takes [slot, attempt] and adds ``ok``; an attempt it does not return counts as not made. Every wave plans
    ``wave`` more attempts for each open slot, settles them, and keeps the slots without a passing one, so the attempts
    planned are those accepted, those rejected and at most ``wave`` - 1 a slot beyond. The last value is their number.
    """
    open_slots, settled, planned, at = slots.select("slot").distinct(), [], 0, start
    while at < start + max_attempts and (left := open_slots.count()):
        width = min(wave, start + max_attempts - at)
        asked = open_slots.select("slot", F.explode(F.sequence(F.lit(at), F.lit(at + width - 1))).alias("attempt"))
        tried = settle(plan(asked).select("slot", "attempt", "ok"))
        settled.append(tried)
        open_slots = settle(open_slots.join(tried.where("ok").select("slot"), "slot", "left_anti"))
        planned, at = planned + left * width, at + width
    tried = slots.select("slot", F.lit(start).alias("attempt"), F.lit(None).cast("boolean").alias("ok")).limit(0)
    for part in settled:
        tried = tried.unionByName(part)
    winners, rejections, _ = first_accepted(tried, start, max_attempts)
    return winners, rejections, slots.select("slot").distinct().join(winners, "slot", "left_anti"), planned


@dataclass(frozen=True)
class Effect:
    stage: str
    kind: str
    probability: float
    id: str | None = None


def effect_ids(effects: Sequence[Effect]) -> list[tuple[str, str, float]]:
    """(stage, id, probability); an effect without id is named by its place in the stage."""
    seen: set[tuple[str, str]] = set()
    places: dict[str, int] = {}
    rows = []
    for effect in effects:
        place = places.get(effect.stage, 0)
        places[effect.stage] = place + 1
        name = effect.id or f"{place:02d}-{effect.kind}"
        if (effect.stage, name) in seen:
            raise ValueError(f"duplicate effect id {name} in stage {effect.stage}")
        seen.add((effect.stage, name))
        rows.append((effect.stage, name, effect.probability))
    return rows


def effect_activation(plans: DataFrame, appearance_seed: Column, effects: Sequence[Effect]) -> DataFrame:
    """One row per plan and effect with the effect's own seed and whether it applies."""
    listed = F.array(
        *[
            F.struct(F.lit(s).alias("stage"), F.lit(i).alias("id"), F.lit(p).alias("probability"))
            for s, i, p in effect_ids(effects)
        ]
    )
    rows = plans.withColumn("__seed", appearance_seed).withColumn("e", F.explode(listed))
    address = (F.col("__seed").cast("string"), F.col("e.stage"), F.col("e.id"))
    return rows.select(
        *plans.columns, "e.stage", "e.id",
        derive_seed(*address, nbytes=4).cast("bigint").alias("seed"),
        (hash_uniform(*address, F.lit("activation")) <= F.col("e.probability")).alias("applied"),
    )


def variant_expand(plans: DataFrame, label: str, contract: str, variants: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Each plan once per named overlay: same draws, suffixed label, new contract hash."""
    names = sorted({key for overlay in variants.values() for key in overlay})
    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("variant"),
                *[F.lit(overlay.get(n)).cast("double").alias(n) for n in names],
            )
            for name, overlay in variants.items()
        ]
    )
    rows = plans.withColumn("v", F.explode(listed))
    overlay = [F.coalesce(F.col(f"v.{n}"), F.col(n)).alias(n) for n in names]
    kept = [c for c in plans.columns if c not in (label, contract, *names)]
    return rows.select(
        *kept, "v.variant", *overlay,
        F.concat_ws("-", F.col(label), F.col("v.variant")).alias(label),
        F.sha2(F.concat_ws(":", F.col(contract), F.col("v.variant"), F.to_json(F.struct(*overlay))), 256).alias(contract),
    )


def qa_pick(accepted: DataFrame, n: int, order: str = "slot") -> DataFrame:
    """The first n accepted samples in commit order."""
    return accepted.orderBy(order).limit(n)
