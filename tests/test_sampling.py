"""Draws, picks and placements: invariants and brute force."""

import hashlib

from pyspark.sql import functions as F

from slotwise.functions import hashing as H
from slotwise.operators import placement as P
from slotwise.operators import sampling as O


def uniform(*parts):
    text = ":".join(str(p) for p in parts)
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big") / float(2**64)


def test_seed_is_the_first_eight_bytes(spark):
    rows = spark.range(50).select("id", H.derive_seed(F.lit(3), F.col("id"), F.lit(0), F.lit("geometry")).alias("s")).collect()
    for r in rows:
        digest = hashlib.sha256(f"3:{r['id']}:0:geometry".encode()).digest()
        assert int(r["s"]) == int.from_bytes(digest[:8], "big")


def test_adding_an_effect_changes_no_other(spark):
    plans = spark.range(200).withColumnRenamed("id", "slot")
    seed = H.derive_seed(F.lit(1), F.col("slot"), F.lit("appearance"))
    base = [O.Effect("final", "blur", 0.5, "blur"), O.Effect("final", "noise", 0.3, "noise")]
    one = O.effect_activation(plans, seed, base)
    two = O.effect_activation(plans.repartition(6), seed, [O.Effect("final", "fog", 0.9, "fog"), *base]).where("id <> 'fog'")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_effect_ids_must_be_unique():
    try:
        O.effect_ids([O.Effect("final", "a", 1.0, "x"), O.Effect("final", "b", 1.0, "x")])
    except ValueError:
        return
    raise AssertionError("duplicate id accepted")


ASSETS = [
    # id, group, hash, roles, units
    (0, "g1", "aa", [], 2), (1, "g1", "aa", [], 1), (2, "g1", "bb", ["base", "detail"], 3), (3, "g1", "cc", ["detail"], 0),
    (4, "g2", "dd", [], 4), (5, "g2", "dd", ["accent"], 1), (6, "g3", "ee", ["base"], 5),
]
ROLES = [O.Role("base"), O.Role("detail", same_group_as="base", distinct_from=("base",)), O.Role("accent", group="g2", distinct_from=("base", "detail"))]


def brute_pick(plan, seed, allowed):
    """The same rules by listing all candidates in cumulative order."""
    anchor, picked, out = None, {}, {}
    pairs = set(allowed) | {(b, a) for a, b in allowed}
    for role in ROLES:
        scope = picked[role.same_group_as][1] if role.same_group_as and role.same_group_as in picked else role.group or anchor
        if role.same_group_as and role.same_group_as not in picked:
            scope = None
        if anchor and scope and anchor != scope and (anchor, scope) not in pairs:
            out[role.name] = (None, False, "cross_group_not_allowed")
            continue
        pool = [a for a in ASSETS if (scope is None or a[1] == scope) and (not a[3] or role.name in a[3])]
        gone = {picked[d][2] for d in role.distinct_from if d in picked}
        left = [a for a in pool if a[2] not in gone] or pool
        total = sum(a[4] for a in left)
        if not pool:
            out[role.name] = (None, False, "no_candidates")
            continue
        if total <= 0:
            out[role.name] = (None, False, "zero_weight")
            continue
        x = min(int(uniform(seed, plan, "role", role.name) * total), total - 1)
        for a in sorted(left, key=lambda a: (a[2], a[0])):
            if x < a[4]:
                break
            x -= a[4]
        out[role.name] = (a[0], any(p[2] == a[2] for p in picked.values()), "ok")
        picked[role.name] = a
        anchor = anchor or a[1]
    return out


def test_constrained_pick_equals_brute_force(spark):
    plans = spark.range(400).withColumnRenamed("id", "plan").repartition(5)
    assets = spark.createDataFrame(ASSETS, "asset_id int, `group` string, content_hash string, approved_roles array<string>, units bigint")
    for allowed in ([("g1", "g2")], [("g2", "g3"), ("g1", "g2")]):
        rows = O.constrained_pick(plans, "plan", assets, ROLES, allowed, 9).collect()
        got = {(r["plan"], r["role"]): (r["asset_id"], r["reused"], r["outcome"]) for r in rows}
        want = {(p, role): v for p in range(400) for role, v in brute_pick(p, 9, allowed).items()}
        assert got == want
    assert {v[2] for v in got.values()} >= {"ok", "no_candidates"}


def test_picks_do_not_depend_on_partitions(spark):
    assets = spark.createDataFrame([(i, f"{i * 7919 % 251:03x}", i % 5 + 1) for i in range(300)], "asset_id int, digest string, units bigint")
    iv = O.weighted_intervals(assets, [], "digest", ["asset_id"])
    plans = spark.range(1000).withColumnRenamed("id", "slot")
    u = H.hash_uniform(F.lit(1), F.col("slot"))
    a = O.weighted_pick(plans, iv, u).select("slot", "asset_id").collect()
    b = O.weighted_pick(plans.repartition(13), O.weighted_intervals(assets.repartition(9), [], "digest", ["asset_id"]), u)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b.select("slot", "asset_id").collect())) and len(a) == 1000


def test_overlap_counts_do_not_depend_on_the_grid(spark):
    rows = [(s, i, (i * 37 + s) % 300, (i * 53) % 300, (i * 37 + s) % 300 + 10 + i % 90, (i * 53) % 300 + 5 + i % 70) for s in range(3) for i in range(60)]
    frame = spark.createDataFrame(rows, "slot int, id int, x1 bigint, y1 bigint, x2 bigint, y2 bigint")
    small = sorted(map(tuple, P.overlap_pairs(frame, "slot", ["id"], cell=1000).collect()))
    large = sorted(map(tuple, P.overlap_pairs(frame, "slot", ["id"], cell=32).collect()))
    want = sorted(
        (a[0], a[1], sum(1 for b in rows if b[0] == a[0] and b[1] != a[1] and a[4] > b[2] and b[4] > a[2] and a[5] > b[3] and b[5] > a[3]))
        for a in rows
    )
    assert small == want and large == want
    flat = spark.createDataFrame([(1, 1, 0, 0, 10, 10), (1, 2, 5, 5, 20, 20), (1, 3, 5, 5, 5, 9)], "slot int, id int, x1 bigint, y1 bigint, x2 bigint, y2 bigint")
    assert sorted(map(tuple, P.overlap_pairs(flat, "slot", ["id"]).collect())) == [(1, 1, 1), (1, 2, 1), (1, 3, 0)]


def test_first_accepted_keeps_failures_and_exhausted_slots(spark):
    rows = spark.createDataFrame([(1, 0, False), (1, 1, True), (1, 2, True), (2, 0, False), (3, 0, True)], "slot int, attempt int, ok boolean")
    winners, rejections, exhausted = O.first_accepted(rows, 0, 3)
    assert sorted(map(tuple, winners.collect())) == [(1, 1), (3, 0)]
    assert sorted(map(tuple, rejections.collect())) == [(1, 0), (2, 0)]
    assert [r["slot"] for r in exhausted.collect()] == [2]


def test_overlaps_of_dealt_boxes_need_no_further_shuffle(spark):
    """Boxes dealt by slot stay where they are; boxes without area and with missing sides are counted with none."""
    rows = [(s, i, i * 3, i * 2, i * 3 + 40, i * 2 + 30) for s in range(4) for i in range(12)] + [(0, 90, 5, 5, 5, 9), (0, 91, None, 0, 9, 9)]
    frame = spark.createDataFrame(rows, "slot int, id int, x1 int, y1 int, x2 int, y2 int")
    plan = P.overlap_pairs(frame.repartition(8, "slot"), "slot", ["id"], cell=32)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    meets = lambda a, b: None not in a + b and a[2] < a[4] and b[2] < b[4] and a[4] > b[2] and b[4] > a[2] and a[5] > b[3] and b[5] > a[3]
    want = [(a[0], a[1], sum(a[0] == b[0] and a[1] != b[1] and meets(a, b) for b in rows)) for a in rows]
    assert sorted(map(tuple, plan.collect())) == sorted(want)
