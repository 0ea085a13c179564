"""Preflight estimates over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators import preflight as O
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query

COST_COLUMNS = ["fingerprint", "height", "image_format", "max_instances", "width"]


@query(
    "cost_fingerprint",
    with_sql(
        """select job, sha256('{"fingerprint":"' || fingerprint || '","height":' || height || ',"image_format":"' || image_format || '","max_instances":' || max_instances || ',"width":' || width || '}') as fingerprint from v_jobs""",
        B.SQL_JOBS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.cost_fingerprint(B.jobs(t), COST_COLUMNS).select("job", "fingerprint")


PROFILES = list(O.PRIORS)


def profiled_jobs(t: Tables) -> DataFrame:
    """Jobs with a known or unknown profile and a family."""
    listed = F.array(*[F.lit(p) for p in [*PROFILES, "local:a", "local:b"]])
    family = F.when(F.col("job") % 3 == 0, "landing").otherwise("manometro")
    return B.jobs(t).select("*", listed[(F.col("job") % 8).cast("int")].alias("profile"), family.alias("family"))


SQL_MATCHED = (
    B.SQL_JOBS
    + ","
    + B.SQL_OBSERVATIONS
    + """,
x as (select fingerprint, environment, workers, count(*) as rows, count(*) filter (kind = 'production') as production, count(*) filter (kind = 'probe') as probes, median(seconds) filter (kind = 'production') as pm,
    avg(seconds) filter (kind = 'probe') as bm, min(seconds) filter (kind = 'production') as lo, max(seconds) filter (kind = 'production') as hi from v_observations group by all),
y as (select fingerprint, environment, count(*) as rows, count(*) filter (kind = 'production') as production, count(*) filter (kind = 'probe') as probes, median(seconds) filter (kind = 'production') as pm,
    avg(seconds) filter (kind = 'probe') as bm, min(seconds) filter (kind = 'production') as lo, max(seconds) filter (kind = 'production') as hi from v_observations group by all),
v_matched as (select j.*, case when x.rows is not null then 'exact' when y.rows is not null then 'cross-worker' else 'none' end as tier,
    coalesce(x.rows, y.rows, 0) as rows, case when x.rows is not null then x.production else coalesce(y.production, 0) end as production,
    case when x.rows is not null then x.probes else coalesce(y.probes, 0) end as probes, case when x.rows is not null then x.pm else y.pm end as pm,
    case when x.rows is not null then x.bm else y.bm end as bm, case when x.rows is not null then x.lo else y.lo end as lo, case when x.rows is not null then x.hi else y.hi end as hi
  from v_jobs j left join x on x.fingerprint = j.fingerprint and x.environment = j.environment and x.workers = j.workers left join y on y.fingerprint = j.fingerprint and y.environment = j.environment)"""
)


def matched(t: Tables) -> DataFrame:
    return O.match_observations(profiled_jobs(t), B.observations(t))


@query(
    "match_observations",
    with_sql("select job, tier, rows, production, probes, round(pm, 6) as production_median, round(bm, 6) as probe_mean from v_matched", SQL_MATCHED),
)
def _(t: Tables) -> DataFrame:
    return matched(t).select(
        "job", "tier", "rows", "production", "probes", F.round("production_median", 6).alias("production_median"),
        F.round("probe_mean", 6).alias("probe_mean"),
    )


_SECONDS = " ".join(
    f"when job % 8 = {i} then case when job % 3 = 0 then {values['landing']}::double else {values['manometro']}::double end"
    for i, (_, values) in enumerate(O.PRIORS.values())
)
_LEVEL = " ".join(f"when job % 8 = {i} then '{level}'" for i, (level, _) in enumerate(O.PRIORS.values()))
_LOW = " ".join(f"when '{n}' then {a}::double" for n, (a, _) in O.BANDS.items())
_HIGH = " ".join(f"when '{n}' then {b}::double" for n, (_, b) in O.BANDS.items())


@query(
    "runtime_estimate",
    with_sql(
        f"""select job, round(e * case confidence {_LOW} end, 8) as lower_seconds, round(e, 8) as expected_seconds, round(e * case confidence {_HIGH} end, 8) as upper_seconds,
              confidence, round(per, 8) as seconds_per_candidate, case when production > 0 then production else probes end as observation_count
            from (select *, per * num_images / greatest(1.0::double, workers * case when workers > 1 then 0.82::double else 1.0::double end) as e from (
              select *, case when production > 0 then pm when probes > 0 then bm when job % 8 < 6 then (case {_SECONDS} end) * greatest(0.1::double, mp / 1.6384::double) else greatest(0.25::double, mp) end as per,
                case when production > 0 and tier = 'cross-worker' then 'local-production-cross-worker' when production >= 3 then 'local-production' when production > 0 then 'local-production-low-sample'
                  when probes > 0 then 'local-probe' else coalesce(case {_LEVEL} end, 'low') end as confidence
              from (select *, width * height / 1e6::double as mp from v_matched)))""",
        SQL_MATCHED,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.runtime_estimate(matched(t), digits=(8, 8))  # fewer digits meet decimal ties, which engines break differently


@query(
    "observation_warnings",
    with_sql(
        """select job, 'LOCAL_OBSERVATION_CROSS_WORKER' as code from v_matched where tier = 'cross-worker'
           union all select job, 'LOCAL_OBSERVATION_LOW_SAMPLE' from v_matched where production between 1 and 2
           union all select job, 'LOCAL_OBSERVATION_OUT_OF_RANGE' from v_matched where production >= 2 and hi / greatest(lo, 1e-9) > 4""",
        SQL_MATCHED,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.observation_warnings(matched(t))


@query(
    "disk_estimate",
    with_sql(
        """select job, i as image_bytes, m as mask_bytes, d as metadata_bytes, i + m + d as output_bytes, free_bytes >= i + m + d + 67108864 as sufficient
           from (select *, cast(trunc(px * 3 * num_images * case when image_format = 'png' then 1.1::double else 0.6::double end) as bigint) as i,
               cast(trunc(px * max_instances * 0.25::double * num_images) as bigint) as m, num_images * 65536 as d from (select *, width::bigint * height as px from v_jobs))""",
        B.SQL_JOBS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.disk_estimate(B.jobs(t))


@query(
    "receipt_check",
    """select c_custkey as job, case when c_custkey % 5 = 0 then 'RECEIPT_MISSING' else 'RECEIPT_MISMATCH' end as code from customer
       where c_nationkey % 3 = 0 and c_custkey % 2 = 0 and (c_custkey % 5 = 0 or c_custkey % 7 = 0 or c_custkey % 11 = 0)""",
)
def _(t: Tables) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    none = F.array().cast("array<string>")
    jobs = t.customer.select(
        key.alias("job"), F.when(nation % 3 == 0, "confirmation").otherwise("informational").alias("risk"),
        F.when(key % 2 == 0, F.array("c_mktsegment", F.lit("RANDOM_FOG_HIGH_COST"))).otherwise(none).alias("warning_codes"),
        O.binding_hash("c_custkey", "c_mktsegment", "c_nationkey").alias("binding_hash"),
    )
    receipts = jobs.where("job % 5 <> 0").select(
        "job", F.when(F.col("job") % 7 == 0, "old").otherwise(F.col("binding_hash")).alias("binding_hash"),
        F.when(F.col("job") % 11 == 0, none).otherwise(F.col("warning_codes")).alias("acknowledged_codes"),
    )
    return O.receipt_check(jobs, receipts)


@query(
    "derive_observation",
    """select o_custkey as run, 'production' as kind, cast(o_custkey % 4 + 1 as integer) as workers, s as active_seconds, n as attempts, a as accepted, round(a / s::double, 9) as throughput, round(s * (o_custkey % 4 + 1)::double / n, 6) as seconds_per_candidate
       from (select o_custkey, cast(sum(cast(round(o_totalprice) as bigint)) as bigint) as s, count(*) as n, count(*) filter (o_orderstatus = 'F') as a from orders group by 1) where o_custkey % 6 <> 0""",
)
def _(t: Tables) -> DataFrame:
    runs = t.orders.groupBy(F.col("o_custkey").alias("run")).agg(
        F.sum(F.round("o_totalprice").cast("bigint")).alias("active_seconds"), F.count(F.lit(1)).alias("attempts"),
        F.sum((F.col("o_orderstatus") == "F").cast("bigint")).alias("accepted"),
    ).select("*", (F.col("run") % 4 + 1).cast("int").alias("workers"),
             F.when(F.col("run") % 6 == 0, "failed").otherwise("complete").alias("status"))
    out = O.derive_observation(runs)
    return out.withColumn("throughput", F.round("throughput", 9)).withColumn("seconds_per_candidate", F.round("seconds_per_candidate", 6))
