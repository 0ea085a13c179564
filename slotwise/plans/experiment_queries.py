"""Paired experiments and run comparison over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators import compare as C
from slotwise.operators import experiments as O
from slotwise.operators import telemetry as T
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query
from slotwise.plans.telemetry_queries import sql_stage_summary

TREATMENTS = ("current", "no-appearance", "background-only", "combined", "forced")


@query(
    "balanced_order",
    """select o_orderkey as fixture, name as treatment, cast(case when (o_orderkey // 5) % 2 = 1 then 4 - p else p end as integer) as order_index
       from (select o_orderkey, name, (i - o_orderkey % 5 + 5) % 5 as p from orders,
         (values (0, 'current'), (1, 'no-appearance'), (2, 'background-only'), (3, 'combined'), (4, 'forced')) v(i, name))""",
)
def _(t: Tables) -> DataFrame:
    return O.balanced_order(t.orders.select(F.col("o_orderkey").alias("fixture")), "fixture", TREATMENTS)


@query(
    "paired_invariants",
    with_sql(
        """select fixture, 'geometry' as signature from v_measurements group by fixture having count(distinct case when object_count > 11 then treatment else 0 end) > 1
           union all select fixture, 'annotation' from v_measurements group by fixture having count(distinct case when tax = 0.08 then 1 else 0 end) > 1
           union all select fixture, 'mask' from v_measurements group by fixture having count(distinct x1 // 500) > 1""",
        B.SQL_MEASUREMENTS,
    ),
)
def _(t: Tables) -> DataFrame:
    rows = B.measurements(t).select(
        "fixture",
        O.signature(F.when(F.col("object_count") > 11, F.col("treatment")).otherwise(0).alias("g")).alias("geometry"),
        O.signature((F.round("tax", 9) == 0.08).alias("a")).alias("annotation"),
        O.signature(F.floor(F.col("x1") / 500).alias("m")).alias("mask"),
    )
    return O.paired_invariants(rows, "fixture", ["geometry", "annotation", "mask"])


@query(
    "treatment_summary",
    with_sql(
        f"""select treatment, count(*) as calls, cast(sum(render_ns) as bigint) as render_total_ns, cast(sum(render_ns) // count(*) as bigint) as render_mean_ns,
             {B.sql_whole('render_ns', 95)} as render_p95_ns, cast(sum(m) // count(*) as bigint) as modeled_mean_ns,
             {B.sql_whole('m', 95)} as modeled_p95_ns, cast(sum(render_ns) // greatest(1, sum(object_count)) as bigint) as per_object_mean_ns,
             cast(trunc(sum(render_ns)::double / greatest(1e-9::double, sum(cast(round(megapixels * 1000000) as bigint)) / 1e6::double)) as bigint) as per_megapixel_mean_ns
           from (select *, render_ns + synthesis_ns + encode_ns + write_ns as m from v_measurements where fixture >= 20) group by treatment""",
        B.SQL_MEASUREMENTS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.treatment_summary(B.measurements(t), 20)


def with_effects(rows: DataFrame) -> DataFrame:
    def effect(name: str, applied, duration: str):
        return F.struct(F.lit(name).alias("id"), applied.alias("applied"), F.col(duration).alias("duration_ns"))

    return rows.withColumn(
        "effects",
        F.array(effect("blur", F.col("discount") > 0.05, "synthesis_ns"), effect("fog", F.col("tax") > 0.045, "render_ns")),
    )


@query(
    "effect_summary",
    with_sql(
        f"""select treatment, effect, count(*) as calls, cast(sum(d) as bigint) as total_ns, cast(sum(d) // count(*) as bigint) as mean_ns, {B.sql_whole('d', 95)} as p95_ns
           from (select treatment, 'blur' as effect, synthesis_ns as d from v_measurements where discount > 0.05
                 union all select treatment, 'fog', render_ns from v_measurements where tax > 0.045) group by all""",
        B.SQL_MEASUREMENTS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.effect_summary(with_effects(B.measurements(t)))


@query(
    "paired_delta",
    with_sql(
        f"""select m.treatment, count(*) as pairs, cast(trunc(sum(m.render_ns - b.render_ns)::double / count(*)) as bigint) as mean_delta_ns,
             {B.sql_whole('(m.render_ns - b.render_ns)', 95)} as p95_delta_ns
           from v_measurements m join v_measurements b on m.fixture = b.fixture and b.treatment = 2 where m.treatment <> 2 group by 1""",
        B.SQL_MEASUREMENTS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.paired_delta(B.measurements(t), F.col("treatment") == 2)


@query(
    "slow_samples",
    with_sql(
        " union all ".join(
            f"""(select '{m}' as metric, fixture, treatment, {m} as value_ns, recipe_id, object_count,
              array_to_string(list_filter([case when discount > 0.05 then 'blur' end, case when tax > 0.045 then 'fog' end], lambda s: s is not null), ',') as active_effects
              from v_m order by {m} desc, fixture, treatment limit 10)"""
            for m in ("render_ns", "modeled_ns")
        ),
        B.SQL_MEASUREMENTS,
        "v_m as (select *, render_ns + synthesis_ns + encode_ns + write_ns as modeled_ns from v_measurements)",
    ),
)
def _(t: Tables) -> DataFrame:
    rows = O.modeled_cost(with_effects(B.measurements(t)))
    out = O.slow_samples(rows, ["render_ns", "modeled_ns"])
    return out.withColumn("active_effects", F.array_join("active_effects", ","))


@query(
    "modeled_cost",
    with_sql(
        "select fixture, treatment, render_ns + synthesis_ns + encode_ns + write_ns as modeled_ns from v_measurements",
        B.SQL_MEASUREMENTS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.modeled_cost(B.measurements(t)).select("fixture", "treatment", "modeled_ns")


@query(
    "study_findings",
    with_sql(
        """select 'TREATMENT_MISSING' as code, cast(r as varchar) as key from d where r not in (select treatment from v_measurements) group by r
           union all select 'TREATMENT_UNDECLARED', cast(treatment as varchar) from v_measurements where treatment not in (select r from d) group by treatment
           union all select 'TREATMENT_DUPLICATE', cast(r as varchar) from d group by r having count(*) > 1
           union all select 'SAMPLE_COUNT_MISMATCH', cast(treatment as varchar) from (select cast(o_orderkey % 4 + 1 as integer) as treatment, count(*) as calls from orders group by 1) r
             left join (select treatment, count(*) as n from v_measurements group by 1) s using (treatment) where calls <> coalesce(n, 0)
           union all select 'LOW_SAMPLE_COUNT', cast(count(distinct fixture) as varchar) from v_measurements having count(distinct fixture) < 20""",
        B.SQL_MEASUREMENTS,
        "d as (select r_regionkey + 2 as r from region union all select n_regionkey + 2 from nation where n_nationkey = 7)",
    ),
)
def _(t: Tables) -> DataFrame:
    declared = t.region.select((F.col("r_regionkey") + 2).alias("treatment")).unionAll(
        t.nation.where("n_nationkey = 7").select(F.col("n_regionkey") + 2)
    )
    reported = t.orders.groupBy((F.col("o_orderkey") % 4 + 1).cast("int").alias("treatment")).agg(F.count(F.lit(1)).alias("calls"))
    return O.study_findings(B.measurements(t), declared, reported)


@query(
    "treatment_matrix",
    """with b as (select ['background','foreground','final'][n_regionkey % 3 + 1] as stage, n_nationkey as pos, n_name as id, n_nationkey / 25.0::double as probability from nation),
       e as (select ['background','foreground','final'][s_nationkey % 3 + 1] as stage, cast(s_suppkey as integer) as pos, s_name as id, 0.5::double as probability from supplier)
       select treatment, stage, 0 as layer, pos, id, probability from b, (values ('current'), ('combined'), ('background-only'), ('foreground-only'), ('final-only')) v(treatment)
       union all select 'combined', stage, 1, pos, id, probability from e union all select stage || '-only', stage, 1, pos, id, probability from e
       union all select 'forced', stage, 0, pos, id, 1.0::double from e""",
)
def _(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(s) for s in O.STAGES])
    base = t.nation.select(
        names[F.col("n_regionkey") % 3].alias("stage"), F.col("n_nationkey").alias("pos"), F.col("n_name").alias("id"),
        (F.col("n_nationkey") / F.lit(25.0)).alias("probability"),
    )
    extra = t.supplier.select(
        names[F.col("s_nationkey") % 3].alias("stage"), F.col("s_suppkey").cast("int").alias("pos"), F.col("s_name").alias("id"),
        F.lit(0.5).alias("probability"),
    )
    return O.treatment_matrix(base, extra)


def halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Event counts per user and type of the two halves of the month, as two runs."""
    rows = t.events.select(
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("reason"),
        (F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).alias("late"),
    )
    counted = rows.groupBy("reason", "late").agg(F.count(F.lit(1)).alias("n"))
    return counted.where("not late"), counted.where("late")


@query(
    "count_changes",
    """with c as (select event_type || '-' || user_id as reason, ts >= timestamp '2024-01-15' as late, count(*) as n from events group by all)
       select reason, coalesce(l.n, 0)::double as "left", coalesce(r.n, 0)::double as "right", (coalesce(r.n, 0) - coalesce(l.n, 0))::double as delta,
         round(coalesce(r.n, 0)::double / l.n, 9) as ratio
       from (select * from c where not late) l full outer join (select * from c where late) r using (reason)""",
)
def _(t: Tables) -> DataFrame:
    left, right = halves(t)
    return C.count_changes(left, right, ["reason"], "n").withColumn("ratio", F.round("ratio", 9))


@query(
    "timing_regressions",
    with_sql(
        f"""select coalesce(l.stage, r.stage) as stage, l.p95_ns::double as "left", r.p95_ns::double as "right", (r.p95_ns - l.p95_ns)::double as delta, round(r.p95_ns::double / l.p95_ns, 9) as ratio
            from ({sql_stage_summary('early')}) l full outer join ({sql_stage_summary('late')}) r on l.stage = r.stage""",
        B.SQL_STAGES,
        "early as (select * replace (case stage when 'view' then 'view-1' else stage end as stage) from v_stages where not in_session)",
        "late as (select * replace (case stage when 'click' then 'click-2' else stage end as stage) from v_stages where in_session)",
    ),
)
def _(t: Tables) -> DataFrame:
    rows = B.stages(t)
    renamed = lambda old, new: F.when(F.col("stage") == old, new).otherwise(F.col("stage"))
    left = T.stage_summary(rows.where("not in_session").withColumn("stage", renamed("view", "view-1")))
    right = T.stage_summary(rows.where("in_session").withColumn("stage", renamed("click", "click-2")))
    return C.timing_regressions(left, right, ["stage"]).withColumn("ratio", F.round("ratio", 9))


@query(
    "identity_changes",
    """with l as (select c_custkey as pool, c_mktsegment as contract_hash, cast(c_nationkey as varchar) as catalog_fingerprint, case when c_acctbal > 0 then 'linux' end as environment from customer),
       r as (select o_custkey as pool, min(case o_orderstatus when 'F' then 'BUILDING' else 'MACHINERY' end) as contract_hash, cast(min(o_orderkey % 25) as varchar) as catalog_fingerprint,
         max(case when o_totalprice > 480000 then 'linux' end) as environment from orders group by 1),
       u as (select l.pool, 'contract_hash' as field, l.contract_hash as "left", r.contract_hash as "right" from l join r using (pool)
         union all select l.pool, 'catalog_fingerprint', l.catalog_fingerprint, r.catalog_fingerprint from l join r using (pool)
         union all select l.pool, 'environment', l.environment, r.environment from l join r using (pool))
       select * from u where "left" is distinct from "right" """,
)
def _(t: Tables) -> DataFrame:
    left = t.customer.select(
        F.col("c_custkey").alias("pool"), F.col("c_mktsegment").alias("contract_hash"),
        F.col("c_nationkey").alias("catalog_fingerprint"), F.when(F.col("c_acctbal") > 0, "linux").alias("environment"),
    )
    right = t.orders.groupBy(F.col("o_custkey").alias("pool")).agg(
        F.min(F.when(F.col("o_orderstatus") == "F", "BUILDING").otherwise("MACHINERY")).alias("contract_hash"),
        F.min(F.col("o_orderkey") % 25).alias("catalog_fingerprint"),
        F.max(F.when(F.col("o_totalprice") > 480000, "linux")).alias("environment"),
    )
    return C.identity_changes(left, right, "pool", ["contract_hash", "catalog_fingerprint", "environment"])


@query(
    "key_diff",
    """with c as (select user_id as run, event_type as field, ts >= timestamp '2024-01-15' as late, count(*) as n from events group by all)
       select run, field, cast(l.n as varchar) as "left", cast(r.n as varchar) as "right"
       from (select * from c where not late) l full outer join (select * from c where late) r using (run, field) where l.n is distinct from r.n""",
)
def _(t: Tables) -> DataFrame:
    counted = t.events.groupBy(
        F.col("user_id").alias("run"), "event_type", (F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).alias("late")
    ).agg(F.count(F.lit(1)).alias("n"))

    def document(late: bool):
        entries = F.collect_list(F.when(F.col("late") == late, F.struct("event_type", "n")))
        return F.to_json(F.map_from_entries(entries))

    pairs = counted.groupBy("run").agg(document(False).alias("l"), document(True).alias("r"))
    return C.key_diff(pairs, "run", "l", "r")
