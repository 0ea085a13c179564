"""Telemetry reports over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators import telemetry as O
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query


def stage_records(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Samples and rejections with their stage-time maps."""
    m = B.annotations(t, positions=False)
    render = F.round(F.col("price") * 100).cast("bigint")
    synth = F.round(F.col("quantity") * 1000).cast("bigint")
    rows = m.select(
        F.create_map(F.lit("scene_render"), render, F.lit("background_synthesis"), synth).alias("stage_timings_ns"),
        F.create_map(F.lit("blend"), F.round(F.col("tax") * 1000000).cast("bigint")).alias("node_timings_ns"),
        (F.col("sample_id") % 3 == 0).alias("in_session"),
        F.concat(F.lit("reason_"), "source_group").alias("reason"),
        (F.col("quantity") > 35).alias("rejected"),
    )
    return rows.where("not rejected"), rows.where("rejected")


SQL_STAGE_RECORDS = (
    B.SQL_ANNOTATIONS
    + """,
v_stage_records as (
  select cast(round(price * 100) as bigint) as render, cast(round(quantity * 1000) as bigint) as synth,
    cast(round(tax * 1000000) as bigint) as blend, sample_id % 3 = 0 as in_session,
    'reason_' || source_group as reason, quantity > 35 as rejected from v_annotations),
v_stage_rows as (
  select 'scene_render' as stage, render as ns, in_session from v_stage_records
  union all select 'background_synthesis', synth, in_session from v_stage_records
  union all select 'background.node.blend', blend, in_session from v_stage_records where not rejected)"""
)


@query(
    "stage_explode",
    with_sql(
        """select stage, in_session, count(*) as n, cast(sum(ns) as bigint) as total_ns
           from v_stage_rows group by stage, in_session""",
        SQL_STAGE_RECORDS,
    ),
)
def _(t: Tables) -> DataFrame:
    rows = O.stage_explode(*stage_records(t))
    return rows.groupBy("stage", "in_session").agg(F.count(F.lit(1)).alias("n"), F.sum("ns").alias("total_ns"))


def sql_stage_summary(source: str) -> str:
    pick = "max(case when rn = cast(least(n - 1, round_even((n - 1) * {p}::double, 0)) as bigint) + 1 then ns end)"
    return f"""
select stage, count(*) as count, cast(sum(ns) as bigint) as total_ns, cast(sum(ns) // count(*) as bigint) as mean_ns,
  cast(floor(median(ns)) as bigint) as median_ns,
  {pick.format(p='0.90')} as p90_ns, {pick.format(p='0.95')} as p95_ns, {pick.format(p='0.99')} as p99_ns
from (select *, row_number() over (partition by stage order by ns) as rn, count(*) over (partition by stage) as n
      from {source}) group by stage"""


@query("stage_summary", with_sql(sql_stage_summary("v_stages"), B.SQL_STAGES))
def _(t: Tables) -> DataFrame:
    return O.stage_summary(B.stages(t))


@query("stage_summary_render", with_sql(sql_stage_summary("v_stage_rows"), SQL_STAGE_RECORDS))
def _(t: Tables) -> DataFrame:
    """The same report over the exploded render times: large, heavily repeated and unique values."""
    return O.stage_summary(O.stage_explode(*stage_records(t)))


@query(
    "rejection_costs",
    with_sql(
        """select reason, count(*) as n, cast(sum(render + synth) as bigint) as cost_ns
           from v_stage_records where rejected group by reason""",
        SQL_STAGE_RECORDS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.rejection_costs(stage_records(t)[1])


@query(
    "mix_configured_observed",
    with_sql(
        """select coalesce(s.recipe, c.recipe) as recipe,
          round(coalesce(c.weight, 0) / (select sum(weight) from conf), 9) as configured_fraction,
          round(coalesce(s.n, 0) / (select sum(n) from seen), 9) as observed_fraction,
          cast(coalesce(s.n, 0) as bigint) as observed_count
        from seen s full outer join conf c on s.recipe = c.recipe""",
        """seen as (select n_name as recipe, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1)""",
        """conf as (select case when n_nationkey < 20 then n_name else n_name || '-old' end as recipe, n_regionkey * 1.0::double as weight from nation where n_nationkey >= 3)""",
    ),
)
def _(t: Tables) -> DataFrame:
    seen = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    weights = t.nation.where("n_nationkey >= 3").select(
        F.when(F.col("n_nationkey") < 20, F.col("n_name")).otherwise(F.concat("n_name", F.lit("-old"))).alias("recipe"),
        F.col("n_regionkey").cast("double").alias("weight"),
    )
    mix = O.mix_configured_observed(seen.select(F.col("n_name").alias("recipe")), "recipe", weights, 0.0)
    return mix.select(
        "recipe", F.round("configured_fraction", 9).alias("configured_fraction"),
        F.round("observed_fraction", 9).alias("observed_fraction"), "observed_count",
    )


def nested_samples(t: Tables) -> DataFrame:
    """Samples with their annotations as an array; a sample's objects are few by contract."""
    a = B.annotations(t)
    grouped = a.groupBy("sample_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct("instance_pos", "class_name", "source_group", "source_asset", "x1", "y1", "x2", "y2", "quantity", "discount")
            )
        ).alias("annotations")
    )
    return B.samples(t).join(grouped, "sample_id", "left")


@query(
    "class_group_counts",
    with_sql(
        """select 'class' as kind, class_name as value, count(*) as n from v_annotations join orders on o_orderkey = sample_id group by 2
           union all select 'group', source_group, count(*) from v_annotations join orders on o_orderkey = sample_id group by 2
           union all select 'negative', '', count(*) from orders
             where o_orderkey not in (select l_orderkey from lineitem)""",
        B.SQL_ANNOTATIONS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.class_group_counts(nested_samples(t))


@query(
    "qa_metric_summary",
    """with q as (select l_quantity, l_discount, l_tax from lineitem),
    m as (select 'quantity' as name, l_quantity as value from q union all select 'discount', l_discount from q
          union all select 'tax', l_tax from q),
    w as (select 'high_quantity' as name from q where l_quantity > 40 union all select 'no_discount' from q where l_discount = 0)
    select 'metric' as kind, name, round(avg(value), 6) as mean, min(value) as minimum, max(value) as maximum, count(*) as n
    from m group by name
    union all select 'warning', name, null, null, null, count(*) from w group by name""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.create_map(
            F.lit("quantity"), F.col("l_quantity"), F.lit("discount"), F.col("l_discount"), F.lit("tax"), F.col("l_tax")
        ).alias("qa"),
        F.array_compact(
            F.array(
                F.when(F.col("l_quantity") > 40, F.lit("high_quantity")),
                F.when(F.col("l_discount") == 0, F.lit("no_discount")),
            )
        ).alias("warnings"),
    )
    return O.qa_metric_summary(rows).withColumn("mean", F.round("mean", 6))


@query(
    "run_summary",
    with_sql(
        """select s.pool, accepted, accepted + rejected as candidate_attempts,
             greatest(0, accepted - 100) as session_accepted, greatest(0, accepted + rejected - 150) as session_attempts,
             round(rejected / (accepted + rejected), 9) as candidate_rejection_rate,
             round(background / (accepted + rejected), 9) as background_rejection_rate,
             object_attempts, object_rejections, round(object_rejections / object_attempts, 9) as object_rejection_rate,
             negative_count, mask_bytes, round(mask_bytes / accepted, 6) as mean_mask_bytes
           from (select pool_index as pool, count(*) as accepted, cast(sum(coalesce(n, 0)) as bigint) as object_attempts,
                   cast(sum(coalesce(r, 0)) as bigint) as object_rejections,
                   cast(sum(case when n is null then 1 else 0 end) as bigint) as negative_count,
                   cast(sum(coalesce(b, 0)) as bigint) as mask_bytes
                 from v_samples left join per using (sample_id) group by 1) s
           join (select cast(c_custkey % 2 as integer) as pool, count(*) as rejected,
                   cast(sum(case when c_mktsegment = 'BUILDING' then 1 else 0 end) as bigint) as background
                 from customer group by 1) r on s.pool = r.pool""",
        B.SQL_SAMPLES,
        """per as (select l_orderkey as sample_id, count(*) as n, sum(case when l_quantity > 35 then 1 else 0 end) as r,
             sum(cast(round(l_extendedprice) as bigint)) as b from lineitem group by 1)""",
    ),
)
def _(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy(F.col("l_orderkey").alias("sample_id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("l_quantity") > 35).cast("bigint")).alias("r"),
        F.sum(F.round("l_extendedprice").cast("bigint")).alias("b"),
    )
    zero = F.lit(0).cast("bigint")
    rows = B.samples(t).join(per, "sample_id", "left").select(
        F.col("pool_index").alias("pool"),
        F.coalesce("n", zero).alias("attempted_instances"),
        F.coalesce("r", zero).alias("rejected_instances"),
        F.col("n").isNull().alias("negative"),
        F.coalesce("b", zero).alias("mask_bytes"),
    )
    rejected = t.customer.select(
        (F.col("c_custkey") % 2).cast("int").alias("pool"),
        F.when(F.col("c_mktsegment") == "BUILDING", O.BACKGROUND_REASON).otherwise("other").alias("reason"),
    )
    baseline = t.region.where("r_regionkey < 2").select(
        F.col("r_regionkey").alias("pool"), F.lit(100).cast("bigint").alias("baseline_accepted"),
        F.lit(150).cast("bigint").alias("baseline_attempts"),
    )
    out = O.run_summary(rows, rejected, baseline)
    for c in ("candidate_rejection_rate", "background_rejection_rate", "object_rejection_rate"):
        out = out.withColumn(c, F.round(c, 9))
    return out.withColumn("mean_mask_bytes", F.round("mean_mask_bytes", 6))


def _sql_rate(dimension: str, value: str) -> str:
    return f"""select '{dimension}' as dimension, {value} as value, cast(sum(case when rejected then 1 else 0 end) as bigint) as rejections,
      count(*) as attempts, round(sum(case when rejected then 1 else 0 end) / count(*), 9) as rate from v_attempts group by 2"""


SQL_SCALE_BAND = "printf('%.2f-%.2f', greatest(0, floor(scale * 10)) / 10, greatest(0, floor(scale * 10)) / 10 + 0.1)"
SQL_ROTATION_BAND = (
    "(cast(floor((abs(rotation) % 180) / 15) as bigint) * 15) || '-' || (cast(floor((abs(rotation) % 180) / 15) as bigint) * 15 + 15)"
)


@query(
    "conditional_rates",
    with_sql(
        " union all ".join(
            [
                _sql_rate("asset", "source_asset"),
                _sql_rate("class", "class_name"),
                _sql_rate("scale_band", SQL_SCALE_BAND),
                _sql_rate("rotation_band", SQL_ROTATION_BAND),
                _sql_rate("object_count", "cast(requested_objects as varchar)"),
                _sql_rate("region", "region"),
            ]
        ),
        B.SQL_ATTEMPTS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.conditional_rates(B.attempts(t)).withColumn("rate", F.round("rate", 9))


@query(
    "event_rates",
    with_sql(
        """select 'stage' as dimension, stage as value, count(*) as rejections,
             (select count(*) from v_attempts) as object_attempts,
             round(count(*) / (select count(*) from v_attempts), 9) as rate from v_attempts where rejected group by stage
           union all
           select 'reason', reason, count(*), (select count(*) from v_attempts),
             round(count(*) / (select count(*) from v_attempts), 9) from v_attempts where rejected group by reason""",
        B.SQL_ATTEMPTS,
    ),
)
def _(t: Tables) -> DataFrame:
    a = t.lineitem.select(
        (F.col("l_quantity") > 35).alias("rejected"),
        F.when(F.col("l_linestatus") == "F", "planner.placement").otherwise("renderer.visibility").alias("stage"),
        F.when(F.col("l_linestatus") == "F", "placement_attempts_exhausted").otherwise("visible_bbox_fraction").alias("reason"),
    )
    return O.event_rates(a).withColumn("rate", F.round("rate", 9))


def metric_records(t: Tables) -> DataFrame:
    """Resource samples; errors stand for failed readings, every 50th click for a drop report."""
    failed = F.col("run_state") == "error"
    dropped = (F.col("run_state") == "click") & (F.col("sequence") % 50 == 0)
    return B.metrics(t).select(
        "*",
        F.when(failed, O.SAMPLE_FAILED_CODE).when(dropped, "RESOURCE_SAMPLES_DROPPED").alias("code"),
        F.when(dropped, F.col("sequence") % 7).alias("dropped_samples"),
    )


SQL_METRIC_RECORDS = (
    B.SQL_METRICS
    + """,
v_metric_records as (
  select *, case when run_state = 'error' then 'RESOURCE_SAMPLE_FAILED'
                 when run_state = 'click' and sequence % 50 = 0 then 'RESOURCE_SAMPLES_DROPPED' end as code,
    case when run_state = 'click' and sequence % 50 = 0 then sequence % 7 end as dropped_samples
  from v_metrics)"""
)


@query(
    "resource_rollup",
    with_sql(
        """select session_id, max(cpu_percent) filter (code is null) as peak_cpu_percent,
             max(rss_bytes) filter (code is null) as peak_rss_bytes,
             max_by(cpu_percent, struct_pack(a := ingested_at, b := sequence)) filter (code is null) as latest_cpu_percent,
             max_by(rss_bytes, struct_pack(a := ingested_at, b := sequence)) filter (code is null) as latest_rss_bytes,
             cast(sum(case when code is null then 1 else 0 end) as bigint) as samples,
             cast(sum(coalesce(dropped_samples, 0)) as bigint) as dropped_samples,
             cast(sum(case when code = 'RESOURCE_SAMPLE_FAILED' then 1 else 0 end) as bigint) as sample_errors
           from v_metric_records group by session_id""",
        SQL_METRIC_RECORDS,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.resource_rollup(metric_records(t), ("session_id",), ("cpu_percent", "rss_bytes"))


@query(
    "process_group_sum",
    """select user_id, max(value + event_id % 10 + 0.5) as cpu_percent,
         cast(max(cast(json_extract_string(props, '$.k') as bigint) * 3 + event_id % 10) as bigint) as rss_bytes
       from events group by user_id""",
)
def _(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    groups = t.events.select(
        "user_id",
        F.struct(F.col("value").alias("cpu_percent"), k.alias("rss_bytes")).alias("coordinator"),
        F.struct((F.col("event_id") % 10).cast("double").alias("cpu_percent"), (k * 2).alias("rss_bytes")).alias("direct_workers"),
        F.struct(F.lit(0.5).alias("cpu_percent"), (F.col("event_id") % 10).alias("rss_bytes")).alias("other_descendants"),
    )
    total = O.process_group_sum(["coordinator", "direct_workers", "other_descendants"], ("cpu_percent", "rss_bytes"))
    return groups.withColumn("aggregate", total).groupBy("user_id").agg(
        F.max("aggregate.cpu_percent").alias("cpu_percent"), F.max("aggregate.rss_bytes").alias("rss_bytes")
    )


@query(
    "active_time_eta",
    with_sql(
        """select run, round(wall, 6) as wall_seconds, round(paused, 6) as paused_seconds,
             round(active, 6) as active_seconds, round(thr, 9) as throughput,
             round(case when thr > 0 then greatest(0, 200 - accepted) / thr else 0 end, 3) as eta_seconds
           from (select *, greatest(0, accepted - 3) / active as thr from (
             select p.run, (end_us - start_us) / 1e6::double as wall, coalesce(paused_us, 0) / 1e6::double as paused,
               greatest(1e-9::double, (end_us - start_us) / 1e6::double - coalesce(paused_us, 0) / 1e6::double) as active, accepted
             from p left join z on p.run = z.run))""",
        B.SQL_CONTROL,
        """p as (select user_id as run, min(epoch_us(ts)) as start_us, max(epoch_us(ts)) as end_us,
             count(*) filter (event_type = 'view') as accepted from events group by 1)""",
        """z as (select c.run, sum(coalesce(nxt, end_us) - us) as paused_us from (
             select *, lead(us) over (partition by run order by seq) as nxt from v_control) c join p on c.run = p.run
             where state = 'paused' group by 1)""",
    ),
)
def _(t: Tables) -> DataFrame:
    progress = t.events.groupBy(F.col("user_id").alias("run")).agg(
        F.min(B.epoch_micros("ts")).alias("start_us"),
        F.max(B.epoch_micros("ts")).alias("end_us"),
        F.sum((F.col("event_type") == "view").cast("bigint")).alias("accepted"),
    ).select("*", F.lit(3).alias("baseline_accepted"), F.lit(200).alias("target"))
    out = O.active_time_eta(B.control(t), progress, F.floor(F.col("seq") / 1000))
    digits = {"wall_seconds": 6, "paused_seconds": 6, "active_seconds": 6, "throughput": 9, "eta_seconds": 3}
    return out.select("run", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query(
    "bottleneck_topk",
    with_sql(
        """select * from (select 'bottleneck' as report, 1::bigint as place, stage as name,
             max(case when rn = n // 2 + 1 then ns end) as value,
             max(case when rn = cast(round_even((n - 1) * 0.95::double, 0) as bigint) + 1 then ns end) as p95_ns
           from (select *, row_number() over (partition by stage order by ns) as rn, count(*) over (partition by stage) as n from v_stages)
           group by stage order by avg(ns) desc, stage limit 1)
           union all (select 'reason', row_number() over (order by n desc, name), name, n, null from
             (select 'reason_' || l_shipyear as name, count(*) as n from
               (select year(l_shipdate) as l_shipyear from lineitem where l_quantity > 35) group by 1) order by n desc, name limit 3)
           union all (select 'class', row_number() over (order by n desc, name), name, n, null from
             (select l_returnflag || l_linestatus as name, count(*) as n from lineitem group by 1) order by n desc, name limit 5)""",
        B.SQL_STAGES,
    ),
)
def _(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    def places(report: str, frame: DataFrame, key: str, k: int) -> DataFrame:
        top = O.top_counts(frame, key, k)
        order = Window.orderBy(F.desc("n"), key)  # k rows only
        return top.select(
            F.lit(report).alias("report"), F.row_number().over(order).cast("bigint").alias("place"),
            F.col(key).alias("name"), F.col("n").alias("value"), F.lit(None).cast("bigint").alias("p95_ns"),
        )

    slow = O.bottleneck(B.stages(t)).select(
        F.lit("bottleneck").alias("report"), F.lit(1).cast("bigint").alias("place"), F.col("stage").alias("name"),
        F.col("p50_ns").alias("value"), "p95_ns",
    )
    reasons = t.lineitem.where("l_quantity > 35").select(
        F.concat(F.lit("reason_"), F.year("l_shipdate").cast("string")).alias("reason")
    )
    classes = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("class"))
    return slow.unionByName(places("reason", reasons, "reason", 3)).unionByName(places("class", classes, "class", 5))


@query(
    "fidelity_summary",
    """select count(*) as instances, min(1.0::double - l_discount) as minimum_iou, max(l_tax) as maximum_area_error,
         cast(sum(case when l_quantity > 45 then 1 else 0 end) as bigint) as warning_instances from lineitem""",
)
def _(t: Tables) -> DataFrame:
    warned = F.when(F.col("l_quantity") > 45, F.array(F.lit("MASK_HOLES_FILLED"))).otherwise(
        F.array().cast("array<string>")
    )
    one = t.lineitem.select(
        F.array(
            F.struct((1.0 - F.col("l_discount")).alias("iou"), F.col("l_tax").alias("area_error"), warned.alias("warnings"))
        ).alias("segmentation")
    )
    return O.fidelity_summary(one)


@query(
    "budget_breach",
    with_sql(
        """select cast(sample_id % 2 as integer) as pool, min_by(sample_id, k) as sample_id, cast(min_by(instance_pos, k) as integer) as instance_pos,
             min_by(attempts, k) as attempts, min_by(rejections, k) as rejections, min_by(code, k) as code
           from (select *, sample_id * 1000 + instance_pos as k,
               case when spent / 1e6 > 300 then 'wall_time' when attempts >= 10 and rejections / attempts > 0.5 then 'rejection_rate' end as code
             from (select *, count(*) over w as attempts, cast(sum(case when quantity > 35 then 1 else 0 end) over w as bigint) as rejections,
                     sum(cast(round(quantity * 1000) as bigint)) over w as spent
                   from v_annotations window w as (partition by sample_id % 2 order by sample_id, instance_pos rows unbounded preceding)))
           where code is not null group by 1""",
        B.SQL_ANNOTATIONS,
    ),
)
def _(t: Tables) -> DataFrame:
    commits = B.annotations(t).select(
        (F.col("sample_id") % 2).cast("int").alias("pool"), "sample_id", "instance_pos",
        (F.col("quantity") > 35).alias("rejected"), F.round(F.col("quantity") * 1000).cast("bigint").alias("micros"),
    )
    return O.budget_breach(
        commits, F.floor(F.col("sample_id") / 1024), ["sample_id", "instance_pos"], 0.5, max_seconds=300.0
    )


@query(
    "benchmark_summary",
    with_sql(
        f"""select stage, cast(sum(ns) // count(*) as bigint) as mean_ns, {B.sql_whole('ns', 95)} as p95_ns
           from v_stages where event_id >= 100 group by stage""",
        B.SQL_STAGES,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.benchmark_summary(B.stages(t).withColumnRenamed("event_id", "index"), 100)
