"""Pool audit, resume planning and control-log checks over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators import audit as O
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query
from slotwise.session import scratch_path
from slotwise.sources import pools, sinks

POOLS = 25


def audit_inputs(t: Tables) -> dict[str, DataFrame]:
    """25 pools with planted faults: drifting counts and hashes, lost files, broken images and masks."""
    pool = F.col("pool")
    orders = t.orders.select((F.col("o_custkey") % POOLS).cast("int").alias("pool"), F.col("o_orderkey").alias("id"))
    counts = orders.groupBy("pool").agg(F.count(F.lit(1)).alias("n"))
    pools = t.nation.select(F.col("n_nationkey").alias("pool"), "n_name").join(counts, "pool")
    runs = pools.select(
        "pool", F.when(pool % 5 == 0, 1).otherwise(2).alias("schema_version"), F.col("n_name").alias("contract_hash"),
        (F.col("n") + F.when(pool == 9, 1).otherwise(0)).alias("target"), F.lit(8).alias("width"), F.lit(8).alias("height"),
    )
    status = F.when(pool % 4 == 1, "interrupted").otherwise("complete")
    summary = pools.select(
        "pool", status.alias("status"), (F.col("n") + F.when(pool == 3, 1).otherwise(0)).alias("accepted"),
        F.when(pool == 7, "other").otherwise(F.col("n_name")).alias("contract_hash"),
    )
    control = pools.select("pool", F.when(pool == 11, "failed").otherwise(status).alias("actual_state"))
    i = F.col("id")
    samples = orders.select(
        "pool", i.cast("string").alias("sample_id"), F.when(i % 501 != 0, F.when(i % 503 == 0, 7).otherwise(8)).alias("image_width"),
        F.lit(8).alias("image_height"), F.when(i % 101 != 0, F.concat(F.lit("masks/"), i.cast("string"))).alias("evidence_path"),
        (i % 103 != 0).alias("evidence_ok"),
    )
    lines = B.annotations(t).join(t.orders.select(F.col("o_orderkey").alias("sample_id"), "o_custkey"), "sample_id")
    q = F.round("quantity").cast("int")
    x1, y1 = (F.col("x1") % 5).cast("int"), (F.col("y1") % 5).cast("int")
    items = lines.select(
        (F.col("o_custkey") % POOLS).cast("int").alias("pool"), F.col("sample_id").cast("string").alias("sample_id"),
        F.concat(F.lit("instance-"), F.col("instance_pos").cast("string")).alias("instance_id"), q.alias("q"),
        F.round(F.col("discount") * 100).cast("int").alias("d"),
        x1.alias("x1"), y1.alias("y1"), (x1 + 1 + q % 4).alias("x2"), (y1 + 1 + F.col("instance_pos") % 3).alias("y2"),
    )
    annotations = items.select(
        "pool", "sample_id", "instance_id", "x1", "y1", "x2", "y2", ((F.col("x1") + F.col("x2")) / 16.0).alias("cx"),
        ((F.col("y1") + F.col("y2")) / 16.0).alias("cy"), ((F.col("x2") - F.col("x1")) / 8.0).alias("w"),
        (F.when(F.col("q") == 49, 0).otherwise(F.col("y2") - F.col("y1")) / 8.0).alias("h"),
    )

    def cells(value):
        """The box's value on 8 x 8 cells of 0, put together from rows."""
        zeros = lambda n: F.array_repeat(F.lit(0), n)
        left, top, right, bottom = F.col("x1"), F.col("y1"), F.least("x2", F.lit(8)), F.least("y2", F.lit(8))
        row = F.concat(zeros(left), F.array_repeat(value, right - left), zeros(8 - right))
        return F.concat(zeros(8 * top), F.flatten(F.array_repeat(row, bottom - top)), zeros(8 * (8 - bottom)))

    masks = items.where("q <> 13").select(
        "pool", "sample_id", "instance_id", F.lit(8).alias("mask_width"), F.lit(8).alias("threshold"),
        cells(F.when(F.col("d") == 7, 100).otherwise(200)).alias("full"),
        cells(F.when(F.col("q") == 50, 5).otherwise(200)).alias("visible"),
    )
    names = F.explode(F.array(*[F.lit(n) for n in O.REQUIRED_ARTIFACTS])).alias("name")
    required = pools.select("pool", names).where("not (pool = 13 and name = 'metrics.jsonl')")
    pictures = t.supplier.select(F.col("s_nationkey").alias("pool"), "s_suppkey", F.concat(F.lit("qa/"), "s_name").alias("name"))
    return {
        "runs": runs, "summary": summary, "control": control, "samples": samples, "annotations": annotations, "masks": masks,
        "files": required.unionByName(pictures.where("s_suppkey % 9 <> 0").select("pool", "name")),
        "links": pictures.select("pool", F.col("name").alias("link")),
        "read_findings": refused_lines(t).unionByName(refused_documents(t)),
    }


def refused_lines(t: Tables) -> DataFrame:
    """Order lines of a log per pool as JSON; every 997th is torn and comes back as a finding of the reader."""
    key = F.col("o_orderkey")
    text = F.to_json(F.struct(key.alias("slot")))
    rows = t.orders.select((F.col("o_custkey") % POOLS).cast("int").alias("pool"), F.when(key % 997 == 0, F.concat(F.lit("{torn "), key.cast("string"))).otherwise(text).alias("value"))
    root = scratch_path(t.spark, "audit-logs")
    rows.write.partitionBy("pool").text(root)
    _, findings = pools.read_jsonl_permissive(t.spark, [root], "slot bigint")
    pool = F.regexp_extract("file", r"pool=(\d+)", 1).cast("int")
    return findings.select(pool.alias("pool"), "code", F.lit("samples.jsonl").alias("artifact"), F.col("raw").alias("detail"))


def refused_documents(t: Tables) -> DataFrame:
    """A manifest per nation; that of nation 17 is cut short."""
    body = F.when(F.col("n_nationkey") == 17, F.lit('{"contract_hash"')).otherwise(F.to_json(F.struct(F.col("n_name").alias("contract_hash"))))
    rows = t.nation.select(F.concat(F.col("n_nationkey").cast("string"), F.lit("/run.json")).alias("path"), body.alias("content"))
    root = scratch_path(t.spark, "audit-manifests")
    sinks.write_files(rows, root, f"{root}-index")
    listed = t.nation.select(F.col("n_nationkey").cast("string").alias("pool"))
    _, findings = pools.read_manifests(t.spark, root, "run.json", "contract_hash string", listed)
    return findings.select(F.col("pool").cast("int").alias("pool"), "code", "artifact", F.lit(None).cast("string").alias("detail"))


SQL_AUDIT = (
    B.SQL_ANNOTATIONS
    + """,
o as (select cast(o_custkey % 25 as integer) as pool, o_orderkey as id from orders where o_custkey % 25 <> 13),
dec as (select *, pool % 5 <> 0 and id % 101 <> 0 and id % 103 <> 0 as masked from o where id % 501 <> 0),
a as (select dec.pool, dec.masked, cast(sample_id as varchar) as sample_id, 'instance-' || instance_pos as instance_id, cast(round(quantity) as integer) as q, cast(round(discount * 100) as integer) as d,
    cast(x1 % 5 as integer) as x1, cast(y1 % 5 as integer) as y1,
    cast(x1 % 5 as integer) + 1 + cast(round(quantity) as integer) % 4 as x2, cast(y1 % 5 as integer) + 1 + instance_pos % 3 as y2,
    '[' || x1 % 5 || ', ' || y1 % 5 || ', ' || x1 % 5 + 1 + cast(round(quantity) as integer) % 4 || ', ' || y1 % 5 + 1 + instance_pos % 3 || ']' as box
  from v_annotations join dec on dec.id = sample_id)"""
)


@query(
    "pool_audit",
    with_sql(
        """select 13 as pool, 'MISSING_ARTIFACT' as code, 'metrics.jsonl' as artifact, 'required artifact is missing: metrics.jsonl' as message
           union all select pool, 'SAMPLE_COUNT_DRIFT', '', 'counts of manifest, summary and samples differ: [' || n + (pool = 9)::int || ', ' || n + (pool = 3)::int || ', ' || n || ']'
             from (select pool, count(*) as n from o group by pool) where pool = 3 or pool = 9 and 9 % 4 <> 1
           union all select 7, 'CONTRACT_HASH_DRIFT', '', 'contract hashes of manifest and summary differ'
           union all select 11, 'TERMINAL_STATE_DRIFT', '', 'states of control and summary differ: [failed, complete]'
           union all select pool, 'IMAGE_DECODE_FAILED', cast(id as varchar), 'image cannot be decoded' from o where id % 501 = 0
           union all select pool, 'IMAGE_DIMENSION_MISMATCH', cast(id as varchar), 'image size differs from the manifest: [8, 8, 7, 8]' from dec where id % 503 = 0
           union all select pool, 'ANNOTATION_OUT_OF_BOUNDS', sample_id, 'invalid box ' || box from a where x2 > 8 or y2 > 8
           union all select pool, 'NORMALIZED_ANNOTATION_INVALID', sample_id, 'invalid normalized box [' || array_to_string([round(v, 6) for v in [(x1 + x2) / 16.0::double, (y1 + y2) / 16.0::double, (x2 - x1) / 8.0::double, 0.0::double]], ', ') || ']' from a where q = 49
           union all select pool, 'MASK_EVIDENCE_MISSING', cast(id as varchar), 'sample lacks mask evidence' from dec where pool % 5 <> 0 and id % 101 = 0
           union all select pool, 'MASK_EVIDENCE_INVALID', 'masks/' || id, 'mask evidence cannot be read' from dec where pool % 5 <> 0 and id % 101 <> 0 and id % 103 = 0
           union all select distinct pool, 'MASK_INSTANCE_DRIFT', sample_id, 'instances of masks and annotations differ' from a where masked and q = 13
           union all select pool, 'MASK_SEMANTICS_INVALID', instance_id, 'visible coverage exceeds full coverage' from a where masked and q <> 13 and d = 7 and q <> 50
           union all select pool, 'MASK_EMPTY', instance_id, 'instance has no visible coverage' from a where masked and q = 50
           union all select pool, 'MASK_BBOX_MISMATCH', instance_id, 'box of the mask [' || x1 || ', ' || y1 || ', ' || least(x2, 8) || ', ' || least(y2, 8) || '] differs from ' || box from a where masked and q not in (13, 50) and (x2 > 8 or y2 > 8)
           union all select s_nationkey, 'BROKEN_QA_LINK', 'qa/' || s_name, 'link leads nowhere: qa/' || s_name from supplier where s_suppkey % 9 = 0 and s_nationkey <> 13
           union all select pool, 'INVALID_JSONL', 'samples.jsonl', 'not a JSON record: {torn ' || id from o where id % 997 = 0
           union all select 17, 'INVALID_JSON', 'run.json', 'not a JSON document'""",
        SQL_AUDIT,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.pool_audit(**audit_inputs(t))


@query(
    "journal_reconcile",
    """select user_id as pool, event_id as slot, 'journal' as origin from events where user_id % 2 = 0
       union all select user_id, event_id, 'log' from events where user_id % 2 = 1 and event_id % 7 <> 0""",
)
def _(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("user_id").alias("pool"), F.col("event_id").alias("slot"))
    torn = rows.where("slot % 7 <> 0")
    log = torn.unionByName(torn.where("slot % 5 = 0")).withColumn("origin", F.lit("log"))
    journal = rows.where("pool % 2 = 0").withColumn("origin", F.lit("journal"))
    return O.journal_reconcile(log, journal, "pool", ["slot"], ["origin"])


@query(
    "pending_slots",
    """select c_custkey as pool, s as slot from customer, unnest(range(c_custkey % 40)) as u(s)
       where not exists (select 1 from orders where o_custkey = c_custkey and o_orderkey % 40 = s)""",
)
def _(t: Tables) -> DataFrame:
    runs = t.customer.select(F.col("c_custkey").alias("pool"), (F.col("c_custkey") % 40).alias("target"))
    committed = t.orders.select(F.col("o_custkey").alias("pool"), (F.col("o_orderkey") % 40).alias("slot"))
    return O.pending_slots(runs, committed)


@query(
    "next_attempt",
    with_sql(
        "select slot, coalesce(max(case when not ok then attempt end) + 1, 0) as next_attempt from v_slots group by slot", B.SQL_SLOTS
    ),
)
def _(t: Tables) -> DataFrame:
    rows = B.slots(t)
    return O.next_attempt(rows.select("slot").distinct(), rows.where("not ok"))


@query(
    "resume_compat",
    """select c_custkey as pool, 'SCHEMA_NOT_RESUMABLE' as code from customer where c_custkey % 4 = 0
       union all select c_custkey, 'CONTRACT_HASH_DIFFERS' from customer where c_mktsegment = 'BUILDING'
       union all select c_custkey, 'CATALOG_FINGERPRINT_DIFFERS' from customer where c_nationkey % 6 = 0""",
)
def _(t: Tables) -> DataFrame:
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    existing = t.customer.select(
        F.col("c_custkey").alias("pool"), F.when(F.col("c_custkey") % 4 != 0, 2).alias("schema_version"),
        segment.alias("contract_hash"), nation.alias("catalog_fingerprint"),
    )
    wanted = t.customer.select(
        F.col("c_custkey").alias("pool"), F.when(segment == "BUILDING", "new").otherwise(segment).alias("contract_hash"),
        F.when(nation % 6 != 0, nation).alias("catalog_fingerprint"), F.lit(2).alias("schema_version"),
    )
    return O.resume_compat(existing, wanted)


@query(
    "incomplete_runs",
    "select c_name as path, lower(c_mktsegment) as label, 'paused' as actual_state from customer where c_mktsegment = 'MACHINERY' order by path desc limit 10",
)
def _(t: Tables) -> DataFrame:
    state = F.when(F.col("c_mktsegment") == "MACHINERY", "paused").otherwise("complete")
    control = t.customer.select(F.col("c_name").alias("path"), F.lower("c_mktsegment").alias("label"), state.alias("actual_state"))
    return O.incomplete_runs(control)


STATE_OF_CLASS = {"AF": "running", "AO": "draining", "NF": "paused", "NO": "stopping", "RF": "complete", "RO": "running"}


@query(
    "control_log_audit",
    with_sql(
        """select sample_id as run, seq, code from (select *, list_filter([
               case when seq <> ps + 1 then 'SEQUENCE_GAP' end,
               case when p in ('complete', 'interrupted', 'failed') and not (resumed and state = 'running') then 'EVENT_AFTER_TERMINAL' end,
               case when p not in ('complete', 'interrupted', 'failed') and not (resumed and state = 'running') and not (
                 (p = 'running' and state in ('running', 'draining', 'stopping', 'complete')) or (p = 'draining' and state in ('draining', 'paused', 'stopping'))
                 or (p = 'paused' and state in ('paused', 'running', 'stopping')) or (p = 'stopping' and state in ('stopping', 'complete'))) then 'ILLEGAL_TRANSITION' end], lambda c: c is not null) as codes
             from (select *, lag(state) over w as p, lag(seq) over w as ps from e window w as (partition by sample_id order by seq)) where p is not null), unnest(codes) as u(code)""",
        B.SQL_ANNOTATIONS,
        """e as (select sample_id, instance_pos as seq, round(discount * 100) = 10 as resumed,
             case class_name when 'AO' then 'draining' when 'NF' then 'paused' when 'NO' then 'stopping' when 'RF' then 'complete' else 'running' end as state
           from v_annotations where quantity <> 17)""",
    ),
)
def _(t: Tables) -> DataFrame:
    state = F.col("class_name")
    for name, value in STATE_OF_CLASS.items():
        state = F.when(F.col("class_name") == name, value).otherwise(state)
    events = B.annotations(t).where("quantity <> 17").select(
        F.col("sample_id").alias("run"), F.col("instance_pos").alias("seq"), state.alias("state"),
        F.when(F.round(F.col("discount") * 100) == 10, O.RESUMED_EVENT).otherwise("moved").alias("event"),
    )
    return O.control_log_audit(events, F.floor(F.col("seq") / 4))
