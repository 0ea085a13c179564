"""The generic star-schema tables seen as pool records.

Every binding exists twice: as a DataFrame for Spark and as a common table
expression (``SQL``) for the SQL check. Column names are the same on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.functions import geometry as G
from slotwise.session import use_utc

FRAME = 1000


class Tables:
    """Lazy access to the parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = use_utc(spark), str(folder).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def epoch_micros(column: str | Column) -> Column:
    """Microseconds since 1970 of a wall-clock timestamp read as UTC."""
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(column.cast("timestamp"))


def annotations(t: Tables, positions: bool = True) -> DataFrame:
    li = t.lineitem
    sample = Window.partitionBy("l_orderkey")
    ordered = sample.orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    qty = F.round("l_quantity").cast("int")
    x1, y1 = (F.col("l_partkey") * 7) % 1000, (F.col("l_suppkey") * 13) % 1000
    columns = [
        F.col("l_orderkey").alias("sample_id"),
        F.concat("l_returnflag", "l_linestatus").alias("class_name"),
        F.col("l_returnflag").alias("source_group"),
        F.col("l_linestatus").alias("status"),
        F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), qty.cast("string")).alias(
            "source_asset"
        ),
        (F.lit(0.10) + F.col("l_discount") * 3).alias("scale"),
        (F.col("l_tax") * 4500 - 180).alias("rotation"),
        F.count(F.lit(1)).over(sample).alias("requested_objects"),
        x1.alias("x1"),
        y1.alias("y1"),
        (x1 + qty * 4).alias("x2"),
        (y1 + 20 + F.round(F.col("l_discount") * 1000).cast("int")).alias("y2"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    ]
    if positions:
        columns.insert(1, F.row_number().over(ordered).alias("instance_pos"))
    return li.select(*columns)


SQL_ANNOTATIONS = """
v_annotations as (
  select l_orderkey as sample_id,
    cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as integer) as instance_pos,
    l_returnflag || l_linestatus as class_name, l_returnflag as source_group, l_linestatus as status,
    l_partkey || '/' || l_suppkey || '/' || cast(round(l_quantity) as integer) as source_asset,
    0.10::double + l_discount * 3 as scale, l_tax * 4500 - 180 as rotation,
    count(*) over (partition by l_orderkey) as requested_objects,
    (l_partkey * 7) % 1000 as x1, (l_suppkey * 13) % 1000 as y1,
    (l_partkey * 7) % 1000 + cast(round(l_quantity) as integer) * 4 as x2,
    (l_suppkey * 13) % 1000 + 20 + cast(round(l_discount * 1000) as integer) as y2,
    l_quantity as quantity, l_extendedprice as price, l_discount as discount, l_tax as tax
  from lineitem)"""


def box_of(frame: DataFrame) -> Column:
    return G.box(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))


def attempts(t: Tables, positions: bool = False) -> DataFrame:
    a = annotations(t, positions)
    b = box_of(a)
    stage = F.when(F.col("status") == "F", "planner.placement").otherwise("renderer.visibility")
    reason = F.when(F.col("status") == "F", "placement_attempts_exhausted").otherwise("visible_bbox_fraction")
    return a.select(
        "*",
        (F.col("quantity") > 35).alias("rejected"),
        stage.alias("stage"),
        reason.alias("reason"),
        G.spatial_region((b["x1"] + b["x2"]) / 2.0, (b["y1"] + b["y2"]) / 2.0, FRAME, FRAME).alias("region"),
    )


def sql_region(x: str, y: str, size: str = "1000.0") -> str:
    rows = "['top','middle','bottom']"
    cols = "['left','center','right']"
    cell = "cast(least(2, greatest(0, floor({v} / {s} * 3))) as integer) + 1"
    return f"{rows}[{cell.format(v=y, s=size)}] || '-' || {cols}[{cell.format(v=x, s=size)}]"


SQL_ATTEMPTS = (
    SQL_ANNOTATIONS
    + f""",
v_attempts as (
  select *, quantity > 35 as rejected,
    case status when 'F' then 'planner.placement' else 'renderer.visibility' end as stage,
    case status when 'F' then 'placement_attempts_exhausted' else 'visible_bbox_fraction' end as reason,
    {sql_region('((x1 + x2) / 2.0)', '((y1 + y2) / 2.0)')} as region
  from v_annotations)"""
)


def samples(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("sample_id"),
        (F.col("o_custkey") % 2).cast("int").alias("pool_index"),
        F.concat_ws(":", (F.col("o_custkey") % 2).cast("string"), F.col("o_orderkey").cast("string")).alias("key"),
    )


SQL_SAMPLES = """
v_samples as (
  select o_orderkey as sample_id, cast(o_custkey % 2 as integer) as pool_index,
    (o_custkey % 2) || ':' || o_orderkey as key
  from orders)"""


def stages(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.col("event_type").alias("stage"),
        F.round(F.col("value") * 1000).cast("bigint").alias("ns"),
        (F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).alias("in_session"),
    )


SQL_STAGES = """
v_stages as (
  select event_id, event_type as stage, cast(round(value * 1000) as bigint) as ns,
    ts >= timestamp '2024-01-15' as in_session
  from events)"""


def metrics(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").cast("string").alias("session_id"),
        F.col("event_id").alias("sequence"),
        F.col("ts").alias("ingested_at"),
        F.col("value").alias("cpu_percent"),
        (F.get_json_object("props", "$.k").cast("bigint") * 1048576).alias("rss_bytes"),
        F.col("event_type").alias("run_state"),
    )


SQL_METRICS = """
v_metrics as (
  select cast(user_id as varchar) as session_id, event_id as sequence, ts as ingested_at, value as cpu_percent,
    cast(json_extract_string(props, '$.k') as bigint) * 1048576 as rss_bytes, event_type as run_state
  from events)"""


def control(t: Tables) -> DataFrame:
    """State changes per run; ``seq`` orders them (event ids follow time)."""
    return (
        t.events.where(F.col("event_type").isin("error", "signup", "purchase"))
        .select(
            F.col("user_id").alias("run"),
            F.col("event_id").alias("seq"),
            epoch_micros("ts").alias("us"),
            F.when(F.col("event_type") == "error", "paused").otherwise("running").alias("state"),
        )
    )


SQL_CONTROL = """
v_control as (
  select user_id as run, event_id as seq, epoch_us(ts) as us,
    case event_type when 'error' then 'paused' else 'running' end as state
  from events where event_type in ('error', 'signup', 'purchase'))"""


def doc_lines(t: Tables) -> DataFrame:
    """Distinct (document, line) without blank lines."""
    line = F.explode(F.split(F.col("text"), "\n"))
    return (
        t.documents.select(F.col("doc_id"), line.alias("raw"))
        .select("doc_id", F.trim("raw").alias("line"))
        .where(F.length("line") > 0)
        .distinct()
    )


def doc_edges(t: Tables) -> DataFrame:
    """Sample-asset edges: a document and the digest of each of its lines."""
    return doc_lines(t).select(
        F.col("doc_id").cast("string").alias("sample"), F.sha2("line", 256).alias("asset")
    )


SQL_DOC_EDGES = """
v_doc_lines as (
  select distinct doc_id, line from (
    select doc_id, trim(unnest(string_split(text, chr(10)))) as line from documents)
  where length(line) > 0),
v_doc_edges as (
  select cast(doc_id as varchar) as sample, sha256(line) as asset from v_doc_lines)"""


def line_edges(t: Tables) -> DataFrame:
    a = annotations(t, positions=False)
    return a.select(F.col("sample_id").cast("string").alias("sample"), F.col("source_asset").alias("asset")).distinct()


SQL_LINE_EDGES = (
    SQL_ANNOTATIONS
    + """,
v_line_edges as (
  select distinct cast(sample_id as varchar) as sample, source_asset as asset from v_annotations)"""
)


def assets(t: Tables) -> DataFrame:
    p = t.part
    logical = F.concat(F.lit("root0/"), "p_brand", F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("_")),
                       F.lit("_"), F.col("p_size").cast("string"))
    return p.select(
        F.col("p_partkey").alias("asset_id"),
        logical.alias("logical_path"),
        F.col("p_brand").alias("group"),
        F.col("p_type").alias("class_name"),
        F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), F.col("p_size").cast("string")).alias("stem"),
        F.sha2(logical, 256).alias("content_hash"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


SQL_ASSETS = """
v_assets as (
  select p_partkey as asset_id,
    'root0/' || p_brand || '/' || replace(p_name, ' ', '_') || '_' || p_size as logical_path,
    p_brand as "group", p_type as class_name,
    replace(p_name, ' ', '_') || '_' || p_size as stem,
    sha256('root0/' || p_brand || '/' || replace(p_name, ' ', '_') || '_' || p_size) as content_hash,
    p_size as size, p_retailprice as price
  from part)"""


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(
        "vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("v")
    )


SQL_VECTORS = """
v_vectors as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings)"""

MASKS_PER_SAMPLE = 8


def masks(t: Tables) -> DataFrame:
    """Eight full coverage arrays (8x8, 0..255) per sample, in composition order."""
    v = vectors(t)
    return v.select(
        F.floor(F.col("vec_id") / MASKS_PER_SAMPLE).cast("bigint").alias("sample"),
        (F.col("vec_id") % MASKS_PER_SAMPLE).cast("int").alias("order"),
        "vec_id",
        F.transform("v", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.round(x * 500).cast("int")))).alias("full"),
    )


SQL_MASKS = (
    SQL_VECTORS
    + f""",
v_masks as (
  select vec_id // {MASKS_PER_SAMPLE} as sample, cast(vec_id % {MASKS_PER_SAMPLE} as integer) as ord, vec_id,
    list_transform(v, lambda x: cast(greatest(0, least(255, round(x * 500))) as integer)) as "full"
  from v_vectors),
v_mask_px as (
  select sample, ord, vec_id, unnest(range(64)) as px, unnest("full") as f from v_masks),
v_visible_px as (
  select sample, ord, vec_id, px, f,
    cast(round_even(greatest(0.0::double, least(1.0::double,
      list_reduce(list_concat([f / 255.0::double], later), lambda x, y: x * y))) * 255.0::double, 0) as integer) as vis
  from (select a.sample, a.ord, a.vec_id, a.px, a.f,
      coalesce(list(1.0::double - b.f / 255.0::double order by b.ord) filter (b.ord is not null), []) as later
    from v_mask_px a left join v_mask_px b on a.sample = b.sample and a.px = b.px and b.ord > a.ord
    group by a.sample, a.ord, a.vec_id, a.px, a.f)),
v_visible as (
  select sample, ord, vec_id, list(f order by px) as "full", list(vis order by px) as visible
  from v_visible_px group by sample, ord, vec_id)"""
)


def slots(t: Tables) -> DataFrame:
    return t.conversations.select(
        F.col("conv_id").alias("slot"), F.col("turn").alias("attempt"), (F.col("role") == "assistant").alias("ok")
    )


SQL_SLOTS = """
v_slots as (select conv_id as slot, turn as attempt, role = 'assistant' as ok from conversations)"""


def measurements(t: Tables) -> DataFrame:
    """Fixture x treatment rows."""
    a = annotations(t)
    return a.select(
        F.col("sample_id").alias("fixture"),
        F.col("instance_pos").alias("treatment"),
        F.round(F.col("price") * 100).cast("bigint").alias("render_ns"),
        F.round(F.col("quantity") * 1000).cast("bigint").alias("synthesis_ns"),
        F.round(F.col("tax") * 1000000).cast("bigint").alias("encode_ns"),
        F.round(F.col("discount") * 1000000).cast("bigint").alias("write_ns"),
        F.col("requested_objects").alias("object_count"),
        (F.round("quantity").cast("int") / 10.0).alias("megapixels"),
        F.col("class_name").alias("recipe_id"),
        "source_asset",
        "x1", "y1", "x2", "y2", "tax", "discount",
    )


SQL_MEASUREMENTS = (
    SQL_ANNOTATIONS
    + """,
v_measurements as (
  select sample_id as fixture, instance_pos as treatment, cast(round(price * 100) as bigint) as render_ns,
    cast(round(quantity * 1000) as bigint) as synthesis_ns, cast(round(tax * 1000000) as bigint) as encode_ns,
    cast(round(discount * 1000000) as bigint) as write_ns, requested_objects as object_count,
    cast(round(quantity) as integer) / 10.0::double as megapixels, class_name as recipe_id, source_asset,
    x1, y1, x2, y2, tax, discount
  from v_annotations)"""
)


def jobs(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("job"),
        F.col("c_mktsegment").alias("fingerprint"),
        F.when(F.col("c_custkey") % 5 < 2, "linux-8").otherwise("windows-8").alias("environment"),
        (F.col("c_custkey") % 6 + 1).cast("int").alias("workers"),
        (F.lit(1) + F.col("c_custkey") % 50).alias("num_images"),
        (F.lit(320) + (F.col("c_nationkey") * 64)).cast("int").alias("width"),
        (F.lit(320) + (F.col("c_custkey") % 10) * 96).cast("int").alias("height"),
        F.when(F.col("c_nationkey") % 2 == 0, "png").otherwise("jpg").alias("image_format"),
        (F.lit(1) + F.col("c_custkey") % 10).cast("int").alias("max_instances"),
        (F.round(F.abs("c_acctbal")).cast("bigint") * 100000).alias("free_bytes"),
    )


SQL_JOBS = """
v_jobs as (
  select c_custkey as job, c_mktsegment as fingerprint, case when c_custkey % 5 < 2 then 'linux-8' else 'windows-8' end as environment, cast(c_custkey % 6 + 1 as integer) as workers,
    1 + c_custkey % 50 as num_images, cast(320 + c_nationkey * 64 as integer) as width,
    cast(320 + (c_custkey % 10) * 96 as integer) as height,
    case when c_nationkey % 2 = 0 then 'png' else 'jpg' end as image_format,
    cast(1 + c_custkey % 10 as integer) as max_instances,
    cast(round(abs(c_acctbal)) as bigint) * 100000 as free_bytes
  from customer)"""


def observations(t: Tables) -> DataFrame:
    """Finished orders as observations; one segment has another name than its jobs, one only probes."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return o.select(
        F.when(F.col("c_mktsegment") == "BUILDING", "BUILDING-2").otherwise(F.col("c_mktsegment")).alias("fingerprint"),
        F.element_at(F.array(F.lit("linux-8"), F.lit("windows-8"), F.lit("mac-8")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("environment"),
        (F.col("o_custkey") % 4 + 1).cast("int").alias("workers"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("c_mktsegment") != "MACHINERY"), "production")
        .otherwise("probe").alias("kind"),
        (F.col("o_totalprice") / 100000).alias("seconds"),
    )


SQL_OBSERVATIONS = """
v_observations as (
  select case c_mktsegment when 'BUILDING' then 'BUILDING-2' else c_mktsegment end as fingerprint, ['linux-8', 'windows-8', 'mac-8'][o_orderkey % 3 + 1] as environment, cast(o_custkey % 4 + 1 as integer) as workers,
    case when o_orderstatus = 'F' and c_mktsegment <> 'MACHINERY' then 'production' else 'probe' end as kind,
    o_totalprice / 100000 as seconds
  from orders join customer on o_custkey = c_custkey)"""


def overrides(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("config"),
        F.col("event_type").alias("path"),
        F.col("props").alias("value"),
        (F.col("event_id") % 5).cast("int").alias("layer"),
        F.col("event_id").alias("pos"),
    )


SQL_OVERRIDES = """
v_overrides as (
  select user_id as config, event_type as path, props as value, cast(event_id % 5 as integer) as layer, event_id as pos
  from events)"""


def sql_whole(value: str, hundredths: int) -> str:
    """Interpolated percentile of whole numbers in whole numbers, truncated toward zero."""
    values, at = f"list({value} order by {value})", f"((count(*) - 1) * {hundredths})"
    low, high = f"({values})[1 + {at} // 100]", f"({values})[least(count(*), 2 + {at} // 100)]"
    return f"cast(({low} * 100 + ({high} - {low}) * ({at} % 100)) // 100 as bigint)"


def with_sql(body: str, *ctes: str, recursive: bool = False) -> str:
    """A query over the given table expressions."""
    head = "with recursive" if recursive else "with"
    return f"{head} {', '.join(cte.strip() for cte in ctes)}\n{body}"
