"""Label export over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators import export as O
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query


@query(
    "merge_class_catalog",
    """with c as (select cast(substr(p_brand, 7) as integer) as pool, p_name as name, row_number() over (partition by p_brand order by p_name) as pos from (select distinct p_brand, p_name from part)),
       f as (select name, min(pool * 100000 + pos) as k from c group by name)
       select name as class_name, cast(row_number() over (order by k) - 1 as integer) as class_id from f""",
)
def _(t: Tables) -> DataFrame:
    runs = t.part.groupBy(F.substring("p_brand", 7, 9).cast("int").alias("pool_index")).agg(
        F.array_sort(F.collect_set("p_name")).alias("classes")
    )
    return O.merge_class_catalog(runs)


def named_samples(t: Tables) -> DataFrame:
    """File names repeat within and across pools."""
    return B.samples(t).select(
        "key", "pool_index", F.concat(F.lit("img_"), (F.col("sample_id") % 5000).cast("string"), F.lit(".png")).alias("name")
    )


@query(
    "allocate_filenames",
    with_sql("select key, printf('image_%08d', row_number() over (order by key) - 1) || '.png' as filename from v_samples", B.SQL_SAMPLES),
)
def _(t: Tables) -> DataFrame:
    return O.allocate_filenames(named_samples(t), preserve=False).select("key", "filename")


@query(
    "allocate_filenames_preserved",
    with_sql(
        """select key, stem || case when nth = 1 then '' else '_pool' || pool_index || case when again > 1 then '_' || again else '' end end || '.png' as filename
           from (select *, row_number() over (partition by stem, pool_index, nth > 1 order by key) as again
             from (select *, row_number() over (partition by stem order by key) as nth from (select *, 'img_' || (sample_id % 5000) as stem from v_samples)))""",
        B.SQL_SAMPLES,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.allocate_filenames(named_samples(t), preserve=True).select("key", "filename")


def class_ids(t: Tables) -> DataFrame:
    names = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("class_name")).distinct()
    runs = names.groupBy(F.lit(0).alias("pool_index")).agg(F.array_sort(F.collect_list("class_name")).alias("classes"))
    return O.merge_class_catalog(runs)


SQL_CLASS_IDS = "v_class_ids as (select class_name, row_number() over (order by class_name) - 1 as class_id from (select distinct class_name from v_annotations))"


def label_rows(t: Tables) -> DataFrame:
    a = B.annotations(t).select(
        F.col("sample_id").alias("sample"), F.col("instance_pos").alias("pos"), "class_name", "x1", "y1", "x2", "y2"
    )
    samples = t.orders.select(F.col("o_orderkey").alias("sample"))
    return O.label_lines(samples, a, class_ids(t), 1000, 1000)


@query(
    "label_lines",
    with_sql(
        """select o_orderkey as sample, coalesce(text || chr(10), '') as text from orders left join (
             select sample_id, string_agg(printf('%d %.6f %.6f %.6f %.6f', class_id, (x1 + x2) / 2.0 / 1000, (y1 + y2) / 2.0 / 1000, (x2 - x1) / 1000.0, (y2 - y1) / 1000.0), chr(10) order by instance_pos) as text
             from v_annotations join v_class_ids using (class_name) group by sample_id) on sample_id = o_orderkey""",
        B.SQL_ANNOTATIONS,
        SQL_CLASS_IDS,
    ),
)
def _(t: Tables) -> DataFrame:
    return label_rows(t)


@query(
    "polygon_lines",
    with_sql(
        """select sample_id, instance_pos, class_id || ' ' || printf('%.6f %.6f %.6f %.6f %.6f %.6f', a, b, c, b, c, d) as line
           from (select *, least(1.0, greatest(0.0, (x1 - 50) / 1000.0)) as a, least(1.0, greatest(0.0, y1 / 1000.0)) as b, least(1.0, greatest(0.0, x2 / 1000.0)) as c, least(1.0, greatest(0.0, y2 / 1000.0)) as d
                 from v_annotations join v_class_ids using (class_name))""",
        B.SQL_ANNOTATIONS,
        SQL_CLASS_IDS,
    ),
)
def _(t: Tables) -> DataFrame:
    def point(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    rows = B.annotations(t).join(class_ids(t), "class_name").withColumn(
        "points", F.array(point(x1 - 50, y1), point(x2, y1), point(x2, y2))
    )
    return O.polygon_lines(rows, 1000, 1000).select("sample_id", "instance_pos", "line")


@query(
    "effective_semantics",
    """select c_nationkey as pool, case when min(s) = max(s) then min(s) else 'mixed' end as mask_semantics
       from (select c_nationkey, case when c_nationkey % 3 = 0 then 'full' when c_nationkey % 3 = 1 and c_custkey % 10 = 0 then 'full' else 'visible' end as s from customer) group by 1""",
)
def _(t: Tables) -> DataFrame:
    nation = F.col("c_nationkey")
    default = F.when(nation % 3 == 0, "full").when((nation % 3 == 1) & (F.col("c_custkey") % 10 == 0), "full").when(nation % 3 == 1, "visible")
    runs = t.customer.select(nation.alias("pool"), default.alias("default_mask_semantics"))
    return O.semantics_report(O.effective_semantics("family", runs), ("pool",))


@query(
    "export_gate",
    """select s_suppkey as pool, case when s_acctbal < 0 and s_nationkey % 4 = 0 then 'CONTRACT_HASH_DRIFT, MASK_EMPTY' when s_acctbal < 0 then 'CONTRACT_HASH_DRIFT' else 'SCHEMA_WITHOUT_MASKS' end as reason
       from supplier where s_acctbal < 0 or s_suppkey % 3 = 0""",
)
def _(t: Tables) -> DataFrame:
    bad = t.supplier.where("s_acctbal < 0").select(F.col("s_suppkey").alias("pool"), "s_nationkey")
    findings = bad.select("pool", F.lit("CONTRACT_HASH_DRIFT").alias("code")).unionByName(
        bad.where("s_nationkey % 4 = 0").select("pool", F.lit("MASK_EMPTY").alias("code"))
    )
    runs = t.supplier.select(
        F.col("s_suppkey").alias("pool"), F.when(F.col("s_suppkey") % 3 != 0, 2).alias("schema_version")
    )
    return O.export_gate(findings, runs, "segmentation")
