"""Splits over two component regimes: shared document lines (one giant) and order lines (many small)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators import components as K
from slotwise.operators import splits as O
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query
from slotwise.plans.sampling_queries import sql_u

SEED = 7
SPLITS = O.fractions({"train": 0.7, "val": 0.2, "test": 0.1})
FRACTIONS = list(SPLITS.values())


def sql_split(u: str) -> str:
    first, second = FRACTIONS[0], FRACTIONS[0] + FRACTIONS[1]
    return f"case when {u} < {first!r}::double then 'train' when {u} < {second!r}::double then 'val' else 'test' end"


@query(
    "normalize_splits",
    """select r_name as name, round(w / s, 9) as fraction, round(hi - w / s, 9) as lo, round(hi, 9) as hi
       from (select r_name, w, s, sum(w / s) over (order by r_regionkey) as hi from (select *, (r_regionkey + 1)::double as w, sum((r_regionkey + 1)::double) over () as s from region))""",
)
def _(t: Tables) -> DataFrame:
    rows = t.region.select(
        F.col("r_name").alias("name"), (F.col("r_regionkey") + 1).cast("double").alias("weight"), F.col("r_regionkey").alias("pos")
    )
    return O.normalize_splits(rows).select("name", *[F.round(c, 9).alias(c) for c in ("fraction", "lo", "hi")])


@query("split_random", with_sql(f"""select key, {sql_split(sql_u("'7'", 'key'))} as split from v_samples""", B.SQL_SAMPLES))
def _(t: Tables) -> DataFrame:
    return O.split_random(B.samples(t).select("key"), "key", SPLITS, SEED)


def strata(t: Tables) -> DataFrame:
    classes = t.lineitem.groupBy(F.col("l_orderkey").alias("sample_id")).agg(
        F.collect_set(F.concat("l_returnflag", "l_linestatus")).alias("classes")
    )
    joined = B.samples(t).join(classes, "sample_id", "left")
    return joined.select("key", "sample_id", O.stratum_of(F.col("classes")).alias("stratum"))


SQL_STRATA = (
    B.SQL_SAMPLES
    + """,
v_strata as (
  select key, sample_id, coalesce(classes, '__negative__') as stratum from v_samples left join
    (select l_orderkey as sample_id, string_agg(c, '|' order by c) as classes from (select distinct l_orderkey, l_returnflag || l_linestatus as c from lineitem) group by 1) using (sample_id))"""
)


@query(
    "split_stratified",
    with_sql(
        """select key, stratum, split from (
             select key, stratum, row_number() over (partition by stratum order by substr(sha256('7:' || stratum || ':' || sample_id), 1, 16), sample_id) as rn from v_strata) s
           join (select split, row_number() over (order by v, i) as rn from (
             select i, split, c / f as v from (values (0, 'train', """
        + f"{FRACTIONS[0]!r}::double), (1, 'val', {FRACTIONS[1]!r}::double), (2, 'test', {FRACTIONS[2]!r}::double)) t(i, split, f), unnest(range((select count(*) from orders))) as u(c))) q using (rn)",
        SQL_STRATA,
    ),
)
def _(t: Tables) -> DataFrame:
    return O.split_stratified(strata(t), "sample_id", "stratum", SPLITS, SEED).select("key", "stratum", "split")


def doc_members(t: Tables) -> tuple[DataFrame, DataFrame]:
    edges = B.doc_edges(t)
    samples = t.documents.select(F.col("doc_id").cast("string").alias("sample"))
    return K.asset_components(samples, edges), edges


def line_members(t: Tables) -> tuple[DataFrame, DataFrame]:
    edges = B.line_edges(t)
    samples = t.orders.select(F.col("o_orderkey").cast("string").alias("sample"))
    return K.asset_components(samples, edges), edges


def doc_labels(t: Tables) -> DataFrame:
    """Classes of a document: its language and, where labelled, its quality; documents without a line are negatives."""
    quality = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id").select(
        F.col("doc_id").cast("string").alias("sample"), F.concat(F.lit("quality"), F.col("quality").cast("string")).alias("class_name")
    )
    lang = t.documents.select(F.col("doc_id").cast("string").alias("sample"), F.col("lang").alias("class_name"))
    rows = lang.unionByName(quality)
    return rows.join(B.doc_edges(t).select("sample").distinct(), "sample", "left_semi")


def sql_components(edges: str, samples: str) -> str:
    return f"""
star as (select distinct e.sample as a, m.sample as b from {edges} e join (select asset, min(sample) as sample from {edges} group by asset) m using (asset) where e.sample <> m.sample),
nb as (select a, b from star union select b, a from star),
reach as (select a, b from nb union select r.a, n.b from reach r join nb n on r.b = n.a),
members as (select s.sample, coalesce(least(s.sample, min(r.b)), s.sample) as component from {samples} s left join reach r on r.a = s.sample group by s.sample),
lanes as (select component, count(*) as size, {", ".join(f"sum(('0x' || substr(d, {1 + 8 * i}, 8))::ubigint::hugeint) as s{i}" for i in range(8))} from (select component, sha256(sample) as d from members) group by component),
comps as (select component, size, concat_ws(':', size, {", ".join(f"s{i}" for i in range(8))}) as key from lanes),
comp as (select component, size, key, substr(sha256(key), 1, 12) as component_id, {sql_u("'7'", 'key')} as u from comps)"""


SQL_DOC = (
    B.SQL_DOC_EDGES
    + """,
doc_samples as (select cast(doc_id as varchar) as sample from documents),
doc_labels as (select sample, class_name from (
    select cast(doc_id as varchar) as sample, lang as class_name from documents
    union all select cast(d.doc_id as varchar), 'quality' || quality from documents d join labels l on d.doc_id = l.doc_id)
  where sample in (select sample from v_doc_edges)),"""
    + sql_components("v_doc_edges", "doc_samples")
)
SQL_LINE = (
    B.SQL_LINE_EDGES
    + ",\nline_samples as (select cast(o_orderkey as varchar) as sample from orders),"
    + sql_components("v_line_edges", "line_samples")
)


@query("asset_components", with_sql("select sample, component from members", SQL_DOC, recursive=True))
def _(t: Tables) -> DataFrame:
    return doc_members(t)[0]


@query("asset_components_many", with_sql("select sample, component from members", SQL_LINE, recursive=True))
def _(t: Tables) -> DataFrame:
    return line_members(t)[0]


@query(
    "component_stats",
    with_sql(
        """select component_id, size, coalesce(assets, 0) as asset_count, coalesce(negatives, 0) as negative_samples, coalesce(classes, '') as classes
           from comp left join (select component, count(distinct asset) as assets from v_doc_edges join members using (sample) group by 1) a using (component)
           left join (select component, count(*) as negatives from members where sample not in (select sample from doc_labels) group by 1) n using (component)
           left join (select component, string_agg(class_name || '=' || n, ',' order by class_name) as classes
             from (select component, class_name, count(*) as n from doc_labels join members using (sample) group by all) group by component) c using (component)""",
        SQL_DOC,
        recursive=True,
    ),
)
def _(t: Tables) -> DataFrame:
    members, edges = doc_members(t)
    table = K.component_table(members, SEED)
    stats, classes = K.component_stats(members, edges, doc_labels(t), table)
    text = classes.groupBy("component").agg(
        F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "class_name", F.col("n").cast("string")))), ",").alias("classes")
    )
    return stats.join(text, "component", "left").na.fill("", ["classes"]).drop("component")


@query(
    "split_asset_disjoint",
    with_sql(f"select sample, component_id, {sql_split('u')} as split from members join comp using (component)", SQL_DOC, recursive=True),
)
def _(t: Tables) -> DataFrame:
    members, _ = doc_members(t)
    members = K.settle(members)
    table = O.split_asset_disjoint(K.component_table(members, SEED), SPLITS)
    return K.samples_of(members, table, ["component_id", "split"]).select("sample", "component_id", "split")


def sql_greedy(extra: str = "") -> str:
    """Greedy assignment as a recursive walk over the ordered components."""
    f = [f"{x!r}::double" for x in FRACTIONS]
    names = ["train", "val", "test"]
    err = [f"abs(c{i} + o.size - t.total * {f[i]}) / greatest(t.total, 1)" for i in range(3)]
    fill = [f"c{i} / {f[i]}" for i in range(3)]
    rows = ", ".join(f"{{'e': {err[i]}, 'f': {fill[i]}, 'n': '{names[i]}'}}" for i in range(3))
    return f"""
ordered as (select *, row_number() over (order by size desc, u, component) as rn from comp),
tot as (select sum(size)::double as total from comp),
walk as (
  select 0::bigint as rn, ''::varchar as component_id, ''::varchar as split, 0::double as c0, 0::double as c1, 0::double as c2
  union all
  select rn, component_id, n, c0 + case when n = 'train' then size else 0 end, c1 + case when n = 'val' then size else 0 end, c2 + case when n = 'test' then size else 0 end
  from (select o.rn, o.component_id, o.size, c0, c1, c2, list_sort([{rows}])[1].n as n from walk w join ordered o on o.rn = w.rn + 1, tot t))"""


@query(
    "split_greedy_sample",
    with_sql("select component_id, split from walk where rn > 0", SQL_DOC, sql_greedy(), recursive=True),
)
def _(t: Tables) -> DataFrame:
    table = K.component_table(doc_members(t)[0], SEED)
    return O.split_greedy_sample(table, SPLITS).select("component_id", "split")


@query("split_greedy_sample_many")
def _(t: Tables) -> DataFrame:
    table = K.component_table(line_members(t)[0], SEED)
    return O.split_greedy_sample(table, SPLITS).select("component_id", "split")


def sql_greedy_class() -> str:
    """The walk with one count per split and class; classes are added in name order."""
    f = [f"{x!r}::double" for x in FRACTIONS]
    names = ["train", "val", "test"]

    def error(i: int) -> str:
        part = f"case when o.v[k] > 0 then abs(w.m{i}[k] + o.v[k] - t.tv[k] * {f[i]}) / greatest(t.tv[k], 1) else 0.0::double end"
        listed = f"list_transform(range(1, len(t.tv) + 1), lambda k: {part})"
        return f"abs(c{i} + o.size - t.total * {f[i]}) / greatest(t.total, 1) + list_reduce({listed}, lambda a, b: a + b)"

    rows = ", ".join(f"{{'e': {error(i)}, 'f': c{i} / {f[i]}, 'n': '{names[i]}'}}" for i in range(3))
    grown = ", ".join(
        f"case when n = '{names[i]}' then list_transform(range(1, len(v) + 1), lambda k: m{i}[k] + v[k]) else m{i} end" for i in range(3)
    )
    return f"""
cls as (select class_name, row_number() over (order by class_name) as k, count(*)::double as tot from doc_labels join members using (sample) group by class_name),
per as (select component, class_name, count(*)::double as n from doc_labels join members using (sample) group by all),
vec as (select component, list(coalesce(n, 0.0::double) order by k) as v, coalesce(string_agg(class_name || '=' || n::bigint, ',' order by class_name) filter (n > 0), '') as kind from comp cross join cls left join per using (component, class_name) group by component),
ordered as (select *, row_number() over (order by size desc, kind, u, component) as rn from comp join vec using (component)),
tot as (select (select sum(size)::double from comp) as total, (select list(tot order by k) from cls) as tv),
walk as (
  select 0::bigint as rn, ''::varchar as component_id, ''::varchar as split, 0::double as c0, 0::double as c1, 0::double as c2,
    list_transform(tv, lambda x: 0::double) as m0, list_transform(tv, lambda x: 0::double) as m1, list_transform(tv, lambda x: 0::double) as m2 from tot
  union all
  select rn, component_id, n, c0 + case when n = 'train' then size else 0 end, c1 + case when n = 'val' then size else 0 end, c2 + case when n = 'test' then size else 0 end, {grown}
  from (select o.rn, o.component_id, o.size, o.v, c0, c1, c2, m0, m1, m2, list_sort([{rows}])[1].n as n from walk w join ordered o on o.rn = w.rn + 1, tot t))"""


@query(
    "split_greedy_class",
    with_sql("select component_id, split from walk where rn > 0", SQL_DOC, sql_greedy_class(), recursive=True),
)
def _(t: Tables) -> DataFrame:
    members, edges = doc_members(t)
    table = K.settle(K.component_table(members, SEED))
    _, classes = K.component_stats(members, edges, doc_labels(t), table)
    return O.split_greedy_class(table, classes, SPLITS).select("component_id", "split")


def sql_greedy_class_walk() -> str:
    """The class-aware walk under names of its own, beside the plain one."""
    out = sql_greedy_class()
    for name, other in (("ordered", "class_ordered"), ("walk", "class_walk"), ("tot as (", "class_tot as ("), (", tot t)", ", class_tot t)"), ("from tot\n", "from class_tot\n")):
        out = out.replace(name, other)
    return out


@query(
    "split_comparison",
    with_sql(
        f"""select policy, split, cast(coalesce(n, 0) as bigint) as sample_count, round(total * fraction, 6) as requested, round(coalesce(n, 0) - total * fraction, 6) as deviation,
             round(sum(abs(coalesce(n, 0) - total * fraction)) over (partition by policy) / total, 9) as l1_fraction_deviation,
             round(max(abs(coalesce(n, 0) - total * fraction)) over (partition by policy) / total, 9) as maximum_fraction_deviation, coalesce(class_counts, '') as class_counts
           from (values ('train', {FRACTIONS[0]!r}::double), ('val', {FRACTIONS[1]!r}::double), ('test', {FRACTIONS[2]!r}::double)) s(split, fraction)
           cross join (values ('hash'), ('greedy-sample'), ('greedy-class')) p(policy) cross join tot
           left join (select policy, split, sum(size) as n from assigned group by all) a using (policy, split)
           left join (select policy, split, string_agg(class_name || '=' || n, ',' order by class_name) as class_counts from (
             select policy, split, class_name, sum(n)::bigint as n from assigned join per using (component) group by all) group by all) c using (policy, split)""",
        SQL_DOC,
        sql_greedy(),
        sql_greedy_class_walk(),
        f"""assigned as (select 'hash' as policy, component, {sql_split('u')} as split, size from comp
             union all select 'greedy-sample', component, split, size from walk join comp using (component_id)
             union all select 'greedy-class', component, split, size from class_walk join comp using (component_id))""",
        recursive=True,
    ),
)
def _(t: Tables) -> DataFrame:
    members, edges = doc_members(t)
    table = K.settle(K.component_table(members, SEED))
    classes = K.settle(K.component_stats(members, edges, doc_labels(t), table)[1])
    policies = {
        "hash": O.split_asset_disjoint(table, SPLITS), "greedy-sample": O.split_greedy_sample(table, SPLITS),
        "greedy-class": O.split_greedy_class(table, classes, SPLITS),
    }
    parts = [frame.select(F.lit(name).alias("policy"), "split", "size", "component") for name, frame in policies.items()]
    detail, summary = O.split_comparison(parts[0].unionByName(parts[1]).unionByName(parts[2]), SPLITS, classes)
    counts = F.array_join(F.transform(F.map_entries("class_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    out = detail.join(summary, "policy").withColumn("class_counts", counts)
    digits = {"requested": 6, "deviation": 6, "l1_fraction_deviation": 9, "maximum_fraction_deviation": 9}
    for name, d in digits.items():
        out = out.withColumn(name, F.round(name, d))
    return out


@query(
    "split_feasibility",
    with_sql(
        f"""select 'support' as kind, class_name as key, count(*) as sample_support, count(distinct component) as component_support, null::double as value from doc_labels join members using (sample) group by class_name
           union all select 'CLASS_PARTITION_FRAGILE', class_name, null, null, null from doc_labels join members using (sample) group by class_name having count(distinct component) < 3
           union all select 'ASSET_DISJOINT_SPLITS_IMPOSSIBLE', cast(count(*) as varchar), null, null, null from comp having count(*) < 3
           union all select 'component_size', size::varchar, null, null, count(*)::double from comp group by size
           union all select 'largest_component_fraction', '', null, null, round(max(size)::double / (select count(*) from documents), 9) from comp
           union all select 'all_splits_populatable', '', null, null, case when count(*) >= 3 then 1 else 0 end from comp
           union all select 'HASH_ASSIGNMENT_IMBALANCED', split, null, null, null from (values ('train', {FRACTIONS[0]!r}::double), ('val', {FRACTIONS[1]!r}::double), ('test', {FRACTIONS[2]!r}::double)) s(split, fraction)
             left join (select {sql_split('u')} as split, sum(size) as n from comp group by 1) a using (split) where abs(coalesce(n, 0) - fraction * (select count(*) from documents)) >= 1""",
        SQL_DOC,
        recursive=True,
    ),
)
def _(t: Tables) -> DataFrame:
    members, edges = doc_members(t)
    table = K.settle(K.component_table(members, SEED))
    _, classes = K.component_stats(members, edges, doc_labels(t), table)
    support, findings, shape = O.split_feasibility(table, classes, O.split_asset_disjoint(table, SPLITS), SPLITS)
    rows = support.select(F.lit("support").alias("kind"), F.col("class_name").alias("key"), "sample_support", "component_support")
    shape = shape.select(F.col("fact").alias("kind"), "key", F.round("value", 9).alias("value"))
    return rows.unionByName(findings.withColumnRenamed("code", "kind"), allowMissingColumns=True).unionByName(shape, allowMissingColumns=True)
