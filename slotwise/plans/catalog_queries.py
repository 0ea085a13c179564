"""Catalog operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions import arrays as A
from slotwise.functions import text as X
from slotwise.operators import catalog as O
from slotwise.plans import bindings as B
from slotwise.plans.bindings import Tables, with_sql
from slotwise.plans.registry import query

HARVEST_PATTERN = r"utm_source=([^&#]+)"
HARVEST_LIMIT = 10


@query(
    "harvest_urls",
    f"""select host as category, page_id as asset_id, value as url from (
          select *, row_number() over (partition by host order by page_id) as rn from (
            select page_id, regexp_extract(url, '://([^/]+)', 1) as host,
              nullif(trim(string_split(url_decode(regexp_extract(url, '{HARVEST_PATTERN}', 1)), ',')[1]), '') as value from pages)
          where value is not null) where rn <= {HARVEST_LIMIT}""",
)
def _(t: Tables) -> DataFrame:
    from slotwise.sources.pools import harvest_urls

    rows = t.pages.select("page_id", F.regexp_extract("url", "://([^/]+)", 1).alias("host"), "url")
    return harvest_urls(rows, "url", "host", "page_id", HARVEST_LIMIT, HARVEST_PATTERN)


@query(
    "catalog_enrich",
    with_sql(
        """select a.asset_id, a."group", coalesce(m.tag || '|' || m.size_tag, '') as tags, m.seamless
           from v_assets a left join m on a.asset_id = m.asset_id where not coalesce(m.excluded, false)""",
        B.SQL_ASSETS,
        """m as (select p_partkey as asset_id, p_size % 7 = 0 as excluded, p_type as tag, 'size' || p_size as size_tag,
             p_size % 2 = 0 as seamless from part where p_partkey % 3 <> 0)""",
    ),
)
def _(t: Tables) -> DataFrame:
    assets = B.assets(t).select(F.col("asset_id").alias("path"), "group")
    metadata = t.part.where("p_partkey % 3 <> 0").select(
        F.col("p_partkey").alias("path"),
        (F.col("p_size") % 7 == 0).alias("excluded"),
        F.array("p_type", F.concat(F.lit("size"), F.col("p_size").cast("string"))).alias("tags"),
        (F.col("p_size") % 2 == 0).alias("seamless"),
    )
    out = O.catalog_enrich(assets, metadata)
    return out.select(F.col("path").alias("asset_id"), "group", F.array_join("tags", "|").alias("tags"), "seamless")


@query(
    "asset_group",
    """select "group", optional_group, count(*) as n from (
         select case when len(p) > 1 then p[1] else 'pages' end as "group", case when len(p) > 1 then p[1] end as optional_group
         from (select string_split(regexp_replace(url, '^https?://[^/]+/', ''), '/') as p from pages)) group by all""",
)
def _(t: Tables) -> DataFrame:
    path = F.regexp_replace("url", "^https?://[^/]+/", "")
    rows = t.pages.select(X.asset_group(path, "pages").alias("group"), X.asset_group(path).alias("optional_group"))
    return rows.groupBy("group", "optional_group").agg(F.count(F.lit(1)).alias("n"))


# Ordered class rules of the query below: whole-stem patterns and class templates.
CLASS_RULES = (
    (r"ECONOMY/(?P<shape>.+)_gadget_\d+", "{shape}_gadget"),
    (r"(?:STANDARD|LARGE)/(?P<class_name>[a-z]+_[a-z]+)_\d+", "{class_name}"),
    (r"LARGE/(?P<class_name>[a-z]+_ring)_\d+", "large_{class_name}"),
    (r"(?P<kind>PROMO)/.+", "{kind}"),
)


def declared_classes(t: Tables) -> list[str]:
    colors = ["small", "red", "blue", "green", "large", "hot", "cold", "shiny", "tiny", "old", "new"]
    return [f"{c}_gadget" for c in colors] + [f"{c}_ring" for c in colors] + ["PROMO"]


@query(
    "class_map_exactly_one",
    """with s as (select p_partkey, p_type || '/' || replace(p_name, ' ', '_') || '_' || p_size as stem from part),
    m as (select stem, list_filter([
        case when regexp_full_match(stem, 'ECONOMY/(.+)_gadget_\\d+') then regexp_extract(stem, '^ECONOMY/(.+)_gadget_\\d+$', 1) || '_gadget' end,
        case when regexp_full_match(stem, '(?:STANDARD|LARGE)/([a-z]+_[a-z]+)_\\d+') then regexp_extract(stem, '^(?:STANDARD|LARGE)/([a-z]+_[a-z]+)_\\d+$', 1) end,
        case when regexp_full_match(stem, 'LARGE/([a-z]+_ring)_\\d+') then 'large_' || regexp_extract(stem, '^LARGE/([a-z]+_ring)_\\d+$', 1) end,
        case when regexp_full_match(stem, '(PROMO)/.+') then 'PROMO' end], lambda x: x is not null) as hits from s),
    d as (select list_concat(list_transform(c, lambda x: x || '_gadget'), list_transform(c, lambda x: x || '_ring'), ['PROMO']) as names
          from (select ['small','red','blue','green','large','hot','cold','shiny','tiny','old','new'] as c)),
    j as (select stem, len(hits) as matches, case when len(hits) = 1 then hits[1] end as class_name, names from m, d)
    select coalesce(class_name, '') as class_name,
      cast(case when matches = 1 and list_contains(names, class_name) then list_position(names, class_name) - 1 end as bigint) as class_id,
      case when matches <> 1 then 'CLASS_RULE_NOT_UNIQUE' when not list_contains(names, class_name) then 'CLASS_NOT_DECLARED' else 'ok' end as code,
      count(*) as n
    from (select case when matches = 1 and list_contains(names, class_name) then class_name end as class_name, matches, names, class_name as raw from j) x
    group by all""".replace(
        "case when matches <> 1 then 'CLASS_RULE_NOT_UNIQUE' when not list_contains(names, class_name)",
        "case when matches <> 1 then 'CLASS_RULE_NOT_UNIQUE' when not list_contains(names, raw)",
    ),
)
def _(t: Tables) -> DataFrame:
    stems = t.part.select(
        F.concat(F.col("p_type"), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"),
                 F.col("p_size").cast("string")).alias("stem")
    )
    good, findings = O.class_map_exactly_one(stems, "stem", CLASS_RULES, declared_classes(t))
    ok = good.groupBy("class_name", "class_id").agg(F.count(F.lit(1)).alias("n")).withColumn("code", F.lit("ok"))
    bad = findings.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return ok.unionByName(
        bad.select(F.lit("").alias("class_name"), F.lit(None).cast("bigint").alias("class_id"), "n", "code")
    )


@query(
    "class_name_rules",
    """with s as (select replace(p_name, ' ', '_') || '_' || p_size as stem, p_size, p_brand,
        case when p_partkey % 4 = 0 then 'gabaritos' when p_partkey % 4 = 1 then (p_size - 1) || '-' || (p_size + 20) end as grp,
        'manometer_' || p_size || '_' || (p_partkey % 10) as gauge from part),
    c as (select case when coalesce(grp, '') like '%gabarito%' then regexp_replace(stem, '(^|_)\\d+$', '') else stem end as numbered,
        case when grp is not null then grp when p_size % 5 = 0 then p_brand else p_size || '.' || (regexp_extract(gauge, '(\\d+)$', 1)) end as reading from s)
    select numbered, reading, coalesce(try_cast(nullif(regexp_extract(reading, '^(\\d+(?:\\.\\d+)?)-(\\d+(?:\\.\\d+)?)$', 1), '') as double),
        try_cast(reading as double), 1e9::double) as sort_key, count(*) as n from c group by all""",
)
def _(t: Tables) -> DataFrame:
    group = F.when(F.col("p_partkey") % 4 == 0, F.lit("gabaritos")).when(
        F.col("p_partkey") % 4 == 1,
        F.concat((F.col("p_size") - 1).cast("string"), F.lit("-"), (F.col("p_size") + 20).cast("string")),
    )
    stem = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_size").cast("string"))
    gauge = F.when(F.col("p_size") % 5 == 0, F.col("p_brand")).otherwise(
        F.concat_ws("_", F.lit("manometer"), F.col("p_size").cast("string"), (F.col("p_partkey") % 10).cast("string"))
    )
    rows = t.part.select(X.numbered_class(stem, group).alias("numbered"), X.reading_class(gauge, group).alias("reading"))
    return rows.select("*", X.range_sort_key(F.col("reading")).alias("sort_key")).groupBy(
        "numbered", "reading", "sort_key"
    ).agg(F.count(F.lit(1)).alias("n"))


@query("content_hash", "select doc_id, sha256(text) as content_hash from documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.sha2("text", 256).alias("content_hash"))


SQL_AHASH = (
    B.SQL_VECTORS
    + """,
v_bits as (
  select vec_id, label, list_transform(v, lambda x: case when x >= m then '1' else '0' end) as b
  from (select *, list_reduce(v, lambda p, q: p + q) / 64 as m from v_vectors)),
v_ahash as (
  select vec_id, label, printf('%016x', ('0b' || array_to_string(b, ''))::ubigint) as ahash,
    array_to_string(b, '') as bits from v_bits)"""
)


def hashes(t: Tables) -> DataFrame:
    return B.vectors(t).select("vec_id", "label", A.average_hash64(F.col("v")).alias("ahash"))


@query("average_hash64", with_sql("select vec_id, ahash from v_ahash", SQL_AHASH))
def _(t: Tables) -> DataFrame:
    return hashes(t).select("vec_id", "ahash")


@query(
    "duplicate_groups",
    """with h as (select doc_id, sha256(text) as hash from documents),
       g as (select hash, count(*) as n from h group by hash having count(*) > 1)
       select h.hash, n, doc_id as member from h join g on h.hash = g.hash""",
)
def _(t: Tables) -> DataFrame:
    hashed = t.documents.select("doc_id", F.sha2("text", 256).alias("hash"))
    return O.duplicate_groups(hashed, "hash", "doc_id")


@query(
    "hamming_similarity",
    with_sql(
        """select a.vec_id as output, max(1.0::double - x.d / 64.0) as similarity, max(1.0::double - x.d / 64.0) >= 0.98 as near_duplicate_source
           from v_ahash a join l on l.output = a.vec_id join v_ahash b on b.vec_id = l.source,
             lateral (select len(list_filter(range(1, 65), lambda i: a.bits[i] <> b.bits[i])) as d) x
           group by 1""",
        SQL_AHASH,
        """l as (select vec_id as output, (vec_id * 31 + r * 17 + 1) % (select count(*) from embeddings) as source
             from embeddings, unnest(range(3)) as u(r))""",
    ),
)
def _(t: Tables) -> DataFrame:
    hashed = hashes(t).select("vec_id", A.hash_as_long(F.col("ahash")).alias("bits"))
    total = t.embeddings.agg(F.count(F.lit(1))).scalar()
    roles = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("r")
    lineage = t.embeddings.select("vec_id", roles).select(
        F.col("vec_id").alias("output"), ((F.col("vec_id") * 31 + F.col("r") * 17 + 1) % total).alias("source")
    )
    return O.nearest_source(
        hashed.withColumnRenamed("vec_id", "output"), lineage,
        hashed.select(F.col("vec_id").alias("source"), F.col("bits").alias("source_bits")),
    )


@query(
    "near_duplicate_hashes",
    """with c as (select p_partkey + (p_size % 4)::bigint * 1048576 as bits, count(*) as n from part group by 1)
       select a.bits as left_bits, b.bits as right_bits, a.n as left_n, b.n as right_n,
         1.0::double - bit_count(xor(a.bits, b.bits)) / 64.0 as similarity
       from c a join c b on a.bits < b.bits and bit_count(xor(a.bits, b.bits)) <= 1""",
)
def _(t: Tables) -> DataFrame:
    bits = F.col("p_partkey") + (F.col("p_size") % 4).cast("bigint") * 1048576
    return O.near_duplicate_hashes(t.part.select(bits.alias("bits")), "bits")


@query(
    "catalog_counts",
    """select 'group' as field, source as value, count(*) as n from documents where source is not null group by source
       union all select 'class', lang, count(*) from documents where lang is not null group by lang
       union all select 'quality', cast(quality as varchar), count(*) from documents d join labels l on d.doc_id = l.doc_id
         where quality is not null group by quality""",
)
def _(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "source", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    parts = [
        O.catalog_counts(d, c).select(F.lit(field).alias("field"), "value", "n")
        for field, c in (("group", "source"), ("class", "lang"), ("quality", "quality"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "catalog_findings",
    with_sql(
        """select 'UNKNOWN_WEIGHT_GROUP' as code, grp as key from gw where grp not in (select "group" from v_assets)
           union all select 'UNKNOWN_WEIGHT_ASSET', path from aw where path not in (select logical_path from v_assets)
           union all select 'NEGATIVE_WEIGHT', grp from gw where weight < 0
           union all select 'ALL_WEIGHTS_ZERO', cast(count(*) as varchar) from gw having count(*) > 0 and sum(weight) <= 0
           union all select 'CLASS_WITHOUT_ASSETS', c from cl where c not in (select class_name from v_assets)
           union all select 'DOCUMENTED_NOT_SUPPORTED', c from doc where c not in (select c from cl)
           union all select 'SUPPORTED_NOT_DOCUMENTED', c from cl where c not in (select c from doc)""",
        B.SQL_ASSETS,
        "gw as (select 'Brand#' || n_nationkey as grp, n_regionkey - 0.5::double as weight from nation)",
        "aw as (select s_name as path, 1.0::double as weight from supplier union all select logical_path, 1.0::double from v_assets)",
        "cl as (select distinct p_type as c from part union all select r_name from region)",
        "doc as (select r_name as c from region where r_regionkey < 3 union all select distinct c_mktsegment from customer)",
    ),
)
def _(t: Tables) -> DataFrame:
    assets = B.assets(t)
    group_weights = t.nation.select(
        F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("group"),
        (F.col("n_regionkey") - F.lit(0.5)).alias("weight"),
    )
    asset_weights = t.supplier.select(F.col("s_name").alias("logical_path")).union(assets.select("logical_path"))
    classes = t.part.select(F.col("p_type").alias("class_name")).distinct().union(t.region.select("r_name"))
    documented = t.region.where("r_regionkey < 3").select(F.col("r_name").alias("class_name")).union(
        t.customer.select("c_mktsegment").distinct()
    )
    return O.catalog_findings(assets, group_weights, asset_weights, classes, documented)


def sql_fingerprint(columns: list[str], source: str, by: str | None = None) -> str:
    row = "sha256(" + " || chr(31) || ".join(f"coalesce(cast({c} as varchar), '')" for c in columns) + ")"
    lanes = ", ".join(f"sum(('0x' || substr(d, {1 + 8 * i}, 8))::ubigint::hugeint) as s{i}" for i in range(8))
    key = f"{by}, " if by else ""
    tail = f" group by {by}" if by else ""
    return f"""select {key}rows, sha256(concat_ws(':', rows, s0, s1, s2, s3, s4, s5, s6, s7)) as fingerprint
      from (select {key}count(*) as rows, {lanes} from (select *, {row} as d from {source}){tail})"""


@query(
    "catalog_fingerprint",
    sql_fingerprint(["doc_id", "sha256(text)", "source", "lang"], "documents"),
)
def _(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", F.sha2("text", 256).alias("content_hash"), "source", "lang")
    return O.catalog_fingerprint(docs, ["doc_id", "content_hash", "source", "lang"])


@query(
    "catalog_summary",
    with_sql(
        """select s.source, assets, groups, classes, duplicate_groups, duplicate_members, fingerprint
           from (select source, count(*) as assets, count(distinct lang) as groups, count(distinct quality) as classes from c group by source) s
           join (select source, cast(sum(case when n > 1 then 1 else 0 end) as bigint) as duplicate_groups,
                   cast(sum(case when n > 1 then n else 0 end) as bigint) as duplicate_members
                 from (select source, h, count(*) as n from c group by all) group by source) d using (source)
           join ("""
        + sql_fingerprint(["doc_id", "h", "lang", "quality"], "c", "source")
        + ") f using (source)",
        """c as (select d.doc_id, d.source, d.lang, sha256(d.text) as h, l.quality from documents d left join labels l on d.doc_id = l.doc_id)""",
    ),
)
def _(t: Tables) -> DataFrame:
    docs = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left").select(
        "source", F.col("doc_id").alias("logical_path"), F.sha2("text", 256).alias("content_hash"),
        F.col("lang").alias("group"), F.col("quality").alias("class_name"),
    )
    return O.catalog_summary(docs, "source")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    "local_links",
    with_sql(
        """select page_id as page, link from l where link not in (
             select link from l where regexp_full_match(link, '/[^/?#]+') group by link having count(*) >= 5)""",
        f"""tags as (select page_id, unnest(regexp_extract_all(regexp_replace(regexp_replace(html, {quoted(X.COMMENT_PATTERN)}, '', 'g'), {quoted(X.RAW_TEXT_PATTERN)}, '\\1\\2', 'g'), {quoted(X.TAG_PATTERN)})) as tag from pages),
           attributes as (select page_id, unnest(regexp_extract_all(tag, {quoted(X.ATTRIBUTE_PATTERN)})) as a from tags),
           l as (select distinct page_id, link from (select page_id, regexp_extract(a, {quoted(X.LINK_ATTRIBUTE_PATTERN)}, 1) as link from attributes)
             where link <> '' and not (starts_with(link, '#') or starts_with(link, 'http:') or starts_with(link, 'https:') or starts_with(link, 'data:')))""",
    ),
)
def _(t: Tables) -> DataFrame:
    links = t.pages.select("page_id", F.explode(F.array_distinct(X.local_link_values(F.col("html")))).alias("link"))
    known = links.where(F.col("link").rlike("^/[^/?#]+$")).groupBy("link").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")
    return O.local_links(t.pages, "page_id", "html", known)


@query(
    "profile_risk_rollup",
    """with m as (select user_id as config, event_id as pos, case when event_type = 'view' then 'appearance' else 'appearance.' || event_type end as subject,
         event_type, props, case event_type when 'error' then 'confirmation' when 'click' then 'informational' else 'none' end as risk
       from events),
    f as (select config, event_type as v, min(pos) as p from m group by all),
    e as (select config, props as v, min(pos) as p from m group by all),
    r as (select config, case max(case risk when 'confirmation' then 2 when 'informational' then 1 else 0 end) when 2 then 'confirmation' when 1 then 'informational' else 'none' end as risk,
        max_by(pos, case when subject = 'appearance' then 1000000000000 else 0 end + pos) as primary_id, count(*) as profiles from m group by config)
    select r.config, risk, primary_id, profiles, c.codes, x.evidence from r
      join (select config, string_agg(v, '|' order by p) as codes from f group by config) c on c.config = r.config
      join (select config, string_agg(v, '|' order by p) as evidence from e group by config) x on x.config = r.config""",
)
def _(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    rows = t.events.select(
        F.col("user_id").alias("config"), F.col("event_id").alias("pos"), F.col("event_id").alias("id"),
        F.when(kind == "view", "appearance").otherwise(F.concat(F.lit("appearance."), kind)).alias("subject"),
        F.when(kind == "error", "confirmation").when(kind == "click", "informational").otherwise("none").alias("risk"),
        F.array(kind).alias("codes"), F.array("props").alias("evidence"),
    )
    out = O.profile_risk_rollup(rows)
    return out.withColumn("codes", F.array_join("codes", "|")).withColumn("evidence", F.array_join("evidence", "|"))


@query(
    "layered_overrides",
    with_sql(
        """select config, path, case when path <> 'error' then value end as value, case when path <> 'error' then layer end as layer,
             case when path = 'error' then 'UNKNOWN_OVERRIDE_PATH' else 'ok' end as code
           from (select *, row_number() over (partition by config, path order by layer desc, pos desc) as rn from v_overrides where value is not null)
           where rn = 1""",
        B.SQL_OVERRIDES,
    ),
)
def _(t: Tables) -> DataFrame:
    rows = B.overrides(t)
    known = rows.select("path").distinct().where("path <> 'error'")
    good, findings = O.layered_overrides(rows, known)
    return good.withColumn("code", F.lit("ok")).unionByName(findings, allowMissingColumns=True)


@query(
    "redact_paths",
    """select page_id, case when regexp_matches(url, '[/\\\\]') then list_last(string_split(rtrim(url, '/'), '/')) else url end as name from pages""",
)
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.redact_path(F.col("url")).alias("name"))
