"""Asset catalogs: enrichment, naming rules, duplicates, fingerprints and findings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.arrays import hamming_similarity
from slotwise.functions.text import local_link_values
from slotwise.session import settle

# Similarity from which an output counts as a copy of its source; risk levels, worst last.
NEAR_DUPLICATE_SIMILARITY = 0.98
RISK_LEVELS = ("none", "informational", "confirmation")


def catalog_enrich(assets: DataFrame, metadata: DataFrame) -> DataFrame:
    """Overlay metadata by relative path; excluded assets disappear, missing lists become empty."""
    extra = [c for c in metadata.columns if c not in ("path", "excluded")]
    lists = {f.name for f in metadata.schema.fields if f.dataType.typeName() == "array"}
    joined = assets.join(metadata, "path", "left").where(~F.coalesce("excluded", F.lit(False)))
    empty = F.array().cast("array<string>")
    return joined.select(*assets.columns, *[F.coalesce(c, empty).alias(c) if c in lists else F.col(c) for c in extra])


def class_map_exactly_one(
    assets: DataFrame, stem: str, rules: Sequence[tuple[str, str]], classes: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Apply ordered (pattern, template) rules; exactly one must match the whole stem.

    Named groups fill the template. The rules are a short configured list and become
    one row expression. Returns the mapped assets and the findings of all others.
    """
    candidates = []
    for pattern, template in rules:
        groups = re.compile(pattern).groupindex
        java = "^(?:" + re.sub(r"\(\?P<(\w+)>", "(", pattern) + ")$"
        pieces = [
            F.regexp_extract(stem, java, groups[piece[1:-1]]) if piece.startswith("{") else F.lit(piece)
            for piece in re.split(r"(\{\w+\})", template)
            if piece
        ]
        candidates.append(F.when(F.col(stem).rlike(java), F.concat(*pieces)))
    matched = assets.withColumn("__m", F.array_compact(F.array(*candidates)))
    declared = F.array(*[F.lit(c) for c in classes])
    name = F.when(F.size("__m") == 1, F.col("__m")[0])
    matched = matched.withColumn("class_name", name).withColumn(
        "class_id", F.when(name.isNotNull(), F.array_position(declared, name) - 1)
    )
    code = F.when(F.size("__m") != 1, "CLASS_RULE_NOT_UNIQUE").when(F.col("class_id") < 0, "CLASS_NOT_DECLARED")
    checked = matched.withColumn("code", code)
    good = checked.where("code is null").drop("__m", "code")
    findings = checked.where("code is not null").select(
        "code", F.col(stem).alias("stem"), F.size("__m").alias("matches")
    )
    return good, findings


def duplicate_groups(assets: DataFrame, hash_col: str, id_col: str) -> DataFrame:
    """Members of every hash that occurs more than once, one row per member with the group size."""
    sizes = assets.groupBy(hash_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return assets.select(hash_col, id_col).join(sizes, hash_col).select(
        F.col(hash_col).alias("hash"), "n", F.col(id_col).alias("member")
    )


def nearest_source(outputs: DataFrame, lineage: DataFrame, sources: DataFrame) -> DataFrame:
    """Largest hash similarity of each output to the sources it was made from.

    outputs[output, bits], lineage[output, source], sources[source, source_bits].
    """
    pairs = lineage.join(outputs, "output").join(sources, "source")
    best = pairs.groupBy("output").agg(
        F.max(hamming_similarity(F.col("bits"), F.col("source_bits"))).alias("similarity")
    )
    return best.withColumn("near_duplicate_source", F.col("similarity") >= NEAR_DUPLICATE_SIMILARITY)


def near_duplicate_hashes(assets: DataFrame, bits: str) -> DataFrame:
    """Pairs of distinct 64-bit hashes whose similarity reaches the near-duplicate limit.

    The limit allows one differing bit. Copies collapse to one distinct hash first, then
    each hash asks for its 64 one-bit variants: an equi-join on unique keys, so neither
    a crowd of copies nor a common bit pattern makes a large group.
    """
    distinct = assets.groupBy(bits).agg(F.count(F.lit(1)).alias("n"))
    positions = F.sequence(F.lit(0), F.lit(63))
    variants = distinct.select(
        F.col(bits).alias("left_bits"),
        F.col("n").alias("left_n"),
        F.explode(
            F.transform(positions, lambda i: F.col(bits).bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
        ).alias("variant"),
    )
    right = distinct.select(F.col(bits).alias("right_bits"), F.col("n").alias("right_n"))
    return (
        variants.join(right, F.col("variant") == F.col("right_bits"))
        .where("left_bits < right_bits")
        .select(
            "left_bits", "right_bits", "left_n", "right_n",
            hamming_similarity(F.col("left_bits"), F.col("right_bits")).alias("similarity"),
        )
    )


def catalog_counts(assets: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL not counted."""
    return assets.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def catalog_findings(
    assets: DataFrame, group_weights: DataFrame, asset_weights: DataFrame, classes: DataFrame, documented: DataFrame
) -> DataFrame:
    """Weights naming unknown groups or assets, bad weights, classes without assets, drifting names.

    group_weights[group, weight], asset_weights[logical_path, weight], classes[class_name],
    documented[class_name] are small configuration tables.
    """

    def finding(frame: DataFrame, code: str, key: str) -> DataFrame:
        return frame.select(F.lit(code).alias("code"), F.col(key).cast("string").alias("key"))

    groups = assets.select("group").distinct()
    paths = assets.select("logical_path").distinct()
    used = assets.select("class_name").distinct()
    total = group_weights.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("total")
    )
    size = assets.agg(F.count(F.lit(1)).alias("rows"))
    parts = [
        finding(group_weights.join(groups, "group", "left_anti"), "UNKNOWN_WEIGHT_GROUP", "group"),
        finding(asset_weights.join(paths, "logical_path", "left_anti"), "UNKNOWN_WEIGHT_ASSET", "logical_path"),
        finding(group_weights.where("weight < 0"), "NEGATIVE_WEIGHT", "group"),
        finding(total.where("rows > 0 and total <= 0"), "ALL_WEIGHTS_ZERO", "rows"),
        finding(classes.join(used, "class_name", "left_anti"), "CLASS_WITHOUT_ASSETS", "class_name"),
        finding(size.where("rows = 0"), "EMPTY_CATALOG", "rows"),
        finding(documented.join(classes, "class_name", "left_anti"), "DOCUMENTED_NOT_SUPPORTED", "class_name"),
        finding(classes.join(documented, "class_name", "left_anti"), "SUPPORTED_NOT_DOCUMENTED", "class_name"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


LANES = 8


def fingerprint_parts(columns: Sequence[Column]) -> tuple[Column, list[Column]]:
    """Row digest and its eight 32-bit lanes as exact decimals; sums of them hold for 10^16 rows."""
    digest = F.sha2(F.concat_ws("\x1f", *columns), 256)
    lanes = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(16,0)") for i in range(LANES)]
    return digest, lanes


def multiset_text(rows: str) -> Column:
    """Number of rows and the lane sums ``s0`` ... as one text."""
    return F.concat_ws(":", F.col(rows).cast("string"), *[F.col(f"s{i}").cast("string") for i in range(LANES)])


def lane_sums(lanes: Sequence[Column]) -> list[Column]:
    return [F.sum(lane).alias(f"s{i}") for i, lane in enumerate(lanes)]


def catalog_fingerprint(assets: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Order-free fingerprint of a set of rows.

    Row digests are added lane by lane (a multiset hash), so rows are combined before
    the shuffle and no task ever holds a list of them.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    _, lanes = fingerprint_parts(filled)
    sums = assets.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *lane_sums(lanes))
    return sums.select(*by, "rows", F.sha2(multiset_text("rows"), 256).alias("fingerprint"))


def local_links(pages: DataFrame, page: str, html: str, known: DataFrame) -> DataFrame:
    """Links to the own site that resolve to no known path."""
    links = pages.select(F.col(page).alias("page"), F.explode(F.array_distinct(local_link_values(F.col(html)))).alias("link"))
    return links.join(known.select("link"), "link", "left_anti").select("page", "link")


def profile_risk_rollup(rows: DataFrame) -> DataFrame:
    """Worst risk, ordered distinct warning codes and evidence, and the primary row per config.

    rows[config, pos, id, subject, risk, codes, evidence]. First positions are found by
    aggregation; only the distinct vocabulary of a config is listed together.
    """
    risk = F.col("risk")
    level = F.coalesce(*[F.when(risk == name, F.lit(i)) for i, name in enumerate(RISK_LEVELS)], F.lit(0))
    primary = F.max_by("id", F.struct((F.col("subject") == "appearance").alias("p"), F.col("pos")))
    base = rows.groupBy("config").agg(
        F.element_at(F.array(*[F.lit(n) for n in RISK_LEVELS]), F.max(level) + 1).alias("risk"),
        primary.alias("primary_id"),
        F.count(F.lit(1)).alias("profiles"),
    )

    def ordered(column: str) -> DataFrame:
        first = (
            rows.select("config", "pos", F.posexplode(column).alias("i", "value"))
            .groupBy("config", "value")
            .agg(F.min(F.struct("pos", "i")).alias("at"))
        )
        return first.groupBy("config").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda s: s["value"]).alias(column)
        )

    return base.join(ordered("codes"), "config", "left").join(ordered("evidence"), "config", "left")


def layered_overrides(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Last writer per (config, path) by layer, then position; unknown paths become findings."""
    set_rows = rows.where(F.col("value").isNotNull())
    merged = set_rows.groupBy("config", "path").agg(
        F.max_by(F.struct("value", "layer"), F.struct("layer", "pos")).alias("w")
    )
    good = merged.join(known.select("path"), "path", "left_semi").select("config", "path", "w.value", "w.layer")
    findings = merged.join(known.select("path"), "path", "left_anti").select(
        "config", "path", F.lit("UNKNOWN_OVERRIDE_PATH").alias("code")
    )
    return good, findings


def flatten_overrides(documents: DataFrame, json: str) -> DataFrame:
    """Dotted path and value of every leaf of nested JSON documents, however deep.

    One round per level; each is checkpointed, and the rounds end when no object is left.
    """
    keep = [c for c in documents.columns if c != json]
    level = documents.select(*keep, F.lit("").alias("path"), F.parse_json(json).alias("v"))
    leaves = None
    while True:
        entries = documents.sparkSession.tvf.variant_explode(F.col("v").outer())
        exploded = settle(
            level.withColumnRenamed("path", "prefix").lateralJoin(entries).select(
                *keep,
                F.when(F.col("prefix") == "", F.col("key")).otherwise(F.concat_ws(".", "prefix", "key")).alias("path"),
                F.col("value").alias("v"),
            )
        )
        nested = F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))
        done = exploded.where(~nested).select(*keep, "path", F.col("v").cast("string").alias("value"))
        leaves = done if leaves is None else leaves.unionByName(done)
        level = exploded.where(nested)
        if level.isEmpty():
            return leaves


def catalog_summary(assets: DataFrame, by: str) -> DataFrame:
    """Size, groups, classes and duplicates of each catalog."""
    copies = assets.groupBy(by, "content_hash").agg(F.count(F.lit(1)).alias("n"))
    duplicates = copies.groupBy(by).agg(
        F.sum((F.col("n") > 1).cast("bigint")).alias("duplicate_groups"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicate_members"),
    )
    sizes = assets.groupBy(by).agg(
        F.count(F.lit(1)).alias("assets"),
        F.countDistinct("group").alias("groups"),
        F.countDistinct("class_name").alias("classes"),
    )
    prints = catalog_fingerprint(assets, ["logical_path", "content_hash", "group", "class_name"], [by])
    return sizes.join(duplicates, by).join(prints.select(by, "fingerprint"), by)
