"""Connected components of samples that share source assets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.hashing import hash_uniform
from slotwise.operators.catalog import fingerprint_parts, lane_sums, multiset_text
from slotwise.operators.scale import heavy_lookup
from slotwise.session import settle


def _count_and_done(links: DataFrame) -> tuple[int, bool]:
    """Number of links, and whether they form plain stars: one parent each, no parent has one."""
    parents = links.select(F.col("lo").alias("hi")).distinct()
    row = links.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("hi").alias("children")).first()
    if row["n"] != row["children"]:
        return row["n"], False
    return row["n"], not links.join(parents, "hi", "left_semi").take(1)


def _star(around: DataFrame, total: int, only_larger: bool) -> DataFrame:
    """Point the neighbours of every node at the smallest one.

    around[u, v] lists neighbours. The minimum is aggregated per node before any join;
    the few nodes with very many neighbours are joined by broadcast.
    """
    lowest = around.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
    lowest = lowest.select("u", F.least("u", "m").alias("m"), "degree")
    facts = around.where("v > u") if only_larger else around
    moved = heavy_lookup(facts, lowest, "u", "degree", total).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    if not only_larger:
        moved = moved.unionByName(lowest.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return moved.where("hi <> lo")


def asset_components(samples: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Component of every sample, named by its smallest member.

    samples[sample] may hold samples without edges; edges[sample, asset] links a sample
    to each asset it uses. An asset shared by many samples becomes a star around its
    smallest sample, never all pairs. Alternating large-star and small-star rounds then
    shrink every component to one star in a logarithmic number of rounds. Each round is
    written to the checkpoint folder.
    """
    edges = settle(edges.select("sample", "asset").distinct())
    total = edges.count()
    owners = edges.groupBy("asset").agg(F.min("sample").alias("owner"), F.count(F.lit(1)).alias("uses"))
    links = heavy_lookup(edges, owners, "asset", "uses", total).where("sample <> owner")
    links = settle(links.select(F.col("sample").alias("hi"), F.col("owner").alias("lo")).distinct())
    size, done = _count_and_done(links)
    rounds = 0
    while not done:
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        down = links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        both = down.unionByName(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        large = _star(both, 2 * size, only_larger=True)
        small = _star(large.select(F.col("hi").alias("u"), F.col("lo").alias("v")), size, only_larger=False)
        links = settle(small.distinct())
        size, done = _count_and_done(links)
        rounds += 1
    roots = links.select(F.col("hi").alias("sample"), F.col("lo").alias("component"))
    return samples.select("sample").distinct().join(roots, "sample", "left").select(
        "sample", F.coalesce("component", "sample").alias("component")
    )


def component_table(members: DataFrame, seed: int) -> DataFrame:
    """One row per component: id, size and the uniform draw that decides its split.

    The key of a component is its size and an order-free digest of its members, so that no
    row grows with the data and one rule holds for every size; id and draw are hashes of the
    key. The short id is a label; frames are joined on ``component``.
    """
    _, lanes = fingerprint_parts([F.col("sample")])
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"), *lane_sums(lanes))
    keys = sizes.select("component", "size", multiset_text("size").alias("key"))
    return keys.select(
        "component",
        F.substring(F.sha2("key", 256), 1, 12).alias("component_id"),
        "size",
        hash_uniform(F.lit(seed), F.col("key")).alias("u"),
    )


def component_stats(
    members: DataFrame, edges: DataFrame, labels: DataFrame, components: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Size, assets and negatives per component, and its class counts in long form.

    labels[sample, class_name] has one row per annotation; a sample without one is a
    negative. An asset belongs to one component only, so assets are counted after one
    representative member per asset is found.
    """
    where = edges.groupBy("asset").agg(F.min("sample").alias("sample")).join(members, "sample")
    assets = where.groupBy("component").agg(F.count(F.lit(1)).alias("asset_count"))
    per_sample = labels.groupBy("sample", "class_name").agg(F.count(F.lit(1)).alias("n"))
    classes = members.join(per_sample, "sample").groupBy("component", "class_name").agg(F.sum("n").alias("n"))
    negatives = (
        members.join(per_sample.select("sample").distinct(), "sample", "left_anti")
        .groupBy("component").agg(F.count(F.lit(1)).alias("negative_samples"))
    )
    stats = (
        components.select("component", "component_id", "size")
        .join(assets, "component", "left").join(negatives, "component", "left")
        .na.fill(0, ["asset_count", "negative_samples"])
    )
    return stats, classes.select("component", "class_name", "n")


def samples_of(members: DataFrame, components: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring component columns back to the samples; a giant component is joined by broadcast."""
    total = members.count()
    lookup = components.select("component", "size", *columns)
    return heavy_lookup(members, lookup, "component", "size", total)
