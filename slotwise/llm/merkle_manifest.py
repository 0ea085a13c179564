"""Merkle manifest of a table: a tree of digests per source, one over the sources, and proofs by pointer jumping.

Every row is a leaf. Leaves of a source are numbered in order without a task that holds a source; sixteen consecutive
nodes are one *run*, and runs become the nodes above, level by level, until one node of the source is left. These
subroots, in the order of their sources, are the leaves of the upper tree, whose last node is the root.

Proofs: every inner node starts with the segment to its parent (its siblings to the left and to the right) and a pointer
to that parent. A self-join along the pointers concatenates the segment of a node with that of the node it points to, so
the distance doubles with every join until all pointers have reached the root. Leaves stay grouped in their runs, and
take their own siblings and the segment of their run's node. Nodes that very many others point to are joined by
broadcast (fewer than 1024 of them, by counting), the rest by shuffle.

Cases: a null in any column is the field ``-``; null doc_ids come first in their source and are never tampered with; the
null source comes first; equal rows are leaves of their own with equal digests (their places are told apart by a row
number); a source of one row is its own subroot, and a table of one source its own root; an empty table gives an empty
result; only the five columns of the digest are read, so others cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.frames import stored
from slotwise.operators.scale import heavy_lookup, join_null_safe, key_ranges

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
#: Stands for the upper tree where a tree is named by the number of its source.
UPPER = -1
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """A value as text behind its length in bytes; nulls differ from every text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**changed: Column) -> Column:
    return digest(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def leaf_rows(docs: DataFrame, every: int) -> DataFrame:
    """Digest of each row and, where ``every`` divides the checksum of the id, of the row with its text lower-cased."""
    lowered = leaf(text=F.translate("text", CAPITALS, CAPITALS.lower()))
    struck = F.crc32(F.col("doc_id").cast("string")) % every == 0
    return docs.select(*[F.col(f"`{name}`") for name in FIELDS]).select(
        "doc_id", "source", leaf().alias("leaf"), F.when(struck, lowered).alias("tampered"), F.monotonically_increasing_id().alias("at")
    )


def numbered(leaves: DataFrame) -> DataFrame:
    """Leaves with ``s``, the number of their source, ``p``, their place in it, and ``n``, the rows of the source.

    Rows are dealt to ranges of the order; only one count for each source in each range is ordered together.
    """
    ranged = key_ranges(leaves, ["source", "doc_id", "leaf", "at"])
    cells = ranged.groupBy("source", "__range").agg(F.count(F.lit(1)).alias("held"))
    of_source = Window.partitionBy("source").orderBy("__range")
    earlier = of_source.rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "source", "__range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
        F.sum("held").over(Window.partitionBy("source")).alias("n"),
    ).withColumn("new", (F.col("before") == 0).cast("long"))
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.groupBy("__range").agg(F.sum("new").alias("new_here"))
    starts = starts.select("__range", F.coalesce(F.sum("new_here").over(ahead), F.lit(0)).alias("sources_before"))
    in_range = Window.partitionBy("__range").orderBy("source")
    cells = cells.join(starts, "__range").withColumn("s", F.col("sources_before") + F.sum("new").over(in_range) - 1)
    within = Window.partitionBy("source", "__range").orderBy("doc_id", "leaf", "at")
    placed = join_null_safe(ranged, cells.select("source", "__range", "before", "n", "s"), ["source", "__range"])
    return placed.select("s", "n", (F.col("before") + F.row_number().over(within) - 1).alias("p"), "doc_id", "leaf", "tampered")


def runs_of(nodes: DataFrame, level: int, *carried: str) -> DataFrame:
    """Runs of at most sixteen consecutive nodes, with the number of nodes on their level."""
    kids = F.sort_array(F.collect_list(F.struct("p", "digest", *carried)))
    grouped = nodes.groupBy("s", "n", F.floor(F.col("p") / FAN).alias("r")).agg(kids.alias("kids"))
    return grouped.withColumn("level", F.lit(level))


def nodes_above(runs: DataFrame) -> DataFrame:
    """The node that each run becomes; a level of one node has none above."""
    return runs.where(F.col("n") > 1).select(
        "s", F.ceil(F.col("n") / FAN).alias("n"), F.col("r").alias("p"), digest(F.col("kids.digest")).alias("digest")
    )


def grow(nodes: DataFrame, most: int, label: str, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored runs of every level of the trees in ``nodes`` and the last node of each tree."""
    levels = [stored(runs_of(nodes, 0, *carried), f"{label}-0")]
    tops = levels[0].where("n = 1").select("s", F.col("kids")[0]["digest"].alias("digest"))
    while most > 1:
        above = nodes_above(levels[-1])
        tops = tops.unionByName(above.where("n = 1").select("s", "digest"))
        most = -(-most // FAN)
        if most > 1:
            levels.append(stored(runs_of(above.where("n > 1"), len(levels)), f"{label}-{len(levels)}"))
    return levels, tops


def name_of(tree: Column, level: Column, place: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), place.cast("long").alias("place"))


def parent_of_run(sources: int) -> Column:
    """Name of the node that a run becomes, null for the root; a subroot has its name in the upper tree."""
    lower = F.when(F.col("n") > FAN, name_of(F.col("s"), F.col("level") + 1, F.col("r")))
    if sources > 1:
        lower = lower.otherwise(name_of(F.lit(UPPER), F.lit(0), F.col("s")))
    upper = F.when(F.col("n") > FAN, name_of(F.lit(UPPER), F.col("level") + 1, F.col("r")))
    return F.when(F.col("s") == UPPER, upper).otherwise(lower)


def step(i: Column) -> Column:
    """Siblings of the child at ``i`` of its run, before and after it."""
    digests = F.col("kids.digest")
    left, right = F.slice(digests, 1, i), F.slice(digests, i + 2, FAN)
    return F.struct(F.concat_ws("", left).alias("left"), F.concat_ws("", right).alias("right"))


def first_segments(runs: list[DataFrame], sources: int) -> DataFrame:
    """Every inner node below the root with a pointer to its parent and the segment between the two."""
    rows = reduce(DataFrame.unionByName, runs).select("*", F.posexplode("kids").alias("i", "kid"))
    subroot = F.when((F.col("s") == UPPER) & (F.col("level") == 0), F.col("kid.digest"))
    return rows.select(
        name_of(F.col("s"), F.col("level"), F.col("kid.p")).alias("node"), parent_of_run(sources).alias("up"),
        F.array(step(F.col("i"))).alias("segment"), subroot.alias("subroot"),
    )


def jump(nodes: DataFrame) -> DataFrame:
    """One self-join along the pointers: segments are concatenated, distances double."""
    waiting = nodes.where(F.col("up").isNotNull())
    pointed = waiting.groupBy("up").agg(F.count(F.lit(1)).alias("weight"))
    ahead = nodes.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("segment").alias("more"), F.col("subroot").alias("top"))
    joined = heavy_lookup(waiting, pointed.join(ahead, "up"), "up", "weight", waiting.count())
    moved = joined.select("node", F.col("up2").alias("up"), F.concat("segment", "more").alias("segment"), F.coalesce("subroot", "top").alias("subroot"))
    return nodes.where(F.col("up").isNull()).unionByName(moved)


def proofs(runs: list[DataFrame], sources: int) -> DataFrame:
    """Segment from every inner node to the root: node, segment, subroot."""
    nodes = stored(first_segments(runs, sources), "merkle-segments")
    distance = 1
    while distance < len(runs):
        nodes, distance = stored(jump(nodes), "merkle-segments"), 2 * distance
    return nodes


def fold(start: Column, segment: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(segment, start, lambda held, x: F.sha2(F.concat(x["left"], held, x["right"]), 256))


def manifest(docs: DataFrame, every: int = 5) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and whether the row, tampered with or not, still leads to the root."""
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    leaves = stored(leaf_rows(docs, every), "merkle-leaves")
    placed = stored(numbered(leaves).withColumnRenamed("leaf", "digest"), "merkle-places")
    size = placed.agg(F.max("n").alias("most"), F.max("s").alias("last")).first()
    if size.most is None:
        return leaves.select("doc_id", "leaf", *[F.lit(None).cast("boolean" if c == "verified" else "string").alias(c) for c in columns[2:]])
    sources = size.last + 1
    lower, subroots = grow(placed, size.most, "merkle-runs", "doc_id", "tampered")
    subroots = subroots.select(F.lit(UPPER).cast("long").alias("s"), F.lit(sources).cast("long").alias("n"), F.col("s").alias("p"), "digest")
    upper, top = grow(subroots, sources, "merkle-upper")
    root = top.first().digest

    inner = lower[1:] + (upper if sources > 1 else [])
    runs = lower[0].withColumn("up", parent_of_run(sources))
    if inner:
        known = proofs(inner, sources).select(F.col("node").alias("up"), F.col("segment").alias("above"), "subroot")
        runs = runs.join(known, "up", "left")
    else:
        runs = runs.withColumns({"above": F.array().cast("array<struct<left:string,right:string>>"), "subroot": F.lit(None).cast("string")})
    rows = runs.select("*", F.posexplode("kids").alias("i", "kid"))
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    own = F.when(F.col("n") > 1, F.array(step(F.col("i")))).otherwise(nothing)
    rows = rows.select("kid.*", "subroot", F.concat(own, F.coalesce("above", nothing)).alias("path"))
    siblings = F.flatten(F.transform("path", lambda x: F.array(x["left"], x["right"])))
    folded = fold(F.coalesce("tampered", "digest"), F.col("path"))
    return rows.select(
        "doc_id", F.col("digest").alias("leaf"), F.coalesce("subroot", F.lit(root)).alias("subroot"), F.lit(root).alias("root"),
        digest(siblings).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_sql(every: int = 5, levels: int = 8) -> str:
    """The same in DuckDB, for trees of at most ``levels`` levels of sixteen."""
    fields = " || ".join(f"CASE WHEN {{{c}}} IS NULL THEN '-' ELSE strlen({{{c}}}::VARCHAR) || ':' || {{{c}}}::VARCHAR END" for c in FIELDS)
    plain = {c: c for c in FIELDS}
    lowered = plain | {"text": f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')"}
    ctes = [
        # One entry of the checksum table for each byte value, by eight shifts.
        "bits AS (SELECT list(list_reduce(list_prepend(b, range(0, 8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t FROM range(0, 256) AS x(b))",
        "ids AS (SELECT DISTINCT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM documents, bits WHERE doc_id IS NOT NULL)",
        f"leaves AS (SELECT d.doc_id, source, sha256({fields.format(**{c: 'd.' + v if c == 'doc_id' else v for c, v in plain.items()})}) AS leaf, CASE WHEN crc % {every} = 0 THEN sha256({fields.format(**{c: 'd.' + v if c == 'doc_id' else v for c, v in lowered.items()})}) END AS tampered FROM documents d LEFT JOIN ids ON d.doc_id = ids.doc_id)",
        "l0 AS (SELECT doc_id, leaf AS digest, tampered, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY source) AS n FROM leaves)",
    ]

    def tree(prefix: str) -> None:
        for k in range(levels):
            ctes.append(
                f"{prefix}{k + 1} AS (SELECT s, p // {FAN} AS p, (n + {FAN - 1}) // {FAN} AS n, sha256(string_agg(digest, '' ORDER BY p)) AS digest FROM {prefix}{k} WHERE n > 1 GROUP BY s, p // {FAN}, n)"
            )

    tree("l")
    tops = " UNION ALL ".join(f"SELECT s, digest FROM l{k} WHERE n = 1" for k in range(levels + 1))
    ctes.append(f"subroots AS ({tops})")
    ctes.append(f"u0 AS (SELECT {UPPER} AS s, s AS p, (SELECT count(*) FROM subroots) AS n, digest FROM subroots)")
    tree("u")
    roots = " UNION ALL ".join(f"SELECT digest FROM u{k} WHERE n = 1" for k in range(levels + 1))
    ctes.append(f"root AS ({roots})")
    joins, steps = [], []
    for prefix, tree_name, first in (("l", "l0.s", "l0.p"), ("u", str(UPPER), "l0.s")):
        for k in range(levels):
            name, of_run = f"{prefix}{k}_siblings", f"PARTITION BY s, p // {FAN} ORDER BY p ROWS BETWEEN"
            left = f"string_agg(digest, '') OVER ({of_run} UNBOUNDED PRECEDING AND 1 PRECEDING)"
            right = f"string_agg(digest, '') OVER ({of_run} 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
            ctes.append(f"{name} AS (SELECT s, p, coalesce({left}, '') AS l, coalesce({right}, '') AS r FROM {prefix}{k} WHERE n > 1)")
            joins.append(f"LEFT JOIN {name} ON {name}.s = {tree_name} AND {name}.p = {first} // {FAN**k}")
            steps.append(f"CASE WHEN {name}.s IS NOT NULL THEN {{'l': {name}.l, 'r': {name}.r}} END")
    path = f"list_filter([{', '.join(steps)}], lambda x: x IS NOT NULL)"
    ctes.append(f"paths AS (SELECT l0.doc_id, l0.s, l0.digest AS leaf, coalesce(l0.tampered, l0.digest) AS start, {path} AS path FROM l0 {' '.join(joins)})")
    folded = "list_reduce(list_prepend({'l': start, 'r': ''}, path), lambda h, x: {'l': sha256(x.l || h.l || x.r), 'r': ''}).l"
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroots.digest AS subroot, root.digest AS root, sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256, "
        f"{folded} AS folded_root, {folded} = root.digest AS verified FROM paths JOIN subroots ON paths.s = subroots.s, root"
    )
