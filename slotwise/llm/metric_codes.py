"""Vector codes of four bytes: codebooks of 256 entries a part, refined over metric trees that never change.

Vectors are cut into four parts of whole numbers. Every block of vectors gets one metric tree a part, built once by the
anchors hierarchy: about sqrt(n) anchors are found first, each the point farthest from its anchor so far, stealing the
points it is nearer to; then the anchors are merged upwards, smallest enclosing ball first, and each is divided downwards
the same way (middle-out). Balls cache the sum and the count of their points.

A round takes the codebook down the trees. A ball inherits the list of entries that may still be nearest to some point in
it and strikes those that the best one beats everywhere in the ball: |m-c|^2 - |m-b|^2 > 2 r |c-b| for centre m and
radius r. A ball with one entry left is owned by it and adds its cached sum and count; only points of leaves with longer
lists are compared one by one. All comparisons are of whole numbers, so the result is that of comparing every point with
every entry. Trees lie in the shared folder as one row a block; a task adds up its blocks, and a round brings one row of
sums an entry to the driver.

Cases: rows whose vector is null or holds a null or non-finite component are dropped; vectors are taken at the most
frequent length that four divides (ties: the longer), and rows of another length stay with null code, error and
label_error; components beyond 2^17 (a little less for very wide parts) count as that bound, so that squares fit in 64
bits; of equal entries only the first owns parts; repeated vec_ids are ordered by their vectors, null ones come last;
fewer than 256 vectors give smaller codebooks; an empty table gives an empty result; only vec_id, embedding and label are
read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.frames import stored
from slotwise.operators.scale import heavy_lookup

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK_ROWS = 4096
LEAF_ROWS = 32
#: Balls are struck with this much room for the rounding of square roots.
ROOM = 1 + 1e-9


def squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every other, exact in the type that both have."""
    own, far = (points * points).sum(1), (others * others).sum(1)
    return own[:, None] - 2 * (points @ others.T) + far[None, :]


def exact(values: np.ndarray, width: int) -> np.ndarray:
    """Whole numbers as doubles where all squared distances fit into 53 bits, else as 64-bit integers."""
    most = int(np.abs(values).max(initial=0))
    return values.astype(np.float64 if 4 * width * most * most < 2**53 else np.int64)


@dataclass
class Tree:
    """Balls in pre-order (a left child follows its parent) over points in the order of the leaves."""

    points: np.ndarray  # int32, n x width
    order: np.ndarray  # int32, row of each point in its block
    first: np.ndarray  # int32, span of each ball
    last: np.ndarray
    right: np.ndarray  # int32, -1 in leaves
    reach: np.ndarray  # float64, radius around the centre
    sums: np.ndarray  # int64, balls x width

    TYPES = {"points": np.int32, "order": np.int32, "first": np.int32, "last": np.int32, "right": np.int32, "reach": np.float64, "sums": np.int64}

    def row(self) -> dict[str, bytes]:
        return {f.name: getattr(self, f.name).astype(self.TYPES[f.name]).tobytes() for f in fields(self)}

    @classmethod
    def read(cls, row: dict[str, bytes], width: int) -> Tree:
        flat = {name: np.frombuffer(row[name], kind) for name, kind in cls.TYPES.items()}
        return cls(**(flat | {name: flat[name].reshape(-1, width) for name in ("points", "sums")}))

    @property
    def counts(self) -> np.ndarray:
        return (self.last - self.first).astype(np.int64)

    @property
    def centres(self) -> np.ndarray:
        return self.sums // self.counts[:, None]


def anchors(points: np.ndarray) -> list[np.ndarray]:
    """Groups of rows around about sqrt(n) anchors; one group if all points are equal."""
    most = int(np.ceil(np.sqrt(len(points))))
    pivots = [0]
    owner = np.zeros(len(points), np.int64)
    near = squares(points, points[:1])[:, 0]
    while len(pivots) < most:
        new = int(near.argmax())
        if near[new] == 0:
            break
        gaps = squares(points[new][None, :], points[pivots])[0]
        # A point nearer to its anchor than half the way from there to the new one cannot be stolen.
        open_to = np.flatnonzero(4 * near > gaps[owner])
        away = squares(points[open_to], points[new][None, :])[:, 0]
        stolen = away < near[open_to]
        owner[open_to[stolen]], near[open_to[stolen]] = len(pivots), away[stolen]
        pivots.append(new)
    by = np.argsort(owner, kind="stable")
    return [g for g in np.split(by, np.cumsum(np.bincount(owner, minlength=len(pivots)))[:-1]) if len(g)]


def merged(balls: list[tuple], points: np.ndarray) -> tuple:
    """One ball over all: the two whose common ball is smallest are joined until one is left."""
    centres = np.array([points[b[0]].mean(0, dtype=np.float64) for b in balls])
    counts = np.array([len(b[0]) for b in balls], np.float64)
    reach = np.array([np.sqrt(((points[b[0]] - c) ** 2).sum(1).max()) for b, c in zip(balls, centres, strict=True)])

    def cost(i: np.ndarray, j: int) -> np.ndarray:
        apart = np.sqrt(((centres[i] - centres[j]) ** 2).sum(1))
        share = counts[i] / (counts[i] + counts[j])
        return np.maximum(apart * (1 - share) + reach[i], apart * share + reach[j])

    n = len(balls)
    live, costs = np.arange(n), np.full((n, n), np.inf)
    for j in range(1, n):
        costs[:j, j] = cost(np.arange(j), j)
    costs = np.minimum(costs, costs.T)
    while len(live) > 1:
        i, j = divmod(int(costs.argmin()), n)
        a, b = balls[i], balls[j]
        centres[i] = (centres[i] * counts[i] + centres[j] * counts[j]) / (counts[i] + counts[j])
        reach[i], counts[i] = costs[i, j], counts[i] + counts[j]
        balls[i] = (np.concatenate([a[0], b[0]]), a, b)
        live = live[live != j]
        costs[j, :] = costs[:, j] = np.inf
        rest = live[live != i]
        costs[rest, i] = costs[i, rest] = cost(rest, i)
    return balls[live[0]]


def divided(rows: np.ndarray, points: np.ndarray) -> tuple:
    """(rows, left, right) from the middle out."""
    if len(rows) <= LEAF_ROWS:
        return rows, None, None
    groups = anchors(points[rows])
    if len(groups) == 1:
        return rows, None, None
    return merged([divided(rows[g], points) for g in groups], points)


def build(points: np.ndarray) -> Tree:
    points = points.astype(np.int64)
    width = points.shape[1]
    numbers = exact(points, width)
    order, first, last, right = [], [], [], []
    filled, waiting = 0, [(divided(np.arange(len(points)), numbers), -1)]
    while waiting:
        (rows, a, b), parent = waiting.pop()
        if parent >= 0:
            right[parent] = len(first)
        first.append(filled)
        last.append(filled + len(rows))
        right.append(-1)
        if a is None:
            order.append(rows)
            filled += len(rows)
        else:
            waiting.append((b, len(first) - 1))
            waiting.append((a, -1))
    order = np.concatenate(order)
    placed, numbers = points[order], numbers[order]
    running = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(placed, axis=0)])
    first, last = np.array(first), np.array(last)
    sums = running[last] - running[first]
    centres = (sums // (last - first)[:, None]).astype(numbers.dtype)
    reach = [np.sqrt(float(((numbers[i:j] - c) ** 2).sum(1).max())) for i, j, c in zip(first, last, centres, strict=True)]
    return Tree(placed, order, first, last, np.array(right), np.array(reach), sums)


@dataclass
class Codebook:
    """Entries of one part, the distances between them, and the entries that can own points."""

    entries: np.ndarray

    def __post_init__(self):
        kept = np.unique(self.entries, axis=0, return_index=True)[1]
        self.able = np.zeros(len(self.entries), bool)
        self.able[kept] = True
        wide = self.entries.astype(np.float64)
        self.gaps = np.sqrt(np.maximum(squares(wide, wide), 0.0)) * ROOM


def descend(tree: Tree, book: Codebook) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owned balls with their entries, and open leaves with their lists of entries."""
    both = exact(np.concatenate([tree.points, book.entries]), tree.points.shape[1]).dtype
    entries, centres = book.entries.astype(both), tree.centres.astype(both)
    far = np.array(np.inf if both == np.float64 else np.iinfo(np.int64).max, both)
    owned, owners, leaves, lists = [], [], [], []
    front, able = np.zeros(1, np.int64), book.able[None, :]
    while len(front):
        apart = np.where(able, squares(centres[front], entries), far)
        best = apart.argmin(1)
        least = apart[np.arange(len(front)), best]
        room = 2 * tree.reach[front, None] * book.gaps[best]
        able = able & (apart - least[:, None] <= room)
        single = (able.sum(1) == 1) | (tree.reach[front] == 0)
        owned.append(front[single])
        owners.append(best[single])
        end = ~single & (tree.right[front] < 0)
        leaves.append(front[end])
        lists.append(able[end])
        down = ~single & ~end
        front = np.concatenate([front[down] + 1, tree.right[front[down]]])
        able = np.concatenate([able[down], able[down]])
    return np.concatenate(owned), np.concatenate(owners), np.concatenate(leaves), np.concatenate(lists)


def spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the given spans and the span of each."""
    counts = (last - first).astype(np.int64)
    which = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.asarray(first)[which] + within, which


def nearest(points: np.ndarray, lists: np.ndarray, book: Codebook) -> np.ndarray:
    """The nearest listed entry of each point, ties to the lower index."""
    both = exact(np.concatenate([points, book.entries]), points.shape[1]).dtype
    apart = squares(points.astype(both), book.entries.astype(both))
    return np.where(lists, apart, np.inf if both == np.float64 else np.iinfo(np.int64).max).argmin(1)


def add_up(tree: Tree, book: Codebook, counts: np.ndarray, sums: np.ndarray) -> None:
    """Add the tree's points to the counts and sums of the entries that own them."""
    owned, owners, leaves, lists = descend(tree, book)
    np.add.at(counts, owners, tree.counts[owned])
    np.add.at(sums, owners, tree.sums[owned])
    places, which = spans(tree.first[leaves], tree.last[leaves])
    points = tree.points[places].astype(np.int64)
    if len(points):
        codes = nearest(points, lists[which], book)
        np.add.at(counts, codes, 1)
        np.add.at(sums, codes, points)


def codes_of(tree: Tree, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every point, in the order of the block's rows."""
    owned, owners, leaves, lists = descend(tree, book)
    codes = np.zeros(len(tree.points), np.int64)
    places, which = spans(tree.first[owned], tree.last[owned])
    codes[places] = owners[which]
    places, which = spans(tree.first[leaves], tree.last[leaves])
    if len(places):
        codes[places] = nearest(tree.points[places].astype(np.int64), lists[which], book)
    apart = ((tree.points.astype(np.int64) - book.entries[codes]) ** 2).sum(1)
    out, errors = np.empty_like(codes), np.empty_like(codes)
    out[tree.order], errors[tree.order] = codes, apart
    return out, errors


def usable(frame: DataFrame) -> DataFrame:
    """The rows whose vector has only finite components."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return frame.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).where(fine)


def whole(values: np.ndarray, width: int) -> np.ndarray:
    bound = 2.0 ** min(27, int((60 - np.log2(max(width, 1))) // 2))
    return np.clip(np.floor(values * SCALE), -bound, bound).astype(np.int64)


def trees(frame: DataFrame, width: int) -> DataFrame:
    """One row a block of vectors: ids, labels and the trees of its parts."""
    label = frame.schema["label"].dataType.simpleString()
    tree = ", ".join(f"{name}: binary" for name in Tree.TYPES)
    kind = pa.list_(pa.struct([(name, pa.binary()) for name in Tree.TYPES]))
    schema = f"vec_id array<long>, label array<{label}>, trees array<struct<{tree}>>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                block = batch.slice(start, BLOCK_ROWS)
                values = whole(block.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, width * PARTS), width)
                built = [build(values[:, k * width : (k + 1) * width]).row() for k in range(PARTS)]
                ends = pa.array([0, block.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, block.column(name)) for name in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([built], kind)], ["vec_id", "label", "trees"])

    return frame.mapInArrow(run, schema)


def totals(blocks: DataFrame, books: list[Codebook], width: int) -> DataFrame:
    """Count and sums of the points that each entry owns, over all blocks."""
    names = [f"s{i}" for i in range(width)]
    schema = "part int, entry int, n long, " + ", ".join(f"{name} long" for name in names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b.entries), np.int64) for b in books]
        sums = [np.zeros_like(b.entries) for b in books]
        for batch in batches:
            for block in batch.column("trees"):
                for k, row in enumerate(block.as_py()):
                    add_up(Tree.read(row, width), books[k], counts[k], sums[k])
        for k in range(len(books)):
            used = np.flatnonzero(counts[k])
            columns = [np.full(len(used), k, np.int32), used.astype(np.int32), counts[k][used], *sums[k][used].T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "n", *names])

    own = blocks.select("trees").mapInArrow(run, schema)
    return own.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)])


def coded(blocks: DataFrame, books: list[Codebook], width: int) -> DataFrame:
    """Code and error of every vector."""
    label = blocks.schema["label"].dataType.elementType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = [codes_of(Tree.read(row, width), books[k]) for k, row in enumerate(batch.column("trees")[i].as_py())]
                codes = np.stack([c for c, _ in found], 1).astype(np.uint8)
                code = [row.tobytes().hex() for row in codes]
                error = np.sum([e for _, e in found], axis=0)
                ids, labels = batch.column("vec_id")[i].values, batch.column("label")[i].values
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def label_key(label: str) -> Column:
    """Labels as text in which null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("-"))


def compress(vectors: DataFrame) -> DataFrame:
    """Codes, errors, the error of all vectors with the label, and the digest of the codebooks."""
    frame = usable(vectors)
    size = F.size("embedding")
    sizes = frame.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).where(f"size > 0 and size % {PARTS} = 0")
    chosen = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    length = chosen[0]["size"] if chosen else PARTS
    width = length // PARTS
    fits = frame.where(size == length)
    start = fits.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    entries = whole(np.array([r.embedding for r in start], np.float64).reshape(-1, length), width)
    books = [Codebook(entries[:, k * width : (k + 1) * width]) for k in range(PARTS)]
    blocks = stored(trees(fits, width), "metric-trees")
    for _ in range(ROUNDS if start else 0):
        moved = [book.entries.copy() for book in books]
        for row in totals(blocks, books, width).collect():
            moved[row.part][row.entry] = [total // row.n for total in row[3:]]
        books = [Codebook(entries) for entries in moved]
    text = ",".join(str(x) for book in books for x in book.entries.ravel())

    rows = coded(blocks, books, width).withColumn("key", label_key("label"))
    rows = stored(rows, "metric-codes")
    by_label = rows.groupBy("key").agg(F.count(F.lit(1)).alias("weight"), F.sum("error").alias("label_error"))
    rows = heavy_lookup(rows, by_label, "key", "weight", rows.count()).drop("key", "label")
    others = frame.where(size != length).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"))])
    return rows.unionByName(others).withColumn("codebooks_sha256", F.lit(hashlib.sha256(text.encode()).hexdigest()))


def codes_sql(length: int = 64) -> str:
    """The same in DuckDB, every part compared with every entry."""
    width = length // PARTS
    dims = range(width)
    ctes = [
        "kept AS MATERIALIZED (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"parts AS MATERIALIZED (SELECT vec_id, label, part, {', '.join(f'floor({SCALE} * embedding[part * {width} + {i + 1}]::DOUBLE)::BIGINT AS v{i}' for i in dims)} FROM kept, range(0, {PARTS}) AS r(part))",
        f"b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, {', '.join(f'v{i}' for i in dims)} FROM parts QUALIFY entry < {ENTRIES})",
    ]
    apart = " + ".join(f"(p.v{i} - b.v{i}) * (p.v{i} - b.v{i})" for i in dims)
    for k in range(ROUNDS + 1):
        ctes.append(
            f"a{k} AS MATERIALIZED (SELECT p.vec_id, p.label, p.part, min(struct_pack(d := {apart}, e := b.entry)) AS best FROM parts p JOIN b{k} b ON p.part = b.part GROUP BY ALL)"
        )
        if k < ROUNDS:
            means = ", ".join(f"floor(sum(p.v{i}) / count(*))::BIGINT AS v{i}" for i in dims)
            ctes.append(f"m{k} AS (SELECT p.part, a.best.e AS entry, {means} FROM parts p JOIN a{k} a ON p.vec_id = a.vec_id AND p.part = a.part GROUP BY ALL)")
            kept = ", ".join(f"coalesce(m.v{i}, b.v{i}) AS v{i}" for i in dims)
            ctes.append(f"b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, {kept} FROM b{k} b LEFT JOIN m{k} m ON b.part = m.part AND b.entry = m.entry)")
    listed = " || ',' || ".join(f"v{i}" for i in dims)
    ctes.append(f"codes AS (SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id, label)")
    ctes.append(f"book AS (SELECT sha256(string_agg({listed}, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})")
    return "WITH " + ",\n".join(ctes) + "\nSELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM codes, book"
