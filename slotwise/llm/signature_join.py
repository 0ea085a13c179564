"""Exact n-gram Jaccard join with signature trees; the result is components, not pairs.

A text's set holds the 64-bit hashes of its distinct 4-word shingles; equal sets are one class. Linked classes share k
shingles among the first |x| - ceil(t |x|) + k of each in one global order (different sets that link have t / (1 - t)
shingles in common at least, which bounds k), so candidates are the classes below k shared prefix keys. The order puts shingles that stand out in a table of 4,194,304 hashed counts last, which keeps boilerplate out
of the prefixes; any order is right. Tasks hand in their counts by blocks of the table, so what they write follows the input.

1. Leaders: every key points at its smallest class; a class is compared with the leader that shares most keys with it, two
   at least. Keys of more than 32 classes that still join different components point at four more, drawn by hash, again
   and again while one asked class in eight is linked. Groups of near copies, however large, become stars in linear work.
2. Signature trees: of the keys that still join different components, those with the same members count as one, with their
   number as its weight. The members' sets of each form a tree whose nodes hold the OR of the members' bitmaps, their
   size range and component range. A dual traversal drops pairs of nodes whose largest possible overlap is too small, or
   which lie in one component already, and yields pairs to compare; a pair leaves its task only if the members' bucket
   counts allow a link too, and only below the smallest key that both have. Groups above 512 members are dealt in blocks,
   one task for each pair of blocks. If there are many pairs, one in sixteen, drawn by hash, is compared first: what these
   links join needs no other pair, and links between components of such a draw are at most some sixteen a class.
3. All pairs are compared exactly on their texts, and the links give the components.

Cases: null or empty texts have an empty set, link with nothing and are their own component; texts of fewer than four
words are one shingle; repeated rows have equal sets; rows that share an id but not a text are separate members;
extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.frames import stored, text_tag, touching
from slotwise.llm.textops import LOWER, SPACE, PrefixHash, Slice, documents, map_slices, mix, sequence_hash, slices, words
from slotwise.operators.components import asset_components
from slotwise.session import bounded_batches

WIDTH = 4
#: Similarity as a fraction in hundredths.
THRESHOLD = 85
RARITY_BITS = 22
#: Hashed counts that travel together, and steps of an octave in which their sums are kept.
RARITY_BLOCK = 1 << 16
RARITY_STEPS = 8
SIGNATURE_BITS = 512
COUNT_BUCKETS = 256
FANOUT = 4
BLOCK = 512
SHARED_WITH_LEADER = 2
#: Classes below a key that is worth more leaders, leaders a round, and one in how many asked classes must be linked to go on.
CROWD = 32
LEADERS = 4
GAIN = 8
#: One pair of the trees in how many is compared before the others, and steps of a test for common keys at a time.
DRAW = 16
KEY_STEPS = 1 << 20
#: Keys that a linked pair shares at least, where the threshold allows it; prefixes are that much longer.
SHARED_KEYS = 4


def shingle_sets(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of the distinct shingles of every text, ordered by row and value."""
    data = LOWER[part.data]
    starts, ends = words(Slice(part.batch, data, part.bounds), SPACE ^ True)
    rows = part.rows(starts)
    hashes = PrefixHash(data)(starts, ends)
    values = sequence_hash(hashes, width)
    at = np.flatnonzero(rows[: len(values)] == rows[len(rows) - len(values) :])
    values, own = values[at], rows[at]
    begin = np.searchsorted(rows, np.arange(len(part) + 1))
    few = np.flatnonzero((np.diff(begin) < width) & (np.diff(begin) > 0))
    if len(few):
        short = [mix(sequence_hash(hashes[begin[i] : begin[i + 1]], int(begin[i + 1] - begin[i])) + np.uint64(begin[i + 1] - begin[i])) for i in few.tolist()]
        values, own = np.concatenate([values, *short]), np.concatenate([own, few])
    order = np.lexsort((values, own))
    values, own = values[order], own[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    return own[first], values[first]


def class_ids(rows: np.ndarray, values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One 64-bit id of each row's set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(0x2545F4914F6CDD1D)), dtype=np.uint64)])
    return mix(sums[begin[1:]] - sums[begin[:-1]] + np.diff(begin).astype(np.uint64)).view(np.int64)


def signatures(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Bitmaps of the sets, (count, bytes)."""
    bits = np.zeros((count, SIGNATURE_BITS), bool)
    bits[rows, (values >> np.uint64(40)).astype(np.int64) % SIGNATURE_BITS] = True
    return np.packbits(bits, axis=1)


def bucket_counts(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """How many members of each set fall in each of ``COUNT_BUCKETS`` buckets, 255 for more, (count, buckets)."""
    at = rows * COUNT_BUCKETS + (values >> np.uint64(20)).astype(np.int64) % COUNT_BUCKETS
    held = np.bincount(at, minlength=count * COUNT_BUCKETS).reshape(count, COUNT_BUCKETS)
    return np.minimum(held, 255).astype(np.uint8)


def enough_in_common(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, threshold: int) -> np.ndarray:
    """Whether sets with these bucket counts and this sum of sizes may link: the overlap is at most the sum of the lesser counts."""
    least = np.minimum(x, y)
    return (least == 255).any(axis=1) | ((100 + threshold) * least.sum(axis=1, dtype=np.int64) >= threshold * sizes)


def _described(docs: DataFrame, width: int) -> DataFrame:
    """Scratch table: a row per document, and per task the packed counts of blocks of hashed shingles (where ``block`` is set)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.int32)
        for batch in batches:
            for part in slices(batch):
                n = len(part)
                rows, values = shingle_sets(part, width)
                np.add.at(total, _rarity_bucket(values), 1)
                begin = np.searchsorted(rows, np.arange(n + 1))
                nothing = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tag"), pa.array(np.diff(begin), pa.int64()), pa.array(class_ids(rows, values, begin)),
                     pa.array([s.tobytes() for s in signatures(rows, values, n)], pa.binary()),
                     pa.array([c.tobytes() for c in bucket_counts(rows, values, n)], pa.binary()), nothing],
                    ["doc_id", "tag", "n_shingles", "cid", "signature", "counts", "block"],
                )
        blocks, squeeze = total.reshape(-1, RARITY_BLOCK), zstandard.ZstdCompressor(level=3)
        some = np.flatnonzero(blocks.any(axis=1))
        nothing = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [nothing, pa.nulls(len(some), pa.int32()), nothing, nothing, pa.nulls(len(some), pa.binary()), pa.array([squeeze.compress(blocks[i].tobytes()) for i in some.tolist()], pa.binary()), pa.array(some, pa.int64())],
            ["doc_id", "tag", "n_shingles", "cid", "signature", "counts", "block"],
        )

    return documents(docs, "doc_id", "text").withColumn("tag", text_tag()).mapInArrow(
        run, "doc_id long, tag int, n_shingles long, cid long, signature binary, counts binary, block long"
    )


def _rarity_bucket(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def _levels(described: DataFrame) -> np.ndarray:
    """Octaves by which each hashed count exceeds the usual one; only one byte a bucket comes to the driver."""

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        plain, total = zstandard.ZstdDecompressor(), np.zeros(RARITY_BLOCK, np.int64)
        for packed in table.column("counts"):
            total += np.frombuffer(plain.decompress(packed.as_py()), np.int32)
        steps = np.minimum(np.rint(RARITY_STEPS * np.log2(np.maximum(total, 1))), 255).astype(np.uint8)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "steps": pa.array([steps.tobytes()], pa.binary())})

    summed = described.where("block is not null").select("block", "counts").groupBy("block").applyInArrow(add, "block long, steps binary")
    steps = np.zeros(1 << RARITY_BITS, np.uint8)
    for row in summed.collect():
        steps[row.block * RARITY_BLOCK : (row.block + 1) * RARITY_BLOCK] = np.frombuffer(row.steps, np.uint8)
    return np.maximum(steps.astype(np.int16) - int(np.median(steps)), 0).astype(np.uint8) // RARITY_STEPS


def _prefixes(docs: DataFrame, level: np.ndarray, width: int, threshold: int, shared: int) -> DataFrame:
    """Prefix keys of every set."""

    def work(part: Slice) -> pa.RecordBatch:
        rows, values = shingle_sets(part, width)
        begin = np.searchsorted(rows, np.arange(len(part) + 1))
        cid, size = class_ids(rows, values, begin), np.diff(begin)
        order = np.lexsort((values, level[_rarity_bucket(values)], rows))
        place = np.arange(len(rows)) - begin[rows]
        length = size - -(-threshold * size // 100) + shared
        taken = place < length[rows]
        return pa.RecordBatch.from_arrays([pa.array(values[order][taken].view(np.int64)), pa.array(cid[rows[taken]])], ["key", "cid"])

    return map_slices(documents(docs, "text"), work, "key long, cid long")


def _possible(frame: DataFrame, threshold: int) -> DataFrame:
    """Keep pairs whose sizes and bucket counts allow a link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("a_size", "b_size"))
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COUNT_BUCKETS) for c in ("a_counts", "b_counts"))
            good = enough_in_common(x, y, a + b, threshold) & (100 * np.minimum(a, b) >= threshold * np.maximum(a, b))
            yield batch.select(["a", "b", "a_doc", "b_doc"]).filter(pa.array(good))

    return frame.mapInArrow(run, "a long, b long, a_doc long, b_doc long")


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, threshold: int) -> DataFrame:
    """The pairs (a, b) whose sets link, compared exactly on the texts of one document of each class."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("doc_id").alias(f"{x}_doc"), F.col("n_shingles").alias(f"{x}_size"), F.col("counts").alias(f"{x}_counts"))
    pairs = stored(_possible(pairs.join(side("a"), "a").join(side("b"), "b"), threshold), "pairs")
    needed = pairs.select(F.col("a").alias("cid"), F.col("a_doc").alias("doc_id"))
    needed = needed.unionByName(pairs.select(F.col("b").alias("cid"), F.col("b_doc").alias("doc_id"))).distinct()
    wanted, _ = touching(needed)

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in wanted(batches):
            for part in slices(batch):
                rows, values = shingle_sets(part, width)
                cid = class_ids(rows, values, np.searchsorted(rows, np.arange(len(part) + 1)))
                packed = [squeeze.compress(part.raw(i)) for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cid), pa.array(packed, pa.binary())], ["doc_id", "cid", "packed"])

    texts = documents(docs, "doc_id", "text").where("text is not null").mapInArrow(fetch, "doc_id long, cid long, packed binary")
    texts = texts.alias("t").join(needed.alias("w"), F.expr("t.cid = w.cid and t.doc_id <=> w.doc_id"), "left_semi")
    texts = stored(texts.groupBy("cid").agg(F.first("packed").alias("packed")), "texts")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, held = zstandard.ZstdDecompressor(), {}

        def sets(cid: int, packed: pa.BinaryScalar) -> np.ndarray:
            if cid not in held:
                if len(held) > 64:
                    held.clear()
                raw = np.frombuffer(plain.decompress(packed.as_py()), np.uint8)
                held[cid] = shingle_sets(Slice(None, raw, np.array([0, len(raw)])), width)[1]
            return held[cid]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            x, y = batch.column("a_text"), batch.column("b_text")
            good = np.zeros(len(a), bool)
            for i in range(len(a)):
                one, two = sets(a[i], x[i]), sets(b[i], y[i])
                common = len(np.intersect1d(one, two, assume_unique=True))
                good[i] = 100 * common >= threshold * (len(one) + len(two) - common)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    joined = pairs.select("a", "b").join(texts.select(F.col("cid").alias("a"), F.col("packed").alias("a_text")), "a")
    joined = joined.join(texts.select(F.col("cid").alias("b"), F.col("packed").alias("b_text")), "b")
    return stored(joined.select("a", "b", "a_text", "b_text").mapInArrow(compare, "a long, b long"), "links")


def _components(links: DataFrame) -> DataFrame:
    """Component of every class with a link."""
    edges = links.select(F.col("a").alias("sample"), F.col("b").alias("asset"))
    edges = edges.unionByName(links.select(F.col("b").alias("sample"), F.col("b").alias("asset")))
    members = asset_components(edges.select("sample").distinct(), edges)
    return members.select(F.col("sample").alias("cid"), F.col("component").alias("comp"))


def _located(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Classes below their keys, with the component that each is in so far."""
    return rows.drop("lead").join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))


def _one_of_alike(keys: DataFrame) -> DataFrame:
    """keys[key, m, one, two] by the members' number and digests: one key for each set of members, and how many have it."""
    return keys.groupBy("one", "two", "m").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("weight")).select("key", "m", "weight")


def _member_digests() -> list[Column]:
    """Number and 128-bit digest of the classes below a key."""
    return [F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("cid")).alias("one"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("two")]


def _more_leaders(rows: DataFrame, comps: DataFrame, seeds: range) -> DataFrame:
    """Pairs (a, b) of a class and, for each seed, the leader outside its component that shares most keys with it."""
    located = _located(rows, comps)
    drawn = [F.min(F.struct(F.xxhash64("cid", F.lit(s)).alias("h"), F.col("cid").alias("b"), F.col("comp").alias("there"))).alias(f"lead{s}") for s in seeds]
    heads = located.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), *drawn).where("low < high")
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("seed"), F.col(f"lead{s}.b"), F.col(f"lead{s}.there")) for s in seeds]))
    leads = heads.select("key", each.alias("lead")).select("key", "lead.*")
    shared = located.join(leads, "key").where("comp <> there").groupBy(F.col("cid").alias("a"), "seed", "b").agg(F.sum("weight").alias("count"))
    best = shared.where(F.col("count") >= SHARED_WITH_LEADER).groupBy("a", "seed").agg(F.max(F.struct("count", "b")).getField("b").alias("b"))
    return best.select("a", "b").distinct()


class Tree:
    """Signature trees of many groups at once, level by level; nodes of a level are ordered by group."""

    def __init__(self, group: np.ndarray, size: np.ndarray, bits: np.ndarray, marks: np.ndarray, threshold: int):
        self.threshold = threshold
        extra = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [{"low": size, "high": size, "extra": extra, "bits": bits, "mark_low": marks, "mark_high": marks}]
        self.first: list[np.ndarray] = []
        while len(group) > 1 and (group[1:] == group[:-1]).any():
            begin = np.searchsorted(group, group)
            node = (np.arange(len(group)) - begin) // FANOUT
            first = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (node[1:] != node[:-1])]))
            below = self.levels[-1]
            self.levels.append(
                {
                    "low": np.minimum.reduceat(below["low"], first),
                    "high": np.maximum.reduceat(below["high"], first),
                    "extra": np.maximum.reduceat(below["extra"], first),
                    "bits": np.bitwise_or.reduceat(below["bits"], first, axis=0),
                    "mark_low": np.minimum.reduceat(below["mark_low"], first, axis=0),
                    "mark_high": np.maximum.reduceat(below["mark_high"], first, axis=0),
                }
            )
            self.first.append(np.append(first, len(group)))
            group = group[first]

    def possible(self, depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether any pair below two nodes may be a link that is not yet implied."""
        at, threshold = self.levels[depth], self.threshold
        low = at["low"]
        good = (100 * at["high"][a] >= threshold * low[b]) & (100 * at["high"][b] >= threshold * low[a])
        for k in range(at["mark_low"].shape[1]):
            left, right = at["mark_low"][:, k], at["mark_high"][:, k]
            good &= ~((left[a] == right[a]) & (left[b] == right[b]) & (left[a] == left[b]))
        some = np.flatnonzero(good)
        x, y = a[some], b[some]
        both = np.bitwise_count(at["bits"][x] & at["bits"][y]).sum(axis=1, dtype=np.int64) + np.minimum(at["extra"][x], at["extra"][y])
        good[some] = (100 + threshold) * both >= threshold * (low[x] + low[y])
        return good

    def pairs(self, limit: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Dual traversal from every root with itself; yields pairs of members."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top]["low"]))
        stack = [(top, roots, roots)]
        while stack:
            depth, a, b = stack.pop()
            if len(a) > limit:
                stack += [(depth, a[k : k + limit], b[k : k + limit]) for k in range(0, len(a), limit)]
                continue
            good = self.possible(depth, a, b)
            a, b = a[good], b[good]
            if not len(a):
                continue
            if not depth:
                yield a, b
                continue
            first = self.first[depth - 1]
            i = (first[a][:, None] + np.arange(FANOUT))[:, :, None]
            j = (first[b][:, None] + np.arange(FANOUT))[:, None, :]
            there = (i < first[a + 1][:, None, None]) & (j < first[b + 1][:, None, None]) & ((a != b)[:, None, None] | (i < j if depth == 1 else i <= j))
            i, j = np.broadcast_arrays(i, j)
            stack.append((depth - 1, i[there], j[there]))


def _drawn(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a pair of classes (the smaller first) is among those that are compared first."""
    return mix(mix(a.view(np.uint64)) + b.view(np.uint64)) % np.uint64(DRAW) == 0


class KeyLists:
    """The ascending keys of every member, with their weights."""

    def __init__(self, bounds: np.ndarray, keys: np.ndarray, weights: np.ndarray):
        self.bounds, self.weights = bounds, weights
        self.known, self.rank = np.unique(keys, return_inverse=True)
        self.places = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) * len(self.known) + self.rank

    def meet_first(self, a: np.ndarray, b: np.ndarray, key: np.ndarray, shared: int) -> np.ndarray:
        """Whether ``key`` is the smallest that members a and b have in common, and all of these weigh ``shared`` at least."""
        sizes = np.diff(self.bounds)
        a, b = np.where(sizes[a] <= sizes[b], a, b), np.where(sizes[a] <= sizes[b], b, a)
        good, steps = np.zeros(len(a), bool), np.cumsum(sizes[a])
        cuts = np.searchsorted(steps, np.arange(KEY_STEPS, steps[-1], KEY_STEPS)) if len(a) else []
        for part in np.split(np.arange(len(a)), np.unique(cuts)):
            n = sizes[a[part]]
            pair = np.repeat(np.arange(len(part)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.bounds[a[part]], n)
            wanted = b[part][pair] * len(self.known) + self.rank[at]
            found = self.places[np.minimum(np.searchsorted(self.places, wanted), len(self.places) - 1)] == wanted
            weight = np.bincount(pair[found], self.weights[at[found]], len(part))
            some, first = np.unique(pair[found], return_index=True)
            smallest = np.zeros(len(part), bool)
            smallest[some] = self.known[self.rank[at[found][first]]] == key[part][some]
            good[part] = smallest & (weight >= shared)
        return good


def _tree_pairs(members: DataFrame, threshold: int, shared: int, draw: bool | None = None) -> DataFrame:
    """Pairs of classes by signature trees; members[key, left, right, side, cid, comp, n_shingles, signature, counts, keys, weights].

    A pair leaves a tree only if its bucket counts allow a link as well, only below the first of its common keys, and only
    if these weigh ``shared`` together. ``draw``: only the pairs that are compared first, or only the others.
    """

    def search(batch: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = {c: batch.column(c).to_numpy() for c in ("key", "left", "right", "side", "cid", "comp", "n_shingles")}
        order = np.lexsort((columns["n_shingles"], columns["right"], columns["left"], columns["key"]))
        columns = {c: v[order] for c, v in columns.items()}
        packed = lambda c, size: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, size)[order]
        bits, counts = packed("signature", SIGNATURE_BITS // 8).view(np.uint64), packed("counts", COUNT_BUCKETS)
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("keys")).to_numpy())]).astype(np.int64)
        lists = KeyLists(bounds, *[pc.list_flatten(batch.column(c)).to_numpy() for c in ("keys", "weights")])
        change = np.zeros(len(order), bool)
        for c in ("key", "left", "right"):
            change[1:] |= columns[c][1:] != columns[c][:-1]
        # In a task of two different blocks, pairs of one block are left to that block's own task.
        side = np.where(columns["left"] == columns["right"], np.arange(len(order)) + 2, columns["side"])
        tree = Tree(np.cumsum(change), columns["n_shingles"], bits, np.stack([columns["comp"], side], axis=1), threshold)
        sizes = columns["n_shingles"]
        for a, b in tree.pairs():
            if draw is not None:
                x, y = columns["cid"][a], columns["cid"][b]
                own = _drawn(np.minimum(x, y), np.maximum(x, y)) == draw
                a, b = a[own], b[own]
            good = enough_in_common(counts[a], counts[b], sizes[a] + sizes[b], threshold)
            a, b = a[good], b[good]
            good = lists.meet_first(order[a], order[b], columns["key"][a], shared)
            x, y = columns["cid"][a[good]], columns["cid"][b[good]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 50_000:
                continue
            table = pa.Table.from_batches(held)
            differs = np.zeros(table.num_rows, bool)
            for c in ("key", "left", "right"):
                values = table.column(c).to_numpy()
                differs |= values != values[-1]
            last = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
            if last:
                yield from search(table.slice(0, last))
                held = table.slice(last).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield from search(pa.Table.from_batches(held))

    dealt = members.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")
    return dealt.mapInArrow(run, "a long, b long")


def _open_members(rows: DataFrame, comps: DataFrame, classes: DataFrame, shared: int) -> DataFrame:
    """Classes below the keys that still join different components, a row for each task of the trees."""
    located = _located(rows, comps)
    open_keys = located.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), *_member_digests()).where("low < high")
    open_keys = _one_of_alike(open_keys).select("key", "weight", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    opened = stored(located.join(open_keys, "key"), "opened")
    lists = F.sort_array(F.collect_list(F.struct("key", "weight"))).alias("l")
    lists = opened.groupBy("cid").agg(lists, F.sum("weight").alias("weight")).where(F.col("weight") >= shared)
    lists = lists.select("cid", F.col("l.key").alias("keys"), F.col("l.weight").alias("weights"))
    members = opened.withColumn("block", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select(
        "key", "cid", "comp", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
    )
    return members.join(lists, "cid").join(classes.select("cid", "n_shingles", "signature", "counts"), "cid")


def _classes(docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """doc_id, tag, n_shingles and comp (a class id; null for empty sets) of every row."""
    bounded_batches(docs.sparkSession)
    described = stored(_described(docs, width), "described")
    own = described.where("block is null").select("doc_id", "tag", "n_shingles", "cid", "signature", "counts")
    level = _levels(described)

    shared = max(1, min(SHARED_KEYS, threshold // max(100 - threshold, 1)))
    keys = stored(_prefixes(docs, level, width, threshold, shared), "prefixes")
    held = keys.groupBy("key").agg(F.min("cid").alias("lead"), F.max("cid").alias("most")).where("lead < most")
    rows = stored(keys.join(held.select("key", "lead"), "key").distinct(), "candidates")
    first = F.min(F.struct("doc_id", "n_shingles", "signature", "counts")).alias("f")
    classes = own.where("n_shingles > 0").groupBy("cid").agg(first).select("cid", "f.*")

    near = rows.where("cid <> lead").groupBy(F.col("cid").alias("a"), F.col("lead").alias("b")).count()
    near = near.where(F.col("count") >= SHARED_WITH_LEADER).groupBy("a").agg(F.max(F.struct("count", "b")).getField("b").alias("b"))
    links = _links(docs, classes, near, width, threshold)
    comps = stored(_components(links), "components")

    crowds = _one_of_alike(rows.groupBy("key").agg(*_member_digests()).where(F.col("m") > CROWD)).select("key", "weight")
    crowded = stored(rows.select("key", "cid").join(crowds, "key"), "crowded")
    asked = 0 if crowded.isEmpty() else 1
    turn = 0
    while asked:
        near = stored(_more_leaders(crowded, comps, range(turn * LEADERS, (turn + 1) * LEADERS)), "leaders")
        asked = near.select("a").distinct().count()
        more = _links(docs, classes, near, width, threshold) if asked else near
        found = more.select("a").distinct().count()
        if found:
            links = links.unionByName(more)
            comps = stored(_components(links), "components")
        if GAIN * found < asked:
            break
        turn += 1

    members = _open_members(rows, comps, classes, shared)
    first = stored(_tree_pairs(members, threshold, shared, True), "drawn")
    rest = None
    if DRAW * first.count() > members.select("cid").distinct().count():
        more = _links(docs, classes, first, width, threshold)
        if not more.isEmpty():
            links = links.unionByName(more)
            comps = stored(_components(links), "components")
            members = _open_members(rows, comps, classes, shared)
        rest = False
    more = _links(docs, classes, _tree_pairs(members, threshold, shared, rest), width, threshold)
    if not more.isEmpty():
        comps = stored(_components(links.unionByName(more)), "components")

    placed = own.select("doc_id", "tag", "n_shingles", "cid").join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    return placed.select("doc_id", "tag", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("comp")).alias("comp"))


def similar_components(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    placed = _classes(docs, width, threshold)
    smallest = placed.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("smallest"))
    return placed.join(smallest, "comp", "left").select("doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """The documents without all but the first (by id) of every component; empty texts all stay."""
    placed = _classes(docs, width, threshold).where("comp is not null")
    best = placed.groupBy("comp").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("doc_id", "tag")).alias("best")).where("m > 1")
    groups = placed.join(best, "comp").groupBy("doc_id", "tag").agg(F.first("best").alias("best"))
    stays = F.expr("best.doc_id <=> doc_id and best.tag = tag").alias("__stays")
    groups = stored(groups.select("doc_id", F.col("tag").alias("__tag"), stays), "groups")
    yes, no = touching(groups)
    groups = groups.withColumnRenamed("doc_id", "__id")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (text_tag() == F.col("__tag"))
    hit = docs.mapInArrow(yes, docs.schema).join(groups, same, "left").where("__stays or __stays is null")
    order = Window.partitionBy("doc_id", text_tag()).orderBy(F.lit(1))
    hit = hit.withColumn("__copy", F.row_number().over(order)).where("__stays is null or __copy = 1").select(docs.columns)
    return hit.unionByName(docs.mapInArrow(no, docs.schema))
