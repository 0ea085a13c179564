"""Quality scores by histogram gradient-boosted trees over document statistics.

Every text becomes a row of statistics (shares of kinds of characters, word and line repetition, lengths), each on a fixed
scale cut into 4,096 cells. The learning rows' cells are counted in Spark, and cut points at equal counts turn them into
at most 64 bins. Trees of fixed depth grow level by level: tasks add up gradients and Hessians by (node, statistic, bin),
Spark sums the histograms, and the driver, which sees one histogram a level and never a row, takes the best split of each
node. Gradients are whole numbers (units of 2^-20), so sums do not depend on the order of tasks and the model is the same
on every run. The finished trees are flat arrays: features, bins and leaf values by (tree, node), traversed by numpy for
all rows of a batch at once.

All labelled rows are learnt from, none is sampled. What the driver holds is bounded by the parameters: statistics x cells
counts once, nodes x statistics x bins sums a level.

Cases: a null text is an empty one and gets a score like any other; equal texts get equal scores; labels of one doc_id are
averaged, null labels and null doc_ids teach nothing; with no labels at all every score is 0.5; repeated rows stay; only
``doc_id`` and ``text`` are read of the documents, ``doc_id`` and ``quality`` of the labels, so other columns cannot
clash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.frames import stored
from slotwise.llm.textops import SPACE, PrefixHash, Slice, documents, map_slices, per_row, sequence_hash, words

CELLS = 4096
BINS = 64
TREES = 16
DEPTH = 3
RATE = 0.4
#: Added to Hessians, and the least Hessian on either side of a split.
RIDGE = 1.0
LEAST = 1.0
UNIT = 1 << 20
THRESHOLD = 0.7

#: Statistics and the largest value of their scales.
SCALES = {
    "log_chars": 32.0, "log_words": 32.0, "log_lines": 32.0, "word_length": 64.0, "word_spread": 64.0, "upper": 1.0, "space": 1.0, "digit": 1.0,
    "symbol": 1.0, "shout": 1.0, "stop": 1.0, "other_ascii": 1.0, "beyond_ascii": 1.0, "short_words": 1.0, "symbol_words": 1.0, "same_as_last": 1.0,
    "distinct_words": 1.0, "top_word": 1.0, "repeated_lines": 1.0, "repeated_triples": 1.0, "byte_entropy": 8.0,
}

KINDS = {
    "upper": bytes(range(65, 91)), "space": b" \t\n\v\f\r", "digit": b"0123456789", "symbol": b"#*$%&|<>~^{}[]\\_=+@", "shout": b"!?",
    "stop": b".,;:", "other_ascii": b"\"'`()-/",
}


def _table(members: Iterable[int]) -> np.ndarray:
    held = np.zeros(256, bool)
    held[list(members)] = True
    return held


MEMBERS = {name: _table(members) for name, members in KINDS.items()}


def _group_sizes(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and size of every group of equal keys in one row."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    starts = np.flatnonzero(new)
    return rows[starts], np.diff(np.append(starts, len(keys)))


def statistics(part: Slice) -> dict[str, np.ndarray]:
    """The statistics of every text of a slice."""
    n, data, sizes = len(part), part.data, np.maximum(part.sizes, 1)

    def total(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[part.bounds])

    leads = total((data & 0xC0) != 0x80)
    chars = np.maximum(leads, 1)
    starts, ends = words(part, ~SPACE)
    rows = part.rows(starts)
    count = per_row(rows, n)
    per_word = np.maximum(count, 1)
    out = {name: total(members[data]) / chars for name, members in MEMBERS.items()}
    out["beyond_ascii"] = total(data >= 0xC0) / chars
    out["log_chars"], out["log_words"] = np.log2(1 + leads), np.log2(1 + count)
    lines = total(data == 10) + (part.sizes > 0)
    out["log_lines"] = np.log2(1 + lines)

    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    length = np.minimum(points[ends] - points[starts], 256)
    mean = per_row(rows, n, length) / per_word
    out["word_length"] = mean
    out["word_spread"] = np.sqrt(np.maximum(per_row(rows, n, length * length) / per_word - mean * mean, 0))
    out["short_words"] = per_row(rows[length == 1], n) / per_word
    marked = np.concatenate([[0], np.cumsum(MEMBERS["symbol"][data] | MEMBERS["shout"][data])])
    out["symbol_words"] = per_row(rows[marked[ends] > marked[starts]], n) / per_word

    keys = PrefixHash(data)(starts, ends)
    same = (keys[1:] == keys[:-1]) & (rows[1:] == rows[:-1])
    out["same_as_last"] = per_row(rows[1:][same], n) / per_word
    owner, group = _group_sizes(keys, rows)
    out["distinct_words"] = per_row(owner, n) / per_word
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, group)
    out["top_word"] = top / per_word
    triples = sequence_hash(keys, 3)
    whole = np.flatnonzero(rows[: len(triples)] == rows[len(rows) - len(triples) :])
    owner, group = _group_sizes(triples[whole], rows[whole])
    out["repeated_triples"] = per_row(owner, n, group - 1) / per_word

    edges = np.unique(np.concatenate([part.bounds, np.flatnonzero(data == 10) + 1]))
    first, last = edges[:-1], edges[1:]
    full = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last = first[full], last[full]
    last = last - (data[last - 1] == 10) if len(last) else last
    owner, group = _group_sizes(PrefixHash(data)(first, last), part.rows(first))
    out["repeated_lines"] = per_row(owner, n, group - 1) / np.maximum(per_row(owner, n, group), 1)

    entropy = np.zeros(n)
    for i in np.flatnonzero(part.sizes):
        share = np.bincount(data[part.bounds[i] : part.bounds[i + 1]], minlength=256) / sizes[i]
        share = share[share > 0]
        entropy[i] = -(share * np.log2(share)).sum()
    out["byte_entropy"] = entropy
    return out


def cells(part: Slice) -> np.ndarray:
    """Statistics as cells of their scales, one row a text."""
    held = statistics(part)
    scaled = np.stack([held[name] / top for name, top in SCALES.items()], 1)
    return np.clip(np.floor(scaled * CELLS), 0, CELLS - 1).astype(np.uint16)


def rows_of(matrix: np.ndarray) -> pa.Array:
    """A matrix as a binary column, one value a row."""
    width = matrix.shape[1] * matrix.dtype.itemsize
    fixed = pa.Array.from_buffers(pa.binary(width), len(matrix), [None, pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])
    return fixed.cast(pa.binary())


def matrix_of(column: pa.Array, kind: type) -> np.ndarray:
    """The matrix in a binary column."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1)


def document_cells(docs: DataFrame) -> DataFrame:
    """doc_id and cells of every document."""
    work = lambda part: pa.RecordBatch.from_arrays([part.column("doc_id"), rows_of(cells(part))], ["doc_id", "cells"])
    return map_slices(documents(docs, "doc_id", "text"), work, "doc_id long, cells binary")


def cell_counts(rows: DataFrame) -> np.ndarray:
    """How many rows each cell of each statistic holds."""
    wide = len(SCALES) * CELLS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(wide, np.int64)
        for batch in batches:
            if batch.num_rows:
                at = matrix_of(batch.column("cells"), np.uint16).astype(np.int64) + np.arange(len(SCALES)) * CELLS
                held += np.bincount(at.ravel(), minlength=wide)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["at", "n"])

    out = np.zeros(wide, np.int64)
    for row in rows.select("cells").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[row.at] = row.n
    return out.reshape(len(SCALES), CELLS)


def cut_points(counts: np.ndarray) -> list[np.ndarray]:
    """Cells after which a new bin begins, about equally many rows between them."""
    out = []
    for own in counts:
        upto = np.cumsum(own)
        wanted = upto[-1] * np.arange(1, BINS) / BINS
        out.append(np.unique(np.searchsorted(upto, wanted)))
    return out


def bins(matrix: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(cut, matrix[:, k], "left") for k, cut in enumerate(cuts)], 1).astype(np.uint8)


@dataclass
class Forest:
    """Full binary trees as flat arrays: row t has the inner nodes of tree t in level order, then its leaves."""

    prior: float
    feature: np.ndarray  # trees x (2^depth - 1)
    bound: np.ndarray  # a row goes right if its bin is larger
    value: np.ndarray  # trees x 2^depth

    @classmethod
    def empty(cls, prior: float) -> Forest:
        inner = (1 << DEPTH) - 1
        return cls(prior, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64), np.zeros((0, inner + 1)))

    def planted(self) -> Forest:
        """With one more tree that has no split and no value yet."""
        inner = (1 << DEPTH) - 1
        return Forest(
            self.prior, np.vstack([self.feature, np.zeros((1, inner), np.int64)]),
            np.vstack([self.bound, np.full((1, inner), BINS, np.int64)]), np.vstack([self.value, np.zeros((1, inner + 1))]),
        )

    def place(self, tree: int, matrix: np.ndarray, depth: int = DEPTH) -> np.ndarray:
        """Node of each row on a level of a tree, counted from the left."""
        rows, node = np.arange(len(matrix)), np.zeros(len(matrix), np.int64)
        for _ in range(depth):
            right = matrix[rows, self.feature[tree, node]] > self.bound[tree, node]
            node = 2 * node + 1 + right
        return node - ((1 << depth) - 1)

    def margin(self, matrix: np.ndarray) -> np.ndarray:
        out = np.full(len(matrix), self.prior)
        for tree in range(len(self.feature)):
            out += self.value[tree, self.place(tree, matrix)]
        return out

    def score(self, matrix: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(matrix)))


def histogram(matrix: np.ndarray, target: np.ndarray, forest: Forest, depth: int) -> np.ndarray:
    """Gradients and Hessians of some rows by (node of the last tree's level, statistic, bin), in whole units."""
    done = Forest(forest.prior, forest.feature[:-1], forest.bound[:-1], forest.value[:-1])
    score = done.score(matrix)
    node = forest.place(len(forest.feature) - 1, matrix, depth)
    wide = len(SCALES) * BINS
    at = (node[:, None] * wide + np.arange(len(SCALES)) * BINS + matrix).ravel()
    out = []
    for values in (score - target, score * (1 - score)):
        units = np.repeat(np.rint(values * UNIT), len(SCALES))
        out.append(np.rint(np.bincount(at, weights=units, minlength=wide << depth)).astype(np.int64))
    return np.stack(out)


def summed(rows: DataFrame, forest: Forest, depth: int) -> np.ndarray:
    """The histogram of all rows: 2 x nodes x statistics x bins."""
    wide = (len(SCALES) * BINS) << depth

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, wide), np.int64)
        for batch in batches:
            if batch.num_rows:
                held += histogram(matrix_of(batch.column("bins"), np.uint8).astype(np.int64), batch.column("target").to_numpy(), forest, depth)
        used = np.flatnonzero(held.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[0, used]), pa.array(held[1, used])], ["at", "g", "h"])

    out = np.zeros((2, wide), np.int64)
    sums = rows.mapInArrow(run, "at long, g long, h long").groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    for row in sums.collect():
        out[:, row.at] = row.g, row.h
    return out.reshape(2, 1 << depth, len(SCALES), BINS)


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def best_splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistic, bin and children's values (nodes x 2) of the best split of every node; no split keeps all rows left."""
    g, h = np.cumsum(sums / UNIT, axis=3)
    all_g, all_h = g[:, :, -1:], h[:, :, -1:]
    better = gain(g, h) + gain(all_g - g, all_h - h) - gain(all_g, all_h)
    better[(h < LEAST) | (all_h - h < LEAST)] = -np.inf
    flat = better.reshape(len(better), -1)
    best = flat.argmax(1)
    feature, bound = best // BINS, best % BINS
    node = np.arange(len(better))
    split = flat[node, best] > 0
    feature, bound = np.where(split, feature, 0), np.where(split, bound, BINS)
    left_g, left_h = [np.where(split, x[node, feature, np.minimum(bound, BINS - 1)], x[node, 0, -1]) for x in (g, h)]
    right_g, right_h = all_g[:, 0, 0] - left_g, all_h[:, 0, 0] - left_h
    values = np.stack([-left_g / (left_h + RIDGE), -right_g / (right_h + RIDGE)], 1)
    return feature, bound, values


def fit(rows: DataFrame) -> Forest:
    """Trees from stored rows of bins and targets, one Spark job a level."""
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("target").alias("mean")).first()
    if not seen.n:
        return Forest.empty(0.0)
    share = min(max(seen.mean, 1 / (seen.n + 2)), 1 - 1 / (seen.n + 2))
    forest = Forest.empty(float(np.log(share / (1 - share))))
    for tree in range(TREES):
        forest = forest.planted()
        for depth in range(DEPTH):
            feature, bound, values = best_splits(summed(rows, forest, depth))
            level = slice((1 << depth) - 1, (2 << depth) - 1)
            forest.feature[tree, level], forest.bound[tree, level] = feature, bound
        forest.value[tree] = RATE * values.ravel()
    return forest


def learning_rows(held: DataFrame, labels: DataFrame, learns: Column) -> DataFrame:
    """Cells and mean label of the labelled rows to learn from."""
    targets = labels.select("doc_id", "quality").where("doc_id is not null and quality is not null")
    targets = targets.groupBy("doc_id").agg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.avg(F.col("quality").cast("double")))).alias("target"))
    return held.where(learns).join(targets, "doc_id").select("cells", "target")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document; rows whose checksum leaves 2 of 4 are held out from learning."""
    held = stored(document_cells(docs), "quality-cells")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    learn = stored(learning_rows(held, labels, ~held_out), "quality-rows")
    cuts = cut_points(cell_counts(learn))

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = rows_of(bins(matrix_of(batch.column("cells"), np.uint16), cuts))
                yield pa.RecordBatch.from_arrays([own, batch.column("target")], ["bins", "target"])

    forest = fit(stored(learn.mapInArrow(binned, "bins binary, target double"), "quality-bins"))

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = forest.score(bins(matrix_of(batch.column("cells"), np.uint16), cuts).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found)], ["doc_id", "held_out", "score"])

    rows = held.withColumn("held_out", held_out).mapInArrow(scored, "doc_id long, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
