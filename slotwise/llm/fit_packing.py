"""Best-fit packing after dominance reduction.

Only the histogram of piece lengths decides a packing, and it has at most ``capacity`` entries whatever the corpus
holds. The reduction walks lengths downwards and fixes small sets that dominate every other bin with that item: the item
alone if nothing fits beside it, a pair that fills the bin exactly or is the best when only one more item can fit, a
pair at least as large as any two smaller items, a triple whose members are each the largest possible. Whole runs of
equal bins are fixed at once. What is left is packed by best fit, largest first, over residual capacities, again in
runs. The plan is a list of runs; pieces find their place by their rank among the pieces of their length, which is
counted in hash buckets, so no group is ever collected.

Cases: a null text is an empty one and has just the end id; documents of any length are cut into full pieces with the
shorter one first; repeated rows are pieces of their own; ties of rank go by id and piece; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.textops import documents
from slotwise.session import scratch_path

CAPACITY = 1024
END_ID = 2
BUCKET_ROWS = 100_000
CACHED_WORDS = 400_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"

# Byte-level vocabularies spell a byte by its Latin-1 letter if that is visible, the others by letters from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
BYTE_LETTERS = {b: b for b in _VISIBLE} | {b: 256 + i for i, b in enumerate(_HIDDEN)}

Run = tuple[tuple[int, ...], int]


class _Items:
    """Lengths with counts, in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: n for k, n in counts.items() if n > 0}
        self.lengths = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.lengths.pop(bisect.bisect_left(self.lengths, length))

    def largest(self, most: int, without: tuple[int, ...] = ()) -> int | None:
        """The largest length up to ``most`` that is left when ``without`` is taken away."""
        at = bisect.bisect_right(self.lengths, most) - 1
        while at >= 0 and self.count[self.lengths[at]] <= without.count(self.lengths[at]):
            at -= 1
        return self.lengths[at] if at >= 0 else None

    def smallest(self, n: int, without: int) -> list[int]:
        out: list[int] = []
        for length in self.lengths:
            out += [length] * min(n - len(out), self.count[length] - (length == without))
            if len(out) >= n:
                break
        return out

    def times(self, pattern: tuple[int, ...]) -> int:
        return min(self.count.get(x, 0) // pattern.count(x) for x in set(pattern))


def _dominating(items: _Items, j: int, capacity: int) -> tuple[int, ...] | None:
    """A set with item j that dominates every feasible set with it, or None."""
    room = capacity - j
    first = items.largest(room, (j,))
    if first is None:
        return (j,)
    small = items.smallest(3, j)
    if first == room or len(small) < 2 or small[0] + small[1] > room:
        return (j, first)
    if len(small) == 3 and sum(small) <= room:
        return None
    best = 0
    for x in reversed(items.lengths):
        if x <= room and items.count[x] > (x == j):
            y = items.largest(min(x, room - x), (j, x))
            best = max(best, x + y if y is not None else 0)
    if first >= best:
        return (j, first)
    second = items.largest(room - first, (j, first))
    if second is None:
        return None
    above = [x for x in items.lengths if x > second and x <= room and items.count[x] > (x == j)]
    pairs = (above[0] * 2 if items.count[above[0]] > 1 + (above[0] == j) else sum(above[:2])) if len(above) > 1 else room + 1
    return (j, first, second) if pairs > room else None


def reduce_items(counts: dict[int, int], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """Fixed runs of bins and the counts that are left."""
    items, fixed, skipped = _Items(counts), [], set()
    at = len(items.lengths) - 1
    while at >= 0:
        j = items.lengths[at]
        pattern = _dominating(items, j, capacity) if j not in skipped else None
        if pattern is None:
            skipped.add(j)
            at -= 1
            continue
        # As bins are fixed the smallest items only grow and no larger item appears, so the choice holds while it lasts.
        bins = items.times(pattern)
        fixed.append((pattern, bins))
        for x in set(pattern):
            items.take(x, bins * pattern.count(x))
        at = min(at, len(items.lengths) - 1)
    return fixed, items.count


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best fit of falling lengths, all bins of one kind at a time."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = {}
    residuals: list[int] = []

    def put(pattern: tuple[int, ...], room: int, bins: int) -> None:
        if room not in open_bins:
            open_bins[room] = {}
            bisect.insort(residuals, room)
        open_bins[room][pattern] = open_bins[room].get(pattern, 0) + bins

    def fill(pattern: tuple[int, ...], room: int, bins: int | None, length: int, n: int) -> int:
        """Fill bins with as many items as go in each; what is left of the items."""
        each = room // length
        full = n // each if bins is None else min(bins, n // each)
        if full:
            put((*pattern, *[length] * each), room - each * length, full)
        n -= full * each
        rest = 0 if bins is None else bins - full
        if n and (bins is None or rest) and n < each:
            put((*pattern, *[length] * n), room - n * length, 1)
            n, rest = 0, rest - 1
        if bins is not None and rest > 0:
            put(pattern, room, rest)
        return n

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(residuals, length)
            if at == len(residuals):
                n = fill((), capacity, None, length, n)
                continue
            room = residuals[at]
            pattern, bins = open_bins[room].popitem()
            if not open_bins[room]:
                del open_bins[room]
                residuals.pop(at)
            n = fill(pattern, room, bins, length, n)
    return [run for kinds in open_bins.values() for run in kinds.items()]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs of equal bins that hold all items."""
    fixed, left = reduce_items(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(runs: list[Run]) -> np.ndarray:
    """For each length and run: length, first rank, items a bin, first sequence, first offset; by length and rank."""
    rows, taken, sequence = [], {}, 0
    for pattern, bins in runs:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            rows.append((length, taken.get(length, 0), each, sequence, offset))
            taken[length] = taken.get(length, 0) + bins * each
            offset += each * length
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


#: Letters and numbers below U+0250; texts of such characters need no Unicode properties, which halves the splitting.
LATIN_RANGES = {"L": "A-Za-zªµºÀ-ÖØ-öø-ɏ", "N": "0-9²³¹¼½¾"}
LATIN = re.compile("[\x00-\x1b\x20-ɏ]*").fullmatch


def latin_pattern(pattern: str) -> re.Pattern:
    r"""The pattern with the properties \p{L} and \p{N} written as ranges, in and outside of classes."""
    parts = re.split(r"(\[[^\]]*\])", pattern)
    for k, part in enumerate(parts):
        parts[k] = re.sub(r"\\p\{([LN])\}", lambda m: LATIN_RANGES[m[1]] if k % 2 else f"[{LATIN_RANGES[m[1]]}]", part)
    return re.compile("".join(parts))


class _Merged(dict):
    """Ids of pre-tokens as bytes, merged when first asked for."""

    def __init__(self, merge, added: dict[str, bytes]):
        super().__init__(added)
        self.merge = merge

    def __missing__(self, word: str) -> bytes:
        spelled = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        self[word] = out = array("I", [t.id for t in self.merge(spelled)]).tobytes()
        return out


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, as the tokenizer's plain call gives them without special tokens around.

    Texts of added tokens, such as ``<|endoftext|>``, are cut out first and have their own ids. Distinct pre-tokens go to
    the tokenizer's merges; a bounded cache keeps them.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        # One pre-token at a time needs no splitting, only the tokenizer's merges.
        tokenizer = Tokenizer.from_file(path)
        self.merge = tokenizer.model.tokenize
        self.any_words = regex.compile(pattern).findall
        self.latin_words = latin_pattern(pattern).findall
        self.added = {t.content: array("I", [i]).tobytes() for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split if self.added else None
        self.held = _Merged(self.merge, self.added)

    def split(self, text: str) -> list[str]:
        for token in self.added:
            if token in text:
                return [w for piece in self.cut(text) for w in ([piece] if piece in self.added else self.words(piece))]
        return self.words(text)

    def words(self, text: str) -> list[str]:
        return self.latin_words(text) if LATIN(text) else self.any_words(text)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.held) > CACHED_WORDS:
            self.held = _Merged(self.merge, self.added)
        get = self.held.__getitem__
        return [b"".join(map(get, self.split(t))) for t in texts]


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: the shorter one first."""
    first = total % capacity or capacity
    return [(0, min(first, total))] + [(at, capacity) for at in range(first, total, capacity)]


def pieces(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents as pieces of at most ``capacity`` ids."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                ids, texts = (c.slice(at, 200).to_pylist() for c in (batch.column("doc_id"), batch.column("text")))
                out = []
                for doc_id, raw in zip(ids, encode([t or "" for t in texts]), strict=True):
                    raw += end
                    for k, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                        out.append((doc_id, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
                columns = list(zip(*out, strict=True))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
                )

    return documents(docs, "doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of every piece; reads ``length``, ``doc_id`` and ``piece``."""
    spark = cut_pieces.sparkSession
    path = scratch_path(spark, "pieces")
    cut_pieces.write.parquet(path)
    stored = spark.read.parquet(path)
    total = stored.count()
    stored = stored.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(1 + total // BUCKET_ROWS)))
    counted = stored.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(plan(counts, capacity))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = stored.withColumn("rank", F.row_number().over(own) - 1).join(counted, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("bucket", "before")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 44 | rank, "right") - 1
            bin_, slot = np.divmod(rank - table[at, 1], table[at, 2])
            out = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            out["sequence_id"] = pa.array(table[at, 3] + bin_)
            out["offset"] = pa.array(table[at, 4] + slot * length)
            yield pa.RecordBatch.from_pydict(out)

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, PACKED_SCHEMA)


def pack_documents(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, tokenizer, pattern, capacity), capacity)
