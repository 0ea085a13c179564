"""Language-model scores from a log-frequency Bloom filter.

Counts of n-grams are quantised to levels and the filter holds (n-gram, 1) ... (n-gram, level), so that a lookup probes
level after level until one is missing. The filter is cut into segments, as many as the training tokens need, with as many
bits as the entries of each need. N-grams with more than 1/COMMON_NGRAMS of all tokens keep their count beside the filter.

A filter grows with the corpus, so it goes nowhere: questions come to it. Texts are read once and kept as chunks of numbered
tokens. A chunk deals its distinct n-grams with their training counts to the segments, in one shuffle; where they arrive a
segment is counted, filled and asked, and the chunk gets one level for each of its n-grams back, in the order in which it
sent them. No n-gram travels twice, nothing on the driver or on a worker grows with the input, and any size goes the same
way. Counts of tokens go and come like that too; they are exact.

The model: every token has its smoothed unigram probability, which is exact, and the bigrams of all tokens pull it towards
what the filter remembers of the left neighbour: p(w | v) = (c(v, w) + m * p(w)) / (c(v) + m). So the score is the unigram
sum plus one gain a token, log10(1 + c(v, w) / (m * p(w))) + log10(m) - log10(c(v) + m).

Tokens are words between \\x20 and \\x09-\\x0D with A-Z lower-cased, then one end. Tokens and texts are compared by 64-bit
hashes. Cases: a null text is an empty one (just its end); no training rows: all counts are 0 and N = 0, where the base
formula is log10(1) and the gain 0; repeated rows are scored one by one; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.textops import LOWER, SPACE, PrefixHash, Slice, documents, mix, per_row, slices, words
from slotwise.session import bounded_batches, scratch_path

#: Tokens of a segment of their counts, each as often as chunks have it.
COMMON_TOKENS = 1 << 17
#: N-grams with a larger share of all tokens have their exact level.
COMMON_NGRAMS = 1 << 17
#: Largest filter of ``build_filter`` in bits (128 MB); room for an entry; probes of an entry; training tokens of a segment.
FILTER_BITS = 1 << 30
BITS_PER_ENTRY = 12
PROBES = 4
SEGMENT_TOKENS = 1 << 17
#: Segments of a file: what the driver fetches at a time is a few files of some hundred kilobytes.
SEGMENTS_A_FILE = 4
#: A chunk ends with the slice that brings it to so many tokens; chunks of a file.
CHUNK_TOKENS = 1 << 21
CHUNKS_A_FILE = 4
#: Neighbouring segments, of n-grams or of tokens, that are dealt together, at most; they are dealt one by one up to so many.
PART_SEGMENTS = 16
SINGLE_SEGMENTS = 256
#: Weight of the unigram probability, in observations of the left neighbour.
PRIOR = 2000.0

END = np.uint64(0x5851F42D4C957F2D)
BEGIN = np.uint64(0x9FB21C651E98DF25)

# Counts up to LEVELS[i] share level i + 1: every step is at least 1 and about 30 %.
LEVELS = [1]
while LEVELS[-1] < 10**15:
    LEVELS.append(max(LEVELS[-1] + 1, int(LEVELS[-1] * 1.3)))
LEVELS = np.array(LEVELS, np.int64)
#: The count that a level stands for; level 0 is a missing n-gram.
MEANS = np.concatenate([[0.0], (LEVELS[:-1] + LEVELS[1:] - 1) / 2, [float(LEVELS[-1])]])

SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, counts, "right")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def tokens(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a slice, ends included, and their rows."""
    data = LOWER[part.data]
    starts, ends = words(Slice(part.batch, data, part.bounds), SPACE ^ True)
    rows = part.rows(starts)
    last = np.searchsorted(rows, np.arange(len(part)), "right")
    return np.insert(PrefixHash(data)(starts, ends), last, END), np.insert(rows, last, np.arange(len(part)))


def _counted(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in held])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([n for _, n in held])[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begin], np.add.reduceat(counts, begin)


def _bigrams(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hash of every token with its left neighbour."""
    left = np.full(len(keys), BEGIN)
    same = rows[1:] == rows[:-1]
    left[1:][same] = keys[:-1][same]
    return mix(left * np.uint64(0xC6A4A7935BD1E995) + keys)


def _segment(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(segments)).astype(np.int64)


def _bits(hashes: np.ndarray, level: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(PROBES):
        yield (mix(hashes + (level * PROBES + k + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % size).astype(np.int64)


class LogBloom:
    """The filter on a worker: segment i has the bits from starts[i] to starts[i + 1]."""

    def __init__(self, filled: np.ndarray, starts: np.ndarray):
        self.filled, self.starts, self.sizes = filled, starts, np.diff(starts).astype(np.uint64)

    def level(self, ngrams: np.ndarray) -> np.ndarray:
        """Level of each n-gram by probing upwards."""
        hashes = mix(ngrams)
        segment = _segment(hashes, len(self.sizes))
        base, size = self.starts[segment], self.sizes[segment]
        level, active = np.zeros(len(ngrams), np.int64), np.flatnonzero(size)
        while len(active):
            there = np.ones(len(active), bool)
            for bit in _bits(hashes[active], level[active] + 1, size[active]):
                at = base[active] + bit
                there &= (self.filled[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) > 0
            active = active[there]
            level[active] += 1
        return level


def _filled(keys: np.ndarray, n: np.ndarray, per_entry: float) -> bytes:
    """The bits of one segment with all levels of its n-grams."""
    hashes, most = mix(keys), level_of(n)
    size = max(64, -(-int(most.sum() * per_entry) // 64) * 64)
    filled = np.zeros(size, bool)
    for one in range(1, int(most.max()) + 1):
        some = hashes[most >= one]
        for bit in _bits(some, np.full(len(some), one), np.uint64(size)):
            filled[bit] = True
    return np.packbits(filled, bitorder="little").tobytes()


def fill_segments(dealt: DataFrame, least: int, per_entry: float = BITS_PER_ENTRY) -> DataFrame:
    """Bits of every segment and its n-grams of at least ``least`` occurrences.

    A row of ``dealt`` (segment, keys, counts) holds partial counts as 64-bit numbers.
    """

    def fill(own: pa.Table) -> pa.Table:
        held = [np.frombuffer(b"".join(own.column(c).to_pylist()), kind) for c, kind in (("keys", np.uint64), ("counts", np.int64))]
        keys, n = _counted([tuple(held)])
        often = n >= least
        values = [[own.column("segment")[0].as_py()], [_filled(keys, n, per_entry)], [keys[often].view(np.int64)], [n[often]]]
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.table([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["segment", "bits", "often", "often_n"])

    return dealt.groupBy("segment").applyInArrow(fill, "segment long, bits binary, often array<long>, often_n array<long>")


def _by_segment(keys: np.ndarray, n: np.ndarray, segments: int) -> Iterator[pa.RecordBatch]:
    segment = _segment(mix(keys), segments)
    order = np.argsort(segment, kind="stable")
    segment, keys, n = segment[order], keys[order], n[order].astype(np.int64)
    firsts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if len(segment) else np.zeros(0, np.int64)
    ends = np.append(firsts[1:], len(segment))
    for at in range(0, len(firsts), 512):
        spans = list(zip(firsts[at : at + 512], ends[at : at + 512], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(segment[firsts[at : at + 512]]), *[pa.array([v[a:b].tobytes() for a, b in spans], pa.binary()) for v in (keys, n)]],
            ["segment", "keys", "counts"],
        )


def load_filter(filled: DataFrame, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits and starts of a filter on the driver, a partition of the table after the other."""
    sizes = np.zeros(segments, np.int64)
    for row in filled.select("segment", F.octet_length("bits").alias("n")).collect():
        sizes[row.segment] = row.n
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], np.uint8)
    for row in filled.select("segment", "bits").toLocalIterator():
        out[starts[row.segment] : starts[row.segment + 1]] = np.frombuffer(row.bits, np.uint8)
    return out, starts * 8


def build_filter(ngrams: DataFrame, most_bits: int = FILTER_BITS) -> LogBloom:
    """A filter of all rows of ``ngrams`` (key, n), filled in Spark; at most about ``most_bits`` come to the driver.

    Every key goes in. Where there are more entries than the bits have room for, each gets less room, and more other keys
    pass by mistake: 0.3 % at 12 bits an entry, 2 % at 8, 15 % at 4, 56 % at 2.
    """
    size = ngrams.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum(F.least(F.col("n"), F.ceil(F.log2("n") * 3) + 2)), F.lit(0)).alias("entries")).first()
    segments = max(1, -(-size["keys"] // SEGMENT_TOKENS))
    per_entry = min(float(BITS_PER_ENTRY), most_bits / max(size.entries, 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _by_segment(batch.column("key").to_numpy().view(np.uint64), batch.column("n").cast(pa.int64()).to_numpy(), segments)

    path = scratch_path(ngrams.sparkSession, "filter")
    filled = fill_segments(ngrams.select("key", "n").mapInArrow(run, "segment long, keys binary, counts binary"), 2**62, per_entry)
    filled.write.option("maxRecordsPerFile", SEGMENTS_A_FILE).parquet(path)
    return LogBloom(*load_filter(ngrams.sparkSession.read.parquet(path), segments))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as bytes of equal weight side by side, as many as the largest needs, compressed."""
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8", copy=False)).view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


CHUNK = "doc_id array<long>, held_out array<boolean>, n_tokens array<long>, keys binary, counts binary, places binary, train_texts long, train_tokens long, n_keys long"


def _chunk(held: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Texts as places in the list of their distinct tokens, frequent ones first, which have their training counts."""
    doc_id, out = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
    n_tokens, tokens_ = (np.concatenate([h[i] for h in held]) for i in (2, 3))
    held.clear()
    keys, places, counts = np.unique(tokens_, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    places = rank[places]
    training = ~out.to_numpy(zero_copy_only=False)
    train = np.bincount(places[np.repeat(training, n_tokens)], minlength=len(keys))
    values = [[doc_id.cast(pa.int64())], [out], [pa.array(n_tokens)], [keys[order].tobytes()], [pack(train)], [pack(places)], [training.sum()], [train.sum()], [len(keys)]]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v[0])], pa.int32()), v[0]) for v in values[:3]]
    rest = [pa.array(v, pa.binary()) for v in values[3:6]] + [pa.array([int(v[0])], pa.int64()) for v in values[6:]]
    return pa.RecordBatch.from_arrays([*lists, *rest], [c.split()[0] for c in CHUNK.split(", ")])


def chunks(docs: DataFrame) -> DataFrame:
    """The documents (doc_id, held_out, text) as numbered chunks of tokens, written once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch):
                keys, rows = tokens(part)
                held.append((part.column("doc_id"), part.column("held_out"), per_row(rows, len(part)), keys))
                size += len(keys)
                if size >= CHUNK_TOKENS:
                    yield _chunk(held)
                    held, size = [], 0
        if held:
            yield _chunk(held)

    path = scratch_path(docs.sparkSession, "chunks")
    made = docs.mapInArrow(run, CHUNK).withColumn("chunk", F.monotonically_increasing_id())
    made.write.option("maxRecordsPerFile", CHUNKS_A_FILE).parquet(path)
    return docs.sparkSession.read.parquet(path)


def _of(rows: pa.Table | pa.RecordBatch, name: str, i: int = 0) -> np.ndarray:
    """A list of a chunk."""
    value = rows.column(name)[i]
    if name == "keys":
        return np.frombuffer(value.as_py(), np.uint64)
    return unpack(value.as_py()).astype(np.int64) if name in ("counts", "places") else value.values.to_numpy(zero_copy_only=False)


def _pairs(rows: pa.Table | pa.RecordBatch, i: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bigrams of a chunk, ascending, and the place of each token's bigram there."""
    n_tokens = _of(rows, "n_tokens", i)
    own = _bigrams(_of(rows, "keys", i)[_of(rows, "places", i)], np.repeat(np.arange(len(n_tokens)), n_tokens))
    return np.unique(own, return_inverse=True)


def _dealt(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which a chunk deals its distinct keys, by part and key, and the part of each in that order."""
    part = _segment(mix(keys), segments) // _together(segments)
    order = np.argsort(keys, kind="stable")
    order = order[np.argsort(part[order].astype(np.uint16 if segments < 1 << 16 else np.int64), kind="stable")]
    return order, part[order]


def _together(segments: int) -> int:
    return min(PART_SEGMENTS, -(-segments // SINGLE_SEGMENTS))


def deal(chunked: DataFrame, counted: Callable, segments: int) -> DataFrame:
    """Distinct keys of every chunk and their training counts, as ``counted(rows, i)`` finds them, by parts of some segments."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, n = counted(batch, i)
                order, part = _dealt(keys, segments)
                keys, n = keys[order], n[order]
                firsts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                steps = np.diff(keys, prepend=np.uint64(0))
                steps[firsts] = keys[firsts]
                spans = list(zip(firsts, np.append(firsts[1:], len(part)), strict=True))
                for at in range(0, len(spans), 512):
                    own = spans[at : at + 512]
                    columns = [pa.array([pack(v[a:b]) for a, b in own], pa.binary()) for v in (steps, n)]
                    chunk = pa.array(np.full(len(own), batch.column("chunk")[i].as_py()))
                    yield pa.RecordBatch.from_arrays([chunk, pa.array(part[firsts[at : at + 512]]), *columns], ["chunk", "part", "steps", "counts"])

    return chunked.mapInArrow(run, "chunk long, part long, steps binary, counts binary")


def answers(dealt: DataFrame, answer: Callable) -> DataFrame:
    """What ``answer(keys, counts)`` says of the distinct keys of a part, given back to each chunk in the order of its own.

    ``found`` counts the keys of a part that the training rows have.
    """

    def run(own: pa.Table) -> pa.Table:
        steps = [unpack(x) for x in own.column("steps").to_pylist()]
        ends = np.cumsum([len(x) for x in steps])
        keys, places = np.unique(np.concatenate([np.cumsum(x, dtype=np.uint64) for x in steps]), return_inverse=True)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, places, np.concatenate([unpack(x) for x in own.column("counts").to_pylist()]).astype(np.int64))
        said = [pack(x) for x in np.split(answer(keys, n)[places], ends[:-1])]
        found = np.zeros(len(steps), np.int64)
        found[0] = np.count_nonzero(n)
        return pa.table([own.column("chunk"), own.column("part"), pa.array(said, pa.binary()), pa.array(found)], ["chunk", "part", "said", "found"])

    return dealt.groupBy("part").applyInArrow(run, "chunk long, part long, said binary, found long")


def filter_levels(keys: np.ndarray, n: np.ndarray, segments: int, least: int) -> np.ndarray:
    """Levels of n-grams from the filled segments that they lie in; from ``least`` occurrences on, exact ones."""
    segment = _segment(mix(keys), segments)
    out = np.zeros(len(keys), np.int64)
    for one in np.unique(segment):
        own = np.flatnonzero(segment == one)
        filled = np.frombuffer(_filled(keys[own], n[own], BITS_PER_ENTRY), np.uint8)
        out[own] = LogBloom(filled, np.array([0, 8 * len(filled)])).level(keys[own])
    return np.where(n >= least, level_of(n), out)


def score(docs: DataFrame) -> DataFrame:
    """Train on the rows outside the held-out fifth and score every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    chunked = chunks(documents(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id"))))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("train_texts", "train_tokens", "n_keys")]
    texts, total, n_keys = chunked.agg(*sums).first()

    token_segments = max(1, -(-n_keys // COMMON_TOKENS))
    path = scratch_path(spark, "unigrams")
    dealt = deal(chunked.select("chunk", "keys", "counts"), lambda rows, i: (_of(rows, "keys", i), _of(rows, "counts", i)), token_segments)
    answers(dealt, lambda keys, n: n).write.parquet(path)
    unigrams = spark.read.parquet(path)
    distinct = unigrams.agg(F.coalesce(F.sum("found"), F.lit(0))).first()[0]

    segments = max(1, -(-total // SEGMENT_TOKENS))
    least = max(2, -(-total // COMMON_NGRAMS))

    def bigrams(rows: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        keys, places = _pairs(rows, i)
        training = np.repeat(~_of(rows, "held_out", i), _of(rows, "n_tokens", i))
        return keys, np.bincount(places[training], minlength=len(keys))

    dealt = deal(chunked.select("chunk", "held_out", "n_tokens", "keys", "places"), bigrams, segments)
    levels = answers(dealt, lambda keys, n: filter_levels(keys, n, segments, least))

    def work(own: pa.Table, said: pa.Table) -> pa.Table:
        def given(kind: int, order: np.ndarray) -> np.ndarray:
            some = said.filter(pc.equal(said.column("kind"), kind)).sort_by("part").column("said").to_pylist()
            out = np.empty(len(order), np.int64)
            out[order] = np.concatenate([unpack(x) for x in some])
            return out

        keys, places, n_tokens = (_of(own, c) for c in ("keys", "places", "n_tokens"))
        rows = np.repeat(np.arange(len(n_tokens)), n_tokens)
        n = given(0, _dealt(keys, token_segments)[0])
        log_p = np.log10((n + 0.5) / (total + 0.5 * (distinct + 1)))
        context = np.where(keys == END, 0.0, np.log10(n + PRIOR))
        base = np.bincount(rows, log_p[places], len(n_tokens))
        gain = n_tokens * np.log10(PRIOR) - np.bincount(rows, context[places], len(n_tokens)) - np.log10(texts + PRIOR)
        known = per_row(rows[n[places] > 0], len(n_tokens))
        pairs, which = _pairs(own)
        means = MEANS[given(1, _dealt(pairs, segments)[0])][which]
        gain += np.bincount(rows, np.log10(1 + means / (PRIOR * 10.0 ** log_p)[places]), len(n_tokens))
        columns = [own.column("doc_id")[0].values, own.column("held_out")[0].values, n_tokens, known, np.full(len(n_tokens), total), base, base + gain]
        return pa.table([pa.array(c) for c in columns], [c.split()[0] for c in SCHEMA.split(", ")])

    said = unigrams.select("chunk", F.lit(0).alias("kind"), "part", "said").unionByName(levels.select("chunk", F.lit(1).alias("kind"), "part", "said"))
    asked = chunked.select("chunk", "doc_id", "held_out", "n_tokens", "keys", "places")
    return asked.groupBy("chunk").cogroup(said.groupBy("chunk")).applyInArrow(work, SCHEMA)
