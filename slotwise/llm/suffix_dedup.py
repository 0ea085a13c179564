"""Removal of long repeated passages with longest-previous-factor arrays.

Texts are UTF-8 bytes. A window of ``MIN_BYTES`` is repeated if it starts at another place too, of the same text or of any
other; a byte goes if a repeated window covers it. ``keep="first"`` spares the earliest place of every window (by doc_id
and offset) and removes later copies only; ``keep="none"`` removes all of them.

1. Every window has an anchor: its smallest 50-byte hash. Windows in a row with the same anchor are a run, so equal windows
   lie in runs with equal anchor hashes. Runs whose anchor occurs once are done: nothing there repeats.
2. Runs with equal bytes (128 bits of hash) are copies; all but one collapse, counted before the shuffle.
3. What is left, runs that share an anchor but differ, meets in buckets of at most about a thousand runs. Each task builds
   a suffix array of its buckets by prefix doubling, down to the window length. In suffix order, previous and next smaller
   text positions inside a stretch of common prefixes of window length tell whether the longest previous factor reaches it.
   Runs of an anchor with more than a bucket are split where the smallest 50-byte strings under four other orders change;
   they refine the key, which windows with an edit rarely share. Where a key still has more than a bucket, it is
   dealt over several; one of each equal windows of a bucket is then also matched by its hashes with those of the others.

Cases: null and short texts lose nothing; rows with one doc_id and one text are one document for ``keep="first"`` and
two for ``keep="none"``; rows with one doc_id and different texts are told apart by a hash of the text; an empty table
gives an empty result; extra columns pass through ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.frames import known_id, stored, text_tag, touching
from slotwise.llm.textops import PrefixHash, Slice, documents, map_slices, mix, slices
from slotwise.session import bounded_batches

MIN_BYTES = 200
GRAM = 50
STARTS = MIN_BYTES - GRAM + 1
BUCKET = 1024
#: Orders of 50-byte strings whose smallest ones refine an anchor with more runs than a bucket.
FINER = 4
CHUNK_BYTES = 1 << 18
PLACE_BITS = np.uint64(31)

RUN = "doc_id long, tag int, a long, n int"


def anchored_runs(part: Slice) -> tuple[np.ndarray, ...]:
    """Rows, first windows, numbers of windows, anchor hashes and content hashes of all runs."""
    data, bounds = part.data, part.bounds
    if len(data) < MIN_BYTES:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefix = PrefixHash(data)
    grams = mix((prefix.sums[GRAM:] - prefix.sums[:-GRAM]) * prefix.back[: len(data) - GRAM + 1])
    least = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < STARTS:
        step = min(width, STARTS - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & np.uint64((1 << 31) - 1)).astype(np.int64)
    row = part.rows(np.arange(len(place)))
    whole = np.arange(len(place)) + MIN_BYTES <= bounds[row + 1]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    count = np.bincount(np.cumsum(new) - 1, weights=whole).astype(np.int64)
    first = np.flatnonzero(new)[count > 0]
    count = count[count > 0]
    return row[first], first, count, grams[place[first]], PrefixHash(data, 1)(first, first + count - 1 + MIN_BYTES)


def _runs(docs: DataFrame) -> DataFrame:
    def work(part: Slice) -> pa.RecordBatch:
        row, first, count, anchor, content = anchored_runs(part)
        at = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(at), part.column("tag").take(at), pa.array(first - part.bounds[row]), pa.array(count, pa.int32()), pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))],
            ["doc_id", "tag", "a", "n", "anchor", "content"],
        )

    return map_slices(documents(docs, "doc_id", "text", "tag"), work, f"{RUN}, anchor long, content long")


def suffix_classes(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, depth: int = MIN_BYTES) -> np.ndarray:
    """Rank, in suffix order, of the ``depth`` bytes at each start; equal bytes have equal ranks. ``ends``: where the text of each byte ends."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    rank = np.zeros(len(data), np.uint64)
    for k in range(8):
        rank = (rank << np.uint64(8)) | padded[k : k + len(data)]
    places = np.flatnonzero(np.arange(len(data)) + 8 <= ends)
    held = np.zeros(len(data), np.int64)
    held[places] = np.unique(rank[places], return_inverse=True)[1]
    length = 8
    while length < depth:
        step = min(length, depth - length)
        final = length + step == depth
        places = starts if final else np.flatnonzero(np.arange(len(data)) + length + step <= ends)
        pairs = held[places] * (len(data) + 1) + held[places + step]
        found = np.unique(pairs, return_inverse=True)[1]
        if final:
            return found
        held = np.zeros(len(data), np.int64)
        held[places] = found
        length += step
    return held[starts]


def smaller_positions(rank: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a smaller, and whether a larger, position shares the rank: previous and next smaller values in suffix order."""
    order = np.argsort(rank, kind="stable")
    own, place = rank[order], np.argsort(np.argsort(position))[order]
    begin = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1]) if len(own) else np.zeros(0, np.int64)
    stretch = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(own))))
    smaller, larger = np.zeros(len(own), bool), np.zeros(len(own), bool)
    span = len(own) + 1
    # Stretches are shifted apart, so that one running extreme serves all of them.
    for out, value in ((smaller, place), (larger, len(own) - place)):
        low = value - stretch * span
        before = np.minimum.accumulate(low)
        out[1:] |= (before[:-1] < low[1:]) & (stretch[1:] == stretch[:-1])
        back = (value + stretch * span)[::-1]
        after = np.minimum.accumulate(back)[::-1]
        out[:-1] |= (after[1:] < (value + stretch * span)[:-1]) & (stretch[1:] == stretch[:-1])
    previous, following = np.zeros(len(own), bool), np.zeros(len(own), bool)
    previous[order], following[order] = smaller, larger
    return previous, following


def _search(table: pa.Table, keep: str) -> pa.RecordBatch:
    """Repeated windows of the runs of whole buckets; for dealt ones also the first of each equal windows, with its hashes.

    ``open``: nothing in the bucket settles that window.
    """
    data = np.frombuffer(b"".join(table.column("context").to_pylist()), np.uint8)
    column = {c: table.column(c).to_numpy() for c in ("doc_id", "tag", "a", "n", "copies", "buckets")}
    count = column["n"].astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(count + MIN_BYTES - 1)])
    run = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    starts = bounds[run] + offset
    ends = np.repeat(bounds[1:], np.diff(bounds))
    order = np.lexsort((column["a"], column["tag"], column["doc_id"]))
    text = np.empty(len(order), np.int64)
    text[order] = np.cumsum(np.concatenate([[False], (column["doc_id"][order][1:] != column["doc_id"][order][:-1]) | (column["tag"][order][1:] != column["tag"][order][:-1])]))
    position = (text[run] << 32) + column["a"][run] + offset
    earlier, later = smaller_positions(suffix_classes(data, ends, starts), position)
    dealt = (column["buckets"] > 1)[run]
    settled = (column["copies"][run] > 1) & (keep == "none")
    found = (earlier | later & (keep == "none")) & ~settled
    begins = found & ~np.concatenate([[False], found[:-1] & (run[1:] == run[:-1])])
    which = np.cumsum(begins) - 1
    first = np.flatnonzero(begins)
    length = np.bincount(which[found], minlength=len(first)).astype(np.int64)
    some = np.flatnonzero(dealt & ~earlier)
    still_open = np.concatenate([np.zeros(len(first), bool), (keep == "first") | ~(later | settled)[some]])
    at, size = np.concatenate([first, some]), np.concatenate([length, np.ones(len(some), np.int64)])
    hashes = [PrefixHash(data, k)(starts[some], starts[some] + MIN_BYTES).view(np.int64) for k in (0, 1)]
    hashes = [pa.concat_arrays([pa.nulls(len(first), pa.int64()), pa.array(h)]) for h in hashes]
    return pa.RecordBatch.from_arrays(
        [pa.array(column["doc_id"][run[at]]), pa.array(column["tag"][run[at]]), pa.array(column["a"][run[at]] + offset[at]), pa.array(size, pa.int32()), pa.array(still_open), *hashes],
        ["doc_id", "tag", "a", "n", "open", "h1", "h2"],
    )


def finer_keys(data: np.ndarray) -> np.ndarray:
    """For each window of a buffer, the smallest of its 50-byte strings under each of ``FINER`` other orders, as one hash."""
    prefix = PrefixHash(data, 1)
    grams = (prefix.sums[GRAM:] - prefix.sums[:-GRAM]) * prefix.back[: len(data) - GRAM + 1]
    out = np.zeros(len(grams) - STARTS + 1, np.uint64)
    for k in range(FINER):
        least = mix(grams + np.uint64(k))
        width = 1
        while width < STARTS:
            step = min(width, STARTS - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        out = mix(out ^ least)
    return out


def _contexts(docs: DataFrame, mixed: DataFrame, split: bool) -> DataFrame:
    """The runs with their bytes; ``split``: cut where the finer key changes, which then is part of the anchor."""
    packed = mixed.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("anchor", "bucket", "buckets", "copies", "a", "n")).alias("runs"))
    wanted, _ = touching(mixed)
    source = docs.mapInArrow(wanted, "doc_id long, text string, tag int").join(packed, ["doc_id", "tag"])
    names = ["anchor", "bucket", "buckets", "copies", "a", "n"]

    def contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                lists = part.column("runs")
                own = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy())
                flat = lists.flatten()
                fields = {c: flat.field(c).to_numpy() for c in names}
                if split:
                    count = fields["n"].astype(np.int64)
                    run = np.repeat(np.arange(len(own)), count)
                    offset = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
                    key = finer_keys(part.data)[part.bounds[own[run]] + fields["a"][run] + offset]
                    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (run[1:] != run[:-1])]))
                    own, fields = own[run[first]], {c: v[run[first]] for c, v in fields.items()}
                    fields["anchor"] = mix(fields["anchor"].view(np.uint64) ^ mix(key[first])).view(np.int64)
                    fields["a"] = fields["a"] + offset[first]
                    fields["n"] = np.diff(np.append(first, len(run))).astype(np.int32)
                first = part.bounds[own] + fields["a"]
                last = first + fields["n"] + MIN_BYTES - 1
                view = part.data.tobytes()
                context = [view[x:y] for x, y in zip(first.tolist(), last.tolist(), strict=True)]
                at = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("tag").take(at), *map(pa.array, fields.values()), pa.array(context, pa.binary())],
                    ["doc_id", "tag", *names, "context"],
                )

    kind = "doc_id long, tag int, anchor long, bucket int, buckets int, copies long, a long, n int, context binary"
    return source.select("doc_id", "tag", "runs", "text").mapInArrow(contexts, kind).dropDuplicates(["doc_id", "tag", "a"])


def repeated_windows(docs: DataFrame, keep: str = "first") -> DataFrame:
    """Runs of windows to remove: doc_id (``NULL_ID`` for null), tag (hash of the text), a (first start), n (starts)."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(known_id("doc_id").alias("doc_id"), F.col("text"), text_tag().alias("tag"))
    runs = _runs(docs)
    anchors = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), (F.min("content") < F.max("content")).alias("mixed"))
    runs = stored(runs.join(anchors.where("m > 1").select("anchor", "mixed"), "anchor"), "runs")

    place = F.struct("doc_id", "tag", "a", "n")
    contents = runs.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("rep"), F.first("mixed").alias("mixed"))
    contents = stored(contents.where("mixed or copies > 1"), "contents")
    copied = runs.join(contents.where("copies > 1").select("anchor", "content", "rep"), ["anchor", "content"])
    if keep == "first":
        copied = copied.where((F.col("doc_id") != F.col("rep.doc_id")) | (F.col("tag") != F.col("rep.tag")) | (F.col("a") != F.col("rep.a")))
    copied = copied.select("doc_id", "tag", "a", "n")

    mixed = contents.where("mixed").select("anchor", "content", "copies", "rep.*")
    sizes = mixed.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / BUCKET).cast("int").alias("buckets"))
    mixed = mixed.join(sizes, "anchor").withColumn("bucket", F.pmod(F.hash("content"), "buckets"))
    plain = _contexts(docs, mixed.where("buckets = 1"), False)
    pieces = stored(_contexts(docs, mixed.where("buckets > 1"), True), "pieces")
    crowds = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    crowds = crowds.select("anchor", F.ceil(F.col("m") / BUCKET).cast("int").alias("buckets"))
    pieces = pieces.drop("bucket", "buckets").join(crowds, "anchor").withColumn("bucket", F.pmod(F.hash("doc_id", "tag", "a"), "buckets"))
    source = plain.unionByName(pieces)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                held.append(batch.slice(at, 2000))
                if sum(b.num_rows for b in held) * (MIN_BYTES + STARTS // 2) < CHUNK_BYTES:
                    continue
                table = pa.Table.from_batches(held)
                differs = np.zeros(table.num_rows, bool)
                for c in ("anchor", "bucket"):
                    values = table.column(c).to_numpy()
                    differs |= values != values[-1]
                last = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
                if last:
                    yield _search(table.slice(0, last), keep)
                    held = table.slice(last).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield _search(pa.Table.from_batches(held), keep)

    dealt = source.repartition("anchor", "bucket").sortWithinPartitions("anchor", "bucket")
    found = stored(dealt.mapInArrow(search, f"{RUN}, open boolean, h1 long, h2 long"), "windows")
    local = found.where("h1 is null").select("doc_id", "tag", "a", "n")
    open_ = found.where("h1 is not null")
    spread = F.min(F.struct("doc_id", "tag", "a")).alias("rep")
    classes = open_.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("m"), spread).where("m > 1").select("h1", "h2", "rep")
    spread_out = open_.where("open").join(classes, ["h1", "h2"])
    if keep == "first":
        spread_out = spread_out.where((F.col("doc_id") != F.col("rep.doc_id")) | (F.col("tag") != F.col("rep.tag")) | (F.col("a") != F.col("rep.a")))
    return copied.unionByName(local).unionByName(spread_out.select("doc_id", "tag", "a", "n"))


def covered(size: int, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which bytes of a text the windows cover."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + counts + MIN_BYTES - 1, -1)
    return np.cumsum(change[:size]) > 0


def _with_windows(docs: DataFrame, keep: str, finish: Callable[[pa.RecordBatch, Slice, Callable[[int], np.ndarray]], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``finish`` to every document with a function that gives the covered bytes of a row."""
    windows = stored(repeated_windows(docs, keep), "repeats")
    yes, no = touching(windows)
    listed = windows.distinct().groupBy(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"))
    listed = listed.agg(F.collect_list("a").alias("__starts"), F.collect_list("n").alias("__counts"))
    same = (known_id("doc_id") == F.col("__id")) & (text_tag() == F.col("__tag"))
    hit = docs.mapInArrow(yes, docs.schema).join(listed, same, "left").drop("__id", "__tag")
    nothing = {"__starts": F.lit(None).cast("array<bigint>"), "__counts": F.lit(None).cast("array<int>")}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                starts, counts, sizes = part.column("__starts"), part.column("__counts"), part.sizes

                def cover(i: int) -> np.ndarray:
                    if not starts[i].is_valid:
                        return np.zeros(sizes[i], bool)
                    return covered(int(sizes[i]), starts[i].values.to_numpy(), counts[i].values.to_numpy().astype(np.int64))

                yield finish(part.batch, part, cover)

    def missed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(no(batches))

    # Filtered and finished by one worker: two in a row would double an executor's Python processes.
    return hit.mapInArrow(run, schema).unionByName(docs.withColumns(nothing).mapInArrow(missed, schema))


def digests(docs: DataFrame, keep: str = "none") -> DataFrame:
    """What removal does to every document: bytes, removed bytes, removed spans and the hash of what stays."""

    def finish(batch: pa.RecordBatch, part: Slice, cover: Callable[[int], np.ndarray]) -> pa.RecordBatch:
        out = []
        for i in range(len(part)):
            gone = cover(i)
            own = part.data[part.bounds[i] : part.bounds[i + 1]]
            spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            out.append((len(own), int(gone.sum()), spans, hashlib.sha256(own[~gone].tobytes()).hexdigest()))
        columns = [batch.column("doc_id"), *map(pa.array, zip(*out, strict=True))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _with_windows(documents(docs, "doc_id", "text"), keep, finish, schema)


def without_repeats(docs: DataFrame, keep: str = "first") -> DataFrame:
    """The documents with repeated passages cut out of ``text``; characters cut in half go whole."""

    def finish(batch: pa.RecordBatch, part: Slice, cover: Callable[[int], np.ndarray]) -> pa.RecordBatch:
        texts = []
        for i, known in enumerate(batch.column("text").is_valid().to_pylist()):
            own = part.data[part.bounds[i] : part.bounds[i + 1]]
            texts.append(own[~cover(i)].tobytes().decode("utf-8", "ignore") if known else None)
        names = [c for c in batch.schema.names if c not in ("__starts", "__counts")]
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names)

    return _with_windows(docs, keep, finish, docs.schema)
