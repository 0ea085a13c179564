"""Byte-level BPE encoding and decoding with Spark's higher-order functions alone.

A rank map is one constant value in the plan: an array of small maps, addressed by the CRC of the bytes. A word is
folded over its byte boundaries: each step removes the boundary whose pair of pieces has the lowest rank (leftmost on a
tie) and looks up the two neighbours that this changes. All distinct words of the corpus are counted, the most frequent
ones are encoded once and come back as a constant dictionary of bounded size; every other word is folded where it
stands, so no document or word is ever shuffled with its text. Decoding looks up the pieces of the ids and concatenates
their bytes (as hex digits, since Spark joins strings).

Cases: a null or empty text has no ids, and decodes to no bytes; ids outside the vocabulary decode to nothing; repeated
rows stay; long words cost their square; extra columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.frames import stored
from slotwise.llm.textops import documents, most_frequent

RANK_BUCKETS = 1 << 15
WORD_BUCKETS = 1 << 16
#: Words of the constant dictionary, and their most bytes: at most about 10 MB.
DICTIONARY_WORDS = 1 << 17
DICTIONARY_WORD_BYTES = 32

_TO_END = 1 << 30


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _buckets(items: Iterable[tuple[bytes, object, object]], count: int) -> list[list[tuple]]:
    """(key, value) lists by the CRC of the key's bytes."""
    out: list[list[tuple]] = [[] for _ in range(count)]
    for raw, key, value in items:
        out[zlib.crc32(raw) % count].append((key, value))
    return out


def _with_constant(frame: DataFrame, name: str, use: Callable[[Column], Column], **fields: pa.Array) -> DataFrame:
    """Add a column that uses one struct value of these arrays.

    The value is read once, as a scalar subquery, and the plan then holds it as a literal. It stands in a column of its
    own for the analysis; being used once, the optimizer puts it into the expression, so no row carries it.
    """
    row = frame.sparkSession.createDataFrame(pa.table({k: pa.array([v.to_pylist()], pa.list_(v.type)) for k, v in fields.items()}))
    held = frame.withColumn("_held", F.array(row.select(F.struct(*fields)).scalar()))
    return held.select(*frame.columns, F.get(F.transform("_held", use), F.lit(0)).alias(name))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value under a name, evaluated once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rank(ranks: Column, raw: Column) -> Column:
    return F.try_element_at(F.get(ranks, (F.crc32(raw) % RANK_BUCKETS).cast("int")), raw)


def _fold(ranks: Column, raw: Column) -> Column:
    """Ids of the bytes of one word."""

    def pair(ends: Column, first: Column, last: Column) -> Column:
        start = F.get(ends, first)
        return _rank(ranks, F.substring(raw, start + 1, F.get(ends, last) - start))

    def step(state: Column) -> Column:
        ends, found = state["ends"], state["found"]

        def merge(place: Column) -> Column:
            # ``found`` has a blank at either end: its place is one more than the number of the left piece.
            k = place - 1
            left, right = pair(ends, k - 2, k + 1), pair(ends, k - 1, k + 2)
            return F.when(place.isNull(), state).otherwise(
                F.struct(
                    F.concat(F.slice(ends, F.lit(1), k), F.slice(ends, k + 2, F.lit(_TO_END))).alias("ends"),
                    F.concat(F.slice(found, F.lit(1), place - 2), F.array(left, right), F.slice(found, place + 2, F.lit(_TO_END))).alias("found"),
                )
            )

        return _bind(F.array_position(found, F.array_min(found)).cast("int"), merge)

    blank = F.lit(None).cast("int")
    size = F.length(raw)
    pairs = F.when(size > 1, F.transform(F.sequence(F.lit(1), size - 1), lambda i: _rank(ranks, F.substring(raw, i, F.lit(2)))))
    start = F.struct(
        F.sequence(F.lit(0), size).alias("ends"),
        F.concat(F.array(blank), F.coalesce(pairs, F.array().cast("array<int>")), F.array(blank)).alias("found"),
    )
    steps = F.when(size > 1, F.sequence(F.lit(2), size)).otherwise(F.array().cast("array<int>"))

    def ids(state: Column) -> Column:
        ends = state["ends"]
        return F.transform(F.sequence(F.lit(1), F.size(ends) - 1), lambda i: pair(ends, i - 1, i))

    whole = _rank(ranks, raw)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.aggregate(steps, start, lambda s, _: step(s), ids))


def _words(pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?U){pattern}"), F.lit(0))


def _rank_array(ranks: dict[bytes, int]) -> pa.Array:
    return pa.array(_buckets(((t, t, r) for t, r in ranks.items()), RANK_BUCKETS), pa.map_(pa.binary(), pa.int32()))


def word_counts(docs: DataFrame, pattern: str) -> DataFrame:
    """How often each distinct word occurs."""
    return docs.select(F.explode(_words(pattern)).alias("word")).groupBy("word").count()


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id and ids of every document."""
    docs = documents(docs, "doc_id", "text")
    table = _rank_array(ranks)
    common = stored(word_counts(docs, pattern).where(F.octet_length("word") <= DICTIONARY_WORD_BYTES), "words")
    common = most_frequent(common, "count", DICTIONARY_WORDS)
    fold = lambda t: _bind(F.col("word").cast("binary"), lambda raw: _fold(t["ranks"], raw))
    folded = _with_constant(common.select("word"), "ids", fold, ranks=table)
    pairs = [(r.word.encode(), r.word, r.ids) for r in folded.collect()]
    dictionary = pa.array(_buckets(pairs, WORD_BUCKETS), pa.map_(pa.string(), pa.list_(pa.int32())))

    def ids(t: Column) -> Column:
        def one(word: Column) -> Column:
            known = F.try_element_at(F.get(t["words"], (F.crc32(word.cast("binary")) % WORD_BUCKETS).cast("int")), word)
            return F.coalesce(known, _bind(word.cast("binary"), lambda raw: _fold(t["ranks"], raw)))

        return F.flatten(F.transform(_words(pattern), one))

    return _with_constant(docs, "ids", ids, ranks=table, words=dictionary).select("doc_id", "ids")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` with the bytes that its ``ids`` stand for and the ids as little-endian 32-bit bytes."""
    size = 1 + max(ranks.values(), default=0)
    pieces, numbers = [""] * size, [i.to_bytes(4, "little").hex() for i in range(size)]
    for token, rank in ranks.items():
        pieces[rank] = token.hex()

    def joined(field: str) -> Callable[[Column], Column]:
        return lambda t: F.unhex(F.array_join(F.transform("ids", lambda i: F.get(t[field], i)), ""))

    both = lambda t: F.struct(joined("pieces")(t).alias("decoded"), joined("numbers")(t).alias("id_bytes"))
    out = _with_constant(encoded, "_both", both, pieces=pa.array(pieces), numbers=pa.array(numbers))
    return out.select(*encoded.columns, "_both.decoded", "_both.id_bytes")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Number and hashes of the ids of every document, and the hash of what they decode to."""
    return decode(encode(docs, ranks, pattern), ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("id_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
