"""Compression bands: zstandard ratios of whole texts and of fixed chunks, with limits by length.

Repetitive text compresses far below what prose of its length does; random or encoded text hardly compresses at all.
Both limits depend on the length, since short texts pay the frame's overhead and long ones profit from their history.
The remainder of a text is a chunk too; chunks count by their bytes.

Cases: a null text is an empty one; a text without words has zero counts, fails the base rule and is not kept; equal
texts get equal values; repeated rows stay; only ``doc_id`` and ``text`` are read, so other columns cannot clash; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from slotwise.llm.textops import SPACE, PrefixHash, Slice, documents, map_slices, per_row, sequence_hash, words

CHUNK_BYTES = 4096
LEVEL = 3
#: (bytes from, lowest ratio, highest ratio) of compressed to plain size of a whole text; the last row that fits holds.
WHOLE_BANDS = ((0, 0.0, 99.0), (200, 0.30, 0.95), (1000, 0.25, 0.80), (4000, 0.22, 0.75), (20000, 0.18, 0.70), (200000, 0.12, 0.70))
#: The same for each chunk of n bytes: lowest ratio, highest ratio at any length, and bytes of overhead over n that add to
#: it. Prose of sf0.1 in its four languages stays below (at most 0.484 at 4,096 bytes, 0.607 at 1,000, 0.730 at 500,
#: 0.895 at 200), base64 above (at least 0.761, 0.795, 0.842, 0.945). A text fails if more than this share of its bytes
#: lies in chunks outside.
CHUNK_BAND = (0.15, 0.69)
CHUNK_OVERHEAD = 48
CHUNK_SHARE = 0.5

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, zstd_ratio double, bad_chunks long, n_chunks long, verdict string"
)

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
REPEAT_WIDTH = 5
LEAST_WORDS = 10
MOST_REPEATED = (20, 100)


def _repeats(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """True where the same key stands at another place of the same row."""
    order = np.lexsort((keys, rows))
    same = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    both = np.zeros(len(keys) + 1, bool)
    both[1:-1] = same
    out = np.zeros(len(keys), bool)
    out[order] = both[1:] | both[:-1]
    return out


def base_counts(part: Slice) -> dict[str, np.ndarray]:
    """The counted rules of every text in a slice."""
    n = len(part)
    starts, ends = words(part, SPACE ^ True)
    rows = part.rows(starts)
    hashes = PrefixHash(part.data)
    points = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
    out = {"n_words": per_row(rows, n), "word_chars": per_row(rows, n, points[ends] - points[starts])}
    out["n_symbols"] = np.diff(np.concatenate([[0], np.cumsum(SYMBOLS[part.data])])[part.bounds])

    cut = np.zeros(len(part.data) + 1, bool)
    cut[np.flatnonzero(part.data == 10) + 1] = True
    cut[part.bounds] = True
    lines = np.flatnonzero(cut)
    first, last = lines[:-1], lines[1:]
    line_rows = part.rows(first)
    if len(starts):
        held = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    else:
        held = np.zeros(len(first), bool)
    first, last, line_rows = first[held], last[held], line_rows[held]
    last = np.where(part.data[last - 1] == 10, last - 1, last) if len(last) else last
    keys = hashes(first, last)
    order = np.lexsort((keys, line_rows))
    again = (keys[order][1:] == keys[order][:-1]) & (line_rows[order][1:] == line_rows[order][:-1])
    out["n_dup_lines"] = per_row(line_rows[order][1:][again], n)

    windows = sequence_hash(hashes(starts, ends), REPEAT_WIDTH)
    whole = rows[: len(windows)] == rows[len(rows) - len(windows) :]
    at = np.flatnonzero(whole)
    twice = at[_repeats(windows[at], rows[at])]
    change = np.zeros(len(rows) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + REPEAT_WIDTH, -1)
    out["n_repeat_words"] = per_row(rows[np.cumsum(change[:-1]) > 0], n)
    return out


def band(size: int) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(WHOLE_BANDS) if size >= least)


def compression(raw: bytes, squeeze: zstandard.ZstdCompressor) -> tuple[float, int, int, str]:
    """Whole ratio, chunks outside the chunk band, chunks, and the verdict of the bands."""
    if not raw:
        return 0.0, 0, 0, "empty"
    ratio = len(squeeze.compress(raw)) / len(raw)
    low, high = band(len(raw))
    if ratio < low:
        return ratio, 0, 0, "repetitive"
    if ratio > high:
        return ratio, 0, 0, "incompressible"
    low_bytes = high_bytes = bad = count = 0
    for at in range(0, len(raw), CHUNK_BYTES):
        piece = raw[at : at + CHUNK_BYTES]
        own = len(squeeze.compress(piece)) / len(piece)
        low, high = own < CHUNK_BAND[0], own > CHUNK_BAND[1] + CHUNK_OVERHEAD / len(piece)
        low_bytes, high_bytes = low_bytes + low * len(piece), high_bytes + high * len(piece)
        bad, count = bad + (low or high), count + 1
    verdict = "pass"
    if low_bytes + high_bytes > CHUNK_SHARE * len(raw):
        verdict = "repetitive chunks" if low_bytes >= high_bytes else "incompressible chunks"
    return ratio, bad, count, verdict


def judge(part: Slice) -> dict[str, pa.Array]:
    """Everything but the id, for every text of a slice."""
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    base = base_counts(part)
    failed = (base["n_words"] < LEAST_WORDS) | (
        MOST_REPEATED[1] * base["n_repeat_words"] > MOST_REPEATED[0] * base["n_words"]
    )
    ratio, bad, count, verdict = zip(*[compression(part.raw(i), squeeze) for i in range(len(part))], strict=True)
    return {
        **{k: pa.array(v, pa.int64()) for k, v in base.items()},
        "base_failed": pa.array(failed),
        "kept": pa.array(~failed & (np.array(verdict) == "pass")),
        "zstd_ratio": pa.array(ratio, pa.float64()),
        "bad_chunks": pa.array(bad, pa.int64()),
        "n_chunks": pa.array(count, pa.int64()),
        "verdict": pa.array(verdict, pa.string()),
    }


def quality(docs: DataFrame) -> DataFrame:
    """Base counts, compression figures and the verdict of every document."""
    work = lambda part: pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **judge(part)})
    return map_slices(documents(docs, "doc_id", "text"), work, SCHEMA)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    return map_slices(docs, lambda part: part.batch.filter(judge(part)["kept"]), docs.schema)
