"""Language identification by multilingual mixture inference.

Byte trigrams of the labelled training texts are counted per language. A text is then a mixture: each of its trigrams
comes from language l with proportion w[l]. Expectation-maximisation estimates the proportions; the set of languages is
the one with the best penalised likelihood (a log of the trigram count for every language beyond the first), found by
backward elimination from all trained languages: the smallest proportion goes, the rest is estimated again. The
prediction is the language with the largest proportion, the score that proportion.

The model holds languages x 32,768 counts, whatever the size of the corpus. All training rows are counted.

Cases: a null text, or one without a letter, is ``und`` with score 0; ties go to the first language by name; rows with
null language never train; with no training rows every text is ``und``; repeated rows and null ids stay (a null id
counts as the empty text in the split); extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.textops import Slice, documents, map_slices, slices

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.1
FULL_ROUNDS, SET_ROUNDS = 10, 4
#: Trigrams x languages that are estimated at once (more for a single text; that has at most BUCKETS trigrams).
BLOCK_CELLS = 1 << 22
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
_ASCII_LETTER = (_LETTER != 32) & (np.arange(256) < 128)
_ANY_LETTER = regex.compile(r"\p{L}")

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, languages string"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def trigrams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every trigram of letters and single blanks."""
    text = _LETTER[part.data].astype(np.int64)
    if len(text) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (text[:-2] << 16) | (text[1:-1] << 8) | text[2:]
    blank = text == 32
    good = ~(blank[:-2] & blank[1:-1]) & ~(blank[1:-1] & blank[2:])
    edge = np.zeros(len(text) + 1, bool)
    edge[part.bounds] = True
    good &= ~(edge[1:-2] | edge[2:-1])
    at = np.flatnonzero(good)
    spread = (code[at] * 0x9E3779B1) & 0xFFFFFFFF
    return part.rows(at), spread >> (32 - BUCKET_BITS)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages by name and their log probabilities, (languages, buckets)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                rows, grams = trigrams(part)
                names, which = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
                counts = np.bincount(which[rows] * BUCKETS + grams, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for name, own in zip(names.tolist(), counts, strict=True):
                    held[name] = held[name] + own if name in held else own
        for name, own in held.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([name] * len(some), pa.string()), "gram": pa.array(some, pa.int32()), "n": pa.array(own[some], pa.int64())}
            )

    known = documents(docs, "doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    known = known.where(~held_out(F.col("doc_id"))).select("text", "lang")
    rows = known.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows["lang"].unique().tolist())
    counts = np.zeros((len(names), BUCKETS))
    counts[np.searchsorted(names, rows["lang"].to_numpy(str)) if names else [], rows["gram"].to_numpy(int)] = rows["n"]
    counts += SMOOTHING
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` from each begin to the next; no stretch is empty."""
    return np.add.reduceat(values, begin, axis=0)


def mixtures(rows: np.ndarray, grams: np.ndarray, model: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Languages (count, k) by falling proportion and their proportions, 0 outside the selected set; -1 without trigrams."""
    k = len(model)
    languages, shares = np.full((count, k), -1), np.zeros((count, k))
    keys, times = np.unique(rows * BUCKETS + grams, return_counts=True)
    if not len(keys) or not k:
        return languages, shares
    row, gram, times = keys >> BUCKET_BITS, keys & (BUCKETS - 1), times.astype(np.float32)
    begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    some, begin = row[begin], np.append(begin, len(row))
    first = 0
    while first < len(some):
        last = int(np.searchsorted(begin, begin[first] + BLOCK_CELLS // k, "right")) - 1
        last = min(max(last, first + 1), len(some))
        own = slice(begin[first], begin[last])
        chosen = _language_sets(gram[own], times[own], begin[first:last] - begin[first], model)
        order = np.argsort(-chosen, axis=1, kind="stable")
        languages[some[first:last]] = order
        shares[some[first:last]] = np.take_along_axis(chosen, order, axis=1)
        first = last
    return languages, shares


def _language_sets(gram: np.ndarray, times: np.ndarray, begin: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Proportions (texts, languages) of the best penalised set of each text, 0 outside it."""
    k = len(model)
    at = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(gram))))
    total = _sums(times, begin)
    single = np.stack([_sums(times * own[gram], begin) for own in model], axis=1)
    log_p = model[:, gram].T
    top = log_p.max(axis=1)
    p = np.exp(log_p - top[:, None])
    floor = _sums(times * top, begin)

    def fit(w: np.ndarray, rounds: int) -> np.ndarray:
        for _ in range(rounds):
            part = p * w[at]
            part *= (times / np.maximum(part.sum(axis=1), 1e-30))[:, None]
            w = _sums(part, begin) / total[:, None]
        return w

    each = np.arange(len(begin))
    w = fit(np.full((len(begin), k), 1 / k, np.float32), FULL_ROUNDS)
    active = np.ones(w.shape, bool)
    chosen, reached = np.zeros_like(w), np.full(len(begin), -np.inf)
    for size in range(k, 0, -1):
        if size < k:
            active[each, np.argmin(np.where(active, w, np.inf), axis=1)] = False
            w = np.where(active, w, 0)
            w /= w.sum(axis=1, keepdims=True)
            w = fit(w, SET_ROUNDS) if size > 1 else w
        if size == 1:
            w = np.zeros_like(w)
            w[each, np.argmax(single, axis=1)] = 1
        value = _sums(times * np.log(np.maximum((p * w[at]).sum(axis=1), 1e-30)), begin) + floor - (size - 1) * np.log(total + 1)
        better = value >= reached
        chosen[better], reached[better] = w[better], value[better]
    return chosen


def _has_letter(part: Slice) -> np.ndarray:
    ascii_letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[part.data])])[part.bounds]
    out = np.diff(ascii_letters) > 0
    for row in np.flatnonzero(~out & (part.sizes > 0)).tolist():
        out[row] = _ANY_LETTER.search(part.raw(row).decode("utf-8", "replace")) is not None
    return out


def label(part: Slice, names: list[str], model: np.ndarray) -> tuple[list[str], list[float], list[str]]:
    """Prediction, score and language set of every text of a slice."""
    rows, grams = trigrams(part)
    languages, shares = mixtures(rows, grams, model, len(part))
    letters = _has_letter(part)
    prediction, score, sets = [], [], []
    for row in range(len(part)):
        if not names or not letters[row]:
            own, held = (UNKNOWN, 0.0), []
        elif languages[row, 0] < 0:
            own, held = (names[0], 1 / len(names)), []
        else:
            held = [(names[i], s) for i, s in zip(languages[row].tolist(), shares[row].tolist(), strict=True) if s > 0]
            own = (held[0][0], min(1.0, held[0][1]))
        prediction.append(own[0])
        score.append(own[1])
        sets.append(",".join(f"{name}:{share:.3f}" for name, share in held))
    return prediction, score, sets


def predict(docs: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    def work(part: Slice) -> pa.RecordBatch:
        prediction, score, sets = label(part, names, model)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "held_out": part.column("held_out"),
                "lang_pred": pa.array(prediction, pa.string()),
                "score": pa.array(score, pa.float64()),
                "languages": pa.array(sets, pa.string()),
            }
        )

    return map_slices(documents(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id"))), work, SCHEMA)


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows outside the held-out third and predict every row."""
    return predict(docs, *train(docs))


#: Share of a text that its language must hold in a corpus.
MAIN_SHARE = 0.5


def keep_known(docs: DataFrame, least_score: float = MAIN_SHARE) -> DataFrame:
    """The documents whose language is known and holds at least this share of the text, with all their columns."""
    names, model = train(docs)

    def work(part: Slice) -> pa.RecordBatch:
        prediction, score, _ = label(part, names, model)
        return part.batch.filter(pa.array([p != UNKNOWN and s >= least_score for p, s in zip(prediction, score, strict=True)]))

    return map_slices(docs, work, docs.schema)
