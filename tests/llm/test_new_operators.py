"""Quality trees, vector codes and the Merkle manifest against plain loops, with nulls, copies, ties and odd tables."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from slotwise.llm import boosted_quality, merkle_manifest, metric_codes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, p long, n long, s string, digest string, leaf string, node int"


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(digests):
    """Levels of digests from the leaves to the last node."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % 16
        out.append((level[first:at], level[at + 1 : first + 16]))
        at //= 16
    return out


def plain_manifest(rows):
    leaves = defaultdict(list)
    for row in rows:
        doc_id, text, lang, source, n_chars = row[:5]
        own = sha(*map(field, (doc_id, source, lang, n_chars, text)))
        bad = sha(*map(field, (doc_id, source, lang, n_chars, lowered(text))))
        struck = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        leaves[source].append((doc_id is not None, doc_id or 0, own, bad if struck else own))
    sources = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        leaves[s].sort()
        trees[s] = tree([leaf for _, _, leaf, _ in leaves[s]])
    upper = tree([trees[s][-1][0] for s in sources])
    root = upper[-1][0]
    out = []
    for i, s in enumerate(sources):
        for at, (known, doc_id, leaf, start) in enumerate(leaves[s]):
            steps = path(trees[s], at) + path(upper, i)
            folded = start
            for left, right in steps:
                folded = sha(*left, folded, *right)
            proof = sha(*[x for left, right in steps for x in left + right])
            out.append((doc_id if known else None, leaf, trees[s][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def manifest_rows(spark, rows):
    filled = [(*r, 1, 2, "x", "y", "z", 3) for r in rows]
    got = merkle_manifest.manifest(spark.createDataFrame(filled, DOCS))
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"a": 300, "b": 17, "c": 16, "é": 1, None: 5, "B": 2}, {"a": 9}, {"a": 1}, {"a": 33}, {f"s{i}": 1 + i % 3 for i in range(40)}])
def test_manifest(spark, sizes):
    rng = random.Random(3)
    rows = [(rng.randrange(10**6), rng.choice(["Ab", "ab", "ÉX", "x" * 5000 + "Q", "", None]), rng.choice(["en", None]), s, rng.choice([3, None])) for s, n in sizes.items() for _ in range(n)]
    if len(rows) > 20:
        rows += [rows[0], rows[0], rows[1], (None, None, None, "a", None), (None, "T", "en", "a", 1), (-5, "Neg", "en", "a", 1)]
    assert manifest_rows(spark, rows) == plain_manifest(rows)


def test_manifest_of_nothing(spark):
    got = merkle_manifest.manifest(spark.createDataFrame([], DOCS))
    assert got.collect() == [] and got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_one_row_shares_no_range_with_its_copies(spark, monkeypatch):
    """A third of the rows are one row; its copies are numbered over several ranges."""
    monkeypatch.setattr(merkle_manifest, "key_ranges", lambda frame, order: __import__("slotwise.operators.scale", fromlist=["key_ranges"]).key_ranges(frame, order, rows=10))
    rows = [(7, "same", "en", "hot", 4)] * 120 + [(i, f"t{i}", "en", f"s{i % 7}", 2) for i in range(240)]
    assert manifest_rows(spark, rows) == plain_manifest(rows)


# Vector codes


def plain_codes(rows):
    kept = [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v, _ in kept if v and len(v) % 4 == 0]
    length = max(lengths, key=lambda n: (lengths.count(n), n), default=4)
    fits = [(i, [math.floor(1024 * c) for c in v], v, x) for i, v, x in kept if len(v) == length]
    width = length // 4
    start = sorted(fits, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:256]
    books = [[tuple(v[k * width : (k + 1) * width]) for _, v, _, _ in start] for k in range(4)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), j) for j, entry in enumerate(book))

    for _ in range(4):
        for k in range(4):
            owned = defaultdict(list)
            for _, v, _, _ in fits:
                part = v[k * width : (k + 1) * width]
                owned[near(part, books[k])[1]].append(part)
            books[k] = [tuple(sum(c) // len(owned[j]) for c in zip(*owned[j], strict=True)) if j in owned else e for j, e in enumerate(books[k])]
    text = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    out, sums = [], defaultdict(int)
    for i, v, _, x in fits:
        found = [near(v[k * width : (k + 1) * width], books[k]) for k in range(4)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), x))
        sums[x] += out[-1][2]
    out = [(i, code, error, sums[x], text) for i, code, error, x in out]
    return out + [(i, None, None, None, text) for i, v, x in kept if len(v) != length]


@pytest.mark.parametrize("n", [0, 3, 700])
def test_codes(spark, n):
    rng = random.Random(n)
    same = [0.25, -0.5, 1.5, 0.0, 0.0, 0.0, 0.125, 9.0]
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 1) + rng.choice([0, 5]) for _ in range(8)]
        rows.append((rng.randrange(10**6), rng.choice([v, v, v, v, same, [c + 0.001 for c in same]]), rng.choice([1, 2, None])))
    if n > 10:
        rows += [(1, None, 1), (2, [None] * 8, 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] + [0.0] * 7, 2), (5, [1.0] * 4, 2), (6, [], 2), (7, [1.0] * 7, None)]
        rows += [rows[0], (rows[0][0], same, 2), (None, same, None), (8, [60000.0, -60000.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0], 3)]
    rows = [(i, v and [float(np.float32(c)) if c is not None else None for c in v], x) for i, v, x in rows]
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], "vec_id long, embedding array<float>, label int, key string, code int")
    got = metric_codes.compress(frame.repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_codes(rows), key=repr)


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "wide"])
def test_trees_find_what_comparing_all_finds(kind):
    rng = np.random.default_rng(1)
    points = {
        "spread": rng.integers(-500, 500, (1500, 6)), "clusters": rng.integers(-5, 5, (1500, 6)) + rng.choice([0, 10000], (1500, 1)),
        "copies": rng.choice([0, 0, 0, 7], (1500, 1)) * np.ones((1, 6), np.int64), "wide": rng.integers(-(2**27), 2**27, (600, 6)),
    }[kind].astype(np.int64)
    grown = metric_codes.build(points)
    assert sorted(grown.order) == list(range(len(points))) and (grown.points == points[grown.order]).all()
    for i, (first, last) in enumerate(zip(grown.first, grown.last, strict=True)):
        inside = grown.points[first:last].astype(object)
        assert (grown.sums[i] == inside.sum(0)).all()
        assert max(((p - grown.centres[i]) ** 2).sum() for p in inside) <= (grown.reach[i] * metric_codes.ROOM) ** 2 + 1e-6
    book = metric_codes.Codebook(points[rng.integers(0, len(points), 40)])
    codes, errors = metric_codes.codes_of(metric_codes.Tree.read(grown.row(), 6), book)
    apart = ((points[:, None, :].astype(object) - book.entries[None]) ** 2).sum(2)
    assert (codes == apart.argmin(1)).all() and (errors == apart.min(1)).all()
    counts, sums = np.zeros(40, np.int64), np.zeros((40, 6), np.int64)
    metric_codes.add_up(grown, book, counts, sums)
    assert (counts == np.bincount(codes, minlength=40)).all()
    assert (sums == np.array([points[codes == j].sum(0) for j in range(40)])).all()
    if kind == "clusters":
        far = metric_codes.Codebook(np.array([[0] * 6, [10000] * 6]))
        owned, _, leaves, _ = metric_codes.descend(grown, far)
        assert len(leaves) == 0 and len(owned) < 10


# Quality trees


def test_statistics_of_known_texts():
    import pyarrow as pa

    from slotwise.llm.textops import slices

    texts = ["AB cd! 12 é\ncd!\ncd!", "", None, "x x x y"]
    part = next(slices(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})))
    got = boosted_quality.statistics(part)
    assert got["upper"].tolist() == [2 / 19, 0, 0, 0]
    assert got["digit"][0] == 2 / 19 and got["beyond_ascii"][0] == 1 / 19 and got["shout"][0] == 3 / 19
    assert got["log_words"].tolist() == [math.log2(7), 0, 0, math.log2(5)]
    assert got["log_lines"].tolist() == [2, 0, 0, 1]
    assert got["same_as_last"].tolist() == [1 / 6, 0, 0, 2 / 4]
    assert got["distinct_words"].tolist() == [4 / 6, 0, 0, 2 / 4] and got["top_word"].tolist() == [3 / 6, 0, 0, 3 / 4]
    assert got["repeated_lines"].tolist() == [1 / 3, 0, 0, 0]
    assert got["word_length"].tolist() == [(2 + 3 + 2 + 1 + 3 + 3) / 6, 0, 0, 1]


def test_best_split_is_that_of_trying_all(spark):
    rng = np.random.default_rng(7)
    matrix = rng.integers(0, boosted_quality.BINS, (400, len(boosted_quality.SCALES))).astype(np.uint8)
    target = ((matrix[:, 4] > 20) ^ (rng.random(400) < 0.1)).astype(float)
    rows = spark.createDataFrame([(m.tobytes(), float(t)) for m, t in zip(matrix, target, strict=True)], "bins binary, target double").repartition(5)
    prior = float(np.log(target.mean() / (1 - target.mean())))
    forest = boosted_quality.Forest.empty(prior).planted()
    sums = boosted_quality.summed(rows, forest, 0)
    score = 1 / (1 + np.exp(-prior))
    g, h = np.rint((score - target) * boosted_quality.UNIT), np.rint(score * (1 - score) * boosted_quality.UNIT) * np.ones(400)
    for k in range(matrix.shape[1]):
        for b in range(boosted_quality.BINS):
            here = matrix[:, k] == b
            assert sums[0, 0, k, b] == g[here].sum() and sums[1, 0, k, b] == h[here].sum()
    g, h = g / boosted_quality.UNIT, h / boosted_quality.UNIT
    tried = []
    for k in range(matrix.shape[1]):
        for b in range(boosted_quality.BINS):
            left = matrix[:, k] <= b
            if h[left].sum() >= 1 and h[~left].sum() >= 1:
                gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1) - g.sum() ** 2 / (h.sum() + 1)
                tried.append((gain, k, b))
    feature, bound, values = boosted_quality.best_splits(sums)
    _, k, b = max(tried)
    left = matrix[:, k] <= b
    assert (feature[0], bound[0]) == (k, b) == (4, 20)
    assert np.allclose(values[0], [-g[left].sum() / (h[left].sum() + 1), -g[~left].sum() / (h[~left].sum() + 1)])


def test_flat_trees_go_where_a_walk_goes():
    rng = np.random.default_rng(2)
    inner = (1 << boosted_quality.DEPTH) - 1
    forest = boosted_quality.Forest(0.3, rng.integers(0, 5, (4, inner)), rng.integers(0, 64, (4, inner)), rng.normal(size=(4, inner + 1)))
    matrix = rng.integers(0, 64, (50, 5))
    for row, got in zip(matrix, forest.margin(matrix), strict=True):
        want = 0.3
        for t in range(4):
            node = 0
            while node < inner:
                node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.bound[t, node])
            want += forest.value[t, node - inner]
        assert math.isclose(got, want)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = boosted_quality.score(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    seen = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    assert len(seen) > 50 and (seen.predicted == seen.quality).mean() >= 0.95
    again = boosted_quality.score(docs.repartition(5), labels.repartition(3)).toPandas()
    assert again.sort_values("doc_id").score.tolist() == got.sort_values("doc_id").score.tolist()


def test_odd_documents_and_labels(spark):
    schema = "doc_id long, text string, quality int, cells int, target string, bins int"
    texts = [None, "", "\n \n", "x", "word " * 300, "Good prose, of many different words." + " more" * 3, "!!! $$$", "é" * 1000 + "\n" + "y" * 3_000_000]
    rows = [(i, t, 0, 0, "", 0) for i, t in enumerate(texts)] + [(None, "no id", 1, 1, "", 1), (1, "", 1, 1, "", 1)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 0, "t"), (1, 1, "t"), (4, 1, "t"), (5, None, "t"), (None, 1, "t"), (99, 1, "t")], "doc_id long, quality int, text string")
    got = boosted_quality.score(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert len({r.score for r in got if r.doc_id in (0, 1)}) == 1 and all(0 <= r.score <= 1 for r in got)
    none = boosted_quality.score(docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}
    assert boosted_quality.score(docs.where("false"), labels).collect() == []
