"""What the text operators hand from step to step on tables that once made them grow."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slotwise.llm import bloom_lm, signature_join, suffix_dedup


@pytest.fixture
def tables(monkeypatch):
    """Scratch tables by name, as the operators write them."""
    seen = {}
    for module in (signature_join, suffix_dedup):
        write = module.stored

        def keep(frame, name, write=write, **options):
            seen[name] = write(frame, name, **options)
            return seen[name]

        monkeypatch.setattr(module, "stored", keep)
    return seen


def test_rare_keys_first_in_a_large_vocabulary(spark, tables):
    """Passages of six texts each stay out of the prefixes, although nine of all shingles share one of 65,536 counts."""
    draw = random.Random(3)
    word = lambda: f"w{draw.getrandbits(40):x}"
    passages = [[word() for _ in range(20)] for _ in range(600)]
    rows = [(i, " ".join([word() for _ in range(150)] + passages[i % 600])) for i in range(3600)]
    out = signature_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.where("component_id = doc_id").count() == 3600
    assert tables["candidates"].count() < 100


def test_equal_keys_are_one_and_pairs_are_judged_in_the_tree(spark, monkeypatch):
    """Two texts of 600 shingles with 520 in common share 14 keys and no link; their 512 bits are too full to tell."""
    draw, seen = random.Random(7), {}
    words = lambda n: [f"w{draw.getrandbits(40):x}" for _ in range(n)]
    rows = []
    for i in range(30):
        shared = words(523)
        rows += [(2 * i + k, " ".join(shared + words(80))) for k in range(2)]
    find = signature_join._tree_pairs

    def keep(members, *rest):
        pairs = find(members, *rest)
        seen.update(members=members.count(), pairs=pairs.count())
        return pairs

    monkeypatch.setattr(signature_join, "_tree_pairs", keep)
    out = signature_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.where("component_id = doc_id").count() == 60
    assert seen["members"] <= 120 and seen["pairs"] == 0


def test_pairs_leave_the_trees_once_and_in_two_parts(spark):
    """Forty classes below three keys: each pair is one row, either of the draw or of the rest; one pair weighs too little."""
    bits, counts = bytearray(b"\xff" * 64), bytearray(b"\x01" * 256)
    below = {1: [*range(40)], 2: [*range(40)], 3: [*range(39)], 4: [39, 40], 5: [40]}
    rows = []
    for key, classes in below.items():
        for c in classes:
            own = [k for k, v in below.items() if c in v]
            rows.append((key, c, c, 0, 0, 0, 256, bits, counts, own, [1] * len(own)))
    schema = "key long, cid long, comp long, left int, right int, side int, n_shingles long, signature binary, counts binary, keys array<long>, weights array<long>"
    members = spark.createDataFrame(rows, schema)
    first, rest, both = ([(r.a, r.b) for r in signature_join._tree_pairs(members, 85, 2, draw).collect()] for draw in (True, False, None))
    assert sorted(both) == [(i, j) for i in range(40) for j in range(i + 1, 40)]
    assert sorted(first + rest) == sorted(both) and 0 < len(first) < 120


@pytest.mark.parametrize("steps", [3, 1 << 20])
def test_a_pair_leaves_below_its_first_common_key(monkeypatch, steps):
    monkeypatch.setattr(signature_join, "KEY_STEPS", steps)
    rng = np.random.default_rng(2)
    keys = [np.sort(rng.choice(np.arange(-9, 9), rng.integers(1, 7), replace=False)) for _ in range(40)]
    weight = {k: int(rng.integers(1, 4)) for k in range(-9, 9)}
    flat = np.concatenate(keys)
    lists = signature_join.KeyLists(np.cumsum([0, *map(len, keys)]), flat, np.array([weight[k] for k in flat.tolist()]))
    asked = [(i, j, k) for i in range(40) for j in range(i) for k in {*keys[i].tolist()} & {*keys[j].tolist()}]
    got = lists.meet_first(*(np.array(c) for c in zip(*asked, strict=True)), 4)
    for (i, j, k), good in zip(asked, got.tolist(), strict=True):
        common = {*keys[i].tolist()} & {*keys[j].tolist()}
        assert good == (k == min(common) and sum(weight[c] for c in common) >= 4)


def test_crowded_anchor_is_refined(spark, tables):
    """Most windows of 1,500 different runs around one anchor are settled in their buckets."""
    draw = random.Random(5)
    letters = lambda n: "".join(draw.choices("abcdefghijklmnop", k=n))
    shared = letters(190)
    rows = [(i, letters(150) + shared + letters(150)) for i in range(1500)]
    rows += [(1500 + i, rows[0][1][100:400]) for i in range(2)]  # both ends reach into what is unique to the first
    out = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in out.where("n_removed > 0").collect()} == {0: 300, 1500: 300, 1501: 300}
    assert tables["windows"].where("h1 is not null").count() < 60_000


@pytest.mark.parametrize("use", [suffix_dedup.digests, bloom_lm.score])
def test_batches_for_python_are_bounded_by_bytes(spark, use):
    frame = spark.createDataFrame([(i, "x" * 4000) for i in range(3000)], "doc_id long, text string").coalesce(1)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    use(frame)
    assert frame.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 3 << 20


def test_the_filter_comes_to_the_driver_in_small_files(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm, "SEGMENT_TOKENS", 200)
    seen, load = [], bloom_lm.load_filter

    def keep(filled, segments):
        seen.append(filled.groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count")).first())
        return load(filled, segments)

    monkeypatch.setattr(bloom_lm, "load_filter", keep)
    bloom = bloom_lm.build_filter(spark.range(20_000).select(F.col("id").alias("key"), F.lit(1).alias("n")))
    assert (bloom.level(np.arange(20_000).astype(np.uint64)) > 0).all()
    assert seen[0][0] <= 4 and seen[0][1] == 100


def invented(rng, texts, words):
    return [(i, " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) if rng.random() < 0.2 else rng.choice("the of and to in is it was".split()) for _ in range(words))) for i in range(texts)]


def test_a_large_filter_moves_no_more_than_a_small_one(spark, tmp_path, monkeypatch):
    """Shuffled and scratch bytes of the language model stay below four times the input where a filter is too large to send."""
    monkeypatch.setattr(bloom_lm, "FILTER_BITS", 1)
    paths, fresh = [], bloom_lm.scratch_path
    monkeypatch.setattr(bloom_lm, "scratch_path", lambda *a: paths.append(fresh(*a)) or paths[-1])
    path = str(tmp_path / "documents")
    spark.createDataFrame(invented(random.Random(3), 600, 700), "doc_id long, text string").coalesce(1).write.parquet(path)
    context = spark.sparkContext._jsc.sc()

    def shuffled():
        context.listenerBus().waitUntilEmpty()
        return context.statusStore().executorList(True).apply(0).totalShuffleWrite()

    before = shuffled()
    bloom_lm.score(spark.read.parquet(path)).write.format("noop").mode("overwrite").save()
    size = {x: sum(f.stat().st_size for f in Path(x.removeprefix("file:")).rglob("*.parquet")) for x in [path, *paths]}
    assert len(size) > 1 and min(size.values()) > 0
    assert shuffled() - before + sum(size[x] for x in paths) < 4 * size[path]


def test_chunks_and_parts_of_any_size_give_the_same_scores(spark, monkeypatch):
    frame = spark.createDataFrame([*invented(random.Random(9), 80, 60), (None, None), (7, "")], "doc_id long, text string").repartition(3)
    scores = []
    for sizes in ((1 << 21, 1 << 17, 1 << 17, 16, 256), (500, 200, 100, 3, 4), (1, 50, 1, 1, 1)):
        for name, value in zip(("CHUNK_TOKENS", "SEGMENT_TOKENS", "COMMON_TOKENS", "PART_SEGMENTS", "SINGLE_SEGMENTS"), sizes, strict=True):
            monkeypatch.setattr(bloom_lm, name, value)
        scores.append(sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6), r.score) for r in bloom_lm.score(frame).collect()))
    for rows in zip(*scores, strict=True):
        assert len({r[:-1] for r in rows}) == 1 and max(r[-1] for r in rows) - min(r[-1] for r in rows) < 0.02 * abs(rows[0][-1])
