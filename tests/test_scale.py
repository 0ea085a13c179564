"""Ordered work in buckets: exact results with one group holding most rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from slotwise.operators import scale as S


def hot_rows(n=3000):
    rng = random.Random(5)
    return [("hot" if rng.random() < 0.7 else rng.choice("abc"), i, rng.randint(-50, 10_000_000)) for i in range(n)]


def test_ranked_and_running_match_plain_python(spark):
    rows = hot_rows()
    frame = spark.createDataFrame(rows, "k string, i int, v bigint").repartition(7)
    got = S.running(frame, ["k"], F.floor(F.col("i") / 100), ["i"], {"n": F.lit(1).cast("bigint"), "s": F.col("v")}).collect()
    want, totals = {}, {}
    for k, i, v in rows:
        n, s = totals.get(k, (0, 0))
        totals[k] = (n + 1, s + v)
        want[i] = totals[k]
    assert {r["i"]: (r["n"], r["s"]) for r in got} == want


def test_null_keys_are_a_group(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, i int")
    got = {(r["k"], r["i"]): r["rank"] for r in S.ranked(frame, ["k"], F.col("i"), ["i"]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 3): 1}


def test_neighbours_cross_buckets(spark):
    rows = hot_rows(1500)
    frame = spark.createDataFrame(rows, "k string, i int, v bigint").repartition(5)
    bucket = F.floor(F.col("i") / 64)
    back = {r["i"]: r["p"] for r in S.neighbour(frame, ["k"], bucket, ["i"], F.col("v"), "p").collect()}
    ahead = {r["i"]: r["p"] for r in S.neighbour(frame, ["k"], bucket, ["i"], F.col("v"), "p", following=True).collect()}
    last, want_back, want_ahead = {}, {}, {}
    for k, i, v in rows:
        want_back[i] = last.get(k, (None, None))[1]
        if k in last:
            want_ahead[last[k][0]] = v
        last[k] = (i, v)
    for i, _ in last.values():
        want_ahead[i] = None
    assert back == want_back and ahead == want_ahead


def test_exact_quantiles_match_numpy(spark):
    rows = hot_rows(4000)
    frame = spark.createDataFrame(rows, "k string, i int, v bigint")
    got = S.exact_quantiles(
        frame, ["k"], "v", {"lin": (0.95, "linear"), "near": (0.9, "nearest"), "up": (0.5, "upper"), "med": (0.5, "linear")},
        keep_stats=True,
    ).collect()
    for r in got:
        values = sorted(v for k, _, v in rows if k == r["k"])
        n = len(values)
        assert abs(r["lin"] - np.percentile(values, 95)) < 1e-6
        assert r["near"] == values[min(n - 1, round((n - 1) * 0.9))]
        assert r["up"] == values[n // 2]
        assert r["med"] == np.median(values)
        assert (r["count"], r["total"]) == (n, sum(values))


def test_global_position_is_the_sorted_order(spark):
    keys = [f"{i % 3}:{i}" for i in range(1000)]
    frame = spark.createDataFrame([(k,) for k in keys], "key string").repartition(6)
    got = {r["key"]: r["position"] for r in S.global_position(frame, ["key"]).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_heavy_lookup_joins_hot_and_rare_keys(spark):
    facts = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i}", i) for i in range(200)], "key string, i int")
    lookup = facts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("top"))
    got = S.heavy_lookup(facts, lookup, "key", "n", 700, parts=8)
    assert got.count() == 700
    assert got.where("key = 'hot' and top <> 499").count() == 0


def test_interval_lookup_wide_and_narrow(spark):
    rng = random.Random(3)
    widths = [1000] + [rng.randint(0, 5) for _ in range(300)]
    bounds, at = [], 0
    for i, w in enumerate(widths):
        bounds.append((i, at, at + w))
        at += w
    intervals = spark.createDataFrame(bounds, "id int, lo bigint, hi bigint").withColumns({"span": F.lit(at), "bins": F.lit(301)})
    points = spark.createDataFrame([(p,) for p in range(at)], "p bigint").withColumns({"span": F.lit(at), "bins": F.lit(301)})
    got = S.interval_lookup(points, intervals, [], "p", "lo", "hi", "span", "bins").select("p", "id").collect()
    want = {p: i for i, lo, hi in bounds for p in range(lo, hi)}
    assert len(got) == at and {r["p"]: r["id"] for r in got} == want


def test_a_wide_interval_is_listed_in_blocks(spark):
    n = 3 * S.CELL_BLOCK
    intervals = spark.createDataFrame([(1, 0, n - 2, n, n), (2, n - 2, n, n, n)], "asset int, low bigint, high bigint, span bigint, bins bigint")
    points = spark.range(0, n, 37).select(F.col("id").alias("at"), F.lit(n).cast("bigint").alias("span"), F.lit(n).cast("bigint").alias("bins"))
    got = S.interval_lookup(points, intervals, [], "at", "low", "high", "span", "bins").select("at", "asset").collect()
    assert len(got) == points.count() and all(r.asset == (1 if r.at < n - 2 else 2) for r in got)


def test_quantiles_by_selection(spark, monkeypatch):
    """Every method over hot, repeated, negative, infinite and null values, with cells that are opened again and again."""
    monkeypatch.setattr(S, "SMALL_CELL", 20)
    rng = random.Random(9)
    groups = {
        "close": [1_000_000_000_000 + rng.randint(0, 400_000) for _ in range(3000)], "repeated": [7] * 2000 + [8] * 3, "signs": [rng.randint(-900, 900) for _ in range(999)],
        "one": [-5], "two": [-(2**62), 2**62], None: [rng.choice([0, 1, -1]) for _ in range(40)], "far": [3**rng.randint(0, 33) for _ in range(500)],
    }
    rows = [(k, v) for k, values in groups.items() for v in [*values, None]]
    frame = spark.createDataFrame(rows, "k string, v bigint").repartition(6)
    asked = {"n": (0.9, "nearest"), "u": (0.5, "upper"), "w": (0.95, "whole"), "m": (0.5, "whole"), "lo": (0.0, "whole"), "hi": (1.0, "nearest")}
    got = {r["k"]: r for r in S.exact_quantiles(frame.where("k is null or k <> 'two'"), ["k"], "v", asked, keep_stats=True).collect()}
    got |= {r["k"]: r for r in S.exact_quantiles(frame.where("k = 'two'"), ["k"], "v", asked).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        values, n = sorted(values), len(values)

        def whole(a):
            low, rest = divmod((n - 1) * a, 100)
            sum_ = values[low] * 100 + (values[min(low + 1, n - 1)] - values[low]) * rest
            return abs(sum_) // 100 * (1 if sum_ >= 0 else -1)

        r = got[k]
        assert (r["n"], r["u"], r["lo"], r["hi"]) == (values[min(n - 1, round((n - 1) * 0.9))], values[n // 2], values[0], values[-1])
        assert (r["w"], r["m"]) == (whole(95), whole(50))
        assert "count" not in r or (r["count"], r["total"]) == (n, sum(values))


def test_quantiles_of_doubles(spark, monkeypatch):
    monkeypatch.setattr(S, "SMALL_CELL", 10)
    rng = random.Random(4)
    groups = {"small": [rng.random() * 1e-9 for _ in range(500)], "mixed": [rng.gauss(0, 10) for _ in range(777)], "odd": [float("inf"), -float("inf"), 0.0, -0.0, 1.5]}
    frame = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r["k"]: r for r in S.exact_quantiles(frame, ["k"], "v", {"med": (0.5, "linear"), "top": (1.0, "nearest"), "p": (0.9, "nearest")}).collect()}
    for k, values in groups.items():
        values = sorted(values)
        assert got[k]["top"] == values[-1] and got[k]["p"] == values[round((len(values) - 1) * 0.9)]
        assert abs(got[k]["med"] - np.median(values)) <= 1e-12 * max(1, abs(np.median(values)))


def test_a_million_values_in_one_cell(spark):
    """All values share the first pass's cell, far more than are put in order together."""
    base = 10**12
    frame = spark.range(0, 1_000_000, 1, 16).select((F.lit(base) + F.col("id") * 7919 % 1_000_003).alias("v"))
    assert frame.select(S.octave_cell(F.col("v"))).distinct().count() == 1
    got = S.exact_quantiles(frame, [], "v", {"p": (0.95, "whole"), "n": (0.5, "nearest")}, keep_stats=True).first()
    values = np.sort(base + np.arange(1_000_000, dtype=np.int64) * 7919 % 1_000_003)
    low, rest = divmod(999_999 * 95, 100)
    assert got["p"] == (int(values[low]) * 100 + int(values[low + 1] - values[low]) * rest) // 100
    assert got["n"] == values[round(999_999 * 0.5)] and (got["count"], got["total"]) == (10**6, int(values.sum()))


def test_whole_quantiles_at_every_count(spark):
    """The 95th percentile is a whole number where the two values beside it differ by a multiple of 100."""
    rows = [(n, 100 * i * i + 7) for n in range(2, 401) for i in range(n)]
    got = {r["k"]: r["p"] for r in S.exact_quantiles(spark.createDataFrame(rows, "k int, v bigint"), ["k"], "v", {"p": (0.95, "whole")}).collect()}
    for n in range(2, 401):
        low, rest = divmod((n - 1) * 95, 100)
        assert got[n] == 100 * low * low + 7 + (2 * low + 1) * rest


def test_numbers_are_dealt_before_they_are_listed(spark, monkeypatch):
    """One input partition that stands for many rows becomes many tasks of bounded size; grouping them needs no shuffle."""
    monkeypatch.setattr(S, "TASK_ROWS", 2000)
    monkeypatch.setattr(S, "NUMBER_CHUNK", 400)
    counts = {k: k % 40 for k in range(300)} | {1000: 5000, 1001: 0, 1002: -3}
    frame = spark.createDataFrame(list(counts.items()), "k int, n int").coalesce(1)
    rows = S.numbered_rows(frame, "n", "i", 4)
    assert sorted((r.k, r.i) for r in rows.collect()) == [(k, i) for k, n in sorted(counts.items()) for i in range(n)]
    most = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most * 4 <= 4 * 2000
    grouped = rows.groupBy("k", "n", S.CHUNK, "i").count()
    assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
