"""Streams against batch results: late, repeated and missing rows, replays, and tables that do not grow with the batches."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.streaming import monitor as M
from slotwise.streaming import tables as S

PAUSES = "run bigint, seq bigint, us bigint, state string"
READINGS = "session_id string, sequence bigint, ingested_at timestamp"


@pytest.fixture
def deliver(spark, tmp_path):
    """Write rows as one more delivery and return the stream over all of them."""

    def run(rows, schema):
        frame = spark.createDataFrame(rows, schema.replace("ingested_at timestamp", "ingested_at bigint"))
        if "ingested_at" in frame.columns:
            frame = frame.withColumn("ingested_at", F.timestamp_millis("ingested_at"))
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return spark.readStream.schema(schema).parquet(str(tmp_path / "in"))

    return run


def table(spark, path, schema, merge, **more):
    return S.MergedTable(spark, str(path), schema, merge, **more)


def test_a_merged_table_stays_small(spark, tmp_path):
    held = table(spark, tmp_path / "t", "k bigint, n bigint", S.combined(["k"], {"n": F.sum}), every=4)
    most, want = 0, {}
    for batch in range(50):
        rows = [(batch % 5, batch), (7, 1)]
        for k, n in rows:
            want[k] = want.get(k, 0) + n
        held.add(spark.createDataFrame(rows, "k bigint, n bigint").coalesce(1), batch)
        base, parts = held.parts()
        most = max(most, len(parts))
        assert len(list((tmp_path / "t").iterdir())) <= 2 + 2 * 4
    assert most <= 4 and {r["k"]: r["n"] for r in held.read().collect()} == want
    before = {r["k"]: r["n"] for r in held.read(47).collect()}
    held.add(spark.createDataFrame([(2, 47), (7, 1)], "k bigint, n bigint"), 47)  # a replay over a base
    assert {r["k"]: r["n"] for r in held.read(47).collect()} == before
    assert {r["k"]: r["n"] for r in held.read().collect()} == want


def test_an_empty_table_reads_as_empty(spark, tmp_path):
    held = table(spark, tmp_path / "none", "k bigint, n bigint", S.newest(["k"]))
    assert held.read().collect() == [] and held.parts() == (-1, [])


def test_pauses_equal_batch_with_late_and_repeated_changes(spark, tmp_path, deliver):
    rng = random.Random(2)
    rows = [(r, i, (1000 + i) * 1_000_000 + r, "paused" if (i * 7 + r) % 3 == 0 else "running") for r in range(5) for i in range(80)]
    held = table(spark, tmp_path / "table", M.PAUSE_SCHEMA, S.newest(["run", "first_seq"]), every=3)
    sizes = []
    for part in range(8):
        chunk = [r for r in rows if r[1] // 10 == part and r[1] % 10 != 9] + [r for r in rows if r[1] // 10 == part - 1 and r[1] % 10 == 9]
        if part == 7:
            chunk += [r for r in rows if r[1] == 79]
        chunk += rng.sample([r for r in rows if r[1] // 10 <= part], 6)
        rng.shuffle(chunk)
        M.stream_pause_state(deliver(chunk, PAUSES), held, str(tmp_path / "state"), "15 seconds")
        sizes.append(held.parts()[1])
    assert max(map(len, sizes)) <= 3
    got = {r["run"]: (r["paused_us"], r["open_since_us"]) for r in M.paused_totals(held.read()).collect()}
    for run in range(5):
        mine = sorted(r for r in rows if r[0] == run)
        closed = sum(b[2] - a[2] for a, b in zip(mine, mine[1:]) if a[3] == "paused")
        assert got[run] == (closed, mine[-1][2] if mine[-1][3] == "paused" else None)


def test_a_silent_run_is_closed(spark, tmp_path, deliver):
    held = table(spark, tmp_path / "table", M.PAUSE_SCHEMA, S.newest(["run", "first_seq"]))
    second = 1_000_000
    deliveries = [
        [(1, 0, 10 * second, "paused"), (1, 1, 14 * second, "running"), (2, 0, 10 * second, "running")],
        [(2, 1, 100 * second, "paused")],
        [(2, 2, 103 * second, "running")],
        [(1, 2, 200 * second, "paused"), (1, 3, 205 * second, "running")],
    ]
    for rows in deliveries:
        M.stream_pause_state(deliver(rows, PAUSES), held, str(tmp_path / "state"), "1 second", silence_ms=30_000)
    rows = {(r["run"], r["first_seq"]): (r["paused_us"], r["closed"]) for r in held.read().collect()}
    assert rows[1, 0] == (4 * second, True) and rows[1, 2] == (5 * second, False)
    totals = {r["run"]: r["paused_us"] for r in M.paused_totals(held.read()).collect()}
    assert totals == {1: 9 * second, 2: 3 * second}


def test_gaps_come_out_when_they_are_final(spark, tmp_path, deliver):
    gaps = table(spark, tmp_path / "gaps", "session_id string, low bigint, high bigint", lambda rows: rows)
    totals = table(spark, tmp_path / "totals", "session_id string, samples bigint, missing bigint", S.newest(["session_id"]))
    at = lambda n: 1_000_000 + n * 1000
    seen = []
    deliveries = [
        [("a", n, at(n)) for n in (1, 2, 3, 6, 7, 7, 10)] + [("b", 5, at(5)), (None, 3, at(3)), ("b", None, at(5))],
        [("a", n, at(n)) for n in (5, 4, 11, 11, 12, 10)],  # 4 and 5 are filled in time, 10 and 11 come twice
        [("a", 30, at(30)), ("b", 6, at(30)), ("b", 5, at(31))],
        [("a", 8, at(8)), ("a", 31, at(60)), ("b", 9, at(60))],  # 8 is too late
        [("a", 32, at(90)), ("b", 10, at(90))],
    ]
    for rows in deliveries:
        M.stream_gaps(deliver(rows, READINGS), gaps, totals, str(tmp_path / "state"), "10 seconds")
        seen.append(sorted((r["session_id"], r["low"], r["high"]) for r in gaps.read().collect()))
    assert seen[0] == seen[1] == [] and ("a", 4, 5) not in seen[-1]
    assert ("a", 8, 9) in seen[-1] and ("a", 13, 29) in seen[-1] and ("b", 7, 8) in seen[-1]
    got = {r["session_id"]: (r["samples"], r["missing"]) for r in totals.read().collect()}
    numbers = {1, 2, 3, 4, 5, 6, 7, 10, 11, 12, 30, 31, 32}
    assert got == {"a": (len(numbers), 32 - len(numbers)), "b": (4, 2)}


def test_spans_merge():
    got = M.merge_spans([(1, 1, 3), (2, 2, 5), (4, 8, 6), (5, 5, 1), (10, 10, 2)])
    assert got == [(1, 2, 3), (4, 8, 6), (10, 10, 2)]


def test_progress_adds_up_over_deliveries(spark, tmp_path, deliver):
    held = table(spark, tmp_path / "p", M.PROGRESS_SCHEMA, S.combined(["run"], M.PROGRESS_RULES), every=2)
    rows = [(i % 3, i * 10, i % 2 == 0, i < 20) for i in range(60)]
    schema = "run bigint, us bigint, accepted boolean, replayed boolean"
    for part in range(5):
        M.stream_progress(deliver(rows[part * 12 : part * 12 + 12], schema), held, str(tmp_path / "s"))
        assert len(held.parts()[1]) <= 2
    want = {r["run"]: tuple(r) for r in M.batch_progress(spark.createDataFrame(rows, schema)).collect()}
    assert {r["run"]: tuple(r)[:-1] for r in held.read().collect()} == want


def test_session_windows_match_the_split_and_count_late_rows(spark, tmp_path):
    rows = [("u", 0), ("u", 5), ("u", 15), ("u", 30), ("v", 2)]
    to_frame = lambda r: spark.createDataFrame(r, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"), (F.col("s") * 1000000).cast("bigint").alias("us"))
    frame, dropped = to_frame(rows), []
    batch = M.session_split(frame.withColumn("id", F.col("us")), "k", "us", "id", 10_000_000, F.floor(F.col("us") / 7_000_000))
    assert sorted((r["k"], r["us"] // 1000000, r["session"]) for r in batch.collect()) == [("u", 0, 1), ("u", 5, 1), ("u", 15, 1), ("u", 30, 2), ("v", 2, 1)]
    for delivery in (rows, [("w", 1000)], [("u", 3), ("w", 1001), ("w", 5000)]):
        to_frame(delivery).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
        dropped.append(S.append_to_table(M.stream_sessions(stream, "k", "ts", "1 second", "10 seconds"), str(tmp_path / "t"), str(tmp_path / "c")))
    assert dropped == [0, 0, 1]
    closed = spark.read.parquet(str(tmp_path / "t")).select("k", F.unix_seconds("first_at"), F.unix_seconds("last_at"), "events")
    assert sorted(map(tuple, closed.collect())) == [("u", 0, 15, 3), ("u", 30, 30, 1), ("v", 2, 2, 1), ("w", 1000, 1001, 2)]


class CountedState:
    """Stands in for the states of one key; each access would be a call to another process."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def getMapState(self, *args):  # noqa: N802
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1

    def iterator(self):
        return iter(())

    def clear(self):
        self.value = None

    registerTimer = getCurrentWatermarkInMs = lambda self, *args: 0


def test_state_is_accessed_once_however_much_waits():
    n = range(0, 4000, 2)
    for processor, frame in (
        (M.Gaps(), pd.DataFrame({"sequence": n, "ms": [k + 1 for k in n]})),
        (M.Pauses(None), pd.DataFrame({"seq": n, "us": [k * 1000 + 1000 for k in n], "state": ["paused", "running"] * 1000})),
    ):
        state = CountedState()
        processor.init(state)
        out = pd.concat(processor.handleInputRows(("k",), iter([frame]), state))
        assert state.calls <= 2 and len(out) == 1
        again = pd.concat(processor.handleInputRows(("k",), iter([frame]), state))
        assert state.calls <= 4 and again.equals(out)
