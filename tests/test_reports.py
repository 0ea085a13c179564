"""Known small inputs with known results."""

import json
import zlib
import struct

from pyspark.sql import functions as F

from slotwise.functions import arrays as A
from slotwise.functions import geometry as G
from slotwise.functions import text as X
from slotwise.operators import audit, catalog, compare, coverage, experiments, export, placement, preflight, telemetry
from slotwise.sources import images, pools, sinks


def test_two_attempts_one_rejection(spark):
    samples = spark.createDataFrame(
        [({"scene_render": 40}, {"blend": 30}, True)], "stage_timings_ns map<string,bigint>, node_timings_ns map<string,bigint>, in_session boolean"
    )
    rejections = spark.createDataFrame(
        [("BackgroundSynthesisError", {"background_synthesis": 20}, True)], "reason string, stage_timings_ns map<string,bigint>, in_session boolean"
    )
    summary = {r["stage"]: r for r in telemetry.stage_summary(telemetry.stage_explode(samples, rejections)).collect()}
    assert summary["background.node.blend"]["p95_ns"] == 30 and set(summary) == {"scene_render", "background.node.blend", "background_synthesis"}
    cost = telemetry.rejection_costs(rejections).collect()[0]
    assert (cost["reason"], cost["n"], cost["cost_ns"]) == ("BackgroundSynthesisError", 1, 20)
    weights = spark.createDataFrame([("direct", 1.0), ("mix", 3.0)], "recipe string, weight double")
    mix = telemetry.mix_configured_observed(spark.createDataFrame([("mix",)], "recipe string"), "recipe", weights, 0.0)
    rows = {r["recipe"]: r for r in mix.collect()}
    assert rows["mix"]["configured_fraction"] == 0.75 and rows["mix"]["observed_fraction"] == 1.0
    assert rows["direct"]["observed_count"] == 0
    none = telemetry.mix_configured_observed(spark.createDataFrame([("g",)], "recipe string"), "recipe", weights.limit(0), None)
    assert none.collect()[0]["configured_fraction"] is None


def attempt_rows(spark):
    return spark.createDataFrame(
        [("root0/dial.png", "dial", 0.21, 37.0, 2, "top-left", True), ("root0/dial.png", "dial", 0.25, -37.0, 2, "top-left", False)],
        "source_asset string, class_name string, scale double, rotation double, requested_objects int, region string, rejected boolean",
    )


def test_rates_have_explicit_denominators(spark):
    rows = {(r["dimension"], r["value"]): r for r in telemetry.conditional_rates(attempt_rows(spark)).collect()}
    assert rows[("scale_band", "0.20-0.30")]["rejections"] == 1
    assert rows[("rotation_band", "30-45")]["attempts"] == 2
    assert rows[("asset", "root0/dial.png")]["rate"] == 0.5


def test_pause_is_not_active_time(spark):
    us = 1_000_000
    events = spark.createDataFrame([(1, 0, 10 * us, "running"), (1, 1, 12 * us, "paused"), (1, 2, 22 * us, "running")], "run int, seq int, us bigint, state string")
    progress = spark.createDataFrame([(1, 10 * us, 24 * us, 3, 2, 4)], "run int, start_us bigint, end_us bigint, accepted int, baseline_accepted int, target int")
    for width in (1, 10):
        row = telemetry.active_time_eta(events, progress, F.floor(F.col("seq") / width)).collect()[0]
        assert (row["wall_seconds"], row["paused_seconds"], row["active_seconds"]) == (14.0, 10.0, 4.0)
        assert row["throughput"] == 0.25 and row["eta_seconds"] == 4.0
    open_pause = telemetry.paused_time(events.where("seq < 2"), progress, F.lit(0)).collect()[0]
    assert open_pause["paused_us"] == 12 * us


def test_resource_peaks_and_drops(spark):
    rows = spark.createDataFrame(
        [("one", 0, 0, 120.0, 1024, None, None), ("one", 1, 1, 80.0, 2048, None, None), ("one", 2, 2, None, None, "RESOURCE_SAMPLES_DROPPED", 4), ("one", 3, 3, None, None, "RESOURCE_SAMPLE_FAILED", None)],
        "session_id string, sequence int, ingested_at int, cpu_percent double, rss_bytes bigint, code string, dropped_samples int",
    )
    r = telemetry.resource_rollup(rows, ("session_id",), ("cpu_percent", "rss_bytes")).collect()[0]
    assert (r["peak_cpu_percent"], r["latest_cpu_percent"], r["peak_rss_bytes"]) == (120.0, 80.0, 2048)
    assert (r["samples"], r["dropped_samples"], r["sample_errors"]) == (2, 4, 1)


def test_histogram_is_bounded_and_clamped(spark):
    points = spark.createDataFrame([(0.05, 0.05), (0.09, 0.06), (0.99, 0.99)], "x double, y double")
    cells = placement.spatial_histogram(points, F.col("x"), F.col("y"), 4).collect()
    assert len(cells) == 16 and sum(r["n"] for r in cells) == 3
    outside = spark.createDataFrame([(-1.0, -1.0), (0.5, 0.5), (2.0, 2.0)], "x double, y double")
    got = {r["bin"]: r["n"] for r in placement.spatial_histogram(outside, F.col("x"), F.col("y"), 3).collect()}
    assert (got[0], got[4], got[8]) == (1, 1, 1)


def test_touching_boxes_do_not_meet(spark):
    row = spark.range(1).select(
        G.intersects(G.box(0, 0, 10, 10), G.box(10, 0, 20, 10)).alias("touch"), G.intersects(G.box(0, 0, 10, 10), G.box(9, 9, 20, 20)).alias("meet"),
        G.clip(G.box(-5, -5, 0, 3), 100, 100).alias("none"), G.clipped_sides(G.box(-1, 0, 101, 100), 100, 100).alias("sides"),
    ).collect()[0]
    assert (row["touch"], row["meet"], row["none"], row["sides"]) == (False, True, None, ["left", "right"])


def test_name_rules(spark):
    rows = [
        ("hexagono_3", "numeros", "hexagono_3"), ("hexagono_gabarito_3", "gabaritos", "hexagono_gabarito"),
        ("hexagono_gabarito_12", "Gabaritos_b", "hexagono_gabarito"),
    ]
    frame = spark.createDataFrame(rows, "stem string, grp string, want string")
    assert frame.where(X.numbered_class(F.col("stem"), F.col("grp")) != F.col("want")).count() == 0
    gauges = spark.createDataFrame([("manometer_59_5", "40-60", "40-60", 40.0), ("manometer_20_0", None, "20.0", 20.0), ("dial", None, "dial", 1e9)], "stem string, grp string, want string, k double")
    out = gauges.select("want", "k", X.reading_class(F.col("stem"), F.col("grp")).alias("c")).withColumn("key", X.range_sort_key(F.col("c")))
    assert out.where("c <> want or key <> k").count() == 0


def test_links_and_texture_urls(spark):
    html = '<a href="/a">x</a><img src=\'pic.png\'><a href="#top"><a href="https://x/y"><a href="data:1"><A HREF="b.html">'
    page = spark.createDataFrame([(1, html)], "page int, html string")
    known = spark.createDataFrame([("/a",)], "link string")
    assert sorted(r["link"] for r in catalog.local_links(page, "page", "html", known).collect()) == ["b.html", "pic.png"]
    url = spark.createDataFrame([("https://v/#x=1&texture_url=https%3A%2F%2Fa%2Fc.jpg%2Chttps%3A%2F%2Fb&y=2",), ("https://v/#none",)], "u string")
    assert [r[0] for r in url.select(X.texture_url(F.col("u"))).collect()] == ["https://a/c.jpg", None]


def test_planted_hash_copies(spark):
    base = 0x123456789ABCDEF
    rows = [(base,), (base,), (base ^ (1 << 63) if base < 0 else base ^ (1 << 5),), (base ^ 0b11000000,)]
    got = catalog.near_duplicate_hashes(spark.createDataFrame(rows, "bits bigint"), "bits").collect()
    assert [(r["similarity"], r["left_n"] + r["right_n"]) for r in got] == [(1 - 1 / 64, 3)]
    negative = catalog.near_duplicate_hashes(spark.createDataFrame([(7,), (7 - 2**63,)], "bits bigint"), "bits").collect()
    assert len(negative) == 1


def test_fingerprint_ignores_order_but_not_copies(spark):
    rows = [("a", "1"), ("b", "2"), ("b", "2")]
    one = catalog.catalog_fingerprint(spark.createDataFrame(rows, "p string, h string"), ["p", "h"]).collect()[0]
    two = catalog.catalog_fingerprint(spark.createDataFrame(rows[::-1], "p string, h string").repartition(3), ["p", "h"]).collect()[0]
    three = catalog.catalog_fingerprint(spark.createDataFrame(rows[:2], "p string, h string"), ["p", "h"]).collect()[0]
    assert one == two and one["fingerprint"] != three["fingerprint"]


def test_nested_overrides_are_flattened(spark):
    docs = spark.createDataFrame([(1, '{"a":{"b":1,"c":{"d":"x"}},"e":true}')], "config int, doc string")
    got = {r["path"]: r["value"] for r in catalog.flatten_overrides(docs, "doc").collect()}
    assert got == {"a.b": "1", "a.c.d": "x", "e": "true"}


def test_overrides_of_any_depth_are_flattened(spark):
    deep = [(n, "".join(f'{{"k{i}":' for i in range(n)) + "1" + "}" * n) for n in (7, 9, 12)]
    got = catalog.flatten_overrides(spark.createDataFrame(deep, "config int, doc string"), "doc").collect()
    assert {r["config"]: r["path"].count(".") + 1 for r in got} == {7: 7, 9: 9, 12: 12}


def test_masks_square_and_ring(spark):
    square = [255 if 2 <= i % 8 < 6 and 2 <= i // 8 < 6 else 0 for i in range(64)]
    wide = [255 if 1 <= i % 8 < 7 and 1 <= i // 8 < 7 else 0 for i in range(64)]
    ring = [0 if 3 <= i % 8 < 5 and 3 <= i // 8 < 5 else v for i, v in enumerate(wide)]
    frame = spark.createDataFrame([("s", 0, wide), ("s", 1, square)], "sample string, o int, full array<int>")
    rows = {r["o"]: r for r in coverage.visible_coverage(frame, "sample", "o", "full").collect()}
    assert rows[1]["visible"] == square
    assert rows[0]["visible"] == [w if not s else 0 for w, s in zip(wide, square)]
    row = spark.createDataFrame([(wide, ring, [0] * 64)], "a array<int>, b array<int>, z array<int>").select(
        A.coverage_bbox(F.col("a"), F.lit(8), 8).alias("box"), A.mask_iou(F.col("a"), F.col("b")).alias("m"),
        A.mask_iou(F.col("z"), F.col("z")).alias("e"), A.coverage_bbox(F.col("z"), F.lit(8), 8).alias("none"),
    ).collect()[0]
    assert tuple(row["box"]) == (1, 1, 7, 7) and row["none"] is None
    assert (row["m"]["iou"], row["e"]["iou"]) == (32 / 36, 1.0)


def test_flat_values_and_gates(spark):
    flat = spark.createDataFrame([("g", 3.0), ("g", 3.0)], "g string, v double")
    assert {r["normalized"] for r in coverage.robust_normalize(flat, "g", "v", 5, 95).collect()} == {0.5}
    gate = spark.createDataFrame([([0.5] * 64,), ([0.0] * 63 + [1.0],), ([float("nan")] + [0.1] * 63,)], "v array<double>").select(A.array_qa_gate(F.col("v")).alias("g"))
    assert [r["g"]["reject"] for r in gate.collect()] == ["near_constant", "severely_clipped", "non_finite"]


def test_balanced_order_rotates_and_reverses(spark):
    names = ("a", "b", "c")
    got = {}
    for r in experiments.balanced_order(spark.range(6).withColumnRenamed("id", "f"), "f", names).collect():
        got.setdefault(r["f"], {})[r["order_index"]] = r["treatment"]
    for f in range(6):
        order = names[f % 3 :] + names[: f % 3]
        want = order[::-1] if (f // 3) % 2 else order
        assert tuple(got[f][i] for i in range(3)) == want


def test_compare_counts_and_timings(spark):
    left = spark.createDataFrame([("a", 2), ("b", 3)], "k string, n int")
    right = spark.createDataFrame([("a", 4), ("c", 1)], "k string, n int")
    rows = {r["k"]: r for r in compare.count_changes(left, right, ["k"], "n").collect()}
    assert (rows["a"]["ratio"], rows["c"]["ratio"], rows["b"]["delta"]) == (2.0, None, -3.0)
    timed = {r["k"]: r for r in compare.timing_regressions(left, right, ["k"], "n").collect()}
    assert timed["b"]["right"] is None and timed["b"]["delta"] is None


def test_name_collisions_and_class_remap(spark):
    runs = spark.createDataFrame([(0, ["class-a", "x"]), (1, ["x", "class-b"])], "pool_index int, classes array<string>")
    ids = {r["class_name"]: r["class_id"] for r in export.merge_class_catalog(runs).collect()}
    assert ids == {"class-a": 0, "x": 1, "class-b": 2}
    named = spark.createDataFrame([("0:same", 0, "same.png"), ("1:same", 1, "same.png"), ("1:tame", 1, "same.png")], "key string, pool_index int, name string")
    names = {r["key"]: r["filename"] for r in export.allocate_filenames(named, True).collect()}
    assert names == {"0:same": "same.png", "1:same": "same_pool1.png", "1:tame": "same_pool1_2.png"}
    plain = {r["key"]: r["filename"] for r in export.allocate_filenames(named, False).collect()}
    assert plain["1:tame"] == "image_00000002.png"


def test_observation_tiers(spark):
    jobs = spark.createDataFrame(
        [(1, "f", "e", 2, 10, 1280, 1280, "p", "landing"), (2, "f", "e", 3, 10, 1280, 1280, "p", "landing"), (3, "none", "e", 1, 10, 1280, 1280, "builtin:appearance/current-fast", "landing"), (4, "f", "elsewhere", 2, 10, 1280, 1280, "p", "landing")],
        "job int, fingerprint string, environment string, workers int, num_images int, width int, height int, profile string, family string",
    )
    rows = [("f", "e", 2, "production", s) for s in (1.0, 2.0, 9.0)] + [("f", "other", 2, "production", 500.0), (None, "e", 2, "production", 1.0)]
    seen = spark.createDataFrame(rows, "fingerprint string, environment string, workers int, kind string, seconds double")
    matched = preflight.match_observations(jobs, seen)
    rows = {r["job"]: r for r in preflight.runtime_estimate(matched).collect()}
    assert [rows[i]["confidence"] for i in (1, 2, 3)] == ["local-production", "local-production-cross-worker", "medium"]
    assert rows[1]["seconds_per_candidate"] == 2.0 and rows[3]["seconds_per_candidate"] == 1.006
    assert rows[1]["expected_seconds"] == round(2.0 * 10 / (2 * 0.82), 3)
    assert {r["job"]: r["tier"] for r in matched.collect()} == {1: "exact", 2: "cross-worker", 3: "none", 4: "none"}
    codes = {(r["job"], r["code"]) for r in preflight.observation_warnings(matched).collect()}
    assert codes == {(1, "LOCAL_OBSERVATION_OUT_OF_RANGE"), (2, "LOCAL_OBSERVATION_OUT_OF_RANGE"), (2, "LOCAL_OBSERVATION_CROSS_WORKER")}


def test_journal_repairs_lost_rows(spark):
    log = spark.createDataFrame([("p", 0), ("q", 0), ("q", 0)], "pool string, slot int")
    journal = spark.createDataFrame([("p", 0), ("p", 1)], "pool string, slot int")
    rows = sorted(map(tuple, audit.journal_reconcile(log, journal, "pool", ["slot"]).collect()))
    assert rows == [("p", 0), ("p", 1), ("q", 0)]


def test_control_states(spark):
    rows = spark.createDataFrame([("running", "paused"), ("running", "stopping"), ("paused", "running")], "a string, d string")
    assert [r[0] for r in rows.select(audit.effective_state(F.col("a"), F.col("d"))).collect()] == ["draining", "stopping", "paused"]
    log = spark.createDataFrame([(1, 0, "created", "running"), (1, 1, "complete", "complete"), (1, 2, "resumed", "running"), (1, 4, "paused", "paused")], "run int, seq int, event string, state string")
    codes = sorted((r["seq"], r["code"]) for r in audit.control_log_audit(log, F.floor(F.col("seq") / 2)).collect())
    assert codes == [(4, "ILLEGAL_TRANSITION"), (4, "SEQUENCE_GAP")]


def png(width, height, pixel):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = b"".join(b"\0" + bytes(c for x in range(width) for c in pixel(x, y)) for y in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_image_scan(spark, tmp_path):
    root = tmp_path / "assets"
    (root / "g1").mkdir(parents=True)
    (root / "g1" / "a.png").write_bytes(png(16, 8, lambda x, y: (255, 255, 255) if x >= 8 else (0, 0, 0)))
    (root / "b.PNG").write_bytes(b"broken")
    (root / "photo.webp").write_bytes(b"RIFF0000WEBP")
    (root / "note.txt").write_text("no image")
    good, bad = images.scan_images(spark, [str(root)])
    row = good.collect()[0]
    assert (row["logical_path"], row["width"], row["height"], row["mode"]) == ("root0/g1/a.png", 16, 8, "RGB")
    assert row["perceptual_hash"] == "0f" * 8
    assert sorted(r["logical_path"] for r in bad.collect()) == ["root0/b.PNG", "root0/photo.webp"]


def test_malformed_lines_become_findings(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"schema_version":2,"kind":"probe"}\n\n{broken\n{"schema_version":1,"kind":"probe"}\n')
    rows, findings = pools.read_jsonl_permissive(spark, [str(path)], "schema_version int, kind string", wanted_schema=2)
    assert rows.count() == 1
    assert sorted((r["code"], r["raw"][:7]) for r in findings.collect()) == [("IGNORED_STALE_OBSERVATION", '{"schem'), ("INVALID_JSONL", "{broken")]


def test_manifests_and_label_files(spark, tmp_path):
    for pool, body in (("p one", json.dumps({"contract_hash": "h"})), ("q", "{")):
        (tmp_path / "pools" / pool).mkdir(parents=True)
        (tmp_path / "pools" / pool / "run.json").write_text(body)
    listed = spark.createDataFrame([("p one",), ("q",), ("r",)], "pool string")
    rows, findings = pools.read_manifests(spark, str(tmp_path / "pools"), "run.json", "contract_hash string", listed)
    assert [tuple(r) for r in rows.collect()] == [("p one", "h")]
    assert sorted((r["pool"], r["code"]) for r in findings.collect()) == [("q", "INVALID_JSON"), ("r", "MISSING_ARTIFACT")]
    labels = spark.createDataFrame([("train", "a.png", "0 1\n"), ("val", "b.png", "")], "split string, filename string, text string")
    index = sinks.write_label_files(labels, str(tmp_path / "out"), str(tmp_path / "index"))
    assert index.count() == 2
    assert (tmp_path / "out/labels/train/a.txt").read_text() == "0 1\n" and (tmp_path / "out/labels/val/b.txt").read_text() == ""


def test_links_of_every_attribute_outside_comments(spark):
    html = (
        '<a href="x.html" src="y.png" title="a href=no.html"> <img src=z.png> <!-- <a href="c.html"> --> '
        "<script src='s.js'>var a = '<a href=\"n.html\">'</script><a HREF = 'q.html'><a href='#top'><a href=http://far/>"
    )
    row = spark.createDataFrame([(html,)], "html string").select(X.local_link_values(F.col("html")).alias("v")).first()
    assert row.v == ["x.html", "y.png", "z.png", "s.js", "q.html"]


def test_torn_lines_are_findings_not_rows(spark, tmp_path):
    (tmp_path / "samples.jsonl").write_text('{"slot": 1, "sample_id": "a"}\n{"slot": 2, "sam\n\n{"slot": 3, "sample_id": "b"}\n')
    rows = pools.read_pool(spark, [str(tmp_path)])
    assert sorted((r.slot, r.key) for r in rows.collect()) == [(1, "0:a"), (3, "0:b")]
    assert [r.raw for r in pools.pool_findings(spark, [str(tmp_path)]).collect()] == ['{"slot": 2, "sam']


def test_coverage_facts_equal_the_folds(spark):
    """Whole batches give what the folds give, also for missing, short and empty arrays; the plan has no fold."""
    rows = [([0, 9, 0, 9], [0, 9, 0, 8], 2, 5), ([0, 0], [1], 2, 5), ([], [], 2, 0), (None, [1], 2, 0), ([7, None, 7], [9, 0, 9], 3, 1), ([1, 2, 3, 4, 5, 6], [9, 1], 3, 4)]
    frame = spark.createDataFrame(rows, "v array<int>, f array<int>, w int, t int").coalesce(1)
    facts = frame.select(A.coverage_facts(F.col("v"), F.col("f"), F.col("w"), F.col("t")).alias("r"))
    folds = frame.select(
        F.coalesce(F.exists(F.arrays_zip(F.col("v"), F.col("f")), lambda p: p["v"] > p["f"]), F.lit(False)).alias("exceeds"),
        A.coverage_bbox(F.col("v"), F.col("w"), F.col("t")).alias("box"),
    )
    assert facts.select("r.*").collect() == folds.collect()
    assert "aggregate" not in facts._jdf.queryExecution().executedPlan().toString()
