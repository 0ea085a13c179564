"""Pool commits, incremental scans, attempts in waves and audits on small fixtures."""

import hashlib
import os
import re
import zipfile

from pyspark.sql import functions as F

from slotwise import session
from slotwise.operators import audit, sampling, scale
from slotwise.sources import images, sinks

POOL = "pool_id int, slot bigint, note string"


def commit(spark, path, rows, **more):
    sinks.write_pool(spark.createDataFrame(rows, POOL), str(path), ["pool_id", "slot"], **more)


def pool_rows(spark, path, last=False):
    rows = [tuple(r[c] for c in ("pool_id", "slot", "note")) for r in sinks.read_pool_table(spark, str(path), ["pool_id", "slot"], last).collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_the_first_commit_of_a_key_wins(spark, tmp_path):
    path = tmp_path / "first"
    commit(spark, path, [(1, 1, "b"), (1, 1, "a"), (1, 2, "x"), (2, 1, "y"), (None, 1, "n")])
    for _ in range(2):
        commit(spark, path, [(1, 1, "later"), (1, 3, "new"), (2, 1, "y"), (None, 1, "n")])
    assert pool_rows(spark, path) == [(1, 1, "a"), (1, 2, "x"), (1, 3, "new"), (2, 1, "y"), (None, 1, "n")]
    assert spark.read.parquet(str(path)).count() == 5


def test_the_last_commit_of_a_key_wins(spark, tmp_path):
    path = tmp_path / "last"
    commit(spark, path, [(1, 1, "a"), (1, 2, "x")], last=True)
    commit(spark, path, [(1, 1, "b"), (1, 2, "x"), (1, 1, "c")], last=True, order=["note"])
    commit(spark, path, [(1, 1, "b"), (1, 2, "x")], last=True)
    assert pool_rows(spark, path, True) == [(1, 1, "b"), (1, 2, "x")]
    assert spark.read.parquet(str(path)).count() == 3
    commit(spark, path, [(1, 1, "a")], last=True)
    assert pool_rows(spark, path, True) == [(1, 1, "a"), (1, 2, "x")]


def test_a_commit_reads_only_its_pools(spark, tmp_path, monkeypatch):
    path, plans = tmp_path / "pruned", []
    commit(spark, path, [(k, 1, "a") for k in range(20)])
    original = sinks.existing_table

    def watched(frame, where):
        stored = original(frame, where)
        plans.append(stored)
        return stored

    monkeypatch.setattr(sinks, "existing_table", watched)
    commit(spark, path, [(7, 1, "a"), (7, 2, "b")])
    scanned = plans[0].where(F.col("pool_id").isin([7])).select("slot")
    text = scanned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*pool_id", text)
    assert len({r[0] for r in scanned.select(F.input_file_name()).collect()}) == 1
    assert pool_rows(spark, path)[-1] == (19, 1, "a") and (7, 2, "b") in pool_rows(spark, path)


def test_one_row_a_key_whatever_the_order(spark):
    rows = [("p", 1, "z"), ("p", 1, "a"), ("p", 2, None), (None, 1, "q"), (None, 1, "b")]
    for part in (rows, rows[::-1]):
        frame = spark.createDataFrame(part, "pool string, slot int, note string").repartition(3)
        assert sorted(map(tuple, scale.one_per_key(frame, ["pool", "slot"]).collect()), key=repr) == sorted([("p", 1, "a"), ("p", 2, None), (None, 1, "b")], key=repr)
        assert ("p", 1, "z") in set(map(tuple, scale.one_per_key(frame, ["pool", "slot"], ["note"], last=True).collect()))


def test_a_second_scan_reads_only_what_changed(spark, tmp_path):
    root, memo = tmp_path / "assets", str(tmp_path / "memo")
    root.mkdir()
    for name, body in (("a.png", b"1"), ("b.png", b"22"), ("c.jpg", b"333"), ("note.txt", b"no image")):
        (root / name).write_bytes(body)
    scans = lambda frame: {r["logical_path"]: (r["scan"], r["content_hash"]) for r in frame.collect()}
    digest = lambda body: hashlib.sha256(body).hexdigest()
    first = scans(images.hash_images(spark, [str(root)], memo))
    assert first == {"root0/a.png": (1, digest(b"1")), "root0/b.png": (1, digest(b"22")), "root0/c.jpg": (1, digest(b"333"))}
    (root / "d.png").write_bytes(b"4")
    second = scans(images.hash_images(spark, [str(root)], memo))
    assert second == first | {"root0/d.png": (2, digest(b"4"))}
    (root / "a.png").write_bytes(b"9")
    os.utime(root / "a.png", (2_000_000_000, 2_000_000_000))
    (root / "c.jpg").unlink()
    third = scans(images.hash_images(spark, [str(root)], memo))
    assert third == {"root0/a.png": (3, digest(b"9")), "root0/b.png": first["root0/b.png"], "root0/d.png": second["root0/d.png"]}
    assert images.hash_images(spark, [str(root)], memo).agg(F.max("scan")).first()[0] == 3


def test_waves_plan_no_more_than_needed(spark):
    passes = {0: 0, 1: 2, 2: 5, 3: None}
    plan = lambda asked: asked.withColumn("ok", F.expr("attempt = case slot when 0 then 0 when 1 then 2 when 2 then 5 else -1 end"))
    slots = spark.createDataFrame([(k,) for k in passes], "slot int")
    for wave, most in ((1, 1 + 3 + 6 + 6), (4, 4 + 4 + 6 + 6)):
        winners, rejections, exhausted, planned = sampling.first_accepted_waves(slots, plan, 0, 6, wave)
        assert sorted(map(tuple, winners.collect())) == [(0, 0), (1, 2), (2, 5)]
        assert sorted(map(tuple, rejections.collect())) == [(1, 0), (1, 1)] + [(2, k) for k in range(5)] + [(3, k) for k in range(6)]
        assert [r[0] for r in exhausted.collect()] == [3] and planned == most
    none = sampling.first_accepted_waves(slots.limit(0), plan, 0, 6)
    assert none[3] == 0 and all(frame.count() == 0 for frame in none[:3])


def test_audit_of_one_sample_with_every_fault(spark):
    def frame(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    names = [("p", n) for n in audit.REQUIRED_ARTIFACTS] + [("q", n) for n in audit.REQUIRED_ARTIFACTS[1:]]
    box = "pool string, sample_id string, instance_id string, x1 int, y1 int, x2 int, y2 int, cx double, cy double, w double, h double"
    full = lambda *on: [200 if i in on else 0 for i in range(16)]
    found = audit.pool_audit(
        frame("pool string, schema_version int, contract_hash string, target int, width int, height int", ("p", 2, "h", 3, 4, 4), ("q", 2, "h", 1, 4, 4)),
        frame("pool string, status string, accepted int, contract_hash string", ("p", "complete", 2, "other"), ("q", "complete", 1, "h")),
        frame("pool string, actual_state string", ("p", "failed")),
        frame("pool string, sample_id string, image_width int, image_height int, evidence_path string, evidence_ok boolean", ("p", "s", 4, 4, "m", True), ("p", "t", None, None, None, None), ("p", "u", 5, 4, None, None)),
        frame(box, ("p", "s", "i", 0, 0, 2, 1, 0.5, 0.5, 0.5, 0.0), ("p", "s", "j", 0, 0, 5, 1, 0.5, 0.5, 0.5, 0.5), ("p", "s", "k", 0, 0, 1, 1, 0.5, 0.5, 0.5, 0.5), ("p", "t", "i", 9, 9, 1, 1, 2.0, 2.0, 2.0, 2.0)),
        frame("pool string, sample_id string, instance_id string, mask_width int, full array<int>, visible array<int>, threshold int", ("p", "s", "i", 4, full(0, 1), full(0, 1, 2), 8), ("p", "s", "j", 4, full(0), full(), 8), ("p", "s", "x", 4, full(0), full(0), 8)),
        frame("pool string, name string", *names), frame("pool string, link string", ("p", "gone.png"), ("p", "run.json")),
        read_findings=frame("pool string, code string, artifact string, detail string", ("p", "INVALID_JSONL", "samples.jsonl", "{x"), ("q", "INVALID_JSON", "run.json", None)),
    )
    assert sorted(map(tuple, found.collect())) == sorted([
        ("q", "MISSING_ARTIFACT", "run.json", "required artifact is missing: run.json"), ("p", "SAMPLE_COUNT_DRIFT", "", "counts of manifest, summary and samples differ: [3, 2, 3]"),
        ("p", "CONTRACT_HASH_DRIFT", "", "contract hashes of manifest and summary differ"), ("p", "TERMINAL_STATE_DRIFT", "", "states of control and summary differ: [failed, complete]"),
        ("p", "IMAGE_DECODE_FAILED", "t", "image cannot be decoded"), ("p", "IMAGE_DIMENSION_MISMATCH", "u", "image size differs from the manifest: [4, 4, 5, 4]"),
        ("p", "MASK_EVIDENCE_MISSING", "u", "sample lacks mask evidence"), ("p", "ANNOTATION_OUT_OF_BOUNDS", "s", "invalid box [0, 0, 5, 1]"),
        ("p", "NORMALIZED_ANNOTATION_INVALID", "s", "invalid normalized box [0.5, 0.5, 0.5, 0.0]"), ("p", "MASK_INSTANCE_DRIFT", "s", "instances of masks and annotations differ"),
        ("p", "MASK_SEMANTICS_INVALID", "i", "visible coverage exceeds full coverage"), ("p", "MASK_BBOX_MISMATCH", "i", "box of the mask [0, 0, 3, 1] differs from [0, 0, 2, 1]"),
        ("p", "MASK_EMPTY", "j", "instance has no visible coverage"), ("p", "BROKEN_QA_LINK", "gone.png", "link leads nowhere: gone.png"),
        ("p", "INVALID_JSONL", "samples.jsonl", "not a JSON record: {x"),
    ])


def test_label_archives_hold_the_files_of_all_samples(spark, tmp_path, monkeypatch):
    """Files on disk follow the text, not the number of samples; unpacked they are the same tree."""
    monkeypatch.setattr(sinks, "ARCHIVE_MEMBERS", 40)
    monkeypatch.setattr(sinks, "DIGEST_RUN", 7)
    texts = {f"{k}": "" if k % 3 == 0 else f"{k} 0.5\n" * (k % 5) for k in range(300)}
    split = lambda k: "val" if int(k) % 4 == 0 else "train"
    labels = spark.createDataFrame([(split(k), f"{k}.png", v) for k, v in texts.items()], "split string, filename string, text string").repartition(2)
    index = sinks.write_label_archives(labels, str(tmp_path / "out"), str(tmp_path / "index"))
    files = [p for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert len(files) <= 12 and {r.archive for r in index.collect()} == {str(p.relative_to(tmp_path / "out")) for p in files}
    for p in files:
        with zipfile.ZipFile(p) as archive:
            archive.extractall(tmp_path / "tree")
    tree = {str(p.relative_to(tmp_path / "tree")): p.read_text() for p in (tmp_path / "tree").rglob("*.txt")}
    assert tree == {f"labels/{split(k)}/{k}.txt": v for k, v in texts.items()}
    digests = sinks.archive_digests(spark, str(tmp_path / "out")).select(F.split("path", "[/.]")[1].alias("split"), F.split("path", "[/.]")[2].alias("key"), "digest")
    got = {r["split"]: r.md5 for r in sinks.md5_of_list(digests, "split", "key", "digest").collect()}
    for name in ("train", "val"):
        own = "".join(hashlib.md5(texts[k].encode()).hexdigest() for k in sorted(texts) if split(k) == name)
        assert got[name] == hashlib.md5(own.encode()).hexdigest()


def test_small_files_share_tasks(spark, tmp_path):
    for k in range(600):
        (tmp_path / f"{k}.png").write_bytes(b"%d" % k)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    before = files.rdd.getNumPartitions()
    with session.small_files(spark):
        assert files.select("path").rdd.getNumPartitions() < before
    assert images.hash_images(spark, [str(tmp_path)], str(tmp_path / "memo")).count() == 600


def test_every_image_is_read_once(spark, tmp_path):
    """Both results of a scan come from one stored table; names with blanks and signs are found by their hashes."""
    (tmp_path / "a b").mkdir()
    for name in ("a b/x%20y.png", "a b/c+d.png", "e.png"):
        (tmp_path / name).write_bytes(b"no image " + name.encode())
    good, bad = images.scan_images(spark, [str(tmp_path)])
    plans = [frame._jdf.queryExecution().executedPlan().toString() for frame in (good, bad)]
    assert not any("Format: image" in plan or "binaryFile" in plan or "Python" in plan for plan in plans)
    assert good.count() == 0 and bad.count() == 3
    hashes = {r.content_hash for r in images.hash_images(spark, [str(tmp_path)], str(tmp_path / "memo")).collect()}
    assert hashes == {hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.rglob("*.png")}


def test_files_are_dealt_to_all_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"{k}.txt", b"x") for k in range(400)], "path string, content binary").coalesce(1)
    assert sinks.dealt(rows).rdd.getNumPartitions() > 8
    assert sinks.write_files(rows, str(tmp_path / "out"), str(tmp_path / "index")).count() == 400
