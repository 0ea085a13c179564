"""Pool audit, resume planning and control-log checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.arrays import coverage_facts
from slotwise.operators.scale import neighbour, numbered_rows, one_per_key

# Artifacts every pool must have, control states and their legal successors.
REQUIRED_ARTIFACTS = (
    "run.json", "summary.json", "samples.jsonl", "rejections.jsonl", "metrics.jsonl", "control.json",
    "control-events.jsonl", "qa/index.html",
)
TERMINAL_STATES = ("complete", "interrupted", "failed")
OPEN_STATES = ("running", "draining", "paused", "stopping", "interrupted", "failed")
SUCCESSORS = {
    "running": ("running", "draining", "stopping", "complete", "interrupted", "failed"),
    "draining": ("draining", "paused", "stopping", "interrupted", "failed"),
    "paused": ("paused", "running", "stopping", "interrupted", "failed"),
    "stopping": ("stopping", "complete", "interrupted", "failed"),
}
RESUMED_EVENT = "resumed"
POOL_SCHEMA = 2


#: What every finding says; {} stands for its detail.
MESSAGES = {
    "MISSING_ARTIFACT": "required artifact is missing: {}", "INVALID_JSON": "not a JSON document", "INVALID_JSONL": "not a JSON record: {}",
    "SAMPLE_COUNT_DRIFT": "counts of manifest, summary and samples differ: {}", "CONTRACT_HASH_DRIFT": "contract hashes of manifest and summary differ",
    "TERMINAL_STATE_DRIFT": "states of control and summary differ: {}", "IMAGE_DECODE_FAILED": "image cannot be decoded",
    "IMAGE_DIMENSION_MISMATCH": "image size differs from the manifest: {}", "ANNOTATION_OUT_OF_BOUNDS": "invalid box {}",
    "NORMALIZED_ANNOTATION_INVALID": "invalid normalized box {}", "MASK_EVIDENCE_MISSING": "sample lacks mask evidence",
    "MASK_EVIDENCE_INVALID": "mask evidence cannot be read", "MASK_INSTANCE_DRIFT": "instances of masks and annotations differ",
    "MASK_SEMANTICS_INVALID": "visible coverage exceeds full coverage", "MASK_EMPTY": "instance has no visible coverage",
    "MASK_BBOX_MISMATCH": "box of the mask {}", "BROKEN_QA_LINK": "link leads nowhere: {}",
}
FINDING = ["pool", "code", "artifact", "message"]


def message(code: str, detail: Column | None = None) -> Column:
    """The text of a finding with its detail in place."""
    before, _, after = MESSAGES[code].partition("{}")
    return F.lit(before) if detail is None else F.concat(F.lit(before), F.coalesce(detail.cast("string"), F.lit("null")), F.lit(after))


def found(code: str, artifact: Column, detail: Column | None = None) -> Column:
    return F.struct(F.lit(code).alias("code"), artifact.cast("string").alias("artifact"), message(code, detail).alias("message"))


def listed(*values: Column) -> Column:
    """Values as [a, b, ...]."""
    return F.concat(F.lit("["), F.concat_ws(", ", *[v.cast("string") for v in values]), F.lit("]"))


def missing_artifacts(pools: DataFrame, files: DataFrame, required: Sequence[str] = REQUIRED_ARTIFACTS) -> DataFrame:
    wanted = pools.select("pool", F.explode(F.array(*[F.lit(n) for n in required])).alias("name"))
    gone = wanted.join(files, ["pool", "name"], "left_anti")
    return gone.select("pool", found("MISSING_ARTIFACT", F.col("name"), F.col("name")).alias("f")).select("pool", "f.*")


def instance_findings() -> Column:
    """Findings on one sample's annotations and masks, which lie side by side as arrays; both are few a sample."""
    sample = F.col("sample_id")
    boxed = lambda a: listed(a["x1"], a["y1"], a["x2"], a["y2"])
    inside = lambda a: (a["x1"] >= 0) & (a["x1"] < a["x2"]) & (a["x2"] <= F.col("width")) & (a["y1"] >= 0) & (a["y1"] < a["y2"]) & (a["y2"] <= F.col("height"))
    normal = lambda a: a["cx"].between(0, 1) & a["cy"].between(0, 1) & (a["w"] > 0) & (a["w"] <= 1) & (a["h"] > 0) & (a["h"] <= 1)
    wrong = lambda rule: F.filter("annotations", lambda a: ~F.coalesce(rule(a), F.lit(False)))
    outside = F.transform(wrong(inside), lambda a: found("ANNOTATION_OUT_OF_BOUNDS", sample, boxed(a)))
    abnormal = F.transform(
        wrong(normal), lambda a: found("NORMALIZED_ANNOTATION_INVALID", sample, listed(*[F.round(a[c], 6) for c in ("cx", "cy", "w", "h")]))
    )
    ids = lambda name: F.array_distinct(F.transform(name, lambda a: a["instance_id"]))
    differ = (F.size(F.array_except(ids("annotations"), ids("masks"))) > 0) | (F.size(F.array_except(ids("masks"), ids("annotations"))) > 0)
    nothing = F.filter(F.array(found("MASK_EMPTY", sample)), lambda f: F.lit(False))
    drift = F.when(differ, F.array(found("MASK_INSTANCE_DRIFT", sample))).otherwise(nothing)

    def of_pair(a: Column, m: Column) -> Column:
        same_box = m["box"].eqNullSafe(F.struct(*[a[c].cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")]))
        derived = F.concat(boxed(m["box"]), F.lit(" differs from "), boxed(a))
        of_box = F.when(m["box"].isNull(), found("MASK_EMPTY", a["instance_id"])).when(~same_box, found("MASK_BBOX_MISMATCH", a["instance_id"], derived))
        return F.array_compact(F.array(F.when(m["exceeds"], found("MASK_SEMANTICS_INVALID", a["instance_id"])), of_box))

    own = lambda a: F.filter("masks", lambda m: m["instance_id"] == a["instance_id"])
    pairs = F.flatten(F.transform("annotations", lambda a: F.flatten(F.transform(own(a), lambda m: of_pair(a, m)))))
    return F.concat(outside, abnormal, F.when(F.col("masked_sample"), F.concat(drift, pairs)).otherwise(nothing))


def pool_audit(
    runs: DataFrame,
    summary: DataFrame,
    control: DataFrame,
    samples: DataFrame,
    annotations: DataFrame,
    masks: DataFrame,
    files: DataFrame,
    links: DataFrame,
    required: Sequence[str] = REQUIRED_ARTIFACTS,
    read_findings: DataFrame | None = None,
) -> DataFrame:
    """One row per violation: pool, code, artifact, message.

    runs[pool, schema_version, contract_hash, target, width, height], summary[pool,
    status, accepted, contract_hash], control[pool, actual_state], samples[pool,
    sample_id, image_width, image_height, evidence_path, evidence_ok], annotations[pool,
    sample_id, instance_id, x1, y1, x2, y2, cx, cy, w, h], masks[pool, sample_id,
    instance_id, mask_width, full, visible, threshold], files[pool, name], links[pool, link],
    read_findings[pool, code, artifact, detail]: lines and documents that the readers refused.
    A pool that lacks an artifact reports only that. An image size of NULL means the
    image could not be decoded; such a sample is not checked further.

    Annotations and masks are dealt once, together, by sample; masks are reduced to a box and a
    flag where they are read. A sample's rules run on its row.
    """
    gone = missing_artifacts(runs, files, required)
    whole = runs.join(gone.select("pool").distinct(), "pool", "left_anti")
    base = whole.select("pool", "schema_version", "target", "contract_hash", "width", "height")

    def coded(frame: DataFrame, findings: Column) -> DataFrame:
        return frame.select("pool", F.explode(findings).alias("f")).select("pool", "f.*")

    def of_rules(*rules: tuple[Column, Column]) -> Column:
        return F.array_compact(F.array(*[F.when(test, item) for test, item in rules]))

    counted = samples.groupBy("pool").agg(F.count(F.lit(1)).alias("n"))
    state = (
        base.join(summary.withColumnRenamed("contract_hash", "summary_hash"), "pool")
        .join(counted, "pool", "left").join(control, "pool", "left").na.fill(0, ["n"])
    )
    none = F.lit("")
    drift = (F.col("accepted") != F.col("n")) | ((F.col("status") == "complete") & (F.col("target") != F.col("n")))
    of_pools = of_rules(
        (drift, found("SAMPLE_COUNT_DRIFT", none, listed(F.col("target"), F.col("accepted"), F.col("n")))),
        (~F.col("summary_hash").eqNullSafe(F.col("contract_hash")), found("CONTRACT_HASH_DRIFT", none)),
        (~F.col("actual_state").eqNullSafe(F.col("status")), found("TERMINAL_STATE_DRIFT", none, listed(F.col("actual_state"), F.col("status")))),
    )

    shot = samples.join(base.select("pool", "schema_version", "width", "height"), "pool")
    decoded = F.col("image_width").isNotNull()
    with_masks = decoded & (F.col("schema_version") == POOL_SCHEMA)
    has_path, evidence = F.col("evidence_path").isNotNull(), F.coalesce("evidence_ok", F.lit(False))
    misfit = decoded & ((F.col("image_width") != F.col("width")) | (F.col("image_height") != F.col("height")))
    sizes = listed(*[F.col(c) for c in ("width", "height", "image_width", "image_height")])
    of_samples = of_rules(
        (~decoded, found("IMAGE_DECODE_FAILED", F.col("sample_id"))),
        (misfit, found("IMAGE_DIMENSION_MISMATCH", F.col("sample_id"), sizes)),
        (with_masks & ~has_path, found("MASK_EVIDENCE_MISSING", F.col("sample_id"))),
        (with_masks & has_path & ~evidence, found("MASK_EVIDENCE_INVALID", F.col("evidence_path"))),
    )

    keys = ["pool", "sample_id"]
    facts = coverage_facts(F.col("visible"), F.col("full"), F.col("mask_width"), F.col("threshold"))
    marked = annotations.select(*keys, F.struct("instance_id", "x1", "y1", "x2", "y2", "cx", "cy", "w", "h").alias("a"))
    covered = masks.select(*keys, "instance_id", facts.alias("f")).select(*keys, F.struct("instance_id", "f.exceeds", "f.box").alias("m"))
    sides = marked.unionByName(covered, allowMissingColumns=True).groupBy(*keys)
    sides = sides.agg(F.collect_list("a").alias("annotations"), F.collect_list("m").alias("masks"))
    frames = shot.where(decoded).select(*keys, "width", "height", (with_masks & has_path & evidence).alias("masked_sample"))

    broken = links.join(base.select("pool"), "pool", "left_semi").join(
        files.withColumnRenamed("name", "link"), ["pool", "link"], "left_anti"
    )
    parts = [
        coded(state, of_pools),
        coded(shot, of_samples),
        coded(sides.join(frames, keys), instance_findings()),
        coded(broken, F.array(found("BROKEN_QA_LINK", F.col("link"), F.col("link")))),
    ]
    if read_findings is not None:
        text = F.lit(None).cast("string")
        for code in ("INVALID_JSON", "INVALID_JSONL"):
            text = F.when(F.col("code") == code, message(code, F.col("detail") if "{}" in MESSAGES[code] else None)).otherwise(text)
        parts.append(read_findings.join(base.select("pool"), "pool", "left_semi").select("pool", "code", "artifact", text.alias("message")))
    result = gone
    for part in parts:
        result = result.unionByName(part)
    return result


def journal_reconcile(log: DataFrame, journal: DataFrame, pool: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Journal rows replace the readable log of every pool that has a journal; one row per key, the first in ``order``."""
    pools = journal.select(pool).distinct()
    return one_per_key(log.join(pools, pool, "left_anti").unionByName(journal), [pool, *keys], order)


def pending_slots(runs: DataFrame, committed: DataFrame) -> DataFrame:
    """Slots below each run's target that are not committed. runs[pool, target], committed[pool, slot].

    A run is cut to chunks of slots that are spread over the tasks before they are listed, so one very large run is no
    single task.
    """
    wanted = numbered_rows(runs.select("pool", "target"), "target", "slot").select("pool", "slot")
    return wanted.join(committed.select("pool", "slot"), ["pool", "slot"], "left_anti")


def next_attempt(slots: DataFrame, rejections: DataFrame) -> DataFrame:
    """Attempt each slot continues with: one after its last rejection, or 0."""
    last = rejections.groupBy("slot").agg(F.max("attempt").alias("last"))
    return slots.join(last, "slot", "left").select("slot", F.coalesce(F.col("last") + 1, F.lit(0)).alias("next_attempt"))


def resume_compat(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Reasons why a pool cannot be resumed. Both: [pool, schema_version, contract_hash, catalog_fingerprint]."""
    joined = existing.alias("e").join(wanted.alias("w"), "pool")
    codes = F.array_compact(
        F.array(
            F.when(F.coalesce("e.schema_version", F.lit(1)) != POOL_SCHEMA, F.lit("SCHEMA_NOT_RESUMABLE")),
            F.when(~F.col("e.contract_hash").eqNullSafe(F.col("w.contract_hash")), F.lit("CONTRACT_HASH_DIFFERS")),
            F.when(
                ~F.col("e.catalog_fingerprint").eqNullSafe(F.col("w.catalog_fingerprint")), F.lit("CATALOG_FINGERPRINT_DIFFERS")
            ),
        )
    )
    return joined.select("pool", F.explode(codes).alias("code"))


def incomplete_runs(control: DataFrame, k: int = 10) -> DataFrame:
    """The k last paths whose run has not completed."""
    return control.where(F.col("actual_state").isin(*OPEN_STATES)).orderBy(F.desc("path")).limit(k)


def effective_state(actual: Column, desired: Column) -> Column:
    """Running, but asked to pause or stop, shows as draining or stopping."""
    return (
        F.when((actual == "running") & (desired == "paused"), "draining")
        .when((actual == "running") & (desired == "stopping"), "stopping")
        .otherwise(actual)
    )


def control_log_audit(events: DataFrame, bucket: Column) -> DataFrame:
    """Gaps, illegal transitions and events after the end of a run.

    events[run, seq, event, state]; ``bucket`` must follow ``seq``.
    """
    stepped = neighbour(events, ["run"], bucket, ["seq"], F.struct("seq", "state"), "prev").where("prev is not null")
    before, now = F.col("prev.state"), F.col("state")
    legal = F.lit(False)
    for name, following in SUCCESSORS.items():
        legal = legal | ((before == name) & now.isin(*following))
    resumed = (F.col("event") == RESUMED_EVENT) & (now == "running")
    ended = before.isin(*TERMINAL_STATES)
    codes = F.array_compact(
        F.array(
            F.when(F.col("seq") != F.col("prev.seq") + 1, F.lit("SEQUENCE_GAP")),
            F.when(ended & ~resumed, F.lit("EVENT_AFTER_TERMINAL")),
            F.when(~ended & ~resumed & ~legal, F.lit("ILLEGAL_TRANSITION")),
        )
    )
    return stepped.select("run", "seq", F.explode(codes).alias("code"))
