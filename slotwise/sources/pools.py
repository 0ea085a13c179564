"""Readers of pool folders and append logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.functions.text import TEXTURE_URL_PATTERN, first_listed_url
from slotwise.schemas import SAMPLE

BAD_LINE = "_corrupt_record"
OBSERVATION_SCHEMA = 2


def read_pool(spark: SparkSession, paths: Sequence[str], schema: str = SAMPLE, name: str = "samples.jsonl") -> DataFrame:
    """Rows of one log of several pools, with the pool's place in ``paths`` and a global key.

    Each path may hold one file or a folder of part files under ``name``. Torn lines are no
    rows; ``pool_findings`` lists them.
    """
    parts = [
        spark.read.schema(f"{schema}, {BAD_LINE} string").option("columnNameOfCorruptRecord", BAD_LINE)
        .json(f"{path.rstrip('/')}/{name}").withColumn("pool_index", F.lit(i))
        for i, path in enumerate(paths)
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    return rows.withColumn("key", F.concat_ws(":", F.col("pool_index").cast("string"), F.col("sample_id")))


def pool_findings(spark: SparkSession, paths: Sequence[str], schema: str = SAMPLE, name: str = "samples.jsonl") -> DataFrame:
    """The lines of the pools' logs that are no JSON records."""
    return read_jsonl_permissive(spark, [f"{path.rstrip('/')}/{name}" for path in paths], schema)[1]


def read_jsonl_permissive(
    spark: SparkSession, paths: Sequence[str], schema: str, code: str = "INVALID_JSONL", wanted_schema: int | None = None,
    required: Sequence[str] = (), stale_code: str = "IGNORED_STALE_OBSERVATION",
) -> tuple[DataFrame, DataFrame]:
    """Good rows and findings of JSON lines; blank lines are skipped.

    A finding names the file and repeats the raw line. Rows of another schema version, or
    without a required field, are findings as well.
    """
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file")).where(
        F.length(F.trim("value")) > 0
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    parsed = lines.withColumn("r", F.from_json("value", f"{schema}, {BAD_LINE} string", options))
    broken = F.col(f"r.{BAD_LINE}").isNotNull() | F.col("r").isNull()
    stale = F.lit(False)
    if wanted_schema is not None:
        stale = ~F.col("r.schema_version").eqNullSafe(wanted_schema)
    for field in required:
        stale = stale | F.col(f"r.{field}").isNull()
    coded = parsed.withColumn("code", F.when(broken, code).when(stale, stale_code))
    rows = coded.where("code is null").select("file", "r.*").drop(BAD_LINE)
    return rows, coded.where("code is not null").select("code", "file", F.col("value").alias("raw"))


def read_manifests(
    spark: SparkSession, root: str, name: str, schema: str, pools: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """One JSON document per pool folder; unreadable and absent documents become findings.

    ``pools[pool]`` lists the folders that should exist under ``root``.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    texts = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).text(root)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    parsed = texts.select(
        F.url_decode(folder).alias("pool"), F.from_json("value", f"{schema}, {BAD_LINE} string", options).alias("r")
    )
    broken = F.col(f"r.{BAD_LINE}").isNotNull() | F.col("r").isNull()
    rows = parsed.where(~broken).select("pool", "r.*").drop(BAD_LINE)
    invalid = parsed.where(broken).select("pool", F.lit("INVALID_JSON").alias("code"), F.lit(name).alias("artifact"))
    absent = pools.join(parsed.select("pool"), "pool", "left_anti").select(
        "pool", F.lit("MISSING_ARTIFACT").alias("code"), F.lit(name).alias("artifact")
    )
    return rows, invalid.unionByName(absent)


def stream_metrics_source(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    """Tail an append-only folder of JSON lines."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def harvest_urls(
    rows: DataFrame, url: str, category: str, asset: str, limit: int, pattern: str = TEXTURE_URL_PATTERN
) -> DataFrame:
    """At most ``limit`` texture URLs per category, first assets first.

    The rank filter lets each task keep only its own first rows before the shuffle.
    """
    found = rows.select(
        F.col(category).alias("category"), F.col(asset).alias("asset_id"),
        first_listed_url(F.col(url), pattern).alias("url"),
    ).where(F.col("url").isNotNull())
    order = Window.partitionBy("category").orderBy("asset_id")
    return found.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= limit).drop("rn")
