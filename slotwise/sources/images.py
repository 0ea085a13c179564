"""Image discovery and inspection."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from slotwise.session import small_files, written
from slotwise.sources.sinks import dealt, file_uri

# Fixed value: file extensions that count as images.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "webp")
#: The same for readers, which take upper and lower case apart.
IMAGE_GLOB = "*.{" + ",".join("".join(f"[{c}{c.upper()}]" for c in name) for name in IMAGE_EXTENSIONS) + "}"


def list_images(spark: SparkSession, roots: Sequence[str], recursive: bool = True) -> DataFrame:
    """Files with an image extension: path, stable logical path, length and time; no content is read."""
    parts = []
    for index, root in enumerate(roots):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
        relative = F.substring_index("path", f"{root.rstrip('/')}/", -1)
        parts.append(
            files.select(
                "path", F.concat(F.lit(f"root{index}/"), F.url_decode(relative)).alias("logical_path"), "length", "modificationTime"
            )
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.where(F.lower("path").rlike(r"\.(" + "|".join(IMAGE_EXTENSIONS) + r")$"))


MEMO = "path string, length bigint, modificationTime timestamp, content_hash string, scan int"
FILE_KEY = ["path", "length", "modificationTime"]
READ_BLOCK = 1 << 20


def content_hashes(files: DataFrame, roots: Sequence[str]) -> DataFrame:
    """SHA-256 of listed files, read block by block where their names were dealt to; one that is gone or has another length is left out."""
    bases = [file_uri(root.rstrip("/")) for root in roots]

    def read(batches):
        import hashlib
        from urllib.parse import unquote

        from pyarrow import fs

        systems = [fs.FileSystem.from_uri(base) for base in bases]

        def digest(path: str, logical: str) -> tuple[str | None, int]:
            number = int(logical[4 : logical.index("/")])
            system, folder = systems[number]
            name = path.split(f"{roots[number].rstrip('/')}/")[-1]
            for target in dict.fromkeys((f"{folder}/{name}", f"{folder}/{unquote(name)}")):
                try:
                    with system.open_input_stream(target) as stream:
                        state, size = hashlib.sha256(), 0
                        while block := stream.read(READ_BLOCK):
                            state.update(block)
                            size += len(block)
                        return state.hexdigest(), size
                except FileNotFoundError:
                    continue
            return None, -1

        for pdf in batches:
            found = [digest(path, logical) for path, logical in zip(pdf["path"], pdf["logical_path"])]
            pdf["content_hash"] = [text for text, _ in found]
            yield pdf.loc[[size == length for (_, size), length in zip(found, pdf["length"])], [*FILE_KEY, "content_hash"]]

    return dealt(files.select(*FILE_KEY, "logical_path")).mapInPandas(read, MEMO.removesuffix(", scan int"))


def hash_images(spark: SparkSession, roots: Sequence[str], memo: str, recursive: bool = True) -> DataFrame:
    """Content hash of every image below ``roots``; a file is read again only when its length or time has changed.

    The memo is a table of path, length, time and hash with the number of the scan that read the file. The listing is written
    once and joined with the memo before any content is read; the tasks open the new files themselves.
    """
    with small_files(spark):
        listed = written(list_images(spark, roots, recursive).dropDuplicates(["path"]), "listing")
    try:
        known = spark.read.schema(MEMO).parquet(memo)
        scan = 1 + (known.agg(F.max("scan")).first()[0] or 0)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        known, scan = spark.createDataFrame([], MEMO), 1
    fresh = listed.join(known.select(*FILE_KEY), FILE_KEY, "left_anti")
    content_hashes(fresh, roots).withColumn("scan", F.lit(scan)).write.mode("append").parquet(memo)
    return listed.join(spark.read.schema(MEMO).parquet(memo), FILE_KEY).drop("modificationTime")


def area_mean_hash(batches):
    """16-hex average hash of decoded images: 8x8 area means of the luma, first cell most significant."""
    from functools import lru_cache

    import numpy as np
    import pandas as pd

    @lru_cache(64)
    def weights(size: int) -> np.ndarray:
        edges = np.linspace(0, size, 9)
        cells = np.arange(size)
        cover = np.minimum(edges[1:, None], cells + 1) - np.maximum(edges[:-1, None], cells)
        return np.clip(cover, 0, None) / (size / 8)

    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            if row.data is None or row.height < 1:
                out.append(None)
                continue
            pixels = np.frombuffer(row.data, dtype=np.uint8).reshape(row.height, row.width, row.channels).astype(np.float64)
            gray = pixels[:, :, 0] if row.channels == 1 else pixels[:, :, :3] @ np.array([0.114, 0.587, 0.299])
            small = weights(row.height) @ gray @ weights(row.width).T
            bits = (np.round(small, 9) >= np.round(small.mean(), 9)).reshape(-1)
            out.append(f"{int(''.join('1' if b else '0' for b in bits), 2):016x}")
        yield pd.DataFrame(
            {
                "path": pdf["path"], "width": pdf["width"], "height": pdf["height"], "channels": pdf["channels"],
                "perceptual_hash": pd.Series(out, dtype=object),
            }
        )


def scan_images(spark: SparkSession, roots: Sequence[str], recursive: bool = True) -> tuple[DataFrame, DataFrame]:
    """Width, height, mode and perceptual hash of every image, and findings on undecodable ones.

    Decoding is the image source of Spark (no webp), which also lists what it cannot decode; the hash is a small batch
    function on the decoded bytes. Every file is read once and its row written; both results are parts of that table.
    """
    parts = []
    for index, root in enumerate(roots):
        source = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", recursive)
        # This source writes the scheme of a path with other slashes than roots have.
        bare = re.sub("^[a-z0-9]+:/+", "/", root.rstrip("/"))
        relative = F.substring_index(F.regexp_replace("image.origin", "^[a-z0-9]+:/+", "/"), f"{bare}/", -1)
        parts.append(
            source.option("pathGlobFilter", IMAGE_GLOB).load(root).select(
                F.concat(F.lit(f"root{index}/"), F.url_decode(relative)).alias("path"), "image.width", "image.height",
                F.col("image.nChannels").alias("channels"), "image.data",
            )
        )
    images = reduce(DataFrame.unionByName, parts)
    with small_files(spark):
        rows = written(images.mapInPandas(area_mean_hash, "path string, width int, height int, channels int, perceptual_hash string"), "images")
    rows = rows.withColumnRenamed("path", "logical_path")
    decoded = F.coalesce(F.col("height") > 0, F.lit(False))
    mode = F.when(F.col("channels") == 1, "L").when(F.col("channels") == 3, "RGB").otherwise("RGBA")
    good = rows.where(decoded).select("logical_path", "width", "height", mode.alias("mode"), "perceptual_hash")
    bad = rows.where(~decoded).select(F.lit("IMAGE_DECODE_FAILED").alias("code"), "logical_path")
    return good, bad
