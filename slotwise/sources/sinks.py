"""Writers: pools, label files and manifests."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from slotwise.operators.scale import join_null_safe, one_per_key
from slotwise.session import settle


def existing_table(frame: DataFrame, path: str) -> DataFrame | None:
    """The table already stored under ``path``, or None."""
    try:
        return frame.sparkSession.read.schema(frame.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


#: Pools of one commit that are looked up by name, so that only their folders are read.
NAMED_POOLS = 1000
COMMIT = "commit"


def write_pool(rows: DataFrame, path: str, keys: Sequence[str], partition: str = "pool_id", order: Sequence[str] = (), last: bool = False) -> None:
    """Commit rows to a table with one folder a pool; repeating a commit changes nothing.

    Within a commit the first row of a key in ``order`` wins. Between commits the first one wins: only keys that are not
    stored yet are appended. With ``last`` the last commit wins: rows that differ from the stored winner are appended with
    a higher commit number, and ``read_pool_table`` returns the newest. Only the folders of the commit's pools are read.
    """
    fresh = settle(one_per_key(rows, keys, order))
    stored = existing_table(fresh.withColumn(COMMIT, F.lit(0).cast("bigint")), path)
    number = 1
    if stored is not None:
        named = [r[0] for r in fresh.select(partition).distinct().limit(NAMED_POOLS + 1).collect()]
        if len(named) <= NAMED_POOLS:
            known = [name for name in named if name is not None]
            stored = stored.where(F.col(partition).isin(known) | (F.col(partition).isNull() if len(known) < len(named) else F.lit(False)))
        number += stored.agg(F.max(COMMIT)).first()[0] or 0
        if last:
            fresh = fresh.subtract(winners(stored, keys, True).select(*fresh.columns))
        else:
            fresh = join_null_safe(fresh, stored.select(*keys), list(keys), "left_anti")
    fresh.withColumn(COMMIT, F.lit(number).cast("bigint")).write.partitionBy(partition).mode("append").parquet(path)


def winners(stored: DataFrame, keys: Sequence[str], last: bool) -> DataFrame:
    """One stored row a key: of the newest commit, or of the oldest."""
    return one_per_key(stored, keys, [COMMIT], last)


def read_pool_table(spark: SparkSession, path: str, keys: Sequence[str], last: bool = False) -> DataFrame:
    """The winning row of every key without its commit number."""
    return winners(spark.read.parquet(path), keys, last).drop(COMMIT)


def file_uri(root: str) -> str:
    return re.sub(r"^file:/+", "file:///", root) if ":" in root else f"file://{root}"


#: Tasks a core that files are dealt to.
FILE_TASKS = 4


def dealt(files: DataFrame) -> DataFrame:
    """Files spread by path: their number decides the work, while their rows are few bytes that Spark would put in one task."""
    return files.repartition(FILE_TASKS * files.sparkSession.sparkContext.defaultParallelism, "path")


def write_files(rows: DataFrame, root: str, index: str) -> DataFrame:
    """Write one file per row [path, content] below ``root`` from the executors.

    Contents are a function of the row and names are final, so a repeated task writes the
    same file again. The list of written files is stored as a table under ``index``.
    """
    base = file_uri(root)

    def write(batches):
        import pandas as pd
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(base)
        made = set()
        for pdf in batches:
            sizes = []
            for path, content in zip(pdf["path"], pdf["content"]):
                target = f"{folder}/{path}"
                parent = target.rsplit("/", 1)[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(target) as stream:
                    stream.write(bytes(content))
                sizes.append(len(content))
            yield pd.DataFrame({"path": pdf["path"], "bytes": sizes})

    listed = dealt(rows).select("path", F.col("content").cast("binary").alias("content")).mapInPandas(write, "path string, bytes bigint")
    listed.write.mode("overwrite").parquet(index)
    return rows.sparkSession.read.parquet(index)


def write_label_files(rows: DataFrame, root: str, index: str) -> DataFrame:
    """One text file per sample under labels/<split>; negatives get an empty file.

    rows[split, filename, text].
    """
    return write_files(label_paths(rows), root, index)


def label_paths(rows: DataFrame) -> DataFrame:
    stem = F.regexp_replace("filename", r"\.[^.]*$", "")
    path = F.concat(F.lit("labels/"), "split", F.lit("/"), stem, F.lit(".txt"))
    return rows.select("split", path.alias("path"), F.col("text").alias("content"))


#: Members and bytes of text of one archive.
ARCHIVE_MEMBERS, ARCHIVE_BYTES = 10_000, 8 << 20


def write_label_archives(rows: DataFrame, root: str, index: str) -> DataFrame:
    """The label files of ``write_label_files`` as members of archives: labels/<split>/part-<task>-<number>.zip.

    rows[split, filename, text]. A file system keeps a block for every small file; an archive keeps the text. Unpacked in one
    folder the archives give the same tree, negatives as empty files. An archive holds at most ``ARCHIVE_MEMBERS`` files, so
    neither writer nor reader holds more. A repeated task writes its archives again; each gets its name when it is whole.
    The table under ``index`` lists path, bytes and archive of every member.
    """
    base = file_uri(root)

    def write(batches):
        import io
        import uuid
        import zipfile

        import pandas as pd
        from pyarrow import fs
        from pyspark import TaskContext

        system, folder = fs.FileSystem.from_uri(base)
        task, made, held = TaskContext.get().partitionId(), {}, {}

        def close(split):
            members, _ = held.pop(split)
            made[split] = made.get(split, -1) + 1
            name = f"labels/{split}/part-{task:05d}-{made[split]:05d}.zip"
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w") as archive:
                for path, content in members:
                    archive.writestr(zipfile.ZipInfo(path), content)
            if not made[split]:
                system.create_dir(f"{folder}/labels/{split}", recursive=True)
            hidden = f"{folder}/labels/{split}/_{uuid.uuid4().hex}"
            with system.open_output_stream(hidden) as stream:
                stream.write(buffer.getvalue())
            system.move(hidden, f"{folder}/{name}")
            return pd.DataFrame({"path": [p for p, _ in members], "bytes": [len(c) for _, c in members], "archive": name})

        for pdf in batches:
            for split, path, content in zip(pdf["split"], pdf["path"], pdf["content"]):
                members, size = held.get(split, ([], 0))
                members.append((path, bytes(content)))
                held[split] = members, size + len(content)
                if len(members) >= ARCHIVE_MEMBERS or held[split][1] >= ARCHIVE_BYTES:
                    yield close(split)
        for split in list(held):
            yield close(split)

    contents = label_paths(rows).select("split", "path", F.col("content").cast("binary").alias("content"))
    contents.mapInPandas(write, "path string, bytes bigint, archive string").write.mode("overwrite").parquet(index)
    return rows.sparkSession.read.parquet(index)


def archive_digests(spark: SparkSession, root: str) -> DataFrame:
    """Path, bytes and MD5 (16 bytes) of every member of the archives below ``root``, read from the archives."""

    def read(batches):
        import hashlib
        import io
        import zipfile

        import pandas as pd

        for pdf in batches:
            for content in pdf["content"]:
                found = []
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for info in archive.infolist():
                        found.append((info.filename, info.file_size, hashlib.md5(archive.read(info)).digest()))
                yield pd.DataFrame(found, columns=["path", "bytes", "digest"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(root)
    return files.select("content").mapInPandas(read, "path string, bytes bigint, digest binary")


#: Digests that one row of ``md5_of_list`` holds.
DIGEST_RUN = 4096


def md5_of_list(rows: DataFrame, by: str, key: str, digest: str) -> DataFrame:
    """MD5 of the hex digests of every group, one after the other in the order of ``key``; rows must be cheap to read twice.

    The digests are packed to runs in ranges of the order. MD5 has no parts that could be joined, so a group's runs go
    through one task, which reads them in order and holds one at a time.
    """

    def pack(batches):
        import pandas as pd

        def run():
            return pd.DataFrame({by: [group], key: [first], "run": [b"".join(held)]})

        group, first, held = None, None, []
        for pdf in batches:
            for g, k, d in zip(pdf[by], pdf[key], pdf[digest]):
                if held and (g != group or len(held) == DIGEST_RUN):
                    yield run()
                    held = []
                if not held:
                    group, first = g, k
                held.append(bytes(d))
        if held:
            yield run()

    def fold(batches):
        import hashlib

        import pandas as pd

        group, state = None, None
        for pdf in batches:
            for g, run in zip(pdf[by], pdf["run"]):
                if state is not None and g != group:
                    yield pd.DataFrame({by: [group], "md5": [state.hexdigest()]})
                    state = None
                if state is None:
                    group, state = g, hashlib.md5()
                state.update(bytes(run).hex().encode())
        if state is not None:
            yield pd.DataFrame({by: [group], "md5": [state.hexdigest()]})

    ordered = rows.select(by, key, digest).repartitionByRange(by, key).sortWithinPartitions(by, key)
    runs = ordered.mapInPandas(pack, f"{by} string, {key} string, run binary")
    return runs.repartition(by).sortWithinPartitions(by, key).mapInPandas(fold, f"{by} string, md5 string")


def write_split_manifest(samples: DataFrame, classes: DataFrame, root: str) -> None:
    """Exported sample list per split, split counts and the ordered class names."""
    samples.write.mode("overwrite").partitionBy("split").json(f"{root}/samples")
    samples.groupBy("split").agg(F.count(F.lit(1)).alias("samples")).coalesce(1).write.mode("overwrite").json(f"{root}/split_counts")
    classes.orderBy("class_id").coalesce(1).write.mode("overwrite").json(f"{root}/classes")
