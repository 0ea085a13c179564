"""Running streams into tables that a batch reader can use."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: State that arbitrary processors need; kept on disk of the executors and in the checkpoint folder.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def finish(writer, checkpoint: str, spark: SparkSession | None = None) -> int:
    """Process everything that is available now and stop; the number of rows dropped as too late.

    With ``spark`` the query keeps its state in RocksDB, as processors with several states need.
    """
    before = spark.conf.get(STATE_PROVIDER, None) if spark else None
    if spark:
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if spark and before is None:
            spark.conf.unset(STATE_PROVIDER)
        elif spark:
            spark.conf.set(STATE_PROVIDER, before)
    query.awaitTermination()
    return sum(int(op.numRowsDroppedByWatermark) for progress in query.recentProgress for op in progress.stateOperators)


class MergedTable:
    """A table that a stream keeps: one base and the batches since, merged when read.

    ``merge`` reduces rows to one a key, whatever their order. Every ``every`` batches a new base is written, and what the
    base before the last covered is removed, so size and files read do not grow with the number of batches. A replayed
    batch replaces its own rows and starts from what was there before it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame], every: int = 8):
        self.spark, self.path, self.merge, self.every = spark, path.rstrip("/"), merge, every
        self.schema = f"{schema}, {BATCH} bigint"
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.files, self.folder = folder.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the finished folders of a kind."""
        if not self.files.exists(self.folder(self.path)):
            return []
        names = [status.getPath().getName() for status in self.files.listStatus(self.folder(self.path))]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=") and self.files.exists(self.folder(f"{self.path}/{n}/_SUCCESS")))

    def parts(self, before: int | None = None) -> tuple[int, list[str]]:
        """The newest base below a batch number and the folders that make up the table there."""
        fits = lambda n: before is None or n < before
        base = max((n for n in self._numbers("base") if fits(n)), default=-1)
        batches = [f"{self.path}/batch={n}" for n in self._numbers("batch") if n > base and fits(n)]
        return base, [f"{self.path}/base={base}"] * (base >= 0) + batches

    def read(self, before: int | None = None) -> DataFrame:
        paths = self.parts(before)[1]
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        return self.merge(rows)

    def add(self, rows: DataFrame, batch: int) -> None:
        rows.withColumn(BATCH, F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        if (batch + 1) % self.every:
            return
        last = max((n for n in self._numbers("base") if n < batch), default=-1)
        paths = [f"{self.path}/base={last}"] * (last >= 0) + [f"{self.path}/batch={n}" for n in self._numbers("batch") if last < n <= batch]
        self.merge(self.spark.read.schema(self.schema).parquet(*paths)).write.mode("overwrite").parquet(f"{self.path}/base={batch}")
        for kind, upto in (("base", last - 1), ("batch", last)):
            for n in self._numbers(kind):
                if n <= upto:
                    self.files.delete(self.folder(f"{self.path}/{kind}={n}"), True)


def newest(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge rule: the row of the last batch of every key."""

    def merge(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in keys]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("v")).select(*keys, "v.*")

    return merge


def combined(keys: Sequence[str], rules: dict[str, Callable[[str], Column]]) -> Callable[[DataFrame], DataFrame]:
    """Merge rule: every column by its own aggregate, such as a sum."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[rule(c).alias(c) for c, rule in rules.items()], F.max(BATCH).alias(BATCH))

    return merge


def update_to_table(stream: DataFrame, table: MergedTable, checkpoint: str) -> None:
    """Keep the changed groups of every micro-batch of a running aggregate."""
    finish(stream.writeStream.outputMode("update").foreachBatch(table.add), checkpoint)


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Store final rows; the number of input rows dropped as too late."""
    return finish(stream.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint)


def each_batch(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    finish(stream.writeStream.foreachBatch(step), checkpoint)
