"""Scratch tables and bounded membership filters shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.bloom_lm import LogBloom, build_filter
from slotwise.session import scratch_path


#: Stands for a null doc_id where ids are compared.
NULL_ID = -(2**63)


def stored(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """A frame written to the shared scratch folder and read again: its lineage ends there."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.parquet(path)


def text_tag() -> Column:
    """Tells texts with one doc_id apart."""
    return F.hash("text")


def known_id(name: str) -> Column:
    return F.coalesce(name, F.lit(NULL_ID))


def touching(rows: DataFrame) -> tuple[Callable, Callable]:
    """Two filters of Arrow batches: documents whose doc_id ``rows`` has, and the others.

    The filter that the workers hold has at most 128 MB, 12 bits an id up to 89 million ids. It may take some others for
    wanted ones, never the reverse: 0.3 % there, 2 % at 134 million ids, 15 % at 268 million.
    Null ids are wanted together.
    """
    keys = rows.select(known_id("doc_id").alias("key"), F.lit(1).alias("n")).distinct()
    bloom = build_filter(keys)
    shared = rows.sparkSession.sparkContext.broadcast((bloom.filled, bloom.starts))

    def reader(wanted: bool) -> Callable:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = LogBloom(*shared.value)
            for batch in batches:
                there = held.level(batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False).view(np.uint64)) > 0
                yield batch.filter(pa.array(there == wanted))

        return run

    return reader(True), reader(False)
