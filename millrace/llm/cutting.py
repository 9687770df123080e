"""Removal of runs found elsewhere from the texts they belong to."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import build_filter, give_back, in_filter, pack_hashes, slices

DOC_BITS = 24
# Names that no table has.
HELPERS = ("cut key", "cut hash", "cut runs")
_MET = "cut met"


def cut(
    docs: DataFrame, runs: DataFrame, key: Column, change: Callable, schema: str, columns: list[str]
) -> DataFrame:
    """``change(batch, texts, runs)`` of all rows of ``docs``.

    ``runs`` has a row ``key, runs`` for each text that loses something; only these texts,
    known by a filter of fixed size, are shuffled to meet their runs.
    """
    filter_ = build_filter(pack_hashes(runs.select(F.xxhash64("key").alias("h"))), DOC_BITS)
    shared = docs.sparkSession.sparkContext.broadcast(filter_)
    rows = docs.select(*columns, key.alias(HELPERS[0])).withColumn(HELPERS[1], F.xxhash64(HELPERS[0]))

    def chosen(batch: pa.RecordBatch, want: bool) -> pa.RecordBatch:
        keys = batch.column(HELPERS[1]).to_numpy(zero_copy_only=False).view(np.uint64)
        return batch.filter(pa.array(in_filter(shared.value, keys, DOC_BITS) == want))

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield chosen(batch, True)
            del batch
        give_back()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices((chosen(b, False) for b in batches), lambda _: []):
            yield change(part.batch, part.texts, [None] * len(part.texts))
            del part
        give_back()

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, lambda _: []):
            yield change(part.batch, part.texts, part.batch.column(HELPERS[2]).to_pylist())
            del part
        give_back()

    found = runs.select(F.col("key").alias(_MET), F.col("runs").alias(HELPERS[2]))
    some = rows.mapInArrow(touched, rows.schema)
    met = some.join(found, some[HELPERS[0]] == found[_MET], "left")
    return rows.mapInArrow(whole, schema).union(met.mapInArrow(shortened, schema))
