"""What the driver holds while filters pass through it."""

import tracemalloc

import numpy as np
from millrace.llm import substring_dedup
from millrace.llm.common import FILTER_BITS, build_filter, in_filter, mix, pack_hashes
from pyspark import SparkContext

MB = 1 << 20


def hashed(spark, values):
    return pack_hashes(spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "h long"))


def peak_of(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_filter_is_held_once(spark):
    values = mix(np.arange(5000, dtype=np.uint64))  # in all 256 parts
    df = hashed(spark, values)
    filter_, peak = peak_of(lambda: build_filter(df, FILTER_BITS))
    assert len(filter_) == 32 * MB
    assert in_filter(filter_, values).all()
    assert not in_filter(filter_, mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64))).any()
    assert peak < 44 * MB


def test_the_index_of_blocks_is_broadcast_once_and_as_it_is(spark, monkeypatch):
    sent = []
    broadcast = SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast",
                        lambda self, value: sent.append(len(value) // MB) or broadcast(self, value))
    texts = [(1, "a b c d e f g h i j k l m n"), (2, "x a b c d e f g h i j k l m n"), (3, "a b")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    runs, peak = peak_of(lambda: substring_dedup.removals(docs))
    assert sent == [32, 16]
    assert peak < 44 * MB
    assert [np.frombuffer(r["runs"], np.uint32).tolist() for r in runs.collect()] == [[1, 15]]
