"""Removal of word runs that a document with a smaller id has too, by fixed-block anchors.

Every document is a reference: it is cut into non-overlapping blocks of ``block`` words,
half a window, so that any repeated window holds a whole block of its reference. The blocks
of all documents are indexed, every document probes the index with each rolling window of
``block`` words, and blocks that something else hit are known by a second index. Where
anchors hit, they are extended: all windows of ``width`` words over a hit are compared by a
hash of all their words, the smallest document of each window is found, and the windows of
larger documents are merged into maximal runs.

The indexes are filters of fixed size, so what is broadcast does not grow; what passes by
chance is dropped by the comparison. Windows travel as packed arrays. A task settles windows
that it saw in several documents itself and sends only the smallest document's, so a passage
in a third of all documents costs its bucket an entry per task, not per document. Texts are
shuffled only where something is removed.

Defined results: null texts have no words; rows with a null id neither lose words nor count
as a reference; rows with one id count as one document and are cut each by its own text; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import (
    EMPTY, FILTER_BITS, ODD_1, PART_BITS, U, binary_list, bucket_count, filter_bytes,
    filter_parts, hash_chunks, in_filter, join_filter, keep, mix, row_key, session, set_bits, slices, table, white_words,
    window_hashes, with_key,
)
from millrace.llm.cutting import cut

HIT_BITS = FILTER_BITS - 1  # repeated blocks are the fewer ones
FLUSH = 250_000  # windows a task holds before it settles and sends them
SLICE = 1 << 20  # text handled at once
BUCKET_BYTES = 8 << 20  # text behind a bucket


def block_hashes(docs: DataFrame, block: int) -> DataFrame:
    """``hashes``: the blocks of the reference documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, white_words, most=SLICE):
            rolled = window_hashes(part.hashes(), block, block)
            at = part.starts(block)
            own = at[(at - part.bounds[part.rows()[at]]) % block == 0]
            yield _one(rolled[own])

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, "hashes binary")


def hit_hashes(docs: DataFrame, block: int, index: Broadcast) -> DataFrame:
    """``hashes``: indexed blocks that a rolling window hit outside of the block grid, or that
    the grid of some document has again within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, white_words, most=SLICE):
            rolled = window_hashes(part.hashes(), block, block)
            at = part.starts(block)
            off = at[(at - part.bounds[part.rows()[at]]) % block != 0]
            values = rolled[off]
            yield _one(values[in_filter(np.frombuffer(index.value, np.uint8), values)])

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, "hashes binary")


def index_blocks(blocks: DataFrame) -> DataFrame:
    """``part, bits, hashes``: the parts of the index, and in rows without bits the blocks that
    were there before, or almost surely so."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("hashes", pa.binary()), ("times", pa.binary())])
        for values in hash_chunks(batches):
            values, times = np.unique(values, return_counts=True)
            part, ends = filter_parts(values, FILTER_BITS)
            yield table({"part": part, "hashes": binary_list(values, ends),
                         "times": binary_list(np.minimum(times, 2).astype(np.uint8), ends)}, schema)

    def gather(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("bits", pa.binary()), ("hashes", pa.binary())])
        bitmap = np.zeros(1 << PART_BITS, np.uint8)
        part = key[0].as_py()
        for batch in batches:
            again = []
            for raw, times in zip(batch.column("hashes"), batch.column("times")):
                values = np.frombuffer(raw.as_buffer(), np.uint64)
                twice = np.frombuffer(times.as_buffer(), np.uint8) > 1
                again.append(values[set_bits(bitmap, values, FILTER_BITS) | twice])
            yield table({"part": [part], "bits": [None],
                         "hashes": [np.concatenate([EMPTY, *again]).tobytes()]}, schema)
        yield table({"part": [part], "bits": [np.packbits(bitmap).tobytes()], "hashes": [b""]}, schema)

    return (
        blocks.mapInArrow(split, "part int, hashes binary, times binary")
        .groupBy("part").applyInArrow(gather, "part int, bits binary, hashes binary")
    )


def _one(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"hashes": pa.array([values.tobytes()], pa.binary())})


def _candidates(part, width: int, block: int, index: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Words at which a window begins that holds an anchor."""
    rolled = window_hashes(part.hashes(), block, block)
    at = part.starts(block)
    on_grid = (at - part.bounds[part.rows()[at]]) % block == 0
    anchor = np.zeros(len(part.words) + 1, np.int64)
    off, on = at[~on_grid], at[on_grid]
    anchor[off[in_filter(index, rolled[off])]] = 1
    anchor[on[in_filter(hit, rolled[on], HIT_BITS)]] = 1
    upto = np.concatenate([[0], np.cumsum(anchor)])
    start = part.starts(width)
    return start[upto[start + width - block + 1] > upto[start]]


def _settle(held: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows of a task: those of documents that are not the smallest here are done (kind 1,
    to the bucket of their document), the others are asked about (kind 0)."""
    hashes, docs, places = _once(*(np.concatenate(x) for x in zip(*held)))
    larger = _larger(hashes, docs)
    for kind, which in ((1, larger), (0, ~larger)):
        some = hashes[which], docs[which], places[which]
        if kind == 1:
            bucket = _bucket_of(some[1], buckets)
        else:
            bucket = (mix(some[0]) % U(buckets)).astype(np.int64)
        yield from _scatter(kind, bucket, *some, buckets)


def _once(hashes: np.ndarray, docs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
    """Copies of a row share its id and key, and each of its windows counts once."""
    order = np.lexsort((places, docs))
    docs, places = docs[order], places[order]
    new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (places[1:] != places[:-1])])
    return hashes[order][new], docs[new], places[new]


def _bucket_of(docs: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(docs.view(np.uint64) * ODD_1) % U(buckets)).astype(np.int64)


def _larger(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether a document with a smaller id has the same window."""
    if not len(hashes):
        return np.zeros(0, bool)
    order = np.argsort(hashes)
    sorted_, of = hashes[order], docs[order]
    first = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    low = np.minimum.reduceat(of, np.flatnonzero(first))[np.cumsum(first) - 1]
    out = np.zeros(len(hashes), bool)
    out[order] = of > low
    return out


_PACKED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()),
                     ("docs", pa.binary()), ("places", pa.binary())])


def _scatter(kind, bucket, hashes, docs, places, buckets) -> Iterator[pa.RecordBatch]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(ends))
    ends = np.concatenate([ends[used], [len(bucket)]])
    n = len(used)
    packed = binary_list(hashes[order], ends) if kind == 0 else pa.array([b""] * n, pa.binary())
    yield table({"kind": [kind] * n, "bucket": used.astype(np.int32), "hashes": packed,
                 "docs": binary_list(docs[order], ends),
                 "places": binary_list(places[order], ends)}, _PACKED)


def removals(docs: DataFrame, width: int = 13) -> DataFrame:
    """``key, runs``: the removed runs of words of every text that loses some, as pairs of
    32-bit numbers. In between, ``tag`` tells rows with one id apart."""
    spark = session(docs.sparkSession)
    block = (width + 1) // 2
    buckets = bucket_count(docs, BUCKET_BYTES)
    known = docs.filter(F.col("doc_id").isNotNull())
    indexed = keep(index_blocks(block_hashes(known, block)), "index")
    context = spark.sparkContext
    # As bytes: an array would be held twice while a worker unpacks it.
    index_ = context.broadcast(join_filter(indexed.filter("bits is not null"), FILTER_BITS))
    found = hit_hashes(known, block, index_).union(indexed.select("hashes"))
    hit_ = context.broadcast(filter_bytes(found, HIT_BITS))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        blocks, again = (np.frombuffer(x.value, np.uint8) for x in (index_, hit_))
        for part in slices(batches, white_words, most=SLICE):
            at = _candidates(part, width, block, blocks, again)
            row = part.rows()[at]
            ids = part.batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            tags = part.batch.column("row_key").to_numpy(zero_copy_only=False).view(np.uint64)
            place = (tags[row] << U(32)) | (at - part.bounds[row]).astype(np.uint64)
            held.append((window_hashes(part.hashes(), width, width)[at], ids[row], place))
            count += len(at)
            if count >= FLUSH:
                yield from _settle(held, buckets)
                held, count = [], 0
        if count:
            yield from _settle(held, buckets)

    def compare(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for x in batch.to_pylist():
                if x["kind"] == 1:
                    yield table({n: [x[n]] for n in ("bucket", "docs", "places")}, _DONE)
                else:
                    held.append((np.frombuffer(x["hashes"], np.uint64),
                                 np.frombuffer(x["docs"], np.int64),
                                 np.frombuffer(x["places"], np.uint64)))
        if held:
            hashes, docs_, places = _once(*(np.concatenate(x) for x in zip(*held)))
            gone = _larger(hashes, docs_)
            for x in _scatter(1, _bucket_of(docs_[gone], buckets), hashes[gone], docs_[gone],
                              places[gone], buckets):
                yield x.select(["bucket", "docs", "places"])

    def assemble(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        held = [(np.frombuffer(x["docs"], np.int64), np.frombuffer(x["places"], np.uint64))
                for batch in batches for x in batch.to_pylist()]
        ids, places = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((places, ids))
        ids, tags = ids[order], (places[order] >> U(32)).astype(np.int64)
        at = (places[order] & U(0xFFFFFFFF)).astype(np.int64)
        new_doc = np.concatenate([[True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])
        new_run = new_doc | np.concatenate([[True], at[1:] > at[:-1] + width])
        first = np.flatnonzero(new_run)
        last = np.concatenate([first[1:] - 1, [len(at) - 1]])
        runs = np.stack([at[first], at[last] + width], axis=1).astype(np.uint32).ravel()
        doc_first = np.flatnonzero(new_doc)
        ends = np.concatenate([np.searchsorted(first, doc_first), [len(first)]]) * 2
        yield table({"doc_id": ids[doc_first], "tag": tags[doc_first],
                     "runs": binary_list(runs, ends)}, _RUNS)

    keyed = with_key(known, F.col("text").cast("binary").alias("text"))
    return (
        keyed.select("doc_id", F.col("row_key").bitwiseAND(0xFFFFFFFF).alias("row_key"), "text")
        .mapInArrow(windows, "kind int, bucket int, hashes binary, docs binary, places binary")
        .groupBy("bucket").applyInArrow(compare, "bucket int, docs binary, places binary")
        .groupBy("bucket").applyInArrow(assemble, "doc_id long, tag long, runs binary")
        .select(F.xxhash64("doc_id", "tag").alias("key"), "runs")
    )


def _text_key() -> Column:
    return F.xxhash64(F.col("doc_id"), row_key().bitwiseAND(0xFFFFFFFF))


_DONE = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("places", pa.binary())])
_RUNS = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("runs", pa.binary())])


def kept_words(words: list[bytes], runs: bytes | None) -> list[bytes]:
    out, at = [], 0
    edges = np.frombuffer(runs or b"", np.uint32).tolist()
    for a, b in zip(edges[::2], edges[1::2]):
        out += words[at:a]
        at = b
    return out + words[at:]


def digest(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    schema = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def change(batch: pa.RecordBatch, texts: list[bytes], runs_: list) -> pa.RecordBatch:
        out = {"n_words": [], "n_removed": [], "kept_sha256": []}
        for text, run in zip(texts, runs_):
            words = white_words(text)
            left = kept_words(words, run)
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(left))
            out["kept_sha256"].append(hashlib.sha256(b" ".join(left)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(out[f.name], f.type) for f in schema)],
            names=["doc_id", *out],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return cut(docs, runs, _text_key(), change,
               f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string",
               ["doc_id", "text"])


def shorten(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with shortened texts; others are left as they are."""
    names = docs.columns

    def change(batch: pa.RecordBatch, texts: list[bytes], runs_: list) -> pa.RecordBatch:
        old = batch.column("text").to_pylist()
        new = [b" ".join(kept_words(white_words(t), r)).decode("utf-8", "replace") if r else o
               for t, r, o in zip(texts, runs_, old)]
        columns = {c: batch.column(c) for c in names}
        columns["text"] = pa.array(new, columns["text"].type)
        if "n_chars" in columns:
            sizes = [len(n) if r else o for n, r, o in
                     zip(new, runs_, columns["n_chars"].to_pylist())]
            columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
        return pa.RecordBatch.from_pydict(columns)

    return cut(docs, runs, _text_key(), change, docs.schema, names)
