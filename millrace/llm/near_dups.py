"""Near duplicates by fast similarity sketching, banding and exact verification.

A text is its set of word shingles. Sketching throws all shingles at the coordinates in
rounds: in each of the first ``coordinates`` rounds a shingle falls into one bin by its
hash, in the later ones round ``i`` fills bin ``i - coordinates`` from all shingles, so every
coordinate is filled for sure; a bin keeps the smallest value of the first round that reached
it, and rounds stop once all are filled. Two sketches agree in a coordinate with the
similarity of the sets, and long texts cost one or two hashes per shingle.

Equal sets are one node (with the smallest id). Bands of coordinates put nodes into buckets.
Within a bucket no pairs are listed: nodes are compared with the bucket's smallest one, on
their full sets. What that links is merged; where a bucket still holds nodes of several
components, those outside of the component of its smallest node are compared, in blocks of
bounded size, with the nodes of other components there. So every pair that shares a bucket is
compared or already in one component, and only links leave a task.

Defined results: texts without words have no shingles and no links; one with fewer words
than a shingle is its whole sequence; rows with one id count as one document; rows with a
null id join the component of an equal text, and stand alone without one; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import (
    ODD_1, ODD_2, U, binary_list, build_filter, in_filter, keep, longs, lower_white_words, mix,
    pack_hashes, session, slices, table, window_hashes, with_key,
)
from millrace.llm.components import components

BITS = 24


@dataclass(frozen=True)
class Likeness:
    """Words of a shingle, least similarity in percent, and the sketch: the chance to miss a
    pair at the limit is (1 - (percent/100)^rows)^bands: 4e-7 at 85 percent; at 80, 30 bands
    are needed for 1e-7."""

    words: int = 3
    percent: int = 85
    bands: int = 20
    rows: int = 4


def shingle_sets(part, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and their row bounds."""
    hashes, n = part.hashes(), len(part.texts)
    at = part.starts(words)
    rows, grams = part.rows()[at], window_hashes(hashes, words, words)[at]
    short = np.flatnonzero((part.counts > 0) & (part.counts < words))
    if len(short):
        whole = [window_hashes(hashes[part.bounds[r] : part.bounds[r + 1]], int(part.counts[r]),
                               int(part.counts[r]))[0] for r in short]
        rows = np.concatenate([rows, short])
        grams = np.concatenate([grams, np.array(whole, np.uint64)])
    order = np.argsort(grams)
    small = rows.astype(np.uint16) if n < 1 << 16 else rows
    order = order[np.argsort(small[order], kind="stable")]
    rows, grams = rows[order], grams[order]
    if len(rows):
        new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])])
        rows, grams = rows[new], grams[new]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int64)
    return grams, bounds


def sketches(grams: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """``size`` filled coordinates for each set that is not empty."""
    n = len(bounds) - 1
    empty = np.iinfo(np.uint64).max
    flat = np.full(n * size, empty, np.uint64)
    left = np.repeat(np.arange(n), np.diff(bounds))
    for i in range(2 * size):
        if not len(grams):
            break
        hashed = mix(grams + U((i + 1) * int(ODD_2) % (1 << 64)))
        value = (hashed >> U(24)) | (U(i) << U(40))
        if i < size:
            at = left * size + (hashed & U(0xFFFFFF)).astype(np.int64) % size
        else:
            at = left * size + (i - size)
        np.minimum.at(flat, at, value)
        full = (flat.reshape(n, size) != empty).all(axis=1)
        go_on = ~full[left]
        grams, left = grams[go_on], left[go_on]
    return flat.reshape(n, size)


def set_sums(grams: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums of each set."""
    sums = []
    for seed in (ODD_1, ODD_2):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams ^ seed))])
        sums.append(total[bounds[1:]] - total[bounds[:-1]])
    return sums


def sketch_rows(docs: DataFrame, like: Likeness) -> DataFrame:
    """``doc_id, row_key, n_shingles, set_a, set_b, bands``; two 64-bit sums tell sets apart."""
    size = like.bands * like.rows
    kinds = "n_shingles long, set_a long, set_b long, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, lower_white_words):
            grams, bounds = shingle_sets(part, like.words)
            coordinates = sketches(grams, bounds, size).reshape(-1, like.bands, like.rows)
            band = np.tile(np.arange(like.bands, dtype=np.uint64), (len(coordinates), 1))
            for k in range(like.rows):
                band = mix(band * ODD_1 + coordinates[:, :, k])
            sums = set_sums(grams, bounds)
            ends = np.arange(0, band.size + 1, like.bands, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.batch.column("doc_id"), part.batch.column("row_key"),
                 pa.array(np.diff(bounds), pa.int64()),
                 longs(sums[0]), longs(sums[1]),
                 pa.ListArray.from_arrays(pa.array(ends), longs(band.ravel()))],
                names=["doc_id", "row_key", "n_shingles", "set_a", "set_b", "bands"],
            )

    return with_key(docs, F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"doc_id long, row_key long, {kinds}"
    )


def sets_of(docs: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """``node, grams``: full shingle sets of the documents that take part in comparisons, each
    once however often its row is repeated. A filter of fixed size keeps other documents from
    being sent anywhere."""
    filter_ = build_filter(pack_hashes(nodes.select(F.xxhash64("node").alias("h"))), BITS)
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column("h")).view(np.uint64)
            hit = in_filter(shared.value, keys, BITS)
            for part in slices([batch.filter(pa.array(hit))], lower_white_words):
                grams, bounds = shingle_sets(part, like.words)
                yield pa.RecordBatch.from_arrays(
                    [part.batch.column("node"), *map(longs, set_sums(grams, bounds)),
                     binary_list(grams, bounds)], names=["node", "set_a", "set_b", "grams"],
                )

    rows = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("node"), F.xxhash64("doc_id").alias("h"), F.col("text").cast("binary")
    )
    each = rows.mapInArrow(run, "node long, set_a long, set_b long, grams binary")
    return each.dropDuplicates(["node", "set_a", "set_b"]).select("node", "grams")


def compare(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """``a, b, linked, apart`` of the pairs ``a, b``: whether their full sets are similar enough
    and the shingles that only one of them has. A node with many partners is a row of its set
    and a row for each partner; adaptive execution splits such joins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, apart = [], []
            for x, y in zip(batch.column("grams_a"), batch.column("grams_b")):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                other = np.setxor1d(s, t, assume_unique=True)
                linked.append(alike(len(s), len(t), len(other), like))
                apart.append(other.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()),
                 pa.array(apart, pa.binary())], names=["a", "b", "linked", "apart"],
            )

    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a")), "a")
    return both.select("a", "b", "grams_a", "grams_b").mapInArrow(
        run, "a long, b long, linked boolean, apart binary"
    )


def alike(m, n, apart, like: Likeness):
    """Similarity test from the sizes of two sets and of their symmetric difference."""
    return 100 * (m + n - apart) >= like.percent * (m + n + apart)


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``doc_id, row_key, n_shingles, set_a, set_b, component_id, kept``."""
    session(docs.sparkSession)
    rows = keep(sketch_rows(docs, like), "sketches")
    same = ["set_a", "set_b", "n_shingles"]
    nodes = keep(
        rows.filter("n_shingles > 0 and doc_id is not null").groupBy(*same)
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")),
        "nodes",
    )
    spread = nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    heads = spread.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("n"))
    # Rows of buckets with company; all later steps start from them.
    held = keep(
        spread.join(heads.filter("n > 1"), "bucket").select("bucket", "node", "n_shingles", "head"),
        "buckets",
    )
    stars = held.filter("node <> head").select(
        F.col("head").alias("a"), F.col("node").alias("b")
    ).distinct()
    sets = keep(sets_of(docs, held.select("node").distinct(), like), "sets")
    compared = keep(compare(stars, sets, like), "compared")
    links = compared.filter("linked").select("a", "b")
    labels = components(links)
    more = keep(across(held, labels, compared, like), "links")
    final = labels if more.isEmpty() else components(links.union(more))

    named = nodes.join(final, "node", "left").select(
        *[F.col(c).alias(f"_{c}") for c in same],
        F.coalesce("component", "node").alias("component_id"),
    )
    match = [rows[c] == named[f"_{c}"] for c in same]
    joined = rows.join(named, match, "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(
        F.col("doc_id")
    )
    return joined.select(
        "doc_id", "row_key", *same, component.alias("component_id"),
        F.when(F.col("doc_id").isNull(), component.isNull())
        .otherwise(F.col("doc_id") == component).alias("kept"),
    )


STRAYS, MEMBERS = 256, 512  # nodes of a block


def across(held: DataFrame, labels: DataFrame, compared: DataFrame, like: Likeness) -> DataFrame:
    """``a, b``: links between the components that met in a bucket, one for each node outside
    of the head's component and component that it is similar to.

    Every such node is compared with all nodes of other components in its bucket, in blocks of
    bounded size. Both sides are known by what sets them apart from the bucket's head: what two
    sets do not share is what their differences do not share, so the full sets stay where they
    are and the test is exact.
    """
    of = labels.withColumnsRenamed({"node": "_n", "component": "_c"})
    marked = held.join(of, F.col("node") == F.col("_n"), "left").select(
        "bucket", "node", "n_shingles", "head", F.coalesce("_c", "node").alias("component")
    )
    marked = keep(marked.join(of, F.col("head") == F.col("_n"), "left").select(
        "bucket", "node", "n_shingles", "head", "component",
        (F.col("component") != F.coalesce("_c", "head")).alias("stray"),
    ), "marked")
    blocks = marked.groupBy("bucket").agg(
        F.ceil(F.count_if("stray") / STRAYS).cast("int").alias("s"),
        F.ceil(F.count("*") / MEMBERS).cast("int").alias("m"),
    ).filter("s > 0")
    apart = compared.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "apart")
    met = marked.join(blocks, "bucket").join(
        apart, (F.col("head") == F.col("_a")) & (F.col("node") == F.col("_b")), "left"
    )
    one = F.xxhash64("node")
    columns = ["bucket", "node", "n_shingles", "component", "apart"]

    def all_of(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    members = met.select(*columns, F.lit(False).alias("is_stray"), all_of(F.col("s")).alias("i"),
                         F.pmod(one, F.col("m")).cast("int").alias("j"))
    strays = met.filter("stray").select(
        *columns, F.lit(True).alias("is_stray"), F.pmod(one, F.col("s")).cast("int").alias("i"),
        all_of(F.col("m")).alias("j"),
    )
    block = ["bucket", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held_: list[tuple] = []
        now = None
        for batch in batches:
            names = [*block, "is_stray", "node", "n_shingles", "component", "apart"]
            found = []
            for row in zip(*(batch.column(x).to_pylist() for x in names)):
                if row[:3] != now:
                    found += _block_links(held_, like)
                    held_, now = [], row[:3]
                held_.append(row[3:])
            yield table({"a": [x for x, _ in found], "b": [y for _, y in found]}, schema)
        found = _block_links(held_, like)
        yield table({"a": [x for x, _ in found], "b": [y for _, y in found]}, schema)

    return (
        members.union(strays).repartition(*block).sortWithinPartitions(*block)
        .mapInArrow(run, "a long, b long").distinct()
    )


def _block_links(rows: list[tuple], like: Likeness) -> list[tuple[int, int]]:
    strays = [r for r in rows if r[0]]
    members = [r for r in rows if not r[0]]
    if not strays or not members:
        return []
    node, size, component = (np.array([r[k] for r in members], np.int64) for k in (1, 2, 3))
    apart = [np.frombuffer(r[4] or b"", np.uint64) for r in members]
    length = np.array([len(x) for x in apart], np.int64)
    at = np.concatenate([[0], np.cumsum(length)])
    all_ = np.concatenate(apart)
    out = []
    for _, s_node, s_size, s_component, raw in strays:
        own = np.frombuffer(raw or b"", np.uint64)
        if len(own) and len(all_):
            place = np.minimum(np.searchsorted(own, all_), len(own) - 1)
            upto = np.concatenate([[0], np.cumsum(own[place] == all_)])
            shared = upto[at[1:]] - upto[at[:-1]]
        else:
            shared = np.zeros(len(members), np.int64)
        good = alike(s_size, size, len(own) + length - 2 * shared, like) & (component != s_component)
        _, first = np.unique(component[good], return_index=True)
        out += [(int(x), s_node) for x in node[good][first]]
    return out
