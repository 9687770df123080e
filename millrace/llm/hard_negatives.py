"""Hard negatives by matrix products in a residue number system.

Scores are inner products of whole-number vectors and must be exact. A product in float32 is
exact only below 2^24, so components are reduced modulo several small primes: with remainders of
at most 511 and 64 of them at a time, every product modulo one prime is exact in float32 and runs
at the speed of a plain matrix product. The remainders of a score are put together again by
Chinese remaindering, in mixed radix, and read as a signed number. How many primes that takes
follows from the largest squared length among the vectors, which bounds every score.

Anchors and rows are dealt to blocks; each pair of blocks is one task, so the work is that of a
stated query set against all rows and no task holds more than two blocks. A first round finds the
nearest rows of an anchor's own label, the best few of every block and then of all; a second
looks, for each of them, for the best rows of other labels whose score lies in its window.

Defined results: rows with a null id, label, vector or component, or with a component that is not
finite, take no part; shorter vectors count as filled up with zeros; a row that is repeated with
its id, label and vector counts once; rows that share an id only are rows of their own, but an
anchor never meets its own id; ties go to the smaller id; an empty table gives no rows. Scores
beyond 2^58 are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import keep, session

# The largest primes below 1024, so that remainders lie within 511.
PRIMES = (1021, 1019, 1013, 1009, 997, 991)
DEPTH = 64  # 64 * 511 * 511 < 2^24
LARGEST = 1 << 58
NONE = -(1 << 62)

_POSITIVES = "anchor_id long, anchor_key long, positive_id long, positive_score long"
_NEGATIVES = _POSITIVES + ", place long, negative_id long, negative_score long"


@dataclass(frozen=True)
class Search:
    positives: int = 5
    negatives: int = 3
    # A negative's score lies between these shares of the positive's.
    low: tuple[int, int] = (50, 100)
    high: tuple[int, int] = (95, 100)
    rows: int = 1 << 16  # of a block, at most
    anchors: int = 1 << 14
    band: int = 64  # anchors scored at a time, so that a task holds band * rows scores


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """Each component as ``floor(scale * x)``; null where the vector or a component is null or
    not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(
        vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    )


def remainders(values: np.ndarray, prime: int) -> np.ndarray:
    """Remainders nearest to zero."""
    rest = values % prime
    return np.where(rest > prime // 2, rest - prime, rest).astype(np.float32)


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as scores between ``-bound`` and ``bound`` need."""
    product = 1
    for n, prime in enumerate(PRIMES, 1):
        product *= prime
        if product > 2 * bound + 1:
            return PRIMES[:n]
    raise ValueError(f"scores up to {bound} are beyond 2^58")


def product_modulo(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """``a @ b.T`` modulo a prime, from float32 remainders."""
    total = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, a.shape[1], DEPTH):
        total += (a[:, at : at + DEPTH] @ b[:, at : at + DEPTH].T).astype(np.int64)
    return total % prime


def products(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Exact signed products from the remainders of both sides for each prime."""
    digits: list[np.ndarray] = []
    for n, prime in enumerate(primes):
        digit = product_modulo(a[n], b[n], prime)
        for held, below in zip(digits, primes):
            digit = (digit - held) * pow(below, -1, prime) % prime
        digits.append(digit)
    value, weight = digits[0], primes[0]
    for digit, prime in zip(digits[1:], primes[1:]):
        value = value + digit * weight
        weight *= prime
    return np.where(value > weight // 2, value - weight, value)


@dataclass
class Block:
    """Rows of a block, each once, by ascending id."""

    ids: np.ndarray
    keys: np.ndarray
    labels: np.ndarray
    parts: list[np.ndarray]
    batch: pa.Table

    def take(self, rows) -> list[np.ndarray]:
        return [x[rows] for x in self.parts]


def block_of(table: pa.Table, width: int, primes: tuple[int, ...]) -> Block:
    ids = table.column("id").to_numpy()
    keys = table.column("key").to_numpy()
    order = np.lexsort((keys, ids))
    if len(order):
        same = (np.diff(ids[order]) == 0) & (np.diff(keys[order]) == 0)
        order = order[np.concatenate([[True], ~same])]
    table = table.take(pa.array(order))
    values = np.zeros((len(order), width), np.int64)
    column = table.column("vector").combine_chunks()
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    values[np.arange(width) < sizes[:, None]] = flat
    parts = [remainders(values, p) for p in primes]
    return Block(ids[order], keys[order], table.column("label").to_numpy(), parts, table)


def bands(count: int, size: int) -> Iterator[slice]:
    for first in range(0, count, size):
        yield slice(first, min(first + size, count))


def first_best(scores: np.ndarray, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Column and score of the ``count`` best of each row, the leftmost among equals; what is
    taken is struck out."""
    if not scores.shape[1]:
        return
    at = np.arange(len(scores))
    for _ in range(min(count, scores.shape[1])):
        best = scores.argmax(axis=1)
        yield best, scores[at, best]
        scores[at, best] = NONE


def nearest(anchors: Block, rows: Block, s: Search, primes) -> dict[str, np.ndarray]:
    """The best rows of the anchors' own labels in a block."""
    found: list[tuple[np.ndarray, ...]] = []
    for label in np.unique(anchors.labels):
        mine, others = np.flatnonzero(anchors.labels == label), np.flatnonzero(rows.labels == label)
        parts = rows.take(others)
        for band in bands(len(mine), s.band):
            here = mine[band]
            scores = products(anchors.take(here), parts, primes)
            scores[anchors.ids[here][:, None] == rows.ids[others]] = NONE
            for best, score in first_best(scores, s.positives):
                real = score != NONE
                found.append((anchors.ids[here][real], anchors.keys[here][real],
                              rows.ids[others[best]][real], score[real]))
    return columns(found, 4)


def within(anchors: Block, rows: Block, s: Search, primes) -> dict[str, np.ndarray]:
    """For every positive of an anchor, the best rows of other labels inside its window."""
    found: list[tuple[np.ndarray, ...]] = []
    names = anchors.batch.column("positive_ids").to_pylist()
    marks = anchors.batch.column("positive_scores").to_pylist()  # both best first
    for band in bands(len(anchors.ids), s.band):
        ids, keys = anchors.ids[band], anchors.keys[band]
        scores = products(anchors.take(band), rows.parts, primes)
        scores[anchors.labels[band][:, None] == rows.labels] = NONE
        scores[ids[:, None] == rows.ids] = NONE
        for k in range(max((len(x) for x in names[band]), default=0)):
            has = np.array([i for i, x in enumerate(names[band]) if len(x) > k])
            positive = np.array([names[band][i][k] for i in has], np.int64)
            mark = [marks[band][i][k] for i in has]
            # Whole bounds of the window, in Python's numbers of any size.
            low = np.array([-(-s.low[0] * x // s.low[1]) for x in mark])
            high = np.array([s.high[0] * x // s.high[1] for x in mark])
            mine = scores[has]
            inside = (mine >= low[:, None]) & (mine <= high[:, None])
            chosen = np.where(inside, mine, NONE)
            for best, score in first_best(chosen, s.negatives):
                real = score != NONE
                found.append((ids[has][real], keys[has][real], positive[real],
                              np.array(mark, np.int64)[real], np.full(real.sum(), k),
                              rows.ids[best][real], score[real]))
    return columns(found, 7)


def columns(found: list[tuple[np.ndarray, ...]], count: int) -> dict[str, np.ndarray]:
    names = [x.split()[0] for x in _NEGATIVES.split(", ")][:count]
    if not found:
        return {x: np.empty(0, np.int64) for x in names}
    return dict(zip(names, (np.concatenate(x).astype(np.int64) for x in zip(*found))))


def in_blocks(anchors: DataFrame, rows: DataFrame, find, schema: str, s: Search, plan) -> DataFrame:
    """Run ``find`` over every block of anchors and every block of rows."""
    width, primes, anchor_blocks, row_blocks = plan

    def pair(anchor_table: pa.Table, row_table: pa.Table) -> pa.Table:
        mine, others = (block_of(x, width, primes) for x in (anchor_table, row_table))
        return pa.table(find(mine, others, s, primes))

    every_row_block = F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))
    every_anchor_block = F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)))
    left = anchors.withColumn("rows_at", every_row_block)
    right = rows.withColumn("anchors_at", every_anchor_block)
    keys = ["anchors_at", "rows_at"]
    # As many partitions as tiles, within reason: a task takes its tiles one after the other.
    parts = min(anchor_blocks * row_blocks, 100_000)
    # Both come from one table: new names for its columns keep the sides apart.
    left, right = (
        x.select(*[F.col(c).alias(c) for c in x.columns]).repartition(parts, *keys)
        for x in (left, right)
    )
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, schema)


def bounds(rows: DataFrame) -> tuple[int, int, int]:
    """Rows, longest vector and largest squared length."""
    square = F.aggregate(
        "vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    found = rows.agg(F.count("*"), F.max(F.size("vector")), F.max(square)).first()
    return found[0], found[1] or 0, int((found[2] or 0.0) * 1.0001) + 1


def best_of(found: DataFrame, keys: list[str], order: list[Column], count: int) -> DataFrame:
    """The first ``count`` of each group, with their ``rank``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= count)


def mine(vectors: DataFrame, anchor: Column, s: Search = Search()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``id long, label long, vector array<long>``; ``anchor`` says of a row whether
    it is one, and other columns are not looked at.
    """
    spark = session(vectors.sparkSession)
    rows = vectors.select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<long>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    rows = keep(rows.withColumn("key", F.xxhash64("id", "label", "vector")), "vectors")
    count, width, bound = bounds(rows)
    if bound > LARGEST:
        raise ValueError(f"scores up to {bound} are beyond 2^58")
    cores = spark.sparkContext.defaultParallelism
    row_blocks = max(-(-count // s.rows), min(2 * cores, -(-count // 1024)), 1)
    anchor_blocks = max(-(-rows.filter("anchor").count() // s.anchors), 1)
    plan = (width, primes_for(bound), anchor_blocks, row_blocks)
    dealt = rows.withColumn("rows_at", F.pmod(F.xxhash64("id"), F.lit(row_blocks)).cast("int"))
    dealt = dealt.select("id", "key", "label", "vector", "rows_at")
    asked = rows.filter("anchor").dropDuplicates(["id", "key"]).withColumn(
        "anchors_at", F.pmod(F.xxhash64("key"), F.lit(anchor_blocks)).cast("int")
    ).select("id", "key", "label", "vector", "anchors_at")

    close = in_blocks(asked, dealt, nearest, _POSITIVES, s, plan)
    order = [F.col("positive_score").desc(), F.col("positive_id")]
    close = keep(best_of(close, ["anchor_id", "anchor_key"], order, s.positives), "positives")
    # Lists of ``positives`` entries at most.
    entry = F.struct("rank", "positive_id", "positive_score")
    listed = close.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_key").alias("key")).agg(
        F.array_sort(F.collect_list(entry)).alias("best")
    ).select("id", "key", F.col("best.positive_id").alias("positive_ids"),
             F.col("best.positive_score").alias("positive_scores"))
    far = in_blocks(asked.join(listed, ["id", "key"]), dealt, within, _NEGATIVES, s, plan)
    keys = ["anchor_id", "anchor_key", "place"]
    order = [F.col("negative_score").desc(), F.col("negative_id")]
    return best_of(far, keys, order, s.negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
