"""Assignment of records to part files under a rolling policy, and part summaries.

Groups that fit a task are numbered whole. Where one does not, records are range-sorted by
``(bucket, subtask, instant, index)``, so any hour, however large, is spread over as many
equal chunks as it needs. One pass describes each chunk, the small descriptions are folded
into the writer state at the start of each chunk, and a second pass numbers the parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.records import line_bytes
from millrace.operators.policy import RollPolicy
from millrace.operators.rolling import Span, State, advance, compose, describe, roll
from millrace.session import checkpoint_root

CHUNK_ROWS = 2_000_000
SMALL_CHUNK_ROWS = 250_000
# Listed rows that one folding task may hold, 40 bytes each.
FOLD_ROWS = 4_000_000
# A start state is 48 bytes and there is at most one per chunk, so at most 24 MB are
# broadcast. Beyond this many chunks, chunks get longer.
MAX_CHUNKS = 500_000

GROUP = ["bucket", "subtask"]
SPAN_SCHEMA = (
    "bucket string, subtask long, chunk long, first_ts long, last_ts long, total long, "
    "must_roll boolean, at_ts array<long>, before array<long>, end_open array<long>, "
    "end_bytes array<long>, rolls array<long>"
)
START_SCHEMA = "bucket string, subtask long, chunk long, open long, last long, bytes long, part long"


def assign_parts(
    records: DataFrame,
    policy: RollPolicy = RollPolicy(),
    parallelism: int = 1,
    size: Column | None = None,
    keep: list[str] | None = None,
    chunk_rows: int = CHUNK_ROWS,
    min_chunks: int = 1,
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """Add ``subtask``, ``size`` and ``part`` to records with ``bucket``, ``ts``, ``index``.

    ``subtask`` is the index modulo ``parallelism``; ``size`` defaults to the bytes of the
    ``foams`` line. Within ``(bucket, subtask)``, in order of instant and index, a record
    opens a new part when the current one is too old, was idle too long, or already holds
    more than the size limit. ``keep`` names the other columns to carry (default: all);
    leaving the line out makes the shuffle a good deal narrower.

    Where even the largest group is a quarter of ``chunk_rows`` at most, whole groups are
    hashed to tasks and numbered in one pass. Otherwise, or with ``min_chunks``, the sorted rows are cut into
    chunks and checkpointed, which runs them; the numbering itself stays lazy.
    """
    kept = records.columns if keep is None else keep
    names = list(dict.fromkeys(["bucket", "ts", "index", *kept]))
    rows = records.withColumn("subtask", F.pmod(F.col("index"), F.lit(parallelism)).cast("long"))
    largest, total = group_sizes(rows)
    cores = records.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, math.ceil(total / chunk_rows), min(cores, total // SMALL_CHUNK_ROWS))
    rows = rows.select(
        *names,
        "subtask",
        (line_bytes(F.col("foams")) if size is None else size.cast("long")).alias("size"),
    )
    schema = T.StructType([*rows.schema, T.StructField("part", T.LongType())])
    order = [*GROUP, "ts", "index", "size"]
    if largest * 4 <= chunk_rows and min_chunks == 1:
        # Four times the tasks, as some get several of the larger groups.
        ordered = rows.repartition(4 * tasks, *GROUP).sortWithinPartitions(*order)
    else:
        chunks = min(MAX_CHUNKS, max(min_chunks, tasks))
        ordered = with_starts(cut(rows, order, chunks), policy, chunks, fold_rows)
    return ordered.mapInArrow(number_parts(policy, schema.names[:-1]), schema)


def group_sizes(rows: DataFrame) -> tuple[int, int]:
    """Rows of the largest group, and of all."""
    counts = rows.groupBy(*GROUP).count()
    found = counts.agg(F.max("count"), F.sum("count")).first()
    return found[0] or 0, found[1] or 0


def cut(rows: DataFrame, order: list[str], chunks: int) -> DataFrame:
    """Rows in range order, one chunk per partition, kept by a checkpoint."""
    checkpoint_root(rows.sparkSession)
    # The last sort key lets copies of one record spread over chunks; copies are alike.
    rows = rows.withColumn("_copy", F.monotonically_increasing_id())
    order = [*order, "_copy"]
    ordered = rows.repartitionByRange(chunks, *order).sortWithinPartitions(*order)
    return ordered.drop("_copy").withColumn("_chunk", F.spark_partition_id()).checkpoint()


def with_starts(chunked: DataFrame, policy: RollPolicy, chunks: int, fold_rows: int) -> DataFrame:
    """Give the first row of each chunk the writer state it starts with.

    The state travels as text, null on all other rows: long runs of nulls are slow to pass
    to Python in an array column.
    """
    starts = chunk_starts(chunked, policy, chunks, fold_rows)
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    joined = chunked.join(F.broadcast(starts), "_chunk", "left").drop("_chunk")
    return joined.withColumn("_start", F.when(first, F.col("_start")))


def number_parts(policy: RollPolicy, names: list[str]):
    """Second pass: number the parts of the sorted rows of a chunk, batch by batch."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, State()
        for batch in batches:
            ts, size = longs(batch, "ts"), longs(batch, "size")
            parts = np.empty(batch.num_rows, np.int64)
            for key, begin, end in group_slices(batch):
                if current is None:
                    current, state = key, given_start(batch)
                elif key != current:
                    current, state = key, State()
                parts[begin:end], state = roll(ts[begin:end], size[begin:end], state, policy)
            yield batch.select(names).append_column("part", pa.array(parts))

    return number


def describe_chunk(policy: RollPolicy):
    """First pass: spans of the first and the last group of a chunk; only these can reach
    into another chunk."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, current, first, ts, size = None, None, True, [], []

        def closed():
            span = describe(np.concatenate(ts), np.concatenate(size), policy)
            values = [*current, chunk, *span]
            arrays = [pa.array([v], f.type) for v, f in zip(values, SPAN_ARROW)]
            return pa.RecordBatch.from_arrays(arrays, schema=SPAN_ARROW)

        for batch in batches:
            all_ts, all_size = longs(batch, "ts"), longs(batch, "size")
            if chunk is None and batch.num_rows:
                chunk = batch.column("_chunk")[0].as_py()
            for key, begin, end in group_slices(batch):
                if key != current:
                    if current is not None and first:
                        yield closed()
                        first = False
                    current, ts, size = key, [], []
                ts.append(all_ts[begin:end])
                size.append(all_size[begin:end])
        if current is not None:
            yield closed()

    return spans


def chunk_starts(ordered: DataFrame, policy: RollPolicy, chunks: int, fold_rows: int) -> DataFrame:
    """Writer state at the start of each chunk that continues a group."""
    spans = (
        ordered.select(*GROUP, "ts", "size", "_chunk")
        .mapInArrow(describe_chunk(policy), SPAN_SCHEMA)
        .checkpoint()
    )
    starts = fold(spans, policy, chunks, fold_rows)
    return starts.filter(F.col("part") >= 0).select(
        F.col("chunk").cast("int").alias("_chunk"),
        F.concat_ws(",", *State._fields).alias("_start"),
    )


def fold(spans: DataFrame, policy: RollPolicy, chunks: int, fold_rows: int) -> DataFrame:
    """State before every span. Neighbouring spans, as many as list ``fold_rows`` rows together at
    most, are composed into one until one task can walk a whole group; the states found there
    are handed down again. Where spans have grown too long to compose, as those of a rule do
    under which a part takes in very many rows, their rows are walked in order instead."""
    longest = spans.agg(F.max(F.size("at_ts"))).first()[0] or 1
    fan = min(256, fold_rows // longest)
    if fan < 2:
        return walk_rows(spans, policy)
    if chunks <= fan:
        return spans.groupBy(*GROUP).applyInPandas(walk(policy), START_SCHEMA)
    block = F.floor(F.col("chunk") / fan).alias("block")
    blocks = spans.groupBy(*GROUP, block).applyInPandas(compose_all(policy, fan), SPAN_SCHEMA)
    starts = fold(blocks.checkpoint(), policy, math.ceil(chunks / fan), fold_rows)
    inside = spans.groupBy(*GROUP, block)
    outside = starts.groupBy(*GROUP, F.col("chunk").alias("block"))
    return inside.cogroup(outside).applyInPandas(walk_from(policy), START_SCHEMA)


def walk_rows(spans: DataFrame, policy: RollPolicy) -> DataFrame:
    """State before every span, from the rows they list, which pass in order: a task holds one
    batch of them and one state."""
    entry = F.arrays_zip(*Span._fields[4:])
    rows = spans.select(
        *GROUP, "chunk", *Span._fields[:4], F.size("at_ts").alias("count"), F.posexplode(entry)
    ).select(*GROUP, "chunk", *Span._fields[:4], "count", "pos", "col.*")
    ordered = rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "chunk", "pos")
    return ordered.mapInArrow(walk_batches(policy), START_SCHEMA)


def walk_batches(policy: RollPolicy):
    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chunk, state, after, rolled = None, None, State(), State(), False
        for batch in batches:
            found = []
            columns = {x: longs(batch, x) for x in (
                "chunk", "first_ts", "last_ts", "total", "must_roll", "count", "pos", *Span._fields[4:]
            )}
            for key, begin, end in group_slices(batch):
                edges = np.flatnonzero(np.diff(columns["chunk"][begin:end])) + begin + 1
                for a, b in pairwise([begin, *edges.tolist(), end]):
                    here = {x: int(columns[x][a]) for x in columns}
                    if (key, here["chunk"]) != (current, chunk):
                        state = after if key == current else State()
                        current, chunk, rolled = key, here["chunk"], False
                        after = state._replace(last=here["last_ts"], bytes=state.bytes + here["total"])
                        found.append((*key, chunk, *state))
                    if rolled:
                        continue
                    at = min(
                        int(columns["at_ts"][a:b].searchsorted(state.open + policy.age_us)),
                        int(columns["before"][a:b].searchsorted(policy.size - state.bytes, "right")),
                    )
                    if here["first_ts"] - state.last >= policy.idle_us:
                        at = 0
                    if here["must_roll"] and columns["pos"][b - 1] == here["count"] - 1:
                        at = min(at, b - a - 1)
                    if at < b - a:
                        rolled = True
                        opened, held, rolls = (
                            int(columns[x][a + at]) for x in ("end_open", "end_bytes", "rolls")
                        )
                        after = State(opened, here["last_ts"], held, state.part + rolls)
            columns = zip(*found) if found else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.string() if n == 0 else pa.int64()) for n, x in enumerate(columns)],
                names=[x.split()[0] for x in START_SCHEMA.split(", ")],
            )

    return walked


def states_before(frame: pd.DataFrame, state: State, policy: RollPolicy) -> pd.DataFrame:
    found = []
    for row in frame.sort_values("chunk").itertuples(index=False):
        found.append((row.bucket, row.subtask, row.chunk, *state))
        state = advance(as_span(row), state, policy)
    return pd.DataFrame(found, columns=[*GROUP, "chunk", *State._fields])


def walk(policy: RollPolicy):
    def fresh(frame: pd.DataFrame) -> pd.DataFrame:
        return states_before(frame, State(), policy)

    return fresh


def walk_from(policy: RollPolicy):
    def continued(frame: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        begin = next(start[list(State._fields)].itertuples(index=False))
        return states_before(frame, State(*map(int, begin)), policy)

    return continued


def compose_all(policy: RollPolicy, fan: int):
    def composed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        rows = list(frame.itertuples(index=False))
        span = as_span(rows[0])
        for row in rows[1:]:
            span = compose(span, as_span(row), policy)
        head = (rows[0].bucket, rows[0].subtask, rows[0].chunk // fan)
        return pd.DataFrame([[*head, *span]], columns=frame.columns)

    return composed


def as_span(row) -> Span:
    return Span(*(getattr(row, name) for name in Span._fields))


SPAN_ARROW = pa.schema(
    [("bucket", pa.string()), ("subtask", pa.int64()), ("chunk", pa.int64())]
    + [(name, pa.int64()) for name in ("first_ts", "last_ts", "total")]
    + [("must_roll", pa.bool_())]
    + [(name, pa.list_(pa.int64())) for name in Span._fields[4:]]
)


def longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column without nulls as whole numbers; a null instant or line is an error."""
    return batch.column(name).cast(pa.int64()).to_numpy()


def group_slices(batch: pa.RecordBatch, names: list[str] = GROUP):
    """Runs of rows of one group in a sorted batch: key, begin, end."""
    if batch.num_rows == 0:
        return
    keys = [batch.column(name) for name in names]
    change = np.zeros(batch.num_rows - 1, bool)
    for key in keys:
        change |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for begin, end in pairwise(edges):
        yield tuple(key[begin].as_py() for key in keys), begin, end


def given_start(batch: pa.RecordBatch) -> State:
    """The start state on the first row of a chunk, or a fresh one."""
    start = batch.column("_start")[0].as_py() if "_start" in batch.schema.names else None
    return State(*map(int, start.split(","))) if start else State()


def roll_by_inactivity(records: DataFrame, idle_s: float, **options) -> DataFrame:
    """Parts that end on a pause alone."""
    return assign_parts(records, RollPolicy(None, idle_s, None), **options)


def part_summary(parts: DataFrame) -> DataFrame:
    """Records, bytes, first and last instant of each part."""
    return parts.groupBy(*GROUP, "part").agg(
        F.count("*").alias("records"),
        F.sum("size").alias("bytes"),
        F.min("ts").alias("opened"),
        F.max("ts").alias("closed"),
    )


def part_name() -> Column:
    """Logical path of a part: ``hour/part-subtask-number``."""
    return F.concat_ws(
        "/", "bucket", F.concat_ws("-", F.lit("part"), F.col("subtask"), F.col("part"))
    )


def last_parts(summary: DataFrame, n: int) -> DataFrame:
    """The last ``n`` parts in key order."""
    return summary.orderBy(*(F.col(c).desc() for c in [*GROUP, "part"])).limit(n)


def layout_summary(summary: DataFrame) -> DataFrame:
    """Number of parts, records and bytes."""
    return summary.agg(
        F.count("*").alias("parts"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )
