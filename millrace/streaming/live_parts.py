"""The exact rolling rule on a stream: the part of each record is decided as it arrives, from
what each writer has open, which the checkpoint keeps from batch to batch and over restarts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.records import line_bytes
from millrace.operators.parts import GROUP
from millrace.operators.policy import RollPolicy
from millrace.operators.rolling import State, roll

STATE_SCHEMA = "open long, last long, bytes long, part long"


def number_live(policy: RollPolicy):
    """Number the rows that a batch brings to one writer."""

    def number(
        key: tuple, frames: Iterator[pd.DataFrame], held: GroupState
    ) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True)
        rows = rows.sort_values(["us", "index", "size"], kind="stable", ignore_index=True)
        state = State(*held.get) if held.exists else State()
        # What comes late is written now: to the writer it has the instant of the last record.
        instants = np.maximum(rows["us"].to_numpy(np.int64), state.last)
        rows["part"], state = roll(instants, rows["size"].to_numpy(np.int64), state, policy)
        held.update(tuple(int(x) for x in state))
        yield rows

    return number


def assign_live(
    records: DataFrame,
    policy: RollPolicy = RollPolicy(),
    parallelism: int = 1,
    size: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """What :func:`millrace.operators.parts.assign_parts` adds, on a stream.

    A writer takes the records of a batch in order of instant and index, and batches as they
    come, so a stream in order of instants gets the parts of the finite table. A writer's share
    of one batch is sorted in one task: ``max_bytes`` of the source or more ``parallelism`` bound
    it. ``forget_s`` drops the state of a writer that had nothing to write for so long; a record
    that comes for it later opens part 0 again.
    """
    kept = [c for c in (records.columns if keep is None else keep) if c not in ("ts", *GROUP)]
    names = list(dict.fromkeys(["index", *kept]))
    rows = records.select(
        "bucket", F.pmod("index", F.lit(parallelism)).cast("long").alias("subtask"),
        F.unix_micros("ts").alias("us"), *names,
        (line_bytes(F.col("foams")) if size is None else size.cast("long")).alias("size"),
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    numbered = rows.groupBy(*GROUP).applyInPandasWithState(
        number_live(policy), f"{kinds}, part long", STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout,
    )
    return numbered.select(
        "bucket", F.timestamp_micros("us").alias("ts"), *names, "subtask", "size", "part"
    )


def part_writer(
    records: DataFrame, root: str, checkpoint: str, policy: RollPolicy = RollPolicy(),
    parallelism: int = 1, name: str | None = None, available_now: bool = False, **options,
) -> DataStreamWriter:
    """Writer of ``root/bucket=<hour>/subtask=<n>/part=<n>/`` on a stream. A part that several
    batches write to has a file of each."""
    place = ["bucket", "subtask", "part"]
    assigned = assign_live(records, policy, parallelism, keep=["foams"], **options)
    writer = (
        assigned.select("foams", *place)
        .writeStream.format("text").outputMode("append").partitionBy(*place)
        .option("path", root).option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True) if available_now else writer
