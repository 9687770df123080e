"""Part assignment on Spark against the record-at-a-time rule."""

import random
from collections import defaultdict

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from millrace.functions.records import as_records
from millrace.operators import parts
from millrace.operators.policy import RollPolicy
from test_rolling import one_by_one

BASE = 1_760_116_523_456_000
DATA_SCHEMA = "index long, us long, bucket string, size long"


def frame(spark, rows):
    df = spark.createDataFrame(rows, DATA_SCHEMA)
    return df.select("index", F.timestamp_micros("us").alias("ts"), "bucket", "size")


def expected(rows, policy, parallelism):
    groups = defaultdict(list)
    for index, us, bucket, size in rows:
        groups[bucket, index % parallelism].append((us, index, size))
    found = []
    for (bucket, subtask), group in groups.items():
        group.sort()
        numbers = one_by_one([g[0] for g in group], [g[2] for g in group], policy)
        found += [(bucket, subtask, g[1], n) for g, n in zip(group, numbers)]
    return sorted(found)


def assigned(df, policy, parallelism, **options):
    out = parts.assign_parts(df, policy, parallelism, size=F.col("size"), keep=[], **options)
    return sorted(map(tuple, out.select("bucket", "subtask", "index", "part").collect()))


def hot_rows(n=4000, seed=7):
    """Most rows in one hour, some in another, the rest in many small ones."""
    rng, us, rows = random.Random(seed), BASE, []
    for i in range(n):
        us += rng.choice([0, 1, 400_000, 900_000, 5_000_000])
        bucket = "hot" if rng.random() < 0.7 else rng.choice(["warm"] * 3 + [f"b{i % 40}"])
        rows.append((i, us, bucket, rng.randint(1, 90)))
    return rows


POLICIES = [
    RollPolicy(20, 4.5, 2000),
    RollPolicy(60, None, None),
    RollPolicy(None, None, 3000),
    RollPolicy(None, 4.5, None),
    RollPolicy(3600, 600, 1 << 20),
    RollPolicy(None, None, None),
]


@pytest.mark.parametrize("policy", POLICIES, ids=str)
def test_one_chunk(spark, policy):
    rows = hot_rows()
    assert assigned(frame(spark, rows), policy, 3) == expected(rows, policy, 3)


@pytest.mark.parametrize("policy", POLICIES, ids=str)
def test_a_hot_hour_over_many_chunks(spark, policy):
    rows = hot_rows()
    got = assigned(frame(spark, rows), policy, 1, chunk_rows=130)
    assert got == expected(rows, policy, 1)


def test_folding_in_several_levels(spark):
    rows, policy = hot_rows(), RollPolicy(30, 4.9, 2500)
    got = assigned(frame(spark, rows), policy, 2, chunk_rows=250, fold_rows=500)
    assert got == expected(rows, policy, 2)


@pytest.mark.parametrize("policy", POLICIES, ids=str)
def test_spans_too_long_to_compose_are_walked_in_order(spark, policy):
    rows = hot_rows()
    df = frame(spark, rows)
    assert assigned(df, policy, 1, chunk_rows=130, fold_rows=1) == expected(rows, policy, 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = assigned(df, policy, 2, chunk_rows=400, fold_rows=1)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == expected(rows, policy, 2)


def test_no_task_composes_more_than_the_bound(spark, tmp_path, monkeypatch):
    """An hour of many rows and no size limit: what tasks compose stays within ``fold_rows``."""

    def measured(make):
        def made(policy, fan):
            work = make(policy, fan)

            def run(rows):
                held = sum(len(x) for x in rows["at_ts"])
                (tmp_path / f"{held}").touch()
                return work(rows)

            return run

        return made

    monkeypatch.setattr(parts, "compose_all", measured(parts.compose_all))
    rng, us, rows = random.Random(3), BASE, []
    for i in range(30_000):
        us += rng.randrange(1, 200_000)
        rows.append((i, us, "hot", rng.randint(1, 90)))
    for policy in (RollPolicy(1800, None, None), RollPolicy(7200, None, None), RollPolicy(None, None, 1 << 27)):
        got = assigned(frame(spark, rows), policy, 1, chunk_rows=500, fold_rows=4000)
        assert got == expected(rows, policy, 1)
    assert max([int(x.name) for x in tmp_path.iterdir()], default=0) <= 4000


def test_chunks_smaller_than_a_part(spark):
    rows, policy = hot_rows(1200), RollPolicy(3000, None, 40_000)
    got = assigned(frame(spark, rows), policy, 1, chunk_rows=60, fold_rows=1)
    assert got == expected(rows, policy, 1)


def test_copies_of_one_record_spread_over_chunks(spark):
    rows = [(5, BASE, "h", 10)] * 900 + [(i, BASE + i, "h", 10) for i in range(600)]
    policy = RollPolicy(None, None, 95)
    df = frame(spark, rows)
    assert assigned(df, policy, 1, chunk_rows=100) == expected(rows, policy, 1)
    ordered = parts.assign_parts(df, policy, size=F.col("size"), keep=[], chunk_rows=100)
    largest = ordered.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 400


def test_state_crosses_arrow_batches(spark):
    rows, policy = hot_rows(1000), RollPolicy(40, 4.9, 1500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = assigned(frame(spark, rows), policy, 1, chunk_rows=300)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    assert got == expected(rows, policy, 1)


def test_lost_tasks_are_repeated(spark, monkeypatch):
    """Every second task of both passes fails once, half way through its rows."""

    def flaky(make):
        def made(*args):
            work = make(*args)

            def run(batches):
                task = TaskContext.get()
                yield from work(batches)
                if task.attemptNumber() == 0 and task.partitionId() % 2:
                    raise RuntimeError("lost")

            return run

        return made

    monkeypatch.setattr(parts, "number_parts", flaky(parts.number_parts))
    monkeypatch.setattr(parts, "describe_chunk", flaky(parts.describe_chunk))
    rows, policy = hot_rows(1500), RollPolicy(30, 4.9, 2500)
    assert assigned(frame(spark, rows), policy, 1, chunk_rows=200) == expected(rows, policy, 1)


def test_no_rows(spark):
    df = frame(spark, [])
    assert assigned(df, RollPolicy(), 1) == []
    assert assigned(df, RollPolicy(), 1, min_chunks=3) == []


def test_null_instant_is_an_error(spark):
    df = spark.createDataFrame([(1, None, "h", 1)], DATA_SCHEMA).withColumn(
        "ts", F.timestamp_micros("us")
    )
    with pytest.raises(Exception):
        parts.assign_parts(df, size=F.col("size"), keep=[]).collect()


def test_default_policy_on_a_steady_stream(spark):
    """At two records a second only the age rule is live."""
    records = as_records(
        spark.range(2400), F.col("id"), F.timestamp_micros(F.lit(BASE) + F.col("id") * 500_000)
    )
    summary = parts.part_summary(parts.assign_parts(records, chunk_rows=500))
    rows = summary.orderBy("bucket", "part").collect()
    assert [r["records"] for r in rows] == [240] * 10
    assert all(r["bytes"] == 240 * 61 or r["bytes"] > 0 for r in rows)
    assert sum(r["records"] for r in rows) == 2400


def test_part_bounds(spark):
    rows, policy = hot_rows(), RollPolicy(20, 4.5, 2000)
    df = frame(spark, rows)
    summary = parts.part_summary(
        parts.assign_parts(df, policy, 1, size=F.col("size"), keep=[], chunk_rows=500)
    )
    worst = summary.agg(
        F.max("bytes"), F.max(F.unix_micros("closed") - F.unix_micros("opened")), F.sum("records")
    ).first()
    assert worst[0] <= 2000 + 90
    assert worst[1] < 20_000_000
    assert worst[2] == len(rows)


def test_kept_columns_and_plan(spark):
    rows = hot_rows(1500)
    df = frame(spark, rows).withColumn("note", F.concat(F.lit("n"), F.col("index")))
    out = parts.assign_parts(df, RollPolicy(), size=F.col("size"), keep=["note"], chunk_rows=400)
    assert out.columns == ["bucket", "ts", "index", "note", "subtask", "size", "part"]
    assert out.filter(F.col("note") != F.concat(F.lit("n"), F.col("index"))).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The sorted rows are not shuffled again; only the small spans are.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_groups_that_fit_need_one_shuffle_and_no_checkpoint(spark):
    out = parts.assign_parts(frame(spark, hot_rows(500)), size=F.col("size"), keep=[])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "ExistingRDD[bucket" not in plan


@pytest.mark.parametrize("chunk_rows, chunked", [(12_000, False), (2000, True)])
def test_the_largest_group_decides(spark, chunk_rows, chunked):
    rows, policy = hot_rows(), RollPolicy(20, 4.5, 2000)
    df = frame(spark, rows)
    out = parts.assign_parts(df, policy, size=F.col("size"), keep=[], chunk_rows=chunk_rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == chunked
    assert sorted(map(tuple, out.select("bucket", "subtask", "index", "part").collect())) == expected(
        rows, policy, 1
    )


def test_layout_and_names(spark):
    summary = spark.createDataFrame(
        [("2025-10-10--17", 0, 9, 3, 30), ("2025-10-10--17", 0, 10, 2, 20), ("2025-10-10--16", 1, 0, 1, 10)],
        "bucket string, subtask long, part long, records long, bytes long",
    )
    newest = parts.last_parts(summary, 2).select(parts.part_name().alias("n")).collect()
    assert [r.n for r in newest] == ["2025-10-10--17/part-0-10", "2025-10-10--17/part-0-9"]
    assert parts.layout_summary(summary).first().asDict() == {"parts": 3, "records": 6, "bytes": 60}
    assert parts.layout_summary(summary.limit(0)).first().asDict() == {"parts": 0, "records": 0, "bytes": 0}
