"""Parts decided on a stream against those of the finite table."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.policy import RollPolicy
from millrace.streaming.live_parts import assign_live, part_writer
from test_parts import BASE, expected, hot_rows
from test_rolling import one_by_one

SCHEMA = "index long, us long, bucket string, size long, ts timestamp, foams string"


class Feed:
    """Rows that reach a stream batch by batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def add(self, rows, partitions=3):
        df = self.spark.createDataFrame(rows, "index long, us long, bucket string, size long")
        df = df.withColumns({"ts": F.timestamp_micros("us"), "foams": F.format_string("line %d", "index")})
        df.repartition(partitions).write.mode("append").parquet(f"{self.folder}/source")

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).parquet(f"{self.folder}/source")

    def run(self, policy, parallelism=1):
        """One run of the job: it takes what has come since the last and ends."""
        out = assign_live(self.stream(), policy, parallelism, size=F.col("size"), keep=[])
        writer = out.select("bucket", "subtask", "index", "part").writeStream.format("parquet")
        writer = writer.option("path", f"{self.folder}/out").option("checkpointLocation", f"{self.folder}/state")
        writer.trigger(availableNow=True).start().awaitTermination()

    def parts(self):
        return sorted(map(tuple, self.spark.read.parquet(f"{self.folder}/out").collect()))


@pytest.mark.parametrize("policy", [
    RollPolicy(20, 4.5, 2000), RollPolicy(60, None, None),
], ids=str)
def test_batches_and_restarts_give_the_parts_of_the_finite_table(spark, tmp_path, policy):
    rows, feed = hot_rows(1500), Feed(spark, str(tmp_path))
    for first, end in ((0, 20), (20, 700), (700, 1500)):
        feed.add(rows[first:end])
        feed.run(policy, 2)
    assert feed.parts() == expected(rows, policy, 2)


def test_late_records_go_to_the_open_part(spark, tmp_path):
    rng, feed, policy = random.Random(2), Feed(spark, str(tmp_path)), RollPolicy(30, 8, 900)
    batches = [[(b * 100 + i, BASE + rng.randrange(60_000_000) + b * 20_000_000, "h", rng.randint(1, 90))
                for i in range(60)] for b in range(4)]
    ts, size, order, last = [], [], [], 0
    for rows in batches:
        feed.add(rows)
        feed.run(policy)
        for index, us, _, n in sorted(rows, key=lambda r: (r[1], r[0])):
            last = max(last, us)
            ts.append(last)
            size.append(n)
            order.append(index)
    want = [("h", 0, i, p) for i, p in zip(order, one_by_one(ts, size, policy))]
    assert feed.parts() == sorted(want)


def test_files_of_parts(spark, tmp_path):
    rows, feed, policy = hot_rows(600), Feed(spark, str(tmp_path)), RollPolicy(20, 4.5, 500)
    root, state = str(tmp_path / "table"), str(tmp_path / "state2")
    for first, end in ((0, 300), (300, 600)):
        feed.add(rows[first:end])
        part_writer(feed.stream(), root, state, policy, size=F.col("size"), available_now=True,
                    name="parts").start().awaitTermination()
    written = spark.read.schema("foams string, bucket string, subtask string, part string").text(root)
    got = sorted((r.bucket, int(r.subtask), int(r.foams.split()[1]), int(r.part)) for r in written.collect())
    assert got == expected(rows, policy, 1)
