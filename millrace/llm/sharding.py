"""Jump consistent hashing: a shard from a stable key and the number of shards.

The key starts a linear congruential generator; each step says at how many shards the key
moves next, and the last step below the number of shards is the shard. No table of the ring
exists, and one more shard takes rows only into itself. All of it is SQL arithmetic; decimals
hold the products, so nothing overflows.

Defined results: a null key counts as the text ``''``; equal rows get equal shards and
different slots; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import keep, number, session

# Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757
WORD = 1 << 64


def jump(key: Column, shards: int) -> Column:
    """Shard of a 64-bit key among ``shards``."""
    wide = "decimal(20,0)"
    word = F.lit(str(WORD)).cast(wide)
    state = F.when(key < 0, key.cast(wide) + word).otherwise(key.cast(wide)).cast(wide)
    start = F.struct(
        state.alias("key"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j")
    )

    def step(at: Column, _: Column) -> Column:
        product = at["key"] * F.lit(str(MULTIPLIER)).cast("decimal(19,0)")
        key_ = ((product + F.lit(1).cast("decimal(1,0)")) % word).cast(wide)
        high = F.floor(key_ / F.lit(1 << 33).cast("decimal(10,0)")).cast("long")
        return F.struct(
            key_.alias("key"),
            at["j"].alias("b"),
            F.floor((at["j"] + 1) * (F.lit(float(1 << 31)) / (high + 1).cast("double")))
            .cast("long").alias("j"),
        )

    def move(at: Column, i: Column) -> Column:
        return F.when(at["j"] < shards, step(at, i)).otherwise(at)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, move)["b"].cast("int")


def key_of(column: str) -> Column:
    """64-bit key of a value, from its text, so 7 and '7' agree."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def shard(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, shard, slot, grown_shard`` of every row."""
    session(docs.sparkSession)
    text_ = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        key,
        (F.octet_length(text_).cast("long") + 16).alias("size"),
        F.crc32(text_.cast("binary")).alias("text_crc32"),
        key_of(key).alias("_key"),
    )
    rows = rows.withColumns({"shard": jump(F.col("_key"), shards),
                             "grown_shard": jump(F.col("_key"), shards + 1)})
    # A written row has a place of its own, so copies of a row spread like other rows.
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    placed = keep(rows.drop("_key"), "placed").select("*", place.alias("_place"))
    largest = placed.groupBy("shard").count().agg(F.max("count")).first()[0] or 0  # one row
    numbered = number(placed, ["shard"], F.col("_place"), ["_place"], "slot", largest)
    return numbered.drop("_place")
