"""Benchmark decontamination by a prefix-filtered join of word shingles.

A benchmark item is cut into windows of ``width`` consecutive words (a shorter item is one
window). A text contains a window if it contains all of its shingles in place, so one of
them is enough to find every copy: the necessary prefix of an exact containment is a single
token. Shingles are ordered by how often they occur in all texts, and each window is looked
up by its rarest one. A place of that shingle in a text fixes where the window would stand;
the place must leave room for the words before and after it, and the words there are then
compared in full.

Filters of fixed size, made from the benchmark, keep other shingles of the texts inside
their task; what passes by chance drops out in the join. Both sides of the join are spread
by a salt, so a passage in a third of the texts is the work of many tasks.

Defined results: a null text or item has no words; an item with a null id counts as a hit
but is not listed; repeated rows are judged alike; empty tables give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import (
    attach, build_filter, in_filter, keep, letter_words, longs, pack_hashes, session, slices,
    table, window_hashes, with_key,
)

BITS = 22
SALTS = 16


def shingle_width(words: int, shingle: int) -> int:
    return min(shingle, words)


def item_windows(items: DataFrame, width: int, shingle: int) -> DataFrame:
    """``item_id, window, words, shingles``: every window of every item, its text with words
    joined by one space, and its shingle hashes in order."""
    schema = pa.schema([
        ("item_id", pa.string()),
        ("window", pa.string()), ("words", pa.int32()), ("shingles", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, letter_words):
            hashes, ids = part.hashes(), part.batch.column("item_id").to_pylist()
            out = {"item_id": [], "window": [], "words": [], "shingles": []}
            for i, (a, b) in enumerate(zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist())):
                n = min(width, b - a)
                if not n:
                    continue
                w = shingle_width(n, shingle)
                grams = window_hashes(hashes[a:b], w, w).view(np.int64).tolist()
                for s in range(b - a - n + 1):
                    out["item_id"].append(ids[i])
                    out["window"].append(b" ".join(part.words[a + s : a + s + n]).decode("utf-8", "replace"))
                    out["words"].append(n)
                    out["shingles"].append(grams[s : s + n - w + 1])
            yield table(out, schema)

    return items.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).mapInArrow(
        run, "item_id string, window string, words int, shingles array<long>"
    )


def shingle_counts(docs: DataFrame, widths: list[int], filter_: np.ndarray) -> DataFrame:
    """``shingle, n``: places in all texts of the shingles that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_)
    schema = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, letter_words):
            hashes = part.hashes()
            for w in widths:
                grams = window_hashes(hashes, w, w)[part.starts(w)]
                found, n = np.unique(grams[in_filter(shared.value, grams, BITS)], return_counts=True)
                yield table({"shingle": longs(found), "n": n.astype(np.int64)}, schema)

    counted = docs.select(F.col("text").cast("binary")).mapInArrow(run, "shingle long, n long")
    return counted.groupBy("shingle").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``shingle, offset, window, words``: each distinct window under its rarest shingle."""
    each = windows.dropDuplicates(["window"]).select(
        "window", "words", F.posexplode("shingles").alias("offset", "shingle")
    )
    rare = each.join(counts, "shingle", "left").select(
        "*", F.coalesce("n", F.lit(0)).alias("places")
    )
    first = F.min(F.struct("places", "offset", "shingle")).alias("first")
    chosen = rare.groupBy("window", "words").agg(first)
    return chosen.select("window", "words", "first.shingle", "first.offset")


def places(docs: DataFrame, widths: list[int], width: int, filter_: np.ndarray) -> DataFrame:
    """Per text its number of words and the places whose shingle passes the filter, each with
    the words around it: all that any window over the place can cover."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_)
    place = pa.struct([
        ("shingle", pa.int64()), ("place", pa.int64()), ("before", pa.int32()), ("around", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, letter_words):
            hashes, rows = part.hashes(), part.rows()
            found: list[list] = [[] for _ in part.texts]
            for w in widths:
                starts = part.starts(w)
                grams = window_hashes(hashes, w, w)[starts]
                hit = in_filter(shared.value, grams, BITS)
                for at, gram in zip(starts[hit].tolist(), grams[hit].view(np.int64).tolist()):
                    r = int(rows[at])
                    a, b = int(part.bounds[r]), int(part.bounds[r + 1])
                    low, high = max(a, at - width), min(b, at + width)
                    around = b" ".join(part.words[low:high]).decode("utf-8", "replace")
                    found[r].append((gram, at - a, at - low, around))
            names = ["doc_id", "row_key"]
            yield pa.RecordBatch.from_arrays(
                [*(part.batch.column(x) for x in names), pa.array(part.counts, pa.int64()),
                 pa.array([[dict(zip(("shingle", "place", "before", "around"), x)) for x in y]
                           for y in found], pa.list_(place))],
                names=[*names, "n_words", "places"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_key(docs, F.col("text").cast("binary").alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, row_key long, n_words long, "
        "places array<struct<shingle:long,place:long,before:int,around:string>>",
    )


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, shingle: int = 3) -> DataFrame:
    """``doc_id, row_key, n_words, n_hit, n_items, items``: the words inside any occurrence of
    a window and the sorted items those windows come from."""
    session(docs.sparkSession)
    windows = keep(item_windows(items, width, shingle), "windows")
    lengths = [r["words"] for r in windows.select("words").distinct().collect()]  # <= width rows
    widths = sorted({shingle_width(n, shingle) for n in lengths})

    def filter_of(column, rows: DataFrame) -> np.ndarray:
        hashed = rows.select(F.explode(column).alias("h")) if column is not None else rows
        return build_filter(pack_hashes(hashed), BITS)

    counts = shingle_counts(docs, widths, filter_of(F.col("shingles"), windows))
    index = keep(prefixes(windows, counts), "prefixes")
    probe = filter_of(None, index.select(F.col("shingle").alias("h")))
    looked = keep(places(docs, widths, width, probe), "places")

    # Every row of the index meets a place under one of SALTS salts.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = index.select("shingle", "offset", "words", "window", salts)
    each = looked.select("doc_id", "row_key", "n_words", F.explode("places").alias("at")).select(
        "doc_id", "row_key", "n_words", "at.*",
        F.pmod(F.xxhash64("row_key", "at.place"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    start = F.col("place") - F.col("offset")
    inside = (start >= 0) & (start + F.col("words") <= F.col("n_words"))
    first = F.greatest(F.col("before") - F.col("offset"), F.lit(0)) + 1
    same = F.array_join(F.slice(F.split("around", " "), first, F.col("words")), " ") == F.col("window")
    found = keep(
        each.join(salted, ["shingle", "salt"]).filter(inside & same)
        .select("doc_id", "row_key", start.alias("start"), "words", "window").distinct(),
        "found",
    )

    # Words under overlapping windows count once: each adds what reaches past those before.
    group = ["doc_id", "row_key"]
    before = Window.partitionBy(*group).orderBy("start", "words").rowsBetween(
        Window.unboundedPreceding, -1
    )
    end = F.col("start") + F.col("words")
    reach = F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0)))
    covered = (
        found.select(*group, "start", "words").distinct()
        .withColumn("new", F.greatest(end - reach, F.lit(0)))
        .groupBy(*group).agg(F.sum("new").alias("n_hit"))
    )
    sources = windows.select("item_id", "window").distinct().withColumn("salt", salts)
    spread = F.pmod(F.col("row_key"), F.lit(SALTS)).cast("int").alias("salt")
    listed = (
        found.select(*group, "window", spread).distinct().join(sources, ["window", "salt"])
        .groupBy(*group).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    per_doc = covered.withColumnsRenamed({"doc_id": "i", "row_key": "k"}).join(
        listed, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("row_key")), "left"
    ).select(F.col("i").alias("doc_id"), F.col("k").alias("row_key"), "n_hit", "items")
    none = F.array().cast("array<string>")
    items_ = F.coalesce("items", none)
    return attach(looked.select(*group, "n_words"), per_doc).select(
        *group, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(items_).cast("long").alias("n_items"), items_.alias("items"),
    )
