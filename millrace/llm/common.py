"""What the operators of this package share: word splitting inside tasks, keys that do not
trust ``doc_id``, scratch tables, bit filters of fixed size and numbering without a single
sorted group.

Texts reach Python as Arrow binary, so no decoding can fail, and are handled in slices of
at most ``SLICE_BYTES`` whatever the batch size (a longer text is a slice of its own).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.session import scratch_path, ship_package

SLICE_BYTES = 1 << 20

WHITE = b" \t\n\x0b\x0c\r"
lower_case = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)

U = np.uint64
ODD_1, ODD_2, ODD_3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def white_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return text.split()


def lower_white_words(text: bytes) -> list[bytes]:
    """The same of the text with A-Z in lower case."""
    return text.translate(lower_case).split()


def letter_words(text: bytes) -> list[bytes]:
    """Words of letters, digits and all non-ASCII characters, A-Z in lower case."""
    return only_letters(text).split()


def only_letters(text: bytes) -> bytes:
    """The same with a blank for everything else."""
    return text.translate(_LETTERS)


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word. Spark gives all Python workers of an application one hash
    seed, so they agree; a process without one has only itself to agree with."""
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> U(30))) * ODD_2
    values = (values ^ (values >> U(27))) * ODD_3
    return values ^ (values >> U(31))


def window_hashes(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words; shorter by ``width - 1``."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, U(seed), np.uint64)
    for i in range(width):
        total = total * ODD_1 + hashes[i : i + count]
    return mix(total)


class Slice:
    """Texts of a few rows with their words in one array: ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, batch: pa.RecordBatch, texts: list[bytes], split) -> None:
        self.batch, self.texts = batch, texts
        self.words: list[bytes] = []
        self.bounds = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            self.words += split(text)
            self.bounds[i + 1] = len(self.words)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        return hash_words(self.words)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.texts)), self.counts)

    def starts(self, width: int) -> np.ndarray:
        """Words at which ``width`` words of one row begin."""
        last = len(self.words) - width + 1
        if last <= 0:
            return np.empty(0, np.int64)
        rows = self.rows()
        return np.flatnonzero(rows[:last] == rows[width - 1 :])


def slices(
    batches: Iterator[pa.RecordBatch], split, text: str = "text", most: int = SLICE_BYTES
) -> Iterator[Slice]:
    """Cut Arrow batches into slices of about ``most`` bytes; null texts are empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[
            column.offset : column.offset + len(column) + 1
        ]) if len(column) else np.zeros(0, np.int64)
        first, size = 0, 0
        for i in range(len(sizes)):
            if size and size + sizes[i] > most:
                yield _slice(batch, column, first, i, split)
                first, size = i, 0
            size += int(sizes[i]) + 64
        if first < len(sizes):
            yield _slice(batch, column, first, len(sizes), split)


def give_back() -> None:
    """Hand freed memory back to the machine. Arrow and the C library keep it for the process, and
    a worker serves many tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def _slice(batch, column, first: int, end: int, split) -> Slice:
    texts = [x or b"" for x in column.slice(first, end - first).to_pylist()]
    return Slice(batch.slice(first, end - first), texts, split)


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` per row."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def binary_list(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary column holding the raw numbers of each row."""
    raw, width = np.ascontiguousarray(values).tobytes(), values.dtype.itemsize
    return pa.array(
        [raw[a * width : b * width] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())],
        pa.binary(),
    )


def longs(values: np.ndarray) -> pa.Array:
    """64-bit hashes as signed numbers, as Spark has no unsigned ones."""
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


def table(rows: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in
         ((rows[f.name], f) for f in schema)],
        schema=schema,
    )


def session(spark: SparkSession) -> SparkSession:
    """Executors need this package for the functions below."""
    return ship_package(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it: cuts the lineage, and a lost
    executor costs no more than the task that read from the table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key() -> Column:
    """Hash of the id and the text of a row; a null id differs from all others."""
    return F.xxhash64(F.col("doc_id"), F.col("text"), F.col("doc_id").isNull())


def bucket_count(docs: DataFrame, bucket_bytes: int) -> int:
    """How many buckets keep about ``bucket_bytes`` of text behind each, at any size."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * least, total // bucket_bytes)


def with_key(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id, row_key`` and the named columns. Rows that agree in id and text share a key
    and hence every result; null ids and repeated ids with other texts stay apart."""
    return docs.select("doc_id", row_key().alias("row_key"), *columns)


def attach(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Left join on the key of :func:`with_key`; ``found`` has at most a row per key."""
    found = found.withColumnsRenamed({"doc_id": "_id", "row_key": "_key"})
    same = (docs["row_key"] == found["_key"]) & docs["doc_id"].eqNullSafe(found["_id"])
    return docs.join(found, same, "left").drop("_id", "_key")


def number(rows: DataFrame, groups: list[str], salt: Column, order: list, name: str, total: int,
           most: int = 100_000) -> DataFrame:
    """Number the rows of each group without gaps from 0, in no order that matters.

    A group is spread over buckets by ``salt``; buckets are counted, and the rows of a
    bucket numbered from where the buckets before it end. The number of buckets follows
    ``total``, so a bucket holds about ``most`` rows at any size and skew.
    """
    buckets = -(-total // most) + 8
    columns = rows.columns
    rows = rows.withColumn("_bucket", F.pmod(salt, F.lit(buckets)).cast("int"))
    keys = [*groups, "_bucket"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = counts.select(*keys, (F.sum("_rows").over(before) - F.col("_rows")).alias("_first"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.join(offsets, keys).select(*columns, (F.col("_first") + inside - 1).alias(name))


# A filter of fixed size says for sure that a hash was not seen. It bounds what is
# broadcast: beyond its capacity it lets more through, which costs time, never rows.
FILTER_BITS = 28
FILTER_PROBES = 3
PART_BITS = 20
HANDED = 1 << 21  # bytes of a filter that come to the driver at once


def filter_position(hashes: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """Bit of each hash for a probe; all probes of a hash lie in one line of 512 bits, so that
    a lookup touches one place in memory."""
    line = (hashes >> U(64 - (bits - 9))) << U(9)
    return (line | ((hashes * ODD_1 >> U(9 * probe + 3)) & U(511))).astype(np.int64)


def set_bits(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Set the bits of hashes in a part of the filter, a byte per bit; tells which were set."""
    seen = np.ones(len(hashes), bool)
    for probe in range(FILTER_PROBES):
        at = filter_position(hashes, probe, bits) & (len(bitmap) - 1)
        seen &= bitmap[at] == 1
    for probe in range(FILTER_PROBES):
        bitmap[filter_position(hashes, probe, bits) & (len(bitmap) - 1)] = 1
    return seen


def hash_chunks(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[np.ndarray]:
    """Hashes of a binary column, about ``most`` at a time."""
    held, size = [], 0
    for batch in batches:
        for raw in batch.column("hashes"):
            held.append(np.frombuffer(raw.as_buffer(), np.uint64) if raw.is_valid else EMPTY)
            size += len(held[-1])
            if size >= most:
                yield np.concatenate(held)
                held, size = [], 0
    if size:
        yield np.concatenate(held)


EMPTY = np.empty(0, np.uint64)


def filter_parts(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts of a filter that ascending hashes fall in, and where each part's end."""
    part = values >> U(63 - (bits - min(PART_BITS, bits))) >> U(1)
    ends = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(values)]])
    return part[ends[:-1]].astype(np.int32), ends


def join_filter(parts: DataFrame, bits: int) -> bytearray:
    """The filter from its parts ``part, bits``. Of a large one a few parts come at a time, so the
    driver holds it once and not its rows too; as bytes, it needs no copy to be broadcast."""
    whole = bytearray((1 << bits) // 8)
    size = (1 << min(PART_BITS, bits)) // 8
    parts, goes = parts.select("part", "bits"), -(-len(whole) // HANDED)
    rows = parts.collect() if goes == 1 else parts.repartition(goes).toLocalIterator()
    for row in rows:  # the size of the filter
        whole[row["part"] * size : (row["part"] + 1) * size] = row["bits"]
    return whole


def build_filter(hashed: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The filter of :func:`filter_bytes` as an array."""
    return np.frombuffer(filter_bytes(hashed, bits), np.uint8)


def filter_bytes(hashed: DataFrame, bits: int = FILTER_BITS) -> bytearray:
    """Bit filter of a table with a binary column ``hashes`` of 64-bit numbers.

    Tasks send hashes to the part of the filter they fall in; parts are put together by tasks
    and only the filter itself, 2^bits bits, comes to the driver.
    """
    part_bits = min(PART_BITS, bits)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("hashes", pa.binary())])
        for values in hash_chunks(batches):
            values = np.unique(values)
            part, ends = filter_parts(values, bits)
            yield table({"part": part, "hashes": binary_list(values, ends)}, schema)

    def gather(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(1 << part_bits, np.uint8)
        for batch in batches:
            for raw in batch.column("hashes"):
                set_bits(bitmap, np.frombuffer(raw.as_buffer(), np.uint64), bits)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([key[0].as_py()], pa.int32()), "bits": [np.packbits(bitmap).tobytes()]}
        )

    parts = (
        hashed.select("hashes")
        .mapInArrow(scatter, "part int, hashes binary")
        .groupBy("part")
        .applyInArrow(gather, "part int, bits binary")
    )
    return join_filter(parts, bits)


def in_filter(filter_: np.ndarray, hashes: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    """Whether each hash may have been seen; later probes look only at what passed before."""
    at = np.arange(len(hashes))
    for probe in range(FILTER_PROBES):
        p = filter_position(hashes[at], probe, bits)
        at = at[(filter_[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1]
    hit = np.zeros(len(hashes), bool)
    hit[at] = True
    return hit


def pack_hashes(hashes: DataFrame) -> DataFrame:
    """Binary column ``hashes`` of a column ``h`` of numbers, a value per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column("h").to_numpy(zero_copy_only=False), np.int64)
            ends = np.array([0, len(values)])
            yield pa.RecordBatch.from_arrays([binary_list(values, ends)], names=["hashes"])

    return hashes.mapInArrow(run, "hashes binary")
