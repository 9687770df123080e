"""Packing of tokenised texts into windows of a fixed number of tokens.

Texts are tokenised once; each becomes full windows and one shorter rest. Only the numbers
of pieces per length go to the driver: a histogram of at most ``window`` rows whatever the
table. There, all ways to fill a window with up to three pieces (lengths rounded up to
``unit``) are enumerated, and non-negative least squares finds how often to repeat each so
that together they use up the histogram. The counts are rounded, and what is left over is
packed greedily, longest first. The outcome is a short list of ranges: the pieces numbered
so and so among those of their length go to these sequences. Numbering the pieces and
looking up their range are joins over narrow rows.

Defined results: a null text has only the closing token; repeated rows are packed each for
itself; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import keep, lower_case, number, session, slices

CACHED_CHUNKS = 250_000
CACHED_PARTS = 700_000
MARKS = ".,;:!?%&$#*"
LONGEST_CACHED = 64
GROUP = 256  # words encoded together


class Tokens:
    """Ids of texts, as raw unsigned 32-bit numbers.

    No token of this vocabulary reaches over white space, so a text's ids are those of its
    chunks between blanks and line ends, and those of frequent chunks are remembered.
    """

    _made: dict[str, "Tokens"] = {}

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(vocabulary)
        self.known: dict[bytes, bytes] = {b"": b""}
        self.parts: dict[str, bytes] = {"": b""}
        self.ends_word = np.zeros(self.encoder.get_vocab_size(), bool)
        self.ends_word[[i for x, i in self.encoder.get_vocab().items() if x.endswith("</w>")]] = True

    @classmethod
    def of(cls, vocabulary: str) -> "Tokens":
        if vocabulary not in cls._made:
            cls._made[vocabulary] = cls(vocabulary)
        return cls._made[vocabulary]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        # The vocabulary is in lower case; only the spelling of special tokens matters.
        chunks = [(x if b"<|" in x else x.translate(lower_case)).replace(b"\n", b" ").split(b" ")
                  for x in texts]
        known = self.known
        new = list(set(filterfalse(known.__contains__, chain.from_iterable(chunks))))
        if len(known) + len(new) > CACHED_CHUNKS:
            here = set().union(*chunks)  # what is frequent is in these texts too
            self.known = known = {x: y for x, y in known.items() if x in here}
        known.update(zip(new, self.encode(new)))
        found = [b"".join(map(known.__getitem__, x)) for x in chunks]
        for x in new:
            if len(x) > LONGEST_CACHED:
                del known[x]
        return found

    def encode(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk. Marks after a word are words of their own to the vocabulary, so what
        is encoded are the few words and marks that many chunks are made of."""
        texts = b"\n".join(chunks).decode("utf-8", "replace").split("\n") if chunks else []
        pairs = []
        for text in texts:
            word = text.rstrip(MARKS)
            pairs.append((word, text[len(word) :]) if word.isalpha() and word.lower().isalpha()
                         else (text, ""))
        parts = self.parts
        new = {x for pair in pairs for x in pair if x not in parts}
        if len(parts) + len(new) > CACHED_PARTS:
            self.parts = parts = {"": b""}
            new = {x for pair in pairs for x in pair if x}
        found = list(new)
        parts.update(zip(found, self.encode_parts(found)))
        out = [parts[word] + parts[marks] for word, marks in pairs]
        for x in found:
            if len(x) > LONGEST_CACHED:
                del parts[x]
        return out

    def encode_parts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Those of letters are single words to the vocabulary and are encoded
        many at a time: each ends at the one token that ends a word."""
        out = [b""] * len(texts)
        words = [i for i, x in enumerate(texts) if x.isalpha()]
        alone = [i for i, x in enumerate(texts) if not x.isalpha()]
        groups = [words[a : a + GROUP] for a in range(0, len(words), GROUP)]
        joined = [" ".join(texts[i] for i in group) for group in groups]
        for group, found in zip(groups, self._batch(joined)):
            ids = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(group):
                alone += group
                continue
            raw, at = ids.tobytes(), [0, *(ends * 4).tolist()]
            for i, a, b in zip(group, at, at[1:]):
                out[i] = raw[a:b]
        for i, found in zip(alone, self._batch([texts[i] for i in alone])):
            out[i] = array("I", found.ids).tobytes()
        return out

    def _batch(self, texts: list[str]) -> list:
        return self.encoder.encode_batch_fast(texts, add_special_tokens=False)


def pieces(docs: DataFrame, vocabulary: str, window: int = 2048, closing: int = 1) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: the pieces of every whole text."""
    end = np.array([closing], np.uint32).tobytes()
    names = ["start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens.of(vocabulary)
        yield from cut_up(batches, tokens)
        # The worker lives on; its memory is for others now.
        tokens.known, tokens.parts = {b"": b""}, {"": b""}

    def cut_up(batches: Iterator[pa.RecordBatch], tokens: Tokens) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, lambda _: []):
            rows: list[int] = []
            out: dict[str, list[int]] = {x: [] for x in names}
            for i, ids in enumerate(tokens.ids(part.texts)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    raw = ids[4 * start : 4 * (start + window)]
                    rows.append(i)
                    for x, v in zip(names, (start, len(raw) // 4, zlib.crc32(raw), total)):
                        out[x].append(v)
            yield pa.RecordBatch.from_arrays(
                [part.batch.column("doc_id").take(pa.array(rows, pa.int64())),
                 *(pa.array(out[x], pa.int64()) for x in names)],
                names=["doc_id", *names],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    kinds = ", ".join(f"{x} long" for x in names)
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run, f"doc_id {kind}, {kinds}"
    )


def fillings(units: int) -> list[tuple[int, ...]]:
    """All ways to fill ``units`` with one to three sizes, longest first."""
    found: list[tuple[int, ...]] = [(units,)]
    found += [(a, units - a) for a in range(units - 1, units // 2 - 1, -1) if a >= units - a]
    for a in range(units - 2, 0, -1):
        for b in range(min(a, units - a - 1), 0, -1):
            c = units - a - b
            if c <= b:
                found.append((a, b, c))
    return found


def non_negative_least_squares(a: np.ndarray, h: np.ndarray) -> np.ndarray:
    """``x >= 0`` with the least ``|a x - h|``: variables join the solution one by one, the
    most promising first, and leave it when they would turn negative."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ h).max(initial=0.0)))
    for _ in range(3 * n):
        gain = np.where(free, -np.inf, a.T @ (h - a @ x))
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        free[best] = True
        while True:
            trial = np.zeros(n)
            trial[free] = np.linalg.lstsq(a[:, free], h, rcond=None)[0]
            bad = free & (trial <= 1e-12)
            if not bad.any():
                x = trial
                break
            step = x[bad] / np.maximum(x[bad] - trial[bad], 1e-300)
            x = x + step.min() * (trial - x)
            gone = free & (x <= 1e-12)
            if not gone.any():
                gone = bad & (step.min() == np.where(bad, x, np.inf))
            free &= ~gone
            x[~free] = 0.0
            if not free.any():
                break
    return x


def patterns(histogram: np.ndarray, units: int) -> list[tuple[dict[int, int], int]]:
    """What a sequence holds (size -> pieces) and how many sequences are so; together they
    take every piece of ``histogram[size]``."""
    left = histogram.astype(np.int64).copy()
    ways = fillings(units)
    a = np.zeros((units + 1, len(ways)))
    for j, way in enumerate(ways):
        for size in way:
            a[size, j] += 1
    repeats = non_negative_least_squares(a, histogram.astype(float))
    out = []
    for j in np.argsort(-repeats, kind="stable").tolist():
        use = {s: ways[j].count(s) for s in ways[j]}
        times = min(round(repeats[j]), *(int(left[s]) // m for s, m in use.items()))
        if times > 0:
            out.append((use, times))
            for s, m in use.items():
                left[s] -= m * times
    while left.any():
        room, use = units, {}
        for s in np.flatnonzero(left)[::-1].tolist():
            m = min(room // s, int(left[s]))
            if m:
                use[s] = m
                room -= m * s
        times = min(int(left[s]) // m for s, m in use.items())
        out.append((use, times))
        for s, m in use.items():
            left[s] -= m * times
    return out


def ranges(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, ...]]:
    """``size, first, end, sequence, each, slot``: the pieces of a size numbered from first to
    end go to the sequences from ``sequence`` on, ``each`` to one, from place ``slot`` on."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for use, times in plan:
        slot = 0
        for size, each in sorted(use.items(), reverse=True):
            first = taken.get(size, 0)
            out.append((size, first, first + each * times, sequence, each, slot))
            taken[size] = first + each * times
            slot += each
        sequence += times
    return out


def pack(
    parts: DataFrame, window: int = 2048, unit: int = 16, salt: Column | None = None
) -> DataFrame:
    """The columns of ``parts`` with ``sequence_id`` and ``offset``. ``salt`` spreads the pieces
    of a length over tasks; by default copies of a piece stay together."""
    columns = [c for c in parts.columns if c != "_spread"]
    spark = parts.sparkSession
    units = window // unit
    sized = parts.withColumn("_size", F.ceil(F.col("length") / unit).cast("int"))
    counts = {r["_size"]: r["n"] for r in
              sized.groupBy("_size").agg(F.count("*").alias("n")).collect()}  # <= units rows
    histogram = np.array([counts.get(s, 0) for s in range(units + 1)], np.int64)
    rows = ranges(patterns(histogram, units))
    places = spark.createDataFrame(
        rows, "size int, first long, end long, sequence long, each long, slot long"
    )
    ids = ["doc_id", "start", "ids_crc32"]
    ranked = number(
        sized, ["_size"], F.xxhash64(*ids) if salt is None else salt, ids, "_rank",
        int(histogram.max(initial=0)),
    )
    # The list of ranges is bounded by the number of sizes, not by the table.
    inside = (F.col("_size") == F.col("size")) & (F.col("_rank") >= F.col("first")) & (
        F.col("_rank") < F.col("end")
    )
    past = F.col("_rank") - F.col("first")
    placed = ranked.join(F.broadcast(places), inside).select(
        *columns,
        (F.col("sequence") + F.floor(past / F.col("each"))).alias("sequence_id"),
        (F.col("slot") + past % F.col("each")).alias("_slot"),
    )
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return placed.select(
        *columns, "sequence_id", (F.sum("length").over(before) - F.col("length")).alias("offset")
    )


def pack_documents(docs: DataFrame, vocabulary: str, window: int = 2048) -> DataFrame:
    """Tokenise and pack: one row per piece."""
    session(docs.sparkSession)
    parts = keep(pieces(docs, vocabulary, window), "pieces")
    # A written row has a place of its own, so copies of a document spread like other rows.
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    return pack(parts.select("*", place.alias("_spread")), window, salt=F.col("_spread"))
