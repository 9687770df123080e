"""Quality rules whose limits follow the data.

Every text gets a few measures. Their distributions are kept per language and source as
sketches: counts of logarithmic cells one hundredth wide, so a sketch is a bounded table of
integers, two sketches are merged by adding counts, and a quantile is off by one cell at
most. Limits are read from the sketches: median plus a multiple of the spread of the middle
half. Every language and source borrows a fixed number of rows from its language, and that one
from everything: they stand at the quartiles of the wider sketch, so they are the whole of a
group without rows and nothing to a large one, and limits move smoothly as a group grows. The
limits are joined back and rows outside of them are dropped. A share over few words or lines
strays by chance, so a text may exceed a limit by the sampling error of a share that size.

Defined results: a null text has no words; null languages and sources form groups of their
own; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import (
    WHITE, hash_words, keep, mix, per_row, session, slices, table, white_words, window_hashes,
)

SYMBOLS = b"#*$%&|<>"
_NOT_POINTS = WHITE + bytes(range(0x80, 0xC0))

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
_COUNT_SCHEMA = [pa.field(x.split()[0], pa.int64()) for x in COUNTS.split(", ")]


class Measure(NamedTuple):
    """A count per word or line, in thousandths."""

    count: str
    of: str
    bad: str  # whether a low value, a high value or both is bad
    slack: int  # thousandths a limit always leaves above or below
    run: int  # words or lines that come together, of which a share is one observation


MEASURES = {
    "word_length": Measure("word_chars", "n_words", "both", 100, 0),
    "symbols": Measure("n_symbols", "n_words", "high", 100, 0),
    "dup_lines": Measure("n_dup_lines", "n_lines", "high", 50, 1),
    "repeats": Measure("n_repeat_words", "n_words", "high", 80, 9),
}


@dataclass(frozen=True)
class Rules:
    """Fixed floors of the contract and the freedom left around the measured middle."""

    min_words: int = 50
    max_repeat_percent: int = 50
    spread: float = 6.0  # half-spreads from the median to a limit
    mean_error: int = 8000  # thousandths a mean length strays, over the root of its words
    share_error: float = 3.5  # sampling errors a share may exceed its limit by
    borrowed: int = 10  # rows borrowed at each quartile of the wider sketch
    salts: int = 32


def measure(docs: DataFrame, text: str = "text", *columns: str) -> DataFrame:
    """``columns`` and the counts of every whole text, one pass, nothing shuffled."""
    out = docs.select(*columns, F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, white_words):
            counts = part.counts
            hashes = hash_words(part.words)
            at = part.starts(3)
            grams = window_hashes(hashes, 3)[at] ^ mix(part.rows()[at].astype(np.uint64))
            order = np.argsort(grams, kind="stable")
            same = grams[order][1:] == grams[order][:-1]
            twice = np.zeros(len(grams), bool)
            twice[order[1:]] |= same
            twice[order[:-1]] |= same
            covered = np.zeros(len(hashes), np.int64)
            for i in range(3):
                covered[at[twice] + i] = 1
            chars, symbols, dups, full = [], [], [], []
            for x in part.texts:
                chars.append(len(x.translate(None, _NOT_POINTS)))
                symbols.append(len(x) - len(x.translate(None, SYMBOLS)))
                lines = [y for y in x.split(b"\n") if y.strip()]
                dups.append(len(lines) - len(set(lines)))
                full.append(len(lines))
            kept = part.batch.select(list(columns))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *(pa.array(x, pa.int64()) for x in
                 (counts, chars, symbols, dups, per_row(covered, part.bounds), full))],
                schema=pa.schema([*kept.schema, *_COUNT_SCHEMA]),
            )

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    return out.mapInArrow(run, ", ".join([*kinds, COUNTS]))


def cell(value: Column) -> Column:
    """Cell of a sketch; 0 holds the values below one thousandth."""
    return F.when(value < 1, F.lit(0)).otherwise(F.ceil(F.log(value) * 100)).cast("int")


def value_of(cell_: Column) -> Column:
    return F.when(cell_ == 0, F.lit(0.0)).otherwise(F.exp(cell_ / 100.0))


def thousandths(m: Measure) -> Column:
    return F.col(m.count) * 1000.0 / F.greatest(F.col(m.of), F.lit(1))


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, measure, cell, rows``. Added up on the map side, so a hot source sends
    a few thousand numbers from each task."""
    each = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), cell(thousandths(m)).alias("cell"))
        for name, m in MEASURES.items()
    ])).alias("m")
    return (
        measured.filter("n_words > 0")
        .select("lang", "source", each)
        .groupBy("lang", "source", "m.measure", "m.cell")
        .agg(F.count("*").alias("rows"))
    )


def merge(sketch: DataFrame, *groups: str) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return sketch.groupBy(*groups, "measure", "cell").agg(F.sum("rows").alias("rows"))


def quartiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """``groups, measure, cells``: where a quarter, half and three quarters of the rows of each
    sketch end."""
    group = Window.partitionBy(*groups, "measure")
    upto = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sketch.select(
        *groups, "measure", "cell",
        F.sum("rows").over(upto).alias("upto"), F.sum("rows").over(group).alias("n"),
    )
    return ranked.groupBy(*groups, "measure").agg(F.array(*[
        F.min(F.when(F.col("upto") >= F.col("n") * q, F.col("cell"))) for q in (0.25, 0.5, 0.75)
    ]).alias("cells"))


def borrow(sketch: DataFrame, groups: list[str], wider: DataFrame, shared: list[str], rules: Rules) -> DataFrame:
    """Each group's sketch with ``borrowed`` rows at each quartile of the wider one it is part of."""
    fine = sketch.select(*groups, "measure").distinct().alias("fine")
    same = F.col("fine.measure") == F.col("wider.measure")
    for c in shared:
        same &= F.col(f"fine.{c}").eqNullSafe(F.col(f"wider.{c}"))
    lent = fine.join(wider.alias("wider"), same).select(
        "fine.*", F.explode("wider.cells").alias("cell"), F.lit(rules.borrowed).cast("long").alias("rows")
    )
    return sketch.unionByName(lent)


def limits(sketch: DataFrame, rules: Rules) -> DataFrame:
    """``lang, source`` and a low and a high limit of every measure."""
    every = quartiles(merge(sketch), [])
    lang = quartiles(borrow(merge(sketch, "lang"), ["lang"], every, [], rules), ["lang"])
    own = quartiles(borrow(sketch, ["lang", "source"], lang, ["lang"], rules), ["lang", "source"])
    first, middle, third = (value_of(F.get("cells", F.lit(i))) for i in range(3))
    slack = F.element_at(F.create_map(*[
        F.lit(x) for name, m in MEASURES.items() for x in (name, m.slack)
    ]), F.col("measure"))
    high = middle + rules.spread * (third - middle) + slack
    low = middle - rules.spread * (middle - first) - slack
    return own.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == name, edge)).alias(f"{name}_{side}")
        for name, m in MEASURES.items()
        for side, edge in (("low", low), ("high", high))
        if m.bad in (side, "both")
    ])


def beyond(m: Measure, high: Column, rules: Rules) -> Column:
    """Thousandths a text may lie beyond a limit by chance."""
    n = F.greatest(F.col(m.of), F.lit(1))
    if m.run:
        share = F.least(high, F.lit(1000.0)) / 1000.0
        return 1000 * rules.share_error * F.sqrt(share * (1 - share) * m.run / n)
    return rules.mean_error / F.sqrt(n) if m.bad == "both" else F.lit(0.0)


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept``, ``n_lines`` and the limits that held."""
    session(docs.sparkSession)
    measured = keep(measure(docs, "text", "doc_id", "lang", "source"), "measured")
    # The limits of a hot source go to many tasks: they are repeated once per salt.
    salted = limits(sketches(measured), rules).withColumnsRenamed(
        {"lang": "_lang", "source": "_source"}
    ).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(rules.salts - 1))))
    rows = measured.withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(rules.salts)).cast("int")
    )
    joined = rows.join(
        salted,
        (rows["salt"] == salted["_salt"])
        & rows["lang"].eqNullSafe(salted["_lang"])
        & rows["source"].eqNullSafe(salted["_source"]),
        "left",
    )
    inside = F.lit(True)
    for name, m in MEASURES.items():
        if m.bad in ("low", "both"):
            low = F.coalesce(F.col(f"{name}_low"), F.lit(0.0))
            inside &= thousandths(m) + beyond(m, low, rules) >= low
        if m.bad in ("high", "both"):
            high = F.coalesce(F.col(f"{name}_high"), F.lit(float("inf")))
            inside &= thousandths(m) - beyond(m, high, rules) <= high
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    edges = [f"{name}_{s}" for name, m in MEASURES.items() for s in ("low", "high")
             if m.bad in (s, "both")]
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & inside).alias("kept"), "n_lines", *edges,
    )
