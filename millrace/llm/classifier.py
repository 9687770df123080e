"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text is a sparse vector: a feature per distinct word (hashed, damped count), a feature per
cell of each structure measure, and the stored length as metadata, scaled to unit length.
The score is a logistic of

    bias + <w, x> + 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so all pairwise interactions cost time linear in the number of features. The model has
``(rank + 1) * 2^bits`` numbers, fixed by its parameters, and is all that is sent to the
executors. It is fitted on labelled rows, at most ``sample`` of them, chosen by the hash of
their id; every row is scored in one pass without a shuffle.

Defined results: null and empty texts are scored by their structure alone; a document with
several labels has the highest; without labelled rows every score is 0.5; repeated rows get
equal scores; an empty table gives an empty result. Labels, language, source and id are
never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import (
    ODD_1, binary_list, hash_words, mix, session, slices, white_words,
)

_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#*$%&|<>"
_ENDS = b".,;:!?"
_DIGITS = bytes(range(48, 58))
_MEASURES = 9


@dataclass(frozen=True)
class Settings:
    bits: int = 16  # hashed features
    rank: int = 8  # numbers per feature in the interactions
    sample: int = 8000  # labelled rows to fit on, at most
    steps: int = 2000  # of ``batch`` rows each, however few rows there are
    batch: int = 48
    rate: float = 0.1
    decay: float = 1e-5
    seed: int = 7


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Rows kept from fitting: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def structure(texts: list[bytes], words: list[int], distinct: np.ndarray, stored) -> np.ndarray:
    """A row of measures for each text, all of the size of 1."""
    out = np.zeros((len(texts), _MEASURES))
    for i, (x, n) in enumerate(zip(texts, words)):
        size, n1 = max(len(x), 1), max(n, 1)
        lines = [y for y in x.split(b"\n") if y.strip()]
        out[i] = (
            (size - len(x.translate(None, _UPPER))) / size * 4,
            (size - len(x.translate(None, _SYMBOLS))) / size * 4,
            (size - len(x.translate(None, _ENDS))) / size * 8,
            (size - len(x.translate(None, _DIGITS))) / size * 8,
            distinct[i] / n1,
            size / n1 / 10,
            np.log1p(n) / 8,
            1 - len(set(lines)) / max(len(lines), 1),
            np.log1p(max(stored[i], 0)) / 10,
        )
    return out


def features(part, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index, value and row bounds of the sparse vectors of a slice."""
    rows = part.rows().astype(np.int64)
    cells = (mix(hash_words(part.words)) >> np.uint64(64 - bits)).astype(np.int64)
    keys, times = np.unique((rows << bits) | cells, return_counts=True)
    row, index, value = keys >> bits, keys & ((1 << bits) - 1), np.log1p(times)
    # Words weigh as much as the measures, however many there are.
    scale = np.sqrt(np.bincount(row, value**2, minlength=len(part.texts)))
    value = value / np.maximum(scale, 1e-9)[row]
    distinct = np.bincount(row, minlength=len(part.texts))
    at = part.batch.schema.get_field_index("n_chars")
    stored = [whole_number(x) for x in part.batch.column(at).to_pylist()] if at >= 0 \
        else [0] * len(part.texts)
    measures = structure(part.texts, part.counts.tolist(), distinct, stored)
    # Each measure is a one-of-many cell and a number.
    level = np.minimum((measures * 12).astype(np.int64), 40)
    names = np.arange(_MEASURES, dtype=np.uint64)
    number_at = (mix((names + np.uint64(1)) * ODD_1) >> np.uint64(64 - bits)).astype(np.int64)
    cell_at = (mix((names + np.uint64(1)) * ODD_1 + level.astype(np.uint64) + np.uint64(99))
               >> np.uint64(64 - bits)).astype(np.int64)
    n = len(part.texts)
    extra = np.repeat(np.arange(n), _MEASURES)
    index = np.concatenate([index, np.tile(number_at, n), cell_at.ravel()])
    value = np.concatenate([value, np.minimum(measures, 4).ravel() / 3, np.full(n * _MEASURES, 1 / 3)])
    row = np.concatenate([row, extra, extra])
    order = np.argsort(row, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
    return index[order], value[order].astype(np.float32), bounds


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``values`` between bounds; every text has features."""
    return np.add.reduceat(values, bounds[:-1], axis=0)


def raw_scores(model: Model, index, value, bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    scaled = model.factors[index] * value[:, None]
    total = sums(scaled, bounds)
    pairs = 0.5 * (total**2 - sums(scaled**2, bounds)).sum(axis=1)
    return model.bias + sums(model.linear[index] * value, bounds) + pairs, scaled, total


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> Model:
    """Logistic loss by steps scaled to each number's past gradients."""
    random = np.random.default_rng(s.seed)
    size = 1 << s.bits
    if not rows:
        return Model(0.0, np.zeros(size, np.float32), np.zeros((size, s.rank), np.float32))
    share = float(np.clip(labels.mean(), 0.02, 0.98))
    model = Model(
        float(np.log(share / (1 - share))),
        np.zeros(size, np.float32),
        random.normal(0, 0.01, (size, s.rank)).astype(np.float32),
    )
    seen_w, seen_v = np.full(size, 1e-3, np.float32), np.full((size, s.rank), 1e-3, np.float32)
    seen_b = 1e-3
    for _ in range(-(-s.steps * s.batch // len(rows))):
        order = random.permutation(len(rows))
        for first in range(0, len(order), s.batch):
            chosen = order[first : first + s.batch]
            index = np.concatenate([rows[i][0] for i in chosen])
            value = np.concatenate([rows[i][1] for i in chosen])
            bounds = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in chosen])])
            score, scaled, total = raw_scores(model, index, value, bounds)
            error = (logistic(score) - labels[chosen]) / len(chosen)
            each = np.repeat(error, np.diff(bounds)).astype(np.float32) * value
            of = np.repeat(np.arange(len(chosen)), np.diff(bounds))
            used, place = np.unique(index, return_inverse=True)
            step_w = np.bincount(place, each, len(used)).astype(np.float32)
            pull = each[:, None] * (total[of] - scaled)
            step_v = np.stack(
                [np.bincount(place, pull[:, f], len(used)) for f in range(s.rank)], axis=1
            ).astype(np.float32)
            step_w += s.decay * model.linear[used]
            step_v += s.decay * model.factors[used]
            seen_w[used] += step_w**2
            seen_v[used] += step_v**2
            seen_b += float(error.sum()) ** 2
            model.linear[used] -= s.rate * step_w / np.sqrt(seen_w[used])
            model.factors[used] -= s.rate * step_v / np.sqrt(seen_v[used])
            model.bias -= s.rate * float(error.sum()) / np.sqrt(seen_b)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """Labelled rows to fit on, ``sample`` at most, by the hash of their id: a fixed choice."""
    usable = labels.filter(
        F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))
    )
    one = usable.groupBy("doc_id").agg(F.max("quality").cast("int").alias("_label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample)
    # At most ``sample`` narrow rows: the bound is a parameter.
    texts = inputs(docs, "doc_id").join(F.broadcast(chosen), "doc_id")
    return texts.withColumn("_order", F.xxhash64("doc_id", "text"))


def inputs(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and what a score is made of."""
    stored = ["n_chars"] if "n_chars" in docs.columns else []
    return docs.select(*columns, *stored, F.col("text").cast("binary").alias("text"))


def whole_number(value) -> int:
    """A stored length, whatever its type; 0 if it is no number."""
    try:
        return int(float(value))
    except (TypeError, ValueError, OverflowError):
        return 0


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, white_words):
            index, value, bounds = features(part, s.bits)
            yield pa.RecordBatch.from_arrays(
                [part.batch.column("_order"), part.batch.column("_label"),
                 binary_list(index.astype(np.uint32), bounds), binary_list(value, bounds)],
                names=["_order", "_label", "index", "value"],
            )

    found = training_rows(docs, labels, s).drop("doc_id").mapInArrow(
        run, "_order long, _label int, index binary, value binary"
    ).collect()
    # Repeated rows of a document add nothing.
    found = list({r["_order"]: r for r in sorted(found, key=lambda r: r["_order"])}.values())
    vectors = [(np.frombuffer(r["index"], np.uint32).astype(np.int64),
                np.frombuffer(r["value"], np.float32)) for r in found]
    return fit(vectors, np.array([float(r["_label"] > 0) for r in found]), s)


def score(docs: DataFrame, model: Model, s: Settings, *columns: str) -> DataFrame:
    """``columns`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, white_words):
            index, value, bounds = features(part, s.bits)
            kept = part.batch.select(list(columns))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns,
                 pa.array(logistic(raw_scores(shared.value, index, value, bounds)[0]), pa.float64())],
                names=[*columns, "score"],
            )

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    return inputs(docs, *columns).mapInArrow(run, ", ".join([*kinds, "score double"]))


def classify(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    session(docs.sparkSession)
    scored = score(docs, train(docs, labels, s), s, "doc_id")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def filter_documents(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows, with all their columns, that the classifier does not reject."""
    session(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, s))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, white_words):
            raw, _, _ = raw_scores(shared.value, *features(part, s.bits))
            yield part.batch.filter(pa.array(logistic(raw) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
