"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as two vectors: its own, and the mean of those of its character triples, so that
words never seen are read by their letters. A
gated recurrent unit runs over a window of words in each direction, attention weighs the states,
and a logistic reads the weighted sum. Windows overlap by half and every one of a text is scored;
the text has the score of its worst window.

The network is trained in numpy on the driver, on labelled rows, ``sample`` of them at most, by the
hash of their id, with ``windows`` windows of each at most, spread over the text. Labels are those
of texts, so each step follows the worst window of a text alone. One text in ``trial`` is not
trained on, and the weights that suit those best are kept. Own vectors are for the ``vocabulary``
words that most texts of the sample have, and several at least; they start from how surely a word
leans to either label, and rarer words are left to their letters. All that is sent to the executors
is the network, whose size is fixed by its parameters; every row is scored in one pass without a
shuffle, a long text in lots.

Defined results: words are runs of letters and digits, A-Z in lower case; a text without any, or
null, is one window of one empty word; a document with several labels has the highest; without
labelled rows every score is 0; repeated rows get equal scores; an empty table gives an empty
result. Labels, language, source and id are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import hash_words, letter_words, mix, only_letters, session, slices

THRESHOLD = 0.3
LOT_BYTES = 1 << 20  # of one text at a time
TRIPLES = 1 << 20  # character triples looked up at a time


@dataclass(frozen=True)
class Settings:
    vocabulary: int = 16384  # words with vectors of their own, at most
    letter_bits: int = 12
    word_size: int = 12
    letter_size: int = 8
    hidden: int = 12  # states of each direction
    attention: int = 12
    window: int = 48
    sample: int = 7000  # labelled rows to train on, at most
    windows: int = 8  # of each of them, at most
    common: int = 3  # texts of the sample a word must be in to have its own vector
    trial: int = 6  # one in so many texts of the sample tells when to stop
    steps: int = 600
    every: int = 40  # steps between two looks at those texts
    batch: int = 32
    rate: float = 4e-3
    floor: float = 3e-4  # under the scale of a step of the tables
    decay: float = 2e-5
    drop: float = 0.1  # share of own vectors left out in training
    seed: int = 11
    together: int = 1024  # windows scored at once

    @property
    def stride(self) -> int:
        return self.window // 2


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Words:
    """Distinct words by their hash, and the cells of the character triples of each."""

    hashes: np.ndarray
    triples: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], hashes: np.ndarray, bits: int) -> "Words":
        raw = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes + 2)
        code = (raw[:-2] << np.uint64(16)) | (raw[1:-1] << np.uint64(8)) | raw[2:]
        inside = np.ones(len(raw), bool)  # triples that begin in a word and end in it
        inside[ends - 1] = inside[ends - 2] = False
        inside[(ends - sizes - 2)[sizes == 0]] = False
        cells = (mix(code + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.uint32)
        return cls(hashes, cells[inside[:-2]], np.concatenate([[0], np.cumsum(sizes)]))

    def rows(self, known: np.ndarray) -> np.ndarray:
        """Row of each in the table of words; words that are not ``known`` share the last one."""
        at = np.searchsorted(known, self.hashes)
        met = known[np.minimum(at, len(known) - 1)] == self.hashes if len(known) else at < 0
        return np.where(met, at, len(known))


def windows_of(counts: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and row of the windows over rows of ``counts`` words each. The last one
    ends with the text; a text shorter than a window is one."""
    at = np.concatenate([[0], np.cumsum(counts)])
    spare = np.maximum(counts - s.window, 0)
    many = 1 + -(-spare // s.stride)
    row = np.repeat(np.arange(len(counts)), many)
    number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = np.minimum(number * s.stride, spare[row])
    return at[row] + start, np.minimum(counts, s.window)[row], row


Weights = dict[str, np.ndarray]


def start_weights(s: Settings, share: float, known: int) -> Weights:
    random = np.random.default_rng(s.seed)

    def normal(*shape: int, scale: float | None = None) -> np.ndarray:
        scale = 1 / np.sqrt(shape[0]) if scale is None else scale
        return random.normal(0, scale, shape).astype(np.float32)

    entry, h = s.word_size + s.letter_size, s.hidden
    out = {
        "words": normal(known + 1, s.word_size, scale=0.02),
        "letters": normal(1 << s.letter_bits, s.letter_size, scale=0.05),
        "attend": normal(2 * h, s.attention), "attend_bias": np.zeros(s.attention, np.float32),
        "look": normal(s.attention), "read": normal(2 * h),
        "bias": np.array([np.log(share / (1 - share))], np.float32),
    }
    for side in ("forth", "back"):
        out |= {f"{side}_in": normal(entry, 3 * h), f"{side}_on": normal(h, 3 * h),
                f"{side}_bias": np.zeros(3 * h, np.float32)}
    return out


def letters_mean(w: Weights, words: Words) -> np.ndarray:
    """Mean vector of the triples of each word, zero for the empty word."""
    size = np.diff(words.bounds)
    total = np.zeros((len(size), w["letters"].shape[1]), np.float32)
    for a in range(0, len(words.triples), TRIPLES):
        b = min(a + TRIPLES, len(words.triples))
        low, high = np.searchsorted(words.bounds, [a, b], "right") - 1
        last = min(high + 1, len(size))
        used = low + np.flatnonzero(size[low:last])
        at = np.clip(words.bounds[used], a, b) - a
        used, at = used[at < b - a], at[at < b - a]
        total[used] += np.add.reduceat(w["letters"][words.triples[a:b]], at, axis=0)
    return total / np.maximum(size, 1)[:, None].astype(np.float32)


def entries(w: Weights, words: Words, rows: np.ndarray) -> np.ndarray:
    """What each word enters as; ``rows`` names its own vector."""
    own = w["words"][rows] * (rows < len(w["words"]) - 1)[:, None]
    return np.concatenate([own, letters_mean(w, words)], axis=1).astype(np.float32)


def run(gates, ids, on, mask, held: list | None = None) -> np.ndarray:
    """States of one direction after each word. ``gates`` has a row for each word; ``mask`` is
    None where all windows are full."""
    n, size = ids.shape
    h = on.shape[0]
    state = np.zeros((n, h), np.float32)
    out = np.empty((size, n, h), np.float32)
    for t in range(size):
        new, past = gates[ids[:, t]], state @ on
        both = np.tanh(0.5 * (new[:, : 2 * h] + past[:, : 2 * h])) * 0.5 + 0.5
        keep, reset = both[:, :h], both[:, h:]
        candidate = np.tanh(new[:, 2 * h :] + reset * past[:, 2 * h :])
        take = keep if mask is None else keep * mask[:, t, None]
        if held is not None:
            held.append((state, keep, reset, candidate, past[:, 2 * h :], take))
        state = state + take * (candidate - state)
        out[t] = state
    return out


def forward(w: Weights, entry: np.ndarray, ids: np.ndarray, mask, held: dict | None = None):
    """Raw score of each window of words ``ids``."""
    sides = []
    for side in ("forth", "back"):
        gates = entry @ w[f"{side}_in"] + w[f"{side}_bias"]
        turn = slice(None, None, -1 if side == "back" else 1)
        steps = None if held is None else held.setdefault(side, [])
        states = run(gates, ids[:, turn], w[f"{side}_on"], None if mask is None else mask[:, turn], steps)
        sides.append(states[turn])
    states = np.concatenate(sides, axis=2)
    seen = np.tanh(states @ w["attend"] + w["attend_bias"])
    mark = seen @ w["look"]
    if mask is not None:
        mark = np.where(mask.T > 0, mark, np.float32(-1e9))
    share = np.exp(mark - mark.max(axis=0))
    share /= share.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", share, states)
    if held is not None:
        held.update(states=states, seen=seen, share=share, pooled=pooled)
    return pooled @ w["read"] + w["bias"][0]


def backward(w: Weights, entry, ids, mask, held: dict, error: np.ndarray) -> tuple[Weights, np.ndarray]:
    """Gradients of the weights past the entries, and of the entries, for the errors of the raw
    scores."""
    h = w["forth_on"].shape[0]
    states, seen, share = held["states"], held["seen"], held["share"]
    out = {"bias": np.array([error.sum()]), "read": held["pooled"].T @ error}
    pooled = error[:, None] * w["read"]
    pull = np.einsum("nh,tnh->tn", pooled, states)
    mark = share * (pull - (share * pull).sum(axis=0))
    out["look"] = np.einsum("tn,tnk->k", mark, seen)
    inner = mark[:, :, None] * w["look"] * (1 - seen**2)
    out["attend"] = np.einsum("tnh,tnk->hk", states, inner)
    out["attend_bias"] = inner.sum(axis=(0, 1))
    each = share[:, :, None] * pooled + inner @ w["attend"].T
    entry_pull = np.zeros_like(entry)
    for number, side in enumerate(("forth", "back")):
        order = slice(None, None, -1 if side == "back" else 1)
        steps, turned = held[side], ids[:, order]
        push = each[order, :, number * h : (number + 1) * h]
        on, gates = np.zeros_like(w[f"{side}_on"]), np.zeros((len(entry), 3 * h), np.float32)
        flow = np.zeros((len(ids), h), np.float32)
        for t in range(len(steps) - 1, -1, -1):
            state, keep, reset, candidate, past, take = steps[t]
            flow = flow + push[t]
            closed = flow * (candidate - state) * (take / np.maximum(keep, 1e-30))
            inside = flow * take * (1 - candidate**2)
            new = np.concatenate(
                [closed * keep * (1 - keep), inside * past * reset * (1 - reset), inside], axis=1
            )
            back = new.copy()
            back[:, 2 * h :] *= reset
            on += state.T @ back
            flow = flow * (1 - take) + back @ w[f"{side}_on"].T
            np.add.at(gates, turned[:, t], new)
        out[f"{side}_on"], out[f"{side}_bias"] = on, gates.sum(axis=0)
        out[f"{side}_in"] = entry.T @ gates
        entry_pull += gates @ w[f"{side}_in"].T
    return out, entry_pull


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30).astype(np.float64)))


@dataclass
class Network:
    weights: Weights | None
    known: np.ndarray  # hashes of the words with vectors of their own


def batch_of(starts, sizes, place, s: Settings) -> tuple[np.ndarray, np.ndarray | None]:
    """Words of windows, and which of them are there; ``place`` names the word at each position."""
    at = starts[:, None] + np.arange(int(sizes.max()))
    there = np.arange(int(sizes.max())) < sizes[:, None]
    ids = place[np.minimum(at, len(place) - 1)]
    return ids, None if there.all() else there.astype(np.float32)


@dataclass
class Sample:
    """Texts to train on: words of their windows in a row, each naming one of ``words``."""

    words: Words
    place: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    rows: np.ndarray  # text of each window, ascending
    labels: np.ndarray


def text_scores(w: Weights, sample: Sample, known, chosen: np.ndarray, s: Settings, left_out=None):
    """Words of a batch, their own rows and entries, and of the worst window of each of the texts
    chosen its words, mask and raw score. ``left_out`` marks rows that are not to be used."""
    first = np.searchsorted(sample.rows, np.stack([chosen, chosen + 1]))
    every = np.concatenate([np.arange(a, b) for a, b in first.T])
    of = np.repeat(np.arange(len(chosen)), first[1] - first[0])
    ids, mask = batch_of(sample.starts[every], sample.sizes[every], sample.place, s)
    used, ids = np.unique(ids, return_inverse=True)
    ids = ids.reshape(len(every), -1)
    words = subset(sample.words, used)
    own = words.rows(known)
    if left_out is not None:
        own = np.where(left_out[own], len(known), own)
    entry = entries(w, words, own)
    raw = forward(w, entry, ids, mask)
    worst = worst_of(raw, of, len(chosen))
    return words, own, entry, ids[worst], None if mask is None else mask[worst], raw[worst]


def mean_loss(w: Weights, sample: Sample, known, rows: np.ndarray, s: Settings) -> float:
    total = 0.0
    for a in range(0, len(rows), 4 * s.batch):
        chosen = rows[a : a + 4 * s.batch]
        p = np.clip(logistic(text_scores(w, sample, known, chosen, s)[-1]), 1e-4, 1 - 1e-4)
        y = sample.labels[chosen]
        total -= float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
    return total / len(rows)


def train(sample: Sample, s: Settings) -> Network:
    """Steps on the worst window of each text of a batch."""
    if not len(sample.labels):
        return Network(None, np.empty(0, np.uint64))
    random = np.random.default_rng(s.seed)
    known = common_words(sample, s)
    w = start_weights(s, float(np.clip(sample.labels.mean(), 0.02, 0.98)), len(known))
    rows = random.permutation(len(sample.labels))
    held_back = len(rows) // s.trial
    trial, rows = rows[:held_back], rows[held_back:]
    w["words"][:-1, 0] = leanings(sample, known, rows)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    least, best, at = np.inf, w, len(rows)
    for step in range(1, s.steps + 1):
        if at >= len(rows):
            rows, at = random.permutation(rows), 0
        chosen = rows[at : at + s.batch]
        at += s.batch
        left_out = random.random(len(known) + 1) < s.drop
        words, own, entry, ids, mask, _ = text_scores(w, sample, known, chosen, s, left_out)
        held: dict = {}
        score = forward(w, entry, ids, mask, held)
        error = ((logistic(score) - sample.labels[chosen]) / len(chosen)).astype(np.float32)
        pull, entry_pull = backward(w, entry, ids, mask, held, error)
        pull |= table_pulls(w, words, own, entry_pull, s)
        descend(w, pull, moments, step, s.rate * min(1.0, 2 * (1 - step / (s.steps + 1))), s)
        if len(trial) and step % s.every == 0:
            loss = mean_loss(w, sample, known, trial, s)
            if loss < least:
                least, best = loss, {k: v.copy() for k, v in w.items()}
    return Network(best if len(trial) else w, known)


def worst_of(raw: np.ndarray, of: np.ndarray, count: int) -> np.ndarray:
    """Place of the highest of each group; groups ascend."""
    order = np.lexsort((-raw, of))
    return order[np.searchsorted(of[order], np.arange(count))]


def subset(words: Words, used: np.ndarray) -> Words:
    sizes = np.diff(words.bounds)[used]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(words.bounds[used] - bounds[:-1], sizes) + np.arange(bounds[-1])
    return Words(words.hashes[used], words.triples[at], bounds)


def table_pulls(w: Weights, words: Words, own: np.ndarray, entry_pull, s: Settings) -> Weights:
    """Gradients of the two tables."""
    table = np.zeros_like(w["words"])
    np.add.at(table, own, entry_pull[:, : s.word_size])
    table[-1] = 0
    sizes = np.diff(words.bounds)
    each = entry_pull[:, s.word_size :] / np.maximum(sizes, 1)[:, None]
    letters = np.stack(
        [np.bincount(words.triples, np.repeat(each[:, i], sizes), len(w["letters"]))
         for i in range(s.letter_size)], axis=1,
    )
    return {"words": table, "letters": letters.astype(np.float32)}


def descend(w: Weights, pull: Weights, moments, step: int, rate: float, s: Settings) -> None:
    """A step scaled by running means of the gradients and of their squares. For the tables the
    scale has a floor, so that what few texts say of a word stays small."""
    norm = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in pull.values()))
    shrink = min(1.0, 5.0 / max(norm, 1e-12))
    for name, g in pull.items():
        mean, square = moments[name]
        g = (g * shrink).astype(np.float32) + s.decay * w[name]
        mean += 0.1 * (g - mean)
        square += 0.002 * (g * g - square)
        floor = s.floor if name in ("words", "letters") else 1e-8
        w[name] -= (rate / (1 - 0.9**step)) * mean / (np.sqrt(square / (1 - 0.998**step)) + floor)


def texts_with(sample: Sample, chosen: np.ndarray) -> np.ndarray:
    """How many of the texts chosen hold each word."""
    at = np.concatenate([np.arange(a, a + n) for a, n in zip(sample.starts, sample.sizes)])
    row = np.repeat(sample.rows, sample.sizes)
    inside = np.isin(row, chosen)
    names = len(sample.words.hashes)
    pairs = np.unique(row[inside] * names + sample.place[at[inside]]) % names
    return np.bincount(pairs, minlength=names)


def leanings(sample: Sample, known: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the own vectors start from: how surely a word leans to either label, from -1 to 1."""
    at = np.searchsorted(sample.words.hashes[:-1], known)
    toxic = rows[sample.labels[rows] > 0]
    share = len(toxic) / max(len(rows), 1)
    texts, mine = (texts_with(sample, x)[at] for x in (rows, toxic))
    return np.tanh((mine - share * texts) / np.sqrt(share * (1 - share) * texts + 1) / 4)


def common_words(sample: Sample, s: Settings) -> np.ndarray:
    """Hashes, ascending, of the words that most texts of the sample have."""
    texts = texts_with(sample, np.arange(len(sample.labels)))
    texts[-1] = 0  # the empty word
    order = np.lexsort((sample.words.hashes, -texts))[: s.vocabulary]
    return np.sort(sample.words.hashes[order[texts[order] >= s.common]])


def spread(windows: int, most: int) -> np.ndarray:
    """``most`` of so many windows, evenly over the text; all, if fewer."""
    return np.unique(np.linspace(0, windows - 1, min(windows, most)).round().astype(np.int64))


def training_rows(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """``order, label, text`` of the labelled rows to train on: a fixed choice by their id."""
    usable = labels.filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))
    )
    one = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample)
    texts = docs.select(F.col("doc_id"), F.col("text").cast("binary").alias("text"))
    # At most ``sample`` narrow rows: the bound is a parameter.
    return texts.join(F.broadcast(chosen), "doc_id").select(
        F.xxhash64("doc_id", "text").alias("order"), "label", "text"
    )


def sampled(docs: DataFrame, labels: DataFrame, s: Settings) -> Sample:
    """The windows to train on, as hashes and cells: at most ``sample * windows * window`` words
    come to the driver, each with at most 2^letter_bits cells."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, letter_words):
            out: list[list] = [[], [], [], [], []]
            hashes = part.hashes()
            for a, b in zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist()):
                starts, sizes, _ = windows_of(np.array([b - a]), s)
                chosen = spread(len(starts), s.windows)
                at = np.concatenate([np.arange(x, x + n) for x, n in zip(starts[chosen], sizes[chosen])])
                mine = hashes[a:b][at] if b > a else hashes[:0]
                names, first = np.unique(mine, return_index=True)
                words = Words.of([part.words[a + i] for i in at[first].tolist()], names, s.letter_bits) \
                    if len(names) else Words(names, np.empty(0, np.uint32), np.zeros(1, np.int64))
                for held, value in zip(out, (sizes[chosen], mine, names, words.triples,
                                             np.diff(words.bounds))):
                    held.append(np.ascontiguousarray(value).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.batch.column("order"), part.batch.column("label"),
                 *(pa.array(x, pa.binary()) for x in out)],
                names=["order", "label", "sizes", "mine", "names", "triples", "lengths"],
            )

    found = training_rows(docs, labels, s).mapInArrow(
        cut, "order long, label int, sizes binary, mine binary, names binary, triples binary, "
        "lengths binary",
    ).collect()
    # Repeated rows of a document add nothing.
    found = list({r["order"]: r for r in sorted(found, key=lambda r: r["order"])}.values())
    return assembled(found)


def assembled(found: list) -> Sample:
    def joined(name: str, kind) -> tuple[np.ndarray, np.ndarray]:
        parts = [np.frombuffer(r[name], kind) for r in found]
        return np.concatenate([*parts, np.empty(0, kind)]), np.array([len(x) for x in parts], np.int64)

    sizes, many = joined("sizes", np.int64)
    mine, _ = joined("mine", np.uint64)
    names, _ = joined("names", np.uint64)
    lengths, _ = joined("lengths", np.int64)
    triples, _ = joined("triples", np.uint32)
    distinct, first = np.unique(names, return_index=True)
    all_words = Words(names, triples, np.concatenate([[0], np.cumsum(lengths)]))
    words = subset(all_words, first)
    # The empty word comes last: an empty text is one window of it.
    words = Words(np.append(words.hashes, np.uint64(0)), words.triples,
                  np.append(words.bounds, words.bounds[-1]))
    place = np.append(np.searchsorted(distinct, mine), len(distinct))
    starts = np.cumsum(sizes) - sizes
    starts[sizes == 0] = len(place) - 1
    return Sample(
        words, place, starts, np.maximum(sizes, 1), np.repeat(np.arange(len(found)), many),
        np.array([float(r["label"] > 0) for r in found]),
    )


def window_scores(net: Network, words: list[bytes], starts, sizes, s: Settings) -> np.ndarray:
    """Raw score of windows over a list of words; one of length 0 holds the empty word."""
    hashes = hash_words(words)
    distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    names = Words.of([*(words[i] for i in first.tolist()), b""], np.append(distinct, np.uint64(0)),
                     s.letter_bits)
    entry = entries(net.weights, names, names.rows(net.known))
    place = np.append(place, len(distinct))
    starts = np.where(sizes == 0, len(place) - 1, starts)
    sizes = np.maximum(sizes, 1)
    out = np.empty(len(starts), np.float32)
    order = np.argsort(-sizes, kind="stable")  # full windows first, then by length
    for a in range(0, len(order), s.together):
        chosen = order[a : a + s.together]
        ids, mask = batch_of(starts[chosen], sizes[chosen], place, s)
        out[chosen] = forward(net.weights, entry, ids, mask)
    return out


def long_lots(text: bytes, s: Settings) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Words, starts and sizes of the windows of a long text, lot by lot; the same windows as of
    the whole."""
    flat, at, buffer, done = only_letters(text), 0, [], 0
    while at < len(flat):
        stop = flat.find(b" ", at + LOT_BYTES)
        stop = len(flat) if stop < 0 else stop
        buffer += flat[at:stop].split()
        at = stop
        if at >= len(flat):
            break
        starts = np.arange(done, len(buffer) - s.window + 1, s.stride)
        if len(starts):
            yield buffer, starts, np.full(len(starts), s.window)
            # The last window scored stays: the one that ends with the text may begin inside it.
            buffer, done = buffer[int(starts[-1]) :], s.stride
    starts, sizes, _ = windows_of(np.array([len(buffer)]), s)
    yield buffer, starts, sizes


def scores_of(net: Network, part, s: Settings) -> np.ndarray:
    """Score of each text of a slice of whole texts."""
    if net.weights is None:
        return np.zeros(len(part.texts))
    if len(part.texts) == 1 and len(part.texts[0]) > LOT_BYTES:
        raw = max(float(window_scores(net, *lot, s).max()) for lot in long_lots(part.texts[0], s))
        return logistic(np.array([raw])).round(6)
    words: list[bytes] = []
    counts = np.empty(len(part.texts), np.int64)
    for i, text in enumerate(part.texts):
        found = letter_words(text)
        words += found
        counts[i] = len(found)
    starts, sizes, row = windows_of(counts, s)
    raw = window_scores(net, words, starts, sizes, s)
    worst = np.maximum.reduceat(raw, np.searchsorted(row, np.arange(len(counts))))
    return logistic(worst).round(6)


def score(docs: DataFrame, net: Network, s: Settings, *columns: str) -> DataFrame:
    """``columns`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    names = [f"kept {i}" for i in range(len(columns))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, lambda _: []):
            yield pa.RecordBatch.from_arrays(
                [*part.batch.select(names).columns, pa.array(scores_of(shared.value, part, s), pa.float64())],
                names=[*names, "score"],
            )

    kinds = [f"`{n}` {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, columns)]
    kept = [F.col(c).alias(n) for n, c in zip(names, columns)]
    found = docs.select(*kept, F.col("text").cast("binary").alias("text")).mapInArrow(
        scan, ", ".join([*kinds, "score double"])
    )
    return found.withColumnsRenamed(dict(zip(names, columns)))


def classify(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    session(docs.sparkSession)
    scored = score(docs, train(sampled(docs, labels, s), s), s, "doc_id")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

