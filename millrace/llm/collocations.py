"""Phrase collocations by partitioned mining.

Documents are dealt to a few shards. A phrase found ``support`` times or more in all of them is
found at least ``support`` times the shard's share of the bytes in one of them, so each shard is
mined completely at that lowered support, level by level: pairs of words that are frequent
themselves, then triples of two pairs that some shard found frequent. What any shard found is
united, and a last pass counts all candidates exactly over all documents.

A shard may be as large as the cluster: tasks count 64-bit keys of language and words, send
them by key to buckets whose number follows the bytes, and a bucket adds up what belongs to one
shard. What the next pass needs to know of a level is a bit filter of fixed size, which lets
more through when it is full and never hides a candidate; the support is checked on exact
counts. Scores, cuts and ranks are DataFrame joins over the frequent phrases alone.

What is sent is nearly a key for every place of the texts, so it is packed: the keys of a bucket
ascend and only their steps are sent; levels are mined by the first bits of a key, as phrases
that share them can only let more through; a candidate is sent as its words, of which
the key follows, and the first two words of triples once for all of them.

Defined results: a null or empty text has no words; a null language is ``und`` and joins
documents that say so; repeated rows count as often as they stand; an empty table gives no
phrases. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import (
    FILTER_BITS, ODD_1, PART_BITS, bucket_count, build_filter, give_back, hash_words, in_filter, keep, mix,
    pack_hashes, row_key, session, slices, window_hashes,
)

# A-Z in lower case, every end of a piece as a full stop.
_PIECES = bytes(
    c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256)
)
_END = b"."
SLICE_BYTES = 1 << 19  # of texts at a time
LOT_BYTES = 4 << 20  # of one text at a time
HELD = 150_000  # keys a task gathers before it adds them up
SENT = 800_000  # keys a task holds before it sends them
HELD_WORDS = 60_000
BUCKET_BYTES = 16 << 20


@dataclass(frozen=True)
class Mining:
    support: int = 10
    shards: int = 4
    swallow_percent: int = 50  # of a phrase inside a longer one, for it to be dropped
    most: int = 2000  # phrases listed for each language
    bits: int = FILTER_BITS  # of a filter, at most
    salts: int = 64
    key_bits: int = 40  # of a key, by which levels are mined


@dataclass
class Lot:
    """Words of some texts of a batch; every piece ends in a full stop. The first ``seen`` of
    them were counted before and stand here for the phrases that go on after them."""

    words: list[bytes]
    ids: np.ndarray  # keys of language and word
    ends: np.ndarray
    rows: np.ndarray
    langs: list[str]
    shards: np.ndarray  # of each row
    seen: int

    def starts(self, size: int) -> np.ndarray:
        """Places of phrases of ``size`` words whose last word is new."""
        count = len(self.words) - size + 1
        if count <= 0:
            return np.empty(0, np.int64)
        whole = ~self.ends[:count]
        for i in range(1, size):
            whole &= ~self.ends[i : i + count]
        whole[: max(self.seen - size + 1, 0)] = False
        return np.flatnonzero(whole)

    def keys(self, size: int) -> np.ndarray:
        """Key of the phrase at every place."""
        return self.ids if size == 1 else window_hashes(self.ids, size, size)


def split(text: bytes) -> list[bytes]:
    words = text.translate(_PIECES).replace(_END, b" . ").split()
    words.append(_END)
    return words


def cuts(text: bytes, most: int) -> Iterator[bytes]:
    """Parts of a text of about ``most`` bytes that end between words."""
    flat, at = text.translate(_PIECES), 0
    while len(flat) - at > most:
        stop = min((x for x in (flat.find(c, at + most) for c in (b" ", b".", b"\t")) if x >= 0),
                   default=len(flat))
        yield flat[at:stop]
        at = stop
    yield flat[at:]


def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[Lot]:
    """Texts of batches with ``lang``, ``shard`` and ``text``, a long one in several lots."""
    for part in slices(batches, lambda _: [], most=SLICE_BYTES):
        langs = part.batch.column("lang").to_pylist()
        shards = np.asarray(part.batch.column("shard").to_numpy(zero_copy_only=False), np.int64)
        if len(part.texts) > 1 or len(part.texts[0]) <= LOT_BYTES:
            split_up = [split(x) for x in part.texts]
            words = [w for x in split_up for w in x]
            yield make_lot(words, np.array([len(x) for x in split_up]), langs, shards, 0)
            continue
        before: list[bytes] = []
        for piece in cuts(part.texts[0], LOT_BYTES):
            new = piece.replace(_END, b" . ").split()
            words = before + new
            if words:
                yield make_lot(words, np.array([len(words)]), langs, shards, len(before))
            before = words[-2:]


def make_lot(words: list[bytes], counts, langs: list[str], shards: np.ndarray, seen: int) -> Lot:
    hashes, rows = hash_words(words), np.repeat(np.arange(len(langs)), counts)
    salt = mix(hash_words([x.encode() for x in langs]))
    return Lot(words, mix(hashes ^ salt[rows]), hashes == hash_words([_END])[0], rows, langs,
               shards, seen)


class Tally:
    """Distinct keys with their counts and, if asked for, the word keys of one place."""

    def __init__(self, columns: int = 0) -> None:
        self.columns, self.held, self.new, self.size = columns, [], 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None, rest=()) -> None:
        if not len(keys):
            return
        counts = np.ones(len(keys), np.int64) if counts is None else counts
        self.held.append((keys, counts, *rest))
        self.new += len(keys)
        if self.new > HELD + self.size:
            self.merge()

    def merge(self) -> tuple[np.ndarray, ...]:
        """Ascending keys, counts and the other columns."""
        if not self.held:
            return tuple(np.empty(0, np.uint64) for _ in range(2 + self.columns))
        columns = [list(x) for x in zip(*self.held)]
        self.held = []
        keys, counts = (np.concatenate(columns.pop(0)) for _ in range(2))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.add.reduceat(counts[order].astype(np.int64), first)
        keys, order = keys[first], order[first]
        # One column at a time, so that no second copy of all is held.
        merged = (keys, counts, *(np.concatenate(columns.pop(0))[order] for _ in range(self.columns)))
        self.held, self.new, self.size = [merged], 0, len(first)
        give_back()
        return merged


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def packed(*columns: np.ndarray) -> bytes:
    """64-bit numbers as they are sent: all their first bytes, then all second ones and so on, as
    those of small numbers are alike."""
    planes = (np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes() for x in columns)
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpacked(raw: pa.Scalar, *counts: int) -> list[np.ndarray]:
    """The columns that :func:`packed` was given, by their lengths."""
    whole = np.frombuffer(pa.decompress(raw.as_buffer(), 8 * sum(counts), "zstd"), np.uint8)
    parts = np.split(whole, np.cumsum([8 * n for n in counts])[:-1])
    return [np.ascontiguousarray(x.reshape(8, -1).T).view(np.uint64).ravel() for x in parts]


def steps(keys: np.ndarray) -> np.ndarray:
    """From each of some ascending keys to the next; their running sum has the keys again."""
    return np.diff(keys, prepend=np.uint64(0))


def edges_of(ascending: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin, and the end."""
    if not len(ascending):
        return np.zeros(1, np.int64)
    changes = np.flatnonzero(ascending[1:] != ascending[:-1]) + 1
    return np.concatenate([[0], changes, [len(ascending)]])


def by_bucket(merged: tuple[np.ndarray, ...], buckets: int, first: int) -> pa.RecordBatch:
    """A row for each bucket with its keys and their counts; buckets count from ``first``."""
    keys, counts = merged
    bucket = bucket_of(keys, buckets)
    edges = edges_of(bucket)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[edges[:-1]] + first, pa.int64()), pa.array(np.diff(edges), pa.int64()),
         pa.array([packed(steps(keys[a:b]), counts[a:b])
                   for a, b in zip(edges.tolist(), edges[1:].tolist())], pa.binary())],
        names=["bucket", "n", "packed"],
    )


SUMS = "bucket long, n long, packed binary"


def gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    tally = Tally()
    for batch in batches:
        for n, raw in zip(batch.column("n").to_pylist(), batch.column("packed")):
            step, counts = unpacked(raw, n, n)
            tally.add(np.cumsum(step), counts.view(np.int64))
    return tally.merge()


def inputs(docs: DataFrame, shards: int) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(
        lang.alias("lang"), F.pmod(row_key(), F.lit(shards)).cast("long").alias("shard"),
        F.col("text").cast("binary").alias("text"),
    )


def frequent_words(texts: DataFrame, buckets: int, support: int) -> DataFrame:
    """``id, f`` of the words found ``support`` times in a language."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for lot in lots(batches):
            tally.add(lot.ids[lot.starts(1)])
            if tally.new > SENT:
                yield by_bucket(tally.merge(), buckets, 0)
                tally = Tally()
        yield by_bucket(tally.merge(), buckets, 0)

    def add_up(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts = gathered(batches)
        chosen = counts >= support
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[chosen].view(np.int64)) for x in (ids, counts)], names=["id", "f"]
        )

    sums = texts.mapInArrow(scan, SUMS)
    return dealt(sums, buckets).groupBy("bucket").applyInArrow(add_up, "id long, f long")


@dataclass
class Sieve:
    """A bit filter that tasks can see. Its size follows what it holds, up to a bound. One of
    short keys holds them mixed, as their last bits are 0."""

    shared: Broadcast
    bits: int
    key_bits: int = 64

    @classmethod
    def over(cls, hashed: DataFrame, count: int, most: int, key_bits: int = 64) -> "Sieve":
        bits = min(most, max(PART_BITS, (16 * count).bit_length()))
        shared = hashed.sparkSession.sparkContext.broadcast(build_filter(hashed, bits))
        return cls(shared, bits, key_bits)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        if self.key_bits < 64:
            keys = mix(shortened(keys, self.key_bits))
        return in_filter(self.shared.value, keys, self.bits)


def shortened(keys: np.ndarray, bits: int) -> np.ndarray:
    """The first bits of keys, the others 0."""
    return keys >> np.uint64(64 - bits) << np.uint64(64 - bits)


def names(texts: DataFrame, frequent: Sieve, buckets: int) -> DataFrame:
    """``lang, word, id, n``: the words that pass the sieve, and for each language a row without
    a word that has the number of all its words."""
    kind = pa.schema([
        ("bucket", pa.int64()), ("n", pa.int64()), ("packed", pa.binary()),
        ("langs", pa.list_(pa.string())), ("size", pa.int64()), ("words", pa.binary()),
    ])

    def sent(found: dict[int, tuple], totals: dict[str, int]) -> pa.RecordBatch:
        """A row for each bucket with its words and, once, their languages; a row without words
        for a language's number."""
        ids = np.array(sorted(found), np.int64)
        order = np.argsort(ids.view(np.uint64))
        ids = ids[order].view(np.uint64)
        bucket = bucket_of(ids, buckets)
        edges = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(ids)]]).tolist()
        rows = []
        for a, b in zip(edges, edges[1:]):
            entries = [found[x] for x in ids[a:b].view(np.int64).tolist()]
            number = {lang: i for i, lang in enumerate(dict.fromkeys(e[0] for e in entries))}
            langs = np.array([number[e[0]] for e in entries], np.uint64)
            words = b" ".join(e[1] for e in entries)  # no word has a blank
            rows.append((int(bucket[a]), b - a, packed(steps(ids[a:b]), langs), list(number), len(words),
                         pa.compress(words, "zstd", asbytes=True)))
        rows += [(int(bucket_of(hash_words([lang.encode()]), buckets)[0]), 1, packed(np.array([n])),
                  [lang], 0, None) for lang, n in totals.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip(zip(*rows), kind)] if rows
            else [pa.array([], f.type) for f in kind], schema=kind,
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        totals: dict[str, int] = {}
        for lot in lots(batches):
            at = lot.starts(1)
            for lang, n in zip(lot.langs, np.bincount(lot.rows[at], minlength=len(lot.langs))):
                totals[lang] = totals.get(lang, 0) + int(n)
            ids, first = np.unique(lot.ids[at], return_index=True)
            passed = frequent.passes(ids)
            places = at[first[passed]]
            for key, row, place in zip(ids[passed].view(np.int64).tolist(),
                                       lot.rows[places].tolist(), places.tolist()):
                if key not in found:
                    found[key] = (lot.langs[row], lot.words[place])
            if len(found) > HELD_WORDS:
                yield sent(found, totals)
                found, totals = {}, {}
                give_back()
        yield sent(found, totals)

    def unite(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        totals: dict[str, int] = {}
        for batch in batches:
            for n, raw, langs, size, words in zip(*(batch.column(x) for x in kind.names[1:])):
                langs = langs.as_py()
                if not words.is_valid:
                    totals[langs[0]] = totals.get(langs[0], 0) + int(unpacked(raw, 1)[0][0])
                    continue
                step, lang = unpacked(raw, n.as_py(), n.as_py())
                listed = pa.decompress(words.as_buffer(), size.as_py(), "zstd", asbytes=True).split(b" ")
                ids = np.cumsum(step).view(np.int64).tolist()
                found.update(zip(ids, zip((langs[i] for i in lang.tolist()), listed)))
        langs, words = zip(*found.values()) if found else ((), ())
        none = [None] * len(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*langs, *totals], pa.string()), pa.array([*words, *none], pa.binary()),
             pa.array([*found, *none], pa.int64()),
             pa.array([*[None] * len(found), *totals.values()], pa.int64())],
            names=["lang", "word", "id", "n"],
        )

    packs = texts.mapInArrow(
        scan, "bucket long, n long, packed binary, langs array<string>, size long, words binary"
    )
    one = dealt(packs, buckets).groupBy("bucket").applyInArrow(
        unite, "lang string, word binary, id long, n long"
    )
    return one.withColumn("word", F.col("word").cast("string"))


def supports(docs: DataFrame, m: Mining) -> list[int]:
    """The lowered support of each shard: its share of the bytes, rounded up."""
    found = dict(
        inputs(docs, m.shards).groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n"))
        .collect()
    )
    sizes = [found.get(i) or 0 for i in range(m.shards)]
    total = max(sum(sizes), 1)
    return [max(1, -(-m.support * x // total)) for x in sizes]


def possible(lot: Lot, size: int, below: Sieve) -> np.ndarray:
    """Places of phrases whose two parts of one word less pass the filter."""
    at = lot.starts(size)
    passed = below.passes(lot.keys(size - 1))
    return at[passed[at] & passed[at + 1]]


def locally_frequent(
    texts: DataFrame, size: int, below: Sieve, needed: list[int], buckets: int, m: Mining
) -> Sieve:
    """Filter of the phrases of ``size`` words that some shard holds as often as it must, among
    those whose parts pass the filter ``below``. Phrases with the same short key are one here."""

    def sent(tallies: list[Tally]) -> Iterator[pa.RecordBatch]:
        for shard, tally in enumerate(tallies):
            yield by_bucket(tally.merge(), buckets, shard * buckets)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = [Tally() for _ in needed]
        for lot in lots(batches):
            at = possible(lot, size, below)
            keys, shard = shortened(lot.keys(size)[at], m.key_bits), lot.shards[lot.rows[at]]
            for i in np.unique(shard).tolist():
                tallies[i].add(keys[shard == i])
            if sum(t.new for t in tallies) > SENT:
                yield from sent(tallies)
                tallies = [Tally() for _ in needed]
        yield from sent(tallies)

    def mine(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = gathered(batches)
        frequent = keys[counts >= needed[key[0].as_py() // buckets]]
        hashes = (mix(frequent) if m.key_bits < 64 else frequent).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([hashes], pa.binary())], ["hashes"])

    sums = texts.mapInArrow(scan, SUMS)
    united = dealt(sums, buckets * len(needed)).groupBy("bucket").applyInArrow(mine, "hashes binary")
    united = keep(united, "united")
    held = united.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0
    return Sieve.over(united, held // 8, m.bits, m.key_bits)


def dealt(sums: DataFrame, buckets: int) -> DataFrame:
    """One partition for a few buckets, so that tasks stay alike however many there are."""
    least = int(sums.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sums.repartition(max(least, buckets // 4), "bucket")


def count_candidates(
    texts: DataFrame, pairs: Sieve, triples: Sieve, buckets: int, m: Mining
) -> DataFrame:
    """``key, a, w1, w2, w3, head, tail`` of the phrases that pass the filters and are found
    ``support`` times in all documents; the last three only for triples."""
    sieves = {2: pairs, 3: triples}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(3)
        for lot in lots(batches):
            for size, sieve in sieves.items():
                at = lot.starts(size)
                keys = lot.keys(size)[at]
                passed = sieve.passes(keys)
                at, keys = at[passed], keys[passed]
                last = lot.ids[at + 2] if size == 3 else np.zeros(len(at), np.uint64)
                tally.add(keys, None, (lot.ids[at], lot.ids[at + 1], last))
            if tally.new > SENT // 2:
                yield by_head(tally.merge(), buckets)
                tally = Tally(3)
        yield by_head(tally.merge(), buckets)

    names = ["key", "a", "w1", "w2", "w3", "head", "tail"]

    def add_up(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, w1, w2, w3 = phrases(batches)
        chosen = counts >= m.support
        columns = [x[chosen] for x in (keys, counts, w1, w2, w3)]
        head = keys_of(columns[2], columns[3])
        tail = keys_of(columns[3], columns[4])
        single = columns[4] == 0
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x.view(np.int64)) for x in columns[:4]),
             *(pa.array(x.view(np.int64), mask=single) for x in (columns[4], head, tail))],
            names=names,
        )

    sums = texts.mapInArrow(scan, "bucket long, n long, longer long, packed binary")
    return dealt(sums, buckets).groupBy("bucket").applyInArrow(
        add_up, ", ".join(f"{x} long" for x in names)
    )


def by_head(merged: tuple[np.ndarray, ...], buckets: int) -> pa.RecordBatch:
    """A row for each bucket with the ``n`` pairs that begin its phrases: both words, how often
    the pair was found alone and how many triples it begins; and of those ``longer`` triples
    the last word and the count."""
    keys, counts, w1, w2, w3 = merged
    single = w3 == 0
    head = np.where(single, keys, keys_of(w1, w2))
    order = np.argsort(head, kind="stable")
    head, counts, w3, single = head[order], counts[order], w3[order], single[order]
    runs = edges_of(head)
    first = runs[:-1]
    alone, triples = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    if len(first):
        alone = np.add.reduceat(np.where(single, counts, 0), first)
        triples = np.add.reduceat((~single).astype(np.int64), first)
    w1, w2 = w1[order[first]], w2[order[first]]
    last, found = w3[~single], counts[~single]
    bucket = bucket_of(head[first], buckets)
    edges = edges_of(bucket)
    ends = np.concatenate([[0], np.cumsum(triples)])[edges]
    spans = list(zip(*(x.tolist() for x in (edges, edges[1:], ends, ends[1:]))))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[edges[:-1]], pa.int64()), pa.array(np.diff(edges), pa.int64()),
         pa.array(np.diff(ends), pa.int64()),
         pa.array([packed(*(x[a:b] for x in (w1, w2, alone, triples)), last[c:d], found[c:d])
                   for a, b, c, d in spans], pa.binary())],
        names=["bucket", "n", "longer", "packed"],
    )


def phrases(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    """What :func:`by_head` sent, added up: keys, counts and the three words."""
    tally = Tally(3)
    for batch in batches:
        sizes = zip(batch.column("n").to_pylist(), batch.column("longer").to_pylist())
        for (n, longer), raw in zip(sizes, batch.column("packed")):
            w1, w2, alone, triples, w3, counts = unpacked(raw, n, n, n, n, longer, longer)
            own = np.flatnonzero(alone)
            pair = w1[own], w2[own]
            tally.add(keys_of(*pair), alone[own].view(np.int64), (*pair, np.zeros_like(pair[0])))
            three = *(np.repeat(x, triples.view(np.int64)) for x in (w1, w2)), w3
            tally.add(keys_of(*three), counts.view(np.int64), three)
    return tally.merge()


def keys_of(*words: np.ndarray) -> np.ndarray:
    """Keys of the phrases of these first, second and so on words, as :meth:`Lot.keys` gives them."""
    total = np.full(len(words[0]), len(words), np.uint64)
    for x in words:
        total = total * ODD_1 + x
    return mix(total)


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """``1000000 * a * a / (left * right)`` rounded down, in decimals of 38 digits."""
    wide = [x.cast("decimal(16,0)") for x in (a, left, right)]
    top = (wide[0] * wide[0]).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), wide[1] * wide[2])


def scored_phrases(found: DataFrame, words: DataFrame, m: Mining) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that no longer one swallows."""
    pairs, triples = found.filter("w3 IS NULL"), found.filter("w3 IS NOT NULL")

    def word(n: int) -> DataFrame:
        # Ids, not words, meet: one row on this side for each.
        return words.select(F.col("id").alias(f"w{n}"), F.col("word").alias(f"t{n}"),
                            F.col("f").alias(f"f{n}"), *(["lang"] if n == 1 else []))

    longer = triples.select("a", F.explode(F.array("head", "tail")).alias("key"))
    longer = longer.groupBy("key").agg(F.max("a").alias("longer"))
    swallowed = 100 * F.col("longer") >= m.swallow_percent * F.col("a")
    two = (
        pairs.join(longer, "key", "left").filter(~F.coalesce(swallowed, F.lit(False)))
        .join(word(1), "w1").join(word(2), "w2")
        .select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), "a",
                F.col("f1").alias("l"), F.col("f2").alias("r"))
        .withColumn("score", cut_score(F.col("a"), F.col("l"), F.col("r")))
    )
    head = pairs.select(F.col("key").alias("head"), F.col("a").alias("f12"))
    tail = pairs.select(F.col("key").alias("tail"), F.col("a").alias("f23"))
    first = cut_score(F.col("a"), F.col("f1"), F.col("f23"))
    second = cut_score(F.col("a"), F.col("f12"), F.col("f3"))
    three = (
        triples.join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
        .join(head, "head").join(tail, "tail")
        .select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", "f1", "f23",
                "f12", "f3", first.alias("first"), second.alias("second"))
        .select("lang", "phrase", "a",
                F.when(F.col("second") < F.col("first"), F.col("f12")).otherwise(F.col("f1")).alias("l"),
                F.when(F.col("second") < F.col("first"), F.col("f3")).otherwise(F.col("f23")).alias("r"),
                F.least("first", "second").alias("score"))
    )
    return two.unionByName(three)


def best(scored: DataFrame, m: Mining) -> DataFrame:
    """The first ``most`` of each language with their ``rank``. A language is first split by
    the hash of the phrase, so that no task ranks all of it."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(m.salts))
    inside = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
    chosen = scored.withColumn("rank", inside).filter(F.col("rank") <= m.most)
    over = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return chosen.withColumn("rank", over).filter(F.col("rank") <= m.most)


def collocations(docs: DataFrame, m: Mining = Mining()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of each language."""
    session(docs.sparkSession)
    texts = inputs(docs, m.shards)
    buckets = bucket_count(docs, BUCKET_BYTES)
    needed = supports(docs, m)
    counts = keep(frequent_words(texts, buckets, m.support), "counts")
    hashed = pack_hashes(counts.select(F.col("id").alias("h")))
    frequent = Sieve.over(hashed, counts.count(), m.bits)
    listed = keep(names(texts, frequent, buckets), "names")
    words = listed.filter("word IS NOT NULL").drop("n").join(counts, "id")
    pairs = locally_frequent(texts, 2, frequent, needed, buckets, m)
    frequent.shared.destroy()
    triples = locally_frequent(texts, 3, pairs, needed, buckets, m)
    found = keep(count_candidates(texts, pairs, triples, buckets, m), "phrases")
    for sieve in (pairs, triples):
        sieve.shared.destroy()
    ranked = best(scored_phrases(found, words, m), m)
    totals = listed.filter("word IS NULL").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
