"""Removal of every byte under a string of ``width`` bytes that also starts anywhere else.

Sorting all suffixes of all texts would move each byte many times. Only suffixes with a
chance to share ``width`` bytes are sorted: every window of ``width`` bytes has an anchor, its
substring of ``GRAM`` bytes with the least hash, and equal windows have equal anchors at equal
places. Anchors are counted over all texts, and a filter of fixed size keeps those found once
in their task. Around the others, the suffixes of the windows they stand for go to the bucket
of the anchor, as one stretch of text for about ``width - GRAM`` suffixes.

A bucket sorts its suffixes deep-shallow. The shallow part is a multikey quicksort by eight
bytes at a time, which takes most suffixes apart. Groups that still agree after ``SHALLOW``
bytes are ordered by blind tries: all members are compared with the group's first one to the
place where they leave it, branch there by that place and what stands in it, and each branch
goes on as a group. Members that never leave it are equal to the full depth: their windows are
repeated.

Stretches a task sees twice are settled there and only one is sent on. Anchors with more than
``HOT`` places, known from the counts, are not gathered as text at all: their windows are
compared as hashes of all their bytes, which spread over all buckets.

Workers serve task after task and those of other stages wait beside them, so each gives freed
memory back when it is done, and a bucket sorts the suffixes of a few anchors at a time.

Defined results: a null text has no bytes; rows with null or equal ids are texts of their own
as long as their texts differ, and equal rows are equal texts at two places; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import (
    ODD_1, ODD_2, U, binary_list, bucket_count, build_filter, filter_bytes, give_back, in_filter, keep,
    mix, row_key, session, slices, table, with_key,
)
from millrace.llm.cutting import cut

GRAM = 64
SHALLOW = 32
HOT = 2000
HOT_BITS = 24
PIECE = 1 << 19  # texts are hashed in pieces of this size that overlap by a window
LOT = 1 << 21  # pieces of a long text are looked at in lots of this size
PLACE_BITS = 24  # of a place in the buffer of a lot
SLICE = 1 << 17  # texts are looked at in slices of this size; each takes some 100 times as much
SORT = 1 << 19  # suffixes that are sorted at a time, but for those of one anchor
FLUSH_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20

_STEP = 0x9E3779B97F4A7C15
_powers = np.empty(0, np.uint64)
_inverse = np.empty(0, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    global _powers, _inverse
    if len(_powers) < n:
        back = pow(_STEP, -1, 1 << 64)
        for name, base in (("_powers", _STEP), ("_inverse", back)):
            values = np.full(n, U(base), np.uint64)
            values[0] = 1
            globals()[name] = np.multiply.accumulate(values)
    return _powers[:n], _inverse[:n]


def _piece_places(texts: list[bytes], width: int) -> Iterator[tuple[int, int]]:
    for i, text in enumerate(texts):
        for first in range(0, max(len(text) - width + 1, 0), PIECE):
            yield i, first


class Pieces:
    """Pieces of texts in one buffer, with the windows and anchors of each: those that begin
    at ``places``, pairs of a text and a place in it, or all."""

    def __init__(
        self, texts: list[bytes], width: int, places: list[tuple[int, int]] | None = None
    ) -> None:
        self.width = width
        if places is None:
            places = list(_piece_places(texts, width))
        parts = [texts[i][first : first + PIECE + width - 1] for i, first in places]
        self.rows = np.array([i for i, _ in places], np.int64)
        self.firsts = np.array([first for _, first in places], np.int64)
        self.raw = b"".join(parts)
        if len(self.raw) >> PLACE_BITS:
            raise ValueError(f"{len(self.raw)} bytes in one buffer, places have {PLACE_BITS} bits")
        sizes = np.array([len(x) for x in parts], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(sizes)])
        self.sums = np.zeros(1, np.uint64)
        if parts:
            self._find(sizes)
        else:
            self.low = self.high = self.anchor = self.piece = np.empty(0, np.int64)
            self.hash = np.empty(0, np.uint64)

    @classmethod
    def lots(cls, texts: list[bytes], width: int) -> Iterator[Pieces]:
        """All pieces, about ``LOT`` bytes at a time however long a text is."""
        lot, size = [], 0
        for i, first in _piece_places(texts, width):
            more = min(len(texts[i]) - first, PIECE + width - 1)
            if lot and size + more > LOT:
                yield cls(texts, width, lot)
                lot, size = [], 0
            lot.append((i, first))
            size += more
        if lot:
            yield cls(texts, width, lot)

    def rolled(self, size: int, seed: np.uint64) -> np.ndarray:
        """Hash of the ``size`` bytes at each place."""
        n = len(self.raw)
        if len(self.sums) != n + 1:
            powers, _ = _power_tables(n + 1)
            values = np.frombuffer(self.raw, np.uint8).astype(np.uint64) + U(1)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:n])])
        _, inverse = _power_tables(n + 1)
        count = n - size + 1
        return mix((self.sums[size:] - self.sums[:count]) * inverse[:count] ^ seed)

    def _find(self, sizes: np.ndarray) -> None:
        """Anchors: for each, the first and the last window it stands for."""
        grams = self.rolled(GRAM, ODD_1)
        span, n = self.width - GRAM + 1, len(grams)
        place_bits = U(PLACE_BITS)
        keys = (grams >> place_bits << place_bits) | np.arange(n, dtype=np.uint64)
        # Least key of each run of ``span``: least to the end of its block and from the start
        # of the next.
        padded = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = keys
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        count = n - span + 1
        least = np.minimum(behind[:count], ahead[span - 1 : span - 1 + count])
        anchor = (least & U((1 << PLACE_BITS) - 1)).astype(np.int64)
        piece = np.repeat(np.arange(len(sizes)), sizes)[:count]
        valid = np.arange(count) + self.width <= self.begins[1:][piece]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
                              | (valid[1:] != valid[:-1])])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:] - 1, [count - 1]])
        use = valid[first]
        self.low, self.high = first[use], last[use]
        self.anchor, self.piece = anchor[self.low], piece[self.low]
        self.hash = grams[self.anchor]

    def place(self, at: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Place in the text of a place in the buffer."""
        return at - self.begins[piece] + self.firsts[piece]


def deep_shallow(raw: bytes, starts: np.ndarray, groups: np.ndarray, depth: int) -> np.ndarray:
    """Marks the suffixes ``raw[start:]`` that agree for ``depth`` bytes with another of their
    group. ``depth`` is a multiple of eight."""
    repeated = np.zeros(len(starts), bool)
    if not len(starts):
        return repeated
    if int(starts.max()) + depth > len(raw):
        raw += bytes(depth)
    view = np.ndarray((len(raw) - 7,), np.dtype(">u8"), raw, strides=(1,))

    def word(at: np.ndarray, level: int) -> np.ndarray:
        return view[at + 8 * level].astype(np.uint64)

    # Shallow: multikey quicksort. Members are sorted by their next word, groups split where
    # it changes, and members alone in theirs are in place.
    members = np.arange(len(starts))
    group = groups
    for level in range(SHALLOW // 8):
        key = word(starts[members], level)
        order = np.lexsort((key, group))
        members, group, key = members[order], group[order], key[order]
        new = np.ones(len(members), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        members, group = _together(members, new)
        if not len(members):
            return repeated
    # Deep: blind tries over the groups that are left. ``leader`` is the member of a group
    # that the others are compared with.
    while len(members):
        new = np.ones(len(members), bool)
        new[1:] = group[1:] != group[:-1]
        leader = members[np.flatnonzero(new)[np.cumsum(new) - 1]]
        leaves = np.full(len(members), depth // 8, np.int64)  # the word where it leaves
        branch = np.zeros(len(members), np.uint64)
        going = np.arange(len(members))
        for level in range(SHALLOW // 8, depth // 8):
            mine = word(starts[members[going]], level)
            other = mine != word(starts[leader[going]], level)
            leaves[going[other]] = level
            branch[going[other]] = mine[other]
            going = going[~other]
        equal = leaves == depth // 8
        follows = equal & ~new
        repeated[members[follows]] = True
        repeated[leader[follows]] = True
        left = ~equal
        members, group, leaves, branch = members[left], group[left], leaves[left], branch[left]
        order = np.lexsort((branch, leaves, group))
        members, group, leaves, branch = (x[order] for x in (members, group, leaves, branch))
        new = np.ones(len(members), bool)
        new[1:] = (group[1:] != group[:-1]) | (leaves[1:] != leaves[:-1]) | (branch[1:] != branch[:-1])
        members, group = _together(members, new)
    return repeated


def _together(members: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of groups of two and more, and their group's number."""
    group = np.cumsum(new) - 1
    shared = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
    return members[shared], group[shared]


def anchor_counts(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """``hashes, hot``: anchors with two places and more, and those with more than ``HOT``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from counted(batches)
        give_back()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in slices(batches, lambda _: [], most=SLICE):
            for found in Pieces.lots(part.texts, width):
                held.append(found.hash)
                size += len(held[-1])
                if size > 2_000_000:
                    yield from send(held)
                    held, size = [], 0
        if size:
            yield from send(held)

    def send(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, n = np.unique(np.concatenate(held), return_counts=True)
        bucket = (values % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        yield table({"bucket": np.arange(buckets, dtype=np.int32),
                     "hashes": binary_list(values[order], ends),
                     "n": binary_list(n[order].astype(np.uint32), ends)}, _COUNTS)

    def add(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        values, n = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            more = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.uint64)
            times = np.frombuffer(b"".join(batch.column("n").to_pylist()), np.uint32)
            values, at = np.unique(np.concatenate([values, more]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, times.astype(np.int64)]), len(values)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({
            "hashes": pa.array([values[n > 1].tobytes()], pa.binary()),
            "hot": pa.array([values[n > HOT].tobytes()], pa.binary()),
        })

    return (
        docs.select(F.col("text").cast("binary"))
        .mapInArrow(count, "bucket int, hashes binary, n binary")
        .groupBy("bucket").applyInArrow(add, "hashes binary, hot binary")
    )


_COUNTS = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("n", pa.binary())])
_DONE = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("starts", pa.binary()),
                   ("ends", pa.binary())])
_SENT = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()),
                   ("starts", pa.binary()), ("ends", pa.binary()), ("hashes", pa.binary()),
                   ("before", pa.binary()), ("many", pa.binary()), ("text", pa.binary())])
_SENT_KINDS = ("bucket int, kind int, keys binary, starts binary, ends binary, hashes binary, "
               "before binary, many binary, text binary")  # fmt: skip


def _grouped(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket, buckets in use, and where each ends."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(ends))
    return order, used.astype(np.int32), np.concatenate([ends[used], [len(bucket)]]).astype(np.int64)


def _done(keys, starts, ends, buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Removed stretches, packed for the bucket of their text. Copies of a row share its key, and
    what they share is sent once."""
    if not len(keys):
        return
    order = np.lexsort((ends, starts, keys))
    keys, starts, ends = keys[order], starts[order], ends[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (starts[1:] != starts[:-1])
                          | (ends[1:] != ends[:-1])])
    keys, starts, ends = keys[new], starts[new], ends[new]
    order, used, at = _grouped((mix(keys.view(np.uint64)) % U(buckets)).astype(np.int64), buckets)
    none = pa.array([b""] * len(used), pa.binary())
    yield table({"bucket": used, "kind": [1] * len(used), "keys": binary_list(keys[order], at),
                 "starts": binary_list(starts[order], at), "ends": binary_list(ends[order], at),
                 **{x: none for x in ("hashes", "before", "many", "text")}}, schema)


def packed(text: bytes) -> bytes:
    """Stretches as they are sent: neighbours of one text overlap, but lie in other buckets, so
    what is sent is larger than the texts."""
    return pa.compress(text, "zstd", asbytes=True)


def unpacked(row: dict) -> bytes:
    size = int((np.frombuffer(row["ends"], np.int64) - np.frombuffer(row["starts"], np.int64)).sum())
    return pa.decompress(row["text"], size, "zstd", asbytes=True)


class _Held:
    """What a task has found and not yet sent."""

    def __init__(self, width: int, buckets: int) -> None:
        self.width, self.buckets, self.size = width, buckets, 0
        # Stretch -> its first holder and how many; window hash likewise.
        self.stretches: dict[tuple, list] = {}
        self.windows: list[tuple] = []
        self.done: list[tuple] = []

    def stretch(self, anchor: int, before: int, text: bytes, key: int, start: int) -> None:
        self.stretches.setdefault((anchor, before, text), []).append((key, start))
        self.size += len(text) + 100

    def send(self) -> Iterator[pa.RecordBatch]:
        width, buckets = self.width, self.buckets
        rows, done = [], []
        for (anchor, before, text), holders in self.stretches.items():
            rows.append((anchor, before, len(holders) > 1, text, *holders[0]))
            if len(holders) > 1:
                done += [(k, s, s + len(text)) for k, s in holders]
        if rows:
            anchors = np.array([r[0] for r in rows], np.uint64)
            order, used, at = _grouped((anchors % U(buckets)).astype(np.int64), buckets)
            size = np.array([len(r[3]) for r in rows], np.int64)
            start = np.array([r[5] for r in rows], np.int64)
            texts = [rows[i][3] for i in order.tolist()]
            text = pa.array([packed(b"".join(texts[a:b])) for a, b in
                             zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
            self.stretches, texts = {}, []
            found = table({
                "bucket": used, "kind": [0] * len(used),
                "keys": binary_list(np.array([r[4] for r in rows], np.int64)[order], at),
                "starts": binary_list(start[order], at),
                "ends": binary_list((start + size)[order], at),
                "hashes": binary_list(anchors[order], at),
                "before": binary_list(np.array([r[1] for r in rows], np.uint16)[order], at),
                "many": binary_list(np.array([r[2] for r in rows], np.uint8)[order], at),
                "text": text,
            }, _SENT)
            del rows, text
            yield found
            del found
        if self.windows:
            hashes, keys, starts = (np.concatenate(x) for x in zip(*self.windows))
            order = np.argsort(hashes, kind="stable")
            hashes, keys, starts = hashes[order], keys[order], starts[order]
            new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            many = (np.bincount(np.cumsum(new) - 1) > 1)[np.cumsum(new) - 1]
            yield from _done(keys[many], starts[many], starts[many] + width, buckets, _SENT)
            hashes, keys, starts, many = hashes[new], keys[new], starts[new], many[new]
            order, used, at = _grouped((mix(hashes) % U(buckets)).astype(np.int64), buckets)
            none = pa.array([b""] * len(used), pa.binary())
            yield table({
                "bucket": used, "kind": [2] * len(used), "keys": binary_list(keys[order], at),
                "starts": binary_list(starts[order], at), "ends": none,
                "hashes": binary_list(hashes[order], at), "before": none,
                "many": binary_list(many[order].astype(np.uint8), at), "text": none,
            }, _SENT)
        if done:
            keys, starts, ends = (np.array(x, np.int64) for x in zip(*done))
            yield from _done(keys, starts, ends, buckets, _SENT)


def _sort_lots(group: np.ndarray, windows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts ascending groups into lots of about ``SORT`` windows; a group stays whole."""
    if not len(group):
        return
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
    upto = np.concatenate([[0], np.cumsum(windows)])[edges]
    first = 0
    while first < len(edges) - 1:
        end = max(first + 1, int(np.searchsorted(upto, upto[first] + SORT, "right")) - 1)
        yield int(edges[first]), int(edges[end])
        first = end


def _sort_bucket(rows: list[dict], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Removed stretches among those of a bucket: keys, starts and ends. Uses up the rows."""
    def column(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(r[name] for r in rows), kind)

    keys, starts, ends = (column(x, np.int64) for x in ("keys", "starts", "ends"))
    anchors, before = column("hashes", np.uint64), column("before", np.uint16).astype(np.int64)
    many, size = column("many", np.uint8) > 0, ends - starts
    raw = b"".join([unpacked(r) for r in rows])
    rows.clear()
    at = np.concatenate([[0], np.cumsum(size)])
    whole = np.array([xxhash.xxh64_intdigest(raw[a:b], int(c)) for a, b, c in
                      zip(at[:-1].tolist(), at[1:].tolist(), before.tolist())], np.uint64)
    # Equal stretches of one anchor stand for one another.
    order = np.lexsort((whole, anchors))
    new = np.ones(len(order), bool)
    new[1:] = (anchors[order][1:] != anchors[order][:-1]) | (whole[order][1:] != whole[order][:-1])
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    first = order[new]  # one holder of each kind
    count = np.bincount(kind, minlength=len(first))
    all_ = (count > 1) | (np.bincount(kind, many, len(first)) > 0)
    # Anchors with several kinds have suffixes to sort.
    _, group = np.unique(anchors[first], return_inverse=True)
    mixed = np.flatnonzero(np.bincount(group)[group] > 1)
    out = [(keys[all_[kind]], starts[all_[kind]], ends[all_[kind]])]
    for a, b in _sort_lots(group[mixed], size[first[mixed]] - width + 1):
        some = mixed[a:b]
        holder = first[some]
        windows = size[holder] - width + 1
        of = np.repeat(np.arange(len(some)), windows)
        step = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        # Windows are equal only if their anchor stands at the same place in them.
        offset = before[holder][of] - step
        groups = group[some][of] * width + offset
        found = deep_shallow(raw, at[holder][of] + step, groups, width)
        found &= ~all_[some][of]
        edge = np.ones(len(of), bool)
        edge[1:] = (of[1:] != of[:-1]) | (found[1:] != found[:-1])
        begin = np.flatnonzero(edge)
        end = np.concatenate([begin[1:] - 1, [len(of) - 1]])
        use = found[begin]
        begin, end = begin[use], end[use]
        who = holder[of[begin]]  # a kind that is not repeated has one holder
        out.append((keys[who], starts[who] + step[begin], starts[who] + step[end] + width))
    return tuple(np.concatenate(x) for x in zip(*out))


def removals(docs: DataFrame, width: int = 200) -> DataFrame:
    """``key, runs``: removed byte ranges of every text that loses some, as pairs of 64-bit
    numbers; ``key`` is the row key of the text."""
    spark = session(docs.sparkSession)
    buckets = bucket_count(docs, BUCKET_BYTES)
    counts = keep(anchor_counts(docs, width, buckets), "anchors")
    context = spark.sparkContext
    # As bytes: an array would be held twice while a worker unpacks it.
    again = context.broadcast(filter_bytes(counts.select("hashes")))
    hot = context.broadcast(build_filter(counts.select(F.col("hot").alias("hashes")), HOT_BITS))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from found_in(batches)
        give_back()

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = _Held(width, buckets), np.frombuffer(again.value, np.uint8)
        for part in slices(batches, lambda _: [], most=SLICE):
            row_keys = part.batch.column("row_key").to_numpy(zero_copy_only=False)
            for found in Pieces.lots(part.texts, width):
                keys = row_keys[found.rows]
                use = np.flatnonzero(in_filter(known, found.hash))
                is_hot = in_filter(hot.value, found.hash[use], HOT_BITS)
                cold, warm = use[~is_hot], use[is_hot]
                low, high, piece = found.low[cold], found.high[cold], found.piece[cold]
                for a, b, c, d, e, f in zip(
                    found.hash[cold].tolist(), (found.anchor[cold] - low).tolist(), low.tolist(),
                    (high + width).tolist(), keys[piece].tolist(), found.place(low, piece).tolist(),
                ):
                    held.stretch(a, b, found.raw[c:d], e, f)
                if len(warm):
                    n = found.high[warm] - found.low[warm] + 1
                    at = np.repeat(found.low[warm] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    piece = np.repeat(found.piece[warm], n)
                    held.windows.append(
                        (found.rolled(width, ODD_2)[at], keys[piece], found.place(at, piece))
                    )
                    held.size += 24 * len(at)
                if held.size >= FLUSH_BYTES:
                    yield from held.send()
                    held = _Held(width, buckets)
                    give_back()
        yield from held.send()

    def compare(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        yield from compared(batches)
        give_back()

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        windows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 1:
                    yield table({x: [row[x]] for x in _DONE.names}, _DONE)
                else:
                    (rows if row["kind"] == 0 else windows).append(row)
        if rows:
            for x in _done(*_sort_bucket(rows, width), buckets, _SENT):
                yield x.select(_DONE.names)
        if windows:
            hashes, keys, starts, many = (
                np.frombuffer(b"".join(r[n] for r in windows), k)
                for n, k in (("hashes", np.uint64), ("keys", np.int64), ("starts", np.int64),
                             ("many", np.uint8))
            )
            _, kind = np.unique(hashes, return_inverse=True)
            twice = ((np.bincount(kind) > 1) | (np.bincount(kind, many) > 0))[kind]
            for x in _done(keys[twice], starts[twice], starts[twice] + width, buckets, _SENT):
                yield x.select(_DONE.names)

    def assemble(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        yield assembled(batches)
        give_back()

    def assembled(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        rows = [r for batch in batches for r in batch.to_pylist()]
        keys, starts, ends = (
            np.frombuffer(b"".join(r[x] for r in rows), np.int64) for x in ("keys", "starts", "ends")
        )
        order = np.lexsort((starts, keys))
        keys, starts, ends = keys[order], starts[order], ends[order]
        new_text = np.concatenate([[True], keys[1:] != keys[:-1]])
        # The furthest end so far in a text: texts are set apart by a shift longer than any.
        shift = (np.cumsum(new_text) - 1) * (int(ends.max()) + 2)
        reach = np.maximum.accumulate(ends + shift) - shift
        new = new_text.copy()
        new[1:] |= starts[1:] > reach[:-1]
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:] - 1, [len(keys) - 1]])
        runs = np.stack([starts[first], reach[last]], axis=1).ravel()
        text_first = np.flatnonzero(new_text)
        at = np.concatenate([np.searchsorted(first, text_first), [len(first)]]) * 2
        return table({"key": keys[text_first], "runs": binary_list(runs, at)}, _RUNS)

    return (
        with_key(docs, F.col("text").cast("binary").alias("text"))
        .select("row_key", "text")
        .mapInArrow(find, _SENT_KINDS)
        .groupBy("bucket").applyInArrow(compare, "bucket int, keys binary, starts binary, ends binary")
        .groupBy("bucket").applyInArrow(assemble, "key long, runs binary")
    )


_RUNS = pa.schema([("key", pa.int64()), ("runs", pa.binary())])


def digest(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(),
             "kept_sha256": pa.string()}

    def change(batch: pa.RecordBatch, texts: list[bytes], runs_: list) -> pa.RecordBatch:
        out: dict[str, list] = {x: [] for x in kinds}
        for text, raw in zip(texts, runs_):
            edges = np.frombuffer(raw or b"", np.int64).tolist()
            left = kept_bytes(text, edges)
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(left))
            out["n_spans"].append(len(edges) // 2)
            out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(out[x], k) for x, k in kinds.items())],
            names=["doc_id", *kinds],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return cut(docs, runs, row_key(), change,
               f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
               ["doc_id", "text"])


def kept_bytes(text: bytes, edges: list[int]) -> bytes:
    out, at = [], 0
    for a, b in zip(edges[::2], edges[1::2]):
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])
