"""The building blocks of the operators."""

import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from millrace.llm import near_dups, packing, sharding, suffix_dedup
from millrace.llm.common import (
    build_filter, in_filter, mix, number, pack_hashes, slices, white_words, window_hashes,
)
from millrace.llm.components import components
from pyspark.sql import functions as F


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_matches_the_published_loop(spark):
    rng = random.Random(1)
    keys = [0, 1, -1, 2**63 - 1, -(2**63)] + [rng.randrange(-(2**63), 2**63) for _ in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 40, 41, 100):
        got = df.select("k", sharding.jump(F.col("k"), n).alias("s")).collect()
        assert all(r["s"] == plain_jump(r["k"] % 2**64, n) for r in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=200, max_size=260).map(lambda b: bytes(c % 2 for c in b)),
                min_size=1, max_size=5), st.booleans())
def test_deep_shallow_finds_equal_suffixes(texts, double):
    texts = texts * 2 if double else texts
    raw, starts = b"", []
    for t in texts:
        starts += range(len(raw), len(raw) + len(t) - 200 + 1)
        raw += t
    starts = np.array(starts)
    found = suffix_dedup.deep_shallow(raw, starts, np.zeros(len(starts), np.int64), 200)
    seen = [raw[s : s + 200] for s in starts.tolist()]
    assert found.tolist() == [seen.count(x) > 1 for x in seen]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    text = bytes(rng.randrange(97, 123) for _ in range(3000))
    a = suffix_dedup.Pieces([text], 200)
    b = suffix_dedup.Pieces([b"x" * 77 + text[500:2500] + b"y" * 300], 200)

    def anchors(p, shift):
        return {w + shift: h for low, high, h in zip(p.low.tolist(), p.high.tolist(), p.hash.tolist())
                for w in range(low, high + 1)}

    whole, part = anchors(a, 0), anchors(b, 500 - 77)
    assert sorted(whole) == list(range(2801))
    assert all(whole[w] == part[w] for w in range(500, 2301))


def test_sketches_estimate_similarity_and_fill_every_coordinate():
    rng = np.random.default_rng(3)
    size = 2000
    for n, shared in ((1, 1), (3, 2), (50, 40), (3000, 1500)):
        common = rng.integers(0, 2**63, shared).astype(np.uint64)
        sets = [np.unique(np.concatenate([common, rng.integers(0, 2**63, n - shared).astype(np.uint64)]))
                for _ in range(2)]
        grams, bounds = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
        a, b = near_dups.sketches(grams, bounds, size)
        assert (a != np.iinfo(np.uint64).max).all()
        assert abs((a == b).mean() - shared / (2 * n - shared)) < 0.05


def test_blocks_link_across_components(monkeypatch, spark):
    monkeypatch.setattr(near_dups, "STRAYS", 3)
    monkeypatch.setattr(near_dups, "MEMBERS", 4)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(60):
        mine = list(base)
        for _ in range(rng.choice([2, 4, 6, 7])):
            mine[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(mine)))
    import brute

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(df).collect()}
    want = {d: c for d, _, c, _ in brute.op8(rows)}
    assert got == want and len(set(want.values())) > 1


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in parent if root(x) != x}


def test_filter_never_forgets(spark):
    values = mix(np.arange(5000, dtype=np.uint64))
    df = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "h long")
    for bits in (18, 22):
        filter_ = build_filter(pack_hashes(df), bits)
        assert len(filter_) == 2**bits // 8
        assert in_filter(filter_, values, bits).all()
        assert in_filter(filter_, mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64)), bits).mean() < 0.1


def test_number_has_no_gaps(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"))
    rows = number(df, ["g"], F.xxhash64("id"), ["id"], "n", 5000, most=50).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["g"], []).append(r["n"])
    assert sum(map(len, groups.values())) == 5000
    assert all(sorted(x) == list(range(len(x))) for x in groups.values())


def test_least_squares_against_all_supports():
    rng = np.random.default_rng(5)
    for _ in range(20):
        a, h = rng.random((6, 4)), rng.normal(size=6)
        best = min(
            (float(np.linalg.norm(a[:, s] @ x - h)) for m in product([False, True], repeat=4)
             for s in [np.array(m)] for x in [np.linalg.lstsq(a[:, s], h, rcond=None)[0]] if (x >= 0).all())
        )
        x = packing.non_negative_least_squares(a, h)
        assert (x >= 0).all() and np.linalg.norm(a @ x - h) <= best + 1e-8


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=17, max_size=17))
def test_patterns_take_every_piece(counts):
    histogram = np.array([0, *counts[1:]])
    plan = packing.patterns(histogram, 16)
    taken = np.zeros(17, np.int64)
    for use, times in plan:
        assert sum(s * m for s, m in use.items()) <= 16 and times > 0
        for s, m in use.items():
            taken[s] += m * times
    assert (taken == histogram).all()


@pytest.mark.parametrize("n", [0, 1, 5])
def test_slices_keep_every_text(n):
    texts = [None, "", "a b", "x" * 100, "last one"][:n]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    got = [t for part in slices([batch], white_words) for t in part.texts]
    assert got == [(t or "").encode() for t in texts]


def test_windows_depend_on_words_and_order():
    a = np.arange(1, 8, dtype=np.uint64)
    assert len(window_hashes(a, 3)) == 5 and len(window_hashes(a, 9)) == 0
    assert window_hashes(a, 3)[0] != window_hashes(a[::-1].copy(), 3)[-1]
