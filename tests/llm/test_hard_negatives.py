"""Hard negatives against a plain version."""

import random

import numpy as np
import pytest
from millrace.llm import hard_negatives
from millrace.llm.hard_negatives import Search, mine, primes_for, products, remainders, whole_numbers
from millrace.llm.oracles import ORACLES
from millrace.llm.queries import QUERIES
from oracle import compare, connect
from pyspark.sql import functions as F


def plain(rows, is_anchor, positives=5, negatives=3):
    """Rows of ``id, label, vector`` of whole numbers, each once."""
    rows = sorted({(i, y, tuple(v)) for i, y, v in rows if None not in (i, y, v) and None not in v})
    out = []
    for a in rows:
        if not is_anchor(a[0]):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1])
                        for b in rows if b[0] != a[0])
        for p, pid, _ in [x for x in scored if x[2] == a[1]][:positives]:
            p = -p
            inside = [x for x in scored if x[2] != a[1] and 50 * p <= -100 * x[0] <= 95 * p]
            out += [(a[0], pid, r, nid, p, -n) for r, (n, nid, _) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def vectors(spark, rows, partitions=4):
    full = [(i, y, v, 1, 2, "k", 0.5) for i, y, v in rows]
    schema = ("id long, label int, vector array<long>, key int, anchor int, rows_at string, score double")
    return spark.createDataFrame(full, schema).repartition(partitions)


def found(df, s=Search(), every=5):
    return sorted(tuple(r) for r in mine(df, F.col("id") % every == 0, s).collect())


def random_rows(n=160, width=9, size=40, seed=4):
    rng = random.Random(seed)
    return [(i, rng.randrange(4), [rng.randint(-size, 3 * size) for _ in range(width)]) for i in range(n)]


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for size, width in ((3, 5), (250, 64), (40_000, 130), (1 << 25, 200)):
        a, b = (rng.integers(-size, size + 1, (n, width)) for n in (7, 11))
        bound = int(max((x.astype(object) ** 2).sum(axis=1).max() for x in (a, b)))
        primes = primes_for(bound)
        got = products(*([remainders(x, p) for p in primes] for x in (a, b)), primes)
        assert (got == a.astype(object) @ b.T.astype(object)).all()
    with pytest.raises(ValueError):
        primes_for(1 << 62)


def test_against_all_pairs(spark):
    rows = random_rows()
    want = plain(rows, lambda i: i % 5 == 0)
    assert len(want) > 100
    assert found(vectors(spark, rows)) == want
    # Many small blocks on both sides, and bands of two anchors.
    assert found(vectors(spark, rows), Search(rows=13, anchors=4, band=2)) == want


def test_ties_repeats_and_rows_that_take_no_part(spark):
    hot = [3, 4, 0, 1]
    rows = [(i, i % 3, hot) for i in range(60)] + [(100 + i, i % 2, [i, 1, 2, i % 5]) for i in range(40)]
    rows += rows[:30] + [(5, 1, [9, 9, 9, 9]), (10, 2, hot), (11, 0, [8, 1, 1, 1])]
    rows += [(None, 1, hot), (200, None, hot), (205, 1, None), (210, 1, [1, None, 2, 3])]
    rows += [(215, 1, []), (220, 2, [4, 4])]  # shorter: filled up with zeros
    full = [(i, y, v + [0] * (4 - len(v)) if v is not None else v) for i, y, v in rows]
    want = plain(full, lambda i: i % 5 == 0)
    for s in (Search(), Search(rows=9, anchors=5, band=3)):
        assert found(vectors(spark, rows), s) == want


def test_negative_and_zero_scores(spark):
    rows = [(0, 1, [1, -2]), (1, 1, [-5, 1]), (2, 1, [2, 1]), (3, 2, [2, 1]), (4, 2, [0, 0]), (5, 2, [9, 1])]
    assert found(vectors(spark, rows)) == plain(rows, lambda i: i % 5 == 0)


def test_empty_table_and_single_label(spark):
    rows = random_rows(20)
    assert found(vectors(spark, rows).limit(0)) == []
    assert found(vectors(spark, [(i, 1, v) for i, _, v in rows])) == []
    assert found(vectors(spark, rows), every=1000) == plain(rows, lambda i: i == 0)


def test_whole_numbers(spark):
    rows = [([0.5, -0.001, 1.0],), ([float("nan")],), ([1.0, float("-inf")],), ([1.0, None],), (None,), ([],)]
    df = spark.createDataFrame(rows, "v array<float>")
    got = [r[0] for r in df.select(whole_numbers(F.col("v"))).collect()]
    assert got == [[128, -1, 256], None, None, None, None, []]


def test_scores_too_large_are_refused(spark):
    with pytest.raises(ValueError):
        mine(vectors(spark, [(0, 1, [1 << 40, 1])]), F.lit(True))


def test_whole_small_table(spark, small):
    name = "op13_hard_negatives"
    assert compare(QUERIES[name](spark, small), connect(small), ORACLES[name]) > 0
    assert hard_negatives.PRIMES[0] < 1024
