"""What adding up keys takes in memory."""

import tracemalloc

import numpy as np
from millrace.llm.collocations import Tally


def test_a_merge_holds_no_second_copy_of_all_columns():
    rng, count = np.random.default_rng(1), 120_000
    tally = Tally(3)
    tracemalloc.start()
    keys = rng.permutation(count).astype(np.uint64)
    tally.add(keys, None, tuple(keys * np.uint64(i) for i in (2, 3, 4)))
    del keys
    before = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    merged = tally.merge()
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert (merged[0] == np.arange(count)).all() and (merged[1] == 1).all()
    assert all((merged[i] == merged[0] * np.uint64(i)).all() for i in (2, 3, 4))
    assert peak < 8 * 6 * count
