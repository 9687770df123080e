"""What a bucket of suffixes takes in memory, however it is cut into lots."""

import random
import tracemalloc

import numpy as np
from millrace.llm import suffix_dedup

WIDTH = 200


def bucket(anchors: int, places: int) -> list[dict]:
    """Stretches around ``anchors`` passages; all places of one share its first 230 bytes or 90."""
    rng = random.Random(4)
    rows = []
    for a in range(anchors):
        shared = rng.randbytes(230 if a % 2 else 90)
        for p in range(places):
            text = shared + rng.randbytes(336 - len(shared))
            key, start = a * places + p, rng.randrange(1000)
            numbers = {"keys": [key], "starts": [start], "ends": [start + len(text)]}
            rows.append({**{k: np.array(v, np.int64).tobytes() for k, v in numbers.items()},
                         "hashes": np.array([a], np.uint64).tobytes(),
                         "before": np.array([136], np.uint16).tobytes(),
                         "many": b"\0", "text": suffix_dedup.packed(text)})
    return rows


def removed(rows: list[dict]) -> set[tuple[int, int, int]]:
    start = {int(np.frombuffer(r["keys"], np.int64)[0]): int(np.frombuffer(r["starts"], np.int64)[0])
             for r in rows}
    keys, starts, ends = suffix_dedup._sort_bucket(rows, WIDTH)
    return {(k, s - start[k], e - s) for k, s, e in
            zip(keys.tolist(), starts.tolist(), ends.tolist())}


def test_lots_give_what_one_sort_gives(monkeypatch):
    wanted = {(a * 3 + p, 0, 230) for a in range(1, 40, 2) for p in range(3)}
    assert removed(bucket(40, 3)) == wanted
    for most in (1, 1000, 5000):
        monkeypatch.setattr(suffix_dedup, "SORT", most)
        assert removed(bucket(40, 3)) == wanted


def test_a_bucket_takes_a_few_times_its_text():
    rows = bucket(8000, 3)  # 8 MB of text, 3.3 million suffixes
    size = 336 * len(rows)
    tracemalloc.start()
    keys, _, _ = suffix_dedup._sort_bucket(rows, WIDTH)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(keys) == 12_000
    assert peak < 10 * size


def test_stretches_are_sent_packed():
    held = suffix_dedup._Held(WIDTH, 3)
    words = [b"%d words of some kind " % i for i in range(200)]
    rng = random.Random(5)
    for i in range(600):
        held.stretch(i, 0, b"".join(rng.choices(words, k=14)), i, 10)
    texts = {text for _, _, text in held.stretches}
    sent = [r for x in held.send() for r in x.to_pylist()]
    assert sum(len(r["text"]) for r in sent) < sum(map(len, texts)) // 2
    found = set()
    for r in sent:
        raw, at = suffix_dedup.unpacked(r), 0
        for size in (np.frombuffer(r["ends"], np.int64) - 10).tolist():
            found.add(raw[at : at + size])
            at += size
        assert at == len(raw)
    assert found == texts
