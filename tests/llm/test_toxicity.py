"""The toxicity network against plain loops, its gradients, and held-out labels."""

import random
import zlib

import numpy as np
import pytest
from conftest import edge_rows, frame
from millrace.llm import toxicity
from millrace.llm.common import hash_words, letter_words
from millrace.llm.toxicity import Network, Settings, Words

TINY = Settings(word_size=3, letter_size=2, letter_bits=5, hidden=3, attention=2, window=6, steps=5)


def network(words, s=TINY, seed=1):
    hashes = hash_words(words)
    known = np.sort(hashes[::2])
    w = toxicity.start_weights(s, 0.3, len(known))
    rng = np.random.default_rng(seed)
    return Network({k: rng.normal(0, 0.6, v.shape).astype(np.float32) for k, v in w.items()}, known)


def plain_score(net, words, s):
    """Raw score of one window, word by word."""
    w, sigma = net.weights, lambda x: 1 / (1 + np.exp(-x))
    entry = []
    for word in words:
        at = np.flatnonzero(net.known == hash_words([word])[0]) if word else []
        own = w["words"][at[0]] if len(at) else np.zeros(s.word_size)
        marked = b"<" + word + b">"
        codes = [(a << 16) | (b << 8) | c for a, b, c in zip(marked, marked[1:], marked[2:])] if word else []
        cells = [int(toxicity.mix(np.array([c + 1], np.uint64))[0]) >> (64 - s.letter_bits) for c in codes]
        letters = np.mean(w["letters"][cells], axis=0) if cells else np.zeros(s.letter_size)
        entry.append(np.concatenate([own, letters]))
    states = []
    for side, order in (("forth", entry), ("back", entry[::-1])):
        h, seen = np.zeros(s.hidden), []
        for x in order:
            new, past = x @ w[f"{side}_in"] + w[f"{side}_bias"], h @ w[f"{side}_on"]
            n = s.hidden
            z, r = sigma(new[:n] + past[:n]), sigma(new[n : 2 * n] + past[n : 2 * n])
            h = h + z * (np.tanh(new[2 * n :] + r * past[2 * n :]) - h)
            seen.append(h)
        states.append(seen if side == "forth" else seen[::-1])
    both = [np.concatenate(x) for x in zip(*states)]
    mark = np.array([np.tanh(x @ w["attend"] + w["attend_bias"]) @ w["look"] for x in both])
    share = np.exp(mark - mark.max())
    share /= share.sum()
    return sum(a * x for a, x in zip(share, both)) @ w["read"] + w["bias"][0]


def plain_windows(words, s):
    if len(words) <= s.window:
        return [words or [b""]]
    last = len(words) - s.window
    starts = sorted({*range(0, last, s.stride), last})
    return [words[a : a + s.window] for a in starts]


def scores(net, texts, s=TINY):
    part = type("Part", (), {"texts": texts})
    return toxicity.scores_of(net, part, s)


def test_scores_are_those_of_plain_loops():
    rng = random.Random(3)
    vocabulary = [rng.randbytes(rng.randrange(1, 5)).hex().encode() for _ in range(30)]
    texts = [b"", b"  ,", vocabulary[0]]
    texts += [b" ".join(rng.choices(vocabulary, k=n)) for n in (2, 5, 6, 7, 9, 12, 13, 40)]
    net = network(vocabulary[:20])
    got = scores(net, texts)
    for text, score in zip(texts, got):
        want = max(plain_score(net, x, TINY) for x in plain_windows(letter_words(text), TINY))
        assert score == pytest.approx(1 / (1 + np.exp(-want)), abs=2e-6)


def test_a_long_text_in_lots_has_the_same_score(monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"w{i}".encode() for i in range(40)]
    net = network(vocabulary)
    texts = [b" ".join(rng.choices(vocabulary, k=n)) for n in (3, 50, 301, 302, 305, 700)]
    want = scores(net, texts)
    for size in (20, 33, 150):
        monkeypatch.setattr(toxicity, "LOT_BYTES", size)
        got = [scores(net, [x])[0] for x in texts]
        assert got == pytest.approx(want, abs=2e-6)


def test_gradients():
    s, rng = TINY, np.random.default_rng(5)
    words = [f"x{i}".encode() for i in range(7)]
    hashes = np.sort(hash_words(words))
    by_hash = {h: w for h, w in zip(hash_words(words), words)}
    net = network(words)
    w = {k: v.astype(np.float64) for k, v in net.weights.items()}
    w["words"][-1] = 0
    names = Words.of([by_hash[h] for h in hashes], hashes, s.letter_bits)
    own = names.rows(net.known)
    ids = rng.integers(0, 7, (4, 6))
    mask = np.ones((4, 6))
    mask[1, 3:] = mask[2, 1:] = 0
    weigh = rng.normal(size=4)

    def value():
        return float(toxicity.forward(w, toxicity.entries(w, names, own), ids, mask) @ weigh)

    held = {}
    entry = toxicity.entries(w, names, own)
    toxicity.forward(w, entry, ids, mask, held)
    pull, entry_pull = toxicity.backward(w, entry, ids, mask, held, weigh)
    pull |= toxicity.table_pulls(w, names, own, entry_pull, s)
    for name, g in pull.items():
        flat, grad = w[name].reshape(-1), np.asarray(g).reshape(-1)
        for i in rng.choice(len(flat), min(len(flat), 12), replace=False):
            if name == "words" and i >= len(flat) - s.word_size:
                continue
            before, step = flat[i], 1e-2
            flat[i] = before + step
            up = value()
            flat[i] = before - step
            down = value()
            flat[i] = before
            assert grad[i] == pytest.approx((up - down) / (2 * step), rel=0.03, abs=2e-3), name


def test_windows_reach_every_word_and_end_with_the_text():
    s = Settings(window=8)
    for n in range(60):
        starts, sizes, rows = toxicity.windows_of(np.array([3, n]), s)
        mine = [(a - 3, k) for a, k, r in zip(starts, sizes, rows) if r == 1]
        assert max(a + k for a, k in mine) == n and {k for _, k in mine} == {min(n, 8)}
        assert {i for a, k in mine for i in range(a, a + k)} == set(range(n))
    assert toxicity.spread(5, 8).tolist() == [0, 1, 2, 3, 4]
    assert toxicity.spread(100, 3).tolist() in ([0, 50, 99], [0, 49, 99])


def test_awkward_tables(spark, edge, empty):
    labels = spark.createDataFrame([(10, 1), (10, 0), (30, 0), (None, 1), (52, None), (77777, 1), (4, 0)],
                                   "doc_id long, toxic int")
    fast = Settings(steps=3)
    rows = toxicity.classify(edge, labels, fast).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d for d, _ in edge_rows())
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[1] == by_id[2] == by_id[3] and by_id[10] == by_id[11]
    assert {r["score"] for r in toxicity.classify(edge, labels.limit(0), fast).collect()} == {0.0}
    assert toxicity.classify(empty, labels, fast).collect() == []
    again = frame(spark, [(7, "a b c")] * 3 + [(None, "a b c"), (None, None)])
    got = toxicity.classify(again, labels, fast).collect()
    assert len(got) == 5 and len({r["score"] for r in got}) <= 2
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.classify(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == docs.count()
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    clean = [r for r in held if not toxic[r["doc_id"]]]
    bad = [r for r in held if toxic[r["doc_id"]]]
    assert len(held) > 900 and sum(r["predicted"] for r in clean) <= 0.03 * len(clean)
    assert sum(r["predicted"] for r in bad) >= 0.8 * len(bad)
