"""Collocations against a plain version."""

import random
import re
from collections import Counter, defaultdict

import brute
from conftest import edge_rows, frame
from millrace.llm import collocations
from millrace.llm.collocations import Mining
from pyspark.sql import functions as F

PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")
WORD = re.compile(r"[^\x20\x09]+")


def plain(rows, support=10, most=2000):
    """Rows of the contract from ``lang, text``."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(brute.UPPER)):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        chosen = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        gone = {p[i : i + 2] for p, a in chosen.items() if len(p) == 3
                for i in (0, 1) if 100 * a >= 50 * chosen.get(p[i : i + 2], 1 << 60)}
        scored = []
        for p, a in chosen.items():
            if p in gone:
                continue
            score, _, le, r = min(
                (1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                for k in range(1, len(p))
            )
            scored.append((-score, -a, " ".join(p).encode(), le, r))
        for rank, (s, a, p, le, r) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, p.decode(), -a, le, r, n[lang], -s))
    return sorted(out)


def mined(df, m=Mining()):
    return sorted(tuple(r) for r in collocations.collocations(df, m).collect())


def texts(spark, rows, partitions=5):
    schema = "lang string, text string, doc_id long, key long, bucket int, shard string, rank int, a int"
    full = [(lang, x, n, 1, 2, "s", 3, 4) for n, (lang, x) in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(partitions)


def sample(seed=3, n=150):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = [f"w{min(int(rng.expovariate(0.2)), 40)}" for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice([["New", "York", "City"], ["ad", "hoc"], ["x", "x", "x", "x"]])
        text = "".join(w + rng.choice([" ", " ", "\t", " \t ", ". ", "\n", ";", "\x0b"]) for w in words)
        rows.append((rng.choice(["en", "en", None, "und", "de"]), text))
    return rows


def test_phrases_of_every_language(spark):
    rows = sample() + [("en", None), ("en", ""), (None, " ,.\n")]
    assert mined(texts(spark, rows)) == plain(rows)
    few = Mining(most=7, salts=3, shards=3)
    assert mined(texts(spark, rows), few) == plain(rows, most=7)


def test_one_shard_and_many_give_the_same(spark):
    rows = sample(8, 60)
    want = plain(rows, support=4)
    assert want
    for shards in (1, 2, 9):
        assert mined(texts(spark, rows), Mining(support=4, shards=shards)) == want


def test_awkward_documents(spark, edge):
    rows = [("en", x) for _, x in edge_rows()]
    assert mined(edge, Mining(support=3)) == plain(rows, support=3)


def test_empty_table(empty):
    assert mined(empty) == []


def test_a_third_of_all_rows_is_one(spark):
    rows = sample(5, 40) + [("en", "hot row of one text, hot row")] * 300
    assert mined(texts(spark, rows, 7)) == plain(rows)


def test_long_texts_in_lots_and_small_buffers(spark, monkeypatch):
    rows = sample(9, 30)
    rows.append(("en", " ".join(x for _, x in rows)))
    want = plain(rows)
    monkeypatch.setattr(collocations, "LOT_BYTES", 50)
    for name in ("HELD", "SENT", "HELD_WORDS"):
        monkeypatch.setattr(collocations, name, 40)
    # Functions of a module go to tasks by name, so the small limits are tried in this process.
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {"lang": ["en"], "shard": [0], "text": [rows[-1][1].encode()]}
    )
    for size in (1, 2, 3):
        got = Counter()
        for lot in collocations.lots(iter([batch])):
            for i in lot.starts(size).tolist():
                got[tuple(w.decode() for w in lot.words[i : i + size])] += 1
        whole = Counter()
        for piece in PIECE.split(rows[-1][1].translate(brute.UPPER)):
            words = WORD.findall(piece)
            whole.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        assert got == whole
    assert mined(texts(spark, rows)) == want


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.range(1).select(
        collocations.cut_score(F.lit(big), F.lit(big + 1), F.lit(big + 2)).alias("s")
    )
    assert row.first()["s"] == 1000000 * big * big // ((big + 1) * (big + 2))


def merged_keys(n, seed=4):
    import numpy as np

    rng = np.random.default_rng(seed)
    tally = collocations.Tally()
    tally.add(rng.integers(0, 1 << 64, n, np.uint64))
    return tally


def test_what_a_level_sends_is_packed():
    import numpy as np

    tally = merged_keys(200_000)
    keys, counts = tally.merge()
    short = collocations.shortened(keys, 40)
    sent = collocations.by_bucket((short, counts), 100, 0)
    assert sent.nbytes < 4 * len(keys)
    back = collocations.gathered([sent])
    assert (back[0] == np.unique(short)).all() and back[1].sum() == counts.sum()
    whole = collocations.by_bucket((keys, counts), 100, 0)
    assert whole.nbytes < 7 * len(keys)
    back = collocations.gathered([whole])
    assert (back[0] == keys).all() and (back[1] == counts).all()


def test_what_is_sent_of_candidates():
    import numpy as np

    rng = np.random.default_rng(6)
    pairs = rng.integers(1, 1 << 64, (2, 30_000), np.uint64)
    some = rng.integers(0, 30_000, 30_000)  # triples of no pair, of one and of several
    last = rng.integers(1, 1 << 64, 30_000, np.uint64)
    tally, none = collocations.Tally(3), np.zeros(20_000, np.uint64)
    for w in ((*pairs[:, :20_000], none), (*pairs[:, some], last)):
        keys = collocations.keys_of(*(x for x in w if x.any()))
        for _ in range(2):
            tally.add(keys, None, w)
    merged = tally.merge()
    sent = collocations.by_head(merged, 100)
    assert sent.nbytes < 18 * len(merged[0])
    back = collocations.phrases([sent])
    assert all((a == b).all() for a, b in zip(back, merged)) and (back[1] == 2).all()
    empty = collocations.by_head(collocations.Tally(3).merge(), 100)
    assert empty.num_rows == 0 and not len(collocations.phrases([empty])[0])


def test_phrases_whose_short_keys_are_the_same(spark):
    # With 6 bits nearly every phrase shares its short key with others.
    rows = sample(11, 60)
    assert mined(texts(spark, rows), Mining(support=4, key_bits=6)) == plain(rows, support=4)
