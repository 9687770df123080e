"""Repeated rows that are a third of a table, and the rules of quality that each act alone."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import frame, words

from millrace.llm import oracles, quality_rules, sharding, substring_dedup, suffix_dedup


def text_of(rng, n, per_line=9, pick=None):
    found = [(pick or (lambda: f"{rng.choice('abcdefg')}{rng.randrange(100, 9999)}"))() for _ in range(n)]
    return [" ".join(found[i : i + per_line]) for i in range(0, n, per_line)]


def planted():
    rng = random.Random(11)
    rows = [(i, "\n".join(text_of(rng, rng.randrange(180, 400)))) for i in range(300)]
    once = [x for i in range(0, 20) for x in text_of(rng, 63)]
    bad = {
        "symbols": "\n".join(f"{x} ## $$" for x in text_of(rng, 300)),
        "long words": "\n".join(text_of(rng, 300, pick=lambda: f"{rng.randrange(10**11, 10**12)}")),
        "short words": "\n".join(text_of(rng, 300, pick=lambda: rng.choice("abcdefghijklmnopq"))),
        "repeats": " ".join([*text_of(rng, 130, 130), *(["a1 b2 c3 d4 e5 f6 g7"] * 10)]),
        "dup lines": "\n".join(once + once[: len(once) // 4]),
    }
    mild = text_of(rng, 60)
    rows += [(400 + i, x) for i, x in enumerate(bad.values())]
    return rows + [(500, "\n".join([*mild, mild[0]]))]


def test_each_quality_rule_acts_and_spares_clean_texts(spark):
    rows = planted()
    judged = {r["doc_id"]: r for r in quality_rules.judge(frame(spark, rows)).collect()}
    assert all(judged[i]["kept"] for i in [*range(300), 500])
    assert not any(judged[i]["base_failed"] or judged[i]["kept"] for i in range(400, 405))
    repeats, lines = judged[403], judged[404]
    assert (repeats["n_words"], repeats["n_dup_lines"]) == (200, 0)
    assert 4 * lines["n_dup_lines"] == lines["n_lines"] - lines["n_dup_lines"]


def test_quality_sql_agrees_on_planted_texts(spark, tmp_path):
    docs = frame(spark, planted())
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    columns = ["doc_id", "n_words", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    wanted = con.execute(f"SELECT {', '.join(columns)} FROM ({oracles.quality_rules()})").fetchall()
    assert Counter(map(tuple, quality_rules.judge(docs).select(*columns).collect())) == Counter(wanted)


def test_limits_move_smoothly_with_the_rows_of_a_group(spark):
    """A group of other habits leaves the limits it borrows row by row, without a jump."""
    cells = "lang string, source string, measure string, cell int, rows long"
    seen = []
    for n in range(0, 61, 5):
        rows = [("en", "wide", "symbols", c, 100) for c in range(500, 560)]
        rows += [("en", "own", "symbols", 600 + c, n) for c in range(3)]
        high = {r["source"]: r["symbols_high"] for r in
                quality_rules.limits(spark.createDataFrame(rows, cells), quality_rules.Rules()).collect()}
        seen.append(high["own"])
    wide = high["wide"]
    assert seen[0] == pytest.approx(wide, rel=0.2)
    assert seen[-1] == pytest.approx(np.exp(6.01) + 6 * (np.exp(6.02) - np.exp(6.01)) + 100, rel=0.2)
    assert len(set(seen)) > 2


def hot_rows():
    rng = random.Random(3)
    hot = " ".join(words(rng, 80))
    return [(7, hot)] * 2000 + [(i, " ".join(words(rng, 40))) for i in range(10, 40)] + [(50, "x " + hot)] * 900


def test_repeated_rows_send_what_they_share_once(spark):
    keys = np.array([5, 5, 9, 5] * 1000, np.int64)
    starts = np.array([0, 0, 0, 3] * 1000, np.int64)
    sent = list(suffix_dedup._done(keys, starts, starts + 200, 4, suffix_dedup._SENT))
    found = sorted(
        (k, s) for x in sent for r in x.to_pylist()
        for k, s in zip(np.frombuffer(r["keys"], np.int64).tolist(), np.frombuffer(r["starts"], np.int64).tolist())
    )
    assert found == [(5, 0), (5, 3), (9, 0)]
    once = substring_dedup._once(keys.view(np.uint64), keys, starts.view(np.uint64))
    assert [len(x) for x in once] == [3, 3, 3]


def test_hot_row_gives_the_runs_of_one(spark):
    docs = frame(spark, hot_rows())
    found = Counter(map(tuple, substring_dedup.digest(docs, substring_dedup.removals(docs))
                        .select("doc_id", "n_words", "n_removed").collect()))
    assert found[(50, 81, 80)] == 900 and found[(7, 80, 0)] == 2000
    spans = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in
             suffix_dedup.digest(docs, suffix_dedup.removals(docs)).collect()}
    size = len(hot_rows()[0][1])
    assert spans[7] == (size, 1) and spans[50] == (size + 2, 1)


def test_slots_of_a_hot_row_are_gapless(spark):
    slots: dict[int, list[int]] = {}
    for r in sharding.shard(frame(spark, hot_rows()), 5).collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sum(map(len, slots.values())) == 2930
