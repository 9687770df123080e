"""The corpus pipeline, stage by stage against plain versions, on the small tables."""

from collections import Counter

import brute
import corpus_pipeline
import pytest
from conftest import edge_rows, frame
from millrace.llm import classifier
from test_contracts import check_packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def after_near_duplicates(docs):
    kept = {d for d, _, _, k in brute.op8([(r[0], r[1]) for r in docs], 5, 80) if k}
    return Counter({r: n for r, n in docs.items() if r[0] in kept})


def after_substrings(docs):
    split = {r: brute.white(r[1]) for r in docs}
    first = {}
    for r, words in split.items():
        for i in range(len(words) - 49):
            w = tuple(words[i : i + 50])
            first[w] = min(first.get(w, r[0]), r[0])
    out = Counter()
    for r, words in split.items():
        gone = {k for i in range(len(words) - 49) if first[tuple(words[i : i + 50])] < r[0]
                for k in range(i, i + 50)}
        if gone:
            text = " ".join(w for i, w in enumerate(words) if i not in gone)
            r = (r[0], text, r[2], r[3], len(text), *r[5:])
        out[r] += docs[r] if r in docs else 1
    return out


def after_benchmarks(docs, items):
    bad = {d for d, _, _, _, _, hit in brute.op5([(r[0], r[1]) for r in docs], items) if hit}
    return Counter({r: n for r, n in docs.items() if r[0] not in bad})


def test_run_on_the_small_tables(spark, small):
    docs = rows(spark.read.parquet(f"{small}/documents.parquet").select(COLUMNS))
    labels = spark.read.parquet(f"{small}/labels.parquet")
    scored = classifier.classify(spark.read.parquet(f"{small}/documents.parquet"), labels).collect()
    good = {r["doc_id"] for r in scored if r["predicted"]}
    want = Counter({r: n for r, n in docs.items() if r[0] in good})
    want = after_substrings(after_near_duplicates(want))
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = after_benchmarks(want, items)
    check_packing(corpus_pipeline.run(spark, small).collect(), [(r[0], r[1]) for r in want])


@pytest.mark.parametrize("name, plain", [
    ("near_duplicates", after_near_duplicates), ("substring_dedup", after_substrings),
])
def test_stages_on_awkward_documents(spark, small, edge, name, plain):
    got = dict(corpus_pipeline.STAGES)[name](spark, edge, small)
    assert got.columns == edge.columns
    assert rows(got) == plain(rows(edge))


def test_stages_keep_columns_of_an_empty_table(spark, small, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, empty, small)
        assert got.columns == empty.columns and got.count() == 0


def test_null_ids_pass_the_stages(spark, small):
    text = " ".join(f"t{i}" for i in range(80))
    docs = frame(spark, [(None, text), (None, "a document of its own"), (3, text), (4, text)])
    stages = dict(corpus_pipeline.STAGES)
    assert sorted((r["doc_id"] or 0) for r in stages["near_duplicates"](spark, docs, small).collect()) == [0, 3]
    assert stages["decontamination"](spark, docs, small).count() == 4
    assert edge_rows()
