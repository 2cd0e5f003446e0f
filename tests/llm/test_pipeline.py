"""Every stage of the pipeline against its brute-force version, on the smallest documents."""

import os
from itertools import combinations

import pytest

import corpus_pipeline
from kindred.llm import line_frequency
from tests.llm import brute
from tests.llm.test_near_copies import sets, similar

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    by_name = dict(corpus_pipeline.STAGES)
    key = lambda rows: sorted((r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in rows)

    def go(name, df):
        out = by_name[name](spark, df, SF)
        assert out.columns == docs.columns
        path = f"{os.getcwd()}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        return spark.read.parquet(path)

    rows = [r.asDict() for r in docs.collect()]
    df = go("quality rules", docs)
    rows = [r for r in rows if brute.quality(r["text"])[-1]]
    assert key(r.asDict() for r in df.collect()) == key(rows)

    df = go("line dedup", df)
    cleaned = brute.lines([(r["source"], r["text"]) for r in rows], line_frequency.MAX_RATIO, line_frequency.MIN_PAGES)
    rows = [r | {"text": t, "n_chars": len(t)} for r, (t, _, _) in zip(rows, cleaned)]
    assert key(r.asDict() for r in df.collect()) == key(rows)

    df = go("simhash near-dedup", df)
    prints = [(r["doc_id"], brute.fingerprint(r["text"])) for r in rows]
    rows = [r for r, c in zip(rows, brute.components(prints)) if r["doc_id"] == c]
    parent: dict = {}
    shingled = [(r["doc_id"], sets(r["text"])) for r in rows]
    for (i, a), (j, b) in combinations(shingled, 2):
        if similar(a, b):
            brute.join(parent, i, j)
    rows = [r for r in rows if brute.find(parent, r["doc_id"]) == r["doc_id"]]
    assert key(r.asDict() for r in df.collect()) == key(rows)

    df = go("benchmark decontamination", df)
    clean = [r for r in rows if not brute.contamination(r["text"], items)[-1]]
    assert len(clean) < len(rows)
    assert key(r.asDict() for r in df.collect()) == key(clean)

    pieces = by_name["packing"](spark, df, SF).collect()
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == ends.get(p.doc_id, 0)
        ends[p.doc_id] = p.start + p.length
    assert ends == {p.doc_id: p.doc_tokens for p in pieces} and set(ends) == {r["doc_id"] for r in clean}


def test_there_are_five_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "packing"
    ]


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
