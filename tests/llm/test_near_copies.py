"""Near copies by five-word shingles against every pair."""

import random
from itertools import combinations

import pytest

import corpus_pipeline
from kindred.llm import near_copies, simhash_index
from kindred.llm.common import may_be_among
from kindred.llm.components import roots
from kindred.sources.scratch import Scratch
from tests.llm import brute


def edited(words, places, mark):
    return " ".join(f"{mark}{i}" if i in places else w for i, w in enumerate(words))


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar(a, b):
    return not (a or b) or 5 * len(a & b) >= 4 * len(a | b)


def texts():
    rng = random.Random(4)
    base = [rng.choice("abcdefgh") + str(rng.randint(0, 300)) for _ in range(300)]
    passage = " ".join(f"p{i}" for i in range(30))
    out = [" ".join(base)] + [edited(base, set(rng.sample(range(300), n)), f"e{n}x") for n in (1, 3, 5, 6, 7, 9, 12, 20)]
    out += [edited(base, {k}, f"k{k}x") for k in range(40)]  # a large group
    out += [" ".join(f"u{k}w{rng.randint(0, 90)}" for _ in range(60)) + " " + passage for k in range(30)]  # a common passage only
    out += [None, "", "a b", "A  b", "one two three four five", "one two three four six", " ".join(base).upper()]
    return [(100 + i, t) for i, t in enumerate(out)] + [(None, " ".join(base)), (105, "an id that repeats with another text of its own")]


def test_groups_are_those_of_all_pairs(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scratch = Scratch(spark, "test-near-copies")
    got = {r.node: r.root for r in roots(near_copies.links(docs, scratch), scratch).collect()}
    parent, named = {}, [(i, sets(t)) for i, t in rows if i is not None]
    for (i, a), (j, b) in combinations(named, 2):
        if similar(a, b):
            brute.join(parent, i, j)
    assert got == {i: brute.find(parent, i) for i, _ in named if brute.find(parent, i) != i}
    kept = near_copies.stage(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - set(got)
    assert near_copies.stage(docs.limit(0)).count() == 0


def test_pipeline_drops_near_copies_beyond_four_bits(spark):
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    rows = [(1, " ".join(base)), (2, edited(base, {20, 80, 140, 200, 260}, "changed"))]
    assert similar(*[sets(t) for _, t in rows])
    assert (brute.fingerprint(rows[0][1]) ^ brute.fingerprint(rows[1][1])).bit_count() > 4
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert simhash_index.stage(docs).count() == 2
    docs = dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, docs, "")
    assert [r.doc_id for r in docs.collect()] == [1]


def test_pages_of_one_template_are_few_pairs(spark):
    rng = random.Random(2)
    template = [f"t{i}" for i in range(430)]
    rows = [(k, " ".join(template[:200] + [f"u{k}w{rng.randint(0, 900)}" for _ in range(130)] + template[200:])) for k in range(300)]
    scratch = Scratch(spark, "test-template")
    found = near_copies.links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), scratch)
    assert found.count() == 0
    tried = sum(spark.read.parquet(scratch.path(f"tried-{n}")).count() for n in range(near_copies.ROUNDS + 1))
    assert tried <= (near_copies.ROUNDS + 1) * near_copies.BANDS * len(rows) / 2


def test_odd_columns_and_texts(spark):
    long = " ".join(f"w{i % 7001}" for i in range(60_000))
    rows = [(1, long, "a", "b"), (2, long + " end", "a", "b"), (3, None, None, None), (4, "", "", ""), (4, "", "", ""), (None, long, "c", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _near_copy string, id string")
    kept = near_copies.stage(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [1, 3, None]


def test_flags_miss_no_id(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(0, 3000, 7), -5, 2**62, None]], "x long")
    rows = spark.range(3000).selectExpr("id AS k").unionByName(spark.createDataFrame([(-5,), (2**62,), (-6,), (None,)], "k long"))
    got = {r.k: r._may for r in may_be_among(rows, "k", ids).collect()}
    assert all(got[k] for k in [*range(0, 3000, 7), -5, 2**62]) and sum(got.values()) < 440
    assert not any(r._may for r in may_be_among(rows, "k", ids.limit(0)).collect())


@pytest.mark.parametrize("stage", [simhash_index.stage, near_copies.stage])
def test_texts_that_surely_stay_are_not_moved(spark, stage):
    docs = spark.createDataFrame([(i, t) for i, t in texts() if i is not None], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stage(docs)._jdf.queryExecution().sparkPlan()
        assert plan.nodeName() == "Union"
        first = plan.children().head().toString()
        assert "BroadcastHashJoin" in first and "SortMergeJoin" not in first
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
