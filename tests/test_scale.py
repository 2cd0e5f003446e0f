"""Steps that all unification queries share: what they read and move, with unchanged results."""

import random

import pytest
from pyspark.sql import functions as F

from checks.fixtures import AS_OF, identity_config
from kindred.operators import skew
from kindred.plans import extract as X
from kindred.plans import resolve as R
from kindred.sources import tables
from kindred.sources.scratch import Scratch

CFG = identity_config()
CID = CFG.canonical_ids[0]


def test_keys_are_counted_where_their_hash_is_crowded(spark, monkeypatch):
    df = spark.createDataFrame([("a", i) for i in range(9)] + [(k, 0) for k in "bcdefg"] + [(None, 0)] * 20, "k string, v int")
    for places in (1, 1 << 16):
        monkeypatch.setattr(skew, "PLACES", places)
        found = skew.hot_keys(df, ["k"], 35, floor=4)
        assert [(r["k"], r["_ways"]) for r in found.collect()] == [("a", 3)]
        assert skew.hot_keys(df, ["k"], 35, floor=9) is None


def test_places_are_counted_without_a_second_look_at_the_keys(spark):
    """A test of computed keys below the count made Spark compute them once per term of it."""
    df = spark.range(20).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("mail"))
    key = F.when(F.col("mail").rlike("k.*"), F.struct(F.col("mail").alias("id"), F.lit(1).alias("ns")))
    keyed = df.withColumn("_key", F.coalesce(key)).select(F.col("_key.id").alias("_id"), F.col("_key.ns").alias("_ns"))
    _, crowded = skew.crowded_places(keyed, ["_id", "_ns"], 16, 0)
    plan = crowded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1
    assert plan.count("Filter") == 1 and plan.index("Filter") < plan.index("Aggregate")


def test_loop_step_reads_its_links_from_a_written_table(spark):
    """The links with the leaders' own rows went through their join five times a step."""
    rows = [("a", 1, "a", 1), ("b", 1, "a", 1), ("b", 1, "c", 1), ("c", 1, "c", 1), ("d", 1, "c", 1)]
    graph = spark.createDataFrame(rows, "follower_id string, follower_ns long, leader_id string, leader_ns long")
    graph = graph.withColumns({c: F.lit(5).cast("long") for c in ("follower_first_seen_at", "follower_last_seen_at", "follower_last_processed_at")})
    graph = graph.withColumn("follower_source_table_ids", F.array(F.lit(1).cast("long")))
    step = R.loop_step(graph, CID, AS_OF)
    plan = step._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "LocalRelation" not in plan and "LogicalRDD" not in plan
    assert sorted((r.follower_id, r.leader_id) for r in step.collect()) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "a")]


def test_small_partitions_are_hashed_instead_of_sorting_both_sides(spark):
    left, right = (spark.range(2000).select((F.col("id") % 500).alias("k"), F.col("id").alias(v)) for v in "ab")
    joined = left.hint("rebalance").join(right.groupBy("k").agg(F.max("b").alias("b")), "k", "left")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert adaptive is None
        assert sorted(r["b"] for r in joined.collect())[-1] == 1999
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    final = plan.split("Initial Plan")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final


def test_one_enriched_table_does_not_make_the_others(spark, monkeypatch):
    from checks import identity as I

    asked = []
    monkeypatch.setattr(I, "_stored", lambda spark, sf, name, make: asked.append(name) or name)
    assert I.enriched_one(spark, "nowhere", "shop_orders") == "enriched-shop_orders"
    assert asked == ["enriched-shop_orders"]


def test_known_frequency_needs_no_count(spark, monkeypatch):
    monkeypatch.setattr(skew, "hot_keys", lambda *a, **k: pytest.fail("keys were counted"))
    left = spark.createDataFrame([("a", i) for i in range(9)] + [(None, 9)], "k string, v int")
    right = spark.createDataFrame([("a", 1)], "k string, w int")
    got = skew.salted_join(left, right, ["k"], "left", floor=9, total=10, largest=9)
    assert sorted((r["k"] or "", r["v"], r["w"]) for r in got.collect()) == [("", 9, None)] + [("a", i, 1) for i in range(9)]


def test_keys_of_a_row_are_found_once(spark):
    schemas = {
        "crm_profiles": "customer_id string, email string, phone string, time long",
        "shop_orders": "order_id long, customer_id string, order_email string, time long",
        "web_events": "event_id long, cookie_id string, user_email string, customer_id string, time long",
    }
    rows = {
        "crm_profiles": [("1", "a@x", None, 5), ("N/A", "bad", "", 6), (None, None, None, 7)],
        "shop_orders": [(1, "1", None, 9), (2, None, "b@x", 8)],
        "web_events": [(1, "ck", "a@x", None, 1)],
    }
    found = {n: spark.createDataFrame(rows[n], schemas[n]) for n in schemas}
    pairs = X.pair_table(X.extract_all(found, CFG, CID), 3)
    assert "size(filter(" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.follower_id, r.leader_id, r.first_at, r.last_at) for r in pairs.collect())
    assert got == [("1", "1", 9, 9), ("1", "a@x", 5, 5), ("a@x", "a@x", 5, 5), ("a@x", "ck", 1, 1), ("b@x", "b@x", 8, 8), ("ck", "ck", 1, 1)]


@pytest.mark.parametrize("floor", [2, 1000])
def test_contraction_by_windows_and_by_joins(spark, monkeypatch, floor):
    """With few neighbours no half step is written; a node with more than ``floor`` takes the joins."""
    rng, saved = random.Random(5), []
    edges = {(max(p), min(p)) for p in ((rng.randrange(80), rng.randrange(80)) for _ in range(55)) if p[0] != p[1]}
    edges |= {(99 - i, 98 - i) for i in range(10)} | {(100 + i, 100) for i in range(1, 9)}
    save = Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: saved.append(name) or save(self, df, name))
    graph = spark.createDataFrame(sorted(edges), "a long, b long")
    stars, metrics = R.contract(graph, Scratch(spark, "test"), floor=floor)
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert sorted(tuple(r) for r in stars.collect()) == sorted((n, r) for n, r in root.items() if n != r)
    assert any(n.startswith("large") for n in saved) == (floor == 2)
    assert metrics[-1]["updated_count"] == 0 and metrics[-1]["widest"] >= 8


def test_followers_of_one_two_and_many_leaders(spark):
    """Two leaders of a follower are linked from its one row; the graph can be left to the caller to write."""
    links = [("f1", "l1"), ("f2", "l1"), ("f2", "l2"), ("f3", "l3"), ("f3", "l4"), ("f3", "l5"), ("f3", "l6"), ("f4", "l6"), ("f4", "l2"), ("f5", "l7")]
    rows = [(f, 2, l, 1, i, 100 - i, 1 << (i % 3)) for i, (f, l) in enumerate(links)]
    pairs = spark.createDataFrame(rows, "follower_id string, follower_ns long, leader_id string, leader_ns long, first_at long, last_at long, _w0 long")
    for written in (True, False):
        graph = R.resolve(pairs, CID, 3, AS_OF, floor=2, written=written).graph
        got = {r.follower_id: (r.leader_id, r.follower_first_seen_at, r.follower_last_seen_at, r.follower_source_table_ids) for r in graph.collect()}
        assert got == {
            "f1": ("l1", 0, 100, [1]), "f2": ("l1", 1, 99, [2, 3]), "f3": ("l1", 3, 97, [1, 2, 3]),
            "f4": ("l1", 7, 93, [2, 3]), "f5": ("l7", 9, 91, [1]),
        }


def test_replaced_keys_are_written_once(spark, tmp_path, monkeypatch):
    """Where the number of buckets is known, added rows go straight to their buckets."""
    saved, save = [], Scratch.save
    root = str(tmp_path / "t")
    tables.replace_by_keys(spark.range(20).withColumn("v", F.lit(0)), root, ["id"], 4, "full")
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: saved.append(name) or save(self, df, name))
    added = spark.range(5, 25).withColumn("v", F.lit(1))
    tables.replace_keys(added, added, root, ["id"], "day1")
    assert sorted((r.id, r.v) for r in tables.load(spark, root).collect()) == [(i, int(i >= 5)) for i in range(25)]
    assert saved == ["gone"]


def test_documents_with_an_id_of_their_own_are_not_ordered(spark):
    """Only rows that share an id, or have none, go through the window; each distinct text of the others stays."""
    simhash_index = pytest.importorskip("kindred.llm.simhash_index")
    words = ["red fox runs far", "blue whale sings low", "green tree grows tall", "old clock ticks on"]
    rows = [(1, words[0]), (2, words[1]), (2, words[2]), (3, words[3]), (4, words[0]), (5, words[3]), (None, "nobody knows this one here")]
    kept = simhash_index.stage(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect())[-3:] == [(1, words[0]), (2, words[1]), (3, words[3])]
    assert "Union" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_source_stats_of_ranks_are_those_of_the_graph(spark):
    """From what resolving has made already, without joining every link with its follower again."""
    from kindred.plans import stats

    rng = random.Random(5)
    rows = []
    for _ in range(400):
        ids = rng.sample([(f"e{i}", 1) for i in range(60)] + [(f"c{i}", 2) for i in range(40)] + [("hub", 3)], rng.randint(1, 3))
        rows.append((sorted(ids, key=lambda x: x[1]), rng.randint(1, 99), rng.randint(1, len(CFG.tables))))
    records = spark.createDataFrame(rows, f"id_ns_array array<{X.ID_TYPE}>, time long, source_table_id long")
    pairs = Scratch(spark, "test").save(X.pair_table(records, len(CFG.tables)), "pairs")
    assert pairs.groupBy("follower_id", "follower_ns").count().filter("count > 2").count() and pairs.count() > 100
    done = R.resolve(pairs, CID, len(CFG.tables), AS_OF, saved=True, written=False)
    expected = stats.source_key_stats(X.edges(pairs, len(CFG.tables), AS_OF), CFG, CID, AS_OF)
    found = stats.source_key_stats_of_ranks(done.seen, done.followers, CFG, CID, AS_OF)
    assert found.columns == expected.columns and found.dtypes == expected.dtypes
    assert sorted(found.collect()) == sorted(expected.collect())


def test_small_partitions_are_not_merged_down_to_one_per_core(spark):
    """One task more than cores is a second round of tasks."""
    from kindred.session import configure

    name = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    before = spark.conf.get(name, None)
    try:
        assert int(configure(spark).conf.get(name)) >= 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
