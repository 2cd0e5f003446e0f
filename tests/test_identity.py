"""Golden cases, brute force and properties of the unification."""

import random
import re
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kindred.functions.hashing import KEY_MASKS, canonical_hash, key_masks
from kindred.functions.keyrules import key_valid
from kindred.plans import bucketed as B
from kindred.plans import canonical as K
from kindred.plans import enrich as E
from kindred.plans import extract as X
from kindred.plans import master as M
from kindred.plans import pipelines, stored
from kindred.plans import resolve as R
from kindred.plans.config import CanonicalId, Config, Key, KeyColumn, Table, check_config, from_dict, pattern_fault
from kindred.plans.unify import resolve_incremental, unify, unify_levels
from kindred.sources import tables

AS_OF = 1_700_000_000


def links_frame(spark, links):
    rows = [(f[1], f[0], l[1], l[0], t, t, 1) for f, l, t in links]
    return spark.createDataFrame(
        rows, "follower_id string, follower_ns bigint, leader_id string, leader_ns bigint, first_at bigint, last_at bigint, _w0 bigint"
    )


def brute_force(links, rank=lambda n: n):
    """Union-find; the smallest leader of a component wins."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for f, l, _ in links:
        parent[find(f)] = find(l)
    best = {}
    for _, l, _ in links:
        root = find(l)
        if root not in best or rank(l) < rank(best[root]):
            best[root] = l
    return {f: best[find(f)] for f, _, _ in links}


def random_links(seed, records=120, ids=60):
    rng, links = random.Random(seed), []
    for t in range(records):
        keys = [(rng.randint(1, 3), f"i{rng.randrange(ids)}") for _ in range(rng.randint(1, 3))]
        links += [(k, keys[0], t) for k in keys]
    return links


def leaders_of(graph):
    rows = graph.select("follower_ns", "follower_id", "leader_ns", "leader_id").collect()
    found = {(r[0], r[1]): (r[2], r[3]) for r in rows}
    assert len(found) == len(rows)
    return found


def chain(n):
    """Each record ties key i to key i+1, so the component is one long path."""
    return [x for i in range(n) for x in (((1, f"k{i:04d}"), (1, f"k{i:04d}"), i), ((1, f"k{i + 1:04d}"), (1, f"k{i:04d}"), i))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_resolve_equals_brute_force(spark, seed):
    links = random_links(seed)
    cid = CanonicalId("u", ("a", "b", "c"))
    graph = R.resolve(links_frame(spark, links), cid, 1, AS_OF).graph
    assert leaders_of(graph) == brute_force(links)


def test_resolve_with_split_hot_keys_equals_brute_force(spark):
    """Floor 0: every key above the share is cut into pieces."""
    links = random_links(9, records=200, ids=25)
    links += [((2, "hub"), (1, f"h{i}"), i) for i in range(150)] + [((1, f"h{i}"), (1, f"h{i}"), i) for i in range(150)]
    cid = CanonicalId("u", ("a", "b", "c"))
    graph = R.resolve(links_frame(spark, links), cid, 1, AS_OF, floor=3).graph
    assert leaders_of(graph) == brute_force(links)


def test_long_chain_and_step_limit(spark):
    links, cid = chain(60), CanonicalId("u", ("a",))
    graph = R.resolve(links_frame(spark, links), cid, 1, AS_OF)
    assert set(leaders_of(graph.graph).values()) == {(1, "k0000")}
    with pytest.raises(R.NotConverged) as error:
        R.resolve(links_frame(spark, links), cid, 1, AS_OF, max_steps=1)
    assert error.value.metrics[0]["edge_count"] == 59


def test_loop_and_contraction_agree(spark):
    links, cid = random_links(5, records=60, ids=50), CanonicalId("u", ("a", "b", "c"))
    pairs = links_frame(spark, links).groupBy("follower_id", "follower_ns", "leader_id", "leader_ns").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.bit_or("_w0").alias("_w0")
    )
    done = R.loop_to_fixpoint(X.edges(pairs, 1, AS_OF), cid, AS_OF)
    assert done.metrics[-1]["updated_count"] == 0
    assert leaders_of(done.graph) == brute_force(links)
    with pytest.raises(R.NotConverged):
        R.loop_to_fixpoint(X.edges(links_frame(spark, chain(30)), 1, AS_OF), CanonicalId("u", ("a",)), AS_OF, max_steps=2)


def test_priorities_reorder_leaders(spark):
    """Priorities are a rank of their own, not the namespace."""
    links, ranks = random_links(11), (3, 1, 2)
    cid = CanonicalId("u", ("a", "b", "c"), key_priorities=ranks)
    want = brute_force(links, rank=lambda n: (ranks[n[0] - 1], n[1]))
    assert leaders_of(R.resolve(links_frame(spark, links), cid, 1, AS_OF).graph) == want
    graph0 = X.edges(links_frame(spark, sorted({(f, l, 0) for f, l, _ in links})), 1, AS_OF)
    assert leaders_of(R.loop_to_fixpoint(graph0, cid, AS_OF).graph) == want


def test_ids_with_separators_survive(spark):
    links = [((1, "a|b"), (1, "a|b"), 1), ((2, "x"), (1, "a|b"), 1), ((2, "x"), (1, "a|c"), 2), ((1, "a|c"), (1, "a|c"), 2)]
    graph = R.resolve(links_frame(spark, links), CanonicalId("u", ("a", "b")), 1, AS_OF).graph
    assert set(leaders_of(graph).values()) == {(1, "a|b")}


def test_hash_golden_values(spark):
    df = spark.createDataFrame([("a@b.com",), ("",)], "id string")
    got = [r[0] for r in df.select(canonical_hash(F.col("id"), F.lit(KEY_MASKS[1]))).collect()]
    assert got == ["mjD1uGEWvn2Q", "ghjlsC66uPyQ"]
    assert len({m for m in KEY_MASKS}) == 10
    with pytest.raises(ValueError):
        key_masks(11)


def test_hash_is_url_safe(spark):
    ids = spark.range(3000).select(F.col("id").cast("string").alias("id"))
    bad = ids.select(canonical_hash(F.col("id"), F.lit(KEY_MASKS[0])).alias("h")).filter(~F.col("h").rlike("^[A-Za-z0-9_-]{12}$"))
    assert bad.count() == 0


def test_key_rules(spark):
    df = spark.createDataFrame([("a@b",), ("N/A",), (None,), ("",), ("x",)], "v string")
    both = df.select(key_valid(F.col("v"), ["", "N/A", None], "@")).collect()
    none = df.select(key_valid(F.col("v"))).collect()
    assert [r[0] for r in both] == [True, False, False, False, False]
    assert [r[0] for r in none] == [True, True, False, True, True]


CFG = from_dict(
    {
        "keys": [{"name": "email", "valid_regexp": ".*@.*"}, {"name": "user_id"}, {"name": "phone"}],
        "tables": [
            {
                "table": "customer_profiles",
                "key_columns": [{"column": "email", "key": "email"}, {"column": "customer_id", "key": "user_id"}, {"column": "phone", "key": "phone"}],
            },
            {"table": "order_history", "key_columns": [{"column": "customer_email", "key": "email"}, {"column": "user_id", "key": "user_id"}]},
        ],
        "canonical_ids": [{"name": "unified_id", "merge_by_keys": ["email", "user_id", "phone"]}],
        "master_tables": [
            {
                "name": "people",
                "canonical_id": "unified_id",
                "attributes": [
                    {"name": "best_email", "source_columns": [{"table": "customer_profiles", "column": "email"}, {"table": "order_history", "column": "customer_email"}]},
                    {"name": "ids", "array_elements": 3, "source_columns": [{"table": "customer_profiles", "column": "customer_id"}, {"table": "order_history", "column": "user_id"}]},
                ],
            }
        ],
    }
)


def people(spark):
    profiles = spark.createDataFrame(
        [("C001", "john@email.com", "5551234567", 1), ("C002", "jane@email.com", "5559876543", 2)],
        "customer_id string, email string, phone string, time bigint",
    )
    orders = spark.createDataFrame(
        [("O001", "U001", "john@email.com", 3), ("O002", "U002", "jane@email.com", 4), ("O003", "U003", "bob@email.com", 5), ("O004", None, None, 6)],
        "order_id string, user_id string, customer_email string, time bigint",
    )
    return {"customer_profiles": profiles, "order_history": orders}


def test_three_people(spark):
    done = unify(people(spark), CFG, AS_OF)
    rows = done.masters["people"].collect()
    assert sorted((r.best_email, r.ids) for r in rows) == [
        ("bob@email.com", ["U003"]),
        ("jane@email.com", ["C002", "U002"]),
        ("john@email.com", ["C001", "U001"]),
    ]
    K.assert_one_canonical_per_id(done.lookup)
    orders = done.enriched["order_history"]
    assert orders.count() == 4 and orders.filter("unified_id is null").count() == 1
    total = done.source_stats.filter("from_table = '*'").first()
    assert (total.total_distinct, total.distinct_email, total.distinct_user_id) == (3, 3, 5)
    result = {r.from_table: r for r in done.result_stats.collect()}
    assert result["*"].histogram_user_id == "1:1,2:2" and result["customer_profiles"].total_distinct == 2


def test_enrichment_keeps_rows_with_split_keys(spark):
    tables = people(spark)
    lookup = unify(tables, CFG, AS_OF).lookup
    many = tables["order_history"].crossJoin(spark.range(50)).drop("id")
    got = E.enrich(many, CFG, CFG.canonical_ids[0], CFG.tables[1], lookup, floor=3)
    plain = E.enrich(many, CFG, CFG.canonical_ids[0], CFG.tables[1], lookup)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert got.count() == 200


def test_key_order_decides_first_key(spark):
    """By default the order of key columns counts, on request the merge order."""
    table = Table("t", (KeyColumn("p", "phone"), KeyColumn("e", "email")))
    cfg = replace(CFG, tables=(table,))
    df = spark.createDataFrame([("1", "a@b", 1)], "p string, e string, time bigint")
    cid = cfg.canonical_ids[0]
    first = lambda flag: df.select(F.coalesce(*X.key_structs(cfg, cid, table, flag)).alias("k")).first().k.id
    assert (first(False), first(True)) == ("1", "a@b")


def test_table_without_merge_key_gives_no_rows(spark):
    table = Table("t", (KeyColumn("x", "other"),))
    cfg = Config((Key("email"), Key("other")), (table,), (CanonicalId("u", ("email",)),))
    df = spark.createDataFrame([("1", 1)], "x string, time bigint")
    assert X.extract_ids(df, cfg, cfg.canonical_ids[0], table).count() == 0


def test_many_tables_fit_the_bit_sets(spark):
    rows = [([("a", 1)], 5, t) for t in (1, 62, 63, 130)]
    records = spark.createDataFrame(rows, "id_ns_array array<struct<id:string,ns:bigint>>, time bigint, source_table_id bigint")
    edge = X.edges(X.pair_table(records, 130), 130, AS_OF).first()
    assert edge.follower_source_table_ids == [1, 62, 63, 130]


def test_iteration_heuristic():
    keys, tables = tuple(Key(f"k{i}") for i in range(4)), tuple(Table(f"t{i}", ()) for i in range(8))
    plan = lambda k, t: Config(keys[:k], tables[:t], ()).iterations(CanonicalId("u", tuple(f"k{i}" for i in range(k))))
    assert (plan(3, 3), plan(4, 8), plan(1, 1)) == (6, 10, 3)
    assert Config(keys, tables, ()).iterations(CanonicalId("u", ("k0",), merge_iterations=15)) == 15


def test_config_faults_are_all_reported(spark):
    bad = replace(
        CFG,
        keys=CFG.keys + (Key("email", "["),),
        canonical_ids=(CanonicalId("unified_id", ("email", "nope")),),
    )
    schemas = {n: df.schema for n, df in people(spark).items()}
    del schemas["order_history"]
    with pytest.raises(ValueError) as error:
        check_config(bad, schemas)
    for part in ("duplicate key email", "bad regexp", "unknown merge key nope", "order_history is missing"):
        assert part in str(error.value)
    assert check_config(CFG, {n: df.schema for n, df in people(spark).items()}) is CFG


def test_master_ties_nulls_and_first(spark):
    df = spark.createDataFrame(
        [("u", "a", 5), ("u", "b", 5), ("u", None, 9), ("u", "z", None), ("v", None, 1), (None, "q", 1)], "cid string, x string, time bigint"
    )
    last = dict(map(tuple, M.master_value(df, "cid", "x", "time", "x").collect()))
    first = dict(map(tuple, M.master_value(df, "cid", "x", "time", "x", newest=False).collect()))
    assert last == {"u": "b", "v": None} and first == {"u": "z", "v": None}


def test_master_counts(spark):
    df = spark.createDataFrame([("u", "b"), ("u", "a"), ("u", "b"), (None, "c")], "cid string, x string")
    assert M.master_counts(df, "cid", "x", "ids", "n").first() == ("u", 0, ["a", "b"], 3)


def test_master_counts_in_parts(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 990, "big").otherwise("small").alias("cid"), F.col("id").alias("x"))
    got = M.master_counts(df, "cid", "x", "ids", "n", part_size=100).collect()
    big = [r for r in got if r.cid == "big"]
    assert len(big) == 10 and all(r.n == 990 and r.ids == sorted(r.ids) and len(r.ids) < 200 for r in big)
    assert sorted(int(i) for r in big for i in r.ids) == list(range(990))
    assert [(r.part, r.n) for r in got if r.cid == "small"] == [(0, 10)]


def test_ids_stay_stable_when_components_merge(spark):
    cid = CFG.canonical_ids[0]
    tables = people(spark)
    before = unify(tables, CFG, AS_OF).lookup
    bridge = spark.createDataFrame(
        [([("jane@email.com", 1), ("bob@email.com", 1)], 99, 2), ([("new@x", 1)], 100, 2)],
        "id_ns_array array<struct<id:string,ns:bigint>>, time bigint, source_table_id bigint",
    )
    after, merged = resolve_incremental(before, bridge, cid, 2, AS_OF + 60)
    old = {(r.id, r.id_key_type): r for r in before.collect()}
    new = {(r.id, r.id_key_type): r for r in after.collect()}
    jane, bob = old[("jane@email.com", 1)].canonical_id, old[("bob@email.com", 1)].canonical_id
    assert new[("john@email.com", 1)].canonical_id == old[("john@email.com", 1)].canonical_id
    assert new[("bob@email.com", 1)].canonical_id == jane and new[("U003", 2)].canonical_id == jane
    assert [tuple(r) for r in merged.collect()] == [(bob, jane)]
    assert set(new) == set(old) | {("new@x", 1)}
    assert new[("jane@email.com", 1)].id_source_table_ids == [1, 2]
    # A profile without new records passes through as it was.
    assert new[("john@email.com", 1)].id_last_processed_at == AS_OF
    assert new[("bob@email.com", 1)].id_last_processed_at == AS_OF + 60


def test_levels(spark):
    cfg = replace(
        CFG,
        keys=CFG.keys + (Key("person"),),
        canonical_ids=(CanonicalId("person", ("email", "user_id")), CanonicalId("household", ("person", "phone"))),
        master_tables=(),
    )
    tables = people(spark)
    shared = tables["customer_profiles"].withColumn("phone", F.lit("555"))
    done = unify_levels({**tables, "customer_profiles": shared}, cfg, AS_OF)
    rows = done["household"].enriched["customer_profiles"].collect()
    assert len({r.person for r in rows}) == 2 and len({r.household for r in rows}) == 1


def contacts(spark, rows):
    return spark.createDataFrame(rows, "email string, customer_id string, address string, time long")


STORED = from_dict(
    {
        "keys": [{"name": "email"}, {"name": "customer_id"}, {"name": "address"}, {"name": "person"}],
        "tables": [{"table": "crm", "key_columns": [{"column": c, "key": c} for c in ("email", "customer_id", "address")]}],
        "canonical_ids": [
            {"name": "household", "merge_by_keys": ["person", "address"]},
            {"name": "person", "merge_by_keys": ["email", "customer_id"]},
        ],
        "master_tables": [
            {"name": "people", "canonical_id": "person", "attributes": [{"name": "last_address", "source_columns": [{"table": "crm", "column": "address"}]}]}
        ],
    }
)


def partition(df, member, group):
    out = {}
    for r in df.collect():
        out.setdefault(r[group], set()).add(r[member])
    return sorted(map(sorted, out.values()))


def test_stored_increments_with_two_ids(spark, tmp_path, monkeypatch):
    day1 = [(f"e{i}", f"c{i}", f"a{i // 2}", 10 + i) for i in range(40)] + [(None, None, "a0", 60), (None, None, None, 61)]
    day2 = [("e0", "c9", "a4", 100), ("e50", "c50", "a50", 101)]  # two people, and with them two households, are one
    day3 = [("e50", "c51", "a7", 200), (None, None, "a50", 201)]
    run = lambda rows, root, **how: pipelines.run_unification(spark, {"crm": contacts(spark, rows)}, STORED, str(tmp_path / root), 1000, buckets=16, **how)
    whole = run(day1 + day2 + day3, "whole")
    first = run(day1, "steps")
    ids = {r.email: (r.person, r.household) for r in first["person"].enriched["crm"].collect()}
    before = tables.folders(spark, str(tmp_path / "steps" / "enriched_crm"))

    def dies(*args, **how):
        raise RuntimeError("killed")

    real = stored.tables.replace_keys
    monkeypatch.setattr(stored.tables, "replace_keys", lambda df, gone, root, *rest: dies() if "people" in root else real(df, gone, root, *rest))
    with pytest.raises(RuntimeError, match="killed"):
        run(day1 + day2, "steps", full=False, run_id="day2")
    monkeypatch.setattr(stored.tables, "replace_keys", real)
    # The next run finishes the one that died.
    steps = run(day1 + day2 + day3, "steps", full=False, run_id="day3")
    again = run(day1 + day2 + day3, "steps", full=False, run_id="day3")
    after = tables.folders(spark, str(tmp_path / "steps" / "enriched_crm"))
    assert len([n for n in before if not set(before[n]) <= set(after[n])]) <= 6 < len(before)
    for got in (steps, again):
        for level in ("person", "household"):
            rows, want = got[level].enriched["crm"], whole[level].enriched["crm"]
            assert rows.count() == want.count() == 46
            named = lambda df: df.withColumn("row", F.concat_ws("/", F.coalesce("email", F.lit("-")), F.coalesce("address", F.lit("-")), "time"))
            assert partition(named(rows), "row", level) == partition(named(want), "row", level)
        assert {(r.last_address, r.n) for r in got["person"].masters["people"].groupBy("last_address").agg(F.count("*").alias("n")).collect()} == {
            (r.last_address, r.n) for r in whole["person"].masters["people"].groupBy("last_address").agg(F.count("*").alias("n")).collect()
        }
    now = {r.email: (r.person, r.household) for r in again["person"].enriched["crm"].filter("time < 100").collect()}
    assert all(now[e] == ids[e] for e in ids if e not in ("e0", "e1", "e8", "e9", "e14", "e15"))
    assert now["e9"][0] == now["e0"][0] == ids["e0"][0]
    feed = tables.load(spark, str(tmp_path / "steps" / "person_merged")).collect()
    assert [(r.old_canonical_id, r.canonical_id) for r in feed] == [(ids["e9"][0], ids["e0"][0])]
    belongs = {r.person: r.household for r in tables.load(spark, str(tmp_path / "steps" / "person_to_household")).collect()}
    assert all(belongs[p] == h for e, (p, h) in now.items() if e)


def test_ids_that_merge_by_each_other_are_refused():
    loop = replace(STORED, canonical_ids=(CanonicalId("a", ("b", "email")), CanonicalId("b", ("a", "email"))))
    with pytest.raises(ValueError, match="by each other"):
        stored.levels_of(loop)


def test_patterns_are_checked_where_they_run(spark):
    assert pattern_fault(r"\p{IsLatin}+[a-z&&[^b]]") is None  # not a pattern in Python
    assert pattern_fault("(?P<x>a)") is not None  # one in Python only
    assert pattern_fault("(a") is not None


def person_config():
    return from_dict(
        {
            "keys": [{"name": "email"}, {"name": "customer_id"}],
            "tables": [{"table": "crm", "key_columns": [{"column": c, "key": c} for c in ("email", "customer_id")]}],
            "canonical_ids": [{"name": "person", "merge_by_keys": ["email", "customer_id"]}],
            "master_tables": [
                {"name": "people", "canonical_id": "person", "attributes": [{"name": "last_address", "source_columns": [{"table": "crm", "column": "address"}]}]}
            ],
        }
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def side_of(plan, table):
    """The operators between a table's scan and the join above it."""
    lines = plan.split("\n")
    depth = lambda line: len(re.match(r"[ :+|*-]*", line)[0])
    out = []
    for i, line in enumerate(lines):
        if "Scan parquet" in line and table in line:
            below = depth(line)
            for above in reversed(lines[:i]):
                if depth(above) < below:
                    below = depth(above)
                    if "Join" in above:
                        break
                    out.append(above)
    return out


@pytest.fixture
def merge_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("floor", [1_000_000, 10])
def test_bucketed_lookup(spark, tmp_path, merge_joins, floor):
    people = [(f"e{i}", f"c{i}", f"a{i // 2}", 10 + i) for i in range(60)]
    # A hot known key, a hot unknown one, many rows without a key.
    hot = [("e1", None, None, 90 + i) for i in range(50)] + [("new", None, None, 90 + i) for i in range(40)] + [(None, None, "x", 90)] * 40
    done = unify({"crm": contacts(spark, people)}, person_config(), as_of=AS_OF)
    cfg = person_config()
    canonical, table = cfg.canonical_ids[0], cfg.tables[0]
    name = f"lookup_{uuid.uuid4().hex}"
    found = B.publish_lookup(done.lookup, name, buckets=8, path=str(tmp_path / name))
    arrived = contacts(spark, people + hot)
    want = E.enrich(arrived, cfg, canonical, table, done.lookup)
    got = B.enrich_bucketed(arrived, cfg, canonical, table, found, floor=floor)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    sides = side_of(plan_of(B.enrich_bucketed(arrived, cfg, canonical, table, found)), found.by_key)
    assert sides and not any("Exchange" in line for line in sides)
    master = cfg.master_tables[0]
    plain = M.master_table(master, {"crm": want}, done.lookup)
    made = B.master_bucketed(spark, master, {"crm": got}, found)
    assert sorted(map(repr, made.collect())) == sorted(map(repr, plain.collect())) and plain.count() == 60
    sides = side_of(plan_of(made), found.by_id)
    assert sides and not any("Exchange" in line for line in sides)
    spark.sql(f"DROP TABLE {found.by_key}")
    spark.sql(f"DROP TABLE {found.by_id}")
