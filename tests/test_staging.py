"""Cleaning rules, traps and upsert properties."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.functions import cleaning as C
from kindred.functions import jsontext as J
from kindred.operators import staging as S
from kindred.operators.skew import salted_join


def one(spark, value, *columns, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(*columns).first()


@pytest.mark.parametrize(
    "raw, want",
    [
        ("(555) 000-1234", "5550001234"),
        ("15550001234", "5550001234"),
        ("555000123", None),
        ("0", None),
        ("", None),
        (None, None),
        ("25550001234", None),
    ],
)
def test_phone(spark, raw, want):
    row = one(spark, raw, *C.std_phone("v"))
    assert (row.v, row.v_std, row.v_valid) == (raw, want, "TRUE" if want else "FALSE")
    assert (row.v_hash is None) == (want is None)


def test_email_hash_uses_the_raw_text(spark):
    import hashlib

    row = one(spark, " Joe@X.com ", *C.std_email("v"))
    assert (row.v, row.v_std, row.v_valid) == ("joe@x.com", "joe@x.com", "TRUE")
    assert row.v_hash == hashlib.sha256(b" JOE@X.COM ").hexdigest()
    bad = one(spark, "joe@x", *C.std_email("v"))
    assert (bad.v, bad.v_std, bad.v_hash, bad.v_valid) == ("joe@x", None, None, "FALSE")


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2024-03-01 10:20:30", "2024-03-01 10:20:30"),
        ("2024-03-01T10:20:30Z", "2024-03-01 10:20:30"),
        ("2024-03-01T10:20:30+02:00", "2024-03-01 08:20:30"),
        ("2024-03-01", "2024-03-01 00:00:00"),
        ("1709288430", "2024-03-01 10:20:30"),
        ("01-03-2024 10:20:30.123", "2024-03-01 10:20:30"),
        ("01-03-2024", "2024-03-01 00:00:00"),
        ("03/01/2024 10:20:30", "2024-03-01 10:20:30"),
        ("03/01/2024", "2024-03-01 00:00:00"),
        ("3/1/2024 9:05:06", "2024-03-01 09:05:06"),
        ("03/01/2024 10:20:30.5", "2024-03-01 10:20:30"),
        ("13/01/2024", None),
        ("01-03-2024 10:20", None),
        ("2024-02-30", None),
        ("2024", None),
        ("bad", None),
        (None, None),
    ],
)
def test_dates(spark, raw, want):
    row = one(spark, raw, *C.std_date("v"))
    assert (row.v, row.v_std, row.v_date) == (raw, want, want and want[:10])
    assert (row.v_unixtime is None) == (want is None)


def test_numbers_flags_and_strings(spark):
    assert one(spark, " 12.345 ", C.std_numeric(F.col("v")).alias("x")).x == 12.35
    assert one(spark, "abc", C.std_numeric(F.col("v")).alias("x")).x is None
    assert [one(spark, v, C.std_boolean(F.col("v")).alias("x")).x for v in (" YES", "0", "maybe", None)] == ["TRUE", "FALSE", None, None]
    assert [one(spark, v, C.std_string(F.col("v")).alias("x")).x for v in (" a ", "n/a", "None", "", None)] == ["A", None, None, None, None]


def test_masking(spark):
    row = one(spark, "abcdef@x.org", C.mask_email(F.col("v"), F.lit(False)).alias("e"), C.mask_phone(F.lit("5550001234"), F.lit(False)).alias("p"))
    assert (row.e, row.p) == ("abc***@x.org", "***-***-1234")
    assert one(spark, "no-at", C.mask_email(F.col("v"), F.lit(False)).alias("e")).e is None


def test_json(spark):
    text = '{"$a":"x","b c":"","n":1.5,"o":{"k":"v"},"l":["p","q"]}'
    row = one(
        spark,
        text,
        J.json_scalar(F.col("v"), ["$a"]).alias("a"),
        J.json_scalar(F.col("v"), ["b c"]).alias("b"),
        J.json_array(F.col("v"), ["l"]).alias("l"),
        J.json_array(F.col("v"), ["n"]).alias("n"),
        J.json_cast(F.col("v"), ["n"], "bigint", 7).alias("c"),
    )
    assert tuple(row) == ("X", None, ["p", "q"], None, 7)
    assert J.json_column_name("Attr", ["$Src", "B c"]) == "attr_src_b_c"


def test_json_keys_must_not_clash(spark):
    df = spark.createDataFrame([('{"a b":"1","a_b":"2"}',)], "j string")
    with pytest.raises(ValueError):
        S.json_flatten(df, "j", S.collect_json_keys(df, "j"))
    with pytest.raises(ValueError):
        S.collect_json_keys(df, "j", limit=1)


def test_json_keys_that_differ_in_case(spark):
    """Each has a column of its own, below an object as well."""
    df = spark.createDataFrame([('{"City":"a","city":"b","n":{"X":1,"x":[2]}}',), ('{"city":"c","n":"t"}',), ("broken",), (None,)], "j string")
    flat = S.json_flatten(df, "j", S.collect_json_keys(df, "j"))
    got = [(r.j_city, r.j_city_2, r.j_n, r.j_n_x, r.j_n_x_2) for r in flat.collect()]
    assert got == [("A", "B", None, "1", ["2"]), (None, "C", "T", None, None), (None,) * 5, (None,) * 5]


def test_key_registry_keeps_columns(spark):
    """A key found later comes behind the known ones, and a known one keeps its kind, whatever later rows hold."""
    registry = spark.createDataFrame([], S.KEY_REGISTRY_SCHEMA)
    batches = ['{"b":"1","l":["x"],"o":{"k":1}}', '{"B":"2","l":"text","o":"plain","a":"3"}', '{"l":["y"],"o":{"k":2}}', None, "broken"]
    for text in batches:
        fresh = S.new_json_keys(spark.createDataFrame([(text,)], "j string"), ["j"], registry)
        registry = registry.union(spark.createDataFrame(fresh, S.KEY_REGISTRY_SCHEMA))
    assert [(r.k1, r.k2, r.kind) for r in registry.orderBy("place").collect()] == [
        ("b", None, "scalar"), ("l", None, "array"), ("o", None, "object"), ("o", "k", "scalar"), ("B", None, "scalar"), ("a", None, "scalar"), ("o", None, "scalar"),
    ]
    df = spark.createDataFrame([(t,) for t in batches], "j string")
    flat = S.json_flatten(df, "j", S.registered_paths(registry, ["j"])["j"])
    assert flat.columns == ["j", "j_b", "j_l", "j_o_k", "j_b_2", "j_a", "j_o"]
    assert [tuple(r)[1:] for r in flat.collect()] == [
        ("1", ["x"], "1", None, None, None), (None, None, None, "2", "3", "PLAIN"), (None, ["y"], "2", None, None, None), (None,) * 6, (None,) * 6,
    ]


def test_json_key_of_two_kinds(spark):
    """An object in some rows and a text in others gives its own column and those of its children."""
    df = spark.createDataFrame([('{"o":{"k":"v"},"x":"1"}',), ('{"o":"plain"}',), (None,)], "j string")
    flat = S.json_flatten(df, "j", S.collect_json_keys(df, "j"))
    assert [(r.j_o, r.j_o_k, r.j_x) for r in flat.collect()] == [(None, "V", "1"), ("PLAIN", None, None), (None, None, None)]


def test_stage_keeps_every_column_and_raw_json(spark):
    wide = spark.range(1).select(
        *[F.lit(i).alias(f"c{i}") for i in range(205)], F.lit('{"A":"X"}').alias("address"), F.lit("  na ").alias("address_line"), F.lit(1).cast("long").alias("time")
    )
    staged = S.stage(wide, S.Rules(json={"address": [(["A"], "scalar")]}), "t", 1706745600)
    assert set(wide.columns) <= set(staged.columns)
    row = staged.first()
    assert (row.address, row.address_a, row.address_line, row.time) == ('{"A":"X"}', "X", None, 1)


def test_rules_table_drives_staging(spark):
    table = spark.createDataFrame(
        [("d", "t", "k", "time desc", '{"json": "all", "joins": [{"table": "dim", "on": {"n": "id"}, "columns": ["name"]}]}')],
        "db_name string, table_name string, partition_columns string, order_by_columns string, additional_rules string",
    )
    df = spark.createDataFrame([("a", 1, '{"u":{"v":"w"}}', 5), ("a", 1, '{"u":"s"}', 9), (None, 2, "broken", 7)], "k string, n int, attributes string, time long")
    dim = spark.createDataFrame([(1, "one")], "id int, name string")
    rules = S.rules_from(S.load_rules(table, "d", "t"), {"dim": dim})
    got = {r.k: (r.attributes_u, r.attributes_u_v, r.name_dim) for r in S.stage(df, rules, "t", 1706745600).collect()}
    assert got == {"A": ("S", None, "one"), None: (None, None, None)}


def test_clean_before_dedupe(spark):
    df = spark.createDataFrame([("John Smith", 1), ("john smith  ", 2), ("JOHN SMITH", 3)], "name string, time bigint")
    rules = S.Rules(keys=["name"], order=[("time", True)])
    got = S.stage(df, rules, "t", 0).collect()
    assert [(r.name, r.time, r.source_system, r.load_timestamp) for r in got] == [("JOHN SMITH", 3, "t", "1970-01-01 00:00:00")]


def test_join_after_clean(spark):
    df = spark.createDataFrame([("Company@Email.com ", 1)], "email string, time bigint")
    dim = spark.createDataFrame([("company@email.com", "gold", "x")], "mail string, tier string, other string")
    row = S.stage(df, S.Rules(joins=[S.Join(dim, {"email_std": "mail"}, ["tier"])]), "t", 0).first()
    assert row.tier_dim == "gold" and "other_dim" not in row.asDict()


def test_dedupe_groups_nulls_and_sorts_them_last(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("k", None, "c"), ("k", 5, "d")], "k string, t bigint, v string")
    for desc, want in ((True, {(None, "b"), ("k", "d")}), (False, {(None, "a"), ("k", "d")})):
        assert {(r.k, r.v) for r in S.dedupe(df, ["k"], [("t", desc)]).collect()} == want


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = S.dedupe(df, ["k"], [("t", True)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_upsert_keys_compare_by_part(spark):
    target = spark.createDataFrame([("a", "bc", 1), ("ab", "c", 2), (None, None, 3), ("", "", 4), ("n", None, 5)], "x string, y string, v int")
    work = spark.createDataFrame([("ab", "c", 20), (None, None, 30), ("n", "", 50)], "x string, y string, v int")
    got = sorted((r.x or "", r.y or "", r.v) for r in S.upsert(target, work, ["x", "y"]).collect())
    assert got == [("", "", 3), ("", "", 4), ("", "", 30), ("a", "bc", 1), ("ab", "c", 20), ("n", "", 50)]
    assert [r.v for r in S.affected_rows(target, work, ["x", "y"]).orderBy("v").collect()] == [2, 5]


def test_guard_types(spark):
    df = spark.createDataFrame([(True, "2024-01-01")], "ok boolean, d string")
    with pytest.raises(ValueError) as error:
        S.guard_types(df, ["d"])
    assert "ok is boolean" in str(error.value) and "time is missing" in str(error.value) and "d_std is missing" in str(error.value)


def test_classify_and_cap(spark):
    df = spark.createDataFrame([], "user_email string, cell_phone string, attributes string, order_date string, name string, n bigint, ok boolean, time bigint, seen_at bigint")
    assert S.classify_columns(df.schema) == {
        "user_email": "email",
        "cell_phone": "phone",
        "attributes": "json",
        "order_date": "date",
        "name": "string",
        "n": "numeric",
        "ok": "boolean",
        "time": "keep",
        "seen_at": "epoch",
    }
    wide = spark.range(1).select(*[F.lit(i).alias(f"c{i}") for i in range(205)])
    kept, left_out = S.cap_columns(wide)
    assert len(kept.columns) == 200 and left_out == [f"c{i}" for i in range(200, 205)]


def test_rules_precedence(spark):
    table = spark.createDataFrame(
        [("d", "t", "a, b", "x desc, y asc", '{"json": ["p"]}'), ("d", "u", None, None, None)],
        "db_name string, table_name string, partition_columns string, order_by_columns string, additional_rules string",
    )
    assert S.load_rules(table, "d", "t") == {"keys": ["a", "b"], "order": [("x", True), ("y", False)], "additional": {"json": ["p"]}}
    assert S.load_rules(table, "d", "u", {"keys": ["k"]})["keys"] == ["k"]
    assert S.load_rules(table, "d", "none") == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    rng = random.Random(3)
    rows = [(None if rng.random() < 0.3 else ("hot" if rng.random() < 0.5 else f"k{rng.randrange(40)}"), i % 7) for i in range(600)]
    left = spark.createDataFrame(rows, "k string, v int")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 40, 2)], "k string, w int")
    key = lambda df: sorted(map(str, df.collect()))
    got = salted_join(left, right, ["k"], how, floor=5)
    assert key(got) == key(left.join(right, "k", how).select(*got.columns))


def test_nested_maps_do_not_stop_joins_and_dedupe(spark):
    left = spark.range(40).select(F.lit("k").alias("k"), F.array(F.create_map(F.lit("a"), F.col("id"))).alias("m"), "id")
    assert salted_join(left, left.select("k").distinct(), ["k"], floor=3).count() == 40
    assert S.dedupe(left, ["k"], [("id", True)]).first().id == 39
