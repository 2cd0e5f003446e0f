"""Sketches of identifier columns against exact counts."""

import pytest
from pyspark.sql import functions as F

from kindred.operators import sketches as SK
from kindred.sources import tables

COLUMNS = {"email": "email", "owner": "user_id"}


def numbered(spark, first, last, step=1):
    return spark.range(first, last, step).select(F.concat(F.lit("e"), "id").alias("email"), F.col("id").alias("owner"))


def merged(spark, root, frames, lg):
    for table, df in frames.items():
        SK.record_sketches(df, table, COLUMNS, root, "day1", lg)
    return SK.merge_sketches(tables.load(spark, root), lg)


@pytest.mark.parametrize("lg", [8, 16])
def test_estimates_are_within_their_error(spark, tmp_path, lg):
    frames = {"a": numbered(spark, 0, 30_000), "b": numbered(spark, 20_000, 50_000), "c": numbered(spark, 60_000, 61_000), "d": numbered(spark, 0, 0)}
    rows = SK.overlap_estimate(merged(spark, str(tmp_path / "s"), frames, lg), lg).collect()
    assert len(rows) == 2 * 6
    true = {("a", "b"): 10_000}
    for r in rows:
        want = true.get((r.table_a, r.table_b), 0)
        assert abs(r.shared - want) <= r.error, r
        if lg == 16:
            assert r.error == 0 and r.values_a == {"a": 30_000, "b": 30_000, "c": 1_000}[r.table_a]
    by = {(r.table_a, r.table_b): r for r in rows}
    assert by["a", "d"].coverage_b_pct is None


def test_loads_merge_and_repeats_add_nothing(spark, tmp_path):
    root = str(tmp_path / "s")
    nulls = spark.createDataFrame([(None, None), ("", 7)], "email string, owner long")
    for run, df in (("1", numbered(spark, 0, 100)), ("2", numbered(spark, 50, 150)), ("2", numbered(spark, 50, 150)), ("3", nulls)):
        SK.record_sketches(df, "t", COLUMNS, root, run)
    rows = {r.column_name: r for r in SK.profile_estimate(SK.merge_sketches(tables.load(spark, root))).collect()}
    assert (rows["email"].unique_count, rows["email"].row_count, rows["email"].null_count) == (151, 202, 1)
    assert (rows["owner"].unique_count, rows["owner"].null_count) == (150, 1)


def test_exact_pass_for_worthwhile_pairs_only(spark, tmp_path):
    frames = {"a": numbered(spark, 0, 1000), "b": numbered(spark, 500, 1500), "c": numbered(spark, 1490, 9000)}
    pairs = SK.worthwhile(SK.overlap_estimate(merged(spark, str(tmp_path / "s"), frames, 14), 14), 20)
    assert {(p.table_a, p.table_b) for p in pairs} == {("a", "b")} and len(pairs) == 2
    got = SK.exact_overlap(frames, pairs).collect()
    assert [(r.identifier_type, r.values_a, r.values_b, r.shared, r.coverage_a_pct) for r in sorted(got)] == [("email", 1000, 1000, 500, 50.0), ("user_id", 1000, 1000, 500, 50.0)]
    with pytest.raises(ValueError):
        SK.exact_overlap(frames, [])


def test_only_sketches_are_shuffled(spark):
    plan = SK.sketch_columns(numbered(spark, 0, 1000), "t", COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in plan
