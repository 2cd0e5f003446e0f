"""Hist-union, watermarks, stored tables, files and streams."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.clock import java_pattern
from kindred.operators import histunion as H
from kindred.operators import prep as P
from kindred.operators import staging as S
from kindred.operators import state
from kindred.plans import ingest, pipelines
from kindred.plans.ledger import Ledger
from kindred.sources import files, tables, windows
from kindred.sources.scratch import Scratch, checkpoint_root
from kindred.streaming import jobs


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_names():
    for name in ("db.shop", "db.shop_hist", "db.shop_histunion"):
        assert H.derive_name_texts(name) == ("db.shop", "db.shop_hist", "db.shop_histunion")


def test_extra_column_is_null_for_history(spark):
    inc = spark.createDataFrame([("2024", "a", 5)], "incremental_date string, id string, time bigint")
    hist = spark.createDataFrame([("b", 3, "x")], "id string, time bigint, old string")
    assert rows(H.hist_union_incremental(inc, hist)) == [("2024", "a", 5), (None, "b", 3)]
    assert H.hist_union_incremental(inc, hist, keep_hist_only=True).columns == ["incremental_date", "id", "time", "old"]
    tags = H.hist_union_full(inc, hist, {"incremental_date": F.lit("none")})
    assert rows(tags) == [("2024", "a", 5), ("none", "b", 3)]


def test_new_array_column_and_reserved_word(spark):
    inc = spark.createDataFrame([(1, ["t"], 5)], "`index` bigint, tags array<string>, time bigint")
    hist = spark.createDataFrame([(2, 3)], "`index` bigint, time bigint")
    assert rows(H.hist_union_full(inc, hist, {"tags": F.array()})) == [(1, ["t"], 5), (2, [], 3)]


def test_each_side_has_its_own_watermark(spark):
    inc = spark.createDataFrame([("a", 10), ("b", 11)], "id string, time bigint")
    hist = spark.createDataFrame([("c", 1), ("d", 2)], "id string, time bigint")
    assert rows(H.hist_union_incremental(inc, hist, 10, 1)) == [("b", 11), ("d", 2)]


def test_missing_sides(spark):
    inc = spark.createDataFrame([("a", 10)], "id string, time bigint")
    assert rows(H.hist_union_full(*H.with_missing_side(spark, None, inc))) == [("a", 10)]
    with pytest.raises(ValueError):
        H.with_missing_side(spark, None, None)


def test_watermark_defaults_to_zero(spark):
    log = spark.createDataFrame([("t", "p", 5), ("t", "p", 9), ("t", "q", 20)], state.INC_LOG_SCHEMA)
    assert [state.read_watermark(log, t, p) for t, p in (("t", "p"), ("t", "q"), ("x", "p"))] == [9, 20, 0]


def test_modes():
    assert [state.choose_mode(*a) for a in ((False,), (True,), (True, "full"))] == ["full", "incremental", "full"]
    assert (state.run_mode(), state.run_mode("hist")) == ("inc", "hist")
    with pytest.raises(ValueError):
        state.run_mode("x")


def test_watermark_filter_reaches_the_scan(spark, root):
    spark.range(100).select(F.col("id").alias("time")).write.parquet(f"{root}/t")
    plan = state.new_rows(spark.read.parquet(f"{root}/t"), 50)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(time), GreaterThan(time,50)]" in plan


def test_hist_union_runs_and_replays(spark, root):
    schema = "id string, time bigint"
    hist = spark.createDataFrame([("h1", 1), ("h2", 2)], schema)
    inc1 = spark.createDataFrame([("a", 5)], schema)
    inc2 = spark.createDataFrame([("a", 5), ("late", 5), ("b", 6)], schema)
    go = lambda inc, run, **k: pipelines.run_hist_union(spark, inc, hist, "t", f"{root}/t", f"{root}/log", run, **k)
    go(inc1, "r1")
    assert rows(tables.load(spark, f"{root}/t")) == [("a", 5), ("h1", 1), ("h2", 2)]
    go(inc1, "r1")
    go(inc2, "r2")
    # A row that shares the committed second is not taken again.
    assert rows(tables.load(spark, f"{root}/t")) == [("a", 5), ("b", 6), ("h1", 1), ("h2", 2)]
    go(inc2, "r3", full=True)
    assert tables.load(spark, f"{root}/t").count() == 5
    log = tables.load(spark, f"{root}/log")
    assert state.read_watermark(log, "t", "hist_union") == 6 and state.read_watermark(log, "t_hist", "hist_union") == 2


def test_crash_between_data_and_watermark(spark, root):
    """Data is there, the watermark is not: repeating the run adds nothing twice."""
    inc = spark.createDataFrame([("a", 5)], "id string, time bigint")
    tables.append(inc, f"{root}/t", "r1")
    pipelines.run_hist_union(spark, inc, None, "t", f"{root}/t", f"{root}/log", "r1")
    assert rows(tables.load(spark, f"{root}/t")) == [("a", 5)]


def test_failed_commit_leaves_the_old_table(spark, root, monkeypatch):
    df = spark.createDataFrame([("a", 5)], "id string, time bigint")
    tables.replace(df, f"{root}/t")
    more = spark.createDataFrame([("a", 6), ("b", 7)], "id string, time bigint")

    def fail(*_):
        raise OSError("lost")

    for change in (
        lambda: tables.replace(more, f"{root}/t"),
        lambda: tables.append(more, f"{root}/t", "r1"),
        lambda: tables.upsert_table(more, f"{root}/t", ["id"], "r1"),
        lambda: tables.compact(spark, f"{root}/t"),
    ):
        with monkeypatch.context() as m:
            m.setattr(tables, "_publish", fail)
            with pytest.raises(OSError):
                change()
        assert rows(tables.load(spark, f"{root}/t")) == [("a", 5)]
    tables.upsert_table(more, f"{root}/t", ["id"], "r1")
    assert rows(tables.load(spark, f"{root}/t")) == [("a", 6), ("b", 7)]
    tables.swap_commit(df.limit(0), f"{root}/t")
    assert tables.load(spark, f"{root}/t").count() == 0 and tables.load(spark, f"{root}/t").columns == ["id", "time"]
    with pytest.raises(FileNotFoundError):
        tables.load(spark, f"{root}/none")


def test_two_writers_cannot_publish_one_version(spark, root):
    df = spark.createDataFrame([("a", 5)], "id string, time bigint")
    tables.replace(df, f"{root}/t")
    version, manifest = tables._current(spark, f"{root}/t")
    with pytest.raises(tables.Conflict):
        tables._publish(spark, f"{root}/t", version, manifest)


def test_columns_are_added_and_types_kept(spark, root):
    tables.append(spark.createDataFrame([("a", 5)], "id string, time bigint"), f"{root}/t", "r1")
    tables.append(spark.createDataFrame([("b", 6, "x")], "id string, time bigint, extra string"), f"{root}/t", "r2")
    tables.append(spark.createDataFrame([("c", 7)], "id string, time bigint"), f"{root}/t", "r3")
    assert sorted(map(tuple, tables.load(spark, f"{root}/t").collect())) == [("a", 5, None), ("b", 6, "x"), ("c", 7, None)]
    with pytest.raises(ValueError):
        tables.append(spark.createDataFrame([("d", "8")], "id string, time string"), f"{root}/t", "r4")
    tables.upsert_table(spark.createDataFrame([("b", 9, 1.5)], "id string, time bigint, more double"), f"{root}/t", ["id"], "r5")
    assert ("b", 9, None, 1.5) in {tuple(r) for r in tables.load(spark, f"{root}/t").collect()}


def test_upsert_with_another_number_of_buckets(spark, root):
    make = lambda items: spark.createDataFrame(items, "k string, v int")
    tables.upsert_table(make([("a", 1), ("b", 1), (None, 0)]), f"{root}/t", ["k"], "r1", buckets=256)
    tables.upsert_table(make([("a", 2), ("b", 2)]), f"{root}/t", ["k"], "r2", buckets=16)
    tables.upsert_table(make([("b", 3)]), f"{root}/t", ["k"], "r3")
    assert rows(tables.load(spark, f"{root}/t")) == [("a", 2), ("b", 3), (None, 0)]
    with pytest.raises(ValueError):
        tables.upsert_table(make([("b", 3)]), f"{root}/t", ["v"], "r4")


def test_compaction_keeps_run_ids(spark, root):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    for go in (lambda r: tables.append(df, f"{root}/plain", r), lambda r: tables.upsert_table(df, f"{root}/keyed", ["k"], r)):
        go("r1")
    for name in ("plain", "keyed"):
        tables.compact(spark, f"{root}/{name}")
        assert tables.has_run(spark, f"{root}/{name}", "r1")
    tables.append(df, f"{root}/plain", "r1")
    tables.upsert_table(df, f"{root}/keyed", ["k"], "r1")
    assert tables.load(spark, f"{root}/plain").count() == 2 and tables.load(spark, f"{root}/keyed").count() == 2


def test_upsert_evaluates_the_work_once_and_cleans_up(spark, root):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).selectExpr("cast(id as string) k", "id v")
    tables.replace(df, f"{root}/t")
    for n in range(3):
        tables.upsert_table(df.limit(300).repartition(2).mapInArrow(count, df.schema), f"{root}/t", ["k"], f"r{n}")
    assert seen.value == 900
    assert len(tables._versions(spark, f"{root}/t")) == 2


def test_stored_upsert_equals_plain_upsert(spark, root):
    make = lambda items: spark.createDataFrame(items, "k string, v int")
    target = make([(f"k{i}", i) for i in range(50)] + [(None, -1)])
    expected = target
    tables.replace(target, f"{root}/t")
    for n, items in enumerate(([("k1", 100), ("new", 1)], [("k1", 200), (None, -2), ("", -3)], [])):
        work = make(items)
        for _ in range(2):
            tables.upsert_table(work, f"{root}/t", ["k"], f"run{n}", buckets=4)
        expected = S.upsert(expected, work, ["k"])
        assert rows(tables.load(spark, f"{root}/t")) == rows(expected)


def test_append_to_upserted_table_is_refused(spark, root):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    tables.upsert_table(df, f"{root}/t", ["k"], "r1", buckets=2)
    with pytest.raises(ValueError):
        tables.append(df, f"{root}/t", "r2")


def test_staging_pipeline(spark, root):
    schema = "id string, email string, time bigint"
    rules = S.Rules(keys=["id"], order=[("time", True)])
    go = lambda df, run, **k: pipelines.run_staging(spark, df, "c", rules, f"{root}/t", f"{root}/log", run, 0, buckets=4, **k)
    day1 = spark.createDataFrame([("a", "A@x.org", 1), ("b", "bad", 2)], schema)
    day2 = day1.union(spark.createDataFrame([("a", "a2@x.org", 3)], schema))
    assert [go(day1, "r1"), go(day1, "r2"), go(day2, "r3")] == ["full", "skipped", "incremental"]
    got = tables.load(spark, f"{root}/t").select("id", "email_std", "time")
    assert rows(got) == [("A", "a2@x.org", 3), ("B", None, 2)]


def test_prep_pipeline_cascades(spark, root):
    schema = "cid string, mail string, tel string"
    columns = {"cid": "customer_id", "mail": "email", "tel": "phone"}
    day1 = spark.createDataFrame([("1", "a@x", "5550000001"), ("2", "b@x", None), ("3", None, None), ("4", None, "9" * 64)], schema)
    day2 = spark.createDataFrame([("1", "a@x", "5550000009"), ("3", None, None)], schema)
    first = pipelines.run_prep(spark, [pipelines.PrepSource("s", day1, columns)], root, 100)
    assert sorted(r.customer_id for r in first.collect()) == ["1", "2"]
    second = pipelines.run_prep(spark, [pipelines.PrepSource("s", day2, columns)], root, 200)
    assert [(r.customer_id, r.phone, r.time) for r in second.collect()] == [("1", "5550000009", 200)]
    listed = tables.load(spark, f"{root}/exclusion_list").collect()
    assert [(r.key_name, r.note) for r in listed] == [("phone", "DSAR masked phone")]


def test_exclusions_keep_rows(spark):
    df = spark.createDataFrame([("1", "a@x", "5"), ("2", None, "6"), ("3", "b@x", None)], "id string, email string, phone string")
    excl = spark.createDataFrame([("a@x", "email"), ("6", "phone"), ("5", "email")], "key_value string, key_name string")
    want = [("1", None, "5"), ("2", None, None), ("3", "b@x", None)]
    assert rows(P.apply_exclusions(df, excl)) == want
    assert rows(P.apply_exclusions(df, excl, floor=1)) == want
    assert [r.id for r in P.require_contact(P.apply_exclusions(df, excl)).orderBy("id").collect()] == ["1", "3"]


def test_strptime_patterns():
    assert java_pattern("%Y-%m-%dT%H:%M:%S.%fZ") == "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    with pytest.raises(ValueError):
        java_pattern("%q")


COLUMNS = [
    {"name": "id", "type": "long"},
    {"name": "name", "type": "string"},
    {"name": "at", "type": "timestamp", "format": "%Y-%m-%d %H:%M:%S"},
]


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text, newline="")
    return str(tmp_path / name)


def test_delimited_quotes_and_bad_records(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,name,at\r\n1,"x, ""y""",2024-01-02 03:04:05\r\n2,short\r\n3,long,2024-01-02 03:04:05,more\r\nx,plain,never\r\n')
    read = lambda **k: [(r.id, r.name, r.at and str(r.at)) for r in files.read_delimited(spark, path, COLUMNS, **k).collect()]
    good = [(1, 'x, "y"', "2024-01-02 03:04:05"), (None, "plain", None)]
    assert read() == good
    assert (2, "short", None) in read(allow_optional_columns=True) and len(read(allow_optional_columns=True)) == 3
    assert (3, "long", "2024-01-02 03:04:05") in read(allow_extra_columns=True) and len(read(allow_extra_columns=True)) == 3
    with pytest.raises(Exception, match="invalid record"):
        read(stop_on_invalid_record=True)


def test_delimited_variants(spark, tmp_path):
    write(tmp_path, "d_2024-01-31.tsv", "1\ta\t2024-01-02 03:04:05\n")
    write(tmp_path, "d_2024-02-29.tsv", "2\tb\t2024-01-02 03:04:05\n")
    pattern = f"{tmp_path}/d_{{date}}.tsv"
    options = {"delimiter": "\t", "skip_header_lines": 0}
    assert files.read_delimited(spark, pattern, COLUMNS, date="2024-01-31", **options).first().id == 1
    every = files.read_delimited(spark, f"{tmp_path}/d_*.tsv", COLUMNS, with_file=True, **options)
    assert every.count() == 2 and every.select("source_file").distinct().count() == 2
    with pytest.raises(ValueError):
        files.resolve_path(pattern)
    two = write(tmp_path, "two.csv", "title;;\nid;name;at\n7;x;2024-01-02 03:04:05\n")
    got = files.read_delimited(spark, two, COLUMNS, delimiter=";", skip_header_lines=2)
    assert [r.id for r in got.collect()] == [7]
    write(tmp_path, "two_b.csv", "title;;\nid;name;at\n8;y;2024-01-02 03:04:05\n9;z;2024-01-02 03:04:05\n")
    got = files.read_delimited(spark, f"{tmp_path}/two*.csv", COLUMNS, delimiter=";", skip_header_lines=2, with_file=True)
    assert sorted((r.id, r.source_file.rsplit("/", 1)[1]) for r in got.collect()) == [(7, "two.csv"), (8, "two_b.csv"), (9, "two_b.csv")]


def test_windows(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",), (None,)], "u string")
    assert windows.pull_window(df, "u", "2024-01-01 00:00:00", "2024-01-02 00:00:00").count() == 1
    row = windows.resolve_window(df, "u", "d", "micros", 0).first()
    assert tuple(row) == ("2024-01-02T00:00:00.000000", "1970-01-01T00:00:00.000000")
    fields = windows.choose_inc_fields({"hist": {"table_field": "created_at", "source_field": "created"}}, "hist")
    assert windows.map_inc_fields(spark.createDataFrame([(1,)], "created int"), fields).columns == ["created_at"]
    assert windows.choose_inc_fields({}, "inc") is None


def test_scratch_uses_the_named_folder(spark):
    saved = Scratch(spark, "t").save(spark.range(3), "x")
    plain = lambda path: path.removeprefix("file:").lstrip("/")
    assert plain(saved.inputFiles()[0]).startswith(plain(checkpoint_root(spark)))


def test_stream_dedupe_and_union(spark, root):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("time", T.LongType())])
    spark.createDataFrame([("a", 100), ("b", 101)], schema).write.parquet(f"{root}/in")
    go = lambda: jobs.stream_dedupe(spark, f"{root}/in", schema, ["id"], "1 hour", f"{root}/out", f"{root}/cp").awaitTermination()
    go()
    spark.createDataFrame([("a", 160), ("c", 161)], schema).write.mode("append").parquet(f"{root}/in")
    go()
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "c"]


def test_stream_upsert_replays_a_batch(spark, root):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType()), T.StructField("time", T.LongType())])
    rules = S.Rules(columns={"v": "string"}, keys=["id"], order=[("time", True)])
    spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "n", 1)], schema).write.parquet(f"{root}/in")
    # Two checkpoints: the second stream replays batch 0 in full.
    for cp in ("cp1", "cp2"):
        jobs.stream_stage_upsert(spark, f"{root}/in", schema, rules, "s", 0, f"{root}/t", f"{root}/{cp}", buckets=4).awaitTermination()
    got = tables.load(spark, f"{root}/t").select("id", "v")
    assert rows(got) == [("a", "Y"), (None, "N")]


def test_quotes_over_lines(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_bytes(b'id,name\n1,"x\ny"\n2,"he said ""hi"""\n3,plain\n4,"open\n5,"a ""b"", c"\n')
    columns = [{"name": "id", "type": "long"}, {"name": "name", "type": "string"}]
    got = files.read_delimited(spark, str(path), columns)
    assert rows(got) == [(2, 'he said "hi"'), (3, "plain"), (5, 'a "b", c')]
    with pytest.raises(Exception, match="invalid record"):
        files.read_delimited(spark, str(path), columns, stop_on_invalid_record=True).collect()
    path.write_bytes(b'id,name\r\n1,"x\r\ny"\r\n2,ok\r\n')
    got = files.read_delimited(spark, str(path), columns, multi_line=True)
    assert [(r.id, r.name.replace("\r", "")) for r in got.collect()] == [(1, "x\ny"), (2, "ok")]


@pytest.mark.parametrize(
    "data",
    [
        b'1,"a\r\nb",2\n3,"c\nd",4\n5,x,6\n',
        b'1,"a\nb",2\r\n3,"c\r\nd","4"\r\n5,x,6',
        b'1,"a\r\nb",2\r\n3,"c\nd",4\r\n5,x,6\r\n',
        b'1,"a\nb",2\n3,"c\nd",4\n5,x,6\n',
    ],
)
def test_quoted_line_ends_decide_nothing_about_records(spark, tmp_path, data):
    (tmp_path / "a.csv").write_bytes(data)
    columns = [{"name": "a", "type": "long"}, {"name": "b", "type": "string"}, {"name": "c", "type": "long"}]
    rows = files.read_delimited(spark, str(tmp_path / "a.csv"), columns, skip_header_lines=0, multi_line=True).collect()
    assert [(r.a, r.b.replace("\r\n", "\n"), r.c) for r in rows] == [(1, "a\nb", 2), (3, "c\nd", 4), (5, "x", 6)]


def _times(spark, *times):
    return spark.createDataFrame([(i, f"k{i}", t) for i, t in enumerate(times)], "n long, key string, time long")


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_a_run_that_died_behind_its_data_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, keys):
    rules, target, log = S.Rules(columns={"key": "string"}, keys=keys, order=[("time", True)]), str(tmp_path / "t"), str(tmp_path / "log")
    whole = _times(spark, 1, 2, 3, 4, 5, 6)
    real = pipelines.tables.append

    def dies(df, root, run_id, *rest):
        if root == log:
            raise RuntimeError("killed")
        real(df, root, run_id, *rest)

    for run, upto in (("run1", 2), ("run2", 4)):
        monkeypatch.setattr(pipelines.tables, "append", dies)
        with pytest.raises(RuntimeError, match="killed"):
            pipelines.run_staging(spark, whole.filter(F.col("time") <= upto), "x", rules, target, log, run, 9, buckets=16)
        monkeypatch.setattr(pipelines.tables, "append", real)
        # More rows are there when it is repeated; they wait for the next run.
        assert pipelines.run_staging(spark, whole.filter(F.col("time") <= upto + 1), "x", rules, target, log, run, 9, buckets=16) == "skipped"
        assert sorted(r.n for r in tables.load(spark, target).collect()) == list(range(upto))
    assert pipelines.run_staging(spark, whole, "x", rules, target, log, "run3", 9, buckets=16) == "incremental"
    assert sorted(r.n for r in tables.load(spark, target).collect()) == list(range(6))


def test_ledger_of_a_failing_runner(spark, tmp_path):
    ledger = Ledger(str(tmp_path / "ledger"), 9, "shop", "stage")
    rules = S.Rules(columns={"key": "string"})
    args = ("x", rules, str(tmp_path / "t"), str(tmp_path / "log"))
    broken = _times(spark, 1, 2).withColumn("n", F.raise_error(F.lit("no such luck")).cast("long"))
    with pytest.raises(Exception, match="no such luck"):
        pipelines.run_staging(spark, broken, *args, "run1", 9, ledger=ledger)
    pipelines.run_staging(spark, _times(spark, 1, 2), *args, "run1", 9, ledger=ledger)
    rows = {(r.status, r.records_processed) for r in ledger.load(spark).collect()}
    assert rows == {("STARTED", 0), ("ERROR", 0), ("SUCCESS", 2)}


def test_ingest_completes_a_commit_that_was_not_logged(spark, tmp_path, monkeypatch):
    job = ingest.Job("x", {m: {"table_field": "at"} for m in ("hist", "inc")})
    rows = spark.createDataFrame([(i, f"2020-{1 + i // 4:02d}-{1 + i % 4 * 9:02d} 23:59:59.7") for i in range(24)], "n long, at string")
    target, ledger = str(tmp_path / "t"), Ledger(str(tmp_path / "ledger"), 1_700_000_000, "shop", "w")
    real = ingest._log_marks
    calls = iter([True, False])
    monkeypatch.setattr(ingest, "_log_marks", lambda *a: real(*a) if next(calls) else (_ for _ in ()).throw(RuntimeError("killed")))
    bounds = ("2020-01-01 00:00:00", "2020-05-31 00:00:00")
    with pytest.raises(RuntimeError, match="killed"):
        ingest.run_ingest(spark, rows, job, target, ledger, "a", "hist", bounds, months_at_once=2)
    monkeypatch.setattr(ingest, "_log_marks", real)
    assert ingest.run_ingest(spark, rows, job, target, ledger, "b", "hist", bounds, months_at_once=2) == 12
    assert ingest.run_ingest(spark, rows, job, target, ledger, "c") == 4
    assert ingest.run_ingest(spark, rows, job, target, ledger, "c") == 0
    assert sorted(r.n for r in tables.load(spark, target).collect()) == list(range(24))
    done = ledger.load(spark).filter("status = 'SUCCESS'").collect()
    assert len(done) == 6 and sum(r.records_processed for r in done) == 24


def test_replaced_keys_leave_other_buckets_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    tables.replace_keys(rows, rows.limit(0), root, ["k"], "run1", 16)
    before = tables.folders(spark, root)
    gone = rows.filter("v in (3, 5)")
    added = spark.createDataFrame([("3", -3), ("new", -1), (None, -2), ("7", -7)], "k string, v long")
    for _ in range(2):
        tables.replace_keys(added, gone, root, ["k"], "run2")
    after = tables.folders(spark, root)
    rewritten = [n for n in before if not set(before[n]) <= set(after[n])]
    assert 1 <= len(rewritten) <= 2
    want = {(str(i), i) for i in range(400) if i not in (3, 5)} | {("3", -3), ("new", -1), (None, -2), ("7", -7)}
    assert set(map(tuple, tables.load(spark, root).collect())) == want
    assert set(map(tuple, tables.load_keys(spark, root, added.filter("k = '7'")).collect())) == {("7", 7), ("7", -7)}


def test_prep_writes_only_the_part_of_its_source(spark, root):
    source = lambda name, *mails: pipelines.PrepSource(name, spark.createDataFrame([(m,) for m in mails], "mail string"), {"mail": "email"})
    pipelines.run_prep(spark, [source("a", "1@x", "2@x"), source("b", "3@x")], root, 100)
    before = tables.folders(spark, f"{root}/unif_input")
    got = pipelines.run_prep(spark, [source("a", "2@x", "4@x")], root, 200)
    after = tables.folders(spark, f"{root}/unif_input")
    assert sorted((r.source, r.email, r.time) for r in got.collect()) == [("a", "2@x", 100), ("a", "4@x", 200), ("b", "3@x", 100)]
    assert before["part:b"] == after["part:b"] and before["part:a"] != after["part:a"]
    # Compaction keeps the parts, so the next run still replaces one of them.
    tables.compact(spark, f"{root}/unif_input")
    got = pipelines.run_prep(spark, [source("b")], root, 300)
    assert sorted((r.source, r.email) for r in got.collect()) == [("a", "2@x"), ("a", "4@x")]


@pytest.mark.parametrize("compacted", [False, True])
def test_stored_stream_repeats_a_batch_that_died_before_its_checkpoint(spark, root, monkeypatch, compacted):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("time", T.LongType())])
    spark.createDataFrame([("a", 100), ("b", 101)], schema).write.parquet(f"{root}/in")
    go = lambda: jobs.stream_dedupe(spark, f"{root}/in", schema, ["id"], "1 hour", f"{root}/out", f"{root}/cp", stored=True).awaitTermination()
    real = tables.append

    def dies(*args):
        real(*args)
        raise RuntimeError("killed behind the data")

    with monkeypatch.context() as m:
        m.setattr(tables, "append", dies)
        with pytest.raises(Exception, match="killed behind the data"):
            go()
    if compacted:
        tables.compact(spark, f"{root}/out")
    spark.createDataFrame([("a", 160), ("c", 161)], schema).write.mode("append").parquet(f"{root}/in")
    go()
    assert rows(tables.load(spark, f"{root}/out")) == [("a", 100), ("b", 101), ("c", 161)]
