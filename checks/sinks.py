"""Stored tables, pipelines and streams: each query writes, reads back and is checked."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import identity as I
from checks.fixtures import AS_OF, sql, view, views
from kindred.operators import reports as R
from kindred.operators import staging as S
from kindred.plans import ingest, pipelines
from kindred.plans.ledger import Ledger
from kindred.plans.unify import unify
from kindred.sources import files, tables
from kindred.sources.scratch import checkpoint_root
from kindred.streaming import jobs


def _root(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def q_read(spark, sf):
    return tables.read_table(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_totalprice", "o_orderstatus")


def q_append(spark, sf):
    """Two runs, the second one repeated after a failure: no row twice."""
    root, (inc, hist) = _root(spark, "append"), views(spark, sf, "orders_inc", "orders_hist")
    inc = inc.drop("incremental_date")
    tables.append(hist, root, "run1")
    tables.append(inc, root, "run2")
    tables.append(inc, root, "run2")
    return tables.load(spark, root)


def q_replace(spark, sf):
    root, (inc, hist) = _root(spark, "replace"), views(spark, sf, "orders_inc", "orders_hist")
    tables.create_if_absent(spark, root, hist.schema)
    tables.replace(hist, root)
    tables.swap_commit(inc, root)
    tables.compact(spark, root)
    return tables.load(spark, root)


def q_table_stats(spark, sf):
    root, hist = _root(spark, "stats"), view(spark, sf, "orders_hist")
    tables.append(hist, root, "run1")
    df = tables.table_stats(spark, {"orders_hist": root, "orders_inc": _root(spark, "none")})
    return df.withColumn("exists", F.col("exists").cast("int"))


def q_upsert_table(spark, sf):
    """Stored upsert, run twice with one run id, against the in-memory form."""
    root, orders = _root(spark, "upsert"), view(spark, sf, "orders_all")
    changed = orders.filter(F.col("status") == "P").withColumn("amount", F.col("amount") + 1)
    keyless = orders.filter(F.col("status") == "F").withColumns({"order_id": F.lit(None).cast("string"), "customer_id": F.lit("")})
    tables.replace(orders, root)
    tables.upsert_table(orders.filter(F.col("status") == "O").withColumn("amount", -F.col("amount")), root, ["order_id"], "run1", 16)
    for _ in range(2):
        tables.upsert_table(changed.unionByName(keyless), root, ["order_id"], "run2", 16)
    return tables.load(spark, root)


def q_upsert_buckets(spark, sf):
    """The number of buckets changes between two upserts."""
    root, orders = _root(spark, "buckets"), view(spark, sf, "orders_all")
    tables.upsert_table(orders, root, ["order_id"], "run1", 256)
    tables.upsert_table(orders.filter(F.col("status") == "P").withColumn("amount", F.col("amount") + 1), root, ["order_id"], "run2", 16)
    return tables.load(spark, root)


def q_replay_compacted(spark, sf):
    """A run repeated after compaction adds nothing."""
    root, (inc, hist) = _root(spark, "replay"), views(spark, sf, "orders_inc", "orders_hist")
    inc = inc.drop("incremental_date")
    for df, run in ((hist, "run1"), (inc, "run2")):
        tables.append(df, root, run)
    tables.compact(spark, root)
    tables.append(inc, root, "run2")
    return tables.load(spark, root)


def q_schema_change(spark, sf):
    """A column that only the second delivery has."""
    root, (inc, hist) = _root(spark, "change"), views(spark, sf, "orders_inc", "orders_hist")
    plain = inc.drop("incremental_date")
    cut = inc.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY time)")).first()[0]
    for run, side in (("run1", plain.filter(F.col("time") <= cut)), ("run2", plain.withColumn("channel", F.lit("web")))):
        pipelines.run_hist_union(spark, side, hist, "orders_hist", f"{root}/target", f"{root}/inc_log", run)
    return tables.load(spark, f"{root}/target")


def q_delimited(spark, sf):
    """Orders written as delimited text with quotes and bad lines, read back."""
    path, orders = _root(spark, "csv"), view(spark, sf, "orders_all")
    text = F.concat_ws("|", "order_id", F.concat(F.lit('"'), F.col("status"), F.lit('|""x"""')), "amount", "updated_at")
    line = F.when(F.col("status") == "P", F.concat(text, F.lit("|extra|field"))).otherwise(text)
    orders.select(line.alias("value")).write.text(path)
    columns = [
        {"name": "order_id", "type": "long"},
        {"name": "status", "type": "string"},
        {"name": "amount", "type": "double"},
        {"name": "updated_at", "type": "timestamp", "format": "%Y-%m-%d %H:%M:%S"},
    ]
    df = files.read_delimited(spark, f"{path}/*.txt", columns, delimiter="|", skip_header_lines=0)
    return df.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


def q_delimited_multiline(spark, sf):
    """Orders with line ends inside quoted fields, LF and CRLF, and whole lines around them."""
    path, orders = _root(spark, "csv-lines"), view(spark, sf, "orders_all")
    end = F.when(F.col("status") == "P", F.lit("\r\n")).otherwise(F.lit("\n"))
    note = F.concat(F.lit('"'), F.col("status"), end, F.lit('said ""so"", twice"'))
    orders.select(F.concat_ws(",", "order_id", note, "amount").alias("value")).write.text(path)
    columns = [{"name": "order_id", "type": "long"}, {"name": "note", "type": "string"}, {"name": "amount", "type": "double"}]
    df = files.read_delimited(spark, f"{path}/*.txt", columns, skip_header_lines=0, multi_line=True)
    return df.withColumn("note", F.regexp_replace("note", "\r?\n", "/"))


def q_run_hist_union(spark, sf):
    """Two runs with a later delivery between them equal one load of everything."""
    root, (inc, hist) = _root(spark, "hu"), views(spark, sf, "orders_inc", "orders_hist")
    cut = inc.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY time)")).first()[0]
    early = inc.filter(F.col("time") <= cut)
    for run, side in (("run1", early), ("run1", early), ("run2", inc)):
        pipelines.run_hist_union(spark, side, hist, "orders_hist", f"{root}/target", f"{root}/inc_log", run)
    return tables.load(spark, f"{root}/target")


def q_run_staging(spark, sf):
    """First load, then an increment that changes rows; per order the newest row stays."""
    root, dups = _root(spark, "stg"), view(spark, sf, "dup_orders")
    rules = S.Rules(columns={"order_email": "email"}, keys=["order_id"], order=[("time", True)])
    cut = dups.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY time)")).first()[0]
    for run, rows in (("run1", dups.filter(F.col("time") <= cut)), ("run2", dups), ("run3", dups)):
        pipelines.run_staging(spark, rows, "orders", rules, f"{root}/target", f"{root}/inc_log", run, AS_OF, buckets=16)
    return tables.load(spark, f"{root}/target").select("order_id", "customer_id", "order_email_std", "o_totalprice", "time")


def q_run_staging_recovery(spark, sf):
    """A run dies behind its data, more rows arrive, it is repeated, and another one follows: as one clean load."""
    root, dups = _root(spark, "stg-recovery"), view(spark, sf, "dup_orders")
    rules = S.Rules(columns={"order_email": "email"}, keys=["order_id"], order=[("time", True)])
    _killed_and_repeated(spark, dups, rules, root)
    return tables.load(spark, f"{root}/target").select("order_id", "customer_id", "order_email_std", "o_totalprice", "time")


def q_run_append_recovery(spark, sf):
    """The same without keys, where a second load of a row would show."""
    root, dups = _root(spark, "stg-append"), view(spark, sf, "dup_orders")
    _killed_and_repeated(spark, dups, S.Rules(columns={"order_email": "email"}), root)
    return tables.load(spark, f"{root}/target").select("order_id", "customer_id", "order_email_std", "o_totalprice", "time")


def q_run_staging_json(spark, sf):
    """Staging from a rules row that asks for all JSON keys; later rows bring a key that differs in case alone, and NULL keys."""
    root, raw = _root(spark, "stg-json"), view(spark, sf, "raw_json")
    cut = raw.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY time)")).first()[0]
    late = F.when(F.col("time") > cut, F.lit('"City":"B",')).otherwise(F.lit(""))
    rows = raw.withColumns(
        {
            "attributes": F.regexp_replace("attributes", F.lit('"empty":""'), F.concat(late, F.lit('"city":"a"'))),
            "event_id": F.when(F.col("event_id") % 10 != 3, F.col("event_id")),
        }
    )
    table = spark.createDataFrame(
        [("shop", "events", "event_id", "time desc", '{"json": "all"}')],
        "db_name string, table_name string, partition_columns string, order_by_columns string, additional_rules string",
    )
    rules = S.rules_from(S.load_rules(table, "shop", "events"))
    for run, arrived in (("run1", rows.filter(F.col("time") <= cut)), ("run2", rows), ("run2", rows)):
        pipelines.run_staging(
            spark, arrived, "events", rules, f"{root}/target", f"{root}/inc_log", run, AS_OF, buckets=16, registry=f"{root}/json_keys"
        )
    staged = tables.load(spark, f"{root}/target")
    return staged.select(
        "event_id", "time", "attributes_city", "attributes_city_2", "attributes_k", "attributes_user_id", F.concat_ws(",", "attributes_tags").alias("tags")
    )


def _killed_and_repeated(spark, rows, rules, root):
    """A watermark that goes to a log of its own is one that was never written."""
    first, second = (rows.filter(F.col("time") <= cut) for cut in rows.agg(*[F.expr(c) for c in _CUTS]).first())
    steps = [("lost0", "run0", first), ("log", "run0", second), ("lost1", "run1", second), ("log", "run1", rows), ("log", "run2", rows)]
    for log, run, arrived in steps:
        pipelines.run_staging(spark, arrived, "orders", rules, f"{root}/target", f"{root}/{log}", run, AS_OF, buckets=16)


_CUTS = [f"min(time) + (max(time) - min(time)) div 10 * {n}" for n in (3, 6)]


def q_run_union_recovery(spark, sf):
    """A union dies behind its data, is compacted, repeated with more rows, and followed by another run."""
    root, (inc, hist) = _root(spark, "hu-recovery"), views(spark, sf, "orders_inc", "orders_hist")
    cut = inc.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY time)")).first()[0]
    target = f"{root}/target"
    pipelines.run_hist_union(spark, inc.filter(F.col("time") <= cut), hist, "orders_hist", target, f"{root}/lost", "run1")
    tables.compact(spark, target)
    for run in ("run1", "run2", "run2"):
        pipelines.run_hist_union(spark, inc, hist, "orders_hist", target, f"{root}/log", run)
    return tables.load(spark, target)


def q_hu_cast_run(spark, sf):
    """Both sides in one type, over two runs; what does not convert is NULL."""
    root, (inc, hist) = _root(spark, "hu-cast"), views(spark, sf, "orders_inc", "orders_hist")
    texts = hist.withColumn("amount", F.when(F.col("status") == "F", F.col("amount").cast("string")).otherwise("unknown"))
    for run in ("run1", "run2"):
        pipelines.run_hist_union(spark, inc, texts, "orders", f"{root}/target", f"{root}/log", run, types={"amount": "double", "order_id": "bigint"})
    return tables.load(spark, f"{root}/target").drop("updated_at")


def _snapshots(spark, sf):
    """The first snapshot, and one with changed, vanished and new rows; both repeated."""
    root, orders = _root(spark, "hu-snapshot"), view(spark, sf, "orders_all")
    one = orders.filter(F.col("status") != "P")
    two = orders.filter(F.col("status") != "F").withColumns(
        {"amount": F.when(F.col("order_id").endswith("0"), F.col("amount") + 1).otherwise(F.col("amount")), "time": F.col("time") + 7}
    )
    for run, snapshot in (("run1", one), ("run1", one), ("run2", two), ("run2", two)):
        pipelines.run_hist_union(
            spark, snapshot, None, "orders", f"{root}/target", f"{root}/log", run, mode="snapshot", keys=["order_id"], changes=f"{root}/changes"
        )
    return root


def q_hu_snapshot_run(spark, sf):
    return tables.load(spark, f"{_snapshots(spark, sf)}/target")


def q_hu_snapshot_changes(spark, sf):
    return tables.load(spark, f"{_snapshots(spark, sf)}/changes").select("order_id", "status", "amount", "time", "change")


JOB = ingest.Job("orders", {m: {"table_field": "updated_at", "source_field": "changed_at"} for m in ("hist", "inc")})
HISTORY = ("1990-01-01 00:00:00", "1997-12-31 00:00:00")


def _ingested(spark, sf):
    """History that fails in a month of its second commit, its repeat, and the rolling load of what came after, twice."""
    root, orders = _root(spark, "ingest"), view(spark, sf, "orders_all").withColumnRenamed("updated_at", "changed_at")
    broken = orders.withColumn(
        "amount", F.when(F.substring("changed_at", 1, 7) == "1996-05", F.raise_error(F.lit("the source went away"))).otherwise(F.col("amount"))
    )
    target, log = f"{root}/target", Ledger(f"{root}/ledger", AS_OF, "shop", "shop_ingest")
    try:
        ingest.run_ingest(spark, broken, JOB, target, log, "day1", "hist", HISTORY, months_at_once=48)
    except Exception as fault:
        if "the source went away" not in str(fault):
            raise
    ingest.run_ingest(spark, orders, JOB, target, log, "day2", "hist", HISTORY, months_at_once=48)
    for run in ("day3", "day3"):
        ingest.run_ingest(spark, orders, JOB, target, log, run)
    return target, log


def q_run_ingest(spark, sf):
    target, _ = _ingested(spark, sf)
    return tables.load(spark, target)


def q_run_ingest_ledger(spark, sf):
    _, log = _ingested(spark, sf)
    rows = log.load(spark).filter(F.col("status").isin("SUCCESS", "ERROR"))
    return rows.groupBy("source_name", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("records_processed").alias("records"))


def q_run_prep(spark, sf):
    """Prep pipeline over two days; rows that left the source disappear everywhere."""
    root = _root(spark, "prep")
    crm, day2, orders = views(spark, sf, "crm_profiles", "src_day2", "shop_orders")
    columns = {"customer_id": "customer_id", "email": "email", "phone": "phone"}
    shop = pipelines.PrepSource("shop", orders, {"customer_id": "customer_id", "order_email": "email"})
    pipelines.run_prep(spark, [pipelines.PrepSource("crm", crm, columns), shop], root, AS_OF)
    return pipelines.run_prep(spark, [pipelines.PrepSource("crm", day2, columns), shop], root, AS_OF + 86400)


def q_run_unify(spark, sf):
    done = unify(I.sources(spark, sf), I.CFG, AS_OF)
    master = done.masters["customer_master"]
    return master.withColumn("top_emails", F.concat_ws("|", "top_emails"))


def q_run_unification(spark, sf):
    """The stored pipeline: every expected table is there, with its rows."""
    root = _root(spark, "unify")
    pipelines.run_unification(spark, I.sources(spark, sf), I.CFG, root, AS_OF)
    expected = pipelines.expected_outputs(spark, I.CFG)
    names = [r.table_name for r in expected.collect()]
    return R.check_outputs(tables.table_stats(spark, {n: f"{root}/{n}" for n in names}), expected)


_STORED: dict[tuple[str, str], str] = {}


def _increments(spark, sf):
    """Two thirds of every source in full, then two increments, the second one repeated; stored once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _STORED:
        return pipelines.run_unification(spark, I.sources(spark, sf), I.CFG, _STORED[key], AS_OF + 9, full=False, run_id="day2")[I.CID.name]
    root, sources = _root(spark, "unify-delta"), I.sources(spark, sf)
    cuts = {n: df.agg(*[F.expr(c) for c in _CUTS]).first() for n, df in sources.items()}
    for i, run in enumerate(("full", "day1", "day2", "day2")):
        arrived = {n: df if i > 1 else df.filter(F.col("time") <= cuts[n][i]) for n, df in sources.items()}
        done = pipelines.run_unification(spark, arrived, I.CFG, root, AS_OF + i, full=run == "full", run_id=run, buckets=16)
    _STORED[key] = root
    return done[I.CID.name]


def _members(lookup):
    """Per canonical id its number of identifiers and the first of them, which do not depend on the id."""
    first = F.min(F.struct("id_key_type", "id")).alias("f")
    return lookup.groupBy("canonical_id").agg(F.count(F.lit(1)).alias("members"), first).select(
        "canonical_id", "members", F.col("f.id").alias("first_id"), F.col("f.id_key_type").alias("first_type")
    )


def q_unification_delta(spark, sf):
    """Profiles after increments are those of one full run."""
    lookup = _increments(spark, sf).lookup
    return lookup.join(_members(lookup), "canonical_id").select("id", "id_key_type", "members", "first_id", "first_type", "id_first_seen_at", "id_last_seen_at")


def q_unification_delta_master(spark, sf):
    """Master profiles after increments, named by their first identifier."""
    done = _increments(spark, sf)
    named = _members(done.lookup).select(F.col("canonical_id").alias(I.CID.name), "first_id", "first_type")
    master = done.masters["customer_master"].join(named, I.CID.name).drop(I.CID.name)
    return master.withColumn("top_emails", F.concat_ws("|", "top_emails"))


def q_unification_levels(spark, sf):
    """Two stored ids, the second one merging by the first."""
    done = pipelines.run_unification(spark, I.sources(spark, sf), I.LEVELS, _root(spark, "unify-levels"), AS_OF, buckets=16)
    return done["household_id"].enriched["crm_profiles"].select("customer_id", "person_id", "household_id")


def q_bucketed(spark, sf):
    """Enriched orders in a catalog table bucketed by canonical id, joined without a shuffle of it."""
    name = f"bucketed_{uuid.uuid4().hex}"
    path = _root(spark, "bucketed")
    enriched = I.enriched_one(spark, sf, "shop_orders")
    tables.write_bucketed(enriched, name, [I.CID.name], buckets=16, path=path)
    per_id = spark.table(name).groupBy(I.CID.name).agg(F.count(F.lit(1)).alias("orders"))
    return per_id


def _arrivals(spark, root, frames):
    path = f"{root}/arrivals"
    for df in frames:
        df.write.mode("append").parquet(path)
    return path


def q_stream_union(spark, sf):
    """History and increments arrive as files in two steps; the target holds each row once."""
    root, (inc, hist) = _root(spark, "str"), views(spark, sf, "orders_inc", "orders_hist")
    for step in (F.col("status") == "F", F.col("status") != "F"):
        hist.filter(step).write.mode("append").parquet(f"{root}/hist")
        inc.filter(step).write.mode("append").parquet(f"{root}/inc")
        jobs.stream_hist_union(
            spark, f"{root}/inc", inc.schema, f"{root}/hist", hist.schema, f"{root}/target", f"{root}/cp"
        ).awaitTermination()
    return spark.read.schema(inc.schema).parquet(f"{root}/target")


def q_stream_union_stored(spark, sf):
    """The same into a stored table, which is compacted between the steps."""
    root, (inc, hist) = _root(spark, "str-stored"), views(spark, sf, "orders_inc", "orders_hist")
    for step in (F.col("status") == "F", F.col("status") != "F"):
        hist.filter(step).write.mode("append").parquet(f"{root}/hist")
        inc.filter(step).write.mode("append").parquet(f"{root}/inc")
        jobs.stream_hist_union(
            spark, f"{root}/inc", inc.schema, f"{root}/hist", hist.schema, f"{root}/target", f"{root}/cp", stored=True
        ).awaitTermination()
        tables.compact(spark, f"{root}/target")
    return tables.load(spark, f"{root}/target")


def q_stream_upsert(spark, sf):
    """Every file is a batch; later batches replace rows of earlier ones."""
    root, orders = _root(spark, "str"), view(spark, sf, "orders_all")
    changed = orders.filter(F.col("status") == "P").withColumns({"amount": F.col("amount") + 1, "time": F.col("time") + 1})
    rules = S.Rules(columns={"status": "string"}, keys=["order_id"], order=[("time", True)])
    path = f"{root}/arrivals"
    for part in (orders, changed):
        part.write.mode("append").parquet(path)
        jobs.stream_stage_upsert(
            spark, path, orders.schema, rules, "orders", AS_OF, f"{root}/target", f"{root}/cp", buckets=16
        ).awaitTermination()
    return tables.load(spark, f"{root}/target")


def q_stream_dedupe(spark, sf):
    root, dups = _root(spark, "str"), view(spark, sf, "dup_orders")
    path = _arrivals(spark, root, [dups])
    jobs.stream_dedupe(spark, path, dups.schema, ["order_id"], "3650 days", f"{root}/target", f"{root}/cp").awaitTermination()
    return spark.read.schema(dups.schema).parquet(f"{root}/target").select("order_id", "customer_id")


def q_stream_dedupe_stored(spark, sf):
    """Rows once per order in a stored table; a batch job reads the sums from it."""
    root, dups = _root(spark, "str-stored"), view(spark, sf, "dup_orders")
    path = _arrivals(spark, root, [dups, dups])
    jobs.stream_dedupe(spark, path, dups.schema, ["order_id"], "3650 days", f"{root}/target", f"{root}/cp", stored=True).awaitTermination()
    stored = tables.load(spark, f"{root}/target")
    return stored.groupBy("customer_id").agg(F.count("order_id").alias("orders"), F.count(F.when(F.col("order_id").isNull(), 1)).alias("without"))


QUERIES = {
    "src_read": q_read,
    "src_delimited": q_delimited,
    "snk_append": q_append,
    "snk_replace": q_replace,
    "snk_table_stats": q_table_stats,
    "snk_upsert": q_upsert_table,
    "src_delimited_multiline": q_delimited_multiline,
    "snk_upsert_buckets": q_upsert_buckets,
    "snk_replay_compacted": q_replay_compacted,
    "hu_schema_change": q_schema_change,
    "snk_bucketed": q_bucketed,
    "run_hist_union": q_run_hist_union,
    "run_staging": q_run_staging,
    "run_staging_json": q_run_staging_json,
    "run_staging_recovery": q_run_staging_recovery,
    "run_append_recovery": q_run_append_recovery,
    "run_union_recovery": q_run_union_recovery,
    "hu_cast_run": q_hu_cast_run,
    "hu_snapshot_run": q_hu_snapshot_run,
    "hu_snapshot_changes": q_hu_snapshot_changes,
    "run_ingest": q_run_ingest,
    "run_ingest_ledger": q_run_ingest_ledger,
    "run_prep": q_run_prep,
    "run_unify": q_run_unify,
    "run_unification": q_run_unification,
    "run_unification_delta": q_unification_delta,
    "run_unification_delta_master": q_unification_delta_master,
    "run_unification_levels": q_unification_levels,
    "str_hist_union": q_stream_union,
    "str_stage_upsert": q_stream_upsert,
    "str_dedupe": q_stream_dedupe,
    "str_hist_union_stored": q_stream_union_stored,
    "str_dedupe_stored": q_stream_dedupe_stored,
}

_NO_DATE = "order_id, customer_id, status, amount, updated_at, time"
_UNION = f"SELECT NULL AS incremental_date, {_NO_DATE} FROM orders_hist UNION ALL SELECT * FROM orders_inc"
_OK = r"'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'"

_RAISED = "CASE WHEN order_id LIKE '%0' THEN amount + 1 ELSE amount END"
_DUCK_CUTS = [f"min(time) + (max(time) - min(time)) // 10 * {n}" for n in (3, 6)]


_MEMBERS = """SELECT canonical_id, count(*) AS members, min({'t': id_key_type, 'i': id}).i AS first_id, min({'t': id_key_type, 'i': id}).t AS first_type
  FROM lookup GROUP BY canonical_id"""


def _staged(batch: str) -> str:
    """Per order its newest row; of the rows without an order the newest of every batch."""
    return f"""SELECT order_id, customer_id, CASE WHEN regexp_matches(order_email, {_OK}) THEN order_email END AS order_email_std, o_totalprice, time FROM shop_orders
        UNION ALL SELECT NULL, customer_id, NULL, o_totalprice, time FROM (
          SELECT *, row_number() OVER (PARTITION BY batch ORDER BY time DESC, customer_id DESC, o_totalprice DESC) AS rn
          FROM (SELECT *, {batch} AS batch FROM dup_orders WHERE order_id IS NULL)) WHERE rn = 1"""


ORACLES = {
    "src_read": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
    "src_delimited": sql(
        """SELECT CAST(order_id AS BIGINT) AS order_id, status || '|"x"' AS status, amount, updated_at FROM orders_all WHERE status <> 'P'""",
        "orders_all",
    ),
    "snk_append": sql(f"SELECT {_NO_DATE} FROM orders_all", "orders_all"),
    "snk_replace": sql("SELECT * FROM orders_inc", "orders_inc"),
    "snk_table_stats": sql(
        """SELECT 'orders_hist' AS table_name, 1 AS exists, (SELECT count(*) FROM orders_hist) AS row_count,
             'order_id, customer_id, status, amount, updated_at, time' AS columns, 'parquet' AS format
           UNION ALL SELECT 'orders_inc', 0, NULL, NULL, NULL""",
        "orders_hist",
    ),
    "snk_upsert": sql(
        """SELECT * REPLACE (CASE status WHEN 'O' THEN -amount WHEN 'P' THEN amount + 1 ELSE amount END AS amount) FROM orders_all
           UNION ALL SELECT NULL, '', status, amount, updated_at, order_day, time FROM orders_all WHERE status = 'F'""",
        "orders_all",
    ),
    "src_delimited_multiline": sql("SELECT CAST(order_id AS BIGINT) AS order_id, status || '/said \"so\", twice' AS note, amount FROM orders_all", "orders_all"),
    "snk_upsert_buckets": sql("SELECT * REPLACE (CASE status WHEN 'P' THEN amount + 1 ELSE amount END AS amount) FROM orders_all", "orders_all"),
    "snk_replay_compacted": sql(f"SELECT {_NO_DATE} FROM orders_all", "orders_all"),
    "hu_schema_change": sql(
        f"""SELECT {_NO_DATE}, CASE WHEN time > (SELECT quantile_disc(time, 0.5) FROM orders_inc) THEN 'web' END AS channel FROM orders_inc
            UNION ALL SELECT {_NO_DATE}, NULL FROM orders_hist""",
        "orders_hist",
        "orders_inc",
    ),
    "snk_bucketed": I.ident("SELECT unified_id, count(*) AS orders FROM en_shop_orders GROUP BY unified_id", I.ENRICHED),
    "run_hist_union": sql(_UNION, "orders_hist", "orders_inc"),
    "run_staging": sql(_staged("CASE WHEN time <= (SELECT quantile_disc(time, 0.5) FROM dup_orders) THEN 0 ELSE 1 END"), "shop_orders", "dup_orders"),
    "run_staging_recovery": sql(
        _staged(f"CASE WHEN time <= (SELECT {_DUCK_CUTS[0]} FROM dup_orders) THEN 0 WHEN time <= (SELECT {_DUCK_CUTS[1]} FROM dup_orders) THEN 1 ELSE 2 END"),
        "shop_orders",
        "dup_orders",
    ),
    "run_staging_json": sql(
        """SELECT event_id, time, upper(json_extract_string(j, '$.city')) AS attributes_city, upper(json_extract_string(j, '$.City')) AS attributes_city_2,
             nullif(upper(json_extract_string(j, '$.k')), '') AS attributes_k, upper(json_extract_string(j, '$.user.id')) AS attributes_user_id,
             coalesce(array_to_string(CAST(json_extract(j, '$.tags') AS VARCHAR[]), ','), '') AS tags
           FROM (SELECT *, CASE WHEN json_valid(attributes) THEN attributes END AS j FROM best)""",
        "raw_json",
        ctes="""cut AS (SELECT quantile_disc(time, 0.5) AS c FROM raw_json),
          made AS (SELECT CASE WHEN event_id % 10 <> 3 THEN event_id END AS event_id, time > c AS late, time,
            replace(attributes, '"empty":""', CASE WHEN time > c THEN '"City":"B",' ELSE '' END || '"city":"a"') AS attributes FROM raw_json, cut),
          best AS (SELECT event_id, time, attributes FROM made WHERE event_id IS NOT NULL
            UNION ALL SELECT event_id, time, attributes FROM (
              SELECT *, row_number() OVER (PARTITION BY late ORDER BY time DESC, attributes DESC NULLS LAST) AS rn FROM made WHERE event_id IS NULL) WHERE rn = 1)""",
    ),
    "run_append_recovery": sql(
        f"SELECT order_id, customer_id, CASE WHEN regexp_matches(order_email, {_OK}) THEN order_email END AS order_email_std, o_totalprice, time FROM dup_orders",
        "dup_orders",
    ),
    "run_union_recovery": sql(_UNION, "orders_hist", "orders_inc"),
    "hu_cast_run": sql(
        """SELECT NULL AS incremental_date, CAST(order_id AS BIGINT) AS order_id, customer_id, status, CASE WHEN status = 'F' THEN amount END AS amount, time FROM orders_hist
           UNION ALL SELECT incremental_date, CAST(order_id AS BIGINT), customer_id, status, amount, time FROM orders_inc""",
        "orders_hist",
        "orders_inc",
    ),
    "hu_snapshot_run": sql(f"SELECT * REPLACE ({_RAISED} AS amount, time + 7 AS time) FROM orders_all WHERE status <> 'F'", "orders_all"),
    "hu_snapshot_changes": sql(
        f"""SELECT order_id, status, amount, time, 'new' AS change FROM orders_all WHERE status <> 'P'
            UNION ALL SELECT order_id, status, {_RAISED}, time + 7, CASE WHEN status = 'P' THEN 'new' ELSE 'changed' END FROM orders_all
            WHERE status = 'P' OR (status <> 'F' AND order_id LIKE '%0')
            UNION ALL SELECT order_id, status, amount, (SELECT max(time) + 7 FROM orders_all WHERE status <> 'F'), 'vanished' FROM orders_all WHERE status = 'F'""",
        "orders_all",
    ),
    "run_ingest": sql(f"SELECT order_id, customer_id, status, amount, order_day, updated_at, CAST({AS_OF} AS BIGINT) AS time FROM orders_all", "orders_all"),
    "run_ingest_ledger": sql(
        """SELECT 'shop_' || strftime(m, '%Y-%m') AS source_name, 'SUCCESS' AS status, CAST(1 AS BIGINT) AS n, count(order_id) AS records
           FROM range(TIMESTAMP '1990-01-01', TIMESTAMP '1998-01-01', INTERVAL 1 MONTH) t(m) LEFT JOIN orders_all ON substr(updated_at, 1, 7) = strftime(m, '%Y-%m') GROUP BY m
           UNION ALL SELECT 'shop', 'SUCCESS', 1, count(*) FROM orders_all WHERE updated_at >= '1998-01-01'
           UNION ALL SELECT 'shop_1994-01', 'ERROR', 1, 0
           UNION ALL SELECT 'ingestion_runner', 'ERROR', 1, 0""",
        "orders_all",
    ),
    "run_prep": sql(
        f"""SELECT customer_id, email, phone, CAST(CASE WHEN (customer_id, coalesce(email, '~'), coalesce(phone, '~')) IN (SELECT (customer_id, coalesce(email, '~'), coalesce(phone, '~')) FROM crm_profiles)
                THEN {AS_OF} ELSE {AS_OF + 86400} END AS BIGINT) AS time, 'crm' AS source,
              CAST(CASE WHEN (customer_id, coalesce(email, '~'), coalesce(phone, '~')) IN (SELECT (customer_id, coalesce(email, '~'), coalesce(phone, '~')) FROM crm_profiles)
                THEN {AS_OF} ELSE {AS_OF + 86400} END AS BIGINT) AS ingest_time
            FROM (SELECT DISTINCT customer_id, email, phone FROM src_day2) WHERE coalesce(email, phone) IS NOT NULL
            UNION ALL SELECT customer_id, order_email, NULL, CAST({AS_OF} AS BIGINT), 'shop', CAST({AS_OF} AS BIGINT)
            FROM (SELECT DISTINCT customer_id, order_email FROM shop_orders) WHERE order_email IS NOT NULL""",
        "crm_profiles",
        "src_day2",
        "shop_orders",
    ),
    "run_unify": I.ident("SELECT * EXCLUDE (n_top_emails) FROM master", I.MASTER),
    "run_unification": I.ident(
        "SELECT 'unification' AS phase, table_name, CAST(row_count AS BIGINT) AS row_count, 'ok' AS result FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, ({count}) AS row_count"
            for name, count in {
                "unified_id_lookup": "SELECT count(*) FROM lookup",
                "unified_id_graph": "SELECT count(*) FROM final",
                "unified_id_keys": "SELECT 4",
                "unified_id_tables": "SELECT 3",
                "unified_id_source_key_stats": "SELECT 4",
                "unified_id_result_key_stats": "SELECT 4",
                "enriched_crm_profiles": "SELECT count(*) FROM customer",
                "enriched_shop_orders": "SELECT count(*) FROM orders",
                "enriched_web_events": "SELECT count(*) FROM events",
                "customer_master": "SELECT count(*) FROM master",
                "unification_metadata": "SELECT 1",
                "filter_lookup": "SELECT 4",
                "column_lookup": "SELECT 8",
            }.items()
        )
        + ")",
        I.MASTER,
    ),
    "run_unification_delta": I.ident(
        f"""SELECT l.id, l.id_key_type, m.members, m.first_id, m.first_type, l.id_first_seen_at, l.id_last_seen_at FROM lookup l JOIN ({_MEMBERS}) m USING (canonical_id)""",
        I.MASTER,
    ),
    "run_unification_delta_master": I.ident(
        f"SELECT a.* EXCLUDE (n_top_emails, unified_id), m.first_id, m.first_type FROM master a JOIN ({_MEMBERS}) m ON a.unified_id = m.canonical_id", I.MASTER
    ),
    "run_unification_levels": I.ORACLES["idu_levels"],
    "str_hist_union": sql(_UNION, "orders_hist", "orders_inc"),
    "str_hist_union_stored": sql(_UNION, "orders_hist", "orders_inc"),
    "str_dedupe_stored": sql(
        """SELECT customer_id, count(order_id) AS orders, count(*) - count(order_id) AS without FROM (
             SELECT order_id, customer_id FROM shop_orders
             UNION ALL SELECT order_id, customer_id FROM (SELECT DISTINCT * FROM dup_orders WHERE order_id IS NULL)) GROUP BY 1""",
        "shop_orders",
        "dup_orders",
    ),
    "str_stage_upsert": sql(
        """SELECT * REPLACE (CASE status WHEN 'P' THEN amount + 1 ELSE amount END AS amount, CASE status WHEN 'P' THEN time + 1 ELSE time END AS time),
             'orders' AS source_system, '2024-02-01 00:00:00' AS load_timestamp FROM orders_all""",
        "orders_all",
    ),
    "str_dedupe": sql(
        """SELECT order_id, customer_id FROM shop_orders
           UNION ALL SELECT order_id, customer_id FROM (SELECT DISTINCT * FROM dup_orders WHERE order_id IS NULL)""",
        "shop_orders",
        "dup_orders",
    ),
}
