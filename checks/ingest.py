"""Source windows, watermarks, ledger and hist-union: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import AS_OF, sql, view, views
from kindred.functions.clock import BOUND_STYLES, format_window_bound
from kindred.operators import histunion as H
from kindred.operators import state
from kindred.sources import files, windows

INC_FIELDS = {
    "hist": {"table_field": "created_at", "source_field": "created"},
    "inc": {"table_field": "updated_at", "source_field": "updated"},
    "none": {},
}


def _late_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Second delivery: the same rows, plus rows exactly at and after the watermark."""
    inc = view(spark, sf, "orders_inc")
    edge = F.lit(inc.agg(F.max("time")).first()[0])
    return inc.unionByName(inc.withColumn("time", edge)).unionByName(
        inc.filter(F.col("status") == "O").withColumn("time", F.col("time") + edge)
    )


# -- sources ------------------------------------------------------------------


def q_window(spark, sf):
    df = view(spark, sf, "orders_all")
    return windows.pull_window(df, "updated_at", "1998-01-01 00:00:00", "1999-06-30 00:00:00").unionByName(
        windows.pull_window(df, "updated_at", "2000-01-01 00:00:00")
    )


def q_resolve_window(spark, sf):
    df = view(spark, sf, "orders_all")
    empty = df.filter(F.lit(False))
    parts = []
    for style in BOUND_STYLES:
        parts.append(windows.resolve_window(df, "updated_at", "2020-01-01", style, AS_OF).withColumn("k", F.lit(style)))
        parts.append(windows.resolve_window(empty, "updated_at", "2020-01-01", style, AS_OF).withColumn("k", F.lit(f"{style}_empty")))
    parts.append(windows.resolve_window(df, None, "2020-01-01", "micros", AS_OF).withColumn("k", F.lit("no_field")))
    parts.append(windows.resolve_window(df, None, "2020-01-01", "micros", AS_OF, empty_start=False).withColumn("k", F.lit("no_field_default")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_bounds(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return view(spark, sf, "events").select("event_id", *[format_window_bound(ts, s).alias(f"as_{s}") for s in BOUND_STYLES])


def q_parse_typed(spark, sf):
    raw = view(spark, sf, "raw_dates")
    other = view(spark, sf, "raw_contacts").select(F.col("contact_id").cast("string").alias("id"), "amount", F.trim("is_active").alias("flag"))
    text = raw.select(F.col("order_id").cast("string").alias("id"), "order_date", "plain_day")
    typed = files.parse_typed(
        text,
        [
            {"name": "id", "type": "long"},
            {"name": "order_date", "type": "timestamp", "format": "%m/%d/%Y %H:%M:%S"},
            {"name": "plain_day", "type": "date", "format": "%Y-%m-%d"},
        ],
    ).select(
        F.lit("orders").alias("src"),
        "id",
        F.date_format("order_date", "yyyy-MM-dd HH:mm:ss").alias("a"),
        F.date_format("plain_day", "yyyy-MM-dd").alias("b"),
        F.lit(None).cast("double").alias("num"),
        F.lit(None).cast("string").alias("flag"),
    )
    numbers = files.parse_typed(
        other, [{"name": "id", "type": "long"}, {"name": "amount", "type": "double"}, {"name": "flag", "type": "boolean"}]
    ).select(
        F.lit("contacts").alias("src"),
        "id",
        F.lit(None).cast("string").alias("a"),
        F.lit(None).cast("string").alias("b"),
        F.col("amount").alias("num"),
        F.col("flag").cast("string").alias("flag"),
    )
    return typed.unionByName(numbers)


def q_parse_json(spark, sf):
    """A JSON column keeps its text and turns NULL where it does not parse."""
    raw = view(spark, sf, "raw_json").select(F.col("event_id").cast("string").alias("event_id"), "attributes")
    return files.parse_typed(raw, [{"name": "event_id", "type": "long"}, {"name": "attributes", "type": "json"}])


def q_add_time(spark, sf):
    return windows.add_time(view(spark, sf, "nation").drop("time"), AS_OF).join(
        view(spark, sf, "supplier"), F.col("n_nationkey") == F.col("s_nationkey")
    ).select("s_suppkey", "n_name", "time")


def q_add_constant(spark, sf):
    df = view(spark, sf, "shop_orders").select("order_id", "time")
    return windows.add_constant(windows.add_constant(df, "shop", "string", "eu"), "priority", "bigint", 7)


def q_full(spark, sf):
    return windows.pull_full(view(spark, sf, "orders_all"))


def q_map_fields(spark, sf):
    df = view(spark, sf, "orders_all").select(
        "order_id", F.col("updated_at").alias("updated"), F.date_format(F.to_timestamp("updated_at"), "yyyy-MM-dd").alias("created")
    )
    for mode in ("hist", "inc", "none"):
        df = windows.map_inc_fields(df, windows.choose_inc_fields(INC_FIELDS, mode))
    return df


# -- state --------------------------------------------------------------------


def q_watermark(spark, sf):
    log = view(spark, sf, "inc_log")
    parts = []
    for table, project in (("orders", "hist_union"), ("orders_hist", "hist_union"), ("orders", "staging"), ("orders", "other")):
        parts.append(state.watermark(log, table, project).select(F.lit(f"{table}/{project}").alias("k"), "inc_value"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def q_new_rows(spark, sf):
    log = view(spark, sf, "inc_log")
    return state.new_rows(_late_orders(spark, sf), state.read_watermark(log, "orders", "hist_union"))


def q_commit(spark, sf):
    inc, hist = views(spark, sf, "orders_inc", "orders_hist")
    none = inc.filter(F.lit(False))
    return (
        state.watermark_row(inc, "orders", "hist_union")
        .unionByName(state.watermark_row(hist, "orders_hist", "hist_union"))
        .unionByName(state.watermark_row(none, "nothing", "hist_union"))
        .unionByName(state.watermark_row(none, "nothing", "staging", empty_as_zero=True))
    )


def q_pending_count(spark, sf):
    log, every = views(spark, sf, "inc_log", "orders_all")
    return state.pending_count(every, state.read_watermark(log, "orders", "staging"))


def q_months(spark, sf):
    bounds = view(spark, sf, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return state.month_ranges(bounds, "a", "b")


def q_pending_batches(spark, sf):
    return state.pending_batches(view(spark, sf, "ledger"), q_months(spark, sf), "shop", "shop_ingest", "shop_orders")


def q_log_event(spark, sf):
    counted = view(spark, sf, "orders").agg(F.count(F.lit(1)).alias("records"))
    named = {"source": "shop", "workflow": "shop_ingest", "table": "shop_orders"}
    job = {"job_id": "42", "job_url": "https://jobs.example.com/42"}
    rows = [
        state.ledger_row(counted, "started", AS_OF, **named),
        state.ledger_row(counted, "success", AS_OF + 1, start_time="a", end_time="b", **named, **job),
        state.ledger_row(counted, "success_no_window", AS_OF + 2, **named, **job),
        state.ledger_row(counted, "error", AS_OF + 3, error="timeout", **named),
        state.ledger_row(counted, "runner_completed", AS_OF + 4),
        state.ledger_row(counted, "runner_error", AS_OF + 5, error="boom"),
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def q_last_record(spark, sf):
    df = view(spark, sf, "orders_all")
    late = df.agg(F.max("time")).first()[0]
    return (
        state.last_record_time(df, "updated_at", late + 86400)
        .withColumn("k", F.lit("recent"))
        .unionByName(state.last_record_time(df, "updated_at", AS_OF).withColumn("k", F.lit("stale")))
    )


# -- hist-union ---------------------------------------------------------------


def q_names(spark, sf):
    part = view(spark, sf, "part")
    suffix = F.element_at(F.array(F.lit(""), F.lit("_hist"), F.lit("_histunion")), (F.col("p_partkey") % 3 + 1).cast("int"))
    name = F.concat(F.lit("client_src."), F.replace("p_name", F.lit(" "), F.lit("_")), suffix)
    return part.select("p_partkey", *[c.alias(n) for n, c in H.derive_names(name).items()])


def q_schema_diff(spark, sf):
    """Differing columns, each with the number of values it would bring in."""
    inc, hist = views(spark, sf, "orders_inc", "orders_hist")
    hist = hist.withColumnRenamed("status", "old_status").withColumn("amount", F.col("amount").cast("string"))
    diff = H.compare_schemas(inc.schema, hist.schema, spark)
    filled = inc.agg(*[F.count(c).alias(c) for c in inc.columns])
    long = filled.unpivot([], list(inc.columns), "column_name", "inc_values")
    return diff.join(long, "column_name", "left")


def q_incremental(spark, sf):
    inc, hist, log = views(spark, sf, "orders_inc", "orders_hist", "inc_log")
    wm_inc = state.read_watermark(log, "orders", "hist_union") - 40 * 86400
    wm_hist = state.read_watermark(log, "orders_hist", "hist_union") - 40 * 86400
    return H.hist_union_incremental(inc, hist, wm_inc, wm_hist)


def q_first_run(spark, sf):
    inc, hist = views(spark, sf, "orders_inc", "orders_hist")
    return H.hist_union_incremental(inc, hist)


def q_full_union(spark, sf):
    inc, hist = views(spark, sf, "orders_inc", "orders_hist")
    hist = hist.withColumnRenamed("status", "old_status")
    return H.hist_union_full(inc, hist, {"status": F.lit("unknown")}, keep_hist_only=True)


def q_snapshot(spark, sf):
    return H.hist_union_snapshot(view(spark, sf, "orders_inc"))


def q_cast_align(spark, sf):
    inc = view(spark, sf, "orders_inc")
    hist = view(spark, sf, "orders_hist").withColumn("amount", F.when(F.col("status") == "P", F.lit("n/a")).otherwise(F.col("amount").cast("int").cast("string")))
    types = {"amount": "double", "order_id": "bigint"}
    return H.hist_union_full(H.cast_align(inc, types), H.cast_align(hist, types))


def q_missing_side(spark, sf):
    inc, hist = views(spark, sf, "orders_inc", "orders_hist")
    only_inc = H.hist_union_full(*H.with_missing_side(spark, inc, None))
    only_hist = H.hist_union_full(*H.with_missing_side(spark, None, hist))
    return only_inc.withColumn("side", F.lit("inc")).unionByName(only_hist.withColumn("side", F.lit("hist")), allowMissingColumns=True)


def q_reconcile(spark, sf):
    inc, hist = views(spark, sf, "orders_inc", "orders_hist")
    return H.reconcile_counts(inc, hist, H.hist_union_full(inc, hist))


def q_origin(spark, sf):
    inc, hist = views(spark, sf, "orders_inc", "orders_hist")
    return H.origin_split(H.hist_union_full(inc, hist), "incremental_date")


def q_watermarks(spark, sf):
    return H.watermark_report(view(spark, sf, "inc_log"))


_ALIGNED = "CAST(NULL AS VARCHAR) AS incremental_date, order_id, customer_id, status, amount, updated_at, time"
_END = "2024-02-01T00:00:00"
_MONTHS = """
    grid AS (SELECT m FROM (SELECT date_trunc('month', min(o_orderdate)) AS lo, max(o_orderdate) AS hi FROM orders) b,
             unnest(generate_series(b.lo, b.hi, INTERVAL 1 MONTH)) AS g(m)),
    ranges AS (SELECT strftime(m, '%Y-%m-01T00:00:00.000000') AS start_time,
                      strftime(last_day(m), '%Y-%m-%dT23:59:59.000000') AS end_time, strftime(m, '%Y-%m') AS month_name FROM grid)"""

QUERIES = {
    "src_window": q_window,
    "src_resolve_window": q_resolve_window,
    "src_bounds": q_bounds,
    "src_parse_typed": q_parse_typed,
    "src_parse_json": q_parse_json,
    "src_add_time": q_add_time,
    "src_add_constant": q_add_constant,
    "src_full": q_full,
    "src_map_fields": q_map_fields,
    "inc_watermark": q_watermark,
    "inc_new_rows": q_new_rows,
    "inc_commit": q_commit,
    "inc_pending_count": q_pending_count,
    "inc_months": q_months,
    "inc_pending_batches": q_pending_batches,
    "inc_log_event": q_log_event,
    "inc_last_record": q_last_record,
    "hu_names": q_names,
    "hu_schema_diff": q_schema_diff,
    "hu_incremental": q_incremental,
    "hu_first_run": q_first_run,
    "hu_full": q_full_union,
    "hu_snapshot": q_snapshot,
    "hu_cast_align": q_cast_align,
    "hu_missing_side": q_missing_side,
    "hu_reconcile": q_reconcile,
    "hu_origin": q_origin,
    "hu_watermarks": q_watermarks,
}

_LATEST = "SELECT max(updated_at) AS u FROM orders_all"


def _window_rows() -> str:
    ends = {"micros": f"{_END}.000000", "millis_z": f"{_END}.000Z", "iso": f"{_END}.000Z", "sql": "2024-02-01 00:00:00.000"}
    starts = {
        "micros": "replace(u, ' ', 'T') || '.000000'",
        "millis_z": "replace(u, ' ', 'T') || '.000Z'",
        "iso": "replace(u, ' ', 'T') || '.000Z'",
        "sql": "u",
    }
    rows = []
    for style in BOUND_STYLES:
        rows.append(f"SELECT {starts[style]} AS start_time, '{ends[style]}' AS end_time, '{style}' AS k FROM ({_LATEST})")
        rows.append(f"SELECT '2020-01-01', '{ends[style]}', '{style}_empty'")
    rows.append(f"SELECT '', '{ends['micros']}', 'no_field'")
    rows.append(f"SELECT '2020-01-01', '{ends['micros']}', 'no_field_default'")
    return " UNION ALL ".join(rows)


ORACLES = {
    "src_window": sql(
        "SELECT * FROM orders_all WHERE (updated_at > '1998-01-01 00:00:00' AND updated_at <= '1999-06-30 00:00:00') OR updated_at > '2000-01-01 00:00:00'",
        "orders_all",
    ),
    "src_resolve_window": sql(_window_rows(), "orders_all"),
    "src_bounds": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000000' AS as_micros,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS as_millis_z,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z' AS as_iso,
        strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') AS as_sql FROM events""",
    "src_parse_typed": sql(
        """SELECT 'orders' AS src, order_id AS id, strftime(try_strptime(order_date, '%m/%d/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS a,
             plain_day AS b, CAST(NULL AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS flag FROM raw_dates
           UNION ALL SELECT 'contacts', contact_id, NULL, NULL, TRY_CAST(trim(amount) AS DOUBLE),
             CASE WHEN lower(trim(is_active)) IN ('yes', '1', 'true', 't', 'y') THEN 'true' WHEN lower(trim(is_active)) IN ('no', '0', 'false', 'f', 'n') THEN 'false' END
           FROM raw_contacts""",
        "raw_dates",
        "raw_contacts",
    ),
    "src_parse_json": sql("SELECT event_id, CASE WHEN json_valid(attributes) THEN attributes END AS attributes FROM raw_json", "raw_json"),
    "src_add_time": f"SELECT s_suppkey, n_name, CAST({AS_OF} AS BIGINT) AS time FROM nation JOIN supplier ON n_nationkey = s_nationkey",
    "src_add_constant": sql("SELECT order_id, time, 'eu' AS shop, CAST(7 AS BIGINT) AS priority FROM shop_orders", "shop_orders"),
    "src_full": sql("SELECT * FROM orders_all", "orders_all"),
    "src_map_fields": sql("SELECT order_id, updated_at, order_day AS created_at FROM orders_all", "orders_all"),
    "inc_watermark": sql(
        """SELECT 'orders/hist_union' AS k, coalesce(max(inc_value), 0) AS inc_value FROM inc_log WHERE table_name = 'orders' AND project_name = 'hist_union'
           UNION ALL SELECT 'orders_hist/hist_union', coalesce(max(inc_value), 0) FROM inc_log WHERE table_name = 'orders_hist' AND project_name = 'hist_union'
           UNION ALL SELECT 'orders/staging', coalesce(max(inc_value), 0) FROM inc_log WHERE table_name = 'orders' AND project_name = 'staging'
           UNION ALL SELECT 'orders/other', 0""",
        "inc_log",
    ),
    "inc_new_rows": sql(
        "SELECT * REPLACE (time + (SELECT max(time) FROM orders_inc) AS time) FROM orders_inc WHERE status = 'O'", "orders_inc"
    ),
    "inc_commit": sql(
        """SELECT 'orders' AS table_name, 'hist_union' AS project_name, max(time) AS inc_value FROM orders_inc
           UNION ALL SELECT 'orders_hist', 'hist_union', max(time) FROM orders_hist
           UNION ALL SELECT 'nothing', 'hist_union', NULL UNION ALL SELECT 'nothing', 'staging', 0""",
        "orders_inc",
        "orders_hist",
    ),
    "inc_pending_count": sql(
        """SELECT w AS stg_time, (SELECT count(*) FROM orders_all WHERE time > w) AS inc_records
           FROM (SELECT max(inc_value) AS w FROM inc_log WHERE table_name = 'orders' AND project_name = 'staging')""",
        "orders_all",
        "inc_log",
    ),
    "inc_months": sql("SELECT * FROM ranges", ctes=_MONTHS),
    "inc_pending_batches": sql(
        """SELECT * FROM ranges r WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.source_name = 'shop_' || r.month_name
           AND l.workflow_name = 'shop_ingest' AND l.table_name = 'shop_orders' AND l.status = 'SUCCESS')""",
        "ledger",
        ctes=_MONTHS,
    ),
    "inc_log_event": f"""SELECT * FROM (VALUES
        ('shop_shop_orders_2024-02-01 00:00:00 UTC', 'shop', 'shop_ingest', 'shop_orders', 'STARTED', '2024-02-01 00:00:00 UTC', NULL, 0, NULL, NULL, NULL, {AS_OF}),
        ('shop_shop_orders_2024-02-01 00:00:01 UTC', 'shop', 'shop_ingest', 'shop_orders', 'SUCCESS', 'a', 'b', (SELECT count(*) FROM orders), NULL, '42', 'https://jobs.example.com/42', {AS_OF + 1}),
        ('shop_shop_orders_2024-02-01 00:00:02 UTC', 'shop', 'shop_ingest', 'shop_orders', 'SUCCESS', '', '', (SELECT count(*) FROM orders), NULL, '42', 'https://jobs.example.com/42', {AS_OF + 2}),
        ('shop_2024-02-01 00:00:03 UTC', 'shop', 'shop_ingest', NULL, 'ERROR', NULL, '2024-02-01 00:00:03 UTC', 0, 'timeout', NULL, NULL, {AS_OF + 3}),
        ('ingestion_runner_{AS_OF + 4}', 'ingestion_runner', 'ingestion_runner', NULL, 'COMPLETED', NULL, '2024-02-01 00:00:04 UTC', (SELECT count(*) FROM orders), NULL, NULL, NULL, {AS_OF + 4}),
        ('ingestion_runner_error_{AS_OF + 5}', 'ingestion_runner', 'ingestion_runner', NULL, 'ERROR', NULL, '2024-02-01 00:00:05 UTC', 0, 'boom', NULL, NULL, {AS_OF + 5}))
        t(log_id, source_name, workflow_name, table_name, status, start_time, end_time, records_processed, error_message, job_id, job_url, time)""",
    "inc_last_record": sql(
        "SELECT max(updated_at) AS last_record_time, 'recent' AS k FROM orders_all UNION ALL SELECT '1970-01-01 00:00:00', 'stale'",
        "orders_all",
    ),
    "hu_names": """SELECT p_partkey, 'client_src.' || replace(p_name, ' ', '_') AS inc_table,
        'client_src.' || replace(p_name, ' ', '_') || '_hist' AS hist_table, 'client_src.' || replace(p_name, ' ', '_') || '_histunion' AS target_table FROM part""",
    "hu_schema_diff": sql(
        """SELECT * FROM (VALUES ('incremental_date', 'inc_only', 'string', NULL, (SELECT count(incremental_date) FROM orders_inc)),
             ('status', 'inc_only', 'string', NULL, (SELECT count(status) FROM orders_inc)),
             ('amount', 'type_differs', 'double', 'string', (SELECT count(amount) FROM orders_inc)),
             ('old_status', 'hist_only', NULL, 'string', NULL)) t(column_name, status, inc_type, hist_type, inc_values)""",
        "orders_inc",
    ),
    "hu_incremental": sql(
        f"""SELECT {_ALIGNED} FROM orders_hist WHERE time > (SELECT max(inc_value) FROM inc_log WHERE table_name = 'orders_hist') - 3456000
            UNION ALL SELECT * FROM orders_inc WHERE time > (SELECT max(inc_value) FROM inc_log WHERE table_name = 'orders' AND project_name = 'hist_union') - 3456000""",
        "orders_hist",
        "orders_inc",
        "inc_log",
    ),
    "hu_first_run": sql(f"SELECT {_ALIGNED} FROM orders_hist UNION ALL SELECT * FROM orders_inc", "orders_hist", "orders_inc"),
    "hu_full": sql(
        """SELECT NULL AS incremental_date, order_id, customer_id, 'unknown' AS status, amount, updated_at, time, status AS old_status FROM orders_hist
           UNION ALL SELECT *, NULL FROM orders_inc""",
        "orders_hist",
        "orders_inc",
    ),
    "hu_snapshot": sql("SELECT * FROM orders_inc", "orders_inc"),
    "hu_cast_align": sql(
        """SELECT NULL AS incremental_date, CAST(order_id AS BIGINT) AS order_id, customer_id, status,
             CASE WHEN status = 'P' THEN NULL ELSE CAST(trunc(amount) AS DOUBLE) END AS amount, updated_at, time FROM orders_hist
           UNION ALL SELECT incremental_date, CAST(order_id AS BIGINT), customer_id, status, amount, updated_at, time FROM orders_inc""",
        "orders_hist",
        "orders_inc",
    ),
    "hu_missing_side": sql(
        "SELECT *, 'inc' AS side FROM orders_inc UNION ALL SELECT NULL, order_id, customer_id, status, amount, updated_at, time, 'hist' FROM orders_hist",
        "orders_hist",
        "orders_inc",
    ),
    "hu_reconcile": sql(
        """SELECT 'inc' AS source, count(*) AS row_count FROM orders_inc UNION ALL SELECT 'hist', count(*) FROM orders_hist
           UNION ALL SELECT 'histunion', count(*) FROM orders""",
        "orders_hist",
        "orders_inc",
    ),
    "hu_origin": sql(
        "SELECT 'from_inc' AS source, count(*) AS row_count FROM orders_inc UNION ALL SELECT 'from_hist', count(*) FROM orders_hist",
        "orders_hist",
        "orders_inc",
    ),
    "hu_watermarks": sql(
        "SELECT *, strftime(make_timestamp(inc_value * 1000000), '%Y-%m-%d %H:%M:%S') AS last_update_time FROM inc_log WHERE project_name = 'hist_union'",
        "inc_log",
    ),
}
