"""Inputs derived from the given tables, written once in SQL that Spark and DuckDB share.

``{epoch:x}`` and similar marks are filled in per dialect. Every fixture reads its
whole base table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from kindred.plans.config import Config, from_dict
from kindred.session import configure

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# A clock for everything that would read the present: 2024-02-01 00:00:00 UTC.
AS_OF = 1706745600

_MARKS = {
    "epoch": {"spark": "unix_timestamp({0})", "duck": "(epoch_us({0}) // 1000000)"},
    "seconds": {
        "spark": "date_format({0}, 'yyyy-MM-dd HH:mm:ss')",
        "duck": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
    },
    "day": {"spark": "date_format({0}, 'yyyy-MM-dd')", "duck": "strftime({0}, '%Y-%m-%d')"},
    "month": {"spark": "date_format({0}, 'yyyy-MM')", "duck": "strftime({0}, '%Y-%m')"},
    "dmy": {"spark": "date_format({0}, 'dd-MM-yyyy')", "duck": "strftime({0}, '%d-%m-%Y')"},
    "mdy": {"spark": "date_format({0}, 'MM/dd/yyyy HH:mm:ss')", "duck": "strftime({0}, '%m/%d/%Y %H:%M:%S')"},
    "iso": {
        "spark": "date_format({0}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
        "duck": "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')",
    },
    "sha": {"spark": "sha2({0}, 256)", "duck": "sha256({0})"},
    "text": {"spark": "CAST({0} AS STRING)", "duck": "CAST({0} AS VARCHAR)"},
}

FIXTURES = {
    "crm_profiles": """
        SELECT {text:c_custkey} AS customer_id,
          CASE WHEN c_custkey % 13 = 0 THEN 'N/A' WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN NULL
               ELSE 'user' || {text:c_custkey - c_custkey % 2} || '@example.com' END AS email,
          CASE WHEN c_custkey % 3 = 0 THEN '555' || lpad({text:c_custkey - c_custkey % 4}, 7, '0') END AS phone,
          CAST(1600000000 + c_custkey * 60 AS BIGINT) AS time
        FROM customer""",
    "shop_orders": """
        SELECT o_orderkey AS order_id, {text:o_custkey} AS customer_id,
          CASE WHEN o_orderkey % 4 = 0 THEN 'user' || {text:o_custkey - o_custkey % 2} || '@example.com'
               WHEN o_orderkey % 9 = 0 THEN 'guest' || {text:o_orderkey} || '@example.com' END AS order_email,
          o_totalprice, CAST({epoch:o_orderdate} AS BIGINT) AS time
        FROM orders""",
    "web_events": """
        SELECT event_id,
          'ck' || {text:CASE WHEN event_id % 97 = 0 AND user_id % 5 <> 4 THEN (user_id + 1) * 3 ELSE user_id * 3 + event_id % 3 END} AS cookie_id,
          CASE WHEN event_type = 'signup' THEN 'user' || {text:user_id - user_id % 2} || '@example.com' END AS user_email,
          CASE WHEN event_type = 'purchase' THEN {text:user_id} END AS customer_id,
          props, CAST({epoch:ts} AS BIGINT) AS time
        FROM events""",
    "orders_all": """
        SELECT {text:o_orderkey} AS order_id, {text:o_custkey} AS customer_id, o_orderstatus AS status,
          o_totalprice AS amount, {seconds:o_orderdate} AS updated_at, {day:o_orderdate} AS order_day,
          CAST({epoch:o_orderdate} AS BIGINT) AS time
        FROM orders""",
    "orders_hist": """
        SELECT order_id, customer_id, status, amount, updated_at, time FROM orders_all WHERE order_day < '1999-01-01'""",
    "orders_inc": """
        SELECT order_day AS incremental_date, order_id, customer_id, status, amount, updated_at, time
        FROM orders_all WHERE order_day >= '1999-01-01'""",
    "raw_contacts": """
        SELECT c_custkey AS contact_id,
          CASE c_custkey % 8 WHEN 0 THEN '  User' || {text:c_custkey} || '@Example.COM ' WHEN 1 THEN 'N/A'
               WHEN 2 THEN 'user' || {text:c_custkey} WHEN 3 THEN NULL WHEN 4 THEN ''
               WHEN 5 THEN 'a.b+c' || {text:c_custkey} || '@test.com'
               ELSE 'user' || {text:c_custkey} || '@mail.org' END AS email,
          CASE c_custkey % 8 WHEN 0 THEN '(555) ' || lpad({text:c_custkey % 1000}, 3, '0') || '-1234'
               WHEN 1 THEN '1-555-' || lpad({text:c_custkey % 1000}, 3, '0') || '-1234'
               WHEN 2 THEN '55500012' || {text:c_custkey % 10} WHEN 3 THEN '0' WHEN 4 THEN NULL WHEN 5 THEN ''
               ELSE '555' || lpad({text:c_custkey}, 7, '0') END AS phone,
          CASE c_custkey % 6 WHEN 0 THEN ' Yes' WHEN 1 THEN 'no ' WHEN 2 THEN '1' WHEN 3 THEN '0'
               WHEN 4 THEN 'x' ELSE 'TRUE' END AS is_active,
          CASE c_custkey % 5 WHEN 0 THEN 'abc' WHEN 1 THEN NULL WHEN 2 THEN ' ' || {text:c_custkey} || '.256 '
               ELSE {text:c_custkey} || '.5' END AS amount,
          CASE c_custkey % 7 WHEN 0 THEN ' none ' WHEN 1 THEN 'n/a' WHEN 2 THEN NULL WHEN 3 THEN 'Na'
               ELSE '  ' || c_mktsegment || ' ' || lower(c_name) END AS segment,
          c_acctbal AS balance, c_nationkey AS nation_id, c_acctbal >= 0 AS consent,
          CAST(1600000000 + c_custkey * 60 AS BIGINT) AS time
        FROM customer""",
    "raw_dates": """
        SELECT o_orderkey AS order_id,
          CASE o_orderkey % 6 WHEN 0 THEN {seconds:o_orderdate} WHEN 1 THEN {iso:o_orderdate} WHEN 2 THEN {dmy:o_orderdate}
               WHEN 3 THEN {mdy:o_orderdate} WHEN 4 THEN {text:{epoch:o_orderdate}} ELSE 'bad' END AS order_date,
          {iso:o_orderdate} AS iso_date, CAST({epoch:o_orderdate} AS BIGINT) AS placed_at,
          {day:o_orderdate} AS plain_day, o_totalprice
        FROM orders""",
    "raw_json": """
        SELECT event_id,
          CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' AND value > 50 THEN 'not json'
               ELSE '{"k":' || {text:event_id % 100} || ',"$src":"web","b c":"' || event_type || '","user":{"id":' || {text:user_id}
                    || ',"type":"t' || {text:user_id % 3} || '"},"tags":["a","' || event_type || '"],"empty":""}' END AS attributes,
          CAST({epoch:ts} AS BIGINT) AS time
        FROM events""",
    "dup_orders": """
        SELECT * FROM shop_orders
        UNION ALL
        SELECT order_id, customer_id, order_email, o_totalprice / 2 AS o_totalprice, time - 1000 AS time FROM shop_orders
        UNION ALL
        SELECT NULL AS order_id, customer_id, order_email, o_totalprice, time FROM shop_orders WHERE order_email IS NULL""",
    "src_day2": """
        SELECT {text:c_custkey} AS customer_id,
          CASE WHEN c_custkey % 13 = 0 THEN 'N/A' WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN NULL
               ELSE 'user' || {text:c_custkey - c_custkey % 2} || '@example.com' END AS email,
          CASE WHEN c_mktsegment = 'BUILDING' THEN '777' || lpad({text:c_custkey}, 7, '0')
               WHEN c_custkey % 3 = 0 THEN '555' || lpad({text:c_custkey - c_custkey % 4}, 7, '0') END AS phone
        FROM customer WHERE c_acctbal >= 0""",
    "masked_input": """
        SELECT customer_id,
          CASE WHEN customer_id LIKE '%7' THEN {sha:email} ELSE email END AS email,
          CASE WHEN customer_id LIKE '%3' THEN {sha:phone} WHEN customer_id LIKE '%9' THEN phone || '99' ELSE phone END AS phone,
          time, 'crm' AS source, time AS ingest_time
        FROM crm_profiles""",
    "months": """
        SELECT month_name, count(*) AS n, min(o_orderdate) AS first_day FROM
          (SELECT {month:o_orderdate} AS month_name, o_orderdate FROM orders) m
        GROUP BY month_name""",
    "ledger": """
        SELECT 'shop_' || month_name AS log_id,
          CASE WHEN month_name < '1996' THEN 'shop' ELSE 'shop_' || month_name END AS source_name,
          'shop_ingest' AS workflow_name, 'shop_orders' AS table_name,
          CASE WHEN month_name LIKE '%-03' OR month_name LIKE '%-08' THEN 'ERROR'
               WHEN month_name LIKE '%-11' THEN 'STARTED' ELSE 'SUCCESS' END AS status,
          month_name || '-01T00:00:00.000000' AS start_time, month_name || '-28T23:59:59.000000' AS end_time,
          CAST(n AS BIGINT) AS records_processed,
          CASE WHEN month_name LIKE '%-03' OR month_name LIKE '%-08' THEN 'timeout' END AS error_message,
          CAST(NULL AS STRING) AS job_id, CAST(NULL AS STRING) AS job_url, CAST({epoch:first_day} AS BIGINT) AS time
        FROM months""",
    "inc_log": """
        SELECT 'orders' AS table_name, 'hist_union' AS project_name, max(time) AS inc_value FROM orders_inc GROUP BY incremental_date
        UNION ALL
        SELECT 'orders_hist' AS table_name, 'hist_union' AS project_name, max(time) AS inc_value FROM orders_hist GROUP BY status
        UNION ALL
        SELECT 'orders' AS table_name, 'staging' AS project_name, max(time) AS inc_value FROM orders_hist""",
}

# Which fixtures a fixture reads.
_NEEDS = {
    "orders_hist": ["orders_all"],
    "orders_inc": ["orders_all"],
    "dup_orders": ["shop_orders"],
    "masked_input": ["crm_profiles"],
    "ledger": ["months"],
    "inc_log": ["orders_inc", "orders_hist"],
}

IDENTITY = {
    "name": "customers",
    "keys": [
        {"name": "email", "valid_regexp": ".*@.*", "invalid_texts": ["", "N/A", "null"]},
        {"name": "customer_id", "invalid_texts": ["", "N/A", "null"]},
        {"name": "phone", "invalid_texts": ["", "N/A", "null"]},
        {"name": "cookie_id", "invalid_texts": ["", "N/A", "null"]},
    ],
    "tables": [
        {
            "database": "client_stg",
            "table": "crm_profiles",
            "key_columns": [
                {"column": "email", "key": "email"},
                {"column": "customer_id", "key": "customer_id"},
                {"column": "phone", "key": "phone"},
            ],
        },
        {
            "database": "client_stg",
            "table": "shop_orders",
            "key_columns": [{"column": "order_email", "key": "email"}, {"column": "customer_id", "key": "customer_id"}],
        },
        {
            "database": "client_stg",
            "table": "web_events",
            "key_columns": [
                {"column": "cookie_id", "key": "cookie_id"},
                {"column": "user_email", "key": "email"},
                {"column": "customer_id", "key": "customer_id"},
            ],
        },
    ],
    "canonical_ids": [{"name": "unified_id", "merge_by_keys": ["email", "customer_id", "phone", "cookie_id"]}],
    "master_tables": [
        {
            "name": "customer_master",
            "canonical_id": "unified_id",
            "attributes": [
                {
                    "name": "best_email",
                    "source_columns": [
                        {"table": "crm_profiles", "column": "email", "priority": 2},
                        {"table": "shop_orders", "column": "order_email", "priority": 1},
                        {"table": "web_events", "column": "user_email", "priority": 3},
                    ],
                },
                {"name": "best_phone", "source_columns": [{"table": "crm_profiles", "column": "phone"}]},
                {
                    "name": "first_customer_id",
                    "source_columns": [{"table": "shop_orders", "column": "customer_id", "order": "first"}],
                },
                {
                    "name": "top_emails",
                    "array_elements": 3,
                    "source_columns": [
                        {"table": "crm_profiles", "column": "email", "priority": 1},
                        {"table": "shop_orders", "column": "order_email", "priority": 2},
                    ],
                },
            ],
        }
    ],
}


def identity_config() -> Config:
    return from_dict(IDENTITY)


def _fill(sql: str, dialect: str) -> str:
    """Replace the innermost marks until none is left."""
    mark = re.compile(r"\{(" + "|".join(_MARKS) + r"):([^{}]*)\}")
    while True:
        sql, count = mark.subn(lambda m: _MARKS[m[1]][dialect].format(m[2]), sql)
        if not count:
            return sql


def _with_needs(names) -> list[str]:
    order: list[str] = []
    for name in names:
        for need in _with_needs(_NEEDS.get(name, [])):
            if need not in order:
                order.append(need)
        if name not in order:
            order.append(name)
    return order


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or fixture as a DataFrame."""
    configure(spark)
    if name in BASE_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    chain = _with_needs([name])
    texts = {n: _fill(FIXTURES[n], "spark") for n in chain}
    for base in BASE_TABLES:
        if any(re.search(rf"\bFROM {base}\b", text) for text in texts.values()):
            spark.read.parquet(f"{sf_dir}/{base}.parquet").createOrReplaceTempView(base)
    for need in chain[:-1]:
        spark.sql(texts[need]).createOrReplaceTempView(need)
    return spark.sql(texts[name])


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [view(spark, sf_dir, n) for n in names]


def sql(body: str, *names: str, ctes: str = "", recursive: bool = False) -> str:
    """DuckDB text: the fixtures as common tables, further ones, then the body."""
    parts = [f"{n} AS ({_fill(FIXTURES[n], 'duck')})" for n in _with_needs(names)]
    if ctes:
        parts.append(_fill(ctes, "duck").strip().rstrip(","))
    head = f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" if parts else ""
    return head + _fill(body, "duck")
