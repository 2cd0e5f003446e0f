"""Identity preparation and key discovery: queries and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.fixtures import AS_OF, sql, view, views
from kindred.operators import keys as K
from kindred.operators import prep as P
from kindred.operators import sketches as SK
from kindred.sources import tables
from kindred.sources.scratch import checkpoint_root

COLUMNS = {"customer_id": "customer_id", "email": "email", "phone": "phone"}
EXCLUSION_SCHEMA = "key_value string, key_name string, tbls array<string>, note string"


def _prep(spark, sf):
    return P.prep_project(view(spark, sf, "crm_profiles"), COLUMNS).withColumn("time", F.lit(AS_OF).cast("long"))


def _input(spark, sf):
    """Unified input after day one: crm rows, and orders from a second source."""
    prep = _prep(spark, sf)
    crm = prep.select("customer_id", "email", "phone", "time", F.lit("crm").alias("source"), F.col("time").alias("ingest_time"))
    shop = view(spark, sf, "shop_orders").select(
        "customer_id", F.col("order_email").alias("email"), F.lit(None).cast("string").alias("phone"), "time", F.lit("shop").alias("source"), F.col("time").alias("ingest_time")
    )
    return crm.unionByName(shop)


def q_project(spark, sf):
    orders = view(spark, sf, "shop_orders")
    return P.prep_project(orders, {"order_email": "email", "customer_id": "cust", "order_id": "ord"}).unionByName(
        P.prep_project(orders, {"order_email": "email"}).withColumns({"cust": F.lit(None).cast("string"), "ord": F.lit(None).cast("string")})
    )


def q_sync(spark, sf):
    return P.prep_delete_vanished(_prep(spark, sf), view(spark, sf, "src_day2"), COLUMNS)


def q_new(spark, sf):
    return P.prep_new_rows(view(spark, sf, "src_day2"), _prep(spark, sf), COLUMNS, AS_OF + 86400)


def _day2(spark, sf):
    src, prep = view(spark, sf, "src_day2"), _prep(spark, sf)
    kept = P.prep_delete_vanished(prep, src, COLUMNS)
    return kept.unionByName(P.prep_new_rows(src, kept, COLUMNS, AS_OF + 86400))


def q_input(spark, sf):
    return P.input_cascade_delete(_input(spark, sf), _day2(spark, sf), list(COLUMNS), "crm")


def q_append(spark, sf):
    return P.input_append(_day2(spark, sf), _input(spark, sf), list(COLUMNS), "crm")


def q_masked(spark, sf):
    return P.find_masked(view(spark, sf, "masked_input"))


def _known(spark, sf):
    """Exclusions already listed: masked values of customers with an id below 5."""
    rows = P.find_masked(view(spark, sf, "masked_input").filter(F.col("customer_id") < "5"))
    return P.extend_exclusions(spark.createDataFrame([], EXCLUSION_SCHEMA), rows, "earlier")


def q_exclusions(spark, sf):
    df = P.extend_exclusions(_known(spark, sf), q_masked(spark, sf), "unif_input")
    return df.withColumn("tbls", F.concat_ws(",", "tbls"))


def q_exclude(spark, sf):
    return P.apply_exclusions(view(spark, sf, "masked_input"), _known(spark, sf))


def q_contact(spark, sf):
    return P.require_contact(P.apply_exclusions(view(spark, sf, "masked_input"), _known(spark, sf)))


def _long(spark, sf):
    crm, orders, web = views(spark, sf, "crm_profiles", "shop_orders", "web_events")
    return P.prep_long(
        [
            (crm, "crm_profiles", "email", "customer_id"),
            (orders, "shop_orders", "order_email", "customer_id"),
            (web, "web_events", "user_email", "cookie_id"),
        ]
    )


def q_long(spark, sf):
    return _long(spark, sf)


LONG_KEYS = [
    ("crm_profiles", "email", "customer_id", "email"),
    ("shop_orders", "order_email", "customer_id", "email"),
    ("web_events", "user_email", "cookie_id", "email"),
    ("crm_profiles", "phone", "customer_id", "phone"),
    ("crm_profiles", "customer_id", "email", "user_id"),
    ("shop_orders", "customer_id", "order_id", "user_id"),
    ("web_events", "customer_id", "cookie_id", "user_id"),
]


def _long_keys(spark, sf):
    return P.prep_long_keys([(view(spark, sf, table), table, *rest) for table, *rest in LONG_KEYS])


def q_long_keys(spark, sf):
    return _long_keys(spark, sf)


def q_dist_keys(spark, sf):
    return P.key_distribution(_long_keys(spark, sf))


def q_dist(spark, sf):
    return P.key_distribution(_long(spark, sf).withColumn("key_type", F.col("source_table")))


def q_key_profile(spark, sf):
    crm, orders = views(spark, sf, "crm_profiles", "shop_orders")
    return K.profile_keys(crm, "crm_profiles", ["customer_id", "email", "phone"]).unionByName(
        K.profile_keys(orders, "shop_orders", ["customer_id", "order_email"])
    )


def q_key_profile_numbers(spark, sf):
    """Numbers, dates and text of one table: each has the extremes of its own type."""
    return K.profile_keys(view(spark, sf, "orders"), "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])


def q_exclude_numbers(spark, sf):
    """A number as a key, against a list that also holds hashes."""
    orders = view(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("phone"))
    listed = orders.filter(F.col("phone") % 7 == 0).select(F.col("phone").cast("string").alias("key_value"))
    hashes = orders.select(F.sha2(F.col("phone").cast("string"), 256).alias("key_value"))
    listed = listed.unionByName(hashes).select("key_value", F.lit("phone").alias("key_name"))
    return P.apply_exclusions(orders, listed, {"phone": "phone"})


def q_key_overlap(spark, sf):
    crm, orders, web = views(spark, sf, "crm_profiles", "shop_orders", "web_events")
    return K.key_overlap({"crm": (crm, "email"), "shop": (orders, "order_email"), "web": (web, "user_email")})


_SKETCHED = {"crm_profiles": {"email": "email", "customer_id": "user_id"}, "shop_orders": {"order_email": "email", "customer_id": "user_id"}, "web_events": {"user_email": "email"}}


def _sketches(spark, sf):
    """Sketches of two loads of every table; the second one is repeated, which adds nothing."""
    root = f"{checkpoint_root(spark)}/sketches-{uuid.uuid4().hex}"
    sources = dict(zip(_SKETCHED, views(spark, sf, *_SKETCHED)))
    for table, columns in _SKETCHED.items():
        late = F.pmod(F.xxhash64("time", *columns), F.lit(2)) == 1
        for run, rows in (("day1", ~late), ("day2", late), ("day2", late)):
            SK.record_sketches(sources[table].filter(rows), table, columns, root, run)
    return sources, SK.merge_sketches(tables.load(spark, root))


def q_key_overlap_estimate(spark, sf):
    return SK.overlap_estimate(_sketches(spark, sf)[1])


def q_key_profile_estimate(spark, sf):
    return SK.profile_estimate(_sketches(spark, sf)[1])


def q_key_overlap_ranked(spark, sf):
    """Exact overlaps of the pairs whose estimate reaches half of the smaller side."""
    sources, merged = _sketches(spark, sf)
    return SK.exact_overlap(sources, SK.worthwhile(SK.overlap_estimate(merged), 50))


def q_key_detect(spark, sf):
    """Identifier columns of the tables, with the number of distinct values behind each."""
    names = ("crm_profiles", "shop_orders", "web_events", "raw_contacts", "part")
    frames = dict(zip(names, views(spark, sf, *names)))
    found = K.detect_identifiers({n: df.schema for n, df in frames.items()}, spark)
    profiles = None
    for row in found.select("table_name", "column_name").collect():
        one = K.profile_keys(frames[row.table_name], row.table_name, [row.column_name]).select("table_name", "column_name", "unique_count")
        profiles = one if profiles is None else profiles.unionByName(one)
    return found.join(profiles, ["table_name", "column_name"])


def q_key_excluded(spark, sf):
    """Tables without an identifier, with their size."""
    names = ("shop_orders", "part", "nation", "raw_json")
    frames = dict(zip(names, views(spark, sf, *names)))
    report = K.exclusion_report({n: df.schema for n, df in frames.items()}, spark)
    sizes = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        sizes = one if sizes is None else sizes.unionByName(one)
    return report.join(sizes, "table_name")


QUERIES = {
    "prep_project": q_project,
    "prep_sync": q_sync,
    "prep_new": q_new,
    "prep_input": q_input,
    "prep_append": q_append,
    "prep_masked": q_masked,
    "prep_exclusions": q_exclusions,
    "prep_exclude": q_exclude,
    "prep_contact": q_contact,
    "prep_long": q_long,
    "prep_dist": q_dist,
    "prep_long_keys": q_long_keys,
    "prep_dist_keys": q_dist_keys,
    "key_profile": q_key_profile,
    "key_profile_numbers": q_key_profile_numbers,
    "prep_exclude_numbers": q_exclude_numbers,
    "key_overlap": q_key_overlap,
    "key_overlap_estimate": q_key_overlap_estimate,
    "key_overlap_ranked": q_key_overlap_ranked,
    "key_profile_estimate": q_key_profile_estimate,
    "key_detect": q_key_detect,
    "key_excluded": q_key_excluded,
}

_KEY = "coalesce(customer_id, '') || '~' || coalesce(email, '') || '~' || coalesce(phone, '')"
_PREP = f"prep AS (SELECT DISTINCT customer_id, email, phone, CAST({AS_OF} AS BIGINT) AS time FROM crm_profiles WHERE coalesce(customer_id, email, phone) IS NOT NULL)"
_DAY2 = (
    _PREP
    + f""",
    fresh AS (SELECT *, CAST({AS_OF + 86400} AS BIGINT) AS time FROM (SELECT customer_id, email, phone FROM src_day2 EXCEPT SELECT customer_id, email, phone FROM prep)),
    kept AS (SELECT * FROM prep WHERE {_KEY} IN (SELECT {_KEY} FROM src_day2)),
    day2 AS (SELECT * FROM kept UNION ALL SELECT * FROM fresh),
    unif AS (SELECT customer_id, email, phone, time, 'crm' AS source, time AS ingest_time FROM prep
             UNION ALL SELECT customer_id, order_email, NULL, time, 'shop', time FROM shop_orders)"""
)
_MASKED = """SELECT 'phone' AS key_name, phone AS key_value FROM {t} WHERE length(phone) = 64 OR length(phone) > 10
    UNION ALL SELECT 'email', email FROM {t} WHERE length(email) = 64 AND email NOT LIKE '%@%'"""
_KNOWN = (
    "earlier AS (SELECT * FROM masked_input WHERE customer_id < '5'), known AS (SELECT DISTINCT key_value, key_name, 'earlier' AS tbls, 'DSAR masked ' || key_name AS note FROM ("
    + _MASKED.format(t="earlier")
    + "))"
)
_CLEAN = """SELECT * REPLACE (CASE WHEN email IN (SELECT key_value FROM known WHERE key_name = 'email') THEN NULL ELSE email END AS email,
    CASE WHEN phone IN (SELECT key_value FROM known WHERE key_name = 'phone') THEN NULL ELSE phone END AS phone) FROM masked_input"""
_RE = r"'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'"
_LONG = " UNION ALL ".join(
    f"SELECT DISTINCT '{t}' AS source_table, '{c}' AS source_column, lower(trim({c})) AS key_value, {i} AS source_id FROM {t} WHERE {c} <> '' AND regexp_matches({c}, {_RE})"
    for t, c, i in (("crm_profiles", "email", "customer_id"), ("shop_orders", "order_email", "customer_id"), ("web_events", "user_email", "cookie_id"))
)
_WEB = ("crm_profiles", "shop_orders", "web_events")
_TESTS = {"email": f"regexp_matches(COLUMN, {_RE})", "phone": r"regexp_matches(COLUMN, '^\s*\+?[0-9][0-9 ().-]{5,}$')", "user_id": "true"}
_LONG_KEYS = " UNION ALL ".join(
    f"""SELECT DISTINCT '{k}' AS key_type, '{t}' AS source_table, '{c}' AS source_column, lower(trim(CAST({c} AS VARCHAR))) AS key_value,
        CAST({i} AS VARCHAR) AS source_id FROM {t} WHERE trim(CAST({c} AS VARCHAR)) <> '' AND {_TESTS[k].replace('COLUMN', c)}"""
    for t, c, i, k in LONG_KEYS
)


def _profile(table: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, min({column}) AS min_value, max({column}) AS max_value,
        count(DISTINCT {column}) AS unique_count, count(*) AS row_count, count(*) - count({column}) AS null_count FROM {table}"""


def _overlap(a: str, b: str) -> str:
    pct = "CAST(round(CAST(s * 100.0 / nullif({n}, 0) AS DECIMAL(18, 8)), 2) AS DOUBLE)"
    return f"""SELECT '{a}' AS table_a, '{b}' AS table_b, na AS values_a, nb AS values_b, s AS shared, {pct.format(n='na')} AS coverage_a_pct, {pct.format(n='nb')} AS coverage_b_pct
        FROM (SELECT (SELECT count(*) FROM v_{a}) AS na, (SELECT count(*) FROM v_{b}) AS nb, (SELECT count(*) FROM v_{a} JOIN v_{b} USING (v)) AS s)"""


_COLUMNS = [(t, c, kind) for t, columns in _SKETCHED.items() for c, kind in columns.items()]


def _pairs_sql(condition: str, *columns: str) -> str:
    """Exact overlaps of all pairs of columns of a kind."""
    pct = "CAST(round(CAST(shared * 100.0 / nullif({n}, 0) AS DECIMAL(18, 8)), 2) AS DOUBLE)"
    parts = [
        f"""SELECT '{k}' AS identifier_type, '{a}' AS table_a, '{ca}' AS column_a, '{b}' AS table_b, '{cb}' AS column_b,
            (SELECT count(DISTINCT {ca}) FROM {a}) AS values_a, (SELECT count(DISTINCT {cb}) FROM {b}) AS values_b,
            (SELECT count(*) FROM (SELECT DISTINCT {ca} AS v FROM {a}) JOIN (SELECT DISTINCT {cb} AS v FROM {b}) USING (v)) AS shared"""
        for a, ca, k in _COLUMNS
        for b, cb, kb in _COLUMNS
        if k == kb and a < b
    ]
    more = "".join(f", {c}" for c in columns)
    return f"SELECT *{more}, {pct.format(n='values_a')} AS coverage_a_pct, {pct.format(n='values_b')} AS coverage_b_pct FROM ({' UNION ALL '.join(parts)}) WHERE {condition}"


ORACLES = {
    "prep_project": sql(
        """SELECT DISTINCT customer_id AS cust, order_email AS email, CAST(order_id AS VARCHAR) AS ord FROM shop_orders
           UNION ALL SELECT DISTINCT NULL, order_email, NULL FROM shop_orders WHERE order_email IS NOT NULL""",
        "shop_orders",
    ),
    "prep_sync": sql("SELECT * FROM kept", "crm_profiles", "src_day2", "shop_orders", ctes=_DAY2),
    "prep_new": sql("SELECT * FROM fresh", "crm_profiles", "src_day2", "shop_orders", ctes=_DAY2),
    "prep_input": sql(
        f"SELECT * FROM unif WHERE source <> 'crm' OR {_KEY} IN (SELECT {_KEY} FROM day2)",
        "crm_profiles",
        "src_day2",
        "shop_orders",
        ctes=_DAY2,
    ),
    "prep_append": sql(
        f"SELECT * FROM unif UNION ALL SELECT customer_id, email, phone, time, 'crm', time FROM day2 WHERE time > {AS_OF}",
        "crm_profiles",
        "src_day2",
        "shop_orders",
        ctes=_DAY2,
    ),
    "prep_masked": sql(_MASKED.format(t="masked_input"), "masked_input"),
    "prep_exclusions": sql(
        """SELECT * FROM known UNION ALL SELECT DISTINCT key_value, key_name, 'unif_input', 'DSAR masked ' || key_name FROM ("""
        + _MASKED.format(t="masked_input")
        + ") m WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.key_value = m.key_value AND k.key_name = m.key_name)",
        "masked_input",
        ctes=_KNOWN,
    ),
    "prep_exclude": sql(_CLEAN, "masked_input", ctes=_KNOWN),
    "prep_contact": sql(f"SELECT * FROM ({_CLEAN}) WHERE coalesce(email, phone) IS NOT NULL", "masked_input", ctes=_KNOWN),
    "prep_long": sql(_LONG, *_WEB),
    "prep_dist": sql(
        f"SELECT source_table AS key_type, count(DISTINCT key_value) AS unique_keys, count(*) AS total_records FROM ({_LONG}) GROUP BY 1", *_WEB
    ),
    "prep_long_keys": sql(_LONG_KEYS, *_WEB),
    "prep_dist_keys": sql(f"SELECT key_type, count(DISTINCT key_value) AS unique_keys, count(*) AS total_records FROM ({_LONG_KEYS}) GROUP BY 1", *_WEB),
    "key_profile": sql(
        " UNION ALL ".join(
            [_profile("crm_profiles", c) for c in ("customer_id", "email", "phone")] + [_profile("shop_orders", c) for c in ("customer_id", "order_email")]
        ),
        "crm_profiles",
        "shop_orders",
    ),
    "key_profile_numbers": sql(
        " UNION ALL ".join(
            f"""SELECT 'orders' AS table_name, '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
                count(DISTINCT {c}) AS unique_count, count(*) AS row_count, count(*) - count({c}) AS null_count FROM orders"""
            for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
        )
    ),
    "prep_exclude_numbers": sql("SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS phone FROM orders"),
    # Tables below 2^14 values: the estimates are exact.
    "key_overlap_estimate": sql(_pairs_sql("true", "CAST(0 AS BIGINT) AS error"), *_SKETCHED),
    "key_overlap_ranked": sql(_pairs_sql("shared > 0 AND 2 * shared >= least(values_a, values_b)"), *_SKETCHED),
    "key_profile_estimate": sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS identifier_type, count(DISTINCT {c}) AS unique_count, count(*) AS row_count, count(*) - count({c}) AS null_count FROM {t}"
            for t, c, k in _COLUMNS
        ),
        *_SKETCHED,
    ),
    "key_overlap": sql(
        " UNION ALL ".join([_overlap("crm", "shop"), _overlap("crm", "web"), _overlap("shop", "web")]),
        *_WEB,
        ctes="""v_crm AS (SELECT DISTINCT email AS v FROM crm_profiles WHERE email IS NOT NULL),
            v_shop AS (SELECT DISTINCT order_email AS v FROM shop_orders WHERE order_email IS NOT NULL),
            v_web AS (SELECT DISTINCT user_email AS v FROM web_events WHERE user_email IS NOT NULL)""",
    ),
    "key_detect": sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'string' AS data_type, '{k}' AS identifier_type, count(DISTINCT {c}) AS unique_count FROM {t}"
            for t, c, k in (
                ("crm_profiles", "customer_id", "user_id"),
                ("crm_profiles", "email", "email"),
                ("crm_profiles", "phone", "phone"),
                ("shop_orders", "customer_id", "user_id"),
                ("web_events", "cookie_id", "cookie_device"),
                ("web_events", "user_email", "email"),
                ("web_events", "customer_id", "user_id"),
                ("raw_contacts", "email", "email"),
                ("raw_contacts", "phone", "phone"),
            )
        ),
        *_WEB,
        "raw_contacts",
    ),
    "key_excluded": """SELECT * FROM (VALUES ('part', 'p_partkey, p_name, p_brand, p_type, p_size, p_retailprice', (SELECT count(*) FROM part)),
        ('nation', 'n_nationkey, n_name, n_regionkey', (SELECT count(*) FROM nation)), ('raw_json', 'event_id, attributes, time', (SELECT count(*) FROM events)))
        t(table_name, available_columns, row_count), (SELECT 'no user identifier columns found' AS reason)""",
}
