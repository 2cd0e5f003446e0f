"""Staging: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import AS_OF, sql, view, views
from kindred.functions import cleaning as C
from kindred.functions import jsontext as J
from kindred.operators import staging as S

RULES = S.Rules(
    columns={"email": "email", "phone": "phone", "is_active": "boolean", "amount": "numeric", "segment": "string"},
)


def q_string(spark, sf):
    return view(spark, sf, "raw_contacts").select("contact_id", C.std_string(F.col("segment")).alias("segment"))


def q_email(spark, sf):
    return view(spark, sf, "raw_contacts").select("contact_id", *C.std_email("email"))


def q_phone(spark, sf):
    return view(spark, sf, "raw_contacts").select("contact_id", *C.std_phone("phone"))


def q_date(spark, sf):
    return view(spark, sf, "raw_dates").select("order_id", *C.std_date("order_date"))


def q_iso(spark, sf):
    df = view(spark, sf, "raw_dates")
    mixed = F.when(F.col("order_id") % 2 == 0, F.replace("iso_date", F.lit("Z"), F.lit("+00:00"))).otherwise(F.col("iso_date"))
    return df.select("order_id", *C.std_iso_utc("iso_date", mixed))


def q_epoch(spark, sf):
    return view(spark, sf, "raw_dates").select("order_id", *C.std_epoch("placed_at"))


def q_numeric(spark, sf):
    df = view(spark, sf, "raw_contacts")
    return df.select("contact_id", C.std_numeric(F.col("amount")).alias("amount"), C.std_numeric(F.col("balance"), "double").alias("balance"))


def q_boolean(spark, sf):
    df = view(spark, sf, "raw_contacts")
    return df.select("contact_id", C.std_boolean(F.col("is_active")).alias("is_active"), C.std_boolean(F.col("consent")).alias("consent"))


def q_json_keys(spark, sf):
    return S.json_keys(view(spark, sf, "raw_json"), "attributes")


def q_json_flat(spark, sf):
    df = view(spark, sf, "raw_json")
    flat = S.json_flatten(df, "attributes", S.collect_json_keys(df, "attributes"))
    return flat.withColumn("attributes_tags", F.concat_ws(",", "attributes_tags"))


def q_json_array(spark, sf):
    df = view(spark, sf, "raw_json")
    count = lambda key: F.coalesce(F.size(J.json_array(F.col("attributes"), [key])), F.lit(-1))
    tags = J.json_array(F.col("attributes"), ["tags"])
    return df.select("event_id", F.concat_ws("|", tags).alias("tags"), count("tags").alias("n_tags"), count("k").alias("n_k"))


def q_json_cast(spark, sf):
    df, j = view(spark, sf, "raw_json"), F.col("attributes")
    return df.select(
        "event_id",
        J.json_cast(j, ["k"], "bigint", -1).alias("k"),
        J.json_cast(j, ["user", "id"], "double").alias("user_id"),
        J.json_cast(j, ["user", "type"], "bigint", 0).alias("not_a_number"),
        J.json_cast(j, ["missing"], "string", "none").alias("missing"),
    )


def q_unnest(spark, sf):
    df = view(spark, sf, "raw_json").select("event_id", J.json_array(F.col("attributes"), ["tags"]).alias("tag"))
    return S.unnest(df, "tag", "place")


def q_metadata(spark, sf):
    return S.add_metadata(view(spark, sf, "shop_orders"), "shop_orders", AS_OF)


def q_join_dim(spark, sf):
    contacts, nation = views(spark, sf, "raw_contacts", "nation")
    dim = nation.select(C.std_string(F.concat(F.lit(" "), F.lower("n_name"))).alias("code"), "n_name", "n_regionkey", "n_nationkey")
    left = contacts.select("contact_id", C.std_string(F.concat(F.lit("Nation_"), F.col("nation_id"), F.lit(" "))).alias("nation_code"))
    return S.join_dim(left, dim, {"nation_code": "code"}, ["n_regionkey", "n_nationkey"])


def q_dedupe(spark, sf):
    return S.dedupe(view(spark, sf, "dup_orders"), ["order_id"], [("time", True)])


def q_dedupe_asc(spark, sf):
    return S.dedupe(view(spark, sf, "dup_orders"), ["customer_id", "order_email"], [("o_totalprice", False), ("time", True)])


def q_dedupe_batch(spark, sf):
    df = view(spark, sf, "dup_orders")
    mark = df.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY time)")).first()[0]
    return S.dedupe(df.filter(F.col("time") > mark), ["order_id"], [("time", True)])


def q_pipeline(spark, sf):
    """Clean, join on cleaned columns, de-duplicate: per e-mail the latest contact."""
    contacts, nation = views(spark, sf, "raw_contacts", "nation")
    contacts = contacts.drop("consent").withColumn("email", F.regexp_replace("email", r"\d", ""))
    rules = S.Rules(
        columns=RULES.columns,
        joins=[S.Join(nation, {"nation_id": "n_nationkey"}, ["n_name"])],
        keys=["email_std"],
        order=[("time", True)],
    )
    return S.guard_types(S.stage(contacts, rules, "contacts", AS_OF))


_WIDE = 230


def q_wide(spark, sf):
    """Orders with more than two hundred further columns; key and clock come last."""
    orders = view(spark, sf, "orders")
    wide = orders.select(*[(F.col("o_orderkey") + i).cast("string").alias(f"c{i}") for i in range(_WIDE)], "o_orderkey", F.col("o_custkey").alias("time"))
    staged = S.stage(wide, S.Rules(columns={"c0": "string"}), "orders", AS_OF)
    return staged.select("o_orderkey", "time", "c0", f"c{_WIDE - 1}", F.lit(len(staged.columns)).alias("n_columns"))


def q_decimal(spark, sf):
    """Exact numbers keep their digits."""
    lines = view(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity").cast("decimal(12,2)") / 8).cast("decimal(18,5)").alias("share")
    )
    return S.clean_columns(lines, S.classify_columns(lines.schema)).withColumn("share", F.col("share").cast("string"))


def _work(spark, sf):
    """Orders of one status changed, plus new ones without key."""
    orders = view(spark, sf, "orders_all")
    changed = orders.filter(F.col("status") == "P").withColumn("amount", F.col("amount") + 1)
    keyless = orders.filter(F.col("status") == "F").withColumns({"order_id": F.lit(None).cast("string"), "customer_id": F.lit("")})
    return changed.unionByName(keyless)


def q_upsert(spark, sf):
    return S.upsert(view(spark, sf, "orders_all"), _work(spark, sf), ["order_id"])


def q_upsert_pair(spark, sf):
    """Two key columns: ('1','23') and ('12','3') are different keys."""
    return S.upsert(view(spark, sf, "orders_all"), _work(spark, sf), ["order_id", "customer_id"])


def q_affected(spark, sf):
    return S.affected_rows(view(spark, sf, "orders_all"), _work(spark, sf), ["order_id"])


def q_defaults(spark, sf):
    df = view(spark, sf, "raw_contacts").select("contact_id", "segment", "amount", "email")
    return S.default_nulls(df, {"segment": "Unknown", "amount": "0"})


def q_mask(spark, sf):
    df, ok = view(spark, sf, "raw_contacts"), F.col("consent")
    return df.select(
        "contact_id",
        C.mask_email(F.col("email"), ok).alias("email_masked"),
        C.mask_phone(F.when(F.length("phone") > 4, F.col("phone")), ok).alias("phone_masked"),
        C.mask_text(F.col("segment"), ok).alias("address"),
    )


def q_flag_email(spark, sf):
    df, e = view(spark, sf, "raw_contacts"), F.lower(F.trim("email"))
    return df.select("contact_id", C.email_is_valid(e).cast("int").alias("email_valid"), C.email_is_test(e).cast("int").alias("is_test_email"))


def q_range(spark, sf):
    return view(spark, sf, "raw_contacts").select("contact_id", *C.check_range("balance", 0, 9000))


def q_date_range(spark, sf):
    return view(spark, sf, "raw_dates").select("order_id", *C.check_date_range("plain_day", "1996-01-01", 946684800))


def q_dups(spark, sf):
    return S.find_duplicates(view(spark, sf, "dup_orders"), ["order_id"])


def q_rules(spark, sf):
    """The rules row of one table, among rules derived for every order month."""
    months = view(spark, sf, "months")
    rules = months.select(
        F.concat(F.lit("db_"), F.substring("month_name", 1, 4)).alias("db_name"),
        F.concat(F.lit("orders_"), F.substring("month_name", 6, 2)).alias("table_name"),
        F.lit("order_id, customer_id").alias("partition_columns"),
        F.lit("time desc").alias("order_by_columns"),
        F.concat(F.lit('{"rows": '), F.col("n").cast("string"), F.lit("}")).alias("additional_rules"),
    )
    return S.select_rules(rules, "db_1997", "orders_05").unionByName(S.select_rules(rules, "db_1998", "orders_11"))


QUERIES = {
    "stg_string": q_string,
    "stg_email": q_email,
    "stg_phone": q_phone,
    "stg_date": q_date,
    "stg_iso": q_iso,
    "stg_epoch": q_epoch,
    "stg_numeric": q_numeric,
    "stg_boolean": q_boolean,
    "stg_json_keys": q_json_keys,
    "stg_json_flat": q_json_flat,
    "stg_json_array": q_json_array,
    "stg_json_cast": q_json_cast,
    "stg_unnest": q_unnest,
    "stg_metadata": q_metadata,
    "stg_join_dim": q_join_dim,
    "stg_dedupe": q_dedupe,
    "stg_dedupe_asc": q_dedupe_asc,
    "stg_dedupe_batch": q_dedupe_batch,
    "stg_pipeline": q_pipeline,
    "stg_wide": q_wide,
    "stg_decimal": q_decimal,
    "stg_upsert": q_upsert,
    "stg_upsert_pair": q_upsert_pair,
    "stg_affected": q_affected,
    "stg_defaults": q_defaults,
    "stg_mask": q_mask,
    "stg_flag_email": q_flag_email,
    "stg_range": q_range,
    "stg_date_range": q_date_range,
    "stg_dups": q_dups,
    "stg_rules": q_rules,
}

_RE = r"'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'"


def _std_string(c: str) -> str:
    return f"CASE WHEN trim(upper({c})) IN ('', 'NONE', 'NULL', 'N/A', 'NA') THEN NULL ELSE trim(upper({c})) END"


def _email(c: str) -> str:
    ok = f"coalesce(regexp_matches(lower(trim({c})), {_RE}), false)"
    return f"""lower(trim({c})) AS email, CASE WHEN {ok} THEN lower(trim({c})) END AS email_std,
        CASE WHEN {ok} THEN sha256(upper({c})) END AS email_hash, CASE WHEN {ok} THEN 'TRUE' ELSE 'FALSE' END AS email_valid"""


def _phone(c: str) -> str:
    digits = f"nullif(nullif(regexp_replace(trim({c}), '[^0-9]', '', 'g'), ''), '0')"
    std = f"CASE WHEN length({digits}) = 10 THEN {digits} WHEN length({digits}) = 11 AND {digits} LIKE '1%' THEN substr({digits}, 2) END"
    return f"""{c} AS phone, {std} AS phone_std, sha256({std}) AS phone_hash, CASE WHEN {std} IS NOT NULL THEN 'TRUE' ELSE 'FALSE' END AS phone_valid"""


def _dates(name: str, original: str, ts: str) -> str:
    return f"""{original} AS {name}, strftime({ts}, '%Y-%m-%d %H:%M:%S') AS {name}_std,
        epoch_us({ts}) // 1000000 AS {name}_unixtime, strftime({ts}, '%Y-%m-%d') AS {name}_date"""


_ANY_DATE = """coalesce(try_strptime(order_date, '%Y-%m-%d %H:%M:%S'), try_strptime(order_date, '%Y-%m-%dT%H:%M:%SZ'),
    CASE WHEN regexp_matches(order_date, '^[0-9]{9,11}$') THEN make_timestamp(CAST(order_date AS BIGINT) * 1000000) END,
    try_strptime(order_date, '%d-%m-%Y'), try_strptime(order_date, '%m/%d/%Y %H:%M:%S'))"""

_ROUND2 = "CAST(round(TRY_CAST(trim(amount) AS DECIMAL(18, 6)), 2) AS DOUBLE)"
_BOOL = "CASE WHEN lower(trim({c})) IN ('true', '1', 'yes') THEN 'TRUE' WHEN lower(trim({c})) IN ('false', '0', 'no') THEN 'FALSE' END"
_J = "CASE WHEN json_valid(attributes) THEN attributes END"


def _js(path: str) -> str:
    return f"nullif(upper(json_extract_string({_J}, '{path}')), '')"


_TAGS = f"CAST(json_extract(CASE WHEN json_type(j, '$.tags') = 'ARRAY' THEN j END, '$.tags') AS VARCHAR[])"

_WORK = """
    work AS (SELECT order_id, customer_id, status, amount + 1 AS amount, updated_at, order_day, time FROM orders_all WHERE status = 'P'
             UNION ALL SELECT NULL, '', status, amount, updated_at, order_day, time FROM orders_all WHERE status = 'F')"""


def _first(order: str, keys: str, source: str = "dup_orders") -> str:
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"


ORACLES = {
    "stg_string": sql(f"SELECT contact_id, {_std_string('segment')} AS segment FROM raw_contacts", "raw_contacts"),
    "stg_email": sql(f"SELECT contact_id, {_email('email')} FROM raw_contacts", "raw_contacts"),
    "stg_phone": sql(f"SELECT contact_id, {_phone('phone')} FROM raw_contacts", "raw_contacts"),
    "stg_date": sql(f"SELECT order_id, {_dates('order_date', 'order_date', _ANY_DATE)} FROM raw_dates", "raw_dates"),
    "stg_iso": sql(
        f"SELECT order_id, {_dates('iso_date', 'd', _ANY_DATE.replace('order_date', 'p'))} FROM (SELECT *, CASE WHEN order_id % 2 = 0 THEN replace(iso_date, 'Z', '+00:00') ELSE iso_date END AS d, iso_date AS p FROM raw_dates)",
        "raw_dates",
    ),
    "stg_epoch": sql(
        "SELECT order_id, placed_at, strftime(make_timestamp(placed_at * 1000000), '%Y-%m-%d %H:%M:%S') AS placed_at_std, placed_at AS placed_at_unixtime, strftime(make_timestamp(placed_at * 1000000), '%Y-%m-%d') AS placed_at_date FROM raw_dates",
        "raw_dates",
    ),
    "stg_numeric": sql(f"SELECT contact_id, {_ROUND2} AS amount, balance FROM raw_contacts", "raw_contacts"),
    "stg_boolean": sql(
        f"SELECT contact_id, {_BOOL.format(c='is_active')} AS is_active, CASE WHEN consent THEN 'TRUE' ELSE 'FALSE' END AS consent FROM raw_contacts",
        "raw_contacts",
    ),
    "stg_json_keys": sql(
        """SELECT k1, NULL AS k2, CASE json_type(j, '$."' || k1 || '"') WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'scalar' END AS kind
             FROM top GROUP BY ALL UNION ALL SELECT k1, k2, 'scalar' AS kind FROM nested GROUP BY ALL""",
        "raw_json",
        ctes=f"""docs AS (SELECT {_J} AS j FROM raw_json WHERE json_valid(attributes)),
             top AS (SELECT j, unnest(json_keys(j)) AS k1 FROM docs),
             nested AS (SELECT k1, unnest(json_keys(j, '$."' || k1 || '"')) AS k2 FROM top WHERE json_type(j, '$."' || k1 || '"') = 'OBJECT')""",
    ),
    "stg_json_flat": sql(
        f"""SELECT event_id, attributes, time, {_js('$."$src"')} AS attributes_src, {_js('$."b c"')} AS attributes_b_c,
              {_js('$.empty')} AS attributes_empty, {_js('$.k')} AS attributes_k,
              coalesce(array_to_string(CAST(json_extract({_J}, '$.tags') AS VARCHAR[]), ','), '') AS attributes_tags,
              {_js('$.user.id')} AS attributes_user_id, {_js('$.user.type')} AS attributes_user_type FROM raw_json""",
        "raw_json",
    ),
    "stg_json_array": sql(
        f"SELECT event_id, coalesce(array_to_string({_TAGS}, '|'), '') AS tags, coalesce(len({_TAGS}), -1) AS n_tags, -1 AS n_k FROM (SELECT event_id, {_J} AS j FROM raw_json)",
        "raw_json",
    ),
    "stg_json_cast": sql(
        f"""SELECT event_id, coalesce(TRY_CAST(json_extract_string({_J}, '$.k') AS BIGINT), -1) AS k,
              TRY_CAST(json_extract_string({_J}, '$.user.id') AS DOUBLE) AS user_id, CAST(0 AS BIGINT) AS not_a_number, 'none' AS missing FROM raw_json""",
        "raw_json",
    ),
    "stg_unnest": sql(
        f"""SELECT event_id, tag, place - 1 AS place FROM (SELECT event_id, {_TAGS} AS t FROM (SELECT event_id, {_J} AS j FROM raw_json)) d,
              unnest(t) WITH ORDINALITY AS u(tag, place)
            UNION ALL SELECT event_id, NULL, NULL FROM raw_json WHERE NOT coalesce(json_valid(attributes), false)""",
        "raw_json",
    ),
    "stg_metadata": sql("SELECT *, 'shop_orders' AS source_system, '2024-02-01 00:00:00' AS load_timestamp FROM shop_orders", "shop_orders"),
    "stg_join_dim": sql(
        "SELECT contact_id, 'NATION_' || nation_id AS nation_code, n_regionkey AS n_regionkey_dim, n_nationkey AS n_nationkey_dim FROM raw_contacts LEFT JOIN nation ON n_name = 'NATION_' || nation_id",
        "raw_contacts",
    ),
    "stg_dedupe": sql(_first("time DESC, customer_id DESC, o_totalprice DESC, order_email DESC NULLS LAST", "order_id"), "dup_orders"),
    "stg_dedupe_asc": sql(
        _first("o_totalprice ASC, time DESC, order_id DESC NULLS LAST", "customer_id, order_email"), "dup_orders"
    ),
    "stg_dedupe_batch": sql(
        _first(
            "time DESC, customer_id DESC, o_totalprice DESC, order_email DESC NULLS LAST",
            "order_id",
            "(SELECT * FROM dup_orders WHERE time > (SELECT quantile_disc(time, 0.5) FROM dup_orders))",
        ),
        "dup_orders",
    ),
    "stg_pipeline": sql(
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY email_std ORDER BY time DESC) AS rn FROM joined) WHERE rn = 1""",
        "raw_contacts",
        ctes=f"""cleaned AS (SELECT contact_id, {_email('e')}, {_phone('phone')}, {_BOOL.format(c='is_active')} AS is_active,
               {_ROUND2} AS amount, {_std_string('segment')} AS segment, balance, nation_id, time
               FROM (SELECT *, regexp_replace(email, '[0-9]', '', 'g') AS e FROM raw_contacts)),
             joined AS (SELECT c.*, n_name AS n_name_dim, 'contacts' AS source_system, '2024-02-01 00:00:00' AS load_timestamp
               FROM cleaned c LEFT JOIN nation ON nation_id = n_nationkey)""",
    ),
    "stg_wide": sql(
        f"""SELECT o_orderkey, o_custkey AS time, CAST(o_orderkey AS VARCHAR) AS c0, CAST(o_orderkey + {_WIDE - 1} AS VARCHAR) AS c{_WIDE - 1},
              {_WIDE} + 4 AS n_columns FROM orders"""
    ),
    "stg_decimal": sql(
        "SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(l_quantity AS DECIMAL(12, 2)) * 0.125 AS DECIMAL(18, 5)) AS VARCHAR) AS share FROM lineitem"
    ),
    "stg_upsert": sql(
        "SELECT * FROM orders_all WHERE order_id NOT IN (SELECT order_id FROM work WHERE order_id IS NOT NULL) UNION ALL SELECT * FROM work",
        "orders_all",
        ctes=_WORK,
    ),
    "stg_upsert_pair": sql(
        """SELECT * FROM orders_all o WHERE NOT EXISTS (SELECT 1 FROM work w WHERE w.order_id = o.order_id AND w.customer_id = o.customer_id)
           UNION ALL SELECT * FROM work""",
        "orders_all",
        ctes=_WORK,
    ),
    "stg_affected": sql("SELECT * FROM orders_all WHERE status = 'P'", "orders_all"),
    "stg_defaults": sql(
        "SELECT contact_id, coalesce(segment, 'Unknown') AS segment, coalesce(amount, '0') AS amount, email FROM raw_contacts", "raw_contacts"
    ),
    "stg_mask": sql(
        """SELECT contact_id,
             CASE WHEN consent THEN email WHEN email LIKE '%@%' THEN substr(email, 1, 3) || '***@' || split_part(email, '@', 2) END AS email_masked,
             CASE WHEN consent THEN p ELSE '***-***-' || right(p, 4) END AS phone_masked,
             CASE WHEN consent THEN segment END AS address FROM (SELECT *, CASE WHEN length(phone) > 4 THEN phone END AS p FROM raw_contacts)""",
        "raw_contacts",
    ),
    "stg_flag_email": sql(
        f"""SELECT contact_id, CASE WHEN regexp_matches(e, {_RE}) THEN 1 ELSE 0 END AS email_valid,
              CASE WHEN e LIKE '%@test.com' OR e LIKE '%@example.com' THEN 1 ELSE 0 END AS is_test_email
            FROM (SELECT *, lower(trim(email)) AS e FROM raw_contacts)""",
        "raw_contacts",
    ),
    "stg_range": sql(
        """SELECT contact_id, CASE WHEN balance < 0 OR balance > 9000 THEN NULL ELSE balance END AS balance_validated,
             CASE WHEN balance < 0 OR balance > 9000 THEN 'needs_review' ELSE 'valid' END AS validation_status FROM raw_contacts""",
        "raw_contacts",
    ),
    "stg_date_range": sql(
        """SELECT order_id, CASE WHEN plain_day < '1996-01-01' OR plain_day > '2000-01-01' THEN NULL ELSE plain_day END AS plain_day_validated,
             plain_day || ' 00:00:00' AS plain_day_timestamp FROM raw_dates""",
        "raw_dates",
    ),
    "stg_dups": sql("SELECT order_id, count(*) AS row_count FROM dup_orders GROUP BY order_id HAVING count(*) > 1", "dup_orders"),
    "stg_rules": sql(
        """SELECT 'db_' || substr(month_name, 1, 4) AS db_name, 'orders_' || substr(month_name, 6, 2) AS table_name,
             'order_id, customer_id' AS partition_columns, 'time desc' AS order_by_columns, '{"rows": ' || n || '}' AS additional_rules
           FROM months WHERE month_name IN ('1997-05', '1998-11')""",
        "months",
    ),
}
