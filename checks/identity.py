"""Identity unification: queries and their SQL."""

from __future__ import annotations

import dataclasses
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import AS_OF, identity_config, sql, views
from kindred.functions.hashing import KEY_MASKS, canonical_hash, mask_of
from kindred.functions.keyrules import key_valid
from kindred.operators import prep as P
from kindred.plans import bucketed as B
from kindred.plans import canonical as K
from kindred.plans import enrich as E
from kindred.plans import extract as X
from kindred.plans import master as M
from kindred.plans import resolve as R
from kindred.plans import stats as S
from kindred.plans.config import CanonicalId, Key
from kindred.plans.unify import resolve_incremental, unify_levels
from kindred.sources.scratch import Scratch, checkpoint_root

CFG = identity_config()
CID = CFG.canonical_ids[0]
TABLES = [t.name for t in CFG.tables]
N = len(TABLES)
KEYS = CID.merge_by_keys

# Stored results of earlier steps, one set per session and data folder, as a job
# that runs step by step would keep them. The flagship query never uses them.
_STORED: dict[tuple, DataFrame] = {}


def _stored(spark: SparkSession, sf: str, name: str, make) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        _STORED[key] = Scratch(spark, f"stored-{name}").save(make(), name)
    return _STORED[key]


def sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return dict(zip(TABLES, views(spark, sf, *TABLES)))


def records(spark, sf):
    return X.extract_all(sources(spark, sf), CFG, CID)


def pairs(spark, sf):
    return _stored(spark, sf, "pairs", lambda: X.pair_table(records(spark, sf), N))


def graph0(spark, sf):
    return _stored(spark, sf, "graph0", lambda: X.edges(pairs(spark, sf), N, AS_OF))


def graph(spark, sf):
    return _stored(spark, sf, "graph", lambda: R.resolve(pairs(spark, sf), CID, N, AS_OF, saved=True, written=False).graph)


def lookup(spark, sf):
    return _stored(spark, sf, "lookup", lambda: K.lookup_table(graph(spark, sf), CID))


def enriched_one(spark, sf, table: str) -> DataFrame:
    t = CFG.tables[TABLES.index(table)]
    return _stored(spark, sf, f"enriched-{table}", lambda: E.enrich(sources(spark, sf)[table], CFG, CID, t, lookup(spark, sf)))


def enriched(spark, sf) -> dict[str, DataFrame]:
    return {name: enriched_one(spark, sf, name) for name in TABLES}


def master(spark, sf):
    return _stored(spark, sf, "master", lambda: M.master_table(CFG.master_tables[0], enriched(spark, sf), lookup(spark, sf)))


PRIORITIES = (3, 1, 2, 4)


def q_priorities(spark, sf):
    """Leaders by a rank of the key types that differs from their merge order."""
    ranked = dataclasses.replace(CID, key_priorities=PRIORITIES)
    found = R.resolve(pairs(spark, sf), ranked, N, AS_OF).graph
    return found.select("follower_id", "follower_ns", "leader_id", "leader_ns")


def ids_text(name: str):
    return F.concat_ws(",", F.transform(name, lambda x: x.cast("string")))


# -- queries ------------------------------------------------------------------


def q_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Which canonical customer does each identifier belong to?"""
    src = sources(spark, sf)
    pairs_now = X.pair_table(X.extract_all(src, CFG, CID), N)
    result = R.resolve(pairs_now, CID, N, AS_OF)
    found = K.lookup_table(result.graph, CID)
    return found.drop("id_last_processed_at").withColumn("id_source_table_ids", ids_text("id_source_table_ids"))


def q_extract(spark, sf):
    pair_text = lambda x: F.concat_ws(":", x["ns"].cast("string"), x["id"])
    return records(spark, sf).select(
        F.concat_ws("|", F.transform("id_ns_array", pair_text)).alias("ids"), "time", "source_table_id"
    )


def q_edges(spark, sf):
    df = X.edges(X.pair_table(records(spark, sf), N), N, AS_OF)
    return df.drop("follower_last_processed_at").withColumn("follower_source_table_ids", ids_text("follower_source_table_ids"))


def q_loop_step(spark, sf):
    df = R.loop_step(graph0(spark, sf), CID, AS_OF + 60)
    return df.withColumn("follower_source_table_ids", ids_text("follower_source_table_ids"))


def q_changed(spark, sf):
    before = graph0(spark, sf)
    after = R.loop_step(before, CID, AS_OF)
    return R.changed_links(before, after).agg(F.count(F.lit(1)).alias("updated_count"))


def q_source_stats(spark, sf):
    return S.source_key_stats(graph0(spark, sf), CFG, CID, AS_OF)


def q_result_stats(spark, sf):
    return S.result_key_stats(graph(spark, sf), CFG, CID, AS_OF)


def q_enrich(spark, sf):
    src, found = sources(spark, sf), lookup(spark, sf)
    parts = []
    for t, row_id in zip(CFG.tables, ("customer_id", "order_id", "event_id")):
        df = E.enrich(src[t.name], CFG, CID, t, found)
        parts.append(df.select(F.lit(t.name).alias("table_name"), F.col(row_id).cast("string").alias("row_id"), "time", CID.name))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _published(spark, sf):
    name = f"lookup_{uuid.uuid4().hex}"
    return B.publish_lookup(lookup(spark, sf), name, buckets=16, path=f"{checkpoint_root(spark)}/{name}")


def q_enrich_bucketed(spark, sf):
    """Enrichment from a lookup that lies in buckets of its keys."""
    src, found = sources(spark, sf), _published(spark, sf)
    parts = []
    for t, row_id in zip(CFG.tables, ("customer_id", "order_id", "event_id")):
        df = B.enrich_bucketed(src[t.name], CFG, CID, t, found)
        parts.append(df.select(F.lit(t.name).alias("table_name"), F.col(row_id).cast("string").alias("row_id"), "time", CID.name))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_master_bucketed(spark, sf):
    df = B.master_bucketed(spark, CFG.master_tables[0], enriched(spark, sf), _published(spark, sf))
    return df.withColumn("top_emails", F.concat_ws("|", "top_emails"))


def q_enrich_unknown(spark, sf):
    """The fallback: enrich the orders against a lookup of the other two tables only."""
    src = sources(spark, sf)
    two = {n: src[n] for n in ("crm_profiles", "web_events")}
    rows = [X.extract_ids(two[t.name], CFG, CID, t) for t in CFG.tables if t.name in two]
    part = X.pair_table(rows[0].unionByName(rows[1]), N)
    found = K.lookup_table(R.resolve(part, CID, N, AS_OF).graph, CID)
    return E.enrich(src["shop_orders"], CFG, CID, CFG.tables[1], found).select("order_id", CID.name)


def q_enrich_excl(spark, sf):
    src = sources(spark, sf)
    masked, = views(spark, sf, "masked_input")
    listed = P.extend_exclusions(
        spark.createDataFrame([], "key_value string, key_name string, tbls array<string>, note string"),
        P.find_masked(masked),
        "unif_input",
    )
    frequent = (
        src["shop_orders"].filter(F.col("order_email").isNotNull()).groupBy("order_email").agg(F.count(F.lit(1)).alias("n"))
    ).filter(F.col("n") > 8)
    listed = listed.unionByName(
        frequent.select(
            F.col("order_email").alias("key_value"),
            F.lit("email").alias("key_name"),
            F.array(F.lit("shop_orders")).alias("tbls"),
            F.lit("frequent").alias("note"),
        )
    )
    return E.enrich_excluding(src["shop_orders"], CID, CFG.tables[1], lookup(spark, sf), listed)


def q_master_value(spark, sf):
    return M.master_value(enriched_one(spark, sf, "shop_orders"), CID.name, "order_email", "time", "last_email")


def q_order_first(spark, sf):
    return M.master_value(enriched_one(spark, sf, "shop_orders"), CID.name, "customer_id", "time", "first_customer", newest=False)


def q_master_array(spark, sf):
    attribute = CFG.master_tables[0].attributes[3]
    df = M.master_array(enriched(spark, sf), CID.name, attribute)
    return df.withColumn("top_emails", F.concat_ws("|", "top_emails"))


def q_master(spark, sf):
    df = M.master_table(CFG.master_tables[0], enriched(spark, sf), lookup(spark, sf))
    return df.withColumn("top_emails", F.concat_ws("|", "top_emails"))


def q_master_counts(spark, sf):
    df = M.master_counts(enriched_one(spark, sf, "shop_orders"), CID.name, "customer_id", "all_user_ids", "order_count")
    joined = master(spark, sf).select(CID.name).join(df, CID.name)
    return joined.withColumn("all_user_ids", F.concat_ws("|", "all_user_ids"))


def q_hash(spark, sf):
    src, = views(spark, sf, "crm_profiles")
    ns = F.pmod(F.col("customer_id").cast("bigint"), F.lit(10)) + 1
    return src.select("customer_id", ns.alias("ns"), canonical_hash(F.col("customer_id"), mask_of(ns, 10)).alias("canonical_id"))


def q_key_validity(spark, sf):
    crm, = views(spark, sf, "crm_profiles")
    rule = CFG.key("email")
    return crm.select(
        "customer_id",
        key_valid(F.col("email"), rule.invalid_texts, rule.valid_regexp).cast("int").alias("by_both"),
        key_valid(F.col("email"), rule.invalid_texts).cast("int").alias("by_texts"),
        key_valid(F.col("email"), (), "^user[0-9]+@").cast("int").alias("by_regexp"),
        key_valid(F.col("email")).cast("int").alias("by_nothing"),
    )


def q_dims(spark, sf):
    """Identifiers per key and table name, through both reference tables."""
    found = lookup(spark, sf).select("id_key_type", F.explode("id_source_table_ids").alias("table_id"))
    counts = found.groupBy("id_key_type", "table_id").agg(F.count(F.lit(1)).alias("identities"))
    keys = K.key_dim(spark, CID).withColumnRenamed("key_type", "id_key_type")
    return counts.join(keys, "id_key_type").join(K.table_dim(spark, CFG), "table_id").select("key_name", "table_name", "identities")


def q_metadata(spark, sf):
    """Usable values per configured column, by the stored filter rules."""
    src = sources(spark, sf)
    parts = []
    for t in CFG.tables:
        for kc in t.key_columns:
            parts.append(
                src[t.name].groupBy(F.col(kc.column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(
                    F.lit(t.name).alias("table_name"), F.lit(kc.column).alias("column_name"), "value", "n"
                )
            )
    values = parts[0]
    for part in parts[1:]:
        values = values.unionByName(part)
    rules = K.column_lookup(spark, CFG).join(K.filter_lookup(spark, CFG), "key_name")
    # One row per configured column on this side.
    joined = values.join(F.broadcast(rules), ["table_name", "column_name"])
    ok = F.col("value").isNotNull() & ~F.array_contains("invalid_texts", F.col("value"))
    ok = ok & F.coalesce(F.rlike("value", F.col("valid_regexp")), F.lit(True))
    return joined.groupBy("database_name", "table_name", "column_name", "key_name").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(ok, F.col("n")).otherwise(0)).alias("usable_rows")
    )


def q_resolve_loop(spark, sf):
    """The step-by-step loop run to its fixpoint gives the same leaders."""
    done = R.loop_to_fixpoint(graph0(spark, sf), CID, AS_OF)
    return done.graph.select("follower_id", "follower_ns", "leader_id", "leader_ns")


def q_incremental(spark, sf):
    """Two tables unified first, the third added later: ids stay stable."""
    src = sources(spark, sf)
    rows = {t.name: X.extract_ids(src[t.name], CFG, CID, t) for t in CFG.tables}
    first = X.pair_table(rows["crm_profiles"].unionByName(rows["shop_orders"]), N)
    before = K.lookup_table(R.resolve(first, CID, N, AS_OF).graph, CID)
    before = Scratch(spark, "before").save(before, "lookup")
    after, _ = resolve_incremental(before, rows["web_events"], CID, N, AS_OF)
    return after.select("canonical_id", "id", "id_key_type", "id_first_seen_at", "id_last_seen_at")


LEVELS = replace(
    CFG,
    keys=CFG.keys + (Key("person_id"),),
    canonical_ids=(CanonicalId("person_id", ("email", "customer_id", "cookie_id")), CanonicalId("household_id", ("person_id", "phone"))),
    master_tables=(),
)


def q_levels(spark, sf):
    """Person by e-mail and customer id, then household by person and phone."""
    done = unify_levels(sources(spark, sf), LEVELS, AS_OF)
    crm = done["household_id"].enriched["crm_profiles"]
    return crm.select("customer_id", "person_id", "household_id")


# -- SQL ----------------------------------------------------------------------

_VALID = "{c} IS NOT NULL AND {c} NOT IN ('', 'N/A', 'null')"


def _pair(column: str, ns: int, email: bool = False) -> str:
    test = _VALID.format(c=column) + (f" AND regexp_matches({column}, '.*@.*')" if email else "")
    return f"CASE WHEN {test} THEN {{'ns': CAST({ns} AS BIGINT), 'id': {column}}} END"


def _rec(table: str, tid: int, *parts: str) -> str:
    return f"SELECT list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL) AS ids, time, CAST({tid} AS BIGINT) AS tid FROM {table}"


_RECS = {
    "crm_profiles": _rec("crm_profiles", 1, _pair("email", 1, True), _pair("customer_id", 2), _pair("phone", 3)),
    "shop_orders": _rec("shop_orders", 2, _pair("order_email", 1, True), _pair("customer_id", 2)),
    "web_events": _rec("web_events", 3, _pair("cookie_id", 4), _pair("user_email", 1, True), _pair("customer_id", 2)),
}


def _code(ns: str, ident: str) -> str:
    """Namespace and id as one text that sorts like the pair."""
    return f"lpad(CAST({ns} AS VARCHAR), 3, '0') || {ident}"


def _hash(code: str) -> str:
    masks = ", ".join(f"'{m}'" for m in KEY_MASKS)
    return hash_sql(f"substr({code}, 4)", f"([{masks}])[CAST(substr({code}, 1, 3) AS INT)]")


def hash_sql(ident: str, mask: str) -> str:
    def word(start: int) -> str:
        left = f"CAST('0x' || substr(sha256({ident}), {start}, 8) AS BIGINT)"
        right = f"CAST('0x' || substr({mask}, {start}, 8) AS BIGINT)"
        return f"lpad(to_hex(xor({left}, {right})), 8, '0')"

    return f"translate(to_base64(unhex({word(1)} || {word(9)} || substr({mask}, 17, 2))), '+/', '-_')"


def _graph_ctes(recs: list[str], prefix: str = "") -> str:
    """Links, followers, and the smallest leader of each component."""
    p = prefix
    return f"""
    {p}rec AS ({' UNION ALL '.join(_RECS[r] for r in recs)}),
    {p}raw AS (SELECT {_code('f.ns', 'f.id')} AS fc, {_code('ids[1].ns', 'ids[1].id')} AS lc, time, tid
            FROM (SELECT unnest(ids) AS f, ids, time, tid FROM {p}rec) u),
    {p}links AS (SELECT DISTINCT fc, lc FROM {p}raw),
    {p}fol AS (SELECT fc, min(time) AS first_at, max(time) AS last_at,
                   array_to_string(list_sort(list_distinct(list(tid))), ',') AS tids FROM {p}raw GROUP BY fc),
    {p}adj AS (SELECT DISTINCT a.lc AS x, b.lc AS y FROM {p}links a JOIN {p}links b ON a.fc = b.fc),
    {p}reach(x, y) AS (SELECT x, y FROM {p}adj UNION SELECT r.x, a.y FROM {p}reach r JOIN {p}adj a ON r.y = a.x),
    {p}root AS (SELECT x AS lc, min(y) AS rc FROM {p}reach GROUP BY x),
    {p}final AS (SELECT l.fc, min(r.rc) AS rc FROM {p}links l JOIN {p}root r ON l.lc = r.lc GROUP BY l.fc)
    """


GRAPH = _graph_ctes(TABLES)

_STEP = """
    step{n}_in AS (SELECT fc, lc FROM {prev} UNION SELECT DISTINCT p.lc AS fc, p.lc AS lc FROM {prev} p
                   WHERE p.lc IN (SELECT fc FROM {prev})),
    step{n}_new AS (SELECT fc, min(lc) AS newest FROM step{n}_in GROUP BY fc),
    step{n}_move AS (SELECT i.lc AS older, min(w.newest) AS newer FROM step{n}_in i JOIN step{n}_new w ON i.fc = w.fc
                     WHERE i.lc > w.newest GROUP BY i.lc),
    step{n} AS (SELECT i.fc, coalesce(m.newer, i.lc) AS lc, max(CASE WHEN m.newer IS NULL THEN 0 ELSE 1 END) AS moved
                FROM step{n}_in i LEFT JOIN step{n}_move m ON i.lc = m.older GROUP BY ALL)"""


def _steps(count: int) -> str:
    out = []
    for n in range(1, count + 1):
        out.append(_STEP.format(n=n, prev="links" if n == 1 else f"step{n - 1}"))
    return GRAPH.rstrip() + "," + ",".join(out)


_SPLIT = "substr({c}, 4) AS {n}_id, CAST(substr({c}, 1, 3) AS BIGINT) AS {n}_ns"


def split(code: str, name: str) -> str:
    return _SPLIT.format(c=code, n=name)


LOOKUP = GRAPH.rstrip() + f""",
    comp AS (SELECT f.rc, min(o.first_at) AS cfirst, max(o.last_at) AS clast FROM final f JOIN fol o ON f.fc = o.fc GROUP BY f.rc),
    lookup AS (SELECT {_hash('f.rc')} AS canonical_id, substr(f.fc, 4) AS id, CAST(substr(f.fc, 1, 3) AS BIGINT) AS id_key_type,
        c.cfirst AS canonical_id_first_seen_at, c.clast AS canonical_id_last_seen_at,
        o.first_at AS id_first_seen_at, o.last_at AS id_last_seen_at, o.tids AS id_source_table_ids, f.rc
      FROM final f JOIN fol o ON f.fc = o.fc JOIN comp c ON c.rc = f.rc)
"""

_FIRST = {
    "crm_profiles": f"list_filter([{_pair('email', 1, True)}, {_pair('customer_id', 2)}, {_pair('phone', 3)}], lambda x: x IS NOT NULL)[1]",
    "shop_orders": f"list_filter([{_pair('order_email', 1, True)}, {_pair('customer_id', 2)}], lambda x: x IS NOT NULL)[1]",
    "web_events": f"list_filter([{_pair('cookie_id', 4)}, {_pair('user_email', 1, True)}, {_pair('customer_id', 2)}], lambda x: x IS NOT NULL)[1]",
}


def _enriched(table: str, lookup_name: str = "lookup") -> str:
    own = _hash("kc")
    return f"""en_{table} AS (SELECT p.* EXCLUDE (k, kc), coalesce(k0.canonical_id, CASE WHEN kc IS NOT NULL THEN {own} END) AS unified_id
        FROM (SELECT *, {_code('k.ns', 'k.id')} AS kc FROM (SELECT *, {_FIRST[table]} AS k FROM {table}) q) p
        LEFT JOIN {lookup_name} k0 ON k0.id = p.k.id AND k0.id_key_type = p.k.ns)"""


ENRICHED = LOOKUP.rstrip() + "," + ",\n".join(_enriched(t) for t in TABLES)

MASTER = ENRICHED + """,
    last_value AS (
      SELECT unified_id, 'o' AS src, order_email AS v, time FROM en_shop_orders WHERE order_email IS NOT NULL
      UNION ALL SELECT unified_id, 'c', email, time FROM en_crm_profiles WHERE email IS NOT NULL
      UNION ALL SELECT unified_id, 'w', user_email, time FROM en_web_events WHERE user_email IS NOT NULL),
    last_ranked AS (SELECT *, row_number() OVER (PARTITION BY unified_id, src ORDER BY time DESC, v DESC) AS rn FROM last_value),
    emails AS (SELECT unified_id, coalesce(max(CASE WHEN src = 'o' THEN v END), max(CASE WHEN src = 'c' THEN v END),
                 max(CASE WHEN src = 'w' THEN v END)) AS best_email FROM last_ranked WHERE rn = 1 GROUP BY unified_id),
    phones AS (SELECT unified_id, phone AS best_phone FROM (SELECT unified_id, phone,
        row_number() OVER (PARTITION BY unified_id ORDER BY time DESC, phone DESC) AS rn FROM en_crm_profiles WHERE phone IS NOT NULL) WHERE rn = 1),
    firsts AS (SELECT unified_id, customer_id AS first_customer_id FROM (SELECT unified_id, customer_id,
        row_number() OVER (PARTITION BY unified_id ORDER BY time, customer_id) AS rn FROM en_shop_orders WHERE customer_id IS NOT NULL) WHERE rn = 1),
    tops AS (SELECT unified_id, array_to_string(list(v ORDER BY place, rn)[1:3], '|') AS top_emails,
        least(count(*), 3) AS n_top_emails FROM
        (SELECT *, row_number() OVER (PARTITION BY unified_id, place ORDER BY time DESC, v DESC) AS rn FROM
          (SELECT unified_id, 1 AS place, email AS v, time FROM en_crm_profiles WHERE email IS NOT NULL AND unified_id IS NOT NULL
           UNION ALL SELECT unified_id, 2, order_email, time FROM en_shop_orders WHERE order_email IS NOT NULL AND unified_id IS NOT NULL) e)
        WHERE rn <= 3 GROUP BY unified_id),
    everyone AS (SELECT DISTINCT unified_id FROM (SELECT unified_id FROM en_crm_profiles UNION ALL SELECT unified_id FROM en_shop_orders
        UNION ALL SELECT unified_id FROM en_web_events) WHERE unified_id IS NOT NULL),
    master AS (SELECT p.unified_id, best_email, best_phone, first_customer_id, coalesce(top_emails, '') AS top_emails,
        coalesce(n_top_emails, 0) AS n_top_emails
        FROM everyone p LEFT JOIN emails USING (unified_id) LEFT JOIN phones USING (unified_id)
        LEFT JOIN firsts USING (unified_id) LEFT JOIN tops USING (unified_id)
        WHERE p.unified_id IN (SELECT canonical_id FROM lookup))
"""


def ident(body: str, ctes: str = GRAPH, *extra: str) -> str:
    return sql(body, *TABLES, *extra, ctes=ctes, recursive=True)


_NAMES = {"email": 1, "customer_id": 2, "phone": 3, "cookie_id": 4}


def _source_stats_sql() -> str:
    cols = ", ".join(f"count(*) FILTER (CAST(substr(fc, 1, 3) AS INT) = {i}) AS distinct_{k}" for k, i in _NAMES.items())
    return f"""SELECT a.from_table, total_distinct, {', '.join('distinct_' + k for k in _NAMES)}, CAST({AS_OF} AS BIGINT) AS time
      FROM (SELECT from_table, count(DISTINCT lc) AS total_distinct FROM seen GROUP BY from_table) a
      JOIN (SELECT from_table, {cols} FROM (SELECT DISTINCT from_table, fc FROM seen) GROUP BY from_table) b USING (from_table)"""


# A leader counts for a table when one of its followers was seen there.
_SEEN = GRAPH.rstrip() + """,
    names(tid, from_table) AS (VALUES (1, 'crm_profiles'), (2, 'shop_orders'), (3, 'web_events')),
    seen AS (SELECT l.fc, l.lc, n.from_table FROM links l JOIN (SELECT DISTINCT fc, tid FROM raw) t ON l.fc = t.fc JOIN names n ON n.tid = t.tid
             UNION ALL SELECT fc, lc, '*' FROM links)"""

_RESULT = GRAPH.rstrip() + """,
    names(tid, from_table) AS (VALUES (1, 'crm_profiles'), (2, 'shop_orders'), (3, 'web_events')),
    profile AS (SELECT rc, """ + ", ".join(f"count(*) FILTER (CAST(substr(fc, 1, 3) AS INT) = {i}) AS n_{k}" for k, i in _NAMES.items()) + """
                FROM final GROUP BY rc),
    seen AS (SELECT DISTINCT f.rc, n.from_table FROM final f JOIN raw t ON f.fc = t.fc JOIN names n ON n.tid = t.tid
             UNION ALL SELECT DISTINCT rc, '*' FROM final),
    sp AS (SELECT s.from_table, p.* FROM seen s JOIN profile p USING (rc)),
    """ + ",\n".join(
    f"h_{k} AS (SELECT from_table, string_agg(n || ':' || c, ',' ORDER BY n) AS histogram_{k} FROM (SELECT from_table, n_{k} AS n, count(*) AS c FROM sp WHERE n_{k} > 0 GROUP BY ALL) GROUP BY from_table)"
    for k in _NAMES
)


def _result_stats_sql() -> str:
    counts = ", ".join(f"count(*) FILTER (n_{k} > 0) AS distinct_with_{k}" for k in _NAMES)
    hist = ", ".join(f"coalesce(histogram_{k}, '') AS histogram_{k}" for k in _NAMES)
    joins = " ".join(f"LEFT JOIN h_{k} USING (from_table)" for k in _NAMES)
    return f"""SELECT t.*, {hist}, CAST({AS_OF} AS BIGINT) AS time
      FROM (SELECT from_table, count(*) AS total_distinct, {counts} FROM sp GROUP BY from_table) t {joins}"""


def _enrich_union() -> str:
    rows = (("crm_profiles", "customer_id"), ("shop_orders", "order_id"), ("web_events", "event_id"))
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST({c} AS VARCHAR) AS row_id, time, unified_id FROM en_{t}" for t, c in rows)


_UNKNOWN = _graph_ctes(["crm_profiles", "web_events"]).rstrip() + f""",
    lookup AS (SELECT {_hash('rc')} AS canonical_id, substr(fc, 4) AS id, CAST(substr(fc, 1, 3) AS BIGINT) AS id_key_type FROM final),
    {_enriched('shop_orders')}"""

_EXCL = LOOKUP.rstrip() + """,
    bad AS (SELECT DISTINCT email AS v FROM masked_input WHERE length(email) = 64 AND email NOT LIKE '%@%'
            UNION SELECT order_email FROM shop_orders WHERE order_email IS NOT NULL GROUP BY order_email HAVING count(*) > 8),
    cleaned AS (SELECT order_id, nullif(customer_id, '') AS customer_id,
        CASE WHEN order_email IN (SELECT v FROM bad) THEN NULL ELSE nullif(order_email, '') END AS order_email, o_totalprice, time FROM shop_orders)"""

_FIRST_TWO = _graph_ctes(["crm_profiles", "shop_orders"], "p_")
_INCR = (
    _graph_ctes(TABLES).rstrip()
    + ","
    + _FIRST_TWO.rstrip()
    + """,
    p_comp AS (SELECT f.rc, min(o.first_at) AS seen FROM p_final f JOIN p_fol o ON f.fc = o.fc GROUP BY f.rc),
    older AS (SELECT f.rc, p.rc AS prc, c.seen FROM final f JOIN p_final p ON f.fc = p.fc JOIN p_comp c ON c.rc = p.rc),
    hashed AS (SELECT rc, prc, seen, """
    + _hash("prc")
    + """ AS cid FROM older),
    kept AS (SELECT rc, cid FROM (SELECT *, row_number() OVER (PARTITION BY rc ORDER BY seen, cid) AS rn FROM hashed) WHERE rn = 1)"""
)

def _components(prefix: str) -> str:
    """Links, roots and final leaders from an existing ``{prefix}rec``."""
    text = _graph_ctes([], prefix)
    return text[text.index(f"{prefix}raw AS") :]


def _first_of(*parts: str) -> str:
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)[1]"


_PERSON_KEYS = {
    "crm_profiles": (_pair("email", 1, True), _pair("customer_id", 2)),
    "shop_orders": (_pair("order_email", 1, True), _pair("customer_id", 2)),
    "web_events": (_pair("cookie_id", 3), _pair("user_email", 1, True), _pair("customer_id", 2)),
}
_PERSON_ID = "CASE WHEN person_id IS NOT NULL THEN {'ns': CAST(1 AS BIGINT), 'id': person_id} END"


def _levels_sql() -> str:
    """Level one per table, then the same search again with the person as a key."""
    parts = ["a_rec AS (" + " UNION ALL ".join(_rec(t, i + 1, *_PERSON_KEYS[t]) for i, t in enumerate(TABLES)) + ")", _components("a_")]
    for t in TABLES:
        parts.append(
            f"""p_{t} AS (SELECT s.*, {_hash('f.rc')} AS person_id FROM (SELECT *, {_first_of(*_PERSON_KEYS[t])} AS k FROM {t}) s
                LEFT JOIN a_final f ON f.fc = {_code('s.k.ns', 's.k.id')})"""
        )
    keys = {"crm_profiles": (_pair("phone", 2), _PERSON_ID), "shop_orders": (_PERSON_ID,), "web_events": (_PERSON_ID,)}
    parts.append("b_rec AS (" + " UNION ALL ".join(_rec(f"p_{t}", i + 1, *keys[t]) for i, t in enumerate(TABLES)) + ")")
    parts.append(_components("b_"))
    first = _first_of(*keys["crm_profiles"])
    return sql(
        f"""SELECT s.customer_id, s.person_id, {_hash('f.rc')} AS household_id FROM (SELECT *, {first} AS h FROM p_crm_profiles) s
            LEFT JOIN b_final f ON f.fc = {_code('s.h.ns', 's.h.id')}""",
        *TABLES,
        ctes=",\n".join(p.strip().rstrip(",") for p in parts),
        recursive=True,
    )


QUERIES = {
    "idu_lookup": q_lookup,
    "idu_priorities": q_priorities,
    "idu_extract": q_extract,
    "idu_edges": q_edges,
    "idu_loop_step": q_loop_step,
    "idu_resolve_loop": q_resolve_loop,
    "idu_changed": q_changed,
    "idu_source_stats": q_source_stats,
    "idu_result_stats": q_result_stats,
    "idu_enrich": q_enrich,
    "idu_enrich_bucketed": q_enrich_bucketed,
    "idu_master_bucketed": q_master_bucketed,
    "idu_enrich_unknown": q_enrich_unknown,
    "idu_enrich_excl": q_enrich_excl,
    "idu_master_value": q_master_value,
    "idu_order_first": q_order_first,
    "idu_master_array": q_master_array,
    "idu_master": q_master,
    "idu_master_counts": q_master_counts,
    "idu_hash": q_hash,
    "idu_key_validity": q_key_validity,
    "idu_dims": q_dims,
    "idu_metadata": q_metadata,
    "idu_incremental": q_incremental,
    "idu_levels": q_levels,
}

_META = " UNION ALL ".join(
    f"""SELECT 'client_stg' AS database_name, '{t.name}' AS table_name, '{kc.column}' AS column_name, '{kc.key}' AS key_name,
        count(*) AS row_count, count(*) FILTER ({_VALID.format(c=kc.column)}{" AND regexp_matches(" + kc.column + ", '.*@.*')" if kc.key == 'email' else ''}) AS usable_rows
        FROM {t.name}"""
    for t in CFG.tables
    for kc in t.key_columns
)

ORACLES = {
    "idu_lookup": ident("SELECT * EXCLUDE (rc) FROM lookup", LOOKUP),
    "idu_priorities": ident(
        f"""SELECT {split('l.fc', 'follower')}, {split('substr(min(b.code), 2)', 'leader')} FROM links l JOIN best b ON l.lc = b.lc GROUP BY l.fc""",
        GRAPH.rstrip() + f""", best AS (SELECT x AS lc, min(CAST({list(PRIORITIES)}[CAST(substr(y, 1, 3) AS INT)] AS VARCHAR) || y) AS code FROM reach GROUP BY x)""",
    ),
    "idu_extract": ident(
        "SELECT coalesce(array_to_string(list_transform(ids, lambda x: x.ns || ':' || x.id), '|'), '') AS ids, time, tid AS source_table_id FROM rec"
    ),
    "idu_edges": ident(
        f"""SELECT {split('l.fc', 'follower')}, {split('l.lc', 'leader')}, first_at AS follower_first_seen_at, last_at AS follower_last_seen_at,
            tids AS follower_source_table_ids FROM links l JOIN fol o ON l.fc = o.fc"""
    ),
    "idu_loop_step": ident(
        f"""SELECT {split('s.fc', 'follower')}, {split('s.lc', 'leader')}, first_at AS follower_first_seen_at, last_at AS follower_last_seen_at,
            tids AS follower_source_table_ids, CAST({AS_OF} + 60 * moved AS BIGINT) AS follower_last_processed_at
            FROM step1 s JOIN fol o ON s.fc = o.fc""",
        _steps(1),
    ),
    "idu_resolve_loop": ident(f"SELECT {split('fc', 'follower')}, {split('rc', 'leader')} FROM final"),
    "idu_changed": ident(
        "SELECT count(*) AS updated_count FROM (SELECT fc, lc FROM step1 EXCEPT SELECT fc, lc FROM links)", _steps(1)
    ),
    "idu_source_stats": ident(_source_stats_sql(), _SEEN),
    "idu_result_stats": ident(_result_stats_sql(), _RESULT),
    "idu_enrich": ident(_enrich_union(), ENRICHED),
    "idu_enrich_bucketed": ident(_enrich_union(), ENRICHED),
    "idu_master_bucketed": ident("SELECT * EXCLUDE (n_top_emails) FROM master", MASTER),
    "idu_enrich_unknown": ident("SELECT order_id, unified_id FROM en_shop_orders", _UNKNOWN),
    "idu_enrich_excl": ident(
        """SELECT c.*, k.canonical_id AS unified_id FROM cleaned c LEFT JOIN lookup k
           ON k.id = coalesce(c.order_email, c.customer_id) AND k.id_key_type = CASE WHEN c.order_email IS NOT NULL THEN 1 ELSE 2 END""",
        _EXCL,
        "masked_input",
    ),
    "idu_master_value": ident(
        "SELECT unified_id, max(CASE WHEN rn = 1 THEN order_email END) AS last_email FROM (SELECT *, row_number() OVER (PARTITION BY unified_id, order_email IS NULL ORDER BY time DESC, order_email DESC) AS rn FROM en_shop_orders WHERE unified_id IS NOT NULL) GROUP BY unified_id",
        ENRICHED,
    ),
    "idu_order_first": ident("SELECT unified_id, first_customer_id AS first_customer FROM firsts WHERE unified_id IS NOT NULL", MASTER),
    "idu_master_array": ident("SELECT unified_id, top_emails FROM tops", MASTER),
    "idu_master": ident("SELECT * EXCLUDE (n_top_emails) FROM master", MASTER),
    "idu_master_counts": ident(
        "SELECT unified_id, 0 AS part, array_to_string(list_sort(list_distinct(list(customer_id))), '|') AS all_user_ids, count(*) AS order_count FROM en_shop_orders WHERE unified_id IN (SELECT unified_id FROM master) GROUP BY unified_id",
        MASTER,
    ),
    "idu_hash": sql(
        "SELECT customer_id, CAST(customer_id AS BIGINT) % 10 + 1 AS ns, " + _hash("c") + " AS canonical_id FROM (SELECT *, lpad(CAST(CAST(customer_id AS BIGINT) % 10 + 1 AS VARCHAR), 3, '0') || customer_id AS c FROM crm_profiles)",
        "crm_profiles",
    ),
    "idu_key_validity": sql(
        """SELECT customer_id,
          CASE WHEN email IS NOT NULL AND email NOT IN ('', 'N/A', 'null') AND contains(email, '@') THEN 1 ELSE 0 END AS by_both,
          CASE WHEN email IS NOT NULL AND email NOT IN ('', 'N/A', 'null') THEN 1 ELSE 0 END AS by_texts,
          CASE WHEN email IS NOT NULL AND regexp_matches(email, '^user[0-9]+@') THEN 1 ELSE 0 END AS by_regexp,
          CASE WHEN email IS NOT NULL THEN 1 ELSE 0 END AS by_nothing FROM crm_profiles""",
        "crm_profiles",
    ),
    "idu_dims": ident(
        """SELECT k.key_name, n.table_name, count(*) AS identities FROM (SELECT DISTINCT fc, tid FROM raw) r
           JOIN (VALUES (1, 'email'), (2, 'customer_id'), (3, 'phone'), (4, 'cookie_id')) k(ns, key_name) ON k.ns = CAST(substr(r.fc, 1, 3) AS INT)
           JOIN (VALUES (1, 'crm_profiles'), (2, 'shop_orders'), (3, 'web_events')) n(tid, table_name) ON n.tid = r.tid GROUP BY ALL"""
    ),
    "idu_metadata": sql(_META, *TABLES),
    "idu_incremental": ident(
        f"""SELECT coalesce(k.cid, {_hash('f.rc')}) AS canonical_id, substr(f.fc, 4) AS id,
            CAST(substr(f.fc, 1, 3) AS BIGINT) AS id_key_type, o.first_at AS id_first_seen_at, o.last_at AS id_last_seen_at
            FROM final f JOIN fol o ON f.fc = o.fc LEFT JOIN kept k ON k.rc = f.rc""",
        _INCR,
    ),
}
ORACLES["idu_levels"] = _levels_sql()
