"""Reports: queries and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import identity as I
from checks.fixtures import AS_OF, sql, view, views
from kindred.operators import reports as R
from kindred.plans import canonical as K
from kindred.plans import resolve as V
from kindred.plans import stats as S
from kindred.sources import tables
from kindred.sources.scratch import checkpoint_root


def _stats(spark, sf):
    source = S.source_key_stats(I.graph0(spark, sf), I.CFG, I.CID, AS_OF)
    result = S.result_key_stats(I.graph(spark, sf), I.CFG, I.CID, AS_OF)
    return source, result


def q_key_stats(spark, sf):
    source, result = _stats(spark, sf)
    both = source.join(result.drop("time", "total_distinct"), "from_table")
    return R.key_stats_report(both)


def q_counts(spark, sf):
    return R.canonical_counts(I.lookup(spark, sf))


def q_top(spark, sf):
    return R.top_merged(I.lookup(spark, sf))


def q_distribution(spark, sf):
    return R.merge_distribution(I.lookup(spark, sf))


def q_keytypes(spark, sf):
    return R.key_type_distribution(I.lookup(spark, sf), K.key_dim(spark, I.CID))


def q_coverage(spark, sf):
    return R.attribute_coverage(I.master(spark, sf), I.CID.name)


def q_sample(spark, sf):
    df = R.sample(I.master(spark, sf), I.CID.name)
    return df.withColumn("top_emails", F.concat_ws("|", "top_emails"))


def q_config(spark, sf):
    """Configured columns with their rules, and the values the column holds."""
    rules = R.config_rule_report(K.column_lookup(spark, I.CFG), K.filter_lookup(spark, I.CFG))
    rules = rules.withColumn("invalid_texts", F.concat_ws("|", "invalid_texts"))
    src = I.sources(spark, sf)
    counts = None
    for t in I.CFG.tables:
        columns = [kc.column for kc in t.key_columns]
        one = src[t.name].agg(*[F.count(c).alias(c) for c in columns]).unpivot([], columns, "column_name", "values")
        one = one.withColumn("table_name", F.lit(t.name))
        counts = one if counts is None else counts.unionByName(one)
    return rules.join(counts, ["table_name", "column_name"])


def q_reconcile(spark, sf):
    df = R.master_reconcile(I.master(spark, sf), I.lookup(spark, sf))
    return df.withColumn("is_equal", F.col("is_equal").cast("int"))


def q_dedup(spark, sf):
    return R.dedup_rates(*_stats(spark, sf), I.KEYS)


def q_quality(spark, sf):
    return R.quality_score(R.attribute_coverage(I.master(spark, sf), I.CID.name))


def q_convergence(spark, sf):
    done = V.loop_to_fixpoint(I.graph0(spark, sf), I.CID, AS_OF, fixed_steps=4)
    return R.convergence_report(spark, done.metrics)


def q_id_coverage(spark, sf):
    df = R.id_coverage(I.enriched(spark, sf), I.CID.name)
    return df.withColumn("passed", F.col("passed").cast("int"))


def q_last_ingestion(spark, sf):
    return R.last_ingestion(view(spark, sf, "ledger"), "shop")


def q_failures(spark, sf):
    return R.recent_failures(view(spark, sf, "ledger"))


def q_freshness(spark, sf):
    names = ("orders_inc", "orders_hist", "orders_all")
    return R.freshness(dict(zip(names, views(spark, sf, *names))), "updated_at")


def q_presence(spark, sf):
    return R.key_presence(view(spark, sf, "crm_profiles"), ["customer_id", "email", "phone"])


def q_outliers(spark, sf):
    return R.merge_outliers(I.lookup(spark, sf), 10).withColumn("level", F.when(F.col("identity_count") > 20, "20+").otherwise("10+"))


def q_check_outputs(spark, sf):
    """Expected tables by phase against what the tables hold."""
    root, (hist, inc) = f"{checkpoint_root(spark)}/outputs-{uuid.uuid4().hex}", views(spark, sf, "orders_hist", "orders_inc")
    roots = {name: f"{root}/{name}" for name in ("orders_hist", "orders_inc", "crm_profiles")}
    tables.replace(hist, roots["orders_hist"])
    tables.replace(inc, roots["orders_inc"])
    tables.create_if_absent(spark, roots["crm_profiles"], "customer_id string, email string, time bigint")
    stats = tables.table_stats(spark, roots).select("table_name", "exists", "row_count")
    expected = spark.createDataFrame(
        [("ingestion", "orders_hist"), ("ingestion", "orders_inc"), ("staging", "crm_profiles"), ("unification", "lookup")],
        "phase string, table_name string",
    )
    return R.check_outputs(stats, expected)


QUERIES = {
    "rep_key_stats": q_key_stats,
    "rep_counts": q_counts,
    "rep_top": q_top,
    "rep_distribution": q_distribution,
    "rep_keytypes": q_keytypes,
    "rep_coverage": q_coverage,
    "rep_sample": q_sample,
    "rep_config": q_config,
    "rep_reconcile": q_reconcile,
    "rep_dedup": q_dedup,
    "rep_quality": q_quality,
    "rep_convergence": q_convergence,
    "rep_id_coverage": q_id_coverage,
    "rep_last_ingestion": q_last_ingestion,
    "rep_failures": q_failures,
    "rep_freshness": q_freshness,
    "rep_key_presence": q_presence,
    "rep_outliers": q_outliers,
    "rep_check_outputs": q_check_outputs,
}


def pct(part: str, whole: str, digits: int = 2) -> str:
    return f"CAST(round(CAST(({part}) * 100.0 / nullif({whole}, 0) AS DECIMAL(18, 8)), {digits}) AS DOUBLE)"


_BY_ID = "(SELECT canonical_id, count(*) AS identity_count FROM lookup GROUP BY canonical_id)"
_CLASS = "CASE WHEN identity_count = 1 THEN 1 WHEN identity_count = 2 THEN 2 WHEN identity_count <= 5 THEN 3 WHEN identity_count <= 10 THEN 4 ELSE 5 END"
_LABELS = "['1 identity (no merge)', '2 identities merged', '3-5 identities merged', '6-10 identities merged', '10+ identities merged']"


def _attribute(name: str, is_array: bool = False) -> str:
    filled = f"count(*) FILTER (n_{name} > 0)" if is_array else f"count({name})"
    average = f"CAST(round(CAST(avg(n_{name}) AS DECIMAL(18, 8)), 2) AS DOUBLE)" if is_array else "CAST(NULL AS DOUBLE)"
    return f"SELECT '{name}' AS attribute, count(*) AS total_records, {filled} AS filled, {pct(filled, 'count(*)')} AS coverage_pct, {average} AS avg_elements FROM counted"


_COUNTED = I.MASTER.rstrip() + """,
    counted AS (SELECT * FROM master),
    coverage AS (""" + " UNION ALL ".join(
    [_attribute("best_email"), _attribute("best_phone"), _attribute("first_customer_id"), _attribute("top_emails", True)]
) + ")"


def _coverage_row(table: str) -> str:
    share = pct("count(unified_id)", "count(*)")
    return f"SELECT '{table}' AS table_name, count(*) AS total_records, count(unified_id) AS with_canonical_id, {share} AS coverage_pct, CASE WHEN {share} > 90 THEN 1 ELSE 0 END AS passed FROM en_{table}"


_TOTALS = I.GRAPH.rstrip() + ", totals AS (SELECT " + ", ".join(
    f"count(DISTINCT fc) FILTER (CAST(substr(fc, 1, 3) AS INT) = {i}) AS source_{k}" for k, i in I._NAMES.items()
) + ", (SELECT count(DISTINCT rc) FROM final) AS final_canonical_ids FROM links)"

# Both statistics side by side, from their own SQL.
_STATS = I._RESULT.rstrip() + ", " + I._SEEN[len(I.GRAPH.rstrip()) + 1 :].replace("names(tid, from_table)", "names2(tid, from_table)").replace(
    "seen AS", "seen2 AS"
).replace("JOIN names n", "JOIN names2 n")
_STATS_SELECT = (
    "SELECT a.from_table, a.total_distinct, "
    + ", ".join(f"distinct_{k}" for k in I._NAMES)
    + ", a.time, "
    + ", ".join(f"distinct_with_{k}, histogram_{k}" for k in I._NAMES)
    + f" FROM ({I._source_stats_sql().replace('FROM seen', 'FROM seen2')}) a JOIN ({I._result_stats_sql()}) b USING (from_table)"
)

ORACLES = {
    "rep_key_stats": I.ident(_STATS_SELECT, _STATS),
    "rep_counts": I.ident(
        f"""SELECT t AS total_canonical_ids, u AS unique_canonical_ids, CAST(round(CAST(t * 1.0 / nullif(u, 0) AS DECIMAL(18, 8)), 2) AS DOUBLE) AS merge_ratio,
            {pct('t - u', 't', 1)} AS fragmentation_reduction_pct FROM (SELECT count(*) AS t, count(DISTINCT canonical_id) AS u FROM lookup)""",
        I.LOOKUP,
    ),
    "rep_top": I.ident(f"SELECT * FROM {_BY_ID} ORDER BY identity_count DESC, canonical_id LIMIT 10", I.LOOKUP),
    "rep_distribution": I.ident(
        f"""SELECT ({_LABELS})[c] AS merge_category, c AS class_order, n AS canonical_id_count, s AS total_identities,
              {pct('n', 'sum(n) OVER ()')} AS pct_of_profiles, {pct('s', 'sum(s) OVER ()')} AS pct_of_identities
            FROM (SELECT {_CLASS} AS c, count(*) AS n, CAST(sum(identity_count) AS BIGINT) AS s FROM {_BY_ID} GROUP BY 1)""",
        I.LOOKUP,
    ),
    "rep_keytypes": I.ident(
        """SELECT id_key_type, (['email', 'customer_id', 'phone', 'cookie_id'])[id_key_type] AS key_name, count(*) AS identity_count,
             count(DISTINCT canonical_id) AS unique_canonical_ids FROM lookup GROUP BY id_key_type""",
        I.LOOKUP,
    ),
    "rep_coverage": I.ident("SELECT * FROM coverage", _COUNTED),
    "rep_sample": I.ident("SELECT * EXCLUDE (n_top_emails) FROM master ORDER BY unified_id LIMIT 5", I.MASTER),
    "rep_config": sql(
        " UNION ALL ".join(
            f"""SELECT '{t.name}' AS table_name, '{kc.column}' AS column_name, '{kc.key}' AS key_name, 'client_stg' AS database_name,
                '|N/A|null' AS invalid_texts, {"'.*@.*'" if kc.key == 'email' else 'CAST(NULL AS VARCHAR)'} AS valid_regexp, count({kc.column}) AS values FROM {t.name}"""
            for t in I.CFG.tables
            for kc in t.key_columns
        ),
        *I.TABLES,
    ),
    "rep_reconcile": I.ident(
        "SELECT r AS total_records, u AS unique_canonical_ids, CASE WHEN r = u THEN 1 ELSE 0 END AS is_equal FROM (SELECT (SELECT count(*) FROM master) AS r, (SELECT count(DISTINCT canonical_id) FROM lookup) AS u)",
        I.MASTER,
    ),
    "rep_dedup": I.ident(
        "SELECT *, " + ", ".join(f"{pct(f'source_{k} - final_canonical_ids', f'source_{k}', 1)} AS {k}_dedup_pct" for k in I._NAMES) + " FROM totals",
        _TOTALS,
    ),
    "rep_quality": I.ident(
        """SELECT q AS quality_score, CASE WHEN q >= 95 THEN 'Excellent' WHEN q >= 85 THEN 'Good' ELSE 'Needs Improvement' END AS badge
           FROM (SELECT CAST(round(CAST(avg(coverage_pct) AS DECIMAL(18, 8)), 2) AS DOUBLE) AS q FROM coverage)""",
        _COUNTED,
    ),
    "rep_convergence": I.ident(
        " UNION ALL ".join(
            f"""SELECT CAST({n} AS BIGINT) AS iteration, (SELECT count(*) FROM step{n}) AS edge_count,
                (SELECT count(*) FROM (SELECT fc, lc FROM step{n} EXCEPT SELECT fc, lc FROM {'links' if n == 1 else f'step{n - 1}'})) AS updated_count"""
            for n in range(1, 5)
        ),
        I._steps(4),
    ),
    "rep_id_coverage": I.ident(" UNION ALL ".join(_coverage_row(t) for t in I.TABLES), I.ENRICHED),
    "rep_last_ingestion": sql(
        """SELECT max(time) AS last_ingestion_timestamp, strftime(make_timestamp(max(time) * 1000000), '%Y-%m-%d %H:%M:%S') AS last_ingestion
           FROM ledger WHERE source_name = 'shop' AND status = 'SUCCESS'""",
        "ledger",
    ),
    "rep_failures": sql(
        "SELECT source_name, table_name, error_message, end_time, time FROM ledger WHERE status = 'ERROR' ORDER BY time DESC, log_id LIMIT 10",
        "ledger",
    ),
    "rep_freshness": sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS total_records, min(updated_at) AS first_record, max(updated_at) AS latest_record FROM {t}"
            for t in ("orders_inc", "orders_hist", "orders_all")
        ),
        "orders_inc",
        "orders_hist",
    ),
    "rep_key_presence": sql(
        "SELECT count(*) AS total, count(customer_id) AS has_customer_id, count(email) AS has_email, count(phone) AS has_phone FROM crm_profiles",
        "crm_profiles",
    ),
    "rep_outliers": I.ident(
        f"SELECT *, CASE WHEN identity_count > 20 THEN '20+' ELSE '10+' END AS level FROM {_BY_ID} WHERE identity_count > 10", I.LOOKUP
    ),
    "rep_check_outputs": sql(
        """SELECT * FROM (VALUES ('ingestion', 'orders_hist', (SELECT count(*) FROM orders_hist), 'ok'), ('ingestion', 'orders_inc', (SELECT count(*) FROM orders_inc), 'ok'),
             ('staging', 'crm_profiles', 0, 'warning'), ('unification', 'lookup', NULL, 'error')) t(phase, table_name, row_count, result)""",
        "orders_hist",
        "orders_inc",
    ),
}
