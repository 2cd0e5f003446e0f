"""Unification on an amplified input: how time grows, with and without a hub.

    python bench_scale.py COPIES [HUB]

Every copy of the three source tables has its own suffix on all identifiers. With
HUB, a third of all profiles share one phone, which ties a third of the copies'
components together. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from checks.fixtures import AS_OF
from checks.identity import CFG, CID, sources
from kindred.plans import canonical as K
from kindred.plans import extract as X
from kindred.plans import resolve as R
from kindred.session import local_session
from kindred.sources.scratch import Scratch


def amplify(df, copies: int, keys):
    many = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    tagged = {k: F.when(F.col(k).isin("", "N/A"), F.col(k)).otherwise(F.concat(F.col(k), F.lit("~"), F.col("_copy").cast("string"))) for k in keys}
    return many.withColumns(tagged).drop("_copy")


def main(copies: int, hub: bool) -> None:
    spark = local_session("scale", os.environ.get("BENCH_CPUS", "8"), partitions=32)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    scratch = Scratch(spark, "amplified")
    tables, records = {}, 0
    for table in CFG.tables:
        df = amplify(sources(spark, sf_dir)[table.name], copies, [kc.column for kc in table.key_columns])
        if hub and table.name == "crm_profiles":
            df = df.withColumn("phone", F.when(F.pmod(F.xxhash64("customer_id"), F.lit(3)) == 0, F.lit("5550000000")).otherwise(F.col("phone")))
        tables[table.name] = scratch.save(df, table.name)
        records += tables[table.name].count()
    started = time.perf_counter()
    pairs = X.pair_table(X.extract_all(tables, CFG, CID), len(CFG.tables))
    floor = int(os.environ.get("BENCH_FLOOR", R.HOT_FLOOR))
    done = R.resolve(pairs, CID, len(CFG.tables), AS_OF, floor=floor)
    lookup = scratch.save(K.lookup_table(done.graph, CID, floor), "lookup")
    spent = time.perf_counter() - started
    largest = lookup.groupBy("canonical_id").count().agg(F.max("count")).first()[0]
    profiles = lookup.select("canonical_id").distinct().count()
    print(
        json.dumps(
            {
                "records": records,
                "identifiers": lookup.count(),
                "profiles": profiles,
                "largest_profile": largest,
                "hub": hub,
                "steps": len(done.metrics),
                "metrics": done.metrics,
                "seconds": round(spent, 1),
                "records_per_second": round(records / spent),
            }
        )
    )


if __name__ == "__main__":
    main(int(sys.argv[1]), len(sys.argv) > 2)
